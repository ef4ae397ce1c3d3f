"""Operators: functions from DataFrames to DataFrames."""

from .annotate import annotate, match_rate, semi_reduce, suffix_collisions
from .bloom import bloom_reduce, filter_by_bitmaps, filter_segments, key_bitmaps, merge_bitmaps
from .manifest import (
    compare_sizes,
    convert_count_check,
    dataset_stats,
    last_by_name,
    missing_locals,
    missing_paths,
    publish_paths,
    raise_on_errors,
    reconcile,
    require_parquet,
    size_mismatches,
    sync_plan,
    sync_reasons,
    sync_summary,
    variant_types_present,
)
from .predicates import annotated_only, containing, head, matching, natural_order, of_type, on_chroms, region
from .skew import KeyProfile, heavy_keys, profile_keys, salted_join, sketch_keys
from .split import (
    distinct_values,
    expected_splits,
    explode_alt,
    pending_sources,
    read_split,
    split_completeness,
    split_variants,
    type_counts,
    with_source,
    write_split,
)

__all__ = [
    "bloom_reduce",
    "filter_by_bitmaps",
    "filter_segments",
    "key_bitmaps",
    "merge_bitmaps",
    "sketch_keys",
    "KeyProfile",
    "annotate",
    "annotated_only",
    "compare_sizes",
    "containing",
    "convert_count_check",
    "dataset_stats",
    "distinct_values",
    "expected_splits",
    "explode_alt",
    "head",
    "heavy_keys",
    "last_by_name",
    "match_rate",
    "matching",
    "missing_locals",
    "missing_paths",
    "natural_order",
    "of_type",
    "on_chroms",
    "pending_sources",
    "profile_keys",
    "publish_paths",
    "raise_on_errors",
    "read_split",
    "reconcile",
    "region",
    "require_parquet",
    "salted_join",
    "semi_reduce",
    "size_mismatches",
    "split_completeness",
    "split_variants",
    "suffix_collisions",
    "sync_plan",
    "sync_reasons",
    "sync_summary",
    "type_counts",
    "variant_types_present",
    "with_source",
    "write_split",
]
