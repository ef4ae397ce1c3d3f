"""Jobs composed of sources, operators and sinks, and the queries that exercise them."""

from .jobs import (
    Prepared,
    annotate_clinical,
    annotate_vcf,
    build_bucketed_reference,
    build_reference,
    convert_pending,
    describe_dataset,
    pending_conversions,
    prepare,
    publish_plan,
    read_converted,
    save_annotated,
    split_existing,
    split_pending,
)
from .statistics import file_states, merged_statistics, refresh_statistics

__all__ = [
    "Prepared",
    "annotate_clinical",
    "annotate_vcf",
    "build_bucketed_reference",
    "build_reference",
    "convert_pending",
    "describe_dataset",
    "file_states",
    "merged_statistics",
    "pending_conversions",
    "prepare",
    "publish_plan",
    "read_converted",
    "refresh_statistics",
    "save_annotated",
    "split_existing",
    "split_pending",
]
