"""Sources: VCF text, file catalogs, reference datasets and presets of public databases."""

from .catalog import collect_parquet_files, file_catalog, list_paths, partition_value
from .indexed import index_windows, read_vcf_regions, region_pieces, within_regions, write_indexed_vcf
from .presets import Preset, clinvar, dbsnp, ensembl, gnomad
from .ranges import in_touched_files, range_table, row_groups, touched, within_range_table
from .reference import (
    chromosome_list,
    chromosomes,
    match_reference_files,
    open_reference,
    prune,
    read_partitioned,
)
from .snapshots import newest_version, read_snapshot, write_snapshot
from .storage import finished, path_exists, scratch_dir
from .vcf import (
    default_path,
    header_info,
    header_lines,
    merge_info,
    parse_lines,
    read_info_fields,
    read_vcf,
    resolve_info,
    select_info,
    type_info,
    vcf_lines,
    vcf_to_parquet,
)

__all__ = [
    "Preset",
    "chromosome_list",
    "chromosomes",
    "clinvar",
    "collect_parquet_files",
    "dbsnp",
    "default_path",
    "ensembl",
    "file_catalog",
    "finished",
    "gnomad",
    "header_info",
    "header_lines",
    "index_windows",
    "in_touched_files",
    "list_paths",
    "match_reference_files",
    "merge_info",
    "newest_version",
    "open_reference",
    "parse_lines",
    "partition_value",
    "path_exists",
    "prune",
    "range_table",
    "read_info_fields",
    "read_partitioned",
    "read_snapshot",
    "read_vcf",
    "read_vcf_regions",
    "region_pieces",
    "resolve_info",
    "row_groups",
    "scratch_dir",
    "select_info",
    "touched",
    "type_info",
    "vcf_lines",
    "vcf_to_parquet",
    "within_range_table",
    "within_regions",
    "write_indexed_vcf",
    "write_snapshot",
]
