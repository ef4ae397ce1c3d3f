"""Column functions: every one takes and returns Column expressions, none is a Python UDF."""

from .alleles import alt_alleles, bare_chrom, chrom_sort_keys
from .info import framed_info, info_flag, info_value, info_variant, late_info, typed_info
from .names import (
    base_name,
    default_parquet_name,
    is_index_file,
    is_parquet_file,
    is_vcf_file,
    last_suffix,
    percent_decoded,
    plain_path,
    relative_path,
    source_id,
    source_name,
    stem,
)
from .sizes import gigabytes, human_size, megabytes, signed_bytes

__all__ = [
    "alt_alleles",
    "bare_chrom",
    "base_name",
    "chrom_sort_keys",
    "default_parquet_name",
    "framed_info",
    "gigabytes",
    "human_size",
    "info_flag",
    "info_value",
    "info_variant",
    "late_info",
    "is_index_file",
    "is_parquet_file",
    "is_vcf_file",
    "last_suffix",
    "megabytes",
    "percent_decoded",
    "plain_path",
    "relative_path",
    "signed_bytes",
    "source_id",
    "source_name",
    "stem",
    "typed_info",
]
