"""Genomic variant tables on Spark: VCF to Parquet, splitting by type, annotation."""

from .operators import annotate, match_rate, split_variants, write_split
from .plans import annotate_vcf, prepare, publish_plan, split_existing
from .schema import CORE_SCHEMA, KEYS, InfoField, variant_schema
from .sources import open_reference, read_info_fields, read_vcf, vcf_to_parquet

__all__ = [
    "CORE_SCHEMA",
    "KEYS",
    "InfoField",
    "annotate",
    "annotate_vcf",
    "match_rate",
    "open_reference",
    "prepare",
    "publish_plan",
    "read_info_fields",
    "read_vcf",
    "split_existing",
    "split_variants",
    "variant_schema",
    "vcf_to_parquet",
    "write_split",
]
