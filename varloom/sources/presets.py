"""Presets of the public variant databases."""

from __future__ import annotations

from dataclasses import dataclass, replace

from ..schema import TYPE_COLUMN


@dataclass(frozen=True)
class Preset:
    """How to find and split the files of one database.

    ``vcf_suffix=False`` takes every selected file that is no index for a VCF, whatever its name.
    """

    name: str
    pattern: str
    type_column: str = TYPE_COLUMN
    snv_types: tuple[str, ...] = ("SNV",)
    explode_snv_alt: bool = True
    vcf_suffix: bool = True

    def with_pattern(self, pattern: str | None) -> "Preset":
        """The same preset selecting other files; None keeps its own pattern."""
        return self if pattern is None else replace(self, pattern=pattern)


# File-name patterns of the published files.
CLINVAR_PATTERN = r"clinvar\.vcf\.gz$"
ENSEMBL_PATTERN = r"homo_sapiens-chr([^.]+)\.vcf\.gz$"
DBSNP_PATTERNS = {
    "GRCh38": r"GCF_000001405\.40\.gz$",
    "GRCh37": r"GCF_000001405\.25\.gz$",
}
GNOMAD_PATTERNS = {
    "v4": r"gnomad\.v4\.0\..+\.vcf\.bgz$",
    "v3": r"gnomad\.v3\.1\.2\..+\.vcf\.bgz$",
}

# The INFO field in which ClinVar names the variant type, and its word for an SNV.
CLINVAR_TYPE_COLUMN = "clnvc"
CLINVAR_SNV = "single_nucleotide_variant"


def clinvar() -> Preset:
    return Preset("clinvar", CLINVAR_PATTERN, type_column=CLINVAR_TYPE_COLUMN, snv_types=(CLINVAR_SNV,))


def ensembl() -> Preset:
    return Preset("ensembl", ENSEMBL_PATTERN)


def dbsnp(build: str = "GRCh38") -> Preset:
    """dbSNP.  Its files carry no ``.vcf`` suffix."""
    if build not in DBSNP_PATTERNS:
        raise ValueError(f"unsupported build {build!r}; use one of {sorted(DBSNP_PATTERNS)}")
    return Preset(f"dbsnp_{build.lower()}", DBSNP_PATTERNS[build], vcf_suffix=False)


def gnomad(version: str = "v4") -> Preset:
    if version not in GNOMAD_PATTERNS:
        raise ValueError(f"unsupported version {version!r}; use one of {sorted(GNOMAD_PATTERNS)}")
    return Preset(f"gnomad_{version}", GNOMAD_PATTERNS[version])
