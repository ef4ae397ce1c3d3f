"""VCF text as variant tables.

``parse_lines`` turns any frame with one line per row into variants: lines from the text source, from a
stream or from block-gzip files.  All of it is column expressions.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import (
    base_name,
    framed_info,
    info_variant,
    is_index_file,
    late_info,
    percent_decoded,
    plain_path,
    source_name,
    typed_info,
)
from ..schema import ALT_SEPARATOR, InfoField, info_columns
from .blocks import SPLIT_BYTES, block_gzip_files, read_block_lines
from .catalog import file_catalog
from .storage import finished, task_opener

#: VCF columns before the sample columns.
_FIXED_COLUMNS = 8


def parse_lines(
    lines: DataFrame,
    info: Sequence[InfoField] = (),
    mode: str = "failfast",
    keep: Sequence[str] = (),
    variant: str | None = None,
) -> DataFrame:
    """Variants from a frame with a ``value`` column; header and blank lines are dropped.

    Only the first eight columns are cut out, so sample columns cost nothing however many there are.
    ``mode="failfast"`` raises on a line with too few columns or an unreadable position;
    ``mode="permissive"`` gives nulls instead.  ``keep`` names further columns of ``lines`` to retain.
    ``variant`` names a VARIANT column for all of INFO, which ``type_info`` takes fields from later.
    """
    if mode not in ("failfast", "permissive"):
        raise ValueError(f"unknown mode {mode!r}")
    cells = F.split("value", "\t", _FIXED_COLUMNS + 1)
    rows = lines.filter((F.col("value") != "") & ~F.col("value").startswith("#")).select(
        *keep, F.col("value").alias("_line"), cells.alias("_cells")
    )

    def cell(i: int) -> Column:
        return F.get("_cells", F.lit(i))

    def known(i: int) -> Column:
        return F.nullif(cell(i), F.lit("."))

    start = cell(1).try_cast("bigint")
    if mode == "failfast":
        bad = F.raise_error(F.concat(F.lit("not a VCF record: "), F.substring("_line", 1, 200)))
        start = F.when(F.size("_cells") >= _FIXED_COLUMNS, start)
        start = F.coalesce(start, bad.cast("bigint"))
    # Two steps, so that the position and the framed INFO text are made once per row and not once per use.
    fixed = rows.select(
        *keep,
        cell(0).alias("chrom"),
        start.alias("start"),
        known(2).alias("id"),
        cell(3).alias("ref"),
        F.translate(known(4), ",", ALT_SEPARATOR).alias("alt"),
        known(5).try_cast("double").alias("qual"),
        known(6).alias("filter"),
        framed_info(cell(7)).alias("_info"),
    )
    end = F.coalesce(typed_info("_info", InfoField("END", "1", "Integer")), F.col("start") + F.length("ref") - 1)
    names = info_columns(info)
    return fixed.select(
        *keep,
        "chrom",
        "start",
        end.alias("end"),
        "id",
        "ref",
        "alt",
        "qual",
        "filter",
        *[typed_info("_info", f).alias(names[f.id]) for f in info],
        *([info_variant("_info").alias(variant)] if variant else []),
    )


def type_info(df: DataFrame, fields: Sequence[InfoField], variant: str = "info") -> DataFrame:
    """``df`` with typed columns for the fields in place of its VARIANT column; a field that a row lacks is null.

    The columns are those that ``parse_lines`` makes of the same fields.
    """
    names = info_columns(fields)
    return df.select(*[c for c in df.columns if c != variant], *[late_info(variant, f).alias(names[f.id]) for f in fields])


def header_info(lines: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``id, number, type, description`` of the INFO declarations among the lines.

    A declaration starts with ``##INFO=<ID=``; the id ends at the first comma, or at ``>``.
    """
    value = F.col("value")

    def part(pattern: str) -> Column:
        text = F.regexp_extract("value", pattern, 1)
        return F.when(text != "", text)

    return lines.filter(value.rlike(r"^##INFO=<ID=[^,>]")).select(
        *keep,
        part(r"^##INFO=<ID=([^,>]+)").alias("id"),
        part(r"[<,]Number=([^,>]+)").alias("number"),
        part(r"[<,]Type=([^,>]+)").alias("type"),
        part(r'[<,]Description="((?:[^"\\]|\\.)*)"').alias("description"),
    )


def header_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``path, line, value`` of the lines above the first record of each file.

    Each file is opened in a task and left at its first record, so the cost does not depend on how much
    data follows the header.
    """
    opened = task_opener()

    def read(batches):
        import gzip
        import io

        import pyarrow as pa

        for batch in batches:
            for path in batch.column("path").to_pylist():
                with opened(path) as f:
                    packed = f.read(2) == b"\x1f\x8b"
                    f.seek(0)
                    text = gzip.GzipFile(fileobj=f) if packed else io.BufferedReader(f)
                    found = []
                    for line in text:
                        if not line.startswith(b"#"):
                            break
                        found.append(line.rstrip(b"\r\n").decode())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([path] * len(found), pa.string()),
                        pa.array(range(len(found)), pa.int64()),
                        pa.array(found, pa.string()),
                    ],
                    names=["path", "line", "value"],
                )

    files = file_catalog(spark, paths, recursive=False).filter(~is_index_file("path")).select("path")
    return files.mapInArrow(read, "path string, line bigint, value string")


def merge_info(declared: DataFrame) -> list[InfoField]:
    """One field per id from the declarations of many files, in the order of the first that has it.

    ``declared`` is ``header_info`` with a ``line`` column.  Files that disagree on the number or type
    of a field widen it to an array or to text.  Only distinct declarations reach the driver.
    """
    merged = (
        declared.groupBy("id")
        .agg(
            F.min("line").alias("line"),
            F.min_by("description", "line").alias("description"),
            F.min(F.coalesce("number", F.lit("."))).alias("low_number"),
            F.max(F.coalesce("number", F.lit("."))).alias("high_number"),
            F.min(F.coalesce("type", F.lit("String"))).alias("low_type"),
            F.max(F.coalesce("type", F.lit("String"))).alias("high_type"),
        )
        .select(
            "id",
            F.when(F.col("low_number") == F.col("high_number"), F.col("low_number")).otherwise(".").alias("number"),
            F.when(F.col("low_type") == F.col("high_type"), F.col("low_type")).otherwise("String").alias("type"),
            "description",
            "line",
        )
        .orderBy("line", "id")
    )
    return [InfoField(r["id"], r["number"], r["type"], r["description"]) for r in merged.collect()]


def read_info_fields(spark: SparkSession, paths: str | Sequence[str]) -> list[InfoField]:
    """The INFO fields that the headers of the files declare."""
    return merge_info(header_info(header_lines(spark, paths), keep=["line"]))


def select_info(declared: Sequence[InfoField], wanted: Sequence[str | InfoField] | None) -> list[InfoField]:
    """The wanted fields, in the wanted order; None means all.  Ids no header declares raise."""
    if wanted is None:
        return list(declared)
    known = {f.id: f for f in declared}
    missing = [w for w in wanted if not isinstance(w, InfoField) and w not in known]
    if missing:
        raise ValueError(f"INFO fields not declared in the header: {missing}; declared: {sorted(known)}")
    return [w if isinstance(w, InfoField) else known[w] for w in wanted]


def resolve_info(
    spark: SparkSession, paths: str | Sequence[str], wanted: Sequence[str | InfoField] | None
) -> list[InfoField]:
    """The wanted fields; headers are read only when some are given by name or all are wanted."""
    if wanted is not None and all(isinstance(f, InfoField) for f in wanted):
        return list(wanted)
    return select_info(read_info_fields(spark, paths), wanted)


def _by_packing(spark: SparkSession, paths: list[str], bgzf: bool | str) -> tuple[list[str], list[str]]:
    """The input files, without index files, as those for the text source and those to read by blocks.

    What a ``.gz`` is depends on its first bytes alone, not on its size.
    """
    files = file_catalog(spark, paths, recursive=False).filter(~is_index_file("path")).select("path", "size")
    found = files.collect()
    blocked = {r["path"] for r in found if r["path"].endswith(".bgz")}
    packed = [r for r in found if r["path"].endswith(".gz")]
    if bgzf is True:
        blocked |= {r["path"] for r in packed}
    elif bgzf == "auto" and packed:
        blocked |= {r["path"] for r in block_gzip_files(files.filter(F.col("path").endswith(".gz"))).collect()}
    return sorted(r["path"] for r in found if r["path"] not in blocked), sorted(blocked)


def vcf_lines(
    spark: SparkSession, paths: str | Sequence[str], bgzf: bool | str = "auto", split_bytes: int = SPLIT_BYTES
) -> DataFrame:
    """``value, source_file, source_path`` of VCF files, plain, gzip or block-gzip; index files are left out.

    Block-gzip files are read block by block in parallel: ``.bgz`` always, ``.gz`` with
    ``bgzf="auto"`` when the file starts with such a block, or with ``bgzf=True``.  Any other ``.gz`` is one task.
    Lines end at LF, CR LF or CR in either.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    plain, blocked = _by_packing(spark, paths, bgzf)
    parts = []
    if plain:
        text = spark.read.text(plain)
        path = plain_path(percent_decoded("_metadata.file_path"))
        parts.append(text.select("value", percent_decoded("_metadata.file_name").alias("source_file"), path.alias("source_path")))
    if blocked:
        text = read_block_lines(spark, blocked, split_bytes)
        parts.append(text.select("value", base_name("path").alias("source_file"), plain_path("path").alias("source_path")))
    if not parts:
        return spark.createDataFrame([], "value string, source_file string, source_path string")
    return reduce(DataFrame.unionByName, parts)


def read_vcf(
    spark: SparkSession,
    paths: str | Sequence[str],
    info_fields: Sequence[str | InfoField] | None = None,
    save_parquet: str | None = None,
    with_source: bool = False,
    with_path: bool = False,
    partitions: int | None = None,
    mode: str = "failfast",
    bgzf: bool | str = "auto",
    split_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """Read VCF files as one variant table.

    ``info_fields`` names the INFO fields that become columns: None takes all that the headers declare,
    an empty list none.  ``with_source`` adds ``source_file``, the stem of the file a row came from, and
    ``with_path`` adds ``source_path``, its whole path.
    ``partitions`` redistributes the rows after the read, for gzip files that Spark reads in one task.
    ``save_parquet`` writes the table, to a path or next to the input with ``"auto"``, and returns the
    written table.
    """
    info = resolve_info(spark, paths, info_fields)
    lines = vcf_lines(spark, paths, bgzf, split_bytes)
    if partitions:
        lines = lines.repartition(partitions)
    keep = ["source_file"] * with_source + ["source_path"] * with_path
    df = parse_lines(lines, info, mode, keep)
    if keep:
        names = df.columns[len(keep) :]
        df = df.select(*names, *[source_name(c).alias(c) if c == "source_file" else c for c in keep])
    if save_parquet is None:
        return df
    target = default_path(paths) if save_parquet == "auto" else save_parquet
    df.write.mode("overwrite").option("compression", "zstd").parquet(target)
    return spark.read.schema(df.schema).parquet(target)


def default_path(path: str | Sequence[str]) -> str:
    """Where the Parquet form of one VCF goes when no path is given: next to it.

    The same rule as ``default_parquet_name``, for a single path.
    """
    if not isinstance(path, str):
        raise ValueError("several inputs have no common default path; give one")
    named, n = re.subn(r"(?<=[^/])\.vcf(\.gz|\.bgz)?$", ".parquet", path)
    return named if n else re.sub(r"(?<=[^/])\.[^./]+$", "", path) + ".parquet"


def vcf_to_parquet(
    spark: SparkSession,
    path: str | Sequence[str],
    parquet_path: str | None = None,
    info_fields: Sequence[str | InfoField] | None = None,
    overwrite: bool = False,
    **options,
) -> tuple[DataFrame, str]:
    """Convert VCF to Parquet and return the written table with its path.

    A finished output is reused unless ``overwrite`` is set.
    """
    target = parquet_path or default_path(path)
    if finished(spark, target) and not overwrite:
        return spark.read.parquet(target), target
    return read_vcf(spark, path, info_fields, save_parquet=target, **options), target
