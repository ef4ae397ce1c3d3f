"""User-level jobs: prepare a dataset, split it, annotate against it, plan its publication."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import bare_chrom, is_index_file, is_vcf_file, percent_decoded, plain_path, relative_path, source_id, source_name, stem
from ..operators.annotate import annotate
from ..operators.manifest import dataset_stats, publish_paths, raise_on_errors, reconcile, require_parquet, sync_plan
from ..operators.predicates import annotated_only, containing
from ..operators.split import (
    SOURCE_COLUMN,
    expected_splits,
    pending_sources,
    split_completeness,
    split_variants,
    write_split,
)
from ..schema import CORE_SCHEMA, KEYS, TYPE_COLUMN, InfoField, info_columns, info_type, variant_schema
from ..sources.catalog import collect_parquet_files, file_catalog, partition_value
from ..sources.presets import Preset
from ..sources.ranges import in_touched_files, range_table, within_range_table
from ..sources.reference import open_reference
from ..sources.storage import path_exists, qualified, scratch_dir
from ..sources.vcf import header_info, header_lines, merge_info, read_vcf, select_info


#: Folders beside written data, which Spark skips when it reads the data: inputs without records, declared INFO
#: fields by version, and the columns of splits.
EMPTY_SOURCES = "_empty_sources"
INFO_FIELDS = "_info_fields"
SPLIT_COLUMNS = "_split_columns"

#: Partition columns beside the source's name: what tells equal names apart, and the version of the INFO columns.
SOURCE_ID = "source_id"
VERSION = "info_version"
NO_FIELDS = "000000"
_SOURCE = "_source"

#: Reference rows of a bucket, and the fewest buckets of a reference whose number of them is not given.
ROWS_PER_BUCKET = 500_000
LEAST_BUCKETS = 8


def save_annotated(df: DataFrame, out: str | None, compression: str = "zstd") -> str:
    """Write an annotated table as Parquet and return its path."""
    if out is None:
        raise ValueError("an output path is required to save annotated variants")
    df.write.mode("overwrite").option("compression", compression).parquet(out)
    return out


def annotate_vcf(
    spark: SparkSession,
    vcf: str | Sequence[str],
    reference: str,
    variant_type: str | None = "SNV",
    on: Sequence[str] = KEYS,
    how: str = "left",
    out: str | None = None,
    info_fields: Sequence[str | InfoField] | None = None,
    bgzf: bool | str = "auto",
    choose_files: bool = False,
    **options,
) -> DataFrame | str:
    """Annotate VCF files against a reference dataset.

    Only the reference data of the chosen type and of the chromosomes and stretches that occur in the VCF is read.
    With ``choose_files`` the footers of the reference say first which of its files hold such stretches, which pays
    for references of many files sorted by position.
    Without ``out`` the annotated table comes back, otherwise its path.  ``options`` go to
    ``annotate``.
    """
    # The text is parsed once: chromosomes, lengths, key sizes and the join read the converted table.
    parsed = read_vcf(spark, vcf, info_fields, bgzf=bgzf)
    table = scratch_dir(spark, "annotate_vcf")
    parsed.write.parquet(table)
    variants = spark.read.schema(parsed.schema).parquet(table)
    # Pruned by the names that the join sees
    named = variants
    if options.get("strip_chr_prefix"):
        named = variants.withColumn("chrom", bare_chrom("chrom"))
    stretches = scratch_dir(spark, "stretches")
    range_table(named).write.parquet(stretches)
    ranges = spark.read.parquet(stretches)
    found = open_reference(spark, reference, variant_type, named.filter("chrom IS NOT NULL").select("chrom").distinct())
    if found is not None:
        # Lengths of Parquet tables come from their footers, before position filters.
        options = {"left_rows": None if options.get("explode_alt") else variants.count(), "reference_rows": found.count(), **options}
        if {"chrom", "start"} <= set(on):
            if choose_files:
                found = in_touched_files(found, ranges)
            found = within_range_table(found, ranges)
    annotated = annotate(variants, found, on, how, **options)
    return annotated if out is None else save_annotated(annotated, out)


def annotate_clinical(
    spark: SparkSession,
    vcf: str | Sequence[str],
    reference: str,
    column: str = "clnsig",
    contains: str | None = None,
    **options,
) -> DataFrame:
    """Annotate and keep the rows for which ``column`` has a value or contains a text.

    Without reference data for the chromosomes no row has one.
    """
    df = annotate_vcf(spark, vcf, reference, variant_type=None, **options)
    if column not in df.columns:
        return df.limit(0)
    return annotated_only(df, column) if contains is None else containing(df, column, contains)


def select_files(
    spark: SparkSession, preset: Preset, landing_dir: str, pattern: str | None = None, recursive: bool = False
) -> DataFrame:
    """Catalog of the landed files that a preset selects, index files included."""
    return file_catalog(spark, landing_dir, preset.with_pattern(pattern).pattern, recursive=recursive)


def pending_conversions(inputs: DataFrame, converted: DataFrame) -> DataFrame:
    """Inputs without an output: ``inputs(path)`` against ``converted(source_file)``."""
    named = inputs.select("path", source_name("path").alias(SOURCE_COLUMN))
    return named.join(converted.select(SOURCE_COLUMN).distinct(), SOURCE_COLUMN, "left_anti")


def _written_partitions(spark: SparkSession, out: str, *columns: str) -> DataFrame:
    """The partition values of a written dataset, from its file listing alone."""
    if not path_exists(spark, out):
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in columns))
    files = file_catalog(spark, out, name_glob="*.parquet")
    return files.select(*[partition_value("path", c).alias(c) for c in columns]).distinct()


def _converted_sources(spark: SparkSession, out: str) -> DataFrame:
    """``source_file, source_id`` of the inputs that have an output or are known to hold no rows."""
    written = _written_partitions(spark, out, SOURCE_COLUMN, SOURCE_ID)
    empty = f"{out.rstrip('/')}/{EMPTY_SOURCES}"
    return written.unionByName(spark.read.parquet(empty)) if path_exists(spark, empty) else written


_DECLARED = "version string, id string, number string, type string, description string, line long"


def _stored_fields(spark: SparkSession, out: str) -> DataFrame:
    """The INFO declarations kept beside converted data, by version."""
    path = f"{out.rstrip('/')}/{INFO_FIELDS}"
    return spark.read.schema(_DECLARED).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], _DECLARED)


def _fields_by_version(stored: DataFrame) -> dict[str, list[InfoField]]:
    """One row per declared field and version reaches the driver."""
    out: dict[str, list[InfoField]] = {}
    for r in stored.orderBy("version", "line", "id").collect():
        out.setdefault(r["version"], []).append(InfoField(r["id"], r["number"], r["type"], r["description"]))
    return out


def _declare(
    spark: SparkSession, out: str, paths: Sequence[str], wanted: Sequence[str | InfoField] | None
) -> tuple[list[InfoField], str]:
    """The fields of the files that are to be converted, and the version of the table they belong to.

    Only the headers of these files are read; what earlier ones declared is stored.  A field that is declared
    differently is widened from here on, and the table gets a new version.
    """
    stored = _stored_fields(spark, out)
    if wanted is not None and all(isinstance(f, InfoField) for f in wanted):
        fields = list(wanted)
    else:
        new = header_info(header_lines(spark, paths), keep=["line"])
        known = merge_info(new.unionByName(stored.drop("version")))
        fields = select_info(known, wanted)
    versions = _fields_by_version(stored)
    for version, had in versions.items():
        if [f[:3] for f in had] == [f[:3] for f in fields]:
            return fields, version
    version = f"{len(versions) + 1:06d}"
    rows = [(version, f.id, f.number, f.type, f.description, i) for i, f in enumerate(fields)]
    if rows:
        kept = spark.createDataFrame(rows, _DECLARED).coalesce(1)
        kept.write.mode("append").parquet(f"{out.rstrip('/')}/{INFO_FIELDS}")
    return fields, version if rows else NO_FIELDS


def convert_pending(
    spark: SparkSession,
    inputs: DataFrame,
    out: str,
    info_fields: Sequence[str | InfoField] | None = None,
    overwrite: bool = False,
    bgzf: bool | str = "auto",
    mode: str = "failfast",
    root: str | None = None,
) -> list[str]:
    """Convert the VCF files of a catalog that have no output yet, all in one job.

    The output is partitioned by ``info_version``, ``source_file`` and ``source_id``; the id tells files of one name
    apart, by their path below ``root`` or by the whole path.  A file counts as converted when its partition
    exists; partitions appear only when the job that writes them commits.  Files without records leave no
    partition and are noted beside the data.  Returns the files converted.  ``read_converted`` reads the output.
    """
    named = inputs.select("path", source_name("path").alias(SOURCE_COLUMN), source_id("path", root).alias(SOURCE_ID))
    pending = named
    if not overwrite:
        pending = named.join(_converted_sources(spark, out).select(SOURCE_ID).distinct(), SOURCE_ID, "left_anti")
    # One name per input file; Spark takes the paths to read as a list.
    paths = sorted(r["path"] for r in pending.select("path").collect())
    if paths:
        info, version = _declare(spark, out, paths, info_fields)
        df = read_vcf(spark, paths, info, with_source=True, with_path=True, mode=mode, bgzf=bgzf)
        df = df.select("*", F.lit(version).alias(VERSION), source_id("source_path", root).alias(SOURCE_ID)).drop("source_path")
        write_split(df, out, [VERSION, SOURCE_COLUMN, SOURCE_ID], layout="scan", replace_partitions=True)
        done = spark.createDataFrame([(p,) for p in paths], "path string").join(named, "path")
        empty = done.join(_converted_sources(spark, out).select(SOURCE_ID), SOURCE_ID, "left_anti")
        empty = empty.select(SOURCE_COLUMN, SOURCE_ID)
        if not empty.isEmpty():
            empty.write.mode("append").parquet(f"{out.rstrip('/')}/{EMPTY_SOURCES}")
    return paths


def _widened(column: str, had: InfoField, wanted: InfoField) -> Column:
    """A column of the type of a field that was declared more narrowly."""
    old, new = info_type(had.number, had.type), info_type(wanted.number, wanted.type)
    if isinstance(new, T.ArrayType) and not isinstance(old, T.ArrayType):
        return F.when(F.col(column).isNotNull(), F.array(F.col(column).cast(new.elementType)))
    return F.col(column).cast(new)


def read_converted(spark: SparkSession, out: str) -> DataFrame:
    """What ``convert_pending`` has written so far, with all columns that any input declared.

    Each version is read as it was written and cast to the widest declaration; a column that a version lacks is
    null.  A file that was converted again counts in its newest version.
    """
    stored = _stored_fields(spark, out)
    versions = _fields_by_version(stored)
    fields = merge_info(stored.drop("version"))
    names = info_columns(fields)
    written = _written_partitions(spark, out, VERSION, SOURCE_ID)
    newest = written.groupBy(SOURCE_ID).agg(F.max(VERSION).alias("newest"), F.count("*").alias("n"))
    again = newest.filter("n > 1").select(SOURCE_ID, "newest")
    parts = []
    for version in sorted(r[0] for r in written.select(VERSION).distinct().collect()):
        had = {f.id: f for f in versions.get(version, [])}
        columns = info_columns(had.values())
        schema = variant_schema(list(had.values()))
        for c in (VERSION, SOURCE_COLUMN, SOURCE_ID):
            schema = schema.add(c, "string")
        reader = spark.read.schema(schema).option("basePath", out)
        part = reader.parquet(f"{out.rstrip('/')}/{VERSION}={version}")
        info = [
            (_widened(columns[f.id], had[f.id], f) if f.id in had else F.lit(None).cast(info_type(f.number, f.type))).alias(names[f.id])
            for f in fields
        ]
        parts.append(part.select(*CORE_SCHEMA.names, *info, VERSION, SOURCE_COLUMN, SOURCE_ID))
    if not parts:
        raise FileNotFoundError(f"nothing has been converted to {out}")
    df = reduce(DataFrame.unionByName, parts)
    if len(parts) > 1 and not again.isEmpty():
        df = df.join(again, SOURCE_ID, "left").filter(F.col("newest").isNull() | (F.col("newest") == F.col(VERSION))).drop("newest")
    return df.drop(VERSION)


def split_pending(
    df: DataFrame,
    out: str,
    type_column: str = TYPE_COLUMN,
    explode_snv_alt: bool = True,
    snv_types: Sequence[str] = ("SNV",),
    layout: str = "rebalance",
    overwrite: bool = False,
    raise_on_error: bool = True,
) -> list[str]:
    """Split the sources of ``df`` that lack any of their types in ``out``, in one job.

    ``df`` has a ``source_file`` column, and ``source_id`` where names repeat.  The output is partitioned by type
    and source.  All sources are split again when the columns of ``df`` are not those of the earlier splits.
    Afterwards every type of every source must be there, or this raises.  Returns the sources that were split.
    """
    spark = df.sparkSession
    by = [c for c in (SOURCE_COLUMN, SOURCE_ID) if c in df.columns]
    keyed = df.withColumn(_SOURCE, F.concat_ws("/", *by))
    # A row per source and type, read for what is missing and again for the check.
    stored = scratch_dir(spark, "expected_splits")
    expected_splits(keyed, type_column, _SOURCE).write.parquet(stored)
    expected = spark.read.parquet(stored)
    columns = f"{out.rstrip('/')}/{SPLIT_COLUMNS}"
    shape = df.schema.simpleString()
    if path_exists(spark, columns) and spark.read.text(columns).filter(F.col("value") == shape).isEmpty():
        overwrite = True
    if overwrite:
        todo = expected.select(_SOURCE).distinct()
    else:
        todo = pending_sources(expected, _written_splits(spark, out, type_column, by), type_column, _SOURCE)
    # One name per input file.
    sources = sorted(r[0] for r in todo.collect())
    if sources:
        wanted = spark.createDataFrame([(s,) for s in sources], f"{_SOURCE} string")
        part = keyed.join(F.broadcast(wanted), _SOURCE, "left_semi").drop(_SOURCE)
        rows = split_variants(part, explode_snv_alt, type_column, snv_types)
        write_split(rows, out, [type_column, *by], layout, replace_partitions=True)
        spark.createDataFrame([(shape,)], "value string").coalesce(1).write.mode("overwrite").text(columns)
        if raise_on_error:
            raise_on_errors(split_problems(expected.join(wanted, _SOURCE), out, type_column, by))
    return [s.split("/")[0] for s in sources]


def _written_splits(spark: SparkSession, out: str, type_column: str, by: Sequence[str]) -> DataFrame:
    return _written_partitions(spark, out, type_column, *by).withColumn(_SOURCE, F.concat_ws("/", *by))


def split_problems(expected: DataFrame, out: str, type_column: str, by: Sequence[str]) -> DataFrame:
    """``kind, name, detail`` of the splits that ``expected(_source, type)`` names and ``out`` lacks."""
    def split_path(df: DataFrame) -> Column:
        return F.concat_ws("/", F.lit(out), F.coalesce(F.col(type_column).cast("string"), F.lit("null")), _SOURCE)

    recorded = expected.select(F.concat(F.col(_SOURCE), F.lit(".parquet")).alias("path"), split_path(expected).alias("split_path"))
    written = _written_splits(expected.sparkSession, out, type_column, by)
    inputs = recorded.select("path").distinct()
    return split_completeness(inputs, inputs, recorded, written.select(split_path(written).alias("path")))


def split_existing(
    spark: SparkSession,
    parquet_paths: str | Sequence[str],
    out: str,
    **options,
) -> list[str]:
    """Split Parquet files by variant type; paths that are not Parquet are left out.

    Files and folders of one name are told apart by their paths.  Sources are named once for each file, in a table that
    is joined to the rows.
    """
    paths = [parquet_paths] if isinstance(parquet_paths, str) else list(parquet_paths)
    paths = [p for p in paths if p.rstrip("/").endswith(".parquet")]
    if not paths:
        return []
    df = spark.read.parquet(*paths)
    # A written dataset is a folder, and its name is the name of the source.
    dataset = F.regexp_extract(percent_decoded("_file"), r"^(.*?/[^/]*\.parquet)(?:/|$)", 1)
    files = df.select(F.col("_metadata.file_path").alias("_file")).distinct()
    named = scratch_dir(spark, "split_sources")
    files.select("_file", dataset.alias("_dataset")).write.parquet(named)
    sources = spark.read.schema("_file string, _dataset string").parquet(named)
    sources = sources.select("_file", stem("_dataset").alias(SOURCE_COLUMN), source_id("_dataset").alias(SOURCE_ID))
    # One row per input file.
    df = df.select("*", F.col("_metadata.file_path").alias("_file")).join(F.broadcast(sources), "_file").drop("_file")
    return split_pending(df, out, **options)


def build_reference(
    df: DataFrame, out: str, type_column: str = TYPE_COLUMN, layout: str = "clustered", mode: str = "overwrite"
) -> None:
    """Write a reference dataset, partitioned by type and chromosome and sorted by position.

    Annotation then reads only the partitions it needs and region filters skip row groups.
    """
    write_split(df, out, [type_column, "chrom"], layout, mode)


def build_bucketed_reference(
    df: DataFrame, table: str, buckets: int | None, on: Sequence[str] = KEYS, path: str | None = None
) -> None:
    """Write a reference as a table bucketed and sorted by the join keys.

    Joins of large variant tables on exactly these keys then shuffle only their own side.  The rows are
    gathered by bucket first, so a bucket is one file; the catalog of the session keeps the table.  A task of a join
    takes one bucket: ``buckets=None`` makes as many as keep it at ``ROWS_PER_BUCKET`` rows, and ``LEAST_BUCKETS``.
    """
    if buckets is None:
        # Counted from a stored copy, so that what makes the rows runs once.
        stored = scratch_dir(df.sparkSession, "bucketed_rows")
        df.write.parquet(stored)
        df = df.sparkSession.read.schema(df.schema).parquet(stored)
        buckets = max(LEAST_BUCKETS, -(-df.count() // ROWS_PER_BUCKET))
    writer = (
        df.repartition(buckets, *on).write.mode("overwrite").bucketBy(buckets, *on).sortBy(*on).option("compression", "zstd")
    )
    (writer.option("path", path) if path else writer).saveAsTable(table)


@dataclass(frozen=True)
class Prepared:
    """What ``prepare`` did: where the tables are, which files it handled and what is wrong."""

    variants: str
    splits: str | None
    converted: list[str]
    split: list[str]
    problems: DataFrame


def prepare(
    spark: SparkSession,
    preset: Preset,
    landing_dir: str,
    out: str,
    split: bool = False,
    explode_snv_alt: bool | None = None,
    pattern: str | None = None,
    info_fields: Sequence[str | InfoField] | None = None,
    remote: DataFrame | None = None,
    overwrite: bool = False,
    bgzf: bool | str = "auto",
    layout: str = "rebalance",
    recursive: bool = False,
    raise_on_error: bool = False,
) -> Prepared:
    """Select landed files, convert them, validate, and optionally split by variant type.

    Files already converted or split are skipped, so the job can be repeated as files arrive.  Index
    files are selected and validated but not converted.  ``remote(url, remote_size)`` adds the check
    that every remote file has landed complete.  ``recursive`` takes files of folders below as well.  With
    ``raise_on_error`` errors stop the job before the split; splits are checked too.
    """
    landed = select_files(spark, preset, landing_dir, pattern, recursive)
    root = qualified(spark, landing_dir)
    convertible = is_vcf_file("path") if preset.vcf_suffix else ~is_index_file("path")
    inputs = landed.filter(convertible)
    variants = f"{out.rstrip('/')}/variants"
    converted = convert_pending(spark, inputs, variants, info_fields, overwrite, bgzf, root=root)

    if remote is None:
        remote = spark.createDataFrame([], "url string, remote_size long")
    written = _converted_sources(spark, variants)
    outputs = inputs.select(F.concat_ws("/", source_id("path", root), source_name("path")).alias("path")).distinct()
    problems = reconcile(
        remote,
        landed.select("path", "size"),
        outputs,
        landed.select("path").unionByName(written.select(F.concat_ws("/", SOURCE_ID, SOURCE_COLUMN).alias("path"))),
    )
    if raise_on_error:
        raise_on_errors(problems)

    splits, done = None, []
    if split and not _written_partitions(spark, variants, SOURCE_COLUMN).isEmpty():
        splits = f"{out.rstrip('/')}/splits"
        explode = preset.explode_snv_alt if explode_snv_alt is None else explode_snv_alt
        df = read_converted(spark, variants)
        done = split_pending(
            df, splits, preset.type_column, explode, preset.snv_types, layout, overwrite, raise_on_error=raise_on_error
        )
        keyed = df.withColumn(_SOURCE, F.concat_ws("/", SOURCE_COLUMN, SOURCE_ID))
        expected = expected_splits(keyed, preset.type_column, _SOURCE)
        lost = split_problems(expected, splits, preset.type_column, [SOURCE_COLUMN, SOURCE_ID])
        problems = problems.unionByName(lost.withColumn("severity", F.lit("error")))
    return Prepared(variants, splits, converted, done, problems)


def publish_plan(
    spark: SparkSession, source_dir: str, remote: DataFrame, prefix: str = "data", recursive: bool = True
) -> DataFrame:
    """Compare the Parquet files below a folder with a remote listing ``path_in_repo, size``."""
    files = require_parquet(collect_parquet_files(spark, source_dir, recursive))
    return sync_plan(publish_paths(files, qualified(spark, source_dir), prefix), remote)


def describe_dataset(spark: SparkSession, source_dir: str, type_column: str = TYPE_COLUMN) -> DataFrame:
    """Files, bytes, GB, variant types and rows per type of a dataset on disk.

    Rows are counted from the file footers, by the type in the path: a ``type=value`` folder, or the first folder
    below the root or ``data``.
    """
    root = qualified(spark, source_dir)
    stats = dataset_stats(collect_parquet_files(spark, source_dir), root)
    rows = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(source_dir)
    path = plain_path(percent_decoded("_metadata.file_path"))
    inner = relative_path(path, re.sub("^([A-Za-z][A-Za-z0-9+.-]*):/+", r"\1:/", root))
    folder = F.regexp_extract(inner, rf"^(?:data/)?(?:{type_column}=)?([^/]+)/", 1)
    counted = rows.select(folder.alias("variant_type")).groupBy("variant_type").agg(F.count("*").alias("n"))
    by_type = counted.filter("variant_type <> ''").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("variant_type", "n")))).alias("rows_by_type")
    )
    # Both are one row.
    return stats.join(F.broadcast(by_type), how="cross")
