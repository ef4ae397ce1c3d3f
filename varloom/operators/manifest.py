"""File manifests as tables: what is missing, what differs in size, what must be published.

Names and paths that serve as the right side of a join are reduced to one row each first, so a name
that occurs very often cannot multiply rows or gather them in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import (
    base_name,
    gigabytes,
    human_size,
    is_parquet_file,
    is_vcf_file,
    relative_path,
    signed_bytes,
)

PUBLISH_SCHEMA = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("path_in_repo", T.StringType()),
        T.StructField("uploaded", T.BooleanType()),
        T.StructField("reason", T.StringType()),
        T.StructField("local_size", T.LongType()),
        T.StructField("remote_size", T.LongType()),
    ]
)


def _distinct_names(files: DataFrame) -> DataFrame:
    return files.select(base_name("path").alias("name")).distinct()


def missing_locals(urls: DataFrame, local: DataFrame) -> DataFrame:
    """``url, name`` of the URLs whose base name no local file has.

    ``urls`` has ``url`` and ``local`` has ``path``.
    """
    wanted = urls.select("url", base_name("url").alias("name"))
    return wanted.join(_distinct_names(local), "name", "left_anti").select("url", "name")


def missing_paths(declared: DataFrame, catalog: DataFrame) -> DataFrame:
    """``path`` of the declared files that the catalog does not hold."""
    return declared.select("path").join(catalog.select("path").distinct(), "path", "left_anti")


def last_by_name(local: DataFrame, position: str | Column = "path") -> DataFrame:
    """``name, path, size``, one row per base name: the one that comes last by ``position``."""
    return (
        local.select(base_name("path").alias("name"), F.col("path"), F.col("size"), _col(position).alias("_at"))
        .groupBy("name")
        .agg(F.max_by(F.struct("path", "size"), F.struct("_at", "path")).alias("_last"))
        .select("name", "_last.path", "_last.size")
    )


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def compare_sizes(remote: DataFrame, local: DataFrame, position: str | Column = "path") -> DataFrame:
    """``url, name, local_path, local_size, remote_size`` for every URL with a local file.

    ``remote`` has ``url, remote_size`` and ``local`` has ``path, size``.
    """
    return (
        remote.select("url", base_name("url").alias("name"), "remote_size")
        .join(last_by_name(local, position), "name")
        .select(
            "url", "name", F.col("path").alias("local_path"), F.col("size").alias("local_size"), "remote_size"
        )
    )


def size_mismatches(remote: DataFrame, local: DataFrame, position: str | Column = "path") -> DataFrame:
    """Files whose local size differs from a known remote size, with the difference and a message."""
    different = compare_sizes(remote, local, position).filter(F.col("local_size") != F.col("remote_size"))
    diff = (F.col("local_size") - F.col("remote_size")).alias("diff")
    return different.select("url", "local_path", "local_size", "remote_size", diff, _size_detail().alias("detail"))


def _size_detail() -> Column:
    """What is wrong with a size, of a row of ``compare_sizes``."""
    return F.concat(
        F.col("local_path"),
        F.lit(": local "),
        human_size("local_size"),
        F.lit(" vs remote "),
        human_size("remote_size"),
        F.lit(" ("),
        signed_bytes(F.col("local_size") - F.col("remote_size")),
        F.lit(")"),
    )


def convert_count_check(local: DataFrame, parquet: DataFrame) -> DataFrame:
    """One row: how many VCF files and Parquet outputs there are, and whether outputs are short.

    Having no outputs at all is accepted: then there was nothing to convert.
    """
    vcfs = local.select(F.lit(1).alias("is_vcf"), F.lit(0).alias("is_parquet"), "path").filter(is_vcf_file("path"))
    outputs = parquet.select(F.lit(0).alias("is_vcf"), F.lit(1).alias("is_parquet"), "path")
    counts = vcfs.unionByName(outputs).agg(
        F.coalesce(F.sum("is_vcf"), F.lit(0)).alias("vcfs"),
        F.coalesce(F.sum("is_parquet"), F.lit(0)).alias("parquets"),
    )
    return counts.withColumn("short", (F.col("parquets") > 0) & (F.col("parquets") < F.col("vcfs")))


def reconcile(remote: DataFrame, local: DataFrame, parquet: DataFrame, catalog: DataFrame) -> DataFrame:
    """All problems of a prepared dataset as ``severity, kind, name, detail``.

    ``remote(url, remote_size)`` is what should have been fetched, ``local(path, size)`` the files
    declared as fetched, ``parquet(path)`` the outputs declared as written, and ``catalog(path)`` what
    exists.  Sizes are compared where the remote size is known; the others give a warning.
    """

    def problem(df: DataFrame, severity: str, kind: str, name: Column, detail: Column) -> DataFrame:
        return df.select(
            F.lit(severity).alias("severity"), F.lit(kind).alias("kind"), name.alias("name"), detail.alias("detail")
        )

    path, url = F.col("path"), F.col("url")
    # Sizes are compared once, for both things that can be wrong with them.
    unknown = F.col("remote_size").isNull()
    sizes = compare_sizes(remote, local).filter(unknown | (F.col("local_size") != F.col("remote_size")))
    sizes = sizes.select(
        F.when(unknown, "warning").otherwise("error").alias("severity"),
        F.when(unknown, "remote_size_unknown").otherwise("size_mismatch").alias("kind"),
        F.when(unknown, F.col("name")).otherwise(base_name(url)).alias("name"),
        F.when(unknown, url).otherwise(_size_detail()).alias("detail"),
    )
    short = convert_count_check(local, parquet).filter("short")
    counts = F.format_string("%d Parquet files for %d VCF files", "parquets", "vcfs")
    found = [
        problem(missing_paths(local, catalog), "error", "missing_local", base_name(path), path),
        problem(missing_locals(remote, local), "error", "no_local_for_url", F.col("name"), url),
        problem(missing_paths(parquet, catalog), "error", "missing_parquet", base_name(path), path),
        sizes,
        problem(short, "warning", "fewer_parquets_than_vcfs", F.lit("dataset"), counts),
    ]
    return reduce(DataFrame.unionByName, found)


def raise_on_errors(problems: DataFrame, shown: int = 20) -> None:
    """Raise ValueError when there are errors, with their number and the first ones spelled out."""
    errors = problems.filter("severity = 'error'") if "severity" in problems.columns else problems
    n = errors.count()
    if n:
        lines = [f"{r['kind']}: {r['detail']}" for r in errors.orderBy("kind", "name").limit(shown).collect()]
        raise ValueError(f"{n} problems in the dataset:\n" + "\n".join(lines))


def require_parquet(files: DataFrame) -> DataFrame:
    """The same files; raises when some are not Parquet, showing three of them."""
    others = files.filter(~is_parquet_file("path"))
    n = others.count()
    if n:
        names = [r[0] for r in others.select(base_name("path")).limit(3).collect()]
        raise ValueError(f"only .parquet files can be published; found {n} others, such as {names}")
    return files


def publish_paths(files: DataFrame, source_dir: str | None = None, prefix: str = "data") -> DataFrame:
    """Add ``path_in_repo``: the path below ``source_dir``, or the base name, under a prefix."""
    inner = base_name("path") if source_dir is None else relative_path("path", source_dir)
    return files.withColumn("path_in_repo", F.concat(F.lit(prefix + "/"), inner))


def sync_plan(local: DataFrame, remote: DataFrame) -> DataFrame:
    """Which local files must be published.

    ``local`` has ``path, path_in_repo, size`` and ``remote`` has ``path_in_repo, size``.  A file is
    skipped when the remote one has the same size.  Files that exist only remotely are left alone.
    """
    theirs = remote.groupBy("path_in_repo").agg(F.max("size").alias("remote_size"))
    reason = (
        F.when(F.col("remote_size").isNull(), "new_file")
        .when(F.col("remote_size") == F.col("size"), "size_match")
        .otherwise("size_differs")
    )
    return local.join(theirs, "path_in_repo", "left").select(
        F.col("path").alias("file"),
        "path_in_repo",
        (reason != "size_match").alias("uploaded"),
        reason.alias("reason"),
        F.col("size").alias("local_size"),
        "remote_size",
    )


def sync_summary(plan: DataFrame) -> DataFrame:
    return plan.agg(
        F.count("*").alias("total_files"),
        F.count_if("uploaded").alias("num_uploaded"),
        F.count_if(~F.col("uploaded")).alias("num_skipped"),
    )


def sync_reasons(plan: DataFrame) -> DataFrame:
    return plan.groupBy("reason").agg(
        F.count("*").alias("n_files"), F.coalesce(F.sum("local_size"), F.lit(0)).alias("total_bytes")
    )


def _type_folder(root: str) -> Column:
    """The folder directly below the root, null for files in the root; ``tsa=SNV`` counts as ``SNV``."""
    rel = relative_path("path", root)
    folder = F.regexp_replace(F.substring_index(rel, "/", 1), "^[^=]+=", "")
    return F.when(rel.contains("/"), folder)


def variant_types_present(catalog: DataFrame, root: str) -> DataFrame:
    """``variant_type``: the folders directly below the root that hold files."""
    return catalog.select(_type_folder(root).alias("variant_type")).filter("variant_type IS NOT NULL").distinct()


def dataset_stats(catalog: DataFrame, root: str) -> DataFrame:
    """One row: number of files, bytes, GB and the sorted variant types of a dataset."""
    per_type = catalog.groupBy(_type_folder(root).alias("_type")).agg(F.count("*").alias("_n"), F.sum("size").alias("_b"))
    total = F.coalesce(F.sum("_b"), F.lit(0))
    return per_type.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("num_files"),
        total.alias("total_bytes"),
        gigabytes(total).alias("total_gb"),
        F.array_sort(F.collect_set("_type")).alias("variant_types"),
    )
