"""Variant tables, VCF text and file manifests derived from the given star-schema tables.

Both Spark and the SQL that checks it use integer arithmetic and ``substr`` only, so they derive the same
rows.  Every derivation runs over its whole input table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import KEYS, InfoField

#: INFO fields of the derived VCF text.
VCF_INFO = (InfoField("TSA"), InfoField("OK", "1", "Integer"), InfoField("LN", "1", "Integer"), InfoField("F", "0", "Flag"))


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _pick(letters: str, key: Column) -> Column:
    return F.substring(F.lit(letters), (key % 4).cast("int") + 1, F.lit(1))


def _chrom(key: Column) -> Column:
    return F.when(key % 24 == 22, "X").when(key % 24 == 23, "Y").otherwise((key % 24 + 1).cast("string"))


def variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One variant per line item."""
    part, line, flag = F.col("l_partkey"), F.col("l_linenumber"), F.col("l_returnflag")
    second = F.when(line == 1, F.concat(F.lit("|"), _pick("GTAC", part))).otherwise("")
    return load(spark, sf_dir, "lineitem").select(
        _chrom(F.col("l_suppkey")).alias("chrom"),
        (part * 10 + line).alias("start"),
        _pick("ACGT", part).alias("ref"),
        F.concat(_pick("CGTA", part), second).alias("alt"),
        F.when(flag == "A", "SNV").when(flag == "N", "deletion").otherwise("insertion").alias("tsa"),
        F.col("l_quantity").alias("qual"),
        "l_orderkey",
        "l_linenumber",
        "l_linestatus",
    )


VARIANTS_SQL = """
  SELECT CASE WHEN l_suppkey % 24 = 22 THEN 'X' WHEN l_suppkey % 24 = 23 THEN 'Y'
              ELSE CAST(l_suppkey % 24 + 1 AS varchar) END AS chrom,
         l_partkey * 10 + l_linenumber AS start,
         substr('ACGT', CAST(l_partkey % 4 AS int) + 1, 1) AS ref,
         substr('CGTA', CAST(l_partkey % 4 AS int) + 1, 1)
           || CASE WHEN l_linenumber = 1
                   THEN '|' || substr('GTAC', CAST(l_partkey % 4 AS int) + 1, 1) ELSE '' END AS alt,
         CASE WHEN l_returnflag = 'A' THEN 'SNV' WHEN l_returnflag = 'N' THEN 'deletion'
              ELSE 'insertion' END AS tsa,
         l_quantity AS qual, l_orderkey, l_linenumber, l_linestatus
  FROM lineitem
"""


def order_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One variant per order: a second set of files with the same columns."""
    key = F.col("o_custkey")
    return load(spark, sf_dir, "orders").select(
        _chrom(key).alias("chrom"),
        (F.col("o_orderkey") * 10).alias("start"),
        _pick("ACGT", key).alias("ref"),
        _pick("CGTA", key).alias("alt"),
        F.when(F.col("o_orderstatus") == "P", "SNV").otherwise("indel").alias("tsa"),
        F.col("o_totalprice").alias("qual"),
    )


ORDER_VARIANTS_SQL = """
  SELECT CASE WHEN o_custkey % 24 = 22 THEN 'X' WHEN o_custkey % 24 = 23 THEN 'Y'
              ELSE CAST(o_custkey % 24 + 1 AS varchar) END AS chrom,
         o_orderkey * 10 AS start,
         substr('ACGT', CAST(o_custkey % 4 AS int) + 1, 1) AS ref,
         substr('CGTA', CAST(o_custkey % 4 AS int) + 1, 1) AS alt,
         CASE WHEN o_orderstatus = 'P' THEN 'SNV' ELSE 'indel' END AS tsa,
         o_totalprice AS qual
  FROM orders
"""


def reference_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference observations: the finished line items, several per key."""
    return variants(spark, sf_dir).filter("l_linestatus = 'F'").select(*KEYS, "tsa", "qual")


def reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference variants, one row per key."""
    rows = reference_rows(spark, sf_dir)
    return rows.groupBy(*KEYS).agg(F.min("qual").alias("qual"), F.count("*").alias("n_obs"))


REFERENCE_ROWS_SQL = "SELECT chrom, start, ref, alt, tsa, qual FROM v WHERE l_linestatus = 'F'"
REFERENCE_SQL = """
  SELECT chrom, start, ref, alt, min(qual) AS qual, count(*) AS n_obs
  FROM v WHERE l_linestatus = 'F' GROUP BY chrom, start, ref, alt
"""

#: ``v``, ``r`` and ``d``: variants, reference and reference observations.
WITH_SQL = f"WITH v AS ({VARIANTS_SQL}), r AS ({REFERENCE_SQL}), d AS ({REFERENCE_ROWS_SQL}) "


def hot_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variants of which a third, the SNVs, share one key."""
    df = variants(spark, sf_dir)
    snv = F.col("tsa") == "SNV"
    fixed = {"chrom": F.lit("1"), "start": F.lit(1).cast("bigint"), "ref": F.lit("A"), "alt": F.lit("C")}
    return df.withColumns({c: F.when(snv, v).otherwise(F.col(c)) for c, v in fixed.items()})


HOT_SQL = """
  SELECT CASE WHEN tsa = 'SNV' THEN '1' ELSE chrom END AS chrom,
         CASE WHEN tsa = 'SNV' THEN CAST(1 AS bigint) ELSE start END AS start,
         CASE WHEN tsa = 'SNV' THEN 'A' ELSE ref END AS ref,
         CASE WHEN tsa = 'SNV' THEN 'C' ELSE alt END AS alt,
         tsa, qual, l_orderkey, l_linenumber, l_linestatus
  FROM v
"""


def vcf_text(df: DataFrame, more: list[str] = []) -> DataFrame:
    """VCF lines of derived variants, with the remaining columns in INFO, and ``more`` under their upper-case names."""
    info = F.concat(
        F.lit("TSA="),
        F.col("tsa"),
        F.lit(";OK="),
        F.col("l_orderkey").cast("string"),
        F.lit(";LN="),
        F.col("l_linenumber").cast("string"),
        F.when(F.col("l_linestatus") == "F", ";F").otherwise(""),
        *[F.concat(F.lit(f";{c.upper()}="), F.col(c).cast("string")) for c in more],
    )
    return df.select(
        F.concat_ws(
            "\t",
            "chrom",
            F.col("start").cast("string"),
            F.lit("."),
            "ref",
            F.translate("alt", "|", ","),
            F.col("qual").cast("string"),
            F.lit("PASS"),
            info,
            F.lit("GT"),
            F.lit("0/1"),
        ).alias("value")
    )


#: What parsing the derived VCF text gives.
PARSED_SQL = """
  SELECT chrom, start, start + length(ref) - 1 AS "end", CAST(NULL AS varchar) AS id, ref, alt,
         CAST(qual AS double) AS qual, 'PASS' AS filter, tsa, l_orderkey AS ok,
         CAST(l_linenumber AS bigint) AS ln, l_linestatus = 'F' AS f
  FROM v
"""


def part_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file manifest with one file per part, of several kinds and in several folders."""
    kind = F.col("p_type")
    suffix = (
        F.when(kind == "STANDARD", ".vcf")
        .when(kind == "MEDIUM", ".vcf.gz")
        .when(kind == "LARGE", ".vcf.bgz")
        .when(kind == "ECONOMY", ".vcf.gz.tbi")
        .when(kind == "PROMO", ".parquet")
        .otherwise(".txt")
    )
    key = F.col("p_partkey").cast("string")
    folder = F.when(F.col("p_size") <= 10, "").when(F.col("p_size") <= 30, "SNV/").otherwise("deletion/")
    name = F.concat(F.lit("homo_sapiens-chr"), key, suffix)
    return load(spark, sf_dir, "part").select(
        "p_partkey",
        "p_name",
        "p_type",
        name.alias("name"),
        F.concat(F.lit("/landing/"), folder, name).alias("path"),
        (F.col("p_partkey") * 1037 + F.col("p_size") * F.col("p_size") * 40_000).alias("size"),
        "p_brand",
        "p_size",
    )


PART_FILES_SQL = """
  SELECT p_partkey, p_name, p_type, name, '/landing/' || folder || name AS path,
         p_partkey * 1037 + p_size * p_size * 40000 AS size, p_brand, p_size
  FROM (SELECT *, 'homo_sapiens-chr' || CAST(p_partkey AS varchar)
                  || CASE p_type WHEN 'STANDARD' THEN '.vcf' WHEN 'MEDIUM' THEN '.vcf.gz'
                       WHEN 'LARGE' THEN '.vcf.bgz' WHEN 'ECONOMY' THEN '.vcf.gz.tbi'
                       WHEN 'PROMO' THEN '.parquet' ELSE '.txt' END AS name,
               CASE WHEN p_size <= 10 THEN '' WHEN p_size <= 30 THEN 'SNV/'
                    ELSE 'deletion/' END AS folder
        FROM part)
"""

#: ``m``: the file manifest.
FILES_SQL = f"WITH m AS ({PART_FILES_SQL}) "


def remote_files(files: DataFrame) -> DataFrame:
    """The remote side of the manifest: one brand is absent and another differs in size."""
    return files.filter("p_brand <> 'Brand#7'").select(
        F.concat(F.lit("https://host.example"), "path").alias("url"),
        "path",
        "name",
        F.when(F.col("p_brand") == "Brand#5", F.col("size") + F.col("p_size") - 25).otherwise(F.col("size")).alias("size"),
    )


REMOTE_SQL = """
  SELECT 'https://host.example' || path AS url, path, name,
         CASE WHEN p_brand = 'Brand#5' THEN size + p_size - 25 ELSE size END AS size
  FROM m WHERE p_brand <> 'Brand#7'
"""


def with_header(lines: DataFrame, *header: str) -> DataFrame:
    """The lines, with header lines ahead of those of each partition, and so of each file that is written."""

    def prepend(batches):
        import pyarrow as pa

        ahead = [pa.array(header, pa.string())]
        for batch in batches:
            for column in (*ahead, batch.column("value")):
                yield pa.RecordBatch.from_arrays([column], names=["value"])
            ahead = []

    return lines.select("value").mapInArrow(prepend, "value string")


def info_line(field: InfoField) -> str:
    return f'##INFO=<ID={field.id},Number={field.number},Type={field.type},Description="{field.id}">'
