"""Queries over the given tables, one per operator, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as fn
from .. import operators as op
from ..schema import ALT_SEPARATOR, KEYS, InfoField
from ..sources import (
    chromosome_list,
    chromosomes,
    ensembl,
    file_catalog,
    header_info,
    match_reference_files,
    open_reference,
    parse_lines,
    range_table,
    read_snapshot,
    read_vcf_regions,
    scratch_dir,
    select_info,
    type_info,
    vcf_to_parquet,
    within_range_table,
    write_indexed_vcf,
    write_snapshot,
)
from ..sources.ranges import BIN
from ..sources.storage import qualified, rename_files
from ..streaming import annotate_stream, ingest, stream_vcf
from . import jobs
from . import tables as t
from .statistics import merged_statistics, refresh_statistics

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with its check."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def finish(stream) -> None:
    """Wait for a stream that ends by itself when it has taken everything."""
    stream.awaitTermination()


KEY_LIST = ", ".join(KEYS)
USING = f"USING ({KEY_LIST})"

# --- annotation -----------------------------------------------------------------------------------

LEFT_ROWS_SQL = f"""
SELECT {KEY_LIST}, v.tsa, v.qual, l_orderkey, l_linenumber, l_linestatus, r.qual AS qual_ensembl, coalesce(n_obs, 0) AS n_obs
FROM v LEFT JOIN r {USING}"""

BY_TYPE_SQL = f"""
SELECT chrom, tsa, count(*) AS n_variants, count(n_obs) AS n_known,
       CAST(coalesce(sum(n_obs), 0) AS bigint) AS n_observations
FROM v LEFT JOIN r {USING} GROUP BY chrom, tsa"""


def counted(df: DataFrame) -> DataFrame:
    """No observations where the reference has none; the other reference columns stay null."""
    return df.withColumn("n_obs", F.coalesce("n_obs", F.lit(0)))


def by_type(df: DataFrame) -> DataFrame:
    return df.groupBy("chrom", "tsa").agg(
        F.count("*").alias("n_variants"),
        F.count("n_obs").alias("n_known"),
        F.coalesce(F.sum("n_obs"), F.lit(0)).alias("n_observations"),
    )


@query(t.WITH_SQL + BY_TYPE_SQL)
def annotate_left_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many variants of each type on each chromosome are known to the reference."""
    v, r = t.variants(spark, sf_dir), t.reference(spark, sf_dir)
    return by_type(op.annotate(v, r, strategy="direct", unique_reference=True))


@query(t.WITH_SQL + LEFT_ROWS_SQL)
def annotate_left_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counted(op.annotate(t.variants(spark, sf_dir), t.reference(spark, sf_dir), unique_reference=True))


@query(t.WITH_SQL + LEFT_ROWS_SQL)
def annotate_semi_strategy(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, r = t.variants(spark, sf_dir), t.reference(spark, sf_dir)
    return counted(op.annotate(v, r, strategy="semi", unique_reference=True, semi_max_rows=None))


@query(t.WITH_SQL + LEFT_ROWS_SQL)
def annotate_direct_strategy(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, r = t.variants(spark, sf_dir), t.reference(spark, sf_dir)
    return counted(op.annotate(v, r, strategy="direct", unique_reference=True))


@query(
    t.WITH_SQL
    + f"""
SELECT {KEY_LIST}, v.tsa, v.qual, l_orderkey, l_linenumber, l_linestatus, r.qual AS qual_ensembl, n_obs
FROM v JOIN r {USING} WHERE chrom = '1'"""
)
def annotate_inner_chr1(spark: SparkSession, sf_dir: str) -> DataFrame:
    on_1 = op.on_chroms(t.variants(spark, sf_dir), ["1"])
    return op.annotate(on_1, t.reference(spark, sf_dir), how="inner", strategy="direct", unique_reference=True)


@query(
    t.WITH_SQL
    + """
SELECT v.chrom, v.start, v.ref, v.alt, v.tsa, v.qual, l_orderkey, l_linenumber, l_linestatus,
       r.ref AS ref_ensembl, r.alt AS alt_ensembl, r.qual AS qual_ensembl, coalesce(n_obs, 0) AS n_obs
FROM v LEFT JOIN r ON v.chrom = r.chrom AND v.start = r.start"""
)
def annotate_custom_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counted(op.annotate(t.variants(spark, sf_dir), t.reference(spark, sf_dir), on=["chrom", "start"], strategy="direct"))


@query(
    t.WITH_SQL
    + f"""
SELECT v.tsa, count(*) AS n_rows, count(d.tsa) AS n_matches, min(d.qual) AS min_qual, max(d.qual) AS max_qual
FROM v LEFT JOIN d {USING} GROUP BY v.tsa"""
)
def annotate_dup_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key that repeats in the reference repeats the input row."""
    joined = op.annotate(t.variants(spark, sf_dir), t.reference_rows(spark, sf_dir), strategy="direct")
    return joined.groupBy("tsa").agg(
        F.count("*").alias("n_rows"),
        F.count("tsa_ensembl").alias("n_matches"),
        F.min("qual_ensembl").alias("min_qual"),
        F.max("qual_ensembl").alias("max_qual"),
    )


@query(
    t.WITH_SQL
    + """
, vn AS (SELECT chrom, start, nullif(ref, 'A') AS ref, alt, tsa FROM v),
rn AS (SELECT chrom, start, nullif(ref, 'A') AS ref, alt, n_obs FROM r)
SELECT vn.ref AS ref, vn.tsa AS tsa, count(*) AS n_rows, count(n_obs) AS n_known
FROM vn LEFT JOIN rn USING (chrom, start, ref, alt) GROUP BY vn.ref, vn.tsa"""
)
def annotate_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null keys match nothing, on either side; their rows are spread over several tasks."""
    null_a = F.nullif(F.col("ref"), F.lit("A"))
    left = t.variants(spark, sf_dir).withColumn("ref", null_a)
    right = t.reference(spark, sf_dir).withColumn("ref", null_a)
    known = op.annotate(left, right, strategy="direct", rows_per_slice=5_000)
    return known.groupBy("ref", "tsa").agg(F.count("*").alias("n_rows"), F.count("n_obs").alias("n_known"))


@query(t.WITH_SQL + "SELECT * FROM v")
def annotate_empty_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No reference data for the chromosomes: the input comes back with its own columns."""
    out = scratch_dir(spark, "annotate_empty_reference")
    t.reference_rows(spark, sf_dir).write.parquet(f"{out}/SNV/homo_sapiens-chrMT.parquet")
    v = t.variants(spark, sf_dir)
    return op.annotate(v, open_reference(spark, out, "SNV", chromosome_list(v)))


@query(
    t.WITH_SQL
    + f"""
, h AS ({t.HOT_SQL})
SELECT h.tsa, count(*) AS n_rows, count(n_obs) AS n_known,
       CAST(coalesce(sum(n_obs), 0) AS bigint) AS n_observations,
       count(DISTINCT l_orderkey) AS n_orders
FROM h LEFT JOIN (SELECT {KEY_LIST}, count(*) AS n_obs FROM h GROUP BY {KEY_LIST}) {USING} GROUP BY h.tsa"""
)
def annotate_hot_input_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the input shares one key; its rows are dealt over several slices."""
    hot = t.hot_variants(spark, sf_dir)
    ref = hot.groupBy(*KEYS).agg(F.count("*").alias("n_obs"))
    known = op.annotate(hot, ref, unique_reference=True, strategy="direct", rows_per_slice=1_000)
    return known.groupBy("tsa").agg(
        F.count("*").alias("n_rows"),
        F.count("n_obs").alias("n_known"),
        F.coalesce(F.sum("n_obs"), F.lit(0)).alias("n_observations"),
        F.count_distinct("l_orderkey").alias("n_orders"),
    )


@query(
    t.WITH_SQL
    + f"""
, h AS ({t.HOT_SQL}), k AS (SELECT DISTINCT {KEY_LIST} FROM h UNION SELECT DISTINCT {KEY_LIST} FROM v)
SELECT chrom, count(*) AS n_rows, count(l_orderkey) AS n_matches, min(qual) AS min_qual,
       max(l_orderkey) AS max_order
FROM k LEFT JOIN h {USING} GROUP BY chrom"""
)
def annotate_hot_reference_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the reference shares one key; unmatched input rows still occur exactly once."""
    hot = t.hot_variants(spark, sf_dir)
    # Written, because the input is read several times and would be made unique again each time.
    out = scratch_dir(spark, "annotate_hot_reference_key")
    hot.select(*KEYS).union(t.variants(spark, sf_dir).select(*KEYS)).distinct().write.parquet(out)
    keys = spark.read.parquet(out)
    known = op.annotate(keys, hot, strategy="direct", rows_per_slice=1_000)
    return known.groupBy("chrom").agg(
        F.count("*").alias("n_rows"),
        F.count("l_orderkey").alias("n_matches"),
        F.min("qual").alias("min_qual"),
        F.max("l_orderkey").alias("max_order"),
    )


@query(
    t.WITH_SQL
    + f"""
SELECT {KEY_LIST}, v.tsa, v.qual, l_orderkey, l_linenumber, l_linestatus, r.qual AS qual_ensembl, n_obs
FROM v LEFT JOIN r {USING} WHERE n_obs IS NOT NULL"""
)
def annotated_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = op.annotate(t.variants(spark, sf_dir), t.reference(spark, sf_dir), strategy="direct", unique_reference=True)
    return op.annotated_only(known, "n_obs")


CLINICAL = "CASE WHEN {0} >= 40 THEN 'Pathogenic' WHEN {0} >= 30 THEN 'Likely_pathogenic' WHEN {0} >= 20 THEN 'Pathogenic/Likely_pathogenic' WHEN {0} >= 10 THEN 'Benign' END"


def clinical_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.reference(spark, sf_dir).select(*KEYS, F.expr(CLINICAL.format("qual")).alias("clnsig"))


@query(
    t.WITH_SQL
    + f"""
, c AS (SELECT {KEY_LIST}, {CLINICAL.format("qual")} AS clnsig FROM r)
SELECT {KEY_LIST}, tsa, qual, l_orderkey, l_linenumber, l_linestatus, clnsig
FROM v LEFT JOIN c {USING} WHERE clnsig LIKE '%Pathogenic%'"""
)
def annotate_then_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Case matters: ``Likely_pathogenic`` alone does not contain ``Pathogenic``."""
    known = op.annotate(t.variants(spark, sf_dir), clinical_reference(spark, sf_dir), strategy="direct", unique_reference=True)
    return op.containing(known, "clnsig", "Pathogenic")


@query(
    t.WITH_SQL
    + f"""
, c AS (SELECT {KEY_LIST}, {CLINICAL.format("qual")} AS clnsig FROM r)
SELECT clnsig, tsa, count(*) AS n FROM v LEFT JOIN c {USING}
WHERE regexp_matches(clnsig, '^(Likely_)?[Pp]athogenic$') GROUP BY clnsig, tsa"""
)
def annotate_then_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = op.annotate(t.variants(spark, sf_dir), clinical_reference(spark, sf_dir), strategy="direct", unique_reference=True)
    return op.matching(known, "clnsig", "^(Likely_)?[Pp]athogenic$").groupBy("clnsig", "tsa").agg(F.count("*").alias("n"))


@query(
    t.WITH_SQL
    + f"""
, m AS (SELECT {KEY_LIST}, count(*) AS m FROM d GROUP BY {KEY_LIST})
SELECT chrom, count(*) AS total, count(m) AS matched, CAST(coalesce(sum(m), 0) AS bigint) AS joined,
       round(CAST(count(m) AS double) * 100 / count(*), 2) AS match_rate,
       round(CAST(coalesce(sum(m), 0) AS double) * 100 / count(*), 2) AS joined_rate
FROM v LEFT JOIN m {USING} GROUP BY chrom"""
)
def match_rate_by_chrom(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.match_rate(t.variants(spark, sf_dir), t.reference_rows(spark, sf_dir), by=["chrom"])


@query(
    t.WITH_SQL
    + f"""
, x AS (SELECT chrom, start, ref, unnest(string_split(alt, '|')) AS alt, tsa FROM v)
SELECT x.tsa, count(*) AS n_rows, count(n_obs) AS n_known FROM x
LEFT JOIN (SELECT {KEY_LIST}, count(*) AS n_obs FROM
           (SELECT chrom, start, ref, unnest(string_split(alt, '|')) AS alt FROM d) GROUP BY {KEY_LIST}) {USING}
GROUP BY x.tsa"""
)
def annotate_exploded_alts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Options that normalise the input: alternates exploded and a ``chr`` prefix removed."""
    prefixed = t.variants(spark, sf_dir).withColumn("chrom", F.concat(F.lit("chr"), "chrom"))
    alleles = op.explode_alt(t.reference_rows(spark, sf_dir), types=None)
    ref = alleles.groupBy(*KEYS).agg(F.count("*").alias("n_obs"))
    known = op.annotate(prefixed, ref, strip_chr_prefix=True, explode_alt=True, strategy="direct", unique_reference=True)
    return known.groupBy("tsa").agg(F.count("*").alias("n_rows"), F.count("n_obs").alias("n_known"))


@query(
    t.WITH_SQL
    + f"""
, n AS (SELECT 'ctg' || (start // 10) AS chrom, start, ref, alt, tsa, l_linestatus FROM v),
m AS (SELECT {KEY_LIST}, count(*) AS n_obs FROM n WHERE l_linestatus = 'F' AND start % 3 = 0 GROUP BY {KEY_LIST})
SELECT tsa, count(*) AS n_rows, count(n_obs) AS n_known FROM n LEFT JOIN m {USING} GROUP BY tsa"""
)
def annotate_many_chromosomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One chromosome name per part: as many contigs as the table has parts, none left out of pruning."""
    out = scratch_dir(spark, "annotate_many_chromosomes")
    name = F.concat(F.lit("ctg"), F.floor(F.col("start") / 10).cast("string"))
    v = t.variants(spark, sf_dir).withColumn("chrom", name)
    t.vcf_text(v).write.text(f"{out}/sample.vcf")
    known = v.filter("l_linestatus = 'F' AND start % 3 = 0").groupBy(*KEYS).agg(F.count("*").alias("n_obs"))
    known.write.parquet(f"{out}/reference")
    df = jobs.annotate_vcf(
        spark, f"{out}/sample.vcf", f"{out}/reference", None, info_fields=t.VCF_INFO, unique_reference=True
    )
    return df.groupBy("tsa").agg(F.count("*").alias("n_rows"), F.count("n_obs").alias("n_known"))


@query(t.WITH_SQL + LEFT_ROWS_SQL)
def annotate_bucketed_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reference stored by buckets of the keys: the join shuffles the left table only."""
    out = scratch_dir(spark, "bucketed_reference")
    name = "varloom_" + out.rsplit("-", 1)[1]
    jobs.build_bucketed_reference(t.reference(spark, sf_dir), name, None, path=out)
    known = spark.table(name)
    return counted(op.annotate(t.variants(spark, sf_dir), known, strategy="direct", unique_reference=True))


@query(
    t.WITH_SQL
    + """
, n AS (SELECT start // 10 AS part, qual, l_linestatus FROM v)
SELECT a.part, count(*) AS n_rows, CAST(sum(a.qual * b.qual) AS bigint) AS total
FROM n a JOIN (SELECT part, qual FROM n WHERE l_linestatus = 'F') b ON a.part = b.part GROUP BY a.part"""
)
def annotate_many_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearly every key is heavy, on both sides: each is found and spread."""
    v = t.variants(spark, sf_dir).select(F.floor(F.col("start") / 10).alias("part"), "qual", "l_linestatus")
    other = v.filter("l_linestatus = 'F'").select("part", "qual")
    joined = op.annotate(v, other, on=["part"], how="inner", strategy="direct", rows_per_slice=8)
    return joined.groupBy("part").agg(
        F.count("*").alias("n_rows"), F.sum(F.col("qual") * F.col("qual_ensembl")).cast("bigint").alias("total")
    )


REGION_SAMPLE = "chrom IN ('2', 'X') AND start % 4000 < 300"


@query(
    t.WITH_SQL
    + f"""
, s AS (SELECT * FROM v WHERE {REGION_SAMPLE}),
m AS (SELECT {KEY_LIST}, count(*) AS n_obs FROM v WHERE l_linestatus = 'F' GROUP BY {KEY_LIST})
SELECT s.l_orderkey AS ok, s.l_linenumber AS ln, {KEY_LIST}, n_obs FROM s LEFT JOIN m {USING}"""
)
def annotate_in_touched_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A panel of stretches against a reference sorted by position: footers tell which files hold them."""
    out = scratch_dir(spark, "annotate_in_touched_files")
    v = t.variants(spark, sf_dir)
    t.vcf_text(v.filter(REGION_SAMPLE)).write.text(f"{out}/sample.vcf")
    known = v.filter("l_linestatus = 'F'").groupBy(*KEYS).agg(F.count("*").alias("n_obs"))
    known.repartitionByRange(64, "chrom", "start").sortWithinPartitions("chrom", "start").write.parquet(f"{out}/reference")
    df = jobs.annotate_vcf(
        spark, f"{out}/sample.vcf", f"{out}/reference", None, info_fields=t.VCF_INFO, choose_files=True, unique_reference=True
    )
    return df.select("ok", "ln", *KEYS, "n_obs").withColumns({"ok": F.col("ok").cast("long")})


@query(
    t.WITH_SQL
    + f"""
, s AS (SELECT DISTINCT chrom, start FROM v WHERE {REGION_SAMPLE})
SELECT chrom, count(*) AS n_rows, min(start) AS lo, max(start) AS hi
FROM (SELECT {KEY_LIST} FROM v WHERE l_linestatus = 'F') r
WHERE EXISTS (SELECT 1 FROM s WHERE s.chrom = r.chrom AND s.start // {BIN} = r.start // {BIN}
  GROUP BY s.start // {BIN} HAVING r.start BETWEEN min(s.start) AND max(s.start))
GROUP BY chrom"""
)
def reference_within_stretches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference rows in the stretches between the first and last variant of each bin."""
    out = scratch_dir(spark, "stretches")
    range_table(t.variants(spark, sf_dir).filter(REGION_SAMPLE)).write.parquet(out)
    found = within_range_table(t.reference_rows(spark, sf_dir), spark.read.parquet(out))
    return found.groupBy("chrom").agg(F.count("*").alias("n_rows"), F.min("start").alias("lo"), F.max("start").alias("hi"))


COHORT_SQL = f"""
, c AS (SELECT * FROM v WHERE l_orderkey % 3 = 0)
SELECT {KEY_LIST}, c.tsa, c.qual, l_orderkey, l_linenumber, l_linestatus, r.qual AS qual_ensembl, n_obs
FROM c LEFT JOIN r {USING}"""


def cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.variants(spark, sf_dir).filter("l_orderkey % 3 = 0")


@query(t.WITH_SQL + COHORT_SQL)
def annotate_cohort_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More left rows than hashes may be broadcast for: a Bloom filter reduces the reference where it is read."""
    out = scratch_dir(spark, "annotate_cohort_bloom")
    t.reference(spark, sf_dir).write.parquet(out)
    return op.annotate(cohort(spark, sf_dir), spark.read.parquet(out), semi_max_rows=100, semi_min_ratio=0)


@query(t.WITH_SQL + COHORT_SQL)
def annotate_merged_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filters of the parts of a cohort, stored one by one and merged, reduce the reference for the whole."""
    out = scratch_dir(spark, "annotate_merged_bitmaps")
    c = cohort(spark, sf_dir)
    segments = op.filter_segments(c.count())
    for i in range(3):
        op.key_bitmaps(c.filter(F.col("l_linenumber") % 3 == i), KEYS, segments).write.mode("append").parquet(out)
    bitmaps = op.merge_bitmaps(spark.read.parquet(out))
    found = op.filter_by_bitmaps(t.reference(spark, sf_dir), KEYS, bitmaps, segments)
    return op.annotate(c, found, strategy="direct", unique_reference=True)


@query(
    t.WITH_SQL
    + """
, n AS (SELECT chrom, ref, tsa FROM v)
SELECT chrom, ref, tsa, CAST(ceil(count(*) / 40.0) AS int) AS left_slices, 1 AS right_slices
FROM n GROUP BY chrom, ref, tsa HAVING count(*) > 40"""
)
def heavy_keys_by_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys above a limit, found by a count-min sketch and counted exactly."""
    v, on = t.variants(spark, sf_dir).select("chrom", "ref", "tsa"), ["chrom", "ref", "tsa"]
    found = op.heavy_keys(v, v, on, op.profile_keys(v, on, 40), None, 40)
    return v.limit(0).selectExpr(*on, "0 AS left_slices", "1 AS right_slices") if found is None else found


@query(t.WITH_SQL + "SELECT * FROM v")
def annotate_empty_partitioned_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same answer on the package's own layout: no folder has one of the chromosomes."""
    out = scratch_dir(spark, "annotate_empty_partitioned")
    jobs.build_reference(t.reference_rows(spark, sf_dir).withColumn("chrom", F.lit("MT")), out, layout="rebalance")
    v = t.variants(spark, sf_dir)
    return op.annotate(v, open_reference(spark, out, "SNV", chromosome_list(v)))


@query(
    t.WITH_SQL
    + "SELECT tsa, count(*) AS n_rows, max(qual) AS max_qual FROM d WHERE chrom IN ('1', 'X') GROUP BY tsa"
)
def reference_of_all_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders per type opened together, without choosing one."""
    out = scratch_dir(spark, "reference_of_all_types")
    rows = t.reference_rows(spark, sf_dir)
    for kind in ("SNV", "deletion", "insertion"):
        rows.filter(F.col("tsa") == kind).write.parquet(f"{out}/{kind}/all.parquet")
    both = open_reference(spark, out, None, ["1", "X"])
    return both.groupBy("tsa").agg(F.count("*").alias("n_rows"), F.max("qual").alias("max_qual"))


@query(
    t.WITH_SQL
    + f"""
, c AS (SELECT {KEY_LIST}, {CLINICAL.format("qual")} AS clnsig FROM r)
SELECT v.tsa, clnsig, count(*) AS n_rows FROM v JOIN c {USING} WHERE clnsig LIKE '%Pathogenic%' GROUP BY v.tsa, clnsig"""
)
def annotate_clinical_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VCF text against a clinical dataset with its files below ``data/``."""
    out = scratch_dir(spark, "annotate_clinical_job")
    t.vcf_text(t.variants(spark, sf_dir)).write.text(f"{out}/sample.vcf")
    clinical_reference(spark, sf_dir).write.parquet(f"{out}/clinvar/data/clinvar.parquet")
    found = jobs.annotate_clinical(
        spark, f"{out}/sample.vcf", f"{out}/clinvar", contains="Pathogenic", info_fields=t.VCF_INFO, unique_reference=True
    )
    return found.groupBy("tsa", "clnsig").agg(F.count("*").alias("n_rows"))


# --- filters, distinct values, order ----------------------------------------------------------------


@query(
    t.WITH_SQL
    + """
SELECT DISTINCT chrom, CASE WHEN TRY_CAST(chrom AS int) IS NULL THEN 1 ELSE 0 END AS chrom_class,
       coalesce(TRY_CAST(chrom AS int), 0) AS chrom_number FROM v"""
)
def distinct_chroms_natural_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chromosomes(t.variants(spark, sf_dir))


@query(t.WITH_SQL + "SELECT DISTINCT tsa FROM v")
def distinct_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.distinct_values(t.variants(spark, sf_dir), "tsa").orderBy("tsa")


@query(t.WITH_SQL + "SELECT tsa, count(*) AS n_rows, count(DISTINCT chrom) AS n_files FROM v GROUP BY tsa")
def type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.type_counts(t.variants(spark, sf_dir), source_column="chrom")


@query(t.WITH_SQL + "SELECT count(*) AS n FROM v")
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.variants(spark, sf_dir).agg(F.count("*").alias("n"))


@query(t.WITH_SQL + "SELECT * FROM v WHERE start BETWEEN 1000 AND 5000 AND chrom = '2'")
def region_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.region(t.variants(spark, sf_dir), 1000, 5000, "2")


@query(t.WITH_SQL + "SELECT chrom, start, ref, alt, tsa FROM v WHERE tsa = 'SNV'")
def filter_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.of_type(t.variants(spark, sf_dir), "SNV").select(*KEYS, "tsa")


@query(t.WITH_SQL + "SELECT * FROM v ORDER BY l_orderkey, l_linenumber, chrom, start, ref, alt, qual, tsa, l_linestatus LIMIT 20")
def head_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ["l_orderkey", "l_linenumber", *KEYS, "qual", "tsa", "l_linestatus"]
    return op.head(t.variants(spark, sf_dir), 20, *order)


# --- splitting -------------------------------------------------------------------------------------

# Some alternates are null or empty: every deletion of quality 50 and every SNV of quality 49 and 48.
GAPPY_SQL = """
, g AS (SELECT chrom, start, ref, tsa, l_orderkey, l_linenumber,
  CASE WHEN qual = 50 THEN NULL WHEN qual = 49 THEN '' WHEN qual = 48 THEN alt || '|' ELSE alt END AS alt FROM v)"""


def gappy_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    alt = (
        F.when(F.col("qual") == 50, None)
        .when(F.col("qual") == 49, "")
        .when(F.col("qual") == 48, F.concat("alt", F.lit(ALT_SEPARATOR)))
        .otherwise(F.col("alt"))
    )
    return t.variants(spark, sf_dir).select("chrom", "start", "ref", "tsa", "l_orderkey", "l_linenumber", alt.alias("alt"))


@query(
    t.WITH_SQL
    + GAPPY_SQL
    + """
SELECT chrom, start, ref, tsa, l_orderkey, l_linenumber, unnest(string_split(alt, '|')) AS alt
FROM g WHERE tsa = 'SNV' AND alt IS NOT NULL
UNION ALL SELECT * FROM g WHERE tsa <> 'SNV' OR alt IS NULL"""
)
def split_snv_exploded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.split_variants(gappy_variants(spark, sf_dir))


@query(t.WITH_SQL + GAPPY_SQL + "SELECT * FROM g")
def split_no_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.split_variants(gappy_variants(spark, sf_dir), explode_snv_alt=False)


SPLIT_SQL = """
SELECT chrom, start, ref, unnest(string_split(alt, '|')) AS alt, qual, nullif(tsa, 'insertion') AS tsa
FROM v WHERE tsa = 'SNV'
UNION ALL SELECT chrom, start, ref, alt, qual, nullif(tsa, 'insertion') FROM v WHERE tsa <> 'SNV'"""


@query(t.WITH_SQL + SPLIT_SQL)
def split_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written by type and read back; rows without a type stay."""
    out = scratch_dir(spark, "split_roundtrip")
    df = t.variants(spark, sf_dir).select(*KEYS, "qual", F.nullif(F.col("tsa"), F.lit("insertion")).alias("tsa"))
    op.write_split(op.split_variants(df), out)
    return op.read_split(spark, out, df.schema)


@query(
    t.WITH_SQL
    + """
SELECT tsa, chrom, count(*) AS n_rows, min(start) AS first_start, max(start) AS last_start FROM
(SELECT chrom, start, unnest(string_split(alt, '|')) AS alt, tsa FROM v WHERE tsa = 'SNV'
 UNION ALL SELECT chrom, start, alt, tsa FROM v WHERE tsa <> 'SNV') GROUP BY tsa, chrom"""
)
def split_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reference dataset: partitioned by type and chromosome, sorted by position."""
    out = scratch_dir(spark, "split_clustered")
    df = op.split_variants(t.variants(spark, sf_dir).select(*KEYS, "tsa"))
    jobs.build_reference(df, out)
    back = op.read_split(spark, out, df.schema, ["tsa", "chrom"])
    return back.groupBy("tsa", "chrom").agg(
        F.count("*").alias("n_rows"), F.min("start").alias("first_start"), F.max("start").alias("last_start")
    )


@query(
    t.WITH_SQL
    + """
SELECT 'lineitem' AS source_file, tsa, count(*) AS n_rows FROM
(SELECT unnest(string_split(alt, '|')) AS alt, tsa FROM v WHERE tsa = 'SNV'
 UNION ALL SELECT alt, tsa FROM v WHERE tsa <> 'SNV') GROUP BY tsa
UNION ALL SELECT 'orders', tsa, count(*) FROM (""" + t.ORDER_VARIANTS_SQL + """) GROUP BY tsa"""
)
def split_many_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two datasets split in one job, then again: the second run finds nothing to do."""
    out = scratch_dir(spark, "split_many_inputs")
    columns = [*KEYS, "tsa"]
    t.variants(spark, sf_dir).select(columns).write.parquet(f"{out}/lineitem.parquet")
    t.order_variants(spark, sf_dir).select(columns).write.parquet(f"{out}/orders.parquet")
    inputs = [f"{out}/lineitem.parquet", f"{out}/orders.parquet"]
    jobs.split_existing(spark, inputs, f"{out}/splits")
    again = jobs.split_existing(spark, inputs, f"{out}/splits")
    if again:
        raise AssertionError(f"already split, yet split again: {again}")
    back = spark.read.parquet(f"{out}/splits")
    return back.groupBy("source_file", "tsa").agg(F.count("*").alias("n_rows"))


@query(
    t.WITH_SQL
    + """
SELECT DISTINCT e.chrom AS source_file FROM v e
LEFT JOIN (SELECT DISTINCT chrom, tsa FROM v WHERE qual < 25 OR chrom NOT IN ('3', 'X')
           EXCEPT SELECT chrom, tsa FROM v WHERE tsa = 'deletion' AND chrom = '7') x
  ON e.chrom = x.chrom AND e.tsa = x.tsa
WHERE x.tsa IS NULL"""
)
def incremental_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources to split again because any of their types is missing."""
    v = t.variants(spark, sf_dir).withColumn("source_file", F.col("chrom"))
    done = v.filter("(qual < 25 OR chrom NOT IN ('3', 'X')) AND NOT (tsa = 'deletion' AND chrom = '7')")
    return op.pending_sources(op.expected_splits(v), done)


# --- reference datasets ----------------------------------------------------------------------------


@query(
    t.WITH_SQL
    + """
SELECT chrom, tsa, count(*) AS n_rows, min(start) AS first_start, max(qual) AS max_qual
FROM d WHERE tsa = 'SNV' AND chrom IN ('1', '10', 'X') GROUP BY chrom, tsa"""
)
def prune_reference_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the partitions of one type and of the given chromosomes are read."""
    out = scratch_dir(spark, "prune_reference_scan")
    jobs.build_reference(t.reference_rows(spark, sf_dir), out, layout="rebalance")
    return (
        open_reference(spark, out, "SNV", ["1", "10", "X"])
        .groupBy("chrom", "tsa")
        .agg(F.count("*").alias("n_rows"), F.min("start").alias("first_start"), F.max("qual").alias("max_qual"))
    )


@query(
    t.FILES_SQL
    + """
, f AS (SELECT '/ref/homo_sapiens-chr' || p_partkey || '.parquet' AS path, p_partkey FROM m WHERE p_type <> 'SMALL'
  UNION ALL SELECT '/ref/chr' || p_partkey || '.parquet', p_partkey FROM m WHERE p_size > 20
  UNION ALL SELECT '/ref/' || p_partkey || '.parquet', p_partkey FROM m WHERE p_size < 40),
c AS (SELECT CAST(p_partkey AS varchar) AS chrom, path,
        CASE WHEN path LIKE '/ref/homo%' THEN 0 WHEN path LIKE '/ref/chr%' THEN 1 ELSE 2 END AS priority FROM f)
SELECT chrom, arg_min(path, priority) AS path FROM c GROUP BY chrom"""
)
def reference_file_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first existing of three file names per chromosome."""
    m = t.part_files(spark, sf_dir)

    def named(form: str, where: str) -> DataFrame:
        return m.filter(where).select(F.format_string(form, "p_partkey").alias("path"))

    files = (
        named("/ref/homo_sapiens-chr%d.parquet", "p_type <> 'SMALL'")
        .union(named("/ref/chr%d.parquet", "p_size > 20"))
        .union(named("/ref/%d.parquet", "p_size < 40"))
    )
    return match_reference_files(files, m.select(F.col("p_partkey").cast("string").alias("chrom")))


@query(
    f"WITH a AS ({t.VARIANTS_SQL}), b AS ({t.ORDER_VARIANTS_SQL})"
    """
SELECT chrom, tsa, count(*) AS n_rows, min(start) AS first_start, max(qual) AS max_qual
FROM (SELECT chrom, start, ref, alt, tsa, qual FROM a UNION ALL SELECT chrom, start, ref, alt, tsa, qual FROM b)
GROUP BY chrom, tsa"""
)
def multi_file_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several Parquet datasets read as one table with a given schema."""
    out = scratch_dir(spark, "multi_file_union")
    columns = [*KEYS, "tsa", "qual"]
    first = t.variants(spark, sf_dir).select(columns)
    first.write.parquet(f"{out}/a")
    t.order_variants(spark, sf_dir).select(columns).write.parquet(f"{out}/b")
    both = spark.read.schema(first.schema).parquet(f"{out}/a", f"{out}/b")
    return both.groupBy("chrom", "tsa").agg(
        F.count("*").alias("n_rows"), F.min("start").alias("first_start"), F.max("qual").alias("max_qual")
    )


@query(
    t.WITH_SQL
    + f"""
, c AS (SELECT {KEY_LIST}, {CLINICAL.format("qual")} AS clnsig FROM v)
SELECT {KEY_LIST}, clnsig FROM c WHERE clnsig LIKE '%Pathogenic%' ORDER BY {KEY_LIST}, clnsig LIMIT 100"""
)
def parquet_glob_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over a glob of Parquet datasets."""
    out = scratch_dir(spark, "parquet_glob_sql")
    clinical = t.variants(spark, sf_dir).select(*KEYS, F.expr(CLINICAL.format("qual")).alias("clnsig"), "l_linestatus")
    for status in ("F", "O"):
        clinical.filter(F.col("l_linestatus") == status).drop("l_linestatus").write.parquet(f"{out}/{status}.parquet")
    spark.read.parquet(f"{out}/*.parquet").createOrReplaceTempView("clinical_variants")
    return spark.sql(
        f"""SELECT {KEY_LIST}, clnsig FROM clinical_variants WHERE clnsig LIKE '%Pathogenic%'
        ORDER BY {KEY_LIST}, clnsig LIMIT 100"""
    )


# --- VCF text --------------------------------------------------------------------------------------


@query(t.WITH_SQL + t.PARSED_SQL)
def vcf_parse_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "vcf_parse_lines")
    t.vcf_text(t.variants(spark, sf_dir)).write.text(out)
    return parse_lines(spark.read.text(out), t.VCF_INFO)


@query(t.WITH_SQL + "SELECT chrom, start, ref, alt, l_linestatus = 'F' AS f, l_orderkey AS ok FROM v")
def vcf_info_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the requested INFO fields are extracted, in the requested order."""
    out = scratch_dir(spark, "vcf_info_projection")
    t.vcf_text(t.variants(spark, sf_dir)).write.text(out)
    return parse_lines(spark.read.text(out), select_info(t.VCF_INFO, ["F", "OK"])).select(*KEYS, "f", "ok")


@query(t.WITH_SQL + t.PARSED_SQL)
def vcf_to_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text files converted to Parquet; the second conversion reuses the first."""
    out = scratch_dir(spark, "vcf_to_parquet_roundtrip")
    t.vcf_text(t.variants(spark, sf_dir)).write.text(f"{out}/sample.vcf")
    vcf_to_parquet(spark, f"{out}/sample.vcf", info_fields=t.VCF_INFO)
    df, path = vcf_to_parquet(spark, f"{out}/sample.vcf")
    if path != f"{out}/sample.parquet":
        raise AssertionError(path)
    return df


VCF_HEADER = ["##fileformat=VCFv4.2", *map(t.info_line, t.VCF_INFO), "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"]


@query(
    t.WITH_SQL
    + f"""
, x AS ({t.PARSED_SQL}), g AS (SELECT DISTINCT 1 + p_partkey % 20 AS k FROM part)
SELECT * FROM x WHERE EXISTS (SELECT 1 FROM g WHERE x.chrom = CAST(k AS varchar) AND x.start BETWEEN 400 * k AND 400 * k + 300)
OR chrom = 'X'"""
)
def vcf_indexed_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A panel of regions and one whole chromosome out of indexed files, of which only the blocks in question are read."""
    out = f"{scratch_dir(spark, 'vcf_indexed_regions')}/cohort"
    write_indexed_vcf(t.vcf_text(t.variants(spark, sf_dir)), out, VCF_HEADER)
    k = F.col("p_partkey") % 20 + 1
    panel = t.load(spark, sf_dir, "part").select(k.cast("string").alias("chrom"), (k * 400).alias("first"), (k * 400 + 300).alias("last"))
    whole = spark.createDataFrame([("X", None, None)], "chrom string, first bigint, last bigint")
    return read_vcf_regions(spark, out, panel.unionByName(whole))


@query(
    """
SELECT 'F' || p_partkey AS id, CASE WHEN p_size <= 10 THEN 'A' ELSE '1' END AS number,
       CASE p_type WHEN 'SMALL' THEN 'Integer' WHEN 'LARGE' THEN 'Float' ELSE 'String' END AS type,
       p_name || ', ' || p_brand AS description
FROM part"""
)
def vcf_header_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = t.load(spark, sf_dir, "part")
    type_ = F.when(F.col("p_type") == "SMALL", "Integer").when(F.col("p_type") == "LARGE", "Float").otherwise("String")
    number = F.when(F.col("p_size") <= 10, "A").otherwise("1")
    text = '##INFO=<ID=F%d,Number=%s,Type=%s,Description="%s, %s">'
    declared = p.select(F.format_string(text, "p_partkey", number, type_, "p_name", "p_brand").alias("value"))
    other = p.select(F.format_string("##FORMAT=<ID=G%d,Number=1,Type=String>", "p_partkey").alias("value"))
    return header_info(declared.union(other))


@query(t.WITH_SQL + BY_TYPE_SQL)
def annotate_vcf_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job: VCF text against a partitioned reference dataset, saved as Parquet."""
    out = scratch_dir(spark, "annotate_vcf_job")
    t.vcf_text(t.variants(spark, sf_dir)).write.text(f"{out}/sample.vcf")
    ref = t.reference(spark, sf_dir).withColumn("tsa", F.lit("any"))
    jobs.build_reference(ref, f"{out}/reference", layout="rebalance")
    saved = jobs.annotate_vcf(
        spark,
        f"{out}/sample.vcf",
        f"{out}/reference",
        variant_type="any",
        info_fields=t.VCF_INFO,
        out=f"{out}/annotated",
        unique_reference=True,
    )
    return by_type(spark.read.parquet(saved))


# --- file manifests --------------------------------------------------------------------------------


@query(t.FILES_SQL + r"SELECT path FROM m WHERE regexp_matches(name, 'chr(21|22|1[0-9]+)\.vcf\.gz$')")
def file_select_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = t.part_files(spark, sf_dir)
    return m.filter(fn.base_name("path").rlike(r"chr(21|22|1[0-9]+)\.vcf\.gz$")).select("path")


@query(
    t.FILES_SQL
    + """
SELECT path, string_split(path, '/')[-1] AS name,
       CASE p_type WHEN 'STANDARD' THEN '.vcf' WHEN 'MEDIUM' THEN '.gz' WHEN 'LARGE' THEN '.bgz'
         WHEN 'ECONOMY' THEN '.tbi' WHEN 'PROMO' THEN '.parquet' ELSE '.txt' END AS suffix,
       p_type IN ('STANDARD', 'MEDIUM', 'LARGE') AS is_vcf, p_type = 'PROMO' AS is_parquet,
       p_type = 'ECONOMY' AS is_index FROM m"""
)
def file_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.part_files(spark, sf_dir).select(
        "path",
        fn.base_name("path").alias("name"),
        fn.last_suffix("path").alias("suffix"),
        fn.is_vcf_file("path").alias("is_vcf"),
        fn.is_parquet_file("path").alias("is_parquet"),
        fn.is_index_file("path").alias("is_index"),
    )


@query(
    t.FILES_SQL
    + """
SELECT path,
       CASE p_type WHEN 'STANDARD' THEN replace(path, '.vcf', '.parquet') WHEN 'MEDIUM' THEN replace(path, '.vcf.gz', '.parquet')
         WHEN 'LARGE' THEN replace(path, '.vcf.bgz', '.parquet') WHEN 'ECONOMY' THEN replace(path, '.tbi', '.parquet')
         WHEN 'PROMO' THEN path ELSE replace(path, '.txt', '.parquet') END AS parquet_path,
       'homo_sapiens-chr' || p_partkey || CASE p_type WHEN 'MEDIUM' THEN '.vcf' WHEN 'LARGE' THEN '.vcf'
         WHEN 'ECONOMY' THEN '.vcf.gz' ELSE '' END AS stem
FROM m"""
)
def default_output_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.part_files(spark, sf_dir).select(
        "path", fn.default_parquet_name("path").alias("parquet_path"), fn.stem("path").alias("stem")
    )


@query(
    t.FILES_SQL
    + """
SELECT path, 'data/' || CASE WHEN path LIKE '/landing/SNV/%' THEN substr(path, 14) ELSE name END AS path_in_repo FROM m"""
)
def relative_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths below a root keep their folders, others fall back to the base name."""
    return op.publish_paths(t.part_files(spark, sf_dir).select("path"), "/landing/SNV/")


@query(t.FILES_SQL + f", q AS ({t.REMOTE_SQL}) SELECT url, name FROM q WHERE name NOT IN (SELECT name FROM m WHERE p_size > 5)")
def missing_locals(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = t.part_files(spark, sf_dir)
    return op.missing_locals(t.remote_files(m).select("url"), m.filter("p_size > 5").select("path"))


@query(t.FILES_SQL + "SELECT path FROM m WHERE p_type = 'PROMO' AND p_size <= 15")
def missing_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = t.part_files(spark, sf_dir)
    return op.missing_paths(m.filter("p_type = 'PROMO'"), m.filter("p_size > 15"))


HUMAN_SQL = """CASE WHEN {0} < 1024 THEN format('{{}} B', {0})
  WHEN {0} < 1048576 THEN format('{{:.1f}} KB', {0} / 1024.0)
  WHEN {0} < 1073741824 THEN format('{{:.1f}} MB', {0} / 1048576.0)
  ELSE format('{{:.1f}} GB', {0} / 1073741824.0) END"""


@query(
    t.FILES_SQL
    + f"""
, q AS ({t.REMOTE_SQL})
SELECT url, m.path AS local_path, m.size AS local_size, q.size AS remote_size, m.size - q.size AS diff,
       m.path || ': local ' || {HUMAN_SQL.format('m.size')} || ' vs remote ' || {HUMAN_SQL.format('q.size')} || ' ('
         || CASE WHEN m.size > q.size THEN '+' ELSE '' END || CAST(m.size - q.size AS varchar) || ' B)' AS detail
FROM q JOIN m ON q.name = m.name WHERE m.size <> q.size"""
)
def size_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = t.part_files(spark, sf_dir)
    remote = t.remote_files(m).select("url", F.col("size").alias("remote_size"))
    return op.size_mismatches(remote, m.select("path", "size"))


@query(
    t.FILES_SQL
    + """
SELECT p_name || '.vcf' AS name, arg_max('/x/' || p_partkey || '/' || p_name || '.vcf', p_partkey) AS path,
       arg_max(size, p_partkey) AS size FROM m GROUP BY p_name"""
)
def last_local_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of several local files with one base name the last counts."""
    path = F.format_string("/x/%d/%s.vcf", "p_partkey", "p_name")
    files = t.part_files(spark, sf_dir).select(path.alias("path"), "size", "p_partkey")
    return op.last_by_name(files, "p_partkey")


@query(
    t.FILES_SQL
    + """
SELECT 'missing_input' AS kind, name, path AS detail FROM m WHERE p_type = 'PROMO' AND p_size = 3
UNION ALL SELECT 'no_splits', name, path FROM m WHERE p_type = 'PROMO' AND p_size <> 3 AND p_brand = 'Brand#3'
UNION ALL SELECT 'missing_split', name, path || '/' || s FROM m CROSS JOIN (VALUES ('SNV'), ('deletion')) AS x(s)
  WHERE p_type = 'PROMO' AND p_size <> 3 AND p_brand <> 'Brand#3' AND p_size > 45 AND s = 'deletion'"""
)
def split_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = t.part_files(spark, sf_dir)
    kinds = F.explode(F.array(F.lit("SNV"), F.lit("deletion"))).alias("kind")
    recorded = m.filter("p_brand <> 'Brand#3'").select("path", "p_size", kinds)
    recorded = recorded.select("path", "p_size", "kind", F.concat_ws("/", "path", "kind").alias("split_path"))
    written = recorded.filter("NOT (p_size > 45 AND kind = 'deletion')").select(F.col("split_path").alias("path"))
    return op.split_completeness(m.select("path"), m.filter("p_size <> 3").select("path"), recorded, written)


@query(
    t.FILES_SQL
    + """
SELECT CAST(count(*) FILTER (p_type IN ('STANDARD', 'MEDIUM', 'LARGE')) AS bigint) AS vcfs,
       CAST(count(*) FILTER (p_type = 'PROMO') AS bigint) AS parquets,
       count(*) FILTER (p_type = 'PROMO') > 0 AND count(*) FILTER (p_type = 'PROMO')
         < count(*) FILTER (p_type IN ('STANDARD', 'MEDIUM', 'LARGE')) AS short FROM m"""
)
def convert_count_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = t.part_files(spark, sf_dir)
    return op.convert_count_check(m.select("path"), m.filter(fn.is_parquet_file("path")).select("path"))


@query(
    t.FILES_SQL
    + f"""
, q AS ({t.REMOTE_SQL}), j AS (SELECT q.url, q.name, q.size AS remote_size, m.path, m.size, p_size
                              FROM q JOIN m ON q.name = m.name)
SELECT 'error' AS severity, 'missing_local' AS kind, name, path AS detail FROM m WHERE p_size = 1
UNION ALL SELECT 'error', 'size_mismatch', name, path || ': local ' || {HUMAN_SQL.format('size')} || ' vs remote '
  || {HUMAN_SQL.format('remote_size')} || ' (' || CASE WHEN size > remote_size THEN '+' ELSE '' END
  || CAST(size - remote_size AS varchar) || ' B)' FROM j WHERE p_size <> 50 AND size <> remote_size
UNION ALL SELECT 'warning', 'remote_size_unknown', name, url FROM j WHERE p_size = 50
UNION ALL SELECT 'error', 'missing_parquet', name, path FROM m WHERE p_type = 'PROMO' AND p_size = 1
UNION ALL SELECT 'warning', 'fewer_parquets_than_vcfs', 'dataset',
  CAST(count(*) FILTER (p_type = 'PROMO') AS varchar) || ' Parquet files for '
  || CAST(count(*) FILTER (p_type IN ('STANDARD', 'MEDIUM', 'LARGE')) AS varchar) || ' VCF files' FROM m
  HAVING count(*) FILTER (p_type = 'PROMO') < count(*) FILTER (p_type IN ('STANDARD', 'MEDIUM', 'LARGE'))"""
)
def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All problems of a prepared dataset in one table."""
    m = t.part_files(spark, sf_dir)
    sizes = t.remote_files(m).join(m.select("name", "p_size"), "name")
    unknown = F.when(F.col("p_size") != 50, F.col("size"))
    remote = sizes.select("url", unknown.alias("remote_size"))
    outputs = m.filter(fn.is_parquet_file("path"))
    return op.reconcile(remote, m.select("path", "size"), outputs.select("path"), m.filter("p_size <> 1").select("path"))


PLAN_SQL = f"""
, q AS ({t.REMOTE_SQL}),
p AS (SELECT m.path AS file, 'data/' || substr(m.path, 10) AS path_in_repo,
        q.size IS NULL OR q.size <> m.size AS uploaded,
        CASE WHEN q.size IS NULL THEN 'new_file' WHEN q.size = m.size THEN 'size_match' ELSE 'size_differs' END AS reason,
        m.size AS local_size, q.size AS remote_size
      FROM m LEFT JOIN q ON m.path = q.path)"""


def plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = t.part_files(spark, sf_dir)
    local = op.publish_paths(m.select("path", "size"), "/landing")
    remote = op.publish_paths(t.remote_files(m), "/landing").select("path_in_repo", "size")
    return op.sync_plan(local, remote)


@query(t.FILES_SQL + PLAN_SQL + "SELECT * FROM p")
def sync_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan(spark, sf_dir)


@query(
    t.FILES_SQL
    + PLAN_SQL
    + """
SELECT count(*) AS total_files, count(*) FILTER (uploaded) AS num_uploaded,
       count(*) FILTER (NOT uploaded) AS num_skipped FROM p"""
)
def sync_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.sync_summary(plan(spark, sf_dir))


@query(
    t.FILES_SQL
    + PLAN_SQL
    + "SELECT reason, count(*) AS n_files, CAST(sum(local_size) AS bigint) AS total_bytes FROM p GROUP BY reason"
)
def sync_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.sync_reasons(plan(spark, sf_dir))


@query(
    t.FILES_SQL
    + """
SELECT count(*) AS num_files, CAST(sum(size) AS bigint) AS total_bytes,
       round(CAST(sum(size) AS double) / 1073741824, 2) AS total_gb,
       'SNV,deletion' AS variant_types FROM m"""
)
def dataset_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = op.dataset_stats(t.part_files(spark, sf_dir), "/landing")
    return stats.withColumn("variant_types", F.array_join("variant_types", ","))


@query(
    t.FILES_SQL
    + f"""
SELECT path, {HUMAN_SQL.format('size')} AS text, round(size / 1048576.0, 2) AS mb, round(size / 1073741824.0, 2) AS gb
FROM m"""
)
def size_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.part_files(spark, sf_dir).select(
        "path", fn.human_size("size").alias("text"), fn.megabytes("size").alias("mb"), fn.gigabytes("size").alias("gb")
    )


@query(
    t.FILES_SQL
    + """
SELECT string_split(name, '.')[1] AS source_file, path FROM m
WHERE p_type IN ('STANDARD', 'MEDIUM', 'LARGE') AND NOT (p_size > 12)"""
)
def incremental_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inputs that have no output yet."""
    m = t.part_files(spark, sf_dir).filter(fn.is_vcf_file("path"))
    done = m.filter("p_size > 12").select(fn.source_name("path").alias("source_file"))
    return jobs.pending_conversions(m.select("path"), done)


@query(t.WITH_SQL + "SELECT tsa AS variant_type, count(*) AS n_rows FROM v GROUP BY tsa")
def catalog_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types found from the folders of a written dataset, each with its rows."""
    out = scratch_dir(spark, "catalog_scan")
    t.variants(spark, sf_dir).write.partitionBy("tsa").parquet(out)
    found = op.variant_types_present(file_catalog(spark, out, r"\.parquet$"), qualified(spark, out))
    counts = op.type_counts(op.read_split(spark, out, t.variants(spark, sf_dir).schema))
    return found.join(counts.withColumnRenamed("tsa", "variant_type"), "variant_type")


@query(t.WITH_SQL + t.PARSED_SQL.replace("FROM v", "FROM v UNION ALL " + t.PARSED_SQL.replace("FROM v", "FROM (SELECT * REPLACE (chrom || '_alt' AS chrom) FROM v)")))
def convert_in_two_waves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that land later are converted without converting the earlier ones again."""
    out = scratch_dir(spark, "convert_in_two_waves")
    v = t.variants(spark, sf_dir)
    landing = f"{out}/landing"
    t.vcf_text(v).write.text(landing)
    first = jobs.convert_pending(spark, file_catalog(spark, landing, r"\.txt$"), f"{out}/variants", t.VCF_INFO)
    t.vcf_text(v.withColumn("chrom", F.concat("chrom", F.lit("_alt")))).write.mode("append").text(landing)
    second = jobs.convert_pending(spark, file_catalog(spark, landing, r"\.txt$"), f"{out}/variants", t.VCF_INFO)
    if set(first) & set(second):
        raise AssertionError("a file was converted twice")
    return jobs.read_converted(spark, f"{out}/variants").drop("source_file", "source_id")


@query(
    t.WITH_SQL
    + """
SELECT chrom, tsa, count(*) AS n_rows FROM
(SELECT chrom, tsa FROM v UNION ALL SELECT chrom || '_b', tsa FROM v) GROUP BY chrom, tsa"""
)
def convert_same_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of the same names in two folders, the second landed later: all rows are there."""
    out = scratch_dir(spark, "convert_same_names")
    v = t.variants(spark, sf_dir)
    for folder, lines in (("a", t.vcf_text(v)), ("b", t.vcf_text(v.withColumn("chrom", F.concat("chrom", F.lit("_b")))))):
        lines.write.text(f"{out}/landing/{folder}")
        rename_files(spark, f"{out}/landing/{folder}", ".txt", "sample{}.vcf")
        landed = file_catalog(spark, f"{out}/landing", r"\.vcf$")
        jobs.convert_pending(spark, landed, f"{out}/variants", t.VCF_INFO, root=qualified(spark, f"{out}/landing"))
    return jobs.read_converted(spark, f"{out}/variants").groupBy("chrom", "tsa").agg(F.count("*").alias("n_rows"))


def land(spark: SparkSession, lines: DataFrame, folder: str, fields, name: str = "homo_sapiens-chr{}.vcf.gz") -> None:
    """Compressed VCF files, each with a header that declares the fields."""
    header = ["##fileformat=VCFv4.2", *map(t.info_line, fields), "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"]
    t.with_header(lines, *header).write.option("compression", "gzip").text(folder)
    rename_files(spark, folder, ".txt.gz", name)


@query(
    t.WITH_SQL
    + """
SELECT tsa, count(*) AS n_rows, CAST(sum(ok) AS bigint) AS orders FROM
(SELECT tsa, unnest(string_split(alt, '|')) AS alt, l_orderkey AS ok FROM v WHERE tsa = 'SNV'
 UNION ALL SELECT tsa, alt, l_orderkey FROM v WHERE tsa <> 'SNV') GROUP BY tsa"""
)
def prepare_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed files selected, their headers read, converted, checked, split by type and checked again."""
    out = scratch_dir(spark, "prepare_job")
    land(spark, t.vcf_text(t.variants(spark, sf_dir)), f"{out}/landing", t.VCF_INFO)
    done = jobs.prepare(spark, ensembl(), f"{out}/landing", out, split=True, raise_on_error=True)
    back = spark.read.parquet(done.splits)
    return back.groupBy("tsa").agg(F.count("*").alias("n_rows"), F.sum("ok").alias("orders"))


@query(
    t.WITH_SQL
    + """
SELECT chrom, tsa, CAST(l_orderkey AS varchar) AS ok, CAST(NULL AS bigint) AS ln FROM v
UNION ALL SELECT chrom || '_b', tsa, CAST(l_orderkey AS varchar), CAST(l_linenumber AS bigint) FROM v"""
)
def convert_changed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second wave declares one field more and another as text: both waves come back with all columns."""
    out = scratch_dir(spark, "convert_changed_headers")
    v = t.variants(spark, sf_dir)
    tsa, ok, ln = t.VCF_INFO[0], t.VCF_INFO[1], t.VCF_INFO[2]
    land(spark, t.vcf_text(v), f"{out}/landing/a", [tsa, ok])
    landed = file_catalog(spark, f"{out}/landing", r"\.gz$")
    jobs.convert_pending(spark, landed, f"{out}/variants")
    later = v.withColumn("chrom", F.concat("chrom", F.lit("_b")))
    land(spark, t.vcf_text(later), f"{out}/landing/b", [tsa, ok._replace(type="String"), ln])
    jobs.convert_pending(spark, file_catalog(spark, f"{out}/landing", r"\.gz$"), f"{out}/variants")
    return jobs.read_converted(spark, f"{out}/variants").select("chrom", "tsa", "ok", "ln")


@query(
    t.WITH_SQL
    + """
SELECT DISTINCT tsa AS variant_type, CASE tsa WHEN 'SNV' THEN 'size_match' WHEN 'deletion' THEN 'new_file'
  ELSE 'size_differs' END AS reason FROM v"""
)
def publish_plan_on_disk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of a written dataset against a remote listing that lacks some and has others of another size."""
    out = scratch_dir(spark, "publish_plan")
    t.variants(spark, sf_dir).write.partitionBy("tsa").parquet(out)
    local = jobs.publish_plan(spark, out, spark.createDataFrame([], "path_in_repo string, size bigint"))
    there = local.filter(~F.col("path_in_repo").contains("tsa=deletion/"))
    other = F.when(F.col("path_in_repo").contains("tsa=insertion/"), 1).otherwise(0)
    plan = jobs.publish_plan(spark, out, there.select("path_in_repo", (F.col("local_size") + other).alias("size")))
    kind = F.regexp_extract("path_in_repo", "tsa=([^/]*)/", 1)
    return plan.select(kind.alias("variant_type"), "reason").distinct()


@query(t.WITH_SQL + "SELECT tsa AS variant_type, count(*) AS n_rows FROM v GROUP BY tsa")
def describe_dataset_on_disk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per type of a written dataset, from its statistics."""
    out = scratch_dir(spark, "describe_dataset")
    t.variants(spark, sf_dir).write.partitionBy("tsa").parquet(out)
    return jobs.describe_dataset(spark, out).select(F.explode("rows_by_type").alias("variant_type", "n_rows"))


# --- streams ---------------------------------------------------------------------------------------


@query(t.WITH_SQL + t.PARSED_SQL)
def stream_ingest_available_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed VCF text taken up by a stream and appended to a dataset."""
    out = scratch_dir(spark, "stream_ingest")
    t.vcf_text(t.variants(spark, sf_dir)).write.text(f"{out}/landing")
    stream = stream_vcf(spark, f"{out}/landing", t.VCF_INFO)
    finish(ingest(stream, f"{out}/variants", f"{out}/checkpoint"))
    return spark.read.schema(stream.schema).parquet(f"{out}/variants")


@query(
    t.WITH_SQL
    + t.PARSED_SQL.replace(
        "l_linestatus = 'F' AS f", "l_linestatus = 'F' AS f, CASE WHEN l_orderkey % 2 = 1 THEN CAST(l_orderkey % 7 AS double) END AS af"
    )
)
def stream_variant_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose headers differ, taken up by a stream that is told no field, and typed when they are read."""
    out = scratch_dir(spark, "stream_variant_info")
    v = t.variants(spark, sf_dir)
    t.vcf_text(v.filter("l_orderkey % 2 = 0")).write.text(f"{out}/landing/old")
    more = t.vcf_text(v.filter("l_orderkey % 2 = 1").withColumn("af", F.col("l_orderkey") % 7), ["af"])
    more.write.text(f"{out}/landing/new")
    stream = stream_vcf(spark, f"{out}/landing/*", variant="info")
    finish(ingest(stream, f"{out}/variants", f"{out}/checkpoint"))
    stored = spark.read.schema(stream.schema).parquet(f"{out}/variants")
    return type_info(stored, [*t.VCF_INFO, InfoField("AF", "1", "Float")])


@query(
    t.WITH_SQL
    + """
SELECT 'between' AS seen, tsa, count(*) AS n_rows FROM v WHERE l_orderkey % 2 = 0 GROUP BY tsa
UNION ALL SELECT 'after', tsa, count(*) FROM v WHERE l_orderkey % 2 = 0 OR tsa = 'SNV' GROUP BY tsa"""
)
def read_between_waves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reader between two waves goes on with the first, while the second replaces one type for those who come later."""
    out = scratch_dir(spark, "read_between_waves")
    v = t.variants(spark, sf_dir)
    write_snapshot(v.filter("l_orderkey % 2 = 0"), out, ["tsa"])
    between = read_snapshot(spark, out)
    write_snapshot(v.filter("tsa = 'SNV'"), out, ["tsa"], replace="partitions")
    frames = [("between", between), ("after", read_snapshot(spark, out))]
    counts = [df.groupBy("tsa").agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("seen"), "tsa", "n_rows") for name, df in frames]
    return counts[0].unionByName(counts[1])


@query(
    t.WITH_SQL
    + """
SELECT tsa AS variant_type, count(*) AS n_rows, min(start) AS first_start, max(start) AS last_start, true AS n_keys_close
FROM v GROUP BY tsa"""
)
def statistics_in_two_waves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of files of a first wave, then of only what the second wave added, merged."""
    out = scratch_dir(spark, "statistics")
    v = t.variants(spark, sf_dir)
    for wave in (0, 1):
        v.filter(F.col("l_orderkey") % 2 == wave).write.mode("append").partitionBy("tsa").parquet(f"{out}/data")
        refresh_statistics(spark, f"{out}/data", f"{out}/state")
    merged = merged_statistics(spark, f"{out}/data", f"{out}/state")
    exact = v.groupBy(F.col("tsa").alias("variant_type")).agg(F.countDistinct(*KEYS).alias("n"))
    close = (F.abs(F.col("n_keys") - F.col("n")) <= F.col("n") * 0.03 + 1).alias("n_keys_close")
    return merged.join(exact, "variant_type").select("variant_type", "n_rows", "first_start", "last_start", close)


STREAM_ANNOTATED_SQL = f"""
SELECT {KEY_LIST}, v.tsa, v.qual, l_orderkey AS ok, r.qual AS qual_ensembl, coalesce(n_obs, 0) AS n_obs FROM v LEFT JOIN r {USING}"""


@query(t.WITH_SQL + STREAM_ANNOTATED_SQL)
def stream_static_annotate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream joined with a static reference; no state is kept."""
    out = scratch_dir(spark, "stream_static")
    t.vcf_text(t.variants(spark, sf_dir)).write.text(f"{out}/landing")
    stream = stream_vcf(spark, f"{out}/landing", t.VCF_INFO)
    known = op.annotate(stream, t.reference(spark, sf_dir))
    known = known.select(*KEYS, "tsa", "qual", "ok", "qual_ensembl", "n_obs")
    finish(ingest(known, f"{out}/annotated", f"{out}/checkpoint"))
    return counted(spark.read.schema(known.schema).parquet(f"{out}/annotated"))


@query(t.WITH_SQL + STREAM_ANNOTATED_SQL)
def stream_batch_annotate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream annotated batch by batch, each reducing the reference where it is read."""
    out = scratch_dir(spark, "stream_batch")
    t.vcf_text(t.variants(spark, sf_dir)).write.text(f"{out}/landing")
    stream = stream_vcf(spark, f"{out}/landing", t.VCF_INFO)
    finish(annotate_stream(stream, t.reference(spark, sf_dir), f"{out}/annotated", f"{out}/checkpoint", unique_reference=True))
    back = spark.read.parquet(f"{out}/annotated")
    return counted(back.select(*KEYS, "tsa", "qual", "ok", "qual_ensembl", "n_obs"))
