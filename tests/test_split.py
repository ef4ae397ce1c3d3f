import os

import pytest
from pyspark.sql import functions as F

from varloom import operators as op
from varloom.plans import build_reference, split_existing, split_pending
from varloom.sources import file_catalog, open_reference, prune, read_partitioned

from .conftest import rows

ROWS = [
    ("1", 1, "A", "A|T", "SNV"),
    ("1", 2, "A", None, "SNV"),
    ("1", 3, "A", "", "SNV"),
    ("1", 4, "A", "G|", "SNV"),
    ("2", 5, "A", "A|T", "deletion"),
    ("2", 6, "A", "C", None),
]
EXPLODED = sorted(
    [
        (1, "A", "SNV"),
        (1, "T", "SNV"),
        (2, None, "SNV"),
        (3, "", "SNV"),
        (4, "G", "SNV"),
        (4, "", "SNV"),
        (5, "A|T", "deletion"),
        (6, "C", None),
    ],
    key=repr,
)


@pytest.fixture(scope="module")
def variants(spark):
    return spark.createDataFrame(ROWS, "chrom string, start bigint, ref string, alt string, tsa string")


def test_explode_only_snv(variants):
    df = op.split_variants(variants)
    assert df.columns == variants.columns
    assert rows(df, "start", "alt", "tsa") == EXPLODED
    assert rows(op.split_variants(variants, explode_snv_alt=False)) == rows(variants)
    assert op.explode_alt(variants, types=None).filter("tsa = 'deletion'").count() == 2


def test_split_by_another_type_column(variants):
    df = variants.withColumnRenamed("tsa", "clnvc")
    with pytest.raises(ValueError, match="tsa"):
        op.split_variants(df)
    assert op.split_variants(df, type_column="clnvc").count() == 8


@pytest.mark.parametrize("layout", ["scan", "rebalance", "clustered"])
def test_write_and_read_back(spark, variants, tmp_path, layout):
    out = str(tmp_path / "out")
    df = op.split_variants(variants)
    op.write_split(df, out, layout=layout)
    back = op.read_split(spark, out, df.schema)
    assert rows(back, "start", "alt", "tsa") == EXPLODED
    assert {d for d in os.listdir(out) if d.startswith("tsa")} == {
        "tsa=SNV",
        "tsa=deletion",
        "tsa=__HIVE_DEFAULT_PARTITION__",
    }


def test_unknown_layout(variants, tmp_path):
    with pytest.raises(ValueError, match="layout"):
        op.write_split(variants, str(tmp_path / "x"), layout="zigzag")


def test_clustered_cuts_a_hot_key_into_several_files(spark, tmp_path):
    """Equal rows of one position do not end up in one task."""
    df = spark.range(20_000).select(
        F.lit("1").alias("chrom"), F.lit(5).cast("bigint").alias("start"), F.lit("A").alias("ref"),
        F.lit("C").alias("alt"), F.lit("SNV").alias("tsa"), F.md5(F.col("id").cast("string")).alias("pad"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        build_reference(df, str(tmp_path / "o"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = spark.read.parquet(str(tmp_path / "o")).groupBy(F.input_file_name()).count().collect()
    assert len(sizes) > 3 and max(r["count"] for r in sizes) < 10_000


def test_sum_of_splits_is_exploded_total(variants):
    counts = {r["tsa"]: r["n_rows"] for r in op.type_counts(op.split_variants(variants)).collect()}
    assert counts == {"SNV": 6, "deletion": 1, None: 1} and sum(counts.values()) == len(EXPLODED)


def test_type_counts_with_files(spark):
    df = spark.createDataFrame([("SNV", "a"), ("SNV", "a"), ("SNV", "b"), ("x", "b")], "tsa string, source_file string")
    assert rows(op.type_counts(df, source_column="source_file")) == [("SNV", 3, 2), ("x", 1, 1)]


def test_split_existing_is_incremental(spark, variants, tmp_path):
    a, b, out = (str(tmp_path / n) for n in ("a.parquet", "b.parquet", "out"))
    variants.write.parquet(a)
    variants.filter("tsa = 'SNV'").write.parquet(b)
    assert split_existing(spark, [a, b, str(tmp_path / "c.vcf")], out) == ["a", "b"]
    assert split_existing(spark, [a, b], out) == []
    back = spark.read.parquet(out)
    assert back.filter("source_file = 'a'").count() == 8 and back.filter("source_file = 'b'").count() == 6
    # A source that gains a type is split again as a whole; the other one is left alone.
    variants.select("chrom", "start", "ref", "alt", F.lit("indel").alias("tsa")).limit(1).write.mode("append").parquet(b)
    assert split_existing(spark, [a, b], out) == ["b"]
    assert spark.read.parquet(out).filter("source_file = 'b'").count() == 7
    assert split_existing(spark, [str(tmp_path / "c.vcf")], out) == []


def test_split_of_single_files(spark, variants, tmp_path):
    """Plain Parquet files, not written as folders, are named by themselves."""
    import pyarrow.parquet as pq

    path = tmp_path / "homo_sapiens-chr1.parquet"
    pq.write_table(variants.toArrow(), path)
    assert split_existing(spark, str(path), str(tmp_path / "out"), explode_snv_alt=False) == ["homo_sapiens-chr1"]
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(ROWS)


def test_split_pending_overwrite(spark, variants, tmp_path):
    df, out = variants.withColumn("source_file", F.lit("s")), str(tmp_path / "out")
    assert split_pending(df, out) == ["s"]
    assert split_pending(df, out) == []
    assert split_pending(df, out, overwrite=True) == ["s"]
    assert spark.read.parquet(out).count() == 8


def test_partitioned_reference_keeps_text_chromosomes(spark, variants, tmp_path):
    out = str(tmp_path / "ref")
    build_reference(variants.filter("tsa IS NOT NULL"), out)
    assert dict(spark.read.parquet(out).dtypes)["chrom"] == "int"
    assert dict(read_partitioned(spark, out).dtypes)["chrom"] == "string"
    df = open_reference(spark, out, "SNV", ["1"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].split("]")[0]
    assert "tsa" in filters and "chrom" in filters
    assert df.count() == 4 and open_reference(spark, out, None).count() == 5
    with pytest.raises(FileNotFoundError, match="deletion"):
        open_reference(spark, out, "indel")
    assert prune(df, chroms=["X"]).isEmpty()


@pytest.mark.parametrize("prefix", ["", "data/"])
def test_folder_reference(spark, variants, tmp_path, prefix):
    for chrom, name in (("1", "homo_sapiens-chr1"), ("1", "chr1"), ("2", "2"), ("X", "chrX")):
        part = variants.withColumn("chrom", F.lit(chrom)).withColumn("file", F.lit(name))
        part.limit(2).coalesce(1).write.parquet(f"{tmp_path}/{prefix}SNV/{name}.parquet")
    found = open_reference(spark, str(tmp_path), "SNV", ["1", "2", "MT"])
    assert {r[0] for r in found.select("file").distinct().collect()} == {"homo_sapiens-chr1", "2"}
    assert open_reference(spark, str(tmp_path), "SNV").count() == 8
    assert open_reference(spark, str(tmp_path), "SNV", ["MT"]) is None
    with pytest.raises(FileNotFoundError, match="SNV"):
        open_reference(spark, str(tmp_path), "INDEL", ["1"])


def test_flat_and_missing_reference(spark, variants, tmp_path):
    variants.write.parquet(f"{tmp_path}/flat/data/clinvar.parquet")
    assert open_reference(spark, f"{tmp_path}/flat", None, ["2"]).count() == 2
    with pytest.raises(FileNotFoundError):
        open_reference(spark, f"{tmp_path}/nowhere")
    os.makedirs(tmp_path / "empty")
    with pytest.raises(FileNotFoundError):
        open_reference(spark, f"{tmp_path}/empty", None)


def test_catalog(spark, tmp_path):
    from varloom.sources import collect_parquet_files, list_paths

    for name in ("a-chr1.vcf.gz", "a-chr1.vcf.gz.tbi", "a-chr22.vcf.gz", "SNV/x y.parquet", "SNV/d/z.parquet", "SNV/z.txt"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"12345")
    root = str(tmp_path)
    names = lambda df: sorted(r[0].rsplit("/", 1)[-1] for r in df.select("path").collect())
    assert names(list_paths(spark, root)) == ["a-chr1.vcf.gz", "a-chr1.vcf.gz.tbi", "a-chr22.vcf.gz"]
    assert names(list_paths(spark, root, file_only=False))[0] == "SNV"
    assert names(list_paths(spark, root, r"chr(21|22|X)")) == ["a-chr22.vcf.gz"]
    assert names(list_paths(spark, root + "/*.gz")) == ["a-chr1.vcf.gz", "a-chr22.vcf.gz"]
    assert names(collect_parquet_files(spark, root)) == ["x y.parquet", "z.parquet"]
    assert names(collect_parquet_files(spark, root + "/SNV", recursive=False)) == ["x y.parquet"]
    with pytest.raises(FileNotFoundError):
        collect_parquet_files(spark, root + "/none")
    sizes = file_catalog(spark, root).groupBy().sum("size").first()[0]
    assert sizes == 30


def test_sources_are_named_once_for_each_file(spark, tmp_path, monkeypatch):
    """Equal names in two folders, and names that paths escape; rows only look their source up."""
    from varloom.functions import source_id
    from varloom.plans import jobs

    paths = [str(tmp_path / a / b) for a, b in (("x", "s.parquet"), ("y", "s.parquet"), ("z", "one two 100%.parquet"))]
    for i, path in enumerate(paths):
        spark.range(5).select(F.lit(str(i)).alias("n"), F.lit("SNV").alias("tsa"), F.lit("A").alias("alt")).repartition(2).write.parquet(path)
    seen = []
    monkeypatch.setattr(jobs, "split_pending", lambda df, out, **options: seen.append(df) or [])
    jobs.split_existing(spark, paths, str(tmp_path / "out"))
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract" not in plan
    of = lambda p: spark.createDataFrame([("file://" + p,)], "p string").select(source_id("p")).first()[0]
    names = ["s", "s", "one two 100%"]
    assert rows(seen[0], "n", "source_file", "source_id") == sorted((str(i), names[i], of(p)) for i, p in enumerate(paths) for _ in range(5))
