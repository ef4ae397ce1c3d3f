import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from varloom import operators as op
from varloom.schema import KEYS

from .conftest import rows

LEFT = "chrom string, start bigint, ref string, alt string, id string, n int"
RIGHT = "chrom string, start bigint, ref string, alt string, id string, score double"


@pytest.fixture(scope="module")
def left(spark):
    data = [
        ("1", 10, "A", "C", "x", 1),
        ("1", 10, "A", "C", "x", 2),
        ("1", 20, "G", "T", None, 3),
        (None, 30, "A", "C", "y", 4),
        ("X", 40, "A", "C|G", "z", 5),
    ]
    return spark.createDataFrame(data, LEFT)


@pytest.fixture(scope="module")
def right(spark):
    data = [
        ("1", 10, "A", "C", "rs1", 0.5),
        ("1", 10, "A", "C", "rs2", 0.6),
        (None, 30, "A", "C", "rs3", 0.7),
        ("X", 40, "A", "C", "rs4", 0.8),
    ]
    return spark.createDataFrame(data, RIGHT)


EXPECTED = [
    ("1", 10, "A", "C", "x", 1, "rs1", 0.5),
    ("1", 10, "A", "C", "x", 1, "rs2", 0.6),
    ("1", 10, "A", "C", "x", 2, "rs1", 0.5),
    ("1", 10, "A", "C", "x", 2, "rs2", 0.6),
    ("1", 20, "G", "T", None, 3, None, None),
    (None, 30, "A", "C", "y", 4, None, None),
    ("X", 40, "A", "C|G", "z", 5, None, None),
]


@pytest.mark.parametrize("strategy", ["auto", "semi", "direct"])
@pytest.mark.parametrize("skew, rows_per_slice", [(None, 10), ("auto", 1_000_000), ("auto", 1)])
def test_left_join(left, right, strategy, skew, rows_per_slice):
    df = op.annotate(left, right, strategy=strategy, skew=skew, rows_per_slice=rows_per_slice)
    assert df.columns == ["chrom", "start", "ref", "alt", "id", "n", "id_ensembl", "score"]
    assert rows(df) == sorted(EXPECTED, key=repr)


@pytest.mark.parametrize("strategy", ["semi", "direct"])
@pytest.mark.parametrize("rows_per_slice", [1, 1000])
def test_inner_join(left, right, strategy, rows_per_slice):
    df = op.annotate(left, right, how="inner", strategy=strategy, rows_per_slice=rows_per_slice)
    assert rows(df) == sorted(EXPECTED[:4], key=repr)


def test_custom_keys_suffix_other_keys(left, right):
    df = op.annotate(left, right, on=["chrom", "start"], suffix="_r")
    assert df.columns == ["chrom", "start", "ref", "alt", "id", "n", "ref_r", "alt_r", "id_r", "score"]
    assert ("X", 40, "A", "C|G", "z", 5, "A", "C", "rs4", 0.8) in rows(df)


def test_suffix_ignores_case_and_detects_clashes(left, right):
    assert op.annotate(left, right.withColumnRenamed("id", "ID")).columns[-2:] == ["ID_ensembl", "score"]
    with pytest.raises(ValueError, match="collide"):
        op.annotate(left, right.withColumn("id_ensembl", F.lit(1)))


def test_without_reference(left, right):
    assert op.annotate(left, None) is left
    wide = op.annotate(left, None, always_add_columns=True, reference_schema=right.schema)
    assert dict(wide.dtypes)["score"] == "double" and wide.columns[-2:] == ["id_ensembl", "score"]
    assert wide.filter("score IS NOT NULL OR id_ensembl IS NOT NULL").isEmpty() and wide.count() == 5


def test_empty_reference_frame_keeps_rows(left, right):
    df = op.annotate(left, right.limit(0))
    assert df.count() == 5 and df.filter("score IS NOT NULL").isEmpty()


def test_normalising_options(spark, right):
    left = spark.createDataFrame([("chrX", 40, "A", "C|G", "z", 5)], LEFT)
    assert op.annotate(left, right).filter("score IS NOT NULL").isEmpty()
    df = op.annotate(left, right, strip_chr_prefix=True, explode_alt=True)
    assert rows(df, "chrom", "alt", "id_ensembl") == [("X", "C", "rs4"), ("X", "G", None)]


def test_bad_arguments(left, right):
    for options in ({"how": "outer"}, {"strategy": "x"}, {"skew": "x"}):
        with pytest.raises(ValueError):
            op.annotate(left, right, **options)


def brute_force(left_rows, right_rows):
    by_key = defaultdict(list)
    for k, v in right_rows:
        if k is not None:
            by_key[k].append(v)
    out = []
    for k, v in left_rows:
        out += [(k, v, w) for w in by_key.get(k, [])] or [(k, v, None)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot", ["left", "right", "both", "null"])
@pytest.mark.parametrize("strategy", ["semi", "direct"])
def test_hot_keys_against_brute_force(spark, hot, strategy):
    """A third of the rows, all equal, share one key on one side or both; another third has none."""
    rng = random.Random(7)

    def side(is_hot, n):
        data = [(rng.randrange(40), i) for i in range(n)]
        return data + ([(1000, -1)] * (n // 2) if is_hot else [(1000, -1)])

    n = 60 if hot == "both" else 300
    left_rows = side(hot in ("left", "both"), n)
    right_rows = side(hot in ("right", "both"), n if hot != "left" else 30)
    if hot == "null":
        left_rows += [(None, i) for i in range(200)]
        right_rows += [(None, i) for i in range(50)]
    left_rows.append((2000, 0))
    left = spark.createDataFrame(left_rows, "k bigint, v bigint").repartition(3)
    right = spark.createDataFrame(right_rows, "k bigint, w bigint").repartition(2)
    # Written, as the docs ask of inputs whose rows are dealt by position.
    df = op.annotate(left, right, on=["k"], strategy=strategy, rows_per_slice=20)
    assert rows(df, "k", "v", "w") == brute_force(left_rows, right_rows)


def test_hot_keys_are_dealt_over_partitions(spark):
    """The slices of one key reach several join tasks."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(4000).select(F.lit(5).cast("bigint").alias("k"), "id")
        right = spark.range(10).select(F.col("id").alias("k"), F.lit("x").alias("w"))
        df = op.annotate(left, right, on=["k"], strategy="direct", rows_per_slice=200)
        sizes = df.groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) >= 4 and max(r["count"] for r in sizes) < 3000
        assert df.count() == 4000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_profile_finds_heavy_keys(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 100).alias("k"))
    profile = op.profile_keys(df, ["k"], 500)
    assert profile.rows == 3000 and profile.null_rows == 0 and len(profile.heavy) == 1
    heavy = op.heavy_keys(df, df, ["k"], profile, None, 500).collect()
    assert [tuple(r) for r in heavy] == [(7, 2, 1)]


def test_semi_strategy_does_not_shuffle_the_reference(spark, left, tmp_path):
    path = str(tmp_path / "ref")
    data = [("1", i, "A", "C", f"rs{i}", 1.0) for i in range(1000)]
    spark.createDataFrame(data, RIGHT).write.parquet(path)
    reduced = op.semi_reduce(spark.read.parquet(path), left, KEYS)
    plan = reduced._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    # The only exchanges belong to the small left side.
    assert "SortMergeJoin" not in plan and plan.index("FileScan parquet") < plan.index("BroadcastExchange")
    assert reduced.columns == list(RIGHT.replace(",", "").split())[::2] and reduced.count() == 1


def test_key_types_that_differ(spark, left, right):
    """Hashes of an int and a bigint differ, so such keys are compared by value."""
    narrow = left.withColumn("start", F.col("start").cast("int"))
    with pytest.raises(ValueError):
        op.annotate(narrow, right, strategy="semi")
    df = op.annotate(narrow, right)
    assert "LeftSemi" not in df._jdf.queryExecution().executedPlan().toString()
    assert rows(df) == sorted(EXPECTED, key=repr)


def test_match_rate_counts_input_rows_once(left, right):
    total = op.match_rate(left, right).first()
    assert (total["total"], total["matched"], total["joined"]) == (5, 2, 4)
    assert (total["match_rate"], total["joined_rate"]) == (40.0, 80.0)
    by = {r["chrom"]: r for r in op.match_rate(left, right, by=["chrom"]).collect()}
    assert by["1"]["match_rate"] == 66.67 and by[None]["matched"] == 0
    empty = op.match_rate(left.limit(0), right).first()
    assert empty["total"] == 0 and empty["match_rate"] is None


def test_bucketed_reference_is_not_shuffled(spark, left, right, tmp_path):
    from varloom.plans import build_bucketed_reference

    build_bucketed_reference(right, "bucketed_reference", 4, path=str(tmp_path / "b"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = op.annotate(left, spark.table("bucketed_reference"), strategy="direct")
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" in plan
        assert rows(df) == sorted(EXPECTED, key=repr)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE bucketed_reference")


def test_semi_is_refused_beyond_its_bounds(left, right):
    with pytest.raises(ValueError):
        op.annotate(left, right, strategy="semi", semi_max_rows=1)
    df = op.annotate(left, right, semi_max_rows=1, semi_min_ratio=0)
    assert "LeftSemi" not in df._jdf.queryExecution().executedPlan().toString()
    assert rows(df) == sorted(EXPECTED, key=repr)


def test_every_heavy_key_is_found(spark):
    """More heavy keys than any sketch would track."""
    df = spark.range(30_000).select((F.col("id") % 3000).alias("k"))
    assert len(op.profile_keys(df, ["k"], 9).heavy) == 3000
    assert not op.profile_keys(df, ["k"], 10).heavy


def test_dealt_input_is_repeatable(spark, tmp_path):
    """Rows that come out of a shuffle are written before they are dealt by their position."""
    from varloom.operators.skew import repeatable

    spark.range(100).write.parquet(str(tmp_path / "p"))
    scan = spark.read.parquet(str(tmp_path / "p")).filter("id > 3")
    assert repeatable(scan) is scan
    shuffled = scan.groupBy((F.col("id") % 7).alias("k")).count()
    written = repeatable(shuffled)
    assert written is not shuffled and rows(written) == rows(shuffled)
    assert "Relation" in written._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("narrow", [False, True])
def test_heavy_keys_beyond_the_broadcast_do_not_reach_the_driver(spark, monkeypatch, how, narrow):
    """Hundreds of heavy keys on both sides, one much heavier, and null keys."""
    from varloom.operators import skew

    monkeypatch.setattr(skew, "BROADCAST_KEYS", 20)
    left_rows = [(i % 300, i) for i in range(3000)] + [(7, -i) for i in range(1, 400)] + [(None, i) for i in range(50)] + [(900, 1)]
    right_rows = [(i % 310, i) for i in range(1500)] + [(None, 5)]
    left = spark.createDataFrame(left_rows, f"k {'int' if narrow else 'bigint'}, v bigint")
    right = spark.createDataFrame(right_rows, "k bigint, w bigint")
    collect, sizes = type(left).collect, []

    def counted(df):
        found = collect(df)
        sizes.append(len(found) + sum(len(x) for r in found for x in r if isinstance(x, list)))
        return found

    monkeypatch.setattr(type(left), "collect", counted)
    df = op.annotate(left, right, on=["k"], how=how, strategy="direct", rows_per_slice=3)
    assert max(sizes, default=0) <= 20
    monkeypatch.undo()
    expected = [r for r in brute_force(left_rows, right_rows) if how == "left" or r[2] is not None]
    assert rows(df, "k", "v", "w") == expected


def test_semi_without_a_bound_takes_any_number_of_rows(left, right, monkeypatch):
    """More left rows than hashes are broadcast for: the whole table is annotated, by the same strategy."""
    import sys

    monkeypatch.setattr(sys.modules["varloom.operators.annotate"], "SEMI_MAX_ROWS", 2)
    for rows_per_slice in (1, 1000):
        df = op.annotate(left, right, strategy="semi", semi_max_rows=None, rows_per_slice=rows_per_slice)
        assert rows(df) == sorted(EXPECTED, key=repr)
    reduced = op.semi_reduce(right.select("id", "score", *KEYS), left, KEYS, None)
    assert reduced.columns == ["id", "score", *KEYS] and rows(reduced, "id") == [("rs1",), ("rs2",)]


def test_buckets_grow_with_the_reference(spark, right, tmp_path, monkeypatch):
    from varloom.plans import build_bucketed_reference, jobs

    monkeypatch.setattr(jobs, "ROWS_PER_BUCKET", 100)
    known = spark.range(2_000).select(F.lit("1").alias("chrom"), F.col("id").alias("start"), F.lit("A").alias("ref"), F.lit("C").alias("alt"))
    for name, df, buckets in (("many_rows", known, 20), ("few_rows", right, jobs.LEAST_BUCKETS)):
        build_bucketed_reference(df, name, None, path=str(tmp_path / name))
        try:
            assert f"{buckets} buckets" in spark.sql(f"DESCRIBE EXTENDED {name}").selectExpr("concat(data_type, ' buckets') AS b", "col_name").where("col_name = 'Num Buckets'").first()["b"]
            assert rows(spark.table(name)) == rows(df)
        finally:
            spark.sql(f"DROP TABLE {name}")
