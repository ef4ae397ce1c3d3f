import pytest
from pyspark.sql import functions as F

from varloom import operators as op
from varloom.operators import skew

from .conftest import rows


def test_filter_loses_no_key_and_drops_most_others(spark):
    left = spark.range(0, 60_000, 3).select(F.col("id").alias("k"), F.when(F.col("id") % 7 != 0, F.col("id").cast("string")).alias("s"))
    right = spark.range(120_000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("s"), F.lit(1).alias("_x"))
    segments = op.filter_segments(20_000)
    assert segments > 1
    kept = op.bloom_reduce(right, left, ["k", "s"])
    got = {r["k"] for r in kept.collect()}
    wanted = {k for k in range(0, 60_000, 3) if k % 7}
    assert wanted <= got and len(got - wanted) < 0.03 * 120_000
    assert kept.columns == right.columns


def test_merged_filters_equal_one_filter(spark):
    df = spark.range(5000).select(F.col("id").alias("k"))
    parts = [op.key_bitmaps(df.filter(F.col("k") % 4 == i), ["k"], 3) for i in range(4)]
    union = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
    assert rows(op.merge_bitmaps(union)) == rows(op.key_bitmaps(df, ["k"], 3))


def test_size_of_the_filter():
    assert op.filter_segments(0) == 1
    assert op.filter_segments(10**6) == 306
    bounded = op.filter_segments(5 * 10**8, 256 << 20)
    assert bounded * 4096 == 256 << 20
    assert op.filter_segments(10**12) is None


@pytest.fixture
def tables(spark, tmp_path):
    """The left table and the stored reference, joined by shuffles where Spark has the choice."""
    spark.range(40_000).selectExpr("id AS k", "id * 2 AS v").write.parquet(str(tmp_path / "r"))
    left = spark.range(3000).selectExpr("CASE WHEN id % 10 > 0 THEN id * 20 END AS k", "id AS n")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield left, spark.read.parquet(str(tmp_path / "r"))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("how", ["left", "inner"])
def test_cohort_is_annotated_by_a_filter(tables, how):
    left, right = tables
    got = op.annotate(left, right, ["k"], how, semi_max_rows=100)
    plan = got._jdf.queryExecution().executedPlan().toString()
    # Above the scan of the reference stands the join with the broadcast filter, and only then an exchange.
    above = plan[: plan.index("FileScan parquet")]
    assert above.rindex("BroadcastHashJoin") > above.rindex("SortMergeJoin")
    assert "Exchange" not in above[above.rindex("BroadcastHashJoin") :]
    assert rows(got) == rows(op.annotate(left, right, ["k"], how, strategy="direct"))


def test_filter_is_refused_beyond_its_bounds(tables):
    left, right = tables
    with pytest.raises(ValueError):
        op.annotate(left, right, ["k"], strategy="bloom", bloom_max_bytes=1)
    with pytest.raises(ValueError):
        op.annotate(left.withColumn("k", F.col("k").cast("int")), right, ["k"], strategy="bloom")


def test_no_left_rows(tables):
    left, right = tables
    assert op.annotate(left.limit(0), right, ["k"], strategy="bloom").count() == 0


@pytest.mark.parametrize("limit", [1, 7, 50, 400])
def test_sketch_finds_the_same_heavy_keys_as_counting(spark, limit):
    """Keys of all frequencies, among them many just at the limit."""
    df = spark.range(20_000).select(
        F.when(F.col("id") % 11 > 0, F.floor(F.sqrt(F.col("id").cast("double"))).cast("int")).alias("a"),
        F.when(F.col("id") % 3 == 0, "x").otherwise((F.col("id") % 5).cast("string")).alias("b"),
    )
    exact = df.filter("a IS NOT NULL").groupBy(F.xxhash64("a", "b").alias("h")).count().filter(F.col("count") > limit)
    profile = op.profile_keys(df, ["a", "b"], limit)
    assert sorted(profile.heavy) == sorted(r["h"] for r in exact.collect())
    assert (profile.rows, profile.null_rows) == (20_000, df.filter("a IS NULL").count())


def test_sketch_hands_on_few_rows(spark):
    """A million different keys: what is shuffled has the size of the sketch, not of the table."""
    df = spark.range(0, 1_000_000, 1, 4).select(F.xxhash64("id").alias("k"))
    sketch = op.sketch_keys(df, ["k"], 1024)
    assert sketch.count() == 2048
    assert not op.profile_keys(df, ["k"], 100_000).heavy
    plan = sketch._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_count" in plan[plan.index("Exchange") :]


def test_sketches_add_up(spark):
    df = spark.range(4000).select((F.col("id") % 50).alias("k"))
    halves = op.sketch_keys(df.filter("k < 20"), ["k"], 64).union(op.sketch_keys(df.filter("k >= 20"), ["k"], 64))
    summed = halves.groupBy("line", "cell").agg(F.sum("n").alias("n"))
    assert rows(summed) == rows(op.sketch_keys(df, ["k"], 64))
    assert skew.CELLS >= 1
