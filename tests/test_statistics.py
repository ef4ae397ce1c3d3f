from pyspark.sql import functions as F

from varloom.plans import file_states, merged_statistics, refresh_statistics

from .conftest import rows

SCHEMA = "chrom string, start long, ref string, alt string, tsa string"


def variants(spark, begin, end):
    return spark.range(begin, end).selectExpr(
        "CAST(id % 3 AS string) AS chrom", "id * 10 AS start", "'A' AS ref", "'C' AS alt", "CASE WHEN id % 4 > 0 THEN 'SNV' ELSE 'indel' END AS tsa"
    )


def test_two_waves_equal_a_full_pass(spark, tmp_path):
    data, state, full = (str(tmp_path / n) for n in ("data", "state", "full"))
    variants(spark, 0, 3000).repartition(3).write.partitionBy("tsa").parquet(data)
    first = refresh_statistics(spark, data, state)
    assert first == 6 and refresh_statistics(spark, data, state) == 0
    variants(spark, 2000, 6000).repartition(2).write.mode("append").partitionBy("tsa").parquet(data)
    assert refresh_statistics(spark, data, state) == 4
    assert refresh_statistics(spark, data, full) == 10
    merged = merged_statistics(spark, data, state)
    assert rows(merged) == rows(merged_statistics(spark, data, full))
    got = {r["variant_type"]: r for r in merged.collect()}
    assert (got["SNV"]["n_rows"], got["indel"]["n_rows"]) == (5250, 1750)
    assert (got["SNV"]["first_start"], got["SNV"]["last_start"], got["SNV"]["n_files"]) == (10, 59_990, 5)
    assert abs(got["SNV"]["n_keys"] - 4500) < 100 and abs(got["indel"]["n_keys"] - 1500) < 50


def test_changed_and_removed_files(spark, tmp_path):
    data, state = str(tmp_path / "data"), str(tmp_path / "state")
    variants(spark, 0, 100).coalesce(1).write.parquet(f"{data}/a")
    variants(spark, 100, 200).coalesce(1).write.parquet(f"{data}/b")
    assert refresh_statistics(spark, data, state) == 2
    variants(spark, 500, 530).coalesce(1).write.mode("overwrite").parquet(f"{data}/b")
    # The old file is gone at once, the new one counts after the next refresh.
    assert merged_statistics(spark, data, state).agg(F.sum("n_rows")).first()[0] == 100
    assert refresh_statistics(spark, data, state) == 1
    assert merged_statistics(spark, data, state).agg(F.sum("n_rows")).first()[0] == 130


def test_no_rows_and_repeated_states(spark, tmp_path):
    data, state = str(tmp_path / "data"), str(tmp_path / "state")
    spark.createDataFrame([], SCHEMA).write.parquet(data)
    assert merged_statistics(spark, data, state).count() == 0
    files = refresh_statistics(spark, data, state)
    assert refresh_statistics(spark, data, state) == 0 and files <= 1
    variants(spark, 0, 40).coalesce(1).write.mode("append").parquet(data)
    assert refresh_statistics(spark, data, state) == 1
    spark.read.parquet(state).write.mode("append").parquet(state + "2")
    spark.read.parquet(state).write.mode("append").parquet(state + "2")
    assert rows(merged_statistics(spark, data, state + "2")) == rows(merged_statistics(spark, data, state))


def test_states_of_a_table(spark, tmp_path):
    variants(spark, 0, 8).coalesce(1).write.parquet(str(tmp_path / "t"))
    got = file_states(spark.read.parquet(str(tmp_path / "t"))).collect()
    assert sorted((r["variant_type"], r["n_rows"]) for r in got) == [("SNV", 6), ("indel", 2)]
