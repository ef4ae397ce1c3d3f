import random

import pytest
from pyspark.sql import functions as F

from varloom.sources import in_touched_files, range_table, row_groups, touched, within_range_table
from varloom.sources import ranges as module

from .conftest import rows

VARIANTS = "chrom string, start long"


@pytest.fixture
def stored(spark, tmp_path):
    def store(df, name="t"):
        path = str(tmp_path / name)
        df.write.parquet(path)
        return spark.read.parquet(path)

    return store


def test_stretches_hold_all_positions(spark):
    data = [("1", 5), ("1", 9), ("1", 70_000), ("ctg", 2**40), (None, 3), ("2", None)]
    got = rows(range_table(spark.createDataFrame(data, VARIANTS)))
    assert got == [("1", 0, 5, 9), ("1", 1, 70_000, 70_000), ("ctg", 2**24, 2**40, 2**40)]


def test_rows_within_stretches_match_brute_force(spark, stored):
    rng = random.Random(2)
    panel = [(rng.choice("123"), rng.randrange(300_000)) for _ in range(20)]
    known = [(rng.choice("1234"), rng.randrange(400_000)) for _ in range(5000)] + [(None, 5)]
    ranges = stored(range_table(spark.createDataFrame(panel, VARIANTS)))
    reference = spark.createDataFrame(known, VARIANTS)
    stretch = {}
    for c, s in panel:
        stretch.setdefault((c, s // module.BIN), []).append(s)
    expected = [(c, s) for c, s in known if (c, s // module.BIN) in stretch and min(stretch[c, s // module.BIN]) <= s <= max(stretch[c, s // module.BIN])]
    found = within_range_table(reference, ranges)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan
    assert rows(found) == sorted(expected, key=repr)
    assert within_range_table(reference, ranges.limit(0)).count() == 0


def test_many_stretches_are_not_broadcast(spark, stored, monkeypatch):
    monkeypatch.setattr(module, "BROADCAST_RANGES", 2)
    ranges = stored(range_table(spark.createDataFrame([("1", i * 10**6) for i in range(1, 6)], VARIANTS)))
    reference = spark.createDataFrame([("1", 5), ("1", 2_500_000), ("9", 3_000_000)], VARIANTS)
    assert rows(within_range_table(reference, ranges)) == [("1", 2_500_000), ("9", 3_000_000)]


def test_touched_row_groups_match_brute_force(spark):
    rng = random.Random(5)
    groups = []
    for i in range(300):
        lo = rng.randrange(2**34)
        chrom = rng.choice("12")
        groups.append((f"f{i // 3}", i % 3, 10, chrom, chrom, lo, lo + rng.choice([0, 1, 2**16, 2**20, 2**23, 2**30])))
    groups += [("mixed", 0, 10, "1", "2", 0, 5), ("unknown", 0, 10, None, None, None, None)]
    schema = "path string, row_group int, n_rows long, first_chrom string, last_chrom string, lo long, hi long"
    panel = [(rng.choice("12"), rng.randrange(2**34)) for _ in range(60)]
    got = touched(spark.createDataFrame(groups, schema), range_table(spark.createDataFrame(panel, VARIANTS))).collect()
    expected = {(g[0], g[1]) for g in groups if g[5] is None or g[3] != g[4] or any(c == g[3] and g[5] <= s <= g[6] for c, s in panel)}
    assert len(got) == len(expected) and {(r["path"], r["row_group"]) for r in got} == expected


@pytest.mark.parametrize("partitioned", [False, True])
def test_only_touched_files_are_read(spark, stored, tmp_path, partitioned):
    known = spark.range(20_000).select((F.col("id") % 2 + 1).cast("string").alias("chrom"), (F.col("id") * 100).alias("start"), F.col("id").alias("x"))
    writer = known.repartitionByRange(20, "chrom", "start").sortWithinPartitions("chrom", "start").write
    path = str(tmp_path / "ref erence")
    (writer.partitionBy("chrom") if partitioned else writer).parquet(path)
    reference = spark.read.schema("chrom string, start long, x long").parquet(path).filter("x > 3")
    panel = [("1", 200_000), ("2", 1_000_100)]
    ranges = stored(range_table(spark.createDataFrame(panel, VARIANTS)), "ranges")
    found = in_touched_files(reference, ranges)
    assert rows(within_range_table(found, ranges), "chrom", "start", "x") == [("1", 200_000, 2000), ("2", 1_000_100, 10_001)]
    read = found.select(F.col("_metadata.file_path").alias("p")).distinct().count()
    assert read <= 4 < len(reference.inputFiles())
    assert row_groups(spark.createDataFrame([(p,) for p in reference.inputFiles()], "path string")).agg(F.sum("n_rows")).first()[0] == 20_000
    # Without stretches only files of several chromosomes stay.
    assert in_touched_files(reference, ranges.limit(0)).count() <= 1_000
