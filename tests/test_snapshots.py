import pytest
from pyspark.sql import functions as F

from varloom.sources import newest_version, read_snapshot, write_snapshot
from varloom.sources import snapshots as module
from varloom.sources.storage import _hadoop_path

from .conftest import rows


def frame(spark, *data):
    return spark.createDataFrame(list(data), "k string, n int")


@pytest.mark.parametrize("by", [[], ["k"]])
def test_versions_add_and_replace(spark, tmp_path, by):
    table = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, table)
    assert write_snapshot(frame(spark, ("1", 1), ("X", 2), (None, 3)), table, by) == 1
    first = read_snapshot(spark, table)
    assert write_snapshot(frame(spark, ("1", 10), ("2", 20)), table, by) == 2
    assert rows(read_snapshot(spark, table)) == sorted([("1", 1), ("X", 2), (None, 3), ("1", 10), ("2", 20)], key=repr)
    assert write_snapshot(frame(spark, ("1", 100), (None, 300)), table, by, replace="partitions" if by else "all") == 3
    expected = [("1", 100), (None, 300)] + ([("X", 2), ("2", 20)] if by else [])
    assert rows(read_snapshot(spark, table)) == sorted(expected, key=repr)
    assert first.columns == ["k", "n"] and first.schema["k"].dataType.simpleString() == "string"
    assert rows(first) == rows(read_snapshot(spark, table, 1)) == sorted([("1", 1), ("X", 2), (None, 3)], key=repr)
    write_snapshot(frame(spark), table, by, replace="all")
    assert read_snapshot(spark, table).count() == 0


def test_a_failed_write_is_invisible(spark, tmp_path):
    table = str(tmp_path / "t")
    write_snapshot(frame(spark, ("a", 1)), table)
    broken = spark.range(1000).select(F.lit("b").alias("k"), F.when(F.col("id") > 900, F.raise_error("no").cast("int")).otherwise(1).alias("n"))
    with pytest.raises(Exception):
        write_snapshot(broken, table)
    assert rows(read_snapshot(spark, table)) == [("a", 1)]
    # A version whose writer died while it wrote the list is passed over, and its number is not used again.
    fs, path = _hadoop_path(spark, f"{table}/versions/{2:012d}")
    fs.create(path, False).close()
    assert newest_version(spark, table)[0] == 1 and rows(read_snapshot(spark, table)) == [("a", 1)]
    assert write_snapshot(frame(spark, ("c", 2)), table) == 3
    assert rows(read_snapshot(spark, table)) == [("a", 1), ("c", 2)]


def test_writers_at_the_same_time_both_count(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "t")
    write_snapshot(frame(spark, ("a", 1)), table)
    claim, state = module._claim, {"other": True}

    def late(spark_, table_, version, content):
        if state.pop("other", False):
            write_snapshot(frame(spark, ("other", 2)), table)
        return claim(spark_, table_, version, content)

    monkeypatch.setattr(module, "_claim", late)
    assert write_snapshot(frame(spark, ("mine", 3)), table) == 3
    assert rows(read_snapshot(spark, table)) == [("a", 1), ("mine", 3), ("other", 2)]
