import pytest
from pyspark.sql import functions as F

from varloom import operators as op
from varloom.operators.manifest import PUBLISH_SCHEMA

from .conftest import rows


@pytest.fixture(scope="module")
def local(spark):
    data = [("/l/a.vcf.gz", 100), ("/l/b.vcf.gz", 2048), ("/l/c.vcf.gz.tbi", 7), ("/old/b.vcf.gz", 1)]
    return spark.createDataFrame(data, "path string, size bigint")


@pytest.fixture(scope="module")
def remote(spark):
    data = [("https://h/a.vcf.gz", 100), ("https://h/b.vcf.gz", 1024), ("https://h/c.vcf.gz.tbi", None), ("https://h/d.vcf", 5)]
    return spark.createDataFrame(data, "url string, remote_size bigint")


def test_missing(spark, local, remote):
    assert rows(op.missing_locals(remote, local)) == [("https://h/d.vcf", "d.vcf")]
    declared = spark.createDataFrame([("/x",), ("/l/a.vcf.gz",)], "path string")
    assert rows(op.missing_paths(declared, local)) == [("/x",)]


def test_last_local_wins(local):
    by_path = {r["name"]: r["path"] for r in op.last_by_name(local).collect()}
    assert by_path["b.vcf.gz"] == "/old/b.vcf.gz"
    by_size = {r["name"]: r["path"] for r in op.last_by_name(local, "size").collect()}
    assert by_size["b.vcf.gz"] == "/l/b.vcf.gz"


def test_size_mismatches(local, remote):
    found = op.size_mismatches(remote, local, F.col("size")).collect()
    assert [tuple(r) for r in found] == [
        ("https://h/b.vcf.gz", "/l/b.vcf.gz", 2048, 1024, 1024, "/l/b.vcf.gz: local 2.0 KB vs remote 1.0 KB (+1024 B)")
    ]


def test_reconcile_collects_every_problem(spark, local, remote):
    parquet = spark.createDataFrame([("/l/a.parquet",)], "path string")
    catalog = local.select("path").filter("path <> '/l/a.vcf.gz'")
    problems = op.reconcile(remote, local, parquet, catalog)
    assert rows(problems, "severity", "kind", "name") == [
        ("error", "missing_local", "a.vcf.gz"),
        ("error", "missing_parquet", "a.parquet"),
        ("error", "no_local_for_url", "d.vcf"),
        ("error", "size_mismatch", "b.vcf.gz"),
        ("warning", "fewer_parquets_than_vcfs", "dataset"),
        ("warning", "remote_size_unknown", "c.vcf.gz.tbi"),
    ]
    with pytest.raises(ValueError, match="4 problems"):
        op.raise_on_errors(problems)
    op.raise_on_errors(problems.filter("severity = 'warning'"))


def test_no_outputs_are_accepted(spark, local, remote):
    none = spark.createDataFrame([], "path string")
    assert op.convert_count_check(local, none).first()["short"] is False
    kinds = {r["kind"] for r in op.reconcile(remote, local, none, local).collect()}
    assert "fewer_parquets_than_vcfs" not in kinds and "missing_parquet" not in kinds


def test_publish_plan(spark):
    files = spark.createDataFrame([("/d/SNV/a.parquet", 1), ("/d/b.parquet", 2), ("/e/c.parquet", 3)], "path string, size bigint")
    local = op.publish_paths(op.require_parquet(files), "/d")
    remote = spark.createDataFrame([("data/SNV/a.parquet", 1), ("data/b.parquet", 9), ("data/gone.parquet", 4)], "path_in_repo string, size bigint")
    plan = op.sync_plan(local, remote)
    assert [(f.name, f.dataType) for f in plan.schema] == [(f.name, f.dataType) for f in PUBLISH_SCHEMA]
    assert rows(plan) == [
        ("/d/SNV/a.parquet", "data/SNV/a.parquet", False, "size_match", 1, 1),
        ("/d/b.parquet", "data/b.parquet", True, "size_differs", 2, 9),
        ("/e/c.parquet", "data/c.parquet", True, "new_file", 3, None),
    ]
    assert tuple(op.sync_summary(plan).first()) == (3, 2, 1)
    assert rows(op.sync_reasons(plan)) == [("new_file", 1, 3), ("size_differs", 1, 2), ("size_match", 1, 1)]
    assert op.publish_paths(files).first()["path_in_repo"] == "data/a.parquet"


def test_only_parquet_is_published(spark):
    files = spark.createDataFrame([("/a.vcf",), ("/b.parquet",)], "path string")
    with pytest.raises(ValueError, match="a.vcf"):
        op.require_parquet(files)


def test_dataset_stats(spark):
    files = spark.createDataFrame([("/d/SNV/a", 2**30), ("/d/indel/b", 2**29), ("/d/README", 10)], "path string, size bigint")
    assert tuple(op.dataset_stats(files, "/d").first()) == (3, 2**30 + 2**29 + 10, 1.5, ["SNV", "indel"])
    assert rows(op.variant_types_present(files, "/d")) == [("SNV",), ("indel",)]
    assert tuple(op.dataset_stats(files.limit(0), "/d").first()) == (0, 0, 0.0, [])


def test_split_completeness(spark):
    paths = lambda *p: spark.createDataFrame([(x,) for x in p], "path string")
    recorded = spark.createDataFrame([("/a.parquet", "/s/1"), ("/a.parquet", "/s/2")], "path string, split_path string")
    found = op.split_completeness(
        paths("/a.parquet", "/b.parquet", "/c.parquet", "/d.vcf"), paths("/a.parquet", "/b.parquet"), recorded, paths("/s/1")
    )
    assert rows(found) == [
        ("missing_input", "c.parquet", "/c.parquet"),
        ("missing_split", "a.parquet", "/s/2"),
        ("no_splits", "b.parquet", "/b.parquet"),
    ]
