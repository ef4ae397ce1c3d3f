import gzip
import random

import pytest
from pyspark.sql import functions as F

from varloom.schema import InfoField
from varloom.sources import file_catalog, index_windows, read_vcf, read_vcf_regions, region_pieces, within_regions, write_indexed_vcf
from varloom.sources.blocks import read_pieces

from .conftest import rows

HEADER = ["##fileformat=VCFv4.2", '##INFO=<ID=N,Number=1,Type=Integer,Description="n">', "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"]
FIELDS = [InfoField("N", "1", "Integer")]
REGIONS = "chrom string, first long, last long"


def lines(n, seed=3):
    rng = random.Random(seed)
    for i in range(n):
        start = rng.choice([rng.randrange(1, 400_000), rng.randrange(1, 3_000_000), 16384 * rng.randrange(1, 20)])
        ref = "A" * rng.choice([1, 1, 1, 2, 300])
        info = f"N={i};X={rng.random()}"
        if rng.random() < 0.02:
            info = f"END={start + rng.randrange(2_000_000)};" + info
        yield f"{rng.choice(['1', '1', '2', 'X', 'chrUn_7'])}\t{start}\t.\t{ref}\tC\t.\tPASS\t{info}"


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("indexed") / "vcf")
    text = spark.createDataFrame([(x,) for x in lines(60_000)], "value string")
    done = write_indexed_vcf(text, folder, HEADER, rows_per_file=25_000)
    assert sorted(r["n_rows"] for r in done.collect())[0] > 0 and done.count() == 3
    return folder


def test_written_files_are_gzip_and_whole(spark, written):
    found = []
    for r in file_catalog(spark, written, r"\.vcf\.gz$").collect():
        with gzip.open(r["path"].removeprefix("file:"), "rt") as f:
            text = f.read().splitlines()
        assert text[:3] == HEADER
        found += text[3:]
    assert sorted(found) == sorted(lines(60_000))


def test_regions_equal_a_full_scan(spark, written):
    rng = random.Random(5)
    whole = read_vcf(spark, f"{written}/*.vcf.gz", FIELDS).cache()
    assert whole.count() == 60_000
    data = whole.collect()
    cases = [
        [("1", 100_000, 100_500)],
        [("1", 16385, 16385), ("1", 16384, 16384), ("2", 32768, 32769)],
        [("X", None, None), ("2", 2_900_000, None), ("chrUn_7", None, 5000)],
        [(rng.choice("12X"), a, a + rng.randrange(3000)) for a in (rng.randrange(400_000) for _ in range(40))],
        [("nowhere", 1, 10), (None, 1, 10), ("1", 9, 3), ("1", -5, 2**40)],
    ]
    for case, split_bytes in zip(cases, [2**24, 50_000, 50_000, 2**24, 2**24]):
        expected = [r for r in data if any(c == r["chrom"] and (a or 1) <= r["start"] <= (b or 2**60) for c, a, b in case if c)]
        got = read_vcf_regions(spark, written, spark.createDataFrame(case, REGIONS), FIELDS, split_bytes=split_bytes)
        assert rows(got) == sorted(map(tuple, expected), key=repr)


def test_few_bytes_are_read(spark, written):
    files = file_catalog(spark, written, r"\.vcf\.gz$").select("path", "size")
    pieces = region_pieces(files, spark.createDataFrame([("2", 350_000, 351_000)], REGIONS))
    size = files.agg(F.sum("size")).first()[0]
    assert pieces.agg(F.sum(F.col("stop") - F.col("start"))).first()[0] < size / 20
    assert region_pieces(files, spark.createDataFrame([("9", 1, 10)], REGIONS)).count() == 0


def test_pieces_hold_each_record_once(spark, written):
    files = file_catalog(spark, written, r"\.vcf\.gz$").select("path", "size")
    everything = spark.createDataFrame([(c, None, None) for c in ("1", "2", "X", "chrUn_7")], REGIONS)
    for split_bytes in (2**24, 30_000):
        read = read_pieces(region_pieces(files, everything, split_bytes), 4)
        assert sorted(r["value"] for r in read.collect()) == sorted(lines(60_000))


def test_files_without_an_index_are_read_whole(spark, tmp_path):
    folder = tmp_path / "plain"
    folder.mkdir()
    (folder / "a.vcf").write_text("\n".join([*HEADER, "1\t5\t.\tA\tC\t.\t.\tN=1", "2\t5\t.\tA\tC\t.\t.\tN=2"]) + "\n")
    got = read_vcf_regions(spark, str(folder), spark.createDataFrame([("2", 1, 9)] * 2, REGIONS))
    assert rows(got, "chrom", "n") == [("2", 2)]


def test_a_wrong_index_raises(spark, tmp_path):
    (tmp_path / "a.vcf.gz").write_bytes(gzip.compress(b"x"))
    (tmp_path / "a.vcf.gz.tbi").write_bytes(gzip.compress(b"no index"))
    files = file_catalog(spark, str(tmp_path), r"\.vcf\.gz$")
    with pytest.raises(Exception, match="not an index"):
        index_windows(files).collect()


def test_rows_in_overlapping_regions_occur_once(spark):
    df = spark.createDataFrame([("1", 5), ("1", 5), ("1", 20_000), ("2", 5), (None, 5), ("1", None)], "chrom string, start long")
    regions = spark.createDataFrame([("1", 1, 10), ("1", 5, 30_000), ("1", 5, 5)], REGIONS)
    assert rows(within_regions(df, regions)) == [("1", 20_000), ("1", 5), ("1", 5)]


def test_lines_are_made_once(spark, tmp_path):
    """Counting, choosing the ranges and dealing read a stored copy of the lines."""
    made = spark.sparkContext.accumulator(0)

    def make(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    text = spark.createDataFrame([(x,) for x in lines(3000)], "value string").mapInArrow(make, "value string")
    done = write_indexed_vcf(text, str(tmp_path / "once"), HEADER, rows_per_file=1000)
    assert done.agg(F.sum("n_rows")).first()[0] == made.value == 3000
