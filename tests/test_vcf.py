import gzip
import random
import struct
import zlib

import pytest

from varloom.schema import CORE_SCHEMA, InfoField
from varloom.sources import (
    header_info,
    header_lines,
    merge_info,
    parse_lines,
    read_info_fields,
    read_vcf,
    vcf_to_parquet,
)
from varloom.sources.blocks import block_splits, read_block_lines

from .conftest import rows

HEADER = [
    "##fileformat=VCFv4.2",
    '##FILTER=<ID=PASS,Description="All filters passed">',
    '##INFO=<ID=END,Number=1,Type=Integer,Description="End, of the \\"variant\\"">',
    '##INFO=<ID=AF,Number=A,Type=Float,Description="Allele frequency">',
    "##INFO=<ID=DB>",
    '##INFO=<ID=TSA,Number=1,Type=String,Description="Type">',
    '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">',
    "##contig=<ID=1,length=248956422>",
    "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tdefault",
]
RECORDS = [
    "1\t10009\t.\tA\tAC\t0\tRefCall\t.\tGT:GQ\t0/0:27",
    "1\t10015\trs5\tACG\tG,T\t55.8\tPASS\tAF=0.1,0.2;TSA=SNV;DB=1\tGT:GQ\t0/1:35",
    "X\t20\t.\tN\t<DEL>\t.\t.\tEND=90;TSA=deletion\tGT\t./.",
    "MT\t7\t.\tT\t.\t3\tq10;s50\tDB=.\tGT\t./.",
]
EXPECTED = [
    ("1", 10009, 10009, None, "A", "AC", 0.0, "RefCall", None, None, None, None),
    ("1", 10015, 10017, "rs5", "ACG", "G|T", 55.8, "PASS", None, [0.1, 0.2], ["1"], "SNV"),
    ("MT", 7, 7, None, "T", None, 3.0, "q10;s50", None, None, None, None),
    ("X", 20, 90, None, "N", "<DEL>", None, None, 90, None, None, "deletion"),
]


def text(end="\n", last=True):
    return end.join(HEADER + RECORDS) + (end if last else "")


def bgzf(data: bytes, block: int = 300) -> bytes:
    """Block-gzip bytes, with the empty block that ends such files."""
    out = b""
    for chunk in [data[i : i + block] for i in range(0, len(data), block)] + [b""]:
        squeeze = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = squeeze.compress(chunk) + squeeze.flush()
        head = b"\x1f\x8b\x08\x04" + bytes(6) + struct.pack("<H", 6) + b"BC\x02\x00" + struct.pack("<H", len(body) + 25)
        out += head + body + struct.pack("<II", zlib.crc32(chunk), len(chunk))
    return out


@pytest.fixture(scope="module")
def landed(tmp_path_factory):
    root = tmp_path_factory.mktemp("landing")
    (root / "plain.vcf").write_bytes(text().encode())
    (root / "crlf.vcf").write_bytes(text("\r\n", last=False).encode())
    (root / "packed.vcf.gz").write_bytes(gzip.compress(text().encode()))
    half = len(text()) // 2
    members = gzip.compress(text()[:half].encode()) + gzip.compress(text()[half:].encode())
    (root / "members.vcf.gz").write_bytes(members)
    (root / "blocks.vcf.gz").write_bytes(bgzf(text().encode(), 60))
    (root / "blocks.vcf.bgz").write_bytes(bgzf(text("\r\n").encode(), 60))
    (root / "not blocks.vcf.bgz").write_bytes(gzip.compress(text().encode()))
    return root


@pytest.mark.parametrize("name", ["plain.vcf", "crlf.vcf", "packed.vcf.gz", "members.vcf.gz", "blocks.vcf.gz", "blocks.vcf.bgz"])
def test_read_vcf_gives_the_same_rows_for_every_packing(spark, landed, name):
    df = read_vcf(spark, str(landed / name))
    assert df.columns[:8] == ["chrom", "start", "end", "id", "ref", "alt", "qual", "filter"]
    assert df.columns[8:] == ["info_end", "af", "db", "tsa"]
    assert rows(df) == EXPECTED


def test_gz_read_as_blocks(spark, landed):
    df = read_vcf(spark, str(landed / "blocks.vcf.gz"), bgzf=True, split_bytes=100)
    assert rows(df) == EXPECTED


def test_file_that_is_not_block_gzip_raises(spark, landed):
    with pytest.raises(Exception, match="not block-gzip"):
        read_vcf(spark, str(landed / "not blocks.vcf.bgz"), []).collect()


def test_info_projection(spark, landed):
    path = str(landed / "plain.vcf")
    assert len(read_vcf(spark, path, []).columns) == 8
    assert read_vcf(spark, path, ["TSA", "AF"]).columns[8:] == ["tsa", "af"]
    with pytest.raises(ValueError, match="NOPE"):
        read_vcf(spark, path, ["NOPE"])


def test_header_fields_in_order(spark, landed):
    fields = read_info_fields(spark, str(landed / "crlf.vcf"))
    assert [f.id for f in fields] == ["END", "AF", "DB", "TSA"]
    assert fields[0] == InfoField("END", "1", "Integer", 'End, of the \\"variant\\"')
    assert fields[2] == InfoField("DB", ".", "String", None)


def test_header_lines_stop_at_the_first_record(spark, landed):
    got = header_lines(spark, [str(landed / "plain.vcf"), str(landed / "blocks.vcf.bgz")])
    assert got.count() == 2 * len(HEADER)
    assert [r["value"] for r in got.filter("path LIKE '%plain%'").orderBy("line").collect()] == HEADER


def test_headers_that_disagree_are_widened(spark, tmp_path):
    (tmp_path / "a.vcf").write_text("##INFO=<ID=X,Number=1,Type=Integer>\n##INFO=<ID=Y,Number=1,Type=Float>\n#C\n")
    (tmp_path / "b.vcf").write_text("##INFO=<ID=X,Number=A,Type=String>\n##INFO=<ID=Z,Number=0,Type=Flag>\n#C\n")
    fields = read_info_fields(spark, str(tmp_path / "*.vcf"))
    assert [tuple(f[:3]) for f in fields] == [("X", ".", "String"), ("Y", "1", "Float"), ("Z", "0", "Flag")]


def test_header_info_ignores_other_lines(spark):
    lines = ["##INFO=<ID=A,Number=1,Type=Integer>", "##INFO=<Number=1,ID=B>", "##FORMAT=<ID=C>", "1\t2", "##INFO=<ID=D>"]
    df = header_info(spark.createDataFrame([(v,) for v in lines], "value string"))
    assert [r["id"] for r in df.collect()] == ["A", "D"]
    assert merge_info(df.selectExpr("*", "0 AS line"))[1] == InfoField("D", ".", "String", None)


@pytest.mark.parametrize("line", ["1\t2\t3", "1\tabc\t.\tA\tC\t.\t.\t."])
def test_bad_lines(spark, line):
    df = spark.createDataFrame([(line,)], "value string")
    with pytest.raises(Exception, match="not a VCF record"):
        parse_lines(df).collect()
    row = parse_lines(df, mode="permissive").first()
    assert row["chrom"] == "1" and row["start"] in (2, None)


def test_blank_and_header_lines_are_dropped(spark):
    df = spark.createDataFrame([("",), ("#x",), (None,), (RECORDS[0],)], "value string")
    assert parse_lines(df).count() == 1


def test_split_runs_once_per_row(spark, landed):
    """The line is cut once; the columns are taken from the result."""
    plan = read_vcf(spark, str(landed / "plain.vcf"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(value") == 1 and "BatchEvalPython" not in plan


def test_index_files_give_no_rows(spark, landed, tmp_path):
    (tmp_path / "a.vcf.gz.tbi").write_bytes(b"index")
    df = read_vcf(spark, str(tmp_path / "a.vcf.gz.tbi"))
    assert df.columns == [f.name for f in CORE_SCHEMA] and df.isEmpty()
    (tmp_path / "a.vcf").write_text(text())
    assert read_vcf(spark, str(tmp_path), []).count() == 4


def test_source_file_and_partitions(spark, landed):
    df = read_vcf(spark, [str(landed / "plain.vcf"), str(landed / "blocks.vcf.bgz")], [], with_source=True, partitions=3)
    assert {r[0] for r in df.select("source_file").distinct().collect()} == {"plain", "blocks"}
    assert df.rdd.getNumPartitions() == 3 and df.count() == 8


def test_vcf_to_parquet_reuses_and_overwrites(spark, tmp_path):
    vcf = tmp_path / "s.vcf"
    vcf.write_text(text())
    df, path = vcf_to_parquet(spark, str(vcf))
    assert path == str(tmp_path / "s.parquet") and rows(df) == EXPECTED
    vcf.write_text("\n".join(HEADER + RECORDS[:1]))
    assert vcf_to_parquet(spark, str(vcf))[0].count() == 4
    assert vcf_to_parquet(spark, str(vcf), overwrite=True)[0].count() == 1
    saved = read_vcf(spark, str(vcf), save_parquet="auto")
    assert saved.count() == 1 and saved.columns == df.columns
    with pytest.raises(ValueError):
        read_vcf(spark, [str(vcf), str(vcf)], save_parquet="auto")


@pytest.mark.parametrize("seed", range(4))
def test_block_lines_against_brute_force(spark, tmp_path, seed):
    """Lines of any length over blocks of any size, cut anywhere: each line exactly once."""
    rng = random.Random(seed)
    lines = [f"{i}:" + "x" * rng.choice([0, 3, 40, 700]) for i in range(rng.randrange(1, 120))]
    data = "\n".join(lines) + ("\n" if seed % 2 else "")
    path = tmp_path / "t.bgz"
    path.write_bytes(bgzf(data.encode(), rng.choice([3, 17, 64, 500])))
    for split in (90, 10**6):
        got = [r["value"] for r in read_block_lines(spark, str(path), split).collect()]
        assert sorted(got) == sorted(lines)


def test_block_splits_cover_the_file(spark):
    files = spark.createDataFrame([("a", 100), ("b", 0), ("c", 31)], "path string, size bigint")
    got = rows(block_splits(files, 40), "path", "start", "stop")
    assert got == [("a", 0, 40), ("a", 40, 80), ("a", 80, 100), ("c", 0, 31)]
