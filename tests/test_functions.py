import pytest
from pyspark.sql import functions as F

from varloom import functions as fn
from varloom.schema import InfoField, info_columns, info_type, variant_schema


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "size, text",
    [
        (0, "0 B"),
        (512, "512 B"),
        (1023, "1023 B"),
        (1024, "1.0 KB"),
        (1280, "1.2 KB"),
        (1536, "1.5 KB"),
        (1024**2 - 1, "1024.0 KB"),
        (5 * 1024**3, "5.0 GB"),
        (3 * 1024**4, "3.0 TB"),
        (2048 * 1024**4, "2048.0 TB"),
    ],
)
def test_human_size(spark, size, text):
    assert one(spark, fn.human_size("n"), n=size) == text


def test_sizes_rounded(spark):
    assert one(spark, fn.megabytes("n"), n=3 * 1024**2 + 1024 * 128) == 3.12
    assert one(spark, fn.gigabytes("n"), n=int(1.5 * 1024**3)) == 1.5


@pytest.mark.parametrize("diff, text", [(5, "+5 B"), (-5, "-5 B"), (0, "0 B")])
def test_signed_bytes(spark, diff, text):
    assert one(spark, fn.signed_bytes("n"), n=diff) == text


@pytest.mark.parametrize(
    "name, is_vcf",
    [
        ("a.vcf", True),
        ("a.vcf.gz", True),
        ("x/a.vcf.bgz", True),
        ("a.vcf.gz.tbi", False),
        ("a.vcf.gz.csi", False),
        ("a.vcf.idx", False),
        ("a.txt", False),
        ("a.vcfx", False),
        (".vcf", False),
        ("a.vcf/b.txt", False),
        ("GCF_000001405.40.gz", False),
    ],
)
def test_is_vcf_file(spark, name, is_vcf):
    assert one(spark, fn.is_vcf_file("p"), p=name) is is_vcf


@pytest.mark.parametrize(
    "path, parquet, source",
    [
        ("d/x.vcf", "d/x.parquet", "x"),
        ("d/x.vcf.gz", "d/x.parquet", "x"),
        ("d/x.vcf.bgz", "d/x.parquet", "x"),
        ("d/a.b.vcf.gz", "d/a.b.parquet", "a.b"),
        ("d.e/x", "d.e/x.parquet", "x"),
        ("GCF_000001405.40.gz", "GCF_000001405.40.parquet", "GCF_000001405.40"),
    ],
)
def test_output_names(spark, path, parquet, source):
    from varloom.sources import default_path

    assert one(spark, fn.default_parquet_name("p"), p=path) == parquet
    assert default_path(path) == parquet
    assert one(spark, fn.source_name("p"), p=path) == source


def test_path_parts(spark):
    assert one(spark, fn.base_name("p"), p="https://h/a/b.vcf.gz") == "b.vcf.gz"
    assert one(spark, fn.stem("p"), p="a/b.vcf.gz") == "b.vcf"
    assert one(spark, fn.stem("p"), p=".hidden") == ".hidden"
    assert one(spark, fn.last_suffix("p"), p="a.d/b") == ""
    assert one(spark, fn.relative_path("p", "/r"), p="/r/a/b.parquet") == "a/b.parquet"
    assert one(spark, fn.relative_path("p", "/r"), p="/rr/a/b.parquet") == "b.parquet"
    assert one(spark, fn.percent_decoded("p"), p="a%20b+c") == "a b+c"


@pytest.mark.parametrize(
    "info, key, type_, number, expected",
    [
        ("FLAG;K=a=b", "K", "String", "1", "a=b"),
        ("FLAG;K=a=b", "FLAG", "Flag", "0", True),
        ("XFLAG;K=1", "FLAG", "Flag", "0", False),
        (".", "FLAG", "Flag", "0", False),
        (None, "FLAG", "Flag", "0", False),
        ("AN=5;N=7", "N", "Integer", "1", 7),
        ("N=.", "N", "Integer", "1", None),
        ("N=oops", "N", "Integer", "1", None),
        ("N=", "N", "String", "1", None),
        ("M=1", "N", "Integer", "1", None),
        ("N=1;N=2", "N", "Integer", "1", 2),
        ("AF=0.5,.,1e-3", "AF", "Float", "A", [0.5, None, 0.001]),
        ("S=a,.,b", "S", "String", ".", ["a", None, "b"]),
        ("S=.", "S", "String", ".", None),
        (".", "S", "String", "1", None),
    ],
)
def test_info_values(spark, info, key, type_, number, expected):
    column = fn.typed_info(fn.framed_info(F.col("i").cast("string")), InfoField(key, number, type_))
    assert one(spark, column, i=info) == expected


def test_info_types_and_names():
    assert info_type("1", "Integer").simpleString() == "bigint"
    assert info_type("A", "Float").simpleString() == "array<double>"
    assert info_type("0", "Flag").simpleString() == "boolean"
    assert info_type("1", "Character").simpleString() == "string"
    names = info_columns([InfoField("END"), InfoField("AF"), InfoField("af"), InfoField("info_end")])
    assert names == {"END": "info_end", "AF": "af", "af": "info_af", "info_end": "info_info_end"}
    schema = variant_schema([InfoField("END", "1", "Integer")])
    assert len({f.name.lower() for f in schema}) == len(schema)


def test_chromosome_names(spark):
    assert one(spark, fn.bare_chrom("c"), c="chrX") == "X"
    assert one(spark, fn.bare_chrom("c"), c="CHR1") == "1"
    assert one(spark, fn.bare_chrom("c"), c="1") == "1"
    assert one(spark, fn.alt_alleles("a"), a="A|T") == ["A", "T"]
