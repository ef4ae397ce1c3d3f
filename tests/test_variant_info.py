from pyspark.sql import functions as F

from varloom.functions import framed_info, info_variant
from varloom.schema import InfoField
from varloom.sources import parse_lines, type_info
from varloom.streaming import ingest, stream_vcf

from .conftest import rows

FIELDS = [
    InfoField("AF", "A", "Float"), InfoField("DP", "1", "Integer"), InfoField("DB", "0", "Flag"), InfoField("S", "1", "String"),
    InfoField("END", "1", "Integer"), InfoField("1000G.x", "0", "Flag"), InfoField("L", ".", "String"),
]
INFOS = [
    "AF=0.1,.,0.3;DP=4", "DB;DP=x;S=a=b", ".", "", "DP=1;DP=2;DB;DP=3", "S=.;L=a,,b;1000G.x", "END=70;;AF=.", "DB=1;S=",
    "XAF=1;AFX=2;DP= 7", 'S="q";L=\\u', "s=lower;S=é日",
]


def test_late_types_equal_early_types(spark):
    lines = [(f"1\t{i + 1}\t.\tA\tC\t.\tPASS\t{info}",) for i, info in enumerate(INFOS)]
    frame = spark.createDataFrame(lines, "value string")
    early = parse_lines(frame, FIELDS)
    late = type_info(parse_lines(frame, variant="v"), FIELDS, "v")
    assert early.columns == late.columns and early.schema.simpleString() == late.schema.simpleString()
    assert rows(early) == rows(late)


def test_variant_holds_all_keys(spark):
    frame = spark.createDataFrame([(i,) for i in [*INFOS, None]], "info string")
    got = [r[0] for r in frame.select(F.to_json(info_variant(framed_info("info")))).collect()]
    assert got[0] == '{"AF":"0.1,.,0.3","DP":"4"}'
    assert got[2] == got[3] == got[-1] == "{}"
    assert got[4] == '{"DB":"true","DP":"3"}'


def test_stream_over_changing_headers_equals_the_batch(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.vcf").write_text("##fileformat=VCFv4.2\n##INFO=<ID=DP,Number=1,Type=Integer>\n1\t5\t.\tA\tC\t.\t.\tDP=3\n")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    stream = stream_vcf(spark, str(landing), variant="info")
    ingest(stream, out, checkpoint).awaitTermination()
    (landing / "b.vcf").write_text("##INFO=<ID=S,Number=1,Type=String>\n2\t6\t.\tA\tC\t.\t.\tS=new;DB\n")
    ingest(stream_vcf(spark, str(landing), variant="info"), out, checkpoint).awaitTermination()
    stored = type_info(spark.read.schema(stream.schema).parquet(out), FIELDS)
    batch = parse_lines(spark.read.text(str(landing)), FIELDS)
    assert stored.count() == 2 and rows(stored) == rows(batch)
