import gzip
import os

import pytest
from pyspark.sql import functions as F

from varloom import operators as op
from varloom import sources as src
from varloom.plans import (
    annotate_clinical,
    annotate_vcf,
    build_reference,
    describe_dataset,
    prepare,
    publish_plan,
    read_converted,
    save_annotated,
)
from varloom.schema import InfoField
from varloom.streaming import annotate_stream, ingest, stream_vcf

from .conftest import rows

HEADER = '##INFO=<ID=TSA,Number=1,Type=String,Description="t">\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\n'


def vcf(*records):
    return HEADER + "".join(f"{c}\t{p}\t.\t{r}\t{a}\t.\tPASS\tTSA={t}\n" for c, p, r, a, t in records)


CHR1 = vcf(("1", 10, "A", "C,G", "SNV"), ("1", 20, "AT", "A", "deletion"))
CHRX = vcf(("X", 30, "G", "T", "SNV"))


@pytest.fixture(scope="module")
def reference(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("ref") / "r")
    data = [
        ("1", 10, "A", "C|G", "SNV", "rs1", "Pathogenic"),
        ("1", 20, "AT", "A", "deletion", "rs2", "Benign"),
        ("2", 10, "A", "C", "SNV", "rs3", "Likely_pathogenic"),
    ]
    df = spark.createDataFrame(data, "chrom string, start bigint, ref string, alt string, tsa string, id string, clnsig string")
    build_reference(df, out)
    return out


def test_annotate_vcf(spark, reference, tmp_path):
    path = tmp_path / "s.vcf.gz"
    path.write_bytes(gzip.compress((CHR1 + CHRX.replace(HEADER, "")).encode()))
    df = annotate_vcf(spark, str(path), reference)
    assert rows(df, "chrom", "start", "id_ensembl") == [("1", 10, "rs1"), ("1", 20, None), ("X", 30, None)]
    assert annotate_vcf(spark, str(path), reference, how="inner").count() == 1
    saved = annotate_vcf(spark, str(path), reference, variant_type="deletion", out=str(tmp_path / "o"))
    assert rows(spark.read.parquet(saved), "start", "id_ensembl") == [(10, None), (20, "rs2"), (30, None)]
    assert any(f.endswith(".zstd.parquet") for f in os.listdir(saved))
    with pytest.raises(FileNotFoundError):
        annotate_vcf(spark, str(path), reference, variant_type="INDEL")
    with pytest.raises(ValueError):
        save_annotated(df, None)


def test_annotate_with_prefixed_chromosomes(spark, reference, tmp_path):
    (tmp_path / "s.vcf").write_text(CHR1.replace("\n1\t", "\nchr1\t"))
    # No folder of the reference has these names, so the input comes back as it is.
    assert "clnsig" not in annotate_vcf(spark, str(tmp_path / "s.vcf"), reference).columns
    assert annotate_clinical(spark, str(tmp_path / "s.vcf"), reference).isEmpty()
    df = annotate_vcf(spark, str(tmp_path / "s.vcf"), reference, strip_chr_prefix=True)
    assert df.filter("clnsig IS NOT NULL").count() == 1


def test_annotate_clinical(spark, reference, tmp_path):
    (tmp_path / "s.vcf").write_text(CHR1)
    assert annotate_clinical(spark, str(tmp_path / "s.vcf"), reference).count() == 2
    assert annotate_clinical(spark, str(tmp_path / "s.vcf"), reference, contains="Pathogenic").count() == 1


def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "homo_sapiens-chr1.vcf.gz").write_bytes(gzip.compress(CHR1.encode()))
    (folder / "homo_sapiens-chr1.vcf.gz.tbi").write_bytes(b"index")
    (folder / "README").write_text("no data")
    return folder


def test_prepare_is_incremental(spark, tmp_path):
    folder, out = landing(tmp_path), str(tmp_path / "out")
    first = prepare(spark, src.ensembl(), str(folder), out, split=True)
    assert [os.path.basename(p) for p in first.converted] == ["homo_sapiens-chr1.vcf.gz"]
    assert first.split == ["homo_sapiens-chr1"] and first.problems.isEmpty()
    (folder / "homo_sapiens-chrX.vcf.gz").write_bytes(gzip.compress(CHRX.encode()))
    second = prepare(spark, src.ensembl(), str(folder), out, split=True)
    assert [os.path.basename(p) for p in second.converted] == ["homo_sapiens-chrX.vcf.gz"]
    assert second.split == ["homo_sapiens-chrX"]
    variants = spark.read.parquet(second.variants)
    assert rows(variants, "chrom", "start", "alt", "source_file") == [
        ("1", 10, "C|G", "homo_sapiens-chr1"),
        ("1", 20, "A", "homo_sapiens-chr1"),
        ("X", 30, "T", "homo_sapiens-chrX"),
    ]
    splits = spark.read.parquet(second.splits)
    assert rows(splits, "start", "alt", "tsa") == [(10, "C", "SNV"), (10, "G", "SNV"), (20, "A", "deletion"), (30, "T", "SNV")]
    third = prepare(spark, src.ensembl(), str(folder), out, split=True)
    assert third.converted == [] and third.split == []


def test_file_without_records_is_converted_once(spark, tmp_path):
    folder, out = tmp_path / "landing", str(tmp_path / "out")
    folder.mkdir()
    (folder / "homo_sapiens-chr2.vcf.gz").write_bytes(gzip.compress(HEADER.encode()))
    first = prepare(spark, src.ensembl(), str(folder), out, split=True)
    assert len(first.converted) == 1 and first.problems.isEmpty() and first.splits is None
    (folder / "homo_sapiens-chrX.vcf.gz").write_bytes(gzip.compress(CHRX.encode()))
    second = prepare(spark, src.ensembl(), str(folder), out, split=True)
    assert len(second.converted) == 1 and second.problems.isEmpty() and second.split == ["homo_sapiens-chrX"]
    assert prepare(spark, src.ensembl(), str(folder), out, split=True).converted == []


def test_prepare_reports_problems(spark, tmp_path):
    folder = landing(tmp_path)
    remote = spark.createDataFrame(
        [("https://h/homo_sapiens-chr1.vcf.gz", 1), ("https://h/homo_sapiens-chr2.vcf.gz", 1)], "url string, remote_size bigint"
    )
    done = prepare(spark, src.ensembl(), str(folder), str(tmp_path / "out"), remote=remote)
    assert rows(done.problems, "kind", "name") == [
        ("no_local_for_url", "homo_sapiens-chr2.vcf.gz"),
        ("size_mismatch", "homo_sapiens-chr1.vcf.gz"),
    ]


def test_pattern_that_also_selects_indexes(spark, tmp_path):
    """A user pattern may match index files; they are validated but not converted."""
    done = prepare(spark, src.ensembl(), str(landing(tmp_path)), str(tmp_path / "out"), pattern="chr(1|X)")
    assert len(done.converted) == 1 and done.problems.isEmpty()


def test_prepare_clinvar_splits_by_its_own_column(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    text = CHR1.replace("TSA", "CLNVC").replace("=SNV", "=single_nucleotide_variant")
    (folder / "clinvar.vcf.gz").write_bytes(gzip.compress(text.encode()))
    done = prepare(spark, src.clinvar(), str(folder), str(tmp_path / "out"), split=True)
    counts = rows(op.type_counts(spark.read.parquet(done.splits), "clnvc"))
    assert counts == [("deletion", 1), ("single_nucleotide_variant", 2)]


def test_prepare_dbsnp_without_suffix(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "GCF_000001405.40.gz").write_bytes(gzip.compress(CHRX.encode()))
    done = prepare(spark, src.dbsnp(), str(folder), str(tmp_path / "out"))
    assert len(done.converted) == 1 and done.problems.isEmpty()


def test_presets():
    assert src.gnomad("v3").name == "gnomad_v3" and src.dbsnp("GRCh37").name == "dbsnp_grch37"
    assert src.ensembl().with_pattern("x").pattern == "x" and src.ensembl().with_pattern(None) == src.ensembl()
    with pytest.raises(ValueError):
        src.dbsnp("hg18")
    with pytest.raises(ValueError):
        src.gnomad("v9")


def test_publish_plan_and_stats(spark, reference):
    listing = spark.createDataFrame([], "path_in_repo string, size bigint")
    plan = publish_plan(spark, reference, listing)
    assert plan.count() == 3 and plan.filter("NOT uploaded OR reason <> 'new_file'").isEmpty()
    assert plan.filter("path_in_repo LIKE 'data/tsa=SNV/chrom=1/%'").count() == 1
    again = publish_plan(spark, reference, plan.select("path_in_repo", F.col("local_size").alias("size")))
    assert again.filter("uploaded").isEmpty()
    stats = describe_dataset(spark, reference).first()
    assert stats["num_files"] == 3 and stats["variant_types"] == ["SNV", "deletion"]
    assert stats["rows_by_type"] == {"SNV": 2, "deletion": 1}


def test_stream_takes_each_file_once(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    info = [InfoField("TSA")]
    (folder / "a.vcf").write_text(CHR1.replace("\n", "\r\n"))
    ingest(stream_vcf(spark, str(folder), info), out, checkpoint, ["tsa"]).awaitTermination(120)
    (folder / "b.vcf.gz").write_bytes(gzip.compress(CHRX.encode()))
    ingest(stream_vcf(spark, str(folder), info), out, checkpoint, ["tsa"]).awaitTermination(120)
    assert rows(spark.read.parquet(out), "start", "tsa") == [(10, "SNV"), (20, "deletion"), (30, "SNV")]


def test_stream_annotation_in_batches(spark, reference, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "a.vcf").write_text(CHR1)
    (folder / "b.vcf").write_text(CHRX)
    stream = stream_vcf(spark, str(folder), [InfoField("TSA")], max_files_per_trigger=1)
    known = src.open_reference(spark, reference, "SNV").drop("tsa")
    annotate_stream(stream, known, str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination(240)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert rows(got, "start", "id_ensembl") == [(10, "rs1"), (20, None), (30, None)]
    assert got.select("batch").distinct().count() == 2


def test_order_and_filters(spark):
    df = spark.createDataFrame([("10", 5), ("2", 6), ("X", 7), ("MT", 8), ("1", 9)], "chrom string, start bigint")
    assert [r["chrom"] for r in op.natural_order(df).collect()] == ["1", "2", "10", "MT", "X"]
    assert src.chromosome_list(df) == ["1", "2", "10", "MT", "X"]
    assert rows(op.region(df, 6, 8), "start") == [(6,), (7,), (8,)]
    assert op.region(df, 6, 8, "X").count() == 1
    assert [r["start"] for r in op.head(df, 2, "start").collect()] == [5, 6]
    assert op.head(df, 3).count() == 3
    assert op.on_chroms(df, ["X", "1"]).count() == 2


def test_region_is_pushed_to_the_scan(spark, tmp_path):
    spark.range(10).select(F.lit("1").alias("chrom"), F.col("id").alias("start"), F.lit(1).alias("other")).write.parquet(str(tmp_path / "p"))
    df = op.region(spark.read.parquet(str(tmp_path / "p")), 3, 5, "1").select("start")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(start,3)" in plan and "LessThanOrEqu" in plan and "other" not in plan


def test_many_chromosomes_change_nothing(spark, tmp_path, reference):
    """As many unknown names as you like: a reference without data leaves the input as it is."""
    for n in (10, 12_000):
        (tmp_path / f"{n}.vcf").write_text(vcf(*[(f"ctg{i}", 10, "A", "C", "SNV") for i in range(n)]))
        df = annotate_vcf(spark, str(tmp_path / f"{n}.vcf"), reference)
        assert "id_ensembl" not in df.columns and df.count() == n
    (tmp_path / "known.vcf").write_text(vcf(*[(f"ctg{i}", 10, "A", "C", "SNV") for i in range(500)], ("1", 10, "A", "C,G", "SNV")))
    df = annotate_vcf(spark, str(tmp_path / "known.vcf"), reference)
    assert df.filter("id_ensembl IS NOT NULL").count() == 1


def test_reference_layouts(spark, tmp_path):
    data = spark.createDataFrame([("1", 10, "A", "C", "x")], "chrom string, start bigint, ref string, alt string, clnsig string")
    data.write.parquet(str(tmp_path / "c/data/clinvar.parquet"))
    data.write.parquet(str(tmp_path / "t/SNV/chr1.parquet"))
    data.write.parquet(str(tmp_path / "t/deletion/chr1.parquet"))
    assert src.open_reference(spark, str(tmp_path / "c"), None).count() == 1
    assert src.open_reference(spark, str(tmp_path / "t"), None).count() == 2
    assert src.open_reference(spark, str(tmp_path / "t"), "SNV", ["2"]) is None
    with pytest.raises(FileNotFoundError):
        (tmp_path / "none").mkdir()
        src.open_reference(spark, str(tmp_path / "none"), None)


def test_line_ends_do_not_depend_on_packing(spark, tmp_path):
    from .test_vcf import bgzf

    text = (HEADER + CHR1.replace(HEADER, "")).replace("\n", "\r").encode()
    (tmp_path / "a.vcf").write_bytes(text)
    (tmp_path / "b.vcf.gz").write_bytes(gzip.compress(text))
    (tmp_path / "c.vcf.gz").write_bytes(bgzf(text, 40))
    found = [rows(src.read_vcf(spark, str(tmp_path / n), [InfoField("TSA")])) for n in ("a.vcf", "b.vcf.gz", "c.vcf.gz")]
    assert len(found[0]) == 2 and found[0] == found[1] == found[2]


def test_stream_of_a_real_folder(spark, tmp_path):
    folder = landing(tmp_path)
    (folder / "README").unlink()
    stream = stream_vcf(spark, str(folder), [InfoField("TSA")])
    ingest(stream, str(tmp_path / "o"), str(tmp_path / "k")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "o")).count() == 2
    (folder / "x.vcf.bgz").write_bytes(gzip.compress(CHRX.encode()))
    with pytest.raises(Exception, match="bgz"):
        stream = stream_vcf(spark, str(folder), [InfoField("TSA")], mode="permissive")
        ingest(stream, str(tmp_path / "o2"), str(tmp_path / "k2")).awaitTermination(120)


def test_inputs_of_one_name_are_all_kept(spark, tmp_path):
    from varloom.plans import split_existing

    folder, out = tmp_path / "landing", str(tmp_path / "out")
    (folder / "a").mkdir(parents=True)
    (folder / "a/homo_sapiens-chr1.vcf.gz").write_bytes(gzip.compress(CHR1.encode()))
    first = prepare(spark, src.ensembl(), str(folder), out, split=True, recursive=True)
    (folder / "b").mkdir()
    (folder / "b/homo_sapiens-chr1.vcf.gz").write_bytes(gzip.compress(CHRX.encode()))
    second = prepare(spark, src.ensembl(), str(folder), out, split=True, recursive=True, raise_on_error=True)
    assert len(first.converted) == len(second.converted) == 1 and second.problems.isEmpty()
    assert read_converted(spark, second.variants).count() == 3 and spark.read.parquet(second.splits).count() == 4
    data = spark.createDataFrame([("1", 10, "A", "C", "SNV")], "chrom string, start bigint, ref string, alt string, tsa string")
    for name in ("p", "q"):
        data.write.parquet(str(tmp_path / name / "x.parquet"))
        split_existing(spark, str(tmp_path / name / "x.parquet"), str(tmp_path / "splits"))
    assert spark.read.parquet(str(tmp_path / "splits")).count() == 2


def test_headers_that_change_between_waves(spark, tmp_path):
    folder, out = tmp_path / "landing", str(tmp_path / "out")
    folder.mkdir()
    af = '##INFO=<ID=AF,Number=1,Type=Integer,Description="a">\n'
    (folder / "homo_sapiens-chr1.vcf.gz").write_bytes(gzip.compress((af + CHR1.replace("TSA=SNV", "TSA=SNV;AF=7")).encode()))
    prepare(spark, src.ensembl(), str(folder), out, split=True)
    text = af.replace("Integer", "String") + '##INFO=<ID=NEW,Number=.,Type=Float,Description="n">\n' + CHRX.replace("TSA=SNV", "TSA=SNV;AF=x;NEW=1,2")
    (folder / "homo_sapiens-chrX.vcf.gz").write_bytes(gzip.compress(text.encode()))
    second = prepare(spark, src.ensembl(), str(folder), out, split=True, raise_on_error=True)
    assert [os.path.basename(p) for p in second.converted] == ["homo_sapiens-chrX.vcf.gz"]
    got = read_converted(spark, second.variants)
    assert rows(got, "chrom", "start", "tsa", "af", "new") == [
        ("1", 10, "SNV", "7", None), ("1", 20, "deletion", None, None), ("X", 30, "SNV", "x", [1.0, 2.0])
    ]
    assert rows(spark.read.parquet(second.splits), "start", "af") == [(10, "7"), (10, "7"), (20, None), (30, "x")]
    assert prepare(spark, src.ensembl(), str(folder), out, split=True).converted == []
    back = prepare(spark, src.ensembl(), str(folder), out, overwrite=True)
    assert len(back.converted) == 2 and read_converted(spark, back.variants).count() == 3
