"""Files that arrive over time: incremental conversion and annotation.

Both jobs are stateless.  The checkpoint records which files were taken, so a restart neither skips nor
repeats one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.annotate import annotate
from ..functions import is_index_file
from ..schema import KEYS, InfoField
from ..sources.vcf import parse_lines


def stream_vcf(
    spark: SparkSession,
    landing_dir: str,
    info: Sequence[InfoField] = (),
    mode: str = "failfast",
    max_files_per_trigger: int | None = None,
    name_glob: str | None = None,
    variant: str | None = None,
) -> DataFrame:
    """A stream of variants from the VCF files that land in a folder.

    A stream cannot discover columns, so the INFO fields are given: from ``read_info_fields`` on a
    first file, or by hand.  ``variant`` names a VARIANT column that takes all of INFO instead, whatever the headers of
    files that land later declare; ``type_info`` makes typed columns of it at any time.  Index files give no rows.  A ``.bgz`` file, which the text source would take for plain
    text, raises in every mode; the same file named ``.gz`` is read.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    lines = reader.load(landing_dir)
    path = F.col("_metadata.file_path")
    lines = lines.filter(~is_index_file(path))
    refused = F.concat(F.lit("a stream cannot read block-gzip by the name .bgz; name it .gz: "), path)
    packed = F.when(path.endswith(".bgz"), F.raise_error(refused).cast("string")).otherwise(F.col("value"))
    return parse_lines(lines.select(packed.alias("value")), info, mode, variant=variant)


def ingest(
    variants: DataFrame,
    out: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    available_now: bool = True,
) -> StreamingQuery:
    """Append a stream of variants to a Parquet dataset.

    With ``available_now`` the query takes everything that has landed and stops; otherwise it keeps
    running.
    """
    writer = variants.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(out)


def annotate_stream(
    variants: DataFrame,
    reference: DataFrame,
    out: str,
    checkpoint: str,
    on: Sequence[str] = KEYS,
    available_now: bool = True,
    **options,
) -> StreamingQuery:
    """Annotate a stream batch by batch against a reference table.

    Each batch is annotated like a table of its own, so a small batch reduces the reference where it is
    read instead of shuffling it.  A batch writes the partition of its own number and replaces it when
    it is run again, so repeated batches leave no duplicates.
    """

    def write(batch: DataFrame, number: int) -> None:
        # The batch feeds several jobs; without this each of them would read the landed files again.
        batch.persist()
        try:
            (
                annotate(batch, reference, on, **options)
                .withColumn("batch", F.lit(number))
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("batch")
                .parquet(out)
            )
        finally:
            batch.unpersist()

    writer = variants.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
