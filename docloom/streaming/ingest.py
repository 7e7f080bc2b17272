"""A folder that grows: files are converted to markdown, or taken all the way to the chunk store, as they arrive."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docloom.config import IngestConfig
from docloom.plans.ingest import Models, markdown_of, store_batch
from docloom.sources.converters import convert
from docloom.sources.store import Store

FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def arriving(spark: SparkSession, folder: str, per_batch: int | None = None) -> DataFrame:
    """path and content of files below ``folder`` as they come, at most ``per_batch`` at a time."""
    reader = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("recursiveFileLookup", True)
    return (reader.option("maxFilesPerTrigger", per_batch) if per_batch else reader).load(folder).select("path", "content")


def ingest(spark: SparkSession, folder: str, out: str, checkpoint: str) -> StreamingQuery:
    """Convert what is new in ``folder`` to Parquet in ``out``; ``checkpoint`` remembers the files seen."""
    return convert(arriving(spark, folder)).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ingest_to_store(spark: SparkSession, config: IngestConfig, models: Models, checkpoint: str, per_batch: int | None = None) -> StreamingQuery:
    """Chunk, number, link, embed and store what is new in the input folder. ``checkpoint`` remembers the files of each batch, and the store
    replaces a batch that comes again: a query that was killed, at whatever point, and started again leaves the store as if it had never
    stopped. Numbers go on from the store. Batches without files in a known format, or with none that can be converted, write nothing."""
    config.check({"summary": models.summary, "relate": models.relate} if models.summary and models.relate else {})
    store, name = Store(spark, f"{config.output_dir}/store"), hashlib.md5(checkpoint.encode()).hexdigest()

    def write(files: DataFrame, batch_id: int) -> None:
        known = files.where(F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1)).isin(*config.formats))
        good, _ = markdown_of(known, config, models)
        if not good.isEmpty():
            store_batch(store, f"stream-{name}-{batch_id}", good, config, models)

    query = arriving(spark, config.input_dir, per_batch).writeStream.foreachBatch(write)
    return query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
