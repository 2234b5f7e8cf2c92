"""Incremental ingestion as a stream of landed files.

The batch driver lists the whole landing folder on every run and filters by watermark. The file stream instead remembers
in its checkpoint which pages it has read, so a run opens new pages only, however large the folder has grown. It takes
what has landed and stops (``availableNow``); the Silver and Gold stages then run on the new Bronze rows as usual.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ledgerline.plans.ingestion import ENDPOINTS, PAGES_PER_BATCH, Endpoint, ingest_micro_batch
from ledgerline.plans.layout import Lakehouse
from ledgerline.sources.landing import page_path


#: Fixed: the columns of Spark's binary file source.
FILE = "path string, modificationTime timestamp, length bigint, content binary"


def page_stream(spark: SparkSession, pages_path: str, files_per_batch: int) -> DataFrame:
    """The paths of newly landed pages. The stream opens no page: a batch reads those that it announces."""
    files = spark.readStream.format("binaryFile").schema(FILE).option("maxFilesPerTrigger", files_per_batch)
    return files.load(pages_path).select(page_path(pages_path))


def ingest_available(
    lake: Lakehouse, endpoint: Endpoint, pages_path: str, files_per_batch: int = PAGES_PER_BATCH
) -> StreamingQuery:
    """Store all pages that landed since the last call in Bronze, as one batch or more.

    The stream's checkpoint and the intents of Bronze agree through the pages: those that any batch holds, also one of the
    batch driver, are left out, so a micro-batch repeated after a failure stores nothing twice.
    """
    lake.start()

    def write(batch: DataFrame, _: int) -> None:
        ingest_micro_batch(lake, endpoint, batch, pages_path)

    stream = page_stream(lake.spark, pages_path, files_per_batch)
    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{lake.root}/checkpoints/{endpoint.name}")
        .trigger(availableNow=True)
        .start()
    )


def ingest_landing(lake: Lakehouse, landing: str) -> None:
    """Bring every endpoint up to date."""
    for endpoint in ENDPOINTS:
        ingest_available(lake, endpoint, f"{landing}/{endpoint.name}").awaitTermination()
