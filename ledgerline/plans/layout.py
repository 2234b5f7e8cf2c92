"""Where the tables of a lakehouse live."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from functools import wraps
from uuid import uuid4

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from ledgerline.plans.progress import LAYOUT, Progress
from ledgerline.session import freed_shuffles
from ledgerline.sources.tables import Table, emptied

# Up to so many buckets, a task writes a file into each; beyond, the rows of a bucket are brought together first.
FEW_BUCKETS = 64

BRONZE, SILVER, GOLD = "ingest_to_bronze", "bronze_to_silver", "silver_to_gold"


def stage(work: Callable) -> Callable:
    """A step of a lakehouse (its first argument), each of whose queries frees its shuffle files."""
    @wraps(work)
    def freeing(lake: Lakehouse, *args, **options):
        with freed_shuffles(lake.spark):
            return work(lake, *args, **options)

    return freeing


class Lakehouse:
    """``buckets``: parts of every keyed table, about 128 MB each when the tables are full grown. It holds for the life of
    the lakehouse: the first run stores it, later ones must agree."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16):
        self.spark = spark
        self.root = root.rstrip("/")
        self.run_id = uuid4().hex
        self.started_at = datetime.now(timezone.utc)
        self.buckets = buckets
        self.progress = Progress(spark, f"{self.root}/control/progress")

    def start(self) -> None:
        """What every stage does first: see how far the others are."""
        self.progress.ensure()
        agreed = self.progress.of(LAYOUT, "buckets").batch
        if not agreed:
            self.progress.save(LAYOUT, "buckets", batch=self.buckets)
        elif agreed != self.buckets:
            raise ValueError(f"{self.root} has {agreed} buckets, not {self.buckets}")

    def table(self, layer: str, name: str, schema=None) -> Table:
        return Table(self.spark, f"{self.root}/{layer}/{name}", schema)

    def bronze(self, name: str) -> Table:
        return self.table("bronze", name, self.progress.of(BRONZE, f"bronze_{name}").schema)

    def silver(self, name: str) -> Table:
        return self.table("silver", name, self.progress.of(SILVER, f"silver_{name}").schema)

    def gold(self, name: str) -> Table:
        return self.table("gold", name, self.progress.of(GOLD, name).schema)

    def staging(self, name: str, schema=None) -> Table:
        return self.table("staging", name, schema)

    def quarantine(self, name: str) -> Table:
        return self.table("quarantine", name)

    def intents(self, endpoint: str) -> Table:
        """The pages of each batch, written before anything else of the batch: (page, batch)."""
        return self.table("control", f"intents_{endpoint}")

    def reports(self, name: str) -> Table:
        return self.table("reports", name)

    def scratch(self, name: str) -> str:
        """Folder for intermediate tables: the shared checkpoint folder of the cluster where one is set."""
        shared = self.spark.conf.get("spark.checkpoint.dir", None)
        base = f"{shared.rstrip('/')}/ledgerline" if shared else f"{self.root}/scratch"
        return f"{base}/{self.run_id}/{name}"

    def release(self, *names: str) -> None:
        """Give back the space of scratch folders that nothing reads any more, if they were written."""
        for name in names:
            if Table(self.spark, self.scratch(name), T.StructType()).exists():  # with a schema, no file is opened
                emptied(self.spark, self.scratch(name))
