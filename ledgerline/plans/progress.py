"""How far each stage has come: one row for every (pipeline, table), in a Parquet partition of its own.

The row is written before and after the tables are touched:

* ``batch`` is the number of the last batch that is done with, ``row_count`` what the last one wrote.
* ``pending`` is the batch up to which a running stage takes rows. It is fixed first, so a stage that died takes the same
  rows again.
* ``staged`` says that the next state of the touched buckets stands complete in the staging folder and may be moved
  into the table; a run that died while moving is finished from there.

Should a crash lose the row itself (Spark removes a partition's files right before it renames the new ones), the stage
starts from its first batch: every stage gives the same tables when rows are taken again.
"""

from __future__ import annotations

import json
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.schemas import PIPELINE_METADATA, PROGRESS, TRACKED_TABLES
from ledgerline.sources.tables import Table

KEYS = ("pipeline_name", "table_name")

# Rows of this name hold what is agreed for the whole lakehouse.
LAYOUT = "layout"

# Rows of this name hold how far each mart, and each copy that marts are made from, has taken its sources.
MARTS = "marts"


class State(NamedTuple):
    last_processed_timestamp: datetime | None = None
    batch: int = 0
    row_count: int | None = None
    pending: int | None = None
    staged: bool = False
    table_schema: str | None = None

    @property
    def schema(self) -> T.StructType | None:
        return T.StructType.fromJson(json.loads(self.table_schema)) if self.table_schema else None


class Progress:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.table = Table(spark, root, PROGRESS)
        self.known: dict[tuple[str, str], State] | None = None

    def refresh(self) -> None:
        """Read the rows again: a stage that starts must know what others have done."""
        rows = self.table.read().collect() if self.table.exists() else []
        self.known = {(row["pipeline_name"], row["table_name"]): State(*[row[f] for f in State._fields]) for row in rows}

    def ensure(self) -> None:
        """Create the table on the first run, with a row for every tracked table."""
        self.refresh()
        if not self.known:
            self._write({pair: State() for pair in TRACKED_TABLES})

    def of(self, pipeline: str, table: str) -> State:
        if self.known is None:
            self.refresh()
        return self.known.get((pipeline, table), State())

    def save(self, pipeline: str, table: str, mark: datetime | None = None, **changes) -> None:
        """Change these values of the row; the mark never moves back and never returns to NULL."""
        state = self.of(pipeline, table)
        marks = [m for m in (state.last_processed_timestamp, mark) if m is not None]
        self._write({(pipeline, table): state._replace(last_processed_timestamp=max(marks, default=None), **changes)})

    def _write(self, states: dict[tuple[str, str], State]) -> None:
        rows = [(*pair, *state) for pair, state in states.items()]
        self.table.replace_parts(self.spark.createDataFrame(rows, PROGRESS).coalesce(1), *KEYS)
        self.known.update(states)

    def metadata(self) -> DataFrame:
        """The watermarks: (pipeline_name, table_name, last_processed_timestamp)."""
        return self.table.read().where(~F.col("pipeline_name").isin(LAYOUT, MARTS)).select(*PIPELINE_METADATA.names)

    def row_counts(self) -> DataFrame:
        """Rows of the last write of each table that was written."""
        return self.table.read().where(F.col("row_count").isNotNull()).select(*KEYS, "row_count")
