"""Layer tables: plain Parquet folders, most of them partitioned.

Spark writes and reads them like any other folder; nothing lists their files. What a run replaces is a partition: a batch
of Bronze or of a quarantine, a key bucket of Silver or Gold. The stage drivers see to it that a run that dies
is repeated or finished (see ``plans.progress``), so a table needs no history of its own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = "bucket"

# From each type to those that hold all its values: Parquet files of the old type are read as the new one.
WIDER = {
    "tinyint": ("smallint", "int", "bigint", "double"),
    "smallint": ("int", "bigint", "double"),
    "int": ("bigint", "double"),
    "float": ("double",),
    "date": ("timestamp_ntz",),
}


class SchemaChange(ValueError):
    """A batch whose columns do not fit the stored ones."""


def merged_schema(name: str, stored: T.StructType | None, batch: T.StructType) -> T.StructType:
    """The stored columns, widened where the batch has a wider type, and the batch's further ones. Refuses, by name, a
    batch with a type that is narrower than the stored one or has nothing to do with it. All columns may be null."""
    if stored is None:
        return T.StructType([T.StructField(f.name, f.dataType) for f in batch.fields])
    incoming = {field.name: field.dataType for field in batch.fields}
    fields = []
    for field in stored.fields:
        old, new = field.dataType, incoming.pop(field.name, field.dataType)
        if _plain(new) != _plain(old) and new.simpleString() not in WIDER.get(old.simpleString(), ()):
            raise SchemaChange(f"{name}.{field.name} is {old.simpleString()}, the batch has {new.simpleString()}")
        fields.append(T.StructField(field.name, old if _plain(new) == _plain(old) else new))
    return T.StructType(fields + [T.StructField(name, kind) for name, kind in incoming.items()])


def _plain(kind: T.DataType) -> str:
    return kind.simpleString()


def fitted(df: DataFrame, schema: T.StructType) -> DataFrame:
    """df with exactly these columns; those it lacks are typed NULLs."""
    def column(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`") if field.name in df.columns else F.lit(None)
        return value.cast(field.dataType).alias(field.name)

    return df.select(*[column(field) for field in schema.fields])


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def with_bucket(df: DataFrame, key: str, buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, bucket_of(key, buckets))


def touched_buckets(df: DataFrame) -> list[int]:
    """The buckets these rows fall into: no more values than a table has buckets."""
    return sorted(row[0] for row in df.select(BUCKET).distinct().collect())


def broadcast_bytes(df: DataFrame) -> int:
    """Bytes that the driver, and every executor, holds when these rows are broadcast to a join, from one aggregate. Each row
    stands in a hash map twice, as key and as value, in words of eight bytes with an offset for every text; the map
    itself takes about 64 bytes a row. A short text key is so held in 112 bytes."""
    row = F.lit(8 + 8 * len(df.columns)).cast("long")
    for name, kind in df.dtypes:
        if kind == "string":
            row = row + F.coalesce(F.ceil(F.octet_length(name) / 8) * 8, F.lit(0)).cast("long")
    return df.agg(F.coalesce(F.sum(row * 2 + 64), F.lit(0))).first()[0]


def fitting(sizes: Mapping[str, int], most: int) -> set[str]:
    """The smallest of these that take no more than ``most`` together."""
    found, left = set(), most
    for name, size in sorted(sizes.items(), key=lambda item: item[1]):
        if size <= left:
            found.add(name)
            left -= size
    return found


class Table:
    def __init__(self, spark: SparkSession, root: str, schema: T.StructType | None = None):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema

    def exists(self) -> bool:
        try:
            self.read()
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return False
            raise
        return True

    def read(self) -> DataFrame:
        """The table as it is when the result is computed. Columns that older files lack are NULL, narrower types are
        read as the present ones."""
        if self.schema is None:
            return self.spark.read.option("mergeSchema", True).parquet(self.root)
        return self.spark.read.schema(self.schema).parquet(self.root).select(*self.schema.names)

    def buckets(self, numbers: Sequence[int]) -> DataFrame:
        """Only the files of these buckets."""
        return self.read().where(F.col(BUCKET).isin(list(numbers)))

    def replace(self, df: DataFrame, *partition_by: str, in_place: bool = False) -> None:
        """The whole table anew. df must not read it. ``in_place`` writes the rows where they are, without a shuffle: for
        rows that stand together by partition already."""
        _writer(df, partition_by, in_place).parquet(self.root)

    def replace_parts(self, df: DataFrame, *partition_by: str, in_place: bool = False) -> None:
        """The partitions that df has rows for; each appears whole, by a rename. The others stay, df must not read these."""
        _writer(df, partition_by, in_place).option("partitionOverwriteMode", "dynamic").parquet(self.root)

    def put(self, df: DataFrame, partition: str, value: object) -> None:
        """One partition, also where df is empty and there are rows to remove."""
        compact(df).mode("overwrite").parquet(f"{self.root}/{partition}={value}")


def _writer(df: DataFrame, partition_by: Sequence[str], in_place: bool = False):
    if not partition_by:
        return compact(df).mode("overwrite")
    # AQE merges small and splits large partition values into files of a sensible size
    return compact(df if in_place else df.hint("rebalance", *partition_by)).mode("overwrite").partitionBy(*partition_by)


def emptied(spark: SparkSession, folder: str) -> None:
    """Give back the space of a folder whose rows stand elsewhere by now."""
    compact(spark.range(0, numPartitions=1)).mode("overwrite").parquet(folder)


def compact(df: DataFrame) -> DataFrameWriter:
    """Every row is written several times on its way, so files are kept small."""
    return df.write.option("compression", "zstd")
