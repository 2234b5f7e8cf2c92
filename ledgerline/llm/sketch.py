"""Threshold-scaled document fingerprints.

A text's shingles (five words each; the whole word sequence if it has fewer) are hashed to 64 bits, and every hash below
a fixed fraction of the hash space is retained. Two fingerprints are comparable whatever their texts' lengths, and the
fingerprint of several texts' shingles follows from their fingerprints (``merged``). A text none of whose hashes lies below the threshold
keeps its smallest one, so that only texts without words have an empty fingerprint. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import whole_text

SHINGLE = 5
FRACTION = 0.25
ROWS_PER_BUCKET = 4_000
#: Bounds of the number of buckets: so many for each shuffle partition at least, so many in all at most (the driver
#: holds one short row for each).
LEAST_BUCKETS, MOST_BUCKETS = 4, 4096


def let(value: Column, body) -> Column:
    """body(value) with value computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def hashes(text: Column, shingle: int = SHINGLE, fold: bool = True) -> Column:
    """The hash of every shingle of the text's words (in lower case unless fold is off, cut at ASCII white space), in
    text order."""
    words = F.filter(F.split(F.lower(text) if fold else text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    none = F.array().cast("array<bigint>")

    def shingles(word: Column) -> Column:
        many = F.transform(
            F.sequence(F.lit(1), F.size(word) - (shingle - 1)),
            lambda i: F.xxhash64(*[F.element_at(word, (i + k).cast("int")) for k in range(shingle)]),
        )
        return F.when(F.size(word) >= shingle, many).when(F.size(word) > 0, F.array(F.xxhash64(word))).otherwise(none)

    # Words are hashed once; a shingle's hash is made of its words' hashes.
    return let(F.transform(words, lambda w: F.xxhash64(w)), shingles)


def retained(all_hashes: Column, fraction: float = FRACTION) -> Column:
    """The distinct hashes below the threshold in ascending order; the smallest one where none is below."""
    threshold = int(-(2**63) + 2**64 * fraction)

    def chosen(found: Column) -> Column:
        below = F.filter(found, lambda h: h < F.lit(threshold))
        some = F.when(F.exists(found, lambda h: h < F.lit(threshold)), below)
        return F.array_sort(F.array_distinct(some.otherwise(F.array_compact(F.array(F.array_min(found))))))

    return let(all_hashes, chosen)


def merged(first: Column, second: Column, fraction: float = FRACTION) -> Column:
    """The fingerprint of two texts together: a hash that one of them keeps for want of one below the threshold goes, if the
    other has one."""
    return retained(F.concat(first, second), fraction)


def containment(first: Column, second: Column) -> Column:
    """How much of the smaller fingerprint lies in the other: 0 to 1; 1 for two empty ones, 0 for one empty."""
    least = F.least(F.size(first), F.size(second))
    shared = F.size(F.array_intersect(first, second))
    return (
        F.when(least > 0, shared / least)
        .when(F.size(first) == F.size(second), F.lit(1.0)).otherwise(F.lit(0.0))
    )


def as_text(fingerprint: Column) -> Column:
    """Sixteen hexadecimal digits for each retained hash."""
    return F.array_join(F.transform(fingerprint, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def from_text(text: Column) -> Column:
    """The fingerprint that as_text wrote."""
    pieces = F.regexp_extract_all(text, F.lit("([0-9A-F]{16})"), 1)
    # Two halves: a 16-digit number does not fit a signed conversion.
    return F.transform(
        pieces,
        lambda p: F.shiftleft(F.conv(F.substring(p, 1, 8), 16, 10).cast("long"), 32).bitwiseOR(
            F.conv(F.substring(p, 9, 8), 16, 10).cast("long")
        ),
    )


def with_next(df: DataFrame, key: str, text: str, into: str) -> DataFrame:
    """key, text (null: empty) and, in ``into``, the text of the next row in descending key order; the last one's next
    is the first. A single row is its own next. Null keys come last; rows with equal keys follow each other by text.

    Rows are dealt into buckets of neighbouring keys with bounds from quantiles; the first row of every bucket also goes,
    as a guest, to the bucket before it, so that every bucket knows all its next rows and no text moves twice.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).alias("key"), whole_text(text).alias("text"))
    facts = rows.agg(F.count(F.lit(1)), F.count("key")).first()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = min(MOST_BUCKETS, max(LEAST_BUCKETS * parts, -(-facts[0] // ROWS_PER_BUCKET)))
    bounds: list = []
    if facts[1]:
        shares = [i / wanted for i in range(1, wanted)]
        bounds = sorted(set(rows.agg(F.percentile_approx("key", shares, 20 * wanted)).first()[0]))
    rows = rows.withColumn("bucket", _bucket("key", bounds))
    # The first row of a bucket has its largest key; among equal keys the smallest text hash leads.
    rows = rows.withColumn("tie", F.xxhash64("text"))
    leader = F.max(F.struct(F.col("key").isNotNull().alias("known"), "key", F.bitwise_not("tie").alias("turned")))
    heads = (
        rows.groupBy("bucket").agg(leader.alias("head"))
        .select("bucket", F.col("head.key").alias("head"), F.bitwise_not(F.col("head.turned")).alias("head_tie"))
    ).collect()  # one short row for each bucket
    order = sorted(heads, key=lambda h: -h["bucket"])
    host = {order[i]["bucket"]: order[i - 1]["bucket"] for i in range(len(order))}
    of_bucket = lambda values: F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), F.col("bucket"))
    if not order:
        return rows.select(F.col("key").alias(key), F.col("text").alias(text), F.lit("").alias(into))
    head_key = of_bucket({h["bucket"]: h["head"] for h in order if h["head"] is not None} or {-1: 0})
    is_head = F.col("tie").eqNullSafe(of_bucket({h["bucket"]: h["head_tie"] for h in order})) & F.col("key").eqNullSafe(head_key)
    seat = F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("guest"))
    guest = F.struct(of_bucket(host).alias("bucket"), F.lit(1).alias("guest"))
    seats = F.when(is_head, F.array(seat, guest)).otherwise(F.array(seat))
    seated = rows.select("key", "text", "tie", F.explode(seats).alias("seat")).select("key", "text", "tie", "seat.*")
    inside = Window.partitionBy("bucket").orderBy("guest", F.col("key").desc_nulls_last(), "tie", "text")
    return (
        seated.withColumn("next", F.lead("text").over(inside)).filter("guest = 0")
        .select(F.col("key").alias(key), F.col("text").alias(text), F.col("next").alias(into))
    )


def _bucket(key: str, bounds: list) -> Column:
    """1 + the number of bounds at or below the key, found in two steps; 0 for a null key."""
    if not bounds:
        return F.when(F.col(key).isNull(), F.lit(0)).otherwise(F.lit(1))
    step = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    coarse = F.array(*[F.lit(g[0]) for g in groups])
    group = F.size(F.filter(coarse, lambda b: b <= F.col(key)))
    fine = F.element_at(F.array(*[F.array(*[F.lit(b) for b in g]) for g in groups]), F.greatest(group, F.lit(1)))
    inside = F.size(F.filter(fine, lambda b: b <= F.col(key)))
    return F.when(F.col(key).isNull(), F.lit(0)).otherwise(1 + F.greatest(group - 1, F.lit(0)) * step + inside)


def fingerprints(df: DataFrame, text: str = "text", into: str = "fingerprint") -> DataFrame:
    """df with the array of retained hashes of each whole text (a null text counts as empty: none) in column ``into``."""
    return df.withColumn(into, retained(hashes(whole_text(text))))
