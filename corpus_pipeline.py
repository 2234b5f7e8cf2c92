"""From raw documents to packed training sequences: quality, toxicity, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of docs. Rows whose
text is null count as empty texts, rows without a doc_id are judged by their text alone and are nobody's duplicates, and
columns beyond those of documents pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm import neardup, packing, quality, toxicity
from ledgerline.llm.queries import remainder
from ledgerline.llm.shared import free_name, stored, table, whole_text

GOOD_ENOUGH = 0.7
TOXIC = 0.5
SIMILAR_PERCENT = 80


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what the byte network takes for good (0.7 or more), fitted on labelled documents of this input."""
    network = quality.fit(docs, table(spark, sf_dir, "labels"), remainder(4) != 2)
    score = free_name(docs, "score")
    return quality.scored(docs, network, into=score).filter(F.col(score) >= GOOD_ENOUGH).select(*names(docs))


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the regularised classifier takes for toxic (0.5 or more), fitted on labelled documents of this input."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), remainder(5) != 0)
    score = free_name(docs, "score")
    return toxicity.scored(docs, model, into=score).filter(F.col(score) < TOXIC).select(*names(docs))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of smallest id in each group linked by a Jaccard similarity of 0.8, once if its row repeats.

    Different texts of one id are different documents.
    """
    key, number = free_name(docs, "document"), free_name(docs, "number")
    document = F.struct("doc_id", F.xxhash64(whole_text("text")).alias("text"))
    keyed = docs.withColumn(key, F.when(F.col("doc_id").isNotNull(), document))
    judged = stored(neardup.near_duplicates(keyed, SIMILAR_PERCENT, key).select(key, "kept"), "judged")
    left = keyed.join(judged.filter("not kept").select(key).distinct(), key, "left_anti")
    repeated = judged.filter(F.col("kept") & F.col(key).isNotNull()).groupBy(key).count().filter("count > 1").select(key)
    if not repeated.isEmpty():
        order = Window.partitionBy(key).orderBy("text", *[F.xxhash64(name) for name in names(docs)])
        several = left.join(repeated, key, "left_semi").withColumn(number, F.row_number().over(order))
        left = left.join(repeated, key, "left_anti").unionByName(several.filter(F.col(number) == 1).drop(number))
    return left.select(*names(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows of 2048 ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


def names(docs: DataFrame) -> list[str]:
    return [f"`{name}`" for name in docs.columns]


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_quality), ("toxicity", not_toxic), ("near_duplicates", one_of_each), ("packing", packed),
]

#: SQL cannot express trained classifiers; tests/llm/test_corpus_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each stage's result written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
