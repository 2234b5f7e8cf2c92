"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from . import bpe, multiindex, neardup, order, packing, phrases, quality, shards, sketch, toxicity, trie, viterbi, whitening
from .shared import new_folder, stored, table

SHARDS = 40


def op1_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shards.tree([1.0] * SHARDS)
    placed = shards.assign(table(spark, sf_dir, "documents"), root, shards.grow(root))
    return placed.withColumn("law", F.lit("key"))


def op2_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return viterbi.counted(documents, public_tokenizers.path("piece_bpe_32k.model")).select("doc_id", "n_tokens")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode(documents, ranks, public_tokenizers.PATTERN)
    numbers = F.replace(F.col("ids").cast("string"), F.lit(","), F.lit(""))  # "[1 2 3]"
    encoded = encoded.select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.btrim(numbers, F.lit("[]")), 256).alias("ids_sha256"),
    )
    return bpe.decode(encoded, ranks).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("bytes", 256).alias("decoded_sha256")
    )


def op6_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op7_sum_of_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    paired = sketch.with_next(table(spark, sf_dir, "documents"), "doc_id", "text", "next")
    n, moved = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - moved), F.substring("next", F.lit(1), moved))
    texts = paired.select("doc_id", n.cast("long").alias("n_chars"), "text", edited.alias("edited"), "next")
    prints = texts.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        *[sketch.retained(sketch.hashes(F.col(name))).alias(name) for name in ("text", "edited", "next")],
    )
    return prints.select(
        "doc_id", "n_chars", "edited_sha256", sketch.as_text(F.col("text")).alias("fingerprint"),
        sketch.as_text(F.col("edited")).alias("edited_fingerprint"),
        sketch.containment(F.col("text"), F.col("edited")).alias("near_edited"),
        sketch.containment(F.col("text"), F.col("next")).alias("near_next"),
    )


def remainder(modulus: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def op5_byte_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, held_out = table(spark, sf_dir, "documents"), remainder(4) == 2
    network = quality.fit(documents, table(spark, sf_dir, "labels"), ~held_out)
    scored = quality.scored(documents.select("doc_id", "text"), network)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op8_counterfactual(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, held_out = table(spark, sf_dir, "documents"), remainder(5) == 0
    model = toxicity.fit(documents, table(spark, sf_dir, "labels"), ~held_out)
    scored = toxicity.scored(documents.select("doc_id", "text"), model, into="score")
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op9_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiindex.near_vectors(table(spark, sf_dir, "embeddings"))


def op10_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the word tokenizer, two bytes each, and 65535, which the vocabulary lacks, at the end of each document.

    The texts are encoded once; the stored ids are counted, cut and written.
    """
    folder = new_folder(spark, "training-order")
    ids = order.token_ids(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return order.materialise(stored(ids, "ids", compression="zstd"), folder, width=2).withColumn("folder", F.lit(folder))


OPENINGS = 5  # conversations that share an opening
MOST_SHARED = 9


def opened_alike(first: int, block: dict[int, list[trie.Turn]]) -> dict[int, list[trie.Turn]]:
    """Each conversation with its first turns taken from the first one of its block, if that is there."""
    taken = {conv: zlib.crc32(str(conv).encode()) % MOST_SHARED for conv in block}
    return {conv: block.get(first, [])[: taken[conv]] + turns[taken[conv] :] for conv, turns in block.items()}


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.col("conv_id") - F.col("conv_id") % OPENINGS
    return trie.prefix_trie(table(spark, sf_dir, "conversations"), first, opened_alike)


OP11_SQL = """
WITH RECURSIVE crc(c, i, state) AS (
    SELECT DISTINCT conv_id, 0, CAST(4294967295 AS BIGINT) FROM conversations WHERE conv_id IS NOT NULL
    UNION ALL
    SELECT c, i + 1, xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END) FROM (
        SELECT c, i, CASE WHEN i % 8 = 0 THEN xor(state, ascii(substr(CAST(c AS VARCHAR), i // 8 + 1, 1))) ELSE state END AS x
        FROM crc WHERE i < 8 * length(CAST(c AS VARCHAR))) AS bit
),
taken AS (SELECT c, xor(state, 4294967295) % 9 AS h FROM crc WHERE i = 8 * length(CAST(c AS VARCHAR))),
said AS (
    SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p
    FROM conversations WHERE conv_id IS NOT NULL
),
rebuilt AS (
    SELECT c, role, text, row_number() OVER (PARTITION BY c ORDER BY part, p) AS d FROM (
        SELECT taken.c, 0 AS part, said.p, role, text FROM taken JOIN said ON said.c = taken.c - taken.c % 5 AND said.p <= h
        UNION ALL
        SELECT taken.c, 1, said.p, role, text FROM taken JOIN said ON said.c = taken.c AND said.p > h) AS parts
),
prefixes AS (
    SELECT c, d, md5(CAST(list(md5(concat(length(role), ' ', role, text))) OVER (PARTITION BY c ORDER BY d) AS VARCHAR)) AS path,
           octet_length(encode(text)) AS size
    FROM rebuilt
    UNION ALL SELECT c, 0, '', 0 FROM taken
),
ends AS (
    SELECT path, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids
    FROM (SELECT c, path, d = max(d) OVER (PARTITION BY c) AS is_end FROM prefixes) AS last WHERE is_end GROUP BY path
),
nodes AS (
    SELECT path, min(d) AS depth, min(c) AS conv_id, count(*) AS n_convs, min(size) AS size, min(above) AS above
    FROM (SELECT *, lag(path) OVER (PARTITION BY c ORDER BY d) AS above FROM prefixes) AS stepped GROUP BY path
),
children AS (SELECT above AS path, count(*) AS n_children FROM nodes WHERE above IS NOT NULL GROUP BY above),
subtrees AS (
    SELECT prefixes.path, count(*) FILTER (WHERE children.path IS NULL) AS n_leaves, sum((n_convs - 1) * size_) AS saved_tokens
    FROM (SELECT path AS own_path, depth, conv_id, n_convs, size AS size_ FROM nodes) AS own
    JOIN prefixes ON prefixes.c = own.conv_id AND prefixes.d <= own.depth
    LEFT JOIN children ON children.path = own_path
    GROUP BY prefixes.path
)
SELECT nodes.conv_id, CAST(nodes.depth AS BIGINT) AS depth, parents.conv_id AS parent_conv_id, nodes.n_convs,
       coalesce(n_children, 0) AS n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens,
       sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes JOIN subtrees USING (path) LEFT JOIN children USING (path) LEFT JOIN ends USING (path)
LEFT JOIN nodes AS parents ON parents.path = nodes.above
"""


def op12_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = phrases.index(table(spark, sf_dir, "documents"))
    found = phrases.search(built, table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, span: n + span["last"] - span["first"] + 1)
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


OP12_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id, w, len(w) AS n FROM (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents) AS cut
),
items AS (
    SELECT item_id, w, len(w) AS n, least(len(w), 10) AS length FROM (
        SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark) AS cut
    WHERE len(w) > 0
),
windows AS (
    SELECT DISTINCT item_id, length, array_to_string(w[place : place + length - 1], ' ') AS words
    FROM (SELECT *, unnest(range(1, n - length + 2)) AS place FROM items) AS placed
),
grams AS (
    SELECT row, place, length, array_to_string(w[place : place + length - 1], ' ') AS words
    FROM (SELECT *, unnest(range(1, n - length + 2)) AS place FROM docs, (SELECT DISTINCT length FROM windows) AS lengths) AS placed
),
found AS (SELECT row, place, grams.length, item_id FROM grams JOIN windows USING (length, words)),
hits AS (
    SELECT row, count(DISTINCT word) AS n_hit FROM (SELECT row, unnest(range(place, place + length)) AS word FROM found) AS covered
    GROUP BY row
),
named AS (
    SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) AS listed GROUP BY row
)
SELECT doc_id, n AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hits USING (row) LEFT JOIN named USING (row)
"""


def op13_spectrum_slicing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_hash_tree": op1_hash_tree,
    "op2_viterbi": op2_viterbi,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_scaled_sketch": op4_scaled_sketch,
    "op5_byte_network": op5_byte_network,
    "op6_bottom_k": op6_bottom_k,
    "op7_sum_of_squares": op7_sum_of_squares,
    "op8_counterfactual": op8_counterfactual,
    "op9_multi_index": op9_multi_index,
    "op10_training_order": op10_training_order,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_positional_index": op12_positional_index,
    "op13_spectrum_slicing": op13_spectrum_slicing,
}

#: SQL that gives the same rows, where SQL can express the operator on whole tables.
SQL: dict[str, str] = {"op11_prefix_trie": OP11_SQL, "op12_positional_index": OP12_SQL}
