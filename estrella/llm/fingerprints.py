"""SimHash fingerprints of whole texts, and a search for all fingerprints within a Hamming radius.

The terms of a text are its word shingles. Each distinct term votes with its hash's bits, for a set
bit and against a clear one, weighted by 1 + log2 of how often it occurs; the signs of the sums are
the fingerprint. For the search, the 64 bits are cut into blocks. Two fingerprints that differ in at
most r bits agree in all but r blocks, so with r + k blocks they agree in some choice of k of them:
there is one table for each choice, keyed by the bits of the chosen blocks.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrella.llm.shipping import ship
from estrella.llm.words import ROWS_AT_ONCE, hashed_words, shingles
from estrella.session import materialize, shuffle_partitions

BITS = 64
PARTS_PER_PARTITION = 4


def simhashes(texts: list[bytes], width: int = 3) -> list[int]:
    """The fingerprints of UTF-8 texts (A-Z lower-cased, words split at ASCII white space); 0 without words."""
    return [_signs(shingles(h, width)) for h in hashed_words(texts)]


def _signs(votes_of: np.ndarray) -> int:
    terms, often = np.unique(votes_of, return_counts=True)
    if not len(terms):
        return 0
    weights = (1 + np.log2(often)).astype(np.float32)
    bits = np.unpackbits(terms.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).astype(np.float32)
    votes = 2 * (weights @ bits) - weights.sum()
    return int.from_bytes(np.packbits(votes > 0).tobytes(), "big")


def likeness(one: int, other: int) -> float:
    return 1 - (one ^ other).bit_count() / BITS


def fingerprint_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many (or
    all) of the next document in descending doc_id order, where the first follows the last. Ids are
    dealt into ranges with a known first id each; that row is also sent to the range before it, so
    every task finds the next row of each of its rows and no other text moves twice. NULL ids come
    last and follow each other in the order of their texts, as do rows with the same id. A NULL text
    is empty. A single row is its own next. Other columns are ignored; an empty input gives an empty
    result. Fingerprints are 16 hex digits.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )
    parts = PARTS_PER_PARTITION * shuffle_partitions(spark)
    cuts = F.percentile_approx("doc_id", F.array(*[F.lit(i / parts) for i in range(1, parts)]), 100 * parts)
    bounds = sorted(set(docs.agg(cuts.alias("c")).first()["c"] or []))
    # part 0 has the largest ids, the last part the NULL ids
    part = F.when(F.col("doc_id").isNull(), len(bounds) + 1).otherwise(
        F.lit(len(bounds)) - F.size(F.filter(F.array(*[F.lit(b) for b in bounds]).cast("array<bigint>"), lambda b: b <= F.col("doc_id")))
    )
    dealt = docs.withColumn("part", part.cast("int"))
    heads = {
        r["part"]: r["head"]
        for r in docs.select("doc_id").withColumn("part", part.cast("int")).groupBy("part").agg(F.max("doc_id").alias("head")).collect()
    }
    order = sorted(heads)
    before = {p: order[i - 1] for i, p in enumerate(order)}
    # the first row of a part (its largest id, smallest text) ends the part before it, as a guest
    tops = spark.createDataFrame([(p, heads[p], before[p]) for p in order], "p int, head long, prev int") if order else None
    if tops is None:
        rows = dealt.withColumn("guest", F.lit(False))
    else:
        top = dealt.join(F.broadcast(tops), (F.col("part") == F.col("p")) & F.col("doc_id").eqNullSafe(F.col("head")))
        first = top.groupBy("prev", "doc_id").agg(F.min("text").alias("text"))
        guests = first.select("doc_id", "text", F.col("prev").alias("part"), F.lit(True).alias("guest"))
        rows = dealt.withColumn("guest", F.lit(False)).unionByName(guests)
    sorted_ = rows.repartition(shuffle_partitions(spark), "part").sortWithinPartitions(
        "part", "guest", F.col("doc_id").desc_nulls_last(), "text"
    )

    def run(batches):
        held = None  # (doc_id, text, fingerprint): a row waits for the next one
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                rows_ = batch.slice(at, ROWS_AT_ONCE)
                guest, names, texts = (rows_.column(c).to_pylist() for c in ("guest", "doc_id", "text"))
                prints = simhashes([t.encode() for t in texts], width)
                made = []
                for end, name, text_, print_ in zip(guest, names, texts, prints, strict=True):
                    if held is not None:
                        made.append((*held, text_, print_))
                    held = None if end else (name, text_, print_)
                if made:
                    yield _compared(made, width)
        if held is not None:
            raise RuntimeError("a part without a guest at its end")

    return sorted_.mapInArrow(
        run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )


_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _compared(rows: list[tuple], width: int) -> pa.RecordBatch:
    """Result rows for (doc_id, text, fingerprint, next text, next fingerprint)."""
    edits = []
    for _, text, _, following, _ in rows:
        half = len(text) // 2
        edits.append((text[: len(text) - half] + following[:half]).encode())
    prints = simhashes(edits, width)
    columns = [
        pa.array([r[0] for r in rows], pa.int64()),
        pa.array([len(r[1]) for r in rows], pa.int64()),
        pa.array([hashlib.sha256(e).hexdigest() for e in edits]),
        pa.array([f"{r[2]:016x}" for r in rows]),
        pa.array([f"{p:016x}" for p in prints]),
        pa.array([likeness(r[2], p) for r, p in zip(rows, prints, strict=True)]),
        pa.array([likeness(r[2], r[4]) for r in rows]),
    ]
    return pa.RecordBatch.from_arrays(columns, names=_NAMES)


def block_masks(radius: int = 3, chosen: int = 2) -> list[int]:
    """One mask for each choice of ``chosen`` blocks out of ``radius + chosen``, as signed 64-bit numbers."""
    edges = [round(i * BITS / (radius + chosen)) for i in range(radius + chosen + 1)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    masks = [sum(c) for c in combinations(blocks, chosen)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def near_counts(queries: DataFrame, prints: DataFrame, radius: int = 3, chosen: int = 2) -> DataFrame:
    """(fingerprint, n_near): how many rows of ``prints`` lie within ``radius`` bits of each query fingerprint.

    Both frames have a column fingerprint (hex). Equal fingerprints are one entry with a count, so
    copies are not expanded; a pair that meets in several tables is kept in the first one only, by
    the join condition itself. NULL fingerprints are ignored; no queries give no rows.
    """
    masks = block_masks(radius, chosen)
    value = F.conv("fingerprint", 16, -10).cast("long")
    counted = prints.filter("fingerprint IS NOT NULL").groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n"))

    def tables(frame: DataFrame, print_: Column, *more: Column) -> DataFrame:
        keys = F.array(*[F.struct(F.lit(i).alias("t"), print_.bitwiseAND(m).alias("k")) for i, m in enumerate(masks)])
        return frame.select(print_.alias("f"), *more, F.explode(keys).alias("key")).select("f", *more, "key.t", "key.k")

    left = tables(queries.filter("fingerprint IS NOT NULL").select("fingerprint").distinct(), value, F.col("fingerprint")).alias("q")
    right = tables(counted, value, F.col("n")).alias("p")
    differ = F.col("q.f").bitwiseXOR(F.col("p.f"))
    earlier = F.slice(F.array(*[F.lit(m).cast("long") for m in masks]), 1, F.col("q.t"))
    same = (
        (F.col("q.t") == F.col("p.t"))
        & (F.col("q.k") == F.col("p.k"))
        & (F.bit_count(differ) <= radius)
        & F.forall(earlier, lambda m: differ.bitwiseAND(m) != 0)
    )
    # neither side has a proven bound, so neither is broadcast
    return left.join(right.hint("merge"), same).groupBy("q.fingerprint").agg(F.sum("p.n").alias("n_near"))
