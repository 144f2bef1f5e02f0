"""A training corpus from raw documents: filter, deduplicate, mix, pack."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estrella.llm import identity, jaccard_join, mixing, packing, toxicity
from estrella.session import materialize

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain calls toxic go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.score_toxicity(docs.select(COLUMNS), labels, keep_columns=True)
    return scored.filter("toxic = 0").select(COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares three quarters of its five-word shingles stays.

    That is the one with the smallest id; of its repeated rows one stays. Rows count by id and text, so an
    id may have several texts; rows without an id come last in their group. Documents without words are
    all kept, as they are near nothing.
    """
    keyed = identity.distinct_keys(docs.select(COLUMNS), "key", "doc_id", "text")
    classes = jaccard_join.jaccard_classes(keyed, "key").select(F.col("doc_id").alias("key"), "component_id").distinct()
    members = materialize(classes.join(keyed.select("key", "doc_id").distinct(), "key"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "key")
    # written, so that the join starts from plain shuffles and a large group can be split
    best = materialize(members.groupBy("component_id").agg(F.min_by("key", order).alias("best")))
    gone = members.join(best, "component_id").filter("key <> best").select("key", F.lit(True).alias("gone"))
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    counted = keyed.filter(worded).groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    repeated = counted.join(gone, "key", "left_anti").select("key", F.lit(False).alias("gone"))
    marked = keyed.join(materialize(gone.unionByName(repeated)), "key", "left")
    # of repeated rows every task sends one
    first = F.min(F.struct("lang", "source", "n_chars")).alias("row")
    once = marked.filter("NOT gone").groupBy("key").agg(F.any_value("doc_id").alias("doc_id"), F.any_value("text").alias("text"), first)
    return marked.filter("gone IS NULL").select(COLUMNS).unionByName(once.select("doc_id", "text", "row.*"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them.

    The document in which a source's share ends is cut after the last word taken. Documents without
    words take part in no mix and go.
    """
    sized = docs.select(COLUMNS).withColumn("size", mixing.word_count(F.col("text")))
    taken = mixing.mixed_sequence(mixing.mix(sized))
    # every piece is a word and the white space after it
    pieces = F.split(F.regexp_replace("text", r"^[\x20\x09-\x0D]+", ""), r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    first_words = F.array_join(F.slice(pieces, 1, F.col("part.take").cast("int")), "")
    whole = F.col("part.take") == F.col("size")
    return taken.withColumn("text", F.when(whole, F.col("text")).otherwise(first_words)).select(COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens."""
    return packing.pack_documents(docs, TOKENIZER, 2)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack),
]

# Two stages (a trained classifier, a similarity join) have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each stage's rows are written before the next one reads them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
