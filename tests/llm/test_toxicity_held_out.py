"""The classifier on labelled documents that it was not trained on, and with an id that floods the table."""

from pyspark.sql import functions as F

from estrella.llm import toxicity

DATA = "/root/testdata/sf0.01"


def test_held_out(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string")) < 1 << 31
    scored = toxicity.score_toxicity(docs, labels.filter(~held_out))
    asked = labels.filter(held_out).select("doc_id", F.col("toxic").alias("truth"))
    met = scored.join(asked, "doc_id").select("toxic", "truth", "score").collect()
    hits = sum(r["toxic"] and r["truth"] for r in met)
    called, true = sum(r["toxic"] for r in met), sum(r["truth"] for r in met)
    assert true >= 10 and hits >= 0.7 * true and hits >= 0.7 * called
    # the score ranks toxic documents above clean ones
    pairs = [(a["score"] > b["score"]) + 0.5 * (a["score"] == b["score"]) for a in met if a["truth"] for b in met if not b["truth"]]
    assert sum(pairs) / len(pairs) > 0.85


def test_an_id_with_many_rows(spark):
    rows = [(i, f"word{i % 7} plain text {'vile' if i % 2 else 'kind'}") for i in range(200)] + [(1, "vile word one")] * 3000
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    got = toxicity.score_toxicity(docs, labels).groupBy("doc_id", "toxic").count().collect()
    assert {r["doc_id"]: r["toxic"] for r in got} == {i: i % 2 for i in range(200)}
