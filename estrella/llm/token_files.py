"""Token ids in ORC files: ordered by document id, cut into parts that tasks read on their own.

ORC keeps integers in run-length encoded streams, each stripe with an index of its rows and a Bloom
filter on the document ids. Stripes are read by separate tasks, and a filter on document ids skips
the files, stripes and row groups whose statistics or filters rule the ids out.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from estrella.llm.shipping import ship
from estrella.llm.tokens import encode_all
from estrella.llm.words import in_slices, utf8_texts
from estrella.session import shuffle_partitions

PARTS_PER_PARTITION = 3


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    doc_id: str = "doc_id",
    text: str = "text",
    stripe_bytes: int = 16 << 20,
    rows_per_index: int = 1000,
) -> None:
    """Write (part, doc_id, ids) as ORC under ``path``; parts and rows ascend by document id.

    Every row of ``docs`` becomes one row with the ids of its whole text and ``end_id``. The parts
    are ranges of ids with about equally many rows, found from approximate percentiles; texts are
    encoded where they are read and only ids are shuffled. NULL ids come first, a NULL text is
    empty, rows with the same id stand in the order of their ids' checksums. Other columns are
    ignored. An empty input writes no rows (and reads back as none).
    """
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text")
    )
    parts = PARTS_PER_PARTITION * shuffle_partitions(spark)
    cuts = F.percentile_approx("doc_id", F.array(*[F.lit(i / parts) for i in range(1, parts)]), 100 * parts)
    bounds = np.array(sorted(set(docs.agg(cuts.alias("c")).first()["c"] or [])), np.int64)

    def one(batch):
        end = np.array([end_id], "<u4").tobytes()
        made = [ids + end for ids in encode_all(utf8_texts(batch, "text"), tokenizer)]
        ids = np.frombuffer(b"".join(made), "<u4").astype(np.int32)
        offsets = np.concatenate([[0], np.cumsum([len(m) // 4 for m in made])]).astype(np.int32)
        known = batch.column("doc_id")
        numbers = known.fill_null(0).to_numpy(zero_copy_only=False)
        part = np.where(known.is_valid().to_numpy(zero_copy_only=False), np.searchsorted(bounds, numbers, "right"), 0)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(part.astype(np.int32)),
                known,
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)),
                pa.array([zlib.crc32(m) for m in made], pa.int64()),
            ],
            names=["part", "doc_id", "ids", "crc"],
        )

    encoded = docs.mapInArrow(in_slices(one), "part int, doc_id long, ids array<int>, crc long")
    dealt = encoded.repartition(shuffle_partitions(spark), "part").sortWithinPartitions("part", "doc_id", "crc")
    (
        dealt.drop("crc")
        .write.partitionBy("part")
        .option("orc.stripe.size", stripe_bytes)
        .option("orc.row.index.stride", rows_per_index)
        .option("orc.create.index", "true")
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("compression", "zstd")
        .mode("overwrite")
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, ids, part) of a written folder; filters on doc_id and part are pushed to the files."""
    return spark.read.schema("doc_id long, ids array<int>, part int").orc(path)


def token_index(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document of ``read_tokens``; start counts all earlier ids."""
    ship(tokens.sparkSession)

    def one(batch):
        ids = batch.column("ids")
        values = ids.values.to_numpy(zero_copy_only=False).astype("<u4")
        offsets = ids.offsets.to_numpy()
        sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        return pa.RecordBatch.from_arrays(
            [batch.column("part"), batch.column("doc_id"), pa.array(np.diff(offsets).astype(np.int64)), pa.array(sums, pa.int64())],
            names=["part", "doc_id", "n_tokens", "ids_crc32"],
        )

    rows = tokens.select("part", "doc_id", "ids").mapInArrow(
        in_slices(one), "part int, doc_id long, n_tokens long, ids_crc32 long"
    )
    in_part = Window.partitionBy("part").orderBy("doc_id", "ids_crc32", "n_tokens")
    earlier = in_part.rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("at", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)))
    sizes = rows.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    return placed.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )
