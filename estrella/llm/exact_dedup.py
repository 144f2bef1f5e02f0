"""Exact copies by a persistent index of digests.

The index is a Parquet table with one row per known text: the digest of the normalised text and the document
that stands for it, bucketed and sorted by the digest. A load is reduced to the best document of each
digest, meets the index in a sort-merge anti-join, and what the index does not hold (or holds by a worse document)
is appended bucket by bucket. The index itself is not shuffled for that, and loads may come in any order: the
best of all appended documents stands for a text. Everything runs in the JVM.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from estrella.session import materialize, materialize_counted, shuffle_partitions

WHITE = r"[\x20\x09-\x0D]+"
# A digest that more than this share of all rows have is looked up by broadcast: at most as many such digests exist.
HOT_SHARE = 1000

_SPEC = "digest BINARY, n_chars BIGINT, doc_id BIGINT, load STRING, row BIGINT"


def normalised(text: Column) -> Column:
    """The text without white space; NULL becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, "")


def digest_rows(docs: DataFrame, load: Column | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, digest, n_chars, load, row) of every row, written once; ``row`` tells equal rows apart.

    ``load`` names the load that a row belongs to, the empty name if it is not given. Digests are SHA-256 of the
    whole normalised text in UTF-8, ``n_chars`` counts the code points of the text as it is. NULL texts
    count as empty; NULL ids stay NULL. Other columns are ignored.
    """
    body = F.col(f"`{text}`")
    return materialize(
        docs.select(
            F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
            F.unhex(F.sha2(normalised(body).cast("binary"), 256)).alias("digest"),
            F.length(F.coalesce(body, F.lit(""))).cast("long").alias("n_chars"),
            (F.lit("") if load is None else load).alias("load"),
            F.monotonically_increasing_id().alias("row"),
        )
    )


def _rank(side: str = "") -> Column:
    """Smaller is better: more code points, then a smaller id, rows without an id last."""
    at = f"{side}." if side else ""
    return F.struct((-F.col(f"{at}n_chars")).alias("n"), F.col(f"{at}doc_id").isNull().alias("u"), F.col(f"{at}doc_id").alias("i"))


def _best(rows: DataFrame) -> DataFrame:
    """The best row of each digest; only one candidate per digest and task is shuffled."""
    whole = F.min(F.struct(_rank().alias("rank"), "load", "row"))
    return rows.groupBy("digest").agg(whole.alias("b")).select(
        "digest", (-F.col("b.rank.n")).alias("n_chars"), F.col("b.rank.i").alias("doc_id"), "b.load", "b.row"
    )


class DigestIndex:
    """The index below the folder ``path``, which all executors must reach; it is created if it is not there.

    Generations are subfolders that carry their number of buckets; the newest complete one is read. A load that
    was stopped half-way is simply appended again: what is there already is found and skipped. Two writers
    at once may append the same digest twice, which readers do not notice. ``compact`` must run alone.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        generation, found = self._newest()
        if not found:
            generation, found = 1, buckets or shuffle_partitions(spark)
        self.generation, self.buckets = generation, found
        self.table = self._register(self._folder(generation, found), found)

    def rows(self) -> DataFrame:
        """Everything appended so far; a digest has several rows after better documents came for it."""
        return self.spark.table(self.table)

    def append(self, rows: DataFrame) -> int:
        """Add a load, rows of ``digest_rows``; returns how many index rows it added. An empty load adds none."""
        with self._bucketed():
            fresh, n = materialize_counted(self._unknown(rows))
            if n:
                self._write(fresh, self.table)
        self.spark.catalog.refreshTable(self.table)
        return n

    def _unknown(self, rows: DataFrame) -> DataFrame:
        best, known = _best(rows).alias("b"), self.rows().alias("k")
        held = (F.col("b.digest") == F.col("k.digest")) & (_rank("k") <= _rank("b"))
        return best.hint("merge").join(known, held, "left_anti").select("digest", "n_chars", "doc_id", "load", "row")

    def decide(self, rows: DataFrame) -> DataFrame:
        """(doc_id, keep_id, group_size, kept, text_sha256) of rows that were appended, one row for each.

        ``keep_id`` is the id of the document that stands for the text and ``kept`` whether it is this row. Of rows
        that tie in length and id, one stays. ``group_size`` counts the given rows with an equal text. A digest with more
        than a thousandth of all rows meets them by broadcast (there are at most a thousand such), the
        others by a join on the digest. No rows give no rows.
        """
        with self._bucketed():
            sizes = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
            stands = _best(self.rows()).select(
                "digest", F.col("doc_id").alias("keep_id"), F.col("load").alias("_load"), F.col("row").alias("_row")
            )
            named = materialize(sizes.join(stands, "digest"))
        total = rows.agg(F.count(F.lit(1))).scalar()
        hot = materialize(named.filter(F.col("group_size") * HOT_SHARE > total))
        many = rows.join(F.broadcast(hot), "digest")
        few = rows.join(F.broadcast(hot.select("digest")), "digest", "left_anti").join(
            named.join(F.broadcast(hot.select("digest")), "digest", "left_anti"), "digest"
        )
        return many.unionByName(few).select(
            "doc_id",
            "keep_id",
            "group_size",
            ((F.col("row") == F.col("_row")) & (F.col("load") == F.col("_load"))).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )

    def compact(self) -> None:
        """Write the next generation: one row per digest and one sorted file per bucket. The old one stays."""
        folder = self._folder(self.generation + 1, self.buckets)
        with self._bucketed():
            table = self._register(folder, self.buckets)
            self._write(_best(self.rows()), table)
        self.generation, self.table = self.generation + 1, table
        self.spark.catalog.refreshTable(table)

    def _write(self, rows: DataFrame, table: str) -> None:
        # as many partitions as buckets on the same hash: a bucket's rows are one task's, and get one file
        dealt = rows.repartition(self.buckets, "digest").sortWithinPartitions("digest")
        dealt.write.mode("append").insertInto(table)

    def _register(self, folder: str, buckets: int) -> str:
        """The catalog of a session may be new; the files tell their bucket by their names."""
        table = f"digests_{md5(folder.encode()).hexdigest()}"
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({_SPEC}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{folder}'"
        )
        return table

    def _folder(self, generation: int, buckets: int) -> str:
        return f"{self.path}/g{generation:06d}-b{buckets}"

    def _newest(self) -> tuple[int, int]:
        """Number and buckets of the newest generation that was written to its end; (0, 0) without one."""
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        root = hadoop.Path(self.path)
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        best = (0, 0)
        for status in fs.listStatus(root) if fs.exists(root) else []:
            if fs.exists(hadoop.Path(status.getPath(), "_SUCCESS")):
                generation, _, buckets = status.getPath().getName().partition("-b")
                best = max(best, (int(generation[1:]), int(buckets)))
        return best

    @contextmanager
    def _bucketed(self) -> Iterator[None]:
        """Shuffles deal as the buckets do, and scans report the order of one-file buckets; the session's own settings come back."""
        wanted = {
            "spark.sql.shuffle.partitions": str(self.buckets),
            "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
        }
        before = {name: self.spark.conf.get(name) for name in wanted}
        try:
            for name, value in wanted.items():
                self.spark.conf.set(name, value)
            yield
        finally:
            for name, value in before.items():
                self.spark.conf.set(name, value)
