"""Groups of spelling variants by pivotal grams.

Two words are near if one code point was inserted, deleted or replaced. Bigrams have a global order, rare ones
first. The prefix of a word are its first three bigrams in that order, and among them dynamic programming chooses two
that do not overlap and are rarest together: the pivots. One edit cannot destroy both pivots, so of two near words, the one whose
prefix ends earlier has a pivot that is in the other's prefix, at a place that the edit's side of it and the lengths
fix. On its other side, and beyond the other pivot, nothing was edited. Pivots therefore meet the prefixes of other
words by (bigram, place, length, unedited side), and what is left is verified.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estrella.llm.shipping import ship
from estrella.llm.words import utf8_texts
from estrella.session import materialize, materialize_counted

GRAM = 2
PREFIX = GRAM + 1  # for one edit
PIVOTS = 2
LEAST_CHARS = 5
LEAST_ROWS = 3
STRAY = 97  # one run in so many loses a code point
KEPT_RUNS = 200_000
SECTION_BYTES = 1 << 22

_RUN = re.compile("[a-zÀ-ÿ]+")
_GAP = re.compile(b"[^A-Za-z\x80-\xff]")


def _sections(text: bytes) -> Iterator[bytes]:
    """A text in sections of about ``SECTION_BYTES`` that end outside of runs."""
    at = 0
    while at < len(text):
        gap = _GAP.search(text, at + SECTION_BYTES)
        end = gap.start() if gap else len(text)
        yield text[at:end]
        at = end


def stray_runs(doc_id: int | None, text: bytes, stray: int) -> Counter:
    """The runs of one text with their counts, some without one of their code points.

    A run loses one if the crc32 of ``<doc_id>:<run>`` is a multiple of ``stray``. An id of NULL counts as empty.
    """
    start = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
    out: Counter = Counter()
    for section in _sections(text):
        for run, n in Counter(_RUN.findall(section.lower().decode())).items():
            h = zlib.crc32(run.encode(), start)
            if h % stray == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            out[run] += n
    return out


def count_words(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST_ROWS, chars: int = LEAST_CHARS, stray: int = STRAY
) -> DataFrame:
    """(word, n) of the words of at least ``chars`` code points that occur at least ``least`` times.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF, lower-cased in A-Z, after some lost a code point (``stray_runs``). NULL
    texts have none, repeated rows count as often as they occur, long texts are taken in sections.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter = Counter()

        def made() -> pa.RecordBatch:
            kept = [w for w in sums if len(w) >= chars]
            out = pa.RecordBatch.from_arrays([pa.array(kept, pa.string()), pa.array([sums[w] for w in kept], pa.int64())], names=["word", "n"])
            sums.clear()
            return out

        for batch in batches:
            for name, body in zip(batch.column("doc_id").to_pylist(), utf8_texts(batch, "text"), strict=True):
                for word, n in stray_runs(name, body, stray).items():
                    sums[word] += n
                if len(sums) > KEPT_RUNS:
                    yield made()
        yield made()
        pa.default_memory_pool().release_unused()

    counted = rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return materialize(counted.filter(F.col("n") >= least))


def _gram_order(words: DataFrame) -> dict[str, tuple[int, int]]:
    """Place in the global order and number of words of each bigram. Of 90 letters there are at most 8,100 bigrams."""
    grams = F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substr("word", i, F.lit(GRAM)))
    counts = words.select(F.explode(F.array_distinct(grams)).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    ordered = sorted(counts.collect(), key=lambda r: (r["n"], r["gram"]))
    return {r["gram"]: (i, r["n"]) for i, r in enumerate(ordered)}


def prefix_and_pivots(word: str, order: dict[str, tuple[int, int]]) -> tuple[list[tuple[int, int]], list[tuple[int, int]], int]:
    """Prefix and pivots as (bigram, place), and the last bigram of the prefix, by the global order.

    All places of the prefix's last bigram belong to the prefix.
    """
    grams = sorted((order[word[i : i + GRAM]][0], i) for i in range(len(word) - GRAM + 1))
    last = grams[min(PREFIX, len(grams)) - 1][0]
    prefix = [g for g in grams if g[0] <= last]
    by_place = sorted(prefix, key=lambda g: g[1])
    # best[k]: the lowest cost of k bigrams that do not overlap, among those up to here, with the bigrams
    best: list[list] = [[(0, [])] * (len(by_place) + 1)] + [[None] * (len(by_place) + 1) for _ in range(PIVOTS)]
    for at, (gram, place) in enumerate(by_place):
        free = sum(1 for _, p in by_place[:at] if p + GRAM <= place)
        cost = order[word[place : place + GRAM]][1]
        for k in range(1, PIVOTS + 1):
            before = best[k - 1][free]
            taken = before and (before[0] + cost, [*before[1], (gram, place)])
            best[k][at + 1] = min((b for b in (best[k][at], taken) if b), default=None)
    return prefix, best[PIVOTS][-1][1], last


def _key(side: str, length: int, text: str) -> int:
    """A bigram with all of its word to the left or right of it, in a word of some length. Place and bigram follow from the text.

    Pairs that meet are verified, so collisions do no harm.
    """
    return xxhash.xxh3_64_intdigest(f"{side}{length}:{text}") - (1 << 63)


def index_keys(word: str, prefix: list[tuple[int, int]]) -> list[int]:
    return [k for _, at in prefix for k in (_key("l", len(word), word[: at + GRAM]), _key("r", len(word), word[at:]))]


def probes(word: str, pivots: list[tuple[int, int]]) -> list[tuple[int, bool, str]]:
    """(key, whether the unedited side is the left one, what else is unedited at the other end) for every place an edit can be at.

    The places before, in front of the second, behind the first and behind both pivots cover the word; for each there is a pivot that
    survives. The other word may be as long, longer or shorter by one.
    """
    one, two = sorted(at for _, at in pivots)
    sides = [
        ("r", word[one:], ""),
        ("r", word[two:], word[:one]),
        ("l", word[: one + GRAM], word[two + GRAM :]),
        ("l", word[: two + GRAM], ""),
    ]
    return [(_key(side, len(word) + more, same), side == "l", rest) for side, same, rest in sides for more in (-1, 0, 1)]


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, na, b, nb): every unordered pair of near words with their counts, once.

    ``words`` has distinct words of at least five code points and their counts ``n``, and should be a stored table.
    """
    spark = words.sparkSession
    ship(spark)
    order = spark.sparkContext.broadcast(_gram_order(words))
    kind = pa.struct([("key", pa.int64()), ("left", pa.bool_()), ("rest", pa.string())])

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, asked, lasts = [], [], []
            for word in batch.column("word").to_pylist():
                prefix, pivots, last = prefix_and_pivots(word, order.value)
                keys.append(index_keys(word, prefix))
                asked.append([{"key": k, "left": left, "rest": rest} for k, left, rest in probes(word, pivots)])
                lasts.append(last)
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("n"), pa.array(keys, pa.list_(pa.int64())), pa.array(asked, pa.list_(kind)), pa.array(lasts, pa.int32())],
                names=["word", "n", "keys", "asked", "last"],
            )

    schema = "word string, n long, keys array<long>, asked array<struct<key:long,left:boolean,rest:string>>, last int"
    known = materialize(words.select("word", "n").mapInArrow(parts, schema))
    indexed = known.select(F.col("word").alias("b"), F.col("n").alias("nb"), F.col("last").alias("b_last"), F.explode("keys").alias("key"))
    asked = known.select(F.col("word").alias("a"), F.col("n").alias("na"), F.col("last").alias("a_last"), F.inline("asked"))
    unedited = F.when(F.col("left"), F.endswith("b", F.col("rest"))).otherwise(F.startswith("b", F.col("rest")))
    met = indexed.join(asked, "key").filter((F.col("a_last") <= F.col("b_last")) & (F.col("a") != F.col("b")) & unedited)
    found = met.filter(F.levenshtein("a", "b", 1) == 1)
    swap = F.col("a") > F.col("b")
    first, second = F.struct(F.col("a").alias("w"), F.col("na").alias("n")), F.struct(F.col("b").alias("w"), F.col("nb").alias("n"))
    ends = found.select(F.when(swap, second).otherwise(first).alias("x"), F.when(swap, first).otherwise(second).alias("y"))
    return ends.select(F.col("x.w").alias("a"), F.col("x.n").alias("na"), F.col("y.w").alias("b"), F.col("y.n").alias("nb")).distinct()


def _roots(links: DataFrame) -> DataFrame:
    """(word, root): the end of each word's chain of forms, by doubling the steps taken; counts grow along a chain, so there are no rings."""
    current = links.select("word", F.col("form").alias("root"))
    while True:
        further = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = materialize(current.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        current = stepped.select("word", "root")
        if stepped.filter("moved").isEmpty():
            return current


def spelling_variants(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST_ROWS, stray: int = STRAY, factor: int = 2
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of ``count_words``.

    ``n_near`` counts the near words. ``form`` is the near word that occurs most often (ties: the smallest by code points) if
    it occurs at least ``factor`` times as often as the word, else NULL, and ``form_n`` its count. ``root`` is the
    last form of the chain of forms, the word itself without one. NULL and empty texts have no words, no rows give
    no rows, other columns are ignored.
    """
    words = count_words(docs, doc_id, text, least, LEAST_CHARS, stray)
    pairs = materialize(near_pairs(words))
    both = pairs.select("a", "b", "nb").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("na").alias("nb")))
    # one candidate per word and task is shuffled
    best = both.groupBy("a").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("nb")).alias("less"), "b")).alias("best"))
    named = words.join(best.withColumnRenamed("a", "word"), "word", "left")
    enough = -F.col("best.less") >= factor * F.col("n")
    formed = materialize(
        named.select(
            "word",
            F.when(enough, F.col("best.b")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(enough, -F.col("best.less")).alias("form_n"),
        )
    )
    linked, rows = materialize_counted(formed.filter("form IS NOT NULL").select("word", "form"))
    roots = _roots(linked) if rows else linked.select("word", F.col("form").alias("root"))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
