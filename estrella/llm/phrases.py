"""Collocations by prefix-free parsing.

Every text is cut into chunks where the content says so: a window of words whose hash is small ends
one chunk and begins the next, so chunks overlap by one window and copies of a passage give the same chunks
wherever they stand. The dictionary of distinct chunks with their frequencies takes the place of the texts.
Phrases are counted inside the distinct chunks and weighted by their frequencies; a phrase belongs to the chunk in
which it starts before the last window, so what lies in an overlap counts once.

Words and pairs are counted first. A longer phrase can only be frequent if all its pairs are; those known to be frequent
are kept in a bitmap of fixed size over hashes, which says yes too often but never no to a frequent one. Phrases meet
as numbers of 96 bits and carry a place where they stand; only the frequent ones fetch their words from there.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estrella.llm.shipping import ship
from estrella.llm.words import in_slices, mixed, shingles, utf8_texts
from estrella.session import materialize

MAX_WORDS = 5
WINDOW = MAX_WORDS - 1  # a phrase that starts before a chunk's last window ends inside the chunk
EVERY = 64  # one window in so many ends a chunk
LONGEST = 4096  # words of a chunk in texts whose windows never end one
FILTER_BITS = 27  # a bitmap takes 16 MB
SECTION_BYTES = 1 << 21
SLAB_WORDS = 1 << 19
SLAB_BYTES = 1 << 23
PLACE_BITS = 13  # for the place of a word in its chunk
KEPT_WORDS = 1 << 20
SALTS = 32
UNKNOWN = "und"

# Stands between two pieces of a text; the byte is in no UTF-8 text.
_BREAK = b"\xff"
_CUT = re.compile(b"[ \xff]")
_BREAKS = bytes([0x2E, 0x2C, 0x3B, 0x3A, 0x21, 0x3F, *range(0x0A, 0x0E)])  # . , ; : ! ? and line ends
_CANONICAL = bytes.maketrans(
    bytes(range(0x41, 0x5B)) + _BREAKS + b"\t", bytes(range(0x61, 0x7B)) + _BREAK * len(_BREAKS) + b" "
)


def _sections(text: bytes) -> Iterator[list[bytes]]:
    """The words and breaks of a text, the last ``WINDOW`` of each section being the first of the next one.

    Only texts above ``SECTION_BYTES`` have several sections; breaks fill up the last one.
    """
    plain = text.translate(_CANONICAL)
    held: list[bytes] = []
    at = 0
    while at < len(plain):
        cut = _CUT.search(plain, at + SECTION_BYTES)
        end = cut.start() if cut else len(plain)
        words = plain[at:end].replace(_BREAK, b" \xff ").split()
        at = end
        if held and len(words) >= WINDOW:
            yield held + words[:WINDOW]
            held = words
        else:
            held += words
    if held:
        yield held + [_BREAK] * WINDOW


class _Vocabulary:
    """Numbers of the words met so far and two 64-bit hashes of each; it starts anew when it is full."""

    def __init__(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.hashes = np.empty((2, 0), np.uint64)

    def number(self, words: list[bytes]) -> np.ndarray:
        if len(self.numbers) > KEPT_WORDS:
            self.__init__()
        out = np.fromiter(map(self.numbers.get, words, repeat(-1)), np.int64, len(words))
        unknown = np.flatnonzero(out < 0).tolist()
        new = list({words[i] for i in unknown})
        for word in new:
            self.numbers[word] = len(self.numbers)
        made = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, new)), np.uint64).reshape(-1, 2).T
        self.hashes = np.concatenate([self.hashes, made], axis=1)
        out[unknown] = [self.numbers[words[i]] for i in unknown]
        return out


_vocabulary = _Vocabulary()


def _chunks(sections: list[list[bytes]], every: int) -> Iterator[tuple[int, bytes]]:
    """(number of the section, chunk) for all chunks of the sections."""
    ends = np.cumsum([len(s) for s in sections])
    begins = np.concatenate([[0], ends[:-1]])
    words = list(chain.from_iterable(sections))
    numbers = _vocabulary.number(words)
    hashes = _vocabulary.hashes[0][numbers]
    section = np.repeat(np.arange(len(sections)), ends - begins)
    small = np.zeros(len(words), bool)
    windows = shingles(hashes, WINDOW) <= np.uint64((1 << 64) // every - 1)
    inside = section[: len(windows) - 1] == section[WINDOW:]  # a window at a section's end starts nothing
    small[: len(inside)] = windows[:-1] & inside
    small[begins] = True
    starts = np.flatnonzero(small)
    gaps = np.diff(starts, append=len(words))
    if (gaps > LONGEST).any():
        starts = np.concatenate([np.arange(s, s + max(g - WINDOW, 1), LONGEST) for s, g in zip(starts, gaps, strict=True)])
    owner = section[starts]
    following = np.append(starts[1:], len(words)) + WINDOW
    stops = np.minimum(following, ends[owner])
    for s, e, i in zip(starts.tolist(), stops.tolist(), owner.tolist(), strict=True):
        yield i, b" ".join(words[s:e])


def chunk_dictionary(docs: DataFrame, text: str = "text", lang: str = "lang", every: int = EVERY) -> DataFrame:
    """(chunk_id, lang, chunk, weight): the distinct chunks of each language and how often each occurs.

    Texts are lower-cased (A-Z); a break byte stands for each of ``.,;:!?`` and line ends. NULL texts count as empty and
    have no chunks, a NULL language is ``und``. Repeated rows count as often as they occur. Texts of any length
    are parsed in sections, and a chunk has at most ``LONGEST`` words and two windows.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(f"`{lang}`"), F.lit(UNKNOWN)).alias("lang"), F.col(f"`{text}`").alias("text"))

    def parse(batch: pa.RecordBatch) -> pa.RecordBatch:
        names = batch.column("lang").to_pylist()
        langs: list[str] = []
        made: list[bytes] = []
        held: list[list[bytes]] = []
        of: list[str] = []

        def flush() -> None:
            for i, chunk in _chunks(held, every):
                langs.append(of[i])
                made.append(chunk)
            held.clear()
            of.clear()

        size = 0
        for name, body in zip(names, utf8_texts(batch, "text"), strict=True):
            for section in _sections(body):
                held.append(section)
                of.append(name)
                size += len(section)
                if size > SLAB_WORDS:
                    flush()
                    size = 0
        if held:
            flush()
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(made, pa.binary())], names=["lang", "chunk"])

    parsed = rows.mapInArrow(in_slices(parse), "lang string, chunk binary")
    distinct = parsed.groupBy("lang", "chunk").agg(F.count(F.lit(1)).alias("weight"))
    return materialize(distinct.withColumn("chunk_id", F.monotonically_increasing_id()))


class _Slab:
    """Chunks of one language word by word: hashes, place, and a weight where a phrase may start."""

    def __init__(self, lang: str, rows: list[tuple[int, bytes, int]]):
        words = b" ".join([chunk for _, chunk, _ in rows]).split(b" ")
        lengths = np.array([chunk.count(b" ") + 1 for _, chunk, _ in rows])
        numbers = _vocabulary.number(words)
        ends = np.cumsum(lengths)
        left = np.repeat(ends, lengths) - np.arange(len(words))  # words from here to the chunk's end
        ids = np.array([i for i, _, _ in rows], np.int64) << PLACE_BITS
        self.places = np.repeat(ids + lengths, lengths) - left
        self.is_word = numbers != _vocabulary.numbers.get(_BREAK, -1)
        weights = np.repeat(np.array([w for _, _, w in rows], np.int64), lengths)
        self.weights = np.where((left > WINDOW) & self.is_word, weights, 0)
        self.salt = np.frombuffer(xxhash.xxh3_128_digest(lang.encode(), seed=1), np.uint64)
        self.hashes = mixed(_vocabulary.hashes[:, numbers] ^ self.salt[:, None])

    def phrase_hashes(self, length: int, starts: np.ndarray) -> np.ndarray:
        """Both hashes of the ``length`` words from each of some places on (of any words, breaks included)."""
        out = self.hashes[:, starts]
        for j in range(1, length):
            out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + self.hashes[:, starts + j])
        return out

    def marked_pairs(self, bitmap: np.ndarray) -> np.ndarray:
        """Whether the pair of words from each place on is in a bitmap."""
        return _marked(bitmap, self.phrase_hashes(2, np.arange(max(0, len(self.weights) - 1)))[0])

    def starts(self, length: int, pairs: np.ndarray | None) -> np.ndarray:
        """Places where a phrase of ``length`` words starts; with ``pairs``, only those all of whose pairs it marks."""
        n = max(0, len(self.weights) - length + 1)
        good = self.weights[:n] > 0
        for j in range(1, length):
            good &= self.is_word[j : j + n]
        if pairs is not None:
            for j in range(length - 1):
                good &= pairs[j : j + n]
        return np.flatnonzero(good)

    def counted(self, length: int, pairs: np.ndarray | None) -> list[np.ndarray]:
        """Hash, check, length, weighted count and a place of each distinct phrase; two of one hash may come in several rows."""
        starts = self.starts(length, pairs)
        one, two = self.phrase_hashes(length, starts)
        order = np.argsort(one)
        one, check, starts = one[order].view(np.int64), (two[order] >> np.uint64(32)).astype(np.uint32).view(np.int32), starts[order]
        first = np.flatnonzero(np.append(True, (one[1:] != one[:-1]) | (check[1:] != check[:-1]))[: len(one)])
        counts = np.add.reduceat(self.weights[starts], first) if len(first) else np.empty(0, np.int64)
        return [one[first], check[first], np.full(len(first), length, np.int32), counts, self.places[starts[first]]]

    def size(self) -> list[np.ndarray]:
        """The number of words of the language here, as a phrase of no words."""
        total = np.array([self.weights.sum()])
        check = np.zeros(1, np.int32)
        return [self.salt[:1].view(np.int64), check, check, total, self.places[:1]]


def _slabs(batches: Iterator[pa.RecordBatch]) -> Iterator[_Slab]:
    held: dict[str, list[tuple[int, bytes, int]]] = {}
    size = 0
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("lang", "chunk_id", "chunk", "weight")]
        for lang, *row in zip(*columns, strict=True):
            held.setdefault(lang, []).append(tuple(row))
            size += len(row[1])
            if size > SLAB_BYTES:
                yield from (_Slab(name, rows) for name, rows in held.items())
                held.clear()
                size = 0
    yield from (_Slab(name, rows) for name, rows in held.items())
    pa.default_memory_pool().release_unused()


def _marked(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bits = len(bitmap).bit_length() + 2
    slot = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    return (bitmap[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


def _bitmap(hashes: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of 2 ** ``bits`` slots over 64-bit hashes, put together from at most 2 ** (bits - 15) rows of 4 kB."""
    slot = F.shiftrightunsigned("hash", 64 - bits) + 1
    blocks = hashes.groupBy(F.bitmap_bucket_number(slot).alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")
    )
    bitmap = np.zeros(1 << (bits - 3), np.uint8)
    for row in blocks.collect():
        at = (row["block"] - 1) * len(row["bits"])
        bitmap[at : at + len(row["bits"])] = np.frombuffer(row["bits"], np.uint8)[: len(bitmap)]
    return bitmap


def _frequent(dictionary: DataFrame, lengths: Sequence[int], pairs: Broadcast | None, least: int) -> DataFrame:
    """(hash, check, words, f, place) of the phrases of some lengths with f >= ``least``; length 0 counts all words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slab in _slabs(batches):
            known = slab.marked_pairs(pairs.value) if pairs else None
            for length in lengths:
                columns = slab.counted(length, known) if length else slab.size()
                if len(columns[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["hash", "check", "words", "f", "place"])

    parts = dictionary.mapInArrow(count, "hash long, check int, words int, f long, place long")
    sums = parts.groupBy("hash", "check", "words").agg(F.sum("f").alias("f"), F.max("place").alias("place"))
    return materialize(sums.filter(F.col("f") >= least))


def phrase_counts(dictionary: DataFrame, least: int, bits: int = FILTER_BITS) -> DataFrame:
    """(lang, phrase, words, f) of the words and phrases with f >= ``least``, and for each language its number of
    words as the phrase of no words. Phrases are joined by spaces."""
    spark = dictionary.sparkSession
    short = _frequent(dictionary, (0, 1, 2), None, least)
    pairs = spark.sparkContext.broadcast(_bitmap(short.filter("words = 2"), bits))
    found = short.unionByName(_frequent(dictionary, range(3, MAX_WORDS + 1), pairs, least))
    placed = found.withColumn("chunk_id", F.shiftright("place", PLACE_BITS)).withColumn(
        "at", F.col("place").bitwiseAND((1 << PLACE_BITS) - 1).cast("int")
    )
    words = F.slice(F.split(F.col("chunk").cast("string"), " "), F.col("at") + 1, F.col("words"))
    texts = placed.join(dictionary.select("chunk_id", "lang", "chunk"), "chunk_id")
    return materialize(texts.select("lang", F.array_join(words, " ").alias("phrase"), "words", "f"))


def _score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 * a * n / (left * right)) in whole numbers of up to 38 digits."""
    wide = [c.cast("decimal(18,0)") for c in (a, n, left, right)]
    above = (F.lit(1000).cast("decimal(4,0)") * wide[0]).cast("decimal(20,0)") * wide[1]
    return F.call_function("div", above.cast("decimal(38,0)"), wide[2] * wide[3])


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = 100,
    top: int = 2000,
    cover: int = 100,
    every: int = EVERY,
    bits: int = FILTER_BITS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best ``top`` phrases of two to five words of each language.

    ``a`` is how often a phrase occurs (at least ``least`` times), ``n`` counts the language's words, ``l`` and ``r`` are the counts
    of the two parts at the cut with the lowest score 1000 * a * n / (l * r), rounded down (ties: the first cut). A
    phrase that stands inside a longer one with at least ``cover`` percent of its occurrences is left out.
    Order: score and a descending, phrase ascending by its bytes. NULL and empty texts have no phrases, a NULL
    language is ``und``, repeated rows count as often as they occur, and no rows give no rows. Other columns are ignored.
    """
    counts = phrase_counts(chunk_dictionary(docs, text, lang, every), least, bits)
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int").alias("salt")
    # once for every salt, so the phrases of a language meet it in many tasks
    sizes = counts.filter("words = 0").select("lang", F.col("f").alias("n"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    known = counts.filter("words > 0").select("lang", "phrase", "f")
    ws = F.split("phrase", " ")
    found = counts.filter("words >= 2").select("lang", "phrase", "words", F.col("f").alias("a"), ws.alias("ws"))

    def part(start: Column, length: Column) -> Column:
        return F.array_join(F.slice("ws", start, length), " ")

    cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("first"), part(F.col("k") + 1, F.col("words") - F.col("k")).alias("rest"))
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    scored = cuts.withColumn("salt", salt).join(sizes, ["lang", "salt"]).withColumn("score", _score(F.col("a"), F.col("n"), F.col("l"), F.col("r")))
    lowest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    inner = found.filter("words >= 3").select(
        "lang", "a", "words", "ws", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("length")
    )
    inner = inner.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("length") + 1)))
    covers = inner.groupBy("lang", part(F.col("at"), F.col("length")).alias("phrase")).agg(F.max("a").alias("longer"))
    left = lowest.join(covers, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(cover) * F.col("a"))
    )
    flat = left.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    # a language's best are found among the best of its parts, so no task sees all its phrases
    best = [F.desc("score"), F.desc("a"), "phrase"]
    parts = flat.withColumn("salt", salt).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best)))
    final = parts.filter(F.col("rank") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)))
    return final.filter(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
