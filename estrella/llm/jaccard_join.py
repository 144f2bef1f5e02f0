"""Exact self-join of texts by the Jaccard similarity of their word shingles, as a metric-space join.

The Jaccard distance 1 - |x & y| / |x | y| is a metric. Unrelated texts all lie at distance 1 from
each other, where the triangle inequality says nothing, so the space is first cut where sets meet:

1. *Nodes.* Equal sets are one node, however many documents have them.
2. *Regions.* If x and y link, one of the first |x| - ceil(t|x|) + 1 shingles of x in a fixed order
   is in y's first ones too. Every node enters the region of each of these shingles. The order puts
   frequent shingles last (by a fixed-size table of counts over all documents), so regions of
   common passages stay empty. Regions with the same nodes are one region.
3. *Pivots and cells.* A region's pivot is its most central node (the one with the most frequent
   shingles: the origin of a family of copies, not a copy of a copy). A node's home is the pivot it
   meets in most regions; the nodes with one home are its Voronoi cell. Nodes within the threshold
   of their home are linked, which connects most of every family by one comparison a node.
4. *Recursion.* Regions whose nodes are all connected are done. The others are cut into blocks of
   bounded size, and every pair of blocks is a task. There the nodes are sorted by the distance to
   the first of them, and by the triangle inequality only nodes within a window of these distances
   are compared; pairs that are connected already are left out.

Before the sets of a pair are compared, their parity sketches are: as every member flips one bit of
a sketch, two sketches differ in no more bits than the sets have members apart. That rules most
pairs out with a few hundred bytes each and never a link. The windows use the sketches' distance
(the number of bits that differ), which is a metric as well.

Every link is found or already implied by other links, so the components are exact.
"""

from __future__ import annotations

import zlib
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estrella.llm.graph import components
from estrella.llm.shipping import ship
from estrella.llm.words import hashed_words, in_slices, shingles, utf8_texts
from estrella.session import materialize, materialize_counted, shuffle_partitions

COUNT_BITS = 20
_SLICES = 64
_SLICE = (1 << COUNT_BITS) // _SLICES
# Regions are named by 48 bits of their shingle; shingles that share them share a region, which only
# adds comparisons.
_REGION_BITS = np.uint64((1 << 48) - 1)

BLOCK = 512
SUMMED = 256
# Ids and pairs of nodes are broadcast up to this many bytes of ids; beyond, texts and sets are shuffled to them.
BROADCAST_BYTES = 32 << 20


def _sets(batch: pa.RecordBatch, width: int) -> list[np.ndarray]:
    return [np.unique(shingles(h, width)) for h in hashed_words(utf8_texts(batch, "text"))]


def sketch(values: np.ndarray) -> bytes:
    """Parities of the members in at least twice as many slots as there are members."""
    bits = max(64, 1 << (2 * len(values) - 1).bit_length())
    slots = (values & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(slots, minlength=bits) & 1, bitorder="little").tobytes()


def folded(words: np.ndarray, length: int) -> np.ndarray:
    """A sketch (last axis: 64-bit words) as it would be with fewer slots."""
    while words.shape[-1] > length:
        half = words.shape[-1] // 2
        words = words[..., :half] ^ words[..., half:]
    return words


def most_common_members(n, m, apart):
    """The largest possible overlap of sets of n and m members whose sketches differ in ``apart`` bits."""
    return np.minimum(np.minimum(n, m), (n + m - apart) // 2)


def _node(values: np.ndarray, seed: int) -> tuple[int | None, int | None]:
    """A set's name, a 64-bit hash of its sorted members, and 64 bits more that tell sets of one name apart."""
    if not len(values):
        return None, None
    name, check = np.frombuffer(xxhash.xxh3_128_digest(values.tobytes(), seed=seed), np.int64)
    return int(name), int(check)


def _slots(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(64 - COUNT_BITS)).astype(np.int64)


_COUNTED = ["doc_id", "n", "node", "check", "sketch", "slice", "part", "counts"]


def _count_pass(docs: DataFrame, width: int) -> tuple[DataFrame, np.ndarray, int]:
    """One row (doc_id, n, node, sketch) per document, how often the shingles of each slot occur in all of them, and
    the seed of the nodes' names, under which no two different sets have one name."""
    for seed in count():
        listed, counts = _counted(docs, width, seed)
        names = listed.filter("node IS NOT NULL").groupBy("node").agg(F.min("check").alias("low"), F.max("check").alias("high"))
        if names.filter("low < high").isEmpty():
            return listed.drop("check"), counts, seed
    raise AssertionError


def _counted(docs: DataFrame, width: int, seed: int) -> tuple[DataFrame, np.ndarray]:

    def run(batches):
        counts = np.zeros(1 << COUNT_BITS, np.int64)

        def one(batch):
            sets = _sets(batch, width)
            if any(len(s) for s in sets):
                counts[:] += np.bincount(_slots(np.concatenate(sets)), minlength=1 << COUNT_BITS)
            nodes = [_node(s, seed) for s in sets]
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    *[pa.array([n[i] for n in nodes], pa.int64()) for i in (0, 1)],
                    pa.array([sketch(s) for s in sets], pa.binary()),
                    *[pa.nulls(len(sets), pa.int32())] * 2,
                    pa.nulls(len(sets), pa.binary()),
                ],
                names=_COUNTED,
            )

        yield from in_slices(one)(batches)
        if counts.any():
            packed = [zlib.compress(c.tobytes(), 1) for c in counts.reshape(_SLICES, _SLICE)]
            empty = pa.nulls(_SLICES, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    *[empty] * 4,
                    pa.nulls(_SLICES, pa.binary()),
                    pa.array(range(_SLICES), pa.int32()),
                    pa.array([TaskContext.get().partitionId()] * _SLICES, pa.int32()),
                    pa.array(packed, pa.binary()),
                ],
                names=_COUNTED,
            )

    schema = "doc_id long, n long, node long, check long, sketch binary, slice int, part int, counts binary"
    seen = materialize(docs.mapInArrow(run, schema))

    def add(key, frame):
        total = np.zeros(_SLICE, np.int64)
        for packed in frame["counts"]:
            total += np.frombuffer(zlib.decompress(packed), np.int64)
        part = frame["part"].to_numpy()[:1] // SUMMED
        return frame.head(1).assign(part=part, counts=[zlib.compress(total.tobytes(), 1)])[["slice", "part", "counts"]]

    # added up in a tree, so that no task sees more than SUMMED tables at once
    slices = seen.filter("slice IS NOT NULL").select("slice", "part", "counts")
    tasks = (slices.agg(F.max("part")).first()[0] or 0) + 1
    while True:
        slices = slices.groupBy("slice", F.expr(f"part div {SUMMED}")).applyInPandas(add, "slice int, part int, counts binary")
        tasks = -(-tasks // SUMMED)
        if tasks == 1:
            break
    counts = np.zeros((_SLICES, _SLICE), np.int64)
    for row in slices.collect():
        counts[row["slice"]] = np.frombuffer(zlib.decompress(row["counts"]), np.int64)
    return seen.filter("slice IS NULL").select("doc_id", "n", "node", "check", "sketch"), counts.reshape(-1)


def _regions(docs: DataFrame, counts: np.ndarray, width: int, percent: int, seed: int) -> DataFrame:
    """(region, node, pivot, shared): regions with at least two nodes; ``shared`` of them were alike."""
    shared_counts = docs.sparkSession.sparkContext.broadcast(counts)

    def run(batches):
        table = shared_counts.value
        seen = set()

        def one(batch):
            nodes, central, firsts = [], [], []
            for values in _sets(batch, width):
                node, _ = _node(values, seed)
                if node is None or node in seen:
                    continue
                seen.add(node)
                often = table[_slots(values)]
                prefix = len(values) + (-percent * len(values)) // 100 + 1
                first = values[np.lexsort((values, often))[:prefix]]
                nodes.append(node)
                central.append(round(64 * float(np.log(often).mean())))
                firsts.append((first & _REGION_BITS).view(np.int64))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(nodes, pa.int64()),
                    pa.array(central, pa.int16()),
                    pa.array(firsts, pa.list_(pa.int64())),
                ],
                names=["node", "central", "firsts"],
            )

        yield from in_slices(one)(batches)

    entries = docs.mapInArrow(run, "node long, central short, firsts array<long>").select(
        F.explode("firsts").alias("shingle"), "node", "central"
    )
    region = Window.partitionBy("shingle")
    low = F.xxhash64(F.lit(1), "node").bitwiseAND(0xFFFFFFFF)
    other = F.xxhash64(F.lit(2), "node").bitwiseAND(0xFFFFFFFF)
    # equal for regions with the same rows; if others should have it too, they are joined as one
    name = F.xxhash64(F.count(F.lit(1)).over(region), F.sum(low).over(region), F.sum(other).over(region))
    met = entries.select(
        "node",
        (F.min("node").over(region) < F.max("node").over(region)).alias("met"),
        F.max(F.struct("central", "node")).over(region)["node"].alias("pivot"),
        name.alias("region"),
    ).filter("met")
    return met.groupBy("region", "node", "pivot").agg(F.count(F.lit(1)).alias("shared"))


def _screened(pairs: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) with whether they can be a link, as far as their sketches tell."""
    one = marks.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a"))
    two = marks.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b"))
    both = pairs.join(one, "a").join(two, "b")

    def screen(batch):
        n, m = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("n_a", "n_b"))
        apart = np.zeros(len(n), np.int64)
        sketches = zip(batch.column("s_a").to_pylist(), batch.column("s_b").to_pylist(), strict=True)
        for i, (x, y) in enumerate(sketches):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            length = min(len(x), len(y))
            apart[i] = np.bitwise_count(folded(x, length) ^ folded(y, length)).sum()
        common = most_common_members(n, m, apart)
        return pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array(common * 100 >= (n + m - common) * percent)],
            names=["a", "b", "possible"],
        )

    return both.mapInArrow(in_slices(screen), "a long, b long, possible boolean")


def _verified(docs: DataFrame, listed: DataFrame, pairs: DataFrame, width: int, seed: int) -> DataFrame:
    """(a, b, common, n, m) for a stored frame of pairs; the texts of their nodes are read again for that."""
    spark = docs.sparkSession
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    chosen = listed.join(ends, "node").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    ids, rows = materialize_counted(chosen.select(F.col("doc_id").alias("_id")).distinct())
    if not rows:
        return spark.createDataFrame([], "a long, b long, common long, n long, m long")
    small = rows * 8 <= BROADCAST_BYTES
    found = docs.join(F.broadcast(ids) if small else ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")

    def load(batch):
        sets = [s for s in _sets(batch, width) if len(s)]
        return pa.RecordBatch.from_arrays(
            [pa.array([_node(s, seed)[0] for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
            names=["node", "items"],
        )

    sets, seen = materialize_counted(found.mapInArrow(in_slices(load), "node long, items binary"))
    if seen > rows:  # ids that occur more than once
        sets = sets.dropDuplicates(["node"])
    near = F.broadcast(pairs) if pairs.count() * 16 <= BROADCAST_BYTES else pairs
    left = sets.select(F.col("node").alias("a"), F.col("items").alias("items_a"))
    pivots = sets.join(pairs.select(F.col("b").alias("node")).distinct(), "node", "left_semi")
    right = pivots.select(F.col("node").alias("b"), F.col("items").alias("items_b"))

    def compare(batch):
        found = []
        for x, y in zip(batch.column("items_a").to_pylist(), batch.column("items_b").to_pylist(), strict=True):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            found.append((len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)))
        columns = np.array(found, np.int64).reshape(-1, 3)
        return pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), *[pa.array(columns[:, i]) for i in range(3)]],
            names=["a", "b", "common", "n", "m"],
        )

    both = left.join(near, "a").join(right, "b").select("a", "b", "items_a", "items_b")
    return materialize(both.mapInArrow(in_slices(compare), "a long, b long, common long, n long, m long"))


def _is_link(percent: int):
    return F.col("common") * 100 >= (F.col("n") + F.col("m") - F.col("common")) * percent


def _compared(rows: tuple[np.ndarray, ...], sides: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """The pairs of unconnected nodes, one of each side or both of the only one, that can be links."""
    nodes, comps, sizes, sketches = rows
    left, right = np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)
    same = not len(right)
    right = left if same else right
    if (comps == comps[0]).all():
        return []
    lengths = np.array([len(x) // 8 for x in sketches])
    out = []

    def stacked(index: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        index = index[lengths[index] == length]
        return index, np.stack([np.frombuffer(sketches[i], np.uint64) for i in index])

    for length in np.unique(lengths[left]):
        mine, words = stacked(left, length)
        for other in np.unique(lengths[right]):
            # a sketch has two to four bits a member, and of linked sets one has at most 100 / percent times the other's members
            if max(length, other) * percent > 200 * min(length, other):
                continue
            theirs, words2 = stacked(right, other)
            x, y = folded(words, other), folded(words2, length)
            # a window of distances to one node: those of a link differ by no more than the sets do
            from_x = np.bitwise_count(x ^ y[0]).sum(axis=1).astype(np.int64)
            from_y = np.bitwise_count(y ^ y[0]).sum(axis=1).astype(np.int64)
            order = np.argsort(from_y, kind="stable")
            theirs, y, from_y = theirs[order], y[order], from_y[order]
            # members apart in a link: at most (n + m) (1 - t) / (1 + t), where m is at most n / t
            wide = sizes[mine] * (100 - percent) // percent + 1
            starts = np.searchsorted(from_y, from_x - wide)
            ends = np.searchsorted(from_y, from_x + wide, "right")
            for k, i in enumerate(mine):
                near = theirs[starts[k] : ends[k]]
                ok = comps[near] != comps[i]
                if same:
                    ok &= nodes[near] > nodes[i]
                if not ok.any():
                    continue
                near = near[ok]
                apart = np.bitwise_count(x[k] ^ y[starts[k] : ends[k]][ok]).sum(axis=1).astype(np.int64)
                common = most_common_members(sizes[i], sizes[near], apart)
                hit = common * 100 >= (sizes[i] + sizes[near] - common) * percent
                out += [(min(nodes[i], v), max(nodes[i], v)) for v in nodes[near[hit]].tolist()]
    return out


def _block_pairs(percent: int):
    """Over rows sorted by task: the pairs that can be links, each once a task partition."""
    columns = ("node", "comp", "n", "sketch", "side")

    def run(batches):
        held: pa.Table | None = None
        seen: set[tuple[int, int]] = set()

        def work(table: pa.Table, keys: np.ndarray) -> pa.RecordBatch:
            node, comp, n, _, side = (table.column(c).to_numpy() for c in columns)
            sketches = table.column("sketch").to_pylist()
            edges = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            found = []
            for a, b in zip([0, *edges], [*edges, len(keys)], strict=True):
                if b - a > 1:
                    pairs = _compared((node[a:b], comp[a:b], n[a:b], sketches[a:b]), side[a:b], percent)
                    found += [p for p in pairs if p not in seen]
                    seen.update(pairs)
            return pa.RecordBatch.from_arrays(
                [pa.array([p[i] for p in found], pa.int64()) for i in (0, 1)], names=["a", "b"]
            )

        def key_columns(table: pa.Table) -> np.ndarray:
            return np.column_stack([table.column(c).to_numpy() for c in ("region", "block1", "block2")])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            keys = key_columns(table)
            last = int(np.argmax((keys == keys[-1]).all(axis=1)))  # the last task may go on in the next batch
            held = table.slice(last)
            if last:
                yield work(table.slice(0, last), keys[:last])
        if held is not None and held.num_rows:
            yield work(held, key_columns(held))

    return run


def jaccard_classes(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 75
) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.

    Two rows link when 100 * |x & y| >= ``percent`` * |x | y| for their sets of distinct shingles of
    ``width`` words (A-Z lower-cased, split at ASCII white space). A text with fewer words has the
    whole sequence as its one shingle; without words, or NULL, its set is empty and links with
    nothing. ``component_id`` is the smallest id reachable by links. A row with a NULL id takes part;
    its component has the smallest id of the others, or NULL. Repeated rows stay. An empty input
    gives an empty result. Other columns are ignored.
    """
    docs = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text")
    )
    ship(docs.sparkSession)
    listed, counts, seed = _count_pass(docs, width)
    regions = materialize(_regions(docs, counts, width, percent, seed))
    wanted = regions.select("node").distinct()
    marks = materialize(
        listed.join(wanted, "node").groupBy("node").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    )
    listed = listed.drop("sketch")

    # homes: the pivot a node meets most often; a node that is the pivot everywhere is its own home
    met = regions.groupBy("node", "pivot").agg(F.sum("shared").alias("shared"))
    order = F.struct(F.col("pivot") != F.col("node"), "shared", "pivot")
    homes = materialize(met.groupBy("node").agg(F.max_by("pivot", order).alias("home")))
    pairs = homes.filter("node <> home").select(F.col("node").alias("a"), F.col("home").alias("b"))
    possible = materialize(_screened(pairs, marks, percent).filter("possible").select("a", "b"))
    near = _verified(docs, listed, possible, width, seed)
    comps = materialize(components(near.filter(_is_link(percent)).select("a", "b")))

    tasks = _open_blocks(regions, marks, comps)
    order = ["region", "block1", "block2", "side", "node"]
    dealt = tasks.repartition(shuffle_partitions(docs.sparkSession), *order[:3]).sortWithinPartitions(*order)
    rest = materialize(dealt.mapInArrow(_block_pairs(percent), "a long, b long").distinct())
    last = _verified(docs, listed, rest, width, seed).filter(_is_link(percent)).select("a", "b")
    known = comps.select(F.col("node").alias("a"), F.col("component").alias("b"))
    every = components(known.unionByName(last))

    # names of the components in ids of documents
    named = listed.join(every, "node", "left").select("doc_id", "n", F.coalesce("component", "node").alias("comp"))
    named = materialize(named)
    smallest = named.filter("comp IS NOT NULL").groupBy(F.col("comp").alias("c")).agg(F.min("doc_id").alias("low"))
    return named.join(materialize(smallest), F.col("comp") == F.col("c"), "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("comp").isNull(), F.col("doc_id")).otherwise(F.col("low")).alias("component_id"),
    )


def _open_blocks(regions: DataFrame, marks: DataFrame, comps: DataFrame) -> DataFrame:
    """Nodes of the regions with more than one component, once for each pair of blocks they take part in."""
    labelled = marks.join(comps, "node", "left").select("node", "n", F.coalesce("component", "node").alias("comp"))
    rows = materialize(regions.select("region", "node").join(labelled, "node").select("region", "node", "comp"))
    # written, so that the join starts from plain shuffles and the rows of a large region can be split
    open_ = materialize(
        rows.groupBy("region")
        .agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count(F.lit(1)).alias("rows"))
        .filter("low < high")
        .select("region", F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks"))
    )
    rows = rows.join(open_, "region")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    spread = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return spread.select(
        "region",
        F.least("own", "other").alias("block1"),
        F.greatest("own", "other").alias("block2"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
        "node",
        "comp",
    ).join(marks, "node")
