"""Near-duplicate vectors by a forest of random-projection trees.

Every tree splits the vectors by random directions at the median, level by level; a vector close to
a split goes to both sides (spill), so near vectors rarely part, and many trees make it rarer still.
What is close is measured by the spread of the node's own projections, so trees split alike in any number of
dimensions. A node whose vectors are as near to each other as linked ones stays whole, and so does one where
every cut would send too many to both sides. Vectors that share a leaf are compared exactly; a large leaf is
dealt into blocks, and pairs of blocks are tasks of their own. Vectors of each length have trees of their
own. Trees are fitted on a bounded sample, but every vector is put into its leaves, and the depth of the trees
follows from the number of all vectors.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estrella.llm.graph import components
from estrella.llm.shipping import ship
from estrella.llm.words import in_slices
from estrella.session import materialize, materialize_counted

SAMPLE_ROWS = 16_384
SAMPLE_PER_NODE = 64
LEAF_ROWS = 256
BLOCK_ROWS = 1024
TASK_ROWS = 2048
SPILL = 0.16  # on each side of a cut, in standard deviations of the node's projections
MAX_SPILLED = 0.25  # share of a node that may go to both sides
# A leaf's name has its number in the lower bits, the tree above and the length of its vectors on top.
TREE_BITS, LENGTH_BITS = 40, 46


class Tree:
    """Random splits over unit vectors of one length, one direction per level.

    Nodes that hold enough of the sample split at a cut of their own. Below them a node splits where its
    last ancestor with enough of the sample would, so a tree can be as deep as the number of rows asks for.
    Without a sample, cuts are at 0. ``near`` is the distance of linked vectors.
    """

    def __init__(self, sample: np.ndarray, depth: int, seed: int, near: float, spill: float = SPILL):
        random = np.random.default_rng(seed)
        width = sample.shape[1]
        self.depth = depth
        self.directions = random.normal(size=(depth, width))
        self.directions /= np.linalg.norm(self.directions, axis=1, keepdims=True)
        self.own = min(depth, max(0, int(np.log2(max(1, len(sample) / SAMPLE_PER_NODE)))))
        # spread along a direction of vectors that are as far apart as linked ones
        tight = near / np.sqrt(2 * width)
        self.cuts, self.wide = [], []
        node = np.zeros(len(sample), np.int64)
        for level in range(depth):
            value = sample @ self.directions[level]
            size = 1 << min(level, self.own)
            cuts, wide = np.zeros(size), np.full(size, spill / np.sqrt(width))
            for n in np.unique(node):
                cuts[n], wide[n] = _best_split(value[node == n], spill, tight)
            if level < self.own:
                node = 2 * node + (value >= cuts[node])
            self.cuts.append(cuts)
            self.wide.append(wide)

    def leaves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) for every leaf a vector lies in or comes close to at some split."""
        row, node = np.arange(len(vectors)), np.zeros(len(vectors), np.int64)
        for level in range(self.depth):
            fitted = node >> max(0, level - self.own)
            off, wide = vectors[row] @ self.directions[level] - self.cuts[level][fitted], self.wide[level][fitted]
            low, high = off < wide, off >= -wide
            row = np.concatenate([row[low], row[high]])
            node = np.concatenate([2 * node[low], 2 * node[high] + 1])
        return row, node


def _best_split(values: np.ndarray, spill: float, tight: float) -> tuple[float, float]:
    """A cut and the width of its spill: the median, or the cut between the quartiles with the fewest values close to it if
    they are many at the median. No cut (everything on one side) if they are many at all cuts, where splitting would
    copy more than it parts, or if the values spread no wider than those of linked vectors."""
    spread = float(values.std())
    if spread <= tight:
        return -np.inf, 0.0
    values, wide = np.sort(values), spill * spread
    cuts = np.quantile(values, [0.5, *np.linspace(0.25, 0.75, 21)])
    close = np.searchsorted(values, cuts + wide) - np.searchsorted(values, cuts - wide)
    at = 0 if close[0] <= MAX_SPILLED * len(values) else int(np.argmin(close))
    return (float(cuts[at]), wide) if close[at] <= MAX_SPILLED * len(values) else (-np.inf, 0.0)


def unit_vectors(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Indexes of the usable vectors and the vectors scaled to length 1, in double precision.

    NULL, zero or empty vectors and those with NULL or non-finite components are not usable.
    """
    rows, kept = [], []
    for i, values in enumerate(column.to_pylist()):
        if not values or any(v is None for v in values):
            continue
        vector = np.array(values, np.float64)
        scale = np.abs(vector).max()
        if not np.isfinite(scale) or scale == 0:
            continue
        vector = vector / scale
        rows.append(i)
        kept.append(vector / np.sqrt((vector * vector).sum()))
    return np.array(rows, np.int64), kept


def _link_leaf(threshold: float):
    """Group function: per vector of a leaf its links there and the smallest vector linked to it in the leaf.

    A pair may share leaves of many trees; it counts in the first leaf that both list. Of a leaf in blocks,
    a group is one block or the pairs between two.
    """

    def apply(key, frame):
        frame = frame.sort_values("cls").reset_index(drop=True)
        names, weight, block = frame["cls"].to_numpy(), frame["rows"].to_numpy(), frame["block"].to_numpy()
        vectors = np.stack([np.frombuffer(v, np.float64) for v in frame["unit"]])
        # columns: the leaves before this one that some vector here is in as well
        earlier = [np.array([x for x in leaves if x < key[0]], np.int64) for leaves in frame["leaves"]]
        known, column = np.unique(np.concatenate(earlier), return_inverse=True)
        taken = np.zeros((len(names), max(1, len(known))), np.float32)
        taken[np.repeat(np.arange(len(names)), [len(e) for e in earlier]), column] = 1
        links = np.zeros(len(names), np.int64)
        edges = [np.empty((0, 2), np.int64)]
        for a in range(0, len(names), BLOCK_ROWS):
            for b in range(a, len(names), BLOCK_ROWS):
                one, two = slice(a, a + BLOCK_ROWS), slice(b, b + BLOCK_ROWS)
                cosine = vectors[one] @ vectors[two].T
                hit = cosine >= threshold
                for i, j in np.argwhere(np.abs(cosine - threshold) < 1e-9):
                    hit[i, j] = float(np.dot(vectors[a + i], vectors[b + j])) >= threshold
                hit &= taken[one] @ taken[two].T == 0
                if key[1] != key[2]:
                    hit &= block[one, None] != block[None, two]
                if a == b:
                    hit = np.triu(hit, 1)
                links[one] += hit @ weight[two]
                links[two] += hit.T @ weight[one]
                edges.append(np.argwhere(hit) + (a, b))
        left, right = np.concatenate(edges).T
        low = np.arange(len(names))
        while True:
            least = np.minimum(low[left], low[right])
            new = low.copy()
            np.minimum.at(new, left, least)
            np.minimum.at(new, right, least)
            new = new[new]
            if (new == low).all():
                break
            low = new
        kept = np.flatnonzero(links)
        return pd.DataFrame({"cls": names[kept], "links": links[kept], "low": names[low[kept]]}).astype("int64")

    return apply


def near_vectors(
    rows: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    threshold: float = 0.95,
    trees: int = 10,
    spill: float = SPILL,
    seed: int = 0,
    leaf_rows: int = LEAF_ROWS,
    sample_rows: int = SAMPLE_ROWS,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row.

    ``n_links`` counts the other rows found with a cosine of at least ``threshold``, ``component_id``
    is the smallest id reachable by links and ``kept`` says whether that is the row itself. Equal
    vectors (equal after scaling to length 1) are one entry with a weight and always linked. Vectors of different
    lengths never link. Unusable vectors (see ``unit_vectors``)
    link with nothing. Rows with a NULL id take part; repeated ids are rows of their own. Other
    columns are ignored, an empty input gives an empty result.
    """
    spark = rows.sparkSession
    ship(spark)
    rows = rows.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{embedding}`").alias("embedding"))

    def scale(batch):
        index, vectors = unit_vectors(batch.column("embedding"))
        units: list[bytes | None] = [None] * batch.num_rows
        names: list[int | None] = [None] * batch.num_rows
        for i, v in zip(index, vectors, strict=True):
            units[i] = v.tobytes()
            names[i] = xxhash.xxh3_64_intdigest(units[i]) - (1 << 63)
        return pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), pa.array(names, pa.int64()), pa.array(units, pa.binary())],
            names=["vec_id", "cls", "unit"],
        )

    scaled = materialize(rows.mapInArrow(in_slices(scale), "vec_id long, cls long, unit binary"))
    usable = scaled.filter("cls IS NOT NULL")
    classes, n = materialize_counted(
        usable.groupBy("cls").agg(F.first("unit").alias("unit"), F.count(F.lit(1)).alias("rows"), F.min("vec_id").alias("least"))
    )
    if not n:
        return scaled.select(
            "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
        )
    near = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    placed = _placed(classes, trees, spill, near, seed, leaf_rows, sample_rows)
    groups = _in_blocks(placed.withColumn("leaf", F.explode("leaves")), task_rows)
    found = groups.groupBy("leaf", "one", "two", F.length("unit").alias("width")).applyInPandas(_link_leaf(threshold), "cls long, links long, low long")
    found = materialize(found)
    linked = found.groupBy("cls").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("cls").alias("a"), F.col("low").alias("b")))
    named = (
        classes.select("cls", "rows", "least")
        .join(linked, "cls", "left")
        .join(joined.withColumnRenamed("node", "cls"), "cls", "left")
        .withColumn("comp", F.coalesce("component", "cls"))
    )
    named = materialize(named.select("cls", "rows", "least", "links", "comp"))
    smallest = materialize(named.groupBy(F.col("comp").alias("c")).agg(F.min("least").alias("low")))
    named = named.join(smallest, F.col("comp") == F.col("c")).select(
        F.col("cls").alias("_cls"), (F.col("rows") - 1 + F.coalesce("links", F.lit(0))).alias("links"), "low"
    )
    alone = scaled.filter("cls IS NULL").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    # both sides come from stored tables, so the rows of a hot vector can be split
    many = usable.join(materialize(named), F.col("cls") == F.col("_cls")).select(
        "vec_id", F.col("links").alias("n_links"), F.col("low").alias("component_id")
    )
    every = many.unionByName(alone)
    return every.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _placed(
    classes: DataFrame, trees: int, spill: float, near: float, seed: int, leaf_rows: int, sample_rows: int
) -> DataFrame:
    """The classes with the names of all their leaves.

    Trees are fitted on a sample of at most ``sample_rows`` classes of all lengths, those with the smallest hashes, and
    are as deep as leaves of about ``leaf_rows`` of all classes of their length need. The driver gets one row per
    length that has more classes than a leaf.
    """
    spark = classes.sparkSession
    chosen = classes.orderBy(F.xxhash64(F.lit(seed), "cls"), "cls").limit(sample_rows).select("unit")
    sample: dict[int, list[bytes]] = {}
    for row in chosen.collect():
        sample.setdefault(len(row["unit"]), []).append(bytes(row["unit"]))
    many = classes.groupBy(F.length("unit").alias("size")).count().filter(F.col("count") > leaf_rows)
    forest = {}
    for row in many.collect():
        width = row["size"] // 8
        fitted = _matrix(sample.get(row["size"], []), width)
        depth = int(np.ceil(np.log2(row["count"] / leaf_rows)))
        forest[row["size"]] = [Tree(fitted, depth, seed * 1000 + t, near, spill) for t in range(trees)]
    shared = spark.sparkContext.broadcast(forest)

    def place(batch):
        units = batch.column("unit").to_pylist()
        lists: list[list[int]] = [[] for _ in units]
        sizes = np.array([len(u) for u in units])
        for size in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == size)
            name = (size // 8 % (1 << 63 - LENGTH_BITS)) << LENGTH_BITS
            known = shared.value.get(size)
            if not known:
                for i in at:
                    lists[i].append(name)
                continue
            vectors = _matrix([units[i] for i in at], size // 8)
            for t, tree in enumerate(known):
                for i, leaf in zip(*tree.leaves(vectors), strict=True):
                    lists[at[i]].append(name + (t << TREE_BITS) + int(leaf))
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([sorted(x) for x in lists], pa.list_(pa.int64()))],
            names=[*batch.schema.names, "leaves"],
        )

    schema = "cls long, unit binary, rows long, least long, leaves array<long>"
    return materialize(classes.select("cls", "unit", "rows", "least").mapInArrow(in_slices(place), schema))


def _in_blocks(in_leaves: DataFrame, task_rows: int) -> DataFrame:
    """Every row of a leaf with its block, once for every pair (one, two) of blocks that it takes part in.

    A leaf of at most ``task_rows`` rows is one block; larger ones have blocks of about half as many.
    """
    sizes = in_leaves.groupBy("leaf").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > task_rows)
    large, found = materialize_counted(sizes)
    if not found:
        return in_leaves.withColumns({c: F.lit(0).cast("long") for c in ("block", "one", "two")})
    blocks = F.coalesce(F.ceil(F.col("size") * 2 / task_rows), F.lit(1)).cast("long")
    dealt = in_leaves.join(large, "leaf", "left").withColumn("blocks", blocks)
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("cls", "leaf"), "blocks"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    pair = {"one": F.least("block", "other"), "two": F.greatest("block", "other")}
    return dealt.withColumns(pair).drop("size", "blocks", "other")


def _matrix(units: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(units), np.float64).reshape(-1, width)
