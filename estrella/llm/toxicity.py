"""Toxicity by a chain of linear classifiers.

The categories come one after another: each model sees a text's words and the probabilities of the
categories before it, and the last link says whether the text is toxic at all. For training, the
earlier probabilities are out-of-fold: every labelled row gets them from models that have not seen it,
so later models learn how far to trust them on new texts. The models used afterwards are fitted on
all folds.

The labels only say toxic or not. The categories are the kinds of toxic vocabulary in the labelled
texts: terms that are much more frequent in toxic texts are grouped by occurring together, and a text
labelled toxic is in the category of every group it has a term of. Terms beyond the largest groups
share a last category.

Features are each word, its first four and its first six characters, hashed into a fixed number of
slots; whether one occurs counts, not how often. All slots take part: those that hardly tell the
classes apart are held back by a stronger penalty. Training uses at most ``max_rows`` labelled rows of
each class (those with the smallest hashes of their ids); whole texts are read for it, and scoring
goes over the whole texts of all documents where they are stored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estrella.llm.shipping import ship
from estrella.llm.words import hashed_words, in_slices, utf8_texts
from estrella.session import materialize

SLOT_BITS = 20
FIRST = (None, 4, 6)  # whole words and beginnings, in characters
MAX_ROWS = 6000
FOLDS = 4
PASSES = 8
BATCH_ROWS = 500
PENALTY = 1e-4
MAX_CATEGORIES = 6  # besides the one of the terms left over
MIN_Z = 4.5  # of the terms that categories are made of; a million slots have none by chance

_PUNCTUATION = bytes(
    0x20 if c < 0x30 or 0x3A <= c <= 0x40 or 0x5B <= c <= 0x60 or 0x7B <= c <= 0x7F else c for c in range(256)
)


def word_slots(texts: list[bytes]) -> list[np.ndarray]:
    """For each text the sorted distinct slots of its words. ASCII punctuation parts words."""
    plain = [t.translate(_PUNCTUATION) for t in texts]
    shift = np.uint64(64 - SLOT_BITS)
    kinds = [hashed_words(plain, first) for first in FIRST]
    return [np.unique((np.concatenate(h) >> shift).astype(np.int32)) for h in zip(*kinds, strict=True)]


def _flat(slots: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([np.empty(0, np.int32), *slots]), np.cumsum([0] + [len(s) for s in slots])


def _sums(weights: np.ndarray, flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per text, the sum of the weights of its slots."""
    running = np.concatenate([[0.0], np.cumsum(weights[flat], dtype=np.float64)])
    return running[offsets[1:]] - running[offsets[:-1]]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _z_scores(flat: np.ndarray, offsets: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Per slot, how far its share among positive texts exceeds that among others, in standard errors."""
    positive = np.repeat(labels > 0, np.diff(offsets))
    yes = np.bincount(flat[positive], minlength=1 << SLOT_BITS)
    no = np.bincount(flat[~positive], minlength=1 << SLOT_BITS)
    n1, n0 = max(1, int((labels > 0).sum())), max(1, int((labels <= 0).sum()))
    share = (yes + no + 1) / (n1 + n0 + 2)
    return (yes / n1 - no / n0) / np.sqrt(share * (1 - share) * (1 / n1 + 1 / n0))


@dataclass
class Linear:
    """Logistic regression on word slots and a few dense inputs."""

    words: np.ndarray
    dense: np.ndarray
    bias: float

    def predict(self, flat: np.ndarray, offsets: np.ndarray, dense: np.ndarray) -> np.ndarray:
        return _sigmoid(_sums(self.words, flat, offsets) + dense @ self.dense + self.bias)


def fit_linear(slots: list[np.ndarray], dense: np.ndarray, labels: np.ndarray) -> Linear:
    """AdaGrad on the logistic loss, in batches; both classes weigh alike.

    Every slot has a weight. It is penalised the more, the less the slot tells the classes apart.
    """
    order = np.random.default_rng(0).permutation(len(labels))
    slots, dense, labels = [slots[i] for i in order], dense[order], labels[order]
    flat, offsets = _flat(slots)
    z = _z_scores(flat, offsets, labels)
    present = np.flatnonzero(np.bincount(flat, minlength=1 << SLOT_BITS))
    place = np.zeros(1 << SLOT_BITS, np.int32)
    place[present] = np.arange(len(present))
    flat = place[flat].astype(np.int64)
    # weights are evidence times free numbers, and these are penalised
    evidence = z[present] ** 4 / (z[present] ** 4 + MIN_Z**4)
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    importance = np.where(labels > 0, 0.5 / share, 0.5 / (1 - share))
    words, weights, bias = np.zeros(len(present)), np.zeros(dense.shape[1]), 0.0
    seen = [np.full(len(present), 1e-8), np.full(dense.shape[1], 1e-8), 1e-8]
    for _ in range(PASSES):
        for a in range(0, len(labels), BATCH_ROWS):
            rows = slice(a, min(a + BATCH_ROWS, len(labels)))
            ends = offsets[rows.start : rows.stop + 1]
            at = flat[ends[0] : ends[-1]]
            score = _sums(evidence * words, at, ends - ends[0]) + dense[rows] @ weights + bias
            error = importance[rows] * (_sigmoid(score) - labels[rows]) / len(score)
            slope = np.bincount(at, np.repeat(error, np.diff(ends)), minlength=len(present))
            steps = (evidence * slope + PENALTY * words, dense[rows].T @ error, error.sum())
            for k, step in enumerate(steps):
                seen[k] = seen[k] + step * step
            words -= 0.3 * steps[0] / np.sqrt(seen[0])
            weights -= 0.3 * steps[1] / np.sqrt(seen[1])
            bias -= 0.3 * steps[2] / np.sqrt(seen[2])
    full = np.zeros(1 << SLOT_BITS, np.float32)
    full[present] = evidence * words
    return Linear(full, weights, float(bias))


def find_categories(slots: list[np.ndarray], toxic: np.ndarray) -> list[np.ndarray]:
    """Groups of toxic terms that occur together, strongest first; a group is an array of slots.

    The last one holds the terms that are left after ``MAX_CATEGORIES`` groups.
    """
    flat, offsets = _flat(slots)
    z = _z_scores(flat, offsets, toxic)
    terms = np.flatnonzero(z >= MIN_Z)
    terms = terms[np.argsort(-z[terms], kind="stable")]
    place = np.full(1 << SLOT_BITS, -1, np.int32)
    place[terms] = np.arange(len(terms))
    positive, positive_offsets = _flat([slots[i] for i in np.flatnonzero(toxic > 0)])
    row, at = np.repeat(np.arange(len(positive_offsets) - 1), np.diff(positive_offsets)), place[positive]
    has = np.zeros((len(positive_offsets) - 1, len(terms)), bool)
    has[row[at >= 0], at[at >= 0]] = True
    often = has.sum(axis=0)
    groups: list[np.ndarray] = []
    left = np.arange(len(terms))
    while len(left) and len(groups) < MAX_CATEGORIES:
        both = has[has[:, left[0]]].sum(axis=0)[left]
        together = both >= 0.25 * np.minimum(often[left[0]], often[left])
        groups.append(terms[left[together]])
        left = left[~together]
    return [*groups, terms[left]] if len(left) else groups


@dataclass
class Chain:
    """One linear model per category and, last, one for the label itself."""

    links: list[Linear]
    threshold: float

    def predict(self, slots: list[np.ndarray]) -> np.ndarray:
        flat, offsets = _flat(slots)
        earlier = np.zeros((len(slots), 0))
        for link in self.links:
            earlier = np.column_stack([earlier, link.predict(flat, offsets, earlier)])
        return earlier


def fit_chain(
    slots: list[np.ndarray], toxic: np.ndarray, weights: np.ndarray | None = None, folds: int = FOLDS
) -> Chain:
    """A chain over the categories found and the label, with out-of-fold probabilities between the links.

    The threshold is the one with the best balance of precision and recall for the last link's
    out-of-fold probabilities, where a row counts as the ``weights`` rows it stands for.
    """
    toxic = np.asarray(toxic, float)
    targets = []
    for group in find_categories(slots, toxic):
        wanted = np.zeros(1 << SLOT_BITS)
        wanted[group] = 1
        targets.append(((toxic > 0) & (_sums(wanted, *_flat(slots)) > 0)).astype(float))
    targets.append(toxic)
    fold = np.arange(len(slots)) % folds
    earlier = np.zeros((len(slots), 0))
    links = []
    for target in targets:
        out = np.zeros(len(slots))
        for k in range(folds):
            inside, outside = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
            if not len(inside):
                continue
            model = fit_linear([slots[i] for i in inside], earlier[inside], target[inside])
            out[outside] = model.predict(*_flat([slots[i] for i in outside]), earlier[outside])
        links.append(fit_linear(slots, earlier, target))
        earlier = np.column_stack([earlier, out])
    return Chain(links, _best_cut(earlier[:, -1], toxic, np.ones(len(toxic)) if weights is None else weights))


def _best_cut(scores: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    order = np.argsort(-scores, kind="stable")
    ranked = scores[order]
    hits = np.cumsum((weights * labels)[order])
    f1 = 2 * hits / (np.cumsum(weights[order]) + (weights * labels).sum())
    f1[:-1][ranked[:-1] == ranked[1:]] = -1  # equal scores stay together
    best = int(np.argmax(f1))
    lower = ranked[best + 1] if best + 1 < len(ranked) else 0.0
    return float((ranked[best] + lower) / 2)


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, seed: int = 0) -> Chain | None:
    """A chain fitted on documents (doc_id, text) with labels (doc_id, toxic); None without both classes.

    The sample holds at most ``max_rows`` ids of each class; the threshold is chosen for the classes'
    shares in all labels. The texts stay where they are; the driver gets the slots of the sample's
    words. Ids with contradicting labels are left out.
    """
    ship(docs.sparkSession)
    known = materialize(
        labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("high"))
        .filter("toxic = high")
        .select("doc_id", "toxic", F.xxhash64(F.lit(seed), "doc_id").alias("turn"))
    )
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    parts = [known.filter(F.col("toxic") == v).orderBy("turn", "doc_id").limit(max_rows) for v in (0, 1)]
    chosen = parts[0].unionByName(parts[1])

    def one(batch):
        slots = [s.astype("<i4").tobytes() for s in word_slots(utf8_texts(batch, "text"))]
        columns = [*(batch.column(c) for c in ("turn", "doc_id", "toxic")), pa.array(slots, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["turn", "doc_id", "toxic", "slots"])

    texts = docs.join(F.broadcast(chosen), "doc_id").select("turn", "doc_id", F.col("toxic").cast("int").alias("toxic"), "text")
    made = texts.mapInArrow(in_slices(one), "turn long, doc_id long, toxic int, slots binary")
    # of an id that occurs more than once the smallest row, chosen before anything comes to the driver
    once = made.groupBy("turn", "doc_id", "toxic").agg(F.min("slots").alias("slots")).collect()
    rows = sorted(once, key=lambda r: (r["turn"], r["doc_id"]))
    toxic = np.array([r["toxic"] for r in rows], float)
    if not len(toxic) or not toxic.any() or toxic.all():
        return None
    # every sampled row stands for so many labelled ones of its class
    stands = {int(v): n / min(n, max_rows) for v, n in counts.items()}
    weights = np.array([stands[r["toxic"]] for r in rows])
    return fit_chain([np.frombuffer(r["slots"], "<i4") for r in rows], toxic, weights)


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    max_rows: int = MAX_ROWS,
    keep_columns: bool = False,
) -> DataFrame:
    """One row per document: doc_id, categories (a probability each), score, toxic (0 or 1).

    ``labels`` has doc_id and toxic. With ``keep_columns`` the documents' own columns stay, but for
    those named as the added ones. An empty or NULL text has no words; without labelled rows of both
    classes every score is 0. NULL ids and repeated rows are scored like others. An empty input
    gives an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    pairs = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text")
    )
    chain = train(pairs, labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic"), max_rows)
    added = ["categories", "score", "toxic"]
    own = [c for c in docs.columns if c not in added] if keep_columns else [doc_id]
    inner = docs.select(
        *[F.col(f"`{c}`").alias(f"in_{c}") for c in own], F.col(f"`{text}`").cast("string").alias("_text")
    )
    if chain is None:
        nothing = (F.array().cast("array<double>"), F.lit(0.0), F.lit(0).cast("long"))
        made = inner.withColumns(dict(zip(added, nothing, strict=True))).drop("_text")
        return made.select(*[F.col(f"`in_{c}`").alias(c) for c in own], *added)
    shared = spark.sparkContext.broadcast(chain)
    names = [*[f"in_{c}" for c in own], *added]

    def score(batch):
        chain = shared.value
        out = chain.predict(word_slots(utf8_texts(batch, "_text")))
        arrays = [
            *batch.columns[:-1],
            pa.array(list(out[:, :-1]), pa.list_(pa.float64())),
            pa.array(out[:, -1]),
            pa.array((out[:, -1] > chain.threshold).astype(np.int64)),
        ]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in inner.drop("_text").schema)
    made = inner.mapInArrow(in_slices(score), f"{kept}categories array<double>, score double, toxic long")
    return made.select(*[F.col(f"`in_{c}`").alias(c) for c in own], *added)
