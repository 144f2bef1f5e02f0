"""Texts made to collide, and keys that meet: nothing may rest on a hash alone."""

import math

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from estrella.llm import identity, jaccard_join, token_files, tokens, vectors, words
from estrella.session import work_path

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def thue_morse(steps, a="a", b="b"):
    letters = [a]
    for _ in range(steps):
        letters += [b if x == a else a for x in letters]
    return "".join(letters)


# under sums of powers modulo 2 ** 64 both words have one hash, whatever the base
ONE, TWO = thue_morse(10), thue_morse(10, "b", "a")
TEXTS = [ONE, TWO, f"x {ONE} {TWO} y", f"{TWO}, {ONE}", ONE, "abcdefghijklmnopqrstuvwxyz, abcdefgh abcdefghi abcdefghijklmnopq", ""]


def test_the_quick_hash_does_collide():
    data = np.frombuffer((ONE + TWO).encode(), np.uint8)
    one, two = words.hashed_spans(data, np.array([0, 1024]), np.array([1024, 2048]))
    assert one == two
    assert words.hashed_words([ONE.encode()])[0] != words.hashed_words([TWO.encode()])[0]


@pytest.mark.parametrize("order", [1, -1])
def test_pieces_of_one_hash(order):
    tokens._known.clear()
    tokenizer = Tokenizer.from_file(TOKENIZER)
    texts = TEXTS[::order]
    want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert tokens.encode_all([t.encode() for t in texts], TOKENIZER) == want
    assert tokens.encode_all([t.encode() for t in texts], TOKENIZER) == want


def test_token_files_of_one_hash(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").coalesce(1)
    path = work_path(spark)
    token_files.write_tokens(docs, path, TOKENIZER, 1)
    tokenizer = Tokenizer.from_file(TOKENIZER)
    got = {r["doc_id"]: r for r in token_files.token_index(token_files.read_tokens(spark, path)).collect()}
    assert {i: got[i]["n_tokens"] for i in got} == {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in enumerate(TEXTS)}
    assert got[0]["ids_crc32"] != got[1]["ids_crc32"] and got[0]["ids_crc32"] == got[4]["ids_crc32"]


def test_words_of_one_hash_are_no_link(spark):
    docs = spark.createDataFrame([(1, ONE), (2, TWO), (3, ONE)], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_classes(docs).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_names_that_meet_are_made_anew(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"a b c d e f{i}") for i in range(6)], "doc_id long, text string")
    asked = []

    def counted(docs, width, seed):
        asked.append(seed)
        listed = docs.select("doc_id", F.lit(2).alias("n"), F.lit(7).alias("node"), (F.col("doc_id") * int(seed < 2)).alias("check"), F.lit(b"").alias("sketch"))
        return listed, np.zeros(1)

    monkeypatch.setattr(jaccard_join, "_counted", counted)
    assert jaccard_join._count_pass(docs, 5)[2] == 2 and asked == [0, 1, 2]


def test_distinct_keys(spark):
    rows = [(1, "a"), (1, None), (None, "a"), (None, None), (1, ""), (None, ""), (1, "a"), (2, "a")]
    keyed = identity.distinct_keys(spark.createDataFrame(rows, "doc_id long, text string"), "key", "doc_id", "text").collect()
    assert len({r["key"] for r in keyed}) == len(set(rows)) and len(keyed) == len(rows)


def plain_links(docs, percent, width=5):
    sets = {}
    for i, text in docs:
        ws = text.split()
        sets[i] = {tuple(ws[k : k + width]) for k in range(max(1, len(ws) - width + 1))} if ws else set()
    low = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                    low[a] = low[b] = min(low[a], low[b])
    return low


@pytest.mark.parametrize("percent", [30, 50, 75])
def test_jaccard_at_other_thresholds(spark, percent):
    rnd = np.random.default_rng(percent)
    docs = []
    for family in range(6):
        base = [f"w{family}_{k}" for k in range(160)]
        for _ in range(5):
            start, size = int(rnd.integers(0, 60)), int(rnd.integers(30, 100))
            docs.append((len(docs), " ".join(base[start : start + size])))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_classes(frame, percent=percent).collect()}
    assert got == plain_links(docs, percent)


@pytest.mark.parametrize("width", [64, 384, 768, 1536])
def test_trees_split_in_any_number_of_dimensions(width):
    random = np.random.default_rng(width)
    units = random.normal(size=(4000, width))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    side = random.normal(size=(300, width))
    side -= (side * units[:300]).sum(axis=1, keepdims=True) * units[:300]
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    pairs = 0.95 * units[:300] + math.sqrt(1 - 0.95**2) * side  # each at a cosine of 0.95
    every = np.concatenate([units, pairs])
    found, entries = np.zeros(300, bool), 0
    for seed in range(10):
        tree = vectors.Tree(every, 5, seed, math.sqrt(0.1))
        row, leaf = tree.leaves(every)
        sizes = np.unique(leaf, return_counts=True)[1]
        assert len(sizes) == 32 and sizes.max() < 0.15 * len(every)
        entries += len(row)
        here = [{*zip(row[(row >= a) & (row < a + 300)] - a, leaf[(row >= a) & (row < a + 300)], strict=True)} for a in (0, 4000)]
        found[[i for i, _ in here[0] & here[1]]] = True
    assert found.mean() >= 0.9 and entries < 30 * len(every)


def test_vectors_of_two_lengths(spark):
    random = np.random.default_rng(2)
    rows, units = [], {}
    for width in (12, 40):
        made = random.normal(size=(150, width))
        made = np.concatenate([made, made[:40] + random.normal(size=(40, width)) * 0.02])
        made /= np.linalg.norm(made, axis=1, keepdims=True)
        rows += [(len(rows) + i, v.tolist()) for i, v in enumerate(made)]
        units[width] = made
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = {r["vec_id"]: r["n_links"] for r in vectors.near_vectors(frame, leaf_rows=20, trees=20).collect()}
    first = 0
    for made in units.values():
        links = (made @ made.T >= 0.95).sum(axis=1) - 1
        assert [got[first + i] for i in range(len(made))] == links.tolist()
        first += len(made)
