"""Spelling variants against a plain comparison of all words."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from estrella.llm import spelling
from estrella.session import materialize

SCHEMA = "doc_id long, text string, word string, n string, place string"  # three names that the operator uses


def near(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, least, stray):
    n = Counter()
    for doc_id, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for run in re.findall("[a-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % stray == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= least}
    forms, beside = {}, {}
    for w, c in n.items():
        around = [x for x in n if near(w, x)]
        beside[w] = len(around)
        best = min(around, key=lambda x: (-n[x], x), default=None)
        forms[w] = best if best and n[best] >= 2 * c else None
    out = set()
    for w in n:
        root = w
        while forms[root]:
            root = forms[root]
        out.add((w, forms[w], root, n[w], beside[w], n[forms[w]] if forms[w] else None))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "w", "n", "p") for i, t in rows], SCHEMA).repartition(3)


def variants(rnd, word, letters):
    at = rnd.randrange(len(word))
    return rnd.choice([word[:at] + word[at + 1 :], word[:at] + rnd.choice(letters) + word[at:], word[:at] + rnd.choice(letters) + word[at + 1 :]])


@pytest.mark.parametrize("letters, stray", [("ab", 3), ("abcé", 5), ("abcdefghijklmnopqrstuvwxyzÀÿ×", 97)])
def test_against_all_pairs(spark, letters, stray):
    rnd = random.Random(letters)
    base = ["".join(rnd.choice(letters) for _ in range(rnd.randint(5, 11))) for _ in range(60)]
    base += ["aaaaa", "aaaaaa", "ababab", "bababa", "aaaaab"]  # the same bigram in several places
    pool = base * 8
    for _ in range(3):
        pool += [variants(rnd, w, letters) for w in rnd.sample(pool, 150)] * rnd.randint(1, 4)
    rows = [(rnd.choice([None, 1, 2, 3, i]), " ".join(rnd.choice(pool).title() if i % 5 else rnd.choice(pool) for _ in range(60))) for i in range(50)]
    rows += [(7, None), (8, ""), (9, "...123 _ ŒŸ"), (10, "hello-Hello's hello1HELLO"), (11, "x" * 50_000 + " " + base[0] * 3000)]
    rows += rows[:5]
    got = spelling.spelling_variants(frame(spark, rows), least=2, stray=stray).collect()
    want = brute(rows, 2, stray)
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert any(r["form"] for r in got) and any(r["root"] not in (r["form"], r["word"]) for r in got)


def test_empty_and_without_near_words(spark):
    assert spelling.spelling_variants(frame(spark, [])).collect() == []
    rows = [(None, "singular different")] * 3
    got = spelling.spelling_variants(frame(spark, rows), stray=10**9).collect()
    assert sorted(map(tuple, got)) == [("different", None, "different", 3, 0, None), ("singular", None, "singular", 3, 0, None)]


def test_long_chain(spark):
    """Every word is the form of the one before; counts double along the chain."""
    words = ["a" * i + "b" * (12 - i) for i in range(11)]
    rows = [(None, " ".join([w] * 3 * 2**i)) for i, w in enumerate(words)]
    got = spelling.spelling_variants(frame(spark, rows), stray=10**9).collect()
    assert {r["word"]: r["form"] for r in got} == dict(zip(words, [*words[1:], None], strict=True))
    assert {r["root"] for r in got} == {words[-1]}


def test_pivots_do_not_overlap_and_cost_least():
    rnd = random.Random(3)
    grams = [a + b for a in "abc" for b in "abc"]
    order = {g: (i, rnd.randint(1, 9)) for i, g in enumerate(rnd.sample(grams, 9))}
    for _ in range(500):
        word = "".join(rnd.choice("abc") for _ in range(rnd.randint(5, 9)))
        prefix, pivots, last = spelling.prefix_and_pivots(word, order)
        places = sorted(p for _, p in pivots)
        assert places[1] - places[0] >= 2 and set(pivots) <= set(prefix) and len(prefix) >= 3
        assert all(g <= last for g, _ in prefix)
        cost = {p: order[word[p : p + 2]][1] for _, p in prefix}
        assert sum(cost[p] for p in places) == min(cost[p] + cost[q] for p in cost for q in cost if q - p >= 2)


def test_sections_part_no_run(monkeypatch):
    monkeypatch.setattr(spelling, "SECTION_BYTES", 7)
    text = "Hello héllo wörld, one-two ÀÿÀÿÀÿÀÿÀÿÀÿ three four5five Ω six" * 5
    parts = list(spelling._sections(text.encode()))
    assert b"".join(parts) == text.encode() and len(parts) > 10
    whole = Counter(re.findall("[a-zÀ-ÿ]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)))
    assert spelling.stray_runs(1, text.encode(), 10**12) == whole


def test_candidates_are_far_fewer_than_pairs(spark):
    rnd = random.Random(9)
    words = sorted({"".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(5, 10))) for _ in range(3000)})
    frame_ = materialize(spark.createDataFrame([(w, 5) for w in words], "word string, n long"))
    found = {(r["a"], r["b"]) for r in spelling.near_pairs(frame_).collect()}
    assert found == {(a, b) for i, a in enumerate(words) for b in words[i + 1 :] if abs(len(a) - len(b)) < 2 and near(a, b)}
    assert frame_.filter(F.length("word") < 5).isEmpty()
