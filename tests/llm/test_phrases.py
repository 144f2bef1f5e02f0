"""Collocations against a plain count over the texts."""

import random
import re
from collections import Counter, defaultdict

import pytest

from estrella.llm import phrases

SCHEMA = "doc_id long, text string, lang string, phrase string, weight string"  # two names that the operator uses


def grams(text, longest=phrases.MAX_WORDS):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    out = Counter()
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
        ws = re.findall(r"[^\x20\x09]+", piece)
        for k in range(1, longest + 1):
            out.update(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))
    return out


def brute(rows, least, top, cover=100):
    out = set()
    by = defaultdict(Counter)
    for text, lang in rows:
        by["und" if lang is None else lang] += grams(text)
    for lang, f in by.items():
        n = sum(c for g, c in f.items() if len(g) == 1)
        cand = {g: c for g, c in f.items() if len(g) > 1 and c >= least}
        longer = Counter()
        for g, c in cand.items():
            for k in range(2, len(g)):
                for i in range(len(g) - k + 1):
                    longer[g[i : i + k]] = max(longer[g[i : i + k]], c)
        found = []
        for g, a in cand.items():
            if 100 * longer[g] >= cover * a:
                continue
            score, k = min((1000 * a * n // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.add((lang, rank, p.decode(), -a, l, r, n, -s))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, t, g, "p", "w") for i, (t, g) in enumerate(rows)], SCHEMA).repartition(3)


def words(rnd, n):
    ends = [" "] * 8 + ["\t ", ". ", ",", "\n\n", " ; ", " ", "\x0b"]
    return "".join(rnd.choice(["a", "b", "B", "cc", "é", "d\x00"]) + rnd.choice(ends) for _ in range(n))


@pytest.mark.parametrize("every", [1, 3, 64])
def test_against_a_plain_count(spark, every):
    rnd = random.Random(every)
    rows = [(words(rnd, rnd.randint(0, 60)), rnd.choice(["en", "fr", None])) for _ in range(60)]
    shared = words(rnd, 80)
    rows += [(shared, "en")] * 30 + [(words(rnd, 9) + shared + words(rnd, 3), "en") for _ in range(10)]
    rows += [(None, "en"), ("", "en"), (" .,\n", "xx"), ("one", "yy"), ("the " * 30_000, "hot"), ("zz" * 100_000, "hot")]
    got = phrases.collocations(frame(spark, rows), least=6, top=40, every=every, bits=20)
    assert {tuple(r) for r in got.collect()} == brute(rows, 6, 40)


def test_full_bitmaps_lose_nothing(spark):
    """A bitmap of so few bits that all are set cannot prune anything; the results are the same."""
    rnd = random.Random(5)
    rows = [(words(rnd, 200), "en") for _ in range(30)]
    docs = frame(spark, rows)
    results = [{tuple(r) for r in phrases.collocations(docs, least=5, top=500, bits=b, cover=80).collect()} for b in (16, 22)]
    assert results[0] == results[1] == brute(rows, 5, 500, 80)


def test_empty_table(spark):
    assert phrases.collocations(frame(spark, [])).collect() == []


def test_large_counts_are_exact(spark):
    a, n, l, r = 10**16, 3 * 10**17, 10**16 + 7, 10**16 + 9
    row = spark.createDataFrame([(a, n, l, r)], "a long, n long, l long, r long")
    got = row.select(phrases._score(*(row[c] for c in "anlr"))).first()[0]
    assert got == 1000 * a * n // (l * r)


@pytest.mark.parametrize("section, longest", [(1 << 21, 4096), (40, 4096), (40, 7), (1 << 21, 5)])
def test_every_phrase_starts_in_one_chunk(monkeypatch, section, longest):
    monkeypatch.setattr(phrases, "SECTION_BYTES", section)
    monkeypatch.setattr(phrases, "LONGEST", longest)
    rnd = random.Random(section + longest)
    texts = [words(rnd, rnd.randint(0, 90)) for _ in range(40)] + ["same " * 200, "x", ".", "", "y" * 500]
    sections = [s for t in texts for s in phrases._sections(t.encode())]
    made = Counter(c for _, c in phrases._chunks(sections, 5))
    if longest < 100:
        assert max(c.count(b" ") + 1 for c in made) <= longest + 2 * phrases.WINDOW
    got = Counter()
    for chunk, weight in made.items():
        ws = chunk.split(b" ")
        for i in range(len(ws) - phrases.WINDOW):
            for k in range(1, phrases.MAX_WORDS + 1):
                if b"\xff" not in ws[i : i + k]:
                    assert i + k <= len(ws)
                    got[tuple(w.decode() for w in ws[i : i + k])] += weight
    want = Counter()
    for t in texts:
        want += grams(t)
    assert got == want


def test_copies_share_their_chunks():
    rnd = random.Random(1)
    passage = " ".join(f"w{rnd.randint(0, 5000)}" for _ in range(2000))
    alone = Counter(c for _, c in phrases._chunks(list(phrases._sections(passage.encode())), 16))
    both = (f"before {passage}".encode(), f"other words go here {passage}".encode())
    made = [{c for _, c in phrases._chunks(list(phrases._sections(t)), 16)} for t in both]
    assert len(made[0] & made[1] & set(alone)) > 0.95 * len(alone)
