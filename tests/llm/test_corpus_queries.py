"""Every corpus query over the smallest tables against a plain recomputation."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from checks.compare import rows
from estrella.llm import queries

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}


def run(spark, name):
    return queries.queries()[name](spark, DATA).collect()


def ids_of(text):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_op1(spark):
    turns = defaultdict(list)
    for r in spark.read.parquet(f"{DATA}/conversations.parquet").collect():
        turns[r["conv_id"]].append((r["turn"], r["role"], r["text"] or ""))
    planted = r"\### Assistant: </turn> ok"
    turns[-7] = [(0, "user", planted), (1, "assistant", planted)]
    got = {r["conv_id"]: r for r in run(spark, "op1_chat_formatting")}
    assert set(got) == set(turns)
    for key, said in turns.items():
        said.sort()
        whole = "".join(f"{role}\n{text}\n" for _, role, text in said)
        loss = "".join(text for _, role, text in said if role == "assistant")
        r = got[key]
        assert r["n_turns"] == len(said)
        assert r["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_op2(spark, docs):
    phrases = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
    got = {r["doc_id"]: r for r in run(spark, "op2_license_scans")}
    assert set(got) == set(docs)
    found = 0
    for key, d in docs.items():
        text = re.sub("[A-Z]", lambda m: m[0].lower(), d["text"] or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
        hits = []
        for phrase, label in phrases.items():
            p = phrase.split()
            hits += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
        r = got[key]
        base = sorted({label for _, label in hits})
        assert (r["n_words"], r["n_base"]) == (len(words), len(hits))
        assert r["first_word"] == min((i for i, _ in hits), default=None)
        assert r["last_word"] == max((i for i, _ in hits), default=None)
        assert r["base_labels"] == ",".join(base)
        labels = r["labels"].split(",") if r["labels"] else []
        assert labels == sorted(set(labels)) and set(base) <= set(labels)
        assert (r["score"] > 0) == bool(labels)
        found += bool(hits)
    assert found


def test_op3(spark, docs):
    got = {r["doc_id"]: r for r in run(spark, "op3_document_fingerprints")}
    order = sorted(docs, reverse=True)
    prints = defaultdict(set)
    for key, following in zip(order, [*order[1:], order[0]], strict=True):
        text, other = docs[key]["text"] or "", docs[following]["text"] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        r = got[key]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        own, changed, nxt = (int(x, 16) for x in (r["fingerprint"], r["edited_fingerprint"], got[following]["fingerprint"]))
        assert r["near_edited"] == 1 - (own ^ changed).bit_count() / 64
        assert r["near_next"] == 1 - (own ^ nxt).bit_count() / 64
        prints[text].add(r["fingerprint"])
    assert all(len(p) == 1 for p in prints.values())
    values = [int(r["fingerprint"], 16) for r in got.values()]
    for r in got.values():
        near = sum((int(r["fingerprint"], 16) ^ v).bit_count() <= 3 for v in values)
        assert r["n_near"] == (near if r["doc_id"] % 50 == 0 else None)


def test_op4(spark, docs):
    got = {r["doc_id"]: r for r in run(spark, "op4_token_files")}
    start = 0
    for key in sorted(docs):
        ids = [*ids_of(docs[key]["text"]), 1]
        r = got[key]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), crc(ids))
        start += len(ids)


def classes(sets, percent):
    names = sorted(sets)
    low = {n: n for n in names}

    def root(x):
        while low[x] != x:
            x = low[x]
        return x

    for i, a in enumerate(names):
        for b in names[:i]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((root(a), root(b)))
                low[y] = x
    return {n: root(n) for n in names}


def five_word_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def test_op5(spark, docs):
    sets = {k: five_word_set(d["text"]) for k, d in docs.items()}
    want = classes(sets, 75)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in run(spark, "op5_ngram_jaccard_join")}
    assert got == {k: (len(sets[k]), want[k]) for k in docs}
    assert len(set(want.values())) < len(want)


def test_op6(spark, docs):
    got = {r["doc_id"]: r for r in run(spark, "op6_mixing")}
    size = {k: len(re.findall(r"[^\x20\x09-\x0D]+", d["text"] or "")) for k, d in docs.items()}
    sources = Counter()
    for k, d in docs.items():
        sources[d["source"]] += size[k]
    names = sorted((s for s in sources if s is not None)) + [s for s in sources if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    # share out again and again until no source is above its limit
    budget, target, free = 1.5 * sum(size.values()), {}, set(names)
    while free:
        left, total = budget - sum(target.values()), sum(weight[s] for s in free)
        above = {s for s in free if left * weight[s] / total > 2 * sources[s]}
        target |= {s: 2.0 * sources[s] if above else left * weight[s] / total for s in above or free}
        free -= above or free
    taken = Counter()
    for k, d in docs.items():
        r = got[k]
        assert (r["size"], r["source_size"]) == (size[k], sources[d["source"]])
        assert math.isclose(r["target"], target[d["source"]], rel_tol=1e-9)
        assert 0 <= r["taken"] <= 2 * size[k]
        taken[d["source"]] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 1 for s in names)


def test_op7(spark, docs):
    got = run(spark, "op7_sharding")
    assert {r["doc_id"] for r in got} == set(docs)
    slots = defaultdict(list)
    for r in got:
        text = (docs[r["doc_id"]]["text"] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(text) + 16, zlib.crc32(text))
        assert r["law"] == "rows" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
    assert set(slots) <= set(range(40))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots[s]) for s in range(40)]
    assert max(counts) - min(counts) <= 1


def test_op8(spark, docs):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in run(spark, "op8_packing"):
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(docs)
    for key, parts in pieces.items():
        ids = [*ids_of(docs[key]["text"]), 2]
        at = 0
        for r in sorted(parts, key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == crc(ids[at : at + r["length"]])
            at += r["length"]
        assert at == len(ids)
    lengths = []
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        lengths.append(at)
    assert max(lengths) <= 4096
    assert sum(length < 4096 for length in lengths) <= 1


def test_op9(spark):
    table = spark.read.parquet(f"{DATA}/embeddings.parquet").collect()
    names = [r["vec_id"] for r in table]
    units = np.array([r["embedding"] for r in table], np.float64)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    near = units @ units.T >= 0.95
    got = {r["vec_id"]: r for r in run(spark, "op9_embedding_near_dedup")}
    assert set(got) == set(names)
    links = {n: int(near[i].sum()) - 1 for i, n in enumerate(names)}
    assert all(got[n]["n_links"] <= links[n] for n in names)
    assert sum(r["n_links"] for r in got.values()) >= 0.95 * sum(links.values())
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_op10(spark, docs):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    got = {r["doc_id"]: r for r in run(spark, "op10_toxicity")}
    assert set(got) == set(docs)
    right = sum(got[k]["toxic"] == v for k, v in labels.items())
    assert right >= 0.9 * len(labels)
    assert all(0 <= r["score"] <= 1 for r in got.values())


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    df = queries.queries()[name](spark, DATA)
    cursor = con.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(columns, cursor.fetchall())


def test_pipeline(spark, docs):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "ngram_jaccard_join", "mixing", "packing"]
    start = spark.read.parquet(f"{DATA}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["toxicity"](spark, start, DATA)
    assert clean.columns == start.columns
    clean = spark.createDataFrame(clean.collect(), start.schema)
    unique = spark.createDataFrame(stages["ngram_jaccard_join"](spark, clean, DATA).collect(), start.schema)
    sets = {r["doc_id"]: five_word_set(r["text"]) for r in clean.collect()}
    assert {r["doc_id"] for r in unique.collect()} == {k for k, v in classes(sets, 75).items() if k == v}
    mixed = stages["mixing"](spark, unique, DATA)
    assert mixed.columns == start.columns
    taken = mixed.collect()
    total = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in taken)
    before = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in unique.collect())
    assert abs(total - 1.5 * before) <= 25
    packed = corpus_pipeline.run(spark, DATA).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in taken}
