"""Odd inputs: nulls, empty and long texts, repeated rows, empty tables, clashing column names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from estrella.llm import (
    chat,
    fingerprints,
    jaccard_join,
    licenses,
    mixing,
    packing,
    queries,
    sharding,
    token_files,
    toxicity,
    vectors,
)
from estrella.session import work_path

LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa " * 4000 + "x" * 30_000
ROWS = [
    (5, "one two three four five six", "en", "a", 27, 1, "n", "p"),
    (5, "one two three four five six", "en", "a", 27, 1, "n", "p"),  # a repeated row
    (5, "another text under the same id", "en", None, 30, 2, "n", "p"),
    (None, "one two three four five six", "en", "b", 27, None, None, None),
    (7, None, None, None, None, 3, "n", "p"),
    (8, "", "en", "b", 0, 4, "n", "p"),
    (9, " \n\t ", "en", "b", 4, 5, "n", "p"),
    (10, LONG, "en", "c", len(LONG), 6, "n", "p"),
    (11, "ONE two three", "en", "c", 13, 7, "n", "p"),
    (12, "one TWO three", None, "c", 13, 8, "n", "p"),
    (13, "héßo Ωmega 𝔘nicode <|endoftext|> <|ENDOFTEXT|> é H̱", "xx", "c", 40, 9, "n", "p"),
]
# extra columns named like those the operators use inside
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, part string, size string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_jaccard(odd, none):
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_classes(odd).collect()), key=str)
    assert got.count((5, 2, 5)) == 3 - 1 + 1  # the two copies and the other text of six words
    assert (None, 2, 5) in got
    assert (7, 0, 7) in got and (8, 0, 8) in got and (9, 0, 9) in got
    assert (11, 1, 11) in got and (12, 1, 11) in got
    assert len(got) == len(ROWS)
    assert jaccard_join.jaccard_classes(none).collect() == []


def test_jaccard_families(spark):
    """Families of edited copies, large enough for several blocks, against all pairs."""
    import random

    random.seed(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(400):
        words = list(base)
        for _ in range(random.randint(0, 8)):
            words[random.randrange(len(words))] = f"x{random.random()}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(base[: 100 + i])) for i in range(20)]
    rows += [(2000 + i, " ".join(f"z{random.randrange(50)}" for _ in range(30))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {}
    for k, t in rows:
        w = t.split()
        sets[k] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    low = {k: k for k in sets}

    def root(x):
        while low[x] != x:
            x = low[x]
        return x

    names = sorted(sets)
    for i, a in enumerate(names):
        for b in names[:i]:
            both = len(sets[a] & sets[b])
            if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                low[y] = x
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_classes(docs).collect()}
    assert got == {k: root(k) for k in names}


def test_chat(spark):
    rows = [
        (1, 0, "user", r"a \0 <turn:x> </turn> \1 \\1"),
        (1, 1, "assistant", None),
        (1, 1, "assistant", "twice"),
        (1, 1, "assistant", "twice"),
        (1, None, "we<ird>\n:role", "text"),
        (None, 3, None, "lost"),
    ]
    made = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {
        r["conv_id"]: [tuple(t) for t in r["turns"]]
        for r in made.select("conv_id", chat.read_back(F.col("formatted"), F.col("loss")).alias("turns")).collect()
    }
    assert got[None] == [("", "lost", "")]
    assert got[1] == [
        ("we<ird>\n:role", "text", ""),
        ("user", r"a \0 <turn:x> </turn> \1 \\1", ""),
        ("assistant", "", ""),
        ("assistant", "twice", "twice"),
        ("assistant", "twice", "twice"),
    ]
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_conversations(empty).collect() == []


def test_chat_parts_and_long_conversations(spark):
    part = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
    content = [
        ("text", "look: ", None, None, None, None, None),
        ("image", None, "a.png", 28, 15, None, None),
        ("audio", None, "b.wav", None, None, 1.5, None),
        ("document", None, "c.pdf", None, None, None, 2),
        ("hologram", None, "d", None, None, None, None),
        ("text", "<done>", None, None, None, None, None),
    ]
    frame = spark.createDataFrame([(1, 0, "assistant", content)], f"conv_id long, turn long, role string, text array<{part}>")
    row = chat.format_conversations(frame).first()
    assert row["formatted"] == "<turn:assistant>look: <image:1><audio:2><document:3><other:4>\\1done></turn>\n"
    assert [(a["part"], a["kind"], a["ref"], a["tokens"]) for a in row["attachments"]] == [
        (1, "image", "a.png", 4),
        (2, "audio", "b.wav", 38),
        (3, "document", "c.pdf", 512),
        (4, "hologram", "d", 0),
    ]
    turns = [(1, i, "user" if i % 2 else "assistant", f"t{i}") for i in range(500)]
    made = chat.format_conversations(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    back = made.select(chat.read_back(F.col("formatted"), F.col("loss")).alias("t")).first()["t"]
    assert [t["text"] for t in back] == [f"t{i}" for i in range(500)]
    assert "".join(t["loss_text"] for t in back) == "".join(f"t{i}" for i in range(0, 500, 2))


def test_licenses(spark, odd, none):
    assert licenses.scan_licenses(odd).count() == len(ROWS)
    assert licenses.scan_licenses(none).collect() == []
    far = "filler " * 500
    rows = [(1, far + "Licensed under the\nApache License, Version 2.0 " + far), (2, "cc\nby cc by, CC-BY"), (3, "license apache")]
    got = {r["doc_id"]: r for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1]["labels"] == "apache-notice" and got[1]["n_base"] == 0
    assert (got[2]["n_base"], got[2]["first_word"], got[2]["last_word"], got[2]["base_labels"]) == (3, 0, 4, "cc-by")
    assert got[3]["labels"] == "" and got[3]["score"] == 0


def test_template_join_is_exact():
    """Every block that holds enough of a template is met, whatever the word frequencies."""
    import random

    random.seed(5)
    words = [f"w{i}".encode() for i in range(30)]
    templates = tuple(
        licenses.Template(f"t{k}", b" ".join(random.sample(words, random.randint(2, 9))).decode()) for k in range(8)
    )
    index = licenses.TemplateIndex(templates, {w: random.randrange(100) for w in words}, 0.75)
    for _ in range(200):
        text = [random.choice(words) for _ in range(random.randint(0, 40))]
        met, _ = index.scan(text)
        want = set()
        for block in range(len(text) // index.stride + 1):
            held = set(text[block * index.stride : (block + 2) * index.stride])
            for t, template in enumerate(templates):
                own = set(template.text.encode().split())
                if len(own & held) >= 0.75 * len(own):
                    want.add((t, block))
        assert {(t, b) for t, b, _ in met} >= {(t, b) for t, b in want if text[b * index.stride :]}
        assert {(t, b) for t, b, _ in met} <= want


def test_fingerprints(odd, none, spark):
    got = fingerprints.fingerprint_documents(odd).collect()
    assert len(got) == len(ROWS)
    same = {r["fingerprint"] for r in got if r["n_chars"] == 27}
    assert len(same) == 1
    assert fingerprints.fingerprint_documents(none).collect() == []
    alone = fingerprints.fingerprint_documents(spark.createDataFrame([(1, "abcd")], "doc_id long, text string")).first()
    assert alone["near_next"] == 1.0


def test_near_fingerprints(spark):
    import random

    random.seed(2)
    values = [random.getrandbits(64) for _ in range(40)]
    values += [v ^ sum(1 << b for b in random.sample(range(64), k)) for v in values for k in (0, 1, 2, 3, 4)]
    frame = spark.createDataFrame([(f"{v:016x}",) for v in values] + [(None,)], "fingerprint string")
    got = {r["fingerprint"]: r["n_near"] for r in fingerprints.near_counts(frame, frame).collect()}
    assert got == {f"{v:016x}": sum((v ^ w).bit_count() <= 3 for w in values) for v in values}


def test_token_files(spark, odd, none):
    path = work_path(spark)
    token_files.write_tokens(odd, path, queries.TOKENIZER, 1)
    index = token_files.token_index(token_files.read_tokens(spark, path)).orderBy("start").collect()
    assert [r["doc_id"] for r in index] == [None, 5, 5, 5, 7, 8, 9, 10, 11, 12, 13]
    at = 0
    for r in index:
        assert r["start"] == at
        at += r["n_tokens"]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.TOKENIZER)
    stored = {r["doc_id"]: r["ids"] for r in token_files.read_tokens(spark, path).filter("doc_id >= 8").collect()}
    for key, text, *_ in ROWS:
        if key is not None and key >= 8:
            assert stored[key] == [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
    empty = work_path(spark)
    token_files.write_tokens(none, empty, queries.TOKENIZER, 1)
    assert token_files.token_index(token_files.read_tokens(spark, empty)).collect() == []


def test_mixing(odd, none, spark):
    sized = odd.withColumn("size", mixing.word_count(F.col("text"))).withColumn("target", F.lit("mine"))
    got = mixing.mix(sized).collect()
    assert len(got) == len(ROWS)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    assert mixing.mix(none.withColumn("size", F.lit(1))).collect() == []
    nothing = mixing.mix(odd.filter("doc_id IN (7, 8)").withColumn("size", F.lit(None).cast("long"))).collect()
    assert [r["taken"] for r in nothing] == [0, 0]


def test_sharding(odd, none, spark):
    got = sharding.shard_rows(odd, ["doc_id", "text", "lang"], 4).collect()
    assert len(got) == len(ROWS)
    for n in (1, 2, 3, 7, 100, 5000):
        frame = spark.range(n).select(sharding.permute(F.col("id"), n, seed=3).alias("p"))
        assert sorted(r["p"] for r in frame.collect()) == list(range(n))
    assert sharding.shard_rows(none, ["doc_id"], 4).collect() == []


def test_packing(odd, none):
    got = packing.pack_documents(odd, queries.TOKENIZER, 2, with_ids=True).collect()
    assert sum(r["length"] for r in got if r["doc_id"] == 10) == next(r["doc_tokens"] for r in got if r["doc_id"] == 10)
    assert all(len(r["ids"]) == r["length"] for r in got)
    assert packing.pack_documents(none, queries.TOKENIZER, 2).collect() == []


def test_pack_vectors_limits():
    import random

    random.seed(1)
    tokens = [random.randint(1, 300) for _ in range(500)]
    loss = [random.randint(0, t) for t in tokens]
    for cut in (True, False):
        out = packing.pack_vectors(tokens, loss, 512, 6, 300, cut)
        sequences, placed = {}, [0] * len(tokens)
        for item, start, length, sequence, offset in out:
            assert start == placed[item]
            borne = max(0, start + length - (tokens[item] - loss[item])) - max(0, start - (tokens[item] - loss[item]))
            used = sequences.setdefault(sequence, [0, 0, 0])
            assert offset == used[0]
            used[0] += length
            used[1] += 1
            used[2] += borne
            placed[item] += length
        assert placed == tokens
        assert all(a <= 512 and b <= 6 and c <= 300 for a, b, c in sequences.values())
    with pytest.raises(ValueError):
        packing.pack_vectors([600], [1], 512, 6, 300, cut=False)


def test_vectors(spark):
    one = [1.0, 0.0, 0.0]
    rows = [
        (1, one), (1, one), (2, [2.0, 0.0, 0.0]), (3, [1.0, 0.1, 0.0]), (4, None), (5, []), (6, [0.0, 0.0, 0.0]),
        (7, [None, 1.0, 0.0]), (8, [float("nan"), 1.0, 0.0]), (9, [float("inf"), 1.0, 0.0]), (None, one), (10, [0.0, 1.0, 0.0]),
        (11, [1.0, 0.0]), (12, [1.0, 0.01]),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in vectors.near_vectors(frame).collect()]
    assert got.count((1, 4, 1, True)) == 2
    assert (2, 4, 1, False) in got and (3, 4, 1, False) in got
    assert all((k, 0, k, True) in got for k in (4, 5, 6, 7, 8, 9, 10))
    assert (11, 1, 11, True) in got and (12, 1, 11, False) in got
    assert vectors.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_toxicity(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1)], "doc_id long, toxic int")
    assert [r["toxic"] for r in toxicity.score_toxicity(odd, labels).collect()] == [0] * len(ROWS)
    rows = [(i, f"word{i % 7} plain text {'vile' if i % 2 else 'kind'}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    got = {r["doc_id"]: r["toxic"] for r in toxicity.score_toxicity(docs, labels).collect()}
    assert got == {i: i % 2 for i in range(200)}
    assert len(toxicity.score_toxicity(odd, labels, keep_columns=True).collect()) == len(ROWS)
    assert toxicity.score_toxicity(none, labels).collect() == []


def test_pipeline_stages(spark, odd, none):
    data = "/root/testdata/sf0.001"
    for frame in (odd, none):
        docs = frame.select(corpus_pipeline.COLUMNS)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = spark.createDataFrame(stage(spark, docs, data).collect(), docs.schema)
        assert len(docs.collect()) <= 2 * len(ROWS)
        corpus_pipeline.STAGES[-1][1](spark, docs, data).collect()


def test_toxicity_cut_keeps_the_shares_of_all_labels(spark):
    """All toxic texts and a sixth of the clean ones say "maybe", most toxic ones also "surely"."""
    rows = [(i, "maybe surely" if i % 5 < 3 else "maybe", 1) for i in range(200)]
    rows += [(200 + i, "maybe" if i % 6 == 0 else "fine", 0) for i in range(1800)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    for max_rows in (6000, 100):
        got = toxicity.score_toxicity(frame, frame, max_rows=max_rows, keep_columns=True)
        called = {r["text"]: r["toxic"] for r in got.select("text", "toxic").distinct().collect()}
        assert called == {"maybe surely": 1, "maybe": 0, "fine": 0}


def test_toxicity_tells_long_words_apart(spark):
    """Words that begin alike, and characters of several bytes."""
    pairs = [("achlichkeit", "achlichheit"), ("переводчица", "переводчику"), ("一二三四", "一二五六")]
    for bad, good in pairs:
        rows = [(i, f"word {bad if i % 2 else good}", i % 2) for i in range(200)]
        frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
        got = toxicity.score_toxicity(frame, frame).collect()
        assert all(r["toxic"] == r["doc_id"] % 2 for r in got)
    assert len(set(map(int, toxicity.word_slots(["一二三四五六七".encode()])[0]))) == 3


def test_toxicity_uses_all_terms():
    """Kinds beyond the largest groups share a category, and each of many rare terms has a weight."""
    import numpy as np

    slots = [np.array([1000 + i % 100 if i % 2 else 5000 + i % 100], np.int32) for i in range(6000)]
    toxic = np.array([i % 2 for i in range(6000)], float)
    groups = toxicity.find_categories(slots, toxic)
    assert sorted(np.concatenate(groups).tolist()) == [1000 + i for i in range(1, 100, 2)]
    rare = [np.array([i if i % 2 else 50_000 + i], np.int32) for i in range(3000)]
    rare = rare + rare
    model = toxicity.fit_linear(rare, np.zeros((6000, 0)), toxic)
    assert (model.words[1:3000:2] > 0).all()


def test_vectors_tight_families(spark):
    """Families of distinct near copies: few leaves for each vector, and large leaves as pairs of blocks."""
    import numpy as np

    random = np.random.default_rng(5)
    centres = random.normal(size=(2, 64))
    near = np.concatenate([c / np.linalg.norm(c) + random.normal(size=(300, 64)) * 0.005 for c in centres])
    units = np.concatenate([near, random.normal(size=(400, 64))])
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    depth = 6
    for seed in range(10):
        row, _ = vectors.Tree(units, depth, seed, 0.1**0.5).leaves(units[:600])
        assert len(row) <= 600 * 1.25**depth
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(units)], "vec_id long, embedding array<double>")
    linked = units @ units.T >= 0.95
    want = {(i, int(linked[i].sum()) - 1, int(np.flatnonzero(linked[i])[0])) for i in range(len(units))}
    for task_rows in (64, 2048):
        got = vectors.near_vectors(frame, leaf_rows=16, task_rows=task_rows).collect()
        assert {(r["vec_id"], r["n_links"], r["component_id"]) for r in got} == want


def test_near_copies_go_by_row(spark):
    """One id with several texts, groups that share ids, near copies under one id or without any."""
    first, second, third, fourth = (" ".join(f"{c}{i}" for i in range(40)) for c in "pqrs")
    rows = [
        (1, first), (2, first + " x"), (2, second), (3, second + " x"),  # 2 is gone for one text only
        (4, third), (4, third + " x"),  # two texts of one id
        (None, fourth), (None, fourth), (None, fourth + " x"), (None, None), (None, None), (5, ""),
    ]
    docs = spark.createDataFrame([(*r, "en", "a", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars int")
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()]
    assert (1, first) in got and (2, second) in got
    assert [k for k, t in got if t and t.startswith("p")] == [1] and [k for k, t in got if t and t.startswith("q")] == [2]
    assert [k for k, t in got if t and t.startswith("r")] == [4]
    assert [k for k, t in got if t and t.startswith("s")] == [None]
    assert sum(t is None for _, t in got) == 2 and (5, "") in got
    assert len(got) == 7
