"""Packing instruction data through Spark under three limits."""

from collections import defaultdict

import numpy as np
import public_tokenizers

from estrella.llm import packing

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def test_a_loss_limit_below_the_token_limit(spark):
    random = np.random.default_rng(4)
    rows = [(i, " ".join(f"word{random.integers(0, 50)}" for _ in range(random.integers(0, 90))), int(random.integers(0, 60))) for i in range(150)]
    rows += [(1000, "plain text without a count", None), (1001, None, 3), (1002, "more than there is", 10**6), (1003, "less than none", -5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bears long").repartition(3)
    got = packing.pack_documents(docs, TOKENIZER, 2, max_tokens=256, max_segments=6, max_loss=64, loss="bears").collect()
    tokens = {r["doc_id"]: r["doc_tokens"] for r in got}
    bears = {i: tokens[i] if b is None else max(0, min(b, tokens[i])) for i, _, b in rows}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        silent = tokens[r["doc_id"]] - bears[r["doc_id"]]  # the tokens before the loss-bearing ones
        borne = max(0, r["start"] + r["length"] - max(r["start"], silent))
        sequences[r["sequence_id"]].append((r["offset"], r["length"], borne))
    assert set(pieces) == {i for i, _, _ in rows}
    for doc_id, parts in pieces.items():  # every token once
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == tokens[doc_id]
    for parts in sequences.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256 and len(parts) <= 6 and sum(b for _, _, b in parts) <= 64
    # the loss limit is what binds, so there are about as many sequences as it asks for
    assert len(sequences) <= 1.3 * max(sum(bears.values()) / 64, sum(tokens.values()) / 256) + 3
