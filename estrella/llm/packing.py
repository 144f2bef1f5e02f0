"""Packing token sequences as vector bin packing with the dot-product heuristic.

A sequence has limits on tokens, segments and loss-bearing tokens. Documents are dealt to groups of
bounded size by hash; in a group, the sequence that is being filled takes the piece whose demand
vector has the largest dot product with what is still free, so a scarce resource counts more. When
no piece fits whole, one is cut to fill the gap, so only the last sequences of a group are padded.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estrella.llm.shipping import ship
from estrella.llm.tokens import encode_all
from estrella.llm.words import in_slices, utf8_texts

GROUP_ROWS = 2048
GROUP_BYTES = 8 << 20


def pack_vectors(
    tokens: Sequence[int], loss: Sequence[int], max_tokens: int, max_segments: int, max_loss: int, cut: bool = True
) -> list[tuple[int, int, int, int, int]]:
    """(item, start, length, sequence, offset) for every piece of every item.

    ``loss`` says how many of an item's tokens, its last ones, bear loss. With ``cut``, items may be
    cut anywhere; without it, every item must fit alone. Items of no tokens get no piece.
    """
    left = np.array(tokens, np.int64)  # still to be placed, always the end of an item
    bearing = np.minimum(np.array(loss, np.int64), left)
    start = np.zeros(len(left), np.int64)
    capacity = np.array([max_tokens, max_segments, max_loss], float)
    if not cut and len(left) and (left.max() > max_tokens or bearing.max() > max_loss):
        raise ValueError("an item exceeds the limits and may not be cut")
    out, sequence = [], 0

    def loss_in(item: int, length: int) -> int:
        """Loss-bearing tokens among the next ``length`` of an item."""
        return max(0, length - (int(left[item]) - int(bearing[item])))

    def place(item: int, length: int, offset: int) -> None:
        out.append((item, int(start[item]), length, sequence, offset))
        bearing[item] -= loss_in(item, length)
        start[item] += length
        left[item] -= length

    if cut and max_loss >= max_tokens:
        for item in np.flatnonzero(left >= max_tokens):  # whole sequences of one long item
            while left[item] >= max_tokens:
                place(int(item), max_tokens, 0)
                sequence += 1
    while (alive := np.flatnonzero(left)).size:
        size, bears = left[alive].astype(float), bearing[alive].astype(float)
        open_ = np.ones(len(alive), bool)
        free, offset = capacity.copy(), 0
        while free[0] > 0 and free[1] > 0 and open_.any():
            weight = free / capacity**2
            score = weight[0] * size + weight[1] + weight[2] * bears
            fits = open_ & (size <= free[0]) & (bears <= free[2])
            whole = fits.any()
            best = int(np.argmax(np.where(fits if whole else open_, score, -1.0)))
            item = int(alive[best])
            if whole:
                length = int(left[item])
            elif not cut:
                break
            else:
                silent = int(left[item] - bearing[item])
                length = int(min(free[0], left[item], silent + free[2]))
                if length <= 0:
                    open_[best] = False
                    continue
            borne = loss_in(item, length)
            place(item, length, offset)
            offset += length
            free -= (length, 1, borne)
            open_[best] = False  # a cut item ends this sequence or goes on in a later one
        sequence += 1
    return out


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    max_tokens: int = 4096,
    max_segments: int = 512,
    max_loss: int | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
    loss: str | None = None,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids).

    A document is the ids of its whole text and ``end_id``. ``loss`` names a column with the number of tokens that bear
    loss, the last ones of the document (a prompt comes before its answer); without it, or where it is NULL, all
    do. No sequence has more than ``max_loss`` of them, nor more than ``max_segments`` pieces. The number of
    groups follows from the rows and bytes of the input, so a task holds about ``GROUP_ROWS`` rows or
    ``GROUP_BYTES`` of text; which group a row goes to depends on its id and text alone. Sequence ids
    are unique, not dense. A NULL text is empty, a NULL id is kept, repeated rows are packed like
    others. Other columns are ignored. An empty input gives an empty result.
    """
    ship(docs.sparkSession)
    docs = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        F.col(f"`{text}`").cast("string").alias("text"),
        (F.col(f"`{loss}`") if loss else F.lit(None)).cast("long").alias("loss"),
    )
    seen = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    groups = max(1, -(-seen["n"] // GROUP_ROWS), -(-(seen["b"] or 0) // GROUP_BYTES))
    limit = max_tokens if max_loss is None else max_loss

    def one(batch):
        end = np.array([end_id], "<u4").tobytes()
        made = [ids + end for ids in encode_all(utf8_texts(batch, "text"), tokenizer)]
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("doc_id", "loss", "grp")), pa.array([_packed(m) for m in made], pa.binary())],
            names=["doc_id", "loss", "grp", "ids"],
        )

    def pack(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids = [_unpacked(b) for b in table.column("ids").to_pylist()]
        names, group = table.column("doc_id").to_pylist(), table.column("grp")[0].as_py()
        bearing = [len(d) if b is None else max(0, min(b, len(d))) for b, d in zip(table.column("loss").to_pylist(), ids, strict=True)]
        # a fixed order, however the rows arrive
        order = sorted(range(len(ids)), key=lambda i: (len(ids[i]), bearing[i], zlib.crc32(ids[i]), names[i] is not None, names[i] or 0))
        pieces = pack_vectors([len(ids[i]) for i in order], [bearing[i] for i in order], max_tokens, max_segments, limit)
        cols: dict[str, list] = {c: [] for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")}
        for at, start, length, sequence, offset in pieces:
            i = order[at]
            part = ids[i][start : start + length]
            row = (names[i], start, length, zlib.crc32(part), len(ids[i]), (group << 32) + sequence, offset)
            for c, v in zip(cols, (*row, part if with_ids else None), strict=True):
                cols[c].append(v)
        arrays = [pa.array(cols[c], pa.int64()) for c in list(cols)[:-1]]
        if with_ids:
            arrays.append(pa.array(cols["ids"], pa.list_(pa.int64())).cast(pa.list_(pa.int32())))
        return pa.Table.from_arrays(arrays, names=list(cols)[: len(arrays)])

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    schema += ", ids array<int>" if with_ids else ""
    grp = F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).alias("grp")
    encoded = docs.select("doc_id", "text", "loss", grp).mapInArrow(in_slices(one), "doc_id long, loss long, grp long, ids binary")
    return encoded.groupBy("grp").applyInArrow(pack, schema)


def _packed(ids: bytes) -> bytes:
    """Two bytes per id if all ids are small enough, else four; the first byte says which."""
    numbers = np.frombuffer(ids, "<u4")
    return b"\x02" + numbers.astype("<u2").tobytes() if numbers.max(initial=0) < 1 << 16 else b"\x04" + ids


def _unpacked(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, f"<u{packed[0]}", offset=1).astype("<u4")
