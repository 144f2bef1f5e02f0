"""Token ids of whole texts with a public tokenizer file, fast for texts whose words repeat."""

from __future__ import annotations

import os
import unicodedata

import numpy as np

from estrella.llm.words import hashed_spans

# Pieces whose ids are kept in a worker, at about 50 bytes each; a full table starts anew.
KEPT_PIECES = 1_000_000
GROUP_BYTES = 1 << 19

_TABLE_BITS = 21
_TABLE_SHIFT = np.uint64(64 - _TABLE_BITS)
_TABLE_MASK = (1 << _TABLE_BITS) - 1

# Kinds of bytes: 0 white space, 1 a-z, 2 ASCII punctuation, 3 everything else.
_KIND = np.full(256, 3, np.uint8)
_KIND[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = 2
_KIND[0x61:0x7B] = 1
_KIND[[0x20, *range(0x09, 0x0E)]] = 0


def _words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number; the last seven places are of the padding."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", padded.data, strides=(1,))


def _ends_of(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and the last eight bytes of spans, of shorter ones all bytes: together the whole span up to 16 bytes."""
    missing = np.maximum(8 - (ends - starts), 0).astype(np.uint64)
    head = words[starts] << (np.uint64(8) * missing)
    return head, np.where(missing == 0, words[np.maximum(ends - 8, 0)], head)


class _Pieces:
    """Ids of the pieces met so far: a table of hashes, and for each the place of its ids in one long array.

    The bytes of each piece are kept as well, and a span that meets its hash is compared with them; one with other bytes
    has a place of its own beside the table.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.clear()

    def clear(self) -> None:
        self.table = np.zeros(1 << _TABLE_BITS, np.uint64)  # 0: free
        self.slots = np.zeros(1 << _TABLE_BITS, np.int32)
        self.starts = np.zeros(1, np.int64)
        self.ids = np.empty(0, np.uint32)
        self.bytes = np.empty(0, np.uint8)
        self.bounds = np.zeros(1, np.int64)
        self.first, self.last = np.empty(0, np.uint64), np.empty(0, np.uint64)
        self.beside: dict[bytes, int] = {}

    def _encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all pieces one after another, how many each piece has, and the pieces' order in it."""
        plain = [i for i, p in enumerate(pieces) if p.isalpha()]  # a-z only: one word each
        other = [i for i, p in enumerate(pieces) if not p.isalpha()]
        counts = np.zeros(len(pieces), np.int64)
        made: list[int] = []
        if plain:
            words = self.tokenizer.encode(b" ".join([pieces[i] for i in plain]).decode(), add_special_tokens=False)
            made += words.ids
            counts[plain] = np.bincount(np.array(words.word_ids, np.int64), minlength=len(plain))
        for i, e in zip(other, self.tokenizer.encode_batch([pieces[i].decode() for i in other], add_special_tokens=False), strict=True):
            ids = e.ids
            made += ids
            counts[i] = len(ids)
        return np.array(made, np.uint32), counts, np.array(plain + other, np.int64)

    def add(self, pieces: list[bytes]) -> tuple[int, np.ndarray]:
        """Keep pieces with their ids; their first slot and their order from there on."""
        ids, counts, order = self._encode(pieces)
        first = len(self.starts) - 1
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(counts[order])])
        self.ids = np.concatenate([self.ids, ids])
        data = np.frombuffer(b"".join([pieces[i] for i in order]), np.uint8)
        bounds = np.concatenate([[0], np.cumsum([len(pieces[i]) for i in order])])
        head, tail = _ends_of(_words_at(data), bounds[:-1], bounds[1:])
        self.first, self.last = np.concatenate([self.first, head]), np.concatenate([self.last, tail])
        self.bounds = np.concatenate([self.bounds, len(self.bytes) + bounds[1:]])
        self.bytes = np.concatenate([self.bytes, data])
        return first, order

    def others(self, slots: np.ndarray, whole: bytes, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The spans whose bytes are not those of their slot."""
        head, tail = _ends_of(_words_at(data), starts, ends)
        lengths = ends - starts
        same = (self.bounds[slots + 1] - self.bounds[slots] == lengths) & (self.first[slots] == head) & (self.last[slots] == tail)
        for i in np.flatnonzero(same & (lengths > 16)).tolist():
            at = self.bounds[slots[i]]
            same[i] = self.bytes[at : at + lengths[i]].tobytes() == whole[starts[i] : ends[i]]
        return np.flatnonzero(~same)

    def slots_beside(self, pieces: list[bytes]) -> list[int]:
        """Slots of pieces whose hash belongs to another piece."""
        new = list(dict.fromkeys(p for p in pieces if p not in self.beside))
        if new:
            first, order = self.add(new)
            self.beside.update((new[i], first + k) for k, i in enumerate(order.tolist()))
        return [self.beside[p] for p in pieces]

    def learn(self, hashes: np.ndarray, pieces: list[bytes]) -> None:
        """Add pieces with distinct hashes that are not known yet."""
        first, order = self.add(pieces)
        hashes, slot = hashes[order], first + np.arange(len(order))
        at = (hashes >> _TABLE_SHIFT).astype(np.int64)
        while len(hashes):
            free = self.table[at] == 0
            # of several hashes for one free place the last stays; the others find it taken and go on
            self.table[at[free]] = hashes[free]
            settled = self.table[at] == hashes
            self.slots[at[settled]] = slot[settled]
            hashes, slot, at = hashes[~settled], slot[~settled], (at[~settled] + 1) & _TABLE_MASK

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Slots of hashes; -1 where unknown."""
        at = (hashes >> _TABLE_SHIFT).astype(np.int64)
        there = self.table[at]
        found = np.where(there == hashes, self.slots[at], -1).astype(np.int64)
        open_ = np.flatnonzero((there != hashes) & (there != 0))
        at = at[open_]
        while len(open_):
            at = (at + 1) & _TABLE_MASK
            there, wanted = self.table[at], hashes[open_]
            hit = there == wanted
            found[open_[hit]] = self.slots[at[hit]]
            go_on = ~hit & (there != 0)
            open_, at = open_[go_on], at[go_on]
        return found


_known: dict[str, _Pieces] = {}


def encode_all(texts: list[bytes], path: str) -> list[bytes]:
    """Ids of UTF-8 texts as little-endian unsigned 32-bit numbers, without special tokens added.

    For tokenizers that lower-case and drop white space (NFC, then white space, then lower case,
    then words), a text may be cut at ASCII white space and its ASCII letters lower-cased beforehand
    without changing the ids, and punctuation that follows a letter starts a new word. So each such
    piece is encoded once and found by a hash and its bytes afterwards. A text in which the order of composing and
    lower-casing could matter, or which may hold the string of a special token, is encoded as it is.
    """
    if path not in _known:
        _known[path] = _Pieces(path)
    known = _known[path]
    out: list[bytes] = []
    group: list[bytes] = []
    size = 0
    for text in texts:
        lowered = _lowered(text)
        if lowered is None or size + len(text) > GROUP_BYTES:
            out += _encoded(group, known)
            group, size = [], 0
        if lowered is None:
            ids = known.tokenizer.encode(text.decode(), add_special_tokens=False).ids
            out.append(np.array(ids, "<u4").tobytes())
        else:
            group.append(lowered)
            size += len(text) + 1
    return out + _encoded(group, known)


def _lowered(text: bytes) -> bytes | None:
    """The text with a-z for A-Z, if that cannot change its ids."""
    lowered = text.lower()
    if b"<|" in text:
        return None
    if text.isascii():
        return lowered
    composed = unicodedata.is_normalized("NFC", text.decode()) and unicodedata.is_normalized("NFC", lowered.decode())
    return lowered if composed else None


def _encoded(group: list[bytes], known: _Pieces) -> list[bytes]:
    if not group:
        return []
    whole = b" ".join(group)
    data = np.frombuffer(whole, np.uint8)
    kind = np.concatenate([[0], _KIND[data], [0]]).astype(np.uint8)
    here, before = kind[1:], kind[:-1]
    starting = (here > 0) & ((before == 0) | ((before == 1) & (here == 2)))
    ending = (before > 0) & ((here == 0) | starting)
    starts, ends = np.flatnonzero(starting), np.flatnonzero(ending)
    hashes = np.maximum(hashed_spans(data, starts, ends), np.uint64(1))
    slots = known.find(hashes)
    if (slots < 0).any():
        if len(known.starts) > KEPT_PIECES:
            known.clear()
            slots[:] = -1
        lost = np.flatnonzero(slots < 0)
        new, first = np.unique(hashes[lost], return_index=True)
        known.learn(new, [whole[starts[i] : ends[i]] for i in lost[first]])
        slots[lost] = known.find(hashes[lost])
    wrong = known.others(slots, whole, data, starts, ends)
    if len(wrong):
        slots[wrong] = known.slots_beside([whole[starts[i] : ends[i]] for i in wrong])
    lengths = known.starts[slots + 1] - known.starts[slots]
    places = np.concatenate([[0], np.cumsum(lengths)])
    ids = known.ids[np.arange(places[-1]) + np.repeat(known.starts[slots] - places[:-1], lengths)].astype("<u4")
    # the pieces of a text are those that start before the next text does
    bounds = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in group]))
    cuts = places[np.concatenate([[0], bounds])]
    return [ids[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
