"""Words and shingles of whole texts as 64-bit numbers, inside Arrow tasks."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

ROWS_AT_ONCE = 500
CHUNK_BYTES = 1 << 18

_BASE = np.uint64(0x9E3779B97F4A7C15)
_WHITE = re.compile(rb"[\x20\x09-\x0D]")
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_tables = (np.empty(0, np.uint64), np.empty(0, np.uint64))


def in_slices(
    function: Callable[[pa.RecordBatch], pa.RecordBatch | None],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow: ``function`` sees at most ``ROWS_AT_ONCE`` rows at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                made = function(batch.slice(at, ROWS_AT_ONCE))
                if made is not None:
                    yield made
        # workers go on to other tasks; what Arrow holds in reserve is given back
        pa.default_memory_pool().release_unused()

    return run


def utf8_texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The texts of a column as UTF-8; NULL becomes empty."""
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def mixed(values: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


# a random-looking number for every byte
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * _BASE)

# Words are told apart by two polynomials over the field of a Mersenne prime. Unlike sums modulo a power of two, where some
# words collide whatever the base, these meet by chance only: for two words of n bytes at odds of about (n / 2 ** 31) ** 2.
_PRIME = np.uint64((1 << 31) - 1)
_BASES = (1_181_783_497, 1_964_071_631)
_FIELD = [(_BYTE >> np.uint64(shift)) % _PRIME for shift in (1, 33)]
_field_tables: list[tuple[np.ndarray, np.ndarray]] = []


def _reduced(values: np.ndarray) -> np.ndarray:
    """Products of two field elements, nearly reduced: below 2 ** 32."""
    return (values & _PRIME) + (values >> np.uint64(31))


def _field_powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The first n powers of both bases and of their inverses."""
    global _field_tables
    if not _field_tables or len(_field_tables[0][0]) < n:
        n = max(n, CHUNK_BYTES)
        made = []
        for base in _BASES:
            both = []
            for factor in (base, pow(base, -1, int(_PRIME))):
                out, step = np.ones(1, np.uint64), factor
                while len(out) < n:
                    out = np.concatenate([out, out * np.uint64(step) % _PRIME])
                    step = step * step % int(_PRIME)
                both.append(out[:n].astype(np.uint32))
            made.append(tuple(both))
        _field_tables = made
    return _field_tables


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2 ** 64."""
    global _tables
    if len(_tables[0]) < n:
        steps = np.full(max(n, CHUNK_BYTES), _BASE, np.uint64)
        back = np.full(len(steps), pow(int(_BASE), -1, 1 << 64), np.uint64)
        steps[0] = back[0] = 1
        _tables = np.cumprod(steps), np.cumprod(back)
    return _tables


def _hashed(text: bytes, first: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word of a text, or of its ``first`` characters.

    Sums of powers give all words' hashes at once.
    """
    data = np.frombuffer(text, np.uint8)
    inside = ~_SPACE[data]
    edge = np.diff(inside, prepend=False, append=False)
    starts, ends = np.flatnonzero(edge).reshape(-1, 2).T
    if first:
        heads = np.flatnonzero((data & 0xC0) != 0x80)
        beyond = np.append(heads, len(data))[np.minimum(np.searchsorted(heads, starts) + first, len(heads))]
        ends = np.minimum(ends, beyond)
    return _field_hashes(data, starts, ends), starts


def _field_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of 62 random bits for every span of bytes."""
    parts = []
    for letters, (forth, back) in zip(_FIELD, _field_powers(len(data) + 1), strict=True):
        sums = np.zeros(len(data) + 1, np.uint64)
        terms = letters[data]
        terms *= forth[: len(data)]
        np.cumsum(_reduced(terms), out=sums[1:])
        parts.append((sums[ends] - sums[starts]) % _PRIME * back[starts] % _PRIME)
    return mixed((parts[0] | parts[1] << np.uint64(31)) + (ends - starts).astype(np.uint64) * _BASE)


def hashed_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A quick 64-bit hash of every span of bytes, for tables that compare the bytes on a hit: collisions can be made on purpose."""
    forth, back = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * forth[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def hashed_words(texts: list[bytes], first: int | None = None) -> list[np.ndarray]:
    """Per text, the 64-bit hashes of its words in order: A-Z lower-cased, split at ASCII white space.

    With ``first``, only that many characters of each word count.

    Short texts are hashed together, long ones in pieces cut at white space, so the working memory is
    bounded by the longest word or ``CHUNK_BYTES``.
    """
    out: list[np.ndarray] = []
    group: list[bytes] = []

    def flush() -> None:
        if group:
            hashes, starts = _hashed(b" ".join(group).lower(), first)
            firsts = np.cumsum([0] + [len(t) + 1 for t in group[:-1]])
            out.extend(np.split(hashes, np.searchsorted(starts, firsts[1:])))
            group.clear()

    size = 0
    for text in texts:
        if group and size + len(text) > CHUNK_BYTES:
            flush()
            size = 0
        if len(text) > CHUNK_BYTES:
            out.append(np.concatenate([_hashed(piece.lower(), first)[0] for piece in _pieces(text)]))
        else:
            group.append(text)
            size += len(text) + 1
    flush()
    return out


def _pieces(text: bytes) -> Iterator[bytes]:
    """A long text in pieces of about ``CHUNK_BYTES`` that end where a word ends."""
    at = 0
    while at < len(text):
        found = _WHITE.search(text, min(at + CHUNK_BYTES, len(text)))
        end = found.start() if found else len(text)
        yield text[at:end]
        at = end


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words, in order; with fewer words the whole sequence is the one run."""
    if not len(hashes):
        return hashes
    width = min(width, len(hashes))
    runs = len(hashes) - width + 1
    out = np.full(runs, width, np.uint64)
    for j in range(width):
        out = out * _BASE + hashes[j : j + runs]
    return mixed(out)
