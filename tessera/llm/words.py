"""Whole texts as arrays of words, in Arrow and numpy.

A word is a maximal run of ``[^\\x20\\x09-\\x0D]+``. Batches are cut by bytes of
text, so a task's memory does not follow the number of rows in a batch."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 4 << 20

#: What numpy and the tokenizers have freed stays with the C library until it is trimmed; None where it can't be (not glibc).
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)

_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}

_MUL = np.uint64(0x9E3779B97F4A7C15)
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)


def give_back() -> None:
    """Free memory goes back to the system: workers live on, executors are small."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of unsigned 64-bit values."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + _MUL
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
        return x ^ (x >> np.uint64(31))


def texts_of(column) -> pa.Array:
    """A string array without nulls (null counts as empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    return pc.fill_null(column, "")


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row ranges of ``batch`` with at most ``limit`` bytes of text each (one
    row at least)."""
    n = batch.num_rows
    if not n:
        return
    size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    cum = np.cumsum(size, dtype=np.int64)
    at = 0
    while at < n:
        done = cum[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(cum, done + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to
    give_back()


@dataclass
class Words:
    """Words of several texts: ``codes[bounds[i]:bounds[i + 1]]`` are the words
    of text i, as positions in ``vocabulary``."""

    vocabulary: list[str]
    codes: np.ndarray
    bounds: np.ndarray

    def sums(self, per_word: np.ndarray) -> np.ndarray:
        """Per text, the sum over its words of a value given per vocabulary entry."""
        total = np.concatenate([np.zeros(1, per_word.dtype), np.cumsum(per_word[self.codes])])
        return total[self.bounds[1:]] - total[self.bounds[:-1]]

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


def split(texts: pa.Array, lower: bool = False) -> Words:
    """Words of every text; ``lower`` lower-cases A-Z only (in the vocabulary,
    which may then hold a word twice)."""
    lists = pc.ascii_split_whitespace(texts)
    bounds = np.asarray(lists.offsets).astype(np.int64)
    flat = lists.flatten()
    bounds = bounds - bounds[0]
    coded = flat.dictionary_encode()
    vocabulary = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # to_pylist makes an Arrow scalar of each
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    if "" in vocabulary:  # white space at either end of a text, or an empty text
        empty = vocabulary.index("")
        keep = codes != empty
        kept = np.concatenate([[0], np.cumsum(keep)])
        codes, bounds = codes[keep], kept[bounds]
    if lower:
        vocabulary = [w.lower() if w.isascii() else w.translate(_LOWER) for w in vocabulary]
    return Words(vocabulary, codes, bounds)


def word_hashes(vocabulary: list[str]) -> np.ndarray:
    """A 64-bit hash of each entry's UTF-8 bytes."""
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in vocabulary), dtype=np.uint64, count=len(vocabulary))


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``width`` words (a text with fewer words, but
    one at least, has its whole sequence as the only one) and the bounds of
    each text's windows. Windows that are not distinct are kept."""
    h = word_hashes(words.vocabulary)[words.codes] if len(words.codes) else np.zeros(0, np.uint64)
    n = words.counts
    made = np.where(n >= width, n - width + 1, (n > 0).astype(np.int64))
    bounds = np.concatenate([[0], np.cumsum(made)])
    if not bounds[-1]:
        return np.zeros(0, np.uint64), bounds
    start = np.repeat(words.bounds[:-1] - bounds[:-1], made) + np.arange(bounds[-1])
    used = np.repeat(np.minimum(n, width), made)
    padded = np.concatenate([h, np.zeros(width, np.uint64)])
    out = mix64(used.astype(np.uint64))
    with np.errstate(over="ignore"):
        for i in range(width):
            part = np.where(i < used, padded[start + i], np.uint64(0))
            out = mix64(out * np.uint64(3) + part)
    return out, bounds
