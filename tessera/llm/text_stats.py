"""Statistics of whole texts, for batches of texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from . import words as W

SPACE = " \t\n\x0b\x0c\r"
#: Symbols that are counted as such (fixed value of the contract).
SYMBOLS = "#*$%&|<>"

_CLASSES = ["symbol", "bang", "upper", "lower", "digit", "stop", "other", "wide", "newline"]


def _class_table() -> np.ndarray:
    t = np.full(256, _CLASSES.index("other"), np.uint8)
    t[ord("a"):ord("z") + 1] = _CLASSES.index("lower")
    t[ord("A"):ord("Z") + 1] = _CLASSES.index("upper")
    t[ord("0"):ord("9") + 1] = _CLASSES.index("digit")
    t[[ord(c) for c in SYMBOLS]] = _CLASSES.index("symbol")
    t[ord("!")] = _CLASSES.index("bang")
    t[[ord(c) for c in ".,;:?"]] = _CLASSES.index("stop")
    t[ord("\n")] = _CLASSES.index("newline")
    t[[ord(c) for c in SPACE if c != "\n"]] = 255
    t[128:] = 255  # bytes after a character's first
    t[192:] = _CLASSES.index("wide")
    return t


_TABLE = _class_table()


def character_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """Characters of each class in each text (white space is in none but
    ``newline``)."""
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[bounds[0]:bounds[-1]] if raw is not None and raw.size else np.zeros(0, np.uint8)
    kind = _TABLE[data]
    cut = bounds - bounds[0]
    out = {}
    for i, name in enumerate(_CLASSES):
        total = np.zeros(len(kind) + 1, np.int32)  # a slice has far fewer bytes than 2**31, or is a single text
        np.cumsum(kind == i, out=total[1:])
        out[name] = (total[cut[1:]] - total[cut[:-1]]).astype(np.int64)
    return out


def repeated_lines(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word in each text, and how many equal an earlier one."""
    lines, repeats = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts.to_pylist()):
        full = [x for x in t.split("\n") if x.strip(SPACE)]
        lines[i], repeats[i] = len(full), len(full) - len(set(full))
    return lines, repeats


def repeated_windows(words: W.Words, width: int = 3) -> np.ndarray:
    """Words that lie in a window of ``width`` words found twice or more in
    the same text, the first included."""
    h, bounds = W.shingles(words, width)
    n = words.counts
    doc = np.repeat(np.arange(len(n)), np.diff(bounds))
    real = n[doc] >= width
    h, doc = h[real], doc[real]
    start = (np.arange(bounds[-1]) - np.repeat(bounds[:-1], np.diff(bounds)))[real] + words.bounds[doc]
    with np.errstate(over="ignore"):
        key = W.mix64(h ^ W.mix64(doc.astype(np.uint64) + np.uint64(1)))  # windows of other texts differ
    _, which, times = np.unique(key, return_inverse=True, return_counts=True)
    start = start[times[which] > 1]
    edge = np.bincount(start, minlength=len(words.codes) + 1) - np.bincount(start + width, minlength=len(words.codes) + 1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(edge)[:len(words.codes)] > 0)])
    return covered[words.bounds[1:]] - covered[words.bounds[:-1]]


def vocabulary_use(words: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words of each text, and the count of its most frequent one."""
    n = len(words.counts)
    doc = np.repeat(np.arange(n), words.counts)
    pair, times = np.unique(doc * max(1, len(words.vocabulary)) + words.codes, return_counts=True)
    owner = pair // max(1, len(words.vocabulary))
    top = np.zeros(n, np.int64)
    np.maximum.at(top, owner, times)
    return np.bincount(owner, minlength=n), top


def neighbours_equal(words: W.Words) -> np.ndarray:
    """Words that equal the one just before them in the same text."""
    same = np.zeros(len(words.codes), np.int64)
    same[1:] = words.codes[1:] == words.codes[:-1]
    first = words.bounds[:-1][words.counts > 0]
    same[first] = 0
    total = np.concatenate([[0], np.cumsum(same)])
    return total[words.bounds[1:]] - total[words.bounds[:-1]]
