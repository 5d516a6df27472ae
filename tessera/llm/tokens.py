"""Token ids of whole texts by a public tokenizer file of the ``tokenizers`` library.

Where the tokenizer drops white space and never joins two words (checked in
its definition), texts are encoded word by word, each distinct word of a slice
once, Latin ones by their pieces: the ids of a text are the ids of its words
in order. Other tokenizers get
whole texts. Strings of special tokens inside a text become these tokens, as
the library has it with ``add_special_tokens=False``."""

from __future__ import annotations

import gc
import json
import os
import re
import unicodedata
from array import array
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from . import words as W

CACHED_WORDS = 300_000  # and pieces, in each generation
CACHED_LENGTH = 64  # longer strings are encoded each time
LATIN_END = 0x250  # plain words have code points below it

_OPEN: dict[str, "Encoder"] = {}


def encoder(path: str) -> "Encoder":
    """The encoder of a tokenizer file, opened once in each Python worker."""
    if path not in _OPEN:
        _OPEN[path] = Encoder(path)
    return _OPEN[path]


@contextmanager
def many_objects() -> Iterator[None]:
    """No search for cycles while many short-lived lists are made: the search
    walks the caches each time and finds none."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


class Recent:
    """Values of the strings asked for lately, in two generations: what is
    asked for again moves from the old one to the young one, and when the
    young one is full the old one goes. Strings seen once so never fill it."""

    def __init__(self, size: int = CACHED_WORDS):
        self.young: dict[str, object] = {}
        self.old: dict[str, object] = {}
        self.size = size

    def take(self, keys: list[str], make) -> list:
        """The value of each key; ``make`` gives those of a list of new keys."""
        out = list(map(self.young.get, keys))
        gaps = [i for i, v in enumerate(out) if v is None]
        if not gaps:
            return out
        missing = [keys[i] for i in gaps]
        found = dict(zip(missing, map(self.old.get, missing)))
        fresh = [k for k, v in found.items() if v is None]
        found.update(zip(fresh, make(fresh)))
        for i, k in zip(gaps, missing):
            out[i] = found[k]
        kept = {k: v for k, v in found.items() if len(k) <= CACHED_LENGTH}
        if len(self.young) + len(kept) > self.size:
            self.old, self.young = self.young, kept
        else:
            self.young.update(kept)
        return out


def spread(parts: list[bytes], codes: np.ndarray, dtype: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """The ids of ``parts[c]`` for each code c, one after the other, and the
    bounds of each code's ids."""
    pool = np.frombuffer(b"".join(parts), dtype)
    length = np.fromiter(map(len, parts), np.int64, len(parts)) // dtype.itemsize
    first = np.cumsum(length) - length
    run = length[codes]
    begin = np.concatenate([[0], np.cumsum(run)])
    ids = pool[np.repeat(first[codes] - begin[:-1], run) + np.arange(begin[-1])] if len(codes) else pool[:0]
    return ids, begin


def _word_local(spec: dict) -> bool:
    """True if no token and no normalisation reaches across white space."""
    norm = spec.get("normalizer") or {}
    steps = norm.get("normalizers", [norm] if norm else [])
    plain = all(s["type"] in ("NFC", "Lowercase") or s["type"] == "Replace" and s["pattern"] == {"Regex": "\\s+"} and s["content"] == " "
                for s in steps)
    pre = spec.get("pre_tokenizer") or {}
    first = (pre.get("pretokenizers") or [pre])[0]
    drops = first.get("type") == "Split" and first.get("behavior") == "Removed" and bool(first.get("invert"))
    pattern = (first.get("pattern") or {}).get("Regex", " ")
    no_space = "[^\\s" in pattern and " " not in pattern
    added = spec.get("added_tokens", [])
    inside = not any(c.isspace() for t in added for c in t["content"]) and not any(t["lstrip"] or t["rstrip"] for t in added)
    return plain and drops and no_space and inside


def _folds(spec: dict) -> bool:
    """True if the normalisation lower-cases."""
    norm = spec.get("normalizer") or {}
    return any(s["type"] == "Lowercase" for s in norm.get("normalizers", [norm] if norm else []))


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the work
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        spec = json.loads(self.tok.to_str())
        self.by_word, self.folds = _word_local(spec), _folds(spec)
        self.marks = {t["content"][0].lower() for t in spec.get("added_tokens", [])}  # a word without them holds no special string
        self.dtype = np.dtype("<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4")
        self.plain, self.pieces, self.letters = self._plain(spec) if self.by_word else (None, None, {})
        self.cache = Recent()  # of pieces, and of the words that aren't cut here

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _plain(self, spec: dict) -> tuple[str | None, str | None, dict[int, str]]:
        """For a byte-level model behind NFC, lower case and a split by letters
        and numbers: the characters of words whose pieces can be cut here (Latin
        letters, digits and marks, nothing that begins a special string), the
        pattern of their pieces, both as Arrow reads them, and the model's
        letters for their bytes."""
        pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer") or {}
        steps = pre.get("pretokenizers") or []
        known = [s["type"] for s in norm.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"] and len(steps) == 2 and \
            steps[1]["type"] == "ByteLevel" and not steps[1]["use_regex"] and not steps[1]["add_prefix_space"] and spec["model"]["type"] == "BPE"
        if not known or spec["model"].get("dropout"):
            return None, None, {}
        end = range(0x21, LATIN_END)
        kind = {c: unicodedata.category(chr(c)) for c in end}
        lower = dict(zip(end, pc.utf8_lower(pa.array(map(chr, end))).to_pylist()))
        chars = lambda codes: "".join(re.escape(chr(c)) for c in codes)
        split = steps[0]["pattern"]["Regex"]
        split = split.replace("\\p{L}", chars(c for c in end if kind[c][0] == "L")).replace("\\p{N}", chars(c for c in end if kind[c][0] == "N"))
        if re.search(r"\\[^\W_s]", split):  # only white space means the same in Arrow's patterns
            return None, None, {}
        try:
            pc.match_substring_regex(pa.array([""]), split)
        except pa.ArrowInvalid:  # they look neither ahead nor back
            return None, None, {}
        # code points that normalisation leaves as they are, but for their case, and that may be a piece
        usable = [c for c in end if kind[c][0] in "LNPS" and len(low := lower[c]) == 1 and ord(low) < LATIN_END and low not in self.marks
                  and self.tok.normalizer.normalize_str(chr(c)) == low and re.fullmatch(split, low)]
        if not usable:
            return None, None, {}
        byte_letters = {c: self.tok.pre_tokenizer.pre_tokenize_str(chr(c)) for c in usable}
        letters = {c: made[0][0] for c, made in byte_letters.items() if len(made) == 1}
        return chars(letters), split, letters

    def _ids_of_pieces(self, pieces: list[str]) -> list[bytes]:
        kind, tokenize = self.dtype.char, self.tok.model.tokenize
        return [array(kind, [t.id for t in tokenize(p if p.isascii() else p.translate(self.letters))]).tobytes() for p in pieces]

    def _cut(self, words: pa.Array) -> list[bytes]:
        """Ids of plain words: their pieces are cut all at once (a space follows
        each, the empty piece behind the last has no ids) and each distinct
        piece is looked up once."""
        spaced = pc.replace_substring_regex(pc.utf8_lower(words), self.pieces, "\\0 ")
        lists = pc.split_pattern(spaced, " ")
        coded = lists.flatten().dictionary_encode()
        pieces = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        parts = self.cache.take(pieces, self._ids_of_pieces)
        ids, begin = spread(parts, coded.indices.to_numpy(zero_copy_only=False), self.dtype)
        flat = ids.tobytes()
        bounds = (begin[np.asarray(lists.offsets)] * self.dtype.itemsize).tolist()
        return [flat[a:b] for a, b in zip(bounds, bounds[1:])]

    def _ids_of_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word. Plain words are cut into their pieces here and a
        new piece goes to the tokenizer's model at once; the library does the
        other words."""
        out: list[bytes | None] = [None] * len(words)
        others = range(len(words))
        if self.plain:
            column = pa.array(words, pa.large_string())
            other = pc.match_substring_regex(column, f"[^{self.plain}]")
            others = np.flatnonzero(other.to_numpy(zero_copy_only=False)).tolist()
            out = self._cut(pc.if_else(other, "", column) if others else column)
        keys = [words[i] for i in others]
        if self.folds:
            keys = [w if w.islower() else self._folded(w) for w in keys]
        for i, ids in zip(others, self.cache.take(keys, self._ids)):
            out[i] = ids
        return out

    def _folded(self, word: str) -> str:
        """A word with the same ids. Folding A-Z before the tokenizer does is the
        same for a word that is all ASCII, but special strings are looked for
        before it folds."""
        folded = word.lower() if word.isascii() else word
        return word if any(c in folded for c in self.marks) else folded

    def encode(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, with ``end`` after each text
        if given, and the bounds of each text's ids."""
        if self.by_word:
            words = W.split(texts)
            with many_objects():
                parts = self._ids_of_words(words.vocabulary)
            codes, text_bounds = words.codes, words.bounds
        else:
            parts = self._ids(texts.to_pylist())
            codes, text_bounds = np.arange(len(parts)), np.arange(len(parts) + 1)
        ids, begin = spread(parts, codes, self.dtype)
        bounds = begin[text_bounds]
        if end is None:
            return ids, bounds
        n = len(texts)
        whole = np.empty(len(ids) + n, self.dtype)
        shifted = bounds + np.arange(n + 1)
        is_end = np.zeros(len(whole), bool)
        is_end[shifted[1:] - 1] = True
        whole[~is_end] = ids
        whole[is_end] = end
        return whole, shifted
