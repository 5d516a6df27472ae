import random
import re
import types

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tessera.llm import tokens as T
from tessera.llm import words as W

ALPHABET = "abcXYZ'stre 09.,!?\n\t\r\x0b\x0c\x1c\u0107\u0307\u030cJI\u0130i\u03a3\u03c3\u03c2 \u00a0\u0085\u00e9\u65e5\u200b#<|>_"


def odd_texts(n: int, seed: int = 1) -> list[str | None]:
    rnd = random.Random(seed)
    out = [None, "", " ", "\n", "a'S b's <|endoftext|> x", "İstanbul J̌ ΣΑΣ Σ. ́x", "word, word. WORD! don't 3.14", "x" * 5000]
    return out + ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 60))) for _ in range(n)]


def test_words_are_the_runs_between_ascii_white_space():
    texts = odd_texts(500)
    words = W.split(W.texts_of(pa.array(texts)))
    got = [[words.vocabulary[c] for c in words.codes[a:b]] for a, b in zip(words.bounds[:-1], words.bounds[1:])]
    assert got == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]


def test_lower_casing_touches_only_a_to_z_also_in_slices():
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    batch = pa.RecordBatch.from_arrays([pa.array(odd_texts(500))], names=["text"])
    at = 0
    for part in W.slices(batch, limit=300):
        words = W.split(W.texts_of(part.column("text")), lower=True)
        for i in range(part.num_rows):
            mine = [words.vocabulary[c] for c in words.codes[words.bounds[i]:words.bounds[i + 1]]]
            assert mine == re.findall(r"[^\x20\x09-\x0D]+", (batch.column("text")[at].as_py() or "").translate(table))
            at += 1
    assert at == batch.num_rows


def test_shingles_are_windows_or_the_whole_sequence():
    words = W.split(W.texts_of(pa.array(["a b c d", "a b", "", "b c d", "a b c a b c"])))
    h, bounds = W.shingles(words, 3)
    assert np.diff(bounds).tolist() == [2, 1, 0, 1, 4]
    assert h[1] == h[3] and len(set(h.tolist())) == 5  # abc bcd | ab | bcd | abc bca cab abc
    assert h[4] == h[0] == h[7]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_are_those_of_the_library(name):
    path = public_tokenizers.path(name)
    enc = T.Encoder(path)
    assert enc.by_word == (name == "word_bpe_49k.json")
    own = Tokenizer.from_file(path)
    texts = odd_texts(3000)
    for _ in range(2):  # the second time from the cache
        ids, bounds = enc.encode(W.texts_of(pa.array(texts)), 1)
        for t, a, b in zip(texts, bounds[:-1], bounds[1:]):
            assert ids[a:b].tolist() == own.encode(t or "", add_special_tokens=False).ids + [1]


def test_special_strings_are_what_the_library_makes_of_them():
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = ["a <|endoftext|> b", "x<|endoftext|>y", "<|endoftext|>", "<|ENDOFTEXT|> <|EndOfText|>", "<|endof text|>", "Ab<|startoftext|>Cd<|endoftext|>.",
             "<|endoftext|><|endoftext|>", "<| endoftext |>", "Ünï<|endoftext|>Ça", "a < b <3 <|", "K \u212b \u023a\u0130 \u01c5 ª²½ ß"]
    own = Tokenizer.from_file(path)
    enc = T.Encoder(path)
    for _ in range(2):
        ids, bounds = enc.encode(W.texts_of(pa.array(texts)), 1)
        for t, a, b in zip(texts, bounds[:-1], bounds[1:]):
            assert ids[a:b].tolist() == own.encode(t, add_special_tokens=False).ids + [1], t
    assert 49407 in enc.encode(W.texts_of(pa.array(["a<|endoftext|>"])))[0].tolist()


def test_plain_words_are_cut_like_the_library_cuts_them():
    path = public_tokenizers.path("word_bpe_49k.json")
    own, enc = Tokenizer.from_file(path), T.Encoder(path)
    assert enc.plain is not None
    every = [chr(c) for c in range(0x21, 0x2b0)]
    rnd = random.Random(4)
    words = every + ["a" + c + "b" for c in every] + ["".join(rnd.choice(every) for _ in range(rnd.randint(1, 9))) for _ in range(4000)]
    got = enc._ids_of_words(words)
    for w, ids in zip(words, got):
        assert np.frombuffer(ids, enc.dtype).tolist() == own.encode(w, add_special_tokens=False).ids, w


def test_a_piece_goes_to_the_model_once_whatever_stands_beside_it():
    path = public_tokenizers.path("word_bpe_49k.json")
    own, enc = Tokenizer.from_file(path), T.Encoder(path)
    asked, model, library = [], enc.tok.model, enc.tok.encode_batch_fast
    enc.tok = types.SimpleNamespace(model=types.SimpleNamespace(tokenize=lambda p: asked.append(p) or model.tokenize(p)), encode_batch_fast=library)
    texts = ["house house, House. (house) HOUSE's", "", "\u4e2d house!<b>\u4e2d house?", "house\u00df7house", "\u4e2d", "  ", "wouldn't've,,"]
    for _ in range(2):
        ids, bounds = enc.encode(W.texts_of(pa.array(texts)), 1)
        for t, a, b in zip(texts, bounds[:-1], bounds[1:]):
            assert ids[a:b].tolist() == own.encode(t, add_special_tokens=False).ids + [1], t
    assert asked.count("house") == 1 and len(asked) == len(set(asked))


def test_the_cache_is_bounded():
    enc = T.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    enc.cache = T.Recent(10)
    texts = [f"word{i} other{i} often" for i in range(100)]
    first = [enc.encode(W.texts_of(pa.array([t])))[0].tolist() for t in texts]
    assert len(enc.cache.young) <= 10 and len(enc.cache.old) <= 10 and "often" in {*enc.cache.young, *enc.cache.old}
    assert [enc.encode(W.texts_of(pa.array([t])))[0].tolist() for t in texts] == first
    enc.encode(W.texts_of(pa.array(["x" * 1_000])))
    assert "x" * 1_000 not in enc.cache.young


def _resident() -> float:
    return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", open("/proc/self/smaps_rollup").read()))) / 1024


def test_a_slice_gives_freed_memory_back():
    """Workers live on; what their slices have freed stayed with the C library
    below whatever was allocated last."""
    if W._TRIM is None:
        pytest.skip("not glibc")
    batch = pa.RecordBatch.from_arrays([pa.array(["a b", "c"])], names=["text"])
    list(W.slices(batch))
    start = _resident()
    blocks = [np.ones(12_000) for _ in range(2_000)]  # 96 kB each: below the size that gets pages of its own
    last = blocks[-1]
    del blocks
    list(W.slices(batch))
    assert last.sum() == 12_000 and _resident() - start < 60


def test_full_caches_stay_small():
    """Each worker of an executor keeps caches of two generations for as long as it lives."""
    import tracemalloc

    cache = T.Recent()
    tracemalloc.start()
    for at in range(0, 3 * cache.size, 20_000):
        cache.take([f"w{i:09d}" for i in range(at, at + 20_000)], lambda keys: [bytes(12) + k[-4:].encode() for k in keys])
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 100e6


def test_scans_hold_few_rows(spark):
    from tessera.llm.store import SCAN_ROWS, prepare

    name = "spark.sql.parquet.columnarReaderBatchSize"
    spark.conf.set(name, 4096)
    prepare(spark)
    assert int(spark.conf.get(name)) == SCAN_ROWS
    spark.conf.set(name, 100)  # smaller ones are left
    prepare(spark)
    assert int(spark.conf.get(name)) == 100
    spark.conf.unset(name)
