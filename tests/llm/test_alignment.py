"""Token alignment against a plain walk over byte offsets."""

import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tessera.llm import alignment, queries

from ..conftest import SF_SMALL
from . import data

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _letter_bytes():
    """Byte of each letter of byte-level vocabularies, by its published table."""
    out, extra = {}, 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out[chr(b)] = b
        else:
            out[chr(256 + extra)] = b
            extra += 1
    return out


def _brute(rows):
    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    letter = _letter_bytes()
    docs, counts = [], Counter()
    for doc_id, text in rows:
        a, b, groups, pairs = [], [], [], []
        if text:
            a = tok.encode(" " + text, add_special_tokens=False).ids
            b = sp.encode(text)
            bytes_a = [bytes(letter[c] for c in tok.id_to_token(i)) for i in a]
            bytes_b = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
            if b"".join(bytes_a) != b" " + text.encode() or b"".join(bytes_b) != b" " + text.encode():
                a, b = [], []
        i = j = end_a = end_b = 0
        group = ([], [])
        while i < len(a) or j < len(b):
            if end_a <= end_b:
                end_a += len(bytes_a[i])
                group[0].append(a[i])
                i += 1
            else:
                end_b += len(bytes_b[j])
                group[1].append(b[j])
                j += 1
            if end_a == end_b:
                groups.append(group)
                pairs.append((group[0][-1], group[1][-1]))
                group = ([], [])
        counts.update(pairs)
        docs.append((doc_id, a, b, groups, pairs))
    top = {}
    for (_, y), n in counts.items():
        top[y] = max(top.get(y, 0), n)
    out = []
    for doc_id, a, b, groups, pairs in docs:
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append((doc_id, len(a), len(b), len(groups), len(pairs), sum(counts[p] == top[p[1]] for p in pairs), sum(counts[p] for p in pairs),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(out, key=repr)


ODD = [(1, "a <|endoftext|> b"), (2, "</s><s>[INST] <unk> <0x41> ▁ x"), (3, "tab\tline\r\n  many   spaces   "), (4, " "), (5, "\n"),
       (6, "日本語 ελληνικά עברית 🙂🙂 é"), (7, "nul\x00byte"), (8, "ﬁ ½ ²"), (9, "x"), (9, "x"), (10, "word" * 3_000), (11, "▁")]


@pytest.mark.parametrize("shared", [alignment.SHARED_PAIRS, 30, 0])
def test_against_a_walk_over_offsets(spark, monkeypatch, shared):
    monkeypatch.setattr(alignment, "SHARED_PAIRS", shared)  # all, some and no pairs are looked up in arrays
    monkeypatch.setattr(alignment, "PARTIAL_PAIRS", 50)
    rows = data.documents() + [(i, t, "en", "a", 1) for i, t in ODD]
    table = data.table(spark, rows).withColumnRenamed("lang", "row").withColumnRenamed("source", "counts")
    got = alignment.align_documents(table, A, B).collect()
    assert sorted((tuple(r) for r in got), key=repr) == _brute([(r[0], r[1]) for r in rows])


def test_slices_do_not_change_results(spark):
    from tessera.llm.alignment import _align, pair

    texts = [t for _, t in ODD] + [None, "", "plain words here"]
    names = pair(A, B)
    whole = _align(texts, names)
    at = 0
    for i, t in enumerate(texts):
        a, b, link_a, link_b = _align([t], names)
        assert a.ids.tolist() == whole[0].ids[whole[0].bounds[i]:whole[0].bounds[i + 1]].tolist()
        assert (link_a + whole[0].bounds[i]).tolist() == whole[2][at:at + len(link_a)].tolist()
        at += len(link_a)
    assert at == len(whole[2])


def test_overlaps_are_all_pairs_that_share_a_byte():
    from tessera.llm.alignment import _align, overlaps, pair

    a, b, _, _ = _align(["unusual tokenisations overlap", "twice  over"], pair(A, B))
    spans = lambda s: list(zip((s.ends - s.size).tolist(), s.ends.tolist()))
    want = {(i, j) for i, (s, e) in enumerate(spans(a)) for j, (t, f) in enumerate(spans(b)) if s < f and t < e}
    found = list(zip(*(x.tolist() for x in overlaps(a, b))))
    assert len(found) == len(want) and set(found) == want


def test_chunks_and_whole_texts_have_equal_ids(monkeypatch):
    from tessera.llm import tokens
    from tessera.llm.alignment import Pair

    texts = [t for _, t in ODD] + ["a  b   c\n d\xa0e f\x1cg\u2003 h", " x ", "it's we'll 12 3a!? (b) -- c", "tail ", "one two one two"]
    names = Pair(A, B)
    assert names.by_chunk
    names.cache = tokens.Recent(3)
    parts = [names.encode(texts), names.encode(texts)]
    names.by_chunk = False
    for side in (0, 1):
        want = names.encode(texts)[side]
        for got in parts:
            assert got[side].ids.tolist() == want.ids.tolist() and got[side].bounds.tolist() == want.bounds.tolist()


def test_empty_table(spark):
    out = alignment.align_documents(data.empty(spark), A, B)
    assert out.count() == 0 and out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_op11_query(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op11_token_alignment(spark, SF_SMALL).collect()
    assert sorted((tuple(r) for r in got), key=repr) == _brute([tuple(d) for d in docs])


def test_a_cached_chunk_is_one_small_object(monkeypatch):
    """Workers keep the ids of many chunks; in pairs of objects a chunk took
    twice as much."""
    import sys

    monkeypatch.setattr(alignment, "ENCODED", 3)   # several calls of the tokenizers
    names = alignment.Pair(A, B)
    chunks = ["word", "tokenisation", "x", "", "日本語", "many", "more", "words"]
    made = names._ids(chunks)
    assert len(made) == len(chunks) and all(type(x) is bytes for x in made)
    a, b = names.a.encode_batch([" " + c for c in chunks], add_special_tokens=False), names.b.encode(chunks)
    for ids, x, y in zip(made, a, b):
        assert sys.getsizeof(ids) == sys.getsizeof(b"") + 4 * (len(x.ids) + len(y))
    one, other = names.encode(chunks)
    assert one.ids.tolist() == [i for x in a for i in x.ids] and one.counts.tolist() == [len(x.ids) for x in a]
    assert other.ids.tolist() == [i for y in b for i in y] and other.counts.tolist() == [len(y) for y in b]


def test_partial_counts_are_exact_and_leave_in_short_rows(monkeypatch):
    """A task's counts left as one row of up to 500,000 pairs, which Spark holds in one piece."""
    import collections

    import numpy as np

    monkeypatch.setattr(alignment, "ROW_PAIRS", 7)
    rng = np.random.default_rng(3)
    pairs, n, want = np.zeros(0, np.int64), np.zeros(0, np.int64), collections.Counter()
    for size in (0, 5, 40, 40, 1):
        more = rng.integers(0, 30, size) << 32
        want.update(more.tolist())
        pairs, n = alignment._added(pairs, n, more)
        assert pairs.tolist() == sorted(want) and n.tolist() == [want[p] for p in sorted(want)]
    rows = [r for b in alignment._counts_batches(pairs, n) for r in b.to_pylist()]
    assert all(r["row"] is None and 0 < len(r["counts"]) <= 7 for r in rows)
    assert [(c["pair"], c["n"]) for r in rows for c in r["counts"]] == sorted(want.items())
    assert not list(alignment._counts_batches(pairs[:0], n[:0]))
