"""Token alignment of two tokenizers over whole texts.

Both tokenizers cut the same bytes (a space and the text), so tokens are byte
ranges. Per batch, token starts of all documents stand one after the other;
``pandas.merge_asof``, keyed by document, finds for each start of either side
the other side's token that covers it. Both directions together are all
overlaps; the overlaps with equal ends are the links, and the offsets where
they end cut the tokens into groups.

Both tokenizers never join bytes across a space between two other characters
(checked in their definitions), so texts are cut there and each distinct chunk
is encoded once, with the space before it.

Links are counted by id pair over the corpus: partial counts leave the pass
over the texts with the documents, so texts are tokenised once. Pairs that hold
more than one in ``SHARED_PAIRS`` of all links, hence fewer than that many, are
shipped to the tasks and looked up in arrays; the links of all other pairs are
joined with their counts. Both give the same sums.

Defined cases: a null or empty text, and one that either tokenizer doesn't
give back byte for byte, has no tokens; strings of special tokens are plain
text; documents with equal or null ids stay apart, one row each; an empty
table gives no rows; other columns are ignored whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens as T
from . import words as W
from .store import materialise, prepare

SLICE_BYTES = 1 << 19  # text that is aligned at once (one document at least)
ENCODED = 4_096  # texts or chunks that go to the tokenizers at once: their results are large objects
PARTIAL_PAIRS = 500_000  # distinct pairs that a task counts before it passes the counts on
ROW_PAIRS = 1 << 14  # of them in one row
CACHED_CHUNKS = 400_000  # in each generation of a worker's cache
SHARED_PAIRS = 1 << 19
_ID = 32  # bits of an id in a pair
_BOTH = np.dtype(np.int32)  # ids of both sides in one string

_CUT = re.compile(r"(?<=\S) (?=\S)")

_OPEN: dict[tuple[str, str], "Pair"] = {}


def _byte_alphabet() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable
    bytes stand for themselves, the others take the code points from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}


def _large(entries: list[bytes]) -> pa.Array:
    return pa.array(entries, pa.large_binary())


class Pair:
    """The two tokenizers, opened once in each Python worker, the bytes of
    their entries and the entries' decimal ids with each mark that may follow."""

    def __init__(self, byte_level: str, pieces: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the work
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        alphabet = _byte_alphabet()
        entries = sorted(self.a.get_vocab(with_added_tokens=True).items(), key=lambda e: e[1])
        self.a_bytes = _large([bytes(alphabet[c] for c in t) if all(c in alphabet for c in t) else t.encode() for t, _ in entries])
        if [i for _, i in entries] != list(range(len(entries))):
            raise ValueError("ids of the byte-level tokenizer have gaps")
        n = self.b.get_piece_size()
        self.b_bytes = _large([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                               for i, p in ((i, self.b.id_to_piece(i)) for i in range(n))])
        m = len(entries)
        # a, then a|, then b, then b; : places of these strings are id, m + id, 2 m + id, 2 m + n + id
        self.marks = _large([f"{i}{mark}".encode() for size, mark in ((m, ","), (m, "|"), (n, ","), (n, ";")) for i in range(size)])
        self.sizes = m, n
        self.by_chunk = self._chunk_local()
        self.cache = T.Recent(CACHED_CHUNKS)

    def _chunk_local(self) -> bool:
        """True if no token of either side has a space after another character
        and nothing is normalised, so that a space between two words always
        begins a token."""
        spec = json.loads(self.a.to_str())
        split = spec.get("pre_tokenizer") or {}
        a = spec.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
        try:
            from sentencepiece import sentencepiece_model_pb2

            model = sentencepiece_model_pb2.ModelProto()
            model.ParseFromString(self.b.serialized_model_proto())
        except ImportError:  # without protobuf the model can't be looked into
            return False
        norm = model.normalizer_spec
        b = norm.name == "identity" and norm.add_dummy_prefix and norm.escape_whitespaces and not norm.remove_extra_whitespaces
        return bool(a and b) and not any("▁" in p.piece.lstrip("▁") for p in model.pieces)

    def _ids(self, texts: list[str]) -> list[bytes]:
        """The ids of both sides in one string for each text: all A ids, then all
        B ids raised by the number of A ids. Caches hold one small object a text."""
        m, out = self.sizes[0], []
        for at in range(0, len(texts), ENCODED):
            some = texts[at:at + ENCODED]
            a = self.a.encode_batch_fast([" " + t for t in some], add_special_tokens=False)
            b = self.b.encode(some, num_threads=1)
            flat: list[int] = []
            runs = []  # how many ids of A, of B, of A ... stand one after the other
            for x, y in zip(a, b):
                i = x.ids
                flat += i
                flat += y
                runs += (len(i), len(y))
            raised = np.repeat(np.arange(len(runs), dtype=_BOTH) % 2 * m, runs)
            joined = (np.array(flat, _BOTH) + raised).tobytes()
            ends = (np.cumsum(runs)[1::2] * _BOTH.itemsize).tolist()
            out += [joined[i:j] for i, j in zip([0, *ends], ends)]
        return out

    def encode(self, texts: list[str]) -> tuple["Side", "Side"]:
        if not self.by_chunk:
            parts, codes, bounds = self._ids(texts), np.arange(len(texts)), np.arange(len(texts) + 1)
        else:
            with T.many_objects():
                cut = [_CUT.split(t) for t in texts]
                bounds = np.concatenate([[0], np.cumsum([len(c) for c in cut], dtype=np.int64)]).astype(np.int64)
                code = dict.fromkeys(chain.from_iterable(cut))
                code = dict(zip(code, range(len(code))))
                codes = np.fromiter(map(code.__getitem__, chain.from_iterable(cut)), np.int64, bounds[-1])
                del cut
                parts = self.cache.take(list(code), self._ids)
        ids, begin = T.spread(parts, codes, _BOTH)
        of_b = ids >= self.sizes[0]
        begin = begin[bounds]
        begin_b = np.concatenate([[0], np.cumsum(of_b)])[begin]
        return Side.of(ids[~of_b], begin - begin_b, self.a_bytes), Side.of(ids[of_b] - self.sizes[0], begin_b, self.b_bytes)


def pair(byte_level: str, pieces: str) -> Pair:
    if (byte_level, pieces) not in _OPEN:
        _OPEN[byte_level, pieces] = Pair(byte_level, pieces)
    return _OPEN[byte_level, pieces]


class Side:
    """Tokens of several documents by one tokenizer, one after the other."""

    def __init__(self, ids: np.ndarray, bounds: np.ndarray, size: np.ndarray):
        self.ids, self.bounds, self.size = ids, bounds, size

    @classmethod
    def of(cls, ids: np.ndarray, bounds: np.ndarray, entries: pa.Array) -> "Side":
        length = pc.binary_length(entries).to_numpy(zero_copy_only=False).astype(np.int64)
        return cls(ids, bounds, length[ids])

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def joined(self, entries: pa.Array) -> pa.Array:
        """The bytes of all tokens of each document."""
        return _join(entries.take(pa.array(self.ids)), self.bounds)

    def only(self, docs: np.ndarray) -> "Side":
        """The same documents, without tokens where ``docs`` is false."""
        keep = np.repeat(docs, self.counts)
        return Side(self.ids[keep], np.concatenate([[0], np.cumsum(self.counts * docs)]), self.size[keep])

    @property
    def ends(self) -> np.ndarray:
        return np.cumsum(self.size)

    def frame(self, name: str) -> pd.DataFrame:
        """Token starts, ascending over all documents, and token numbers."""
        return pd.DataFrame({"doc": np.repeat(np.arange(len(self.bounds) - 1), self.counts), "start": self.ends - self.size,
                             name: np.arange(len(self.ids))}, copy=False)


def _join(parts: pa.Array, bounds: np.ndarray) -> pa.Array:
    lists = pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), parts)
    return pc.binary_join(lists, pa.scalar(b"", parts.type))


def overlaps(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all pairs of tokens that share a byte. Documents lie one
    after the other in both sides, so starts ascend."""
    left, right = a.frame("a"), b.frame("b")
    over_a = pd.merge_asof(left, right, on="start", by="doc")
    over_b = pd.merge_asof(right, left, on="start", by="doc")
    # pairs with equal starts are found from both sides
    apart = (a.ends - a.size)[over_b["a"].to_numpy(np.int64)] != over_b["start"].to_numpy()
    over_b = over_b[apart]
    return (np.concatenate([over_a["a"].to_numpy(np.int64), over_b["a"].to_numpy(np.int64)]),
            np.concatenate([over_a["b"].to_numpy(np.int64), over_b["b"].to_numpy(np.int64)]))


def links(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the tokens of both sides that end together, in order."""
    over_a, over_b = overlaps(a, b)
    together = a.ends[over_a] == b.ends[over_b]
    return np.sort(over_a[together]), np.sort(over_b[together])


def group_texts(a: Side, b: Side, link_a: np.ndarray, link_b: np.ndarray, names: Pair) -> pa.Array:
    """``a1,a2|b1;a3|b2,b3`` per document: the ids of each group's tokens."""
    group_a = np.searchsorted(link_a, np.arange(len(a.ids)))
    group_b = np.searchsorted(link_b, np.arange(len(b.ids)))
    # a token stands after the tokens of its side before it and the other side's of earlier groups
    # (and, on the b side, of its own group)
    place_a = np.arange(len(a.ids)) + np.concatenate([[0], link_b + 1])[group_a]
    place_b = np.arange(len(b.ids)) + (link_a + 1)[group_b] if len(link_a) else np.zeros(0, np.int64)
    m, n = names.sizes
    code = np.empty(len(a.ids) + len(b.ids), np.int64)
    last_a, last_b = np.zeros(len(a.ids), bool), np.zeros(len(b.ids), bool)
    last_a[link_a], last_b[link_b] = True, True
    code[place_a] = a.ids + m * last_a
    code[place_b] = 2 * m + b.ids + n * last_b
    return _join(names.marks.take(pa.array(code)), a.bounds + b.bounds)


def _align(texts: list[str | None], names: Pair) -> tuple[Side, Side, np.ndarray, np.ndarray]:
    whole = [t or "" for t in texts]
    a, b = names.encode(whole)
    wanted = _large([b" " + t.encode() if t else b"" for t in whole])
    good = pc.and_(pc.equal(a.joined(names.a_bytes), wanted), pc.equal(b.joined(names.b_bytes), wanted))
    good = good.to_numpy(zero_copy_only=False) & np.array([bool(t) for t in whole])
    a, b = a.only(good), b.only(good)
    return a, b, *links(a, b)


DOCUMENTS = "row long, doc_id long, n_a long, n_b long, n_groups long, a array<int>, b array<int>, groups_sha256 string"
_COUNTS = pa.struct([("pair", pa.int64()), ("n", pa.int64())])
_DOCS = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                   ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32())), ("groups_sha256", pa.string()), ("counts", pa.list_(_COUNTS))])


def _added(pairs: np.ndarray, n: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, ascending, and their counts with one more for each of ``more``."""
    found, times = np.unique(more, return_counts=True)
    at = np.searchsorted(pairs, found)
    known = at < len(pairs)
    known[known] = pairs[at[known]] == found[known]
    n = n.copy()
    n[at[known]] += times[known]
    return np.insert(pairs, at[~known], found[~known]), np.insert(n, at[~known], times[~known])


def _counts_batches(pairs: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Partial counts of pairs as rows without a document, each of ROW_PAIRS
    pairs at most: Spark holds a row in one piece."""
    for i in range(0, len(pairs), ROW_PAIRS):
        cell = pa.StructArray.from_arrays([pa.array(pairs[i:i + ROW_PAIRS]), pa.array(n[i:i + ROW_PAIRS])], fields=list(_COUNTS))
        counts = pa.ListArray.from_arrays(pa.array([0, len(cell)], pa.int32()), cell)
        yield pa.RecordBatch.from_arrays([*[pa.nulls(1, f.type) for f in _DOCS][:-1], counts], schema=_DOCS)


def align(docs: DataFrame, byte_level: str, pieces: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its links (ids ``a[i]`` and ``b[i]``), token and
    group counts and the digest of its groups; and rows without a ``row``
    number that hold partial counts of id pairs (a << 32 | b)."""
    prepare(docs.sparkSession)
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pair(byte_level, pieces)
        row = TaskContext.get().partitionId() << 40
        pairs, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for part in W.slices(batch, limit=SLICE_BYTES):
                a, b, link_a, link_b = _align(part.column("text").to_pylist(), names)
                groups = group_texts(a, b, link_a, link_b, names)
                digests = [hashlib.sha256(memoryview(g.as_buffer())[:-1]).hexdigest() if n else "" for g, n in zip(groups, a.counts)]
                bounds = pa.array(np.searchsorted(link_a, a.bounds), pa.int32())
                ids_a, ids_b = a.ids[link_a], b.ids[link_b]
                m = part.num_rows
                yield pa.RecordBatch.from_arrays([
                    pa.array(row + np.arange(m)), part.column("doc_id"), pa.array(a.counts), pa.array(b.counts),
                    pa.array(np.diff(bounds.to_numpy()), pa.int64()), pa.ListArray.from_arrays(bounds, pa.array(ids_a)),
                    pa.ListArray.from_arrays(bounds, pa.array(ids_b)), pa.array(digests, pa.string()), pa.nulls(m, pa.list_(_COUNTS))], schema=_DOCS)
                row += m
                pairs, n = _added(pairs, n, (ids_a.astype(np.int64) << _ID) | ids_b)
                if len(pairs) >= PARTIAL_PAIRS:
                    yield from _counts_batches(pairs, n)
                    pairs, n = pairs[:0], n[:0]
        yield from _counts_batches(pairs, n)

    return docs.mapInArrow(run, DOCUMENTS + ", counts array<struct<pair: bigint, n: bigint>>")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """How many links of the corpus hold each id pair, and whether no pair with
    the same b id has more: pair, n, best."""
    cells = aligned.where("row is null").select(F.explode("counts").alias("c")).groupBy("c.pair").agg(F.sum("c.n").alias("n"))
    b_id = F.col("pair").bitwiseAND((1 << _ID) - 1)
    top = cells.groupBy(b_id.alias("_b")).agg(F.max("n").alias("_top"))  # one row per id of the vocabulary
    return cells.join(top, b_id == F.col("_b")).select("pair", "n", (F.col("n") == F.col("_top")).alias("best"))


def summarise(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """One row per document of ``aligned``: doc_id, n_a, n_b, n_groups,
    n_links, n_best, count_sum, groups_sha256. Both inputs are read several
    times: give them materialised."""
    prepare(aligned.sparkSession)
    total = counts.agg(F.sum("n")).first()[0] or 0
    shared = counts.where(F.col("n") * SHARED_PAIRS > total).orderBy("pair").toPandas()  # fewer than SHARED_PAIRS rows
    sent = aligned.sparkSession.sparkContext.broadcast(
        (shared["pair"].to_numpy(np.int64), shared["n"].to_numpy(np.int64), shared["best"].to_numpy(bool)))
    out_schema = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
                  "groups_sha256 string, rest array<long>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, best = sent.value
        pairs = np.append(pairs, np.iinfo(np.int64).max)
        n, best = np.append(n, 0), np.append(best, False)
        for batch in batches:
            lists = batch.column("a")
            bounds = np.asarray(lists.offsets).astype(np.int64)
            bounds -= bounds[0]
            links_ = (lists.flatten().to_numpy().astype(np.int64) << _ID) | batch.column("b").flatten().to_numpy()
            at = np.searchsorted(pairs, links_)
            known = pairs[at] == links_
            value, is_best = n[at] * known, best[at] & known

            def sums(x: np.ndarray) -> pa.Array:
                c = np.concatenate([[0], np.cumsum(x, dtype=np.int64)])
                return pa.array(c[bounds[1:]] - c[bounds[:-1]])

            left = np.concatenate([[0], np.cumsum(~known)])[bounds]
            column = {name: batch.column(name) for name in ("row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256")}
            yield pa.RecordBatch.from_arrays(
                [column["row"], column["doc_id"], column["n_a"], column["n_b"], column["n_groups"], pa.array(np.diff(bounds)), sums(is_best),
                 sums(value), column["groups_sha256"], pa.ListArray.from_arrays(pa.array(left, pa.int32()), pa.array(links_[~known]))],
                names=[c.split()[0] for c in out_schema.split(", ")])

    first = materialise(aligned.where("row is not null").select(*[c.split()[0] for c in DOCUMENTS.split(", ")]).mapInArrow(run, out_schema), "aligned-sums")
    rare = first.select("row", F.explode("rest").alias("pair")).groupBy("row", "pair").agg(F.count("*").alias("times"))
    rare = rare.join(counts, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more"))
    plus = lambda x, y: (F.col(x) + F.coalesce(y, F.lit(0))).alias(x)
    return first.drop("rest").join(rare, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", plus("n_best", "more_best"), plus("count_sum", "more"), "groups_sha256")


def align_documents(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """The corpus alignment of both tokenizers, one row per document."""
    aligned = materialise(align(docs, byte_level, pieces), "aligned")
    return summarise(aligned, materialise(pair_counts(aligned), "aligned-pairs"))
