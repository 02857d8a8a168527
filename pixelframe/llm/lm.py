"""Operator 5: language-model scoring with an Elias-Fano n-gram trie.

A bigram model with a unigram level, learnt from the documents that are not held
out: P(w) = (c(w) + 0.5) / (N + 0.5 (V + 1)), as in the base score, and
P(w | v) = (c(v w) + M P(w)) / (c(v) + M), Dirichlet smoothing.  A text is its
words (A-Z lower-cased) and one end; its first word follows an end.

The work is cut twice.  Documents are cut into blocks of about ``BLOCK_TOKENS``
tokens, each one row of a table in the shared folder: its different words as
64-bit hashes and its tokens as numbers of these.  The n-grams are cut into
shards by a hash of the whole n-gram, so no frequent word or context gathers in
one place.  Every block sends each shard its different n-grams there, with
their counts in training documents.  A shard adds the counts up, keeps them in
an Elias-Fano trie (contexts, monotone pointers, words by context, quantised
probabilities as 16-bit codes relative to N), mapped from a file, looks up what
the blocks sent and answers with codes.  Every block then adds up its documents.
Only N and V reach the driver.

Defined results: null text has one token, its end; null doc_id is not held out;
words never seen in training have count 0; equal rows are scored alike, each on
its own (and counted as often as they occur); further columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from pixelframe.llm.base import read_table, stored
from pixelframe.llm.elias_fano import EliasFano, Trie, restore

BLOCK_TOKENS = 2_000_000
SHARD_TOKENS = 2_000_000
MU = 200.0  # M above
FOLDS, HELD_OUT = 5, 1
END = b" end"  # no word has a space
_WORD_BYTES = 6  # of a following word's hash within a shard


def held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == HELD_OUT


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        i = self[word] = len(self)
        return i


def _pack(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes())


def _unpack(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel()


_BLOCK = "block long, n_train long, doc_ids array<long>, lengths binary, tokens binary, words binary"


def blocks(docs: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per block; token 0 is the end, which closes every document."""

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        ids, lengths, parts, words, size = [], [], [], None, 0

        def row():
            held = np.array([held_out(i) for i in ids], bool)
            n = np.array(lengths, np.uint32)
            hashes = np.fromiter((xxhash.xxh64_intdigest(w, 11) for w in words), np.uint64, len(words))
            return pa.RecordBatch.from_pydict({
                "block": [number], "n_train": [int(n[~held].sum())], "doc_ids": [ids], "lengths": [_pack(n)],
                "tokens": [_pack(np.concatenate(parts))], "words": [hashes.tobytes()]},
                schema=pa.schema([("block", pa.int64()), ("n_train", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                                  ("lengths", pa.binary()), ("tokens", pa.binary()), ("words", pa.binary())]))

        for batch in batches:
            for doc_id, text in zip(*[c.to_pylist() for c in batch.columns]):
                if words is None:
                    words = _Numbers({END: 0})
                found = (text or "").encode("utf-8", "surrogatepass").lower().split()
                tokens = np.zeros(len(found) + 1, np.uint32)
                tokens[:-1] = np.fromiter(map(words.__getitem__, found), np.uint32, len(found))
                ids.append(doc_id)
                lengths.append(len(tokens))
                parts.append(tokens)
                size += len(tokens)
                if size >= block_tokens:
                    yield row()
                    number, ids, lengths, parts, words, size = number + 1, [], [], [], None, 0
        if ids:
            yield row()

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    return stored(rows.mapInArrow(run, _BLOCK), "blocks")


class Block:
    """A block's tokens, its different pairs and the shards of both."""

    def __init__(self, doc_ids: list, lengths: bytes, tokens: bytes, words: bytes, shards: int):
        self.doc_ids = doc_ids
        self.lengths = _unpack(lengths, np.uint32).astype(np.int64)
        self.tokens = _unpack(tokens, np.uint32).astype(np.int64)
        self.hashes = np.frombuffer(words, np.uint64)
        self.held = np.array([held_out(i) for i in doc_ids], bool)
        before = np.concatenate([[0], self.tokens[:-1]])  # an end stands before every document
        key = before * len(self.hashes) + self.tokens
        pairs, self.pair_of = np.unique(key, return_inverse=True)
        train = np.repeat(~self.held, self.lengths)
        self.pair_counts = np.bincount(self.pair_of[train], minlength=len(pairs))
        self.word_counts = np.bincount(self.tokens[train], minlength=len(self.hashes))
        self.first, self.second = np.divmod(pairs, len(self.hashes))
        with np.errstate(over="ignore"):
            mixed = (self.hashes[self.first] * np.uint64(0x9E3779B97F4A7C15)) ^ (self.hashes[self.second] * np.uint64(0xC2B2AE3D27D4EB4F))
            mixed ^= mixed >> np.uint64(32)
            self.pair_shard = (mixed * np.uint64(0x165667B19E3779F9) >> np.uint64(33)).astype(np.int64) % shards
            self.word_shard = (self.hashes * np.uint64(0x165667B19E3779F9) >> np.uint64(33)).astype(np.int64) % shards


def _by_shard(shard: np.ndarray):
    """(shard, indexes there), indexes in order."""
    order = np.argsort(shard, kind="stable")
    found, starts = np.unique(shard[order], return_index=True)
    return zip(found.tolist(), np.split(order, starts[1:]))


_REQUEST = "shard long, block long, words binary, word_counts binary, contexts binary, runs binary, followers binary, pair_counts binary"


def requests(table: DataFrame, shards: int) -> DataFrame:
    """One row per block and shard: the words and the pairs (by context) that the
    block has there and how often each occurs in training documents."""

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                b = Block(r["doc_ids"], r["lengths"], r["tokens"], r["words"], shards)
                words, pairs = dict(_by_shard(b.word_shard)), dict(_by_shard(b.pair_shard))
                none = np.empty(0, np.int64)
                out = []
                for shard in sorted(set(words) | set(pairs)):
                    w, p = words.get(shard, none), pairs.get(shard, none)
                    starts = np.flatnonzero(np.concatenate([[True], np.diff(b.first[p]) != 0])) if len(p) else none
                    followers = b.hashes[b.second[p]].view(np.uint8).reshape(-1, 8)[:, :_WORD_BYTES]
                    out.append((shard, r["block"], b.hashes[w].tobytes(), _pack(b.word_counts[w].astype(np.uint32)),
                                b.hashes[b.first[p[starts]]].tobytes(),
                                _pack(np.diff(np.append(starts, len(p))).astype(np.uint32)),
                                followers.tobytes(), _pack(b.pair_counts[p].astype(np.uint32))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), [pa.int64()] * 2 + [pa.binary()] * 6)],
                    names=[f.split()[0] for f in _REQUEST.split(", ")])

    return table.mapInArrow(run, _REQUEST)


_ANSWER = "block long, shard long, n_words long, words binary, pairs binary"


def _answer(table: pa.Table) -> pa.Table:
    """One shard: add up, build the trie, look up.  A row with block -1 has the
    number of different training words."""
    rows = table.to_pylist()
    word = [np.frombuffer(r["words"], np.uint64) for r in rows]
    word_count = [_unpack(r["word_counts"], np.uint32) for r in rows]
    known, which = np.unique(np.concatenate(word), return_inverse=True)
    total = np.bincount(which, weights=np.concatenate(word_count), minlength=len(known)).astype(np.int64)
    level = EliasFano(known[total > 0])
    kept = total[total > 0]
    context, follower, count = [], [], []
    for r in rows:
        runs = _unpack(r["runs"], np.uint32)
        context.append(np.repeat(np.frombuffer(r["contexts"], np.uint64), runs))
        six = np.frombuffer(r["followers"], np.uint8).reshape(-1, _WORD_BYTES)
        follower.append(np.ascontiguousarray(np.pad(six, ((0, 0), (0, 8 - _WORD_BYTES)))).view(np.uint64).ravel())
        count.append(_unpack(r["pair_counts"], np.uint32))
    sizes = [len(c) for c in context]
    c, f, n = np.concatenate(context), np.concatenate(follower), np.concatenate(count).astype(np.int64)
    del context, follower, count
    order = np.lexsort((f, c))
    new = np.concatenate([[True], (np.diff(c[order]) != 0) | (np.diff(f[order]) != 0)]) if len(c) else np.zeros(0, bool)
    starts = np.flatnonzero(new)
    sums = np.add.reduceat(n[order], starts) if len(c) else n
    heads = order[starts]
    seen = sums > 0
    trie = Trie(c[heads][seen], f[heads][seen], sums[seen])
    codes = np.empty(len(c), np.uint16)
    codes[order] = trie.lookup(c[heads], f[heads])[np.cumsum(new) - 1] if len(c) else 0
    out, at = [], 0
    for r, w, size in zip(rows, word, sizes):
        i = level.find(w)
        counts = np.where(i >= 0, kept[np.maximum(i, 0)] if len(kept) else 0, 0)
        out.append((r["block"], r["shard"], 0, _pack(counts.astype(np.uint64)), _pack(codes[at:at + size])))
        at += size
    out.append((-1, rows[0]["shard"], len(kept), None, None))
    return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), [pa.int64()] * 3 + [pa.binary()] * 2)],
                                names=[x.split()[0] for x in _ANSWER.split(", ")])


_SCORE = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _scores(shards: int, n: int, v: int, mu: float):
    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        for r in block.to_pylist():
            b = Block(r["doc_ids"], r["lengths"], r["tokens"], r["words"], shards)
            count = np.zeros(len(b.hashes))
            joint = np.zeros(len(b.first))
            words, pairs = dict(_by_shard(b.word_shard)), dict(_by_shard(b.pair_shard))
            for a in answers.to_pylist():
                if a["shard"] in words:
                    count[words[a["shard"]]] = _unpack(a["words"], np.uint64)
                if a["shard"] in pairs:
                    joint[pairs[a["shard"]]] = restore(_unpack(a["pairs"], np.uint16))
            base = (count + 0.5) / (n + 0.5 * (v + 1))
            p = (joint + mu * base[b.second]) / (count[b.first] + mu)
            starts = np.concatenate([[0], np.cumsum(b.lengths)[:-1]])
            out.append(pd.DataFrame({
                "doc_id": pd.array(b.doc_ids, "Int64"), "held_out": b.held, "n_tokens": b.lengths,
                "n_known": np.add.reduceat((count > 0)[b.tokens].astype(np.int64), starts), "train_tokens": n,
                "base_score": np.add.reduceat(np.log10(base)[b.tokens], starts),
                "score": np.add.reduceat(np.log10(p)[b.pair_of], starts)}))
        schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                            ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
        return pa.Table.from_pandas(pd.concat(out), schema, preserve_index=False) if out else schema.empty_table()

    return run


def score(docs: DataFrame, mu: float = MU, block_tokens: int = BLOCK_TOKENS, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs`` (doc_id, text)."""
    table = blocks(docs, block_tokens)
    n = table.agg(F.coalesce(F.sum("n_train"), F.lit(0))).first()[0]
    shards = int(max(8, n // shard_tokens))
    answers = stored(requests(table, shards).groupBy("shard").applyInArrow(_answer, _ANSWER), "answers")
    v = answers.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    return table.groupBy("block").cogroup(answers.where("block >= 0").groupBy("block")).applyInArrow(
        _scores(shards, n, v, mu), _SCORE)


def op5_lm(spark, sf_dir) -> DataFrame:
    return score(read_table(spark, sf_dir, "documents"))
