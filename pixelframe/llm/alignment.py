"""Operator 12: cross-tokenizer alignment by whitespace-token anchors.

Every text is tokenised whole under both vocabularies, a byte-level BPE (A, over
a space and the text) and a sentence-piece BPE (B, which adds the space).  Where
a token of both ends at the same byte, and the next token of both is marked by a
space, the text is cut: an anchor.  What lies between two anchors is a window,
a pair of id tuples.  A window is aligned once and looked up afterwards: the
byte offsets where both end cut it into groups, and all A-B pairs of a group are
links.  Shared ends inside a window are found with it, so the groups of the
windows, joined, are those of the text.

The work is cut into blocks of whole documents.  A block keeps its different
windows with their links and each document's sequence of windows, in one row of
a table in the shared folder, and counts for each of its id pairs the documents
that hold it.  These counts are added up over all blocks, the highest count of
every A id is taken, and each block is sent the counts of its own pairs.  A
block's pairs are bounded by its tokens, a document's sums are those of its
windows.  No document is sent anywhere, and nothing of the corpus to the driver.

Defined results: null or empty text and text whose tokens do not spell a space
and the text (a U+2581, which B reads as a space) has no tokens: zeros and an
empty ``groups_sha256``; strings of special tokens are plain text; equal rows
are documents of their own, also in the counts; null doc_id takes part; further
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from array import array

import numpy as np
import pyarrow as pa
import zstandard
from public_tokenizers import path as vocabulary
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from pixelframe.llm.base import read_table, stored
from pixelframe.llm.tokens import LONG, ByteBPE, PieceBPE, chunked, kept, slices

#: A tokens after which a block is closed.
BLOCK_TOKENS = 1_000_000
#: Chunks that a task remembers.
MEMO = 400_000
#: Text bytes that are tokenised at once, and chunks that are then cut at once, or one document.
_TOKENISED, _CUT_AT_ONCE = 10_000_000, 400_000
#: Links of a group up to which they are listed one by one.
_FEW = 4096
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
_B_BITS = 16  # ids of B are below 2^16: a pair of ids is a << 16 | b

_BLOCK = ("block long, doc_ids array<long>, n_a binary, n_b binary, n_groups binary, n_links binary, shas array<string>, "
          "n_windows binary, windows binary, sizes binary, links binary, times binary, pairs binary, held binary")
_RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def _pack(a, kind) -> bytes:
    """Compressed byte by byte of the numbers: high ones are mostly zero."""
    a = np.ascontiguousarray(a, kind)
    return zstandard.ZstdCompressor(level=1).compress(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes())


def _unpack(data: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


class Vocabularies(dict):
    """Chunk -> its A ids, its B ids and its length in bytes, which is -1 if
    either do not spell it.  Also both tokenizers, and of every token the byte
    length, the space mark and its decimal text before a comma or, as the last
    of its kind in a group, before the next sign."""

    def __init__(self, a_path: str, b_path: str):
        super().__init__()
        self.a, self.b = ByteBPE(a_path, plain=True, memo=MEMO), PieceBPE(b_path, memo=0)
        (self.a_bytes, self.a_len, self.a_space), (self.b_bytes, self.b_len, self.b_space), self.texts = kept(
            ("tables", a_path, b_path), self._tables)
        self.b_texts_at = 2 * len(self.a_bytes)

    def all(self, chunks: list[str]) -> tuple[list[bytes], list[bytes], np.ndarray]:
        """A ids, B ids and lengths of ``chunks``."""
        new = [c for c in chunks if c not in self]
        a, b = [self.a.encode(c) for c in new], self.b.encode_all(new)
        fresh = dict(zip(new, zip(a, b, self._lengths(new, a, b))))
        found = [self.get(c) or fresh[c] for c in chunks]
        for c in new[:MEMO - len(self)]:
            if len(c) <= LONG:
                self[c] = fresh[c]
        return [x for x, _, _ in found], [x for _, x, _ in found], np.array([n for _, _, n in found], np.int64)

    def _lengths(self, chunks: list[str], a: list[bytes], b: list[bytes]) -> list[int]:
        texts = [c.encode() for c in chunks]
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        spelt = True
        for ids, words, length in ((a, self.a_bytes, self.a_len), (b, self.b_bytes, self.b_len)):
            every = np.frombuffer(b"".join(ids), "<u4")
            ends = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)) // 4)
            at = np.append(0, np.cumsum(length[every]))[np.append(0, ends)]
            spelt = spelt and (np.diff(at) == size).all() and b"".join([words[i] for i in every.tolist()]) == b"".join(texts)
        if spelt:  # all at once; else one by one
            return size.tolist()
        return [len(t) if b"".join([self.a_bytes[i] for i in array("I", x)]) == t == b"".join([self.b_bytes[i] for i in array("I", y)])
                else -1 for t, x, y in zip(texts, a, b)]

    def _tables(self):
        both = self.a.token_bytes(), self.b.token_bytes()
        texts = [f"{i}{c}" for v, last in zip(both, "|;") for i in range(len(v)) for c in (",", last)]
        return (*((v, np.array([len(t) for t in v], np.int64), np.array([t[:1] == b" " for t in v])) for v in both),
                np.array(texts, object))


class Cuts:
    """Tokenised texts that follow each other, cut into groups and windows.

    Group g has the A tokens from a_from[g] to a_from[g + 1] and the B tokens
    likewise; window w has the groups from g_from[w] to g_from[w + 1].  Every
    text begins with a space, so its end is an anchor as well."""

    def __init__(self, a_data: bytes, b_data: bytes, v: Vocabularies):
        self.a, self.b = a, b = np.frombuffer(a_data, "<u4"), np.frombuffer(b_data, "<u4")
        a_ends, b_ends = np.cumsum(v.a_len[a]), np.cumsum(v.b_len[b])
        ended = np.zeros(int(a_ends[-1]) + 1, bool)
        ended[b_ends] = True
        i = np.flatnonzero(ended[a_ends])  # A tokens that end where a B token does
        j = np.searchsorted(b_ends, a_ends[i])
        marked = v.a_space[a[i[:-1] + 1]] & v.b_space[b[j[:-1] + 1]]
        self.a_from, self.b_from = np.append(0, i + 1), np.append(0, j + 1)
        self.g_from = np.concatenate([[0], np.flatnonzero(marked) + 1, [len(i)]])
        self.ends = a_ends[i[self.g_from[1:] - 1]]  # byte offset of each window's end

    def keys(self) -> list[bytes]:
        """The id tuples of every window as bytes: A ids, a sign that is no id, B ids."""
        a_cuts, b_cuts = self.a_from[self.g_from], self.b_from[self.g_from]
        n = np.arange(len(a_cuts))
        mixed = np.full(len(self.a) + len(self.b) + len(n) - 1, 0xFFFFFFFF, "<u4")
        mixed[np.arange(len(self.a)) + np.repeat(b_cuts[:-1] + n[:-1], np.diff(a_cuts))] = self.a
        mixed[np.arange(len(self.b)) + np.repeat(a_cuts[1:] + n[1:], np.diff(b_cuts))] = self.b
        data, edges = mixed.tobytes(), (4 * (a_cuts + b_cuts + n)).tolist()
        return [data[p:q] for p, q in zip(edges, edges[1:])]

    def align(self, w: np.ndarray, v: Vocabularies):
        """Of the windows ``w``: groups, links, different pairs, these pairs with
        their times in a row, and the text of the groups, each closed by ``;``."""
        n_groups = np.diff(self.g_from)[w]
        g = ranges(self.g_from[w], n_groups)
        edges = np.append(0, np.cumsum(n_groups))
        a_at, b_at, n_a, n_b = self.a_from[g], self.b_from[g], np.diff(self.a_from)[g], np.diff(self.b_from)[g]
        links = n_a * n_b
        n_links = np.diff(np.append(0, np.cumsum(links))[edges])
        of = np.repeat(np.arange(len(w)), n_groups)
        few = np.where(links <= _FEW, links, 0)
        nth = ranges(np.zeros(len(g), np.int64), few)
        wide = np.repeat(n_b, few)
        pair = (self.a[np.repeat(a_at, few) + nth // wide].astype(np.int64) << _B_BITS
                | self.b[np.repeat(b_at, few) + nth % wide])
        key, times = [np.repeat(of, few) << 32 | pair], [np.ones(len(pair), np.int64)]
        for k in np.flatnonzero(links > _FEW).tolist():  # long groups: different ids with their times
            (x, m), (y, n) = (np.unique(ids[at:at + size].astype(np.int64), return_counts=True)
                              for ids, at, size in ((self.a, a_at[k], n_a[k]), (self.b, b_at[k], n_b[k])))
            key.append((of[k] << 32 | x[:, None] << _B_BITS | y).ravel())
            times.append((m[:, None] * n).ravel())
        key, times = np.concatenate(key), np.concatenate(times)
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        times = np.add.reduceat(times[order], first) if len(first) else times
        key = key[first]
        n_pairs = np.bincount(key >> 32, minlength=len(w))
        # decimal ids, A before B in every group
        n = n_a + n_b
        at = np.cumsum(n) - n
        code = np.empty(int(n.sum()), np.int64)
        code[ranges(at, n_a)] = 2 * self.a[ranges(a_at, n_a)].astype(np.int64)
        code[ranges(at + n_a, n_b)] = 2 * self.b[ranges(b_at, n_b)].astype(np.int64) + v.b_texts_at
        code[at + n_a - 1] += 1
        code[at + n - 1] += 1
        texts, cuts = v.texts[code].tolist(), np.append(0, np.cumsum(n))[edges].tolist()
        return (n_groups, n_links, n_pairs, (key & 0xFFFFFFFF).astype(np.uint32), times,
                ["".join(texts[p:q]) for p, q in zip(cuts, cuts[1:])])


class Numbers(dict):
    """Key -> number, in order of appearance."""

    def __missing__(self, key: bytes) -> int:
        number = self[key] = len(self)
        return number


class _Block:
    """Documents until ``BLOCK_TOKENS``, then one row."""

    def __init__(self, number: int, v: Vocabularies):
        self.number, self.v, self.tokens = number, v, 0
        self.windows, self.texts = Numbers(), []
        none = np.zeros(0, np.int64)
        self.n_groups, self.n_links, self.n_pairs, self.pairs, self.times = none, none, [none], [none.astype(np.uint32)], [none]
        self.doc_ids, self.shas, self.sequences = [], [], []
        self.counts = [array("q") for _ in range(4)]  # a, b, groups, links

    def add(self, doc_ids: list, docs: list) -> None:
        """``docs``: (A ids, B ids, length in bytes) of each document, or None."""
        good = [d for d in docs if d is not None]
        numbers, cuts = np.zeros(0, np.int64), []
        if good:
            found = Cuts(b"".join([d[0] for d in good]), b"".join([d[1] for d in good]), self.v)
            keys, known = found.keys(), len(self.windows)
            numbers = np.fromiter(map(self.windows.__getitem__, keys), np.int64, len(keys))
            so_far = np.maximum.accumulate(numbers)
            fresh = np.flatnonzero(numbers > np.append(known - 1, np.maximum(so_far, known - 1)[:-1]))
            if len(fresh):
                n_groups, n_links, n_pairs, pairs, times, texts = found.align(fresh, self.v)
                self.n_groups, self.n_links = np.append(self.n_groups, n_groups), np.append(self.n_links, n_links)
                self.n_pairs.append(n_pairs)
                self.pairs.append(pairs)
                self.times.append(times)
                self.texts += texts
            cuts = (np.searchsorted(found.ends, np.cumsum([d[2] for d in good])) + 1).tolist()
        at, k = 0, 0
        for doc_id, d in zip(doc_ids, docs):
            own = numbers[:0]
            if d is not None:
                own, at, k = numbers[at:cuts[k]], cuts[k], k + 1
                self.tokens += len(d[0]) // 4
            text = "".join([self.texts[n] for n in own.tolist()])[:-1]
            self.doc_ids.append(doc_id)
            self.shas.append(hashlib.sha256(text.encode()).hexdigest() if d is not None else "")
            self.sequences.append(own.astype(np.uint32))
            for c, n in zip(self.counts, (len(d[0]) // 4 if d else 0, len(d[1]) // 4 if d else 0,
                                          int(self.n_groups[own].sum()), int(self.n_links[own].sum()))):
                c.append(n)

    def row(self) -> pa.RecordBatch:
        pairs, links = np.unique(np.concatenate(self.pairs), return_inverse=True)
        sizes = np.concatenate(self.n_pairs)
        starts = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        held = np.zeros(len(pairs), np.int64)
        for own in self.sequences:  # documents that hold each pair
            own = np.unique(own)
            held[np.unique(links[ranges(starts[own], sizes[own])])] += 1
        sequence = np.concatenate(self.sequences) if self.sequences else np.zeros(0, np.uint32)
        data = {"block": [self.number], "doc_ids": [self.doc_ids],
                **{n: [_pack(c, np.int64)] for n, c in zip(("n_a", "n_b", "n_groups", "n_links"), self.counts)},
                "shas": [self.shas], "n_windows": [_pack([len(s) for s in self.sequences], np.int64)],
                "windows": [_pack(sequence, np.uint32)], "sizes": [_pack(sizes, np.uint32)],
                "links": [_pack(links, np.uint32)], "times": [_pack(np.concatenate(self.times), np.int64)],
                "pairs": [_pack(pairs, np.uint32)], "held": [_pack(held, np.int64)]}
        kinds = {"block": pa.int64(), "doc_ids": pa.list_(pa.int64()), "shas": pa.list_(pa.string())}
        return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.binary())) for n, c in data.items()], names=list(data))


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size, one after the other."""
    sizes = sizes.astype(np.int64)
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def blocks(docs: DataFrame, a_path: str, b_path: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per block of ``docs`` (doc_id, text)."""

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        v = Vocabularies(a_path, b_path)
        block = _Block(number, v)
        for part in (part for batch in batches for part in slices(batch, 1, _TOKENISED)):
            chunks, texts = chunked(part.column(1).fill_null(""), spaced=True)
            a, b, sizes = v.all(chunks)
            ids, group, held = [], [], 0
            for doc_id, own in zip(part.column(0).to_pylist(), texts):
                size, spelt = sizes[own], len(own) > 0
                spelt = spelt and size.min() >= 0
                own = own.tolist()
                ids.append(doc_id)
                group.append((b"".join([a[c] for c in own]), b"".join([b[c] for c in own]), int(size.sum())) if spelt else None)
                held += len(own)
                if held >= _CUT_AT_ONCE:
                    block.add(ids, group)
                    ids, group, held = [], [], 0
            if ids:
                block.add(ids, group)
            if block.tokens >= block_tokens:
                yield block.row()
                number += 1
                block = _Block(number, v)
        if block.doc_ids:
            yield block.row()

    return stored(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).mapInArrow(run, _BLOCK), "alignments")


def _held(batches):
    """(block, pair, held): the documents of a block that hold each of its pairs."""
    for batch in batches:
        for block, pairs, held in zip(*[c.to_pylist() for c in batch.columns]):
            pairs = _unpack(pairs, np.uint32)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pairs), block, np.int64)), pa.array(pairs.astype(np.int64)),
                                              pa.array(_unpack(held, np.int64))], names=["block", "pair", "held"])


def _sums(block: pa.Table, counts: pa.Table) -> pa.Table:
    """The documents of one block, with the corpus-wide counts of its pairs."""
    row = {n: c[0] for n, c in block.to_pydict().items()}
    order = np.argsort(counts["pair"].to_numpy())  # as the block's own pairs
    count, best = counts["n"].to_numpy()[order], counts["best"].to_numpy()[order]
    sizes, links, times = _unpack(row["sizes"], np.uint32), _unpack(row["links"], np.uint32), _unpack(row["times"], np.int64)
    edges = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    windows = _unpack(row["windows"], np.uint32)
    ends = np.concatenate([[0], np.cumsum(_unpack(row["n_windows"], np.int64))])

    def per_doc(of_link: np.ndarray) -> np.ndarray:
        by_window = np.diff(np.concatenate([[0], np.cumsum(of_link * times)])[edges])
        return np.diff(np.concatenate([[0], np.cumsum(by_window[windows])])[ends])

    columns = [row["doc_ids"], *[_unpack(row[n], np.int64) for n in ("n_a", "n_b", "n_groups", "n_links")],
               per_doc(best[links].astype(np.int64)), per_doc(count[links])]
    return pa.Table.from_arrays([*[pa.array(c, pa.int64()) for c in columns], pa.array(row["shas"], pa.string())],
                                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])


def alignments(docs: DataFrame, a_path: str | None = None, b_path: str | None = None,
               block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row for every row of ``docs`` (doc_id, text): tokens, groups and links
    of its alignment.  The paths name a byte-level and a sentence-piece BPE that
    every executor can read."""
    done = blocks(docs, a_path or vocabulary(A_FILE), b_path or vocabulary(B_FILE), block_tokens)
    held = stored(done.select("block", "pairs", "held").mapInArrow(_held, "block long, pair long, held long"), "pairs")
    counts = held.groupBy("pair").agg(F.sum("held").alias("n"))
    by_a = Window.partitionBy(F.shiftright("pair", _B_BITS))  # at most one row for every id of B
    flagged = counts.withColumn("best", F.col("n") == F.max("n").over(by_a))
    answers = held.select("block", "pair").join(flagged, "pair")
    return done.drop("pairs", "held").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_sums, _RESULT)


def op12_alignment(spark, sf_dir) -> DataFrame:
    return alignments(read_table(spark, sf_dir, "documents"))
