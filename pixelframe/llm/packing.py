"""Operator 11: best-fit packing by large-item matching.

Documents become token ids and an end (id 0); one of more than ``capacity`` ids
is cut from its end into pieces of ``capacity``, so only its first piece may be
shorter.  No sequence holds more than two pieces above a third of the capacity:
those are paired by greedy matching, the largest with the largest that still
fits beside it.  Shorter pieces, longest first, go into the smallest gap that
takes them, or into a new sequence.

Only lengths decide, and there are at most ``capacity`` of them.  The tasks
that cut the documents number their pieces within (task, length); counts by
task and length give every piece its rank among all of its length; the table of
counts by length, ``capacity`` rows at any size of the input, is packed by
runs of equal sequences.  The resulting runs (length, first rank, first
sequence, place) are sent to the tasks, where each piece finds its own.

Defined results: null text is empty (its end alone, one id); equal rows and
null doc_id are packed like any other, each on its own; a special token's
string in a text has its own id, as the tokenizer gives it by default; further
columns are ignored; an empty table gives an empty result.  Sequences are numbered from 0.
"""

from __future__ import annotations

import zlib
from collections import Counter, deque

import numpy as np
import pyarrow as pa
from public_tokenizers import path as vocabulary
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from pixelframe.llm.base import read_table, stored
from pixelframe.llm.tokens import ByteBPE, chunked

CAPACITY = 2048
END = 0
VOCABULARY = "byte_bpe_50k.json"

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long"
_PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """The pieces of every row of ``docs`` (doc_id, text), numbered by task and length."""
    closing = np.array([end], "<u4").tobytes()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"]

    def run(batches):
        part, seen = TaskContext.get().partitionId(), Counter()
        bpe = ByteBPE(tokenizer)
        for batch in batches:
            chunks, texts = chunked(batch.column(1).fill_null(""), spaced=False)
            ids = bpe.all(chunks)
            rows = []
            for doc_id, own in zip(batch.column(0).to_pylist(), texts):
                data = b"".join([ids[c] for c in own.tolist()]) + closing
                n = len(data) // 4
                at = 0
                for k, length in enumerate([(n - 1) % capacity + 1, *[capacity] * ((n - 1) // capacity)]):
                    rows.append((doc_id, k, at, length, zlib.crc32(data[4 * at:4 * (at + length)]), part, seen[length]))
                    seen[length] += 1
                    at += length
            if rows:
                kinds = (pa.int64(), pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).mapInArrow(run, _PIECES)


def plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Runs of equal sequences, from the number of pieces of each length: rows
    (length, first rank, pieces a sequence, first sequence, place), by length
    and rank.  Pieces of a length take the places of its runs in their order."""
    left, taken, runs = dict(counts), Counter(), []
    gaps: list[deque] = [deque() for _ in range(capacity + 1)]  # by room: (first sequence, number of sequences)
    opened = 0

    def put(length: int, first: int, n: int, each: int, room: int) -> None:
        """``each`` pieces into every one of ``n`` sequences with ``room``."""
        runs.append((length, taken[length], each, first, capacity - room))
        taken[length] += n * each
        left[length] -= n * each
        gaps[room - each * length].append((first, n))

    large = [n for n in sorted(counts, reverse=True) if 3 * n > capacity]
    for a in large:
        for b in large:
            if not left[a]:
                break
            if b > a or a + b > capacity or not left[b]:
                continue
            n = min(left[a], left[b]) if a != b else left[a] // 2
            if n:
                put(a, opened, n, 1, capacity)
                gaps[capacity - a].pop()
                put(b, opened, n, 1, capacity - a)
                opened += n
        if left[a]:
            n = left[a]
            put(a, opened, n, 1, capacity)
            opened += n
    for length in sorted((n for n in counts if 3 * n <= capacity), reverse=True):
        room = length
        while left[length]:
            if room > capacity:  # no gap takes it
                n = -(-left[length] // (capacity // length))
                gaps[capacity].append((opened, n))
                opened += n
                room = capacity
            while gaps[room] and left[length]:
                first, n = gaps[room].popleft()
                each = room // length
                full = min(n, left[length] // each)
                if full < n:
                    rest = left[length] - full * each
                    if rest:  # the last pieces of this length do not fill a sequence's gap
                        if n - full > 1:
                            gaps[room].appendleft((first + full + 1, n - full - 1))
                    else:
                        gaps[room].appendleft((first + full, n - full))
                else:
                    rest = 0
                if full:
                    put(length, first, full, each, room)
                if rest:
                    put(length, first + full, 1, rest, room)
            room += 1
    return np.array(sorted(runs), np.int64).reshape(-1, 5)


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for every
    piece of every row of ``docs`` (doc_id, text).  ``tokenizer``: path of a
    byte-level BPE file that every executor can read."""
    spark = docs.sparkSession
    cut = stored(pieces(docs, tokenizer or vocabulary(VOCABULARY), capacity, end), "pieces")
    counts = stored(cut.groupBy("part", "length").agg(F.count("*").alias("n")), "piece_counts")
    # at most ``capacity`` rows reach the driver, whatever the size of the input
    runs = plan({r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, capacity)
    sent = spark.sparkContext.broadcast(runs)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = cut.join(before, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank"))
    base = 1 << 40  # above any rank of a length

    def place(batches):
        length, first, each, sequence, offset = sent.value.T
        keys = length * base + first
        for batch in batches:
            n, rank = (batch.column(k).to_numpy() for k in (3, 5))
            r = np.searchsorted(keys, n * base + rank, side="right") - 1
            nth = rank - first[r]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence[r] + nth // each[r]), pa.array(offset[r] + nth % each[r] * n)],
                names=[*batch.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(place, _PLACED)


def op11_packing(spark, sf_dir) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))
