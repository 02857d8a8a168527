"""Operator 1: mixing sources to target weights by pivotal dependent rounding.

Every source gets a target (words); a document's expected number of copies is
``target / source size``, at most ``cap``.  The whole part is taken as it is,
the fractional part is a copy probability.  Within a source, probabilities are
paired: mass moves at random from one to the other, weighted by their sizes so
that the expected words of the pair stay the same, until one of the two is 0 or
1.  The other goes on to the next pair.  Blocks of at most about
``docs_per_block`` documents, dealt by row and not by source, do this in
parallel, largest documents first, each paired with the pool of those after it;
what each block leaves open (one document per source) is combined by a
reduction tree of further such rounds, whose nodes take a share of the sources.  At the root one document per source is
rounded by itself, so a source misses its target by less than the size of one
document, most often one of its smallest.

Defined results: null text has size 0; documents of size 0 are taken 0 times
(0 words); null ``source`` is a source of its own, last in order; equal rows
are separate documents; an empty table gives an empty result; further columns
are ignored.  Rows are dealt and ordered by a hash of their content (doc_id,
source, text), not by their place in the files, and draws depend on ``seed``,
block and source only: reruns agree however the table is cut, up to the exchange
of rows that are equal.
"""

from __future__ import annotations

import hashlib
import math
import random

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from pixelframe.functions.ranges import global_index
from pixelframe.llm.base import ROW, WS, read_table, split_words, stored, with_row_key

WEIGHTS = (1.0, 2.0, 3.0)
CAP = 3.0
DOCS_PER_BLOCK = 20_000
FAN_IN = 32

#: Sources of a node of the reduction tree, about.
SOURCES_PER_NODE = 1000

_ROUND_SCHEMA = ("nth long, row_key long, doc_id long, source string, size long, source_size long, target double, "
                 "whole long, p double, block long, up int")


def word_count(text) -> Column:
    return F.size(split_words(text, WS)).cast("long")


def source_targets(sized: DataFrame, weights=WEIGHTS, cap: float = CAP) -> DataFrame:
    """(source, source_size, weight, target) from (source, size).

    All sizes together are shared by weight; a target stops at ``cap`` times
    its source's size and the excess is shared again, until none is above.
    The loop raises one number, the words per unit of weight; each pass is
    one aggregate over the sources."""
    by_source = stored(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    ranked = global_index(by_source, [F.col("source").asc_nulls_last()], "rank")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", w)
    total, all_weight = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    rate, capped = 0.0, -1
    if total:
        rate = total / all_weight
        while True:
            above = F.col("source_size") * cap < F.col("weight") * rate
            n, words, weight = ranked.where(above).agg(
                F.count("*"), F.sum(F.col("source_size") * cap), F.sum("weight")).first()
            if n == capped:
                break
            capped = n
            rate = (total - (words or 0.0)) / (all_weight - (weight or 0.0))
    return ranked.select("source", "source_size", "weight",
                         F.least(F.col("source_size") * cap, F.col("weight") * rate).alias("target"))


def _draws(seed: int, level: int, block: int, source: str | None) -> random.Random:
    key = repr((seed, level, block, source)).encode()
    return random.Random(int.from_bytes(hashlib.blake2b(key, digest_size=8).digest(), "big"))


def pivot(p: float, a: float, q: float, b: float, u: float) -> tuple[float, float]:
    """Move mass between probabilities ``p`` (weight ``a``) and ``q`` (``b``);
    ``a*p + b*q`` and both expectations stay, one of the two ends at 0 or 1."""
    up = min(1.0 - p, q * b / a)
    down = min(p, (1.0 - q) * b / a)
    if u * (up + down) < down:
        return (1.0, q - up * a / b) if up == 1.0 - p else (p + up, 0.0)
    return (0.0, q + down * a / b) if down == p else (p - down, 1.0)


def _first_round(seed: int):
    """One block: its documents of a source all have the same probability.  The
    largest is paired with the pool of the rest, whose common probability takes
    up the mass, then the next largest.  What is left open is a small document."""

    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["size", "nth"], ascending=[False, True]).reset_index(drop=True)
        up, open_p = block["up"].astype("Int32").copy(), block["p"].astype(float).copy()
        number = int(block["block"].iloc[0])
        for source, rows in block.groupby("source", dropna=False, sort=False):
            rng = _draws(seed, 0, number, None if pd.isna(source) else source)
            sizes, q = rows["size"].tolist(), float(rows["p"].iloc[0])
            pool = float(sum(sizes))
            for at, i in enumerate(rows.index):
                pool -= sizes[at]
                if at == len(sizes) - 1:
                    open_p[i] = q
                    if q in (0.0, 1.0):
                        up[i] = int(q)
                    break
                p, q = (_snap(x) for x in pivot(q, sizes[at], q, pool, rng.random()))
                if p in (0.0, 1.0):
                    up[i], open_p[i] = int(p), p
                if q in (0.0, 1.0):
                    rest = rows.index[at + 1:]
                    up[rest], open_p[rest] = int(q), q
                    if p not in (0.0, 1.0):
                        open_p[i] = p
                    break
        return block.assign(up=up, p=open_p)

    return run


def _snap(p: float) -> float:
    return 0.0 if p < 1e-9 else 1.0 if p > 1 - 1e-9 else p


def _next_round(level: int, last: bool, seed: int):
    """One node of the tree: what its blocks left open, one document per block
    and source, paired one after the other.  At the root the last one is drawn."""

    def run(node: pd.DataFrame) -> pd.DataFrame:
        node = node.sort_values(["size", "nth"], ascending=[False, True]).reset_index(drop=True)
        up, open_p = node["up"].astype("Int32").copy(), node["p"].astype(float).copy()
        number, sizes = int(node["block"].iloc[0]), node["size"].tolist()
        for source, rows in node.groupby("source", dropna=False, sort=False):
            rng = _draws(seed, level, number, None if pd.isna(source) else source)
            live = None
            for i in rows.index:
                if live is None:
                    live = i
                    continue
                p, q = (_snap(x) for x in pivot(open_p[live], sizes[live], open_p[i], sizes[i], rng.random()))
                open_p[live], open_p[i] = p, q
                still = [x for x in (live, i) if open_p[x] not in (0.0, 1.0)]
                for x in (live, i):
                    if x not in still:
                        up[x] = int(open_p[x])
                live = still[0] if still else None
            if last and live is not None:
                up[live] = int(rng.random() < open_p[live])
        return node.assign(up=up, p=open_p)

    return run


def mix(docs: DataFrame, weights=WEIGHTS, cap: float = CAP, seed: int = 17,
        docs_per_block: int = DOCS_PER_BLOCK, fan_in: int = FAN_IN, row_key=None) -> DataFrame:
    """(row_key, doc_id, source, size, source_size, target, copies, taken) for
    every row of ``docs`` (doc_id, text, source)."""
    key = F.monotonically_increasing_id() if row_key is None else docs[row_key]
    content = F.xxhash64(docs["doc_id"], docs["source"], docs["text"])
    hashed = stored(docs.select(key.alias("row_key"), content.alias("h"), docs["doc_id"].cast("long").alias("doc_id"),
                                docs["source"], word_count(docs["text"]).alias("size")), "sizes")
    # equal rows share a hash; the key spreads them, and which is which does not matter
    sized = stored(global_index(hashed, [F.col("h"), F.col("row_key")], "nth").drop("h"), "order")
    targets = source_targets(sized, weights, cap)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    n_blocks = max(1, math.ceil(sized.count() / docs_per_block))
    t = targets.withColumnRenamed("source", "source_t")
    # a source is a hot key: the targets join on (source, salt), each source once per salt
    salts = 16
    t = t.withColumn("salt_t", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = sized.withColumn("salt", F.pmod(F.xxhash64("row_key"), F.lit(salts)).cast("int"))
    with_rate = salted.join(t, F.col("source").eqNullSafe(F.col("source_t")) & (F.col("salt") == F.col("salt_t")))
    rows = with_rate.select(
        "nth", "row_key", "doc_id", "source", "size", "source_size", "target",
        F.when(F.col("size") > 0, F.floor(rate)).otherwise(0).cast("long").alias("whole"),
        F.when(F.col("size") > 0, rate - F.floor(rate)).otherwise(0.0).alias("p"),
        (F.col("nth") % n_blocks).alias("block"))
    rows = stored(rows.withColumn("up", F.when(F.col("p") == 0, 0)), "rates")
    done = stored(rows.where("up is null").groupBy("block").applyInPandas(_first_round(seed), _ROUND_SCHEMA), "round0")
    decided, level = [rows.where("up is not null"), done.where("up is not null")], 0
    lanes = max(1, math.ceil(targets.count() / SOURCES_PER_NODE))
    lane = F.pmod(F.xxhash64("source"), F.lit(lanes))
    while True:
        n_blocks, level = math.ceil(n_blocks / fan_in), level + 1
        nodes = done.where("up is null").withColumn("block", F.floor(F.col("block") / fan_in).cast("long"))
        done = stored(nodes.groupBy("block", lane.alias("lane")).applyInPandas(
            _next_round(level, n_blocks == 1, seed), _ROUND_SCHEMA), f"round{level}")
        decided.append(done.where("up is not null"))
        if n_blocks == 1:
            break
    out = decided[0]
    for d in decided[1:]:
        out = out.unionByName(d)
    copies = (F.col("whole") + F.col("up")).cast("long")
    return out.select("row_key", "doc_id", "source", "size", "source_size", "target",
                      copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """Every row of ``docs`` as often as the mix takes it, with all its columns
    and ``mix_copy``, the number of the copy from 1 on."""
    rows = with_row_key(docs)
    taken = stored(mix(rows, row_key=ROW, **options).where("copies > 0").select(
        F.col("row_key").alias(ROW), F.col("copies").alias("__copies")), "copies")
    out = rows.join(taken, ROW).withColumn("mix_copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))))
    return out.select(*docs.columns, "mix_copy")


def op1_mixing(spark, sf_dir) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies")
