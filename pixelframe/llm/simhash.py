"""Operator 10: SimHash near-duplicates by deletion-variant signatures.

Fingerprints are 64 bits over word shingles.  For a distance of at most two
bits the fingerprint is cut into two segments of 32 bits: of any linked pair,
one segment differs in at most one bit.  Every segment is indexed under its 32
one-wildcard variants (one bit left out); two fingerprints meet under a common
variant exactly when that segment differs in no more than that bit.  An
equality join on the variants gives candidates, the bit distance of the whole
fingerprints decides.

Work is done on distinct fingerprints.  A variant shared by more than
``BUCKET`` fingerprints is not paired: its members are indexed by the points at
distance at most one (the fingerprint and its 64 one-bit changes).  Two
fingerprints link exactly when they share such a point, and all that share a
point (65 at most) link to each other, so each is tied to the smallest.  The
components are the same as of all links.

Defined results: null or wordless text has fingerprint zero, linked like any
other; equal rows fall into one component; null doc_id takes part and its
component_id is the smallest id reachable, null if there is none; further
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from pixelframe.llm.base import ROW, read_table, stored, with_row_key
from pixelframe.llm.components import connected_components

SHINGLE = 3
MAX_BITS = 2
SEED = 42
SEGMENTS = 2
BUCKET = 16
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash: a bit is set if it is set in over half the shingles' XXH64."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = max(len(words) - shingle + 1, 1)
    if not words:
        return 0
    if n == 1:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    counts = np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        part = words[at:at + _CHUNK + shingle - 1]
        m = len(part) - shingle + 1
        grams = zip(*[part[k:k + m] for k in range(shingle)])
        h = np.fromiter((digest(join(g), seed) for g in grams), np.uint64, m)
        bits = np.unpackbits(h.view(np.uint8).reshape(m, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and ``fp`` (the fingerprint as a signed long) of every row."""
    fields = docs.select(*[docs[c] for c in keep]).schema

    def run(batches):
        for batch in batches:
            fp = np.fromiter((fingerprint(t, shingle, seed) for t in batch.column(len(keep)).to_pylist()),
                             np.uint64, batch.num_rows).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fp)],
                                             names=[*batch.schema.names[:-1], "fp"])

    return docs.select(*[docs[c] for c in keep], docs["text"]).mapInArrow(
        run, fields.add("fp", "long"))


def _variants(fps: DataFrame) -> DataFrame:
    """(sig, fp): 32 one-wildcard variants of either 32-bit segment."""
    one = F.lit(1).cast("long")
    # a small file of fingerprints makes many rows: dealt to as many tasks as any shuffle first
    tasks = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = fps.repartition(tasks, "fp").select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("i"))
    bit = (F.col("i") % 32).cast("int")
    seg = F.when(F.col("i") < 32, F.col("fp")).otherwise(F.expr("shiftrightunsigned(fp, 32)")).bitwiseAND(0xFFFFFFFF)
    rows = rows.withColumn("seg", seg).withColumn("mask", F.call_function("shiftleft", one, bit))
    rest = F.col("seg").bitwiseAND(F.bitwise_not("mask"))
    return rows.select(rest.bitwiseOR(F.call_function("shiftleft", F.col("i").cast("long"), F.lit(32))).alias("sig"), "fp")


def links(fps: DataFrame, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """(u, v): pairs of distinct fingerprints whose components are those of all
    pairs at ``max_bits`` or fewer differing bits.  ``fps``: distinct fp (long)."""
    if max_bits != MAX_BITS:
        raise ValueError("two segments with one wildcard find distances up to 2")
    sigs = _variants(fps)
    shared = sigs.groupBy("sig").agg(F.count("*").alias("n")).where("n > 1")
    # both sides grow with the input: a merge join at any size
    members = stored(sigs.join(shared.hint("merge"), "sig"), "variants")
    small = members.where(F.col("n") <= bucket).groupBy("sig").agg(
        F.sort_array(F.collect_list("fp")).alias("fps"))  # at most ``bucket`` entries
    pairs = small.select(F.explode(F.flatten(F.transform("fps", lambda a, i: F.transform(
        F.filter("fps", lambda b: b > a), lambda b: F.struct(a.alias("u"), b.alias("v")))))).alias("p")).select("p.*")
    pairs = pairs.where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits).distinct()
    crowded = members.where(F.col("n") > bucket).select("fp").distinct()
    return pairs.union(_ball_links(crowded))


def _ball_links(fps: DataFrame) -> DataFrame:
    """Exact links of crowded variants by the points at distance 0 or 1."""
    one = F.lit(1).cast("long")
    rows = fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(64))).alias("i"))
    point = F.when(F.col("i") == 64, F.col("fp")).otherwise(
        F.col("fp").bitwiseXOR(F.call_function("shiftleft", one, (F.col("i") % 64).cast("int"))))
    groups = rows.select(point.alias("point"), "fp").groupBy("point").agg(
        F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)  # at most 65 entries
    return groups.select(F.explode("fps").alias("u"), F.array_min("fps").alias("v")).where("u <> v").distinct()


def components(rows: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(fp, root): the smallest linked fingerprint of every fingerprint in ``rows``."""
    distinct = stored(rows.select("fp").distinct(), "fingerprints")
    roots = connected_components(links(distinct, bucket=bucket))
    return distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs`` (doc_id, text)."""
    rows = stored(fingerprints(docs.withColumn("doc_id", F.col("doc_id").cast("long")), shingle), "fps")
    by_fp = rows.groupBy("fp").agg(F.min("doc_id").alias("low"))
    comp = stored(components(rows, bucket).join(by_fp, "fp"), "roots")
    lows = comp.groupBy("root").agg(F.min("low").alias("component_id"))
    comp = comp.join(lows, "root").select("fp", "component_id")
    return rows.join(comp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One row of every component, with all its columns: the one with the
    smallest doc_id (null last), of equal ones the first in the table."""
    rows = with_row_key(docs)
    fps = stored(fingerprints(rows, shingle, keep=("doc_id", ROW)), "fps")
    best = fps.join(components(fps), "fp").groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", ROW)).alias("first"))
    return rows.join(best.select(F.col(f"first.{ROW}").alias(ROW)), ROW, "left_semi").select(docs.columns)


def op10_simhash(spark, sf_dir) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))
