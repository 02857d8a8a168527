"""Operator 4: quality classifier by hierarchical empirical Bayes.

Two questions are asked of every document: is it of good quality, is it toxic.
For each, the log-odds are those of its site plus the evidence of its text.

Site: the rate among the labelled documents of its host (``source``) and, within
the host, of its path (here host and ``lang``).  A host's rate is shrunk towards
the global rate, a path's towards its host's: rate = (positives + k * prior) /
(labelled + k), where k follows from how far the rates of all hosts (paths) vary
beyond chance (method of moments).  Sparse sites so stay near their prior.
Everything is grouped aggregation over all labelled documents.

Text: logistic regression over the presence of words and shape marks (shares of
character classes, function words and repeated words), fitted on at most
``MAX_TRAIN`` labelled documents chosen by a hash of doc_id, with at most
``MAX_FEATURES`` features, those that differ most between the classes.  Its
log-odds less those of the class in the sample are the evidence.

Defined results: null text is empty text; null source or lang is a site of its
own; sites and whole tables without labels have the prior (0.5 without any
label); null doc_id never matches a label; of several labels of a doc_id the
largest counts; equal rows are judged alike; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, functions as F

from pixelframe.llm.base import read_table, stored
from pixelframe.llm.rules import N_CHAR_BINS, char_histogram, repeated_words, word_histogram

HEADS = ("quality", "toxic")
MAX_TRAIN = 20_000
MAX_FEATURES = 2_000
MIN_DOCUMENTS = 5
MIN_Z = 4.0
BROADCAST_ROWS = 1_000_000
REG = 0.005
_STRIP = b".,;:!?'\"-()[]#$%&*|<>"


def features(text: str | None) -> set[bytes]:
    """Different words (A-Z lower-cased, outer marks off) and shape marks of a text."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    found = {w.strip(_STRIP) for w in set(text.encode("utf-8", "surrogatepass").lower().split())}
    found.discard(b"")
    if words:
        chars, common = char_histogram(text), word_histogram(words)
        for i in range(N_CHAR_BINS):
            found.add(b" char %d %d" % (i, _bin(chars[i] / chars.sum())))
        found.add(b" common %d" % _bin(1 - common[-1] / common.sum()))
        found.add(b" repeat %d" % _bin(repeated_words(words) / len(words)))
    found.add(b" words %d" % min(len(words).bit_length(), 12))
    return found


def _bin(share: float) -> int:
    """0: none, then bins that double from 1/64 on."""
    return 0 if share <= 0 else max(1, 8 + math.ceil(math.log2(share))) if share > 1 / 128 else 1


def sample_labelled(docs: DataFrame, labels: DataFrame, max_train: int) -> DataFrame:
    """(text, quality, toxic) of at most about ``max_train`` labelled documents."""
    one = one_label(labels)
    share = min(1.0, max_train / max(1, one.count()))
    chosen = F.pmod(F.xxhash64(F.lit("train"), F.col("doc_id")), F.lit(1 << 20)) < int(share * (1 << 20))
    d = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).where(chosen)
    return d.join(one.where(chosen), "doc_id").select("text", *HEADS)


def one_label(labels: DataFrame) -> DataFrame:
    rows = labels.select(labels["doc_id"].cast("long").alias("doc_id"), *[labels[h].cast("int").alias(h) for h in HEADS])
    return rows.where("doc_id is not null").groupBy("doc_id").agg(*[F.max(h).alias(h) for h in HEADS])


def fit_text(sample: DataFrame, max_features: int = MAX_FEATURES) -> dict:
    """{"base": [per head], "weight": {feature: (per head)}}: their sum is the evidence."""

    def counts(batches):
        total: dict[bytes, np.ndarray] = {}
        for batch in batches:
            for text, *heads in zip(*[c.to_pylist() for c in batch.columns]):
                row = np.zeros(4)
                for k, y in enumerate(heads):
                    if y is not None:
                        row[2 * k + (y > 0)] = 1
                for f in features(text) | {b" all"}:
                    if f in total:
                        total[f] += row
                    else:
                        total[f] = row.copy()
        for at in range(0, len(total), 50_000):
            part = list(total.items())[at:at + 50_000]
            cols = np.array([v for _, v in part])
            yield pa.RecordBatch.from_arrays(
                [pa.array([f for f, _ in part], pa.binary()), *[pa.array(cols[:, i]) for i in range(4)]],
                names=["f", "n0", "n1", "n2", "n3"])

    names = ["n0", "n1", "n2", "n3"]
    by_feature = stored(sample.mapInArrow(counts, "f binary, n0 double, n1 double, n2 double, n3 double").groupBy("f").agg(
        *[F.sum(n).alias(n) for n in names]), "features")
    total = by_feature.where(F.col("f") == F.lit(b" all")).first()
    size = [float(total[n]) if total else 0.0 for n in names]

    def z(a: str, b: str, na: float, nb: float) -> Column:
        if not na or not nb:
            return F.lit(0.0)
        p = (F.col(a) + F.col(b) + 0.5) / (na + nb + 1.0)
        return F.abs(F.col(a) / na - F.col(b) / nb) / F.sqrt(p * (1 - p) * (1 / na + 1 / nb) + 1e-12)

    scored = by_feature.where(F.col("f") != F.lit(b" all")).where(sum(F.col(n) for n in names) >= MIN_DOCUMENTS).withColumn(
        "z", F.greatest(z("n0", "n1", *size[:2]), z("n2", "n3", *size[2:])))
    rows = scored.where(F.col("z") >= MIN_Z).orderBy(F.col("z").desc(), "f").limit(max_features).collect()
    vocabulary = [bytes(r["f"]) for r in rows]
    base, weight = [0.0, 0.0], {f: [0.0, 0.0] for f in vocabulary}
    vectors = _vectors(sample, vocabulary) if vocabulary else None
    for k, head in enumerate(HEADS):
        if vectors is None or not all(size[2 * k:2 * k + 2]):
            continue  # only one class: no evidence either way
        fitted = LogisticRegression(featuresCol="x", labelCol=head, regParam=REG, maxIter=50).fit(
            vectors.where(F.col(head).isNotNull()).withColumn(head, (F.col(head) > 0).cast("double")))
        base[k] = float(fitted.intercept) - math.log(size[2 * k + 1] / size[2 * k])
        for f, w in zip(vocabulary, fitted.coefficients.toArray()):
            weight[f][k] = float(w)
    return {"base": base, "weight": {f: tuple(w) for f, w in weight.items()}}


def _vectors(sample: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """(x, quality, toxic): which of the chosen features each document has."""
    known = frozenset(vocabulary)

    def run(batches):
        for batch in batches:
            found = [[f.decode("latin-1") for f in known & features(t)] for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.string())), *batch.columns[1:]],
                                             names=["found", *HEADS])

    rows = sample.mapInArrow(run, "found array<string>, quality int, toxic int")
    model = CountVectorizerModel.from_vocabulary([f.decode("latin-1") for f in vocabulary],
                                                 inputCol="found", outputCol="x", minTF=1.0, binary=True)
    return stored(model.transform(rows).drop("found"), "vectors")


def text_evidence(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, source, lang, evidence_quality, evidence_toxic) of every row."""
    weight, base = model["weight"], model["base"]
    known = frozenset(weight)

    def run(batches):
        for batch in batches:
            out = np.empty((batch.num_rows, 2))
            for i, text in enumerate(batch.column(3).to_pylist()):
                q, t = base
                for f in known & features(text):
                    a, b = weight[f]
                    q, t = q + a, t + b
                out[i] = q, t
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out[:, 0]), pa.array(out[:, 1])],
                                             names=["doc_id", "source", "lang", "evidence_quality", "evidence_toxic"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["source"], docs["lang"], docs["text"])
    return rows.mapInArrow(run, "doc_id long, source string, lang string, evidence_quality double, evidence_toxic double")


def _strength(groups: DataFrame, n: str, s: str, prior: Column) -> float:
    """Pseudo-counts k of a prior by the method of moments: the spread of the
    groups' rates around ``prior`` beyond what their sizes explain."""
    rate = F.col(s) / F.col(n)
    r = groups.where(F.col(n) > 0).agg(
        F.count("*"), F.sum(n), F.sum(F.col(n) * F.col(n)), F.sum(F.col(n) * (rate - prior) * (rate - prior)),
        F.sum(F.col(n) * prior * (1 - prior))).first()
    if not r[0] or r[0] < 2 or not r[4]:
        return 1e6
    inside = r[4] / r[1]  # mean binomial variance
    between = (r[3] - (r[0] - 1) * inside) / (r[1] - r[2] / r[1])
    return min(1e6, max(1.0, inside / between - 1)) if between > 0 else 1e6


def site_rates(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict]:
    """((source, lang, rate_quality, rate_toxic, host_quality, host_toxic, n_labelled), global rates)."""
    d = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["source"], docs["lang"])
    seen = d.join(one_label(labels), "doc_id", "left")
    sums = []
    for h in HEADS:
        sums += [F.count(h).cast("double").alias(f"n_{h}"), F.sum(F.coalesce(h, F.lit(0))).cast("double").alias(f"s_{h}")]
    path = stored(seen.groupBy("source", "lang").agg(*sums), "paths")
    names = [f"{x}_{h}" for h in HEADS for x in "ns"]
    host = stored(path.groupBy("source").agg(*[F.sum(c).alias(c) for c in names]), "hosts")
    total = host.agg(*[F.sum(c).alias(c) for c in names]).first()
    world = {}
    for h in HEADS:
        n, s = total[f"n_{h}"] or 0.0, total[f"s_{h}"] or 0.0
        world[h] = (s + 0.5) / (n + 1.0)
        k = _strength(host, f"n_{h}", f"s_{h}", F.lit(world[h]))
        host = host.withColumn(f"host_{h}", (F.col(f"s_{h}") + k * world[h]) / (F.col(f"n_{h}") + k))
    hosts = host.select(F.col("source").alias("source_h"), *[f"host_{h}" for h in HEADS])
    out = stored(path.join(hosts, F.col("source").eqNullSafe(F.col("source_h"))).drop("source_h"), "paths")
    rated = out
    for h in HEADS:
        k = _strength(out, f"n_{h}", f"s_{h}", F.col(f"host_{h}"))
        rated = rated.withColumn(f"rate_{h}", (F.col(f"s_{h}") + k * F.col(f"host_{h}")) / (F.col(f"n_{h}") + k))
    return rated.select("source", "lang", *[f"rate_{h}" for h in HEADS], *[f"host_{h}" for h in HEADS],
                        F.col("n_quality").cast("long").alias("n_labelled")), world


def classify(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN,
             broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(doc_id, evidence, site rates, p_quality, p_toxic, kept) of every row of
    ``docs`` (doc_id, text, source, lang): kept if rather good and rather not toxic."""
    model = fit_text(stored(sample_labelled(docs, labels, max_train), "train"))
    sites, _ = site_rates(docs, labels)
    sites = stored(sites.withColumnRenamed("source", "source_s").withColumnRenamed("lang", "lang_s"), "sites")
    if sites.limit(broadcast_rows + 1).count() <= broadcast_rows:
        sites = F.broadcast(sites)
    rows = text_evidence(docs, model).join(
        sites, F.col("source").eqNullSafe(F.col("source_s")) & F.col("lang").eqNullSafe(F.col("lang_s")))
    p = {}
    for h in HEADS:
        odds = F.log(F.col(f"rate_{h}")) - F.log1p(-F.col(f"rate_{h}")) + F.col(f"evidence_{h}")
        p[h] = 1 / (1 + F.exp(-odds))
    rows = rows.select("doc_id", *[f"evidence_{h}" for h in HEADS], *[f"rate_{h}" for h in HEADS],
                       *[p[h].alias(f"p_{h}") for h in HEADS])
    return rows.withColumn("kept", (F.col("p_quality") >= 0.5) & (F.col("p_toxic") < 0.5))


def op4_quality(spark, sf_dir) -> DataFrame:
    return classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
