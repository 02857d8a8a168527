import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pixelframe.llm import decontaminate, lines, mixing, rules, simhash
from pixelframe.llm.base import read_table, stored

SF_SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "simhash_near_dedup", "decontamination", "mixing"]
    docs = read_table(spark, SF_SMALL, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, SF_SMALL), name)
        if name == "quality_rules":
            good = {r.doc_id for r in rules.judge(docs).where("kept").collect()}
            assert {r.doc_id for r in out.collect()} == good
        elif name == "line_dedup":
            want = {r.doc_id: r.text for r in lines.dedup(docs).collect()}
            assert {r.doc_id: r.text for r in out.collect()} == want
            assert out.where("n_chars <> length(text)").count() == 0
        elif name == "simhash_near_dedup":
            groups = simhash.near_duplicates(docs)
            assert {r.doc_id for r in out.collect()} == {r.component_id for r in groups.collect()}
        elif name == "decontamination":
            clean = decontaminate.contamination(docs, read_table(spark, SF_SMALL, "benchmark")).where("not contaminated")
            assert {r.doc_id for r in out.collect()} == {r.doc_id for r in clean.collect()}
        else:
            taken = {r.doc_id: r.copies for r in mixing.mix(docs).where("copies > 0").collect()}
            got = {r.doc_id: r["n"] for r in out.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
            assert sum(got.values()) == pytest.approx(sum(taken.values()), rel=0.1)
            assert out.columns == [*columns, "mix_copy"]
        if name != "mixing":
            assert out.columns == columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
        docs = out


@pytest.mark.parametrize("k", range(5))
def test_stage_on_odd_rows(spark, docs, no_docs, k):
    name, stage = corpus_pipeline.STAGES[k]
    wide = docs.withColumn("kept", F.lit("x")).withColumn("copies", F.lit(1)).withColumn("key", F.lit(2))
    out = stage(spark, wide, SF_SMALL)
    assert out.columns[:len(wide.columns)] == wide.columns
    assert out.count() > 0
    assert stage(spark, no_docs, SF_SMALL).count() == 0
