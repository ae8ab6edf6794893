"""The pipeline, stage by stage, against what each stage must keep."""

from __future__ import annotations

import corpus_pipeline
from lavra.llm import pieces
from lavra.llm.common import table
from pyspark.sql import functions as F
from test_methods import plain_components

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    steps = [docs]
    for name, function in corpus_pipeline.STAGES:
        step = function(spark, steps[-1], SF)
        steps.append(step.cache())
    raw, good, one, masked, mixed, encoded = steps
    for step in steps[1:5]:
        assert step.schema.names == docs.schema.names
    text = {i: {r["doc_id"]: r["text"] for r in s.collect()} for i, s in enumerate(steps[:5])}
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    # trusted text stays
    assert {i for i in text[0] if labels.get(i) == 1} <= set(text[1])
    assert len(text[1]) < len(text[0])
    # the smallest id of each component stays
    assert set(text[2]) == {root for _, root in plain_components(text[1]).values()}
    # every document stays, with no key-value secret left
    assert set(text[3]) == set(text[2])
    assert masked.where(F.lower("text").rlike('token = "[0-9a-f]{40}"')).count() == 0
    assert masked.where(F.length("text") != F.col("n_chars")).count() == 0
    # sources only repeat
    assert set(text[4]) == set(text[3])
    assert encoded.count() == mixed.count()
    back = encoded.withColumn("text", pieces.decode(spark, F.col("ids"))).select("doc_id", "text").collect()
    assert {r["doc_id"]: r["text"] for r in back} == text[4]


def test_run_gives_the_rows_of_the_stages(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "lang", "source", "n_tokens", "ids"]
    assert out.where("n_tokens <> size(ids)").count() == 0 and out.count() > 0


def test_rows_without_id_and_copies(spark):
    docs = table(spark, SF, "documents").limit(0)
    text = "a lone text of more than five words that nobody else has"
    rows = [(None, text, "en", "s", 1), (None, text, "en", "s", 1), (4, text, "en", "s", 1), (4, text, "en", "s", 1), (9, text, "en", "s", 1)]
    odd = spark.createDataFrame(rows, docs.schema)
    kept = corpus_pipeline.one_of_each(spark, odd, SF)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["4", "None", "None"]
