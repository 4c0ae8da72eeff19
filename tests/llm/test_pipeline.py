import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline as cp  # noqa: E402

from isobar.llm import langid, mixing, packing, quality_bayes, simhash  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def short_training(monkeypatch):
    monkeypatch.setattr(langid, "STEPS", 120)


def test_registered():
    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1


def test_stages_act_on_what_was_kept(spark, workdir):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    before = docs
    for i, (name, stage) in enumerate(cp.STAGES):
        out = stage(spark, before, SF)
        out.write.parquet(f"{workdir}/{i}")
        after = spark.read.parquet(f"{workdir}/{i}")
        ids = {r.doc_id for r in before.collect()}
        got = [r.doc_id for r in after.collect()]
        assert set(got) <= ids
        if i < 4:
            assert after.columns == docs.columns and after.join(docs, docs.columns, "left_anti").count() == 0
        if name == "quality classifier":
            want = quality_bayes.classify(before, labels, F.col("source"), F.col("lang")).filter("kept")
            assert sorted(got) == sorted(r.doc_id for r in want.collect()) and len(got) < len(ids)
        elif name == "language ID":
            want = langid.report(before).filter("lang_pred <> 'und' and score >= 0.35")
            assert sorted(got) == sorted(r.doc_id for r in want.collect())
        elif name == "SimHash near-dedup":
            want = simhash.report(before).filter("doc_id = component_id")
            assert sorted(got) == sorted(r.doc_id for r in want.collect()) and len(got) < len(ids)
        elif name == "mixing":
            want = [r.doc_id for r in mixing.mix_report(before).collect() for _ in range(r.copies)]
            assert sorted(got) == sorted(want)
        else:
            want = packing.packed(before)
            key = ["doc_id", "start", "length", "ids_crc32", "sequence_id", "offset"]
            assert sorted(map(tuple, after.select(key).collect())) == sorted(map(tuple, want.select(key).collect()))
        before = after
    whole = cp.run(spark, SF)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, before.collect()))


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_awkward_rows(spark, edge, empty, stage):
    fn = cp.STAGES[stage][1]
    fn(spark, edge, SF).count()
    assert fn(spark, empty, SF).count() == 0
