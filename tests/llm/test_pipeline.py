"""The corpus pipeline, stage by stage, against the operators' own results."""

import corpus_pipeline
from conftest import SF001

from tidewater.llm import queries
from tidewater.llm.shared import written

SF = SF001.replace("0.001", "0.01")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, docs
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "simhash", "decontaminate", "mixing", "sharding"]

    after = written(stages["toxicity"](spark, kept, SF), "t")
    toxic = {r.doc_id for r in queries.op4_toxicity(spark, SF).where("predicted = 1").collect()}
    assert after.columns == columns and {r.doc_id for r in after.collect()} == {r.doc_id for r in docs.collect()} - toxic

    before, after = after, written(stages["simhash"](spark, after, SF), "s")
    from tidewater.llm import simhash
    keep = {r.doc_id for r in simhash.near_duplicates(before).collect() if r.doc_id == r.component_id}
    assert after.columns == columns and sorted(r.doc_id for r in after.collect()) == sorted(keep)

    before, after = after, written(stages["decontaminate"](spark, after, SF), "d")
    leaks = {r.doc_id for r in queries.op8_decontaminate(spark, SF).where("contaminated").collect()}
    assert after.columns == columns and {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()} - leaks

    before, after = after, written(stages["mixing"](spark, after, SF), "m")
    assert after.columns == columns
    rows = {r.doc_id: r.n for r in after.groupBy("doc_id").count().withColumnRenamed("count", "n").collect()}
    assert set(rows) <= {r.doc_id for r in before.collect()} and max(rows.values()) >= 2

    shards = stages["sharding"](spark, after, SF)
    assert shards.count() == after.count()


def test_run(spark):
    assert corpus_pipeline.run(spark, SF001).count() > 0


CLASHES = "doc_id long, text string, lang string, source string, n_chars long, mixture string, toxicity int, contamination string, copy int, member string, spot int, kept_id long"


def test_stages_keep_nulls_empties_repeats_and_clashing_columns(spark):
    """Every stage on odd rows: all but the last return the columns of documents, with their values."""
    texts = [None, "", "   ", "one short text", "a clean text of its own, that no other row has"]
    rows = [(i if i else None, t, "en", "s", 1, "mine", 7, "mine", 7, "mine", 7, 7) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3]]
    stages = dict(corpus_pipeline.STAGES)
    for name in ("toxicity", "simhash", "decontaminate", "mixing"):
        docs = spark.createDataFrame(rows, CLASHES)
        kept = stages[name](spark, docs, SF001)
        assert kept.columns == docs.columns
        found = kept.collect()
        assert {tuple(r) for r in found} <= set(rows) and all((r.mixture, r.toxicity, r.spot) == ("mine", 7, 7) for r in found)
        if name in ("toxicity", "decontaminate"):
            assert len(found) == len(rows)
        if name == "simhash":
            # no shingle: one group, of which the row without an id is no representative
            assert sorted(r.doc_id for r in found) == [1, 3, 4]
        assert stages[name](spark, docs.limit(0), SF001).count() == 0
    assert stages["sharding"](spark, spark.createDataFrame(rows, CLASHES), SF001).count() == len(rows)
