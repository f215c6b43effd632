import corpus_pipeline
import pytest
from llm_cases import SCHEMA, no_documents, odd_documents

import __spark_entry__ as entry
from weirflow.llm import decontamination, language, secret_scan, simhash
from weirflow.workspace import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_in_their_order(spark, sf, documents):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_dedup", "decontamination", "secret_scan", "packing"]
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs.count(), materialize(stage(spark, docs, sf), name)
        assert docs.columns == COLUMNS and 0 < docs.count() <= before
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    whole = entry.queries()["pipeline"](spark, sf)
    assert sorted(map(tuple, packed.select(key).collect())) == sorted(map(tuple, whole.select(key).collect()))


def test_each_stage_alone(spark, sf, documents):
    """What a stage drops is what its operator says, and nothing else."""
    stages = dict(corpus_pipeline.STAGES)
    queries = entry.queries()
    all_ids = {r["doc_id"] for r in documents.collect()}
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    groups = queries["op6_simhash"](spark, sf)
    assert ids(stages["near_dedup"](spark, documents, sf)) == ids(groups.filter("doc_id = component_id"))
    bad = ids(queries["op4_decontamination"](spark, sf).filter("contaminated"))
    assert ids(stages["decontamination"](spark, documents, sf)) == all_ids - bad
    und = ids(queries["op9_language"](spark, sf).filter("lang_pred = 'und'"))
    assert ids(stages["language_id"](spark, documents, sf)) == all_ids - und
    clean = ids(queries["op3_secrets"](spark, sf).filter("spans = ''"))
    masked = stages["secret_scan"](spark, documents, sf)
    assert ids(masked) == all_ids
    assert ids(masked.filter("text like '%[secret]%'")) == all_ids - clean


@pytest.mark.parametrize("make", [odd_documents, no_documents])
def test_odd_tables_pass_all_stages(spark, tmp_path, make):
    spark.createDataFrame([(1, "one two")], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))
    docs = make(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, str(tmp_path)), name)
        assert docs.columns == SCHEMA.names
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert packed.count() >= docs.count()
    assert corpus_pipeline.ORACLE_SQL is None


def test_operators_stand_alone():
    for module in (decontamination, language, secret_scan, simhash):
        assert module.__doc__
