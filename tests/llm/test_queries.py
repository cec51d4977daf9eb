"""The registered queries on the smallest tables: columns, SQL where it states the result, and the pipeline's stages."""

import duckdb
import pytest

import corpus_pipeline
from towerlens.llm.common import read
from towerlens.llm.queries import ORACLE, QUERIES

from ..test_entry import canon

SF = "/root/testdata/sf0.001"

COLUMNS = {
    1: ["doc_id", "held_out", "score", "predicted"],
    2: ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    3: ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    4: ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    5: ["doc_id", "held_out", "score", "predicted"],
    6: ["doc_id", "start", "n_tokens", "ids_crc32"],
    7: ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    8: ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    9: ["doc_id", "fingerprint", "component_id"],
    10: ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
}


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == sorted(COLUMNS)
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns_and_rows(spark, name):
    df = QUERIES[name](spark, SF)
    wanted = COLUMNS[int(name[2:].split("_")[0])]
    assert [c for c in df.columns if c in wanted] == wanted
    rows = df.count()
    assert rows == 200 if not name.startswith("op10") else rows >= 200


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got, want = QUERIES[name](spark, SF).toArrow(), con.sql(ORACLE[name]).to_arrow_table()
    assert {f.name: str(f.type) for f in got.schema} == {f.name: str(f.type) for f in want.schema}
    assert canon(got.to_pandas()) == canon(want.to_pandas())


def test_stages_keep_columns_on_edge_rows(spark, edge_docs, no_docs):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for docs in (edge_docs, no_docs):
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns, name
            assert out.count() <= docs.count()
    for docs in (edge_docs, no_docs):
        assert (corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() > 0) == (docs is edge_docs)


def test_pipeline_equals_its_operators_one_by_one(spark):
    """Each stage's decisions, taken from its operator's query form, lead to the pipeline's rows."""
    from towerlens.llm.exact_dedup import exact_groups
    from towerlens.llm.simhash import near_duplicates
    from towerlens.llm.toxicity import toxicity_scores
    from towerlens.llm.winnowing import contamination
    docs = read(spark, SF, "documents").select("doc_id", "text")
    clean = {r.doc_id for r in toxicity_scores(docs, read(spark, SF, "labels")).where("score < 0.5").collect()}
    docs = docs.where(docs.doc_id.isin(clean))
    kept = {r.doc_id for r in exact_groups(docs).where("kept").collect()}
    docs = docs.where(docs.doc_id.isin(kept))
    heads = {r.doc_id for r in near_duplicates(docs).where("doc_id = component_id").collect()}
    docs = docs.where(docs.doc_id.isin(heads))
    judged, column = contamination(docs, read(spark, SF, "benchmark"))
    left = {r.doc_id for r in judged.where(f"size({column}.hit_words) = 0").collect()}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in got} == left and 0 < len(left) < 200
    assert sum(r.length for r in got if r.start == 0) > 0
    per_doc = {}
    for r in got:
        per_doc[r.doc_id] = per_doc.get(r.doc_id, 0) + r.length
        assert r.doc_tokens >= r.start + r.length
    assert all(per_doc[r.doc_id] == r.doc_tokens for r in got)
