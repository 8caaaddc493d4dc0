"""Registered queries against their SQL, and the pipeline against its single stages."""

import corpus_pipeline
import pytest
from checks.compare import connect
from fiberqa.llm.queries import ORACLES, QUERIES
from fiberqa.sources.frames import cut

from ..conftest import DATA


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(sent, name):
    df = QUERIES[name](sent, DATA)
    names = sorted(df.columns)
    got = sorted(tuple(r[c] for c in names) for r in df.collect())
    cursor = connect(DATA).execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == names
    want = sorted(tuple(r[columns.index(c)] for c in names) for r in cursor.fetchall())
    assert got and got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"op2_decontaminate"}))
def test_one_row_for_each_document(sent, name):
    ids = sorted(r[0] for r in QUERIES[name](sent, DATA).select("doc_id").collect())
    assert ids == sorted(r[0] for r in sent.read.parquet(f"{DATA}/documents.parquet").select("doc_id").collect())


def test_pipeline_stages_keep_columns_and_clean_documents(sent):
    docs = sent.read.parquet(f"{DATA}/documents.parquet")
    before = {r["doc_id"] for r in docs.select("doc_id").collect()}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = cut(stage(sent, docs, DATA))
        after = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert after <= before and len(after) > 0.7 * len(before), name
        if name != "encoded":
            assert docs.columns == columns
        before = after
    rows = corpus_pipeline.run(sent, DATA)
    assert {r["doc_id"] for r in rows.collect()} == before


def test_pipeline_decides_each_row(sent):
    """Null, shared and repeated doc_ids."""
    item = sent.read.parquet(f"{DATA}/benchmark.parquet").where("length(text) > 100").first()["text"]
    clean, other = (" ".join(f"{c}{i}" for i in range(40)) for c in "uv")
    rows = [(None, item, "a"), (None, clean, "a"), (5, item, "a"), (5, clean, "a"), (6, other, "a"), (None, None, "a")]
    docs = sent.createDataFrame(rows, "doc_id long, text string, source string")
    got = [tuple(r) for r in corpus_pipeline.decontaminated(sent, docs, DATA).collect()]
    assert sorted(got, key=repr) == sorted([rows[1], rows[3], rows[4], rows[5]], key=repr)

    rows = [(1, clean, "a"), (1, clean, "b"), (1, clean.upper(), "a"), (2, clean, "a"), (2, other, "a"), (3, "", "a"), (None, clean, "a"), (None, clean, "a")]
    docs = sent.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted(((r["doc_id"], (r["text"] or "").lower()) for r in corpus_pipeline.near_duplicates(sent, docs, DATA).collect()), key=repr)
    assert got == sorted([(1, clean), (2, other), (3, ""), (None, clean), (None, clean)], key=repr)


def test_pipeline_stages_on_odd_and_on_no_documents(sent, edge, nothing):
    for docs in (edge, nothing):
        for _, stage in corpus_pipeline.STAGES:
            docs = cut(stage(sent, docs, DATA))
    assert docs.count() == 0
    kept = corpus_pipeline.near_duplicates(sent, edge, DATA).collect()
    assert {r["doc_id"] for r in kept} == {1, 2, 3, 4, 6, 7, 9, 10, None}
