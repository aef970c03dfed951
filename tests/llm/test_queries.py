"""The registered queries and the pipeline, over the smallest tables."""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from harbor.llm import decontaminate, pieces, quality, secrets
from harbor.llm.expected import SQL
from harbor.llm.queries import QUERIES
from harbor.llm.texts import texts_of
from tests.llm.frames import ALL_IDS, ROWS, TABLES, documents, ids_of, needs_tables
from tests.llm.test_near_texts import components_by_hand
from trials.check import canonical, duck

pytestmark = needs_tables


def test_one_query_per_operator():
    names = [n for n in contract.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in contract.queries() and SQL.keys() <= QUERIES.keys()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_against_sql(spark, name):
    frame = QUERIES[name](spark, TABLES)
    got = pd.DataFrame(frame.collect(), columns=frame.columns)
    with duck(TABLES) as connection:
        result = connection.execute(SQL[name])
        want = pd.DataFrame(result.fetchall(), columns=[d[0] for d in result.description])
    assert len(got) and sorted(got.columns) == sorted(want.columns)
    pd.testing.assert_frame_equal(canonical(got), canonical(want))


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - SQL.keys()))
def test_query_runs_over_its_whole_table(spark, name):
    frame = QUERIES[name](spark, TABLES)
    n = frame.count()
    if name.startswith("op1_"):
        assert n > 0
    elif name.startswith("op11_"):
        assert n == 32 * spark.read.parquet(f"{TABLES}/embeddings.parquet").count()
    else:
        key = frame.columns[0]
        source = {"page_id": "pages", "doc_id": "documents"}[key]
        assert n == spark.read.parquet(f"{TABLES}/{source}.parquet").count()


def stages_by_hand(spark, docs):
    """The stages' decisions, from the operators' reports rather than their filters."""
    report = {r.doc_id for r in quality.quality_report(docs).where("kept").collect()}
    docs = docs.where(docs.doc_id.isin(*report))
    first = set(components_by_hand([(r.doc_id, r.text) for r in docs.collect()]).values())
    docs = docs.where(docs.doc_id.isin(*first))
    bench = spark.read.parquet(f"{TABLES}/benchmark.parquet")
    leaking = {r.doc_id for r in decontaminate.leaks(docs, bench).collect()}
    rows = [r for r in docs.collect() if r.doc_id not in leaking]
    spans = secrets.scan_texts(texts_of(pa.array([r.text for r in rows])))
    return {r.doc_id: secrets.mask(r.text, spans.get(i, [])) for i, r in enumerate(rows)}


def test_pipeline(spark):
    done = corpus_pipeline.run(spark, TABLES)
    want = stages_by_hand(spark, spark.read.parquet(f"{TABLES}/documents.parquet"))
    assert done.where("not decoded").count() == 0
    got = {r.doc_id: r.text for r in pieces.decode(done.select("doc_id", "ids")).collect()}
    assert got == want and 0 < len(got) < 200


def test_stages_on_awkward_documents(spark):
    docs = documents(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, TABLES)
        assert found.columns == docs.columns, name
        assert set(ids_of(found)) <= set(ALL_IDS)
        assert stage(spark, docs.limit(0), TABLES).count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, TABLES)
    assert last.count() == len(ROWS)
