"""Registered queries against their SQL, or the operators they are thin covers of; the pipeline stage by stage."""

import hashlib

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm import helpers
from tests.llm.test_near_dup import brute as near_brute
from tests.llm.test_pii import brute as pii_brute
from tests.oracle import compare, connect
from tillwright.llm import catalog


@pytest.fixture(scope="module")
def sql():
    return connect(helpers.SF)


@pytest.mark.parametrize("name", sorted(catalog.statements()))
def test_equals_sql(spark, sql, name):
    assert compare(spark, sql, helpers.SF, name) is None


def rows(spark, name):
    return catalog.registered()[name](spark, helpers.SF).collect()


def test_registration():
    assert {f"op{n}" for n in range(1, 14)} <= {q.split("_")[0] for q in entry.queries()}
    assert "pipeline" in entry.queries()


def test_whole_tables(spark):
    documents = {r["doc_id"]: r for r in helpers.sample_table(spark, "documents").collect()}
    for name in ("op1_mixing", "op3_token_counts", "op5_near_dedup", "op6_pii", "op10_language_id", "op11_bpe", "op12_merkle_manifest", "op13_periodic_runs"):
        assert sorted(r["doc_id"] for r in rows(spark, name)) == sorted(documents), name
    assert len(rows(spark, "op4_html_extraction")) == helpers.sample_table(spark, "pages").count()


def test_pii_digest(spark):
    texts = {r["doc_id"]: r["text"] for r in helpers.sample_table(spark, "documents").collect()}
    for r in rows(spark, "op6_pii"):
        spans = [f"{kind}:{start}:{end}" for start, _, kind, end in pii_brute(texts[r["doc_id"]])]
        assert r["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert set(spans) <= set(r["spans"].split(",") if r["spans"] else [])
        assert r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"] == len(spans)


def test_near_dedup_classes(spark):
    table = [(r["doc_id"], r["text"]) for r in helpers.sample_table(spark, "documents").collect()]
    found = {}
    for r in rows(spark, "op5_near_dedup"):
        found.setdefault(r["class_id"], []).append(r["doc_id"])
        assert r["class_id"] <= r["doc_id"]
    assert sorted(sorted(g, key=str) for g in found.values()) == near_brute(table)


def test_stages(spark, docs):
    prose = helpers.prose
    items = [r["text"] for r in helpers.sample_table(spark, "benchmark").collect()]
    english = [r["text"] for r in helpers.sample_table(spark, "documents").collect() if r["lang"] == "en" and len(r["text"]) > 500]
    text = english[0]
    kept = {n: f"{text} {prose(n, 120, 9000)}" for n in range(4)}
    table = [(n, t, "en", "s1") for n, t in kept.items()]
    table += [(10, kept[0], "en", "s2"), (11, helpers.edited(kept[1], 1, 2), "en", "s2"), (12, "and so " + items[0], "en", "s2")]
    table += [(20, None, None, None), (21, "", "en", "s1"), (22, "12 34 !", "en", "s1")]
    frame = docs(table)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame, helpers.SF)
        assert out.columns == corpus_pipeline.COLUMNS, name
        frame = spark.createDataFrame(out.collect(), out.schema)
    final = corpus_pipeline.STAGES[-1][1](spark, frame, helpers.SF).collect()
    ids = {r["doc_id"] for r in final}
    assert ids & {2, 3} == {2, 3} and len(ids & {0, 10}) == 1 and len(ids & {1, 11}) == 1 and not ids & {12, 20, 21, 22}
    assert [s for s, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "mixing"]


def test_stages_on_an_empty_table(spark, docs):
    frame = docs([])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame, helpers.SF)
        assert out.columns == corpus_pipeline.COLUMNS
        frame = spark.createDataFrame(out.collect(), out.schema)
    assert corpus_pipeline.STAGES[-1][1](spark, frame, helpers.SF).count() == 0


def test_run_is_its_stages(spark):
    ids = [r["doc_id"] for r in corpus_pipeline.run(spark, helpers.SF).collect()]
    assert len(ids) == len(set(ids)) > 100
