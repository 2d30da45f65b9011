"""Registered queries against SQL where they have it, and the pipeline stage by stage."""

import corpus_pipeline
import duckdb
import pytest
from sievework.llm import mixing, simhash, suffix_dedup
from sievework.llm.common import documents, written
from sievework.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"


def test_each_operator_has_its_query():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "embeddings"):
        duck.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    expected = duck.sql(ORACLES[name])
    found = QUERIES[name](spark, SF)
    assert sorted(found.columns) == sorted(expected.columns)
    assert sorted(map(tuple, found.select(expected.columns).collect()), key=repr) == sorted(expected.fetchall(), key=repr)


def test_pipeline_stage_by_stage(spark):
    """Each stage on its own input: what it keeps, and that its decisions take effect."""
    from test_simhash import plain_fingerprint, plain_groups
    from test_suffix_dedup import plain

    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    docs, before = documents(spark, SF), None
    for name, stage in corpus_pipeline.STAGES:
        given = {r["doc_id"]: r["text"] for r in docs.collect()} if name != "packed" else docs.collect()
        columns = docs.columns
        docs = written(stage(spark, docs, SF), name)
        rows = docs.collect()
        if name != "packed":
            assert docs.columns == columns
        if name == "quality":
            ids = {r["doc_id"] for r in rows}
            assert all((labels[i] == 1) == (i in ids) for i in given if i in labels)
        elif name == "near_copies":
            prints = [(i, plain_fingerprint(t)) for i, t in given.items()]
            assert sorted(r["doc_id"] for r in rows) == sorted({g for g in plain_groups(prints)})
            assert all(r["text"] == given[r["doc_id"]] for r in rows)
        elif name == "repeated_passages":
            expected = dict(zip(given, plain(list(given.values()), suffix_dedup.LENGTH)))
            assert len(rows) == len(given)
            for r in rows:
                size, gone, *_ = expected[r["doc_id"]]
                assert abs(len(r["text"].encode()) - (size - gone)) <= 8 and r["n_chars"] == len(r["text"])
        elif name == "source_mix":
            words = {r["row"]["doc_id"]: r["taken"] for r in mixing.mix(before).collect()}
            got = {}
            for r in rows:
                got[r["doc_id"]] = got.get(r["doc_id"], 0) + len(r["text"].encode().split())
            assert got == {i: n for i, n in words.items() if n}
        else:
            assert sum(r["n_tokens"] for r in rows) == sum(len(r["text"].encode().split()) + 1 for r in given)
        before = docs


def test_the_stages_share_one_pass_from_end_to_end(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "repeated_passages", "source_mix", "packed"]
    assert corpus_pipeline.ORACLE_SQL is None
    assert simhash.RADIUS == 2
