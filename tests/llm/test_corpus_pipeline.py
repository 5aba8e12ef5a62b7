"""The stages against brute force, and on odd rows."""
import brute
import corpus_pipeline as cp
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidewater.llm.queries import QUERIES


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for name, stage in cp.STAGES:
        docs = cp.materialize(stage(spark, docs, sf_dir), "test-stage")
        out.append(docs)
    return out


def test_registered(spark):
    names = entry.queries()
    assert "pipeline" in names and {f"op{n}_" for n in range(1, 14)} == {n.split("_")[0] + "_" for n in names if n.startswith("op")}
    assert all(hasattr(entry, f) for f in ("entry", "oracle_sql"))


def test_all_but_the_last_keep_the_columns(stages):
    assert all(d.schema.simpleString() == stages[0].schema.simpleString() for d in stages[:-1])


def test_near_duplicates_leave_one_of_each_group(stages):
    rows = sorted((r.doc_id, r.text) for r in stages[1].collect())
    group = brute.grouped(len(rows), brute.near([brute.simhash(t) for _, t in rows], 2))
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted({rows[g][0] for g in group})


def test_repeats_are_cut(stages):
    rows = [(r.doc_id, r.text) for r in stages[2].collect()]
    want = {k: v[3].decode(errors="ignore") for (k, _), v in zip(rows, brute.suffix_dedup(rows, 100))}
    assert {r.doc_id: r.text for r in stages[3].collect()} == want
    assert all(r.n_chars == len(r.text) for r in stages[3].collect())


def test_mix_repeats_whole_documents(stages):
    before, after = stages[3].count(), stages[4]
    assert after.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3
    assert after.join(stages[3], after.columns, "left_anti").count() == 0 and before > 0


def test_tokens_decode(stages):
    assert stages[5].where("not parity or not round_trip").count() == 0 and stages[5].count() == stages[4].count()


def test_toxicity_drops_what_the_operator_rejects(spark):
    sf_dir = "/root/testdata/sf0.01"
    scored = {r.doc_id: r.predicted for r in QUERIES["op9_compression_toxicity"](spark, sf_dir).collect()}
    kept = {r.doc_id for r in cp.drop_toxic(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir).select("doc_id").collect()}
    assert kept == {i for i, p in scored.items() if not p} and 0 < len(kept) < len(scored)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect() if r.doc_id in scored}
    lost = {k: [i not in kept for i, t in labels.items() if t == k] for k in (0, 1)}
    assert sum(lost[0]) <= 0.02 * len(lost[0]) and sum(lost[1]) >= 0.3 * len(lost[1])


def test_odd_rows(spark, sf_dir, odd_docs, no_docs):
    for name, stage in cp.STAGES:
        assert stage(spark, no_docs, sf_dir).count() == 0, name
        out = stage(spark, odd_docs, sf_dir)
        if name != "tokens":
            assert out.columns == odd_docs.columns, name
        assert out.count() > 0, name
    once = cp.drop_near_duplicates(spark, odd_docs, sf_dir)
    rows = sorted({(r.doc_id is None, r.doc_id or 0, r.text or "") for r in odd_docs.select("doc_id", "text").collect()})
    group = brute.grouped(len(rows), brute.near([brute.simhash(t) for _, _, t in rows], 2))
    firsts = sorted(min(r for r, g in zip(rows, group) if g == k) for k in set(group))  # ids first, then rows without one
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in once.collect() if r.doc_id is not None) == [f for f in firsts if not f[0]]
    assert sum(r.doc_id is None for r in once.collect()) == sum(f[0] for f in firsts)
    assert cp.cut_repeats(spark, odd_docs, sf_dir).where("text is null").count() == odd_docs.where("text is null").count()


def test_near_duplicates_keep_unlinked_texts_of_one_id(spark, sf_dir):
    one, other, third = (" ".join(f"{k}{i}" for i in range(60)) for k in "abc")
    docs = spark.createDataFrame([(1, one), (1, other), (1, other), (2, one), (3, third), (3, other)], "doc_id long, text string")
    got = sorted((r.doc_id, r.text) for r in cp.drop_near_duplicates(spark, docs, sf_dir).collect())
    assert got == [(1, one), (1, other), (3, third)]
