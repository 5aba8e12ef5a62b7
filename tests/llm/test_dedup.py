"""Exact and near dedup operators against brute force, and their behaviour on odd rows."""
import random

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewater.llm.multi_index import embedding_groups, visits
from tidewater.llm.pieces import find_pieces, sliding
from tidewater.llm.queries import QUERIES
from tidewater.llm.simhash_vp import fit_tree, leaves_of, link_shard, simhash_groups
from tidewater.llm.substring_dedup import substring_dedup
from tidewater.llm.suffix_array import permuted_common_prefixes, suffix_array
from tidewater.llm.suffix_dedup import chosen_pieces, shard_repeats, suffix_dedup


def _texts(spark, sf_dir):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]


def test_substring_query_equals_brute_force(spark, sf_dir):
    rows = _texts(spark, sf_dir)
    want = {key: (n, r, brute.sha(kept)) for (key, _), (n, r, kept) in zip(rows, brute.substring_dedup(rows, 50))}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op1_substring_dedup"](spark, sf_dir).collect()}
    assert got == want and sum(v[1] for v in want.values()) > 0


def test_suffix_query_equals_brute_force(spark, sf_dir):
    rows = _texts(spark, sf_dir)
    want = {key: (n, r, s, brute.sha(kept)) for (key, _), (n, r, s, kept) in zip(rows, brute.suffix_dedup(rows, 100))}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op3_suffix_array_dedup"](spark, sf_dir).collect()}
    assert got == want and sum(v[1] for v in want.values()) > 0


def test_simhash_query_equals_brute_force(spark, sf_dir):
    rows = sorted(_texts(spark, sf_dir))
    prints = [brute.simhash(t) for _, t in rows]
    group = brute.grouped(len(rows), brute.near(prints, 2))
    want = {key: (f"{p:016x}", rows[g][0]) for (key, _), p, g in zip(rows, prints, group)}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op7_simhash_near_dedup"](spark, sf_dir).collect()}
    assert got == want


def test_crowded_anchors_are_split_without_change(spark, monkeypatch):
    import tidewater.llm.suffix_dedup as sd
    rng = random.Random(9)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage, line = noise(150), noise(60)
    rows = [(i, noise(80) + (passage if i % 2 else line) + noise(70 + i)) for i in range(40)] + [(90, passage[:120]), (91, noise(30) + passage[20:] + line)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = {k: w for (k, _), w in zip(rows, brute.suffix_dedup(rows, 100))}
    for crowd in (sd.CROWD, 5, 1):
        monkeypatch.setattr(sd, "CROWD", crowd)
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup(df).collect()}
        assert got == want


def test_only_chosen_places_reach_a_shard(spark, sf_dir, monkeypatch):
    import pyarrow as pa

    import tidewater.llm.suffix_dedup as sd
    rows = [(1, 1, 5, None), (1, 1, 5, b"a"), (1, 1, 5, b"a"), (1, 2, 5, b"a"), (1, 3, 5, None), (2, 1, 5, b"b"), (2, 3, 5, None), (2, 3, 5, b"c")]
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*part)], ["anchor", "doc", "at", "piece"]) for part in (rows[:1], rows[1:5], rows[5:])]
    assert list(chosen_pieces(batches)) == [(1, 1, 5, b"a"), (2, 3, 5, b"c")]
    real, filled = sd.build_sketch, []

    def full_sketch(*args, least=2):
        out = real(*args, least=least)
        if least == 1:
            filled.append(out.fill(255))  # every place gets through
        return out

    monkeypatch.setattr(sd, "build_sketch", full_sketch)
    texts = _texts(spark, sf_dir)
    want = sorted((key, n, r, s, kept) for (key, _), (n, r, s, kept) in zip(texts, brute.suffix_dedup(texts, 100)))
    for crowd in (sd.CROWD, 2):
        monkeypatch.setattr(sd, "CROWD", crowd)
        got = suffix_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
        assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got.collect()) == want
    assert len(filled) >= 3


def test_periodic_and_overlapping_texts(spark):
    rng = random.Random(3)
    rows = [(1, "a" * 1000), (2, "ab" * 400), (3, None), (4, ""), (5, "x" * 99), (6, "x" * 100), (7, "y" + "x" * 100),
            (8, ("abc" * 60 + "d") * 5), (9, "".join(rng.choice("ab") for _ in range(3000)) * 2), (10, "é" * 300)]
    out = suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out.collect()}
    assert got == {k: w for (k, _), w in zip(rows, brute.suffix_dedup(rows, 100))}
    words = [(1, "a " * 200), (2, "a " * 60), (3, "b " + "a " * 49), (4, "b " + "a " * 49 + "c"), (5, " ".join("ab"[i % 2] for i in range(150)))]
    out = substring_dedup(spark.createDataFrame(words, "doc_id long, text string"))
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in out.collect()}
    assert got == {k: w for (k, _), w in zip(words, brute.substring_dedup(words, 50))}


def test_odd_rows(spark, odd_docs, no_docs):
    for op in (substring_dedup, suffix_dedup, simhash_groups):
        assert op(no_docs).count() == 0
        assert op(odd_docs).count() == odd_docs.count()
    kept = [(r.doc_id, r.n_removed) for r in substring_dedup(odd_docs).collect()]
    assert (1, 0) in kept and (2, 70) in kept and (None, 70) in kept and kept.count((6, 0)) == 2
    cut = sorted(r.n_removed for r in suffix_dedup(odd_docs).where("doc_id is null").collect())
    assert cut[:2] == [0, 0] and cut[2] > 200
    groups = {(r.doc_id, r.component_id) for r in simhash_groups(odd_docs).collect()}
    assert {(3, 3), (4, 3), (10, 3), (None, 3), (6, 5), (9, 8), (None, None)} <= groups


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=1, max_size=300), st.integers(1, 4))
def test_suffix_array_and_prefixes(data, kinds):
    b = bytes(97 + x % kinds for x in data) * 2
    t = np.frombuffer(b, dtype=np.uint8)
    order = suffix_array(t.astype(np.int32), 256)
    assert order.tolist() == sorted(range(len(b)), key=lambda i: b[i:])
    before, common = permuted_common_prefixes(t, order)
    for a, i in zip(order[:-1].tolist(), order[1:].tolist()):
        n = next((k for k in range(len(b)) if b[a + k:a + k + 1] != b[i + k:i + k + 1] or max(a, i) + k >= len(b)), 0)
        assert before[i] == a and common[i] == n


def test_suffix_array_recursion_levels():
    rng = np.random.default_rng(5)
    b = bytes(rng.integers(97, 100, 60_000, dtype=np.uint8)) * 2
    order = suffix_array(np.frombuffer(b, dtype=np.uint8).astype(np.int32), 256)
    assert (np.sort(order) == np.arange(len(b))).all()
    step = range(0, len(b) - 1, 997)
    assert all(b[order[i]:order[i] + 200_000] < b[order[i + 1]:order[i + 1] + 200_000] for i in step)


def test_shard_repeats_marks_all_but_the_first():
    docs, ats = np.array([5, 3, 3]), np.array([0, 10, 500])
    a, b = bytes(range(60)) + b"q" * 5, b"z" + bytes(range(60))
    found = shard_repeats([a, b, bytes(range(60))], docs, ats, 50)
    assert sorted(zip(*(f.tolist() for f in found))) == [(3, 500, 60), (5, 0, 60)]


def test_pieces_cover_every_window_once():
    rng = np.random.default_rng(1)
    symbols = rng.integers(0, 3, 500, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    ends = np.array([5, 130, 131, 500])
    p = find_pieces(symbols, ends, 20, 8)
    covered = sorted(i for s, n in zip(p.start.tolist(), p.count.tolist()) for i in range(s, s + n))
    assert covered == [i for lo, hi in ((5, 130), (131, 500)) for i in range(lo, hi - 19)]
    low = sliding(p.rolling.fixed(8), 13, np.minimum)
    assert all((low[s:s + n] == a).all() for s, n, a in zip(p.start, p.count, p.anchor))
    assert find_pieces(symbols, np.array([10, 20]), 30, 8) is None


def test_shards_lose_no_link():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 1500, dtype=np.uint64)
    flip = lambda x: x ^ (np.uint64(1) << rng.integers(0, 64, len(x)).astype(np.uint64))
    x = np.unique(np.concatenate((base, flip(base), flip(flip(base[:700])), flip(flip(np.full(900, base[0]))))))
    nodes = fit_tree(x[rng.permutation(len(x))][:2000], 5)
    leaf, idx = leaves_of(nodes, x, 1)
    together = {i: set(leaf[idx == i].tolist()) for i in range(len(x))}
    pairs = brute.near(x, 2)
    assert pairs and all(together[a] & together[b] for a, b in pairs)
    a, b = link_shard(x, 2)
    assert brute.grouped(len(x), zip(a.tolist(), b.tolist())) == brute.grouped(len(x), pairs)


def test_multi_sequence_visits_nearest_cells_first():
    rng = np.random.default_rng(4)
    x, books = rng.normal(size=(20, 8)), (rng.normal(size=(6, 4)), rng.normal(size=(5, 4)))
    got = visits(x, books, 30)
    for r, cells in zip(x, got):
        cost = [((r[:4] - books[0][c // 5]) ** 2).sum() + ((r[4:] - books[1][c % 5]) ** 2).sum() for c in cells]
        assert sorted(cells) == list(range(30)) and all(a <= b + 1e-9 for a, b in zip(cost, cost[1:]))


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(300, 16))
    hot = np.concatenate([base[:1] + 0.05 * rng.normal(size=(200, 16)), np.repeat(base[1:2], 50, axis=0)])
    x = np.concatenate([base, hot, base[10:60] + 0.1 * rng.normal(size=(50, 16))]).astype(np.float32)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    return x.astype(float), spark.createDataFrame(rows, "vec_id long, embedding array<float>, n_links int")


def test_multi_index_recall_and_exactness(vectors, monkeypatch):
    import tidewater.llm.multi_index as mi
    monkeypatch.setattr(mi, "CROWD", 40)  # crowded cells are split
    x, df = vectors
    u = x / np.linalg.norm(x, axis=1)[:, None]
    linked = [(int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(u @ u.T >= 0.9, 1)))]
    n = np.bincount(np.array(linked).ravel(), minlength=len(x))
    got = sorted(embedding_groups(df).collect())
    assert all(r.n_links <= n[r.vec_id] for r in got) and sum(r.n_links for r in got) >= 0.98 * n.sum()
    group = brute.grouped(len(x), linked)
    assert np.mean([r.component_id == g for r, g in zip(got, group)]) > 0.98
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def _sparse_copies(n, dim, planted, seed=5):
    """Random vectors of which few have a near copy, at cosines of 0.91 to 0.99, and the pairs."""
    rng = np.random.default_rng(seed)
    u = rng.normal(size=(n, dim))
    u /= np.linalg.norm(u, axis=1)[:, None]
    for k in range(planted):
        r = rng.normal(size=dim)
        r -= (r @ u[k]) * u[k]
        c = rng.uniform(0.91, 0.99)
        u[n - 1 - k] = c * u[k] + (1 - c * c) ** 0.5 * r / np.linalg.norm(r)
    return u


def test_multi_index_finds_links_that_no_probe_has(spark, monkeypatch):
    import tidewater.llm.multi_index as mi
    monkeypatch.setattr(mi, "CROWD", 500)  # several shards
    u = _sparse_copies(4000, 32, 40)
    linked = np.triu(u @ u.T >= 0.9, 1)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(u)], "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_groups(df).collect()}
    n = linked.sum(axis=0) + linked.sum(axis=1)
    assert linked.sum() >= 40 and all(got[i][0] == n[i] for i in range(len(u)))
    assert [got[i][1] for i in range(len(u))] == list(brute.grouped(len(u), [(int(a), int(b)) for a, b in zip(*np.nonzero(linked))]))


def test_calibration_takes_probes_alike():
    import tidewater.llm.multi_index as mi
    rows = [(0, 0, 1_000_000), *((p, 9, 1) for p in range(1, 100))]  # one hot probe whose links are near doesn't decide for the others
    assert mi.calibrate(rows, 0.9) == 10
    assert mi.calibrate(rows[:5], 0.9) is None and mi.calibrate([], 0.9) is None
    assert mi.calibrate([(p, mi.MAX_VISITS, 1) for p in range(100)], 0.9) is None


def test_multi_index_odd_vectors(spark):
    a, b = [1.0] * 8 + [2.0] * 8, [3.0] * 16
    rows = [(1, a), (2, [2 * v for v in a]), (3, None), (4, [0.0] * 16), (5, [float("nan")] * 16), (6, [float("inf")] + [1.0] * 15), (7, [None] + [1.0] * 15),
            (8, [1.0]), (None, a), (9, []), (9, []), (10, [-v for v in b]), (11, b), (None, [-v for v in a])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(((r.vec_id if r.vec_id is not None else -1), r.n_links, r.component_id) for r in embedding_groups(df).collect())
    assert got == sorted([(1, 3, 1), (2, 3, 1), (-1, 3, 1), (11, 3, 1), *((i, 0, i) for i in (3, 4, 5, 6, 7, 8, 9, 9)), (10, 1, 10), (-1, 1, 10)])
    assert embedding_groups(df.limit(0)).count() == 0
