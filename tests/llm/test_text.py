"""Mixing, tokenising, fingerprints, scoring, toxicity and extraction."""
import hashlib
import math
import random
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidewater.llm.brown_lm import brown_scores, exchange
from tidewater.llm.imatch import fingerprint, imatch_edits, likeness, _TermKeys
from tidewater.llm.mixing import mix_sources, with_quality, word_targets
from tidewater.llm.queries import QUERIES, SENTENCEPIECE_MODEL
from tidewater.llm.sentencepiece_codec import Codec, SentencePieceModel, sentencepiece_codec
from tidewater.llm.text_density import extract_pages, main_text
from tidewater.llm.zstd_toxicity import fit_toxicity, score_toxicity


# ---- mixing

@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100}, {"a": 1000, "b": 10, "c": 5, None: 50}, {"a": 7}, {"a": 0, "b": 0}, {"a": 0, "b": 9}])
def test_targets_are_capped_and_reshared(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in word_targets(df).collect()}
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    want, open_, rest = {}, set(names), float(sum(sizes.values()))
    while open_:  # reshare until none is above its cap
        share = {s: rest * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            want |= share
            break
        for s in over:
            want[s] = 3.0 * sizes[s]
            rest -= want[s]
        open_ -= over
    assert got == pytest.approx(want)


def test_mix_meets_targets_and_repeats_itself(spark, sf_dir):
    rows = QUERIES["op2_source_mixing"](spark, sf_dir).collect()
    assert sorted(rows) == sorted(QUERIES["op2_source_mixing"](spark, sf_dir).collect())
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    taken, target = Counter(), {}
    for r in rows:
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
        assert 0 <= r.taken <= 3 * r.size
    assert all(abs(taken[s] - t) <= 0.5 for s, t in target.items())


def test_heavier_documents_are_drawn_more_often(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("w w w w w w w w w w").alias("text"), F.when(F.col("id") < 2000, "a").otherwise("b").alias("source"))
    docs = docs.unionByName(spark.createDataFrame([(9000, "x " * 20000, "c")], "doc_id long, text string, source string"))
    out = mix_sources(docs, ["doc_id"], quality=F.when(F.col("doc_id") % 2 == 0, 4.0).otherwise(1.0)).where("row.doc_id < 2000")
    even, odd = (out.where(F.col("row.doc_id") % 2 == k).agg(F.sum("taken") / F.sum("size")).first()[0] for k in (0, 1))
    assert out.first().target < out.first().source_size and even > 1.5 * odd


def test_mix_odd_rows(spark, odd_docs, no_docs):
    assert mix_sources(no_docs, ["doc_id"]).count() == 0
    out = mix_sources(odd_docs, ["doc_id", "row"]).collect()
    assert len(out) == odd_docs.count() and all(r.taken <= 3 * r.size for r in out)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (None, 1)], "doc_id long, quality int")
    weighed, weight = with_quality(odd_docs, labels)
    assert {(r[0], r[1]) for r in weighed.where("doc_id < 4").select("doc_id", weight).collect()} == {(1, 2.0), (2, 0.5), (3, 1.0)}
    assert weighed.count() == odd_docs.count()


# ---- tokens

def test_codec_equals_sentencepiece(spark, sf_dir):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=SENTENCEPIECE_MODEL)
    texts = [r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    texts += ["  two  spaces ", "a\n\nb\t c", "▁x", " ", "   ", "日本語 🙂", "<s> </s> <unk> <0x41>", "aaaaaaaa aaa", "\x00\x7f", ""]
    with open(SENTENCEPIECE_MODEL, "rb") as f:
        codec = Codec(f.read(), 2)
    ids, sizes, decoded, same, agrees = codec.run(texts)
    parts = [p.tolist() for p in np.split(ids, np.cumsum(sizes)[:-1])]
    assert parts == sp.encode(texts) and decoded == sp.decode(parts) and all(agrees)
    assert [t for t, s in zip(texts, same) if not s] == [] and decoded[texts.index("a\n\nb\t c")] == "a\n\nb\t c"


def test_unigram_model_is_rebuilt():
    def field(number, payload):
        return bytes([number << 3 | 2, len(payload)]) + payload

    def piece(text, score, kind):
        return field(1, field(1, text.encode()) + bytes([2 << 3 | 5]) + np.float32(score).tobytes() + bytes([3 << 3, kind]))

    pieces = [("<unk>", 0, 2), ("<s>", 0, 3), ("▁", -3.0, 1), ("a", -2.0, 1), ("b", -2.5, 1), ("ab", -3.0, 1), ("▁ab", -3.5, 1)]
    data = b"".join(piece(*p) for p in pieces) + field(2, bytes([3 << 3, 1])) + field(3, bytes([3 << 3, 1, 4 << 3, 1, 5 << 3, 1]))
    model = SentencePieceModel.parse(data)
    assert [p for p, _, _ in model.pieces] == [p for p, _, _ in pieces] and model.kind == 1
    codec = Codec(data, 1)
    ids, sizes, decoded, _, agrees = codec.run(["ab  ab a", "", " "])
    assert all(agrees) and decoded == ["ab ab a", "", ""] and ids.tolist() == [6, 6, 2, 3] and sizes.tolist() == [4, 0, 0]


def test_codec_encodes_many_words_in_one_string():
    """the libraries get a small part of as many strings as there are words; the results are those of whole texts."""
    import sentencepiece
    rng = random.Random(2)
    texts = [" ".join("".join(rng.choices("abcdeéß日, 1", k=rng.randint(1, 9))) for _ in range(300)) for _ in range(20)] + ["a  b ", "  ", "▁x ▁", ""]
    with open(SENTENCEPIECE_MODEL, "rb") as f:
        data = f.read()
    codec, given = Codec(data, 1), []
    encode = codec.tokenizer.encode_batch_fast

    class Counted:
        decode_batch = staticmethod(codec.tokenizer.decode_batch)

        @staticmethod
        def encode_batch_fast(strings, **options):
            given.extend(strings)
            return encode(strings, **options)
    codec.tokenizer = Counted()
    ids, sizes, decoded, same, agrees = codec.run(texts)
    assert len(codec.words) > 2000 and len(given) < len(codec.words) / 4
    sp = sentencepiece.SentencePieceProcessor(model_proto=data)
    assert [p.tolist() for p in np.split(ids, np.cumsum(sizes)[:-1])] == sp.encode(texts)
    assert decoded == [t.replace("▁", " ") for t in texts] and all(same) and all(agrees)
    again = codec.run(texts[::-1])
    assert again[2] == decoded[::-1] and again[1].tolist() == sizes.tolist()[::-1]


def test_codec_of_a_model_that_loses_characters():
    """Words that decode to something else, and words on which the libraries differ, are told apart text by text."""
    def field(number, payload):
        return bytes([number << 3 | 2, len(payload)]) + payload

    pieces = [("<unk>", 0, 2), ("▁", -3.0, 1), ("a", -4.0, 1), ("b", -5.0, 1), ("ab", -1.0, 1), ("▁ab", -2.0, 1)]
    made = b"".join(field(1, field(1, t.encode()) + bytes([2 << 3 | 5]) + np.float32(x).tobytes() + bytes([3 << 3, k])) for t, x, k in pieces)
    codec = Codec(made + field(2, bytes([3 << 3, 2])) + field(3, bytes([3 << 3, 1, 4 << 3, 0, 5 << 3, 1])), 1)
    assert codec.joins
    ids, sizes, decoded, same, agrees = codec.run(["ab a", "ab x", "b ab", ""])
    assert sizes.tolist() == [3, 3, 3, 0] and ids.tolist() == [5, 1, 2, 5, 1, 0, 1, 3, 5]
    assert same == [True, False, True, True] and decoded == ["ab a", "ab <unk>", "b ab", ""] and all(agrees)
    codec._forget()
    codec.reference = type("Other", (), {"encode": staticmethod(lambda texts, **_: [[2]] * len(texts)), "piece_to_id": staticmethod(lambda p: 1)})
    assert codec.run(["", "ab", "b"])[4] == [True, False, False]


def test_codec_odd_rows(spark, odd_docs, no_docs):
    assert sentencepiece_codec(no_docs, SENTENCEPIECE_MODEL, ["doc_id"]).count() == 0
    out = sentencepiece_codec(odd_docs, SENTENCEPIECE_MODEL, ["doc_id", "row"]).collect()
    assert len(out) == odd_docs.count() and all(r.parity and r.round_trip and len(r.ids) == r.n_tokens for r in out)
    assert {r.n_tokens for r in out if r.doc_id in (3, 4)} == {0}


# ---- fingerprints

def test_imatch_edits_and_likeness(spark, sf_dir):
    rows = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    got = {r.doc_id: r for r in QUERIES["op5_imatch"](spark, sf_dir).collect()}
    prints = {}
    for i, (key, text) in enumerate(rows):
        following, cut = rows[(i + 1) % len(rows)][1], len(text) // 4
        edited = text[:len(text) - cut] + following[:cut]
        r = got[key]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and r.near_edited == likeness(r.fingerprint, r.edited_fingerprint)
        assert r.near_next == likeness(r.fingerprint, got[rows[(i + 1) % len(rows)][0]].fingerprint)
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
    assert np.mean([r.near_edited for r in got.values()]) > 0.3 > 10 * np.mean([r.near_next for r in got.values()])


def test_imatch_uses_the_lexicon_only():
    memo = _TermKeys()
    from tidewater.llm.imatch import _terms
    lexicon = np.sort(_terms(" ".join(f"t{i}" for i in range(40)), memo))
    a = fingerprint("T1, t2 t3 other words", lexicon, memo)
    assert a == fingerprint("t3 t2. t1 quite unlike", lexicon, memo) != fingerprint("t1 t2 t4", lexicon, memo)
    empty, blank = fingerprint("", lexicon, memo), fingerprint(" ", lexicon[:0], memo)
    assert empty[0] == blank[0] == "t" and empty != blank and likeness(empty, blank) == 0.0 and likeness(empty, empty) == 1.0
    assert likeness(a, a) == 1.0


def _brute_mix(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 % 2**64
    x ^= x >> 27
    x = x * 0x94D049BB133111EB % 2**64
    return x ^ x >> 31


def _brute_terms(text):
    words = text.encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")).split()
    return {xxhash.xxh3_64_intdigest(w.strip(b".,;:!?\"'()[]") or w) for w in words}


def _brute_fingerprint(text, lexicon):
    """{(level, subset): hash of the subset's terms at that level, or 0} with the kind, one term and one level at a time."""
    terms = _brute_terms(text)
    kind, used = ("l", terms & lexicon) if terms & lexicon else ("a", terms) if terms else ("t", set())
    if kind == "t":
        return kind, text
    first, out = max(0, len(used).bit_length() - 2), {}
    for subset in range(24):
        salt = _brute_mix((subset + 1) * 0x9E3779B97F4A7C15 % 2**64) | 1
        for level in range(first, first + 4):
            taken = [t * salt % 2**64 for t in used if t * salt % 2**64 < 2 ** (64 - level)]
            out[level, subset] = max(1, _brute_mix(sum(map(_brute_mix, taken)) % 2**64) >> 48) if taken else 0
    return kind, out


def _brute_likeness(a, b):
    if a == b:
        return 1.0
    if a[0] != b[0] or a[0] == "t":
        return 0.0
    best = 0.0
    for level in {k[0] for k in a[1]} & {k[0] for k in b[1]}:
        pairs = [(a[1][level, s], b[1][level, s]) for s in range(24)]
        some = [x == y for x, y in pairs if x or y]
        best = max(best, sum(some) / len(some) if some else 0.0)
    return best


def test_imatch_equals_brute_force(spark, sf_dir):
    """Document frequencies, lexicon, fingerprints and likeness by plain loops."""
    rows = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    frequency = Counter(t for _, text in rows for t in _brute_terms(text))
    lexicon = {t for t, n in frequency.items() if 2e-4 * len(rows) <= n <= max(0.05 * len(rows), 1)}
    own = [_brute_fingerprint(t, lexicon) for _, t in rows]
    got = {r.doc_id: r for r in QUERIES["op5_imatch"](spark, sf_dir).collect()}
    for i, (key, text) in enumerate(rows):
        cut, after = len(text) // 4, (i + 1) % len(rows)
        r, changed = got[key], _brute_fingerprint(text[:len(text) - cut] + rows[after][1][:cut], lexicon)
        for told, (kind, want) in ((r.fingerprint, own[i]), (r.edited_fingerprint, changed)):
            assert told[0] == kind
            if kind != "t":
                first = min(k[0] for k in want)
                assert told == f"{kind}{first:02d}:" + "/".join("".join(f"{want[level, s]:04x}" for s in range(24)) for level in range(first, first + 4))
        assert r.near_edited == _brute_likeness(own[i], changed) and r.near_next == _brute_likeness(own[i], own[after])


def test_imatch_keeps_its_resolution():
    terms = [f"t{i}" for i in range(300)]
    own, changed = (fingerprint(" ".join(t), np.empty(0, dtype=np.uint64), _TermKeys()) for t in (terms, terms[:285]))
    assert [len(h) for h in own[4:].split("/")] == [24 * 4] * 4 and 0 < likeness(own, changed) <= 1


def test_imatch_ranges_meet_their_successors(spark):
    rows = [(i // 3, f"text number {i} of many, with words {i % 7} and {i % 11}") for i in range(900)] + [(5, "twice"), (5, "twice")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "xxhash64(text) AS tie").repartition(5)
    order = sorted((r.doc_id, r.tie, r.text) for r in docs.collect())
    edits = [(d, hashlib.sha256((t[:len(t) - len(t) // 4] + order[(i + 1) % len(order)][2][:len(t) // 4]).encode()).hexdigest()) for i, (d, _, t) in enumerate(order)]
    for few in (docs, docs.limit(1)):
        got = sorted((r.doc_id, r.edited_sha256) for r in imatch_edits(few, ["doc_id"]).collect())
        assert got == sorted(edits) if few is docs else len(got) == 1


def test_imatch_odd_rows(odd_docs, no_docs):
    assert imatch_edits(no_docs, ["doc_id"]).count() == 0
    out = imatch_edits(odd_docs, ["doc_id", "row"]).collect()
    assert len(out) == odd_docs.count()
    assert len({r.fingerprint for r in out if r.doc_id == 6}) == 1
    one = imatch_edits(odd_docs.where("doc_id = 8"), ["doc_id"]).first()
    assert one.near_next == 1.0


# ---- language model

def test_brown_base_figures_equal_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    tokens = {k: [*(t or "").encode().translate(brute.UPPER).split(), None] for k, t in rows}
    held = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k in tokens}
    c = Counter(w for k, ws in tokens.items() if not held[k] for w in ws)
    total, types = sum(c.values()), len(c)
    base = score = 0.0
    for r in QUERIES["op8_brown_lm"](spark, sf_dir).collect():
        ws = tokens[r.doc_id]
        want = sum(math.log10((c[w] + 1) / (total + types + 1)) for w in ws)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(ws), sum(c[w] > 0 for w in ws), total)
        assert r.base_score == pytest.approx(want, rel=1e-9) and r.score < 0
        if r.held_out:
            base, score = base + want, score + r.score
    assert score > base  # the class model does better on held-out texts


def test_rare_words_come_back_by_the_join(spark, monkeypatch):
    import tidewater.llm.brown_lm as lm
    docs = spark.createDataFrame([(i, "a a a b c " * (i + 1) + f"rare{i % 3} odd{i}") for i in range(12)], "doc_id long, text string")
    want = {r.doc_id: (r.n_known, r.base_score, r.score) for r in brown_scores(docs, F.col("doc_id") < 8, ["doc_id"]).collect()}
    monkeypatch.setattr(lm, "HOT", 0.05)  # all but a few words are rare
    got = {r.doc_id: (r.n_known, r.base_score, r.score) for r in brown_scores(docs, F.col("doc_id") < 8, ["doc_id"]).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_exchange_raises_the_likelihood():
    rng = np.random.default_rng(0)
    kind = rng.integers(0, 3, 40)
    kind[-1] = 0
    pairs = rng.poisson(np.where((kind[:, None] + 1) % 3 == kind[None, :], 20.0, 0.5)).astype(float)
    cls = exchange(pairs, 4, 20)
    assert cls[-1] == 3
    pure = [len(set(kind[:-1][cls[:-1] == c])) for c in set(cls[:-1])]
    assert max(pure) == 1


def test_exchange_ends_where_no_move_raises_the_likelihood():
    """Against moving every unit to every class and counting anew; the table has units before themselves and small classes."""
    from tidewater.llm.brown_lm import SWEEPS, _table_likelihood
    for seed in range(6):
        rng = np.random.default_rng(seed)
        pairs = rng.poisson(rng.gamma(0.15, 25.0, (24, 24))).astype(float)
        cls = exchange(pairs, 7, SWEEPS)

        def likelihood(of):
            onehot = np.eye(7)[of]
            return _table_likelihood(onehot.T @ pairs @ onehot)
        moves = [np.where(np.arange(24) == u, c, cls) for u in range(23) for c in range(6)]
        assert max(map(likelihood, moves)) <= likelihood(cls) + 1e-5


def test_merges_lose_least():
    """Brown's merges against counting the information of every possible merge anew."""
    from tidewater.llm.brown_lm import merge_losses, merge_paths, merge_units
    rng = np.random.default_rng(5)
    kind = rng.integers(0, 3, 30)
    pairs = rng.poisson(np.where((kind[:, None] + 1) % 3 == kind[None, :], 9.0, 1.0)).astype(float)
    pairs[20] = pairs[:, 20] = 0  # never occurs
    n, classes = 30, 5
    rows, cols = pairs.sum(axis=1), pairs.sum(axis=0)

    def information(groups):
        total = 0.0
        for a in groups:
            for b in groups:
                t = pairs[np.ix_(a, b)].sum()
                total += t * math.log(t / (rows[a].sum() * cols[b].sum())) if t else 0.0
        return total

    def merged(groups, i, j):
        return [g for k, g in enumerate(groups) if k not in (i, j)] + [groups[i] + groups[j]]
    order = [int(u) for u in np.argsort(-(rows + cols), kind="stable") if u not in (n - 1, 20)]
    end, groups = [n - 1], [[u] for u in order[:classes - 1]]
    for u in order[classes - 1:]:
        groups.append([u])
        every = [end, *groups]
        table = np.array([[pairs[np.ix_(a, b)].sum() for b in every] for a in every])
        loss = merge_losses(table, np.array([rows[g].sum() for g in every]), np.array([cols[g].sum() for g in every]))
        for i in range(1, len(every)):
            for j in range(1, i):
                assert loss[i, j] == pytest.approx(information(every) - information(merged(every, i, j)), abs=1e-7)
        _, i, j = min((loss[i + 1, j + 1], i, j) for i in range(len(groups)) for j in range(i))
        groups = merged(groups, i, j)
    cls = merge_units(pairs, classes)
    assert {frozenset(g) for g in groups} | {frozenset(end)} == {frozenset(np.flatnonzero((cls == c) & (np.arange(n) != 20)).tolist()) for c in range(classes)}
    onehot = np.eye(classes)[cls]
    paths = merge_paths(onehot.T @ pairs @ onehot)
    assert paths[-1] == "" and len(set(paths[:-1])) == classes - 1 and sum(2.0 ** -len(p) for p in paths[:-1]) == 1.0


def test_fit_starts_from_merges(spark, monkeypatch):
    """With no later step, the classes are those of Brown's merges, whose first words are classes of their own."""
    import tidewater.llm.brown_lm as lm
    rng = np.random.default_rng(1)
    texts = [(" ".join(f"w{k}" for k in rng.zipf(1.3, 200) if k < 2000),) for _ in range(200)]
    monkeypatch.setattr(lm, "SWEEPS", 0)
    monkeypatch.setattr(lm, "_exchange_all", lambda texts, key, cls, ending, table: (cls, table))
    model, _ = lm.fit_brown(spark.createDataFrame(texts, "txt string"))
    top = sorted(Counter(w for t, in texts for w in t.split()).items(), key=lambda x: -x[1])[:10]
    memo, cls = lm._WordKeys(), dict(zip(model.hot_key.tolist(), model.hot_cls.tolist()))
    assert len({cls[memo[w.encode()]] for w, _ in top}) > 5  # few of the most frequent are merged with one another
    assert len(set(model.paths)) == lm.CLASSES


def test_best_class_raises_the_likelihood_most():
    """Against moving the word to every class and counting anew."""
    from tidewater.llm.brown_lm import CLASSES, LAST, _table_likelihood, best_class
    rng = np.random.default_rng(8)
    cls, text = rng.integers(0, 6, 40), rng.integers(1, 40, 3000)
    text = text[np.append(True, text[1:] != text[:-1])]  # no word before itself
    cls[0] = LAST

    def table(of):
        t = np.zeros((CLASSES, CLASSES))
        np.add.at(t, (of[text[:-1]], of[text[1:]]), 1)
        return t
    words = [w for w in range(1, 40, 7) if w not in (text[0], text[-1])]  # those have a neighbour on one side only
    assert len(words) >= 4
    for word in words:
        at = np.flatnonzero(text[1:-1] == word) + 1
        left, right = (np.bincount(cls[text[at + d]], minlength=CLASSES).astype(float) for d in (-1, 1))
        moved = []
        for c in range(LAST):
            other = cls.copy()
            other[word] = c
            moved.append(_table_likelihood(table(other)))
        assert moved[best_class(table(cls), int(cls[word]), left, right)] == pytest.approx(max(moved), rel=1e-12)


def test_brown_scores_equal_plain_loops(spark, sf_dir):
    """Class tables counted one by one, and every text's probability multiplied out word by word, rare and unknown words too."""
    from tidewater.llm import brown_lm as b
    rows = [(r.doc_id, (r.text or "").encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")).split())
            for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    train = [(i, w) for i, w in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with pytest.MonkeyPatch.context() as m:
        m.setattr(b, "HOT", 3e-5)  # so that there are rare words
        model, counts = b.fit_brown(docs.where(F.crc32(F.col("doc_id").cast("string")) % 7 != 2).select(F.coalesce("text", F.lit("")).alias("txt")))
        got = {r.doc_id: r for r in b.score_brown(docs, model, counts, ["doc_id"]).collect()}
    memo, count = b._WordKeys(), Counter(w for _, ws in train for w in ws)
    hot = dict(zip(model.hot_key.tolist(), model.hot_cls.tolist()))
    assert set(hot) == {memo[w] for w, n in count.items() if n >= max(1.0, 3e-5 * model.tokens)} | {memo[w] for w, _ in sorted(count.items(), key=lambda x: (-x[1], memo[x[0]]))[:b.CORE]}
    cls = lambda w: hot.get(memo[w], int(model.ending_cls[memo[w] & 0xFF]))
    table = np.zeros((b.CLASSES, b.CLASSES))
    for k, (_, ws) in enumerate(train):
        seq = [b.LAST, *map(cls, ws), b.LAST]
        np.add.at(table, (seq[:-1], seq[1:]), 1)
    size, once = table.sum(axis=0), Counter(int(model.ending_cls[memo[w] & 0xFF]) for w, n in count.items() if n == 1)
    prior = (size + 1) / (size.sum() + b.CLASSES)
    unknown = [min((once[c] + 0.5) / (size[c] + 1), 0.5) for c in range(b.CLASSES)]
    for i, ws in rows:
        total, last = 0.0, b.LAST
        for w in [*ws, None]:
            c, n = (b.LAST, len(train)) if w is None else (cls(w), count[w])
            total += math.log10((table[last, c] + b.CLASSES * prior[c]) / (table[last].sum() + b.CLASSES))
            total += math.log10(unknown[c]) if not n else math.log10((1 - unknown[c]) / max(size[c], 1) * n)
            last = c
        assert got[i].score == pytest.approx(total, rel=1e-9)


def test_best_classes_are_those_word_by_word():
    from tidewater.llm.brown_lm import CLASSES, LAST, best_class, best_classes
    rng = np.random.default_rng(3)
    cls = rng.integers(0, 5, 60)  # most classes stay empty
    cls[0] = LAST
    text = rng.zipf(1.2, 20000)
    text = text[text < 60] * rng.integers(0, 2, (text < 60).sum())  # some words before themselves
    table, beside = np.zeros((CLASSES, CLASSES)), np.zeros((60, 2, CLASSES))
    np.add.at(table, (cls[text[:-1]], cls[text[1:]]), 1)
    np.add.at(beside, (text[1:], 0, cls[text[:-1]]), 1)
    np.add.at(beside, (text[:-1], 1, cls[text[1:]]), 1)
    words = np.arange(1, 60)
    got = best_classes(table, cls[words], beside[words, 0], beside[words, 1])
    assert got.tolist() == [best_class(table, int(cls[w]), beside[w, 0], beside[w, 1]) for w in words] and (got != cls[words]).any()
    assert best_classes(table, cls[:0], beside[:0, 0], beside[:0, 1]).tolist() == []


def test_every_rare_word_is_merged_by_its_own_contexts(spark, monkeypatch):
    """Words of two kinds that take turns and have one ending: rare ones, too, are told apart; scores against plain loops."""
    from tidewater.llm import brown_lm as b
    monkeypatch.setattr(b, "HOT", 2e-4)
    rng = np.random.default_rng(4)
    texts = []
    for _ in range(300):
        n = rng.zipf(1.15, 100)
        n = np.where(n < 3000, n, rng.integers(3000, 9000, 100))
        texts.append(" ".join(f"{'ab'[k % 2]}{x}Ing" for k, x in enumerate(n)))
    rows = [(k, t) for k, t in enumerate(texts)] + [(900, None), (901, "a5ing new one a7000ing b8000ing"), (906, "unheard"), (3, texts[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    training = F.col("doc_id") % 5 != 1
    train = [(t or "").lower().encode().split() for i, t in rows if i % 5 != 1]
    model, counts = b.fit_brown(docs.where(training).select(F.coalesce("text", F.lit("")).alias("txt")))
    got = {r.key: r for r in b.merge_rare(b._class_texts(docs, training, model, ["doc_id"], "text"), model).collect()}
    memo, count = b._WordKeys(), Counter(w for ws in train for w in ws)
    hot = dict(zip(model.hot_key.tolist(), model.hot_cls.tolist()))
    rare = [w for w in count if memo[w] not in hot]
    assert len(rare) > 1000 and {k: r.n for k, r in got.items()} == {memo[w]: count[w] for w in rare}
    by_ending = lambda w: int(model.ending_cls[memo[w] & 0xFF])
    first, beside = lambda w: hot.get(memo[w], by_ending(w)), {w: np.zeros((2, b.CLASSES)) for w in rare}
    for ws in train:
        for k, w in enumerate(ws):
            if w in beside:
                beside[w][0][first(ws[k - 1]) if k else b.LAST] += 1
                beside[w][1][first(ws[k + 1]) if k + 1 < len(ws) else b.LAST] += 1
    assert {k: r.cls for k, r in got.items()} == {memo[w]: b.best_class(model.table, by_ending(w), *beside[w]) for w in rare}
    kinds = [Counter(got[memo[w]].cls for w in rare if w.startswith(kind)) for kind in (b"a", b"b")]
    assert len({by_ending(w) for w in rare}) == 1 and sum((kinds[0] & kinds[1]).values()) < 0.05 * len(rare)  # nearly all are told apart

    cls = lambda w: got[memo[w]].cls if memo[w] in got else first(w)
    table = np.zeros((b.CLASSES, b.CLASSES))
    for ws in train:
        seq = [b.LAST, *map(cls, ws), b.LAST]
        np.add.at(table, (seq[:-1], seq[1:]), 1)
    size, once = table.sum(axis=0), Counter(by_ending(w) for w, n in count.items() if n == 1)
    prior, total = (size + 1) / (size.sum() + b.CLASSES), sum(count.values()) + len(train)
    unknown = [min((once[c] + 0.5) / (size[c] + 1), 0.5) for c in range(b.CLASSES)]
    before = {r.doc_id: r.score for r in b.score_brown(docs, model, counts, ["doc_id"]).collect()}
    out = b.brown_scores(docs, training, ["doc_id"]).collect()
    assert sorted(r.doc_id for r in out) == sorted(i for i, _ in rows)
    for r in out:
        ws, want, last = (dict(rows)[r.doc_id] or "").lower().encode().split(), 0.0, b.LAST
        for w in [*ws, None]:
            c, n = (b.LAST, len(train)) if w is None else (cls(w), count[w])
            want += math.log10((table[last, c] + b.CLASSES * prior[c]) / (table[last].sum() + b.CLASSES))
            want += math.log10(unknown[c]) if not n else math.log10((1 - unknown[c]) / max(size[c], 1) * n)
            last = c
        assert r.score == pytest.approx(want, rel=1e-9)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws) + 1, sum(count[w] > 0 for w in ws) + 1, total)
        assert r.base_score == pytest.approx(sum(math.log10((n + 1) / (total + len(count) + 2)) for n in [len(train), *(count[w] for w in ws)]), rel=1e-9)
    learnt = [r for r in out if r.doc_id % 5 != 1]  # held-out texts need not gain: words never seen keep a class that rare words have left
    assert sum(r.score for r in learnt) > sum(before[r.doc_id] for r in learnt)


def test_brown_odd_rows(odd_docs, no_docs):
    assert brown_scores(no_docs, F.lit(True), ["doc_id"]).count() == 0
    out = brown_scores(odd_docs, F.col("doc_id") < 6, ["doc_id", "row"]).collect()
    assert len(out) == odd_docs.count() and {r.n_tokens for r in out if r.doc_id in (3, 4, 10)} == {1}
    untrained = brown_scores(odd_docs, F.lit(False), ["doc_id"]).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and np.isfinite(r.score) for r in untrained)


# ---- toxicity

def _toxic_table(spark, n=400):
    rng = np.random.default_rng(8)
    words = np.array(["".join(rng.choice(list("aeioustnr"), rng.integers(3, 8))) for _ in range(500)])
    docs, labels = [], []
    for i in range(n):
        text = rng.choice(words, rng.integers(30, 300)).tolist()
        toxic = i % 5 == 0
        for _ in range(4 if toxic else 0):
            text.insert(int(rng.integers(0, len(text))), str(rng.choice(["blockhead", "Scoundrel!", "vermin"])))
        docs.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_on_held_out_texts(spark):
    docs, labels = _toxic_table(spark)
    model = fit_toxicity(docs, labels, F.col("doc_id") % 3 != 0)
    got = {r.doc_id: r.score for r in score_toxicity(docs, model, ["doc_id"]).collect()}
    held = [(got[i], i % 5 == 0) for i in range(0, 400, 3)]
    assert np.mean([(s >= 0.5) == t for s, t in held]) > 0.95 and all(0 <= s <= 1 for s in got.values())


def test_dictionaries_take_all_of_the_sample():
    import random

    from tidewater.llm.zstd_toxicity import _ordinary_content, _toxic_content
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9))
    plain, bad = [word() for _ in range(300)], [word() for _ in range(900)]
    ordinary = [" ".join(rng.choices(plain, k=30)) for _ in range(300)]
    toxic = [" ".join(rng.choices(plain, k=20) + bad[i % 20 :: 20]) for i in range(300)]
    assert set(bad) <= set(_toxic_content(toxic, ordinary).decode().split())
    late = [" ".join(rng.choices(plain[:150], k=600) + ["latecomer"] * 3 + rng.choices(plain[150:], k=600)) for _ in range(40)]
    assert any(w.encode() in _ordinary_content(late) for w in plain[150:])


def test_toxicity_odd_rows(spark, odd_docs, no_docs):
    docs, labels = _toxic_table(spark, 120)
    model = fit_toxicity(docs, labels, F.lit(True))
    out = score_toxicity(odd_docs, model, ["doc_id", "row"]).collect()
    assert len(out) == odd_docs.count() and all(r.score < 0.5 for r in out)
    assert score_toxicity(no_docs, model, ["doc_id"]).count() == 0
    assert fit_toxicity(docs, labels.limit(0), F.lit(True)) is None and fit_toxicity(no_docs, labels, F.lit(True)) is None
    assert {r[1] for r in score_toxicity(docs, None, ["doc_id"]).collect()} == {0.0}
    doubled = labels.unionByName(labels.selectExpr("doc_id", "quality", "null AS toxic"))
    assert fit_toxicity(docs.unionByName(docs), doubled, F.lit(True)) == model


# ---- pages

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style></head><body><div id="header"><p>Site name and a long slogan of the site</p></div>
<nav><ul><li><a href=x>Home</a><li><a href=y>More</a></ul></nav><div class="cookie-notice">We use cookies, please accept all of them now.</div>
<main><h1>The   title</h1><div class="post"><p>First <b>bold</b> &amp; plain&nbsp;text, long enough to matter.<p>Second one with <a href=z>a link</a><br>and a break.
<script>var s="</p><p>x";</script><ul><li>item one<li>item two</ul><table><tr><td>cell<td>cell two</table><form>Name <input><button>Send</button></form></div></main>
<aside>Side story that is long, too, and might look like text.</aside><section id="comments"><p>A reader writes a long comment about all of this.</p></section>
<div class="ad">Buy this now, it is the best product ever.</div><footer>&copy; me</footer></body></html>"""


def test_main_text_of_a_page():
    assert main_text(PAGE) == "The title First bold & plain text, long enough to matter. Second one with a link and a break. item one item two cell cell two"


def _paragraphs(first, count):
    return "".join(f"<p>Paragraph {i} tells one more part of a long story in plain words, without a link.</p>" for i in range(first, first + count))


@pytest.mark.parametrize("shell", ["<body>{}</body>", "<body><div class=page><div id=content>{}</div></div></body>", "<body><article>{}</article></body>"])
def test_article_in_sibling_containers(shell):
    links = "<div>" + "".join(f"<p><a href=/{i}>Elsewhere {i}</a></p>" for i in range(5)) + "</div>"
    inside = f"<div class=lead>{_paragraphs(0, 1)}</div><div>{_paragraphs(1, 12)}</div>{'' if 'article' in shell else links}<section><div>{_paragraphs(13, 10)}</div></section>"
    want = " ".join(f"Paragraph {i} tells one more part of a long story in plain words, without a link." for i in range(23))
    assert main_text(shell.format(inside)) == want


@pytest.mark.parametrize("page, text", [("", ""), ("no tags &lt;at all&gt;", "no tags <at all>"), ("<p>one<p>two", "one two"), ("<!-- <p>x", ""), ("<script>a</scrip", ""),
                                        ("<nav>only a menu</nav>", ""), ("<p title='a>b'>quoted</p>", "quoted"), ("<p>1 < 2", "1 < 2"), ("<div>" * 3000 + "deep", "deep"),
                                        ("</p></div><p>x</b></p>", "x"), ("<a href='unclosed>x</a><p>y</p>", "x y")])
def test_broken_pages(page, text):
    assert main_text(page) == text  # a quote that is never closed ends with its tag


def test_pages_query(spark, sf_dir):
    import html
    import re
    rows = {r.page_id: r for r in QUERIES["op10_text_density"](spark, sf_dir).collect()}
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", r.html, re.S)[1]
        plain = html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"</?(?:p|h1|br)\b[^>]*>", " ", article)))
        assert rows[r.page_id].text == " ".join(plain.split()) and rows[r.page_id].n_chars == len(rows[r.page_id].text)


def test_pages_odd_rows(spark):
    rows = [(1, "u", None, "x"), (None, None, "", "x"), (2, "u", PAGE, "x"), (2, "u", PAGE, "x"), (3, "u", "<p>" + "long text " * 50000, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((r.page_id or 0, len(r[2])) for r in extract_pages(df.drop("text"), ["page_id", "url"]).collect())
    assert [g[0] for g in got] == [0, 1, 2, 2, 3] and got[0][1] == got[1][1] == 0 and got[4][1] == 499_999
    assert extract_pages(df, ["page_id"]).count() == 5 and extract_pages(df.limit(0), ["page_id"]).count() == 0
