"""Token files, filter audit and fill-in-the-middle."""
import hashlib
import io
import zlib
from itertools import permutations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewater.llm.common import NULL_IDS
from tidewater.llm.fill_middle import ArrayContainer, BitmapContainer, BoundarySet, RunContainer, container, fill_middle, restore, transform, unit_ends
from tidewater.llm.filter_audit import audit_documents, filter_audit
from tidewater.llm.queries import QUERIES
from tidewater.llm.token_files import ChecksumError, TokenFile, read_some, read_token_files, write_token_files
from tidewater.llm.word_ids import WordIds
from tidewater.session import scratch_dir

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def words():
    with open(FILE, encoding="utf-8") as f:
        return WordIds(f.read())


def same_ids(words, tokenizer, texts):
    flat, sizes = words.encode(pa.array(texts, pa.string()))
    got = [g.tolist() for g in np.split(flat, np.cumsum(sizes)[:-1])]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


# ---- token ids

ODD_TEXTS = ["", " \t\n", "a", "'s", "it's It'S we're WE'RE they'll ''s 's's \"'d x'", "don'tell 'tis '", "abc123 1²³¼x", "É é é ﬁ İstanbul Kelvin K ſ straße",
             "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|> <|", "a b\u0085c d \x1c\x1d e\x00f", "漢字 かな 🙂👍🏽 mixed漢x", "ªº µ ×÷ ·", "x" * 5000, "1" * 300, "ﬀ̈ ä̈",
             "'é 'S9 'll'llama 'ſ 'K", "tab\tvt\x0bff\x0ccr\rlf\nend ", "<", "|", "<|x", "é", "'", "''", "s", "ͅ ͅ"]


def test_ids_equal_the_library(words, tokenizer):
    assert words.by_part
    same_ids(words, tokenizer, ODD_TEXTS)
    same_ids(words, tokenizer, ["", "", "x", ""])
    same_ids(words, tokenizer, list(reversed(ODD_TEXTS)))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("aAzsStTdDmMrReEvVlL'’ \t\n19²<|>é É.,! ́漢İſK")), min_size=1, max_size=4), st.text(max_size=30))
def test_ids_equal_the_library_on_any_text(words, tokenizer, texts, other):
    same_ids(words, tokenizer, [*texts, other])


@pytest.mark.parametrize("name", ["byte_bpe_50k.json"])
def test_other_tokenizers_get_whole_texts(name):
    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        other = WordIds(f.read())
    assert not other.by_part
    same_ids(other, Tokenizer.from_file(public_tokenizers.path(name)), ODD_TEXTS)


def test_odd_parts_leave_the_others_joined(tokenizer):
    """a Latin part that the pattern cuts further doesn't send the parts beside it to the library one by one."""
    with open(FILE, encoding="utf-8") as f:
        words = WordIds(f.read())
    given_, own = [], words.tokenizer.encode_batch_fast
    words.tokenizer = type("Counted", (), {"encode_batch_fast": staticmethod(lambda strings, **options: given_.extend(strings) or own(strings, **options))})
    texts = [" ".join(f"{a}{b}{c}" for a in "abcdefghijkÉ" for b in "lmnopqrsß" for c in ("tu", "vé", "wX", "yz", "%%", "#!")), "<|abc x<|end|>y <|", "abl abm"]
    same_ids(words, tokenizer, texts)
    assert len(words.parts) > 500 and len(given_) < 30


# ---- token files

def brute_tokens(tokenizer, rows):
    start, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_token_query_equals_brute_force(spark, sf_dir, tokenizer):
    got = QUERIES["op11_token_files"](spark, sf_dir)
    assert got.dtypes == [("doc_id", "bigint"), ("start", "bigint"), ("n_tokens", "bigint"), ("ids_crc32", "bigint")]
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted(map(tuple, got.collect())) == brute_tokens(tokenizer, rows)


def contents(spark, path):
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path).where("length > 0")
    return [bytes(r.content) for r in files.orderBy("path").collect()]


class Counting(io.BytesIO):
    taken = 0

    def read(self, n=-1):
        out = super().read(n)
        self.taken += len(out)
        return out


@pytest.fixture(scope="module")
def written(spark):
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(f"word{n}" for n in rng.integers(0, 10**6, 1 + i * 37 % 200))) for i in range(300)]
    path = scratch_dir(spark, "token-test")
    write_token_files(spark.createDataFrame(rows, "doc_id long, text string"), path, FILE, end_id=1, file_bytes=4000)
    return path, dict(rows)


def test_files_are_zstandard_and_close_by_bytes(spark, written, tokenizer):
    path, rows = written
    files = contents(spark, path)
    assert len(files) > 20 and max(map(len, files)) < 4000 + 2000 + 300 * (12 + 8 + 13)  # one document more, and the tables
    some = files[0]
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(some), read_across_frames=True).read()
    f = TokenFile(io.BytesIO(some))
    assert plain == b"".join(f.ids(i).tobytes() for i in range(len(f)))  # a plain reader skips the tables
    assert list(f.keys) == sorted(f.keys)
    assert {int(k) for x in files for k in TokenFile(io.BytesIO(x)).keys} == set(rows)


def test_a_reader_takes_only_the_frames_it_wants(spark, written, tokenizer):
    path, rows = written
    data = max(contents(spark, path), key=len)
    stream = Counting(data)
    f = TokenFile(stream)
    opened, key = stream.taken, int(f.keys[len(f) // 2])
    frame = f.find(key)[0]
    assert f.ids(frame).tolist() == tokenizer.encode(rows[key], add_special_tokens=False).ids + [1]
    assert stream.taken - opened == int(f.entries["stored"][frame]) - 13
    broken = bytearray(data)
    for other in range(len(f)):  # all other frames may be lost
        if other != frame:
            at = int(f.ends[other])
            broken[at - int(f.entries["stored"][other]) : at] = bytes(int(f.entries["stored"][other]))
    g = TokenFile(io.BytesIO(bytes(broken)))
    assert g.ids(frame).tolist() == f.ids(frame).tolist()
    with pytest.raises(ChecksumError):
        g.ids(frame - 1 if frame else frame + 1)
    assert [(k, len(i)) for k, i in read_some([io.BytesIO(data)], [key, -5])] == [(key, len(f.ids(frame)))]


def test_every_changed_byte_of_a_frame_is_noticed(spark, written):
    data = min(contents(spark, written[0]), key=len)
    f = TokenFile(io.BytesIO(data))
    for at in range(0, int(f.entries["stored"][0]) - 13):
        bad = bytearray(data)
        bad[at] ^= 0x55
        with pytest.raises(ChecksumError):
            TokenFile(io.BytesIO(bytes(bad))).ids(0)
    with pytest.raises(ChecksumError):
        TokenFile(io.BytesIO(data[:-1]))


def test_requested_documents(spark, written, tokenizer):
    path, rows = written
    want = spark.createDataFrame([(5,), (5,), (17,), (299,), (100000,), (None,)], "doc_id long")
    got = {r.doc_id: r for r in read_token_files(spark, path, want).collect()}
    everything = {r.doc_id: r for r in read_token_files(spark, path).collect()}
    assert sorted(got) == [5, 17, 299] and len(everything) == 300
    for i, r in got.items():
        assert np.frombuffer(r.ids, dtype="<u4").tolist() == tokenizer.encode(rows[i], add_special_tokens=False).ids + [1]
        assert r == everything[i]


def test_token_files_odd_rows(spark, odd_docs, no_docs, tokenizer):
    path = scratch_dir(spark, "token-odd")
    write_token_files(odd_docs, path, FILE, end_id=1)
    got = read_token_files(spark, path).orderBy("start").collect()
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1]]
    ids = [r.doc_id for r in got]
    assert ids == sorted((i for i, _ in rows if i is not None)) + [None] * 3  # without an id: last
    each = sorted((i if i is not None else NULL_IDS, tokenizer.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in rows)
    assert sorted((r.doc_id if r.doc_id is not None else NULL_IDS, np.frombuffer(r.ids, dtype="<u4").tolist()) for r in got) == each
    empty = scratch_dir(spark, "token-none")
    write_token_files(no_docs, empty, FILE, end_id=1)
    assert read_token_files(spark, empty).count() == 0
    assert read_token_files(spark, empty, spark.range(3).withColumnRenamed("id", "doc_id")).count() == 0


# ---- filter audit

def brute_audit(docs, marks):
    """Every document through every order, one filter after the other."""
    first, table = {}, {}
    for i, t, _ in docs:
        first[t or ""] = min(i, first.get(t or "", i))
    for i, t, part in docs:
        t, words = t or "", (t or "").encode().split()
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t), "D": any(c in "#$%&*|" for c in t), "E": first[t] < i}
        good, toxic = marks.get(i, (0, 0))
        for order in map("".join, permutations("ABCDE")):
            gone = False
            for step, f in enumerate(order, 1):
                row = table.setdefault((part or "", order, step), [0] * 7)
                row[2] += fails[f] and gone
                row[3] += fails[f] and sum(fails.values()) == 1
                if fails[f] and not gone:
                    gone = True
                    row[1] += 1
                    row[4] += good == 1
                    row[5] += toxic == 1
                row[0] += not gone
    for (part, order, step), row in table.items():
        row[6] = sum(r[1] for (p, o, s), r in table.items() if p == part and o[s - 1] == order[step - 1])
    return sorted((*k, *map(int, v)) for k, v in table.items())


def test_audit_equals_brute_force(spark):
    long = " ".join(f"w{i}" for i in range(120))
    rows = [(1, long, "en"), (2, long, "en"), (3, long + " $", "en"), (4, "A " * 130, "en"), (5, "A " * 130, "de"), (6, None, "de"), (7, "", None), (8, "x", ""), (9, long.upper(), "fr"),
            (10, "a & b", "fr"), (11, "ÄÖÜ É", "fr"), (12, " ".join(["a"] * 80 + [f"b{i}" for i in range(20)]), "en"), (13, "a b " * 60, "en"), (14, "x\x0by\x0cz", "de")]
    marks = [(1, 1, 0), (2, 1, 1), (4, 0, 1), (5, None, None), (9, 1, 0), (9, 0, 0), (99, 1, 1), (None, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = audit_documents(docs, spark.createDataFrame(marks, "doc_id long, quality int, toxic int"))
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(map(tuple, got.collect())) == brute_audit(rows, {1: (1, 0), 2: (1, 1), 4: (0, 1), 9: (1, 0)})


def test_audit_query_equals_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    marks = {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert sorted(map(tuple, QUERIES["op12_filter_audit"](spark, sf_dir).collect())) == brute_audit(rows, marks)


def test_audit_of_other_filters_and_parts(spark):
    cells = spark.createDataFrame([("p", 0, 5, 1, 0), ("p", 3, 2, 0, 1), ("q", 1, 4, 4, 4)], "part string, mask int, n long, good long, toxic long")
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in filter_audit(cells, "XY").collect()}
    assert got == {("p", "XY", 1): (5, 2, 0, 0, 0, 1, 2), ("p", "XY", 2): (5, 0, 2, 0, 0, 0, 2), ("p", "YX", 1): (5, 2, 0, 0, 0, 1, 2), ("p", "YX", 2): (5, 0, 2, 0, 0, 0, 2),
                   ("q", "XY", 1): (0, 4, 0, 4, 4, 4, 8), ("q", "XY", 2): (0, 0, 0, 0, 0, 0, 0), ("q", "YX", 1): (4, 0, 0, 0, 0, 0, 0), ("q", "YX", 2): (0, 4, 0, 4, 4, 4, 8)}


def test_audit_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = audit_documents(odd_docs, labels, "source")
    assert got.groupBy("part").count().collect() and {r.part: r["count"] for r in got.groupBy("part").count().collect()} == {p: 600 for p in ("", "a", "b", "c")}
    last = got.where("filter_order = 'EABCD' and step = 1").groupBy().agg(F.sum("removed")).first()[0]
    # a null text and an empty one are equal; 5 and 6 say the same; rows without an id come after all others, and equal rows share a fate
    texts = {}
    for r in odd_docs.collect():
        texts.setdefault(r.text or "", []).append(r.doc_id if r.doc_id is not None else NULL_IDS)
    assert last == sum(i > min(ids) for ids in texts.values() for i in ids)
    assert audit_documents(no_docs, labels, "source").count() == 0


# ---- fill in the middle

@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32), st.sampled_from([0.0005, 0.02, 0.3, 0.9, 0.999]), st.sampled_from([1, 100, 65536, 200_000]))
def test_boundary_set_selects(seed, share, size):
    at = np.flatnonzero(np.random.default_rng(seed).random(size) < share)
    s = BoundarySet(at)
    assert len(s) == len(at)
    for k in {0, len(at) // 3, len(at) - 1} if len(at) else ():
        assert s.select(k) == at[k]


def test_containers_by_size():
    every = np.arange(65536)
    kinds = [(every[::100], ArrayContainer), (every[::2], BitmapContainer), (every, RunContainer), (every[5:6], ArrayContainer), (np.concatenate((every[:3000], every[9000:9500])), RunContainer)]
    for low, kind in kinds:
        c = container(low)
        assert type(c) is kind and [c.select(k) for k in range(0, len(low), 97)] == low[::97].tolist()


def brute_fim(text, ident):
    import re

    units = re.findall("[A-Za-z]+|[^A-Za-z]", text, re.S)
    h = hashlib.sha256(f"1:{ident}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(units), "plain", None, None, text
    return (len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 20 else (len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("abZ <>PSM1é漢🙂\n\0[`@{"), max_size=60), st.integers(-5, 10**12))
def test_transform_equals_brute_force_and_comes_back(text, ident):
    got = transform(text, ident)
    assert got == brute_fim(text, ident)
    assert restore(got[4], got[1]) == text


def test_long_texts_use_every_container():
    rng = np.random.default_rng(3)
    text = "word " * 30000 + "漢" * 200_000 + ("y" * 300 + " ") * 600 + "".join(map(chr, rng.choice([97, 98, 32, 0x1F642], 200_000)))
    ends = BoundarySet(unit_ends(np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)))
    assert {type(c) for c in ends.containers} == {ArrayContainer, BitmapContainer, RunContainer}
    for ident in range(12):
        assert transform(text, ident) == brute_fim(text, ident)


def test_fill_middle_odd_rows(odd_docs, no_docs):
    got = fill_middle(odd_docs, ["doc_id", "row"]).collect()
    assert len(got) == odd_docs.count() and all(r.row == "r" for r in got)
    texts = sorted(((r.doc_id is None, r.doc_id or 0, r.text or "") for r in odd_docs.collect()))
    assert sorted(((r.doc_id is None, r.doc_id or 0, r.restored) for r in got)) == texts
    for r in got:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == brute_fim(r.restored, "" if r.doc_id is None else r.doc_id)
    assert fill_middle(no_docs, ["doc_id"]).count() == 0
