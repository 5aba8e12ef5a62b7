"""I-Match fingerprints: hashes of the distinct terms that fall into randomised subsets of a lexicon.

The lexicon holds the terms whose document frequency lies in a band of shares of all documents. As the frequencies sum up to the
distinct terms of all documents, at most (mean distinct terms) / LOW terms reach the lower share, whatever the
size of the corpus: the lexicon is bounded and broadcast. Each of HASHES subsets takes a term with a probability that
halves from level to level; a text uses the levels at which a subset holds a few of its terms or about one, so that
short and long texts lose about the same number of subsets by an edit of the same share.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import keyed_texts, order_key, slices
from tidewater.llm.pieces import mix

LOW, HIGH = 2e-4, 0.05  # the band: document frequency between these shares (idf between 3.0 and 8.5)
HASHES, LEVELS = 24, 4
MAX_HELD = 400_000
RANGES, DRAWN = 8, 16  # ranges of ids for each shuffle partition; keys drawn for each range
_STRIP = b".,;:!?\"'()[]"
_UPPER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_SALT = mix(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


class _TermKeys(dict):
    """64-bit key of each word's term: lower case (A-Z), without punctuation at its ends; kept up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > MAX_HELD:
            self.clear()
        k = self[word] = xxhash.xxh3_64_intdigest(word.strip(_STRIP) or word)
        return k


def _terms(text: str, memo: _TermKeys) -> np.ndarray:
    """Distinct term keys, in no order."""
    keys = set(map(memo.__getitem__, set(text.encode().translate(_UPPER).split())))
    return np.fromiter(keys, dtype=np.uint64, count=len(keys))


def lexicon_of(texts: DataFrame, low: float = LOW, high: float = HIGH) -> np.ndarray:
    """Sorted keys of the terms in the band, from the document frequencies in all texts (column ``txt``)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, held, size = _TermKeys(), [], 0

        def out() -> pa.RecordBatch:
            key, n = np.unique(np.concatenate(held), return_counts=True) if held else (np.empty(0, np.uint64), np.empty(0, np.int64))
            return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], ["key", "n"])

        for b in slices(batches):
            for t in b.column("txt").to_pylist():
                held.append(_terms(t, memo))
                size += len(held[-1])
            if size > 8 * MAX_HELD:
                yield out()
                held, size = [], 0
        yield out()

    total = texts.count()
    frequency = texts.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    band = frequency.where((F.col("n") >= low * total) & (F.col("n") <= max(high * total, 1.0)))
    return np.sort(band.select("key").toPandas()["key"].to_numpy(dtype=np.int64).view(np.uint64))


@dataclass
class Prints:
    """Fingerprints of several texts. kind: ``l`` lexicon terms, ``a`` all terms, ``t`` no terms (then ``own`` is the text's hash)."""

    kind: np.ndarray  # one letter a text
    first: np.ndarray  # first of its levels
    hashes: np.ndarray  # texts x LEVELS x HASHES, 16 bits each; zero for a subset that holds no term
    own: list[str]

    def take(self, at) -> Prints:
        return Prints(self.kind[at], self.first[at], self.hashes[at], [self.own[i] for i in np.arange(len(self.own))[at]])

    def strings(self) -> list[str]:
        """``level:hashes/hashes/...`` behind the kind."""
        told = self.hashes.astype(">u2")
        return ["t" + o if k == "t" else f"{k}{f:02d}:" + h.tobytes().hex("/", 2 * HASHES) for k, f, h, o in zip(self.kind.tolist(), self.first.tolist(), told, self.own, strict=True)]


def fingerprints(texts: list[str], lexicon: np.ndarray, memo: _TermKeys) -> Prints:
    """Subset hashes of each text's lexicon terms at LEVELS levels around its own. A text without lexicon terms uses all its terms, one
    without terms its own hash. A subset takes the terms whose product with its salt begins with as many zero bits as the level
    says; its hash is of the sum of their values, so their order doesn't matter. All texts go through numpy at once, subset by subset."""
    terms = [_terms(t, memo) for t in texts]
    size = np.array([len(t) for t in terms], dtype=np.int64)
    flat, doc = np.concatenate([*terms, np.empty(0, dtype=np.uint64)]), np.repeat(np.arange(len(texts)), size)
    known = lexicon[np.minimum(np.searchsorted(lexicon, flat), len(lexicon) - 1)] == flat if len(lexicon) else np.zeros(len(flat), dtype=bool)
    count = np.bincount(doc[known], minlength=len(texts))
    kind = np.where(count > 0, "l", np.where(size > 0, "a", "t"))
    used = known | (kind[doc] == "a")
    flat, doc = flat[used], doc[used]
    first = np.maximum(np.frexp(np.bincount(doc, minlength=len(texts)))[1] - 2, 0)  # the exponent is the number of bits
    hashes = np.zeros((len(texts), LEVELS, HASHES), dtype=np.uint16)
    shift = (64 - first[doc]).astype(np.uint64)
    every = first[doc] == 0
    for s in range(HASHES):
        drawn = flat * _SALT[s]
        at = np.flatnonzero(every | (drawn >> np.minimum(shift, 63) == 0))
        d, drawn = doc[at], drawn[at]
        value = mix(drawn)
        for j in range(LEVELS):
            level = first[d] + j
            taken = (level == 0) | (drawn >> np.minimum(64 - level, 63).astype(np.uint64) == 0)
            sums = np.zeros(len(texts), dtype=np.uint64)
            np.add.at(sums, d[taken], value[taken])
            held = np.unique(d[taken])
            hashes[held, j, s] = np.maximum(mix(sums[held]) >> np.uint64(48), np.uint64(1))
    return Prints(kind, first, hashes, [xxhash.xxh3_128_hexdigest(t.encode()) if k == "t" else "" for t, k in zip(texts, kind.tolist(), strict=True)])


def compare(a: Prints, b: Prints) -> np.ndarray:
    """Likeness of each fingerprint of ``a`` to the one of ``b`` at its place: the share of equal subset hashes at a level that both have, among
    subsets that hold a term of either (0 to 1); the best such level counts. Texts without terms are alike if equal."""
    best = np.zeros(len(a.own))
    comparable = (a.kind == b.kind) & (a.kind != "t")
    for apart in range(1 - LEVELS, LEVELS):  # how much higher the levels of b begin
        at = np.flatnonzero(comparable & (b.first - a.first == apart))
        for j in range(max(0, apart), LEVELS + min(0, apart)) if len(at) else ():
            x, y = a.hashes[at, j], b.hashes[at, j - apart]
            some = (x > 0) | (y > 0)
            n = some.sum(axis=1)
            best[at] = np.maximum(best[at], np.divide(((x == y) & some).sum(axis=1), n, out=np.zeros(len(at)), where=n > 0))
    best[(a.kind == "t") & (b.kind == "t") & (np.array(a.own, dtype=object) == np.array(b.own, dtype=object))] = 1.0
    return best


def fingerprint(text: str, lexicon: np.ndarray, memo: _TermKeys) -> str:
    return fingerprints([text], lexicon, memo).strings()[0]


def parse(told: list[str]) -> Prints:
    """Fingerprints from their strings."""
    plain = [t[0] == "t" for t in told]
    none = np.zeros((LEVELS, HASHES), dtype=np.uint16)
    hashes = [none if p else np.frombuffer(bytes.fromhex(t[4:].replace("/", "")), dtype=">u2").reshape(LEVELS, HASHES) for t, p in zip(told, plain, strict=True)]
    return Prints(np.array([t[0] for t in told]), np.array([0 if p else int(t[1:3]) for t, p in zip(told, plain, strict=True)]), np.array(hashes, dtype=np.uint16),
                  [t[1:] if p else "" for t, p in zip(told, plain, strict=True)])


def likeness(a: str, b: str) -> float:
    return float(compare(parse([a]), parse([b]))[0])


_RESULT = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by as much of the next text's beginning."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def _joined(a: Prints, b: Prints) -> Prints:
    return Prints(np.concatenate((a.kind, b.kind)), np.concatenate((a.first, b.first)), np.concatenate((a.hashes, b.hashes)), a.own + b.own)


def _range_starts(keys: DataFrame, ranges: int) -> list[tuple[int, int]]:
    """First keys (doc, tie) of about ``ranges`` ranges of equal size: the smallest key of all and keys drawn by their hash, all of them met in
    the table."""
    step = max(1, keys.count() // (ranges * DRAWN))
    drawn = keys.where(F.pmod(F.xxhash64("doc", "tie"), F.lit(step)) == 0).distinct()
    least = keys.agg(F.min("doc").alias("doc"))  # the smallest tie of the smallest id is looked up afterwards
    first = keys.join(F.broadcast(least), "doc").agg(F.min("doc"), F.min("tie")).first()
    if first[0] is None:
        return []
    order = sorted((r.doc, r.tie) for r in drawn.collect())  # about ranges x DRAWN keys
    return sorted({tuple(first), *order[:: max(1, -(-len(order) // ranges))]})


def imatch_edits(docs: DataFrame, keep: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The columns in ``keep`` and, per row: ``n_chars``, ``edited_sha256`` and ``edited_fingerprint`` (of the edited text), ``fingerprint``,
    ``near_edited`` and ``near_next`` (likeness to the edited text and to the next document).

    The next document is the following row by id, then by the text's hash (the last row's: the first), so equal rows follow one
    another; null ids come last. A null text is empty; the edit of a text under four characters changes nothing. The lexicon comes from all
    texts. An empty table gives an empty result; other columns are ignored.

    Texts are dealt once, into ranges of ids. A range ends with a copy of the next range's first row (the last range's: of the very first), so every
    row meets its successor and nothing is written in between."""
    spark = docs.sparkSession
    lexicon = spark.sparkContext.broadcast(lexicon_of(keyed_texts(docs, id_col, text_col)))
    source = docs.select(F.struct(*keep).alias("row"), order_key(F.col(id_col), F.col(text_col)).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("txt"))
    source = source.withColumn("tie", F.xxhash64("txt"))
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    starts = _range_starts(source.select("doc", "tie"), shards * RANGES)

    @F.pandas_udf("int")
    def range_of(doc: pd.Series, tie: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(starts, k) - 1 for k in zip(doc.tolist(), tie.tolist(), strict=True)], dtype="int32")

    firsts = spark.createDataFrame([(d, t, (i or len(starts)) - 1) for i, (d, t) in enumerate(starts)], "doc long, tie long, part int")
    ends = source.join(F.broadcast(firsts), ["doc", "tie"]).select("row", "txt", "doc", "tie", "part", F.lit(True).alias("end")).dropDuplicates(["part"])
    dealt = source.select("row", "txt", "doc", "tie", range_of("doc", "tie").alias("part"), F.lit(False).alias("end")).unionByName(ends)
    dealt = dealt.repartition(shards, "part").sortWithinPartitions("part", "end", "doc", "tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, last = _TermKeys(), None  # last: row, text and fingerprint that still wait for their successor
        for b in slices(batches):
            kind, row, end = b.schema.field("row").type, b.column("row"), b.column("end").to_pylist()
            texts = b.column("txt").to_pylist()
            own = fingerprints(texts, lexicon.value, memo)
            rows = pa.concat_arrays([last[0], row]) if last else row
            if last:
                texts, end, own = [last[1], *texts], [False, *end], _joined(last[2], own)
            at = np.array([i for i in range(len(texts) - 1) if not end[i]], dtype=np.int64)
            edited = [_edited(texts[i], texts[i + 1]) for i in at.tolist()]
            changed, mine = fingerprints(edited, lexicon.value, memo), own.take(at)
            columns = [rows.take(pa.array(at)).cast(kind), pa.array([len(texts[i]) for i in at.tolist()], pa.int64()), pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
                       pa.array(mine.strings(), pa.string()), pa.array(changed.strings(), pa.string()), pa.array(compare(mine, changed)), pa.array(compare(mine, own.take(at + 1)))]
            yield pa.RecordBatch.from_arrays(columns, ["row", *(f.split()[0] for f in _RESULT.split(", "))])
            k = len(texts) - 1
            last = None if end[k] else (rows.slice(k, 1), texts[k], own.take(np.array([k])))

    kind = source.schema["row"].dataType.simpleString()
    found = dealt.select("row", "txt", "end").mapInArrow(run, f"row {kind}, {_RESULT}")
    return found.select("row.*", *(f.split()[0] for f in _RESULT.split(", ")))
