"""Toxicity by compression distance: each window of words is compressed with two zstandard dictionaries.

The ordinary dictionary is trained on ordinary text. The toxic one isn't trained by zstandard (that tells the classes apart badly, README):
it holds the same content followed by all words of the toxic sample that carry byte sequences significantly more frequent in
toxic documents, so a window becomes shorter with it only where it resembles toxic text. Per document the differences of all windows are
summed up in a few figures, and a logistic curve calibrated on other labelled documents turns them into a score.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import slices

WINDOW, STRIDE = 6, 3  # words
DICTIONARY = 60_000  # bytes of ordinary content; the toxic words are as many as the sample shows
GRAM, MARKED, SHARE = 5, 15.0, 20.0  # byte grams; least G-squared; least ratio of document shares
SAMPLE, SAMPLE_TEXT = 2000, 1 << 15  # the bound on what the model is fitted on: texts per class, bytes of each
_UPPER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


@dataclass
class ToxicityModel:
    """Dictionary contents and the logistic curve over the summed-up differences."""

    ordinary: bytes
    toxic: bytes
    weights: list[float]

    def scorer(self):
        plain, marked = _compressor(self.ordinary), _compressor(self.ordinary + self.toxic)
        w = np.array(self.weights)
        return lambda text: float(1 / (1 + np.exp(-np.clip(w[0] + w[1:] @ _figures(plain, marked, text), -30, 30))))


def _compressor(content: bytes):
    settings = zstandard.ZstdCompressionParameters.from_level(
        3, source_size=64, dict_size=len(content), min_match=GRAM, strategy=zstandard.STRATEGY_DFAST, write_content_size=0, write_checksum=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS
    )
    held = zstandard.ZstdCompressionDict(content or b" ", dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    held.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(dict_data=held, compression_params=settings).compress


def _words(text: str) -> list[bytes]:
    return text.encode().translate(_UPPER).split()


def _figures(plain, marked, text: str) -> np.ndarray:
    """How much shorter windows get with the toxic content: largest, mean of the top three, shares of clear ones, log of their count."""
    words = _words(text)
    if not words:
        return np.zeros(5)
    windows = [b" " + b" ".join(words[i : i + WINDOW]) + b" " for i in range(0, max(1, len(words) - (WINDOW - STRIDE)), STRIDE)]
    gain = np.array([len(plain(w)) - len(marked(w)) for w in windows])
    top = np.sort(gain)[-3:]
    clear = gain >= 4
    return np.array([top[-1] / 4, top.mean() / 4, 4 * (gain >= 3).mean(), 4 * clear.mean(), np.log1p(clear.sum())])


def _significance(x: int, y: int, n: int, m: int) -> float:
    """G-squared of x of n toxic against y of m ordinary documents."""
    p = (x + y) / (n + m)
    part = lambda k, size, q: (k * math.log(q) if k else 0.0) + ((size - k) * math.log(1 - q) if k < size else 0.0)
    return 2 * (part(x, n, x / n) + part(y, m, y / m) - part(x, n, p) - part(y, m, p))


def _without_copies(texts: list[str]) -> list[str]:
    """Texts that don't repeat the five-word sequences of earlier ones, so that copies count once."""
    seen: set[int] = set()
    out = []
    for t in texts:
        w = _words(t)
        own = {hash(b" ".join(w[i : i + 5])) for i in range(max(1, len(w) - 4))}
        if len(own & seen) <= 0.2 * len(own):
            out.append(t)
        seen |= own
    return out


def _toxic_content(toxic: list[str], ordinary: list[str]) -> bytes:
    def document_counts(texts: list[str], keys) -> Counter:
        c: Counter = Counter()
        for t in texts:
            c.update(keys(_words(t)))
        return c

    def grams(words: list[bytes]) -> set[bytes]:
        b = b" " + b" ".join(words) + b" "
        return {b[i : i + GRAM] for i in range(len(b) - GRAM + 1)}

    n, m = len(toxic), len(ordinary)
    in_toxic, in_ordinary = document_counts(toxic, grams), document_counts(ordinary, grams)
    marks = {g for g, x in in_toxic.items() if x >= 3 and x * m >= SHARE * in_ordinary[g] * n and _significance(x, in_ordinary[g], n, m) >= MARKED}
    words, plain = document_counts(toxic, set), document_counts(ordinary, set)
    least = 1 + n // 400  # documents: with many examples, words of one alone tell nothing
    ranked = sorted((w for w, x in words.items() if x >= least and x * m >= 4 * plain[w] * n), key=lambda w: (-words[w], w))
    chosen = []
    for w in ranked:
        b = b" " + w + b" "
        if any(b[i : i + GRAM] in marks for i in range(len(b) - GRAM + 1)):
            chosen.append(w)
    return b" " + b" ".join(reversed(chosen)) + b" " if chosen else b""


def _ordinary_content(texts: list[str]) -> bytes:
    joined = [b" ".join(_words(t)) for t in texts]
    parts = [j[i : i + 120] for j in joined for i in range(0, len(j), 120)]
    try:
        return zstandard.train_dictionary(DICTIONARY + 1000, parts).as_bytes()[-DICTIONARY:]
    except zstandard.ZstdError:  # too little text to train on: the text itself
        return b" ".join(parts)[-DICTIONARY:]


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression with a small ridge, by Newton steps; the slopes stay non-negative (more toxic is never less)."""
    active = list(range(x.shape[1]))
    while True:
        a = np.column_stack((np.ones(len(x)), x[:, active]))
        w = np.zeros(a.shape[1])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
            ridge = np.full(len(w), 0.02)
            ridge[0] = 1e-6
            step = np.linalg.solve((a * (weight * p * (1 - p))[:, None]).T @ a + np.diag(ridge), a.T @ (weight * (y - p)) - ridge * w)
            w += np.clip(step, -5, 5)
            if np.abs(step).max() < 1e-8:
                break
        if (w[1:] >= 0).all():
            break
        active = [k for k, v in zip(active, w[1:], strict=True) if v > 0]
    out = np.zeros(x.shape[1] + 1)
    out[0] = w[0]
    out[1 + np.array(active, dtype=int)] = w[1:]
    return out


def fit_toxicity(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text") -> ToxicityModel | None:
    """Fit on a bounded sample: per class the SAMPLE documents (of at most SAMPLE_TEXT bytes) that come first by the hash of
    their ids, among labelled ones where ``usable`` (a condition on ``labels``) holds. Two thirds give the dictionaries, one third the curve,
    with the classes weighed as in all usable labels. None if a class has too few examples (under 3)."""
    marked = labels.where(usable).where("toxic in (0, 1)").groupBy(F.col("doc_id").alias("__id")).agg(F.max("toxic").alias("__toxic"))
    fitting = docs.where(F.octet_length(text_col).between(1, SAMPLE_TEXT))
    known = marked.join(fitting.select(F.col(id_col).alias("__id")).distinct(), "__id")
    shares = {r["__toxic"]: r["count"] for r in known.groupBy("__toxic").count().collect()}
    if min(shares.get(0, 0), shares.get(1, 0)) < 3:
        return None
    by = F.xxhash64("__id")
    chosen = [known.where(F.col("__toxic") == k).orderBy(by, "__id").limit(SAMPLE) for k in (0, 1)]
    ids = F.broadcast(chosen[0].unionByName(chosen[1]))  # 2 x SAMPLE ids at most
    rows = fitting.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(ids, "__id").dropDuplicates(["__id"]).orderBy(by, "__id")
    texts: dict[int, list[str]] = {0: [], 1: []}
    for r in rows.collect():
        texts[r["__toxic"]].append(r["__text"])
    train, rest = {}, {}
    for k, all_ in texts.items():
        every = _without_copies(all_)
        train[k] = [t for i, t in enumerate(every) if i % 3]
        rest[k] = [t for i, t in enumerate(every) if i % 3 == 0]
    if not train[0] or not train[1] or not rest[0] or not rest[1]:
        return None
    model = ToxicityModel(_ordinary_content(train[0]), _toxic_content(train[1], train[0]), [])
    plain, both = _compressor(model.ordinary), _compressor(model.ordinary + model.toxic)
    x = np.array([_figures(plain, both, t) for k in (0, 1) for t in rest[k]])
    y = np.repeat([0.0, 1.0], [len(rest[0]), len(rest[1])])
    weight = np.where(y == 1, shares[1] / len(rest[1]), shares[0] / len(rest[0]))
    model.weights = _logistic(x, y, weight * len(y) / weight.sum()).tolist()
    return model


def score_toxicity(docs: DataFrame, model: ToxicityModel | None, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns in ``keep`` and ``score`` (0 to 1) of every row; whole texts, every window. A null text scores like an empty one (no
    window resembles toxic text); without a model every score is 0. Nothing but the text enters a score."""
    if model is None:
        return docs.select(*keep, F.lit(0.0).alias("score"))
    source = docs.select(F.struct(*keep).alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("txt"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array([score(t) for t in b.column("txt").to_pylist()], pa.float64())], ["row", "score"])

    kind = source.schema["row"].dataType.simpleString()
    return source.mapInArrow(run, f"row {kind}, score double").select("row.*", "score")
