"""Exact substring dedup over windows of words: count-min prefilter, then exact grouping.

Pass 1 fills a count-min sketch per partition and merges them (``pieces.build_sketch``). Pass 2
reads the texts again and keeps only pieces (runs of windows) that the sketch estimates repeated;
it writes their content hash and the hashes of their windows. Identical pieces are grouped
first: every copy outside the smallest document goes as a whole, without its windows being
listed, and a piece that is alone with its anchor has no other place to recur. The windows of what is left are grouped exactly by a 96-bit hash; each window has one
first document, and windows of later documents are removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import byte_total, keyed_texts, materialize, order_key, slices
from tidewater.llm.pieces import Rolling, build_sketch, find_pieces, repeated, sketch_width

TAG_BITS = 24  # of a text's hash, in front of the word number: rows that share an id but not the text stay apart
AT_BITS = 63 - TAG_BITS


class _WordHashes(dict):
    """Hash of each word, kept between slices up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _tag(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text) >> (64 - TAG_BITS)


def _words(batch: pa.RecordBatch, memo: _WordHashes) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    texts = [t.encode() for t in batch.column("txt").to_pylist()]
    words: list[bytes] = []
    ends = np.empty(len(texts), dtype=np.int64)
    for i, t in enumerate(texts):
        words += t.split()
        ends[i] = len(words)
    return np.fromiter(map(memo.__getitem__, words), dtype=np.uint64, count=len(words)), ends, texts


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50, keep: list[str] | None = None) -> DataFrame:
    """One row per input row: the columns in ``keep`` (the id), ``n_words``, ``n_removed`` and ``kept`` (kept words joined by one space).

    A word goes if a window of ``window`` words that covers it also starts in a document with a smaller id.
    A null text has no words; rows with a null id come after all others, as documents of their own; texts shorter than a window stay whole. Equal rows (same id,
    same text) don't remove each other and get equal results; rows that share an id but not the text are judged one by one.
    An empty table gives an empty result. Other columns are ignored. Nothing is capped: a full sketch only widens pass 2.
    """
    spark, keep = docs.sparkSession, keep or [id_col]
    texts = keyed_texts(docs, id_col, text_col)
    gram = max(1, window // 2)
    width = sketch_width(byte_total(texts) / 6 * 2 / (window - gram + 2))

    def anchors_of(b: pa.RecordBatch) -> np.ndarray:
        symbols, ends, _ = _words(b, memo)
        found = find_pieces(symbols, ends, window, gram)
        if found is None:
            return np.empty(0, dtype=np.uint64)
        order = np.lexsort((found.anchor, found.row))  # each anchor once a document
        row, anchor = found.row[order], found.anchor[order]
        new = np.ones(len(row), dtype=bool)
        new[1:] = (row[1:] != row[:-1]) | (anchor[1:] != anchor[:-1])
        return anchor[new]

    memo = _WordHashes()
    bits = spark.sparkContext.broadcast(build_sketch(texts, anchors_of, slices, width))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _WordHashes()
        for b in slices(batches):
            symbols, ends, raw = _words(b, memo)
            found = find_pieces(symbols, ends, window, gram)
            keep = np.flatnonzero(repeated(bits.value, found.anchor)) if found is not None else []
            if not len(keep):
                continue
            start, count, row = found.start[keep], found.count[keep], found.row[keep]
            doc = np.array(b.column("doc").to_pylist(), dtype=np.int64)
            base = ends - np.diff(ends, prepend=0)
            tags = np.array([_tag(t) for t in raw], dtype=np.int64) << AT_BITS
            other = Rolling(symbols, 1)
            end = start + count + window - 1
            w1, w2 = found.rolling.fixed(window).view(np.int64), (other.fixed(window) >> np.uint64(32)).astype(np.uint32)
            spans = [(int(s), int(s + c)) for s, c in zip(start, count, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(found.rolling.ranges(start, end).view(np.int64)), pa.array(other.ranges(start, end).view(np.int64)), pa.array(found.anchor[keep].view(np.int64)),
                    pa.array(doc[row]), pa.array(tags[row] + start - base[row]), pa.array(count.astype(np.int32)),
                    pa.array([w1[s:e].tobytes() for s, e in spans], pa.binary()), pa.array([w2[s:e].tobytes() for s, e in spans], pa.binary()),
                ],
                ["p1", "p2", "anchor", "doc", "at", "n", "w1", "w2"],
            )

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in slices([b], "w1", 1 << 20):
                n = np.array(s.column("n").to_pylist(), dtype=np.int64)
                if not len(n):
                    continue
                within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                col = lambda k: np.repeat(np.array(s.column(k).to_pylist(), dtype=np.int64), n)  # noqa: B023,E731
                h1 = np.frombuffer(b"".join(s.column("w1").to_pylist()), dtype=np.int64)
                h2 = np.frombuffer(b"".join(s.column("w2").to_pylist()), dtype=np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(h1), pa.array(h2), pa.array(col("doc")), pa.array(col("at") + within)], ["h1", "h2", "doc", "at"])

    pieces = materialize(texts.mapInArrow(candidates, "p1 long, p2 long, anchor long, doc long, at long, n int, w1 binary, w2 binary"), "substring-pieces")
    first = materialize(pieces.groupBy("p1", "p2").agg(F.min("doc").alias("head"), F.max("doc").alias("tail"), F.min("anchor").alias("anchor")), "substring-kinds")
    shared = first.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1").select("anchor")
    mixed = first.join(shared, "anchor").select("p1", "p2", "head")  # a window can only recur in another piece of its anchor
    copied = first.where("head < tail").select("p1", "p2", "head")
    copies = pieces.select("p1", "p2", "doc", "at", "n").join(copied, ["p1", "p2"]).where("doc > head").select("doc", "at", "n")
    heads = pieces.join(mixed, ["p1", "p2"]).where("doc = head").select("doc", "at", "n", "w1", "w2")
    each = materialize(heads.mapInArrow(windows, "h1 long, h2 int, doc long, at long"), "substring-windows")
    owner = each.groupBy("h1", "h2").agg(F.min("doc").alias("head"), F.max("doc").alias("tail")).where("head < tail").drop("tail")
    later = each.join(owner, ["h1", "h2"]).where("doc > head").select("doc", "at", F.lit(1).alias("n"))
    spans = copies.unionByName(later).groupBy("doc").agg(F.collect_list(F.struct("at", "n")).alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            n_words, n_removed, kept = [], [], []
            for text, doc_spans in zip(b.column("txt").to_pylist(), b.column("spans"), strict=True):
                raw = text.encode()
                words = raw.split()
                if doc_spans.is_valid:
                    flat = doc_spans.values
                    at, n = (flat.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                    mine = at >> AT_BITS == _tag(raw)
                    at, n = at[mine] & ((1 << AT_BITS) - 1), n[mine]
                    edge = np.zeros(len(words) + 1, dtype=np.int64)
                    np.add.at(edge, at, 1)
                    np.add.at(edge, np.minimum(at + n + window - 1, len(words)), -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    left = [words[i] for i in np.flatnonzero(~gone)]
                else:
                    left = words
                n_words.append(len(words))
                n_removed.append(len(words) - len(left))
                kept.append(b" ".join(left).decode())
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())], ["row", "n_words", "n_removed", "kept"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(F.struct(*keep).alias("row"), order_key(F.col(id_col), text).alias("doc"), text.alias("txt"))
    joined = source.join(spans, "doc", "left").select("row", "txt", "spans")
    kind = joined.schema["row"].dataType.simpleString()
    return joined.mapInArrow(cut, f"row {kind}, n_words long, n_removed long, kept string").select("row.*", "n_words", "n_removed", "kept")
