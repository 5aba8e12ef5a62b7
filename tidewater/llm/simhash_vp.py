"""SimHash near-dedup: 64-bit fingerprints of word shingles, linked by Hamming distance through vantage-point trees.

Equal fingerprints are one class before anything is compared. Two fingerprints at distance <= d have a fingerprint
between them at distance <= ceil(d / 2) from both, so each class is sent into every leaf that a ball of that radius
around it reaches; the pair meets in the leaf that holds the one between. At a node with vantage point v
and radius r the triangle bound sends x inside if dist(v, x) <= r + radius and outside if dist(v, x) > r - radius. A tree
fitted on a bounded sample deals the classes to shards; inside a shard the same split goes on until a leaf is small, and
leaves are compared exactly. A leaf hands out a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import keyed_texts, materialize, shown_id, slices
from tidewater.llm.components import components

SAMPLE = 1 << 13  # fingerprints (about) on which the sharding tree is fitted; never more than an eighth of them
LEAF = 512  # classes compared with each other directly
_UPPER = bytes(range(65, 91)), bytes(range(97, 123))


def fingerprints(texts: list[str], shingle: int) -> np.ndarray:
    """Majority bits of the shingles' XXH64 (seed 42), per text; zero without words."""
    lower, hash64 = bytes.maketrans(*_UPPER), xxhash.xxh64_intdigest
    out = np.zeros(len(texts), dtype=np.uint64)
    for i, text in enumerate(texts):
        words = text.encode().translate(lower).split()
        if not words:
            continue
        joined = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = np.concatenate(([0], ends[:-1]))
        n = max(1, len(words) - shingle + 1)
        spans = zip(starts[:n].tolist(), (ends[len(ends) - n :] - 1).tolist(), strict=True)
        h = np.fromiter((hash64(joined[a:b], 42) for a, b in spans), dtype=">u8", count=n)
        ones = np.zeros(64, dtype=np.int64)
        for part in range(0, n, 1 << 14):  # bounds the unpacked bits of a long text
            ones += np.unpackbits(h[part : part + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        out[i] = np.packbits(2 * ones > n).view(">u8")[0]
    return out


def _split(x: np.ndarray, vantage: np.uint64, cut: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    d = np.bitwise_count(x ^ vantage).astype(np.int64)
    return d <= cut + radius, d > cut - radius


def fit_tree(sample: np.ndarray, depth: int) -> list[tuple[int, int] | None]:
    """Vantage points and cuts in heap order: the vantage point is the first of the node's sample, the cut its median distance."""
    nodes: list[tuple[int, int] | None] = [None] * (2**depth - 1)

    def fit(at: int, x: np.ndarray) -> None:
        if at >= len(nodes) or len(x) < 16:
            return
        d = np.bitwise_count(x ^ x[0])
        cut = int(np.median(d))
        inside = d <= cut
        if inside.all():
            return
        nodes[at] = (int(x[0]), cut)
        fit(2 * at + 1, x[inside])
        fit(2 * at + 2, x[~inside])

    fit(0, sample)
    return nodes


def leaves_of(nodes: list[tuple[int, int] | None], x: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(leaf, index into x) of every leaf that the ball around each fingerprint reaches."""
    out: list[tuple[int, np.ndarray]] = []

    def go(at: int, idx: np.ndarray) -> None:
        if not len(idx):
            return
        if at >= len(nodes) or nodes[at] is None:
            out.append((at, idx))
            return
        near, far = _split(x[idx], np.uint64(nodes[at][0]), nodes[at][1], radius)
        go(2 * at + 1, idx[near])
        go(2 * at + 2, idx[far])

    go(0, np.arange(len(x)))
    leaf = np.concatenate([np.full(len(i), at) for at, i in out] or [np.empty(0, dtype=np.int64)])
    return leaf, np.concatenate([i for _, i in out] or [np.empty(0, dtype=np.int64)])


def _forest(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of a[i] and b[i] in ``parent`` (smallest index is the root), many at a time."""
    while len(a):
        while True:  # compress
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up
        ra, rb = parent[a], parent[b]
        differ = ra != rb
        a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))


def link_shard(x: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links among the distinct fingerprints of one shard, as pairs of indexes."""
    radius = (distance + 1) // 2
    parent = np.arange(len(x))

    def block(i: np.ndarray, j: np.ndarray) -> None:
        p, q = np.nonzero(np.bitwise_count(x[i][:, None] ^ x[j][None, :]) <= distance)
        _forest(parent, i[p], j[q])

    todo = [np.arange(len(x))]
    while todo:
        idx = todo.pop()
        if len(idx) > LEAF:
            v = x[idx[len(idx) // 2]]
            cut = int(np.median(np.bitwise_count(x[idx] ^ v)))
            parts = _split(x[idx], v, cut, radius)
            if max(p.sum() for p in parts) < 0.9 * len(idx):
                todo += [idx[p] for p in parts]
                continue
        cuts = [idx[k : k + LEAF] for k in range(0, len(idx), LEAF)]
        for k, i in enumerate(cuts):
            for j in cuts[k:]:
                block(i, j)
    a = np.flatnonzero(parent != np.arange(len(x)))
    return a, parent[a]


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 2) -> DataFrame:
    """One row per input row: the id, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest id reachable over links
    of at most ``distance`` bits (itself included); also ``key``, ``component_key`` (``common.order_key`` of the row and of its component's first),
    ``component_fp`` (a fingerprint of the component, alike in all its rows) and ``text_hash``, for joining results to rows. Rows that share an id
    but not the text are linked by their fingerprints only.

    A null or wordless text has fingerprint zero and links like any other; fewer words than a shingle give one
    shingle of them all. Rows with a null id come after all others, as documents of their own, and a component of such rows alone
    has the id null. Equal rows are one class. An empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    texts = keyed_texts(docs, id_col, text_col)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            fp = fingerprints(b.column("txt").to_pylist(), shingle)
            yield pa.RecordBatch.from_arrays([b.column("doc"), b.column("text_hash"), pa.array(fp.view(np.int64))], ["doc", "text_hash", "fp"])

    marked = materialize(texts.withColumn("text_hash", F.xxhash64("txt")).mapInArrow(mark, "doc long, text_hash long, fp long"), "simhash-marked")
    classes = materialize(marked.groupBy("fp").agg(F.min("doc").alias("head")), "simhash-classes")
    count = classes.count()
    step = max(8, count // SAMPLE)
    sample = classes.where(F.pmod(F.xxhash64("fp"), F.lit(step)) == 0).select("fp").limit(2 * SAMPLE).toPandas()["fp"].to_numpy(dtype=np.int64).view(np.uint64)
    sample = sample[np.argsort(sample * np.uint64(0x9E3779B97F4A7C15))]
    depth = min(12, max(0, int(count // 4000).bit_length() + 1))
    nodes = fit_tree(sample, depth) if count > LEAF and len(sample) else []
    radius = (distance + 1) // 2

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column("fp").to_numpy().view(np.uint64)
            leaf, idx = leaves_of(nodes, fp, radius)
            yield pa.RecordBatch.from_arrays([pa.array(leaf.astype(np.int32)), b.column("fp").take(pa.array(idx))], ["leaf", "fp"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
        if not held:
            return
        table = pa.concat_tables(held)
        leaf, fp = (table.column(k).to_numpy() for k in ("leaf", "fp"))
        order = np.argsort(leaf, kind="stable")
        for idx in np.split(order, np.flatnonzero(np.diff(leaf[order])) + 1):
            a, b = link_shard(fp[idx].view(np.uint64), distance)
            yield pa.RecordBatch.from_arrays([pa.array(fp[idx][a]), pa.array(fp[idx][b])], ["a", "b"])

    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), len(nodes) + 1)
    dealt = classes.select("fp").mapInArrow(deal, "leaf int, fp long").repartition(shards, "leaf")
    links = dealt.mapInArrow(link, "a long, b long")
    grouped = classes.join(components(links), F.col("fp") == F.col("node"), "left").select("fp", "head", F.coalesce("component", "fp").alias("component_fp"))
    named = grouped.join(grouped.groupBy("component_fp").agg(F.min("head").alias("component")), "component_fp").select("fp", "component_fp", "component")
    kind = docs.schema[id_col].dataType
    return marked.join(named, "fp").select(
        shown_id("doc", kind).alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), shown_id("component", kind).alias("component_id"),
        F.col("doc").alias("key"), F.col("component").alias("component_key"), "component_fp", "text_hash",
    )
