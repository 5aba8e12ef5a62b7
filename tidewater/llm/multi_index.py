"""Near-duplicate vectors by cosine with an inverted multi-index.

Unit vectors are cut into halves, and each half has a codebook of its own (k-means on a bounded sample); the cells of
the product grid are pairs of centroids. Every distinct vector stands in the cell of its two nearest centroids. A query visits
cells in multi-sequence order (by the sum of its distances to the two centroids) and stops after as many cells as brought the target recall
for a bounded set of queries that were compared with all others; where that isn't known or isn't enough, a query goes wherever its distances
to the centroids don't prove that no link is left. A pair is looked up from its smaller member, each candidate is verified
by its cosine in double precision, and a cell's task hands out counts and a spanning forest, never pairs. The number of cells follows
the number of vectors up to a bound, and crowded cells are split.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import materialize, order_key, shown_id
from tidewater.llm.components import components
from tidewater.llm.simhash_vp import _forest

SAMPLE = 8192  # vectors the codebooks are fitted on
PROBES, PROBE_BLOCK = (256, 1024, 8192), 4096  # queries that calibrate the traversal, more as long as few have links; rows compared with them at a time
LINKED = 64  # queries with links that a calibration needs
PER_CELL = 8  # vectors per cell on average that the grid is sized for
MAX_CODES = 256  # centroids a half, so 65,536 cells
MAX_VISITS = 128
RECALL = 0.999
BLOCK = 1024  # vectors of a cell compared at a time
DEALT = 1 << 14  # rows of a batch that goes to the cells
CROWD = 4096  # vectors of a cell that a task holds; the vectors of fuller cells are dealt to several, and visitors go to each


def _unit(column: pa.Array, dim: int) -> np.ndarray:
    v = np.frombuffer(b"".join(column.to_pylist()), dtype="<f8").reshape(-1, dim) if len(column) else np.empty((0, dim))
    return v


def _kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centroids of the rows of x: spread starts taken at equal steps through the sample, then Lloyd's steps; empty ones stay."""
    k = min(k, len(x))
    c = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = _distances(x, c).argmin(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=k)
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return c


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ c.T + (c * c).sum(axis=1)[None, :], 0.0)


def cells_of(x: np.ndarray, books: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    half = x.shape[1] // 2
    a, b = _distances(x[:, :half], books[0]).argmin(axis=1), _distances(x[:, half:], books[1]).argmin(axis=1)
    return a * len(books[1]) + b


def visits(x: np.ndarray, books: tuple[np.ndarray, np.ndarray], count: int) -> np.ndarray:
    """The ``count`` nearest cells of each row, nearest first (fewer if the grid is smaller): the multi-sequence algorithm.

    Both lists of centroids are sorted by distance; a cell (i, j) of the sorted grid can come next only when (i - 1, j) and
    (i, j - 1) are out, so the heap stays small."""
    half, width = x.shape[1] // 2, len(books[1])
    da, db = _distances(x[:, :half], books[0]), _distances(x[:, half:], books[1])
    oa, ob = da.argsort(axis=1), db.argsort(axis=1)
    sa, sb = np.take_along_axis(da, oa, 1).tolist(), np.take_along_axis(db, ob, 1).tolist()
    count = min(count, len(books[0]) * width)
    out = np.empty((len(x), count), dtype=np.int64)
    for r in range(len(x)):
        u, v, n, done = sa[r], sb[r], 0, {}
        heap = [(u[0] + v[0], 0, 0)]
        while n < count:
            _, i, j = heapq.heappop(heap)
            out[r, n] = oa[r, i] * width + ob[r, j]
            n += 1
            done[i] = j  # cells (i, 0..j) are out
            if i + 1 < len(u) and (j == 0 or done.get(i + 1, -1) == j - 1):
                heapq.heappush(heap, (u[i + 1] + v[j], i + 1, j))
            if j + 1 < len(v) and (i == 0 or done.get(i - 1, -1) > j):
                heapq.heappush(heap, (u[i] + v[j + 1], i, j + 1))
    return out


def _rank(sa: np.ndarray, sb: np.ndarray, s: np.ndarray) -> np.ndarray:
    """How many cells come before one at distance ``s`` (ties included), from the sorted distances to both lists of centroids."""
    return np.searchsorted(sb, s[:, None] - sa[None, :] + 1e-12, side="right").sum(axis=1) - 1


def _apart(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Least squared distance of each row to any point that is nearest to each centroid: how far away the plane midway between that
    centroid and the row's own is."""
    d = _distances(x, book)
    own = d.argmin(axis=1)
    between = np.sqrt(_distances(book, book))[own]
    far = between > 1e-6
    return np.where(far, np.maximum(d - d.min(axis=1)[:, None], 0.0) / (2 * np.where(far, between, 1.0)), 0.0) ** 2


def calibrate(found: list[tuple[int, int, int]], recall: float) -> int | None:
    """Visits that bring the recall of the probes with links (rows: probe, rank of a cell, links in it; at least LINKED probes): the mean over the probes
    less two standard errors reaches ``recall``, so a few lucky probes don't stop the traversal early. None if no count up to MAX_VISITS is known to."""
    if not found or len({f[0] for f in found}) < LINKED:
        return None
    probe, rank, n = np.array(found, dtype=np.int64).T
    _, probe = np.unique(probe, return_inverse=True)
    share = np.zeros((probe.max() + 1, MAX_VISITS + 1))
    np.add.at(share, (probe, rank), n / np.bincount(probe, weights=n)[probe])
    reach = np.cumsum(share, axis=1)[:, :MAX_VISITS]
    sure = reach.mean(axis=0) - 2 * reach.std(axis=0) / len(reach) ** 0.5
    enough = np.flatnonzero(sure >= recall - 1e-12)
    return int(enough[0]) + 1 if len(enough) else None


def embedding_groups(vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding", recall: float = RECALL) -> DataFrame:
    """One row per input row: the id, ``n_links`` (other rows with a cosine of at least ``threshold``, as found), ``component_id`` (smallest
    id reachable over links) and ``kept`` (the row is its component's first).

    Vectors that are null, zero, empty or hold null or non-finite components link with nothing, and neither do vectors of
    other lengths than the most frequent one, except with equal ones. Equal vectors are one class and link with each other; a class is
    compared once. Rows with a null id come after all others, and a component of such rows alone has the id null. An empty table
    gives an empty result; other columns are ignored. Searched are all rows: each visits the cells that its calibrated
    traversal reaches, or all that can hold a link."""
    spark = vectors.sparkSession
    values = F.transform(F.col(vector_col), lambda v: v.cast("double"))
    rows = vectors.select(order_key(F.col(id_col), F.col(vector_col)).alias("vec"), values.alias("v"))
    sound = F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))) & F.exists("v", lambda c: c != 0)
    rows = rows.withColumn("v", F.when(F.coalesce(sound, F.lit(False)), F.col("v")))

    def normalise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for v in b.column("v"):
                x = v.values.to_numpy(zero_copy_only=False) if v.is_valid else None
                if x is not None:
                    x = x / np.abs(x).max()  # squares neither overflow nor vanish
                    x = (x / np.linalg.norm(x) + 0.0).astype("<f8").tobytes()
                out.append(x)
            yield pa.RecordBatch.from_arrays([b.column("vec"), pa.array(out, pa.binary())], ["vec", "unit"])

    units = materialize(rows.mapInArrow(normalise, "vec long, unit binary"), "vectors")
    classes = units.where("unit is not null").groupBy("unit").agg(F.min("vec").alias("head"), F.count("*").alias("copies"))
    classes = materialize(classes, "vector-classes")
    widths = classes.groupBy(F.octet_length("unit").alias("w")).count().orderBy(F.desc("count"), "w").first()
    if widths is None or widths["w"] < 16:
        pairs, links = None, None
    else:
        dim, count = widths["w"] // 8, widths["count"]
        pairs, links = _search(classes.where(F.octet_length("unit") == widths["w"]), dim, count, threshold, recall)
    kind = vectors.schema[id_col].dataType
    if pairs is None:
        classes = classes.select("unit", "copies", F.lit(0).cast("long").alias("linked"), F.col("head").alias("component"))
    else:
        named = classes.join(links.groupBy("head").agg(F.sum("n").alias("n")), "head", "left").join(components(pairs), F.col("head") == F.col("node"), "left")
        classes = named.select("unit", "copies", F.coalesce("n", F.lit(0)).alias("linked"), F.coalesce("component", "head").alias("component"))
    out = units.join(classes, "unit", "left").select("vec", F.coalesce(F.col("copies") - 1 + F.col("linked"), F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec").alias("component"))
    return out.select(shown_id("vec", kind).alias(id_col), "n_links", shown_id("component", kind).alias("component_id"), (F.col("vec") == F.col("component")).alias("kept"))


def _search(classes: DataFrame, dim: int, count: int, threshold: float, recall: float) -> tuple[DataFrame, DataFrame]:
    """(links (a, b) that span the components, rows (head, n) of linked vectors per class in parts) among distinct unit vectors."""
    spark = classes.sparkSession
    by_hash = classes.select("head", "unit", F.xxhash64("unit").alias("h"))
    sample = by_hash.orderBy("h").limit(SAMPLE).select("head", "unit").toPandas()
    x, x_heads = np.array([np.frombuffer(u, dtype="<f8") for u in sample["unit"]]), sample["head"].to_numpy(dtype=np.int64)
    codes = int(min(MAX_CODES, max(1, round((count / PER_CELL) ** 0.5))))
    half = dim // 2
    books = (_kmeans(x[:, :half], codes), _kmeans(x[:, half:], codes))
    width = len(books[1])
    shuffled = np.random.default_rng(0).permutation(len(x))
    held, probed, found = None, 0, []

    def ranks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """How many cells each probe has to visit until it meets each of its links with other vectors: counted over all."""
        probes, probe_heads = held.value
        da, db = _distances(probes[:, :half], books[0]), _distances(probes[:, half:], books[1])
        sa, sb = np.sort(da, axis=1), np.sort(db, axis=1)
        for b in batches:
            heads = b.column("head").to_numpy()
            for start in range(0, b.num_rows, PROBE_BLOCK):
                y = _unit(b.column("unit").slice(start, PROBE_BLOCK), dim)
                p, q = np.nonzero((probes @ y.T >= threshold) & (probe_heads[:, None] != heads[None, start : start + PROBE_BLOCK]))
                cell = cells_of(y, books)[q]
                for i in np.unique(p):
                    mine, n = np.unique(cell[p == i], return_counts=True)
                    at = np.minimum(_rank(sa[i], sb[i], da[i][mine // width] + db[i][mine % width]), MAX_VISITS)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(mine), i)), pa.array(at), pa.array(n)], ["probe", "visit", "n"])

    for upto in PROBES:
        some = shuffled[probed:upto]
        if not len(some) or len({f[0] for f in found}) >= LINKED:
            break
        held = spark.sparkContext.broadcast((x[some], x_heads[some]))
        seen = classes.select("head", "unit").mapInArrow(ranks, "probe long, visit long, n long").groupBy("probe", "visit").agg(F.sum("n").alias("n"))
        found += [(probed + r.probe, r.visit, r.n) for r in seen.collect()]  # MAX_VISITS + 1 rows a probe at most
        probed = min(upto, len(x))
    steps = calibrate(found, recall)

    def stand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(cells_of(_unit(b.column("unit"), dim), books))], ["cell"])

    sizes = np.zeros(len(books[0]) * width, dtype=np.int64)  # by cell; one number for each of the MAX_CODES squared cells at most
    for r in classes.select("unit").mapInArrow(stand, "cell long").groupBy("cell").count().collect():
        sizes[r["cell"]] = r["count"]
    shard = np.arange(len(sizes))
    if steps is None:  # a query that goes to many cells goes once to all that stand together
        shard = (np.cumsum(sizes) - sizes) // CROWD
        sizes = np.bincount(shard, weights=sizes).astype(np.int64)
    parts = np.maximum(1, -(-sizes // CROWD))
    used = np.flatnonzero(sizes > 0)
    room = 2 - 2 * threshold + 1e-9  # squared distance of linked vectors at most

    def to_visit(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, shard) of all visits."""
        if steps is not None:
            near = visits(y, books, steps)
            return np.repeat(np.arange(len(y)), near.shape[1]), near.reshape(-1)
        a, b = _apart(y[:, :half], books[0]), _apart(y[:, half:], books[1])
        near = [np.intersect1d(shard[np.flatnonzero((a[r][:, None] + b[r][None, :] <= room).reshape(-1))], used) for r in range(len(y))]
        return np.repeat(np.arange(len(y)), [len(c) for c in near]), np.concatenate(near) if near else np.empty(0, dtype=np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Residents go to one part of their cell by their id, visitors to every part; ``visit`` tells them apart."""
        for b in batches:
            for start in range(0, b.num_rows, 512):
                s = b.slice(start, 512)
                y = _unit(s.column("unit"), dim)
                (row, cell), n = to_visit(y), len(y)
                mark = np.arange(len(row) + n) < len(row)
                row, cell = np.concatenate((row, np.arange(n))), np.concatenate((cell, shard[cells_of(y, books)]))
                times = np.where(mark, parts[cell], 1)
                part = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                row, cell, mark = (np.repeat(c, times) for c in (row, cell, mark))
                heads, copies = s.column("head").to_numpy()[row], s.column("copies").to_numpy()[row]
                part = np.where(mark, part, heads % parts[cell])
                for i in range(0, len(row), DEALT):
                    columns = [pa.array(c[i : i + DEALT]) for c in (cell, part, mark, heads, copies)]
                    yield pa.RecordBatch.from_arrays([*columns, s.column("unit").take(pa.array(row[i : i + DEALT]))], ["cell", "part", "visit", "head", "copies", "unit"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, residents = None, []
        for b in batches:
            cells, split, mark = (b.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "part", "visit"))
            heads, copies, units = b.column("head").to_numpy(), b.column("copies").to_numpy(), _unit(b.column("unit"), dim)
            edge = np.flatnonzero((np.diff(cells) != 0) | (np.diff(split) != 0)) + 1
            for part in np.split(np.arange(len(cells)), edge):
                if not len(part):
                    continue
                if (cells[part[0]], split[part[0]]) != held:
                    held, residents = (cells[part[0]], split[part[0]]), []
                own, came = part[~mark[part]], part[mark[part]]
                block = lambda of, i: (units[of[i : i + BLOCK]], heads[of[i : i + BLOCK]], copies[of[i : i + BLOCK]])  # noqa: B023,E731
                residents += [block(own, i) for i in range(0, len(own), BLOCK)]
                for i in range(0, len(came), BLOCK):
                    yield _links(block(came, i), residents, threshold)

    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), codes)
    dealt = classes.select("head", "copies", "unit").mapInArrow(deal, "cell long, part long, visit boolean, head long, copies long, unit binary")
    dealt = dealt.repartition(shards, "cell", "part").sortWithinPartitions("cell", "part", "visit")
    found_links = materialize(dealt.mapInArrow(compare, "head long, n long, other long"), "vector-links")
    return found_links.where("other is not null").select(F.col("head").alias("a"), F.col("other").alias("b")), found_links.where("n > 0").select("head", "n")


Block = tuple[np.ndarray, np.ndarray, np.ndarray]  # unit vectors, ids and copies of some classes


def _links(visitors: Block, residents: list[Block], threshold: float) -> pa.RecordBatch:
    """Links of a block of visitors with a cell's residents of larger ids: linked vectors on both sides, and a spanning forest."""
    x, x_heads, x_copies = visitors
    heads = np.concatenate([x_heads, *(r[1] for r in residents)])
    n, parent = np.zeros(len(heads), dtype=np.int64), np.arange(len(heads))
    base = len(x_heads)
    for y, y_heads, y_copies in residents:
        p, q = np.nonzero((x @ y.T >= threshold) & (x_heads[:, None] < y_heads[None, :]))
        np.add.at(n, p, y_copies[q])
        np.add.at(n, base + q, x_copies[p])
        _forest(parent, p, q + base)
        base += len(y_heads)
    some = np.flatnonzero((n > 0) | (parent != np.arange(len(parent))))
    other = pa.array(heads[parent[some]], mask=parent[some] == some)
    return pa.RecordBatch.from_arrays([pa.array(heads[some]), pa.array(n[some]), other], ["head", "n", "other"])
