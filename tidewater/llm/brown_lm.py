"""Brown's class-based bigram language model: words get classes by merges that lose the least average mutual information, and a text's
probability is the product of class transitions and word emissions.

Words are counted exactly over all training texts. A bounded table of bigrams, of the CORE most frequent words and the word endings (256 buckets)
that stand for all others, is clustered as Brown et al. (1992) do it: the most frequent units begin as classes of their own; each of the others
comes as a further class, by frequency, and the two classes whose merge loses least become one. Then units move one after the other to
the class that raises the information most, until none moves. Every frequent word (at least HOT of all tokens, so 1 / HOT words at most) then comes as
a class of its own and is merged where that loses least, in parallel: one pass over the texts counts the classes that each word stands behind
and before, and each word is merged, by itself, from its own counts. Classes are counted anew and kept if the likelihood of the training texts rose.
Then every other word of the training texts, however rare, is merged in the same way, beside the classes of the frequent ones, and classes are counted
once more: no word that occurs is left to the class of its ending, which only words never seen have. The classes are merged on to one, which gives each its
path in the tree of merges. Emissions use the word's own count; the mass of words never seen is that of the class's singletons.

Frequent words are looked up in a broadcast table, which turns every text once into classes, a byte a word, where only rare words are open. Each distinct
rare word of a text becomes one row that is joined with counts and classes; counting again and scoring read the classes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import materialize, slices

CORE, ENDINGS, CLASSES = 1024, 256, 48
SWEEPS = 1000  # a bound only: units stop moving long before
UNITS = CORE + ENDINGS + 1  # the last: end of text, also what stands before the first word
END = UNITS - 1
LAST = CLASSES - 1  # the class of END alone
HOT = 2e-7
MAX_HELD = 400_000  # words whose counts a task holds before handing them out
DENSE = 8_000_000  # cells of a table that counts (64 MB)
BLOCK = 500  # words that are merged together
RARE, UNKNOWN = 255, 128  # a place of a text whose word has to be looked up; added to the class of a word without a count
_UPPER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


class _WordKeys(dict):
    """64-bit key of each word: 56 bits of its hash, and in the lowest 8 the bucket of its ending. Kept up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > MAX_HELD:
            self.clear()
        ending = xxhash.xxh3_64_intdigest(word.rstrip(b".,;:!?")[-3:]) % ENDINGS
        k = self[word] = (xxhash.xxh3_64_intdigest(word) & ~0xFF | ending) - (1 << 63)
        return k


def _keys(batch: pa.RecordBatch, memo: _WordKeys) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct word keys of a slice, the place among them of each word of its texts, one text after the other, and where each text ends. Arrow splits
    the texts and numbers their distinct words."""
    texts = pa.concat_arrays([batch.column("txt"), pa.array([], pa.string())]).cast(pa.large_string())  # a copy: splitting goes wrong on a slice
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    spots = split.flatten().cast(pa.large_binary()).dictionary_encode()
    distinct = spots.dictionary.to_numpy(zero_copy_only=False).tolist()
    ends = split.offsets.to_numpy()
    at, ends = spots.indices.to_numpy(), ends[1:] - ends[0]
    key = np.fromiter(map(memo.__getitem__, distinct), dtype=np.int64, count=len(distinct))
    if b"" in distinct:  # before the first and behind the last blank of a text
        blank = distinct.index(b"")
        word = at != blank
        ends = np.concatenate(([0], np.cumsum(word)))[ends]
        at = at[word]
        at = at - (at > blank)
        key = np.delete(key, blank)
    return key, at, ends


def _table_likelihood(table: np.ndarray) -> float:
    """Log likelihood of class bigrams, but for what doesn't depend on the classes."""
    flat = lambda x: x * np.log(np.maximum(x, 1.0))
    return float(flat(table).sum() - flat(table.sum(axis=1)).sum() - flat(table.sum(axis=0)).sum())


def best_class(table: np.ndarray, a: int, left: np.ndarray, right: np.ndarray) -> int:
    """The class that a word of class ``a`` should have, given how often each class stands before (``left``) and behind it (``right``), all others
    staying where they are: taken out as a class of its own, it is merged where that loses least. The end keeps a class of its own."""
    flat = lambda x: x * np.log(np.maximum(x, 1.0))
    own, t = np.arange(len(table)), table.copy()
    t[a] -= right
    t[:, a] -= left
    t = np.maximum(t, 0.0)  # a word before itself is counted on both sides
    d, r, s = t[own, own], np.flatnonzero(right), np.flatnonzero(left)
    gain = (flat(t[:, r] + right[r]) - flat(t[:, r])).sum(axis=1) + (flat(t[s] + left[s, None]) - flat(t[s])).sum(axis=0)
    gain += flat(d + right + left) - flat(d + right) - flat(d + left) + flat(d)
    rows, cols = table.sum(axis=1), table.sum(axis=0)  # with the bigrams of the other words and this one
    rows[a] -= right.sum()
    cols[a] -= left.sum()
    gain -= flat(rows + right.sum()) - flat(rows) + flat(cols + left.sum()) - flat(cols)
    gain[LAST] = -np.inf
    return int(np.argmax(gain)) if gain.max() > gain[a] + 1e-6 else int(a)


def best_classes(table: np.ndarray, a: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """``best_class`` of many words, a row of ``left`` and ``right`` for each; only classes that a word stands beside are worked on."""
    flat = lambda x: x * np.log(np.maximum(x, 1.0))
    words = np.arange(len(a))
    d = np.tile(np.diag(table), (len(a), 1))
    d[words, a] -= left[words, a] + right[words, a]
    d = np.maximum(d, 0.0)  # a word before itself is counted on both sides
    gain = flat(d + right + left) - flat(d + right) - flat(d + left) + flat(d)
    rows, cols = np.tile(table.sum(axis=1), (len(a), 1)), np.tile(table.sum(axis=0), (len(a), 1))
    n_right, n_left = right.sum(axis=1), left.sum(axis=1)
    rows[words, a] -= n_right
    cols[words, a] -= n_left
    gain -= flat(rows + n_right[:, None]) - flat(rows) + flat(cols + n_left[:, None]) - flat(cols)
    for own, other, grid in ((right, left, table.T), (left, right, table)):
        word, j = np.nonzero(own)
        n, t, at = own[word, j], grid[j], j == a[word]
        t[np.arange(len(j)), a[word]] -= n
        t[at] -= other[word[at]]
        t = np.maximum(t, 0.0)
        some, first = np.unique(word, return_index=True)
        if len(some):
            gain[some] += np.add.reduceat(flat(t + n[:, None]) - flat(t), first, axis=0)
    gain[:, LAST] = -np.inf
    return np.where(gain.max(axis=1) > gain[words, a] + 1e-6, gain.argmax(axis=1), a)


def merge_losses(table: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Average mutual information (times the number of bigrams) that is lost by merging each two classes. table: bigrams of the classes; rows, cols: how often each
    stands before and behind any unit, also one without a class yet."""
    log = lambda x: np.log(np.maximum(x, 1.0))
    flat = lambda x: x * log(x)
    both = lambda x: x[:, None] + x[None, :]
    r, c, r2, c2 = log(rows), log(cols), log(both(rows)), log(both(cols))
    cell = flat(table) - table * r[:, None] - table * c
    own = cell.sum(axis=1) + cell.sum(axis=0) - np.diag(cell)
    before = both(own) - cell - cell.T
    t, u = np.diag(table)[:, None] + table.T, np.diag(table)[:, None] + table  # two rows at the first's column, two columns at its row
    t_cell, u_cell, four = flat(t) - t * r2 - t * c[:, None], flat(u) - u * c2 - u * r[:, None], t + t.T
    after = flat(table[:, None] + table[None]).sum(axis=2) - both(table.sum(axis=1)) * r2 - both((table * c).sum(axis=1)) - t_cell - t_cell.T
    after += flat(table.T[:, None] + table.T[None]).sum(axis=2) - both(table.sum(axis=0)) * c2 - both((table * r[:, None]).sum(axis=0)) - u_cell - u_cell.T
    return before - after - (flat(four) - four * r2 - four * c2)


class _Merges:
    """Classes that are merged two by two: their bigrams, totals and units. The end's class takes no part."""

    def __init__(self, places: int, end: int):
        self.table, self.rows, self.cols = np.zeros((places, places)), np.zeros(places), np.zeros(places)
        self.end, self.used = end, np.zeros(places, dtype=bool)

    def best(self) -> tuple[int, int]:
        """The two classes that lose least."""
        loss = merge_losses(self.table, self.rows, self.cols)
        out = ~self.used
        out[self.end] = True
        loss[out] = loss[:, out] = loss[np.tril_indices(len(loss))] = np.inf
        return tuple(int(x) for x in divmod(int(np.argmin(loss)), len(loss)))

    def merge(self, a: int, b: int) -> None:
        """Class b becomes part of a, and its place is free."""
        for x in (self.table, self.table.T, self.rows, self.cols):
            x[a] += x[b]
            x[b] = 0
        self.used[b] = False


def merge_units(pairs: np.ndarray, classes: int) -> np.ndarray:
    """Class of each unit from bigram counts ``pairs`` by Brown's merges: the most frequent units are classes of their own; each of the others comes as one class
    more, by frequency, and the two classes that lose least are merged. The end keeps a class of its own; units that never occur are dealt in turn."""
    n, rows, cols = len(pairs), pairs.sum(axis=1), pairs.sum(axis=0)
    by_amount = np.argsort(-(rows + cols), kind="stable")
    by_amount = by_amount[by_amount != n - 1]
    cls = np.empty(n, dtype=np.int64)
    cls[by_amount] = np.arange(n - 1) % (classes - 1)
    cls[n - 1] = classes - 1
    m, has, fresh = _Merges(classes + 1, classes - 1), np.zeros(n, dtype=bool), classes
    free = list(range(classes - 1))[::-1]
    for u in [n - 1, *by_amount[(rows + cols)[by_amount] > 0]]:
        place = cls[u] = classes - 1 if u == n - 1 else free.pop() if free else fresh
        has[u], m.used[place] = True, True
        m.table[place] += np.bincount(cls[has], pairs[u, has], minlength=classes + 1)
        has[u] = False  # a unit before itself is counted once
        m.table[:, place] += np.bincount(cls[has], pairs[has, u], minlength=classes + 1)
        has[u] = True
        m.rows[place] += rows[u]
        m.cols[place] += cols[u]
        if place == fresh:
            a, b = m.best()
            m.merge(a, b)
            cls[has & (cls == b)] = a
            if b != fresh:  # the new class takes the place that became free
                m.used[b] = True
                m.merge(b, fresh)
                cls[has & (cls == fresh)] = b
    return cls


def merge_paths(table: np.ndarray) -> list[str]:
    """Path of each class in the binary tree that arises if the classes, but for the end's, are merged on to one."""
    n = len(table)
    m = _Merges(n, n - 1)
    m.table, m.rows, m.cols, m.used[:] = table.astype(float), table.sum(axis=1).astype(float), table.sum(axis=0).astype(float), True
    paths, held = [""] * n, [[c] for c in range(n)]
    for _ in range(n - 2):
        a, b = m.best()
        m.merge(a, b)
        for bit, side in (("0", a), ("1", b)):
            for c in held[side]:
                paths[c] = bit + paths[c]
        held[a] += held[b]
    return paths


def exchange(pairs: np.ndarray, classes: int, sweeps: int) -> np.ndarray:
    """Class of each unit from bigram counts ``pairs``: start with the classes that merges give, then move one unit after the
    other to the class that raises the likelihood of the class bigrams most, until a sweep moves none. The end keeps a class of its own."""
    n = len(pairs)
    amount = pairs.sum(axis=0) + pairs.sum(axis=1)
    by_amount = np.argsort(-amount, kind="stable")
    by_amount = by_amount[by_amount != n - 1]
    cls = merge_units(pairs, classes)
    onehot = np.eye(classes)[cls]
    after, before = pairs @ onehot, pairs.T @ onehot  # of each unit: what follows it and what precedes it, by class
    table = onehot.T @ after
    flat = lambda x: x * np.log(np.maximum(x, 1.0))
    own = np.arange(classes)
    for _ in range(sweeps):
        moved = 0
        for u in by_amount:
            if not amount[u]:
                continue
            a, self_ = cls[u], pairs[u, u]
            right, left = after[u].copy(), before[u].copy()
            right[a] -= self_
            left[a] -= self_
            table[a] -= right
            table[:, a] -= left
            table[a, a] -= self_
            f = flat(table)
            gain = (flat(table + right) - f).sum(axis=1) + (flat(table + left[:, None]) - f).sum(axis=0)
            d = table[own, own]
            gain += flat(d + right + left + self_) - flat(d + right) - flat(d + left) + flat(d)
            rows, cols = table.sum(axis=1) + left, table.sum(axis=0) + right  # with the bigrams of the other units and this one
            gain -= flat(rows + right.sum() + self_) - flat(rows) + flat(cols + left.sum() + self_) - flat(cols)
            gain[classes - 1] = -np.inf
            b = int(np.argmax(gain)) if gain.max() > gain[a] + 1e-6 else int(a)
            table[b] += right
            table[:, b] += left
            table[b, b] += self_
            if b != a:
                moved += 1
                cls[u] = b
                after[:, a] -= pairs[:, u]
                after[:, b] += pairs[:, u]
                before[:, a] -= pairs[u]
                before[:, b] += pairs[u]
        if not moved:
            break
    return cls


@dataclass
class BrownModel:
    """Broadcast part of the model. hot_key (sorted), hot_count, hot_cls: frequent words; ending_cls: class of all others by ending; step: log10
    class transitions; seen, unseen: log10 of a class's factor for a known word (to be multiplied by the word's count) and of its mass
    for unknown words; paths: of each class in the tree of merges; table: class bigrams; singles: words seen once, by the class of their ending."""

    tokens: int
    types: int
    ends: int
    hot_key: np.ndarray
    hot_count: np.ndarray
    hot_cls: np.ndarray
    ending_cls: np.ndarray
    step: np.ndarray
    seen: np.ndarray
    unseen: np.ndarray
    paths: list[str]
    table: np.ndarray
    singles: np.ndarray

    @property
    def base_total(self) -> float:
        return float(np.log10(self.tokens + self.types + 1))


def _class_figures(table: np.ndarray, singles: np.ndarray) -> dict:
    """What a model takes from its class bigrams and from the number of words seen once, by the class of their ending."""
    size = table.sum(axis=0)  # tokens of each class
    prior = (size + 1) / (size.sum() + CLASSES)
    step = np.log10((table + CLASSES * prior) / (table.sum(axis=1, keepdims=True) + CLASSES))
    unknown = np.minimum((singles + 0.5) / (size + 1), 0.5)
    size = np.maximum(size, 1)
    return {"step": step, "seen": np.log10(1 - unknown) - np.log10(size), "unseen": np.log10(unknown), "paths": merge_paths(table), "table": table, "singles": singles}


def _places(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Place of each key in the sorted ``known``, -1 where it isn't there."""
    if not len(known):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, at, -1)


def _units(keys: np.ndarray, core: np.ndarray) -> np.ndarray:
    """Number of each word's unit; core: the most frequent words' keys, sorted."""
    at = _places(keys, core)
    return np.where(at >= 0, at, CORE + (keys & 0xFF))


def _word_classes(keys: np.ndarray, hot_key: np.ndarray, hot_cls: np.ndarray, ending_cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of each word, and its place among the frequent ones (-1: none)."""
    at = _places(keys, hot_key)
    cls = ending_cls[keys & 0xFF].astype(np.int64)
    cls[at >= 0] = hot_cls[at[at >= 0]]
    return cls, at


def _sequence(unit: np.ndarray, ends: np.ndarray, end: int) -> np.ndarray:
    """Units of all texts with ``end`` before the first and behind each text."""
    out = np.full(len(unit) + len(ends) + 1, end, dtype=np.int64)
    place = np.arange(len(unit)) + np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0)) + 1
    out[place] = unit
    return out


def _sums(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Of each text's part of x, one by one: a text's sum depends on its own words only."""
    return np.array([x[i:j].sum() for i, j in zip(lo.tolist(), hi.tolist(), strict=True)], dtype=x.dtype)


def _added(keys: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys with the sums of their numbers."""
    if not keys:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    k, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    n = np.zeros(len(k), dtype=np.int64)
    np.add.at(n, inverse, np.concatenate(times))
    return k, n


def _counted(cells: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct cells below ``width`` and how often each occurs: by a table while that is small, else by sorting."""
    if width > DENSE:
        return np.unique(cells, return_counts=True)
    n = np.bincount(cells, minlength=width)
    some = np.flatnonzero(n)
    return some, n[some]


def _merged(table: np.ndarray, a: np.ndarray, word: np.ndarray, context: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Class of each word, ``a`` so far, by the contexts counted for it (``word``, ascending: its place; classes before it, then classes behind it)."""
    found, a = [np.empty(0, dtype=np.int64)], a.astype(np.int64)
    for lo in range(0, len(a), BLOCK):
        hi = min(lo + BLOCK, len(a))
        i, j = np.searchsorted(word, (lo, hi))
        n = np.bincount((word[i:j] - lo) * 2 * CLASSES + context[i:j], times[i:j], (hi - lo) * 2 * CLASSES).reshape(hi - lo, 2 * CLASSES)
        found.append(best_classes(table, a[lo:hi], n[:, :CLASSES], n[:, CLASSES:]))
    return np.concatenate(found)


def _exchange_all(texts: DataFrame, hot_key: np.ndarray, hot_cls: np.ndarray, ending_cls: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every frequent word at once is taken out and merged where that loses least: classes and the table of class bigrams, the old ones if the new are worse."""
    spark = texts.sparkSession
    held = spark.sparkContext.broadcast((hot_key, hot_cls, ending_cls))
    width = 2 * CLASSES  # contexts of a word: classes before it, classes behind it

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, cells, times, size = _WordKeys(), [], [], 0

        def out() -> pa.RecordBatch:
            cell, n = _added(cells, times)
            return pa.RecordBatch.from_arrays([pa.array((cell // width).astype(np.int32)), pa.array((cell % width).astype(np.int32)), pa.array(n)], ["word", "context", "n"])

        for b in slices(batches):
            keys, at, stops = _keys(b, memo)
            cls, place = _word_classes(keys, *held.value)
            seq, word = _sequence(cls[at], stops, LAST), _sequence(at, stops, -1)
            spot = np.flatnonzero(word >= 0)
            own = word[spot] * width
            cell, n = _counted(np.concatenate((own + seq[spot - 1], own + CLASSES + seq[spot + 1])), len(keys) * width)
            frequent = place[cell // width] >= 0
            cell, n = cell[frequent], n[frequent]
            cells.append(place[cell // width] * width + cell % width)
            times.append(n)
            size += len(cell)
            if size > 8 * MAX_HELD:
                yield out()
                cells, times, size = [], [], 0
        yield out()

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        old = held.value[1]
        for b in batches:
            words, seen = b.column("word").to_numpy(), b.column("seen")
            own = np.repeat(np.arange(len(words)), pc.list_value_length(seen).to_numpy())
            flat = seen.flatten()
            context, times = (flat.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            found = _merged(table, old[words], own, context, times)
            yield pa.RecordBatch.from_arrays([b.column("word"), pa.array(found, pa.int32())], ["word", "cls"])

    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = texts.mapInArrow(contexts, "word int, context int, n long").repartition(shards, "word").groupBy("word", "context").agg(F.sum("n").alias("n"))
    moved = rows.groupBy("word").agg(F.collect_list(F.struct("context", "n")).alias("seen")).mapInArrow(move, "word int, cls int").toPandas()  # a row a frequent word
    new_cls = hot_cls.copy()
    new_cls[moved["word"].to_numpy(dtype=np.int64)] = moved["cls"].to_numpy(dtype=np.uint8)
    fresh = spark.sparkContext.broadcast((hot_key, new_cls, ending_cls))

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, total = _WordKeys(), np.zeros(CLASSES * CLASSES, dtype=np.int64)
        for b in slices(batches):
            keys, at, stops = _keys(b, memo)
            seq = _sequence(_word_classes(keys, *fresh.value)[0][at], stops, LAST)
            total += np.bincount(seq[:-1] * CLASSES + seq[1:], minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["cell", "n"])

    new_table = np.zeros(CLASSES * CLASSES)
    for r in texts.mapInArrow(again, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():  # CLASSES squared rows
        new_table[r["cell"]] = r["n"]
    new_table = new_table.reshape(CLASSES, CLASSES)
    return (new_cls, new_table) if _table_likelihood(new_table) > _table_likelihood(table) else (hot_cls, table)


def fit_brown(texts: DataFrame) -> tuple[BrownModel, DataFrame]:
    """Model and exact word counts (key, n) of the texts (column ``txt``, without nulls). Rare words have the class of their ending until
    ``merge_rare`` merges them."""
    spark = texts.sparkSession

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, keys, times, held = _WordKeys(), [], [], 0
        for b in slices(batches):
            k, at, _ = _keys(b, memo)
            keys.append(k)
            times.append(np.bincount(at, minlength=len(k)))
            held += len(k)
            if held > 4 * MAX_HELD:
                k, n = _added(keys, times)
                keys, times, held = [k], [n], len(k)
                if held > MAX_HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(n)], ["key", "n"])
                    keys, times, held = [], [], 0
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in _added(keys, times)], ["key", "n"])

    counts = materialize(texts.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), "brown-counts")
    ends = texts.count()
    words, types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    tokens, types = words + ends, types + (ends > 0)
    hot = counts.where(F.col("n") >= max(1.0, tokens * HOT)).toPandas()  # 1 / HOT rows at most
    top = counts.orderBy(F.desc("n"), "key").limit(CORE).toPandas()
    hot = pd.concat([hot, top]).drop_duplicates("key").sort_values("key")  # core words never count as rare
    core = np.sort(top["key"].to_numpy(dtype=np.int64))

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, total = _WordKeys(), np.zeros(UNITS * UNITS, dtype=np.int64)
        for b in slices(batches):
            keys, at, stops = _keys(b, memo)
            seq = _sequence(_units(keys, core)[at], stops, END)
            total += np.bincount(seq[:-1] * UNITS + seq[1:], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["cell", "n"])

    cells = texts.mapInArrow(pair, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()  # UNITS squared rows at most
    pairs = np.zeros(UNITS * UNITS)
    pairs[cells["cell"].to_numpy(dtype=np.int64)] = cells["n"].to_numpy(dtype=np.float64)
    pairs = pairs.reshape(UNITS, UNITS)
    cls = exchange(pairs, CLASSES, SWEEPS)
    hot_key, ending_cls = hot["key"].to_numpy(dtype=np.int64), cls[CORE : CORE + ENDINGS].astype(np.uint8)
    onehot = np.eye(CLASSES)[cls]
    hot_cls, table = cls[_units(hot_key, core)].astype(np.uint8), onehot.T @ pairs @ onehot
    hot_cls, table = _exchange_all(texts, hot_key, hot_cls, ending_cls, table)
    once = counts.where("n = 1").select("key").groupBy(F.col("key").bitwiseAND(F.lit(0xFF)).alias("ending")).count().toPandas()
    singles = np.zeros(CLASSES)
    np.add.at(singles, ending_cls[once["ending"].to_numpy(dtype=np.int64)], once["count"].to_numpy(dtype=np.float64))
    return BrownModel(int(tokens), int(types), ends, hot_key, hot["n"].to_numpy(dtype=np.int64), hot_cls, ending_cls, **_class_figures(table, singles)), counts


def _class_texts(docs: DataFrame, training: Column, model: BrownModel, keep: list[str], text_col: str) -> DataFrame:
    """Every text as the classes of its words, a byte each (``seq``), RARE where only the counts know the word. ``rare``: its distinct rare words; ``spots``: which of them
    stands at each such place. Sums over the frequent words: ``known``, ``base`` and ``logs``, log10 of the counts."""
    held = docs.sparkSession.sparkContext.broadcast(vars(model))  # a plain dict, so that tasks need no installed package to read it
    source = docs.select(F.struct(*keep).alias("row"), F.coalesce(training, F.lit(False)).alias("training"), F.coalesce(F.col(text_col), F.lit("")).alias("txt"), F.monotonically_increasing_id().alias("uid"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, memo = BrownModel(**held.value), _WordKeys()
        for b in slices(batches):
            distinct, inverse, ends = _keys(b, memo)
            cls, at = _word_classes(distinct, m.hot_key, m.hot_cls, m.ending_cls)
            n = np.where(at >= 0, m.hot_count[at], 0) if len(m.hot_key) else np.zeros(len(distinct), dtype=np.int64)
            some = n > 0
            starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
            words = ends - starts
            logs = _sums(np.log10(np.maximum(n, 1))[inverse], starts, ends)
            base = _sums(np.where(some, np.log10(n + 1.0), 0.0)[inverse], starts, ends) + np.log10(m.ends + 1.0) - (words + 1) * m.base_total
            known = _sums(some[inverse].astype(np.int64), starts, ends) + (m.ends > 0)
            seq = np.where(some, cls, RARE).astype(np.uint8)[inverse]
            rare_at = np.flatnonzero(seq == RARE)
            width, rare_row = max(1, len(distinct)), np.searchsorted(ends, rare_at, side="right")
            pair, spot = np.unique(rare_row * width + inverse[rare_at], return_inverse=True)
            first = np.searchsorted(pair, np.arange(len(ends) + 1) * width)
            spots = pa.ListArray.from_arrays(pa.array(np.searchsorted(rare_at, np.append(0, ends)).astype(np.int32)), pa.array((spot - first[rare_row]).astype(np.int32)))
            rare = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(distinct[pair % width]))
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("training"), b.column("uid"), pa.array(words + 1), pa.array(known), pa.array(base), pa.array(logs), _binaries(seq, words), spots, rare],
                                             ["row", "training", "uid", "n_tokens", "known", "base", "logs", "seq", "spots", "rare"])

    kind = source.schema["row"].dataType.simpleString()
    return materialize(source.mapInArrow(run, f"row {kind}, training boolean, uid long, n_tokens long, known long, base double, logs double, seq binary, spots array<int>, rare array<long>"), "brown-first")


def _binaries(flat: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Bytes, one row after the other, as an Arrow column."""
    ends = np.append(0, np.cumsum(lengths)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(flat, dtype=np.uint8))])


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column, one row after the other, and where each row ends."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), dtype=np.uint8), np.cumsum([len(x) for x in rows], dtype=np.int64)


def _rare_words(lengths: np.ndarray, b: pa.RecordBatch) -> np.ndarray:
    """For each rare place of a batch, one text after the other, its word's place among the rare words of all texts; lengths: distinct ones of each text."""
    places = pc.list_value_length(b.column("spots")).to_numpy(zero_copy_only=False)
    return np.repeat(np.cumsum(lengths) - lengths, places) + b.column("spots").flatten().to_numpy()


def merge_rare(first: DataFrame, model: BrownModel) -> DataFrame:
    """Rare words of the training texts (``_class_texts``) with count and class (key, n, cls): each comes, as the frequent words did before it, as a class of its own and is merged
    where that loses least, by its own contexts, in parallel. Rare words beside it count by the class of their ending."""
    spark = first.sparkSession
    held, table = spark.sparkContext.broadcast(model.ending_cls), model.table

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ending = held.value
        for b in batches:
            seq, ends = _flat(b.column("seq"))
            keys = b.column("rare").flatten().to_numpy()
            keys = keys[_rare_words(pc.list_value_length(b.column("rare")).to_numpy(), b)]
            cls, at = seq.copy(), np.flatnonzero(seq == RARE)
            cls[at] = ending[keys & 0xFF]
            full = _sequence(cls, ends, LAST)
            at = at + np.searchsorted(ends, at, side="right") + 1
            distinct, own, n = np.unique(keys, return_inverse=True, return_counts=True)
            beside = np.column_stack((full[at - 1], CLASSES + full[at + 1]))[np.argsort(own, kind="stable")]
            yield pa.RecordBatch.from_arrays([pa.array(distinct), _binaries(beside.ravel(), 2 * n)], ["key", "seen"])

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ending = held.value
        for b in batches:
            keys, seen = b.column("key").to_numpy(), b.column("seen")
            parts = pc.list_value_length(seen).to_numpy()
            context, ends = _flat(seen.flatten())
            n = np.diff(np.append(0, ends)[np.append(0, np.cumsum(parts))])
            found = _merged(table, ending[keys & 0xFF], np.repeat(np.arange(len(keys)), n), context, np.ones(len(context)))
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(n // 2), pa.array(found, pa.int32())], ["key", "n", "cls"])

    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = first.where("training").select("seq", "spots", "rare").mapInArrow(contexts, "key long, seen binary").repartition(shards, "key")
    return rows.groupBy("key").agg(F.collect_list("seen").alias("seen")).mapInArrow(move, "key long, n long, cls int")


def _looked_up(first: DataFrame, model: BrownModel, words: DataFrame) -> DataFrame:
    """Texts of ``_class_texts`` with the rare words' classes and counts (``words``: key, n, cls), UNKNOWN added to the class of words without a count, and the sums over all words."""
    ending = (F.col("key").bitwiseAND(F.lit(0xFF)) + 1).cast("int")
    cls = F.coalesce("cls", F.element_at(F.array(*(F.lit(int(c)) for c in model.ending_cls)), ending))
    rows = first.select("uid", F.posexplode("rare").alias("i", "key")).join(words, "key", "left")
    found = rows.groupBy("uid").agg(F.collect_list(F.struct("i", F.coalesce("n", F.lit(0)).alias("n"), cls.alias("cls"))).alias("found"))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seq, ends = _flat(b.column("seq"))
            lengths = pc.fill_null(pc.list_value_length(b.column("found")), 0).to_numpy()
            own = np.repeat(np.cumsum(lengths) - lengths, lengths)
            i, n, cls = (b.column("found").flatten().field(k).to_numpy(zero_copy_only=False) for k in range(3))
            count, of = np.empty(len(i), dtype=np.int64), np.empty(len(i), dtype=np.int64)
            count[own + i], of[own + i] = n, cls
            at, word = np.flatnonzero(seq == RARE), _rare_words(lengths, b)
            seq, count = seq.copy(), count[word]
            seq[at] = of[word] + UNKNOWN * (count == 0)
            bounds = np.searchsorted(at, np.append(0, ends))
            plus = [pa.array(b.column(c).to_numpy() + _sums(x, bounds[:-1], bounds[1:]))
                    for c, x in (("known", (count > 0).astype(np.int64)), ("base", np.log10(count + 1.0)), ("logs", np.log10(np.maximum(count, 1))))]
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("training"), b.column("n_tokens"), *plus, _binaries(seq, np.diff(ends, prepend=0))],
                                             ["row", "training", "n_tokens", "known", "base", "logs", "seq"])

    kind = first.schema["row"].dataType.simpleString()
    return first.drop("rare").join(found, "uid", "left").mapInArrow(fill, f"row {kind}, training boolean, n_tokens long, known long, base double, logs double, seq binary")


def _count_again(texts: DataFrame, model: BrownModel) -> BrownModel:
    """The model with the class bigrams of the training texts (``_looked_up``)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES * CLASSES, dtype=np.int64)
        for b in batches:
            seq, ends = _flat(b.column("seq"))
            seq = _sequence(seq, ends, LAST)
            total += np.bincount(seq[:-1] * CLASSES + seq[1:], minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["cell", "n"])

    table = np.zeros(CLASSES * CLASSES)
    for r in texts.where("training").select("seq").mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():  # CLASSES squared rows
        table[r["cell"]] = r["n"]
    return replace(model, **_class_figures(table.reshape(CLASSES, CLASSES), model.singles))


def _probabilities(texts: DataFrame, model: BrownModel) -> DataFrame:
    """Scores of the texts of ``_looked_up``."""
    held = texts.sparkSession.sparkContext.broadcast((model.step, model.seen, model.unseen))
    end_emit = float(model.seen[LAST] + np.log10(model.ends) if model.ends else model.unseen[LAST])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, seen, unseen = held.value
        for b in batches:
            seq, ends = _flat(b.column("seq"))
            cls = seq & (UNKNOWN - 1)
            starts, row = np.concatenate(([0], ends[:-1])) if len(ends) else ends, np.arange(len(ends))
            full = _sequence(cls, ends, LAST)
            steps = step[full[:-1], full[1:]]
            score = b.column("logs").to_numpy() + _sums(np.where(seq < UNKNOWN, seen[cls], unseen[cls]), starts, ends) + _sums(steps, starts + row, ends + row + 1) + end_emit
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("row", "n_tokens", "known", "base")), pa.array(score)], ["row", "n_tokens", "n_known", "base_score", "score"])

    kind = texts.schema["row"].dataType.simpleString()
    scored = texts.select("row", "n_tokens", "known", "base", "logs", "seq").mapInArrow(run, f"row {kind}, n_tokens long, n_known long, base_score double, score double")
    return scored.select("row.*", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def score_brown(docs: DataFrame, model: BrownModel, counts: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns in ``keep``, ``n_tokens`` (words and one end), ``n_known`` (seen in training), ``base_score`` (add-one unigram) and
    ``score`` (class bigram), log10 of the text's probability. Rare words have the class of their ending. Whole texts; a null text is empty and consists of its end. Equal rows
    score alike; a model of no texts knows no words; an empty table gives an empty result; other columns are ignored."""
    cold = counts.where(F.col("n") < max(1.0, model.tokens * HOT)).withColumn("cls", F.lit(None).cast("int"))
    return _probabilities(_looked_up(_class_texts(docs, F.lit(False), model, keep, text_col), model, cold), model)


def brown_scores(docs: DataFrame, training: Column, keep: list[str], text_col: str = "text") -> DataFrame:
    """Fit on the rows where ``training`` holds, every word with a class by its own contexts, and score all rows (as ``score_brown`` does)."""
    model, _ = fit_brown(docs.where(training).select(F.coalesce(F.col(text_col), F.lit("")).alias("txt")))
    first = _class_texts(docs, training, model, keep, text_col)
    texts = materialize(_looked_up(first, model, merge_rare(first, model)), "brown-texts")
    return _probabilities(texts, _count_again(texts, model))
