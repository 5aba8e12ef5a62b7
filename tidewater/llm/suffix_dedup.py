"""Exact byte-substring dedup with suffix arrays over shards.

Equal windows (``length`` bytes) have equal anchors (``pieces``), so windows are dealt to shards by anchor and
equal ones meet, whatever documents they stand in. A count-min sketch over the anchors first sets
aside every piece of text that cannot repeat; copies of a piece are grouped by content, and only its first
occurrence goes to a shard (a second sketch, of those places, lets a scan cut them out of the texts without a join of the texts; what it lets
through by chance is dropped where it meets the table of the places). A shard joins its pieces with a separator byte that UTF-8 never holds, builds
the suffix array by induced sorting and its permuted common prefixes (``suffix_array``), and groups neighbours
that share ``length`` bytes; the first of each group by (id, start) stays, the others are removed.

An anchor inside a passage that very many documents share has as many pieces as there are contexts. Such an anchor doesn't go to
a shard: the windows of its pieces are grouped by a 128-bit hash, with partial sums before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import byte_total, keyed_texts, materialize, order_key, slices
from tidewater.llm.pieces import Rolling, build_sketch, find_pieces, mix, repeated, sketch_width
from tidewater.llm.suffix_array import permuted_common_prefixes, suffix_array

TAG_BITS = 24  # as in substring_dedup: of a text's hash, before the byte number
AT_BITS = 63 - TAG_BITS
SHARD_BYTES = 3 << 19  # a suffix array is built over about this much text at a time (some 100 bytes of memory for each)
SLICE = 1 << 19  # text hashed at a time: a task holds about 15 numbers of 8 bytes for each byte
CROWD = 100_000  # pieces of one anchor that a shard takes (about 14 MB); windows of fuller anchors are grouped one by one
SEPARATOR = b"\xff"
_SYMBOL = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _tag(raw: bytes) -> int:
    return xxhash.xxh3_64_intdigest(raw) >> (64 - TAG_BITS)


def _place(doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    return mix(doc.view(np.uint64) + mix(at.view(np.uint64)))


def _bytes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    texts = [t.encode() for t in batch.column("txt").to_pylist()]
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    return _SYMBOL[np.frombuffer(b"".join(texts), dtype=np.uint8)], ends, texts


def shard_repeats(pieces: list[bytes], docs: np.ndarray, ats: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans (doc, at, bytes) of the windows in one shard's pieces that aren't the first of their kind."""
    text = np.frombuffer(SEPARATOR.join(pieces) + SEPARATOR, dtype=np.uint8)
    sizes = np.array([len(p) for p in pieces], dtype=np.int64)
    ends = np.cumsum(sizes + 1) - 1  # of each piece: where its separator stands
    order = suffix_array(text.astype(np.int32), 256)
    _, common = permuted_common_prefixes(text, order)
    piece = np.repeat(np.arange(len(pieces)), sizes + 1)
    fits = ends[piece] - np.arange(len(text)) >= length
    joins = (common >= length)[order] & fits[order]
    group = np.cumsum(~joins)
    member = joins.copy()
    member[:-1] |= joins[1:]
    place, group = order[member].astype(np.int64), group[member]
    doc, at = docs[piece[place]], ats[piece[place]] + place - (ends - sizes)[piece[place]]
    by = np.lexsort((at, doc, group))
    later = by[1:][group[by][1:] == group[by][:-1]]
    gone = np.zeros(len(text) + 1, dtype=bool)
    gone[place[later]] = True
    begin = np.flatnonzero(gone & ~np.concatenate(([False], gone[:-1])))
    stop = np.flatnonzero(gone[:-1] & ~gone[1:]) + 1
    return docs[piece[begin]], ats[piece[begin]] + begin - (ends - sizes)[piece[begin]], stop - begin + length - 1


def chosen_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, int, bytes]]:
    """The rows (anchor, doc, at, piece) that stand behind a row of the same place without a piece, once each (equal rows of a table bring a piece
    twice). Rows come sorted by place, the ones without a piece first; one place is held at a time."""
    place = None
    for b in batches:
        for h in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if h[3] is None:
                place = h[:3]
            elif h[:3] == place:
                place = None
                yield h


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100, gram: int = 32, keep: list[str] | None = None) -> DataFrame:
    """One row per input row: the columns in ``keep`` (the id), ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs), ``kept``
    (binary) and ``kept_text`` (the same without what is left of characters that were cut in two).

    A byte goes if a string of ``length`` bytes that covers it also starts earlier: in a document with a smaller id, or in
    the same one before it. A null text is empty; rows with a null id come after all others, as documents of their own. Equal rows (same id, same text) are one
    document and get equal results; rows that share an id but not the text are read as one document, in the order of the
    texts' hashes, without matches across them. An empty table gives an empty result; other columns are ignored.
    """
    spark, keep = docs.sparkSession, keep or [id_col]
    texts = keyed_texts(docs, id_col, text_col)
    total = byte_total(texts)

    def anchors_of(b: pa.RecordBatch) -> np.ndarray:
        symbols, ends, _ = _bytes(b)
        found = find_pieces(symbols, ends, length, gram)
        return np.empty(0, dtype=np.uint64) if found is None else found.site_anchor

    bits = spark.sparkContext.broadcast(build_sketch(texts, anchors_of, lambda batches: slices(batches, limit=SLICE), sketch_width(total * 2 / (length - gram + 2))))

    def kept_pieces(b: pa.RecordBatch, chosen) -> tuple | None:
        """Pieces of a slice that ``chosen`` lets through: (found, kept, start, size, document, place in it), and the slice's texts."""
        symbols, ends, raw = _bytes(b)
        found = find_pieces(symbols, ends, length, gram)
        keep = np.flatnonzero(repeated(bits.value, found.anchor)) if found is not None else np.empty(0, dtype=np.int64)
        if not len(keep):
            return None
        start, row = found.start[keep], found.row[keep]
        tags = np.array([_tag(t) for t in raw], dtype=np.int64) << AT_BITS
        doc = b.column("doc").to_numpy()[row]
        at = tags[row] + start - (ends - np.diff(ends, prepend=0))[row]
        some = chosen(found.anchor[keep], doc, at)
        return symbols, raw, found, keep[some], start[some], (found.count[keep] + length - 1)[some], doc[some], at[some]

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, limit=SLICE):
            if (kept := kept_pieces(b, lambda anchor, doc, at: np.ones(len(doc), dtype=bool))) is not None:
                symbols, _, found, keep, start, size, doc, at = kept
                columns = [found.rolling.ranges(start, start + size).view(np.int64), Rolling(symbols, 1).ranges(start, start + size).view(np.int64),
                           found.anchor[keep].view(np.int64), doc, at, size.astype(np.int32), found.again[keep]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["p1", "p2", "anchor", "doc", "at", "size", "again"])

    def cut_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The bytes of the pieces in ``places``, and of some let through by chance, but none of a crowded anchor."""
        for b in slices(batches, limit=SLICE):
            if (kept := kept_pieces(b, lambda anchor, doc, at: repeated(places.value, _place(doc, at)) & ~np.isin(anchor.view(np.int64), full.value))) is not None:
                _, raw, found, keep, start, size, doc, at = kept
                text = b"".join(raw)
                bodies = [text[i : i + n] for i, n in zip(start.tolist(), size.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(found.anchor[keep].view(np.int64)), pa.array(doc), pa.array(at), pa.array(bodies, pa.binary())], ["anchor", "doc", "at", "piece"])

    def list_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Hashes of the windows of the pieces in ``crowded_places``. A place of these anchors let through by chance does no harm: its windows are
        compared like all others."""
        for b in slices(batches, limit=SLICE):
            if (kept := kept_pieces(b, lambda anchor, doc, at: repeated(crowded_places.value, _place(doc, at)) & np.isin(anchor.view(np.int64), full.value))) is not None:
                symbols, _, found, _, start, size, doc, at = kept
                n = size - length + 1
                within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                window = np.repeat(start, n) + within
                hashes = [r.ranges(window, window + length).view(np.int64) for r in (found.rolling, Rolling(symbols, 1))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*hashes, np.repeat(doc, n), np.repeat(at, n) + within)], ["h1", "h2", "doc", "at"])

    def mark_places(rows: DataFrame, count: int):
        key = lambda b: _place(b.column("doc").to_numpy(), b.column("at").to_numpy())
        return spark.sparkContext.broadcast(build_sketch(rows.select("doc", "at"), key, iter, sketch_width(2 * count), least=1))

    def sort_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, bytes]] = []
        size = 0

        def result() -> pa.RecordBatch:
            found = shard_repeats([h[3] for h in held], np.array([h[1] for h in held]), np.array([h[2] for h in held]), length)
            return pa.RecordBatch.from_arrays([pa.array(f.astype(np.int64)) for f in found], ["doc", "at", "size"])

        for h in chosen_pieces(batches):
            if size >= SHARD_BYTES and h[0] != held[-1][0]:
                yield result()
                held, size = [], 0
            held.append(h)
            size += len(h[3]) + 1
        if held:
            yield result()

    pieces = materialize(texts.mapInArrow(candidates, "p1 long, p2 long, anchor long, doc long, at long, size int, again boolean"), "suffix-pieces")
    kinds = pieces.groupBy("p1", "p2").agg(F.min(F.struct("doc", "at")).alias("head"), F.min("anchor").alias("anchor"), F.min("size").alias("size"), F.max("again").alias("again"), F.count("*").alias("n"))
    kinds = materialize(kinds, "suffix-kinds")
    copies = pieces.join(kinds.where("n > 1").select("p1", "p2", "head"), ["p1", "p2"]).where("doc != head.doc or at != head.at").select("doc", "at", F.col("size").cast("long"))
    shared = kinds.groupBy("anchor").agg(F.count("*").alias("n"), F.max("again").alias("again")).where("n > 1 or again").select("anchor", "n")
    todo = materialize(kinds.drop("n").join(shared, "anchor").select("anchor", "head.doc", "head.at", "size", (F.col("n") > CROWD).alias("crowded")), "suffix-todo")
    number, amount = todo.where("not crowded").agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), amount // (2 * SHARD_BYTES))
    places = mark_places(todo.where("not crowded"), number)
    full = shared.where(F.col("n") > CROWD).select("anchor").toPandas()["anchor"].to_numpy(dtype=np.int64)  # one in CROWD of all pieces at most
    full = spark.sparkContext.broadcast(full)
    wanted = todo.where("not crowded").select("anchor", "doc", "at", F.lit(None).cast("binary").alias("piece"))
    shard_rows = texts.mapInArrow(cut_pieces, "anchor long, doc long, at long, piece binary").unionByName(wanted)
    shard_rows = shard_rows.repartition(shards, "anchor").sortWithinPartitions("anchor", "doc", "at", F.col("piece").isNotNull())
    later = shard_rows.mapInArrow(sort_shards, "doc long, at long, size long")
    crowded = todo.where("crowded").count()
    if crowded:
        crowded_places = mark_places(todo.where("crowded"), crowded)
        each = materialize(texts.mapInArrow(list_windows, "h1 long, h2 long, doc long, at long"), "suffix-windows")
        owner = each.groupBy("h1", "h2").agg(F.min(F.struct("doc", "at")).alias("head"), F.count("*").alias("n")).where("n > 1").drop("n")
        repeats = each.join(owner, ["h1", "h2"]).where("doc != head.doc or at != head.at")
        later = later.unionByName(repeats.select("doc", "at", F.lit(length).cast("long").alias("size")))
    spans = copies.unionByName(later).groupBy("doc").agg(F.collect_list(F.struct("at", "size")).alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            out: tuple[list, ...] = ([], [], [], [], [])
            for text, doc_spans in zip(b.column("txt").to_pylist(), b.column("spans"), strict=True):
                raw = text.encode()
                n_removed = n_spans = 0
                kept = raw
                if doc_spans.is_valid:
                    at, size = (doc_spans.values.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                    mine = at >> AT_BITS == _tag(raw)
                    at, size = at[mine] & ((1 << AT_BITS) - 1), size[mine]
                    edge = np.zeros(len(raw) + 1, dtype=np.int64)
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + size, -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    n_removed, n_spans = int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum())
                    kept = np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes()
                for column, v in zip(out, (len(raw), n_removed, n_spans, kept, kept.decode(errors="ignore")), strict=True):
                    column.append(v)
            yield pa.RecordBatch.from_arrays([b.column("row"), *(pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string()), strict=True))], ["row", "n_bytes", "n_removed", "n_spans", "kept", "kept_text"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(F.struct(*keep).alias("row"), order_key(F.col(id_col), text).alias("doc"), text.alias("txt"))
    kind = source.schema["row"].dataType.simpleString()
    out = source.join(spans, "doc", "left").select("row", "txt", "spans")
    out = out.mapInArrow(cut, f"row {kind}, n_bytes long, n_removed long, n_spans long, kept binary, kept_text string")
    return out.select("row.*", "n_bytes", "n_removed", "n_spans", "kept", "kept_text")
