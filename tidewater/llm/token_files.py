"""Token ids in seekable binary files: one zstandard frame a document, a trailing seek table, a checksum for every frame.

A file is a sequence of zstandard frames, so any zstandard reader can decompress all of it:

* per document, in ascending order: an independent frame (with zstandard's own checksum) whose content is the document's ids as
  little-endian numbers, followed by a skippable frame of five bytes (below);
* a skippable frame with the bytes an id takes and the documents' keys, eight bytes each;
* the seek table, in the published seekable format: compressed size, decompressed size and checksum (lowest 32 bits of XXH64) of every document's
  frame, their number, a descriptor and the closing magic number. Sizes include the skippable frame behind a document's.

The files are written by Spark's text writer, so its commit protocol covers lost executors and any file system Spark reaches: a row is
a piece of a file, and the line separator is the five bytes that close the seek table, which the skippable frames make room for elsewhere.
A reader takes the seek table from the end of a file, then reads and decompresses the frames of the documents it wants and no others.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterable, Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import NULL_IDS, materialize, order_key, slices
from tidewater.llm.word_ids import SharedWordIds

# fixed values of the zstandard frame and seekable formats
SKIPPABLE, SEEK_TABLE, FOOTER_MAGIC, CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
KEYS = SKIPPABLE + 1
TAIL = struct.pack("<BI", CHECKSUMS, FOOTER_MAGIC)
GAP = struct.pack("<II", SKIPPABLE, len(TAIL))  # TAIL itself comes from the writer
ENTRY = np.dtype([("stored", "<u4"), ("size", "<u4"), ("checksum", "<u4")])

FILE_BYTES = 32 << 20  # a file closes with the document that reaches this
LEVEL = 3


class ChecksumError(ValueError):
    pass


def _closing(width: int, keys: list[int], entries: list[tuple[int, int, int]]) -> list[bytes]:
    """The two last pieces of a file, each without TAIL."""
    keyed = struct.pack("<B", width) + np.array(keys, dtype="<i8").tobytes()
    table = np.array(entries, dtype=ENTRY).tobytes() + struct.pack("<I", len(entries))
    return [struct.pack("<II", KEYS, len(keyed) + len(TAIL)) + keyed, struct.pack("<II", SEEK_TABLE, len(table) + len(TAIL)) + table]


class TokenFile:
    """Reads one file through a seekable binary stream: the closing parts at once, frames only when asked for."""

    def __init__(self, stream: BinaryIO):
        self.stream = stream
        end = stream.seek(0, os.SEEK_END)
        foot = self._read(end - 4 - len(TAIL), 4 + len(TAIL))
        if foot[4:] != TAIL:
            raise ChecksumError("no seek table at the end of the file")
        count = struct.unpack("<I", foot[:4])[0]
        table_at = end - len(foot) - count * ENTRY.itemsize - 8
        head = self._read(table_at, 8 + count * ENTRY.itemsize)
        if struct.unpack("<II", head[:8]) != (SEEK_TABLE, count * ENTRY.itemsize + len(foot)):
            raise ChecksumError("broken seek table")
        self.entries = np.frombuffer(head[8:], dtype=ENTRY)
        self.ends = np.cumsum(self.entries["stored"].astype(np.int64))
        keyed_at = int(self.ends[-1]) if count else 0
        keyed = self._read(keyed_at, table_at - keyed_at)
        if struct.unpack("<II", keyed[:8]) != (KEYS, len(keyed) - 8) or len(keyed) != 9 + 8 * count + len(TAIL):
            raise ChecksumError("broken key table")
        self.width = keyed[8]
        self.keys = np.frombuffer(keyed[9 : -len(TAIL)], dtype="<i8")
        self.sizes = self.entries["size"].astype(np.int64) // self.width  # ids of each document

    def _read(self, at: int, size: int) -> bytes:
        if at < 0:
            raise ChecksumError("the file is too short")
        self.stream.seek(at)
        out = self.stream.read(size)
        if len(out) != size:
            raise ChecksumError("the file is too short")
        return out

    def __len__(self) -> int:
        return len(self.entries)

    def ids(self, frame: int) -> np.ndarray:
        """Ids of the frame-th document; reads its frame only."""
        stored, size, checksum = (int(x) for x in self.entries[frame])
        data = self._read(int(self.ends[frame]) - stored, stored - len(GAP) - len(TAIL))
        try:
            plain = zstandard.ZstdDecompressor().decompress(data, max_output_size=size, read_across_frames=False)
        except zstandard.ZstdError as e:
            raise ChecksumError(f"frame {frame}: {e}") from e
        if len(plain) != size or xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != checksum:
            raise ChecksumError(f"frame {frame} differs from its checksum")
        return np.frombuffer(plain, dtype=f"<u{self.width}")

    def find(self, key: int) -> range:
        """Frames of the documents with that key (rows of one id lie together)."""
        return range(*(int(np.searchsorted(self.keys, key, side=s)) for s in ("left", "right")))


def _frames(docs: DataFrame, definition: str, end_id: int, id_col: str, text_col: str, level: int) -> DataFrame:
    """Per document its key, a hash of its text, and its frame with size and checksum of the content. Nothing is shuffled."""
    tokenizer = docs.sparkSession.sparkContext.broadcast(SharedWordIds(definition))
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(order_key(F.col(id_col), text).alias("doc"), F.xxhash64(text).alias("tie"), text.alias("txt"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pack = tokenizer.value.get(), zstandard.ZstdCompressor(level=level, write_checksum=True)
        for b in slices(batches, limit=3 << 20):
            ids, sizes = words.encode(b.column("txt"))
            ends = np.cumsum(sizes)
            closed = np.insert(ids, ends, end_id).astype(words.kind).tobytes()
            cuts = [0, *((ends + np.arange(1, len(ends) + 1)) * words.width).tolist()]
            plain = [closed[i:j] for i, j in zip(cuts, cuts[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc"), b.column("tie"), pa.array([pack.compress(p) for p in plain], pa.binary()), pa.array([len(p) for p in plain], pa.int64()),
                 pa.array([xxhash.xxh64_intdigest(p) & 0xFFFFFFFF for p in plain], pa.int64()), pa.array([words.width] * len(plain), pa.int32())],
                ["doc", "tie", "frame", "size", "checksum", "width"])

    return source.mapInArrow(run, "doc long, tie long, frame binary, size long, checksum long, width int")


def write_token_files(docs: DataFrame, path: str, tokenizer_file: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", file_bytes: int = FILE_BYTES,
                      level: int = LEVEL) -> None:
    """Write the ids of every whole text (a null one is empty), each followed by ``end_id``, to a new folder of token files.

    Files go by name in ascending order of ids (``part=`` folder, then part number, then ``seg``); inside a file documents ascend. Rows of one id are ordered by their
    text's hash; rows without an id come last. Frames are dealt into ranges of keys with a random tail, so that equal keys can't crowd
    one range; a task closes a file with the document that reaches ``file_bytes`` and opens the next. Texts themselves aren't shuffled. An
    empty table writes no file; other columns are ignored. The tokenizer file is read once, on the driver, and broadcast (about 2 MB)."""
    with open(tokenizer_file, encoding="utf-8") as f:
        definition = f.read()
    spark = docs.sparkSession
    frames = materialize(_frames(docs, definition, end_id, id_col, text_col, level), "token-frames")
    total = frames.agg(F.sum(F.octet_length("frame"))).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // file_bytes))
    dealt = frames.withColumn("tail", F.rand(7)).repartitionByRange(ranges, "doc", "tie", "tail").sortWithinPartitions("doc", "tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg, held, keys, entries, width = 0, 0, [], [], 2

        def rows(pieces: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
            columns = zip(*pieces, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.binary()), strict=True)], ["seg", "at", "piece"])

        for b in batches:
            pieces = []
            for doc, frame, size, checksum, width in zip(*(b.column(c).to_pylist() for c in ("doc", "frame", "size", "checksum", "width")), strict=True):
                pieces.append((seg, len(entries), frame + GAP))
                keys.append(doc)
                entries.append((len(frame) + len(GAP) + len(TAIL), size, checksum))
                held += len(frame)
                if held >= file_bytes:
                    pieces += ((seg, len(entries) + i, p) for i, p in enumerate(_closing(width, keys, entries)))
                    seg, held, keys, entries = seg + 1, 0, [], []
            if pieces:
                yield rows(pieces)
        if entries:
            yield rows([(seg, len(entries) + i, p) for i, p in enumerate(_closing(width, keys, entries))])

    pieces = dealt.select("doc", "frame", "size", "checksum", "width").mapInArrow(run, "seg int, at long, piece binary")
    # partitionBy asks for rows sorted by seg; sorting by (seg, at) says so and keeps the order inside a file
    pieces = pieces.sortWithinPartitions("seg", "at").select("seg", F.col("piece").cast("string").alias("piece"))
    pieces.write.mode("error").partitionBy("seg").option("encoding", "ISO-8859-1").option("lineSep", TAIL.decode("iso-8859-1")).option("compression", "none").text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    """The files of a folder: ``file`` (its path), ``part`` and ``seg`` (its place in the order), ``content``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    place = [F.regexp_extract("path", p, 1).cast("long").alias(n) for p, n in ((r"/part-(\d+)-[^/]*$", "part"), (r"/seg=(\d+)/[^/]*$", "seg"))]
    return files.where("length > 0").select(F.col("path").alias("file"), *place, "content")


def _scan(files: DataFrame, schema: str, rows) -> DataFrame:
    """Apply ``rows(file name, TokenFile, frames asked for) -> lists of columns`` to every file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            asked = b.column("frames") if "frames" in b.schema.names else None
            for i in range(b.num_rows):
                f = TokenFile(pa.BufferReader(b.column("content")[i].as_buffer()))
                for columns in rows(b.column("file")[i].as_py(), f, None if asked is None else asked[i].as_py()):
                    yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in schema.split(", ")])

    return files.drop("part", "seg").mapInArrow(run, schema)


def _totals(files: DataFrame) -> DataFrame:
    """Per file the number of its ids, from the seek table."""
    return _scan(files, "file string, total long", lambda name, f, _: [[pa.array([name]), pa.array([int(f.sizes.sum())])]])


def _keys(files: DataFrame) -> DataFrame:
    """Per document its file, frame and key, from the key table."""
    return _scan(files, "file string, frame long, key long", lambda name, f, _: [[pa.array([name] * len(f), pa.string()), pa.array(np.arange(len(f))), pa.array(f.keys)]])


def _documents(files: DataFrame, digest: bool) -> DataFrame:
    """Documents of files: key, number of ids, the ids before it in its file, and its ids (or their crc32)."""

    def rows(name: str, f: TokenFile, asked: list[int] | None) -> Iterator[list[pa.Array]]:
        before = np.cumsum(f.sizes) - f.sizes
        chosen = np.arange(len(f)) if asked is None else np.array(asked, dtype=np.int64)
        for k in range(0, len(chosen), 1000):
            some = chosen[k : k + 1000]
            wide = (f.ids(int(j)).astype("<u4").tobytes() for j in some)
            last = pa.array([zlib.crc32(w) for w in wide], pa.int64()) if digest else pa.array(list(wide), pa.binary())
            yield [pa.array([name] * len(some), pa.string()), pa.array(f.keys[some]), pa.array(f.sizes[some]), pa.array(before[some]), last]

    return _scan(files, "file string, key long, n_tokens long, before long, " + ("ids_crc32 long" if digest else "ids binary"), rows)


def _file_starts(files: DataFrame) -> DataFrame:
    """Per file the number of ids in all files before it: one row a file goes through the running sum."""
    order = Window.orderBy("part", "seg").rowsBetween(Window.unboundedPreceding, -1)
    placed = _totals(files).join(files.select("file", "part", "seg"), "file")
    return placed.select("file", F.coalesce(F.sum("total").over(order), F.lit(0)).alias("file_start"))


def read_token_files(spark: SparkSession, path: str, wanted: DataFrame | None = None, digest: bool = False) -> DataFrame:
    """Documents of a folder of token files: ``doc_id`` (null for rows written without one), ``start`` (ids of all documents before it), ``n_tokens`` and ``ids``
    (binary, little-endian unsigned 32-bit numbers), or with ``digest`` their unsigned ``ids_crc32`` instead. Every frame that is read is checked
    against its checksum; a broken one raises ``ChecksumError``.

    ``wanted`` (a column ``doc_id``) limits this to some documents: their frames are looked up in the key tables, and no other is
    decompressed. Ids that aren't there are left out, repeated ones don't count twice; rows of one id all come."""
    files = _files(spark, path)
    read = files
    if wanted is not None:
        ids = wanted.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("key")).distinct()
        hits = _keys(files).join(ids, "key", "left_semi").groupBy("file").agg(F.sort_array(F.collect_list("frame")).alias("frames"))  # a file's documents at most
        read = files.join(hits, "file")
    shown = F.when(F.col("key") < NULL_IDS, F.col("key")).alias("doc_id")
    found = _documents(read, digest).join(_file_starts(files), "file")
    return found.select(shown, (F.col("file_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32" if digest else "ids")


def read_some(streams: Iterable[BinaryIO], keys: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """Ids of a few documents straight from seekable streams (any file system's), without a Spark job."""
    for stream in streams:
        f = TokenFile(stream)
        for key in keys:
            for frame in f.find(key):
                yield key, f.ids(frame)
