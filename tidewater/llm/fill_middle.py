"""Fill-in-the-middle transformation, with cuts at token boundaries found in a compressed set of positions.

A text's units are runs of ASCII letters and single other characters; their ends are a set of positions that is kept as Roaring
bitmaps are: positions with equal high 16 bits share a container, and a container is a sorted array (up to 4,096 positions), a
bitmap of 65,536 bits, or a list of runs where that is smaller. Cumulative cardinalities of the containers lead ``select`` to the one
that holds the k-th boundary by binary search; a select inside it gives the position. Both cuts of a text are two such look-ups.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import slices

# fixed values of the layout: positions a container spans, largest array, bytes of a bitmap
SPAN, ARRAY_MAX, BITMAP_BYTES = 1 << 16, 4096, 8192
MARKS = PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM, SPM_BELOW = 90, 20  # of 100


class ArrayContainer:
    """Sorted 16-bit positions."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.low[k])


class BitmapContainer:
    """One bit a position, with the number of bits before each 64-bit word."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(SPAN, dtype=bool)
        bits[low] = True
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.before, k, side="right")) - 1
        rest, bits = k - int(self.before[word]), int(self.words[word])
        for _ in range(rest):
            bits &= bits - 1  # drops the lowest bit
        return word * 64 + (bits & -bits).bit_length() - 1


class RunContainer:
    """First positions of runs of consecutive positions, with the number of positions before each run."""

    def __init__(self, first: np.ndarray, length: np.ndarray):
        self.first = first.astype(np.uint16)
        self.before = np.concatenate(([0], np.cumsum(length, dtype=np.int64)))

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, side="right")) - 1
        return int(self.first[run]) + k - int(self.before[run])


def container(low: np.ndarray):
    """The smallest container for sorted distinct positions below SPAN."""
    breaks = np.flatnonzero(np.diff(low) != 1) + 1
    runs = len(breaks) + 1
    plain = 2 * len(low) if len(low) <= ARRAY_MAX else BITMAP_BYTES
    if 4 * runs < plain:
        first = np.concatenate(([0], breaks))
        return RunContainer(low[first], np.diff(np.append(first, len(low))))
    return ArrayContainer(low) if len(low) <= ARRAY_MAX else BitmapContainer(low)


class BoundarySet:
    """A set of positions given in ascending order."""

    def __init__(self, positions: np.ndarray):
        high = positions >> 16
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(high)) + 1, [len(positions)])) if len(positions) else np.zeros(1, dtype=np.int64)
        self.keys = [int(high[c]) for c in cuts[:-1]]
        self.containers = [container(positions[a:b] & (SPAN - 1)) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        self.cardinalities = [int(c) for c in cuts]  # positions before each container, and of all

    def __len__(self) -> int:
        return self.cardinalities[-1]

    def select(self, k: int) -> int:
        """The k-th position, counted from zero."""
        at = bisect_right(self.cardinalities, k) - 1
        return self.keys[at] * SPAN + self.containers[at].select(k - self.cardinalities[at])

    def cut(self, units: int) -> int:
        """Where the first ``units`` units end."""
        return self.select(units - 1) if units else 0


def unit_ends(points: np.ndarray) -> np.ndarray:
    """Ends of the units of a text given as code points: everywhere but between two letters."""
    folded = points | 0x20
    letter = (folded >= 97) & (folded <= 122)
    return np.flatnonzero(~(letter & np.append(letter[1:], False))) + 1


def draws(ident: int | None, epoch: int) -> list[int]:
    """Four 32-bit numbers that follow from the document's id (nothing follows the colon where there is none)."""
    digest = hashlib.sha256(f"{epoch}:{'' if ident is None else ident}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def transform(text: str, ident: int | None, epoch: int = 1) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, characters of the prefix, of the middle, output)."""
    ends = BoundarySet(unit_ends(np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)))
    n, (h1, h2, h3, h4) = len(ends), draws(ident, epoch)
    if not n or h3 % 100 >= PLAIN_FROM or any(m in text for m in MARKS):
        return n, "plain", None, None, text
    a, b = (ends.cut(k) for k in sorted((h1 % (n + 1), h2 % (n + 1))))
    before, inner, after = text[:a], text[a:b], text[b:]
    if h4 % 100 < SPM_BELOW:
        return n, "spm", a, b - a, SUFFIX + after + PREFIX + before + MIDDLE + inner
    return n, "psm", a, b - a, PREFIX + before + SUFFIX + after + MIDDLE + inner


def restore(output: str, form: str) -> str:
    """The text that an output was made from, read from the output and its form alone. A text that is not plain holds no mark, and no mark begins
    inside another, so the first one found is the one that was set."""
    if form == "plain":
        return output
    first, second = (SUFFIX, PREFIX) if form == "spm" else (PREFIX, SUFFIX)
    one, rest = output.removeprefix(first).split(second, 1)
    two, inner = rest.split(MIDDLE, 1)
    return two + inner + one if form == "spm" else one + inner + two


def fill_middle(docs: DataFrame, keep: list[str], id_col: str = "doc_id", text_col: str = "text", epoch: int = 1) -> DataFrame:
    """The columns in ``keep`` and ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars`` (null if plain), ``output`` and ``restored``.

    Whole texts; a null text is empty and stays plain. Rows with one id draw the same numbers, rows without an id share those of
    the empty id; equal rows give equal results. A text is held once with four bytes a character while it is cut. An empty
    table gives an empty result; other columns are ignored. Nothing is shuffled."""
    source = docs.select(F.struct(*keep).alias("row"), F.col(id_col).cast("long").alias("ident"), F.coalesce(F.col(text_col), F.lit("")).alias("txt"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found = [transform(t, i, epoch) for t, i in zip(b.column("txt").to_pylist(), b.column("ident").to_pylist(), strict=True)]
            n, form, head, inner, out = ([r[i] for r in found] for i in range(5))
            back = [restore(o, f) for o, f in zip(out, form, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(head, pa.int64()), pa.array(inner, pa.int64()),
                                              pa.array(out, pa.string()), pa.array(back, pa.string())],
                                             ["row", "n", "form", "prefix_chars", "middle_chars", "output", "restored"])

    kind = source.schema["row"].dataType.simpleString()
    out = source.mapInArrow(run, f"row {kind}, n long, form string, prefix_chars long, middle_chars long, output string, restored string")
    return out.select("row.*", "n", "form", "prefix_chars", "middle_chars", "output", "restored")
