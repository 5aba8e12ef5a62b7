"""Filter interaction audit: what each of several filters removes, in every order in which they can run.

A document's filters are decided once, as a bit mask of those that it fails. Only the mask decides what happens to a document in
an order, so documents are counted by part and mask first (2^filters cells a part at most) and each cell is
folded through the array of orders, a literal of the plan: ``aggregate`` walks one order's filters with the state "already removed",
``transform`` does so for every order. The cells' arrays of weighted structs are then added element by element.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import materialize, order_key

SPLIT = r"[\x20\x09-\x0D]+"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
DUPLICATE = "E"  # the filter that needs the whole table; all others look at one text


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions of one text: too few words, too few distinct words, too many capitals, odd characters."""
    words = F.array_remove(F.split(text, SPLIT), "")
    capitals = F.octet_length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * capitals.cast("long") > 10 * F.length(text).cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }


def _bit(letters: str, letter: str) -> int:
    return 1 << letters.index(letter)


def mask_cells(docs: DataFrame, labels: DataFrame, filters: dict[str, Column], duplicate: str | None = DUPLICATE, part: Column | None = None,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents counted by part and mask of failed filters: ``part``, ``mask``, ``n``, ``good`` (quality 1), ``toxic`` (toxic 1). ``filters`` are
    conditions on the column ``__txt``; their bits follow their order, ``duplicate`` comes last.

    The duplicate filter fails documents whose text a document with a smaller id has too. Only the smallest id of each text is looked up, by
    text hash and id, so a text that a third of all documents share is one reduced row and not a join key."""
    letters = "".join(filters) + (duplicate or "")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.coalesce(part if part is not None else F.lit(""), F.lit("")).alias("part"), order_key(F.col(id_col), text).alias("key"), text.alias("__txt"))
    mask = sum((F.when(c, F.lit(_bit(letters, k))).otherwise(F.lit(0)) for k, c in filters.items()), F.lit(0))
    marked = rows.select("part", "key", F.unhex(F.sha2("__txt", 256)).alias("h"), F.coalesce(mask, F.lit(0)).cast("int").alias("mask"))
    marked = marked.groupBy("part", "key", "h", "mask").agg(F.count("*").alias("n"))  # equal rows meet here, before any join
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("key"))
    marks = marks.agg(F.max((F.col("quality") == 1).cast("int")).alias("is_good"), F.max((F.col("toxic") == 1).cast("int")).alias("is_toxic"))
    weigh = [F.col("n"), *((F.col("n") * F.coalesce(F.col(f"is_{k}"), F.lit(0))).alias(k) for k in ("good", "toxic"))]
    base = materialize(marked.join(marks, "key", "left").select("part", "key", "h", "mask", *weigh), "filter-audit")
    sums = [F.sum(k).alias(k) for k in ("n", "good", "toxic")]
    total = base.groupBy("part", "mask").agg(*sums)
    if duplicate is None:
        return total
    bit = _bit(letters, duplicate)
    least = base.groupBy("h").agg(F.min("key").alias("key"))
    firsts = base.join(least, ["h", "key"], "left_semi").groupBy("part", "mask").agg(*sums)
    moved = [F.struct((F.col("mask") + b).alias("mask"), *((F.col(k) * sign).alias(k) for k in ("n", "good", "toxic"))) for b, sign in ((0, 1), (bit, -1))]
    signed = firsts.select("part", F.inline(F.array(*moved))).unionByName(total.withColumn("mask", F.col("mask") + bit))
    return signed.groupBy("part", "mask").agg(*sums)


def _fold(orders: Column) -> Column:
    """600 weighted structs (for five filters) of the cell in the columns mask, n, good, toxic: one per order and step."""
    mask, zero = F.col("mask"), F.lit(0).cast("long")

    def step(state: Column, bit: Column) -> Column:
        fails, gone = mask.bitwiseAND(bit) != 0, state["gone"]
        lost = fails & ~gone
        cases = {"kept": (~fails & ~gone, "n"), "removed": (lost, "n"), "redundant": (fails & gone, "n"), "unique_fails": (mask == bit, "n"),
                 "good_lost": (lost, "good"), "toxic_lost": (lost, "toxic")}
        weighted = F.struct(bit.alias("bit"), *(F.when(when, F.col(of)).otherwise(zero).alias(k) for k, (when, of) in cases.items()))
        return F.struct((gone | fails).alias("gone"), F.concat(state["out"], F.array(weighted)).alias("out"))

    kind = "array<struct<bit:int," + ",".join(f"{k}:bigint" for k in COUNTS) + ">>"
    start = F.struct(F.lit(False).alias("gone"), F.expr(f"cast(array() as {kind})").alias("out"))
    return F.flatten(F.transform(orders, lambda order: F.aggregate(order, start, step, lambda s: s["out"])))


def filter_audit(cells: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """Per part, order of the filters and step (its filter is that letter of the order): ``kept`` after the step, ``removed`` by it, ``redundant``
    (fail the filter, removed earlier), ``unique_fails`` (fail no other filter), ``good_lost`` and ``toxic_lost`` (removed here with that label),
    ``shapley`` (what the filter removes, summed over all orders). Every part has all rows, zeros included; no cells, no rows.

    Cells of a part are at most 2^len(letters), so the list that is added up is bounded whatever the table."""
    names = ["".join(p) for p in permutations(letters)]
    orders = F.array(*(F.array(*(F.lit(_bit(letters, k)) for k in name)) for name in names))

    def add(a: Column, b: Column) -> Column:
        return F.zip_with(a, b, lambda x, y: F.struct(x["bit"].alias("bit"), *((x[k] + y[k]).alias(k) for k in COUNTS)))

    folded = cells.select("part", _fold(orders).alias("steps")).groupBy("part").agg(F.collect_list("steps").alias("all"))
    merged = folded.select("part", F.aggregate(F.slice("all", 2, 1 << len(letters)), F.col("all")[0], add).alias("steps"))
    def removed_by(bit: int) -> Column:
        none = F.lit(0).cast("long")
        return F.aggregate("steps", none, lambda total, x: total + F.when(x["bit"] == bit, x["removed"]).otherwise(none))

    share = F.create_map(*(c for k in letters for c in (F.lit(_bit(letters, k)), removed_by(_bit(letters, k)))))
    rows = merged.withColumn("share", share).select("part", "share", F.posexplode("steps").alias("at", "s"))
    size = len(letters)
    return rows.select("part", F.array(*map(F.lit, names))[(F.col("at") / size).cast("int")].alias("filter_order"), (F.col("at") % size + 1).cast("int").alias("step"),
                       *(F.col(f"s.{k}").alias(k) for k in COUNTS), F.col("share")[F.col("s.bit")].alias("shapley"))


def audit_documents(docs: DataFrame, labels: DataFrame, part_col: str = "lang") -> DataFrame:
    """The audit of the five filters A to E over whole texts, by ``part_col`` (null: empty string).

    A null text is empty (fails A only, and E if it isn't the first such); a null label is neither good nor toxic; of several label
    rows of a document one that says 1 is enough. Rows without an id come after all others; equal ones share a fate (among
    rows with the smallest id of a text none is a duplicate). An empty table gives an empty result; other columns are ignored."""
    return filter_audit(mask_cells(docs, labels, text_filters(F.col("__txt")), part=F.col(part_col)), "ABCDE")
