"""Benchmark decontamination by winnowing.

A document is contaminated where it holds a window of a benchmark item: `WINDOW` words in a row,
or the whole item if that has fewer. Of every window in a document or an item only the smallest of
its k-gram hashes is kept (the leftmost, if several are equal). A window that a document shares
with an item therefore leaves the same hash at the same place of the window on both sides, so a
join of these fingerprints misses no shared span of a window or more, at about a quarter of the
rows that all k-grams would make. A hit is then extended to all windows around it, which are
compared with the items' windows as texts: no hash decides on a result.

DataFrame functions only. Documents are read once and only hits, and one short row per document,
are shuffled while the items' windows are small enough to be broadcast; their size is measured. Beyond
`BROADCAST_BYTES` the fingerprints themselves are shuffled and the texts meet their hits by row.
No step makes pairs of documents and items that share a fingerprint: fingerprints meet in a
semi-join, windows in a join of different texts, so that what is frequent on both sides stays one
row per place. Only windows that really are shared are looked up in the list of their items.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from astrolode.llm.common import lower_ascii, with_row, written

WINDOW = 10
GRAM = 4
BROADCAST_BYTES = 64 << 20
ROW_BYTES = 64

# Outside these ranges, after lower-casing A-Z, are the characters of words.
_BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# What lower() may change beside A-Z, or may change in a later release of Unicode.
_OTHER_CAPITALS = r"[\p{Lu}\p{Lt}\p{Nl}\p{So}\p{Cn}&&[^\x00-\x7F]]"
# The low bits of a number that orders k-grams hold their place: more than any text has words.
_PLACE = (1 << 28) - 1


def words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; none of a null text."""
    text = F.coalesce(text, F.lit(""))
    # lower() is much faster than a translation, and the same where A-Z are the only capitals.
    lowered = F.when(text.rlike(_OTHER_CAPITALS), lower_ascii(text)).otherwise(F.lower(text))
    return F.array_remove(F.split(lowered, _BETWEEN_WORDS), "")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often `body` names it."""
    return F.transform(F.array(value), body)[0]


def _folded(values: Column, size: int, two: Callable[[Column, Column], Column]) -> Column:
    """At each place what `two` makes of so many neighbours, by doubling; parts may overlap.

    The last places, which have fewer neighbours, are of no use.
    """
    def with_those(step: int) -> Callable[[Column], Column]:
        return lambda v: F.zip_with(v, F.slice(v, step + 1, F.size(v)), lambda a, b: two(a, b))

    reach = 1
    while reach < size:
        step = min(reach, size - reach)
        values = _let(values, with_those(step))
        reach += step
    return values


def winnowed(tokens: Column, window: int) -> Column:
    """Struct of `grams`, the hash at each place, and `kept`, for each window of so many words a
    number that tells windows apart by the place of the hash they keep and holds that place."""
    gram = min(GRAM, window)
    count = F.greatest(F.size(tokens) - (window - 1), F.lit(0))

    def struct(grams: Column) -> Column:
        placed = F.transform(grams, lambda h, i: h.bitwiseAND(~_PLACE).bitwiseOR(i.cast("long")))
        least = _folded(placed, window - gram + 1, F.least)
        return F.struct(grams.alias("grams"), F.slice(least, F.lit(1), count).alias("kept"))

    hashes = F.transform(tokens, lambda w: F.xxhash64(w))
    return _let(_folded(hashes, gram, F.xxhash64), struct)


def fingerprints(rows: DataFrame, window: int) -> DataFrame:
    """`rows` (with `tokens`), for each kept hash: `gram`, `first` (the first window that keeps it),
    `last` (the last that can hold it) and `index`, which is 0 or null in one row of each of `rows`.
    """
    names = rows.columns
    made = rows.withColumn("winnowed", winnowed(F.col("tokens"), window)).select(
        *names, F.col("winnowed.grams").alias("grams"), F.col("winnowed.kept").alias("kept"))
    each = made.select(*names, "grams", "kept", F.posexplode_outer("kept").alias("index", "number"))
    place = F.col("number").bitwiseAND(_PLACE).cast("int")
    new = F.col("index").isNull() | (F.col("index") == 0) | (
        F.col("number") != F.get("kept", F.col("index") - 1))
    return each.filter(new).select(
        *names, "index", F.get("grams", place).alias("gram"), F.col("index").alias("first"),
        F.least(place, F.size("kept") - 1).alias("last"))


def _window_text(start: Column, size: Column) -> Column:
    # Words hold no spaces, so different windows have different texts.
    return F.array_join(F.slice("tokens", start + 1, size), " ")


class Benchmark:
    """Each different window of the items, in a written table with the items that hold it."""

    def __init__(self, items: DataFrame, broadcast_bytes: int = BROADCAST_BYTES):
        tokens = items.select("item_id", words(F.col("text")).alias("tokens")).filter(
            F.size("tokens") > 0).withColumn("size", F.least(F.size("tokens"), F.lit(WINDOW)))
        starts = F.sequence(F.lit(0), F.size("tokens") - F.col("size"))
        self.held = written(tokens.withColumn("start", F.explode(starts)).select(
            "size", _window_text(F.col("start"), F.col("size")).alias("window"), "item_id"
        ).distinct(), "benchmark-windows")
        # One row per length of windows comes back, WINDOW at most.
        measured = self.held.groupBy("size").agg(F.sum(F.length("window") + ROW_BYTES).alias("bytes"))
        found = {r["size"]: r["bytes"] for r in measured.collect()}
        self.sizes = sorted(found, reverse=True) or [WINDOW]
        self.small = sum(found.values()) <= broadcast_bytes

    def windows(self, size: int) -> DataFrame:
        return self.held.filter(F.col("size") == size).select("window").distinct()

    def grams(self, size: int) -> DataFrame:
        """The different hashes that the windows of a size keep."""
        rows = self.windows(size).select(F.split("window", " ").alias("tokens"))
        return fingerprints(rows, size).select("gram").dropna().distinct()


def shared_windows(rows: DataFrame, benchmark: Benchmark, size: int) -> DataFrame:
    """The windows of so many words (`start`, `window`) that each of `rows` shares with an item.

    `rows` have `_row` and `tokens`. Each of them stays at least once, with nulls where it shares
    nothing. A window may be found several times.
    """
    names = [c for c in rows.columns if c != "tokens"]
    known = benchmark.grams(size).withColumn("known", F.lit(True))
    shared = benchmark.windows(size).withColumn("shared", F.lit(True))
    prints = fingerprints(rows, size)
    kept = F.lit(False)
    if benchmark.small:  # the texts stay where they are
        met, shared = prints.join(F.broadcast(known), "gram", "left"), F.broadcast(shared)
        kept = F.coalesce("index", F.lit(0)) == 0
        met = met.filter(kept | F.col("known"))
    else:  # only fingerprints are shuffled, and the texts meet those that are known
        light = written(prints.select("_row", "index", "gram", "first", "last").join(
            known, "gram"), "known-grams")
        met = rows.join(light.drop("gram"), "_row")
    starts = F.when(F.col("known"), F.sequence("first", "last"))
    near = met.select(*names, "index", "tokens", F.explode_outer(starts).alias("start"))
    texts = near.select(
        *names, "index", "start", _window_text(F.col("start"), F.lit(size)).alias("window"))
    found = texts.join(shared, "window", "left").filter(kept | F.col("shared")).select(
        *names, *(F.when(F.col("shared"), F.col(c)).alias(c) for c in ("start", "window")))
    if benchmark.small:
        return found
    none = [F.lit(None).cast(found.schema[c].dataType).alias(c) for c in ("start", "window")]
    return found.unionByName(rows.select(*names, *none))


def _spans(found: DataFrame) -> DataFrame:
    """`_row` and `spans`, the stretches of words that its windows cover together."""
    ordered = Window.partitionBy("_row").orderBy("start")
    windows = found.dropna(subset=["start"]).groupBy("_row", "start").agg(F.max("size").alias("size"))
    ends = windows.withColumn("end", F.col("start") + F.col("size"))
    reached = F.max("end").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    opened = ends.withColumn("opens", (F.col("start") > F.coalesce(reached, F.lit(-1))).cast("int"))
    numbered = opened.withColumn("span", F.sum("opens").over(
        ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    whole = numbered.groupBy("_row", "span").agg(
        F.min("start").cast("long").alias("start"), F.max("end").cast("long").alias("end"))
    return whole.groupBy("_row").agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))


def _items(found: DataFrame, benchmark: Benchmark) -> DataFrame:
    """`_row` and `items`, the ids of the items whose windows it holds."""
    windows = found.dropna(subset=["start"]).select("_row", "window").distinct()
    pairs = windows.join(benchmark.held.select("window", "item_id"), "window").select(
        "_row", F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item")).distinct()
    return pairs.groupBy("_row").agg(F.array_sort(F.collect_list("item")).alias("items"))


def find(docs: DataFrame, items: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """`doc_id`, `n_words`, `spans` and `items` of each document.

    `spans` are the stretches of words, [start, end) from 0, that windows of items cover; `items`
    the ids of these items as strings, in their order. A null text has no words, and neither
    documents nor items without words share anything. Repeated rows of documents have a result
    each. Rows of items that repeat an id count as one item, and so do those without an id, whose
    name is the empty string. Empty tables give an empty result, or documents without spans;
    extra columns are left out.
    """
    benchmark = Benchmark(items, broadcast_bytes)
    rows = with_row(docs.select("doc_id", words(F.col("text")).alias("tokens"))).withColumn(
        "n_words", F.size("tokens").cast("long"))
    if not benchmark.small or len(benchmark.sizes) > 1:  # read more than once
        rows = written(rows, "document-words")
    found = written(reduce(DataFrame.unionByName, (
        shared_windows(rows, benchmark, size).withColumn("size", F.lit(size))
        for size in benchmark.sizes)), "shared-windows")
    every = found.select("_row", "doc_id", "n_words").distinct()
    return (
        every.join(_spans(found), "_row", "left").join(_items(found, benchmark), "_row", "left")
        .select("doc_id", "n_words", *(
            F.coalesce(c, F.array().cast(t)).alias(c)
            for c, t in (("spans", "array<struct<start:bigint,end:bigint>>"),
                         ("items", "array<string>"))))
    )
