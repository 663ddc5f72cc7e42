"""Benchmark passages in documents (operator 4).

A window of a document, as long as an item, is compared with the item by the weighted
Jaccard similarity of their word shingles (each weighs as often as it occurs). Only
windows that share a shingle with an item can pass, so fingerprints are taken around
such places only: the window that puts the shared shingle where the item has it,
and its neighbours, moved into the document where they stick out of it. SimHash fingerprints of these windows are looked up among the
items' by a multi-index: of two fingerprints within ``radius`` bits, at least one of ``count``
blocks differs in no more than radius / count bits (pigeonhole). Each item is listed under all
blocks so near to its own, so equal blocks miss none of them. With the defaults a block has 12 or 13
bits, and one of 18 pairs of unlike fingerprints meets. Each pair found is verified exactly.

Words are the unit of fingerprints: one edited word moves one of forty words, but
five of forty shingles, so near copies stay well within the radius.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.common import SPACE, if_small, read_table, stored, text_of

BITS = 64


def lower_words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), SPACE), "")


def shingles(words: str, n: int) -> Column:
    """64-bit hashes of the n-word shingles in order; one of all words if there are fewer."""
    parts = ", ".join(f"get({words}, i + {k})" for k in range(n))
    return F.expr(f"""
        CASE WHEN size({words}) = 0 THEN cast(array() AS array<bigint>) ELSE
        transform(sequence(0, greatest(size({words}) - {n}, 0)), i -> xxhash64({parts})) END""")


def simhash(words: str) -> Column:
    """A bit is set if most of the words' hashes have it set."""
    hashes = f"transform({words}, w -> xxhash64(w))"
    return F.expr(f"""
        aggregate(transform(array({hashes}), h -> aggregate(sequence(0, {BITS - 1}), 0L, (a, b) ->
          CASE WHEN aggregate(h, 0, (s, x) -> s + cast(shiftrightunsigned(x, b) & 1L AS int)) * 2 > size(h)
          THEN a | shiftleft(1L, b) ELSE a END)), 0L, (a, x) -> x)""")


def edges(count: int) -> list[tuple[int, int]]:
    """(number of the first bit, width) of each of ``count`` blocks."""
    ends = [BITS * k // count for k in range(count + 1)]
    return [(a, b - a) for a, b in zip(ends, ends[1:])]


def blocks(fingerprint: str, count: int) -> Column:
    """(number, bits) of the fingerprint's ``count`` blocks."""
    return F.array(
        *[
            F.struct(
                F.lit(k).alias("number"),
                F.expr(f"shiftrightunsigned({fingerprint}, {at}) & {2**width - 1}L").alias("bits"),
            )
            for k, (at, width) in enumerate(edges(count))
        ]
    )


def near_blocks(fingerprint: str, count: int, radius: int) -> Column:
    """(number, bits) of all blocks that differ from the fingerprint's in radius / count bits or fewer."""

    def flips(width: int) -> list[int]:
        chosen = (c for most in range(radius // count + 1) for c in combinations(range(width), most))
        return [sum(1 << bit for bit in c) for c in chosen]

    rows = [
        F.expr(
            f"transform(array({', '.join(f'{x}L' for x in flips(width))}), "
            f"x -> named_struct('number', {k}, 'bits', (shiftrightunsigned({fingerprint}, {at}) & {2**width - 1}L) ^ x))"
        )
        for k, (at, width) in enumerate(edges(count))
    ]
    return F.concat(*rows)


def similarity(a: str, b: str) -> Column:
    """Weighted Jaccard of two arrays of shingles: sum of lesser over sum of greater counts."""
    shared = f"""aggregate(array_intersect({a}, {b}), 0, (s, g) ->
        s + least(size(filter({a}, x -> x = g)), size(filter({b}, x -> x = g))))"""
    return F.expr(f"""
        aggregate(array({shared}), 0D, (z, s) -> s / (size({a}) + size({b}) - s))""")


def items_of(benchmark: DataFrame, n: int) -> DataFrame:
    """(item_id, size, item_shingles, fingerprint) of the items that have words."""
    rows = benchmark.select("item_id", lower_words(text_of("text")).alias("words")).where(F.size("words") > 0)
    rows = rows.select("item_id", "words", F.size("words").alias("size"), shingles("words", n).alias("item_shingles"))
    return rows.select("item_id", "size", "item_shingles", simhash("words").alias("fingerprint"))


def windows_of(docs: DataFrame, items: DataFrame, n: int, shift: int) -> DataFrame:
    """(doc_id, windows): places (start, size) around the shingles shared with an item.

    The explode carries ids and hashes only. Shared shingles are few, so what is grouped
    by document is small.
    """
    known = items.select("size", F.posexplode("item_shingles").alias("item_at", "shingle"))
    # One row per shingle, however many items have it.
    known = known.groupBy("shingle").agg(F.collect_set(F.struct("item_at", "size")).alias("as_in"))
    places = docs.select("doc_id", lower_words(text_of("text")).alias("words"))
    places = places.withColumn("n_words", F.size("words"))
    # Items of fewer words than a shingle are looked for as shingles of their own length.
    shorter = [r[0] for r in items.where(F.col("size") < n).select("size").distinct().collect()]
    found = None
    for width in [n, *sorted(shorter)]:
        rows = places.select("doc_id", "n_words", shingles("words", width).alias("shingles"))
        # "outer": else a filter on the array would be moved below it and compute it again.
        rows = rows.select("doc_id", "n_words", F.posexplode_outer("shingles").alias("at", "shingle"))
        found = rows if found is None else found.union(rows)
    places = found
    met = places.join(if_small(known), "shingle").select("doc_id", "n_words", "at", F.explode("as_in").alias("as_in"))
    # The last start at which the document has a window of that size.
    met = met.withColumn("last", F.col("n_words") - F.col("as_in.size")).where(F.col("last") >= 0)
    met = met.select("doc_id", "last", (F.col("at") - F.col("as_in.item_at")).alias("at"), "as_in.size").distinct()
    around = F.explode(F.sequence(F.col("at") - shift, F.col("at") + shift)).alias("start")
    met = met.select("doc_id", "last", around, "size")
    # An item cut by the document's edge: the window at the edge has all that is left of it.
    met = met.withColumn("start", F.greatest(F.lit(0), F.least("start", "last")))
    return met.groupBy("doc_id").agg(F.collect_set(F.struct("start", "size")).alias("windows"))


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = 5,
    least: float = 0.8,
    radius: int = 14,
    shift: int = 1,
    count: int = 5,
) -> DataFrame:
    """(doc_id, item_id, similarity, start, size): the items that documents contain.

    One row per document and item: the best window (of equals, the first that was tried),
    by its first word (counted from 0) and its length in words. A similarity of ``least`` or more
    counts. Words are compared in lower case. Documents and items that are null, empty or
    without an id give no rows; rows with one doc_id are one document, repeated
    items one item. ``shift``: places before and behind an aligned window that are tried too.
    ``radius``: most bits in which the fingerprints of a window and an item may differ, looked
    up by ``count`` blocks.
    """
    items = items_of(benchmark, n).where(F.col("item_id").isNotNull()).dropDuplicates()
    items = stored(items, "items")
    docs = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull())
    windows = stored(windows_of(docs, items, n, shift), "windows")
    rows = docs.join(if_small(windows), "doc_id").select(
        "doc_id", lower_words(text_of("text")).alias("words"), "windows"
    )
    rows = rows.select("doc_id", "words", F.explode("windows").alias("window"))
    rows = rows.select("doc_id", "window.*", F.expr("slice(words, window.start + 1, window.size)").alias("words"))
    rows = rows.where(F.size("words") == F.col("size")).dropDuplicates(["doc_id", "start", "size", "words"])
    rows = rows.select("doc_id", "start", "size", shingles("words", n).alias("shingles"), simhash("words").alias("mine"))
    rows = stored(rows, "fingerprints")

    # Windows and items of one length meet by their blocks.
    theirs = items.select("item_id", "size", "fingerprint", F.explode(near_blocks("fingerprint", count, radius)).alias("block"))
    mine = rows.select("doc_id", "start", "size", "mine", F.explode(blocks("mine", count)).alias("block"))
    near = mine.join(if_small(theirs), ["size", "block"]).where(
        F.bit_count(F.col("mine").bitwiseXOR(F.col("fingerprint"))) <= radius
    )
    near = near.select("doc_id", "start", "size", "mine", "item_id").distinct()
    pairs = near.join(rows, ["doc_id", "start", "size", "mine"]).join(
        if_small(items.select("item_id", "size", "item_shingles")), ["item_id", "size"]
    )
    found = pairs.select("doc_id", "item_id", "start", "size", similarity("shingles", "item_shingles").alias("similarity"))
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"), "size")).alias("best")
    found = found.where(F.col("similarity") >= least).groupBy("doc_id", "item_id").agg(best)
    return found.select(
        "doc_id", "item_id", "best.similarity", (-F.col("best.back")).alias("start"), "best.size"
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, **settings: float) -> DataFrame:
    """The rows of ``docs`` whose document contains no item, all columns as they were."""
    ids = stored(leaks(docs, benchmark, **settings).select("doc_id").distinct(), "leaks")
    return docs.join(if_small(ids), "doc_id", "left_anti").select(*[f"`{c}`" for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
