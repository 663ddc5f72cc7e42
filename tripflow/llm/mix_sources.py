"""Mixes sources to target weights (operator 5).

Every document gets a hash-random key. Within a source the keys are cut into
ranges; sums of the ranges, a prefix sum over those sums, and a prefix sum within
each range give every document its place among the words of its source without
ever sorting a source in one task. The source's budget is cut at that place, to
the word; a budget above the source's size repeats whole epochs first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripflow.llm.common import WORD, read_table, stored, text_of

#: 60 bits of an MD5 are the key of a document.
KEY_BITS = 60


def random_key(doc_id: Column, seed: str) -> Column:
    """A number below 2^60 that depends on the id and the seed only."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int], share: tuple[int, int], most: int) -> DataFrame:
    """Adds ``target`` to one row (source_key, source_size) per source.

    Sources in the order of their keys weigh ``weights`` in turn and split
    ``share`` (a fraction) of all sizes. No target passes ``most`` times its
    source's size; what is over goes to the others by weight. A source is at its
    limit exactly if it would be so after all sources that reach theirs sooner,
    so one pass in the order of limit per weight settles all of them.
    """
    num, den = share
    everything = Window.partitionBy()
    by_key = Window.orderBy("source_key")
    soonest = Window.orderBy(F.col("limit") / F.col("weight"), "source_key")
    place = (F.row_number().over(by_key) - 1) % len(weights) + 1
    sizes = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), place).cast("long"))
    sizes = sizes.withColumns(
        {
            "limit": F.col("source_size") * most,
            "budget": F.sum("source_size").over(everything) * num,
            "weights": F.sum("weight").over(everything),
        }
    )
    before = soonest.rowsBetween(Window.unboundedPreceding, -1)
    spent = F.coalesce(F.sum("limit").over(before), F.lit(0))
    left = F.col("weights") - F.coalesce(F.sum("weight").over(before), F.lit(0))
    sizes = sizes.withColumn(
        "full", F.col("limit") * left * den <= F.col("weight") * (F.col("budget") - spent * den)
    )
    full = F.sum(F.when(F.col("full"), F.col("limit")).otherwise(0)).over(everything)
    rest = F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(everything)
    sizes = sizes.withColumns({"spent": full, "open": rest})
    share_of_rest = (F.col("weight") * (F.col("budget") - F.col("spent") * den)).cast("double") / (
        F.col("open") * den
    ).cast("double")
    target = F.when(F.col("full"), F.col("limit").cast("double")).otherwise(share_of_rest)
    return sizes.select("source_key", "source_size", target.alias("target"))


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    share: tuple[int, int] = (3, 2),
    most: int = 2,
    seed: str = "mix",
    ranges: int = 1024,
) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for each row of ``docs``.

    ``docs`` needs doc_id, text and source; other columns are ignored. A size is the
    number of words, 0 for a null or empty text. ``taken`` counts the words the mix
    takes of a document, repeats included: at the place where a source's budget
    (its target, rounded down) ends, a document is taken in part. A null source is
    a source of its own, the last one. Rows that agree in id and size are
    interchangeable; each counts. Sizes of 0 give targets of 0; an empty table gives no rows.

    ``ranges`` (a power of two) is the number of key ranges a source is cut into:
    a task sorts one range, the prefix sum over a source meets ``ranges`` rows.
    """
    size = F.coalesce(F.regexp_count(text_of("text"), F.lit(WORD)).cast("long"), F.lit(0))
    # "s" before the name keeps names in code point order; "t" puts null behind them.
    source_key = F.when(F.col("source").isNull(), F.lit("t")).otherwise(
        F.concat(F.lit("s"), F.col("source").cast("string"))
    )
    sized = docs.select("doc_id", source_key.alias("source_key"), size.alias("size")).withColumn(
        "key", random_key(F.col("doc_id"), seed)
    )
    shift = KEY_BITS - (ranges.bit_length() - 1)
    # Texts are read once: range sums and row sums below both start from the sizes.
    sized = stored(sized.withColumn("range", F.shiftright("key", shift)), "mix-sizes")

    by_range = sized.groupBy("source_key", "range").agg(F.sum("size").alias("range_size"))
    sizes = by_range.groupBy("source_key").agg(F.sum("range_size").alias("source_size"))
    up_to = Window.partitionBy("source_key").orderBy("range")
    starts = by_range.select(
        "source_key",
        "range",
        (F.sum("range_size").over(up_to) - F.col("range_size")).alias("range_start"),
    ).join(targets(sizes, weights, share, most), "source_key")

    within = Window.partitionBy("source_key", "range").orderBy("key", "doc_id", "size")
    within = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = sized.withColumn("before", F.sum("size").over(within) - F.col("size")).join(
        starts, ["source_key", "range"]
    )
    budget = F.floor("target").cast("long")
    per_epoch = F.greatest(F.col("source_size"), F.lit(1))
    epochs = F.floor(budget / per_epoch).cast("long")
    last = budget - epochs * per_epoch - F.col("range_start") - F.col("before")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), last))
    return placed.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(read_table(spark, sf_dir, "documents"))


SQL = r"""
WITH sized AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN 't' ELSE 's' || source END AS source_key,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS key
  FROM documents),
placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source_key ORDER BY key, doc_id, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM sized),
sources AS (
  SELECT source_key, sum(size)::BIGINT AS source_size,
    [5, 2, 1][(row_number() OVER (ORDER BY source_key) - 1) % 3 + 1]::BIGINT AS weight
  FROM sized GROUP BY source_key),
limits AS (
  SELECT *, 2 * source_size AS lim, 3 * sum(source_size) OVER () AS budget,
    sum(weight) OVER (ORDER BY 2 * source_size / weight, source_key
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS still_open,
    coalesce(sum(2 * source_size) OVER (ORDER BY 2 * source_size / weight, source_key
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent_before
  FROM sources),
settled AS (
  SELECT *, lim * still_open * 2 <= weight * (budget - 2 * spent_before) AS is_full FROM limits),
targets AS (
  SELECT source_key, source_size, CASE WHEN is_full THEN lim::DOUBLE ELSE
    (weight * (budget - 2 * sum(CASE WHEN is_full THEN lim ELSE 0 END) OVER ()))::DOUBLE
    / (2 * sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ())::DOUBLE END AS target
  FROM settled)
SELECT doc_id, size, source_size, target,
  ((floor(target)::BIGINT // greatest(source_size, 1)) * size + greatest(0, least(size,
    floor(target)::BIGINT % greatest(source_size, 1) - before)))::BIGINT AS taken
FROM placed JOIN targets USING (source_key)
"""
