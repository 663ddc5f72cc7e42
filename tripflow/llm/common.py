"""Small pieces that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.sources.scratch import scratch_path

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

#: Most rows of a side that is broadcast; a side is counted before.
BROADCAST_ROWS = 500_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str | Column) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words_of(text: Column) -> Column:
    """All words of a text, in order."""
    return F.array_remove(F.split(text, SPACE), "")


def remainder(doc_id: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % divisor


def stored(rows: DataFrame, label: str) -> DataFrame:
    """``rows``, written to the shared folder once and read back.

    Cuts the lineage so that a lost executor costs one read, not the work before.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, label)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def if_small(rows: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``rows``, to be broadcast if they are counted to be at most ``most``.

    Beyond that the join shuffles both sides.
    """
    # A count and no limit: a limit would bring the rows of all partitions into one task.
    return F.broadcast(rows) if rows.count() <= most else rows


def free_name(rows: DataFrame, wanted: str) -> str:
    """``wanted``, or with underscores behind it if ``rows`` has such a column."""
    taken = {name.lower() for name in rows.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def sample_by_hash(rows: DataFrame, label: str, wanted: dict[int, int]) -> DataFrame:
    """About the ``wanted`` number of rows of each label, by a hash of doc_id.

    A count by label comes first, so nothing is sorted or gathered. Whether a row is
    in the sample depends on its id and the counts alone. The result is marked for
    broadcast: its size is bounded by the number of labels.
    """
    counts = {r[0]: r[1] for r in rows.groupBy(label).agg(F.count("*")).collect() if r[0] is not None}
    if not counts:
        return rows.limit(0)
    bounds = [
        F.lit(x)
        for value, n in counts.items()
        for x in (value, min(2**31, wanted.get(value, 0) * 2**31 // n + 1))
    ]
    place = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(2**31))
    return rows.where(F.col(label).isNotNull() & (place < F.create_map(*bounds)[F.col(label)]))


def labelled_sample_rows(
    docs: DataFrame, labels: DataFrame, label: str, wanted: dict[int, int], more: list[str]
) -> list[tuple]:
    """(text, label, more columns) of a bounded sample of labelled documents, in that order.

    A document with several labels counts with the largest; labels other than 0 and
    1, null ids and null texts are left out. Equal rows count once.
    """
    one = labels.where(F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).alias("y"))
    chosen = sample_by_hash(one, "y", wanted)
    found = docs.select("doc_id", "text", *more).join(F.broadcast(chosen), "doc_id")
    found = found.where(F.col("text").isNotNull()).select("text", F.col("y").cast("int"), *more)
    return sorted({tuple(r) for r in found.collect()}, key=repr)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, wanted: dict[int, int]
) -> list[tuple[str, int]]:
    return labelled_sample_rows(docs, labels, label, wanted, [])
