"""Document fingerprints as threshold-scaled sketches (operator 12).

Every shingle hash below a fixed fraction of the hash space is kept. Which hashes a
text keeps depends on its shingles alone, so sketches of parts merge by union, and
the share of a small sketch found in a large one estimates how much of the small text
the large one contains, however unequal their sizes are.

A fingerprint is the kept hashes, ascending and comma-joined. A text that keeps none
has one mark that only texts of the same words have, so that it is like those and no
others; a text without words has the empty fingerprint.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripflow.llm.common import free_name, read_table, text_of, words_of

#: Share of the hash space that is kept.
FRACTION = 0.25
#: Hexadecimal digits of a kept hash.
DIGITS = 12
#: Documents of one run of ids: what a task sorts at a time.
RUN_ROWS = 4_000
#: Most runs a table is cut into; the ids that bound them go to the driver.
MOST_RUNS = 65_536
#: Ids looked at for each bound.
SAMPLED = 16

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, also below functions over arrays."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def fingerprint(text: Column, n: int = 5, fraction: float = FRACTION) -> Column:
    """The sketch of a text's shingles of ``n`` words, A-Z in lower case.

    A text of fewer words is one shingle. Null counts as the empty text. Equal shingles
    of a text count once.
    """
    cut = F.lit(f"{min(2**32, math.ceil(fraction * 2**32)):08x}" if fraction < 1 else "g")

    def sketch(words: Column) -> Column:
        def hashed(i: Column) -> Column:
            # Places behind the last word are null, which concat_ws leaves out.
            return F.md5(F.concat_ws(" ", *[F.get(words, i + k) for k in range(n)]))

        places = F.sequence(F.lit(0), F.greatest(F.size(words) - n, F.lit(0)))
        # Places first, then the hashes of the places kept: no hash of the others is held.
        kept = F.transform(F.filter(places, lambda i: hashed(i) < cut), lambda i: F.substring(hashed(i), 1, DIGITS))
        alone = F.concat(F.lit("~"), F.substring(F.md5(F.array_join(words, " ")), 1, DIGITS))
        joined = F.array_join(F.array_sort(F.array_distinct(kept)), ",")
        marked = bound(joined, lambda found: F.when(found == "", alone).otherwise(found))
        return F.when(F.size(words) == 0, F.lit("")).otherwise(marked)

    return bound(words_of(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)), sketch)


def containment(part: Column, whole: Column) -> Column:
    """Estimated share of the first text's shingles that the second one has; 0 to 1."""
    part, whole = F.split(part, ","), F.split(whole, ",")
    return F.size(F.array_intersect(part, whole)).cast("double") / F.size(part)


def likeness(a: Column, b: Column) -> Column:
    """How much of the smaller sketch the other one contains: 1 for equal, 0 for unrelated."""
    a, b = F.split(a, ","), F.split(b, ",")
    return F.size(F.array_intersect(a, b)).cast("double") / F.least(F.size(a), F.size(b))


def merged(*prints: Column) -> Column:
    """The sketch of several texts' shingles together, from their fingerprints.

    Marks of texts that keep no hash say nothing about shingles and are left out, unless
    there is nothing else; then the first one stands.
    """
    parts = F.array_distinct(F.flatten(F.array(*[F.split(p, ",") for p in prints])))
    hashes = F.filter(parts, lambda h: (h != "") & ~h.startswith("~"))
    marks = F.filter(parts, lambda h: h != "")
    return F.when(F.size(hashes) > 0, F.array_join(F.array_sort(hashes), ",")).otherwise(
        F.coalesce(F.get(marks, F.lit(0)), F.lit(""))
    )


def _run_starts(ids: DataFrame, doc_id: str, run_rows: int) -> tuple[list[int], int | None, bool]:
    """Ids that begin a run of about ``run_rows``, the first id of all, and whether one is null."""
    rows, known, first = ids.agg(F.count("*"), F.count(doc_id), F.min(doc_id)).first()
    runs = min(MOST_RUNS, -(-rows // run_rows))
    if runs < 2:
        return [], first, known < rows
    space = 2**31
    place = F.pmod(F.xxhash64(F.lit("runs"), doc_id), F.lit(space))
    chosen = ids.where(F.col(doc_id).isNotNull() & (place < min(space, SAMPLED * runs * space // rows + 1)))
    found = sorted({r[0] for r in chosen.distinct().collect()})
    starts = sorted({found[len(found) * k // runs] for k in range(1, runs)} - {first}) if found else []
    return starts, first, known < rows


def with_next(
    docs: DataFrame, columns: list[str], doc_id: str = "doc_id", text: str = "text", run_rows: int = RUN_ROWS
) -> DataFrame:
    """Adds ``next_<column>``: the columns of the document that follows by id, the first behind the last.

    Null ids come first; rows of one id follow by text, null first. Documents go to the task of
    their run of ids, once; the one that begins a run also goes to the run before, so
    no task meets more than its run and no window spans the table. Rows of one id are
    in one run.
    """
    starts, first, has_null = _run_starts(docs.select(doc_id), doc_id, run_rows)
    names = {name: free_name(docs, name) for name in ("run", "copy")}
    key = F.col(doc_id)
    begins = F.split(F.lit(",".join(map(str, starts))), ",").cast("array<bigint>")
    steps = [2**k for k in range(len(starts).bit_length() - 1, -1, -1)] if starts else []

    def step(at: Column, by: Column) -> Column:
        fits = (at + by <= len(starts)) & (F.get(begins, at + by - 1) <= key)
        return F.when(fits, at + by).otherwise(at)

    run = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step) if steps else F.lit(0)
    run = F.when(key.isNull(), 0).otherwise(run)
    is_first = key.isNull() if has_null else key == F.lit(first)

    def places(at: Column) -> Column:
        begins_run = (at > 0) & (F.get(begins, at - 1) == key) if starts else F.lit(False)
        place = lambda run, copy: F.struct(run.cast("int").alias("run"), F.lit(copy).alias("copy"))
        return F.filter(
            F.array(
                place(at, 0),
                F.when(begins_run, place(at - 1, 1)),
                F.when(is_first, place(F.lit(len(starts)), 2)),
            ),
            lambda p: p.isNotNull(),
        )

    place = free_name(docs, "place")
    dealt = docs.withColumn(place, F.explode(bound(run, places)))
    dealt = dealt.withColumns({names[k]: F.col(f"{place}.{k}") for k in names}).drop(place)
    order = [F.col(names["copy"]) == 2, key.asc_nulls_first(), F.col(text), F.col(names["copy"])]
    following = Window.partitionBy(names["run"]).orderBy(*order)
    dealt = dealt.withColumns({f"next_{c}": F.lead(c).over(following) for c in columns})
    return dealt.where(F.col(names["copy"]) == 0).drop(*names.values())


def edited(text: Column, following: Column) -> Column:
    """The text with the latter half of its code points replaced by as many of the following text, or all."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def fingerprints(docs: DataFrame, n: int = 5, fraction: float = FRACTION, run_rows: int = RUN_ROWS) -> DataFrame:
    """One row per row of ``docs``: its fingerprint, its edited text's, and how like they are.

    ``docs`` needs doc_id and text; other columns are ignored. Null text counts as the
    empty text. Documents follow each other by doc_id, null first; those of one id by
    text, so equal rows are interchangeable. Behind the last comes the first, which for
    a table of one row is the document itself. Equal fingerprints have likeness 1, those
    of two texts without words too. An empty table gives no rows.
    """
    texts = docs.select("doc_id", text_of("text").alias("text"))
    printed = texts.withColumn("fingerprint", fingerprint(F.col("text"), n, fraction))
    pairs = with_next(printed, ["text", "fingerprint"], run_rows=run_rows)
    pairs = pairs.withColumn("edited", edited(F.col("text"), F.col("next_text")))
    pairs = pairs.withColumn("edited_fingerprint", fingerprint(F.col("edited"), n, fraction))
    own = F.col("fingerprint")
    return pairs.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(own, F.col("edited_fingerprint")).alias("near_edited"),
        likeness(own, F.col("next_fingerprint")).alias("near_next"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(read_table(spark, sf_dir, "documents"))


_SKETCH_SQL = r"""
  SELECT i, which, CASE WHEN len(words) = 0 THEN '' WHEN len(kept) = 0
    THEN '~' || substr(md5(array_to_string(words, ' ')), 1, 12) ELSE array_to_string(kept, ',') END AS print
  FROM (SELECT *, list_sort(list_distinct(list_transform(list_filter(list_transform(
      range(1, greatest(len(words) - 4, 1) + 1),
      lambda k: md5(array_to_string(words[k:k + 4], ' '))),
      lambda h: h < '40000000'), lambda h: substr(h, 1, 12)))) AS kept
    FROM (SELECT i, which, regexp_extract_all(translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM bodies))"""

SQL = rf"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, row_number() OVER
    (ORDER BY doc_id NULLS FIRST, coalesce(text, '')) AS i, count(*) OVER () AS n FROM documents),
pairs AS (
  SELECT a.*, b.i AS j, length(a.text) AS n_chars, b.text AS next_text
  FROM texts a JOIN texts b ON b.i = a.i % a.n + 1),
cut AS (
  SELECT *, substr(text, 1, n_chars - n_chars // 2) ||
    CASE WHEN n_chars < 2 THEN '' ELSE substr(next_text, 1, n_chars // 2) END AS edited FROM pairs),
bodies AS (
  SELECT i, 'own' AS which, text AS body FROM cut UNION ALL SELECT i, 'edited', edited FROM cut),
prints AS ({_SKETCH_SQL}),
lined AS (
  SELECT c.doc_id, c.n_chars, sha256(c.edited) AS edited_sha256, o.print AS fingerprint,
    e.print AS edited_fingerprint, string_split(o.print, ',') AS a, string_split(e.print, ',') AS b,
    string_split(x.print, ',') AS c
  FROM cut c JOIN prints o ON o.i = c.i AND o.which = 'own'
  JOIN prints e ON e.i = c.i AND e.which = 'edited' JOIN prints x ON x.i = c.j AND x.which = 'own')
SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
  len(list_intersect(a, b)) / least(len(a), len(b)) AS near_edited,
  len(list_intersect(a, c)) / least(len(a), len(c)) AS near_next
FROM lined
"""
