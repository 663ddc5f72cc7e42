"""Quality rules with risk-controlled cutoffs (operator 6).

A rule rejects a document whose feature is above a cutoff. Labelled documents
decide how low a cutoff may go: in each stratum (language) a cutoff is certified if
an exact binomial test rejects "it turns away more than its share of good
documents". The cutoffs of a rule are tested in a fixed order from the loosest
down to the first that fails, so within a rule no correction is needed; over rules
and strata the error rate is split (Bonferroni). With probability 1 - ``error``
no stratum loses more than ``risk`` of its good documents to all rules together.
Any choice among certified cutoffs keeps that promise. The one taken turns away most
labelled poor documents, where a good one turned away costs ``cost`` poor ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripflow.llm.common import free_name, if_small, read_table, stored, text_of, words_of

SYMBOL = r"[#*$%&|<>]"

#: Rules: scale, what is counted, per what. Larger is worse.
RULES = {
    "symbols": (1000, "n_symbols", "n_words"),
    "shouts": (1000, "n_shouts", "n_words"),
    "repeat_words": (1000, "n_repeat_words", "n_words"),
    "dup_lines": (1000, "n_dup_lines", "n_lines"),
    "word_length": (100, "word_chars", "n_words"),
}

#: Cutoffs that are tested, loosest first; fixed before any label is seen.
CUTOFFS = (2500, 2000, 1500, 1200, 1000, 900, 800, 700, 600, 500, 400, 300, 250, 200, 150, 100, 75, 50, 25)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def feature(rule: str, prefix: str = "") -> Column:
    scale, part, whole = RULES[rule]
    return F.expr(f"{scale} * {prefix}{part} div greatest({prefix}{whole}, 1)")


#: Up to so many different repeated windows, each window is looked up in their list.
LOOKED_UP = 256


def windows(words: str) -> Column:
    """A 64-bit hash of each 3-word window, in order."""
    return F.expr(f"""
        CASE WHEN size({words}) < 3 THEN cast(array() AS array<bigint>) ELSE
        transform(sequence(0, size({words}) - 3),
          i -> xxhash64({words}[i], {words}[i + 1], {words}[i + 2])) END""")


def repeated(hashes: str) -> Column:
    """The hashes that occur twice or more, each once."""
    return F.expr(f"""
        CASE WHEN size(array_distinct({hashes})) = size({hashes})
        THEN cast(array() AS array<bigint>) ELSE
        aggregate(array(sort_array({hashes})), cast(array() AS array<bigint>), (a, s) ->
          array_distinct(filter(s, (x, k) -> x <=> get(s, k + 1)))) END""")


def repeat_words(hashes: str, twice: str) -> Column:
    """Words within a 3-word window that the text has twice or more.

    Each start of such a window adds the words up to the next start, three at most.
    Where a text has many such windows, their starts are found by sorting all windows
    instead: time stays near the length of the text.
    """
    looked_up = f"filter(sequence(0, size({hashes}) - 1), i -> array_contains({twice}, {hashes}[i]))"
    in_order = f"""sort_array(aggregate(
          array(sort_array(transform({hashes}, (h, i) -> struct(h AS h, i AS i)))),
          cast(array() AS array<int>), (a, s) ->
          transform(filter(s, (x, k) -> get(s, k - 1).h <=> x.h OR get(s, k + 1).h <=> x.h), x -> x.i)))"""
    return F.expr(f"""
        CASE WHEN size({twice}) = 0 THEN 0L ELSE
        aggregate(
          CASE WHEN size({twice}) <= {LOOKED_UP} THEN {looked_up} ELSE {in_order} END,
          struct(0L AS n, -3 AS last),
          (a, i) -> struct(a.n + least(3, i - a.last) AS n, i AS last),
          a -> a.n)
        END""")


def measured(docs: DataFrame, into: str) -> DataFrame:
    """``docs`` with one more column ``into``: a struct of all counts and ``base_failed``."""
    names = {n: free_name(docs, f"_{into}_{n}") for n in ("text", "words", "lines", "hashes", "twice", "counts")}
    text, words, lines, hashes, twice, counts = names.values()
    rows = docs.withColumn(text, text_of("text"))
    rows = rows.withColumn(words, words_of(F.col(text)))
    rows = rows.withColumn(
        lines, F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    )
    rows = rows.withColumn(hashes, windows(words))
    rows = rows.withColumn(twice, repeated(hashes))
    # explode() of one struct, so that no filter on the counts is moved below them,
    # where each mention of a count would count again.
    one = F.explode(
        F.array(
        F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit(SYMBOL)).cast("long").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            repeat_words(hashes, twice).alias("n_repeat_words"),
            F.size(lines).cast("long").alias("n_lines"),
            F.regexp_count(text, F.lit("!")).cast("long").alias("n_shouts"),
        ))
    )
    rows = rows.select("*", one.alias(counts))
    failed = (F.col(f"{counts}.n_words") < 50) | (
        100 * F.col(f"{counts}.n_repeat_words") > 50 * F.col(f"{counts}.n_words")
    )
    rows = rows.withColumn(into, F.struct(f"{counts}.*", failed.alias("base_failed")))
    return rows.drop(*names.values())


def most_failures(n: str, risk: str, error: str) -> Column:
    """Most good documents of ``n`` that a cutoff may turn away; -1 if not even none.

    The largest k with P(Binomial(n, risk) <= k) <= error. Log probabilities are
    summed from twelve deviations below the mean, where less than e^-60 lies.
    """
    gamma = "(({0} + 0.5D) * ln({0}) - {0} + 0.9189385332046727D + 1 / (12D * {0}) - 1 / (360D * pow({0}, 3)))"
    first = f"(CASE WHEN {n} * {risk} < 250 THEN 0L ELSE floor({n} * {risk} - 12 * sqrt({n} * {risk})) END)"
    start = f"""(CASE WHEN {n} * {risk} < 250 THEN {n} * ln(1 - {risk}) ELSE
        {gamma.format(f'({n})')} - {gamma.format(f'({first})')} - {gamma.format(f'({n} - {first})')}
        + {first} * ln({risk}) + ({n} - {first}) * ln(1 - {risk}) END)"""
    return F.expr(f"""
        CASE WHEN {n} <= 0 THEN -1L ELSE
        aggregate(sequence({first}, cast(ceil({n} * {risk}) AS BIGINT)),
          struct({start} AS p, 0D AS below, -1L AS k),
          (a, i) -> struct(
            a.p + ln(({n} - i) * {risk} / ((i + 1) * (1 - {risk}))) AS p,
            a.below + exp(a.p) AS below,
            CASE WHEN a.below + exp(a.p) <= {error} THEN i ELSE a.k END AS k),
          a -> a.k)
        END""")


def cutoffs(labelled: DataFrame, risk: float, error: float, cost: float) -> DataFrame:
    """(stratum, one cutoff per rule or null) from rows (stratum, quality, counts.*).

    Rows that a base rule fails are left out: they go in any case. One row per stratum
    and rule and cutoff is all that is shuffled.
    """
    usable = labelled.where(~F.col("base_failed") & F.col("quality").isin(0, 1))
    passed = [
        F.struct(
            F.lit(rule).alias("rule"),
            # Number of cutoffs, from the loosest, that let the row pass.
            F.size(F.filter(F.array(*map(F.lit, CUTOFFS)), lambda c: c >= feature(rule))).alias("place"),
        )
        for rule in RULES
    ]
    rows = usable.select("stratum", "quality", F.explode(F.array(*passed)).alias("at"))
    counts = rows.groupBy("stratum", F.col("at.rule").alias("rule"), F.col("at.place").alias("place")).agg(
        F.sum("quality").alias("good"), F.sum(1 - F.col("quality")).alias("poor")
    )
    tested = (
        counts.groupBy("stratum", "rule")
        .agg(
            F.sum("good").alias("n"),
            F.collect_list(F.struct("place", "good", "poor")).alias("at"),
        )
        .withColumn("tests", F.count("*").over(Window.partitionBy()))
        .withColumn("share", F.lit(risk / len(RULES)))
        .withColumn("level", F.lit(error) / F.col("tests"))
        .withColumn("most", most_failures("n", "share", "level"))
    )
    # The cutoff at a place turns away the rows that no cutoff from there on lets pass.
    tested = tested.select(
        "stratum",
        "rule",
        "most",
        F.posexplode(F.array(*map(F.lit, CUTOFFS))).alias("place", "cutoff"),
        "at",
    ).select(
        "stratum",
        "rule",
        "most",
        "cutoff",
        F.expr("aggregate(filter(at, x -> x.place <= place), 0L, (a, x) -> a + x.good)").alias("good"),
        F.expr("aggregate(filter(at, x -> x.place <= place), 0L, (a, x) -> a + x.poor)").alias("poor"),
    )
    gain = F.col("poor") - cost * F.col("good")
    best = (
        tested.where((F.col("good") <= F.col("most")) & (gain > 0))
        .groupBy("stratum", "rule")
        # Equal gains: the loosest.
        .agg(F.max_by("cutoff", F.struct(gain, "cutoff")).alias("cutoff"))
    )
    return best.groupBy("stratum").agg(
        *[F.max(F.when(F.col("rule") == rule, F.col("cutoff"))).alias(rule) for rule in RULES]
    )


def learn_cutoffs(
    docs: DataFrame,
    labels: DataFrame,
    risk: float = 0.02,
    error: float = 0.05,
    cost: float = 20.0,
) -> tuple[DataFrame, DataFrame]:
    """Cutoffs by stratum, and the counts of all rows (doc_id, stratum, counts) they come from."""
    rows = measured(docs.select("doc_id", "text", F.col("lang").alias("stratum")), "counts")
    rows = stored(rows.select("doc_id", "stratum", "counts.*"), "quality-counts")
    one_label = labels.groupBy("doc_id").agg(F.min("quality").cast("long").alias("quality"))
    found = cutoffs(rows.join(one_label, "doc_id"), risk, error, cost)
    return stored(found, "quality-cutoffs"), rows


def stays(counts: str, cut: str) -> Column:
    """Whether a row with these counts stays under these cutoffs (prefixes of columns)."""
    over = F.lit(False)
    for rule in RULES:
        over = over | F.coalesce(feature(rule, counts) > F.col(f"{cut}{rule}"), F.lit(False))
    return ~F.col(f"{counts}base_failed") & ~over


def quality_rules(docs: DataFrame, labels: DataFrame, **settings: float) -> DataFrame:
    """(doc_id, counts, base_failed, kept) for each row of ``docs``.

    ``docs`` needs doc_id, text and lang, ``labels`` doc_id and quality (1 good, 0 poor).
    A null or empty text has no words and fails the base rules. A null language is a
    stratum of its own. Labels that are null or neither are ignored; of several
    labels of one document the lowest counts. Without labels, only the base rules decide.
    """
    found, rows = learn_cutoffs(docs, labels, **settings)
    cut = found.select(F.col("stratum").alias("cut_stratum"), F.struct(*RULES).alias("cut"))
    same = F.col("stratum").eqNullSafe(F.col("cut_stratum"))
    kept = rows.join(if_small(cut), same, "left").withColumn("kept", stays("", "cut."))
    return kept.select("doc_id", *COUNTS, "base_failed", "kept")


def keep_good(docs: DataFrame, labels: DataFrame, **settings: float) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they were.

    The counts are taken again beside each text instead of joined to it: no text is shuffled.
    """
    found, _ = learn_cutoffs(docs, labels, **settings)
    counts, cut = free_name(docs, "_counts"), free_name(docs, "_cut")
    cuts = found.select(F.struct(F.col("stratum").alias("of"), F.struct(*RULES).alias("at")).alias(cut))
    same = F.col("lang").eqNullSafe(F.col(f"{cut}.of"))
    rows = measured(docs, counts).join(if_small(cuts), same, "left")
    return rows.where(stays(f"{counts}.", f"{cut}.at.")).select(*[f"`{c}`" for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def _sql(risk: float = 0.02, error: float = 0.05, cost: float = 20.0) -> str:
    """The same in DuckDB's SQL."""
    features = ", ".join(
        f"{{'rule': '{rule}', 'x': {scale} * {part} // greatest({whole}, 1)}}"
        for rule, (scale, part, whole) in RULES.items()
    )
    share = risk / len(RULES)
    return rf"""
WITH words AS (
  SELECT doc_id, lang, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
grams AS (
  SELECT doc_id, i, w[i:i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM grams) WHERE c > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice)
  GROUP BY doc_id),
counts AS (
  SELECT doc_id, lang AS stratum, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
    len(l)::BIGINT AS n_lines, len(regexp_extract_all(text, '!'))::BIGINT AS n_shouts
  FROM words LEFT JOIN covered USING (doc_id)),
measured AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    [{features}] AS features FROM counts),
labelled AS (
  SELECT stratum, quality, unnest(features) AS f FROM measured
  JOIN (SELECT doc_id, min(quality) AS quality FROM labels GROUP BY doc_id) USING (doc_id)
  WHERE NOT base_failed AND quality IN (0, 1)),
sizes AS (
  SELECT stratum, f.rule AS rule, sum(quality) AS n, {error} / count(*) OVER () AS level
  FROM labelled GROUP BY stratum, f.rule),
steps AS (
  SELECT *, sum(exp(p)) OVER (PARTITION BY stratum, rule ORDER BY i) AS below FROM (
    SELECT *, n * ln(1 - {share}) + coalesce(sum(ln((n - i + 1) * {share} / (i * (1 - {share}))))
      FILTER (i > 0) OVER (PARTITION BY stratum, rule ORDER BY i), 0) AS p
    FROM (SELECT *, unnest(range(0, n::BIGINT + 1)) AS i FROM sizes WHERE n > 0))),
most AS (
  SELECT stratum, rule, coalesce(max(i) FILTER (below <= level), -1) AS k FROM steps GROUP BY stratum, rule),
tested AS (
  SELECT stratum, f.rule AS rule, cutoff, sum(quality) FILTER (f.x > cutoff) AS good,
    sum(1 - quality) FILTER (f.x > cutoff) AS poor
  FROM labelled, (SELECT unnest({list(CUTOFFS)}) AS cutoff) GROUP BY stratum, f.rule, cutoff),
chosen AS (
  SELECT t.stratum, t.rule, arg_max(cutoff, [coalesce(poor, 0) - {cost} * coalesce(good, 0), cutoff]) AS cutoff
  FROM tested t JOIN most m ON t.stratum IS NOT DISTINCT FROM m.stratum AND t.rule = m.rule
  WHERE coalesce(good, 0) <= k AND coalesce(poor, 0) - {cost} * coalesce(good, 0) > 0
  GROUP BY t.stratum, t.rule),
rejected AS (
  SELECT DISTINCT doc_id FROM (SELECT doc_id, stratum, unnest(features) AS f FROM measured) m
  JOIN chosen c ON m.stratum IS NOT DISTINCT FROM c.stratum AND m.f.rule = c.rule WHERE m.f.x > c.cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM rejected) AS kept
FROM measured
"""


SQL = _sql()
