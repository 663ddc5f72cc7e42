"""Quality by co-training (operator 2).

Two classifiers see a document from different sides: one its text (which bytes, how long
the words, how much repeats), the other what is known about it and how it is laid out
(source, language, length, lines). Each is trained on the labelled documents; then, round
by round, each labels the unlabelled documents it is surest of for the other. At
the end both are calibrated on labelled documents they have not seen, and a document's
score adds up their evidence, each by its weight in the calibration.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import crf
from tripflow.llm.common import labelled_sample_rows, read_table, sample_by_hash

SCHEMA = "doc_id long, score double, keep boolean, text_score double, meta_score double"
#: Places for hashed names of sources and languages.
SLOTS = 64


def text_view(text: str) -> np.ndarray:
    """Shares of kinds of bytes, word lengths and repeats; 0 for a text without words."""
    data = np.frombuffer(text.encode(), np.uint8)
    words = text.split()
    if not words:
        return np.zeros(20)
    counts = np.bincount(data, minlength=256)
    size = max(1, len(data))
    share = lambda chars: counts[list(chars)].sum() / size
    n = len(words)
    lines = [x for x in text.split("\n") if x.strip()]
    return np.array(
        [
            share(b"#*$%&"), share(b"|<>"), share(b"!"), share(b"?"), share(b".,;:"),
            share(range(48, 58)), share(range(65, 91)), share(range(97, 123)),
            counts[128:].sum() / size, share(b"[]{}()_=+/\\@~^"),
            len(set(words)) / n, len(set(words[::2])) / max(1, len(words[::2])),
            len(set(zip(words, words[1:]))) / max(1, n - 1),
            len(set(lines)) / len(lines), min(20, len(text) / n) / 10, max(map(len, words)) / 50,
            sum(a == b for a, b in zip(words, words[1:])) / n,
            1.0 if n < 50 else 0.0, math.log1p(n) / 10, sum(w[-1] in ".!?" for w in words) / n,
        ]
    )


def meta_view(lang: str | None, source: str | None, text: str) -> np.ndarray:
    """Hashed source and language, length and layout; nothing of what the words are."""
    view = np.zeros(SLOTS + 8)
    for kind, name in (("lang", lang), ("source", source)):
        view[zlib.crc32(f"{kind}:{name}".encode()) % SLOTS] += 1.0
    lines = text.split("\n")
    size = len(text)
    view[SLOTS:] = [
        math.log1p(size) / 10, math.log1p(len(lines)) / 5, size / len(lines) / 1000,
        1.0 if size < 200 else 0.0, max(map(len, lines)) / (size + 1), float(len(lines) == 1),
        min(map(len, lines)) / (size + 1), text.count("\n\n") / len(lines),
    ]
    return view


class Classifier:
    """Logistic regression over standardised features."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray) -> None:
        self.mean, self.scale = rows.mean(axis=0), rows.std(axis=0) + 1e-6
        self.weights = crf.logistic(np.clip(self.standard(rows), -5, 5), labels, penalty=2.0)

    def standard(self, rows: np.ndarray) -> np.ndarray:
        return (rows - self.mean) / self.scale

    def odds(self, rows: np.ndarray) -> np.ndarray:
        """Log odds of good quality."""
        x = np.clip(self.standard(np.atleast_2d(rows)), -5, 5)
        return x @ self.weights[:-1] + self.weights[-1]


class CoTraining:
    def __init__(
        self,
        labelled: list[tuple[np.ndarray, np.ndarray, int]],
        unlabelled: list[tuple[np.ndarray, np.ndarray]],
        rounds: int,
        step: int,
        sure: float,
    ) -> None:
        views = [np.array([row[v] for row in labelled]) for v in (0, 1)]
        labels = np.array([row[2] for row in labelled], float)
        # Every third labelled row calibrates; the order of the sample is that of the texts.
        apart = np.arange(len(labels)) % 3 == 2
        pool = [np.array([row[v] for row in unlabelled]) for v in (0, 1)]
        free = np.ones(len(unlabelled), bool)
        have = [(views[v][~apart], labels[~apart]) for v in (0, 1)]
        self.models = [Classifier(*have[v]) for v in (0, 1)]
        self.exchanged = 0
        for _ in range(rounds if len(unlabelled) else 0):
            for v in (0, 1):
                odds = self.models[v].odds(pool[v])
                for label, strength in ((1, odds), (0, -odds)):
                    # The surest first; equal ones in the order of the sample.
                    order = np.argsort(-np.where(free, strength, -np.inf), kind="stable")[:step]
                    order = order[free[order] & (strength[order] >= sure)]
                    free[order] = False
                    self.exchanged += len(order)
                    rows, known = have[1 - v]
                    have[1 - v] = (
                        np.vstack([rows, pool[1 - v][order]]),
                        np.append(known, np.full(len(order), float(label))),
                    )
            self.models = [Classifier(*have[v]) for v in (0, 1)]
        held = apart if len(set(labels[apart])) == 2 else ~apart
        odds = np.array([self.models[v].odds(views[v][held]) for v in (0, 1)]).T
        self.views = [crf.logistic(odds[:, [v]], labels[held], 0.1) for v in (0, 1)]
        self.both = crf.logistic(odds, labels[held], 0.1)

    def score(self, text: np.ndarray, meta: np.ndarray) -> tuple[float, float, float]:
        """P(good) by both views, by text, by metadata."""
        odds = [float(m.odds(x)[0]) for m, x in zip(self.models, (text, meta))]
        p = lambda z: 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
        return (
            p(odds[0] * self.both[0] + odds[1] * self.both[1] + self.both[2]),
            *(p(o * w[0] + w[1]) for o, w in zip(odds, self.views)),
        )


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    per_label: int = 3000,
    unlabelled: int = 6000,
    rounds: int = 6,
    step: int = 150,
    sure: float = 2.0,
    threshold: float = 0.5,
) -> DataFrame:
    """(doc_id, score, keep, text_score, meta_score) for each row of ``docs``.

    ``docs`` needs doc_id, text, lang and source, ``labels`` doc_id and quality (1 good, 0
    poor). Learns from about ``per_label`` documents of either label and ``unlabelled``
    others; scores every row by its whole text. Null texts count as empty; a null
    language or source is a value like others. Without both labels every score is 1:
    nothing speaks against a document. Repeated rows get equal results.
    """
    wanted = {0: per_label, 1: per_label}
    known = labelled_sample_rows(docs, labels, "quality", wanted, ["lang", "source"])
    rest = docs.join(labels.select("doc_id"), "doc_id", "left_anti").select("doc_id").distinct()
    rest = rest.withColumn("y", F.lit(1))
    drawn = docs.join(F.broadcast(sample_by_hash(rest, "y", {1: unlabelled}).select("doc_id")), "doc_id")
    others = drawn.select("text", "lang", "source").where(F.col("text").isNotNull()).distinct().collect()
    others = sorted(map(tuple, others), key=repr)
    model = None
    if {r[1] for r in known} == {0, 1}:
        model = CoTraining(
            [(text_view(t), meta_view(lang, source, t), y) for t, y, lang, source in known],
            [(text_view(t), meta_view(lang, source, t)) for t, lang, source in others],
            rounds,
            step,
            sure,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            for text, lang, source in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3))):
                text = text or ""
                views = (text_view(text), meta_view(lang, source, text))
                scores.append(model.score(*views) if model else (1.0, 1.0, 1.0))
            columns = [[s[k] for s in scores] for k in range(3)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(columns[0], pa.float64()),
                    pa.array([s >= threshold for s in columns[0]], pa.bool_()),
                    pa.array(columns[1], pa.float64()),
                    pa.array(columns[2], pa.float64()),
                ],
                names=["doc_id", "score", "keep", "text_score", "meta_score"],
            )

    return docs.select("doc_id", "text", "lang", "source").mapInArrow(run, SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
