"""Toxic spans and documents (operator 3).

A conditional random field with the states "plain" and "toxic" reads the words of a
text: the word and its beginnings, how it is written, what ends before it and begins
behind it. Labels exist for documents only, so training labels the tokens itself, in
turns. At first a word or a beginning that stands in many different contexts within
toxic documents, and hardly ever elsewhere, marks its tokens there. (Counting contexts,
not places, keeps words out that only a group of copies has.) The field learned from
these then labels the tokens of the toxic documents anew, by all features together, and
one in each toxic document at least, if any is likely; tokens of other documents stay
plain. So a word that is toxic in some surroundings only is weighed with them.
Forward-backward gives each token's probability; the document's score combines the
largest and the sum of them, calibrated on the labels.

Words without a learned feature all have the same scores, so a stretch of them is one
power of one matrix: a text costs time by its words only to look them up.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tripflow.llm import crf
from tripflow.llm.common import labelled_sample, read_table, remainder

WORD = re.compile(r"\w+")
#: Lengths of the beginnings of words that are features, besides whole words.
BEGINNINGS = (4, 5, 6, 7, 8)
#: A small letter where a sentence should begin.
ODD = re.compile(r"[.!?]\s+[a-zß-öø-ÿ]")
#: How a looked-at word is written and what surrounds it.
SHAPES = ("small", "capital", "shouted", "begins", "within", "odd", "before-capital", "before-end", "lone")
SCHEMA = (
    "doc_id long, held_out boolean, score double, predicted int, n_toxic long, offsets string"
)


def beginnings(word: str) -> list[str]:
    """The features of a word: itself, and its beginnings (marked by a star)."""
    return [word] + [word[:n] + "*" for n in BEGINNINGS if len(word) > n]


def markers(texts: list[tuple[str, int]], purity: float, chance: float = 0.01) -> set[str]:
    """Features that belong to toxic texts.

    At least ``purity`` of a feature's places are in toxic texts, and so many that a
    feature without any tie to them would get there by chance with a probability of
    ``chance`` over all features together (a Chernoff bound on the binomial tail). In
    toxic texts only different contexts count.
    """
    toxic: dict[str, set] = defaultdict(set)
    plain: dict[str, int] = defaultdict(int)
    total = [0, 0]
    for text, label in texts:
        words = WORD.findall(text.lower())
        total[label] += len(words)
        for k, word in enumerate(words):
            if label:
                around = (words[k - 1] if k else "", words[k + 1] if k + 1 < len(words) else "")
                for feature in beginnings(word):
                    toxic[feature].add(around)
            else:
                for feature in beginnings(word):
                    plain[feature] += 1
    share = max(total[1], 1) / max(sum(total), 1)
    needed = math.log(max(len(toxic), 1) / chance)

    def surprise(k: int, n: int) -> float:
        rest = (n - k) * math.log((n - k) / n / (1 - share)) if n > k else 0.0
        return k * math.log(k / n / share) + rest

    found = set()
    for feature, seen in toxic.items():
        k, n = len(seen), len(seen) + plain.get(feature, 0)
        if k >= purity * n and share < 1 and surprise(k, n) >= needed:
            found.add(feature)
    return found


def shapes(text: str, before: re.Match | None, word: re.Match, behind: re.Match | None) -> list[str]:
    """The shape features of a word between its neighbours."""
    found = ["shouted" if len(word[0]) > 1 and word[0].isupper() else "capital" if word[0][0].isupper() else "small"]
    gap = text[before.end() : word.start()] if before else "."
    begins = any(c in gap for c in ".!?")
    found.append("odd" if begins and word[0][0].islower() else "begins" if begins else "within")
    rest = text[word.end() : behind.start()] if behind else "."
    ends = any(c in rest for c in ".!?")
    if ends:
        found.append("before-end")
    elif behind and behind[0][0].isupper():
        found.append("before-capital")
    if begins and ends:
        found.append("lone")
    return found


class Model:
    """What scoring needs: scores by feature, the chain, and the calibration."""

    def __init__(
        self,
        texts: list[tuple[str, int]],
        purity: float,
        piece: int,
        pieces: int,
        least_purity: float = 0.5,
        turns: int = 2,
        plain_every: int = 8,
        penalty: float = 1.0,
    ) -> None:
        sure = markers(texts, purity)
        names = sorted(sure | markers(texts, least_purity))
        self.ids = {name: k for k, name in enumerate(["", *SHAPES, *names])}
        self.words: dict[str, list[int]] = {}
        read = [self.tokens(text) for text, _ in texts]
        first = {self.ids[name] for name in sure}
        toxic = [{k for k, _, _, ids in found if label and first.intersection(ids)} for (_, label), (_, found) in zip(texts, read)]
        for turn in range(turns):
            # What only serves to label again needs no more than a part.
            share = pieces if turn + 1 == turns else pieces // 4
            self.fit(read, toxic, piece, share, plain_every, penalty)
            if turn + 1 < turns:
                toxic = [self.relabelled(*found) if label else set() for (_, label), found in zip(texts, read)]
        rows = np.array([self.evidence(self.marginals(*found)) for found in read]).reshape(-1, 2)
        labels = np.array([label for _, label in texts], float)
        self.weights = crf.logistic(rows, labels) if len(texts) else np.zeros(3)

    def fit(self, read: list, toxic: list[set[int]], piece: int, pieces: int, plain_every: int, penalty: float) -> None:
        """The field of the tokens so labelled, from stretches of ``piece`` words.

        Stretches without any feature are alike: one of ``plain_every`` is enough.
        """
        sequences = []
        for (count, found), marked in zip(read, toxic):
            ids = {k: features for k, _, _, features in found}
            featured = {k // piece for k in ids}
            for number in range(-(-count // piece)):
                if number in featured or number % plain_every == 0:
                    places = range(number * piece, min(count, (number + 1) * piece))
                    sequences.append(([ids.get(k, [0]) for k in places], [int(k in marked) for k in places]))
        # Stretches with a toxic token all count, the others in even steps.
        some = [s for s in sequences if any(s[1])][:pieces]
        rest = [s for s in sequences if not any(s[1])]
        step = max(1, -(-len(rest) // max(1, pieces - len(some))))
        self.chain = crf.train(some + rest[::step], len(self.ids), 2, rounds=50, penalty=penalty)
        self.plain = self.chain.emit[0]
        step = np.exp(self.chain.move + self.plain[None, :])
        self.powers = [np.eye(2)]
        for _ in range(256):
            power = self.powers[-1] @ step
            self.powers.append(power / power.sum())

    def relabelled(self, count: int, found: list) -> set[int]:
        """The tokens of a toxic document that the field holds for toxic, one of them if it can."""
        chances = self.marginals(count, found)
        likely = {k for k, p in chances if p >= 0.5}
        if not likely and chances:
            k, p = max(chances, key=lambda c: c[1])
            return {k} if p >= 0.1 else set()
        return likely

    def word_ids(self, word: str) -> list[int]:
        """The lexical features of a word, remembered by word."""
        try:
            return self.words[word]
        except KeyError:
            if len(self.words) > 500_000:
                self.words.clear()
            found = [self.ids[f] for f in beginnings(word.lower()) if f in self.ids]
            self.words[word] = found
            return found

    def tokens(self, text: str | None) -> tuple[int, list[tuple[int, int, int, list[int]]]]:
        """The number of words, and (place, start, end, features) of each that is looked at.

        That is one with a lexical feature or an odd beginning; the others are plain.
        """
        text = text or ""
        words = WORD.findall(text)
        get = self.word_ids
        known = {w for w in set(words) if get(w)}
        if not known and not ODD.search(text):
            return len(words), []
        at = list(WORD.finditer(text))
        odd = {m.end() - 1 for m in ODD.finditer(text)}
        found = []
        for k, m in enumerate(at):
            if m[0] in known or m.start() in odd:
                around = shapes(text, at[k - 1] if k else None, m, at[k + 1] if k + 1 < len(at) else None)
                found.append((k, m.start(), m.end(), [0, *get(m[0]), *(self.ids[name] for name in around)]))
        return len(at), found

    def gap(self, words: int) -> np.ndarray:
        """From before so many plain words to behind them; beyond the table it no longer changes."""
        return self.powers[min(words, len(self.powers) - 1)]

    def read(self, text: str | None) -> list[tuple[int, float]]:
        """(place among the words, P(toxic)) of each word that is looked at."""
        return self.marginals(*self.tokens(text))

    def marginals(self, count: int, found: list) -> list[tuple[int, float]]:
        """Forward-backward over all ``count`` words."""
        if not found:
            return []
        at = [k for k, _, _, _ in found]
        move = np.exp(self.chain.move)
        emits = [np.exp(self.chain.emit[ids].sum(axis=0)) for _, _, _, ids in found]
        ahead, vector = [], np.ones(2)
        for n, k in enumerate(at):
            if n == 0:
                # Plain words first: the chain starts with the first of them.
                vector = np.exp(self.plain) @ self.gap(k - 1) @ move if k else np.ones(2)
            else:
                vector = vector @ self.gap(k - at[n - 1] - 1) @ move
            vector = vector * emits[n]
            vector = vector / vector.sum()
            ahead.append(vector)
        behind, vector = [], self.gap(count - 1 - at[-1]) @ np.ones(2)
        for n in range(len(at) - 1, -1, -1):
            behind.append(vector / vector.sum())
            if n:
                vector = self.gap(at[n] - at[n - 1] - 1) @ move @ (emits[n] * vector / vector.sum())
        both = np.array(ahead) * np.array(behind[::-1])
        return list(zip(at, (both[:, 1] / both.sum(axis=1)).tolist()))

    @staticmethod
    def evidence(found: list[tuple[int, float]]) -> tuple[float, float]:
        top = max((p for _, p in found), default=0.0)
        return top, math.log1p(sum(p for _, p in found))

    def score(self, found: list[tuple[int, float]]) -> float:
        top, many = self.evidence(found)
        w = self.weights
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, w[0] * top + w[1] * many + w[2]))))


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    per_label: int = 2000,
    plain_per_toxic: int = 5,
    purity: float = 0.95,
    piece: int = 32,
    pieces: int = 8000,
    threshold: float = 0.7,
) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_toxic, offsets) for each row of ``docs``.

    ``docs`` needs doc_id and text, ``labels`` doc_id and toxic (1 or 0). Learns from at
    about ``per_label`` toxic documents and ``plain_per_toxic`` times as many others, none
    with crc32(doc_id) mod 3 = 1, and on about ``pieces`` stretches of ``piece`` words of them,
    of those without any feature every eighth; the score uses the text alone. Null and
    empty texts get the score of a text without any toxic word. Without both labels to
    learn from, every score is 0. ``offsets`` lists start:end (code points) of the words
    that are toxic with a probability of one half or more; ``n_toxic`` counts them.
    Repeated rows get equal results.
    """
    usable = labels.where(remainder("doc_id", 3) != 1)
    texts = labelled_sample(docs, usable, "toxic", {1: per_label, 0: plain_per_toxic * per_label})
    model = Model(texts, purity, piece, pieces) if len({y for _, y in texts}) == 2 else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, places = [], []
            for text in batch.column(2).to_pylist():
                count, tokens = model.tokens(text) if model else (0, [])
                found = model.marginals(count, tokens) if model else []
                scores.append(model.score(found) if model else 0.0)
                places.append([f"{start}:{end}" for (_, start, end, _), (_, p) in zip(tokens, found) if p >= 0.5])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(scores, pa.float64()),
                    pa.array([int(s >= threshold) for s in scores], pa.int32()),
                    pa.array([len(p) for p in places], pa.int64()),
                    pa.array([",".join(p) for p in places], pa.string()),
                ],
                names=["doc_id", "held_out", "score", "predicted", "n_toxic", "offsets"],
            )

    rows = docs.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "text")
    return rows.mapInArrow(run, SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
