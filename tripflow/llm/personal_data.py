"""Personal data in texts (operator 8).

Four patterns find what has its full form. A skip-chain conditional random field looks at
every candidate entity: an address-like word with an "@", or a run of digits with the
separators that numbers are written with. Its states are the kinds and "none".
Neighbours are linked in a chain; a candidate that repeats an entity in another form (a
phone without its country code or with other separators, a card in other groups, the
four parts of an address, the same name before an "@") is linked to it however far
apart they are. Loopy sum-product messages pass labels along both until they settle.

No table has labelled words. Entities in a bounded sample of texts are labelled by the
patterns; the forms that no pattern knows are made from them: each such text also gets
its entities in bare forms, labelled alike, and numbers of the same forms with other
digits, labelled "none". All weights, those of the skip links too, are fitted together.
"""

from __future__ import annotations

import collections
import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.common import read_table

KINDS = ("email", "ip", "card", "phone")
STATES = len(KINDS) + 1  # 0: none
SCHEMA = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string,"
    " spans string, n_added long"
)

# The patterns. Each is written so that it takes time in line with the text.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
PARTS = re.compile(r"[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
#: What follows a name, and digits with what may stand between them.
HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*")
RUN = re.compile(r"[0-9](?:[ ().\-/_]{0,2}[0-9])*")
SOME = re.compile(r"[0-9@]")
#: Digits of a number that is worth a look, and groups of digits it is at most written in.
LEAST_DIGITS, MOST_DIGITS, MOST_GROUPS = 7, 19, 8
#: Characters between neighbours of the chain.
NEAR = 24

Span = tuple[int, int, int]


def emails(text: str) -> list[Span]:
    """The leftmost name before each "@" reaches back to its start or the last match."""
    found, last = [], 0
    at = text.find("@")
    while at >= 0:
        m = DOMAIN.match(text, at)
        if m:
            start = at
            while start > last and text[start - 1] in LOCAL:
                start -= 1
            if start < at:
                found.append((0, start, m.end()))
                last = m.end()
        at = text.find("@", max(at + 1, last))
    return found


def addresses(text: str) -> list[Span]:
    """Four parts each, from the left of every dotted run."""
    found = []
    for run in DOTTED.finditer(text):
        parts = list(PARTS.finditer(text, run.start(), run.end()))
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            values = [p[0].lstrip("0") for p in four]
            if all(len(v) <= 3 and int(v or 0) <= 255 for v in values):
                found.append((1, four[0].start(), four[3].end()))
    return found


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def cards(text: str) -> list[Span]:
    found = []
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append((2, m.start(), m.end()))
    return found


def phones(text: str) -> list[Span]:
    found = []
    for m in PHONE.finditer(text):
        if 8 <= len(DIGIT.findall(m[0])) <= 15:
            found.append((3, m.start(), m.end()))
    return found


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) in order of kind and start."""
    found = emails(text) if "@" in text else []
    if DIGIT.search(text):
        found += addresses(text) + cards(text) + (phones(text) if "+" in text else [])
    return found


def digits_of(text: str) -> str:
    return "".join(PARTS.findall(text))


def four_parts(text: str) -> str:
    """The parts of an address in any separators, or nothing."""
    parts = [p.lstrip("0") or "0" for p in PARTS.findall(text)]
    fits = len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    return ".".join(parts) if fits else ""


class Known:
    """The entities of a text by what their other forms share with them."""

    def __init__(self, text: str, base: list[Span]) -> None:
        self.names: dict[str, int] = {}
        self.parts: dict[str, int] = {}
        self.cards: dict[str, int] = {}
        self.phones: dict[str, list[tuple[str, int]]] = {}
        for node, (kind, start, end) in enumerate(base):
            entity = text[start:end]
            if kind == 0:
                self.names.setdefault(entity.split("@")[0].lower(), node)
            elif kind == 1:
                self.parts.setdefault(four_parts(entity), node)
            elif kind == 2:
                self.cards.setdefault(digits_of(entity), node)
            else:
                number = digits_of(entity)
                same = self.phones.setdefault(number[-LEAST_DIGITS:], [])
                if all(number != other for other, _ in same):
                    same.append((number, node))

    def of_number(self, run: str) -> int | None:
        """The entity that the run is a form of: all of its digits, or its last seven or more."""
        digits = digits_of(run)
        if digits in self.cards:
            return self.cards[digits]
        for number, node in self.phones.get(digits[-LEAST_DIGITS:], ()):
            if len(digits) >= LEAST_DIGITS and number.endswith(digits):
                return node
        return self.parts.get(four_parts(run)) if self.parts else None


class Nodes:
    """The candidates of a text: spans, features, labels by ``base``, and links.

    The first nodes are the entities of ``base``; the others lie between them.
    """

    def __init__(self, text: str, base: list[Span]) -> None:
        base = sorted(base, key=lambda span: (span[1], span[0]))
        known = Known(text, base)
        self.spans = [(start, end) for _, start, end in base]
        self.labels = [kind + 1 for kind, _, _ in base]
        self.skip: list[tuple[int, int]] = []
        last: dict[str, int] = {}
        at = 0
        for start, end in [*self.spans, (len(text), len(text))]:
            for span, entity, key in candidates(text, at, start, known):
                node = len(self.spans)
                self.spans.append(span)
                self.labels.append(0)
                if entity is not None:
                    self.skip.append((node, entity))
                elif key in last:
                    self.skip.append((node, last[key]))
                last[key] = node
            at = max(at, end)
        order = sorted(range(len(self.spans)), key=self.spans.__getitem__)
        self.chain = [(a, b) for a, b in zip(order, order[1:]) if self.spans[b][0] - self.spans[a][1] <= NEAR]
        self.features = [shape(text, start, end) for start, end in self.spans]


def candidates(text: str, start: int, end: int, known: Known) -> Iterator[tuple[tuple[int, int], int | None, str]]:
    """(span, entity it is a form of, what repeats of it share) between two entities."""
    if not SOME.search(text, start, end):
        return
    least = start
    for m in HOST.finditer(text, start, end):
        begin = m.start()
        while begin > least and text[begin - 1] in LOCAL:
            begin -= 1
        least = m.end()
        name = text[begin : m.start()].lower()
        if name:
            yield (begin, m.end()), known.names.get(name), "@" + name
    for run in RUN.finditer(text, start, end):
        if run.end() - run.start() < 4:
            continue
        groups = [g.span() for g in PARTS.finditer(text, run.start(), run.end())]
        first = rest = 0
        while first < len(groups):
            # The most groups that together are a form of an entity; what is between stays whole.
            for count in range(min(MOST_GROUPS, len(groups) - first), 0, -1):
                span = opened(text, groups[first][0], groups[first + count - 1][1], start)
                entity = known.of_number(text[span[0] : span[1]])
                if entity is not None:
                    yield from unknown(text, groups[rest:first], start)
                    yield span, entity, digits_of(text[span[0] : span[1]])
                    first = rest = first + count
                    break
            else:
                first += 1
        yield from unknown(text, groups[rest:], start)


def unknown(text: str, groups: list[tuple[int, int]], least: int) -> Iterator[tuple[tuple[int, int], None, str]]:
    if groups:
        span = opened(text, groups[0][0], groups[-1][1], least)
        digits = digits_of(text[span[0] : span[1]])
        if LEAST_DIGITS <= len(digits) <= MOST_DIGITS:
            yield span, None, digits


def opened(text: str, start: int, end: int, least: int) -> tuple[int, int]:
    """The span with the bracket in front that one within closes."""
    return (start - 1 if start > least and text[start - 1] == "(" and ")" in text[start:end] else start), end


def shape(text: str, start: int, end: int) -> list[str]:
    word = text[start:end]
    before = text[max(0, start - NEAR) : start].split()
    digits = len(DIGIT.findall(word))
    form = re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]+", "0", word))[:12]
    return [
        "all",
        f"form:{form}",
        f"digits:{min(digits, 20)}",
        f"at:{word.count('@')}",
        f"plus:{word[0] == '+'}",
        f"check:{16 <= digits <= 19 and luhn(digits_of(word))}",
        f"before:{re.sub(r'[0-9]+', '0', before[-1].lower())[-8:] if before else ''}",
    ]


def bare_forms(kind: int, entity: str) -> list[str]:
    """The entity as people write it the second time: no pattern finds these."""
    digits = digits_of(entity)
    if kind == 0:
        return [entity.split("@")[0] + "@localhost"]
    if kind == 1:
        return ["-".join(PARTS.findall(entity)), " ".join(PARTS.findall(entity))]
    if kind == 2:
        groups = [digits[k : k + 4] for k in range(0, len(digits), 4)]
        return [".".join(groups), "/".join(groups)]
    a, b, c = digits[-10:-7], digits[-7:-4], digits[-4:]
    if len(digits) < 10:
        return [f"{b}-{c}", b + c]
    return [f"{a}.{b}.{c}", f"{a}-{b}-{c}", a + b + c, f"({a}) {b}-{c}", f"{b}-{c}"]


def with_forms(text: str, base: list[Span], draw: random.Random) -> tuple[str, list[tuple[int, int, int]]]:
    """The text with bare forms and look-alikes behind some of its words, and where the forms are."""
    more, places = [], [m.end() for m in re.finditer(r"\S+", text)]
    inside = [(start, end) for _, start, end in base]
    places = [p for p in places if not any(start < p < end for start, end in inside)]
    for kind, start, end in base:
        forms = bare_forms(kind, text[start:end])
        for form in forms:
            more.append((draw.choice(places), kind, form))
            # Other digits in the same form, or another name.
            alike = re.sub("[0-9]", lambda m: str((int(m[0]) + draw.randrange(1, 9)) % 10), form)
            more.append((draw.choice(places), None, "x" + alike if kind == 0 else alike))
        if kind == 2:
            # As a card, but for its check digit.
            last = str((int(text[end - 1]) + draw.randrange(1, 9)) % 10)
            more += [(draw.choice(places), None, text[start : end - 1] + last) for _ in forms]
    parts, at, moved, labelled = [], 0, 0, []
    for place, kind, form in sorted(more, key=lambda m: m[0]):
        parts += [text[at:place], " , ", form, " ,"]
        begin = place + moved + 3
        if kind is not None:
            labelled.append((begin, begin + len(form), kind + 1))
        moved += len(form) + 5
        at = place
    return "".join([*parts, text[at:]]), labelled


class Model:
    """Weights by state of features (``emit``), of chain links and of skip links."""

    def __init__(self, texts: list[str], least_count: int = 3, rounds: int = 150) -> None:
        draw = random.Random(8)
        read = []
        for text in texts:
            base = base_spans(text)
            if base:
                text, forms = with_forms(text, base, draw)
                base = base_spans(text)
            nodes = Nodes(text, base)
            for begin, end, label in forms if base else ():
                for k, (start, stop) in enumerate(nodes.spans):
                    if not nodes.labels[k] and start < end and begin < stop:
                        nodes.labels[k] = label
            if nodes.spans:
                read.append(nodes)
        counts = collections.Counter(name for nodes in read for names in nodes.features for name in names)
        self.ids = {name: k for k, name in enumerate(sorted(n for n, c in counts.items() if c >= least_count))}
        self._fit(read, rounds)

    def _fit(self, read: list[Nodes], rounds: int, penalty: float = 0.1, rate: float = 0.1) -> None:
        """Largest pseudo-likelihood: each label given the labels it is linked to."""
        rows, ids, labels, links = [], [], [], {"chain": [], "skip": []}
        for nodes in read:
            first = len(labels)
            for k, names in enumerate(nodes.features):
                found = [self.ids[n] for n in names if n in self.ids]
                rows += [first + k] * len(found)
                ids += found
            labels += nodes.labels
            for name, pairs in links.items():
                pairs += [(first + a, first + b) for a, b in getattr(nodes, name)]
        rows, ids, y = (np.array(v, np.int64) for v in (rows, ids, labels))
        chain, skip = (np.array(links[k], np.int64).reshape(-1, 2) for k in ("chain", "skip"))
        shapes = [(max(1, len(self.ids)), STATES), (STATES, STATES), (STATES, STATES)]
        sizes = np.cumsum([0, *(a * b for a, b in shapes)])
        weights = np.zeros(sizes[-1])
        mean, power = np.zeros_like(weights), np.zeros_like(weights)

        def parts(flat: np.ndarray) -> list[np.ndarray]:
            return [flat[i:j].reshape(s) for i, j, s in zip(sizes, sizes[1:], shapes)]

        want = np.eye(STATES)[y] if len(y) else np.zeros((0, STATES))
        for step in range(1, rounds + 1):
            if not len(y):
                break
            emit, *pair = parts(weights)
            scores = np.stack([np.bincount(rows, emit[ids, k], len(y)) for k in range(STATES)], 1)
            for table, (a, b) in zip(pair, (chain.T, skip.T)):
                np.add.at(scores, a, table[:, y[b]].T)
                np.add.at(scores, b, table[y[a]])
            p = np.exp(scores - scores.max(axis=1, keepdims=True))
            off = p / p.sum(axis=1, keepdims=True) - want
            slopes = [np.stack([np.bincount(ids, off[rows, k], shapes[0][0]) for k in range(STATES)], 1)]
            for a, b in (chain.T, skip.T):
                slope = np.zeros((STATES, STATES))
                np.add.at(slope.T, y[b], off[a])
                np.add.at(slope, y[a], off[b])
                slopes.append(slope)
            slope = (np.concatenate([s.ravel() for s in slopes]) + penalty * weights) / len(y)
            mean, power = 0.9 * mean + 0.1 * slope, 0.99 * power + 0.01 * slope**2
            weights = weights - rate * (mean / (1 - 0.9**step)) / (np.sqrt(power / (1 - 0.99**step)) + 1e-9)
        self.emit, self.chain, self.skip = parts(weights)

    def marginals(self, nodes: Nodes, settled: float = 1e-4, most_rounds: int = 1000) -> np.ndarray:
        """P(state of node) by loopy sum-product over chain and skip links.

        Entities that a pattern has found keep their label and pass it on. Messages go
        round until none changes by more than ``settled``; each is mixed with the one before
        it after some rounds, and more so the longer they take, which ends swinging to and fro.
        """
        scores = np.array([self.emit[[self.ids[n] for n in names if n in self.ids]].sum(axis=0) for names in nodes.features])
        for k, label in enumerate(nodes.labels):
            if label:
                scores[k] = np.where(np.arange(STATES) == label, 0.0, -1e9)
        links = [(a, b, self.chain) for a, b in nodes.chain] + [(a, b, self.skip) for a, b in nodes.skip]
        own = scores - scores.max(axis=1, keepdims=True)
        if not links:
            both = np.exp(own)
            return both / both.sum(axis=1, keepdims=True)
        a, b = (np.array([link[k] for link in links]) for k in (0, 1))
        pair = np.exp(np.array([link[2] for link in links]))
        forth, back = (np.full((len(links), STATES), 1 / STATES) for _ in range(2))

        def gathered() -> np.ndarray:
            logs = own.copy()
            np.add.at(logs, b, np.log(forth + 1e-300))
            np.add.at(logs, a, np.log(back + 1e-300))
            return logs

        for turn in range(most_rounds):
            logs = gathered()
            # What a node sends over a link leaves out what came over it.
            out_a = logs[a] - np.log(back + 1e-300)
            out_b = logs[b] - np.log(forth + 1e-300)
            out_a = np.exp(out_a - out_a.max(axis=1, keepdims=True))
            out_b = np.exp(out_b - out_b.max(axis=1, keepdims=True))
            new_forth = np.einsum("ls,lst->lt", out_a, pair)
            new_back = np.einsum("lt,lst->ls", out_b, pair)
            new_forth, new_back = new_forth / new_forth.sum(1, keepdims=True), new_back / new_back.sum(1, keepdims=True)
            change = max(np.abs(new_forth - forth).max(), np.abs(new_back - back).max())
            keep = max(0, turn - 20) / (turn + 30)
            forth, back = keep * forth + (1 - keep) * new_forth, keep * back + (1 - keep) * new_back
            if change <= settled:
                break
        logs = gathered()
        both = np.exp(logs - logs.max(axis=1, keepdims=True))
        return both / both.sum(axis=1, keepdims=True)

    def added(self, text: str, base: list[Span], least: float) -> list[Span]:
        """Candidates that no pattern has found, but the field is sure of."""
        nodes = Nodes(text, base)
        if all(nodes.labels):
            return []
        found = []
        for (start, end), label, p in zip(nodes.spans, nodes.labels, self.marginals(nodes)):
            kind = int(p[1:].argmax())
            if not label and p[kind + 1] >= least:
                found.append((kind, start, end))
        return found


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def sample_texts(docs: DataFrame, most: int) -> list[str]:
    """About ``most`` different texts with a digit or an "@", by a hash of the text."""
    usable = docs.where(F.col("text").rlike("[0-9@]"))
    total = usable.count()
    bound = min(2**31, most * 2**31 // max(1, total) + 1)
    place = F.pmod(F.xxhash64(F.lit("personal"), "text"), F.lit(2**31))
    drawn = usable.where(place < F.lit(bound)).select("text").distinct()
    return sorted(r["text"] for r in drawn.collect())


def find_personal(docs: DataFrame, most: int = 3000, least: float = 0.95) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) for each row.

    The counts and the hash are of what the patterns find; ``spans`` also has the
    ``n_added`` entities that the field adds, with a probability of ``least`` or more and apart
    from the patterns' spans. Trained on about ``most`` texts. A null or empty text has no
    spans; spans of different kinds may overlap; repeated rows give equal results.
    """
    texts = sample_texts(docs, most)
    model = Model(texts) if texts else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, hashes, spans, more = [], [], [], []
            for text in batch.column(1).to_pylist():
                base = base_spans(text) if text else []
                added = model.added(text, base, least) if text and model and SOME.search(text) else []
                counts.append([sum(k == kind for k, _, _ in base) for kind in range(len(KINDS))])
                hashes.append(hashlib.sha256(listed(base).encode()).hexdigest())
                spans.append(listed(sorted(base + added)))
                more.append(len(added))
            columns = [batch.column(0)]
            columns += [pa.array([c[k] for c in counts], pa.int64()) for k in range(len(KINDS))]
            columns += [pa.array(hashes, pa.string()), pa.array(spans, pa.string()), pa.array(more, pa.int64())]
            names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal(read_table(spark, sf_dir, "documents"))
