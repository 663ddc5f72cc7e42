"""Language by compression (operator 10).

A text is written in the language whose sample helps most to compress it. Each
language has a zstandard raw-content dictionary, made of labelled documents, whole
or by stretches from anywhere in them; the pieces of a text are compressed with each dictionary, and the
smallest sum wins. Where the second is nearly as small, the row is marked as not
accepted and its score is low.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.common import read_table, remainder

OTHERS = re.compile(r"[\W\d_]+")
SCHEMA = (
    "doc_id long, held_out boolean, lang_pred string, score double, accepted boolean, margin double"
)


def has_letter(text: str) -> bool:
    """Whether a character is a letter; fractions and circled or raised numbers are none."""
    return any(map(str.isalpha, text))


def sample(docs: DataFrame, per_lang: int) -> dict[str, list[str]]:
    """At most ``per_lang`` whole texts of each language, by lowest hash of the id.

    The counts by language (no text is read for them) give each language a hash
    bound that leaves few rows more than wanted, so what reaches the driver is
    bounded by the number of languages.
    """
    # A share of labels: the rest is held out.
    usable = docs.where((remainder("doc_id", 4) != 2) & F.col("lang").isNotNull())
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return {}
    # pmod of a 64-bit hash to 2^31 places.
    place = F.pmod(F.xxhash64(F.lit("lang"), "doc_id"), F.lit(2**31))
    bound = F.create_map(
        *[
            F.lit(x)
            for lang, n in counts.items()
            for x in (lang, min(2**31, math.ceil(2**31 * (per_lang + 4 * math.sqrt(per_lang)) / n)))
        ]
    )
    rows = (
        usable.where(F.col("text").isNotNull() & (place < bound[F.col("lang")]))
        .select("lang", "text", place.alias("place"))
        .collect()
    )
    # Languages with more rows come first: they win ties.
    order = sorted(counts, key=lambda x: (-counts[x], x))
    chosen: dict[str, list[str]] = {lang: [] for lang in order}
    for row in sorted(rows, key=lambda r: (r["place"], r["text"])):
        if len(chosen[row["lang"]]) < per_lang and has_letter(row["text"]):
            chosen[row["lang"]].append(row["text"])
    return {lang: texts for lang, texts in chosen.items() if texts}


def dictionary(texts: list[str], size: int) -> bytes:
    """The texts behind each other, ``size`` bytes at most.

    If they are more, each has an equal share, and what shorter texts leave of theirs goes to
    the others. Of a longer text the share is a stretch at a place by its hash, so that what
    documents open with fills no dictionary.
    """
    data = [letters(text) for text in texts]
    left, share = max(0, size - len(data) + 1), 0
    for n, length in enumerate(sorted(map(len, data))):
        share = left // (len(data) - n)
        if length > share:
            break
        left -= length
    return b" ".join(stretch(x, max(1, share)) for x in data)[:size]


def stretch(data: bytes, share: int) -> bytes:
    """``share`` bytes at a place by the hash of ``data``; all of it if it is not longer."""
    if len(data) <= share:
        return data
    at = zlib.crc32(data) % (len(data) - share + 1)
    return data[at : at + share]


def letters(text: str) -> bytes:
    """Lower-case words; whatever is between them says nothing about the language."""
    return OTHERS.sub(" ", text.lower()).encode()


class Languages:
    """Compressors, one per language; built anew in each task from their dictionaries.

    ``contents`` comes in the order in which equal sizes are resolved. The last
    ``carrier`` bytes of a language's sample are kept out of its dictionary: a text
    shorter than that is compressed behind them, and what it adds counts. Alone it
    would be stored as it is, at the same size by each dictionary.
    """

    def __init__(self, contents: dict[str, bytes], level: int, piece: int, carrier: int) -> None:
        self.names = list(contents)
        self.piece = piece
        self.carriers = [contents[name][-carrier:] for name in self.names]
        parameters = zstandard.ZstdCompressionParameters.from_level(
            level, write_checksum=0, write_dict_id=0, write_content_size=0
        )
        self.by_name = []
        for name in self.names:
            data = zstandard.ZstdCompressionDict(
                contents[name][:-carrier] or b" ", dict_type=zstandard.DICT_TYPE_RAWCONTENT
            )
            data.precompute_compress(compression_params=parameters)
            self.by_name.append(
                zstandard.ZstdCompressor(dict_data=data, compression_params=parameters)
            )
        self.bare = [len(c.compress(x)) for c, x in zip(self.by_name, self.carriers)]

    def sizes(self, text: str) -> list[int]:
        """Bytes of the whole text by each dictionary.

        Pieces keep the dictionary at work: within a long text the text itself would
        soon be the better dictionary, the same for every language.
        """
        data = letters(text)
        if len(data) < len(self.carriers[0]):
            return [
                max(0, len(c.compress(x + data)) - alone)
                for c, x, alone in zip(self.by_name, self.carriers, self.bare)
            ]
        pieces = [data[i : i + self.piece] for i in range(0, len(data), self.piece)]
        return [sum(len(c.compress(p)) for p in pieces) for c in self.by_name]

    def predict(self, text: str | None, narrow: float) -> tuple[str, float, bool, float]:
        if not text or not has_letter(text) or not self.names:
            return "und", 0.0, False, 0.0
        sizes = self.sizes(text)
        order = sorted(range(len(sizes)), key=lambda k: (sizes[k], k))
        first = sizes[order[0]]
        if len(order) == 1:
            return self.names[0], 1.0, True, 1.0
        margin = (sizes[order[1]] - first) / max(1, sizes[order[1]])
        # Each byte saved counts as one step of log odds, half at a tie.
        score = 1.0 / sum(math.exp(-min(50.0, float(s - first))) for s in sizes)
        return self.names[order[0]], score, margin >= narrow, margin


def identify(
    docs: DataFrame,
    per_lang: int = 400,
    dictionary_bytes: int = 1 << 17,
    level: int = 5,
    piece: int = 2048,
    carrier: int = 512,
    narrow: float = 0.02,
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, accepted, margin) for each row of ``docs``.

    Learns from text and lang of rows whose crc32(doc_id) mod 4 is not 2: a sample of
    ``per_lang`` documents per language, ``dictionary_bytes`` of them at most (see
    ``dictionary``). The result uses the text alone. ``und`` and score 0 for a null text, one without a
    letter, or if nothing was learned. Equal sizes go to the language with more
    labelled rows, with a score of at most one half. ``accepted`` is false where the margin between
    the two smallest sizes is below ``narrow``. Repeated rows get equal results.
    """
    contents = {k: dictionary(v, dictionary_bytes) for k, v in sample(docs, per_lang).items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages = Languages(contents, level, piece, carrier)
        for batch in batches:
            found = [languages.predict(text, narrow) for text in batch.column(2).to_pylist()]
            columns = [pa.array(x) for x in zip(*found)] if found else [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(columns[0], pa.string()),
                    pa.array(columns[1], pa.float64()),
                    pa.array(columns[2], pa.bool_()),
                    pa.array(columns[3], pa.float64()),
                ],
                names=["doc_id", "held_out", "lang_pred", "score", "accepted", "margin"],
            )

    rows = docs.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "text")
    return rows.mapInArrow(run, SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read_table(spark, sf_dir, "documents"))
