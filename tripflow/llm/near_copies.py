"""Jaccard join of documents on word shingles (operator 9).

The distance 1 - J between shingle sets is a metric. The join works with pivots, as
metric joins do, in three steps.

1. *Classes.* Documents with equal sets are one class, by a 128-bit digest.
2. *Regions.* Two linked sets share a shingle among the first |x| - ceil(t|x|) + 1 of
   each, in any common order of shingles (else too few are left to share). So each
   shingle of these prefixes elects a pivot, the set with the lowest digest among those
   that have it there, and every set joins the regions of the pivots that its prefix
   elects: two linked sets always meet in the region of a pivot. A set whose prefix
   shingles are all its own meets nobody and is done. The common order puts
   shingles of shared passages last, so that a passage makes no region.
3. *Windows.* In a region every set knows its distance to the pivot. Within the
   radius it is linked to it. Two others can be linked only if their distances
   differ by no more than the radius (triangle inequality): sets are compared within
   that window. A region too large for one task elects further pivots: sets go to the
   nearest of them and are replicated to every other that is no more than twice the
   radius further away; the new regions are joined the same way.

What is linked to one pivot is connected already, so a group of copies costs one
comparison a member, not one a pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.common import if_small, read_table, stored, text_of
from tripflow.llm.components import connected

#: Words whose hashes a task remembers.
REMEMBERED = 1_000_000
#: Sets of so many shingles are counted in finer parts.
LARGE_SET = 2048
MIX = np.uint64(0x9E3779B97F4A7C15)


class Shingles:
    """Sets of 64-bit hashes of a text's n-word shingles.

    ``bytes.lower`` and ``bytes.split`` treat exactly A-Z and ASCII white space.
    """

    def __init__(self, n: int) -> None:
        self.n = n
        self.words: dict[bytes, int] = {}

    def hashes(self, text: str) -> np.ndarray:
        """Sorted and distinct; one hash of all words if there are fewer than n."""
        words = text.encode().lower().split()
        if not words:
            return np.empty(0, np.uint64)
        known = self.words
        if len(known) > REMEMBERED:
            known.clear()
        try:
            codes = [known[w] for w in words]
        except KeyError:
            for w in set(words):
                if w not in known:
                    known[w] = xxhash.xxh3_64_intdigest(w)
            codes = [known[w] for w in words]
        codes = np.array(codes, np.uint64)
        n = min(self.n, len(codes))
        mixed = np.full(len(codes) - n + 1, n, np.uint64)
        for k in range(n):
            mixed = (mixed ^ codes[k : len(codes) - n + 1 + k]) * MIX
            mixed ^= mixed >> np.uint64(29)
        return np.unique(mixed)


def prefix(hashes: np.ndarray, least: int, late: np.ndarray | None) -> np.ndarray:
    """The first shingles of a set in the common order, so many that linked sets share one.

    The order is by hash, behind it the shingles that ``late`` (a bit per slot of the
    hash) marks. ``least`` is the threshold in hundredths.
    """
    need = len(hashes) - -(-least * len(hashes) // 100) + 1
    if late is not None:
        marked = marks(hashes, late)
        hashes = np.concatenate([hashes[~marked], hashes[marked]])
    return hashes[:need]


def slots(hashes: np.ndarray, bits: int) -> np.ndarray:
    return ((hashes * MIX) >> np.uint64(64 - bits)).astype(np.int64)


def marks(hashes: np.ndarray, late: np.ndarray) -> np.ndarray:
    at = slots(hashes, int(math.log2(len(late) * 8)))
    return (late[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def shared_slots(docs: DataFrame, n: int, often: int, bits: int, chunk: int = 2_000_000) -> np.ndarray:
    """Marks the slots of shingles that many documents share.

    A task sends on what occurs twice or more in a chunk of its shingles, whole
    documents only. What N of all documents share comes together about N * N / chunks
    times, so what is shared by very many is found at any size, and what is not
    found makes a region, no error: marks only order shingles. Slots are 2^bits bits
    whatever the data; if most fill up, the order is plain hash order again.
    """

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, held, size = Shingles(n), [], 0

        def flush() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            at = slots(values[counts > 1], bits)
            return pa.RecordBatch.from_arrays(
                [pa.array(at), pa.array(counts[counts > 1].astype(np.int64))], names=["slot", "n"]
            )

        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.append(shingles.hashes(text))
                size += len(held[-1])
                if size > chunk:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    texts = docs.select(text_of("text").alias("text"))
    counted = texts.mapInArrow(repeated, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    packed = (
        counted.where(F.col("n") > often)
        .groupBy(F.shiftright("slot", 3).alias("at"))
        .agg(F.bit_or(F.expr("shiftleft(1, cast(slot % 8 AS int))")).alias("byte"))
        .toPandas()
    )
    late = np.zeros(2**bits // 8, np.uint8)
    late[packed["at"].to_numpy(np.int64)] = packed["byte"].to_numpy(np.int64).astype(np.uint8)
    return late


def linked(shared: np.ndarray, a: np.ndarray, b: np.ndarray, least: int) -> np.ndarray:
    return 100 * shared >= least * (a + b - shared)


def compare(sets: list[np.ndarray], least: int, stars: int = 8) -> list[tuple[int, int]]:
    """Links between sets, so many that their components are those of all links.

    Pivots first: the first set, then sets not linked so far, as long as they link
    others. Then every set outside the largest component meets all sets that share a
    shingle of its prefix, the rarest shingles here first. Of these, the
    window of distances to the first pivot and the sizes leave few to be compared.
    """
    m = len(sets)
    sizes = np.array([len(x) for x in sets], np.int64)
    flat, owner = np.concatenate(sets), np.repeat(np.arange(m), sizes)
    parent = list(range(m))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    links: list[tuple[int, int]] = []

    def link(x: int, y: int) -> None:
        a, b = root(x), root(y)
        if a != b:
            parent[max(a, b)] = min(a, b)
            links.append((x, y))

    free, pivot, first = np.ones(m, bool), 0, None
    for _ in range(stars):
        shared = np.bincount(owner[np.isin(flat, sets[pivot])], minlength=m)
        if first is None:
            first = 1 - shared / (sizes + sizes[pivot] - shared)
        near = linked(shared, sizes, sizes[pivot], least)
        for x in np.flatnonzero(near).tolist():
            link(pivot, x)
        free &= ~near
        free[pivot] = False
        if not free.any() or (near.sum() == 1 and m > 64):
            break
        pivot = int(free.argmax())
    roots = np.array([root(x) for x in range(m)])
    main = np.bincount(roots).argmax()
    outside = roots != main
    if not outside.any():
        return links
    values, back, counts = np.unique(flat, return_inverse=True, return_counts=True)
    # Within each set the rarest shingles first.
    order = np.lexsort((back, counts[back], owner))
    rank = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    need = np.repeat(sizes - -(-least * sizes // 100) + 1, sizes)
    taken = order[rank < need]
    token, who = back[taken], owner[taken]
    by_token = np.lexsort((who, token))
    token, who = token[by_token], who[by_token]
    radius = 1 - least / 100 + 1e-9
    starts = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
    seen: set[tuple[int, int]] = set()
    for at, end in zip(starts.tolist(), np.r_[starts[1:], len(token)].tolist()):
        if end - at < 2:
            continue
        group = who[at:end]
        for x in group[outside[group]].tolist():
            size = sizes[group]
            fits = (
                (group != x)
                & (100 * size >= least * sizes[x])
                & (100 * sizes[x] >= least * size)
                & (np.abs(first[group] - first[x]) <= radius)
            )
            for y in group[fits].tolist():
                pair = (min(x, y), max(x, y))
                if pair in seen or root(x) == root(y):
                    continue
                seen.add(pair)
                shared = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if linked(shared, sizes[x], sizes[y], least):
                    link(x, y)
    return links


def region_links(n: int, least: int):
    """A task over rows (region, doc_id, text) in the order of regions: links (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(n)
        region, ids, sets = None, [], []

        def flush() -> list[tuple[int, int]]:
            return [(ids[x], ids[y]) for x, y in compare(sets, least)] if len(ids) > 1 else []

        for batch in batches:
            found: list[tuple[int, int]] = []
            for key, doc_id, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if key != region:
                    found += flush()
                    region, ids, sets = key, [], []
                ids.append(doc_id)
                sets.append(shingles.hashes(text))
            yield edges_of(found)
        yield edges_of(flush())

    return run


def edges_of(found: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*found) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def measured_sets(docs: DataFrame, n: int, least: int, late: np.ndarray) -> DataFrame:
    """(doc_id, n_shingles, digest, bins, prefix) for each row; no digest for an empty set.

    ``bins``: see counted().
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(n)
        for batch in batches:
            sets = [shingles.hashes(t) for t in batch.column(1).to_pylist()]
            digests = [xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None for x in sets]
            prefixes = [prefix(x, least, late).view(np.int64) for x in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(x) for x in sets], pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array([counted(x) for x in sets], pa.binary()),
                    pa.array(prefixes, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "digest", "bins", "prefix"],
            )

    rows = docs.select("doc_id", text_of("text").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_shingles long, digest binary, bins binary, prefix array<long>")


def counted(hashes: np.ndarray) -> bytes:
    """How many hashes fall into each part of their range: 64 parts, 1024 for large sets."""
    parts = 10 if len(hashes) >= LARGE_SET else 6
    counts = np.bincount((hashes >> np.uint64(64 - parts)).astype(np.int64), minlength=2**parts)
    return counts.astype(np.uint16 if counts.max() < 2**16 else np.uint32).tobytes()


def counts_of(stored_counts: bytes) -> np.ndarray:
    wide = len(stored_counts) == 4 * 1024
    return np.frombuffer(stored_counts, np.uint32 if wide else np.uint16).astype(np.int64)


def possible(least: int):
    """A task over rows (region, doc_id, n, bins) in the order of regions: rows that may have a link.

    Two sets share no more than the sum of the lesser counts of their bins. What can
    reach the threshold with nobody in its region by this bound leaves the region.
    """

    def kept(rows: list[tuple]) -> list[tuple]:
        bins = [counts_of(r[3]) for r in rows]
        coarse = np.array([b.reshape(64, -1).sum(axis=1) for b in bins])
        sizes = coarse.sum(axis=1)
        alive = np.zeros(len(rows), bool)
        for x in range(len(rows)):
            fits = (100 * sizes >= least * sizes[x]) & (100 * sizes[x] >= least * sizes)
            # One partner is enough for a set: pairs of two that have one may be left out.
            others = np.flatnonzero(fits & ~alive if alive[x] else fits)
            others = others[others != x]
            shared = np.minimum(coarse[others], coarse[x]).sum(axis=1)
            others = others[linked(shared, sizes[others], sizes[x], least)]
            if len(bins[x]) > 64:
                others = np.array(
                    [
                        y for y in others.tolist()
                        if len(bins[y]) == 64
                        or linked(np.minimum(bins[x], bins[y]).sum(), sizes[x], sizes[y], least)
                    ],
                    np.int64,
                )
            alive[others] = True
            alive[x] |= len(others) > 0
        return [r for r, stays in zip(rows, alive) if stays]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        region, rows = None, []

        def batch_of(found: list[tuple]) -> pa.RecordBatch:
            columns = [[r[k] for r in found] for k in range(3)]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["region", "doc_id", "n"]
            )

        for batch in batches:
            found = []
            for row in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if row[0] != region:
                    found += kept(rows) if len(rows) > 1 else []
                    region, rows = row[0], []
                rows.append(row)
            yield batch_of(found)
        yield batch_of(kept(rows) if len(rows) > 1 else [])

    return run


def with_text(members: DataFrame, docs: DataFrame) -> DataFrame:
    """Rows of ``members`` with the texts of their documents.

    Few members are broadcast, so the texts stay where they are; beyond a count both
    sides are shuffled.
    """
    texts = docs.select("doc_id", text_of("text").alias("text"))
    return texts.join(if_small(members), "doc_id")


def pivot_distances(n: int, least: int):
    """A task over rows (region, doc_id, text, pivots): distance to the first pivot, and linked pivots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, key, pivots = Shingles(n), None, []
        for batch in batches:
            first, near = [], []
            regions, texts, sets = (batch.column(k) for k in (0, 2, 3))
            for k, (region, text) in enumerate(zip(regions.to_pylist(), texts.to_pylist())):
                if region != key:
                    key = region
                    pivots = [(p["id"], shingles.hashes(p["text"])) for p in sets[k].as_py()]
                    # The one that gave the region its name is the first.
                    pivots.sort(key=lambda p: (p[0] != region, p[0]))
                mine = shingles.hashes(text)
                shared = [len(np.intersect1d(mine, p, assume_unique=True)) for _, p in pivots]
                first.append(1 - shared[0] / (len(mine) + len(pivots[0][1]) - shared[0]))
                near.append(
                    [i for (i, p), s in zip(pivots, shared) if linked(s, len(mine), len(p), least)]
                )
            yield pa.RecordBatch.from_arrays(
                [
                    regions,
                    batch.column(1),
                    pa.array(first, pa.float64()),
                    pa.array(near, pa.list_(pa.int64())),
                ],
                names=["region", "doc_id", "first", "near"],
            )

    return run


def main_pivots(pairs: pd.DataFrame) -> pd.DataFrame:
    """Of one region's pivots, those of the part with most sets; rows (region, a, b, n) of pivots linked by n sets."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in zip(pairs["a"], pairs["b"]):
        parent[max(root(a), root(b))] = min(root(a), root(b))
    sizes: dict[int, int] = {}
    for a, k in zip(pairs["a"], pairs["n"]):
        sizes[root(a)] = sizes.get(root(a), 0) + int(k)
    best = max(sizes, key=lambda r: (sizes[r], -r))
    return pd.DataFrame({"region": [pairs["region"].iloc[0]], "main": [[x for x in parent if root(x) == best]]})


def split_regions(
    members: DataFrame, docs: DataFrame, n: int, least: int, weight: int, pivots: int
) -> tuple[DataFrame, DataFrame]:
    """Large regions (region, doc_id, n, sets, weight): links to pivots, and what is left to compare.

    About ``pivots`` sets of a region, by hash, join the one that gave it its name. Sets
    that hang together through pivots are settled; those of the largest part need no
    comparison among themselves. Every other set meets all sets whose distance to the
    first pivot lies in its window: both sides are cut into blocks of ``weight``, and a
    block of the one meets each block of the other in a task of its own.
    """
    place = F.pmod(F.xxhash64(F.lit("pivot"), "doc_id"), F.lit(2**31))
    drawn = (F.col("doc_id") == F.col("region")) | (place * F.col("sets") < F.lit(pivots * 2**31))
    chosen = with_text(members.where(drawn).select("region", "doc_id"), docs)
    chosen = chosen.groupBy("region").agg(
        F.collect_list(F.struct(F.col("doc_id").alias("id"), "text")).alias("pivots")
    )
    rows = with_text(members.select("region", "doc_id"), docs).join(chosen, "region")
    rows = rows.select("region", "doc_id", "text", "pivots").mapInArrow(
        pivot_distances(n, least), "region long, doc_id long, first double, near array<long>"
    )
    rows = stored(rows, "pivots")
    links = rows.select(F.col("doc_id").alias("a"), F.explode("near").alias("b"))
    together = rows.where(F.size("near") > 0).select(
        "region", F.array_min("near").alias("a"), F.explode("near").alias("b")
    )
    together = together.groupBy("region", "a", "b").agg(F.count("*").alias("n"))
    main = together.groupBy("region").applyInPandas(main_pivots, "region long, main array<long>")
    rows = rows.join(main, "region", "left").join(members.select("region", "doc_id", "n"), ["region", "doc_id"])
    settled = F.coalesce(F.arrays_overlap("near", "main"), F.lit(False))
    rows = stored(rows.select("region", "doc_id", "n", "first", settled.alias("settled")), "settled")
    radius = 1 - least / 100 + 1e-9
    open_ = ~F.col("settled")
    spans = rows.groupBy("region").agg(
        F.min(F.when(open_, F.col("first"))).alias("low"),
        F.max(F.when(open_, F.col("first"))).alias("high"),
        F.sum(F.when(open_, F.col("n"))).alias("open_weight"),
        F.sum("n").alias("weight"),
    )
    spans = spans.where(F.col("low").isNotNull())
    rows = rows.join(spans, "region").where(F.col("first").between(F.col("low") - radius, F.col("high") + radius))
    blocks = {c: F.ceil(F.col(c) / weight).cast("int") for c in ("open_weight", "weight")}

    def block(count: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit("block"), "doc_id"), count).cast("int")

    every = F.sequence(F.lit(0), blocks["open_weight"] - 1)
    ours = rows.select("region", F.explode(every).alias("i"), block(blocks["weight"]).alias("j"), "doc_id")
    every = F.sequence(F.lit(0), blocks["weight"] - 1)
    theirs = rows.where(open_).select(
        "region", block(blocks["open_weight"]).alias("i"), F.explode(every).alias("j"), "doc_id"
    )
    return links, ours.union(theirs).distinct()


def jaccard_join(
    docs: DataFrame,
    n: int = 4,
    least: int = 85,
    weight: int = 4_000_000,
    most_sets: int = 4096,
    pivots: int = 16,
    often: int = 2,
    bits: int = 23,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, digest) for each row of ``docs``.

    Two documents are linked if their sets of ``n``-word shingles have a Jaccard
    similarity of ``least`` hundredths or more; ``component_id`` is the smallest doc_id
    reachable over links. ``digest`` names the set. A text of fewer words is one shingle;
    a null or empty text has none and is linked with nothing. A row's component is that of
    its text, also where an id has several texts; a row with a null id is linked with nothing
    but equal texts.
    Shingles are 64-bit hashes: a false link would take a collision for every shingle
    that two sets seem to share.

    ``weight``, ``most_sets``: shingles and sets that a region may have to be one task's
    work; larger regions are split.
    ``often``, ``bits``: see shared_slots().
    """
    late = shared_slots(docs, n, often, bits)
    sets = stored(measured_sets(docs, n, least, late), "sets")
    known = sets.where(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    classes = known.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    reps = known.join(
        if_small(classes.select(F.col("rep").alias("doc_id"), F.col("digest").alias("of"))), "doc_id"
    ).where(F.col("digest") == F.col("of"))
    postings = reps.select("doc_id", F.explode("prefix").alias("shingle"))
    elected = postings.groupBy("shingle").agg(F.min("doc_id").alias("region"), F.max("doc_id").alias("last"))
    elected = elected.where(F.col("region") != F.col("last")).select("shingle", "region")
    members = postings.join(elected, "shingle").select("region", "doc_id").distinct()
    sizes = reps.groupBy("doc_id").agg(F.max("n_shingles").alias("n"))
    members = stored(members.join(sizes, "doc_id").select("region", "doc_id", "n"), "regions")
    weights = members.groupBy("region").agg(F.sum("n").alias("weight"), F.count("*").alias("sets"))
    is_large = (F.col("weight") > weight) | (F.col("sets") > most_sets)
    large = weights.where(is_large)
    small = members.join(weights.where(~is_large), "region").select("region", "doc_id", "n")
    small = small.join(reps.select("doc_id", "bins"), "doc_id").select("region", "doc_id", "n", "bins")
    small = small.repartition("region").sortWithinPartitions("region", "doc_id")
    small = stored(small.mapInArrow(possible(least), "region long, doc_id long, n long"), "possible")
    tasks = small.select("region", F.lit(0).alias("i"), F.lit(0).alias("j"), "doc_id")
    links = None
    if large.limit(1).count():
        links, rest = split_regions(stored(members.join(large, "region"), "large"), docs, n, least, weight, pivots)
        tasks = tasks.union(rest)
    keyed = tasks.select(F.xxhash64("region", "i", "j").alias("task"), "doc_id")
    ready = with_text(keyed, docs).select("task", "doc_id", "text")
    found = (
        ready.repartition("task").sortWithinPartitions("task", "doc_id").mapInArrow(region_links(n, least), "a long, b long")
    )
    if links is not None:
        found = found.union(links)
    parts = connected(found)
    named = classes.join(parts.select(F.col("node").alias("rep"), "component"), "rep", "left")
    named = stored(named.select("digest", F.coalesce("component", "rep").alias("component")), "classes")
    # Two plain tables: adaptive execution can split the join at a class of very many copies.
    labelled = sets.join(named, "digest", "left")
    component = F.coalesce("component", "doc_id")
    return labelled.select("doc_id", "n_shingles", component.alias("component_id"), "digest")


def one_of_each(docs: DataFrame, n: int = 5, least: int = 80, **settings: int) -> DataFrame:
    """``docs`` with the document of smallest doc_id of each component, all columns as they were.

    Of several rows of one doc_id the one with the smallest text stays. Rows without an id
    or without words stay.
    """
    joined = jaccard_join(docs, n, least, **settings).where(F.col("doc_id").isNotNull())
    by_id = joined.groupBy("doc_id").agg(F.min("component_id").alias("first"), F.count("*").alias("rows"))
    by_id = stored(by_id.where((F.col("first") != F.col("doc_id")) | (F.col("rows") > 1)), "losers")
    kept = docs.join(if_small(by_id.select("doc_id")), "doc_id", "left_anti").select(docs.columns)
    repeated = by_id.where(F.col("first") == F.col("doc_id")).select("doc_id")
    repeated = docs.join(if_small(repeated), "doc_id", "left_semi").select(docs.columns)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = repeated.groupBy("doc_id").agg(F.min_by(whole, F.struct("text")).alias("row")).select("row.*")
    return kept.unionByName(one)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(read_table(spark, sf_dir, "documents")).drop("digest")


SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS shingle
  FROM words),
sizes AS (SELECT doc_id, count(shingle) AS n FROM words LEFT JOIN shingles USING (doc_id) GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b USING (shingle)
  WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared.n >= 85 * (x.n + y.n - shared.n)),
reached AS (
  SELECT doc_id, doc_id AS from_id FROM documents
  UNION SELECT links.b, reached.from_id FROM reached JOIN links ON reached.doc_id = links.a)
SELECT doc_id, n AS n_shingles, min(from_id) AS component_id
FROM reached JOIN sizes USING (doc_id) GROUP BY doc_id, n
"""
