"""The prefix trie of conversations (operator 11).

A conversation is a row of turn digests. Sorted, conversations of a common prefix stand
side by side, and the longest common prefix (LCP) of neighbours says how far they agree.
A prefix is a node where it first appears, and its members are the interval around that
place in which no LCP is below its depth. Each candidate prefix finds the two ends of
its interval by itself: a sparse table of minima over the LCPs answers "is any of the
next 2^k below the depth?", and halving k walks to the end. No stack is kept and no
candidate waits for another one.

The sort deals the conversations over blocks. A task answers its block's prefixes from
the block's sparse table. A prefix that is still open at the end of a block has a piece
in each block behind; such a block finds the owner of each piece by the same search over
a sparse table of the blocks' minima. There are at most (longest common prefix) pieces
a block, and one pass sums the pieces of a prefix.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.common import if_small, read_table, stored, text_of
from tripflow.llm.crc_sql import CRC_TABLE, crc32_sql

#: Conversations of a block, and most blocks: one row of small numbers per block goes to every task.
BLOCK_ROWS = 20_000
MOST_BLOCKS = 8_192
#: Bytes of a turn's digest.
DIGEST = 16

_EMPTY_SHA = hashlib.sha256(b"").hexdigest()
_NUMBERS = ("conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")


def rebuilt(turns: DataFrame, shared: int = 5, family: int = 100) -> DataFrame:
    """(conv_id, key, sizes): each conversation with its head taken from its family's first one.

    The head is the first h turns of conversation c - c % family, h = crc32(c) % (shared
    + 1); behind it come c's own turns after its first h. Turns go by number, null
    first, those of one number by digest. ``key`` joins the digests, ``sizes`` are the
    texts' code points. A conversation is one row, of 20 bytes a turn.
    """
    role, text = text_of("role"), text_of("text")
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    turn = F.struct("turn", F.substring(digest, 1, 2 * DIGEST).alias("digest"), F.length(text).alias("size"))
    own = turns.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    own = own.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("own"))
    own = stored(own.withColumn("own", F.transform("own", lambda t: F.struct(t.digest, t.size))), "talks")
    heads = own.where(F.col("conv_id") % family == 0)
    heads = heads.select(F.col("conv_id").alias("base"), F.slice("own", 1, shared).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (shared + 1)).cast("int")
    base = F.col("conv_id") - F.col("conv_id") % family
    whole = own.select("conv_id", "own", h.alias("h"), base.alias("base")).join(if_small(heads), "base", "left")
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.filter("own", lambda t: F.lit(False)))
    rest = F.slice("own", F.col("h") + 1, F.greatest(F.size("own"), F.lit(1)))
    whole = whole.select("conv_id", F.concat(head, rest).alias("turns"))
    key = F.unhex(F.array_join(F.transform("turns", lambda t: t.digest), ""))
    return whole.select("conv_id", key.alias("key"), F.transform("turns", lambda t: t.size).alias("sizes"))


def common_turns(a: bytes, b: bytes) -> int:
    """Turns at the beginning that two keys share."""
    low, high = 0, min(len(a), len(b)) // DIGEST
    while low < high:
        middle = (low + high + 1) // 2
        if a[low * DIGEST : middle * DIGEST] == b[low * DIGEST : middle * DIGEST]:
            low = middle
        else:
            high = middle - 1
    return low


class SparseMin:
    """Minima of all runs of 2^k values."""

    def __init__(self, values: np.ndarray) -> None:
        self.rows = [np.asarray(values)]
        while len(self.rows[-1]) > (width := 1 << (len(self.rows) - 1)):
            last = self.rows[-1]
            self.rows.append(np.minimum(last[:-width], last[width:]))

    def least(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The least value of each interval, ends included."""
        first, last = np.asarray(first), np.asarray(last)
        result = np.empty(len(first), self.rows[0].dtype)
        level = np.frexp((last - first + 1).astype(float))[1] - 1
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            row = self.rows[k]
            result[at] = np.minimum(row[first[at]], row[last[at] - (1 << k) + 1])
        return result

    def right_end(self, start: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Largest r such that no value of start+1..r is below the depth, by halving steps."""
        at = start.copy()
        for k in reversed(range(len(self.rows))):
            row, ahead = self.rows[k], at + 1
            open_ = ahead < len(row)
            open_[open_] = row[ahead[open_]] >= depth[open_]
            at[open_] += 1 << k
        return at

    def left_end(self, start: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Smallest l >= 0 such that no value of l+1..start is below the depth."""
        at = start.copy()
        for k in reversed(range(len(self.rows))):
            row, behind = self.rows[k], at - (1 << k) + 1
            open_ = behind >= 1
            open_[open_] = row[behind[open_]] >= depth[open_]
            at[open_] -= 1 << k
        return at


@dataclass(frozen=True)
class Blocks:
    """What every task knows of all blocks: a few numbers each."""

    numbers: np.ndarray  # of the block, ascending
    edge: np.ndarray  # LCP of its first conversation with the one before it, -1 for the first of all
    least: np.ndarray  # least LCP of the block, the edge included
    copied: np.ndarray  # whether its first conversation equals the one before it

    def owner(self, block: int, depth: np.ndarray) -> np.ndarray:
        """The block in which the prefix of each depth begins that is open where ``block`` begins."""
        start = np.full(len(depth), block - 1)
        return np.maximum(SparseMin(self.least).left_end(start, depth), 0)


def sorted_blocks(talks: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per block of sorted conversations: their ids, lengths, sizes and LCPs in arrays.

    The sort goes by key, then by id, so copies of one conversation are dealt over as
    many blocks as they fill.
    """
    wanted = max(1, min(MOST_BLOCKS, -(-talks.count() // block_rows)))
    talks = talks.repartitionByRange(wanted, "key", "conv_id").sortWithinPartitions("key", "conv_id")

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lengths, shared, sizes = [], [], [], []
        first = last = None
        for batch in batches:
            ids.append(batch.column(0).to_numpy(zero_copy_only=False))
            sizes.append(batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.int32))
            keys = batch.column(1).to_pylist()
            lengths.append(np.array([len(key) // DIGEST for key in keys], np.int32))
            first = keys[0] if first is None and keys else first
            befores = [last if last is not None else b"", *keys]
            shared.append(np.array([common_turns(a, b) for a, b in zip(befores, keys)], np.int32))
            last = keys[-1] if keys else last
        if last is None:
            return
        shared = np.concatenate(shared)
        interior = int(shared[1:].min()) if len(shared) > 1 else 2**31 - 1
        lists = [np.concatenate(ids), np.concatenate(lengths), shared, np.concatenate(sizes)]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32()]
        number = pa.array([TaskContext.get().partitionId()], pa.int32())
        arrays = [pa.array([values], pa.list_(kind)) for values, kind in zip(lists, kinds)]
        ends = [pa.array([first], pa.binary()), pa.array([last], pa.binary()), pa.array([interior], pa.int32())]
        names = ["block", "ids", "lengths", "shared", "sizes", "first", "last", "interior"]
        yield pa.RecordBatch.from_arrays([number, *arrays, *ends], names)

    shape = (
        "block int, ids array<bigint>, lengths array<int>, shared array<int>, sizes array<int>, "
        "first binary, last binary, interior int"
    )
    return stored(talks.select("conv_id", "key", "sizes").mapInArrow(block, shape), "trie-blocks")


def known_blocks(blocks: DataFrame) -> Blocks:
    """The edges of all blocks: keys meet in one task a pair at a time, numbers come back."""
    edges = blocks.select("block", "first", "last", "interior").coalesce(1).sortWithinPartitions("block")

    def edge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            for row in batch.to_pylist():
                shared = -1 if before is None else common_turns(before, row["first"])
                found = {"block": row["block"], "edge": shared, "least": min(shared, row["interior"])}
                yield pa.RecordBatch.from_pylist([found | {"copied": before == row["first"]}], schema)
                before = row["last"]

    schema = pa.schema([("block", pa.int32()), ("edge", pa.int32()), ("least", pa.int32()), ("copied", pa.bool_())])
    rows = sorted(edges.mapInArrow(edge, "block int, edge int, least int, copied boolean").collect())
    columns = list(zip(*rows)) or [(), (), (), ()]
    kinds = (np.int64, np.int64, np.int64, bool)
    return Blocks(*(np.array(values, kind) for values, kind in zip(columns, kinds)))


def _sums(values: np.ndarray) -> np.ndarray:
    """Prefix sums with a 0 in front."""
    return np.concatenate([np.zeros(1, np.int64), np.cumsum(values, dtype=np.int64)])


def block_prefixes(row: dict, known: Blocks) -> dict[str, list]:
    """All prefixes that first appear in a block, and its pieces of earlier ones, as columns.

    A row has a state: ``closed`` (whole), ``open`` (goes on in the next block) or
    ``piece``. The latter two name the block and depth of the prefix (owner, depth). A
    parent is known by its smallest member or, where it is not whole here, by its owner.
    """
    at = int(np.searchsorted(known.numbers, row["block"]))
    ids, lengths = np.asarray(row["ids"], np.int64), np.asarray(row["lengths"], np.int64)
    lcp = np.asarray(row["shared"], np.int64)
    lcp[0] = known.edge[at]
    is_last = at + 1 == len(known.numbers)
    next_lcp = -1 if is_last else int(known.edge[at + 1])
    n = len(ids)
    sizes = _sums(np.asarray(row["sizes"], np.int64))
    offset = _sums(lengths)[:-1]

    def size_up_to(place: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Code points of the first ``depth`` turns."""
        return sizes[offset[place] + np.maximum(depth, 0)] - sizes[offset[place]]

    table, least_id = SparseMin(lcp), SparseMin(ids)
    after = np.append(lcp[1:], next_lcp)
    leaves = _sums(after < lengths)
    shared_size = _sums(size_up_to(np.arange(n), lcp))
    copied = np.zeros(n, bool)
    copied[1:] = (lcp[1:] == lengths[1:]) & (lengths[1:] == lengths[:-1])
    copied[0] = bool(known.copied[at])
    # Last conversation of the run of copies that each one is in.
    stops = np.flatnonzero(~np.append(copied[1:], False))
    run_end = stops[np.searchsorted(stops, np.arange(n))]

    # Candidates: a prefix is met first at the place behind whose LCP it reaches.
    new = np.maximum(lengths - lcp, 0)
    place = np.repeat(np.arange(n), new)
    rank = np.arange(len(place)) - np.repeat(_sums(new)[:-1], new)
    depth = lcp[place] + 1 + rank
    right = table.right_end(place, depth)
    open_right = (right == n - 1) & (next_lcp >= depth)

    # Where a branch leaves: its parent's interval, searched from the branch to both sides.
    branch = np.flatnonzero(new > 0)
    branch = branch[lcp[branch] >= 0]
    joint = lcp[branch]
    p_left = table.left_end(branch, joint)
    from_left = (p_left == 0) & (lcp[0] >= joint)
    p_right = table.right_end(branch, joint)
    p_open = from_left | ((p_right == n - 1) & (next_lcp >= joint))
    owners = np.full(len(branch), at)
    if from_left.any():
        owners[from_left] = known.owner(at, joint[from_left])

    first_of = np.full(n, -1)
    first_of[np.flatnonzero(new > 0)] = _sums(new)[:-1][new > 0]
    children = (lengths[place] > depth).astype(np.int64)
    inner = ~from_left
    np.add.at(children, first_of[p_left[inner]] + joint[inner] - lcp[p_left[inner]] - 1, 1)

    smallest = least_id.least(place, right) if len(place) else ids[:0]
    parent = np.roll(smallest, 1) if len(place) else smallest
    parent_open = np.roll(open_right, 1) if len(place) else open_right
    parent_owner = np.full(len(place), at)
    heads = first_of[branch]
    if len(branch):
        parent[heads] = least_id.least(p_left, p_right)
        parent_open[heads] = p_open
        parent_owner[heads] = owners
    saved = shared_size[right + 1] - shared_size[place + 1] - (right - place) * size_up_to(place, depth - 1)
    ends = [_ids(ids[p : run_end[p] + 1]) if lengths[p] == d else "" for p, d in zip(place, depth)]

    # Pieces of prefixes from blocks before, one for each depth of the edge.
    deep = np.arange(0, max(int(lcp[0]), -1) + 1)
    zero = np.zeros(len(deep), np.int64)
    reach = table.right_end(zero, deep)
    grown = np.bincount(joint[from_left], minlength=len(deep))[: len(deep)] if len(deep) else zero
    piece_saved = shared_size[reach + 1] - (reach + 1) * size_up_to(zero, deep - 1)
    piece_ends = [_ids(ids[: run_end[0] + 1]) if copied[0] and d == lengths[0] else "" for d in deep]

    count, pieces = len(place), len(deep)
    return {
        "block": [int(row["block"])] * (count + pieces),
        "state": [*np.where(open_right, "open", "closed").tolist(), *["piece"] * pieces],
        "owner": [*[at] * count, *(known.owner(at, deep).tolist() if pieces else [])],
        "depth": [*depth.tolist(), *deep.tolist()],
        "conv_id": [*smallest.tolist(), *(least_id.least(zero, reach).tolist() if pieces else [])],
        "n_convs": [*(right - place + 1).tolist(), *(reach + 1).tolist()],
        "n_children": [*children.tolist(), *grown.tolist()],
        "n_leaves": [*(leaves[right + 1] - leaves[place]).tolist(), *leaves[reach + 1].tolist()],
        "saved_tokens": [*saved.tolist(), *piece_saved.tolist()],
        # Whole lists become digests here; the others are hashed when all parts have come.
        "ends": [
            *(hashlib.sha256(e.encode()).hexdigest() if not o else e for e, o in zip(ends, open_right)),
            *piece_ends,
        ],
        "parent": [None if d == 0 or o else p for p, d, o in zip(parent.tolist(), depth.tolist(), parent_open)] + [None] * pieces,
        "parent_owner": [None if d == 0 or not o else w for w, d, o in zip(parent_owner.tolist(), depth.tolist(), parent_open)] + [None] * pieces,
    }


def _ids(ids: np.ndarray) -> str:
    return ",".join(map(str, ids.tolist()))


_PREFIX_TYPES = {
    "block": pa.int32(), "state": pa.string(), "owner": pa.int32(), "depth": pa.int64(),
    **{name: pa.int64() for name in _NUMBERS},
    "ends": pa.string(), "parent": pa.int64(), "parent_owner": pa.int32(),
}
_PREFIX_SHAPE = (
    "block int, state string, owner int, depth bigint, "
    + ", ".join(f"{name} bigint" for name in _NUMBERS)
    + ", ends string, parent bigint, parent_owner int"
)


def _prefixes(blocks: DataFrame, known: Blocks) -> DataFrame:
    schema = pa.schema(list(_PREFIX_TYPES.items()))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {
                    "block": batch.column("block")[i].as_py(),
                    **{k: batch.column(k)[i].values.to_numpy().copy() for k in ("ids", "lengths", "shared", "sizes")},
                }
                yield pa.RecordBatch.from_pydict(block_prefixes(row, known), schema)

    columns = blocks.select("block", "ids", "lengths", "shared", "sizes")
    return stored(columns.mapInArrow(prefixes, _PREFIX_SHAPE), "trie-prefixes")


def _whole(parts: DataFrame) -> DataFrame:
    """Prefixes that span blocks, from their parts in order; lists of ids pass through as parts."""
    schema = pa.schema([(name, kind) for name, kind in _PREFIX_TYPES.items() if name != "state"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = whole = digest = None
        some = False

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([whole | {"ends": digest.hexdigest()}], schema)

        for batch in batches:
            for part in batch.to_pylist():
                if (part["owner"], part["depth"]) != key:
                    if whole is not None:
                        yield done()
                    key, whole, digest, some = (part["owner"], part["depth"]), dict(part), hashlib.sha256(), False
                    whole.pop("state")
                else:
                    whole["conv_id"] = min(whole["conv_id"], part["conv_id"])
                    for name in _NUMBERS[1:]:
                        whole[name] += part[name]
                if part["ends"]:
                    digest.update((("," if some else "") + part["ends"]).encode())
                    some = True
        if whole is not None:
            yield done()

    # The part that owns the prefix is in the lowest block, so it comes first.
    parts = parts.repartition("owner", "depth").sortWithinPartitions("owner", "depth", "block")
    shape = _PREFIX_SHAPE.replace("state string, ", "")
    return stored(parts.mapInArrow(merge, shape), "trie-open")


def prefix_trie(turns: DataFrame, shared: int = 5, family: int = 100, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per node of the trie of rebuilt conversations (see :func:`rebuilt`).

    ``turns`` needs conv_id, turn, role and text; other columns are ignored. Null roles
    and texts are empty; rows without a conv_id belong to no conversation and are left
    out; repeated rows are turns of their own; turns of one number go by the digest of
    role and text. A conversation left without turns is a member of the root. An empty
    table has no node, not even a root. The ids that end in a node are hashed in one
    pass over parts of a block each, so a node with a third of all conversations needs
    no task to hold them.
    """
    blocks = sorted_blocks(rebuilt(turns, shared, family), block_rows)
    known = known_blocks(blocks)
    found = _prefixes(blocks, known)
    whole = _whole(found.where("state <> 'closed'"))
    closed = found.where("state = 'closed'").drop("state")
    known_parents = whole.select(
        F.col("owner").alias("parent_owner"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("open_parent")
    )
    # At most (longest common prefix) rows a block.
    nodes = closed.unionByName(whole).join(if_small(known_parents), ["parent_owner", "depth"], "left")
    return nodes.select(
        "conv_id",
        "depth",
        F.coalesce("parent", "open_parent").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.col("ends").alias("ends_sha256"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(read_table(spark, sf_dir, "conversations"))


SQL = f"""
WITH {CRC_TABLE},
own AS (
  SELECT conv_id, size, digest, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest, size) AS p
  FROM (SELECT conv_id, turn, length(coalesce(text, '')) AS size, substr(sha256(octet_length(encode(coalesce(role, '')))
    || ':' || coalesce(role, '') || coalesce(text, '')), 1, {2 * DIGEST}) AS digest
    FROM conversations WHERE conv_id IS NOT NULL)),
ids AS (
  SELECT conv_id, n, conv_id - conv_id % 100 AS base, {crc32_sql("conv_id::VARCHAR")} % 6 AS h
  FROM (SELECT conv_id, count(*) AS n FROM own GROUP BY conv_id), crc),
turns AS (
  SELECT i.conv_id, o.p AS d, o.digest, o.size FROM ids i JOIN own o ON o.conv_id = i.base AND o.p <= i.h
  UNION ALL
  SELECT i.conv_id, least(i.h, coalesce(b.n, 0)) + o.p - i.h, o.digest, o.size
  FROM ids i JOIN own o ON o.conv_id = i.conv_id AND o.p > i.h LEFT JOIN ids b ON b.conv_id = i.base),
paths AS (
  SELECT conv_id, d, size, sha256(string_agg(digest, '') OVER (PARTITION BY conv_id ORDER BY d)) AS node FROM turns
  UNION ALL SELECT conv_id, 0, 0, '' FROM ids),
ended AS (SELECT *, d = max(d) OVER (PARTITION BY conv_id) AS ends FROM paths),
nodes AS (
  SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size, bool_and(ends) AS leaf,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM ended GROUP BY node, d),
linked AS (
  SELECT n.*, p.node AS parent, q.conv_id AS parent_conv_id FROM nodes n
  LEFT JOIN paths p ON p.conv_id = n.conv_id AND p.d = n.d - 1 LEFT JOIN nodes q ON q.node = p.node),
below AS (
  SELECT p.node, sum((n.n_convs - 1) * n.size)::BIGINT AS saved_tokens, sum(n.leaf::INT)::BIGINT AS n_leaves
  FROM nodes n JOIN paths p ON p.conv_id = n.conv_id AND p.d <= n.d GROUP BY p.node),
grown AS (SELECT parent, count(*) AS n FROM linked WHERE parent IS NOT NULL GROUP BY parent)
SELECT l.conv_id, l.d::BIGINT AS depth, l.parent_conv_id, l.n_convs, coalesce(g.n, 0)::BIGINT AS n_children,
  b.n_leaves, b.saved_tokens, l.ends_sha256
FROM linked l JOIN below b ON b.node = l.node LEFT JOIN grown g ON g.parent = l.node
"""
