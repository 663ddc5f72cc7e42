"""A Merkle tree over a table, with a proof for each row (operator 13).

Each row is a leaf. The leaves of a group (a source), in order, are cut into aligned
blocks of fanout^levels leaves; a task hashes a block's subtree by itself. Above the
blocks there is no tree to walk down: round by round, the blocks of an aligned group
swap the roots of their subtrees in the manner of a butterfly. A block asks one block
of each sibling subtree, that of its own place in it, hashes the parent itself, and
notes the siblings. After log(blocks) rounds every block has the root of its group
and the upper part of the proofs of its leaves, so its leaves finish in one pass. The
roots of the groups are leaves of a second tree that is built the same way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripflow.llm.common import if_small, read_table, remainder, stored
from tripflow.llm.crc_sql import CRC_TABLE, crc32_sql

FANOUT = 3
#: Levels of the tree that one task hashes: a block has fanout^levels leaves.
LEVELS = 7


def field(column: str) -> Column:
    """``-`` for null, else the length of the value's UTF-8 bytes, a colon, and the value."""
    text = F.col(column).cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def digest_of(columns: Sequence[str]) -> Column:
    return F.sha2(F.concat(*map(field, columns)), 256)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def tree_of(leaves: list[str], fanout: int, levels: int | None) -> list[list[str]]:
    """The levels of a tree from its leaves up: ``levels`` of them, or until one node is left."""
    tree = [leaves]
    while len(tree) <= levels if levels is not None else len(tree[-1]) > 1:
        last = tree[-1]
        tree.append([_sha("".join(last[i : i + fanout])) for i in range(0, len(last), fanout)])
    return tree


def siblings(level: list[str], place: int, fanout: int) -> tuple[str, str]:
    """The digests of a node's run before and behind it, each joined."""
    start = place - place % fanout
    return "".join(level[start:place]), "".join(level[place + 1 : start + fanout])


def folded(digest: str, path: Sequence[tuple[str, str]]) -> str:
    """The root that a digest and the siblings beside it, level by level, lead to."""
    for left, right in path:
        digest = _sha(left + digest + right)
    return digest


def placed(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Adds ``place``: 0, 1, ... within the group, in the given order, nulls first.

    A range sort deals the rows over the tasks, a large group over many; a task numbers
    its rows of each group, and prefix sums of the tasks' counts (one row per task and
    group) do the rest. Rows that agree in the order are dealt by where they are read.
    """
    rows = rows.withColumn("tie", F.monotonically_increasing_id())
    keys = [F.col(name).asc_nulls_first() for name in (group, *order, "tie")]
    sorted_rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("tie")
    at = sorted_rows.columns.index(group)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, count = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            places = []
            for name in batch.column(at).to_pylist():
                count = 0 if name != last else count + 1
                last = name
                places.append(count)
            more = [pa.array([part] * len(places), pa.int32()), pa.array(places, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "part", "nth"])

    shape = ", ".join(f"`{name}` {kind}" for name, kind in sorted_rows.dtypes)
    numbered = stored(sorted_rows.mapInArrow(number, f"{shape}, part int, nth bigint"), "placed")
    counts = numbered.groupBy(group, "part").agg(F.count("*").alias("rows"))
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    total = Window.partitionBy(group)
    starts = counts.select(
        group,
        "part",
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"),
        F.sum("rows").over(total).alias("group_rows"),
    )
    joined = numbered.join(if_small(stored(starts, "starts")), [group, "part"])
    return joined.withColumn("place", F.col("start") + F.col("nth")).drop("part", "nth", "start")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of one (group, block) at a time; those of a block follow each other."""
    key, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if (row["grp"], row["block"]) != key:
                if rows:
                    yield rows
                key, rows = (row["grp"], row["block"]), []
            rows.append(row)
    if rows:
        yield rows


def _tables(rows: Iterator[dict], schema: pa.Schema, size: int = 2_000) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _inner_levels(rows: int, size: int, levels: int) -> int | None:
    """Levels to climb in a block: all of the block's where the group has others, else to its root."""
    return levels if rows > size else None


def block_roots(leaves: DataFrame, fanout: int, levels: int) -> DataFrame:
    """(grp, block, n_blocks, root) from leaves (grp, place, group_rows, digest)."""
    size = fanout**levels
    schema = pa.schema([("grp", pa.string()), ("block", pa.int64()), ("n_blocks", pa.int64()), ("root", pa.string())])

    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[dict]:
            for rows in _blocks(batches):
                head = rows[0]
                tree = tree_of([r["digest"] for r in rows], fanout, _inner_levels(head["group_rows"], size, levels))
                n_blocks = -(-head["group_rows"] // size)
                yield {"grp": head["grp"], "block": head["block"], "n_blocks": n_blocks, "root": tree[-1][0]}

        yield from _tables(each(), schema)

    rows = leaves.select("grp", F.floor(F.col("place") / size).alias("block"), "place", "group_rows", "digest")
    rows = rows.repartition("grp", "block").sortWithinPartitions("grp", "block", "place")
    return rows.mapInArrow(roots, "grp string, block bigint, n_blocks bigint, root string")


def butterfly(blocks: DataFrame, fanout: int) -> DataFrame:
    """(grp, block, lefts, rights, root): each block's path to the root of its group.

    In round j a block that has place q in its subtree of fanout^j blocks asks block q
    of each sibling subtree for its root; where the last subtree is short, block
    q modulo its length. All blocks know the same root of a subtree, so any would do;
    this one spreads the questions evenly. Each round is written.
    """
    empty = F.lit([]).cast("array<string>")
    blocks = stored(blocks.select("*", empty.alias("lefts"), empty.alias("rights")), "butterfly")
    most = blocks.agg(F.max("n_blocks")).first()[0] or 0
    width = 1
    while width < most:
        tree = F.floor(F.col("block") / width)
        first = tree - tree % fanout
        sibling = F.explode(F.filter(
            F.transform(F.sequence(F.lit(0), F.lit(fanout - 1)), lambda k: first + k),
            lambda s: (s != tree) & (s * width < F.col("n_blocks")),
        ))
        asking = blocks.where(F.col("n_blocks") > width).select("grp", "block", "n_blocks", tree.alias("tree"), sibling.alias("other"))
        length = F.least(F.lit(width), F.col("n_blocks") - F.col("other") * width)
        asked = F.col("other") * width + (F.col("block") - F.col("tree") * width) % length
        asking = asking.select("grp", "block", "tree", "other", asked.alias("asked"))
        told = blocks.select("grp", F.col("block").alias("asked"), F.col("root").alias("other_root"))
        # At most fanout - 1 answers a block.
        answers = asking.join(told, ["grp", "asked"]).groupBy("grp", "block").agg(
            F.array_sort(F.collect_list(F.struct("other", "other_root"))).alias("others"),
            F.first("tree").alias("tree"),
        )

        def side(before: bool) -> Column:
            picked = F.filter("others", lambda o: o.other < F.col("tree") if before else o.other > F.col("tree"))
            return F.coalesce(F.array_join(F.transform(picked, lambda o: o.other_root), ""), F.lit(""))

        sides = answers.select("grp", "block", side(True).alias("left"), side(False).alias("right"))
        climbs = F.col("n_blocks") > width
        left, right = F.coalesce("left", F.lit("")), F.coalesce("right", F.lit(""))
        blocks = blocks.join(sides, ["grp", "block"], "left").select(
            "grp",
            "block",
            "n_blocks",
            F.when(climbs, F.sha2(F.concat(left, "root", right), 256)).otherwise(F.col("root")).alias("root"),
            F.when(climbs, F.array_append("lefts", left)).otherwise(F.col("lefts")).alias("lefts"),
            F.when(climbs, F.array_append("rights", right)).otherwise(F.col("rights")).alias("rights"),
        )
        blocks = stored(blocks, "butterfly")
        width *= fanout
    return blocks.select("grp", "block", "lefts", "rights", "root")


def leaf_rows(
    leaves: DataFrame,
    upper: DataFrame,
    carried: Sequence[str],
    shape: str,
    schema: pa.Schema,
    finish: Callable[[dict, dict, str, list[tuple[str, str]], Callable[[], list]], dict],
    fanout: int,
    levels: int,
) -> DataFrame:
    """One finished row per leaf.

    ``upper`` has a row per block (grp, block, lefts, rights, and more), which comes to
    the task ahead of the block's leaves. ``finish`` gets that row, the leaf, the joined
    siblings up to the top, the upper path, and a function that gives the lower one.
    """
    size = fanout**levels

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[dict]:
            for head, *rows in _blocks(batches):
                path = list(zip(head["lefts"], head["rights"]))
                tree = tree_of([r["digest"] for r in rows], fanout, _inner_levels(rows[0]["group_rows"], size, levels))
                # Siblings of each node and of all above it, from the top down.
                above = ["".join(left + right for left, right in path)]
                for level in reversed(tree[:-1]):
                    above = ["".join(siblings(level, i, fanout)) + above[i // fanout] for i in range(len(level))]

                def lower(i: int) -> list[tuple[str, str]]:
                    return [siblings(level, i // fanout**k, fanout) for k, level in enumerate(tree[:-1])]

                for i, row in enumerate(rows):
                    yield finish(head, row, above[i], path, lambda: lower(i))

        yield from _tables(each(), schema)

    rows = leaves.withColumn("block", F.floor(F.col("place") / size))
    rows = rows.select("grp", "block", "place", "group_rows", "digest", *carried)
    heads = upper.withColumn("place", F.lit(-1).cast("long"))
    both = heads.unionByName(rows, allowMissingColumns=True)
    both = both.repartition("grp", "block").sortWithinPartitions("grp", "block", "place")
    return both.mapInArrow(finished, shape)


def _group_key(column: str) -> Column:
    """Orders like the value, null first, and is never null."""
    return F.when(F.col(column).isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col(column).cast("string")))


def manifest(
    docs: DataFrame,
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    tampered: Callable[[DataFrame], DataFrame] | None = None,
    fanout: int = FANOUT,
    levels: int = LEVELS,
) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) per row of ``docs``.

    ``docs`` needs doc_id, source and ``columns``; others are ignored. Within a source
    (null is one, the first) leaves ascend by doc_id, null first, rows of one id by
    digest; equal rows are interchangeable and each is a leaf. ``tampered`` maps the
    table to one as it may be found later; the proof of every row, changed or not, is
    folded from the leaf found there and the siblings of the true tree, and is verified
    if that gives the true root. An empty table has no rows, hence no root.
    """
    true = docs.withColumn("__leaf", digest_of(columns))
    found = true if tampered is None else tampered(true)
    leaves = found.select(
        _group_key("source").alias("grp"),
        F.col("doc_id"),
        F.col("__leaf").alias("digest"),
        digest_of(columns).alias("found"),
    )
    # Texts are read here and never again; the sort samples what is written.
    leaves = placed(stored(leaves, "leaves"), "grp", ["doc_id", "digest"])
    lower = butterfly(block_roots(leaves, fanout, levels), fanout)

    tops = lower.where("block = 0").select(F.lit("").alias("top"), "grp", F.col("root").alias("digest"))
    tops = placed(tops, "top", ["grp"]).select(F.col("top").alias("grp"), F.col("grp").alias("member"), "digest", "group_rows", "place")
    upper = butterfly(block_roots(tops, fanout, levels), fanout)

    def path_of(head, row, above, path, below):
        steps = below() + path
        return {
            "grp": row["member"],
            "subroot": row["digest"],
            "top_lefts": [left for left, _ in steps],
            "top_rights": [right for _, right in steps],
            "top_root": head["root"],
        }

    texts = pa.list_(pa.string())
    top_schema = pa.schema([("grp", pa.string()), ("subroot", pa.string()), ("top_lefts", texts), ("top_rights", texts), ("top_root", pa.string())])
    top_shape = "grp string, subroot string, top_lefts array<string>, top_rights array<string>, top_root string"
    paths = leaf_rows(tops, upper, ["member"], top_shape, top_schema, path_of, fanout, levels)

    # One row per block and one per source: small beside the leaves.
    heads = lower.drop("root").join(if_small(stored(paths, "paths")), "grp").select(
        "grp",
        "block",
        F.concat("lefts", "top_lefts").alias("lefts"),
        F.concat("rights", "top_rights").alias("rights"),
        "subroot",
        F.col("top_root").alias("root"),
    )

    def proof_of(head, row, above, path, below):
        root = head["root"]
        reached = folded(row["found"], below() + path)
        return {
            "doc_id": row["doc_id"],
            "leaf": row["digest"],
            "subroot": head["subroot"],
            "root": root,
            "proof_sha256": _sha(above),
            "folded_root": reached,
            "verified": reached == root,
        }

    names = ("leaf", "subroot", "root", "proof_sha256", "folded_root")
    schema = pa.schema([("doc_id", pa.int64()), *((n, pa.string()) for n in names), ("verified", pa.bool_())])
    shape = "doc_id bigint, " + ", ".join(f"{n} string" for n in names) + ", verified boolean"
    leaves = leaves.withColumn("doc_id", F.col("doc_id").cast("long"))
    return leaf_rows(leaves, heads, ["doc_id", "found"], shape, schema, proof_of, fanout, levels)


def without_line_ends(rows: DataFrame) -> DataFrame:
    """The texts of every other row, by a hash of its id, without their line ends."""
    hit = remainder("doc_id", 2) == 0
    return rows.withColumn("text", F.when(hit, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(read_table(spark, sf_dir, "documents"), tampered=without_line_ends)


def _field_sql(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::VARCHAR))::VARCHAR || ':' || {value}::VARCHAR, '-')"


def _tree_sql(name: str, rounds: int) -> str:
    """Common tables ``<name>0``, ... of a tree's levels and ``<name>s0``, ... with siblings."""
    steps = []
    for k in range(rounds):
        before = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
        behind = "ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING"
        run = "PARTITION BY grp, place // 3 ORDER BY place"
        steps.append(
            f"""{name}s{k} AS (SELECT *, coalesce(string_agg(digest, '') OVER ({run} {before}), '') AS l,
    coalesce(string_agg(digest, '') OVER ({run} {behind}), '') AS r FROM {name}{k}),
{name}{k + 1} AS (SELECT grp, place // 3 AS place, (any_value(n) + 2) // 3 AS n, CASE WHEN any_value(n) = 1
    THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY place)) END AS digest
  FROM {name}{k} GROUP BY grp, place // 3)"""
        )
    return ",\n".join(steps)


def _path_sql(name: str, rounds: int, leaf: str) -> tuple[list[str], str, list[str]]:
    """A leaf's path: the join of each level, its siblings joined, and the fold of ``cur`` at each level."""
    levels = [f"{name}s{k}" for k in range(rounds)]
    joins = [f"JOIN {s} ON {s}.grp = {leaf}.grp AND {s}.place = {leaf}.place // {3**k}" for k, s in enumerate(levels)]
    proof = " || ".join(f"{s}.l || {s}.r" for s in levels)
    folds = [f"CASE WHEN {s}.n > 1 THEN sha256({s}.l || cur || {s}.r) ELSE cur END" for s in levels]
    return joins, proof, folds


def _sql(leaf_rounds: int, source_rounds: int) -> str:
    """Enough for 3^leaf_rounds rows of a source and 3^source_rounds sources."""
    columns = ("doc_id", "source", "lang", "n_chars", "text")
    leaf = "sha256(" + " || ".join(map(_field_sql, columns)) + ")"
    hit = f"doc_id IS NULL OR {crc32_sql('doc_id::VARCHAR')} % 2 = 0"
    found = "sha256(" + " || ".join(_field_sql("found_text" if c == "text" else c) for c in columns) + ")"
    joins, proof, folds = _path_sql("a", leaf_rounds, "f")
    top_joins, top_proof, top_folds = _path_sql("b", source_rounds, "t")
    top = "JOIN b0 t ON t.member = f.grp"
    folding = [*zip(folds, joins), *((fold, f"{top} {join}") for fold, join in zip(top_folds, top_joins))]
    steps = [
        f"f{k + 1} AS (SELECT f.* EXCLUDE (cur), {fold} AS cur FROM f{k} f {join})"
        for k, (fold, join) in enumerate(folding)
    ]
    return f"""
WITH {CRC_TABLE},
texts AS (SELECT doc_id, source, lang, n_chars, text,
  CASE WHEN {hit} THEN replace(text, chr(10), '') ELSE text END AS found_text FROM documents, crc),
leaves AS (SELECT doc_id, coalesce('1' || source, '0') AS grp, {leaf} AS digest, {found} AS found FROM texts),
a0 AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, digest, found) - 1 AS place,
    count(*) OVER (PARTITION BY grp) AS n FROM leaves),
{_tree_sql("a", leaf_rounds)},
b0 AS (SELECT '' AS grp, grp AS member, digest, row_number() OVER (ORDER BY grp) - 1 AS place, count(*) OVER () AS n
  FROM a{leaf_rounds}),
{_tree_sql("b", source_rounds)},
f0 AS (SELECT doc_id, grp, place, digest, found AS cur FROM a0),
{", ".join(steps)},
proofs AS (SELECT f.doc_id, f.digest AS leaf, t.digest AS subroot, sha256({proof} || {top_proof}) AS proof_sha256, f.cur
  FROM f{len(steps)} f {" ".join(joins)} {top} {" ".join(top_joins)})
SELECT doc_id, leaf, subroot, digest AS root, proof_sha256, cur AS folded_root, cur = digest AS verified
FROM proofs, b{source_rounds}
"""


SQL = _sql(9, 4)
