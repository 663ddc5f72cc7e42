"""Operators 11, 12, 13 on small tables, against plain Python."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from llm_tables import COLUMNS, EDGES, edges, no_docs  # noqa: F401
from pyspark.sql import functions as F

from tripflow.llm import conversation_trie, merkle, sketch

TURNS = "conv_id long, turn long, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def crc(number):
    return zlib.crc32(str(number).encode())


# --- conversations -------------------------------------------------------------


def plain_trie(rows):
    """The nodes by writing every prefix down."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = sha(f"{len(role.encode())}:{role}{text}")[:32]
            own.setdefault(c, []).append((turn is not None, turn or 0, digest, role, text))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    members, ends = {}, {}
    for c, turns in own.items():
        h = crc(c) % 6
        talk = tuple(own.get(c - int(np.fmod(c, 100)), [])[:h] + turns[h:])
        for d in range(len(talk) + 1):
            members.setdefault(talk[:d], []).append(c)
        ends.setdefault(talk, []).append(c)
    result = []
    for node, who in members.items():
        below = [other for other in members if other[: len(node)] == node]
        grown = [other for other in below if len(other) == len(node) + 1]
        leaves = [o for o in below if not any(len(x) == len(o) + 1 and x[: len(o)] == o for x in below)]
        saved = sum((len(members[o]) - 1) * len(o[-1][1]) for o in below if o)
        last = sha(",".join(map(str, sorted(ends.get(node, [])))))
        up = min(members[node[:-1]]) if node else None
        result.append((min(who), len(node), up, len(who), len(grown), len(leaves), saved, last))
    return sorted(result, key=repr)


def trie_rows(spark, rows, **options):
    found = conversation_trie.prefix_trie(spark.createDataFrame(rows, TURNS), **options)
    return sorted(map(tuple, found.collect()), key=repr)


@pytest.mark.parametrize("block_rows", [2, 7, 1000])
def test_trie_equals_written_prefixes(spark, block_rows):
    random.seed(11)
    rows = []
    for c in [*range(60), *range(100, 130), 205, 307, -4, -103]:
        # Families agree for some turns, then part; many are copies of others.
        for turn in range(random.choice([0, 1, 3, 6, 7])):
            text = f"t{turn}" if random.random() < 0.8 else random.choice(["x", "é\U0001f600", "", None])
            rows.append((c, turn, random.choice(["user", "user", None]), text))
    rows += [(c, None, "user", "before all") for c in (3, 5)]
    rows += [(9, 2, "user", "twice")] * 2 + [(None, 0, "user", "nobody's")]
    assert trie_rows(spark, rows, block_rows=block_rows) == plain_trie(rows)


def test_trie_of_copies_over_many_blocks(spark):
    """A third and more of all conversations are one, and one more turn follows in some."""
    rows = [(c, t, "u", f"same {t}") for c in range(300, 380) for t in range(6)]
    rows += [(c, 6, "u", "more") for c in range(340, 380, 3)]
    rows += [(c, 0, "u", f"other {c}") for c in range(700, 720)]
    assert trie_rows(spark, rows, block_rows=5) == plain_trie(rows)


def test_trie_edges(spark):
    assert trie_rows(spark, [(None, 1, "u", "t")]) == []
    assert trie_rows(spark, []) == []
    # A base without turns of its own leaves its family turnless where all turns are its head.
    alone = next(c for c in range(1, 100) if crc(c) % 6 == 5)
    rows = [(alone, 0, "u", "gone")]
    assert trie_rows(spark, rows) == plain_trie(rows) == [(alone, 0, None, 1, 0, 1, 0, sha(str(alone)))]
    long = [(7, t, "u", "word " * 500) for t in range(400)] + [(8, t, "u", "word " * 500) for t in range(401)]
    assert trie_rows(spark, long, block_rows=1) == plain_trie(long)
    clash = spark.createDataFrame([(1, 0, "u", "t", 1, 2, "k")], f"{TURNS}, block int, depth int, key string")
    assert conversation_trie.prefix_trie(clash).count() == len(plain_trie([(1, 0, "u", "t")]))


def test_sparse_minima():
    random.seed(3)
    values = np.array([random.randrange(5) for _ in range(37)])
    table = conversation_trie.SparseMin(values)
    for start in range(37):
        for depth in range(6):
            right = start
            while right + 1 < 37 and values[right + 1] >= depth:
                right += 1
            left = start
            while left > 0 and values[left] >= depth:
                left -= 1
            at, by = np.array([start]), np.array([depth])
            assert (table.left_end(at, by)[0], table.right_end(at, by)[0]) == (left, right)
            assert table.least(np.array([left]), np.array([right]))[0] == values[left : right + 1].min()


# --- fingerprints --------------------------------------------------------------


def plain_print(text, n=5, digits=12):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    parts = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = {hashlib.md5(p.encode()).hexdigest() for p in parts}
    kept = sorted({h[:digits] for h in hashes if h < "40000000"})
    if words and not kept:
        return "~" + hashlib.md5(" ".join(words).encode()).hexdigest()[:digits]
    return ",".join(kept)


def plain_likeness(a, b):
    a, b = set(a.split(",")), set(b.split(","))
    return len(a & b) / min(len(a), len(b))


def plain_fingerprints(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    result = []
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        own, new, other = plain_print(text), plain_print(edited), plain_print(following)
        result.append((i, len(text), sha(edited), own, new, plain_likeness(own, new), plain_likeness(own, other)))
    return sorted(result, key=repr)


@pytest.mark.parametrize("run_rows", [1, 3, 1000])
def test_fingerprints(spark, edges, run_rows):
    random.seed(12)
    some = [(i, " ".join(random.choice("abc") for _ in range(random.randrange(60)))) for i in range(20, 60, 2)]
    some += [(-5, "One more TEXT, of some words"), (2**62, "one more text, of some words"), (2**62, "again")]
    docs = edges.select("doc_id", "text").union(spark.createDataFrame(some, "doc_id long, text string"))
    rows = [tuple(r) for r in docs.collect()]
    docs = docs.withColumns({name: F.lit(1) for name in ("run", "copy", "place", "next_text", "fingerprint")})
    found = sketch.fingerprints(docs, run_rows=run_rows)
    assert sorted(map(tuple, found.collect()), key=repr) == plain_fingerprints(rows)


def test_fingerprints_of_tiny_tables(spark, no_docs):
    assert sketch.fingerprints(no_docs).count() == 0
    one = spark.createDataFrame([(4, "a b c d e f")], "doc_id long, text string")
    row = sketch.fingerprints(one, run_rows=1).first()
    assert row.near_next == 1.0 and row.edited_sha256 == sha("a b c " + "a b c")
    nulls = spark.createDataFrame([(None, None), (None, "x")], "doc_id long, text string")
    assert sorted(map(tuple, sketch.fingerprints(nulls).collect()), key=repr) == plain_fingerprints([(None, None), (None, "x")])


def test_sketches_merge_and_contain(spark):
    """A small part of a long text is found in it, and two sketches' union is the union's sketch."""
    random.seed(13)
    long = [f"w{random.randrange(10**6)}" for _ in range(8000)]
    part, alien = long[3000:3400], [f"v{k}" for k in range(400)]
    texts = [" ".join(t) for t in (long, part, alien, long[:4004], long[4000:])]
    docs = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    whole, part, alien, left, right = [
        r[0] for r in docs.orderBy("i").select(sketch.fingerprint(F.col("text"))).collect()
    ]
    names = ("whole", "part", "alien", "left", "right")
    row = spark.createDataFrame([(whole, part, alien, left, right)], ", ".join(f"{n} string" for n in names))
    found = row.select(
        sketch.containment(F.col("part"), F.col("whole")).alias("inside"),
        sketch.containment(F.col("whole"), F.col("part")).alias("outside"),
        sketch.likeness(F.col("alien"), F.col("whole")).alias("alien"),
        sketch.merged(F.col("left"), F.col("right")).alias("merged"),
    ).first()
    assert found.inside == 1.0 and found.alien == 0.0
    assert found.outside == pytest.approx(396 / 7996, abs=0.01)
    assert found.merged == whole
    assert len(whole.split(",")) == pytest.approx(7996 / 4, rel=0.1)


# --- manifest ------------------------------------------------------------------


def plain_tree(leaves, fanout=3):
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i : i + fanout])) for i in range(0, len(last), fanout)])
    paths = []
    for place in range(len(leaves)):
        path = []
        for level in levels[:-1]:
            start = place - place % fanout
            path.append((level[start:place], level[place + 1 : start + fanout]))
            place //= fanout
        paths.append(path)
    return levels[-1][0], paths


def plain_leaf(row):
    """The digest of (doc_id, text, lang, source, n_chars)."""
    i, text, lang, source, n = row
    values = (str(v) if v is not None else None for v in (i, source, lang, n, text))
    return sha("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def plain_manifest(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[3], []).append((row[0] is not None, row[0] or 0, plain_leaf(row), row))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for name in names:
        groups[name].sort(key=lambda leaf: leaf[:3])
        trees.append(plain_tree([leaf[2] for leaf in groups[name]]))
    root, tops = plain_tree([tree[0] for tree in trees])
    result = []
    for name, (subroot, paths), top in zip(names, trees, tops):
        for (_, _, leaf, row), path in zip(groups[name], paths):
            path = path + top
            i, text, *rest = row
            if zlib.crc32(("" if i is None else str(i)).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            reached = plain_leaf((i, text, *rest))
            for left, right in path:
                reached = sha("".join([*left, reached, *right]))
            proof = sha("".join("".join(left + right) for left, right in path))
            result.append((i, leaf, subroot, root, proof, reached, reached == root))
    return sorted(result, key=repr)


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_manifest(spark, edges, levels):
    random.seed(14)
    more = [(i, random.choice(["a\nb", "c", None, "é\n"]), "en", random.choice(["big"] * 9 + ["a", "z"]), 3) for i in range(10, 90)]
    rows = EDGES + more
    docs = spark.createDataFrame(rows, COLUMNS)
    docs = docs.withColumns({name: F.lit("x") for name in ("grp", "place", "block", "digest", "tie", "part", "found")})
    found = merkle.manifest(docs, tampered=merkle.without_line_ends, levels=levels)
    assert sorted(map(tuple, found.collect()), key=repr) == plain_manifest(rows)


@pytest.mark.parametrize("count", [1, 2, 3, 4, 9, 10, 28])
def test_manifest_of_one_source(spark, count):
    rows = [(i, f"t{i}\n", "en", None, 3) for i in range(count)]
    found = merkle.manifest(spark.createDataFrame(rows, COLUMNS), tampered=merkle.without_line_ends, levels=1)
    assert sorted(map(tuple, found.collect()), key=repr) == plain_manifest(rows)


def test_manifest_of_nothing_and_of_an_untouched_table(spark, edges, no_docs):
    assert merkle.manifest(no_docs, tampered=merkle.without_line_ends).count() == 0
    assert merkle.manifest(edges).where("verified").count() == len(EDGES)


@pytest.mark.parametrize("tampered", [None, merkle.without_line_ends])
def test_unchanged_leaves_are_folded_too(spark, monkeypatch, tampered):
    """A false sibling in a proof is found by rows whose own leaf is as it was."""
    docs = spark.createDataFrame([(i, "a b", "en", "web", 3) for i in range(20)], COLUMNS)
    sound = merkle.manifest(docs, tampered=tampered, levels=1).collect()
    assert len(sound) == 20 and all(r.verified for r in sound)

    butterfly = merkle.butterfly

    def bent(blocks, fanout):
        return butterfly(blocks, fanout).withColumn("rights", F.transform("rights", lambda r: F.concat(r, F.lit("0"))))

    monkeypatch.setattr(merkle, "butterfly", bent)
    rows = merkle.manifest(docs, tampered=tampered, levels=1).collect()
    assert {r.root for r in rows} == {r.root for r in sound}
    assert len(rows) == 20 and not any(r.verified or r.folded_root == r.root for r in rows)
