"""Operators 2, 3, 7, 8, 10: edges, and accuracy on rows they have not learned from."""

import random
import re
import time

import numpy as np
from conftest import TESTDATA
from llm_tables import edges, few_labels, no_docs  # noqa: F401
from pyspark.sql import functions as F

from tripflow.llm import crf, lang_id, page_text, personal_data, quality_model, toxicity


def test_chain_matches_sums_over_all_labellings():
    import itertools

    rng = np.random.default_rng(1)
    scores, move = rng.normal(size=(5, 3)), rng.normal(size=(3, 3))
    total = {
        path: scores[range(5), path].sum() + sum(move[a, b] for a, b in zip(path, path[1:]))
        for path in itertools.product(range(3), repeat=5)
    }
    assert tuple(crf.viterbi(scores, move)) == max(total, key=total.get)
    weights = {p: np.exp(v) for p, v in total.items()}
    # The longer sequence beside it must not change the shorter one's sums.
    padded = np.stack([np.vstack([scores, np.zeros((3, 3))]), rng.normal(size=(8, 3))])
    cells = np.arange(8)[None, :] < np.array([5, 8])[:, None]
    ahead, behind = crf._sums(padded, move, cells)
    both = np.exp(ahead + behind)[0, :5]
    for t in range(5):
        for k in range(3):
            expected = sum(w for p, w in weights.items() if p[t] == k) / sum(weights.values())
            assert abs(both[t, k] / both[t].sum() - expected) < 1e-9


def test_gaps_equal_the_whole_chain():
    """Powers over plain words give what forward-backward over every word gives."""
    texts = [(" ".join(["calm"] * 5 + ["nasty"] + [f"w{k}{j}" for j in range(9)] + ["nasty"]), 1) for k in range(60)]
    texts += [(" ".join(f"w{k}{j}" for j in range(20)), 0) for k in range(60)]
    model = toxicity.Model(texts, 0.95, 32, 500)
    text = "calm calm nasty one two three nasty four"
    words = text.split()
    count, tokens = model.tokens(text)
    ids = {k: features for k, _, _, features in tokens}
    assert count == len(words)
    scores = np.array([model.chain.emit[ids.get(k, [0])].sum(axis=0) for k in range(count)])
    ahead, behind = crf._sums(scores[None], model.chain.move, np.ones((1, len(words)), bool))
    both = np.exp(ahead + behind)[0]
    found = dict(model.read(text))
    assert set(found) == {2, 6}
    for at, p in found.items():
        assert abs(p - both[at, 1] / both[at].sum()) < 1e-9


def test_toxicity(spark, edges, few_labels, no_docs):
    docs, labels = (spark.read.parquet(f"{TESTDATA}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.score_toxicity(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert all((r.score >= 0.7) == bool(r.predicted) and 0 <= r.score <= 1 for r in rows)
    assert sum(r.predicted == r.toxic for r in rows) >= 0.93 * len(rows)
    assert sum(r.predicted and not r.toxic for r in rows) <= 2
    # The field is more than a list: held out it makes fewer errors than a lookup of its markers.
    usable = labels.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1)
    names = toxicity.markers(toxicity.labelled_sample(docs, usable, "toxic", {1: 2000, 0: 10_000}), 0.95)
    texts = {r.doc_id: set(toxicity.WORD.findall((r.text or "").lower())) for r in docs.collect()}
    listed = {i: any(f in names for w in ws for f in toxicity.beginnings(w)) for i, ws in texts.items()}
    errors = [sum(bool(r.predicted) != bool(r.toxic) for r in rows), sum(listed[r.doc_id] != bool(r.toxic) for r in rows)]
    assert errors[0] < errors[1], errors
    rows = toxicity.score_toxicity(edges.withColumn("score", F.lit("x")), few_labels).collect()
    assert len(rows) == edges.count() and len({r.score for r in rows if not r.n_toxic}) == 1
    assert toxicity.score_toxicity(no_docs, few_labels).count() == 0


def test_toxicity_depends_on_the_surroundings():
    """One word, toxic within a sentence and a name where it begins one: no list tells them apart."""
    random.seed(33)
    some = lambda n: " ".join(f"w{random.randrange(400)}" for _ in range(n))
    texts = []
    for k in range(200):
        texts.append((f"So {some(8)} {['vexor', 'grimble'][k % 2]} {some(8)}. So {some(6)} vexor {some(3)}.", 1))
        for word in ("And", "Then", "Grimble" if k % 3 == 0 else "But"):
            texts.append((f"So {some(8)}. {word} {some(8)}. So {some(6)}.", 0))
    model = toxicity.Model(texts, 0.95, 32, 2000)
    assert "grimble" not in toxicity.markers(texts, 0.95)
    within = [model.score(model.read(f"So {some(9)} grimble {some(9)}.")) for _ in range(20)]
    begins = [model.score(model.read(f"So {some(9)}. Grimble {some(9)}.")) for _ in range(20)]
    assert min(within) > max(begins)


def test_toxic_offsets_count_code_points_of_the_text(spark):
    texts = [(f"w{k} v{k} nasty u{k} t{k}.", 1) for k in range(80)] + [(f"w{k} v{k} calm u{k}.", 0) for k in range(80)]
    docs = spark.createDataFrame([(10 + k, t) for k, (t, _) in enumerate(texts)] + [(1, "İİ İstanbul is nasty today"), (2, "😀 a nasty")], "doc_id long, text string")
    labels = spark.createDataFrame([(10 + k, y) for k, (_, y) in enumerate(texts)], "doc_id long, toxic int")
    offsets = {r.doc_id: r.offsets for r in toxicity.score_toxicity(docs, labels).collect()}
    assert (offsets[1], offsets[2]) == ("15:20", "4:9")


def test_frequent_toxic_words_stay_markers():
    """1000 contexts in toxic texts beside 30 plain places: 0.971 are toxic."""
    texts = [(f"a{k} b{k} nasty c{k} d{k}", 1) for k in range(1000)]
    texts += [(f"e{k} nasty f{k}", 0) for k in range(30)]
    texts += [(" ".join(f"g{k}x{j}" for j in range(20)), 0) for k in range(500)]
    assert "nasty" in toxicity.markers(texts, 0.95)
    texts += [(f"h{k} nasty i{k}", 0) for k in range(30)]
    assert "nasty" not in toxicity.markers(texts, 0.95)


def test_longest_word_is_that_of_the_whole_text():
    near, far = (quality_model.text_view(" ".join(ws)) for ws in (["z" * 900] + ["ab"] * 6000, ["ab"] * 6000 + ["z" * 900]))
    assert near[15] == far[15] == 900 / 50


def test_quality_model(spark, edges, few_labels, no_docs):
    docs, labels = (spark.read.parquet(f"{TESTDATA}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_model.score_quality(docs, labels).join(labels, "doc_id").collect()
    assert sum(r.keep == bool(r.quality) for r in rows) >= 0.95 * len(rows)
    assert sum(r.quality == 1 and not r.keep for r in rows) <= 0.02 * len(rows)
    assert quality_model.score_quality(edges, few_labels).count() == edges.count()
    assert {r.score for r in quality_model.score_quality(edges, few_labels.limit(0)).collect()} == {1.0}
    assert quality_model.score_quality(no_docs, few_labels).count() == 0


def test_repeated_unlabelled_rows_are_drawn_once(spark, few_labels):
    rows = [(7, "again and again", "en", "a")] * 2000 + [(k, f"text {k} of some words", "en", "b") for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert quality_model.score_quality(docs, few_labels).count() == len(rows)


def test_numbers_are_no_letters(spark):
    odd = spark.createDataFrame([(1, "½ 3 ² ① 12"), (2, "a ½")], "doc_id long, text string")
    known = [(10 + k, f"these are words of a text number {k}") for k in range(40)]
    docs = odd.union(spark.createDataFrame(known, odd.schema)).withColumn("lang", F.lit("en"))
    found = {r.doc_id: r.lang_pred for r in lang_id.identify(docs).collect()}
    assert found[1] == "und" and found[2] != "und"


def test_language(spark, edges, no_docs):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    rows = lang_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in rows) >= 0.98 * len(rows)
    rows = lang_id.identify(edges.withColumn("score", F.lit(1))).collect()
    assert {r.lang_pred for r in rows if r.doc_id in (1, 2)} == {"und"}
    assert all(0 <= r.score <= 1 for r in rows) and len(rows) == edges.count()
    assert lang_id.identify(no_docs).count() == 0
    nothing = lang_id.identify(edges.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}


def test_dictionaries_are_no_prefixes():
    texts = [f"banner {chr(97 + k % 26) * 3} " * 40 + "inner words " * 400 for k in range(50)] + ["short one"] * 50
    made = lang_id.dictionary(texts, 20_000)
    # Short texts are whole, their share goes to the others, and these are not read from their start only.
    assert made.count(b"short one") == 50 and 19_900 <= len(made) <= 20_000
    assert made.count(b"inner words") > 3 * made.count(b"banner")
    assert lang_id.dictionary(["ab cd", "ef"], 100) == b"ab cd ef"
    # More than all shares: everything is whole.
    assert lang_id.dictionary(["ab", "abcdef"], 9) == b"ab abcdef"


def by_tags(page):
    """What the pages of the test tables hold between their article tags."""
    inner = re.search(r"<article>(.*)</article>", page, re.S)[1]
    inner = re.sub(r"</?b>", "", re.sub(r"</?(p|h1|br)>", "\0", inner))
    import html

    blocks = (re.sub(r"\s+", " ", html.unescape(b)).strip() for b in inner.split("\0"))
    return "\n".join(b for b in blocks if b)


def test_pages(spark):
    pages = spark.read.parquet(f"{TESTDATA}/pages.parquet")
    got = {r.page_id: r for r in page_text.extract_text(pages).collect()}
    for r in pages.collect():
        assert got[r.page_id].text == by_tags(r.html)
        assert got[r.page_id].n_chars == len(by_tags(r.html))
    odd = [
        (1, "u", None), (2, "u", ""), (2, "u", ""), (3, None, "<<<a<b"), (4, "u", "<p>" * 20_000),
        (5, "u", '<body><nav>menu here</nav><main><h1>A &amp; B</h1><p>Long text  of\n the page.<p>More &lt;text&gt;.'
         '<div class="comments"><p>Nice post!</p></div><form><label>Mail</label></form></main>'
         '<div class="sidebar"><p>Related.</p></div><footer>end</footer>'),
    ]
    table = pages.limit(60).union(spark.createDataFrame([(-k, u, h) for k, u, h in odd], pages.schema))
    rows = page_text.extract_text(table.withColumn("text", F.lit(0))).collect()
    assert len(rows) == 66
    text = {r.page_id: r.text for r in rows}
    assert text[-1] == text[-2] == text[-4] == ""
    assert text[-5] == "A & B\nLong text of the page.\nMore <text>."
    assert page_text.extract_text(pages.limit(0)).count() == 0


def test_pages_without_declared_main_text(spark):
    """Trained on half of the pages, tried on the others with their main elements, then all, taken away."""
    pages = [r.html for r in spark.read.parquet(f"{TESTDATA}/pages.parquet").orderBy("page_id").collect() if r.html]
    model = page_text.Extractor(pages[::2], 64)
    others = pages[1::2]
    main = re.compile(r"<(/?)article\b[^>]*>")
    every = re.compile(r"<(/?)(?:article|main|nav|header|footer|aside|form)\b[^>]*>")
    for tags in (main, every):
        found = sum(model.extract(tags.sub(r"<\1div>", page)) == by_tags(page) for page in others)
        assert found >= 0.95 * len(others), (found, len(others))
    # What declares a label is no feature: no feature tells the labels apart by itself.
    assert not any("declared" in name for name in model.ids)


def test_pages_that_declare_only_what_is_aside(spark):
    """No page says what its main text is: what is not declared aside is kept."""
    rows = [(k, "u", f"<nav>menu {k}</nav><div><p>Article {k}. It is long enough.</p></div>") for k in range(30)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in page_text.extract_text(pages).collect()} == {
        k: f"Article {k}. It is long enough." for k in range(30)
    }


def test_odd_markup(spark):
    pages = [r.html for r in spark.read.parquet(f"{TESTDATA}/pages.parquet").limit(100).collect() if r.html]
    model = page_text.Extractor(pages, 64)
    long = "A long paragraph of the text, as it is. And some more of it."
    for page in (
        f"<article><h1>T</h1><div class='elementor-widget-wrap'><p>{long}</p></div></article>",
        f"<article><h1 title=it's>T</h1><p title='a > b' id=x\"y>{long}</p></article>",
        f"<article class=a data-x=\"<p>no</p>\"><header class='post-header'><h1>T</h1></header><p>{long}</article>",
    ):
        assert model.extract(page) == f"T\n{long}", page


def test_deep_and_broken_pages_take_time_in_line_with_them():
    import tracemalloc

    for page in ("<div>a" * 100_000, "<b>x" * 100_000, "<div>" * 50_000 + "</x>" * 50_000, "<a " * 50_000, '<a b="' * 50_000):
        start = time.perf_counter()
        page_text.leaf_blocks(page)
        assert time.perf_counter() - start < 5
    tracemalloc.start()
    page_text.leaf_blocks("<div>a" * 100_000)
    assert tracemalloc.get_traced_memory()[1] < 100e6
    tracemalloc.stop()


def test_open_heads_and_skipped_elements_end():
    def texts(page):
        return [b.text for b in page_text.leaf_blocks(page)]

    body = "<article><h1>Top</h1><p>One.</p></article>"
    for head in ("<head><title>t</title>", "<head><title>t", "<head><meta charset=x><script>a < b</script><title>t</title></head>"):
        assert texts(f"<html>{head}<body>{body}</html>") == ["Top", "One."]
        assert texts(f"<html>{head}{body}</html>") == ["Top", "One."]
    for tag in ("textarea", "svg", "math", "noscript", "template", "object", "script", "style", "iframe"):
        for page in (
            f"<body><div><{tag}>no <b>text</b></div>{body}</body>",
            f"<body><{tag}>no text{body}</body>",
            f"<ul><li>a<li><{tag}>no</li><li>b</ul>{body}",
            f"<div>a<{tag}>no<i>no</i></{tag}>b</div>{body}",
        ):
            assert texts(page)[-2:] == ["Top", "One."] and "no" not in " ".join(texts(page)), page
    # An end tag further on belongs to the second drawing, and inner ones to their own.
    assert texts(f"<div><svg>no</div>{body}<p><svg>no</svg>b</p>") == ["Top", "One.", "b"]
    assert texts(f"<p><svg>no<svg>no</svg>no</svg>b</p>{body}") == ["b", "Top", "One."]
    assert texts("<p><svg width=1 />b</p>") == ["b"]
    assert texts("<script>f('<script><p>no</p>')</script><p>a") == ["a"]
    page_text.leaf_blocks("<svg>" * 50_000 + "<head>" * 50_000 + "<textarea>" * 50_000)


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    found = [(0, m.start(), m.end()) for m in EMAIL.finditer(text)]
    found += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(int(x) < 256 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = [int(c) for c in m[0] if c in "0123456789"][::-1]
        total = sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(digits))
        if 16 <= len(digits) <= 19 and total % 10 == 0:
            found.append((2, m.start(), m.end()))
    return found + [
        (3, m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= sum(c in "0123456789" for c in m[0]) <= 15
    ]


def test_patterns_of_personal_data():
    random.seed(4)
    pieces = ["@", ".", "1", "12", "255", "a.b", "-", " ", "+", "(", "x@y.zz", "4539148803436467", "1.2.3.4", "300", "é"]
    for _ in range(20_000):
        text = "".join(random.choices(pieces, k=random.randint(1, 14)))
        assert personal_data.base_spans(text) == plain_spans(text), text
    # Long runs take time in line with their length.
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1 " + " " * 300_000, "a@" * 150_000):
        personal_data.base_spans(text)


def test_personal_data(spark, edges, no_docs):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    rows = personal_data.find_personal(docs).collect()
    assert len(rows) == len(text)
    for r in rows:
        base = plain_spans(text[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, _, _ in base) for x in range(4)]
        assert set(personal_data.listed(base).split(",")) <= set(r.spans.split(","))
    assert sum(r.n_added for r in rows) <= 0.02 * sum(bool(r.spans) for r in rows) + 2
    model = personal_data.Model(personal_data.sample_texts(docs, 3000))
    known = "Call +1 (217) 555-7713 today. Years later (217) 555-7713 and me.you@mail3.example.com, me.you@localhost"
    added = [known[s:e] for _, s, e in model.added(known, personal_data.base_spans(known), 0.9)]
    assert "me.you@localhost" in added
    alone = "Years later (217) 555-7713 and you@localhost"
    assert len(model.added(alone, [], 0.9)) <= len(added)
    assert not [x for x in added if x in ("+1", "555-7713")]
    assert personal_data.find_personal(edges.withColumn("spans", F.lit(1))).count() == edges.count()
    assert personal_data.find_personal(no_docs).count() == 0


def test_entity_marginals_match_sums_over_all_labellings():
    """On links without a loop the messages give exact marginals, known labels held."""
    import itertools

    model = personal_data.Model([])
    rng = np.random.default_rng(2)
    states = personal_data.STATES
    model.ids = {f"f{k}": k for k in range(6)}
    model.emit, model.chain, model.skip = rng.normal(size=(6, states)), rng.normal(size=(states, states)), rng.normal(size=(states, states))
    nodes = personal_data.Nodes("", [])
    nodes.spans, nodes.labels = [(0, 1)] * 5, [0, 0, 3, 0, 0]
    nodes.features = [[f"f{k}", "f5"] for k in range(5)]
    nodes.chain, nodes.skip = [(0, 1), (3, 4)], [(1, 2), (4, 2)]
    p = model.marginals(nodes, settled=1e-9)
    weights = {}
    for y in itertools.product(range(states), repeat=5):
        if y[2] == 3:
            value = sum(model.emit[k, y[k]] + model.emit[5, y[k]] for k in (0, 1, 3, 4))
            value += sum(model.chain[y[a], y[b]] for a, b in nodes.chain)
            weights[y] = np.exp(value + sum(model.skip[y[a], y[b]] for a, b in nodes.skip))
    for k in (0, 1, 3, 4):
        for state in range(states):
            expected = sum(w for y, w in weights.items() if y[k] == state) / sum(weights.values())
            assert abs(p[k, state] - expected) < 1e-6
    # Loops of links that pull apart settle too.
    nodes.chain, nodes.skip = [(0, 1), (1, 3), (3, 0)], [(0, 3), (3, 4), (4, 0)]
    model.chain, model.skip = -4 * np.eye(states), -4 * np.eye(states)
    assert np.allclose(model.marginals(nodes, most_rounds=1000), model.marginals(nodes, most_rounds=3000), atol=1e-2)


def test_bare_repeats_of_known_entities_are_found(spark):
    """Trained on the tables' texts; the texts here are made, of words and numbers of their own."""
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    model = personal_data.Model(personal_data.sample_texts(docs, 3000))
    random.seed(81)
    digits = lambda n: "".join(random.choice("0123456789") for _ in range(n))

    def card():
        while True:
            number = "4" + digits(15)
            if personal_data.luhn(number):
                return number

    words = "it was so that they came by and left for some other place in time".split()
    found = planted = wrong = decoys = 0
    for turn in range(300):
        a, b, c, four = random.choice("23456789") + digits(2), digits(3), digits(4), card()
        parts = [str(random.randrange(256)) for _ in range(4)]
        entity, forms = [
            (f"+1 ({a}) {b}-{c}", [f"{a}.{b}.{c}", f"{a}-{b}-{c}", a + b + c, f"({a}) {b}-{c}"]),
            (four, [".".join(four[k : k + 4] for k in range(0, 16, 4))]),
            (".".join(parts), ["-".join(parts)]),
            (f"jo.{turn}@mail{turn}.example.com", [f"jo.{turn}@localhost", f"JO.{turn}@intranet"]),
        ][turn % 4]
        plain = lambda: " ".join(random.choice(words) for _ in range(random.randrange(3, 60)))
        form = random.choice(forms)
        repeats = random.choice([1, 1, 2, 20])
        alike = re.sub("[0-9]", lambda m: str((int(m[0]) + random.randrange(1, 9)) % 10), form)
        alike = "x" + alike if "@" in alike else alike
        body = [plain(), entity] + [piece for _ in range(repeats) for piece in (plain(), form)] + [plain(), alike, plain()]
        if random.random() < 0.5:
            body = body[::-1]
        text = " ".join(body)
        base = personal_data.base_spans(text)
        added = [text[s:e] for _, s, e in model.added(text, base, 0.95)]
        planted, found = planted + repeats, found + added.count(form)
        decoys, wrong = decoys + 1, wrong + sum(x != form for x in added)
    assert found >= 0.9 * planted and wrong <= 0.01 * decoys, (found, planted, wrong, decoys)


def test_forms_need_an_entity_to_be_forms_of(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    model = personal_data.Model(personal_data.sample_texts(docs, 3000))
    alone = "Years later (217) 555-7713 and you@localhost, 217.555.7713, 4539.1488.0343.6467, 10-1-2-3, 8812345678"
    assert model.added(alone, [], 0.95) == []
    # Long runs and many candidates take time in line with their number.
    for text in ("1" * 200_000, "1-" * 100_000, "+1 217 555 7713 " * 3_000, "217.555.7713 " * 5_000 + "+1 (217) 555-7713"):
        base = personal_data.base_spans(text)
        model.added(text, base, 0.95)
