"""Main text of web pages (operator 7).

A page is cut into leaf blocks: stretches of text between the tags that start a new
block. A linear-chain conditional random field over the blocks, with the states "aside"
and "main", weighs the tags and class names a block stands in and what its text looks
like; Viterbi picks the best labelling of the page.

No table says which blocks are main text, so training pages are labelled by what their
markup declares: a block within an article or main element is main text, one within a
menu, footer, advert and the like is not, nor is one beside declared main text for which
nothing is declared. Pages that declare no main text are not trained on. What declares a
label is no feature: the field sees single tags and families of names, and it sees each
training page again without the main elements, and without them and half of the others,
so it learns to tell main text by its looks where markup is silent.
"""

from __future__ import annotations

import collections
import html
import random
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import crf
from tripflow.llm.common import read_table

# Fixed values of the HTML standard.
#: Elements whose start and end bound a block.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt"
    " fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html"
    " legend li main menu nav ol option optgroup p pre search section select summary table tbody"
    " td tfoot th thead title tr ul video audio iframe object canvas".split()
)
#: Elements that hold no element.
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
#: Elements whose content is no text of the page.
SKIPPED_TAGS = ("script", "style", "noscript", "template", "textarea", "svg", "math", "iframe", "object")
#: Those of them that can hold one of their own kind.
NESTED_TAGS = frozenset("template svg math object".split())
#: Those that can hold blocks; start tags of other blocks end an open one of the rest.
HOLDS_BLOCKS = frozenset("noscript template object iframe".split())
#: Start tags that do not end a head.
HEAD_TAGS = frozenset("base basefont bgsound head html link meta noframes title".split()) | frozenset(SKIPPED_TAGS)
#: Start tags that end an open paragraph.
ENDS_P = BLOCK_TAGS - {"br", "body", "html", "head", "title", "option", "optgroup", "caption", "iframe", "object", "canvas", "video", "audio"}
#: Elements that end an open one of their kind: list items, cells, rows.
ENDS_ITSELF = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

LISTS = frozenset("ul ol li dl dt dd".split())
ASIDE_TAGS = frozenset("nav header footer aside form menu button select dialog search label fieldset".split())
MAIN_TAGS = frozenset("article main".split())
#: Words in class names, ids and roles that declare something beside the main text.
FAMILIES = {
    "ad": "ad ads advert adverts advertisement banner promo promoted sponsor sponsored",
    "menu": "breadcrumb breadcrumbs menu nav navbar navigation pager pagination masthead toolbar",
    "comment": "comment comments disqus reply replies",
    "notice": "consent cookie cookies modal newsletter notice popup signup subscribe",
    "form": "button form login search",
    "header": "header",
    "footer": "contentinfo footer",
    "more": "related share sharing sidebar social",
}
ASIDE_WORDS = {word: family for family, words in FAMILIES.items() for word in words.split()}
MAIN_WORDS = frozenset("article body content entry main post story text".split())

TAG = re.compile(
    r"<!--.*?(?:-->|$)|<(?P<skip>" + "|".join(SKIPPED_TAGS) + r")\b[^>]*>"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^<>=]++|=\s*+(?:\"[^\"]*\"|'[^']*')?+)*+)>|<[!?/][^>]*(?:>|$)",
    re.S | re.I,
)
#: Start and end tags of each skipped element.
BOUNDS = {t: re.compile(rf"<{t}\b[^>]*>|(?P<end></{t}\s*>)", re.I) for t in SKIPPED_TAGS}
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
WORDS = re.compile(r"[a-z]+")
SPACES = re.compile(r"\s+")
SCHEMA = "page_id long, url string, text string, n_chars long"


def names_in(rest: str) -> tuple[str, ...]:
    """Words of an element's class, id and role."""
    if "=" not in rest:
        return ()
    found = " ".join(x for m in NAMES.finditer(rest) for x in m.groups() if x)
    split = re.sub(r"([a-z])([A-Z])", r"\1 \2", found)
    return tuple(WORDS.findall(split.lower()))


class Element:
    """An open element: what it and those around it say. ``marks`` are its own."""

    __slots__ = ("parent", "tag", "linked", "inner", "said", "marks", "near", "seen", "named")

    def __init__(self, parent: Element | None, tag: str, names: tuple[str, ...]) -> None:
        self.parent, self.tag = parent, tag
        named = frozenset(names) if tag not in ("html", "body") else frozenset()
        said = parent.said if parent else None
        marks = []
        # A header within an article belongs to the article.
        if tag in MAIN_TAGS or (tag in ASIDE_TAGS and not (tag == "header" and said)):
            marks.append(f"<{tag}>")
        families = {ASIDE_WORDS[word] for word in named if word in ASIDE_WORDS}
        marks += sorted(f for f in families if not (f == "header" and said))
        self.marks = tuple(marks)
        if marks:
            said = int(marks == [f"<{tag}>"] and tag in MAIN_TAGS)
        #: 1 for main text, 0 for others, None if the markup does not say; the innermost word counts.
        self.said: int | None = said
        self.linked = tag == "a" or bool(parent and parent.linked)
        # Lists say nothing: menus have them, and so have articles.
        self.inner = tag if tag in BLOCK_TAGS and tag not in LISTS else parent.inner if parent else ""
        self.near, self.seen = seen_marks(self.marks, parent.near if parent else (), parent.seen if parent else frozenset())
        named = named & MAIN_WORDS
        self.named = named | parent.named if parent and not parent.named >= named else parent.named if parent else named


def seen_marks(marks: tuple, near: tuple, seen: frozenset) -> tuple[tuple, frozenset]:
    """The innermost marks and all marks, from an element's own and those around it."""
    if not marks:
        return near, seen
    return marks, seen if seen >= frozenset(marks) else seen.union(marks)


class Block:
    __slots__ = ("text", "element", "links")

    def __init__(self, text: str, element: Element, links: int) -> None:
        self.text, self.element, self.links = text, element, links


def closed(page: str, tag: str) -> dict[int, int]:
    """Where each skipped element ends that has an end tag, by the end of its start tag."""
    ends: dict[int, int] = {}
    opened: list[int] = []
    for m in BOUNDS[tag].finditer(page):
        if m[0].endswith("/>") and tag in ("svg", "math"):
            ends[m.end()] = m.end()
        elif not m["end"]:
            # What stands in a text-only element is no tag.
            if tag in NESTED_TAGS or not opened:
                opened.append(m.end())
        elif opened:
            ends[opened.pop()] = m.end()
    return ends


def leaf_blocks(page: str) -> list[Block]:
    """The page's blocks of text in order, each with the element it stands in."""
    blocks: list[Block] = []
    root = Element(None, "", ())
    stack: list[Element] = []
    opened: collections.Counter[str] = collections.Counter()
    parts: list[str] = []
    linked, at = 0, 0
    ends: dict[str, dict[int, int]] = {}
    # An open head, or a skipped element without an end tag: its place in the stack, and its tag.
    hidden: tuple[int, str] | None = None

    def flush() -> None:
        nonlocal linked
        if parts:
            text = SPACES.sub(" ", html.unescape("".join(parts))).strip()
            if text:
                blocks.append(Block(text, stack[-1] if stack else root, linked))
            parts.clear()
        linked = 0

    def push(tag: str, names: tuple[str, ...]) -> None:
        stack.append(Element(stack[-1] if stack else root, tag, names))
        opened[tag] += 1

    def cut(size: int) -> None:
        opened.subtract(element.tag for element in stack[size:])
        del stack[size:]

    def close(kinds: tuple[str, ...], until: frozenset = frozenset()) -> None:
        if not any(opened[kind] for kind in kinds):
            return
        for k in range(len(stack) - 1, -1, -1):
            if stack[k].tag in kinds:
                cut(k)
                return
            if stack[k].tag in until:
                return

    def add(text: str) -> None:
        nonlocal linked
        if hidden:
            return
        parts.append(text)
        if stack and stack[-1].linked:
            linked += len(text)

    def skip(tag: str) -> None:
        nonlocal hidden
        hidden = hidden or (len(stack), tag)
        # No name that other tags look for.
        push("head" if tag == "head" else "skipped", ())

    while m := TAG.search(page, at):
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        if m["skip"]:
            tag = m["skip"].lower()
            if tag not in ends:
                ends[tag] = closed(page, tag)
            if at in ends[tag]:
                at = ends[tag][at]
            elif not hidden:
                skip(tag)
            continue
        if not m["name"]:
            continue
        name = m["name"].lower()
        if hidden and not m["end"] and ends_hidden(hidden[1], name):
            cut(hidden[0])
            hidden = None
        if name in BLOCK_TAGS:
            flush()
        if m["end"]:
            close((name,))
        else:
            if name in ENDS_P:
                close(("p",), until=frozenset(BLOCK_TAGS - {"p"}))
            if name in ENDS_ITSELF:
                close(ENDS_ITSELF[name], until=frozenset({"ul", "ol", "dl", "table", "select"}))
            if name == "head":
                skip(name)
            elif name not in VOID_TAGS:
                push(name, names_in(m["rest"]))
        if hidden and len(stack) <= hidden[0]:
            hidden = None
    if at < len(page):
        add(page[at:])
    flush()
    return blocks


def ends_hidden(tag: str, name: str) -> bool:
    """Whether the start tag ``name`` ends an open head or a skipped element ``tag`` without an end tag."""
    if tag == "head":
        return name not in HEAD_TAGS
    if tag in HOLDS_BLOCKS:
        return name in MAIN_TAGS or name == "body"
    return name in BLOCK_TAGS and name != "title"


def masked(element: Element, gone: Callable[[Element], bool]) -> tuple[tuple, frozenset]:
    """What is seen around a block where the marks of some elements are gone."""
    path = []
    while element.parent is not None:
        path.append(element)
        element = element.parent
    near, seen = (), frozenset()
    for element in reversed(path):
        near, seen = seen_marks(() if gone(element) else element.marks, near, seen)
    return near, seen


_MAIN_MARKS = frozenset(f"<{tag}>" for tag in MAIN_TAGS)


def features(block: Block, near: tuple, seen: frozenset, page_has_main: bool, named: bool = True) -> list[str]:
    """Single marks around the block, and its looks; which label they stand for is learned."""
    element, text = block.element, block.text
    size = len(text)
    inner = element.inner if f"<{element.inner}>" not in element.marks else ""
    found = ["all", f"inner:{inner}", f"size:{min(size, 4000).bit_length()}"]
    found += [f"near:{mark}" for mark in near] + [f"in:{mark}" for mark in sorted(seen)]
    found.append("main:" + ("in" if seen & _MAIN_MARKS else "out" if page_has_main else "none"))
    if named:
        found += [f"named:{w}" for w in sorted(element.named)]
    found.append(f"links:{4 * min(block.links, size) // max(size, 1)}")
    found.append(f"ends:{text[-1] in '.!?:;…'}")
    found.append(f"sentences:{min(3, sum(text.count(c) for c in '.!?'))}")
    if "©" in text[:40]:
        found.append("copyright")
    return found


class Extractor:
    """Scores of features and moves; built once on the driver, used in the tasks."""

    def __init__(self, pages: list[str], blocks_per_page: int) -> None:
        draw = random.Random(7)
        sequences: list[tuple[list[list[str]], list[int]]] = []
        for page in pages:
            blocks = leaf_blocks(page)[:blocks_per_page]
            # What is not declared beside declared main text is aside.
            labels = [block.element.said or 0 for block in blocks]
            if not any(labels):
                continue
            whole = [(b.element.near, b.element.seen) for b in blocks]
            sequences.append(([features(b, *views, True) for b, views in zip(blocks, whole)], labels))
            for share in (0.0, 0.5):
                lost: dict[int, bool] = {}

                def gone(element: Element) -> bool:
                    if _MAIN_MARKS.intersection(element.marks):
                        return True
                    return lost.setdefault(id(element), draw.random() < share)

                views = [masked(b.element, gone) for b in blocks]
                sequences.append(([features(b, *v, False, named=False) for b, v in zip(blocks, views)], labels))
        self.ids: dict[str, int] = {}
        tokens = [([[self.ids.setdefault(f, len(self.ids)) for f in names] for names in page], y) for page, y in sequences]
        self.chain = crf.train(tokens, max(1, len(self.ids)), 2, rounds=60)
        self.trained = bool(sequences)

    def extract(self, page: str | None) -> str:
        blocks = leaf_blocks(page or "")
        if not blocks:
            return ""
        if self.trained:
            get = self.ids.get
            has_main = any(b.element.seen & _MAIN_MARKS for b in blocks)
            names = (features(b, b.element.near, b.element.seen, has_main) for b in blocks)
            tokens = [[k for k in map(get, found) if k is not None] for found in names]
            states = crf.viterbi(self.chain.scores(tokens), self.chain.move)
        else:
            states = [int(b.element.said != 0) for b in blocks]
        return "\n".join(b.text for b, y in zip(blocks, states) if y)


def sample_pages(pages: DataFrame, most: int) -> list[str]:
    """About ``most`` different pages, by a hash of the page."""
    total = pages.select("html").count()
    bound = min(2**31, most * 2**31 // max(1, total) + 1)
    place = F.pmod(F.xxhash64(F.lit("pages"), "html"), F.lit(2**31))
    drawn = pages.where(F.col("html").isNotNull() & (place < F.lit(bound))).select("html").distinct()
    return sorted(r["html"] for r in drawn.collect())


def extract_text(pages: DataFrame, most: int = 400, blocks_per_page: int = 64) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of ``pages`` (page_id, url, html).

    Trained on about ``most`` pages, on their first ``blocks_per_page`` blocks; extraction
    reads every page whole. The main blocks come in page order, joined by line feeds, with
    character references decoded and white space turned into single spaces. A null or
    empty page, or one without main text, gives an empty text. If no page of the sample
    declares main text, blocks are kept unless their markup speaks against them.
    Broken markup is read as far as it goes: a head without an end tag ends where a start tag
    does not belong to it, an element that is no text (a script, a drawing) at the end of the
    block around it, or where a block starts that it cannot hold. Repeated rows give equal results.
    """
    extractor = Extractor(sample_pages(pages, most), blocks_per_page)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extractor.extract(page) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(run, SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(read_table(spark, sf_dir, "pages"))
