"""Main text of HTML pages: flat text blocks, classified by a decision tree over each block and its neighbours.

A page is cut into blocks at block-level tags. Each block carries its word count, its link density (share of
words inside links), both figures of the block before and after it, and what encloses it: the tags and class names
that boilerplate has, with the share of the page's words inside the innermost such element, since a name on the
frame of a whole page says little. A decision tree, fitted with Spark ML on the blocks of the labelled pages below,
marks blocks as main text; the fitted tree is a plain nested tuple that is sent to the tasks. Pages are handled row
by row, so no page meets another one.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# HTML elements by role.
HIDDEN = frozenset("script style noscript template svg math iframe object canvas head title select option textarea button".split())
RAW = frozenset("script style textarea title noscript template iframe".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILER_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
MAIN_TAGS = frozenset("article main".split())
BOILER_NAMES = re.compile(
    r"(?:^|[-_\s])(?:ad|ads|advert\w*|adsense|adbox|adslot|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumb\w*|footer|foot|header|masthead|topbar"
    r"|side|sidebar\w*|aside|widget\w*|related|recommended|share|sharing|social|cookie\w*|consent|notice\w*|alert|popup|modal|newsletter|subscribe"
    r"|signup|login|comment\w*|disqus|respond|replies|reply|pagination|pager|copyright|legal|disclaimer|toolbar|search\w*|form)(?:$|[-_\s])",
    re.I,
)
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: An open element ends when one of these opens inside it: paragraphs and list parts may lack their end tag.
CLOSES_P = BLOCK - {"body", "html"}
CLOSES_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
STOPS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}

#: What a head may hold, and hidden elements that end where a block begins.
IN_HEAD = frozenset("title meta link base style script noscript template".split())
ENDED_BY_BLOCK = frozenset("svg math select option".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")

TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 li dd dt td th blockquote pre figcaption caption summary".split())

FEATURES = [
    "words", "link_share", "words_before", "link_before", "words_after", "link_after", "in_tag", "in_name", "inner_share", "outer_share", "in_main",
    "has_main", "in_h1", "in_text", "main_share",
]
#: Labelled pages: layouts with places for main text (H heading, P paragraph, s short piece, M text with links) and for other
#: text (L links, b a few words, B a notice, C a comment as long as a paragraph); K is a link that is part of the main text.
#: Neighbours are those on the page.
LAYOUTS = (
    "<nav><ul><li>{L}<li>{L}<li>{L}</ul></nav><div class=ad>{B}</div><article><h1>{H}</h1><p>{P}<p>{s}<p>{P}<ul><li>{s}<li>{M}</ul></article><footer>{B}</footer>",
    "<header><h1>{b}</h1></header><main><article><h1>{H}</h1><p>{P}<p>{M}<table><tr><td>{s}<td>{s}</table><form><label>{b}</label></form><aside>{B}</aside></article>"
    "<section id=comments><h2>{b}</h2><p>{C}<p>{B}<p>{C}</section></main><div id=sidebar><p>{B}</div><div class=ad>{b}</div><footer>{B}</footer>",
    "<article><p>{s}</article><footer>{b}</footer>",
    "<div class='cookie-notice'>{B}</div><main><h1>{H}</h1><p>{P}<h2>{H}</h2><p>{s}<p>{P}</main><div>{B}</div><div>{b}</div>",
    "<div class='layout has-sidebar'><nav>{L}{L}</nav><article><header class='entry-header'><h1>{H}</h1><div class='share'>{L}</div></header><p>{P}<p>{P}<p>{s}<p>{P}"
    "<div class='related'><h3>{b}</h3><p>{L}<p>{B}</div></article><div class=sidebar><h3>{b}</h3><p>{B}<ul><li>{L}<li>{L}</ul></div></div><div class=footer>{B}</div>",
    "<form id='page-form'><div class='header'>{b}<ul><li>{L}<li>{L}</ul></div><article><h1>{H}</h1><p>{P}<div>{P}</div><p>{M}</article><div class=footer>{b}</div></form>",
    "<article><header class='post header'><h1>{H}</h1><p>{b}</p></header><p>{P}<p>{P}<ul><li>{K}<li>{K}</ul></article><div id=comments><article><p>{C}</article><article><p>{B}</article></div>",
    "<article class='teaser'><h2>{H}</h2><p>{s}</article><div><p>{P}<p>{P}<p>{P}</div><aside><article><p>{B}</article></aside><div>{b}</div><div>{L}</div>",
    "<div><ul><li>{L}<li>{L}<li>{L}</ul></div><h1>{H}</h1><p>{P}<p>{s}<p>{M}<p>{P}<div>{B}</div><div>{L}</div>",
    "<div>{L}</div><div>{b}</div><h1>{H}</h1><div>{P}</div><div>{P}</div><div>{P}</div><div>{B}</div>",
    "<div>{b}</div><div>{L}</div><div><p>{P}<p>{P}<h2>{H}</h2><p>{P}</div><div>{B}</div>",
    "<div class='layout has-sidebar'><ul><li>{L}<li>{L}</ul><h1>{H}</h1><p>{P}<p>{P}<p>{s}<p>{P}<div class=sidebar><p>{B}<p>{L}</div></div><div>{b}</div>",
    "<div class='main-header'><h1>{b}</h1><p>{b}</div><p>{P}<p>{P}<h3>{H}</h3><p>{s}<p>{P}<div class='comments'><p>{C}<p>{B}<p>{C}</div><div class='copyright'>{b}</div>",
    "<nav>{L}</nav><article><h1>{H}</h1><p>{P}<ul><li>{K}<li>{K}<li>{K}</ul><p>{P}<ol><li>{K}<li>{s}</ol></article><footer>{L}</footer>",
    "<main><p>{s}<p>{K}<p>{P}<dl><dt>{K}<dd>{s}</dl></main><div>{L}</div>",
    "<article><h1>{H}</h1><p>{P}<p>{P}<p>{P}</article><div class='user-posts'><p>{C}<p>{C}</div><div>{b}</div>",
    "<nav>{L}</nav><main><p>{P}<p>{P}<p>{P}</main><section><h2>{b}</h2><div>{C}</div><div>{B}</div><div>{C}</div></section>",
    "<nav>{b}</nav><p>{s}</p>{P}", "<nav>{L}</nav><p>{s}<p>{s}<footer>{b}</footer>", "<p>{s}", "<p>{P}", "<div>{s}</div>", "{s}", "<h1>{H}</h1><p>{s}<p>{P}", "<nav>{L}</nav>", "<footer>{B}</footer>",
)
_SIZES = {"H": (1, 14), "P": (30, 220), "s": (1, 29), "M": (8, 90), "K": (1, 8), "L": (1, 8), "b": (1, 8), "B": (4, 26), "C": (20, 110)}


def labelled_pages(draws: int = 40) -> list[str]:
    """Every layout with texts of several lengths; main text starts with ``main`` and other text with ``other``."""
    rng = random.Random(7)

    def text(place: re.Match) -> str:
        kind = place[1]
        first, n = "main" if kind in "HPsMK" else "other", rng.randint(*_SIZES[kind])
        if kind in "LK":
            return "<a href='/x'>" + " ".join([first, *["w"] * (n - 1)]) + "</a>"
        linked = rng.randint(0, n // 2 - 1) if kind == "M" else 0
        return " ".join([first, *["w"] * (n - 1 - linked)]) + (" <a href='/x'>" + " ".join(["w"] * linked) + "</a>" if linked else "")

    return [re.sub(r"\{(\w)\}", text, layout) for layout in LAYOUTS for _ in range(draws)]


def labelled_blocks() -> list[tuple]:
    """Features and label of every block of the labelled pages."""
    return [(*x, int(b.text.startswith("main"))) for page in labelled_pages() for blocks in [text_blocks(page)] for b, x in zip(blocks, features(blocks), strict=True)]


def fit_tree(spark: SparkSession, labelled: list[tuple] | None = None, depth: int = 10) -> tuple:
    """Fit the tree on labelled blocks; a leaf is (label,), a branch (feature, threshold, left, right)."""
    table = spark.createDataFrame([tuple(float(v) for v in row) for row in labelled or labelled_blocks()], [*FEATURES, "label"])
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(table).coalesce(1)
    model = DecisionTreeClassifier(maxDepth=depth, minInstancesPerNode=1, seed=7).fit(rows)

    def plain(node) -> tuple:
        if node.numDescendants() == 0:
            return (int(node.prediction()),)
        split = node.split()
        return (split.featureIndex(), split.threshold(), plain(node.leftChild()), plain(node.rightChild()))

    return plain(model._call_java("rootNode"))


def is_main(tree: tuple, x: tuple) -> bool:
    while len(tree) > 1:
        tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
    return tree[0] == 1


def _boiler(tag: str, attributes: str, in_main: bool) -> int:
    """What an element says of its contents: 2 by tag or role, 1 by a name, 0 nothing."""
    if tag in BOILER_TAGS or tag == "header" and not in_main:
        return 2
    if not attributes or tag in ("html", "body", "article", "main"):
        return 0
    named = 0
    for name, *values in _ATTRIBUTE.findall(attributes):
        value = next((v for v in values if v), "")
        name = name.lower()
        if name == "role" and value.lower() in BOILER_ROLES:
            return 2
        named |= name in ("class", "id") and BOILER_NAMES.search(value) is not None
    return int(named)


class Block(NamedTuple):
    text: str
    words: int
    linked: int  # words inside links
    in_tag: bool  # inside an element that is boilerplate by its tag, which itself is inside the article if there is one
    in_name: bool  # the same by a name
    inner: float  # share of the page's words inside the innermost of these elements, 1 without
    outer: float  # the same of the innermost such element around the article
    main: bool  # inside the article
    h1: bool
    text_tag: bool  # inside a paragraph, heading, list item or the like
    main_share: float  # share of the page's words inside the article


class _Open:
    """Open elements, with the places of each tag, so that the last one of a tag is found without a search."""

    def __init__(self):
        self.stack: list[tuple[str, int, bool]] = []  # tag, boilerplate, hidden
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def push(self, tag: str, bad: int, unseen: bool) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag in BLOCK:
            self.blocks.append(len(self.stack))
        self.stack.append((tag, bad, unseen))

    def pop(self) -> tuple[str, int, bool]:
        one = self.stack.pop()
        self.places[one[0]].pop()
        if one[0] in BLOCK:
            self.blocks.pop()
        return one

    def last(self, tags, stops=()) -> int:
        """Place of the last open element of these tags, unless one of the others is open inside it; -1 for none."""
        found = max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)
        return found if found > max((self.places[t][-1] for t in stops if self.places.get(t)), default=-1) else -1


def text_blocks(page: str) -> list[Block]:
    """Blocks in page order."""
    out: list[tuple] = []
    parts: list[str] = []
    linked: list[str] = []
    opened = _Open()
    marks: list[tuple[int, int, int]] = []  # open boilerplate elements: number, and how many by name and by tag up to it
    sizes: list[int] = []  # words inside each of them, by number; while one is open, less the words ahead of it
    total = main = hidden = links = h1 = in_text = floor = 0
    ends: dict[str, int] = {}

    def close_block():
        nonlocal total
        if parts:
            if words := html.unescape("".join(parts)).split():
                inside = len(html.unescape(" ".join(linked)).split()) if linked else 0
                total += len(words)
                within = floor if main else 0
                ahead = marks[within - 1] if within else (-1, 0, 0)
                now = marks[-1] if len(marks) > within else ahead
                out.append((
                    " ".join(words), len(words), min(inside, len(words)), now[2] > ahead[2], now[1] > ahead[1], now[0] if len(marks) > within else -1, ahead[0], main > 0, h1 > 0, in_text > 0,
                ))
            parts.clear()
            linked.clear()

    def leave(n: int):
        """Close the open elements from place n on."""
        nonlocal main, hidden, links, h1, in_text
        while len(opened.stack) > n:
            tag, bad, unseen = opened.stack[-1]
            if tag in BLOCK:
                close_block()
            opened.pop()
            if bad:
                number = marks.pop()[0]
                sizes[number] += total
            hidden -= unseen
            h1 -= tag == "h1"
            in_text -= tag in TEXT_TAGS
            main -= tag in MAIN_TAGS
            links -= tag == "a"

    def is_closed(tag: str, at: int) -> bool:
        """Whether an end tag of that name still comes."""
        if tag not in ends:
            ends[tag] = max((m.start() for m in re.finditer(rf"</{tag}(?=[\s/>])", page, re.I)), default=-1)
        return ends[tag] >= at

    at = 0
    while at < len(page):
        found = _TAG.search(page, at)
        upto = found.start() if found else len(page)
        if upto > at:
            if hidden and opened.stack[-1][0] == "head" and not page[at:upto].isspace():
                leave(opened.last({"head"}))
            if not hidden:
                parts.append(page[at:upto])
                if links:
                    linked.append(page[at:upto])
        if not found:
            break
        at = found.end()
        if not found[2]:
            continue
        tag = found[2].lower()
        if found[1]:
            n = opened.last({tag})
            if n >= 0:
                leave(n)
            elif tag in BLOCK:
                close_block()
            continue
        # Start and end tag of the head may be left out: it ends where something else begins.
        if opened.places.get("head") and tag not in IN_HEAD and tag != "head":
            leave(opened.last({"head"}))
        if tag in VOID:
            if tag == "hr":
                close_block()
            elif not hidden and tag == "br":
                parts.append(" ")
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in BLOCK and hidden and not opened.places.get("foreignobject") and (n := min((opened.places[t][0] for t in ENDED_BY_BLOCK if opened.places.get(t)), default=-1)) >= 0:
            leave(n)
        if tag in HIDDEN and tag != "head" and tag not in CLOSES_SAME and not is_closed(tag, at):
            continue  # never closed: what follows belongs to the page
        if tag in CLOSES_P and (n := opened.last({"p"}, {"table", "button", "td", "th"})) >= 0:
            leave(n)
        if tag in CLOSES_SAME and (n := opened.last(CLOSES_SAME[tag], STOPS[tag])) >= 0:
            leave(n)
        if tag == "a" and links and (n := opened.last({"a"})) >= 0 and not (opened.blocks and opened.blocks[-1] >= n):
            leave(n)
        if tag in BLOCK:
            close_block()
        bad, unseen = _boiler(tag, found[3], main > 0), tag in HIDDEN
        if found[3].rstrip().endswith("/") and tag not in BLOCK:
            continue
        opened.push(tag, bad, unseen)
        if tag in MAIN_TAGS and not main:
            floor = len(marks)
        if bad:
            named, tagged = marks[-1][1:] if marks else (0, 0)
            marks.append((len(sizes), named + (bad == 1), tagged + (bad == 2)))
            sizes.append(-total)
        hidden += unseen
        h1 += tag == "h1"
        in_text += tag in TEXT_TAGS
        main += tag in MAIN_TAGS
        links += tag == "a"
    leave(0)
    close_block()
    share = lambda number: 1.0 if number < 0 else sizes[number] / total
    whole = sum(b[1] for b in out if b[7]) / total if total else 0.0
    return [Block(*b[:5], share(b[5]), share(b[6]), *b[7:], whole) for b in out]


def features(blocks: list[Block]) -> Iterator[tuple]:
    """The figures of each block, in the order of ``FEATURES``."""
    has_main = any(b.main and not b.in_tag and not b.in_name for b in blocks)
    figures = [(0, 0.0), *[(b.words, b.linked / b.words) for b in blocks], (0, 0.0)]
    for i, b in enumerate(blocks):
        yield (*figures[i + 1], *figures[i], *figures[i + 2], float(b.in_tag), float(b.in_name), b.inner, b.outer, float(b.main), float(has_main), float(b.h1), float(b.text_tag), b.main_share)


def main_text(page: str | None, tree: tuple) -> str:
    """The blocks that the tree takes as main text, joined by line feeds."""
    blocks = text_blocks(page or "")
    return "\n".join(b.text for b, x in zip(blocks, features(blocks), strict=True) if is_main(tree, x))


def extract_main_text(pages: DataFrame, html_col: str = "html", out: str = "text", tree: tuple | None = None) -> DataFrame:
    """Add the main text of every page as ``out``; a column of that name is replaced.

    Null and empty pages give an empty text, as do pages without main text; equal rows give equal texts, an
    empty table an empty result. Pages are read whole, cut-off ones up to their end.
    """
    tree = tree or fit_tree(pages.sparkSession)
    kept = [c for c in pages.columns if c not in (html_col, out)]
    # The other columns travel as one value, so that none of them meets a name used here.
    row = F.struct(F.lit(0).alias("_"), F.struct(*[F.col(f"`{c}`") for c in kept]).alias("r") if kept else F.lit(0).alias("r")).alias("_row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(page.as_py(), tree) for page in batch.column("_html")], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("_row"), texts], names=["_row", "_text"])

    shaped = pages.select(row, F.col(f"`{html_col}`").alias("_html"))
    schema = T.StructType([*shaped.drop("_html").schema.fields, T.StructField("_text", T.StringType())])
    made = shaped.mapInArrow(run, schema)
    return made.select(*(["_row.r.*"] if kept else []), F.col("_text").alias(out))
