"""Main text of web pages by two-pass block rules.

The page is cut into blocks of text at block-level tags. The first pass decides what it can:
a block is bad if it lies in a part of the page that never holds the article (menus, footers,
forms, what is hidden, containers whose whole name is that of an advert, a comment or the like), or
if most of its characters are links;
it is good if it is long enough and dense enough in stop words. Blocks that say little (short
ones, and long ones without stop words) stay open. In the second pass an open block takes the
label of its nearest decided neighbours, the better one if they differ and are equally near,
within the part of the page that it shares with them. Where a page marks its article, blocks
outside of it are bad, and open blocks inside of it lean to good.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .tables import text_slices

#: Tags whose content is not text, those that end a block, and those that hold no article.
UNREAD = ("script", "style", "noscript", "template", "svg", "iframe", "object", "textarea", "select", "title", "math")
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre search section summary table tbody "
    "td tfoot th thead tr ul".split()
)
BARRED = frozenset("nav footer aside form menu head button label dialog search".split())
ARTICLE = frozenset(("article", "main"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

#: Names of parts beside the article. A class, id, role or label names such a part if it has one of these
#: words and otherwise only words of layout: "ad-slot-3" and "related-posts", but not "side-effects" or "no-sidebar".
BESIDE = frozenset(
    "ad ads advert adverts advertisement advertisements banner banners breadcrumb breadcrumbs captcha comment comments "
    "commentlist consent cookie cookies disqus footer gdpr header login masthead menu menus modal nav navbar navigation "
    "newsletter notice notices popup promo promos recommended related replies reply share sharing sidebar side signup skip "
    "social sponsor sponsored subscribe tags toolbar widget widgets alert complementary contentinfo response responses".split()
)
LAYOUT = frozenset(
    "area article articles bar block bottom box buttons container entry form group icons inner item items links list main "
    "outer panel post posts primary secondary section site slot stories story thread top unit wrap wrapper".split()
)
#: A header named after one of these has the title of the article.
OWN = frozenset("article entry post story".split())
#: Blocks that are named for what they hold. Headings and text that stands for itself are not.
CONTAINERS = frozenset("center dd details div dl fieldset figure footer header li ol p section table tbody td tfoot th thead tr ul".split())
_HIDES = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\s*(?:!|;|$)", re.I)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_ATTRIBUTES = r"""(?:[^"'>]++|"[^"]*+"|'[^']*+')*+"""
_TOKENS = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(?P<unread>{'|'.join(UNREAD)})\b{_ATTRIBUTES}(?:/>|>.*?(?:</(?P=unread)\s*>|\Z)|\Z)"
    rf"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>{_ATTRIBUTES})(?:>|\Z)"
    r"|</?[a-zA-Z][^<]*\Z",
    re.S | re.I,
)

#: Common words of the languages that pages are expected in.
STOP_WORDS = frozenset(
    "a about all an and are as at be been but by can for from had has have he her his if in is it its more no not of on or "
    "out she so that the their there they this to was we were what when which who will with would you "
    "aber als am an auch auf aus bei das dass dem den der des die durch ein eine einem einen einer er es für hat ich im in "
    "ist mit nach nicht noch nur oder sich sie sind so über um und uns von vor war was werden wie wir zu zum zur "
    "al como con de del el ella en era es esta este fue ha la las le lo los mas me mi muy no nos o para pero por que se "
    "sin sobre son su sus también un una y ya "
    "au aux avec ce ces cette dans de des du elle en est et être il ils je la le les leur lui mais ne nous on ou par pas "
    "plus pour qu que qui sa sans se ses son sont sur un une vous".split()
)

LEAST_GOOD_CHARS = 70
LEAST_DENSITY = 0.15
MOST_LINK_SHARE = 0.5

GOOD, BAD, OPEN = 1, -1, 0


def _attributes(rest: str) -> dict[str, str]:
    """Values by name; of a name given twice the first, as browsers have it."""
    out: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(rest):
        out.setdefault(name.lower(), html.unescape("".join(values)))
    return out


def _hidden(attributes: dict[str, str]) -> bool:
    return "hidden" in attributes or bool(_HIDES.search(attributes.get("style", "")))


def _names_beside(name: str) -> bool:
    words = {x for x in re.split(r"[\s_-]+|\d+", name.lower()) if x}
    if "header" in words and words & OWN:
        return False
    return bool(words & BESIDE) and words <= BESIDE | LAYOUT


def _beside(attributes: dict[str, str]) -> bool:
    """Whether a class, the id, a role or the label as a whole names a part beside the article,
    or the container is not there for all readers."""
    if attributes.get("aria-hidden", "").strip().lower() == "true":
        return True
    tokens = [*attributes.get("class", "").split(), *attributes.get("role", "").split()]
    return any(map(_names_beside, [*tokens, attributes.get("id", ""), attributes.get("aria-label", "")]))


class _Block:
    __slots__ = ("article", "barred", "linked", "pieces")

    def __init__(self, barred: bool, article: bool):
        self.barred, self.article, self.pieces, self.linked = barred, article, [], 0


def _blocks(page: str) -> list[tuple[str, bool, bool, float]]:
    """Text, whether it is barred, whether it is in an article, and share of link characters."""
    done: list[_Block] = []
    # open tags with what holds below them: barred, in an article, in a link, and barred by name only
    stack: list[tuple[str, bool, bool, bool, bool]] = []
    state = (False, False, False, False)
    block = _Block(False, False)

    def text(raw: str) -> None:
        if raw:
            said = html.unescape(raw)
            block.pieces.append(said)
            if state[2]:
                block.linked += len("".join(said.split()))

    def fresh() -> None:
        nonlocal block
        if block.pieces:
            done.append(block)
        block = _Block(state[0], state[1])

    at = 0
    for token in _TOKENS.finditer(page):
        text(page[at : token.start()])
        at = token.end()
        if token["cdata"]:
            text(token["cdata"])
        tag = token["tag"] and token["tag"].lower()
        if not tag:
            continue
        if tag == "br":
            block.pieces.append(" ")
            continue
        ends = tag in BLOCKS
        if token["close"]:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if depth is not None and (ends or not any(x[0] in BLOCKS for x in stack[depth + 1 :])):
                del stack[depth:]
                state = stack[-1][1:] if stack else (False, False, False, False)
        elif tag not in VOID and not token["rest"].endswith("/"):
            if ends:
                # a paragraph or item that was never closed ends where the next block begins
                if tag in ("li", "dd", "dt", "td", "th", "tr", "option") or tag not in ("ul", "ol", "dl", "table", "tbody", "thead"):
                    while stack and (stack[-1][0] == "p" or stack[-1][0] == tag and tag in ("li", "dd", "dt", "td", "th", "tr", "option") or stack[-1][0] not in BLOCKS):
                        stack.pop()
                    state = stack[-1][1:] if stack else (False, False, False, False)
            barred, article, link, named = state
            if tag == "main" and named:
                # a page has one main part, whatever the blocks around it are called
                barred = named = False
            attributes = _attributes(token["rest"]) if token["rest"].strip() else {}
            if tag in BARRED or (tag == "header" and not article) or _hidden(attributes):
                barred, named = True, False
            elif not barred and tag in CONTAINERS and _beside(attributes):
                barred = named = True
            if tag in ARTICLE and not barred:
                article = True
            state = (barred, article, link or tag == "a", named)
            stack.append((tag, *state))
        if ends or (block.barred, block.article) != state[:2]:
            fresh()
    text(page[at:])
    if block.pieces:
        done.append(block)
    out = []
    for x in done:
        words = "".join(x.pieces).split()
        if words:
            out.append((" ".join(words), x.barred, x.article, x.linked / sum(map(len, words))))
    return out


def _first_pass(text: str, barred: bool, linked: float) -> int:
    if barred or linked > MOST_LINK_SHARE:
        return BAD
    if len(text) >= LEAST_GOOD_CHARS:
        words = text.lower().split()
        if sum(word.strip(".,;:!?\"'()") in STOP_WORDS for word in words) >= LEAST_DENSITY * len(words):
            return GOOD
    return OPEN


def _second_pass(labels: list[int], parts: list[int], lean: list[int]) -> list[int]:
    """Open blocks take the label of the nearest decided block of their part, on a tie the
    better; without any they take what their part leans to."""
    size = len(labels)
    near: list[list[tuple[int, int] | None]] = [[None] * size, [None] * size]
    for side, order in enumerate((range(size), range(size - 1, -1, -1))):
        last: dict[int, int] = {}
        for i in order:
            if labels[i] != OPEN:
                last[parts[i]] = i
            elif parts[i] in last:
                near[side][i] = (abs(i - last[parts[i]]), -labels[last[parts[i]]])
    out = []
    for i, label in enumerate(labels):
        if label == OPEN:
            found = [x for x in (near[0][i], near[1][i]) if x]
            label = -min(found)[1] if found else lean[i]
        out.append(label)
    return out


def main_text(page: str | None) -> str:
    """Blocks of the article in page order, joined by line ends."""
    blocks = _blocks(page or "")
    marked = any(article and not barred for _, barred, article, _ in blocks)
    labels, parts, lean = [], [], []
    for text, barred, article, linked in blocks:
        outside = marked and not article
        labels.append(BAD if outside else _first_pass(text, barred, linked))
        # what is barred is decided, and is no neighbour to what is not
        parts.append(2 if barred or outside else int(article))
        lean.append(GOOD if article else BAD)
    return "\n".join(text for (text, *_), label in zip(blocks, _second_pass(labels, parts, lean)) if label == GOOD)


def extract(pages: DataFrame, id_col: str, html_col: str, *keep: str) -> DataFrame:
    """``id``, the columns named in ``keep``, and ``text``: the main text of every page.

    A null page counts as empty; a page without an article gives an empty text, never null.
    Null ids and repeated rows pass through; other columns are not read, whatever their names.
    Every page is read whole.
    """
    rows = pages.select(F.col(id_col).alias("id"), *keep, F.col(html_col).alias("html"))
    kept = rows.columns[:-1]
    schema = pa.schema([*(pa.field(x, to_arrow_type(rows.schema[x].dataType)) for x in kept), pa.field("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "html"):
            texts = [main_text(page) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in kept), pa.array(texts, pa.string())], schema=schema)

    ddl = ", ".join(f"`{x}` {rows.schema[x].dataType.simpleString()}" for x in kept)
    return rows.mapInArrow(run, f"{ddl}, text string")
