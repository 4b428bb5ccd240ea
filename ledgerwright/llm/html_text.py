"""Main text of web pages by two passes over their blocks.

A page is cut into blocks at block-level tags and line breaks. The first pass decides
a block where it can:

* boilerplate: inside navigation, headers, footers, asides, forms, dialogs, hidden or
  non-text elements, or an element whose class, id or role names such a part, an advert,
  a notice or comments; or mostly links. Class and id names never judge ``html``, ``body``,
  ``main``, ``article`` or an element around a main one; names such as no-sidebar or
  has-comments say how a page is laid out and judge nothing;
* content: inside ``article`` or ``main`` where the page has one; otherwise long enough
  with enough stop words;
* boilerplate too: long without stop words, outside any main element.

Everything else is short and ambiguous. The second pass gives it the label of the
nearest decided block. Of two as near, the one in the same element wins; else a heading
follows the one after it, and another block is content only if both are. On a page without any content block, stop
words judge its short blocks too. Content blocks are joined in page order.

Character references are decoded, white space within a block becomes one space. Null,
empty and tag-only pages have an empty text; unclosed and truncated markup is read as
far as it goes. Repeated rows are extracted once each. Further columns do not matter.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerwright.llm.shared import arrow_map, slices

LINK_DENSITY = 0.5
STOP_DENSITY = 0.15
LONG = 80
_BYTES = 4 << 20

# Names of elements and of page parts, and frequent words of four languages.
_RAW = {"script", "style", "title", "textarea", "noscript", "template", "svg", "iframe", "math"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_BLOCKS = set(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption"
    " figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup"
    " option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_MAIN = {"article", "main"}
_WHOLE = _MAIN | {"html", "body"}
#: Words before a part's name that tell of its absence or of the layout around it.
_NEUTRAL = {"no", "not", "non", "without", "has", "have", "with"}
_OUTSIDE = {"nav", "footer", "aside", "form", "head", "menu", "dialog", "button", "select", "fieldset"}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu"}
_PARTS = set(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright"
    " disqus footer header login masthead menu modal nav navbar navigation newsletter notice popup promo promoted"
    " recommended related respond share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
_STOP = set(
    # English
    "a an and are as at be but by for from had has have he his i in is it its not of on or she that the their they"
    " this to was were which will with you"
    # German
    " als am auch auf aus bei das dass dem den der des die durch ein eine einem einen einer er es für hat ich im ist"
    " mit nach nicht noch nur sich sie sind über um und uns von war werden wie wird wir zu zum zur"
    # French
    " au aux avec ce cette dans de des du elle en est et eux il ils je la le les leur lui mais ne nous par pas pour"
    " qu que qui sa se ses son sont sur un une vous"
    # Spanish
    " al como con cuando del desde donde el ella entre era esta este ha hasta las lo los más me mi muy no para pero"
    " por porque si sin sobre su sus también tiene todo una uno y ya".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_NAME_PART = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    tag: str
    outside: bool  # in a part that is never content
    main: bool
    parent: int  # number of the innermost open element around the block
    pieces: list[tuple[str, bool]] = field(default_factory=list)  # text, and whether it is a link's
    text: str = ""
    label: bool | None = None


def _is_part(name: str, attributes: str, in_main: bool) -> bool:
    if name in _OUTSIDE or name == "header" and not in_main:
        return True
    if not attributes.strip():
        return False
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "role" and value.lower() in _ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        if key == "style" and _HIDDEN.search(value):
            return True
    return False


def _is_named_part(name: str, attributes: str) -> bool:
    """Whether a class or id names a part; names after a neutral word of theirs do not count."""
    if name in _WHOLE or not attributes.strip():
        return False
    for key, value in _ATTRIBUTE.findall(attributes):
        if key.lower() not in ("class", "id"):
            continue
        for one in value.strip("\"'").split():
            for word in _NAME_PART.findall(one):
                if word.lower() in _NEUTRAL:
                    break
                if word.lower() in _PARTS:
                    return True
    return False


def blocks(page: str, spared: frozenset[int] = frozenset()) -> list[Block]:
    """All blocks with text, in page order. Class words do not judge elements that start at ``spared``.

    Those are the elements around the page's first ``main``, or its first ``article`` where it has none: known
    only once that starts, so such a page is read again.
    """
    out: list[Block] = []
    # Elements that matter: name, outside, main, number, start, and whether class words judged it.
    open_: list[tuple[str, bool, bool, int, int, bool]] = []
    # How many of each name are open: a page of open or of stray tags is read in linear time.
    depth: Counter[str] = Counter()
    around: dict[str, list[tuple[int, bool]]] = {}
    current = Block("", False, False, 0)
    at, in_link, number = 0, False, 0

    def state() -> tuple[bool, bool, int]:
        return open_[-1][1:4] if open_ else (False, False, 0)

    def begin(tag: str) -> None:
        nonlocal current, in_link
        if current.pieces:
            current.text = " ".join(html.unescape("".join(t for t, _ in current.pieces)).split())
            if current.text:
                out.append(current)
        current, in_link = Block(tag, *state()), False

    def close() -> str:
        name = open_.pop()[0]
        depth[name] -= 1
        return name

    while at < len(page):
        token = page.find("<", at)
        if token < 0:
            token = len(page)
        if token > at:
            current.pieces.append((page[at:token], in_link))
        if token == len(page):
            break
        match = _TOKEN.match(page, token)
        if not match:
            after = page[token + 1 : token + 2]
            if after.isalpha() or after == "/":  # a tag that never ends
                end = page.find(">", token)
                if end < 0:
                    break
                at = end + 1
            else:
                current.pieces.append(("<", in_link))
                at = token + 1
            continue
        at = match.end()
        name = (match["name"] or "").lower()
        if not name:
            continue
        if match["close"]:
            if name == "a":
                in_link = False
            if depth[name]:
                begin("")
                while close() != name:
                    pass
                current.outside, current.main, current.parent = state()
            elif name in _BLOCKS:
                begin("")
            continue
        if name in _RAW:
            if not match["attributes"].rstrip().endswith("/"):
                end = re.compile(f"</{re.escape(name)}\\b[^>]*>", re.IGNORECASE).search(page, at)
                at = end.end() if end else len(page)
            continue
        outside, main, _ = state()
        if name == "a":
            in_link = True
        if name in _BLOCKS:
            # A new block ends an open paragraph or item that was only kept for its class.
            if open_ and open_[-1][0] == "p":
                close()
                outside, main, _ = state()
            if open_ and open_[-1][0] == name and name in ("li", "dt", "dd", "tr", "td", "th", "option"):
                close()
                outside, main, _ = state()
        if name in _MAIN and name not in around:
            around[name] = [o[4:] for o in open_]
        part = _is_part(name, match["attributes"], main)
        named = not part and token not in spared and _is_named_part(name, match["attributes"])
        part = part or named
        keeps = part or name in _MAIN or depth[name] > 0 or name in ("div", "section")
        if keeps and name not in _VOID and not match["attributes"].rstrip().endswith("/"):
            number += 1
            depth[name] += 1
            open_.append((name, outside or part, main or name in _MAIN, number, token, named))
            begin(name)
        elif name in _BLOCKS:
            begin(name)
    begin("")
    judged = around.get("main", around.get("article", []))
    if not spared and any(named for _, named in judged):
        return blocks(page, frozenset(start for start, _ in judged))
    return out


def _dense(block: Block) -> bool:
    words = _WORD.findall(block.text.lower())
    return sum(w in _STOP for w in words) >= STOP_DENSITY * max(1, len(words))


def _first_label(block: Block, has_main: bool) -> bool | None:
    if block.outside:
        return False
    length = sum(len(t.strip()) for t, _ in block.pieces)
    linked = sum(len(t.strip()) for t, link in block.pieces if link)
    if linked > LINK_DENSITY * max(1, length):
        return False
    if block.main:
        return True
    if has_main or len(block.text) < LONG:
        return None
    return _dense(block)


def _nearest(labels: list[bool | None], order: range) -> list[int | None]:
    """The last decided block before each one in the given order."""
    out: list[int | None] = [None] * len(labels)
    last = None
    for k in order:
        out[k] = last
        if labels[k] is not None:
            last = k
    return out


def _inherited(at: int, found: list[Block], labels: list[bool | None], back: int | None, ahead: int | None) -> bool:
    """The label of the nearest decided block; see the module for two as near."""
    if back is None or ahead is None:
        one = ahead if back is None else back
        return one is not None and bool(labels[one])
    if at - back != ahead - at:
        return bool(labels[back if at - back < ahead - at else ahead])
    siblings = [k for k in (back, ahead) if found[k].parent == found[at].parent]
    if len(siblings) == 1:
        return bool(labels[siblings[0]])
    if found[at].tag in _HEADINGS:
        return bool(labels[ahead])
    return bool(labels[back] and labels[ahead])


def main_text(page: str | None) -> str:
    """The text of the content blocks, joined by one space."""
    found = blocks(page) if page else []
    has_main = any(b.main for b in found)
    labels = [_first_label(b, has_main) for b in found]
    if not any(labels):
        labels = [True if label is None and _dense(b) else label for b, label in zip(found, labels, strict=True)]
    before = _nearest(labels, range(len(found)))
    after = _nearest(labels, range(len(found) - 1, -1, -1))
    return " ".join(
        block.text
        for k, (block, label) in enumerate(zip(found, labels, strict=True))
        if (label if label is not None else _inherited(k, found, labels, before[k], after[k]))
    )


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages`` (page_id, url, html)."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "html", _BYTES):
                texts = [main_text(p) for p in batch.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:2], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    return arrow_map(
        pages.selectExpr("CAST(page_id AS LONG) page_id", "url", "html"),
        of,
        "page_id long, url string, text string, n_chars long",
    )
