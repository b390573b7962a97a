"""Main text of web pages by line-block distribution."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroweave.llm.shared import arrow_schema, record_batch, sliced

#: Lines that one block sums up.
BLOCK_LINES = 3
#: Characters that a block must reach for text to surge, or half of the page's fullest block if that is less.
SURGE_CHARS = 80
#: A line that the page marks as its article weighs so many times its characters.
ARTICLE_WEIGHT = 4
#: Characters that a line of link text counts at most, as a share of its length.
LINK_SHARE = 0.5

# Fixed values of HTML: elements that end a line, whose text is none, that have no end tag.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option optgroup p pre search "
    "section select summary table tbody td template tfoot th thead title tr ul".split())
RAW_TAGS = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that hold no article text.
ASIDE_TAGS = frozenset(
    "head nav footer aside form script style noscript template iframe button select textarea svg canvas object audio video "
    "math dialog menu search".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar".split())
#: Words in class or id that mark what isn't the article.
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo banner menu nav navbar navigation breadcrumb "
    "breadcrumbs sidebar aside widget footer header masthead cookie cookies consent gdpr notice notices alert popup modal "
    "overlay comment comments disqus respond replies share sharing social related recommended newsletter subscribe signup "
    "login search toolbar pagination pager copyright disclaimer".split())
_ASIDE = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])")
_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:-->|--!>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)|</[^a-zA-Z>][^>]*(?:>|\Z)|</>""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+))""")
_ENDS_P = BLOCK_TAGS - {"body", "html", "head", "option", "optgroup", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "title", "legend"}
_SCHEMA = "page_id long, url string, text string, n_chars long"


class Line(NamedTuple):
    text: str
    linked: int
    aside: bool
    article: int  # number of the outermost element that marks an article, or 0
    path: tuple[int, ...]  # numbers of the elements around it but for the page and its body, from the outermost


def _is_aside(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in ASIDE_TAGS or (tag == "header" and not in_article):
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    if re.search(r"(?:^|\s)hidden(?:$|[\s=])", attributes):
        return True
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next((v for v in values if v), "")
        if name == "role" and value.lower() in ASIDE_ROLES or name == "aria-hidden" and value.lower() == "true":
            return True
        if name in ("class", "id") and any(word.lower() in ASIDE_WORDS for word in _ASIDE.split(value)):
            return True
        if name == "style" and re.search(r"display\s*:\s*none", value):
            return True
    return False


def page_lines(html: str) -> list[Line]:
    """The page without markup, a line for each block of text, with what the markup says about it.

    Character references are decoded after the markup is cut away; white space inside a line becomes one space.
    """
    lines: list[Line] = []
    open_tags: list[tuple[str, bool, int, int]] = []  # tag, aside, article (as they hold inside it), number
    pieces: list[str] = []
    linked, links, aside, article, at, number = 0, 0, False, 0, 0, 0

    def end_line():
        nonlocal linked
        text = " ".join(unescape("".join(pieces)).split())
        if text:
            lines.append(Line(text, min(linked, len(text)), aside, article, tuple(t[3] for t in open_tags if t[0] not in ("html", "body"))))
        pieces.clear()
        linked = 0

    def add(text: str):
        nonlocal linked
        if text:
            pieces.append(text)
            if links:
                linked += len(unescape(text).strip())

    def close(down_to: int):
        nonlocal aside, article
        del open_tags[down_to:]
        aside, article = open_tags[-1][1:3] if open_tags else (False, 0)

    while token := _TOKEN.search(html, at):
        add(html[at:token.start()])
        at = token.end()
        tag = token[2]
        if not tag:
            continue
        tag = tag.lower()
        if tag == "br":
            pieces.append(" ")
        elif token[1]:
            if tag in BLOCK_TAGS:
                end_line()
            links = max(0, links - (tag == "a"))
            for i in range(len(open_tags) - 1, -1, -1):
                if open_tags[i][0] == tag:
                    close(i)
                    break
        else:
            if tag in BLOCK_TAGS:
                end_line()
            if tag in _ENDS_P and open_tags and open_tags[-1][0] == "p":
                close(len(open_tags) - 1)
            if tag in ("li", "dt", "dd", "option", "tr", "td", "th") and open_tags and open_tags[-1][0] == tag:
                close(len(open_tags) - 1)
            if tag in RAW_TAGS:
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(html, at)
                at = end.end() if end else len(html)
                continue
            links += tag == "a"
            if tag not in VOID_TAGS and (tag in BLOCK_TAGS or tag in ASIDE_TAGS or token[3]):
                inside = aside or _is_aside(tag, token[3], article > 0)
                if inside != aside and tag not in BLOCK_TAGS:
                    end_line()
                number += 1
                aside = inside
                if not article and (tag in ("article", "main") or "main" == _role(token[3])):
                    article = number
                if not token[3].endswith("/") or tag in BLOCK_TAGS:
                    open_tags.append((tag, aside, article, number))
    add(html[at:])
    end_line()
    return lines


def _role(attributes: str) -> str:
    found = re.search(r"""\brole\s*=\s*["']?([a-z]+)""", attributes, re.I) if "role" in attributes else None
    return found[1].lower() if found else ""


def _stretches(weights: list[int], level: float, block_lines: int) -> list[list[int]]:
    """Runs of lines with weight, from where a block reaches ``level`` to where a block is empty."""
    found, now = [], None
    for i in range(len(weights)):
        block = sum(weights[i:i + block_lines])
        if now is None and weights[i] and block >= level:
            now = []
        if now is not None:
            if not block:
                found.append(now)
                now = None
            elif weights[i]:
                now.append(i)
    return found + [now] if now else found


def _container(lines: list[Line], core: list[int]) -> tuple[int, ...]:
    """The elements that all lines of ``core`` have around their own."""
    path = lines[core[0]].path[:-1]
    for i in core[1:]:
        same = 0
        for a, b in zip(path, lines[i].path[:-1]):
            if a != b:
                break
            same += 1
        path = path[:same]
    return path


def article_lines(lines: list[Line], block_lines: int = BLOCK_LINES, surge_chars: int = SURGE_CHARS) -> list[str]:
    """Lines of the article: what surges and dives finds it, the elements around it say how far it goes.

    A line weighs its characters, or nothing if markup says that it isn't article text, also when links make up most of it; in an
    element that marks an article it weighs ARTICLE_WEIGHT times as much. A block sums ``block_lines`` lines from each on. Text surges at
    a line with weight where a block reaches ``surge_chars``, or half of the fullest block if that is less, and dives where a block is
    empty. The stretch of most weight is the core. Around it, all that has weight between the first surge and the last dive is kept of
    the marked article it lies in, there with lines of links too, or else of the innermost element that holds all of it. Where that is
    the page itself, stretches that surge are kept.
    """
    plain = [0 if line.aside else len(line.text) for line in lines]
    weights = [
        0 if line.linked > LINK_SHARE * len(line.text) else n * (ARTICLE_WEIGHT if line.article else 1) for n, line in zip(plain, lines)]
    weights = weights if any(weights) else plain  # a page of links alone
    blocks = [sum(weights[i:i + block_lines]) for i in range(len(weights))]
    level = min(surge_chars, max(blocks, default=0) / 2)
    stretches = _stretches(weights, level, block_lines)
    if not stretches:
        return []
    core = max(stretches, key=lambda s: sum(weights[i] for i in s))
    marks = {lines[i].article for i in core} - {0}
    if marks:
        mark = max(marks, key=lambda m: sum(weights[i] for i in core if lines[i].article == m))
        kept = [i for i, line in enumerate(lines) if line.article == mark and plain[i]]
    else:
        around = _container(lines, core)
        if around:
            kept = [i for i, line in enumerate(lines) if line.path[:len(around)] == around and weights[i]]
        else:
            kept = [i for s in stretches for i in s]
    return [lines[i].text for i in kept]


def main_text(html: str) -> str:
    return "\n".join(article_lines(page_lines(html)))


def _extract(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(_SCHEMA)
    for part in sliced(parts):
        texts = [main_text(html or "") for html in part.column(2).to_pylist()]
        yield record_batch(zip(part.column(0).to_pylist(), part.column(1).to_pylist(), texts, map(len, texts)), schema)


def extract_text(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html",
) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every row of ``pages``; whole pages, no shuffle.

    A null or empty page, or one without article text, has the empty text. Null ids and URLs pass through, repeated rows
    repeat, other columns are left out. Pages may be of any length; an empty table gives no rows.
    """
    return pages.select(
        F.col(id_column).cast("long"), F.col(url_column).cast("string"), F.col(html_column).cast("string")
    ).mapInArrow(_extract, _SCHEMA).toDF(id_column, url_column, "text", "n_chars")
