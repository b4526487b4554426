"""Main text of web pages by the distribution of text over lines.

Markup is stripped into lines, one per block of the page. Text lengths are summed
over a sliding window of lines; where the sum surges the main text begins, where
it dives it ends, and lines between are kept. Menus, forms, adverts, notices,
comments and the like are left out before; articles that hold most of the text
bound it, and where they do, all their lines are kept.
"""

from __future__ import annotations

import re
from html import unescape

from pyspark.sql import DataFrame

from .common import map_rows

# A quotation mark opens a value only behind an equals sign; anywhere else it is a character like others.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|"
    r"<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/<>]*)(?P<attributes>(?>(?:=\s*(?:\"[^\"]*\"|'[^']*')|[^<>])*))>",
    re.DOTALL | re.IGNORECASE,
)
# Elements whose content is no text of the page, and those of them that run to the end unless closed.
RAW = frozenset("script style noscript template textarea svg math iframe object select title".split())
CODE = frozenset(("script", "style"))
FOREIGN = frozenset(("svg", "math"))
# First words of class names that tell a state and not what the element is.
STATES = frozenset("has have no not with without is show hide".split())
# Elements that start a new block, and those that hold no main text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section "
    "summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FURNITURE = frozenset("nav header footer aside form button menu dialog head search fieldset label".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs captcha comment comments "
    "alert commentlist consent cookie cookies copyright disclaimer discussion disqus feedback footer gdpr header login "
    "masthead menu modal nav navbar navigation newsletter notice notices notification overlay pagination pager popup promo promoted "
    "recommended related replies respond share sharing sidebar signup skip social sponsor sponsored subscribe "
    "subscription tags teaser toast toc toolbar topbar widget widgets".split()
)
ATTRIBUTE = re.compile(r"""([\w:-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
WORD = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
WINDOW = 3  # lines summed together
SURGE = 40  # characters in a window that start the main text


def _is_furniture(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in FURNITURE and not (tag == "header" and in_article):
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    for name, value in ATTRIBUTE.findall(attributes):  # names outside values only
        name, value = name.lower(), value.strip("\"'")
        if name == "role" and value.lower() in ROLES:
            return True
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
        if name in ("class", "id"):
            # The first or last word of a name tells what the element is.
            for part in value.split():
                words = WORD.findall(CAMEL.sub("-", part).lower())
                if words and words[0] not in STATES and (words[0] in NAMES or words[-1] in NAMES):
                    return True
    return False


def page_lines(html: str) -> list[tuple[str, int, bool]]:
    """(text, weight, within an article) of every block with text, in page order.

    An element of furniture counts only if it is closed; its lines weigh nothing.
    Link text adds no weight.
    """
    tokens, at = [], 0
    unclosed: set[str] = set()
    while m := TOKEN.search(html, at):
        if m.start() > at:
            tokens.append((None, False, html[at : m.start()], ""))
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        close, attributes = bool(m["close"]), m["attributes"]
        if tag in RAW and not close:
            if tag in FOREIGN and m[0].endswith("/>"):
                continue
            end = None if tag in unclosed else re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(html, at)
            if end or tag in CODE:
                at = end.end() if end else len(html)
                if tag not in FOREIGN:
                    tokens.append(("br", False, "", ""))
            else:
                unclosed.add(tag)
            continue
        tokens.append((tag, close, "", attributes))
    if at < len(html):
        tokens.append((None, False, html[at:], ""))

    # Where each furniture element ends: the close of its own tag, counting nested ones.
    open_tags: dict[str, list[int]] = {}
    end_of: dict[int, int] = {}
    for i, (tag, close, _, attributes) in enumerate(tokens):
        if tag is None or tag in VOID:
            continue
        if not close:
            if not attributes.endswith("/"):
                open_tags.setdefault(tag, []).append(i)
        elif open_tags.get(tag):
            end_of[open_tags[tag].pop()] = i

    # Text outside links before each token, in all and within an article: what holds most of it is no furniture.
    before, before_main, depth, linking = [0], [0], 0, False
    for tag, close, words, _ in tokens:
        if tag == "a":
            linking = not close
        elif tag in ("article", "main"):
            depth = max(0, depth - 1) if close else depth + 1
        size = 0 if linking or tag else len(words.strip())
        before.append(before[-1] + size)
        before_main.append(before_main[-1] + (size if depth else 0))

    def holds_most(tag: str, a: int, b: int) -> bool:
        held, outside = before[b] - before[a], before_main[-1] - (before_main[b] - before_main[a])
        if outside and tag in FURNITURE and tag != "form":
            return False  # a long footer beside a short article
        return held >= SURGE and 2 * held > before[-1] and 3 * outside < held

    lines: list[tuple[str, int, bool]] = []
    text: list[str] = []
    linked = article = link = 0
    off_until = inline_from = -1

    def flush(weighs: bool) -> None:
        nonlocal linked, link
        line = " ".join(unescape("".join(text)).split())
        if line:
            lines.append((line, max(0, len(line) - linked) if weighs else 0, article > 0) if weighs else (line, -1, False))
        text.clear()
        linked = link = 0

    for i, (tag, close, words, attributes) in enumerate(tokens):
        on = i > off_until
        if tag is None:
            text.append(words)
            if link:
                linked += len(words.strip())
            continue
        if tag in BLOCKS:
            if on or inline_from < 0:
                flush(on)
            else:
                del text[inline_from:]
        elif tag == "br" or tag == "img":
            text.append(" ")
        if tag == "a":
            link = 0 if close else 1
        if tag in ("article", "main"):
            article = max(0, article - 1) if close else article + 1
        if on and not close and i in end_of and _is_furniture(tag, attributes, article > 0) and not holds_most(tag, i, end_of[i]):
            off_until = end_of[i]
            if tag in BLOCKS or tag in FURNITURE:
                flush(True)
                inline_from = -1
            else:
                inline_from = len(text)  # the block goes on behind it
        elif i == off_until:
            if inline_from >= 0:
                del text[inline_from:]
            else:
                flush(False)
    flush(len(tokens) > off_until + 1)
    return lines


def main_lines(lines: list[tuple[str, int, bool]]) -> list[str]:
    """Lines between surge and dive points of the windowed text lengths.

    Furniture is left out first, so it neither adds to a window nor parts what
    stands on its two sides. Text begins where a window of lines reaches the
    surge, with the lines of text right before (a title, a byline), and ends where a
    whole window weighs nothing, as among links. It may begin again behind. A page
    that never reaches the surge begins at its largest window.

    Articles are an outer bound where they hold most of the text: then the lines
    outside are left out too, and no line within is left behind.
    """
    shown = [line for line in lines if line[1] >= 0]
    whole = sum(weight for _, weight, _ in shown)
    within = sum(weight for _, weight, inside in shown if inside)
    if any(inside for _, _, inside in shown) and 2 * within >= whole:
        return [text for text, _, inside in shown if inside] if within else []
    weights = [weight for _, weight, _ in shown]
    sums = [sum(weights[i : i + WINDOW]) for i in range(len(weights))]
    surge = min(SURGE, max(sums, default=0))
    kept, inside = [False] * len(shown), False
    for i, weight in enumerate(weights):
        if not inside and weight and sums[i] >= surge:
            inside = True
            first = i
            while first and weights[first - 1] and not kept[first - 1]:
                first -= 1
                kept[first] = True
        elif inside and not sums[i]:
            inside = False
        kept[i] = inside
    return [text for (text, _, _), ok in zip(shown, kept) if ok]


def extract_text(html: str | None) -> str:
    return "\n".join(main_lines(page_lines(html or "")))


def main_texts(pages: DataFrame, key_columns: list[str], html_column: str) -> DataFrame:
    """Main text of every page, from its whole markup, in one pass without a shuffle.

    Returns ``key_columns``, ``text`` (blocks joined by a line feed; empty if none)
    and ``n_chars``, its code points. One row per input row: repeated rows and null
    keys stay; null or empty markup gives an empty text; an empty table gives an
    empty result; other columns are ignored. Key columns may not be named ``text``
    or ``n_chars``.
    """
    if {"text", "n_chars"} & set(key_columns):
        raise ValueError("key columns may not be named text or n_chars")
    names = [f"key_{i}" for i in range(len(key_columns))]
    rows = pages.select(*[pages[c].alias(n) for c, n in zip(key_columns, names)], pages[html_column].alias("html"))

    def scan(batch: dict):
        texts = [extract_text(html) for html in batch.pop("html")]
        yield {**batch, "text": texts, "n_chars": [len(t) for t in texts]}

    kinds = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in names)
    found = map_rows(rows, scan, f"{kinds}, text string, n_chars bigint")
    for name, column in zip(names, key_columns):
        found = found.withColumnRenamed(name, column)
    return found
