"""Main text of web pages: two passes over their blocks."""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.common import table

# HTML elements by what they do, name parts of boilerplate, function words of four languages.
BLOCK = set(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main nav ol option p pre section select summary table "
    "tbody td tfoot th thead title tr ul".split()
)
RAW = set("script style noscript template textarea title svg iframe object math canvas audio video".split())
BOILER = set("nav footer aside form head button select dialog menu".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
NAMES = set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies copyright disclaimer disqus footer header login masthead menu nav navbar navigation newsletter notice "
    "notices pager pagination popup promo promotion related replies reply respond share sharing sidebar signup skip "
    "social sponsor sponsored subscribe tags toolbar widget".split()
)
WHOLE = set("html body main article".split())  # their names speak of the page's layout, not of their text
ROLES = set("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
STOP = set(
    "the of and to in is it that for was on are with as be by this at from or an a not have which you he his they we "
    "le la les de des du un une et en est que qui pour dans au aux sur par pas ne se ce il elle "
    "der die das und ist nicht ein eine den dem zu mit für auf von im auch sich als es an "
    "el los las del y que en por con para una su se al lo no más como un".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.DOTALL
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$|/)|display\s*:\s*none", re.IGNORECASE)
_EDGE = re.compile(r"^\W+|\W+$")


def _is_boiler(name: str, attributes: str, in_article: bool) -> bool:
    if name in BOILER or (name == "header" and not in_article):
        return True
    for key, *values in _ATTRIBUTE.findall(attributes):
        parts = set(re.split(r"[\s_-]+", "".join(values).lower()))
        if key.lower() == "role":
            if parts & ROLES:
                return True
        elif name not in WHOLE and parts & NAMES:
            return True
    return bool(attributes and _HIDDEN.search(attributes))


def blocks(page: str) -> Iterator[tuple[str, int, bool, bool]]:
    """(text, characters inside links, boilerplate by structure, inside an article) in page order."""
    parts: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # name, boilerplate from here on, article from here on
    raw, at, links = "", 0, 0

    def close():
        text = " ".join(references.unescape("".join(parts)).split())
        inside = len(" ".join(references.unescape("".join(linked)).split()))
        parts.clear()
        linked.clear()
        return text, inside

    for token in _TOKEN.finditer(page):
        name = (token[2] or "").lower()
        if raw and not (token[1] and name == raw):
            if f"</{raw}" in token[0].lower():  # a quote in a script swallowed the end
                raw, at = "", token.end()
            continue
        boiler, article = (stack[-1][1], stack[-1][2]) if stack else (False, False)
        if not raw:
            parts.append(page[at : token.start()])
            if links:
                linked.append(page[at : token.start()])
        at = token.end()
        if raw:
            raw = ""
            continue
        if not name:
            continue
        if name in BLOCK:
            text, inside = close()
            if text:
                yield text, inside, boiler, article
        elif name == "br":
            parts.append(" ")
        if name == "a":
            links = 0 if token[1] else 1
        if token[1]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
        elif token[3].endswith("/"):
            continue
        elif name in RAW:
            raw = name
        elif name not in VOID:
            if name in ("p", "li") and stack and stack[-1][0] == name:
                stack.pop()
            inner = article or name in ("article", "main")
            stack.append((name, boiler or _is_boiler(name, token[3], article), inner))
    if not raw:
        parts.append(page[at:])
    text, inside = close()
    if text:
        boiler, article = (stack[-1][1], stack[-1][2]) if stack else (False, False)
        yield text, inside, boiler, article


def _stop_words(text: str) -> tuple[int, int]:
    words = [_EDGE.sub("", w).lower() for w in text.split()]
    return sum(w in STOP for w in words), len(words)


def main_text(page: str | None, short: int = 80, stop_low: float = 0.1, link_high: float = 0.4) -> str:
    """The page's text blocks, one per line; empty for null, empty or all-boilerplate pages.

    First pass: link density, structure and stop-word density decide a block; short ones, and unusual ones inside
    an article, stay open. Where the whole page has hardly any stop words, its language is none of the four and length
    stands in for them in the article, or anywhere if there is none. Second pass: an open block looks at its nearest neighbours
    on the same side of the article's border that text or links decided. Inside an article it is dropped only between two
    dropped ones, and only if the article has decided text at all. Outside it takes their verdict; if they differ or there are
    none it is dropped, but without any article, a page's open blocks next to text on either side are text.
    """
    found = list(blocks(page or ""))
    any_article = any(block[3] for block in found)
    loose = [not boiler and inside <= link_high * len(text) for text, inside, boiler, _ in found]
    stops = [_stop_words(block[0]) if free else (0, 0) for block, free in zip(found, loose, strict=True)]
    foreign = sum(n for n, _ in stops) < stop_low / 2 * sum(n for _, n in stops)
    verdicts: list[bool | None] = []  # True: text; False: boilerplate; None: open until the second pass
    for (text, _, _, article), free, (hits, n) in zip(found, loose, stops, strict=True):
        if not free:
            verdicts.append(False)
        elif len(text) >= short and (hits >= stop_low * n or (foreign and (article or not any_article))):
            verdicts.append(True)
        else:
            verdicts.append(None if len(text) < short or article or foreign else False)
    left: list[bool | None] = []
    right: list[bool | None] = []
    for order, out in ((range(len(found)), left), (range(len(found) - 1, -1, -1), right)):
        last: dict[bool, bool | None] = {True: None, False: None}
        for k in order:
            out.append(last[found[k][3]])
            if verdicts[k] is not None and not found[k][2]:
                last[found[k][3]] = verdicts[k]
    right.reverse()
    text_in_article = any(verdict and block[3] for verdict, block in zip(verdicts, found, strict=True))
    kept = []
    for k, (text, _, _, article) in enumerate(found):
        verdict = verdicts[k]
        if verdict is None and article:
            verdict = not (text_in_article and left[k] is False and right[k] is False)
        elif verdict is None:
            near = {left[k], right[k]} - {None}
            verdict = near == {True} or (not any_article and True in near)
        if verdict:
            kept.append(text)
    return "\n".join(kept)


def extract(pages: DataFrame, html: str = "html", into: str = "text") -> DataFrame:
    """``pages`` with the main text in column ``into`` and its code points in ``n_chars``, replacing columns so named.

    One row out per row in, whatever repeats or is null; an empty table stays empty.
    """
    body = F.pandas_udf(lambda column: pd.Series([main_text(page) for page in column], dtype=object), "string")
    return pages.withColumn(into, body(F.col(html))).withColumn("n_chars", F.char_length(into).cast("long"))


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", "n_chars")
