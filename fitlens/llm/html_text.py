"""Main text of web pages by two-pass block rules.

First pass: each block of text is good or bad by its stop-word density, length and link density, or by an element around it
that is never article text; short and unclear blocks stay open. Second pass: open blocks take the label of the nearest decided
neighbours, and headings that of what they head. A main part that the page marks counts as one more sign.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fitlens.llm.quality import STOP_WORDS
from fitlens.llm.registry import query, table

# Shares and lengths of the first pass.
LINKS_HIGH = 0.5
LENGTH_LOW, LENGTH_HIGH = 40, 140
STOPS_LOW, STOPS_HIGH = 0.08, 0.2

# HTML elements by their role.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe object svg math canvas audio video select textarea title noframes xmp".split())
BOILERPLATE = frozenset("head nav footer aside form menu dialog button".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = BLOCKS - frozenset(("body", "html"))
# Words in class, id and role that name parts which are no article text.
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices notification alert popup modal overlay newsletter subscribe subscription signup login menu nav navbar "
    "navigation breadcrumb breadcrumbs sidebar rail widget widgets related recommended recommendations trending share sharing "
    "social comment comments commentlist disqus reply replies respond footer foot copyright search pagination pager toolbar "
    "skip contentinfo complementary dialog form hidden".split()
)
HEADER_NAMES = frozenset("header masthead topbar".split())
MAIN_NAMES = frozenset(("main", "articlebody"))

# Attributes are read without going back, so that broken markup takes no longer than its length.
TAG = re.compile(r"""<(?:!--(?s:.*?)(?:-->|\Z)|!\[CDATA\[|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/<>]*+)((?:[^"'<>]++|"[^"]*"|'[^']*'|["'])*+)>)""")
NAME_VALUES = re.compile(r"""(?:^|\s)(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)(?:hidden(?=[\s/=]|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)
END_OF = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in RAW}
WORDS = re.compile(r"[^\W\d_]+")

GOOD, BAD, OPEN = 1, 0, -1


@dataclass
class Block:
    text: str
    linked: int
    barred: bool
    main: bool
    heading: str = ""


def blocks_of(page: str) -> list[Block]:
    """Blocks with text in page order. Unclosed and crossed elements are closed by what follows them."""
    out: list[Block] = []
    pieces: list[str] = []
    linked = links = 0
    stack: list[tuple[str, bool, bool]] = []  # name, barred, main: of the element and all around it
    open_names: Counter[str] = Counter()
    barred = main = found_main = False

    def flush() -> None:
        nonlocal pieces, linked, found_main
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                heading = stack[-1][0] if stack and stack[-1][0] in HEADINGS else ""
                out.append(Block(text, linked, barred, main, heading))
                found_main = found_main or (main and not barred)
            pieces, linked = [], 0

    def close(n: int) -> None:
        """Elements from place n of the stack on end here."""
        nonlocal barred, main
        flush()
        open_names.subtract(name for name, _, _ in stack[n:])
        del stack[n:]
        barred, main = stack[-1][1:] if stack else (False, False)

    at, size = 0, len(page)
    while at < size:
        tag = TAG.search(page, at)
        start = tag.start() if tag else size
        if start > at:
            piece = page[at:start]
            pieces.append(piece)
            if links:
                linked += len(" ".join(piece.split()))
        if not tag:
            break
        at = tag.end()
        name = tag.group(2)
        if name is None:
            continue
        name = name.lower()
        if tag.group(1):
            if name == "a":
                links = 0
            elif name in BLOCKS or name in BOILERPLATE:
                n = len(stack) if open_names[name] > 0 else 0
                while n and stack[n - 1][0] != name:
                    n -= 1
                if n:
                    close(n - 1)
                else:
                    flush()
            continue
        if name in RAW:
            end = END_OF[name].search(page, at)
            at = end.end() if end else size
            pieces.append(" ")
            continue
        if name == "a":
            links = 1
            continue
        if name == "br":
            pieces.append(" ")
            continue
        if name == "body":
            close(0)
        if name in BLOCKS or name in BOILERPLATE:
            flush()
            if name in CLOSES_P and stack and stack[-1][0] == "p":
                close(len(stack) - 1)
            if name in ("li", "td", "th", "tr", "dt", "dd") and stack and stack[-1][0] == name:
                close(len(stack) - 1)
            if name in VOID:
                continue
            attributes = tag.group(3)
            names = _names(attributes)
            is_main = name == "main" or name == "article" or bool(names & MAIN_NAMES)
            bad = name in BOILERPLATE or bool(HIDDEN.search(attributes))
            if name not in ("body", "html"):
                bad = bad or bool(names & NAMES)
                # A header of the page; within the article it belongs to it.
                bad = bad or (not main and (name == "header" or bool(names & HEADER_NAMES)))
            if is_main and not bad and name in ("main", "article") and barred and not found_main:
                close(0)  # what should have ended before the article
            barred, main = barred or bad, main or is_main
            stack.append((name, barred, main))
            open_names[name] += 1
    flush()
    return out


def _names(attributes: str) -> set[str]:
    if "=" not in attributes:
        return set()
    return {w for m in NAME_VALUES.finditer(attributes) for w in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", m.group(1) or m.group(2) or m.group(3) or "").lower())} | {
        (m.group(1) or m.group(2) or m.group(3) or "").lower() for m in NAME_VALUES.finditer(attributes)
    }


def first_labels(blocks: list[Block]) -> list[int]:
    """Good, bad or open. If the page marks its main part, what stands outside is bad."""
    marked = any(b.main and not b.barred for b in blocks)
    labels = []
    for b in blocks:
        size = len(b.text)
        links = b.linked / size
        if b.barred or (marked and not b.main):
            labels.append(BAD)
        elif links > LINKS_HIGH:
            # In the article a linked heading is decided by what it heads.
            labels.append(OPEN if marked and b.heading else BAD)
        elif size < LENGTH_LOW:
            labels.append(OPEN)
        else:
            words = WORDS.findall(b.text.lower())
            stops = sum(w in STOP_WORDS for w in words) / max(1, len(words))
            if stops >= STOPS_HIGH or (stops >= STOPS_LOW and size >= LENGTH_HIGH):
                labels.append(GOOD)
            elif stops >= STOPS_LOW or marked:
                labels.append(OPEN)  # in the article also tables, code and other languages
            else:
                labels.append(BAD)
    return labels


def last_labels(blocks: list[Block], labels: list[int]) -> list[int]:
    """Open blocks take the label of the nearest decided neighbour in the same part of the page. At equal distance, or without
    a decided neighbour, they are good in a marked main part and bad elsewhere. A heading in a main part is bad if all that stands
    below it, up to the next heading, is bad, and good otherwise; the title of the part is good."""
    n = len(blocks)
    heads_bad = [False] * n
    below: set[int] = set()
    for i in range(n - 1, -1, -1):
        if blocks[i].heading or not blocks[i].main:
            heads_bad[i], below = below == {BAD}, set()
        else:
            below.add(labels[i])
    # Distance to, and label of, the nearest decided block on either side.
    sides = []
    for places in (range(n), range(n - 1, -1, -1)):
        near: list[tuple[int, int] | None] = [None] * n
        last: tuple[int, int, bool] | None = None
        for i in places:
            if last is not None and last[2] == blocks[i].main:
                near[i] = (abs(i - last[0]), last[1])
            if labels[i] != OPEN and not (blocks[i].barred and blocks[i].main):
                last = (i, labels[i], blocks[i].main)
        sides.append(near)
    out = list(labels)
    for i in range(n):
        if labels[i] == OPEN and blocks[i].heading and blocks[i].main:
            out[i] = BAD if heads_bad[i] and blocks[i].heading != "h1" else GOOD
        elif labels[i] == OPEN:
            before, after = sides[0][i], sides[1][i]
            if before and after and before[1] != after[1] and before[0] != after[0]:
                out[i] = min(before, after)[1]
            elif before and after and before[1] != after[1]:
                out[i] = GOOD if blocks[i].main else BAD
            elif before or after:
                out[i] = (before or after)[1]
            else:
                out[i] = GOOD if blocks[i].main else BAD
    return out


def main_text(page: str | None) -> str:
    """Good blocks in page order, joined by line breaks; empty if there are none."""
    blocks = blocks_of(page or "")
    labels = last_labels(blocks, first_labels(blocks))
    return "\n".join(b.text for b, label in zip(blocks, labels) if label == GOOD)


def extract_pages(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """``(key, url, text, n_chars)`` of every page.

    Null counts as an empty page; empty pages, pages without text and pages of boilerplate only have an empty text. Repeated
    rows and null keys are treated one by one; extra columns are left out. A page is held whole by the task that reads it.
    """

    @F.pandas_udf("string")
    def extracted(column: pd.Series) -> pd.Series:
        return pd.Series([main_text(x) for x in column], dtype=object)

    rows = pages.select(F.col(key), F.col(url), extracted(F.col(page)).alias("text"))
    return rows.withColumn("n_chars", F.char_length("text").cast("long"))


@query("op4_block_rules")
def op4_block_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_pages(table(spark, sf_dir, "pages"))
