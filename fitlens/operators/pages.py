"""Links and readable text of stored web pages.

Every step works inside the row of one page. Pages of a site meet only in ``site_text``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fitlens.constants import ABOUT_PATTERNS, UNREADABLE_TAGS
from fitlens.functions.text import md5_number
from fitlens.operators.joins import null_safe_join
from fitlens.session import stored

# An absolute URL in running text or in an attribute.
URL = r"https?://[^\s\\>\"')]+"
SITE = r"^(https?://[^/?#]+)"
SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"
TEXT_CHARS = 1_000_000


def _without(html: Column, tags: Sequence[str]) -> Column:
    """A page without comments and without elements of these names and all that is in them."""
    out = F.regexp_replace(html, r"(?s)<!--.*?-->", " ")
    for tag in tags:
        if tag in ("script", "style"):  # what looks like a tag in them is none
            out = F.regexp_replace(out, rf"(?is)<{tag}(?:\s[^>]*)?>.*?</{tag}\s*>", " ")
        else:
            out = _without_nested(out, tag)
    return out


def _without_nested(html: Column, tag: str) -> Column:
    """A page without the outermost elements of a name; one that is never closed goes on to the end."""
    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("text"))

    def step(state: Column, piece: Column) -> Column:
        opens, closes = piece.rlike(rf"(?i)^<{tag}[\s>]"), piece.rlike(rf"(?i)^</{tag}\s*>")
        depth = F.greatest(state["depth"] + F.when(opens, 1).when(closes, -1).otherwise(0), F.lit(0))
        after = F.when(closes & (state["depth"] > 0), F.concat(F.lit(" "), F.regexp_replace(piece, "^[^>]*>", ""))).otherwise(piece)
        return F.struct(depth.alias("depth"), F.concat(state["text"], F.when(depth > 0, "").otherwise(after)).alias("text"))

    pieces = F.split(html, rf"(?i)(?=<{tag}[\s>]|</{tag}\s*>)")
    return F.aggregate(pieces, start, step, lambda state: state["text"])


def _pieces(html: Column, tag: str) -> Column:
    """What follows each opening of a tag, from its attributes on, up to the next opening."""
    parts = F.split(html, rf"(?i)<{tag}(?=[\s>])")
    return F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))


def _attribute(piece: Column, name: str) -> Column:
    """Attribute of a tag, quoted or bare, or NULL."""
    tag = F.substring_index(piece, ">", 1)
    value = F.regexp_extract(tag, rf"(?is)\s{name}\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", 0)
    bare = F.regexp_replace(value, rf"(?is)^\s{name}\s*=\s*[\"']?|[\"']$", "")
    return F.when(value != "", bare)


def _numbered(text: Column) -> Column:
    """A text with its numeric character references decoded; numbers of no character stay."""
    pieces = F.split(text, "&#(?=[0-9]{1,7};|[xX][0-9a-fA-F]{1,6};)")

    def char(piece: Column) -> Column:
        decimal = F.regexp_extract(piece, "^([0-9]+);", 1)
        number = F.coalesce(
            F.when(decimal != "", decimal.cast("int")), F.conv(F.regexp_extract(piece, "^[xX]([0-9a-fA-F]+);", 1), 16, 10).cast("int")
        )
        valid = (number > 0) & (number < 0x110000) & ~number.between(0xD800, 0xDFFF)
        sign = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, number).otherwise(32)), 8, "0")), "UTF-32")
        return F.when(valid, F.concat(sign, F.regexp_replace(piece, "^[^;]*;", ""))).otherwise(F.concat(F.lit("&#"), piece))

    rest = F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), char)
    return F.when(F.contains(text, F.lit("&#")), F.concat(F.get(pieces, F.lit(0)), F.array_join(rest, ""))).otherwise(text)


def _decoded(text: Column) -> Column:
    text = _numbered(text)
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def _stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def _cleaned(url: Column) -> Column:
    """A link up to its first blank or ``>``."""
    return F.regexp_extract(F.trim(url), r"^[^\s>]*", 0)


def _without_dots(path: Column) -> Column:
    """A path with its ``.`` and ``..`` steps taken; none leads above the root."""
    steps = F.aggregate(
        F.split(F.regexp_replace(path, r"(^|/)(\.\.?)$", "$1$2/"), "/"),
        F.array().cast("array<string>"),
        lambda done, step: F.when(step == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1))))
        .when(step == ".", done)
        .otherwise(F.concat(done, F.array(step))),
    )
    return F.array_join(steps, "/")


def joined_url(base: Column, href: Column) -> Column:
    """``href`` seen from a page at ``base``."""
    site = F.regexp_extract(base, SITE, 1)
    path = F.regexp_extract(base, r"^[^?#]*", 0)
    folder = F.when(path == site, F.concat(site, F.lit("/"))).otherwise(F.regexp_extract(path, r"^.*/", 0))
    return (
        F.when(href.rlike(SCHEME), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(base, r"^https?:", 0), href))
        .when(href.startswith("/"), F.concat(site, href))
        .when(href.startswith("?"), F.concat(path, href))
        .when(href.startswith("#"), F.concat(F.regexp_extract(base, r"^[^#]*", 0), href))
        .when(href.rlike(r"(^|/)\.\.?(/|$)"), F.concat(site, _without_dots(F.concat(F.replace(folder, site), href))))
        .otherwise(F.concat(folder, href))
    )


def links(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``(page_id, url, kind, label)`` of all links of a page.

    Kinds: ``absolute``, ``relative`` (resolved) and ``other`` (mailto and the like) hrefs, absolute
    image sources, and bare URLs in the text. ``label`` is the text in spans of an href link.
    """
    body = _without(F.col(html), ["script", "style"])
    base = F.col(url)

    def parts(piece: Column) -> Column:
        inside = F.regexp_extract(piece, r"(?is)^[^>]*>(.*?)(?:</a|$)", 1)
        spans = F.transform(_pieces(inside, "span"), lambda s: F.regexp_extract(s, r"(?is)^[^>]*>(.*?)(?:</span|$)", 1))
        label = F.regexp_replace(F.array_join(spans, " "), r"<[^>]*>", "")
        return F.struct(_attribute(piece, "href").alias("href"), label.alias("label"))

    def anchor(found: Column) -> Column:
        href = found["href"]
        absolute = href.rlike(f"^{URL}")
        return F.struct(
            F.when(absolute, href).otherwise(joined_url(base, href)).alias("url"),
            F.when(absolute, F.lit("absolute")).when(href.rlike(SCHEME), F.lit("other")).otherwise(F.lit("relative")).alias("kind"),
            found["label"].alias("label"),
        )

    def plain(value: Column, kind: str) -> Column:
        return F.struct(value.alias("url"), F.lit(kind).alias("kind"), F.lit("").alias("label"))

    # In two steps, so that an attribute is looked for once and not wherever it is used.
    hrefs = F.transform(F.transform(_pieces(body, "a"), parts), anchor)
    images = F.transform(_pieces(body, "img"), lambda p: plain(_attribute(p, "src"), "image"))
    images = F.filter(images, lambda i: i["url"].rlike(f"^{URL}"))
    text = _decoded(F.regexp_replace(body, r"<[^>]*>", " "))
    bare = F.transform(F.regexp_extract_all(text, F.lit(f"({URL})"), F.lit(1)), lambda u: plain(u, "text"))
    found = pages.select(page_id, F.explode(F.concat(hrefs, images, bare)).alias("link"))
    return found.select(
        page_id, _cleaned(F.col("link.url")).alias("url"), F.col("link.kind").alias("kind"), F.col("link.label").alias("label")
    ).filter("url is not null and url <> ''")


def about_links(found: DataFrame, patterns: Sequence[str] = ABOUT_PATTERNS) -> DataFrame:
    """Links whose URL or span text matches a pattern, with the number of the first that does."""
    any_of = "(?i)" + "|".join(f"(?:{p})" for p in patterns)
    rank = F.lit(None).cast("int")
    for i, pattern in reversed(list(enumerate(patterns, 1))):
        test = F.col("url").rlike(f"(?i){pattern}") | F.col("label").rlike(f"(?i){pattern}")
        rank = F.when(test, i).otherwise(rank)
    hits = found.filter(F.col("url").rlike(any_of) | F.col("label").rlike(any_of))
    return hits.withColumn("pattern", rank)


def readable_paragraphs(html: Column, min_words: int = 5) -> Column:
    """Texts of the paragraphs with more than ``min_words`` words, outside unreadable elements.

    A paragraph ends at its closing tag or where the next one opens.
    """
    body = _without(html, UNREADABLE_TAGS)
    parts = F.split(body, r"(?i)<p(?:\s[^>]*)?>")
    opened = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))

    def text(part: Column) -> Column:
        inner = F.regexp_replace(part, r"(?is)</p\s*>.*$", "")
        bare = F.regexp_replace(inner, r"\s*<[^>]*>\s*", "")
        return _stripped(_decoded(bare))

    texts = F.transform(opened, text)
    return F.filter(texts, lambda t: (t != "") & (F.size(F.split(t, r"\s+")) > min_words))


def page_text(pages: DataFrame, page_id: str = "page_id", html: str = "html", min_words: int = 5) -> DataFrame:
    """``(page_id, text)``: readable paragraphs of a page, a blank line between them."""
    return pages.select(page_id, F.array_join(readable_paragraphs(F.col(html), min_words), "\n\n").alias("text"))


def site_text(about: DataFrame, site: str, url: str, text: str, chars: int = TEXT_CHARS, sites: DataFrame | None = None) -> DataFrame:
    """``(site, part, text)``: texts of the distinct about pages of a site, NULL if all are empty.

    With ``sites`` (a column ``site``) every one of them is in the result, with NULL in part 0 if it has no about pages.

    A site with more than ``chars`` characters is dealt over several parts by the hash of the
    URL; within a part texts follow the order of their URLs.
    """
    once = about.select(site, url, text).groupBy(site, url).agg(F.max(text).alias(text))
    sizes = once.groupBy(site).agg(
        F.greatest(F.ceil(F.sum(F.length(text)) / F.lit(chars)), F.lit(1)).alias("_parts")
    )
    sizes = sizes.withColumn("_parts", F.coalesce("_parts", F.lit(1)))
    dealt = null_safe_join(once, sizes, [site]).withColumn("part", md5_number(F.col(url)) % F.col("_parts"))
    ordered = F.array_sort(F.collect_list(F.struct(F.col(url).alias("u"), F.col(text).alias("t"))))
    joined = F.array_join(F.transform(F.filter(ordered, lambda r: r["t"] != ""), lambda r: r["t"]), "\n")
    out = dealt.groupBy(site, "part").agg(F.nullif(joined, F.lit("")).alias("text"))
    if sites is None:
        return out
    every = sites.select(site).distinct()
    return null_safe_join(every, out, [site], "left").withColumn("part", F.coalesce("part", F.lit(0).cast("bigint")))


def url_key(url: Column) -> Column:
    """One spelling of an absolute URL for all that name the same page; NULL for what is none.

    Scheme and host are in lower case, the scheme's usual port, the fragment and an empty query go, ``.`` and ``..`` steps are taken,
    an empty path is ``/``, and percent escapes have capital digits.
    """
    parts = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?"
    url = F.trim(url)
    scheme, host = F.lower(F.regexp_extract(url, parts, 1)), F.lower(F.regexp_extract(url, parts, 2))
    host = F.when(scheme == "http", F.regexp_replace(host, ":(80)?$", "")).when(scheme == "https", F.regexp_replace(host, ":(443)?$", "")).otherwise(host)
    path = F.regexp_extract(url, parts, 3)
    # Only paths with dots are taken apart.
    path = F.when(path.rlike(r"(^|/)\.\.?(/|$)"), _without_dots(path)).otherwise(path)
    path = F.when(path == "", "/").otherwise(path)
    rest = F.concat(path, F.regexp_replace(F.regexp_extract(url, parts, 4), r"^\?$", ""))
    pieces = F.split(rest, "(?=%[0-9A-Fa-f]{2})")
    capital = F.array_join(F.transform(pieces, lambda p: F.when(p.rlike("^%[0-9A-Fa-f]{2}"), F.concat(F.upper(F.substring(p, 1, 3)), F.substr(p, F.lit(4)))).otherwise(p)), "")
    rest = F.when(rest.contains("%"), capital).otherwise(rest)
    return F.when(url.rlike(parts) & (host != ""), F.concat(scheme, F.lit("://"), host, rest))


def about_texts(
    sites: DataFrame, pages: DataFrame, site: str = "name", website: str = "website", patterns: Sequence[str] = ABOUT_PATTERNS, chars: int = TEXT_CHARS
) -> DataFrame:
    """``(site, website, part, text)``: what the stored about pages say that the home page of each site links to.

    sites: ``(site, website)``, a site may have several websites. pages: ``(url, html)``, all that were stored. A link finds a
    page, and a website its home page, by ``url_key``, however they are spelled; links to pages that were not stored find
    nothing. Only home pages are read for links and only linked pages for text. Sites without a home page, without about pages or
    without readable text have NULL. Of several stored copies of a page the last by its html counts.
    """
    wanted = sites.select(F.col(site).alias("_site"), F.col(website).alias("_website")).distinct()
    wanted = wanted.withColumn("_key", url_key(F.col("_website")))
    kept = pages.select(url_key(F.col("url")).alias("_key"), "html").filter("_key IS NOT NULL")
    homes = kept.join(wanted.select("_key").distinct(), "_key", "left_semi").groupBy("_key").agg(F.max("html").alias("html"))
    found = about_links(links(homes, "_key", "_key", "html"), patterns)
    # Stored, so that each home page is read for links once.
    targets = stored(found.select("_key", url_key(F.col("url")).alias("_target")).filter("_target IS NOT NULL").distinct())
    read = kept.join(targets.select(F.col("_target").alias("_key")).distinct(), "_key", "left_semi").groupBy("_key").agg(F.max("html").alias("html"))
    texts = read.select(F.col("_key").alias("_target"), F.array_join(readable_paragraphs(F.col("html")), "\n\n").alias("_text"))
    about = wanted.join(targets, "_key").join(stored(texts), "_target").select(F.struct("_site", "_website").alias("_pair"), "_target", "_text")
    every = wanted.select(F.struct("_site", "_website").alias("_pair"))
    out = site_text(about, "_pair", "_target", "_text", chars, every)
    return out.select(F.col("_pair._site").alias(site), F.col("_pair._website").alias(website), "part", F.col("text"))


def container_text(pages: DataFrame, page_id: str, html: str, div_class: str, p_class: str) -> DataFrame:
    """``(page_id, text)``: paragraphs of one class in the first container of a class.

    The container ends where its nested elements are all closed. Pages without it drop out; a
    container without text gives NULL.
    """
    opening = rf"(?is)<div(?=[^>]*\sclass\s*=\s*[\"']{div_class}[\"'])"
    parts = F.split(F.col(html), opening, 2)
    found = pages.withColumn("_parts", parts).filter(F.size("_parts") > 1)
    steps = F.split(F.concat(F.lit("<div"), F.get("_parts", 1)), r"(?i)(?=<div[\s>]|</div)")
    walked = F.aggregate(
        steps,
        F.struct(F.lit(0).alias("depth"), F.lit(False).alias("over"), F.lit("").alias("inside")),
        lambda s, piece: F.struct(
            F.when(s["over"], s["depth"]).otherwise(
                s["depth"] + F.when(piece.rlike("(?i)^</div"), -1).when(piece.rlike("(?i)^<div"), 1).otherwise(0)
            ).alias("depth"),
            (s["over"] | ((s["depth"] == 1) & piece.rlike("(?i)^</div"))).alias("over"),
            F.when(s["over"] | ((s["depth"] == 1) & piece.rlike("(?i)^</div")), s["inside"])
            .otherwise(F.concat(s["inside"], piece))
            .alias("inside"),
        ),
    )
    marked = F.filter(
        _pieces(walked["inside"], "p"),
        lambda p: F.concat(F.lit(" "), F.coalesce(_attribute(p, "class"), F.lit("")), F.lit(" ")).contains(f" {p_class} "),
    )
    texts = F.transform(
        marked,
        lambda p: _decoded(F.regexp_replace(F.regexp_extract(p, r"(?is)^[^>]*>(.*?)(?:</p|$)", 1), r"<[^>]*>", "")),
    )
    return found.select(page_id, F.nullif(F.array_join(texts, ""), F.lit("")).alias("text"))


def first_result(
    pages: DataFrame, page_id: str, html: str, results_class: str, title_class: str, skip: Sequence[str] = ()
) -> DataFrame:
    """``(page_id, url, title)`` of the first card on a search page, unless its title is to be skipped."""
    opening = rf"(?is)<div(?=[^>]*\sclass\s*=\s*[\"']{results_class}[\"'])"
    parts = F.split(F.col(html), opening, 2)
    rest = pages.withColumn("_parts", parts).filter(F.size("_parts") > 1).withColumn("_rest", F.get("_parts", 1))
    card = F.get(_pieces(F.col("_rest"), "a"), 0)
    title = F.regexp_extract(F.col("_rest"), rf"(?is)<div[^>]*\sclass\s*=\s*[\"']{title_class}[\"'][^>]*>(.*?)</div", 1)
    out = rest.select(
        page_id, _attribute(card, "href").alias("url"), _stripped(_decoded(F.regexp_replace(title, "<[^>]*>", ""))).alias("title")
    )
    return out.filter(~F.col("title").isin(list(skip))) if skip else out
