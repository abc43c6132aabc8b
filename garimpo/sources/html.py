"""Landed HTML pages to article fields.

Titles and tag texts of simple selectors are native expressions; links and selectors with
attributes run over Arrow batches with the standard library's parser.
"""

from __future__ import annotations

import datetime
import json
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser
from itertools import accumulate, islice
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from garimpo.functions import dates
from garimpo.functions.text import clean_html

NO_TITLE = "sem-titulo"
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_BLOCKS = ("p", "h2", "h3")

# Parts of links and texts that are no articles, and of classes that name dates and subtitles.
STOP_HREFS = ("javascript:", "#", "mailto:", "categoria", "category", "tag", "author", "page", "pagina")
STOP_TEXTS = ("menu", "contato", "sobre", "anuncie", "assine", "login", "buscar")
DATE_CLASSES = ("date", "data")
SUBTITLE_CLASSES = ("subtitle", "chamada", "lead", "excerpt", "resumo", "deck")


def scripts_off(html: Column) -> Column:
    """The page without scripts, styles and comments."""
    return F.regexp_replace(html, r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>|<!--.*?-->", "")


def absolute(base: str | None, href: str | None) -> str | None:
    """A link resolved against its page (RFC 3986); none where it is empty or no address."""
    if not href:
        return None
    try:
        return urljoin(base or "", href)
    except ValueError:  # a malformed host
        return None


def found_links(page: Page, base: str | None, finder: dict) -> list[str]:
    """Distinct links of the elements that a ``link_finder`` (``tag``, ``attrs``, ``href_prefixes``) names, in order, cut at ``?``.

    A prefix is compared with the absolute link before the cut; without prefixes all links count.
    """
    prefixes = finder.get("href_prefixes")
    urls = (absolute(base, e.attrs.get("href")) for e in page.find(finder.get("tag", "a"), finder.get("attrs")))
    return list(dict.fromkeys(u.split("?")[0] for u in urls if u is not None and (prefixes is None or u.startswith(tuple(prefixes)))))


def links(pages: DataFrame, base: Column, finders: dict[str, dict] | None = None) -> DataFrame:
    """``page_id, url``: distinct links of each page by its portal's ``link_finder`` (``finders``; ``*`` for the others).

    ``pages`` have ``page_id, html`` and, where finders differ, ``portal``.  Attributes may be quoted in any way or not at all and
    named in any letter case; references are decoded.
    """
    finders = finders or {"*": {"tag": "a"}}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [(r.page_id, u) for r in pdf.itertuples(index=False) for u in found_links(Page(r.html), r.base, finders.get(r.portal) or finders.get("*") or {})]
            yield pd.DataFrame(out, columns=["page_id", "url"])

    portal = F.col("portal") if "portal" in pages.columns else F.lit(None).cast("string")
    return pages.select("page_id", base.alias("base"), portal.alias("portal"), "html").mapInPandas(run, "page_id long, url string")


def main_link_of(page: Page, url: str | None, least: int = 20) -> str | None:
    """The first link that looks like an article; see :func:`main_link`."""
    for e in page.find("a"):
        href, text = e.attrs.get("href"), page.joined(e)
        if not href or len(text) <= least or any(x in href.lower() for x in STOP_HREFS) or any(x in text.lower() for x in STOP_TEXTS):
            continue
        if href.startswith("http"):
            return href
        if href.startswith("/"):
            at = urlsplit(url or "")
            return f"{at.scheme}://{at.netloc}{href}"
    return None


def main_link(pages: DataFrame, least: int = 20) -> DataFrame:
    """``page_id, url``: the first link that looks like an article: a text of over ``least`` letters, no stop words in either.

    Links are whole or begin with ``/``, which is put behind scheme and host of the page's ``url``; others don't count.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = ((r.page_id, main_link_of(Page(r.html), r.url, least)) for r in pdf.itertuples(index=False))
            yield pd.DataFrame([x for x in found if x[1] is not None], columns=["page_id", "url"])

    return pages.select("page_id", "url", "html").mapInPandas(run, "page_id long, url string")


def title(html: Column, tag: str = "h1") -> Column:
    """Text of the first such element, ``sem-titulo`` where there is none or it is empty."""
    inner = F.regexp_extract(scripts_off(html), f"(?is)<{tag}\\b[^>]*>(.*?)</{tag}>", 1)
    text = F.trim(F.regexp_replace(inner, "<[^>]+>", ""))
    return F.coalesce(F.when(text != "", text), F.lit(NO_TITLE))


class Element:
    """An element: its number in order, the number behind its last descendant, and its range of the page's text pieces."""

    __slots__ = ("attrs", "end", "number", "tag", "text_end", "text_from")

    def __init__(self, tag: str, attrs: dict[str, str], number: int, text_from: int):
        self.tag, self.attrs, self.number, self.text_from = tag, attrs, number, text_from
        self.end, self.text_end = number + 1, text_from


class Page(HTMLParser):
    """Elements of a page in order, in time and memory linear in its length however deep they nest.

    An element holds those from its number to its end, and the text pieces of its range, so neither ancestors nor texts are copied.
    """

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.elements: list[Element] = []
        self.pieces: list[str] = []
        self.open: list[Element] = []
        self.n_open: Counter[str] = Counter()
        self.skip = 0
        self.feed(html or "")
        self.close()
        while self.open:
            self._close()

    def _close(self) -> Element:
        e = self.open.pop()
        self.n_open[e.tag] -= 1
        e.end, e.text_end = len(self.elements), len(self.pieces)
        return e

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.skip += 1
            return
        # An open paragraph ends where the next block begins.
        if tag in _BLOCKS and self.n_open["p"]:
            while self._close().tag != "p":
                pass
        first: dict[str, str] = {}
        for k, v in attrs:  # of a repeated attribute the last counts
            first[k] = v or ""
        e = Element(tag, first, len(self.elements), len(self.pieces))
        self.elements.append(e)
        if tag not in _VOID:
            self.open.append(e)
            self.n_open[tag] += 1

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.skip = max(0, self.skip - 1)
        elif self.n_open[tag]:
            while self._close().tag != tag:
                pass

    def handle_data(self, data):
        if not self.skip:
            self.pieces.append(data)

    def find(self, tag: str | None = None, attrs: dict | None = None) -> Iterator[Element]:
        """Elements of a selector; a class name matches any of an element's, one with a space the whole attribute."""
        wanted = (attrs or {}).items()
        return (e for e in self.elements if (not tag or e.tag == tag) and all(_matches(e.attrs.get(k), k, v) for k, v in wanted))

    def first(self, tag: str | None = None, attrs: dict | None = None) -> Element | None:
        return next(self.find(tag, attrs), None)

    def text(self, e: Element | None) -> str:
        """The element's text, trimmed."""
        return "".join(self.pieces[e.text_from : e.text_end]).strip() if e else ""

    def joined(self, e: Element) -> str:
        """The element's pieces of text, each trimmed, without anything between them."""
        return "".join(x.strip() for x in self.pieces[e.text_from : e.text_end])


def _matches(have: str | None, name: str, want: str) -> bool:
    if have is None:
        return False
    return have == want or name == "class" and " " not in want and want in have.split()


def content(page: Page, selector: dict | None) -> str:
    """Stripped texts of all paragraphs and headings of the container, a line each; each text once."""
    selector = selector or {}
    low, high = 0, len(page.elements)
    if selector.get("tag"):
        box = page.first(selector["tag"], selector.get("attrs"))
        if box is None:
            return ""
        low, high = box.number + 1, box.end
    kinds, lines, done = selector.get("find_all") or _BLOCKS, [], low
    for e in page.elements[low:high]:
        if e.tag in kinds and e.number >= done:  # what a chosen one holds is in its text
            done = e.end
            lines.append(page.text(e))
    return "\n".join(x for x in lines if x)


def first_date(page: Page, selectors: list[dict]) -> str | None:
    """The first selector with a filled attribute or text decides, whatever its value."""
    for s in selectors:
        if e := page.first(s.get("tag"), s.get("attrs")):
            value = e.attrs.get(s["attribute"], "") if s.get("attribute") else page.text(e)
            if value:
                return value
    return None


ARTICLE = "page_id long, portal string, title string, chamada string, text string, url string, date_string string, date_parser string, page_number int"


#: Portals that a table of settings may have.
MOST_PORTALS = 100_000


def configuration(table: DataFrame) -> dict[str, dict]:
    """Portal settings of a table (``portal, config``: one JSON object each), as :func:`articles` and :func:`links` take them."""
    rows = table.select("portal", "config").limit(MOST_PORTALS + 1).collect()
    if len(rows) > MOST_PORTALS:
        raise ValueError(f"a table of portal settings has at most {MOST_PORTALS} rows")
    return {r.portal: json.loads(r.config) for r in rows}


def in_range(pages: DataFrame, config: dict[str, dict]) -> DataFrame:
    """Pages whose number lies in [``min_page``, ``max_page``] of their portal; a limit that is not set lets all through."""
    rest, named = config.get("*") or {}, {k: v for k, v in config.items() if k != "*"}

    def limit(name: str) -> Column:
        own = F.create_map(*[F.lit(x) for k, v in named.items() for x in (k, v.get(name))]) if named else None
        other = F.lit(rest.get(name)).cast("long")
        if own is None:
            return other
        return F.when(F.col("portal").isin(*named), F.try_element_at(own, F.col("portal")).cast("long")).otherwise(other)

    number = F.col("page_number")
    return pages.filter(F.coalesce(number >= limit("min_page"), F.lit(True)) & F.coalesce(number <= limit("max_page"), F.lit(True)))


def articles(pages: DataFrame, config: dict[str, dict], as_of: datetime.datetime | None = None) -> DataFrame:
    """Article rows of landed pages (``page_id, url, html, portal, page_number``) by their portal's configuration.

    Pages outside their portal's range are left out before they are parsed, and so are those of portals without configuration where there is no ``*``.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                c = config.get(r.portal) or config.get("*")
                if c is None:
                    continue
                sel, page = c["article_selectors"], Page(r.html)
                head = page.first(**sel["title"])
                sub = page.first(**sel["subtitle"]) if sel.get("subtitle") else None
                dates_ = sel.get("date", [])
                out.append((r.page_id, r.portal, page.text(head) or NO_TITLE, page.text(sub) if sub else None, content(page, sel.get("content")), r.url,
                            first_date(page, dates_ if isinstance(dates_, list) else [dates_]), c.get("date_parser", "iso_or_portuguese"), r.page_number))
            yield pd.DataFrame(out, columns=[x.split()[0] for x in ARTICLE.split(", ")])

    own = in_range(pages.select("page_id", "url", "html", "portal", F.col("page_number").cast("int").alias("page_number")), config)
    rows = own.mapInPandas(run, ARTICLE)
    day = dates.parse_by_name(F.col("date_string"), F.col("date_parser"))
    when = F.lit(as_of) if as_of else F.current_timestamp()
    return rows.select("page_id", "portal", "title", "chamada", "text", "url", day.alias("date_publication"), when.alias("date_extraction"), "page_number")


def first_words(html: Column, n: int = 2000) -> Column:
    """The page's text on one line, its first n words; each text once."""
    flat = F.regexp_replace(clean_html(F.regexp_replace(scripts_off(html), "<[^>]+>", " ")), r"\s+", " ")
    return F.array_join(F.slice(F.split(F.trim(flat), " "), 1, n), " ")


PROFILE = "page_id long, host string, h1 string, dates array<string>, subtitle_class string, containers array<string>"


def profile(page: Page) -> tuple:
    """(heading, dates, subtitle class, container classes) of one page.

    Dates: up to three ``time`` elements or else elements whose class names one; the subtitle:
    the first of ten classed elements of a kind that names one; containers: up to two classed
    articles, then divs, of three paragraphs or more.
    """
    classed = lambda tag: (e for e in page.elements if e.tag == tag and e.attrs.get("class"))
    names = lambda e, parts: any(x in e.attrs["class"].lower() for x in parts)
    times = [e.attrs.get("datetime") or page.text(e) for e in islice(page.find("time"), 3)]
    times = times or [page.text(e) for e in islice((e for tag in ("span", "div", "p") for e in classed(tag) if names(e, DATE_CLASSES)), 3)]
    sub = next((e.attrs["class"] for tag in ("h2", "p", "div") for e in islice(classed(tag), 10) if names(e, SUBTITLE_CLASSES)), None)
    before = [0, *accumulate(e.tag == "p" for e in page.elements)]  # paragraphs before each element
    boxes = (e.attrs["class"] for tag in ("article", "div") for e in classed(tag) if before[e.end] - before[e.number + 1] >= 3)
    return page.text(page.first("h1")) or None, times, sub, list(islice(boxes, 2))


def profiles(pages: DataFrame) -> DataFrame:
    """Structure of each page: heading, dates, subtitle-like class, containers of three paragraphs or more."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [(r.page_id, r.host, *profile(Page(r.html))) for r in pdf.itertuples(index=False)]
            yield pd.DataFrame(out, columns=[x.split()[0] for x in PROFILE.split(", ")])

    host = F.regexp_replace(F.coalesce(F.try_parse_url("url", F.lit("HOST")), F.lit("")), r"^www\.", "")
    return pages.select("page_id", host.alias("host"), "html").mapInPandas(run, PROFILE)


def proposals(profile: DataFrame) -> DataFrame:
    """For each host: pages, pages with a heading and dates, and its most frequent container."""
    boxes = profile.select("host", F.explode("containers").alias("c")).groupBy("host", "c").agg(F.count("*").alias("n"))
    best = Window.partitionBy("host").orderBy(F.desc("n"), "c")
    top = boxes.withColumn("r", F.row_number().over(best)).filter("r = 1").select("host", F.col("c").alias("container"), F.col("n").alias("container_pages"))
    sums = profile.groupBy("host").agg(F.count("*").alias("pages"), F.count("h1").alias("with_h1"), F.count_if(F.size("dates") > 0).alias("with_date"))
    return sums.join(top, "host", "left")
