"""HTML pages: title, links, visible text and slim markup, one Arrow helper per page."""

from __future__ import annotations

from html import escape
from html.parser import HTMLParser
from urllib.parse import urljoin, urlparse

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, StringType, StructType

from starloom.functions.rows import SLICE, by_row, numbered_rows

# Elements without visible text, media elements, and elements without an end tag.
INVISIBLE = {"style", "script", "head", "title", "footer"}
MEDIA = {"svg", "img", "video", "audio"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class _Reader(HTMLParser):
    """Collects the first title, the link targets and the visible strings."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.title, self.hrefs, self.strings = None, [], []
        self._open, self._hidden = [], 0

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            href = dict(attrs).get("href")
            if href is not None:
                self.hrefs.append(href)
        if tag in VOID:
            return
        self._open.append(tag)
        self._hidden += tag in INVISIBLE
        if tag == "title" and self.title is None:
            self.title = ""

    def handle_endtag(self, tag):
        if tag not in self._open:
            return
        while self._open:
            closed = self._open.pop()
            self._hidden -= closed in INVISIBLE
            if closed == tag:
                break

    def handle_data(self, data):
        if "title" in self._open and self.title is not None:
            self.title += data
        if not self._hidden and data.strip():
            self.strings.append(data.strip())


def _resolve(href: str, url: str) -> str | None:
    try:
        parts = urlparse(href)
        if (not parts.scheme and parts.path) or href.startswith(("http://", "https://")):
            return urljoin(url, href)
    except ValueError:
        pass
    return None


def _parts(page: str | None, address: str | None) -> tuple[str, list[str], str]:
    """Title, links and visible text; its strings are joined without a separator."""
    reader = _Reader()
    reader.feed(page or "")
    reader.close()
    links = [x for x in (_resolve(h, address or "") for h in reader.hrefs) if x]
    return (reader.title or "").strip(), links, "".join(reader.strings)


class _Slimmer(HTMLParser):
    def __init__(self, keep: set[str]):
        super().__init__(convert_charrefs=True)
        self.keep, self.out, self._skipped = keep, [], []

    def handle_starttag(self, tag, attrs):
        if self._skipped or tag in MEDIA | INVISIBLE:
            if tag not in VOID:
                self._skipped.append(tag)
            return
        kept = "".join(f' {k}="{escape(v or "")}"' for k, v in attrs if k in self.keep or not v)
        self.out.append(f"<{tag}{kept}>")

    def handle_endtag(self, tag):
        if self._skipped:
            if tag in self._skipped:
                while self._skipped.pop() != tag:
                    pass
        elif tag not in VOID:
            self.out.append(f"</{tag}>")

    def handle_data(self, data):
        if not self._skipped and data.strip():
            self.out.append(escape(" ".join(data.split()), quote=False))


def slim_html(html: Column, keep_links: bool = False) -> Column:
    """Markup with class and id (and href) only, without media, scripts, comments and spare blanks."""
    keep = {"class", "id", "href"} if keep_links else {"class", "id"}

    def slim(page):
        worker = _Slimmer(keep)
        worker.feed(page or "")
        worker.close()
        return "".join(worker.out)

    return by_row(slim, StringType())(html)


def parsed_pages(pages: DataFrame) -> DataFrame:
    """Pages (page_id, url, html) with title, links and text.

    A step over batches, not a column: a filter on the text would have every page parsed twice.
    """
    schema = StructType([pages.schema["page_id"], pages.schema["url"]]).add("title", StringType()).add("links", ArrayType(StringType())).add("text", StringType())
    kinds = to_arrow_schema(schema)

    def parse(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                found = [_parts(*row) for row in zip(part.column("html").to_pylist(), part.column("url").to_pylist())]
                made = [pa.array(values, kinds.field(name).type) for name, values in zip(("title", "links", "text"), zip(*found))]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), *made], names=kinds.names)

    return pages.select("page_id", "url", "html").mapInArrow(parse, schema)


def link_table(pages: DataFrame) -> DataFrame:
    """One row per link with its position and target host."""
    links = numbered_rows(parsed_pages(pages), ["page_id"], F.col("links"), "pos", "link")
    return links.withColumn("host", F.lower(F.regexp_extract("link", r"^https?://([^/?#]*)", 1)))


def valid_pages(pages: DataFrame, text: str = "text") -> DataFrame:
    """Pages whose text is not a load failure."""
    body = F.trim(F.col(text))
    return pages.filter(~(body.startswith("Fail to load page") | body.startswith("Access Denied")))
