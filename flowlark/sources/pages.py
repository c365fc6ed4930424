"""Stored web pages to well-formed snapshots, checked by a selector."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from xml.sax.saxutils import escape, quoteattr

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlark.operators.routing import REL

# Elements without content, and those whose end tag may be left out.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
IMPLIED_END = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "p": {"p"},
}
NOT_SHOWN = ["head", "script", "style", "title", "template", "noscript"]
_BAD_CHARS = re.compile("[^\t\n\r -퟿-�\U00010000-\U0010ffff]")
_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_.-]*$")


class _Writer(HTMLParser):
    """Rewrites one page as nested, closed elements."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.open: list[str] = []

    def handle_starttag(self, tag, attrs):
        if not _NAME.match(tag) or (tag in ("html", "body") and tag in self.open):
            return
        while self.open and self.open[-1] in IMPLIED_END.get(tag, ()):
            self.out.append(f"</{self.open.pop()}>")
        seen = {}
        for name, value in attrs:
            if _NAME.match(name):
                seen.setdefault(name, value or "")
        text = "".join(f" {n}={quoteattr(_BAD_CHARS.sub('', v))}" for n, v in seen.items())
        if tag in VOID:
            self.out.append(f"<{tag}{text}/>")
        else:
            self.out.append(f"<{tag}{text}>")
            self.open.append(tag)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open and self.open[-1] == tag:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in self.open:
            while True:
                last = self.open.pop()
                self.out.append(f"</{last}>")
                if last == tag:
                    return

    def handle_data(self, data):
        self.out.append(escape(_BAD_CHARS.sub("", data)))

    def page(self, html: str) -> str:
        self.feed(html)
        self.close()
        while self.open:
            self.out.append(f"</{self.open.pop()}>")
        body = "".join(self.out).strip()
        whole = body.startswith(("<html>", "<html ")) and body.count("<html") == 1
        return body if whole and body.endswith("</html>") else f"<html><body>{body}</body></html>"


def to_xhtml(html: str | None) -> str | None:
    return None if html is None else _Writer().page(html)


def selector_path(selector_type: str, selector: str) -> str:
    """XPath of a selector given as xpath, css, id or link text."""
    if selector_type == "xpath":
        return selector
    if selector_type == "id":
        return f"//*[@id={_text(selector)}]"
    if selector_type == "link text":
        return f"//a[normalize-space(.)={_text(selector)}]"
    if selector_type == "css":
        return _css_path(selector)
    raise ValueError(f"unknown selector type: {selector_type}")


def _text(value: str) -> str:
    if "'" not in value:
        return f"'{value}'"
    if '"' not in value:
        return f'"{value}"'
    raise ValueError("selector text with both kinds of quotes")


def _css_path(selector: str) -> str:
    """Tags, ids, classes and attributes, nested by blank or ``>``."""
    path, axis = "", "//"
    for step in re.findall(r">|[^\s>]+", selector):
        if step == ">":
            axis = "/"
            continue
        tag = re.match(r"[A-Za-z][\w-]*|\*", step)
        parts = re.findall(r"#([\w-]+)|\.([\w-]+)|\[([\w-]+)(?:=[\"']?([^\]\"']*)[\"']?)?\]", step)
        tests = "".join(
            f"[@id='{i}']" if i
            else f"[contains(concat(' ',normalize-space(@class),' '),' {c} ')]" if c
            else f"[@{a}='{v}']" if v else f"[@{a}]"
            for i, c, a, v in parts
        )
        path += f"{axis}{tag.group(0) if tag else '*'}{tests}"
        axis = "//"
    return path


def _visible(path: str) -> str:
    style = "translate(@style,' ','')"
    hidden = f"@hidden or contains({style},'display:none') or contains({style},'visibility:hidden')"
    unseen = " or ".join(f"self::{name}" for name in NOT_SHOWN)
    return f"boolean({path}[not(ancestor-or-self::*[{hidden} or {unseen}])])"


def page_snapshots(
    pages: DataFrame, selector_type: str, selector: str, html: str = "html"
) -> DataFrame:
    """Well-formed text of each page; ``success`` if the chosen element shows.

    Pages are rewritten one by one in Arrow batches; the check and everything
    after it are native XPath functions.
    """
    schema = pages.drop(html).schema.add("xhtml", "string")
    names = schema.fieldNames()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            yield pdf.assign(xhtml=[to_xhtml(h) for h in pdf[html]])[names]

    snapshots = pages.mapInPandas(run, schema)
    shown = F.xpath_boolean("xhtml", F.lit(_visible(selector_path(selector_type, selector))))
    return snapshots.withColumn(
        REL, F.when(F.col("xhtml").isNotNull() & shown, "success").otherwise("failure")
    )


def page_links(snapshots: DataFrame, *keep: str) -> DataFrame:
    """One row per link target of a snapshot."""
    links = F.xpath("xhtml", F.lit("//a/@href"))
    return snapshots.select(*keep, F.explode(links).alias("link"))
