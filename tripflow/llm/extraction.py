"""Main text of pages: element subtrees that recur on a host are its template."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import text_of, written
from tripflow.llm.html import blocks, countable, parse, set_hashes

# A subtree is template if it is on so many pages of a host, however large the host is.
MIN_PAGES = 5


def host_of(url: str | Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#``; A-Z lower-cased; or empty."""
    url = F.col(url) if isinstance(url, str) else url
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                                  "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: str | Column) -> Column:
    """What follows the host up to ``?`` or ``#``, or empty."""
    url = F.col(url) if isinstance(url, str) else url
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _subtrees(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        content, hashes = [], []
        for page in batch["html"]:
            root = parse(page)
            set_hashes(root)
            hashes.append([_signed(h) for h in countable(root)])
            content.append(_signed(xxhash.xxh64("\n".join(blocks(root))).intdigest()))
        yield pd.DataFrame({"host": batch["host"], "digest": batch["digest"], "content": content,
                            "hashes": hashes})


def templates(subtrees: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """``host`` and ``hash`` of subtrees that recur on the host's pages.

    Pages with the same main text count once, so copies of a page are no template.
    """
    seen = subtrees.select("host", "content", F.explode("hashes").alias("hash")).distinct()
    return seen.groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n")).where(
        F.col("n") >= min_pages).select("host", "hash")


def _texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = []
        for page, found in zip(batch["html"], batch["template"]):
            root = parse(page)
            template = set() if found is None else {int(h) & ((1 << 64) - 1) for h in found}
            if template:
                set_hashes(root)
            texts.append("\n".join(blocks(root, template)))
        yield pd.DataFrame({"page_id": batch["page_id"].astype("Int64"), "url": batch["url"],
                            "text": texts})


def main_texts(pages: DataFrame, *, min_pages: int = MIN_PAGES) -> DataFrame:
    """``page_id``, ``url`` and main ``text`` of every page, from ``url`` and ``html``.

    Subtrees that recur on ``min_pages`` different pages of a host are deleted, and so are elements that name
    themselves as menus, footers, adverts, forms or the like. Only containers can be
    template: paragraphs, headings, list items and inline elements go only with a
    container that recurs, and an article's lists and tables are text however often
    they recur. Blocks are joined by a line feed, white space within a
    block is one space. Null html counts as empty and gives an empty text; a null url
    has the empty host. Repeated rows give repeated results. Other columns are left out.

    Pages of one host are never gathered: subtrees are counted by host and hash, and
    each page gets back those of its own subtrees that recur.
    """
    source = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        text_of("html").alias("html"))
    keyed = source.withColumn("host", host_of("url")).withColumn("digest", F.md5("html"))
    subtrees = written(
        keyed.select("host", "digest", "html").mapInPandas(
            _subtrees, "host string, digest string, content long, hashes array<long>"), "subtrees")
    recurring = written(templates(subtrees, min_pages), "templates")
    own = subtrees.select("host", "digest", F.explode("hashes").alias("hash"))
    hits = written(
        own.join(recurring, ["host", "hash"]).groupBy("host", "digest").agg(
            F.collect_set("hash").alias("template")), "hits")
    return keyed.join(hits, ["host", "digest"], "left").select(
        "page_id", "url", "html", "template").mapInPandas(
        _texts, "page_id long, url string, text string")
