"""Labels for web pages, through the documents whose text they show.

Labels are of documents, and a page's number says nothing about documents, so pages are linked by text. The visible lines of a page are
looked up among the lines of all documents; a line counts if it stands in documents of one text only, so common lines link
nothing and no key of the lookup has more than one document row. A page belongs to the text that holds most of its characters, if that is
at least ``share`` of them (the smaller digest of equals), and takes the labels of the documents with that text: bad if one of them says so.

A null page or document has no lines. Lines under ``least_chars`` characters, such as menu entries, count for neither side. Repeated pages
(one url, one body) count once. Without labels, documents or pages the result is empty. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_CHARS = 20
SHARE = 0.5

# Elements that break a line, and the named characters most pages use.
_BREAKS = "address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|head|header|hr|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul"
_NAMED = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&nbsp;": " ", "&amp;": "&"}


def visible(html: Column) -> Column:
    """The text that a reader sees, blocks on lines of their own."""
    text = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    text = F.regexp_replace(text, rf"(?i)</?(?:{_BREAKS})\b[^>]*>", "\n")
    text = F.regexp_replace(text, "<[^>]*>", "")
    for name, character in _NAMED.items():
        text = F.replace(text, F.lit(name), F.lit(character))
    return text


def lines(text: Column, least_chars: int = LEAST_CHARS) -> Column:
    """(hash, number of characters) of each distinct line of at least ``least_chars`` characters, white space folded."""
    folded = F.transform(F.split(text, "\n"), lambda x: F.trim(F.regexp_replace(x, r"\s+", " ")))
    long = F.filter(F.array_distinct(folded), lambda x: F.length(x) >= least_chars)
    return F.transform(long, lambda x: F.struct(F.xxhash64(x).alias("line"), F.length(x).alias("chars")))


def labelled_urls(
    pages: DataFrame, docs: DataFrame, labels: DataFrame, share: float = SHARE, least_chars: int = LEAST_CHARS
) -> DataFrame:
    """``url`` and ``bad`` of every page linked to a labelled document; ``labels``: ``doc_id``, ``bad``."""
    same = F.sha2(F.col("text"), 256).alias("same")
    of_docs = docs.where(F.col("text").isNotNull()).select(same, F.explode(lines(F.col("text"), least_chars)).alias("l")).select("same", "l.line")
    own = of_docs.groupBy("line").agg(F.min("same").alias("same"), F.max("same").alias("other")).where("same = other").select("line", "same")
    judged = docs.select("doc_id", same).join(labels.where(F.col("bad").isNotNull()).select("doc_id", "bad"), "doc_id")
    judged = judged.where(F.col("same").isNotNull()).groupBy("same").agg(F.max("bad").alias("bad"))

    page = F.xxhash64("html").alias("page")
    of_pages = pages.where(F.col("url").isNotNull()).select("url", page, lines(visible(F.col("html")), least_chars).alias("found")).distinct()
    total = F.aggregate("found", F.lit(0), lambda t, x: t + x["chars"])
    wanted = of_pages.select("url", "page", total.alias("total"), F.explode("found").alias("l")).select("url", "page", "total", "l.*")
    held = wanted.join(own, "line").groupBy("url", "page", "same").agg(F.sum("chars").alias("chars"), F.max("total").alias("total"))
    best = held.groupBy("url", "page").agg(F.min_by("same", F.struct(-F.col("chars"), "same")).alias("same"), F.max("chars").alias("chars"), F.max("total").alias("total"))
    return best.where(F.col("chars") >= share * F.col("total")).join(judged, "same").select("url", "bad")
