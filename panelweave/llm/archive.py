"""A content-addressed archive of web records.

``write`` keeps each payload once, under its SHA-256, and the exact header bytes of every record apart from it.
``read`` joins the two and puts each record together again; payloads are checked against their digest. Payload bytes are shuffled
once on each way, after each task has reduced its own copies to one. A payload that many records share is copied once
for every ``COPY_ROWS`` of them, and its records are dealt over the copies, so a payload that a third of all pages carry is no hot key.

Of records with one payload of at least ``revisit_bytes`` bytes, the one with the largest id is a response and the others
revisit it; repeated rows with that id are all responses, and so are all rows if none has an id. Shorter payloads are
responses. A revisit's own block is empty; its payload comes back from the response's. A null body is empty, a null url leaves the target out.

A header ends its lines with CR LF and is read back by these alone. Control characters and the line and paragraph separators of
Unicode stand in a url, and in an id also ``%``, ``+``, ``<`` and ``>``, as the percent signs of their UTF-8 bytes, so no value can make a line of
its own; ids come back as they were, as text. An id of the empty text comes back null. Texts of any length are kept whole; an empty
table makes an empty archive. Columns other than the three are not read.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_END = "\r\n"
#: Records that are joined to one copy of their payload.
COPY_ROWS = 1000
# Fixed value: what a revisit of the same payload names as its profile.
_SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CONTROL = r"\x00-\x1F\x7F-\x9F\u2028\u2029"


def _escaped(value: Column, more: str = "") -> Column:
    """Each character of the class as the percent signs of its UTF-8 bytes."""
    odd = F.lit(f"[{_CONTROL}{more}]")
    signs = F.transform(F.split(value, ""), lambda c: F.when(F.rlike(c, odd), F.regexp_replace(F.hex(F.encode(c, "UTF-8")), "(..)", "%$1")).otherwise(c))
    return F.when(F.rlike(value, odd), F.array_join(signs, "")).otherwise(value)


def _name(key: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(_escaped(key.cast("string"), "%+<>"), F.lit("")), F.lit(">"))


def _header(key: Column, date: str) -> Column:
    def line(name: str, value: Column) -> Column:
        return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit(_END))).otherwise(F.lit(""))

    revisit = F.col("record_type") == "revisit"
    return F.concat(
        F.lit(f"WARC/1.1{_END}"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", _name(key)),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", _escaped(F.col("url"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        line("WARC-Refers-To", F.when(revisit, _name(F.col("refers_to")))),
        line("WARC-Profile", F.when(revisit, F.lit(_SAME_PAYLOAD))),
        line("Content-Type", F.lit("text/html")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("bytes").cast("string"))),
        F.lit(_END),
    )


def write(pages: DataFrame, path: str, revisit_bytes: int = 1000, key: str = "page_id", body: str = "html", at: datetime | None = None) -> None:
    """Write ``path/payloads`` (digest, payload, records) and ``path/records`` (id, digest, records, header); ``at`` is the date of all records."""
    payload = F.encode(F.coalesce(F.col(body), F.lit("")), "UTF-8")
    rows = pages.select(F.col(key).alias("id"), F.col("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    once = rows.groupBy("digest").agg(F.first("payload").alias("payload"), F.count(F.lit(1)).alias("records"))
    once.write.option("compression", "zstd").parquet(f"{path}/payloads")
    named = rows.select("id", "url", "digest", F.octet_length("payload").cast("long").alias("bytes"), F.sha1("payload").alias("sha1"))
    owners = named.groupBy("digest").agg(F.max("id").alias("owner"), F.count(F.lit(1)).alias("records"))
    judged = named.join(owners, "digest")
    revisits = (F.col("bytes") >= revisit_bytes) & F.col("owner").isNotNull() & ~F.col("id").eqNullSafe(F.col("owner"))
    judged = judged.withColumn("record_type", F.when(revisits, "revisit").otherwise("response")).withColumn(
        "refers_to", F.when(revisits, F.col("owner"))
    )
    date = (at or datetime.now(timezone.utc)).strftime("%Y-%m-%dT%H:%M:%SZ")
    judged.select("id", "digest", "records", F.encode(_header(F.col("id"), date), "UTF-8").alias("header")).write.parquet(f"{path}/records")


def _fields(records: DataFrame) -> DataFrame:
    """What the header bytes say."""
    lines = F.split(F.decode("header", "UTF-8"), _END)

    def field(name: str) -> Column:
        return F.substring(F.get(F.filter(lines, lambda x: F.startswith(x, F.lit(f"{name}: "))), F.lit(0)), len(name) + 3, 1 << 30)

    def page(name: str) -> Column:
        named = F.url_decode(F.regexp_extract(field(name), "^<urn:page:(.*)>$", 1))
        return F.when(named != "", named)

    found = [page("WARC-Record-ID").alias("id"), field("WARC-Type").alias("record_type"), page("WARC-Refers-To").alias("refers_to")]
    return records.select("digest", "records", "header", *found)


def _checked(payloads: DataFrame, value: Column) -> Column:
    wrong = F.raise_error(F.concat(F.lit("payload does not fit its digest "), F.col("digest")))
    return F.when(F.sha2("payload", 256) == F.col("digest"), value).otherwise(wrong)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Every record: ``id``, ``record_type``, ``refers_to``, ``payload``, and its full WARC bytes (``record``), put together again."""
    copies = F.ceil(F.col("records") / COPY_ROWS)
    payloads = spark.read.parquet(f"{path}/payloads")
    payloads = payloads.select("digest", _checked(payloads, F.col("payload")).alias("payload"), F.explode(F.sequence(F.lit(1), copies)).alias("copy"))
    # The number of a row in what was written deals it to a copy.
    copy = F.pmod(F.monotonically_increasing_id(), copies) + 1
    dealt = _fields(spark.read.parquet(f"{path}/records")).withColumn("copy", F.when(copies > 1, copy).otherwise(1))
    joined = dealt.join(payloads, ["digest", "copy"])
    block = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return joined.select("id", "record_type", "refers_to", "payload", F.concat("header", block, F.encode(F.lit(_END * 2), "UTF-8")).alias("record"))


def summary(spark: SparkSession, path: str) -> DataFrame:
    """Every record with size and SHA-1 of its payload; each payload is measured once, and only the figures are joined."""
    payloads = spark.read.parquet(f"{path}/payloads")
    size, sha1 = F.octet_length("payload").cast("long"), F.sha1("payload")
    measured = payloads.select("digest", _checked(payloads, size).alias("payload_bytes"), sha1.alias("payload_digest"))
    return _fields(spark.read.parquet(f"{path}/records")).join(measured, "digest").drop("digest", "records", "header")
