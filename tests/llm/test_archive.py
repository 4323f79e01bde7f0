import hashlib
import uuid

from panelweave.llm import archive, queries
from panelweave.workspace import fresh_path

ODD = [
    (1, "http://a.example.org/x", "short"),
    (2, "http://a.example.org/y", "short"),
    (3, None, None),
    (4, "http://a.example.org/\r\nWARC-Type: resource\r\n", ""),
    *[(20 + i, f"http://a.example.org/{c}WARC-Refers-To: <urn:page:99>", body) for i, (c, body) in enumerate((c, b) for c in "\x85\u2028\u2029\x0b\x0c\r\n" for b in ("s", "long " * 300))],
    (5, "u", "é" * 600),
    (9, "v", "é" * 600),
    (7, "w", "é" * 600),
    (9, "v", "é" * 600),
    (None, "n", "é" * 600),
    (None, "n", "z" * 2000),
    (None, "n", "z" * 2000),
    (10, "p", "WARC-Type: response\r\n\r\n" + "q" * 200_000),
]


def pages(spark, rows=ODD):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], "page_id long, url string, html string, digest string, payload string")


def stored(spark, rows=ODD):
    path = fresh_path(spark, "archive")
    archive.write(pages(spark, rows), path)
    return path


def plain(rows):
    owners = {}
    for i, _, body in rows:
        body = body or ""
        owners[body] = max([x for x in (owners.get(body), i) if x is not None], default=None)
    out = []
    for i, _, body in rows:
        raw = (body or "").encode()
        owner = owners[body or ""]
        revisit = len(raw) >= 1000 and owner is not None and i != owner
        out.append((str(i), len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", str(owner if revisit else None)))
    return sorted(out)


def test_summary(spark):
    got = archive.summary(spark, stored(spark)).collect()
    assert sorted((str(r["id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], str(r["refers_to"])) for r in got) == plain(ODD)


def test_records_are_put_together_again(spark):
    path = stored(spark)
    got = archive.read(spark, path).collect()
    assert sorted(bytes(r["payload"]).decode() for r in got) == sorted(r[2] or "" for r in ODD)
    for r in got:
        header, _, rest = bytes(r["record"]).partition(b"\r\n\r\n")
        fields = dict(line.split(b": ", 1) for line in header.split(b"\r\n")[1:])
        revisit = r["record_type"] == "revisit"
        block = b"" if revisit else bytes(r["payload"])
        assert header.startswith(b"WARC/1.1\r\n") and int(fields[b"Content-Length"]) == len(block)
        assert rest == block + b"\r\n\r\n"
        assert fields[b"WARC-Type"].decode() == r["record_type"]
        assert {b"WARC-Record-ID", b"WARC-Date", b"WARC-Payload-Digest", b"Content-Type"} <= set(fields)
        assert (b"WARC-Profile" in fields) == (b"WARC-Refers-To" in fields) == revisit
        # No value makes a line of its own, whatever a reader takes for the end of one.
        assert len(header.decode().splitlines()) == len(header.split(b"\r\n"))


def measured(rows):
    return sorted((str(r["id"]), len(r["payload"]), hashlib.sha1(bytes(r["payload"])).hexdigest(), r["record_type"], str(r["refers_to"])) for r in rows)


def test_records_say_what_the_rule_says(spark):
    assert measured(archive.read(spark, stored(spark)).collect()) == plain(ODD)


def test_a_payload_of_many_records_is_copied(spark, monkeypatch):
    monkeypatch.setattr(archive, "COPY_ROWS", 3)
    rows = [(i, f"u{i}", "many " * 300 if i % 3 else f"own {i}") for i in range(90)] + [(4, "u4", "many " * 300)] * 5
    assert measured(archive.read(spark, stored(spark, rows)).collect()) == plain(rows)


def test_ids_that_are_no_numbers(spark):
    names = ["a b", "<x>", "50%+1", "é\u2028z", "a\r\nWARC-Type: x", "plain"]
    rows = spark.createDataFrame([(n, "u", "same " * 300) for n in names], "page_id string, url string, html string")
    path = fresh_path(spark, "archive")
    archive.write(rows, path)
    got = archive.read(spark, path).collect()
    assert sorted(r["id"] for r in got) == sorted(names)
    assert {r["refers_to"] for r in got if r["record_type"] == "revisit"} == {max(names)}


def test_query_over_odd_urls(spark, tmp_path):
    pages(spark).where("page_id is not null").select("page_id", "url", "html").write.parquet(str(tmp_path / "pages.parquet"))
    got = queries.op7_archive(spark, str(tmp_path)).collect()
    want = plain([r for r in ODD if r[0] is not None])
    assert sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], str(r["refers_to"])) for r in got) == want


def test_payloads_are_stored_once(spark):
    stored_payloads = spark.read.parquet(f"{stored(spark)}/payloads")
    assert stored_payloads.count() == len({r[2] or "" for r in ODD})


def test_a_wrong_payload_is_found(spark):
    path = stored(spark)
    bad = f"{path}-{uuid.uuid4().hex}"
    spark.read.parquet(f"{path}/records").write.parquet(f"{bad}/records")
    payloads = spark.read.parquet(f"{path}/payloads")
    payloads.selectExpr("digest", "cast('other' as binary) as payload", "records").write.parquet(f"{bad}/payloads")
    try:
        archive.summary(spark, bad).collect()
    except Exception as error:
        assert "does not fit its digest" in str(error)
    else:
        raise AssertionError("not found")


def test_empty_table(spark):
    path = fresh_path(spark, "archive")
    archive.write(pages(spark).limit(0), path)
    assert archive.summary(spark, path).count() == 0
    assert archive.read(spark, path).count() == 0
