import itertools
import math
import re
from collections import Counter

import pytest

from panelweave.llm import pagelinks, urlrules
from panelweave.llm.queries import URL_RULES, op8_urlrules
from tests.llm.cases import rows_of

URLS = [
    None,
    "",
    "no scheme",
    "http://Example.NET/en/x?y=1",
    "http://a.example.net/en",
    "http://net",
    "http://net/",
    "http://xnet/a",
    "https://m.example.com/de/1.html#top",
    "https://example.com?q=/de/",
    "ftp://b.org/fr/",
    "x://y://org/fr/",
    "http://ÄB.org/fr/a\nb",
    "://",
    "http://a.org/" + "p/" * 3000,
]


def split(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    return (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")


def given(host, path):
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


def labels(spark, rows):
    return spark.createDataFrame(rows, "url string, bad boolean")


def test_given_rules(spark):
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    got = {r["page_id"]: r for r in rows_of(urlrules.judge(pages, labels(spark, []), URL_RULES))}
    for i, url in enumerate(URLS):
        host, path = split(url)
        rule = given(host, path)
        want = (host, path, rule and rule.name, rule.verdict if rule else "allow")
        assert (got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) == want


def tokens(spark, urls):
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    return [r[0] for r in df.select(urlrules.tokens_of(df.url)).collect()]


def test_tokens(spark):
    got = tokens(spark, ["https://M.a.org/x/y.html?p=1&q#t", None, "plain"])
    assert got == [["scheme=https", "host=m.a.org", "host=a.org", "host=org", "path=x", "path=y.html", "ending=html", "query=p", "query=q"], [], []]


def brute(rows, least=5, min_confidence=0.8, chance=0.01):
    """All token combinations by counting subsets; of tokens that stand in the same rows, the first by name."""
    sets = [(frozenset(t), bad) for t, bad in rows if bad is not None]
    n, bads = len(sets), sum(bad for _, bad in sets)
    if not 0 < bads < n:
        return {}
    where = {}
    for t in {x for s, _ in sets for x in s}:
        where.setdefault(tuple(i for i, (s, _) in enumerate(sets) if t in s), []).append(t)
    firsts = {min(same) for same in where.values()}
    sets = [(t & firsts, bad) for t, bad in sets]
    candidates = {c for t, bad in sets if bad for k in range(1, len(t) + 1) for c in itertools.combinations(sorted(t), k)}
    tried = {}
    for c in candidates:
        cover = [bad for t, bad in sets if set(c) <= t]
        if sum(cover) >= least:
            tried[frozenset(c)] = (len(cover), sum(cover) / len(cover))
    usual, rules = bads / n, {}
    for c, (cover, sure) in tried.items():
        apart = sure * math.log(sure / usual) + ((1 - sure) * math.log((1 - sure) / (1 - usual)) if sure < 1 else 0)
        if sure >= min_confidence and sure > usual and cover * apart >= math.log(len(tried) / chance):
            rules[c] = sure
    return {c: s for c, s in rules.items() if not any(d < c and rules[d] >= s for d in rules)}


def planted():
    rows = []
    for i in range(400):
        host, folder = ("spam", "ok")[i % 5 > 0], ("win", "news", "shop")[i % 3]
        rows.append((f"http://{host}.example.org/{folder}?{'ref' if i % 2 else 'page'}={i}", host == "spam" and folder != "news"))
    return rows + [(None, True), ("http://spam.example.org/win", None)]


def test_mined_rules(spark):
    rows = planted()
    limits = {"least": 8, "min_confidence": 0.8}
    mined = urlrules.prune(urlrules.mine(labels(spark, rows), **limits)).collect()
    got = {frozenset(r["antecedent"]): round(r["confidence"], 9) for r in mined}
    found = tokens(spark, [u for u, _ in rows])
    want = brute([(t, bad) for t, (_, bad) in zip(found, rows)], **limits)
    assert got == {c: round(s, 9) for c, s in want.items()} and got


@pytest.mark.parametrize("sent", [100_000, 0])
def test_mined_verdicts(spark, monkeypatch, sent):
    monkeypatch.setattr(urlrules, "SENT_RULES", sent)
    rows = planted()
    urls = [u for u, _ in rows] + ["http://a.spam.example.org/win", "http://spam.example.org/news?ref=1", "http://spam.example.net/win"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    limits = {"least": 8, "min_confidence": 0.8}
    got = {r["page_id"]: r["verdict"] for r in rows_of(urlrules.judge(pages, labels(spark, rows), URL_RULES, **limits))}
    found = tokens(spark, urls)
    rules = brute([(t, bad) for t, (_, bad) in zip(found, rows)], **limits)
    for i, url in enumerate(urls):
        rule = given(*split(url))
        want = rule.verdict if rule else "block" if any(c <= set(found[i]) for c in rules) else "allow"
        assert got[i] == want, url


def test_a_few_by_chance_are_no_rule(spark):
    """Three bad ones of three are no evidence where a quarter of all are bad, and thousands do not hide five dozen."""
    rows = [(f"http://h{i % 7}.org/p{i % 5}", i % 4 == 0) for i in range(2000)] + [("http://few.org/", True)] * 3
    assert urlrules.mine(labels(spark, rows), least=3).count() == 0
    mined = urlrules.prune(urlrules.mine(labels(spark, rows + [("http://many.org/", True)] * 60))).collect()
    assert [(set(r["antecedent"]), r["confidence"]) for r in mined] == [({"host=many.org"}, 1.0)]


def test_long_urls_do_not_multiply(spark):
    """Forty folders that come in all combinations, on every page."""
    rows = [(f"http://{'bad' if i % 4 == 0 else 'ok'}.org/" + "/".join(f"f{k}" for k in range(40) if hash((i, k)) % 3), i % 4 == 0) for i in range(120)]
    mined = urlrules.prune(urlrules.mine(labels(spark, rows), most_tokens=6)).collect()
    assert {"host=bad.org"} in [set(r["antecedent"]) for r in mined]


def fold(line):
    return re.sub(r"[ \t\n\x0b\f\r]+", " ", line).strip(" ")


def linked(pages, docs, labels):
    """Labelled pages by comparing the lines of all pages and texts."""
    owners = {}
    for _, text in docs:
        for line in {fold(x) for x in (text or "").split("\n")}:
            if len(line) >= 20:
                owners.setdefault(line, set()).add(text)
    bad = {}
    for i, text in docs:
        if i in labels:
            bad[text] = bad.get(text, False) or labels[i]
    out = set()
    for url, html in pages:
        seen = re.sub(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ", html or "")
        seen = re.sub(r"(?i)</?(?:article|br|div|footer|h[1-6]|head|li|nav|p|title|ul|body|html|header)\b[^>]*>", lambda m: "" if re.match("</?(body|html)", m[0]) else "\n", seen)
        seen = re.sub("<[^>]*>", "", seen)
        for name, character in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "'"), ("apos", "'"), ("nbsp", " "), ("amp", "&")):
            seen = seen.replace(f"&{name};", character)
        found = {fold(x) for x in seen.split("\n")}
        found = [x for x in found if len(x) >= 20]
        chars = Counter()
        for x in found:
            if len(owners.get(x, ())) == 1:
                chars[next(iter(owners[x]))] += len(x)
        if chars and max(chars.values()) >= 0.5 * sum(map(len, found)):
            text = max(chars, key=chars.get)
            if text in bad:
                out.add((url, html, bad[text]))
    return Counter((u, b) for u, _, b in out)


def test_pages_get_the_labels_of_their_texts(spark):
    a, b, c = "a first line of some length\nanother line of the first text", "one line that stands alone in here", "a first line of some length"
    docs = spark.createDataFrame([(1, a), (2, b), (3, c), (4, None), (5, ""), (6, b)], "doc_id long, text string")
    marks = spark.createDataFrame([(1, True), (2, False), (6, True), (4, True), (9, True), (3, None)], "doc_id long, bad boolean")
    pages = [
        ("http://a/", "<p>a first line of some length</p><p>another  line of the <b>first</b> text</p>"),
        ("http://b/", "<div>one line that stands alone in here</div>"),
        ("http://b/", "<div>one line that stands alone in here</div>"),
        ("http://c/", "<p>a first line of some length</p>"),
        ("http://d/", "<p>one line that stands alone in here</p><p>and much more text that is of no document at all</p>"),
        ("http://e/", None),
        (None, "<p>one line that stands alone in here</p>"),
    ]
    found = pagelinks.labelled_urls(spark.createDataFrame(pages, "url string, html string"), docs, marks).collect()
    assert sorted(map(tuple, found)) == [("http://a/", True), ("http://b/", True)]


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    marks = {r["doc_id"]: r["quality"] == 0 or r["toxic"] == 1 for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    labelled = linked([(r["url"], r["html"]) for r in pages.values()], docs, marks)
    assert labelled.total() > 20
    table = spark.read.parquet(f"{sf}/labels.parquet").selectExpr("doc_id", "quality = 0 or toxic = 1 as bad")
    by_text = pagelinks.labelled_urls(spark.read.parquet(f"{sf}/pages.parquet"), spark.read.parquet(f"{sf}/documents.parquet"), table)
    assert Counter(map(tuple, by_text.collect())) == labelled
    ids = list(pages)
    found = dict(zip(ids, tokens(spark, [pages[i]["url"] for i in ids])))
    urls = list(labelled.elements())
    rules = brute([(t, bad) for t, (_, bad) in zip(tokens(spark, [u for u, _ in urls]), urls)])
    got = rows_of(op8_urlrules(spark, sf))
    assert len(got) == len(pages)
    for r in got:
        host, path = split(pages[r["page_id"]]["url"])
        rule = given(host, path)
        want = rule.verdict if rule else "block" if any(c <= set(found[r["page_id"]]) for c in rules) else "allow"
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule and rule.name, want)


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert urlrules.judge(pages, labels(spark, []), URL_RULES).count() == 0
