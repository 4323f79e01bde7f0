"""URL filters: given rules first, then rules mined from labelled pages.

FP-growth finds combinations of URL tokens that come with a bad label; a rule is kept if at least ``least`` bad URLs follow it, whatever
the size of the table, if it is right often enough, and if so many would hardly follow it by chance: Chernoff's bound on that, times the
number of rules tried, is at most ``chance``. A rule that holds a shorter rule of no less confidence is pruned, and each is filed under
its rarest token. A URL looks up its own tokens in that index and is blocked if all tokens of a rule are its own. The verdict depends on
the URL alone, so it is worked out once for each distinct URL with a known token.

Tokens that stand in exactly the same labelled URLs say the same, so the first of them by name stands for all; that and ``most_tokens``, the
tokens of a URL that are tried together (those that depart most from the usual share of bad ones), bound the combinations of a URL.

The number of rules depends on the tokens with ``least`` bad URLs; it is counted, and above ``SENT_RULES`` the index is not
broadcast. A null URL, or one without ``://``, has an empty host and path and no tokens. Repeated pages are judged alike. Pages
without a label teach nothing; a label table that is empty, or has one kind of label only, gives no mined rules.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelweave.workspace import materialise

#: Mined rules that may be broadcast.
SENT_RULES = 100_000
_BAD = "label=bad"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    # Only A to Z are lower-cased.
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def given(rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits ``host`` and ``path``; null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((F.col("host") == rule.host) | F.endswith("host", F.lit("." + rule.host))) & F.startswith("path", F.lit(rule.path))
        name, verdict = F.when(fits, rule.name).otherwise(name), F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def tokens_of(url: Column) -> Column:
    """The distinct tokens of a URL: scheme, labels of the host with their parents, folders, file ending, names in the query."""
    host, path = host_of(url), path_of(url)
    labels = F.split(host, r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat(F.lit("host="), F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    folders = F.transform(F.filter(F.split(path, "/"), lambda p: p != ""), lambda p: F.concat(F.lit("path="), p))
    ending = F.concat(F.lit("ending="), F.regexp_extract(path, r"\.([A-Za-z0-9]{1,8})$", 1))
    query = F.split(F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1), "&")
    names = F.transform(query, lambda q: F.concat(F.lit("query="), F.split_part(q, F.lit("="), F.lit(1))))
    scheme = F.array(F.concat(F.lit("scheme="), F.regexp_extract(url, r"^(?s:(.*?))://", 1)))
    all_tokens = F.array_distinct(F.concat(scheme, parents, folders, F.array(ending), names))
    return F.when(host != "", F.filter(all_tokens, lambda t: ~t.isin("ending=", "query="))).otherwise(F.array().cast("array<string>"))


def baskets_of(rows: DataFrame, bads: int, n: int, least: int, most_tokens: int) -> DataFrame:
    """``items`` of each row of ``row``, ``bad`` and ``tokens``: its tokens that a rule may hold, and its label if bad."""
    named = rows.select("row", "bad", F.explode("tokens").alias("token"))
    # Two digests of the set of rows in which a token stands.
    sets = F.bit_xor(F.xxhash64("row")).alias("set"), F.bit_xor(F.xxhash64("row", F.lit(1))).alias("other_set")
    stats = named.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.count_if("bad").alias("bads"), *sets)
    firsts = stats.where(F.col("bads") >= least).groupBy("n", "bads", "set", "other_set").agg(F.min("token").alias("token"))
    usual = bads / n
    departs = F.abs(F.col("bads") - F.col("n") * usual) / F.sqrt(F.col("n") * (usual * (1 - usual)))
    known = named.join(firsts.select("token", (-departs).alias("rank")), "token")
    kept = known.groupBy("row").agg(F.first("bad").alias("bad"), F.slice(F.array_sort(F.collect_list(F.struct("rank", "token"))), 1, most_tokens).alias("kept"))
    return kept.select(F.when(F.col("bad"), F.array_append("kept.token", F.lit(_BAD))).otherwise(F.col("kept.token")).alias("items"))


def mine(labelled: DataFrame, least: int = 5, min_confidence: float = 0.8, chance: float = 0.01, most_tokens: int = 16) -> DataFrame:
    """Rules (``antecedent``, ``confidence``) for bad URLs, from rows of ``url`` and ``bad``."""
    rows = labelled.where(F.col("bad").isNotNull()).select(F.monotonically_increasing_id().alias("row"), "bad", tokens_of(F.col("url")).alias("tokens"))
    rows = materialise(rows, "labelled-urls")
    n, bads = rows.agg(F.count(F.lit(1)), F.count_if("bad")).first()
    none = labelled.sparkSession.createDataFrame([], "antecedent array<string>, confidence double")
    if bads < least or bads == n:
        return none
    baskets = materialise(baskets_of(rows, bads, n, least, most_tokens), "baskets")
    size = baskets.count()
    if not size:
        return none
    # Half a row less, so that rounding does not ask for one more.
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / size, minConfidence=min_confidence).fit(baskets)
    tried = model.freqItemsets.where(F.array_contains("items", _BAD) & (F.size("items") > 1)).count()
    usual, sure = bads / n, F.col("confidence")
    apart = sure * F.ln(sure / usual) + F.when(sure < 1, (1 - sure) * F.ln((1 - sure) / (1 - usual))).otherwise(0.0)
    followers = F.col("support") * size / sure
    found = model.associationRules.where((F.col("consequent") == F.array(F.lit(_BAD))) & (sure > usual))
    return found.where(followers * apart >= math.log(max(tried, 1) / chance)).select("antecedent", "confidence")


def prune(rules: DataFrame) -> DataFrame:
    """Without rules that hold all tokens of a shorter rule of at least the same confidence."""
    shorter = rules.select(F.col("antecedent").alias("part"), F.col("confidence").alias("sure"), F.element_at("antecedent", 1).alias("token"))
    held = rules.select("antecedent", "confidence", F.explode("antecedent").alias("token")).join(shorter, "token")
    inside = F.forall("part", lambda t: F.array_contains("antecedent", t)) & (F.size("part") < F.size("antecedent"))
    beaten = held.where(inside & (F.col("sure") >= F.col("confidence"))).select("antecedent")
    return rules.join(beaten, "antecedent", "left_anti")


def blocked_urls(urls: DataFrame, rules: DataFrame, counts: DataFrame, n_rules: int) -> DataFrame:
    """The distinct urls that a rule blocks, with the ``confidence`` of the surest one. ``counts``: ``token``, ``n``."""
    ranked = rules.select("antecedent", "confidence", F.explode("antecedent").alias("token")).join(counts, "token")
    index = ranked.groupBy("antecedent", "confidence").agg(F.min_by("token", F.struct("n", "token")).alias("token"))
    if n_rules <= SENT_RULES:
        index = F.broadcast(index)
    tokens = urls.distinct().select("url", tokens_of(F.col("url")).alias("tokens"))
    hits = tokens.select("url", "tokens", F.explode("tokens").alias("token")).join(index, "token")
    hits = hits.where(F.forall("antecedent", lambda t: F.array_contains("tokens", t)))
    return hits.groupBy("url").agg(F.max("confidence").alias("confidence"))


def judge(pages: DataFrame, labelled: DataFrame, rules: Sequence[Rule], key: str = "page_id", **limits: float) -> DataFrame:
    """``key``, ``host``, ``path``, ``rule``, ``verdict`` and the ``confidence`` of a mined rule that blocks."""
    mined = materialise(prune(mine(labelled, **limits)), "url-rules")
    n_rules = mined.count()
    name, verdict = given(rules)
    split = pages.select(F.col(key), F.col("url"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    ruled = split.select(key, "url", "host", "path", name.alias("rule"), verdict.alias("given"))
    if n_rules:
        counts = labelled.select(F.explode(tokens_of(F.col("url"))).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
        blocked = blocked_urls(pages.select("url").where(F.col("url").isNotNull()), mined, counts, n_rules)
        ruled = ruled.join(blocked, "url", "left")
    else:
        ruled = ruled.withColumn("confidence", F.lit(None).cast("double"))
    method = F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")
    return ruled.select(key, "host", "path", "rule", F.coalesce("given", method).alias("verdict"), "confidence")
