"""One query for each operator, over whole tables, and its SQL where SQL can tell the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.llm import archive, differencing, hmm, merkle, packing, pagelinks, phrases, prefixjoin, raking, ranks, repetition, simplex, skipchain, urlrules
from panelweave.workspace import fresh_path, materialise

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# The url rules that are given.
URL_RULES = (
    urlrules.Rule("net", "/", "block"),
    urlrules.Rule("example.net", "/en/", "allow"),
    urlrules.Rule("example.com", "/de/", "block"),
    urlrules.Rule("org", "/fr/", "allow"),
)
#: Powers that temper the counted shares of each margin.
MIX = {"source": 0.7, "lang": 0.9, "topic": 0.9}
SWEEPS = 6
#: Least share of all tokens that mixing keeps.
KEEP = 0.4
#: Largest relative error of a margin; ``SWEEPS`` is the least number of sweeps.
TOLERANCE = 1e-4


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.measure(table(spark, sf_dir, "documents"))


@query
def op2_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.fingerprint_with_next(table(spark, sf_dir, "documents"))


@query
def op3_skipchain(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = skipchain.find(table(spark, sf_dir, "documents"))
    counts = [f"n_{k}" for k in skipchain.KINDS]
    return found.select("doc_id", *counts, F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_added")


@query
def op4_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = differencing.shard_by_bytes(table(spark, sf_dir, "documents"), shards=8)
    grown = F.lit(None).cast("int").alias("grown_shard")
    return dealt.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", grown)


@query
def op5_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranks.digests(table(spark, sf_dir, "documents"), ranks.read_vocabulary(vocabulary_path()))


@query
def op6_prefixjoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixjoin.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op7_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "archive")
    archive.write(table(spark, sf_dir, "pages"), path)
    read = archive.read(spark, path)
    size, digest = F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest")
    return read.select(F.col("id").cast("long").alias("page_id"), size, digest, "record_type", F.col("refers_to").cast("long").alias("refers_to"))


@query
def op8_urlrules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    labels = table(spark, sf_dir, "labels").select("doc_id", ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    labelled = materialise(pagelinks.labelled_urls(pages, table(spark, sf_dir, "documents"), labels), "page-labels")
    judged = urlrules.judge(pages, labelled, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query
def op9_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(table(spark, sf_dir, "documents"))


@query
def op10_raking(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = raking.mixed(table(spark, sf_dir, "documents"), MIX, SWEEPS, keep=KEEP, tolerance=TOLERANCE)
    rounded = F.round("probability", 6).alias("probability")
    return mixed.select("doc_id", "source", "lang", "topic", "n_tokens", rounded, "kept")


@query
def op11_complement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary_path("word_bpe_49k.json"))


@query
def op12_simplex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simplex.cluster(table(spark, sf_dir, "embeddings")).drop("n_compared")


@query
def op13_timeforward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"), tampered=merkle.seventh(F.col("doc_id")))


ORACLE["op7_archive"] = """
WITH p AS (
  SELECT page_id, sha1(coalesce(html, '')) AS payload_digest,
    CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, coalesce(html, '') AS body
  FROM pages
), o AS (SELECT *, max(page_id) OVER (PARTITION BY body) AS owner FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> owner THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> owner THEN owner END AS refers_to
FROM o
"""

ORACLE["op6_prefixjoin"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g
  FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM common JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)
), reach(x, y) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.y) AS component_id
FROM documents d JOIN reach r ON r.x = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
"""


def _raking_sql() -> str:
    """The sweeps of op10 written out one after the other."""
    parts = [
        r"""d AS (
  SELECT doc_id, source, lang, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens
  FROM documents
), t AS (
  SELECT *, CASE WHEN n_tokens < 100 THEN 'short' WHEN n_tokens < 1000 THEN 'medium' ELSE 'long' END AS topic FROM d
), f0 AS (
  SELECT source, lang, topic, CAST(sum(n_tokens) AS DOUBLE) AS tokens, CAST(sum(n_tokens) AS DOUBLE) AS weight FROM t GROUP BY ALL
)"""
    ]
    for margin, power in MIX.items():
        raised = f"SELECT {margin} AS name, pow(sum(tokens), {power}) AS p FROM f0 GROUP BY 1 HAVING sum(tokens) > 0"
        parts.append(f"target_{margin} AS (SELECT name, p / sum(p) OVER () AS target FROM ({raised}))")
    step = 0
    for _ in range(SWEEPS):
        for margin in MIX:
            last, step = f"f{step}", step + 1
            total = f"sum(weight) OVER (PARTITION BY {margin})"
            scale = f"CASE WHEN {total} > 0 THEN coalesce(target, 0) / {total} ELSE 0 END"
            parts.append(
                f"f{step} AS (SELECT source, lang, topic, tokens, weight * {scale} AS weight "
                f"FROM {last} LEFT JOIN target_{margin} ON {margin} IS NOT DISTINCT FROM name)"
            )
    parts.append(
        f"""p AS (
  SELECT *, CASE WHEN tokens > 0 THEN round(weight / tokens / (SELECT max(weight / tokens) FROM f{step} WHERE tokens > 0), 9)
    ELSE 1.0 END AS probability FROM f{step}
)"""
    )
    return (
        "WITH " + ", ".join(parts) + """
SELECT doc_id, t.source, t.lang, t.topic, n_tokens, round(probability, 6) AS probability,
  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) / 4503599627370496.0 < probability AS kept
FROM t JOIN p ON t.source IS NOT DISTINCT FROM p.source AND t.lang IS NOT DISTINCT FROM p.lang
  AND t.topic IS NOT DISTINCT FROM p.topic
"""
    )


ORACLE["op10_raking"] = _raking_sql()


def _clustering_sql(n_centroids: int = 16, rounds: int = 3) -> str:
    """The rounds of op12 written out one after the other."""
    parts = [
        f"""v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), c0 AS (
  SELECT CAST(row_number() OVER (ORDER BY h, q) - 1 AS INTEGER) AS cluster, q FROM (
    SELECT sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, q FROM v ORDER BY h, q LIMIT {n_centroids})
)"""
    ]
    off = "list_sum(list_transform(list_zip(v.q, c.q), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    for i in range(rounds + 1):
        parts.append(
            f"""a{i} AS (
  SELECT vec_id, q, best.cluster AS cluster, best.d AS distance FROM (
    SELECT vec_id, v.q AS q, min({{'d': CAST({off} AS BIGINT), 'cluster': c.cluster}}) AS best FROM (SELECT *, row_number() OVER () AS r FROM v) v, c{i} c
    GROUP BY r, vec_id, v.q)
)"""
        )
        if i < rounds:
            parts.append(
                f"""m{i} AS (
  SELECT cluster, list(m ORDER BY i) AS q FROM (
    SELECT cluster, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS m FROM (
      SELECT cluster, i, sum(x) AS s, count(*) AS n FROM (SELECT cluster, unnest(q) AS x, unnest(range(64)) AS i FROM a{i}) GROUP BY ALL))
  GROUP BY cluster
), c{i + 1} AS (SELECT c.cluster, coalesce(m.q, c.q) AS q FROM c{i} c LEFT JOIN m{i} m USING (cluster))"""
            )
    return (
        "WITH " + ", ".join(parts) + f"""
SELECT vec_id, a.cluster, distance, CAST(sum(distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c USING (cluster)
"""
    )


ORACLE["op12_simplex"] = _clustering_sql()


def _leaf_sql(columns: dict[str, str]) -> str:
    parts = [f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END" for c in columns.values()]
    return f"sha256({' || '.join(parts)})"


_LEAF = {c: c for c in merkle.FIELDS}
# One bit after the other, from each byte of the decimal id.
_CRC = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, len(s) + 1), lambda i: CAST(ord(s[i]) AS BIGINT))), lambda c, b:
    list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"""
_NEXT = "list_transform(range(0, (len(nodes) + 1) // 2), lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))"

ORACLE["op13_timeforward"] = f"""
WITH RECURSIVE d AS (
  SELECT *, {_leaf_sql(_LEAF)} AS leaf, {_leaf_sql(_LEAF | {"n_chars": "(n_chars + 1)"})} AS changed, CAST(doc_id AS VARCHAR) AS s FROM documents
), f AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, leaf, CASE WHEN {_CRC} % 7 = 0 THEN changed ELSE leaf END AS start,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY lang) AS size
  FROM d
), t(tree, level, nodes) AS (
  SELECT tree, 0, list(leaf ORDER BY place) FROM f GROUP BY tree
  UNION ALL SELECT tree, level + 1, {_NEXT} FROM t WHERE len(nodes) > 1
), subroots AS (
  SELECT tree, nodes[1] AS subroot, row_number() OVER (ORDER BY tree) - 1 AS top_place, count(*) OVER () AS top_size FROM t WHERE len(nodes) = 1
), u(level, nodes) AS (
  SELECT 0, list(subroot ORDER BY top_place) FROM subroots
  UNION ALL SELECT level + 1, {_NEXT} FROM u WHERE len(nodes) > 1
), root AS (SELECT nodes[1] AS root FROM u WHERE len(nodes) = 1),
steps AS (
  SELECT row_number() OVER () AS r, f.*, subroot, top_place, top_size FROM f JOIN subroots USING (tree)
), beside AS (
  SELECT r, 0 AS top, level, (place >> level) % 2 AS side, nodes[xor(place >> level, 1) + 1] AS sibling FROM steps JOIN t USING (tree) WHERE len(nodes) > 1
  UNION ALL
  SELECT r, 1, level, (top_place >> level) % 2, nodes[xor(top_place >> level, 1) + 1] FROM steps, u WHERE len(nodes) > 1
), paths AS (
  SELECT r, sha256(string_agg(coalesce(sibling, ''), '' ORDER BY top, level)) AS proof_sha256,
    list({{'side': side, 'sibling': sibling}} ORDER BY top, level) AS hops FROM beside GROUP BY r
), folds(r, k, digest, hops) AS (
  SELECT r, 1, start, coalesce(hops, []) FROM steps LEFT JOIN paths USING (r)
  UNION ALL
  SELECT r, k + 1, sha256(CASE WHEN hops[k].sibling IS NULL THEN digest WHEN hops[k].side = 1 THEN hops[k].sibling || digest
    ELSE digest || hops[k].sibling END), hops FROM folds WHERE k <= len(hops)
)
SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, digest AS folded_root, digest = root AS verified
FROM steps JOIN root ON true LEFT JOIN paths USING (r) JOIN folds USING (r) WHERE k > len(folds.hops)
"""
