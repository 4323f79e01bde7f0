"""The same results as SQL over the given tables."""

from __future__ import annotations

from panelweave.operators.evaluate import SWEEP_THRESHOLDS, poisson_steps
from registry.panels import (
    ALARM, BIAS, CHANNELS, ENCODED, EVENT_FEATURES, EVENTS_SQL, HOURLY_OF, HOURLY_SEEN, HOURLY_SQL, ORDERS_SQL,
    SPLIT_SQL, TYPES_SQL, WEIGHTS,
)
from registry.queries import CATEGORICAL, NUMERIC

ORACLE: dict[str, str] = {}
BY_TIME = "PARTITION BY id ORDER BY ts, event_id"
BY_DATE = "PARTITION BY id ORDER BY o_orderdate, o_orderkey"
SO_FAR = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
KEPT = ("v_view", "v_click", "v_error", "v_purchase", "v_signup", "v_empty", "v_const")


def each(template: str, names, sep: str = ", ") -> str:
    return sep.join(template.format(c=c) for c in names)


def r6(names, digits: int = 6) -> str:
    return each(f"round({{c}}, {digits}) AS {{c}}", names)


def ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


# ---- shared steps

FILLED = "f AS (SELECT id, ts, event_id, grp, label, split, " + each(
    f"last_value({{c}} IGNORE NULLS) OVER ({BY_TIME} {SO_FAR}) AS {{c}}", KEPT
) + f", row_number() OVER ({BY_TIME}) AS rn, count(*) OVER (PARTITION BY id) AS n FROM p)"

ENCODE = "CASE WHEN grp = 0 THEN 1 ELSE 0 END AS grp_0, CASE WHEN grp = 1 THEN 1 ELSE 0 END AS grp_1"
TRIMMED = f"t AS (SELECT *, {ENCODE} FROM f WHERE n - rn >= 5 AND n - rn < 55)"


def fitted(source: str, names, where: str = "split = 'train'", name: str = "s") -> str:
    inner = each("avg({c}) AS m_{c}, min({c}) AS lo_{c}, max({c}) AS hi_{c}", names)
    return f"{name} AS (SELECT {inner} FROM {source} WHERE {where})"


def scaled(c: str, filled: str) -> str:
    low, high = f"coalesce(lo_{c}, 0)", f"coalesce(hi_{c}, 0)"
    return f"(({filled}) - {low}) / CASE WHEN {high} > {low} THEN {high} - {low} ELSE 1.0::DOUBLE END"


def scale_all(names) -> str:
    return ", ".join(f"{scaled(c, f'coalesce({c}, m_{c}, 0)')} AS {c}" for c in names)


V1 = (
    EVENTS_SQL, FILLED, TRIMMED, fitted("t", ENCODED),
    f"v AS (SELECT id, ts, event_id, label, split, {scale_all(ENCODED)} FROM t, s)",
)

WEIGHTED = " + ".join(f"{w}::DOUBLE * {c}" for c, w in zip(ENCODED, WEIGHTS))
SCORE = f"1 / (1 + exp(-({BIAS}::DOUBLE + {WEIGHTED})))"

RANKED = (
    "k AS (SELECT * FROM (SELECT *, row_number() OVER "
    f"({BY_TIME}) AS rank, count(*) OVER (PARTITION BY id) AS len FROM v) WHERE len >= 15)"
)
PADS = "ids AS (SELECT DISTINCT id, len FROM k)"
STEPS = (
    "st AS (SELECT id, 50 - len + rank - 1 AS step, false AS padded, label AS y, "
    + ", ".join(ENCODED)
    + " FROM k UNION ALL SELECT id, unnest(generate_series(0, 49 - len)) AS step, true, 0, "
    + each("0", ENCODED)
    + " FROM ids)"
)
SCORED = (
    "sc AS (SELECT id, CAST(step AS INT) AS step, padded, y, "
    f"{SCORE} AS score, {SPLIT_SQL.format(key='id')} AS split FROM st)"
)
STEPPED = (*V1, RANKED, PADS, STEPS, SCORED)


def counts(score: str = "score", threshold: str = f"{ALARM}::DOUBLE") -> str:
    return (
        f"count(*) FILTER ({score} < {threshold} AND y = 0) AS tn, "
        f"count(*) FILTER ({score} >= {threshold} AND y = 0) AS fp, "
        f"count(*) FILTER ({score} < {threshold} AND y = 1) AS fn, "
        f"count(*) FILTER ({score} >= {threshold} AND y = 1) AS tp"
    )


METRICS = (
    "round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS sensitivity, "
    "round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, "
    "round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1"
)

# ---- sources and sinks

ORACLE["psv_scan"] = ctes(EVENTS_SQL) + f"SELECT id, event_id, {', '.join(EVENT_FEATURES)}, label FROM p"
ORACLE["psv_scan_flat"] = ORACLE["psv_scan"]
BY_HOUR = "PARTITION BY id ORDER BY ICULOS"
HOURLY_FILLED = "f AS (SELECT * REPLACE (" + each(
    f"last_value({{c}} IGNORE NULLS) OVER ({BY_HOUR} {SO_FAR}) AS {{c}}", HOURLY_OF
) + ") FROM h)"
ORACLE["hourly_sequences"] = ctes(
    EVENTS_SQL, HOURLY_SQL, HOURLY_FILLED,
    "t AS (SELECT * FROM f WHERE n - ICULOS >= 5 AND n - ICULOS < 55)", fitted("t", HOURLY_SEEN),
    f"v AS (SELECT id, ICULOS AS hour, label, {scale_all(HOURLY_SEEN)} FROM t, s)",
    "k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY hour) AS rank, "
    "count(*) OVER (PARTITION BY id) AS len FROM v) WHERE len >= 15)",
    "st AS (SELECT id, 50 - len + rank - 1 AS step, false AS padded, label AS y, " + ", ".join(HOURLY_SEEN)
    + " FROM k UNION ALL SELECT id, unnest(generate_series(0, 49 - len)), true, 0, " + each("0", HOURLY_SEEN)
    + " FROM (SELECT DISTINCT id, len FROM k))",
) + "SELECT id, CAST(step AS INT) AS step, padded, CAST(y AS INT) AS y, " + each(
    "round({c}::DOUBLE, 6) AS {c}", HOURLY_SEEN
) + ", 0::DOUBLE AS rest FROM st"
ORACLE["one_hot_long"] = "SELECT o_orderkey, 'id_' || o_custkey AS category FROM orders"
ORACLE["panel_csv"] = (
    ctes(ORDERS_SQL) + "SELECT id, o_orderkey, p_urgent, p_low, p_total, status, label, split FROM o"
)
ORACLE["entity_cap"] = """SELECT user_id AS id, event_id FROM events
WHERE user_id IN (SELECT DISTINCT user_id FROM events ORDER BY user_id LIMIT 100)"""
ORACLE["panel_union"] = ctes(EVENTS_SQL) + """SELECT id, event_id, v_view,
CASE WHEN split = 'train' THEN v_const END AS v_const, split FROM p"""
ORACLE["predictions_json"] = ctes(*STEPPED) + f"""SELECT id,
'{{"id":' || id || ',"result":[' || max(CASE WHEN score >= {ALARM} THEN 1 ELSE 0 END) || ']}}' AS prediction
FROM sc GROUP BY id"""

# ---- projections

ORACLE["drop_cols"] = (
    ctes(EVENTS_SQL) + "SELECT id, event_id, v_view, v_click, v_error, v_purchase, v_signup, label FROM p"
)
ORACLE["one_hot"] = ctes(ORDERS_SQL) + """SELECT id, o_orderkey, p_urgent, p_low, p_total,
CASE WHEN status = 'F' THEN 1 ELSE 0 END AS "status_F", CASE WHEN status = 'O' THEN 1 ELSE 0 END AS "status_O",
CASE WHEN status = 'P' THEN 1 ELSE 0 END AS "status_P", label, split FROM o"""
ORACLE["one_hot_end"] = ctes(EVENTS_SQL) + """SELECT id, event_id, label,
CASE WHEN grp = 0 THEN 1 ELSE 0 END AS column_grp_0, CASE WHEN grp = 1 THEN 1 ELSE 0 END AS column_grp_1 FROM p"""
ORACLE["null_profile"] = ctes(EVENTS_SQL) + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) AS n_rows, count(*) - count({c}) AS n_null,
round((count(*) - count({c})) / count(*), 6) AS null_share FROM p"""
    for c in EVENT_FEATURES
)
ORACLE["drop_sparse"] = ctes(EVENTS_SQL) + """SELECT id, event_id, v_view, v_click, v_error, v_purchase, v_signup,
v_const, grp, label, split FROM p"""

# ---- filters and splits

ORACLE["min_history"] = """SELECT o_custkey AS id, o_orderkey FROM orders
QUALIFY count(*) OVER (PARTITION BY o_custkey) >= 15"""
ORACLE["split_id_range"] = """SELECT user_id AS id, event_id,
CASE WHEN user_id <= (SELECT max(user_id) // 2 FROM events) THEN 'train' ELSE 'test' END AS split FROM events"""
ORACLE["stratified_split"] = ctes(
    ORDERS_SQL, "e AS (SELECT id, max(label) AS stratum, CAST('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 13) AS BIGINT) AS draw FROM o GROUP BY id)",
    "r AS (SELECT id, row_number() OVER (PARTITION BY stratum ORDER BY draw, id) AS place, count(*) OVER (PARTITION BY stratum) AS n FROM e)",
) + (
    "SELECT id, o_orderkey, label, CASE WHEN place <= floor(n * 0.60 + 0.5) THEN 'train' WHEN place <= floor(n * 0.85 + 0.5) THEN 'test' "
    "ELSE 'valid' END AS split FROM o JOIN r USING (id)"
)
ORACLE["hash_split"] = """SELECT o_custkey, o_orderkey,
CASE WHEN e < 60 THEN 'train' WHEN e < 80 THEN 'test' ELSE 'valid' END AS entity_split,
CASE WHEN r < 67 THEN 'train' ELSE 'test' END AS row_split
FROM (SELECT o_custkey, o_orderkey,
      CAST('0x' || substr(md5(CAST(o_custkey AS VARCHAR)), 1, 7) AS BIGINT) % 100 AS e,
      CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '|42'), 1, 7) AS BIGINT) % 100 AS r FROM orders)"""

# ---- aggregates

ORACLE["column_means"] = ctes(EVENTS_SQL) + "SELECT " + each(
    "round(avg({c}), 6) AS {c}", EVENT_FEATURES[:-1]
) + " FROM p WHERE split = 'train'"
ORACLE["column_minmax"] = ctes(EVENTS_SQL) + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", min({c})::DOUBLE AS min, max({c})::DOUBLE AS max FROM p WHERE split = 'train'"""
    for c in EVENT_FEATURES
)
ORACLE["entity_lengths"] = "SELECT o_custkey AS id, count(*) AS n_rows FROM orders GROUP BY 1"
ORACLE["entity_alarm"] = ctes(*STEPPED) + (
    f"SELECT id, max(CASE WHEN score >= {ALARM} THEN 1 ELSE 0 END) AS result FROM sc GROUP BY id"
)

# ---- windows

ORACLE["ffill"] = ctes(EVENTS_SQL) + "SELECT id, event_id, grp, label, " + each(
    f"last_value({{c}} IGNORE NULLS) OVER ({BY_TIME} {SO_FAR}) AS {{c}}", KEPT
) + " FROM p"
WIDE = ("w_some", "w_rare", "w_all")
TYPES_FILLED = "f AS (SELECT id, ts, event_id, label, " + each(
    f"last_value({{c}} IGNORE NULLS) OVER ({BY_TIME} {SO_FAR}) AS {{c}}", WIDE
) + f", count(*) OVER (PARTITION BY id) - row_number() OVER ({BY_TIME}) AS after FROM p)"
ORACLE["ffill_split"] = ctes(TYPES_SQL, TYPES_FILLED) + (
    "SELECT id, event_id, w_some, w_rare, w_all, label FROM f"
)
ORACLE["ffill_split_text"] = ORACLE["ffill_split_three"] = ORACLE["ffill_split"].replace("ORDER BY ts, event_id", "ORDER BY event_id")
ORACLE["ffill_split_null"] = ORACLE["ffill_split"].replace("SELECT id, event_id", "SELECT nullif(id, 'view') AS id, event_id")
ORACLE["ffill_trim_split"] = ORACLE["ffill_split"] + " WHERE after >= 5 AND after < 55"
PLACED = (
    ORDERS_SQL,
    f"q AS (SELECT *, count(*) OVER (PARTITION BY id) - row_number() OVER ({BY_DATE}) AS after FROM o)",
)
ORACLE["drop_last"] = ctes(*PLACED) + "SELECT id, o_orderkey, p_total FROM q WHERE after >= 5"
ORACLE["drop_last_null"] = ctes(
    ORDERS_SQL,
    "u AS (SELECT * REPLACE (CASE WHEN id % 7 > 0 THEN id END AS id) FROM o)",
    f"q AS (SELECT *, count(*) OVER (PARTITION BY id) - row_number() OVER ({BY_DATE}) AS after FROM u)",
) + "SELECT id, o_orderkey, p_total FROM q WHERE after >= 5"
ORACLE["keep_last"] = ctes(*PLACED) + "SELECT id, o_orderkey, p_total FROM q WHERE after < 8"
ORACLE["trim_tail"] = ctes(*PLACED) + "SELECT id, o_orderkey, p_total FROM q WHERE after >= 5 AND after < 13"
ORACLE["row_batches"] = (
    "SELECT event_id, (row_number() OVER (ORDER BY ts, event_id) - 1) // 100 AS batch FROM events"
)
ORACLE["row_batches_split"] = (
    "SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 100 AS batch FROM orders"
)

# ---- imputation and scaling

RAW_FIT = (EVENTS_SQL, fitted("p", EVENT_FEATURES))
ORACLE["mean_impute"] = ctes(*RAW_FIT) + "SELECT id, event_id, " + each(
    "round(coalesce({c}, m_{c}, 0)::DOUBLE, 6) AS {c}", EVENT_FEATURES
) + " FROM p, s"
ORACLE["zero_impute"] = ctes(EVENTS_SQL) + "SELECT id, event_id, " + each(
    "round(coalesce({c}, 0)::DOUBLE, 6) AS {c}", EVENT_FEATURES
) + " FROM p"
ORACLE["minmax_scale"] = ctes(*RAW_FIT) + "SELECT id, event_id, " + ", ".join(
    f"round({scaled(c, c)}, 6) AS {c}" for c in EVENT_FEATURES
) + " FROM p, s"
ORACLE["prepare_v1"] = ctes(*V1) + f"SELECT id, event_id, {r6(ENCODED)}, label, split FROM v"
ORACLE["entity_layout"] = ORACLE["prepare_v1"]
ORACLE["prepare_v2"] = ctes(
    EVENTS_SQL,
    f"e AS (SELECT *, {ENCODE}, count(*) OVER (PARTITION BY id) - row_number() OVER ({BY_TIME}) AS after FROM p)",
    fitted("e", ENCODED),
    f"v AS (SELECT id, event_id, label, split, {scale_all(ENCODED)} FROM e, s WHERE after >= 5 AND after < 55)",
) + f"SELECT id, event_id, {r6(ENCODED)}, label, split FROM v"
PRICES = ("p_urgent", "p_low", "p_total")
LONG_ENOUGH = "l AS (SELECT * FROM o QUALIFY split <> 'train' OR count(*) OVER (PARTITION BY id) >= 15)"
PRICES_FILLED = "g AS (SELECT id, o_orderkey, label, split, " + each(
    f"last_value({{c}} IGNORE NULLS) OVER ({BY_DATE} {SO_FAR}) AS {{c}}", PRICES
) + " FROM l)"
ORACLE["prepare_v3"] = ctes(ORDERS_SQL, LONG_ENOUGH, PRICES_FILLED, fitted("g", PRICES)) + (
    "SELECT id, o_orderkey, "
    + each("round(coalesce({c}, m_{c}, 0), 3) AS {c}", PRICES)
    + ", label, split FROM g, s"
)
ZEROED = "z AS (SELECT id, o_orderkey, label, split, coalesce(p_urgent, 0) AS p_urgent, p_total FROM g)"
ORACLE["prepare_v4"] = ctes(
    ORDERS_SQL, LONG_ENOUGH, PRICES_FILLED, ZEROED, fitted("z", ("p_urgent", "p_total"))
) + (
    f"SELECT id, o_orderkey, round({scaled('p_urgent', 'p_urgent')}, 6) AS p_urgent, "
    f"round({scaled('p_total', 'p_total')}, 6) AS p_total, label, split FROM z, s"
)
ORACLE["self_fit_prepare"] = ctes(
    EVENTS_SQL, FILLED, TRIMMED, fitted("t", ENCODED, "split = 'test'"),
    f"v AS (SELECT id, event_id, label, {scale_all(ENCODED)} FROM t, s WHERE split = 'test')",
) + f"SELECT id, event_id, {r6(ENCODED)}, label FROM v"
ORACLE["saved_stats_prepare"] = ctes(*V1) + (
    f"SELECT id, event_id, {r6(ENCODED)}, label FROM v WHERE split = 'test'"
)

# ---- sequences

VECTOR = "[" + each("CAST(round({c} * 1000000) AS BIGINT)", ENCODED) + "]"
PACKED = (
    f"pk AS (SELECT id, len, list({VECTOR} ORDER BY ts, event_id) AS x, "
    "list(CAST(label AS INT) ORDER BY ts, event_id) AS y FROM k GROUP BY id, len)"
)
LISTS = (*V1, RANKED, PACKED)
ZERO = "[" + each("0::BIGINT", ENCODED) + "]"


def text(expression: str, name: str) -> str:
    return f"CAST(to_json({expression}) AS VARCHAR) AS {name}"


PAD_X = f"list_transform(generate_series(1, 50 - len), lambda i: {ZERO})"
PAD_Y = "list_transform(generate_series(1, {l} - len), lambda i: 0::INT)"
ORACLE["sequences"] = ctes(*LISTS) + (
    f"SELECT id, CAST(len AS INT) AS n_steps, {text('x', 'x')}, {text('y', 'y')} FROM pk"
)
ORACLE["sequence_store"] = ORACLE["sequences"]
ORACLE["pad_pre"] = ctes(*LISTS) + (
    f"SELECT id, {text(f'{PAD_X} || x', 'x')}, {text(PAD_Y.format(l=50) + ' || y', 'y')} FROM pk"
)
ORACLE["pad_post"] = ctes(*LISTS) + (
    f"SELECT id, {text(f'x || {PAD_X}', 'x')}, {text('y || ' + PAD_Y.format(l=50), 'y')} FROM pk"
)
ORACLE["pad_labels"] = ctes(*LISTS) + (
    f"SELECT id, {text('y || ' + PAD_Y.format(l=50), 'y_post')}, "
    f"{text(PAD_Y.format(l=40) + ' || list_slice(y, greatest(len - 39, 1), len)', 'y_pre')} FROM pk"
)
ORACLE["flatten_steps"] = ctes(*STEPPED) + (
    f"SELECT id, CAST(step AS INT) AS step, padded, y, {each('round({c}::DOUBLE, 6) AS {c}', ENCODED)} FROM st"
)

# ---- scores and evaluation

ORACLE["linear_score"] = ctes(*V1) + f"SELECT id, event_id, round({SCORE}, 6) AS score FROM v"
ORACLE["score_user_model"] = ctes(*STEPPED) + "SELECT id, step, round(score, 6) AS score FROM sc"
ORACLE["score_label_join"] = ctes(*STEPPED) + "SELECT id, step, y, round(score, 6) AS score FROM sc"
UNKNOWN = "count(*) FILTER (WHERE y IS NULL OR score IS NULL OR isnan(score)) AS unknown"
ORACLE["confusion"] = ctes(*STEPPED) + (
    f"SELECT split, {counts()}, {UNKNOWN}, true AS padding FROM sc GROUP BY split UNION ALL "
    f"SELECT split, {counts()}, {UNKNOWN}, false AS padding FROM sc WHERE NOT padded GROUP BY split"
)
ORACLE["binary_metrics"] = ctes(*STEPPED, f"c AS (SELECT split, {counts()} FROM sc GROUP BY split)") + (
    f"SELECT split, {METRICS} FROM c"
)
ORACLE["run_log"] = ctes(*STEPPED, f"c AS (SELECT split, {counts()} FROM sc GROUP BY split)") + (
    f"SELECT run_id, threshold, sensitivity, f1 FROM "
    f"(SELECT split AS run_id, '{ALARM}' AS threshold, {METRICS} FROM c)"
)
ORACLE["running_metrics"] = ctes(
    *STEPPED,
    f"c AS (SELECT id // 16 AS batch, {counts()} FROM sc GROUP BY 1)",
    "u AS (SELECT batch, "
    + each(f"CAST(sum({{c}}) OVER (ORDER BY batch {SO_FAR}) AS BIGINT) AS {{c}}", ("tn", "fp", "fn", "tp"))
    + " FROM c)",
) + f"SELECT batch, tn, fp, fn, tp, {METRICS} FROM u"
TRIED = ", ".join(f"({t}::DOUBLE)" for t in SWEEP_THRESHOLDS)
ORACLE["threshold_sweep"] = ctes(
    *STEPPED,
    f"th AS (SELECT col0 AS threshold FROM (VALUES {TRIED}) x(col0))",
    f"c AS (SELECT split, threshold, {counts(threshold='threshold')} FROM sc, th GROUP BY split, threshold)",
) + f"SELECT split, threshold, tn, fp, fn, tp, {METRICS} FROM c"

REPLICATES = 20
_DRAW = "CAST('0x' || substr(md5(CAST(id AS VARCHAR) || ':' || b), 1, 13) AS BIGINT) / 4503599627370496.0"
_TIMES = " + ".join(f"(u >= {x!r}::DOUBLE)::INT" for x in poisson_steps())
_WEIGHED = ", ".join(
    f"sum(w) FILTER ({hit} AND y = {y}) AS {name}"
    for name, hit, y in (("tn", "score < threshold", 0), ("fp", "score >= threshold", 0), ("fn", "score < threshold", 1), ("tp", "score >= threshold", 1))
)
ORACLE["sweep_intervals"] = ctes(
    *STEPPED,
    f"th AS (SELECT col0 AS threshold FROM (VALUES {TRIED}) x(col0))",
    f"dr AS (SELECT id, b, {_TIMES} AS w FROM (SELECT id, b, {_DRAW} AS u FROM (SELECT DISTINCT id FROM sc), range({REPLICATES}) r(b)) "
    "UNION ALL SELECT DISTINCT id, -1, 1 FROM sc)",
    f"c0 AS (SELECT split, threshold, b, {_WEIGHED} FROM sc JOIN dr USING (id), th GROUP BY ALL)",
    "c AS (SELECT split, threshold, b, coalesce(tn, 0) AS tn, coalesce(fp, 0) AS fp, coalesce(fn, 0) AS fn, coalesce(tp, 0) AS tp FROM c0)",
    "m AS (SELECT split, threshold, b, coalesce(tp / nullif(tp + fn, 0), 0) AS se, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f FROM c)",
) + (
    "SELECT split, threshold, round(max(se) FILTER (b < 0), 6) AS sensitivity, round(max(f) FILTER (b < 0), 6) AS f1, "
    "round(quantile_cont(se, 0.05) FILTER (b >= 0), 6) AS sensitivity_low, round(quantile_cont(se, 0.95) FILTER (b >= 0), 6) AS sensitivity_high, "
    "round(quantile_cont(f, 0.05) FILTER (b >= 0), 6) AS f1_low, round(quantile_cont(f, 0.95) FILTER (b >= 0), 6) AS f1_high FROM m GROUP BY ALL"
)
_GAPS = (
    "g AS (SELECT id, split, CASE WHEN (id + step) % 7 = 0 OR id % 10 = 0 OR (id + step) % 11 = 0 THEN NULL ELSE score END AS score, "
    "CASE WHEN (id + step) % 13 <> 0 THEN y END AS y FROM sc)"
)
_FOUR = f"{counts()}, count(*) FILTER (y IS NULL OR score IS NULL) AS unknown FROM g GROUP BY split"
ORACLE["unknown_scores"] = ctes(*STEPPED, _GAPS) + (
    f"SELECT 'counts' AS source, split, {_FOUR} UNION ALL SELECT 'sweep', split, {_FOUR} UNION ALL "
    "SELECT 'alarms', 'all', count(*) FILTER (r = 0), 0, 0, count(*) FILTER (r = 1), count(*) FILTER (r IS NULL) "
    f"FROM (SELECT max(CASE WHEN score >= {ALARM} THEN 1 WHEN score < {ALARM} THEN 0 END) AS r FROM g GROUP BY id)"
)


def causal(names, source: str) -> str:
    recent = f"OVER ({BY_TIME} ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)"
    made = ", ".join(
        f"round({c}, 6) AS {c}, round({c} - lag({c}) OVER ({BY_TIME}), 6) AS {c}_delta, "
        f"round(avg({c}) {recent}, 6) AS {c}_avg6, round(min({c}) {recent}, 6) AS {c}_min6, "
        f"round(max({c}) {recent}, 6) AS {c}_max6"
        for c in names
    )
    return f"SELECT id, event_id, {made} FROM {source}"


ORACLE["causal_features"] = ctes(*V1) + causal(ENCODED, "v")
ORACLE["causal_features_split"] = ctes(TYPES_SQL) + causal(WIDE, "p")

# The loaded model scores as the saved one did, on every prepared row.
ORACLE["model_versions"] = ctes(*V1) + "SELECT id, event_id, true AS same FROM v"

# ---- drift and data quality

BATCHED = (
    EVENTS_SQL,
    "ref AS (SELECT * FROM p WHERE split = 'train')",
    "cur AS (SELECT *, (row_number() OVER (ORDER BY ts, event_id) - 1) // "
    "CAST(ceil(count(*) OVER () / 5) AS BIGINT) AS batch FROM p WHERE split = 'test')",
)
CELLS = each("({c} IS NULL)::INT", EVENT_FEATURES, " + ")
QUALITY = (
    "mv AS (SELECT batch, count(*) AS n_rows, CAST(sum(m) AS BIGINT) AS n_missing, "
    f"round(sum(m) / (count(*) * {len(EVENT_FEATURES)}), 6) AS share_missing, "
    "count(*) FILTER (m > 0) AS rows_with_missing, "
    + each("(count(*) > count({c}))::INT", EVENT_FEATURES, " + ")
    + f" AS columns_with_missing FROM (SELECT *, {CELLS} AS m FROM cur) GROUP BY batch)"
)
ORACLE["missing_values"] = ctes(*BATCHED, QUALITY) + (
    "SELECT batch, n_rows, n_missing, share_missing, rows_with_missing, "
    "CAST(columns_with_missing AS BIGINT) AS columns_with_missing FROM mv"
)
ORACLE["missing_by_column"] = ctes(*BATCHED) + " UNION ALL ".join(
    f"""SELECT batch, '{c}' AS "column", count(*) - count({c}) AS n_missing,
round((count(*) - count({c})) / count(*), 6) AS share_missing FROM cur GROUP BY batch"""
    for c in EVENT_FEATURES
)
ORACLE["column_summary"] = ctes(*BATCHED) + " UNION ALL ".join(
    f"""SELECT batch, '{c}' AS "column", count({c}) AS n, count(*) - count({c}) AS n_missing,
round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min, round(max({c}), 6) AS max,
round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
round(quantile_cont({c}, 0.75), 6) AS p75, count(DISTINCT {c}) AS n_unique,
(SELECT x.{c} FROM cur x WHERE x.batch = cur.batch AND x.{c} IS NOT NULL
 GROUP BY x.{c} ORDER BY count(*) DESC, x.{c} LIMIT 1) AS most_common
FROM cur GROUP BY batch"""
    for c in NUMERIC
)


def long(source: str, names, kind: str, extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT {extra}'{c}' AS col, CAST({c} AS {kind}) AS val FROM {source} WHERE {c} IS NOT NULL"
        for c in names
    )


def numeric_parts(names) -> tuple[str, ...]:
    return (
        f"rl AS ({long('ref', names, 'DOUBLE')})",
        f"cl AS ({long('cur', names, 'DOUBLE', 'batch, ')})",
        "rs AS (SELECT col, count(*) AS n_ref, stddev_pop(val) AS std FROM rl GROUP BY col)",
        "cs AS (SELECT batch, col, count(*) AS n_cur FROM cl GROUP BY batch, col)",
        "u AS (SELECT batch, col, val, sum(r) AS r, sum(c) AS c FROM ("
        "SELECT b.batch, rl.col, rl.val, 1 AS r, 0 AS c FROM rl, (SELECT DISTINCT batch FROM cl) b "
        "UNION ALL SELECT batch, col, val, 0, 1 FROM cl) GROUP BY batch, col, val)",
        "w AS (SELECT u.batch, u.col, abs(sum(r) OVER o / n_ref - sum(c) OVER o / n_cur) AS apart, "
        "coalesce(lead(val) OVER (PARTITION BY u.batch, u.col ORDER BY val) - val, 0) AS gap, n_ref, n_cur, std "
        "FROM u JOIN rs ON rs.col = u.col JOIN cs ON cs.col = u.col AND cs.batch = u.batch "
        f"WINDOW o AS (PARTITION BY u.batch, u.col ORDER BY val {SO_FAR}))",
        'nd AS (SELECT batch, col AS "column", max(n_ref) AS n_ref, max(n_cur) AS n_cur, '
        "sum(apart * gap) AS wasserstein, max(apart) AS ks, max(std) AS std FROM w GROUP BY batch, col)",
    )


NUMERIC_DRIFT = (*BATCHED, *numeric_parts(NUMERIC))
ORACLE["wasserstein"] = ctes(*NUMERIC_DRIFT) + (
    'SELECT batch, "column", round(wasserstein, 6) AS wasserstein, '
    "round(wasserstein / greatest(std, 0.001), 6) AS drift_score FROM nd"
)
ORACLE["wasserstein_split"] = ORACLE["wasserstein"]
SERIES = (
    "list_sum(list_transform(generate_series(1, 100), "
    "lambda k: (CASE WHEN k % 2 = 1 THEN 2.0::DOUBLE ELSE -2.0::DOUBLE END) * exp(-2.0::DOUBLE * k * k * x * x)))"
)
KS_TAIL = f"CASE WHEN x < 0.2 THEN 1.0::DOUBLE ELSE least(greatest({SERIES}, 0.0::DOUBLE), 1.0::DOUBLE) END"
ORACLE["ks_statistic"] = ctes(
    *NUMERIC_DRIFT, "kx AS (SELECT *, ks * sqrt(n_ref * n_cur / (n_ref + n_cur)) AS x FROM nd)"
) + (
    'SELECT batch, "column", n_ref, n_cur, round(ks, 6) AS ks, '
    f"round({KS_TAIL}, 6) AS ks_p_value FROM kx"
)


def categorical_parts(names) -> tuple[str, ...]:
    return (
        f"rg AS (SELECT col, val, count(*) AS r FROM ({long('ref', names, 'VARCHAR')}) GROUP BY col, val)",
        f"cg AS (SELECT batch, col, val, count(*) AS c FROM ({long('cur', names, 'VARCHAR', 'batch, ')}) "
        "GROUP BY batch, col, val)",
        "grid AS (SELECT b.batch, v.col, v.val FROM (SELECT DISTINCT batch FROM cg) b, "
        "(SELECT col, val FROM rg UNION SELECT col, val FROM cg) v)",
        "m AS (SELECT g.batch, g.col, g.val, coalesce(r, 0) AS r, coalesce(c, 0) AS c FROM grid g "
        "LEFT JOIN rg ON rg.col = g.col AND rg.val = g.val "
        "LEFT JOIN cg ON cg.col = g.col AND cg.val = g.val AND cg.batch = g.batch)",
        "sh AS (SELECT *, sum(r) OVER q AS nr, sum(c) OVER q AS nc, r / sum(r) OVER q AS a, c / sum(c) OVER q AS b "
        "FROM m WINDOW q AS (PARTITION BY batch, col))",
        'cd AS (SELECT batch, col AS "column", count(*) FILTER (r > 0 OR c > 0) AS n_values, '
        "sqrt(greatest(sum(CASE WHEN a > 0 THEN a * ln(a / ((a + b) / 2)) ELSE 0 END + "
        "CASE WHEN b > 0 THEN b * ln(b / ((a + b) / 2)) ELSE 0 END) / 2, 0)) AS js, "
        "sum(CASE WHEN a > 0 THEN (c - a * nc) * (c - a * nc) / (a * nc) ELSE 0 END) AS chi2, "
        "max(nr) AS nr, max(nc) AS nc, max_by(r, val) AS tr, max_by(c, val) AS tc FROM sh GROUP BY batch, col)",
    )


def tail(freedom: str, x: str) -> str:
    """Upper tail of the chi-squared distribution, for few degrees of freedom: 1 less the series of the lower part."""
    a, half = f"({freedom} / 2)", f"(({x}) / 2)"
    term = f"exp(({a} + k) * ln({half}) - {half} - lgamma({a} + k + 1))"
    return (
        f"CASE WHEN {half} <= 0 THEN 1.0::DOUBLE WHEN {half} > 100 THEN 0.0::DOUBLE "
        f"ELSE greatest(1 - list_sum(list_transform(generate_series(0, 400), lambda k: {term})), 0.0::DOUBLE) END"
    )


CATEGORICAL_DRIFT = (*BATCHED, *categorical_parts(CATEGORICAL))
ORACLE["js_distance"] = ctes(*CATEGORICAL_DRIFT) + 'SELECT batch, "column", round(js, 6) AS js FROM cd'
ORACLE["chi2_statistic"] = ctes(*CATEGORICAL_DRIFT) + (
    f'SELECT batch, "column", n_values, round(chi2, 6) AS chi2, round({tail("(n_values - 1)", "chi2")}, 6) AS p_value FROM cd'
)
Z = (
    "zd AS (SELECT *, (tr / nr - tc / nc) / sqrt((tr + tc) / (nr + nc) * "
    "(1 - (tr + tc) / (nr + nc)) * (1 / nr + 1 / nc)) AS z FROM cd WHERE n_values = 2)"
)
ORACLE["z_statistic"] = ctes(*CATEGORICAL_DRIFT, Z) + (
    f'SELECT batch, "column", round(z, 6) AS z, round({tail("1", "z * z")}, 6) AS p_value FROM zd'
)
MEASURES = (
    *numeric_parts(NUMERIC),
    *categorical_parts(CATEGORICAL),
    "rep AS (SELECT batch, \"column\", 'wasserstein' AS stattest, wasserstein / greatest(std, 0.001) AS score FROM nd "
    "UNION ALL SELECT batch, \"column\", 'jensenshannon', js FROM cd)",
    "ds AS (SELECT batch, count(*) AS n_columns, count(*) FILTER (score >= 0.1) AS n_drifted, "
    "count(*) FILTER (score >= 0.1) / count(*) AS share_drifted FROM rep GROUP BY batch)",
)
REPORT = (*BATCHED, *MEASURES)
ORACLE["drift_by_batch"] = ctes(*REPORT) + (
    'SELECT batch, "column", stattest, round(score, 6) AS score, score >= 0.1 AS drifted FROM rep'
)
ORACLE["incremental_drift"] = ORACLE["drift_by_batch"]
ORACLE["sketch_drift"] = ctes(*REPORT) + (
    'SELECT batch, "column", CAST(n_ref AS BIGINT) AS n_ref, CAST(n_cur AS BIGINT) AS n_cur, true AS wasserstein_within, true AS ks_within FROM nd'
)
ORACLE["merged_stats"] = ctes(EVENTS_SQL) + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS n, count(*) - count({c}) AS nulls, round(avg({c}), 6) AS mean, """
    f"round(min({c})::DOUBLE, 6) AS low, round(max({c})::DOUBLE, 6) AS high, round(stddev_pop({c}), 6) AS spread FROM p WHERE split = 'train'"
    for c in EVENT_FEATURES
)
ORACLE["drift_many_batches"] = ctes(
    *BATCHED[:2], "cur AS (SELECT *, (row_number() OVER (ORDER BY ts, event_id) - 1) // 100 AS batch FROM p)", *MEASURES
) + 'SELECT batch, "column", stattest, round(score, 6) AS score, score >= 0.1 AS drifted FROM rep'
ORACLE["drift_by_batch_small"] = ctes(
    *REPORT, Z, "kx AS (SELECT *, ks * sqrt(n_ref * n_cur / (n_ref + n_cur)) AS x FROM nd)",
    f"""sm AS (SELECT batch, "column", 'ks' AS stattest, {KS_TAIL} AS score FROM kx
UNION ALL SELECT batch, "column", 'z', {tail("1", "z * z")} FROM zd
UNION ALL SELECT batch, "column", 'chi2', {tail("(n_values - 1)", "chi2")} FROM cd WHERE n_values > 2)""",
) + 'SELECT batch, "column", stattest, round(score, 6) AS score, score < 0.05 AS drifted FROM sm'
ORACLE["dataset_drift"] = ctes(*REPORT) + (
    "SELECT batch, n_columns, n_drifted, round(share_drifted, 6) AS share_drifted, "
    "share_drifted >= 0.5 AS dataset_drift FROM ds"
)
ORACLE["drift_tests"] = ctes(*REPORT) + (
    "SELECT batch, 'column_drift' AS test, \"column\", round(score, 6) AS value, score < 0.1 AS passed FROM rep "
    "UNION ALL SELECT batch, 'share_of_drifted_columns', '*', round(share_drifted, 6), share_drifted < 0.5 FROM ds"
)
ORACLE["drift_timeline"] = ctes(*REPORT, QUALITY) + (
    "SELECT strftime(DATE '2024-02-01' + CAST(ds.batch AS INT), '%Y-%m-%d') AS report_at, n_rows, "
    "round(share_drifted, 6) AS share_drifted, share_missing FROM ds JOIN mv ON mv.batch = ds.batch"
)
ORACLE["drift_counters"] = ctes(*REPORT, QUALITY) + (
    "SELECT CAST(sum(n_rows) AS BIGINT) AS rows_seen, "
    "round(max_by(share_drifted, ds.batch), 6) AS last_share_drifted FROM ds JOIN mv ON mv.batch = ds.batch"
)

# ---- streaming

ARRIVALS, HOUR_LATE = 3, 3600
STREAMED = EVENT_FEATURES
STREAM_SCORE = " + ".join(
    f"{w}::DOUBLE * {scaled(c, f'coalesce(f.{c}, m_{c}, 0)')}" for c, w in zip(STREAMED, WEIGHTS)
)
SCORED = f"1 / (1 + exp(-({BIAS}::DOUBLE + {STREAM_SCORE}))) AS score"
ALARMED = f"SELECT id, event_id, round(score, 6) AS score, CASE WHEN score >= {ALARM} THEN 1 ELSE 0 END AS alarm, late FROM x"
ORACLE["stream_alarms_unordered"] = ctes(
    EVENTS_SQL, FILLED, fitted("p", STREAMED), f"x AS (SELECT id, event_id, {SCORED}, false AS late FROM f, s WHERE n - rn >= 5)",
) + ALARMED
ORACLE["stream_alarms"] = ctes(
    EVENTS_SQL,
    f"w AS (SELECT min(ts) AS first, date_sub('second', min(ts), max(ts)) // {ARRIVALS} + 1 AS step FROM p)",
    f"e AS (SELECT p.*, least(date_sub('second', first, ts) // step, {ARRIVALS - 1}) "
    "+ CASE WHEN event_id % 53 = 0 THEN 1 ELSE 0 END AS arrival FROM p, w)",
    "tops AS (SELECT arrival, max(max(ts)) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top "
    "FROM e GROUP BY arrival)",
    f"l AS (SELECT e.*, coalesce(ts < top - to_seconds({HOUR_LATE}), false) AS late FROM e JOIN tops USING (arrival))",
    FILLED.replace("FROM p)", "FROM l WHERE NOT late)"),
    fitted("p", STREAMED),
    f"x AS (SELECT id, event_id, {SCORED}, false AS late FROM f, s WHERE n - rn >= 5 "
    f"UNION ALL SELECT id, event_id, {SCORED}, true FROM l AS f, s WHERE late)",
) + ALARMED

# ---- learners, where SQL can tell what they must find

ORACLE["select_features"] = "SELECT 'p_total' AS feature"
ORACLE["permutation_importance"] = ctes(ORDERS_SQL) + (
    "SELECT DISTINCT split, feature, feature = 'p_total' AS matters, feature <> 'p_total' AS \"none\" "
    "FROM o, (VALUES ('p_total'), ('p_const'), ('p_zero')) x(feature)"
)
ORACLE["step_classifier_auc"] = ctes(ORDERS_SQL) + "SELECT DISTINCT split, true AS ranked FROM o"
ORACLE["recurrent_classifier"] = ctes(ORDERS_SQL) + "SELECT DISTINCT split, true AS network_ranks, true AS windows_do_not FROM o"
ORACLE["logistic_coefficients"] = """WITH r AS (
  SELECT o_totalprice > 150000 AS x, o_custkey % 3 = 0 OR (o_totalprice > 150000 AND o_orderkey % 2 = 0) AS y FROM orders
), o AS (SELECT x, ln(count(*) FILTER (y) / count(*) FILTER (NOT y)) AS odds FROM r GROUP BY x)
SELECT 'intercept' AS name, round(max(odds) FILTER (NOT x), 3) AS value FROM o
UNION ALL SELECT 'x', round(max(odds) FILTER (x) - max(odds) FILTER (NOT x), 3) FROM o"""
ORACLE["score_keeps_nulls"] = ctes(ORDERS_SQL) + "SELECT id, o_orderkey, p_urgent, p_low, p_total, true AS scored FROM o"
