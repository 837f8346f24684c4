"""Independent ANSI SQL (DuckDB dialect) for the registered queries.

Written from the operator definitions, not from the Spark plans: splits and
folds are plain ``row_number()`` windows here, profiles are one-column-at-a-time
aggregates, and so on. The driver runs these on the same Parquet tables.
"""

from __future__ import annotations


def H(seed: str, key: str) -> str:
    """52-bit md5 prefix of ``seed:key`` as BIGINT."""
    return f"('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 13))::BIGINT"


def R(expr: str, digits: int = 6) -> str:
    return f"(round({expr}, {digits}) + 0.0)"


OF = """of AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_totalprice END AS price,
         CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS prio,
         CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label
  FROM orders)"""

SCORED = OF + """,
imp AS (SELECT *, coalesce(price, avg(price) OVER ()) AS price_i FROM of),
sc0 AS (SELECT *, 1.0 / (1.0 + exp(-(-1.2 + 2.0 * (price_i / 500000.0) + 0.1 * prio))) AS prob
        FROM imp),
sc AS (SELECT *, CAST(round_even(prob, 0) AS INTEGER) AS prediction FROM sc0)"""


def strat(src: str, label: str, key: str, seed: str, frac: float = 0.2, out: str = "split",
          test: str = "test", train: str = "train") -> str:
    return f"""SELECT *, CASE WHEN row_number() OVER (PARTITION BY {label} ORDER BY {H(seed, key)}, {key})
                    <= round(count(*) OVER (PARTITION BY {label}) * {frac})
               THEN '{test}' ELSE '{train}' END AS {out}
        FROM {src}"""


def kfold_sql(src: str, key: str, seed: str, k: int = 5) -> str:
    return f"""SELECT *, CAST(CASE WHEN rn < (n % {k}) * (n // {k} + 1) THEN rn // (n // {k} + 1)
                      ELSE (n % {k}) + (rn - (n % {k}) * (n // {k} + 1)) // (n // {k}) END AS INTEGER) AS fold
        FROM (SELECT *, row_number() OVER (ORDER BY {H(seed, key)}, {key}) - 1 AS rn,
                     count(*) OVER () AS n FROM {src})"""


def confusion(label: str = "label", pred: str = "prediction") -> str:
    return f"""CAST(count_if({label} = 1 AND {pred} = 1) AS BIGINT) AS tp,
       CAST(count_if({label} = 0 AND {pred} = 1) AS BIGINT) AS fp,
       CAST(count_if({label} = 0 AND {pred} = 0) AS BIGINT) AS tn,
       CAST(count_if({label} = 1 AND {pred} = 0) AS BIGINT) AS fn"""


RATES_SQL = f"""*, {R("coalesce((tp + tn) / nullif(tp + fp + tn + fn, 0), 0.0)")} AS accuracy,
   {R("coalesce(tp / nullif(tp + fp, 0), 0.0)")} AS precision,
   {R("coalesce(tp / nullif(tp + fn, 0), 0.0)")} AS recall,
   {R("coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0)")} AS f1"""

ORACLE: dict[str, str] = {}

ORACLE["typed_projection"] = """
SELECT o_orderkey, CAST(o_custkey AS DOUBLE) AS o_custkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice,
       o_orderpriority, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label
FROM orders"""

ORACLE["display_rename"] = """
SELECT c_custkey AS "Customer Key", c_name AS "Customer Name", c_nationkey AS "Nation Key",
       c_acctbal AS "Account Balance", c_mktsegment AS "Market Segment"
FROM customer"""

ORACLE["drop_if_present"] = "SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer"

ORACLE["null_profile"] = f"""
WITH {OF}
SELECT 'o_orderkey' AS column_name, CAST(count_if(o_orderkey IS NULL) AS BIGINT) AS null_count FROM of
UNION ALL SELECT 'price', CAST(count_if(price IS NULL OR isnan(price)) AS BIGINT) FROM of
UNION ALL SELECT 'prio', CAST(count_if(prio IS NULL OR isnan(prio)) AS BIGINT) FROM of
UNION ALL SELECT 'label', CAST(count_if(label IS NULL) AS BIGINT) FROM of"""

ORACLE["mean_impute"] = f"""
WITH {OF}
SELECT o_orderkey, {R("coalesce(price, avg(price) OVER ())")} AS price_imputed FROM of"""

ORACLE["stratified_split"] = f"""
WITH {OF}
SELECT o_orderkey, label, split FROM ({strat("(SELECT o_orderkey, label FROM of)", "label", "o_orderkey", "42")})"""

ORACLE["second_split"] = f"""
WITH {OF},
s1 AS ({strat("(SELECT o_orderkey, label FROM of)", "label", "o_orderkey", "42", out="s1")}),
s2 AS ({strat("(SELECT o_orderkey, label FROM s1 WHERE s1 = 'train')", "label", "o_orderkey",
              "42:valid", out="s2", test="valid")})
SELECT o_orderkey, label, 'test' AS split FROM s1 WHERE s1 = 'test'
UNION ALL SELECT o_orderkey, label, s2 AS split FROM s2"""

ORACLE["kfold"] = f"""
WITH {OF}
SELECT o_orderkey, fold FROM ({kfold_sql("(SELECT o_orderkey FROM of)", "o_orderkey", "42")})"""

ORACLE["label_split"] = f"""
SELECT doc_id, quality, split FROM ({strat("(SELECT doc_id, quality FROM labels)", "quality", "doc_id", "42")})"""

ORACLE["score_fixed"] = f"""
WITH {SCORED}
SELECT o_orderkey, {R("prob")} AS prob, prediction,
       CASE WHEN prediction = 1 THEN 'Good investment' ELSE 'Bad investment' END AS message
FROM sc"""

ORACLE["metrics_by_split"] = f"""
WITH {SCORED},
sp AS ({strat("sc", "label", "o_orderkey", "42")}),
c AS (SELECT split, {confusion()} FROM sp GROUP BY split)
SELECT {RATES_SQL} FROM c"""

ORACLE["fold_metrics"] = f"""
WITH {SCORED},
kf AS ({kfold_sql("sc", "o_orderkey", "42")}),
c AS (SELECT fold, {confusion()} FROM kf GROUP BY fold)
SELECT {RATES_SQL} FROM c"""

ORACLE["fold_mean"] = f"""
WITH {SCORED},
kf AS ({kfold_sql("sc", "o_orderkey", "42")}),
c AS (SELECT fold, {confusion()} FROM kf GROUP BY fold),
m AS (SELECT fold, (tp + tn) / (tp + fp + tn + fn) AS accuracy,
             coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision,
             coalesce(tp / nullif(tp + fn, 0), 0.0) AS recall,
             coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0) AS f1 FROM c)
SELECT {R("avg(accuracy)")} AS mean_accuracy, {R("avg(precision)")} AS mean_precision,
       {R("avg(recall)")} AS mean_recall, {R("avg(f1)")} AS mean_f1, count(*) AS n_folds FROM m"""

ORACLE["logloss"] = f"""
WITH {SCORED},
sp AS ({strat("sc", "label", "o_orderkey", "42")}),
cl AS (SELECT *, least(greatest(prob, 1e-15), 1.0 - 1e-15) AS p FROM sp)
SELECT split, {R("avg(-(label * ln(p) + (1 - label) * ln(1.0 - p)))")} AS logloss, count(*) AS n
FROM cl GROUP BY split"""


# ---------------------------------------------------------------- A3, A6-A15

LINE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

ORACLE["summary_stats"] = "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS count, {R(f"avg({c})", 4)} AS mean,
       {R(f"stddev_samp({c})", 4)} AS std, {R(f"min({c})", 4)} AS min,
       {R(f"quantile_cont({c}, 0.25)", 4)} AS p25, {R(f"quantile_cont({c}, 0.5)", 4)} AS p50,
       {R(f"quantile_cont({c}, 0.75)", 4)} AS p75, {R(f"max({c})", 4)} AS max
FROM lineitem""" for c in LINE_COLS)

ORACLE["class_distribution"] = f"""
SELECT o_orderstatus, count(*) AS n, {R("count(*) / sum(count(*)) OVER ()")} AS share
FROM orders GROUP BY o_orderstatus"""


def hist_sql(src: str, n_bins: int, by: str | None = None) -> str:
    cls = f"{by}, " if by else ""
    classes = f", (SELECT DISTINCT {by} FROM v) cl" if by else ""
    return f"""
WITH v AS ({src}),
b AS (SELECT min(x) AS lo, max(x) AS hi FROM v),
binned AS (SELECT {cls}CAST(CASE WHEN hi > lo THEN least(floor((x - lo) / (hi - lo) * {n_bins}) + 1, {n_bins})
                            ELSE 1 END AS INTEGER) AS bin FROM v, b),
cnt AS (SELECT {cls}bin, count(*) AS count FROM binned GROUP BY ALL),
grid AS (SELECT {cls}CAST(g AS INTEGER) AS bin, lo + (g - 1) * ((hi - lo) / {n_bins}) AS lower,
                lo + g * ((hi - lo) / {n_bins}) AS upper
         FROM b, range(1, {n_bins + 1}) t(g){classes})
SELECT grid.*, coalesce(cnt.count, 0) AS count FROM grid LEFT JOIN cnt USING ({cls}bin)"""


def _round_hist(inner: str, extra: str = "") -> str:
    return (f"SELECT {extra}bin, {R('lower')} AS lower, {R('upper')} AS upper, count FROM ({inner})")


ORACLE["histogram"] = _round_hist(hist_sql("SELECT l_extendedprice AS x FROM lineitem", 20))
ORACLE["histogram_by_class"] = _round_hist(
    hist_sql("SELECT l_returnflag, l_extendedprice AS x FROM lineitem", 20, by="l_returnflag"),
    extra="l_returnflag, ")
ORACLE["marginal_hist"] = (
    _round_hist(hist_sql("SELECT l_quantity AS x FROM lineitem", 10), extra="'x' AS axis, ")
    + "\nUNION ALL\n"
    + _round_hist(hist_sql("SELECT l_extendedprice AS x FROM lineitem", 10), extra="'y' AS axis, "))


def box_sql(src: str, by: str | None = None) -> str:
    g = f"{by}, " if by else ""
    grp = f"GROUP BY {by}" if by else ""
    join = f"JOIN qs USING ({by})" if by else ", qs"
    return f"""
WITH v AS ({src}),
qs0 AS (SELECT {g}quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median,
               quantile_cont(x, 0.75) AS q3 FROM v {grp}),
qs AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo_fence, q3 + 1.5 * (q3 - q1) AS hi_fence FROM qs0)
SELECT {"v." + by + ", " if by else ""}{R("any_value(q1)", 4)} AS q1, {R("any_value(median)", 4)} AS median,
       {R("any_value(q3)", 4)} AS q3, {R("any_value(iqr)", 4)} AS iqr,
       {R("any_value(lo_fence)", 4)} AS lo_fence, {R("any_value(hi_fence)", 4)} AS hi_fence,
       {R("min(x) FILTER (WHERE x BETWEEN lo_fence AND hi_fence)", 4)} AS whisker_low,
       {R("max(x) FILTER (WHERE x BETWEEN lo_fence AND hi_fence)", 4)} AS whisker_high,
       CAST(count_if(NOT (x BETWEEN lo_fence AND hi_fence)) AS BIGINT) AS n_outliers, count(*) AS n
FROM v {join} {"GROUP BY v." + by if by else ""}"""


ORACLE["box_stats"] = box_sql("SELECT l_extendedprice AS x FROM lineitem")
ORACLE["box_by_class"] = box_sql("SELECT event_type, value AS x FROM events", by="event_type")
ORACLE["box_outliers"] = """
WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
           FROM events GROUP BY event_type)
SELECT e.event_id, e.event_type, e.value FROM events e JOIN q USING (event_type)
WHERE e.value < q1 - 1.5 * (q3 - q1) OR e.value > q3 + 1.5 * (q3 - q1)"""

ORACLE["marginal_box"] = "\nUNION ALL\n".join(
    f"SELECT '{axis}' AS axis, * FROM ({box_sql(f'SELECT {c} AS x FROM lineitem')})"
    for axis, c in (("x", "l_quantity"), ("y", "l_extendedprice")))


def violin_sql(src: str, by: str, digits: int | None = None) -> str:
    """Density of x for each value of ``by``; rows are shared between bins of 1/64 bandwidth."""
    grid = R("grid_x", digits) if digits else R("grid_x")
    return f"""
WITH v AS ({src}),
s AS (SELECT {by}, count(*) AS n, stddev_samp(x) AS sd, min(x) AS lo, max(x) AS hi FROM v GROUP BY 1),
s2 AS (SELECT *, CASE WHEN coalesce(1.06 * sd * pow(n, -0.2), 0) > 0 THEN 1.06 * sd * pow(n, -0.2)
                      ELSE 1e-3 END AS h FROM s),
g AS (SELECT {by}, CAST(p AS INTEGER) AS point, lo + (hi - lo) * p / 49 AS grid_x, n, h, lo
      FROM s2, range(0, 50) t(p)),
c AS (SELECT {by}, floor(t) AS b, sum(1 - (t - floor(t))) AS w0, sum(t - floor(t)) AS w1
      FROM (SELECT {by}, (x - lo) / (h / 64) AS t FROM v JOIN s2 USING ({by})) GROUP BY 1, 2)
SELECT g.{by}, point, {grid} AS grid_x,
       {R("""sum(w0 * exp(-0.5 * pow((grid_x - (lo + b * (h / 64))) / h, 2)) + w1 * exp(-0.5 * pow((grid_x - (lo + (b + 1) * (h / 64))) / h, 2)))
             / (n * h * sqrt(2 * pi()))""", 8)} AS density
FROM g JOIN c USING ({by}) GROUP BY g.{by}, point, grid_x, n, h"""


ORACLE["violin_density"] = violin_sql("SELECT event_type, value AS x FROM events", "event_type")
ORACLE["marginal_violin"] = violin_sql(
    "SELECT 'x' AS axis, l_quantity AS x FROM lineitem UNION ALL SELECT 'y', l_extendedprice FROM lineitem", "axis", 4)

ORACLE["pearson"] = f"""
SELECT l_returnflag, {R("corr(l_quantity, l_extendedprice)")} AS r FROM lineitem GROUP BY l_returnflag"""

_pairs = [(a, b) for a in LINE_COLS for b in LINE_COLS]
ORACLE["corr_matrix"] = "\nUNION ALL\n".join(
    f"SELECT '{a}' AS f1, '{b}' AS f2, {R(f'corr({a}, {b})')} AS r FROM lineitem" if a != b
    else f"SELECT '{a}' AS f1, '{b}' AS f2, CAST(1.0 AS DOUBLE) AS r"
    for a, b in _pairs)

ORACLE["ols_trend"] = f"""
SELECT l_returnflag, {R("regr_slope(l_extendedprice, l_quantity)", 4)} AS slope,
       {R("regr_intercept(l_extendedprice, l_quantity)", 4)} AS intercept,
       {R("regr_r2(l_extendedprice, l_quantity)")} AS r2,
       CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n
FROM lineitem GROUP BY l_returnflag"""


# ---------------------------------------------------------------- F1-F3, P8, P12

_neg_names = ("concat_ws(',', CASE WHEN c_nationkey < 0 THEN 'c_nationkey' END, "
              "CASE WHEN c_acctbal < 0 THEN 'c_acctbal' END)")
ORACLE["negative_split"] = f"""
SELECT c_custkey,
       CASE WHEN {_neg_names} = '' THEN 'accepted' ELSE 'rejected' END AS status,
       CASE WHEN {_neg_names} = '' THEN NULL ELSE 'negative value in ' || {_neg_names} END AS reason
FROM customer"""

ORACLE["negative_file_check"] = """
SELECT count(*) AS n_rows, CAST(count_if(c_nationkey < 0 OR c_acctbal < 0) AS BIGINT) AS n_negative_rows,
       count_if(c_nationkey < 0 OR c_acctbal < 0) > 0 AS file_rejected
FROM customer"""


def _num_checks(f: str, expr: str) -> list[str]:
    num = f"TRY_CAST(CAST({expr} AS VARCHAR) AS DOUBLE)"
    return [f"CASE WHEN {expr} IS NULL THEN '{f}: missing' END",
            f"CASE WHEN {expr} IS NOT NULL AND {num} IS NULL THEN '{f}: not a number' END",
            f"CASE WHEN {num} < 0 THEN '{f}: negative' END"]


REQ = """req0 AS (
  SELECT event_id, ts, user_id,
         CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 19 = 0 THEN 'abc' ELSE json_extract_string(props, '$.k') END AS k,
         CASE WHEN event_id % 23 = 0 THEN -value ELSE value END AS value,
         CASE WHEN event_id % 29 = 0 THEN 'no such model' WHEN event_id % 31 = 0 THEN NULL ELSE event_type END AS event_type
  FROM events),
known AS (SELECT DISTINCT event_type AS known FROM events WHERE value >= 100),
req AS (SELECT r.*, known.known FROM req0 r LEFT JOIN known ON r.event_type = known.known)"""
_req_checks = (_num_checks("k", "k") + _num_checks("value", "value") + _num_checks("user_id", "user_id")
               + ["CASE WHEN event_type IS NULL THEN 'event_type: missing' END",
                  "CASE WHEN event_type IS NOT NULL AND known IS NULL THEN 'event_type: unknown' END"])
N_ERRORS = " + ".join(f"(CASE WHEN ({c}) IS NULL THEN 0 ELSE 1 END)" for c in _req_checks)
ERRORS_TEXT = f"concat_ws('; ', {', '.join(_req_checks)})"
ORACLE["request_validation"] = f"""
WITH {REQ}
SELECT event_id, TRY_CAST(k AS DOUBLE) AS k, value AS "VALUE",
       CAST({N_ERRORS} AS INTEGER) AS n_errors, {ERRORS_TEXT} AS errors_text
FROM req"""

ORACLE["preference_map"] = """
WITH p AS (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'cautious'
                                  WHEN c_mktsegment = 'AUTOMOBILE' THEN 'risk taker'
                                  ELSE 'neutral' END AS preference FROM customer)
SELECT c_custkey, preference,
       CASE preference WHEN 'cautious' THEN 'precision' WHEN 'risk taker' THEN 'recall' ELSE 'f1' END AS metric
FROM p"""


# ---------------------------------------------------------------- M4, O4, A20

def U(seed: str, key: str) -> str:
    return f"(CAST({H(seed, key)} AS DOUBLE) / CAST(4503599627370496 AS DOUBLE))"


def draws(key: str) -> str:
    return (f"CAST(round_even((4.0 + 296.0 * {U('42:max_depth', key)}) / 1.0, 0) * 1.0 AS INTEGER) AS max_depth, "
            f"exp(-3.0 + 3.0 * {U('42:learning_rate', key)}) AS learning_rate, "
            f"exp(-5.0 + 4.0 * {U('42:reg_alpha', key)}) AS reg_alpha, "
            f"exp(-6.0 + 5.0 * {U('42:reg_lambda', key)}) AS reg_lambda, "
            f"exp(-1.0 + 4.0 * {U('42:min_child_weight', key)}) AS min_child_weight")


ORACLE["trial_draws"] = f"""
WITH t AS (SELECT o_orderkey, {draws("o_orderkey")} FROM orders)
SELECT o_orderkey, max_depth, {R("learning_rate")} AS learning_rate, {R("reg_alpha")} AS reg_alpha,
       {R("reg_lambda")} AS reg_lambda, {R("min_child_weight")} AS min_child_weight FROM t"""

ORACLE["best_trial"] = f"""
WITH t AS (SELECT o_orderkey, o_custkey, 1.0 - o_totalprice / 500000.0 AS loss, {draws("o_orderkey")} FROM orders),
b AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY loss, o_orderkey) AS rn FROM t)
SELECT o_custkey, o_orderkey, {R("loss")} AS loss, {R("learning_rate")} AS learning_rate, max_depth
FROM b WHERE rn = 1"""


# ---------------------------------------------------------------- O2, O3, O5, O6, R1-R4, F4, F5

VM = """vm AS (
  SELECT event_type AS model_name, CAST(user_id + 1 AS INTEGER) AS model_version, count(*) AS n,
         count_if(value >= 50) / count(*) AS accuracy, count_if(value >= 100) / count(*) AS precision,
         count_if(value >= 20) / count(*) AS recall,
         2 * count_if(value >= 100) / (count(*) + count_if(value >= 100)) AS f1
  FROM events GROUP BY 1, 2)"""
RV = """rv AS (SELECT DISTINCT event_type AS model_name, CAST(user_id + 1 AS INTEGER) AS version
          FROM events WHERE value >= 100)"""
SE = """se AS (SELECT event_type AS model_name, CAST(user_id + 1 AS INTEGER) AS version,
               CASE WHEN value >= 100 THEN 'Production' WHEN value >= 20 THEN 'Staging' ELSE 'Archived' END AS stage,
               ts, event_id AS seq FROM events),
cs AS (SELECT model_name, version, stage, seq AS last_seq FROM (
         SELECT *, row_number() OVER (PARTITION BY model_name, version ORDER BY ts DESC, seq DESC) AS rn FROM se)
       WHERE rn = 1)"""

ORACLE["leaderboard"] = f"""
WITH {VM}
SELECT model_name, model_version, f1,
       row_number() OVER (PARTITION BY model_name ORDER BY f1 DESC NULLS LAST, model_version) AS position
FROM vm"""

ORACLE["best_version"] = f"""
WITH {VM},
b AS (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY f1 DESC, model_version) AS rn
      FROM vm WHERE f1 IS NOT NULL AND NOT isnan(f1))
SELECT model_name, model_version, f1 FROM b WHERE rn = 1"""

ORACLE["gap_free_versions"] = f"""
WITH {RV}
SELECT model_name, version FROM (
  SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY version) AS rn FROM rv)
WHERE rn = version"""

ORACLE["next_version"] = f"""
WITH {RV}
SELECT model_name, CAST(coalesce(max(version), 0) + 1 AS INTEGER) AS next_version FROM rv GROUP BY 1"""

ORACLE["list_models"] = f"""
WITH {RV}
SELECT model_name, count(*) AS n_versions, max(version) AS latest_version FROM rv GROUP BY 1"""

ORACLE["model_versions"] = f"""
WITH {RV}
SELECT model_name, version FROM rv WHERE model_name = 'purchase'"""

ORACLE["current_stage"] = f"WITH {SE} SELECT * FROM cs"

ORACLE["stage_version"] = f"""
WITH {SE}
SELECT model_name, max(version) AS version FROM cs WHERE stage = 'Production' GROUP BY 1"""

ORACLE["run_metrics"] = f"""
WITH {VM},
r AS (SELECT model_name || '-' || CAST(model_version AS VARCHAR) AS run_id, * FROM vm)
SELECT run_id, 'accuracy' AS metric, accuracy AS value FROM r
UNION ALL SELECT run_id, 'precision', precision FROM r
UNION ALL SELECT run_id, 'recall', recall FROM r
UNION ALL SELECT run_id, 'f1', f1 FROM r"""

ORACLE["early_stop"] = """
WITH l AS (SELECT event_type AS run_id, event_id AS round, value AS loss FROM events),
p AS (SELECT *, min({'l': loss, 'r': round}) OVER (PARTITION BY run_id ORDER BY round
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS best FROM l),
st AS (SELECT run_id, min(round) AS stop_round FROM p WHERE round - best.r >= 40 GROUP BY 1),
sb AS (SELECT p.run_id, p.best.r AS br, p.best.l AS bl FROM p JOIN st
         ON p.run_id = st.run_id AND p.round = st.stop_round),
al AS (SELECT run_id, min({'l': loss, 'r': round}) AS b, count(*) AS n_rounds FROM l GROUP BY 1)
SELECT al.run_id, coalesce(sb.br, al.b.r) AS best_round, coalesce(sb.bl, al.b.l) AS best_loss,
       st.stop_round, al.n_rounds
FROM al LEFT JOIN st USING (run_id) LEFT JOIN sb USING (run_id)"""


# ---------------------------------------------------------------- ML1

ORACLE["minmax_scale"] = f"""
SELECT p_partkey,
  {R("CASE WHEN max(p_size) OVER () > min(p_size) OVER () THEN (CAST(p_size AS DOUBLE) - min(p_size) OVER ()) / (max(p_size) OVER () - min(p_size) OVER ()) ELSE 0.0 END")} AS p_size_scaled,
  {R("CASE WHEN max(p_retailprice) OVER () > min(p_retailprice) OVER () THEN (p_retailprice - min(p_retailprice) OVER ()) / (max(p_retailprice) OVER () - min(p_retailprice) OVER ()) ELSE 0.0 END")} AS p_retailprice_scaled
FROM part"""


# ---------------------------------------------------------------- S6, S7, A19, ST1, ST2

EV = """ev AS (SELECT *, CAST(round_even(1.0 / (1.0 + exp(-(-1.0 + 0.01 * value))), 0) AS INTEGER) AS prediction
          FROM events)"""

ORACLE["prediction_log_daily"] = f"""
WITH {EV}
SELECT CAST(ts AS DATE) AS day, prediction, count(*) AS n_events, {R("avg(value)")} AS avg_value
FROM ev GROUP BY 1, 2"""

ORACLE["prediction_log_head"] = f"""
WITH {EV}
SELECT prediction, user_id, value FROM ev ORDER BY ts, event_id LIMIT 10"""

ORACLE["prediction_count"] = "SELECT count(*) AS n FROM events"

ORACLE["stream_score"] = f"""
WITH {REQ},
ev AS (SELECT *, CAST(round_even(1.0 / (1.0 + exp(-(-1.0 + 0.01 * value))), 0) AS INTEGER) AS prediction FROM req)
SELECT event_id, event_type, prediction,
       CASE WHEN prediction = 1 THEN 'Good investment' ELSE 'Bad investment' END AS message,
       TRY_CAST(k AS DOUBLE) AS k, value, user_id, CAST(ts AS DATE) AS day
FROM ev WHERE {N_ERRORS} = 0"""

ORACLE["stream_rejected"] = f"""
WITH {REQ}
SELECT event_id, {ERRORS_TEXT} AS errors_text FROM req WHERE {N_ERRORS} > 0"""

ORACLE["stream_json_requests"] = """
WITH p AS (SELECT event_id, json_extract_string(props, '$.k') AS pk, user_id, event_type,
                  event_id % 43 = 0 OR event_id % 47 = 0 OR event_id % 53 = 0 AS bad FROM events),
t AS (SELECT *, CASE WHEN bad OR event_id % 17 = 0 THEN NULL WHEN event_id % 19 = 0 THEN 'abc' WHEN event_id % 37 = 0 THEN '{"v":1}'
                     WHEN event_id % 41 = 0 THEN '[1,2]' WHEN event_id % 23 = 0 THEN '-' || pk || '.5' ELSE pk END AS raw,
             CASE WHEN bad OR event_id % 31 = 0 THEN NULL WHEN event_id % 29 = 0 THEN 'no such model' ELSE event_type END AS model_name FROM p),
n AS (SELECT *, TRY_CAST(raw AS DOUBLE) AS k FROM t),
e AS (SELECT *, CASE WHEN bad THEN 'request: malformed' ELSE concat_ws('; ',
             CASE WHEN raw IS NULL THEN 'k: missing' END, CASE WHEN raw IS NOT NULL AND k IS NULL THEN 'k: not a number' END,
             CASE WHEN k < 0 THEN 'k: negative' END, CASE WHEN model_name IS NULL THEN 'model_name: missing' END,
             CASE WHEN model_name = 'no such model' THEN 'model_name: unknown' END) END AS errors_text FROM n)
SELECT event_id, k, CASE WHEN k IS NULL THEN raw END AS k_text, CASE WHEN NOT bad THEN user_id::DOUBLE END AS user_id, model_name,
       CASE WHEN errors_text = '' THEN CAST(round_even(1.0 / (1.0 + exp(-(-1.0 + 0.02 * k))), 0) AS INTEGER) END AS prediction, errors_text
FROM e"""

ORACLE["stream_monitor"] = f"""
WITH {EV},
wm AS (SELECT max(ts) - INTERVAL 1 HOUR AS wm FROM events)
SELECT CAST(date_trunc('day', ts) AS DATE) AS day, prediction, count(*) AS n_events,
       {R("avg(value)")} AS avg_value
FROM ev, wm WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= wm GROUP BY 1, 2"""


# ---------------------------------------------------------------- S1-S5, P2, P3, P9, P10, P13-P15, A4, M2

CSV = OF + """,
file AS (SELECT o_orderkey, coalesce(price, 0.0) - 20000.0 AS price, prio, label FROM of)"""

ORACLE["csv_typed_scan"] = f"WITH {CSV} SELECT o_orderkey, price, prio, label FROM file"

ORACLE["batch_predict"] = f"""
WITH {CSV}
SELECT o_orderkey, price, prio, {R("1.0 / (1.0 + exp(-(-1.2 + 2.0 * (price / 500000.0) + 0.1 * prio)))")} AS predictions
FROM file WHERE price >= 0 AND prio >= 0"""

ORACLE["scatter_records"] = f"""
WITH {OF}
SELECT price AS x, prio AS y, CAST(trunc(price) AS INTEGER) AS size, CAST(label AS VARCHAR) AS label FROM of WHERE price IS NOT NULL"""

ORACLE["record_head"] = f"""
WITH {OF}
SELECT o_orderkey, '{{"o_orderkey":' || o_orderkey || ',"prio":' || CAST(prio AS VARCHAR) || '}}' AS record, label
FROM of ORDER BY o_orderkey LIMIT 20"""

ORACLE["table_shape"] = """
SELECT count(*) AS n_rows, 3 AS n_cols, 'features' AS part FROM orders
UNION ALL SELECT count(*), 1, 'target' FROM orders"""


# ---------------------------------------------------------------- ML12, ML13, J2, R1-R3, F4-F6; parts and trials of the learners

ORACLE["promote_best"] = f"""
WITH {SCORED},
sp AS ({strat("imp", "label", "o_orderkey", "42")}),
vs(version, a, b, c) AS (VALUES (1, -1.2, 2.0, 0.1), (2, -0.5, 1.0, 0.1), (3, -2.0, 3.0, 0.3), (5, 9.0, 0.0, 0.0)),
p AS (SELECT version, label, CAST(round_even(1.0 / (1.0 + exp(-(a + b * (price_i / 500000.0) + c * prio))), 0) AS INTEGER) AS prediction
      FROM sp, vs WHERE split = 'test'),
k AS (SELECT 'orders' AS model_name, version, {confusion()} FROM p GROUP BY version),
m AS (SELECT {RATES_SQL}, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0) AS f FROM k)
SELECT * EXCLUDE (f), CASE WHEN version = (SELECT version FROM m WHERE version <= 3 ORDER BY f DESC, version LIMIT 1)
                           THEN 'Production' END AS stage FROM m"""

ORACLE["part_sizes"] = f"""
WITH {OF},
c AS (SELECT of.* FROM of JOIN orders USING (o_orderkey) JOIN customer ON o_custkey = c_custkey),
s1 AS ({strat("(SELECT o_orderkey, label FROM c)", "label", "o_orderkey", "42", out="s1")}),
s2 AS ({strat("(SELECT o_orderkey, label FROM s1 WHERE s1 = 'train')", "label", "o_orderkey", "42:valid", out="s2", test="valid")})
SELECT 'test' AS split, label, count(*) AS n FROM s1 WHERE s1 = 'test' GROUP BY label
UNION ALL SELECT s2, label, count(*) FROM s2 GROUP BY s2, label"""

ORACLE["search_trials"] = f"""
WITH t AS (SELECT user_id, {draws("user_id")} FROM (SELECT DISTINCT user_id FROM events))
SELECT user_id, CAST(round_even(4.0 + 26.0 * {U("42:max_depth", "user_id")}, 0) AS INTEGER) AS max_depth, {R("learning_rate")} AS learning_rate,
       {R("reg_alpha")} AS reg_alpha, {R("reg_lambda")} AS reg_lambda, {R("min_child_weight")} AS min_child_weight FROM t"""
