"""SQL that follows the training steps of ensembles (DuckDB): one step of a recursion divides all nodes of a level,
the step after the last level moves the margins and judges the round."""

from __future__ import annotations

import math

from tallyspark.operators.boosting import BINS, COPIES, LEAST_GAIN
from tallyspark.plans import ml_queries as Q
from tallyspark.plans.features import SEARCH_SPACE, SPLIT_SEED
from tallyspark.plans.oracle import OF, ORACLE, RATES_SQL, H, R, confusion, kfold_sql, strat

SCALE, LOSS = 1 << 24, 1 << 32

#: (k, y, x0 ... x3) of the order data.
ORDERS = OF + """,
tr AS (SELECT o_orderkey AS k, label AS y, coalesce(price, avg(price) OVER ()) / 500000.0 AS x0, prio AS x1,
    c_acctbal / 10000.0 AS x2, CAST(c_nationkey AS DOUBLE) AS x3
  FROM of JOIN (SELECT o_orderkey, o_custkey FROM orders) USING (o_orderkey) JOIN customer ON c_custkey = o_custkey)"""

DOCS = """tr AS (SELECT doc_id AS k, quality AS y, ln(1 + CAST(n_chars AS DOUBLE)) AS x0, len(regexp_split_to_array(text, '\\s+')) / 1000.0 AS x1,
    CAST(lang = 'en' AS INTEGER)::DOUBLE AS x2, len(string_split(text, chr(10)))::DOUBLE AS x3
  FROM documents JOIN labels USING (doc_id))"""


def binned(learn: str = "true") -> str:
    """b (k, y, fold, b0 ... b3) from tr (k, y, fold, x0 ... x3): bounds at the ranks ceil(i * n / BINS) of the rows that ``learn``."""
    parts = []
    for f in range(4):
        parts.append(f"""c{f} AS (SELECT list(DISTINCT x) AS c FROM (SELECT x{f} AS x, row_number() OVER (ORDER BY x{f}) AS rn, count(*) OVER () AS n
    FROM tr WHERE x{f} IS NOT NULL AND {learn}) JOIN range(1, {BINS}) t(i) ON rn = (i * n + {BINS - 1}) // {BINS})""")
    bins = ", ".join(f"CAST(CASE WHEN x{f} IS NULL THEN 0 ELSE 1 + len(list_filter(c{f}.c, lambda v: v < x{f})) END AS INTEGER) AS b{f}" for f in range(4))
    return ",\n".join(parts) + f",\nb AS MATERIALIZED (SELECT k, y, fold, {bins} FROM tr, c0, c1, c2, c3)"


def models(rows: list[dict]) -> str:
    """p (m, depth, lr, alpha, lam, least, vfold)."""
    values = ", ".join(f"({m}, {x['max_depth']}, {x['learning_rate']!r}::DOUBLE, {x['reg_alpha']!r}::DOUBLE, {x['reg_lambda']!r}::DOUBLE, "
                       f"{x['min_child_weight']!r}::DOUBLE, {x.get('fold', -1)})" for m, x in enumerate(rows))
    return f"p AS MATERIALIZED (SELECT * FROM (VALUES {values}) t(m, depth, lr, alpha, lam, least, vfold))"


def score(g: str, h: str) -> str:
    return f"(greatest(abs({g}) - alpha, 0.0) * greatest(abs({g}) - alpha, 0.0) / ({h} + lam))"


def split(rows: str, extra: str = "") -> str:
    """The best split of each (m, node) of rows (m, node, g, h, b0 ... b3)."""
    return f"""(SELECT m, node, f, b AS cut, gain FROM (
      SELECT *, 0.5 * (({score('lg', 'lh')} + {score('(g - lg)', '(h - lh)')}) - {score('g', 'h')}) AS gain FROM (
        SELECT m, node, f, b, c, lc, g / {SCALE}.0 AS g, h / {SCALE}.0 AS h, lg / {SCALE}.0 AS lg, lh / {SCALE}.0 AS lh FROM (
          SELECT m, node, f, b, sum(g) OVER (PARTITION BY m, node, f ORDER BY b) AS lg, sum(h) OVER (PARTITION BY m, node, f ORDER BY b) AS lh,
            sum(c) OVER (PARTITION BY m, node, f ORDER BY b) AS lc, sum(g) OVER (PARTITION BY m, node, f) AS g,
            sum(h) OVER (PARTITION BY m, node, f) AS h, sum(c) OVER (PARTITION BY m, node, f) AS c
          FROM (SELECT m, node, f, b, sum(g)::BIGINT AS g, sum(h)::BIGINT AS h, count(*) AS c FROM (
            SELECT m, node, g, h, unnest([0, 1, 2, 3]) AS f, unnest([b0, b1, b2, b3]) AS b FROM {rows}) GROUP BY m, node, f, b)))
      JOIN p USING (m) WHERE lc < c AND lh >= least AND h - lh >= least {extra})
    WHERE gain > {LEAST_GAIN!r} QUALIFY row_number() OVER (PARTITION BY m, node ORDER BY gain DESC, f, b) = 1)"""


PROB = "(1.0 / (1.0 + exp(-margin)))"
G = f"CAST(round(({PROB} - y) * {SCALE}) AS BIGINT)"
HS = f"CAST(round({PROB} * (1.0 - {PROB}) * {SCALE}) AS BIGINT)"
CLIPPED = f"least(greatest({PROB}, 1e-15), 1.0 - 1e-15)"
ROW_LOSS = f"CAST(round(-(CASE WHEN y = 1 THEN ln({CLIPPED}) ELSE ln(1.0 - {CLIPPED}) END) * {LOSS}) AS BIGINT)"


def boosting(depth: int, rounds: int, patience: int | None) -> str:
    """s: state of each (model, row) before each step (rnd trees done, lvl levels of the next): margin, node, f and gain
    of the split that led here; bl, br: least loss (whole units) and its round so far. Rows of fold -9 take part in nothing but the margins."""
    wait = f"AND rnd - 1 - br < {patience}" if patience else ""
    return f"""s AS (
  SELECT m, k, y, fold, b0, b1, b2, b3, 0.0::DOUBLE AS margin, 1::BIGINT AS node, 0 AS rnd, 0 AS lvl, NULL::INTEGER AS f, NULL::DOUBLE AS gain,
    NULL::BIGINT AS bl, 0 AS br FROM b, p
  UNION ALL
  SELECT m, k, y, fold, b0, b1, b2, b3, margin, node, rnd, lvl, f, gain, bl, br FROM (
    SELECT s.m, k, y, fold, b0, b1, b2, b3, margin,
      CASE WHEN t.f IS NULL THEN s.node ELSE 2 * s.node + CAST(list_extract([b0, b1, b2, b3], t.f + 1) > t.cut AS BIGINT) END AS node,
      rnd, lvl + 1 AS lvl, t.f, t.gain, bl, br
    FROM s LEFT JOIN {split(f"(SELECT s.m, node, {G} AS g, {HS} AS h, b0, b1, b2, b3 FROM s JOIN p USING (m) WHERE lvl < p.depth AND fold <> vfold AND fold <> -9)")} t
      ON t.m = s.m AND t.node = s.node WHERE lvl < {depth} AND rnd < {rounds} {wait}
    UNION ALL
    SELECT m, k, y, fold, b0, b1, b2, b3, margin, 1 AS node, rnd + 1, 0 AS lvl, NULL, NULL, CASE WHEN bl IS NULL OR l < bl THEN l ELSE bl END,
      CASE WHEN bl IS NULL OR l < bl THEN rnd ELSE br END
    FROM (SELECT *, CAST(sum(CASE WHEN fold = vfold THEN {ROW_LOSS} ELSE 0 END) OVER (PARTITION BY m) AS BIGINT) AS l FROM (
      SELECT s.m, k, y, fold, b0, b1, b2, b3, s.margin + v.value AS margin, rnd, bl, br, p.vfold
      FROM s JOIN p USING (m) JOIN (
        SELECT m, node, -sign(g) * greatest(abs(g) - alpha, 0.0) / (h + lam) * lr AS value FROM (
          SELECT m, node, sum(g)::BIGINT / {SCALE}.0 AS g, sum(h)::BIGINT / {SCALE}.0 AS h FROM (
            SELECT s.m, node, {G} AS g, {HS} AS h FROM s JOIN p USING (m) WHERE fold <> vfold AND fold <> -9) GROUP BY m, node) JOIN p USING (m)) v
        ON v.m = s.m AND v.node = s.node WHERE lvl = {depth} AND rnd < {rounds} {wait}))))"""


def params(rows: list[dict] | dict) -> list[dict]:
    return rows if isinstance(rows, list) else [rows]


FEATURE = "list_extract([" + ", ".join(f"'{f}'" for f in Q.ORDER_FEATURES) + "], CAST(f + 1 AS BIGINT))"

ORACLE["gbt_importance"] = f"""
WITH RECURSIVE {ORDERS.replace(") USING (o_orderkey)", ") USING (o_orderkey)").replace("label AS y,", "label AS y, 0 AS fold,")},
{binned()},
{models(params(Q.BOOST_DEFAULTS))},
{boosting(6, Q.BOOST_ROUNDS, None)},
g AS (SELECT f, avg(gain) AS gain FROM (SELECT rnd, lvl, node // 2 AS node, any_value(f) AS f, any_value(gain) AS gain FROM s WHERE f IS NOT NULL GROUP BY ALL) GROUP BY f)
SELECT {FEATURE} AS feature, {R("coalesce(gain, 0.0) / sum(gain) OVER ()")} AS importance FROM range(4) t(f) LEFT JOIN g USING (f)"""

ORACLE["gbt_train_eval"] = f"""
WITH RECURSIVE {ORDERS.replace("tr AS (", "tr0 AS (")},
s1 AS ({strat("tr0", "y", "k", SPLIT_SEED, out="s1")}),
s2 AS ({strat("(SELECT k, y FROM s1 WHERE s1 = 'train')", "y", "k", f"{SPLIT_SEED}:valid", out="s2", test="valid")}),
tr AS (SELECT s1.* EXCLUDE (s1), CASE WHEN s1 = 'test' THEN -9 WHEN s2 = 'valid' THEN 1 ELSE 0 END AS fold FROM s1 LEFT JOIN s2 USING (k)),
{binned("fold = 0")},
{models([{**Q.TRAIN_PARAMS, "fold": 1}])},
{boosting(Q.TRAIN_PARAMS["max_depth"], Q.TRAIN_ROUNDS, Q.TRAIN_PATIENCE)},
z AS (SELECT max(rnd) AS n FROM s WHERE lvl = 0),
e AS (SELECT any_value(br) AS br, any_value(bl) AS bl, count_if(fold = 1) AS n_valid FROM s, z WHERE lvl = 0 AND rnd = z.n),
o AS (SELECT s.y AS label, {PROB} AS prob, CAST(round_even({PROB}, 0) AS INTEGER) AS prediction FROM s, e WHERE lvl = 0 AND rnd = e.br + 1 AND fold = -9),
c AS (SELECT {confusion()}, avg(-(label * ln(prob) + (1 - label) * ln(1.0 - prob))) AS l FROM o),
w AS (SELECT {RATES_SQL} FROM c)
SELECT tp, fp, tn, fn, accuracy, precision, recall, f1, e.br AS best_round, CASE WHEN z.n < {Q.TRAIN_ROUNDS} OR z.n - 1 - e.br >= {Q.TRAIN_PATIENCE} THEN z.n - 1 END AS stop_round,
  z.n AS n_rounds, {R(f"e.bl / {LOSS}.0 / e.n_valid")} AS valid_logloss, {R("l")} AS test_logloss FROM w, e, z"""


LIFE = [{**Q.TRAIN_PARAMS, **p, "fold": 1} for p in Q.LIFE_PARAMS]
ORACLE["model_lifecycle"] = f"""
WITH RECURSIVE {ORDERS.replace("tr AS (", "tr0 AS (")},
s1 AS ({strat("tr0", "y", "k", SPLIT_SEED, out="s1")}),
s2 AS ({strat("(SELECT k, y FROM s1 WHERE s1 = 'train')", "y", "k", f"{SPLIT_SEED}:valid", out="s2", test="valid")}),
tr AS (SELECT s1.* EXCLUDE (s1), CASE WHEN s1 = 'test' THEN -9 WHEN s2 = 'valid' THEN 1 ELSE 0 END AS fold FROM s1 LEFT JOIN s2 USING (k)),
{binned("fold = 0")},
{models(LIFE)},
{boosting(max(p["max_depth"] for p in LIFE), Q.LIFE_ROUNDS, Q.LIFE_PATIENCE)},
z AS (SELECT m, max(rnd) AS n FROM s WHERE lvl = 0 GROUP BY m),
e AS (SELECT m, any_value(br) AS br, any_value(bl) AS bl, count_if(fold = 1) AS nv FROM s JOIN z USING (m) WHERE lvl = 0 AND rnd = z.n GROUP BY m),
o AS (SELECT m, s.y AS label, CAST(round_even({PROB}, 0) AS INTEGER) AS prediction FROM s JOIN e USING (m) WHERE lvl = 0 AND rnd = e.br + 1 AND fold = -9 AND m < {Q.LIFE_DAMAGED - 1}),
c AS (SELECT m, {confusion()} FROM o GROUP BY m),
w AS (SELECT {RATES_SQL} FROM c),
a AS (SELECT arg_max(m, [(tp + tn) / (tp + fp + tn + fn), -m]) AS m FROM c),
v AS (SELECT avg(prediction) AS share, count(*) AS n FROM o JOIN a USING (m))
SELECT 'orders' AS model_name, CAST(p.m + 1 AS INTEGER) AS version, 'run-' || (p.m + 1) AS run_id, CAST(p.depth AS VARCHAR) AS depth, {R(f"e.bl / {LOSS}.0 / e.nv")} AS valid_logloss,
  p.m + 1 <> {Q.LIFE_DAMAGED} AS is_sound, tp, fp, tn, fn, accuracy, f1, CASE WHEN p.m = a.m THEN 'Production' END AS stage,
  CASE WHEN p.m = a.m THEN {R("v.share")} END AS served_share, v.n AS served_rows
FROM p JOIN e USING (m) LEFT JOIN w USING (m), a, v"""


def drawn(name: str, key: str) -> str:
    kind, low, high = SEARCH_SPACE[name][:3]
    u = f"{H(f'{SPLIT_SEED}:{name}', key)} / 4503599627370496.0"
    return f"exp({float(low)} + {float(high - low)} * ({u}))" if kind == "loguniform" else f"CAST(round_even({low} + {high - low} * ({u}), 0) AS INTEGER)"


ORACLE["search_steps"] = f"""
WITH RECURSIVE {DOCS.replace("tr AS (", "tr0 AS (")},
tr AS (SELECT k, y, x0, x1, x2, x3, fold FROM ({kfold_sql("tr0", "k", SPLIT_SEED, Q.STEP_FOLDS)})),
{binned()},
p AS MATERIALIZED (SELECT t * {Q.STEP_FOLDS} + f AS m, least({drawn("max_depth", "t")}, {Q.STEP_DEPTH}) AS depth, {drawn("learning_rate", "t")} AS lr,
  {drawn("reg_alpha", "t")} AS alpha, {drawn("reg_lambda", "t")} AS lam, {drawn("min_child_weight", "t")} AS least, f AS vfold
  FROM range({Q.STEP_TRIALS}) a(t), range({Q.STEP_FOLDS}) b(f)),
{boosting(Q.STEP_DEPTH, Q.STEP_ROUNDS, Q.STEP_PATIENCE)},
z AS (SELECT m, max(rnd) AS n, arg_max(br, rnd) AS br, arg_max(bl, rnd) AS bl FROM s WHERE lvl = 0 GROUP BY m),
o AS (SELECT m, s.y AS label, CAST(round_even({PROB}, 0) AS INTEGER) AS prediction FROM s JOIN z USING (m) JOIN p USING (m) WHERE lvl = 0 AND rnd = z.br + 1 AND fold = vfold),
c AS (SELECT m, {confusion()}, count(*) AS nv FROM o GROUP BY m)
SELECT CAST(m // {Q.STEP_FOLDS} AS INTEGER) AS trial_id, CAST(m % {Q.STEP_FOLDS} AS INTEGER) AS fold, br AS best_round, n AS n_rounds,
  {R(f"bl / {LOSS}.0 / nv")} AS logloss, tp, fp, tn, fn FROM z JOIN c USING (m)"""

COPY_COUNT = " + ".join(f"CAST(v >= {t} AS INTEGER)" for t in COPIES)

ORACLE["rf_importance"] = f"""
WITH RECURSIVE {ORDERS.replace("label AS y,", "label AS y, 0 AS fold,")},
{binned()},
p AS MATERIALIZED (SELECT m, 0.0::DOUBLE AS alpha, 0.0::DOUBLE AS lam, 1.0::DOUBLE AS least FROM range({Q.FOREST_TREES}) t(m)),
d AS (SELECT k, g8, md5('{SPLIT_SEED}:' || g8 || ':' || k) AS digest FROM b, range({-(-Q.FOREST_TREES // 8)}) t(g8)),
w AS (SELECT m, k, {COPY_COUNT} AS w FROM (SELECT p.m, d.k, ('0x' || substr(digest, 1 + 4 * (p.m % 8)::INTEGER, 4))::INTEGER AS v FROM p JOIN d ON d.g8 = p.m // 8)),
s AS (
  SELECT m, b0, b1, b2, b3, CAST(-w * y AS BIGINT) * {SCALE} AS g, CAST(w AS BIGINT) * {SCALE} AS h, 1::BIGINT AS node, 0 AS lvl, NULL::INTEGER AS f, NULL::DOUBLE AS gain
  FROM b JOIN w USING (k) WHERE w > 0
  UNION ALL
  SELECT s.m, b0, b1, b2, b3, g, h,
    CASE WHEN t.f IS NULL THEN s.node ELSE 2 * s.node + CAST(list_extract([b0, b1, b2, b3], t.f + 1) > t.cut AS BIGINT) END, lvl + 1, t.f, t.gain
  FROM s LEFT JOIN {split("s", f"AND list_contains(list_sort([md5('{SPLIT_SEED}:' || m || ':' || bin(node) || ':' || i) for i in range(4)])[1:{int(math.sqrt(4))}], "
                              f"md5('{SPLIT_SEED}:' || m || ':' || bin(node) || ':' || f))")} t ON t.m = s.m AND t.node = s.node
  WHERE lvl < {Q.FOREST_DEPTH}),
g AS (SELECT m, f, sum(gain) AS gain FROM (SELECT m, lvl, node // 2 AS node, any_value(f) AS f, any_value(gain) AS gain FROM s WHERE f IS NOT NULL GROUP BY ALL) GROUP BY ALL),
i AS (SELECT f, sum(share) AS share FROM (SELECT f, gain / sum(gain) OVER (PARTITION BY m) AS share FROM g) GROUP BY f)
SELECT {FEATURE} AS feature, {R("coalesce(share, 0.0) / sum(share) OVER ()")} AS importance FROM range(4) t(f) LEFT JOIN i USING (f)"""


# ---------------------------------------------------------------- logistic models, by the same Newton steps

PAIRS = [(i, j) for i in range(5) for j in range(i, 5)]
#: Newton steps, and sweeps over the weights inside a step: a recursion's step is one scan or one sweep.
NEWTON, SWEEPS = 14, 150
W5 = range(5)


def cols(*names: str) -> str:
    return ", ".join(f"{n}{i}" for n in names for i in W5)


def h(i: int, j: int) -> str:
    return f"h{min(i, j)}{max(i, j)}"


def newton(folds: int, penalty: str) -> str:
    """t (f, c, a0 ... a4): weights of each fold (-1: all rows) and strength, from tr (y, x0 ... x3, fold)."""
    scaled = ", ".join(f"CASE WHEN max(x{i}) OVER () > min(x{i}) OVER () THEN (x{i} - min(x{i}) OVER ()) / (max(x{i}) OVER () - min(x{i}) OVER ()) ELSE 0.0 END AS z{i}"
                       for i in range(4))
    hs = ", ".join(h(i, j) for i, j in PAIRS)
    sweep = f"(SELECT * FROM n WHERE turn < {SWEEPS})"
    for j in W5:
        slope = f"c * g{j} + c * (" + " + ".join(f"{h(j, i)} * (a{i} - w{i})" for i in W5) + ")"
        place = f"(c * {h(j, j)} * a{j} - ({slope}))"
        moved = (f"{place} / (c * {h(j, j)} + 1.0)" if penalty == "l2"
                 else f"CASE WHEN {h(j, j)} > 0 THEN sign({place}) * greatest(abs({place}) - 1.0, 0.0) / (c * {h(j, j)}) ELSE 0.0 END")
        sweep = f"(SELECT * REPLACE ({moved} AS a{j}) FROM {sweep})"
    grad = ", ".join(f"sum((q - y) * z{i}) AS g{i}" for i in W5)
    hess = ", ".join(f"sum(q * (1 - q) * z{i} * z{j}) AS {h(i, j)}" for i, j in PAIRS)
    return f"""zz AS MATERIALIZED (SELECT y, fold, {scaled}, 1.0::DOUBLE AS z4 FROM tr),
n AS (
  SELECT 0 AS i, {SWEEPS} AS turn, f, 10.0::DOUBLE ** e AS c, {", ".join(f"0.0::DOUBLE AS {n}{i}" for n in "awg" for i in W5)},
    {", ".join(f"0.0::DOUBLE AS {h(i, j)}" for i, j in PAIRS)} FROM range(-1, {folds}) a(f), range(-5, 6) b(e)
  UNION ALL
  (SELECT i, turn + 1, f, c, {cols("a", "w", "g")}, {hs} FROM {sweep}
  UNION ALL
  SELECT i + 1, 0, f, c, {cols("a")}, {cols("a")}, {cols("g")}, {hs} FROM (
    SELECT i, f, c, {", ".join(f"any_value(a{i}) AS a{i}" for i in W5)}, {grad}, {hess} FROM (
      SELECT i, f, c, {cols("a")}, y, {cols("z")}, 1.0 / (1.0 + exp(-({" + ".join(f"a{i} * z{i}" for i in W5)}))) AS q FROM n JOIN zz ON zz.fold <> n.f
      WHERE turn = {SWEEPS} AND i < {NEWTON}) GROUP BY i, f, c))),
t AS MATERIALIZED (SELECT f, c, {cols("a")} FROM n WHERE i = {NEWTON} AND turn = {SWEEPS})"""


def scored(metric: str) -> str:
    dot = " + ".join(f"a{i} * z{i}" for i in W5)
    return f"""o AS (SELECT f, c, y AS label, CAST({dot} > 0 AS INTEGER) AS prediction FROM t JOIN zz ON zz.fold = t.f),
cc AS (SELECT f, c, {confusion()} FROM o GROUP BY f, c),
rt AS (SELECT f, c, coalesce((tp + tn) / nullif(tp + fp + tn + fn, 0), 0.0) AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision,
  coalesce(tp / nullif(tp + fn, 0), 0.0) AS recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0) AS f1 FROM cc),
sc AS (SELECT c, round(avg({metric}), 12) AS score FROM rt GROUP BY c)"""


def logit(metric: str, penalty: str) -> str:
    return f"""
WITH RECURSIVE {ORDERS.replace("tr AS (", "tr0 AS (")},
tr AS (SELECT y, x0, x1, x2, x3, fold FROM ({kfold_sql("tr0", "k", SPLIT_SEED, 10)})),
{newton(10, penalty)},
{scored(metric)},
best AS (SELECT arg_max([{cols("a")}], [score, -c]) AS w FROM sc JOIN t USING (c) WHERE f = -1)
SELECT {FEATURE} AS feature, {R("w[CAST(f + 1 AS BIGINT)]")} AS importance FROM best, range(4) r(f)"""


ORACLE["logit_importance"] = logit("f1", "l2")
ORACLE["logit_importance_l1"] = logit("accuracy", "l1")
ORACLE["logit_scores"] = f"""
WITH RECURSIVE {DOCS.replace("tr AS (", "tr0 AS (")},
tr AS (SELECT y, x0, x1, x2, x3, fold FROM ({kfold_sql("tr0", "k", SPLIT_SEED, 5)})),
{newton(5, "l2")},
{scored("f1")}
SELECT metric, c AS strength, {R("avg(v)")} AS score FROM (UNPIVOT rt ON accuracy, precision, recall, f1 INTO NAME metric VALUE v) GROUP BY metric, c"""
