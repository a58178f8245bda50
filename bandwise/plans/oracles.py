"""DuckDB twins of the registered queries (views: the driver table names)."""

from __future__ import annotations

from bandwise.plans.sql_common import avg_rank, corr, ln, log1p, r6, split2, split3

ALPHA = "0.05::DOUBLE"
INSIDE = "CASE WHEN y_real >= lower AND y_real <= upper THEN 1.0 ELSE 0.0 END"


def cov_verdict(cov: str) -> str:
    return (f"CASE WHEN {cov} < 0.90 THEN 'over-confident' WHEN {cov} > 0.99 THEN 'under-confident' "
            f"WHEN {cov} IS NOT NULL THEN 'well calibrated' END")


def events_calibrated(group: str = "segment") -> str:
    """CTEs base, g, p, t, c (calibrated rows), sc, kk, q (global conformal q_hat)."""
    return f"""
base AS (
  SELECT event_id AS key, event_type AS segment, user_id, value, {log1p('value')} AS y,
         {split3('event_id')} AS split
  FROM events),
g AS (
  SELECT {group}, avg(y) AS mu, ln(greatest(var_pop(y), 1e-12)) AS log_var
  FROM base WHERE split = 'train' GROUP BY {group}),
p AS (SELECT base.*, g.mu, g.log_var FROM base LEFT JOIN g USING ({group})),
t AS (
  SELECT ln(avg(pow(y - mu, 2) * exp(-log_var))) AS bias,
         sqrt(avg(pow(y - mu, 2) * exp(-log_var))) AS temperature
  FROM p WHERE split = 'val'),
c AS (
  SELECT p.*, p.log_var + t.bias AS log_var_cal, exp(0.5 * (p.log_var + t.bias)) AS sigma,
         t.temperature
  FROM p CROSS JOIN t),
sc AS (
  SELECT abs(y - mu) / sigma AS score,
         row_number() OVER (ORDER BY abs(y - mu) / sigma) AS rn,
         count(*) OVER () AS n
  FROM c WHERE split = 'val' AND abs(y - mu) / sigma IS NOT NULL),
kk AS (SELECT DISTINCT n, ceil((n + 1) * (1.0::DOUBLE - {ALPHA})) AS k FROM sc),
q AS (
  SELECT sc.score AS q_hat, sc.n AS n_cal,
         (CASE WHEN kk.k < kk.n THEN kk.k + 1 ELSE kk.n END)::BIGINT AS rank
  FROM sc CROSS JOIN kk
  WHERE sc.rn = CASE WHEN kk.k < kk.n THEN kk.k + 1 ELSE kk.n END),
te AS (
  SELECT c.key, c.segment, c.user_id, exp(c.y) - 1 AS y_real, exp(c.mu) - 1 AS point,
         exp(c.mu - q.q_hat * c.sigma) - 1 AS lower, exp(c.mu + q.q_hat * c.sigma) - 1 AS upper,
         (exp(c.mu + q.q_hat * c.sigma) - 1) - (exp(c.mu - q.q_hat * c.sigma) - 1) AS width,
         c.temperature, q.q_hat, q.n_cal, q.rank
  FROM c CROSS JOIN q WHERE c.split = 'test')"""


def calibration_chain() -> str:
    return f"""
WITH {events_calibrated('segment')},
w AS (SELECT segment, y_real, width, abs(y_real - point) AS abs_error,
             lower, upper, temperature, q_hat FROM te),
rk AS (SELECT *, {avg_rank('width', 'segment')} AS rw, {avg_rank('abs_error', 'segment')} AS re FROM w)
SELECT segment, count(y_real) AS n,
  {r6(f'avg({INSIDE})')} AS coverage,
  {cov_verdict(f'avg({INSIDE})')} AS verdict,
  {r6('avg(width)')} AS mean_width,
  {r6('100.0 * avg(width) / nullif(max(y_real) - min(y_real), 0)')} AS width_pct_range,
  {r6('stddev_pop(width)')} AS width_std,
  {r6(corr('rw', 're'))} AS error_width_spearman,
  {r6('any_value(temperature)')} AS temperature,
  {r6('any_value(q_hat)')} AS q_hat
FROM rk GROUP BY segment
"""


EV = events_calibrated("user_id")


def gaussian_interval_rows() -> str:
    return f"""
WITH {EV}
SELECT key, {r6('exp(y) - 1')} AS truth, {r6('exp(mu) - 1')} AS point,
  {r6('exp(mu - 1.96 * sigma) - 1')} AS lower, {r6('exp(mu + 1.96 * sigma) - 1')} AS upper,
  {r6('(exp(mu + 1.96 * sigma) - 1) - (exp(mu - 1.96 * sigma) - 1)')} AS width
FROM c WHERE split = 'test'
"""


def nll_before_after_report() -> str:
    nll_raw = "avg(0.5 * (log_var + pow(y - mu, 2) * exp(-log_var)))"
    nll_cal = "avg(0.5 * (log_var_cal + pow(y - mu, 2) * exp(-log_var_cal)))"
    hit = "avg(CASE WHEN y >= mu - 1.96 * sigma AND y <= mu + 1.96 * sigma THEN 1.0 ELSE 0.0 END)"
    return f"""
WITH {EV}
SELECT count(y) AS n, {r6(nll_raw)} AS nll_raw, {r6(nll_cal)} AS nll_cal,
  {r6(f'{nll_raw} - {nll_cal}')} AS improvement, {r6(hit)} AS coverage_model_scale
FROM c WHERE split = 'test'
"""


def temperature_scale() -> str:
    z2 = "avg(pow(y - mu, 2) * exp(-log_var))"
    return f"""
WITH {EV}
SELECT segment, {r6(f'ln({z2})')} AS bias, {r6(f'sqrt({z2})')} AS temperature, count(*) AS n_cal
FROM p WHERE split = 'val' GROUP BY segment
"""


def temperature_batched() -> str:
    return f"""
WITH {EV},
v AS (SELECT pow(y - mu, 2) * exp(-log_var) AS z2, row_number() OVER (ORDER BY key) AS rn
      FROM p WHERE split = 'val'),
bm AS (SELECT floor((rn - 1) / 256) AS b, avg(z2) AS m, count(*) AS nb FROM v GROUP BY 1)
SELECT {r6('ln(avg(m))')} AS bias, {r6('sqrt(avg(m))')} AS temperature, sum(nb)::BIGINT AS n_cal FROM bm
"""


def conformal_interval() -> str:
    cov = f"avg({INSIDE})"
    return f"""
WITH {EV}
SELECT count(y_real) AS n, {r6(cov)} AS coverage, {cov_verdict(cov)} AS verdict,
  {r6('any_value(q_hat)')} AS q_hat, any_value(n_cal) AS n_cal, any_value(rank) AS rank,
  {r6('avg(width)')} AS mean_width
FROM te
"""


def conformal_by_segment() -> str:
    cov = f"avg({INSIDE})"
    return f"""
WITH {EV},
ss AS (
  SELECT segment, abs(y - mu) / sigma AS score,
         row_number() OVER (PARTITION BY segment ORDER BY abs(y - mu) / sigma) AS rn,
         count(*) OVER (PARTITION BY segment) AS n
  FROM c WHERE split = 'val' AND abs(y - mu) / sigma IS NOT NULL),
sk AS (SELECT DISTINCT segment, n, ceil((n + 1) * (1.0::DOUBLE - {ALPHA})) AS k FROM ss),
sq AS (
  SELECT ss.segment, ss.score AS q_hat, ss.n AS n_cal,
         (CASE WHEN sk.k < sk.n THEN sk.k + 1 ELSE sk.n END)::BIGINT AS rank
  FROM ss JOIN sk USING (segment)
  WHERE ss.rn = CASE WHEN sk.k < sk.n THEN sk.k + 1 ELSE sk.n END),
st AS (
  SELECT c.segment, exp(c.y) - 1 AS y_real,
         exp(c.mu - sq.q_hat * c.sigma) - 1 AS lower, exp(c.mu + sq.q_hat * c.sigma) - 1 AS upper,
         sq.q_hat, sq.n_cal, sq.rank
  FROM c LEFT JOIN sq USING (segment) WHERE c.split = 'test')
SELECT segment, count(y_real) AS n, {r6(cov)} AS coverage, {cov_verdict(cov)} AS verdict,
  {r6('any_value(q_hat)')} AS q_hat, any_value(n_cal) AS n_cal, any_value(rank) AS rank
FROM st GROUP BY segment
"""


def asymmetric_bars_rows() -> str:
    return f"""
WITH {EV}
SELECT key, {r6('point - lower')} AS err_low, {r6('upper - point')} AS err_high FROM te
"""


def coverage_verdicts() -> str:
    def one(stage: str, sig: str) -> str:
        inside = (f"CASE WHEN exp(y) - 1 >= exp(mu - 1.96 * {sig}) - 1 AND "
                  f"exp(y) - 1 <= exp(mu + 1.96 * {sig}) - 1 THEN 1.0 ELSE 0.0 END")
        return (f"SELECT split, '{stage}' AS stage, count(y) AS n, {r6(f'avg({inside})')} AS coverage, "
                f"{cov_verdict(f'avg({inside})')} AS verdict FROM c WHERE split <> 'train' GROUP BY split")
    return f"""
WITH {EV}
{one('raw', 'exp(0.5 * log_var)')}
UNION ALL
{one('calibrated', 'sigma')}
"""


def sharpness_report() -> str:
    return f"""
WITH {EV},
w AS (SELECT y_real, width, abs(y_real - point) AS abs_error FROM te),
rk AS (SELECT *, {avg_rank('width')} AS rw, {avg_rank('abs_error')} AS re FROM w)
SELECT count(y_real) AS n, {r6('avg(width)')} AS mean_width,
  {r6('100.0 * avg(width) / nullif(max(y_real) - min(y_real), 0)')} AS width_pct_range,
  {r6('stddev_pop(width)')} AS width_std, {r6(corr('rw', 're'))} AS error_width_spearman
FROM rk
"""


def spearman_width_error() -> str:
    return f"""
WITH {EV},
w AS (SELECT segment, width, abs(y_real - point) AS abs_error FROM te),
per AS (SELECT segment, {avg_rank('width', 'segment')} AS rw, {avg_rank('abs_error', 'segment')} AS re FROM w),
al AS (SELECT {avg_rank('width')} AS rw, {avg_rank('abs_error')} AS re FROM w)
SELECT segment, {r6(corr('rw', 're'))} AS spearman FROM per GROUP BY segment
UNION ALL
SELECT 'ALL' AS segment, {r6(corr('rw', 're'))} AS spearman FROM al
"""


def row_verdicts() -> str:
    inside = "(y_real >= lower AND y_real <= upper)"
    return f"""
WITH {EV}
SELECT key, {r6('y_real')} AS truth, {r6('point')} AS prediction, {r6('lower')} AS range_low,
  {r6('upper')} AS range_high, {inside} AS inside, {r6('upper - lower')} AS width,
  CASE WHEN {inside} THEN 'SUCCESS' ELSE 'FAILURE' END AS verdict
FROM te
"""


def top_by_truth() -> str:
    return f"""
WITH {EV},
top AS (SELECT * FROM te ORDER BY y_real, key LIMIT 100)
SELECT row_number() OVER (ORDER BY y_real, key) AS position, key, {r6('y_real')} AS truth,
  {r6('point')} AS point, {r6('point - lower')} AS err_low, {r6('upper - point')} AS err_high
FROM top
"""


def sample_sorted_band() -> str:
    return f"""
WITH {EV},
s AS (SELECT * FROM te ORDER BY md5('42:' || key::VARCHAR), key LIMIT 200)
SELECT row_number() OVER (ORDER BY y_real, key) AS position, key, {r6('y_real')} AS truth,
  {r6('point')} AS point, {r6('lower')} AS lower, {r6('upper')} AS upper
FROM s
"""


# ---- preparation and statistics -----------------------------------------------

LINEITEM_FEATURES = ["l_quantity", "l_discount", "l_tax", "p_retailprice", "p_size"]
LI_KEY = ("concat_ws('-', l_orderkey::VARCHAR, l_linenumber::VARCHAR, "
          "l_partkey::VARCHAR, l_suppkey::VARCHAR)")
LINEITEM_FRAME = f"""
lp AS (
  SELECT {LI_KEY} AS key, p_type AS segment,
         {', '.join(f'{c}::DOUBLE AS {c}' for c in LINEITEM_FEATURES)},
         l_extendedprice::DOUBLE AS y, {split3(LI_KEY)} AS split
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def positive_filter_rows() -> str:
    return "SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey > 0 AND c_acctbal > 0"


def ordinal_encode_rows() -> str:
    return """
SELECT o_orderkey, o_orderpriority,
  (CASE WHEN o_orderpriority = '1-URGENT' THEN 1 WHEN o_orderpriority = '2-HIGH' THEN 2
        WHEN o_orderpriority = '3-MEDIUM' THEN 3 WHEN o_orderpriority = '5-LOW' THEN 4
        ELSE 0 END)::INTEGER AS o_orderpriority_score
FROM orders
"""


def hash_split_counts() -> str:
    return f"""
SELECT 'orders' AS table_name, {split3('o_orderkey')} AS split, count(*) AS n FROM orders GROUP BY 2
UNION ALL
SELECT 'documents' AS table_name, {split2('doc_id')} AS split, count(*) AS n FROM documents GROUP BY 2
"""


def standardize_train_stats_rows() -> str:
    parts = [f"SELECT '{c}' AS feature, {r6(f'avg({c})')} AS mean, {r6(f'stddev_pop({c})')} AS std, "
             f"count(*) AS n FROM lp WHERE split = 'train'" for c in LINEITEM_FEATURES]
    return f"WITH {LINEITEM_FRAME}\n" + "\nUNION ALL\n".join(parts)


def standardized_check() -> str:
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in LINEITEM_FEATURES)
    parts = []
    for c in LINEITEM_FEATURES:
        z = f"(({c} - m_{c}) / (CASE WHEN s_{c} = 0 THEN 1.0 ELSE s_{c} END))"
        parts.append(f"SELECT split, '{c}' AS feature, round(avg({z}), 6) + 0.0 AS mean, "
                     f"round(stddev_pop({z}), 6) + 0.0 AS std, count(*) AS n "
                     f"FROM lp CROSS JOIN st GROUP BY split")
    return f"WITH {LINEITEM_FRAME},\nst AS (SELECT {stats} FROM lp WHERE split = 'train')\n" + \
        "\nUNION ALL\n".join(parts)


def target_transform_rows() -> str:
    return f"""
SELECT event_id, {r6(log1p('value'), 9)} AS y_log1p, {r6(ln('value'), 9)} AS y_log,
  {r6(f"exp({log1p('value')}) - 1", 9)} AS back_log1p, {r6(f"exp({ln('value')})", 9)} AS back_log
FROM events
"""


def drop_select_rows() -> str:
    return f"WITH {LINEITEM_FRAME}\nSELECT key, {', '.join(LINEITEM_FEATURES)}, y, split FROM lp"


def skew_audit_rows() -> str:
    return f"""
WITH s AS (
  SELECT 'identity' AS transform, value::DOUBLE AS x FROM events
  UNION ALL SELECT 'log1p', {log1p('value')} FROM events
  UNION ALL SELECT 'log', {ln('value')} FROM events),
m AS (SELECT transform, avg(x) AS mean FROM s GROUP BY transform),
a AS (
  SELECT transform, count(x) AS n,
         avg(pow(x - mean, 3)) / nullif(pow(var_pop(x), 1.5), 0) AS skewness,
         any_value(mean) AS mean, quantile_cont(x, 0.5) AS median
  FROM s JOIN m USING (transform) GROUP BY transform)
SELECT transform, n, {r6('skewness')} AS skewness, {r6('mean')} AS mean, {r6('median')} AS median,
  CASE WHEN skewness < -1.0 THEN 'skewed left' WHEN skewness > 1.0 THEN 'skewed right, log-transform advised'
       WHEN skewness IS NOT NULL THEN 'symmetric' END AS verdict
FROM a
"""


def _histogram(source_cte: str, value: str) -> str:
    return f"""
WITH {source_cte},
hv AS (SELECT {value} AS x FROM hsrc WHERE {value} IS NOT NULL),
r0 AS (SELECT min(x) AS lo0, max(x) AS hi0 FROM hv),
r AS (SELECT CASE WHEN hi0 > lo0 THEN lo0 ELSE lo0 - 0.5 END AS lo,
             CASE WHEN hi0 > lo0 THEN hi0 ELSE hi0 + 0.5 END AS hi FROM r0),
cnt AS (SELECT least(floor((x - lo) / ((hi - lo) / 30.0))::INTEGER, 29) AS bin, count(*) AS n
        FROM hv CROSS JOIN r GROUP BY 1),
edges AS (SELECT range::INTEGER AS bin, lo + range * ((hi - lo) / 30.0) AS bin_lo,
                 lo + (range + 1) * ((hi - lo) / 30.0) AS bin_hi FROM range(30) CROSS JOIN r)
SELECT edges.bin, {r6('bin_lo')} AS bin_lo, {r6('bin_hi')} AS bin_hi, coalesce(n, 0)::BIGINT AS count
FROM edges LEFT JOIN cnt USING (bin)
"""


def width_histogram() -> str:
    return _histogram(f"{EV},\nhsrc AS (SELECT width FROM te)", "width")


def target_histogram() -> str:
    return _histogram(f"hsrc AS (SELECT {log1p('value')} AS y FROM events)", "y")


def density_curve_rows() -> str:
    return f"""
WITH dv AS (SELECT {log1p('value')} AS x FROM events WHERE {log1p('value')} IS NOT NULL),
st AS (SELECT count(x) AS n, stddev_samp(x) * pow(count(x)::DOUBLE, -0.2) AS h,
              min(x) AS mn, max(x) AS mx FROM dv),
gr AS (SELECT range::INTEGER AS point,
              (mn - 0.0 * h) + range * ((mx - mn + 0.0 * h) / 199.0) AS g FROM range(200) CROSS JOIN st),
k AS (SELECT point, any_value(g) AS g, sum(exp(-0.5 * pow((g - x) / h, 2))) AS s
      FROM gr CROSS JOIN dv CROSS JOIN st GROUP BY point)
SELECT point, {r6('g', 9)} AS x, {r6('s / (n * h * sqrt(2 * pi()))', 9)} AS density,
  {r6('s / (n * h * sqrt(2 * pi())) * n * ((mx - mn) / 30.0)')} AS count_scale
FROM k CROSS JOIN st
"""


def order_stat_quantile() -> str:
    def one(part: str, label: str) -> str:
        pby = f"PARTITION BY {part}" if part else ""
        return f"""
SELECT {label} AS o_orderstatus, q_value, n, r FROM (
  SELECT {part + ',' if part else ''} o_totalprice AS q_value, n,
         (CASE WHEN k < n THEN k + 1 ELSE n END)::BIGINT AS r, rn
  FROM (SELECT *, row_number() OVER ({pby} ORDER BY o_totalprice) AS rn,
               count(*) OVER ({pby}) AS n,
               ceil((count(*) OVER ({pby}) + 1) * (1.0::DOUBLE - {ALPHA})) AS k
        FROM orders)) WHERE rn = r"""
    return one("o_orderstatus", "o_orderstatus") + "\nUNION ALL" + one("", "'ALL'")


GROUP_BOUNDS = """
gb AS (SELECT segment, quantile_cont(y, 0.05) AS q_lower, quantile_cont(y, 0.95) AS q_upper,
              count(y) AS n_train FROM lp WHERE split = 'train' GROUP BY segment)"""


def group_quantile_interval() -> str:
    return f"""
WITH {LINEITEM_FRAME},{GROUP_BOUNDS}
SELECT segment, {r6('q_lower')} AS q_lower, {r6('q_upper')} AS q_upper, n_train FROM gb
"""


def report_card_rows() -> str:
    cov = "avg(CASE WHEN y >= q_lower AND y <= q_upper THEN 1.0 ELSE 0.0 END)"
    return f"""
WITH {LINEITEM_FRAME},{GROUP_BOUNDS}
SELECT segment, count(y) AS n, {r6(cov)} AS coverage, {r6('avg(q_upper - q_lower)')} AS mean_width,
  {r6('avg(y)')} AS mean_target,
  {r6('100.0 * avg(q_upper - q_lower) / nullif(avg(y), 0)')} AS relative_width_pct,
  CASE WHEN abs({cov} - 0.9) < 0.05 THEN 'good' ELSE 'needs calibration' END AS verdict
FROM lp JOIN gb USING (segment) WHERE split = 'test' GROUP BY segment
"""


# ---- phase 6: linear variational model on documents ---------------------------

def _hash_u(parts: str) -> str:
    return f"((('0x' || substr(md5(concat_ws(':', {parts})), 1, 8))::BIGINT::DOUBLE + 0.5) / 4294967296.0)"


DOCS_POSTERIOR = f"""
d0 AS (
  SELECT doc_id AS key, lang AS segment,
         ln(len(string_split_regex(text, '\\s+'))::DOUBLE + 1.0) AS xw,
         {ln('n_chars')} AS y, {split3('doc_id')} AS split
  FROM documents),
sx AS (SELECT avg(xw) AS m, stddev_pop(xw) AS s FROM d0 WHERE split = 'train'),
d AS (SELECT d0.*, (xw - m) / (CASE WHEN s = 0 THEN 1.0 ELSE s END) AS x FROM d0 CROSS JOIN sx),
agg AS (
  SELECT count(*) AS n, sum(x * x) AS a00, sum(x) AS a01, count(*)::DOUBLE AS a11,
         sum(x * y) AS c0, sum(y) AS c1
  FROM d WHERE split = 'train' AND y IS NOT NULL),
sol AS (
  SELECT n, 1.0 / n AS lam, a00, a11,
         ((a11 + 0.5 / n) * c0 - a01 * c1) / ((a00 + 0.5 / n) * (a11 + 0.5 / n) - a01 * a01) AS mu0,
         ((a00 + 0.5 / n) * c1 - a01 * c0) / ((a00 + 0.5 / n) * (a11 + 0.5 / n) - a01 * a01) AS mu1
  FROM agg),
post AS (
  SELECT 0 AS col, 'weight' AS kind, 'x_words' AS name, mu0 AS mu,
         sqrt(lam / (lam + 2 * a00)) AS sigma FROM sol
  UNION ALL
  SELECT 1, 'bias', 'bias', mu1, sqrt(lam / (lam + 2 * a11)) FROM sol),
dr AS (
  SELECT range AS draw, col, mu + sigma * (
           sqrt(-2.0 * ln({_hash_u("'42', range::VARCHAR, col::VARCHAR, 'a'")})) *
           cos(6.283185307179586 * {_hash_u("'42', range::VARCHAR, col::VARCHAR, 'b'")})) AS w
  FROM post CROSS JOIN range(100)),
wd AS (SELECT draw, max(CASE WHEN col = 0 THEN w END) AS w0, max(CASE WHEN col = 1 THEN w END) AS w1
       FROM dr GROUP BY draw),
mc AS (
  SELECT d.key, d.segment, any_value(d.y) AS y, avg(d.x * w0 + w1) AS mc_mean,
         stddev_pop(d.x * w0 + w1) AS mc_std
  FROM d CROSS JOIN wd WHERE d.split = 'test' GROUP BY d.key, d.segment)"""


def linear_posterior() -> str:
    return f"""
WITH {DOCS_POSTERIOR}
SELECT 0 AS layer, 0 AS row, col, kind, name, {r6('mu')} AS mu, {r6('sigma', 9)} AS sigma,
  {r6('ln(exp(sigma) - 1)')} AS rho
FROM post
"""


def posterior_kl_report() -> str:
    return f"""
WITH {DOCS_POSTERIOR}
SELECT count(*) AS n_weights,
  {r6('0.5 * sum(mu * mu + sigma * sigma - 2 * ln(sigma) - 1)', 4)} AS kl
FROM post
"""


def mc_predictive_linear() -> str:
    return f"WITH {DOCS_POSTERIOR}\nSELECT key, {r6('mc_mean')} AS mc_mean, {r6('mc_std', 9)} AS mc_std FROM mc"


def credible_interval_rows() -> str:
    return f"""
WITH {DOCS_POSTERIOR}
SELECT key, {r6('exp(y)')} AS truth, {r6('exp(mc_mean)')} AS point,
  {r6('exp(mc_mean - 2.0 * mc_std)')} AS lower, {r6('exp(mc_mean + 2.0 * mc_std)')} AS upper
FROM mc
"""


def spread_diagnosis_report() -> str:
    return f"""
WITH {DOCS_POSTERIOR}
SELECT segment AS lang, count(mc_std) AS n, {r6('avg(mc_std)', 9)} AS mean_std,
  CASE WHEN avg(mc_std) < 0.01 THEN 'collapsed' WHEN avg(mc_std) > 1.0 THEN 'exploding'
       WHEN avg(mc_std) IS NOT NULL THEN 'healthy' END AS verdict
FROM mc GROUP BY segment
"""


ORACLES_PHASE6 = {
    "linear_posterior": linear_posterior,
    "posterior_kl": posterior_kl_report,
    "mc_predictive_linear": mc_predictive_linear,
    "credible_interval": credible_interval_rows,
    "spread_diagnosis": spread_diagnosis_report,
}


# ---- phase 7: nearest centre on the embeddings ---------------------------------

def nearest_center_rows() -> str:
    return f"""
WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda v: v::DOUBLE) AS emb,
                  {split3('vec_id')} AS split FROM embeddings),
u AS (SELECT label, unnest(emb) AS v, generate_subscripts(emb, 1) AS i FROM e WHERE split = 'train'),
cd AS (SELECT label, i, avg(v) AS m FROM u GROUP BY label, i),
ce AS (SELECT label AS center, list(m ORDER BY i) AS c FROM cd GROUP BY label),
dd AS (SELECT e.vec_id, e.label, ce.center,
              list_reduce(list_transform(list_zip(e.emb, ce.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])),
                          lambda a, b: a + b) AS d
       FROM e CROSS JOIN ce),
best AS (SELECT vec_id, label, arg_min(center, (d, center)) AS center, min(d) AS d
         FROM dd GROUP BY vec_id, label)
SELECT vec_id, label, center, {r6('d')} AS distance FROM best
"""


ORACLES_PHASE7 = {"nearest_center": nearest_center_rows}


# ---- added plot tables and the single-row verdict -------------------------------

def error_width_points() -> str:
    return f"""
WITH {EV}
SELECT key, {r6('width')} AS width, {r6('abs(y_real - point)')} AS abs_error
FROM te
"""


def single_row_verdict() -> str:
    inside = "(y_real >= lower AND y_real <= upper)"
    return f"""
WITH {EV},
one AS (SELECT * FROM te ORDER BY md5('42:' || key::VARCHAR), key LIMIT 1)
SELECT key, {r6('y_real')} AS truth, {r6('point')} AS prediction, {r6('lower')} AS range_low,
  {r6('upper')} AS range_high, {inside} AS inside, {r6('upper - lower')} AS width,
  CASE WHEN {inside} THEN 'SUCCESS' ELSE 'FAILURE' END AS verdict
FROM one
"""


def mc_sample_bars() -> str:
    return f"""
WITH {DOCS_POSTERIOR},
s AS (SELECT * FROM mc ORDER BY md5('42:' || key::VARCHAR), key LIMIT 20)
SELECT key, {r6('exp(y)')} AS truth, {r6('exp(mc_mean)')} AS point,
  {r6('exp(mc_mean) - exp(mc_mean - 2.0 * mc_std)')} AS err_low,
  {r6('exp(mc_mean + 2.0 * mc_std) - exp(mc_mean)')} AS err_high
FROM s
"""


ORACLES_EXTRA = {
    "error_width_points": error_width_points,
    "single_row_verdict": single_row_verdict,
    "mc_sample_bars": mc_sample_bars,
}


def mse_report() -> str:
    return f"""
WITH {events_calibrated('user_id')}
SELECT split, count(pow(y - mu, 2)) AS n, {r6('sum(pow(y - mu, 2))')} AS sse, {r6('avg(pow(y - mu, 2))')} AS mse
FROM c GROUP BY split
"""


def anomaly_flags() -> str:
    return f"""
WITH o AS (SELECT o_orderkey AS key, o_totalprice::DOUBLE AS s, {split3('o_orderkey')} AS split FROM orders),
cut AS (SELECT quantile_cont(s, 1.0::DOUBLE - 0.05::DOUBLE) AS q FROM o WHERE split = 'train')
SELECT key, {r6('s - q')} AS weirdness_score, s - q > 0 AS is_anomaly,
  CASE WHEN s - q > 0 THEN 'uncommon' ELSE 'normal' END AS trust
FROM o, cut
"""


def crossing_intervals() -> str:
    return f"""
WITH b AS (
  SELECT (l_extendedprice * (1 - l_discount))::DOUBLE AS lo, l_quantity::DOUBLE * 1500.0::DOUBLE AS hi FROM lineitem)
SELECT lo > hi AS crossed, count(*) AS n, {r6('avg(hi - lo)', 4)} AS mean_raw_width,
  {r6('avg(greatest(lo, hi) - least(lo, hi))', 4)} AS mean_width, 0::BIGINT AS n_crossed_after
FROM b GROUP BY lo > hi
"""


def assembled_features() -> str:
    return """
SELECT o_orderkey AS key, 2 AS width, o_totalprice::DOUBLE AS total,
  CASE o_orderpriority WHEN '1-URGENT' THEN 1.0 WHEN '2-HIGH' THEN 2.0 WHEN '3-MEDIUM' THEN 3.0
       WHEN '5-LOW' THEN 4.0 ELSE 0.0 END::DOUBLE AS priority
FROM orders
"""


def csv_round_trip() -> str:
    return """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 0::BIGINT AS n_rejected FROM customer
"""


def all_oracles() -> dict[str, str]:
    return {
        "calibration_chain": calibration_chain(),
        "positive_filter": positive_filter_rows(),
        "csv_round_trip": csv_round_trip(),
        "ordinal_encode": ordinal_encode_rows(),
        "hash_split_counts": hash_split_counts(),
        "standardize_train_stats": standardize_train_stats_rows(),
        "standardized_check": standardized_check(),
        "target_transform": target_transform_rows(),
        "drop_select": drop_select_rows(),
        "skew_audit": skew_audit_rows(),
        "width_histogram": width_histogram(),
        "target_histogram": target_histogram(),
        "density_curve": density_curve_rows(),
        "spearman_width_error": spearman_width_error(),
        "order_stat_quantile": order_stat_quantile(),
        "top_by_truth": top_by_truth(),
        "sample_sorted_band": sample_sorted_band(),
        "gaussian_interval": gaussian_interval_rows(),
        "group_quantile_interval": group_quantile_interval(),
        "nll_before_after": nll_before_after_report(),
        "temperature_scale": temperature_scale(),
        "temperature_batched": temperature_batched(),
        "conformal_interval": conformal_interval(),
        "conformal_by_segment": conformal_by_segment(),
        "asymmetric_bars": asymmetric_bars_rows(),
        "coverage_verdict": coverage_verdicts(),
        "sharpness_audit": sharpness_report(),
        "report_card": report_card_rows(),
        "row_verdict": row_verdicts(),
        "mse_report": mse_report(),
        "anomaly_flags": anomaly_flags(),
        "crossing_intervals": crossing_intervals(),
        "assembled_features": assembled_features(),
        **{k: f() for k, f in ORACLES_PHASE6.items()},
        **{k: f() for k, f in ORACLES_PHASE7.items()},
        **{k: f() for k, f in ORACLES_EXTRA.items()},
    }
