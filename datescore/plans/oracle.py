"""Oracle SQL for every registered query (DuckDB dialect).

Tables are the driver's pre-registered views. The feature CTE restates the
fixture definition of FIXTURES.md §2 literally (joins and an EXISTS for the
label), independent of the Spark plan, which derives the same rows with one
aggregation and windows. Column names and types match the Spark results.
"""

from __future__ import annotations

# The feature fixture, as CTEs ending in ``features``.
FEATURE_CTES = """
ev AS (
  SELECT user_id, ts, event_type, CAST(ts AS DATE) AS sd,
         CAST(floor(value) AS INTEGER) % 15 AS pre_days
  FROM events),
ev2 AS (SELECT *, sd + pre_days AS dep FROM ev),
g AS (
  SELECT user_id, sd, dep, min(pre_days) AS pre_days,
         CAST(sum(CASE WHEN event_type <> 'click' THEN 1 ELSE 0 END) AS BIGINT) AS search_single,
         CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS ota_single,
         max(CASE WHEN event_type = 'click' AND isodow(ts) = 5 AND hour(ts) >= 18 THEN 1 ELSE 0 END) AS fri,
         max(CASE WHEN event_type = 'click' AND isodow(ts) = 6 AND hour(ts) < 12 THEN 1 ELSE 0 END) AS sat
  FROM ev2 WHERE event_type <> 'purchase'
  GROUP BY user_id, sd, dep),
u AS (
  SELECT user_id, sd, count(*) AS date_cnt, max(pre_days) AS pmax, min(pre_days) AS pmin,
         avg(pre_days) AS pavg, median(pre_days) AS pmed,
         CAST(sum(search_single) AS BIGINT) AS s_cnt, CAST(sum(ota_single) AS BIGINT) AS o_cnt,
         CAST(sum(CASE WHEN isodow(dep) >= 6 THEN 1 ELSE 0 END) AS BIGINT) AS wk
  FROM g GROUP BY user_id, sd),
h AS (
  SELECT user_id, sd,
         sum(wk) OVER (PARTITION BY user_id ORDER BY sd ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cwk,
         sum(date_cnt) OVER (PARTITION BY user_id ORDER BY sd ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cn
  FROM u),
buy AS (SELECT DISTINCT user_id, sd, dep FROM ev2 WHERE event_type = 'purchase'),
features AS (
  SELECT 'u' || CAST(g.user_id AS VARCHAR) AS user_name,
         g.dep AS dep_date_of_search,
         u.date_cnt,
         g.sd AS search_date,
         g.pre_days,
         u.pmax AS pre_days_max,
         u.pmin AS pre_days_min,
         u.pavg AS pre_days_avg,
         abs(g.pre_days - u.pmed) AS difference_between_dep_date_median,
         u.pmax - u.pmin AS dep_date_span,
         u.s_cnt AS search_date_cnt,
         g.search_single AS search_date_single_cnt,
         g.search_single / nullif(u.s_cnt, 0) AS search_date_rate,
         u.o_cnt AS ota_date_cnt,
         g.ota_single AS ota_date_single_cnt,
         g.ota_single / nullif(u.o_cnt, 0) AS ota_date_rate,
         CASE WHEN g.search_single > 0 AND isodow(g.dep) >= 6 THEN 1 ELSE 0 END AS search_date_is_weekend,
         CASE WHEN g.ota_single > 0 AND isodow(g.dep) >= 6 THEN 1 ELSE 0 END AS ota_date_is_weekend,
         g.fri AS ota_date_on_friday_night,
         g.sat AS ota_date_on_saturday_morning,
         CAST(h.cwk AS DOUBLE) / h.cn AS history_weekend_rate,
         CASE WHEN g.user_id % 7 <> 3 THEN CAST(g.user_id % 5 = 0 AS INTEGER) END AS is_student,
         CASE WHEN g.user_id % 7 <> 3 THEN CAST(g.user_id % 4 = 0 AS INTEGER) END AS is_trader,
         strftime(g.sd, '%Y%m%d') AS dt,
         u.pmed AS pre_days_median,
         CASE WHEN EXISTS (SELECT 1 FROM buy b WHERE b.user_id = g.user_id AND b.dep = g.dep
                           AND b.sd > g.sd AND b.sd <= g.sd + 7) THEN 1 ELSE 0 END AS label
  FROM g JOIN u ON g.user_id = u.user_id AND g.sd = u.sd
         JOIN h ON g.user_id = h.user_id AND g.sd = h.sd)
"""

# Fixed values shared with the Spark side (``plans.catalog``).
DAY = "20240115"  # previous day of the run date 2024-01-16
NEXT_DAY = "20240116"
OTHER_DAY = "20240114"
N_SAMPLE = 200

FEATURE_NAMES = [
    "date_cnt", "pre_days", "pre_days_max", "pre_days_min", "pre_days_avg",
    "difference_between_dep_date_median", "dep_date_span", "search_date_cnt",
    "search_date_single_cnt", "search_date_rate", "ota_date_cnt", "ota_date_single_cnt",
    "ota_date_rate", "search_date_is_weekend", "ota_date_is_weekend",
    "ota_date_on_friday_night", "ota_date_on_saturday_morning", "history_weekend_rate",
    "is_student", "is_trader",
]
EXTRACT = ", ".join(
    ["user_name", "dep_date_of_search", "date_cnt", "search_date", *FEATURE_NAMES[1:], "dt"]
)
FILLED_FEATURES = ", ".join(f"coalesce({c}, 0) AS {c}" for c in FEATURE_NAMES)


def with_ctes(*ctes: str) -> str:
    parts = [FEATURE_CTES.strip(), *[c.strip() for c in ctes]]
    return "WITH " + ",\n".join(parts) + "\n"


FILLED = f"""
filled AS (
  SELECT user_name, dep_date_of_search, search_date, dt, label, {FILLED_FEATURES}
  FROM features)
"""

# The fixed three-tree ensemble, written out by hand; leaves and thresholds
# as DOUBLE so the sums are floating point as in Spark.
SCORED = """
trees AS (
  SELECT *,
    CASE WHEN search_date_rate < 0.3::DOUBLE
         THEN (CASE WHEN pre_days < 3 THEN -0.6::DOUBLE ELSE -0.9::DOUBLE END)
         ELSE (CASE WHEN pre_days < 7 THEN -0.2::DOUBLE ELSE -0.5::DOUBLE END) END AS t1,
    CASE WHEN is_student < 0.5::DOUBLE THEN -0.1::DOUBLE ELSE 0.4::DOUBLE END AS t2,
    CASE WHEN history_weekend_rate < 0.25::DOUBLE
         THEN (CASE WHEN date_cnt < 2 THEN 0.7::DOUBLE ELSE -0.3::DOUBLE END)
         ELSE (CASE WHEN date_cnt < 3 THEN 0.5::DOUBLE ELSE -0.2::DOUBLE END) END AS t3
  FROM filled),
scored AS (
  SELECT *,
    1.0::DOUBLE / (1.0::DOUBLE + exp(-(t1))) AS score1,
    1.0::DOUBLE / (1.0::DOUBLE + exp(-(t1 + t2))) AS score2,
    1.0::DOUBLE / (1.0::DOUBLE + exp(-(t1 + t2 + t3))) AS score
  FROM trees)
"""


def _md5_key(seed_sql: str) -> str:
    fields = ", '|', ".join(
        f"CASE WHEN {c} IS NULL THEN '-' ELSE concat(length(CAST({c} AS VARCHAR)), ':', CAST({c} AS VARCHAR)) END"
        for c in ("user_name", "dt", "dep_date_of_search")
    )
    return f"md5(concat({seed_sql}, '|', {fields}))"


# The sampling queries run on features where one user has no name.
NAMELESS_USER = "u149"
SAMPLE = f"""
keyed AS (
  SELECT * REPLACE (CASE WHEN user_name = '{NAMELESS_USER}' THEN NULL ELSE user_name END AS user_name) FROM features),
smp AS (
  SELECT *, row_number() OVER (
    PARTITION BY label ORDER BY {_md5_key("CASE WHEN label = 1 THEN '1' ELSE '43' END")}) AS rn
  FROM keyed WHERE label IN (0, 1)),
sample AS (SELECT * EXCLUDE (rn) FROM smp WHERE rn <= {N_SAMPLE})
"""

KEYS = "user_name, dt, dep_date_of_search"
SAME_KEY = " AND ".join(f"s.{c} IS NOT DISTINCT FROM f.{c}" for c in KEYS.split(", "))
TRAINING = f"{EXTRACT}, pre_days_median, label"

# Settings of the registered model jobs.
QUERY_TREES, QUERY_LIMIT, QUERY_MARK = 20, 15, 5
INIT_POINTS, N_ITER = 10, 25

# Settings of the root's histogram and splits: the same cuts for every feature, and penalties.
BOOST_CUTS = [0.25, 0.5, 1.0, 2.0, 3.0, 5.0, 8.0, 13.0]
BOOST = {"reg_lambda": 1.0, "reg_alpha": 1.0, "min_child_weight": 0.8}


def _root_cells() -> str:
    """Rows, gradients and Hessians of a first tree's root (margin 0: p = 1/2) for each feature and bin."""
    bins = " + ".join(f"CAST({{c}} >= {t}::DOUBLE AS INTEGER)" for t in BOOST_CUTS)
    each = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {i} AS f, CASE WHEN {c} IS NULL THEN -1 ELSE {bins.format(c=c)} END AS bin, label FROM features"
        for i, c in enumerate(FEATURE_NAMES)
    )
    return f"""
cells AS (
  SELECT feature, f, CAST(bin AS INTEGER) AS bin, count(*) AS rows,
         sum(0.5::DOUBLE - label) AS g, count(*) * 0.25::DOUBLE AS h
  FROM ({each}) GROUP BY ALL)"""


def _leaf_score(g: str, h: str) -> str:
    t = f"greatest(abs({g}) - {BOOST['reg_alpha']}::DOUBLE, 0.0::DOUBLE)"
    return f"({t} * {t} / ({h} + {BOOST['reg_lambda']}::DOUBLE))"


def _root_split_sql() -> str:
    last, least = len(BOOST_CUTS), BOOST["min_child_weight"]
    cuts = ", ".join(f"({i}, {t}::DOUBLE)" for i, t in enumerate(BOOST_CUTS))
    gain = f"{_leaf_score('gl', 'hl')} + {_leaf_score('g - gl', 'h - hl')} - {_leaf_score('g', 'h')}"
    return f"""SELECT feature, threshold, missing_left, gain, left_rows FROM (
  SELECT feature, threshold, side = 1 AS missing_left, {gain} AS gain, nl AS left_rows,
         row_number() OVER (PARTITION BY feature ORDER BY {gain} DESC, b, side) AS r
  FROM sides
  WHERE nl > 0 AND n - nl > 0 AND hl >= {least}::DOUBLE AND h - hl >= {least}::DOUBLE AND {gain} > 1e-6
    AND (b < {last} OR side = 0)) WHERE r = 1""", f"""
cuts AS (SELECT * FROM (VALUES {cuts}, ({last}, NULL)) t(b, threshold)),
whole AS (SELECT feature, CAST(sum(rows) AS BIGINT) AS n, sum(g) AS g, sum(h) AS h FROM cells GROUP BY feature)""", """
sides AS (
  SELECT w.feature, c.b, c.threshold, s.side, w.n, w.g, w.h,
         CAST(coalesce(sum(x.rows), 0) AS BIGINT) AS nl, coalesce(sum(x.g), 0) AS gl, coalesce(sum(x.h), 0) AS hl
  FROM whole w CROSS JOIN cuts c CROSS JOIN (VALUES (0), (1)) s(side)
       LEFT JOIN cells x ON x.feature = w.feature AND (x.bin BETWEEN 0 AND c.b OR s.side = 1 AND x.bin = -1)
  GROUP BY ALL)"""


def auc_sql(source: str, by: str = "") -> str:
    """Tie-aware AUC over ``source`` (columns score, label[, by]) with exact integer sums."""
    g = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    return f"""
auc_s AS (
  SELECT {g}score,
         CAST(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos,
         CAST(sum(CASE WHEN label = 0 THEN 1 ELSE 0 END) AS BIGINT) AS neg
  FROM {source} GROUP BY {g}score),
auc_r AS (
  SELECT *, coalesce(sum(neg) OVER ({part}ORDER BY score
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb
  FROM auc_s),
auc_t AS (
  SELECT {g}sum(CAST(pos AS HUGEINT) * (2 * CAST(nb AS HUGEINT) + neg)) AS num,
         CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives
  FROM auc_r {"GROUP BY " + by if by else ""}),
auc_out AS (
  SELECT {g}CASE WHEN positives > 0 AND negatives > 0
              THEN CAST(num AS DOUBLE) / CAST(2 * CAST(positives AS HUGEINT) * negatives AS DOUBLE) END AS auc,
         positives, negatives
  FROM auc_t)
"""


def _ratio(num: str, den: str) -> str:
    return f"coalesce(CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0), 0.0::DOUBLE)"


def counts_sql(pairs: str) -> str:
    def cnt(cond: str) -> str:
        return f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"

    return f"""
cnt AS (
  SELECT {cnt("prediction_label = 1 AND true_label = 1")} AS tp,
         {cnt("prediction_label = 1 AND true_label = 0")} AS fp,
         {cnt("prediction_label = 0 AND true_label = 1")} AS fn,
         {cnt("prediction_label = 0 AND true_label = 0")} AS tn,
         count(*) AS n
  FROM {pairs})
"""


STRICT_PAIRS = """
pairs AS (SELECT label AS true_label, CASE WHEN score > 0.5::DOUBLE THEN 1 ELSE 0 END AS prediction_label FROM scored)
"""
INCLUSIVE_PAIRS = """
pairs AS (SELECT label AS true_label, CASE WHEN score >= 0.5::DOUBLE THEN 1 ELSE 0 END AS prediction_label FROM scored)
"""


def _class(name: str, tp: str, fp: str, fn: str, support: str) -> str:
    return (
        f"SELECT '{name}' AS class, {_ratio(tp, f'{tp} + {fp}')} AS precision, "
        f"{_ratio(tp, f'{tp} + {fn}')} AS recall, {_ratio(f'2 * {tp}', f'2 * {tp} + {fp} + {fn}')} AS f1, "
        f"CAST({support} AS BIGINT) AS support FROM cnt"
    )


_P1, _R1, _F1 = _ratio("tp", "tp + fp"), _ratio("tp", "tp + fn"), _ratio("2 * tp", "2 * tp + fp + fn")
_P0, _R0, _F0 = _ratio("tn", "tn + fn"), _ratio("tn", "tn + fp"), _ratio("2 * tn", "2 * tn + fn + fp")
_ACC = _ratio("tp + tn", "n")


def _weighted(a0: str, a1: str) -> str:
    return _ratio(f"({a0}) * (tn + fp) + ({a1}) * (tp + fn)", "n")


CLASS_REPORT_SELECT = f"""
{_class("0", "tn", "fn", "fp", "tn + fp")}
UNION ALL {_class("1", "tp", "fp", "fn", "tp + fn")}
UNION ALL SELECT 'accuracy', NULL::DOUBLE, NULL::DOUBLE, {_ACC}, CAST(n AS BIGINT) FROM cnt
UNION ALL SELECT 'macro avg', ({_P0} + {_P1}) / 2.0::DOUBLE, ({_R0} + {_R1}) / 2.0::DOUBLE,
                 ({_F0} + {_F1}) / 2.0::DOUBLE, CAST(n AS BIGINT) FROM cnt
UNION ALL SELECT 'weighted avg', {_weighted(_P0, _P1)}, {_weighted(_R0, _R1)}, {_weighted(_F0, _F1)},
                 CAST(n AS BIGINT) FROM cnt
"""

BINARY_METRICS_SELECT = f"""
SELECT 'accuracy' AS metric, {_ACC} AS value FROM cnt
UNION ALL SELECT 'auc_hard', CASE WHEN tp + fn > 0 AND tn + fp > 0
                  THEN ({_R1} + {_ratio("tn", "tn + fp")}) / 2.0::DOUBLE END FROM cnt
UNION ALL SELECT 'recall', {_R1} FROM cnt
UNION ALL SELECT 'f1', {_F1} FROM cnt
UNION ALL SELECT 'precision', {_P1} FROM cnt
"""

RESULT_OF = "user_name, dep_date_of_search AS dep_date, CAST({s} AS FLOAT) AS q_ratio, dt"

PREFIX_LONG = """
prefix_long AS (
  SELECT 1 AS trees, score1 AS score, label FROM scored
  UNION ALL SELECT 2, score2, label FROM scored
  UNION ALL SELECT 3, score, label FROM scored)
"""

SQL: dict[str, str] = {
    "feature_extract": with_ctes() + f"SELECT {EXTRACT} FROM features WHERE dt = '{DAY}'",
    "fill_missing": with_ctes() + f"SELECT {KEYS}, {FILLED_FEATURES} FROM features",
    "scoring_features": with_ctes() + f"SELECT {KEYS}, {', '.join(FEATURE_NAMES)} FROM features",
    "training_features": with_ctes() + f"SELECT {', '.join(FEATURE_NAMES)}, label FROM features",
    "class_counts": with_ctes() + "SELECT label, count(*) AS rows FROM features GROUP BY label",
    "class_sample": with_ctes(SAMPLE) + "SELECT * FROM sample",
    "holdout": with_ctes(SAMPLE)
    + f"SELECT * FROM keyed f WHERE NOT EXISTS (SELECT 1 FROM sample s WHERE {SAME_KEY})",
    "holdout_anti_join": with_ctes(SAMPLE)
    + f"SELECT f.* FROM keyed f ANTI JOIN sample s ON {SAME_KEY}",
    "training_union": with_ctes(SAMPLE)
    + "SELECT * FROM sample WHERE label = 1 UNION ALL SELECT * FROM sample WHERE label = 0",
    "subset_sizes": with_ctes(SAMPLE)
    + f"""SELECT CASE WHEN s.label = 1 THEN 'positive' WHEN s.label = 0 THEN 'negative' ELSE 'holdout' END AS role,
              count(*) AS rows
       FROM keyed f LEFT JOIN sample s ON {SAME_KEY} GROUP BY 1""",
    "half_split": with_ctes(
        SAMPLE,
        f"""sp AS (SELECT *, row_number() OVER (ORDER BY {_md5_key("'split|43'")}) AS r,
                         count(*) OVER () AS n FROM sample)""",
    )
    + f"SELECT {KEYS}, label, r <= ceil(n * 0.5) AS is_test FROM sp",
    "fold_assign": with_ctes(
        SAMPLE,
        f"""fo AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {_md5_key("'fold|90'")}) AS r
                 FROM sample)""",
    )
    + f"SELECT {KEYS}, label, CAST((r - 1) % 3 AS INTEGER) AS fold FROM fo",
    "score_pairs": with_ctes(FILLED, SCORED) + f"SELECT {RESULT_OF.format(s='score')} FROM scored",
    "stream_scoring": with_ctes(FILLED, SCORED) + f"SELECT {RESULT_OF.format(s='score')} FROM scored",
    "score_prefix": with_ctes(FILLED, SCORED) + f"SELECT {RESULT_OF.format(s='score2')} FROM scored",
    "threshold_strict": with_ctes(FILLED, SCORED)
    + f"""SELECT {KEYS}, CAST(score AS FLOAT) AS q_ratio,
              CASE WHEN score > 0.5::DOUBLE THEN 1 ELSE 0 END AS prediction_label FROM scored""",
    "threshold_inclusive": with_ctes(FILLED, SCORED)
    + f"""SELECT {KEYS}, CAST(score AS FLOAT) AS q_ratio,
              CASE WHEN score >= 0.5::DOUBLE THEN 1 ELSE 0 END AS prediction_label FROM scored""",
    "confusion_matrix": with_ctes(FILLED, SCORED, INCLUSIVE_PAIRS)
    + """SELECT prediction_label,
              CAST(nullif(sum(CASE WHEN true_label = 0 THEN 1 ELSE 0 END), 0) AS BIGINT) AS true_0,
              CAST(nullif(sum(CASE WHEN true_label = 1 THEN 1 ELSE 0 END), 0) AS BIGINT) AS true_1
       FROM pairs GROUP BY prediction_label""",
    "class_report": with_ctes(FILLED, SCORED, STRICT_PAIRS, counts_sql("pairs")) + CLASS_REPORT_SELECT,
    "binary_metrics": with_ctes(FILLED, SCORED, STRICT_PAIRS, counts_sql("pairs")) + BINARY_METRICS_SELECT,
    "auc_scores": with_ctes(FILLED, SCORED, auc_sql("scored")) + "SELECT auc, positives, negatives FROM auc_out",
    "auc_by_prefix": with_ctes(FILLED, SCORED, PREFIX_LONG, auc_sql("prefix_long", "trees"))
    + "SELECT trees, auc, positives, negatives FROM auc_out",
    "fold_mean_auc": with_ctes(
        SAMPLE,
        f"""fo AS (SELECT *, CAST((row_number() OVER (PARTITION BY label ORDER BY {_md5_key("'fold|90'")}) - 1) % 3
                          AS INTEGER) AS fold FROM sample)""",
        f"filled AS (SELECT user_name, dep_date_of_search, search_date, dt, label, fold, {FILLED_FEATURES} FROM fo)",
        SCORED,
        auc_sql("scored", "fold"),
    )
    + "SELECT fold, auc, positives, negatives, round(avg(auc) OVER (), 12) AS mean_auc FROM auc_out",
    "best_trial": with_ctes(FILLED, SCORED, PREFIX_LONG, auc_sql("prefix_long", "trees"))
    + "SELECT trees AS trial_id, trees, auc AS score FROM auc_out ORDER BY auc DESC, trees ASC LIMIT 1",
    "result_overwrite": with_ctes(FILLED, SCORED)
    + f"""SELECT {RESULT_OF.format(s='score2')} FROM scored WHERE dt = '{DAY}'
       UNION ALL SELECT {RESULT_OF.format(s='score')} FROM scored WHERE dt <> '{DAY}'""",
    "drop_partition": with_ctes(FILLED, SCORED)
    + f"SELECT {RESULT_OF.format(s='score')} FROM scored WHERE dt <> '{DAY}'",
    "partition_audit": with_ctes() + "SELECT dt, count(*) AS count FROM features GROUP BY dt ORDER BY dt DESC LIMIT 5",
    "result_peek": with_ctes(FILLED, SCORED)
    + f"SELECT {RESULT_OF.format(s='score')} FROM scored ORDER BY dt, user_name, dep_date_of_search LIMIT 5",
    "tsv_roundtrip": with_ctes() + f"SELECT {TRAINING} FROM features",
    "extract_job": with_ctes() + f"SELECT {EXTRACT} FROM features WHERE dt = '{DAY}'",
    # One day comes from a file (another score), with dates as the reference writes them; the others stay.
    "result_csv_load": with_ctes(FILLED, SCORED)
    + f"""SELECT {RESULT_OF.format(s='score2')} FROM scored WHERE dt = '{DAY}'
       UNION ALL SELECT {RESULT_OF.format(s='score')} FROM scored WHERE dt <> '{DAY}'""",
    "train_evaluate": with_ctes(SAMPLE)
    + f"""SELECT 'positive' AS metric, CAST({N_SAMPLE} AS BIGINT) AS value
       UNION ALL SELECT 'negative', {N_SAMPLE}
       UNION ALL SELECT 'holdout', count(*) - 2 * {N_SAMPLE} FROM keyed
       UNION ALL SELECT 'support_0', count(*) - {N_SAMPLE} FROM keyed WHERE label = 0
       UNION ALL SELECT 'support_1', count(*) - {N_SAMPLE} FROM keyed WHERE label = 1
       UNION ALL SELECT 'confusion_cells', count(*) - 2 * {N_SAMPLE} FROM keyed
       UNION ALL SELECT 'trees', {QUERY_TREES}
       UNION ALL SELECT 'history_rows', 2 * {QUERY_TREES // QUERY_MARK}
       UNION ALL SELECT 'best_trees_is_a_mark', 1
       UNION ALL SELECT 'reload_mismatches', 0
       UNION ALL SELECT 'prefix_mismatches', 0
       UNION ALL SELECT 'report_mismatches', 0""",
    "tune": with_ctes(
        SAMPLE,
        f"""fo AS (SELECT *, (row_number() OVER (PARTITION BY label ORDER BY {_md5_key("'fold|90'")}) - 1) % 3 AS fold
                 FROM sample)""",
        "sizes AS (SELECT count(*) FILTER (fold = 0) AS fold_0, count(*) FILTER (fold = 1) AS fold_1, "
        "count(*) FILTER (fold = 2) AS fold_2 FROM fo)",
    )
    + f"""SELECT CAST(t.i AS INTEGER) AS trial_id, CASE WHEN t.i < {INIT_POINTS} THEN 'random' ELSE 'guided' END AS stage,
              true AS in_box, true AS truncated, true AS scored, true AS best_is_first_max, sizes.*
       FROM range({INIT_POINTS + N_ITER}) t(i), sizes""",
    "daily_scoring": with_ctes()
    + f"""SELECT user_name, dep_date_of_search AS dep_date, dt, true AS in_range, true AS others_unchanged,
              (SELECT CAST(sum(n) AS BIGINT) FROM (SELECT count(*) AS n FROM features GROUP BY dt ORDER BY dt DESC LIMIT 5)) AS audit_rows
       FROM features WHERE dt = '{DAY}'""",
    "index_scores": with_ctes(FILLED, SCORED) + f"SELECT {RESULT_OF.format(s='score')} FROM scored",
    "boost_histogram": with_ctes(_root_cells()) + "SELECT feature, bin, rows, g, h FROM cells",
    "boost_root_split": with_ctes(_root_cells(), *_root_split_sql()[1:]) + _root_split_sql()[0],
    "quantile_summary": with_ctes()
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, count({c}) AS rows, true AS bounded, true AS ranks_hold FROM features" for c in FEATURE_NAMES),
    "boost_train_evaluate": with_ctes(SAMPLE)
    + f"""SELECT 'positive' AS metric, CAST({N_SAMPLE} AS BIGINT) AS value
       UNION ALL SELECT 'negative', {N_SAMPLE}
       UNION ALL SELECT 'holdout', count(*) - 2 * {N_SAMPLE} FROM keyed
       UNION ALL SELECT 'support_0', count(*) - {N_SAMPLE} FROM keyed WHERE label = 0
       UNION ALL SELECT 'support_1', count(*) - {N_SAMPLE} FROM keyed WHERE label = 1
       UNION ALL SELECT 'confusion_cells', count(*) - 2 * {N_SAMPLE} FROM keyed
       UNION ALL SELECT 'stopped_before_the_last_round', 1
       UNION ALL SELECT 'trees_after_the_best', 8
       UNION ALL SELECT 'marks_missing', 0
       UNION ALL SELECT 'best_is_the_first_maximum', 1
       UNION ALL SELECT 'best_trees_differ_from_the_stored', 0
       UNION ALL SELECT 'reload_mismatches', 0
       UNION ALL SELECT 'history_mismatches', 0""",
    "result_csv_roundtrip": with_ctes(FILLED, SCORED)
    + "SELECT user_name, dep_date_of_search AS dep_date, CAST(score AS FLOAT) AS q_ratio FROM scored",
}
# The same job with another kind of model: the same rows.
SQL["daily_boosted"] = SQL["daily_scoring"]
