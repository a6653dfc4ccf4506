"""Query bodies for the catalog (see ``catalog.py``)."""
from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from churnspark.operators.series import series_features
from churnspark.plans.catalog import query, round_doubles, table

# ---------------------------------------------------------------- series

SERIES_SQL = """
WITH o AS (
  SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS pos
  FROM orders WHERE o_custkey IS NOT NULL),
g AS (
  SELECT o_custkey, count(*) AS n, avg(o_totalprice) AS m, stddev_samp(o_totalprice) AS s,
         first(o_totalprice ORDER BY o_orderdate DESC, o_orderkey ASC) AS lst,
         first(o_totalprice ORDER BY o_orderdate ASC, o_orderkey ASC) AS fst,
         regr_slope(o_totalprice, pos) AS slope
  FROM o GROUP BY o_custkey)
SELECT c.c_custkey, c.c_mktsegment,
       round(g.m, 4) AS mean_o_totalprice,
       round(g.lst, 4) AS last_o_totalprice,
       round(g.lst - g.fst, 4) AS difference_o_totalprice,
       round(CASE WHEN g.n >= 2 THEN g.slope END, 4) AS o_totalprice_slope,
       round(g.s, 4) AS std_o_totalprice
FROM customer c JOIN g ON c.c_custkey = g.o_custkey
"""


def customer_series(spark, sf_dir, skew_safe=True):
    orders = table(spark, sf_dir, "orders")
    feats = series_features(orders, ["o_totalprice"], id_column="o_custkey", date_column="o_orderdate",
                            tiebreak=["o_orderkey"], skew_safe=skew_safe)
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return cust.join(feats.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", "inner")


@query("series_features", SERIES_SQL)
def q_series_features(spark, sf_dir):
    return round_doubles(customer_series(spark, sf_dir), 4)


@query("series_features_window", SERIES_SQL)
def q_series_features_window(spark, sf_dir):
    """Same features through the one-shuffle per-id window path (bounded entities)."""
    return round_doubles(customer_series(spark, sf_dir, skew_safe=False), 4)


LINE_VALUES = ["l_extendedprice", "l_discount", "l_tax", "l_quantity"]

SERIES_MULTI_SQL = """
WITH l AS (
  SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey) - 1 AS pos
  FROM lineitem WHERE l_suppkey IS NOT NULL),
g AS (
  SELECT l_suppkey, count(*) AS n,
    avg(l_extendedprice) AS m0, avg(l_discount) AS m1, avg(l_tax) AS m2, avg(l_quantity) AS m3,
    first(l_extendedprice ORDER BY l_shipdate DESC, l_orderkey ASC, l_linenumber ASC, l_partkey ASC) AS l0,
    first(l_discount ORDER BY l_shipdate DESC, l_orderkey ASC, l_linenumber ASC, l_partkey ASC) AS l1,
    first(l_tax ORDER BY l_shipdate DESC, l_orderkey ASC, l_linenumber ASC, l_partkey ASC) AS l2,
    first(l_quantity ORDER BY l_shipdate DESC, l_orderkey ASC, l_linenumber ASC, l_partkey ASC) AS l3,
    first(l_extendedprice ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey) AS f0,
    first(l_discount ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey) AS f1,
    first(l_tax ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey) AS f2,
    first(l_quantity ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey) AS f3,
    regr_slope(l_extendedprice, pos) AS s0, regr_slope(l_discount, pos) AS s1,
    regr_slope(l_tax, pos) AS s2, regr_slope(l_quantity, pos) AS s3,
    stddev_samp(l_extendedprice) AS d0, stddev_samp(l_discount) AS d1,
    stddev_samp(l_tax) AS d2, stddev_samp(l_quantity) AS d3
  FROM l GROUP BY l_suppkey)
SELECT l_suppkey,
  round(m0, 4) AS mean_l_extendedprice, round(m1, 6) AS mean_l_discount, round(m2, 6) AS mean_l_tax, round(m3, 4) AS mean_l_quantity,
  round((m1 + m2) / 2, 6) AS mean_rate, round(m1 - m2, 6) AS discount_minus_tax,
  round(l0, 4) AS last_l_extendedprice, round(l1, 6) AS last_l_discount, round(l2, 6) AS last_l_tax, round(l3, 4) AS last_l_quantity,
  round(l0 - f0, 4) AS difference_l_extendedprice, round(l1 - f1, 6) AS difference_l_discount,
  round(l2 - f2, 6) AS difference_l_tax, round(l3 - f3, 4) AS difference_l_quantity,
  round(CASE WHEN n >= 2 THEN s0 END, 4) AS l_extendedprice_slope, round(CASE WHEN n >= 2 THEN s1 END, 6) AS l_discount_slope,
  round(CASE WHEN n >= 2 THEN s2 END, 6) AS l_tax_slope, round(CASE WHEN n >= 2 THEN s3 END, 4) AS l_quantity_slope,
  round(d0, 4) AS std_l_extendedprice, round(d1, 6) AS std_l_discount, round(d2, 6) AS std_l_tax, round(d3, 4) AS std_l_quantity
FROM g
"""


@query("series_features_multi", SERIES_MULTI_SQL)
def q_series_features_multi(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    feats = series_features(li, LINE_VALUES, id_column="l_suppkey", date_column="l_shipdate",
                            tiebreak=["l_orderkey", "l_linenumber", "l_partkey"],
                            families={"mean_rate": ["l_discount", "l_tax"]},
                            differences={"discount_minus_tax": ("l_discount", "l_tax")})
    four = [c for c in feats.columns if c.endswith("l_extendedprice") or c.endswith("l_quantity")
            or c.startswith("l_extendedprice") or c.startswith("l_quantity")]
    return round_doubles(feats, 6, {c: 4 for c in four})


# ---------------------------------------------------------------- profiling
from churnspark.operators import profile as P  # noqa: E402

CUST_NULLS_CTE = """cn AS (
  SELECT c_custkey, c_name, c_nationkey,
         CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS c_acctbal,
         CASE WHEN c_custkey % 11 <> 0 THEN c_mktsegment END AS c_mktsegment
  FROM customer)"""


def customer_with_nulls(spark, sf_dir):
    """customer with missing values injected by key modulus (same rule as the SQL twin)."""
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", "c_name", "c_nationkey",
                    F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal")).alias("c_acctbal"),
                    F.when(F.col("c_custkey") % 11 != 0, F.col("c_mktsegment")).alias("c_mktsegment"))


CUST_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@query("null_counts", f"WITH {CUST_NULLS_CTE} " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST(count(*) - count({c}) AS BIGINT) AS missing FROM cn" for c in CUST_COLS))
def q_null_counts(spark, sf_dir):
    return P.null_counts(customer_with_nulls(spark, sf_dir))


@query("distinct_counts", f"WITH {CUST_NULLS_CTE} " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST(count(DISTINCT {c}) AS BIGINT) AS unique FROM cn" for c in CUST_COLS))
def q_distinct_counts(spark, sf_dir):
    return P.distinct_counts(customer_with_nulls(spark, sf_dir))


def _profile_sql(col, typ, numeric, integral=False, tbl="events"):
    mode_val = f"CAST({col} AS VARCHAR)"
    mode = f"(SELECT {mode_val} FROM {tbl} WHERE {col} IS NOT NULL GROUP BY {col} ORDER BY count(*) DESC, {col} ASC LIMIT 1)"
    head = (f"SELECT '{col}' AS feature, '{typ}' AS type, count({col}) AS count, count(*) - count({col}) AS missing, "
            f"count(DISTINCT {col}) AS unique, {mode} AS mode")
    if not numeric:
        nulls = ", ".join(f"CAST(NULL AS DOUBLE) AS {n}" for n in
                          ["min_value", "q_1", "median", "q_3", "max_value", "mean", "std", "skew", "kurtosis"])
        return f"{head}, {nulls} FROM {tbl}"
    x = f"CAST({col} AS DOUBLE)"
    return (f"{head}, round(round(min({x}), 3), 6) AS min_value, round(quantile_cont({x}, 0.25), 6) AS q_1, "
            f"round(quantile_cont({x}, 0.5), 6) AS median, round(quantile_cont({x}, 0.75), 6) AS q_3, "
            f"round(max({x}), 6) AS max_value, round(round(avg({x}), 3), 6) AS mean, "
            f"round(round(stddev_samp({x}), 3), 6) AS std, "
            f"round(round(CASE WHEN var_pop({x}) = 0 THEN 0 ELSE skewness({x}) END, 3), 6) AS skew, "
            f"round(round(CASE WHEN var_pop({x}) = 0 THEN 0 ELSE kurtosis({x}) END, 3), 6) AS kurtosis FROM {tbl}")


PROFILE_SQL = " UNION ALL ".join([
    _profile_sql("event_id", "int64", True, True), _profile_sql("user_id", "int64", True, True),
    _profile_sql("event_type", "object", False), _profile_sql("value", "float64", True)])


@query("univariate_profile", PROFILE_SQL)
def q_univariate_profile(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return round_doubles(P.univariate_profile(ev, 3, columns=["event_id", "user_id", "event_type", "value"]), 6)


HIST_SQL = """
WITH r AS (SELECT min(value) AS lo, max(value) AS hi, count(value) AS n FROM events),
b AS (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((value - lo) / ((hi - lo) / 10)), 9) END AS INTEGER) AS bin,
             lo, hi, n FROM events, r WHERE value IS NOT NULL)
SELECT 'value' AS feature, bin, round(lo + bin * ((hi - lo) / 10), 6) AS bin_start,
       round(lo + (bin + 1) * ((hi - lo) / 10), 6) AS bin_end, count(*) AS count,
       round(count(*) / (n * ((hi - lo) / 10)), 6) AS density
FROM b GROUP BY bin, lo, hi, n
"""


@query("histogram", HIST_SQL)
def q_histogram(spark, sf_dir):
    return round_doubles(P.histogram(table(spark, sf_dir, "events"), "value", bins=10), 6)


@query("category_counts", "SELECT 'event_type' AS feature, event_type AS category, count(*) AS count "
                          "FROM events WHERE event_type IS NOT NULL GROUP BY event_type")
def q_category_counts(spark, sf_dir):
    return P.category_counts(table(spark, sf_dir, "events"), "event_type")


GROUP_SUMMARY_SQL = """
SELECT c_mktsegment AS category, round(avg(c_acctbal), 6) AS mean, round(stddev_samp(c_acctbal), 6) AS std,
       count(*) AS count, round(quantile_cont(c_acctbal, 0.25), 6) AS q_1,
       round(quantile_cont(c_acctbal, 0.5), 6) AS median, round(quantile_cont(c_acctbal, 0.75), 6) AS q_3
FROM customer WHERE c_mktsegment IS NOT NULL AND c_acctbal IS NOT NULL GROUP BY c_mktsegment
"""


@query("group_summary", GROUP_SUMMARY_SQL)
def q_group_summary(spark, sf_dir):
    return round_doubles(P.group_summary(table(spark, sf_dir, "customer"), "c_acctbal", "c_mktsegment"), 6)


CONT_SQL = ("SELECT o_orderstatus, o_orderpriority, count(*) AS count FROM orders "
            "WHERE o_orderstatus IS NOT NULL AND o_orderpriority IS NOT NULL GROUP BY 1, 2")


@query("contingency", CONT_SQL)
def q_contingency(spark, sf_dir):
    return P.contingency(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority")


def _shares_sql(over):
    return (f"SELECT o_orderstatus, o_orderpriority, count, round(count / sum(count) OVER ({over}) * 100, 6) AS percent "
            f"FROM ({CONT_SQL}) t")


for _key, _axis, _over in (("contingency_shares_total", None, ""),
                           ("contingency_shares_col", 0, "PARTITION BY o_orderpriority"),
                           ("contingency_shares_row", 1, "PARTITION BY o_orderstatus")):
    def _mk(axis):
        def fn(spark, sf_dir):
            return round_doubles(P.contingency_shares(table(spark, sf_dir, "orders"),
                                                      "o_orderstatus", "o_orderpriority", axis), 6)
        return fn
    query(_key, _shares_sql(_over))(_mk(_axis))


# ---------------------------------------------------------------- dates
from churnspark.functions import dates as D  # noqa: E402

DATE_RENDER_SQL = """
SELECT o_orderkey,
  CASE WHEN o_orderkey % 50 = 7 THEN 'not a date'
       WHEN o_orderkey % 50 = 11 THEN '2016-02-30'
       WHEN o_orderkey % 50 = 13 THEN NULL
       WHEN o_orderkey % 5 = 0 THEN strftime(o_orderdate, '%Y-%m-%d')
       WHEN o_orderkey % 5 = 1 THEN strftime(o_orderdate, '%d-%m-%Y')
       WHEN o_orderkey % 5 = 2 THEN strftime(o_orderdate, '%m/%d/%Y')
       WHEN o_orderkey % 5 = 3 THEN strftime(o_orderdate, '%-d %b %Y')
       ELSE strftime(o_orderdate, '%B %-d, %Y') END AS raw
FROM orders"""


def rendered_dates(spark, sf_dir):
    """o_orderdate written in the five accepted layouts (chosen by key) plus invalid strings."""
    o = table(spark, sf_dir, "orders")
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    raw = (F.when(k % 50 == 7, F.lit("not a date")).when(k % 50 == 11, F.lit("2016-02-30"))
            .when(k % 50 == 13, F.lit(None).cast("string"))
            .when(k % 5 == 0, F.date_format(d, "yyyy-MM-dd")).when(k % 5 == 1, F.date_format(d, "dd-MM-yyyy"))
            .when(k % 5 == 2, F.date_format(d, "MM/dd/yyyy")).when(k % 5 == 3, F.date_format(d, "d MMM yyyy"))
            .otherwise(F.date_format(d, "MMMM d, yyyy")))
    return o.select("o_orderkey", raw.alias("raw"))


@query("parse_dates", f"""
SELECT o_orderkey, raw,
  strftime(try_strptime(raw, ['%Y-%m-%d', '%d-%m-%Y', '%m/%d/%Y', '%d %b %Y', '%B %d, %Y']), '%Y-%m-%d') AS parsed
FROM ({DATE_RENDER_SQL}) r""")
def q_parse_dates(spark, sf_dir):
    r = rendered_dates(spark, sf_dir)
    return r.withColumn("parsed", D.parse_and_format(F.col("raw"), "%Y-%m-%d"))


@query("date_features", """
WITH d AS (SELECT o_custkey, min(o_orderdate) AS a, max(o_orderdate) + INTERVAL 365 DAY AS e,
                  max(o_orderdate) AS r, min(o_orderdate) + INTERVAL 30 DAY AS m
           FROM orders GROUP BY o_custkey)
SELECT o_custkey AS c_custkey, date_diff('day', a, e) AS contract_length,
       date_diff('day', e, TIMESTAMP '2002-01-01') AS days_until_end,
       date_diff('day', r, TIMESTAMP '2002-01-01') AS days_until_renewal,
       date_diff('day', m, TIMESTAMP '2002-01-01') AS days_since_modification
FROM d""")
def q_date_features(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    d = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.date_format(F.min("o_orderdate"), "dd-MM-yyyy").alias("date_activ"),
        F.date_format(F.date_add(F.max("o_orderdate"), 365), "MM/dd/yyyy").alias("date_end"),
        F.date_format(F.max("o_orderdate"), "d MMM yyyy").alias("date_renewal"),
        F.date_format(F.date_add(F.min("o_orderdate"), 30), "yyyy-MM-dd").alias("date_modif_prod"))
    cols = ["date_activ", "date_end", "date_modif_prod", "date_renewal"]
    parsed = D.DateParser(dateColumns=cols).transform(d)
    return D.ContractDateFeatures(dateColumns=cols, referenceDate="2002-01-01").transform(parsed)


@query("date_parts", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS o_orderdate_year,
       CAST(month(o_orderdate) AS INTEGER) AS o_orderdate_month, CAST(day(o_orderdate) AS INTEGER) AS o_orderdate_day,
       dayname(o_orderdate) AS o_orderdate_weekday,
       date_diff('day', o_orderdate, TIMESTAMP '2002-01-01') AS "actual_date - o_orderdate in days"
FROM orders""")
def q_date_parts(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    out = D.date_columns(o, ["o_orderdate", "not_a_column"], calculate_difference=True, reference_date="2002-01-01")
    return out.select("o_orderkey", "o_orderdate_year", "o_orderdate_month", "o_orderdate_day",
                      "o_orderdate_weekday", "`actual_date - o_orderdate in days`")


@query("date_interval", """SELECT o_orderkey, date_diff('day', o_orderdate, TIMESTAMP '2002-01-01') AS days FROM orders""")
def q_date_interval(spark, sf_dir):
    """The difference to the reference date as an interval, read back in days."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    out = D.date_columns(o, ["o_orderdate"], calculate_difference=True, reference_date="2002-01-01")
    return out.select("o_orderkey", F.expr("extract(day from `actual_date - o_orderdate`)").cast("bigint").alias("days"))


# ---------------------------------------------------------------- pruning
from churnspark.operators import prune as PR  # noqa: E402

EV_NULLS_CTE = """en AS (
  SELECT event_id, user_id,
         CASE WHEN event_id % 17 <> 0 THEN event_type END AS event_type,
         CASE WHEN event_id % 13 <> 0 THEN value END AS value
  FROM events)"""


def events_with_nulls(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_id", "user_id",
                    F.when(F.col("event_id") % 17 != 0, F.col("event_type")).alias("event_type"),
                    F.when(F.col("event_id") % 13 != 0, F.col("value")).alias("value"))


@query("drop_missing_rows", f"WITH {EV_NULLS_CTE} SELECT * FROM en WHERE event_type IS NOT NULL AND value IS NOT NULL")
def q_drop_missing_rows(spark, sf_dir):
    return PR.DropMissing(axis=0).transform(events_with_nulls(spark, sf_dir))


@query("missing_rows", f"""WITH {EV_NULLS_CTE} SELECT count(*) AS rows, count_if(event_type IS NULL OR value IS NULL) AS dropped,
count_if(event_type IS NOT NULL AND value IS NOT NULL) AS kept FROM en""")
def q_missing_rows(spark, sf_dir):
    """P5: how many rows ``drop_missing`` drops."""
    return PR.missing_rows(events_with_nulls(spark, sf_dir))


@query("drop_missing_cols", f"WITH {EV_NULLS_CTE} SELECT event_id, user_id FROM en")
def q_drop_missing_cols(spark, sf_dir):
    return PR.drop_missing(events_with_nulls(spark, sf_dir), axis=1)


@query("drop_empty_then_rows", f"WITH {EV_NULLS_CTE} SELECT event_id, user_id, event_type, value FROM en "
                               "WHERE event_type IS NOT NULL AND value IS NOT NULL")
def q_drop_empty_then_rows(spark, sf_dir):
    e = events_with_nulls(spark, sf_dir).withColumn("empty", F.lit(None).cast("double"))
    return PR.drop_empty_columns_then_rows(e)


DOC_PRUNE_COLS = ["doc_id", "text", "lang", "source", "n_chars", "constant", "sparse"]


def documents_for_pruning(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", "text", "lang", "source", "n_chars", F.lit(1).alias("constant"),
                    F.when(F.col("doc_id") % 50 == 0, F.col("lang")).alias("sparse"))


def _prune_sql():
    parts = []
    numeric = {"doc_id", "n_chars", "constant"}
    for c in DOC_PRUNE_COLS:
        num = "TRUE" if c in numeric else "FALSE"
        parts.append(f"SELECT '{c}' AS feature, count(*) - count({c}) AS missing, count(DISTINCT {c}) AS uq, "
                     f"count(*) AS n, {num} AS numeric FROM dp")
    return f"""
WITH dp AS (SELECT doc_id, text, lang, source, n_chars, 1 AS constant,
                   CASE WHEN doc_id % 50 = 0 THEN lang END AS sparse FROM documents),
s AS ({' UNION ALL '.join(parts)})
SELECT feature, CASE WHEN missing / n > 0.95 THEN 'drop' WHEN uq = 1 THEN 'drop'
                     WHEN uq / n > 0.95 AND NOT numeric THEN 'drop' ELSE 'keep' END AS decision
FROM s"""


@query("prune_columns", _prune_sql())
def q_prune_columns(spark, sf_dir):
    d = documents_for_pruning(spark, sf_dir)
    model = PR.LowInformationPruner().fit(d)
    dropped = set(model.getOrDefault(model.columns))
    kept = set(model.transform(d).columns)
    rows = [(c, "drop" if c in dropped else "keep") for c in DOC_PRUNE_COLS if c in dropped or c in kept]
    return spark.createDataFrame(rows, "feature string, decision string")


# ---------------------------------------------------------------- outliers
from churnspark.operators import outliers as O  # noqa: E402

LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _threshold_sql(src: str, col: str) -> str:
    return f"""SELECT '{col}' AS feature,
  CASE WHEN var_pop({col}) = 0 THEN 0 ELSE skewness({col}) END AS skew, avg({col}) AS mean, stddev_samp({col}) AS std,
  quantile_cont({col}, 0.25) AS q_1, quantile_cont({col}, 0.75) AS q_3 FROM {src} WHERE {col} IS NOT NULL"""


def _threshold_cols(t: str = "t") -> str:
    normal = f"({t}.skew > -1 AND {t}.skew < 1)"
    return (f"CASE WHEN {normal} THEN 'empirical' ELSE 'tukey' END AS rule, "
            f"CASE WHEN {normal} THEN {t}.mean - 3 * {t}.std ELSE {t}.q_1 - 1.5 * ({t}.q_3 - {t}.q_1) END AS min_thresh, "
            f"CASE WHEN {normal} THEN {t}.mean + 3 * {t}.std ELSE {t}.q_3 + 1.5 * ({t}.q_3 - {t}.q_1) END AS max_thresh")


@query("outlier_thresholds", f"""
WITH t AS ({' UNION ALL '.join(_threshold_sql('lineitem', c) for c in LI_NUM)})
SELECT feature, round(skew, 6) AS skew, round(mean, 6) AS mean, round(std, 6) AS std, round(q_1, 6) AS q_1,
       round(q_3, 6) AS q_3, rule, round(min_thresh, 6) AS min_thresh, round(max_thresh, 6) AS max_thresh
FROM (SELECT t.*, {_threshold_cols()} FROM t) x""")
def q_outlier_thresholds(spark, sf_dir):
    return round_doubles(O.outlier_thresholds(table(spark, sf_dir, "lineitem"), LI_NUM), 6)


@query("cap_outliers", f"""
WITH t AS ({_threshold_sql('events', 'value')}), th AS (SELECT {_threshold_cols()} FROM t)
SELECT event_id, round(CASE WHEN value > max_thresh THEN max_thresh WHEN value < min_thresh THEN min_thresh
                            ELSE value END, 6) AS value
FROM events, th""")
def q_cap_outliers(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "value")
    model = O.ReplaceOutliers(exclude=["event_id"]).fit(ev)
    return round_doubles(model.transform(ev), 6)


@query("outlier_counts", f"""
WITH t AS ({' UNION ALL '.join(_threshold_sql('lineitem', c) for c in LI_NUM)}),
th AS (SELECT t.feature, {_threshold_cols()} FROM t)
""" + " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, count_if({c} > max_thresh) AS above, count_if({c} < min_thresh) AS below,
        count_if({c} > max_thresh) + count_if({c} < min_thresh) AS outliers
        FROM lineitem, (SELECT * FROM th WHERE feature = '{c}') q""" for c in LI_NUM))
def q_outlier_counts(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return O.outlier_counts(li, O.thresholds_dict(li, LI_NUM))


def _remove_sql() -> str:
    ctes, src = [], "lineitem"
    for i, c in enumerate(LI_NUM):
        ctes.append(f"th{i} AS (SELECT {_threshold_cols()} FROM ({_threshold_sql(src, c)}) t)")
        ctes.append(f"f{i} AS (SELECT {src}.* FROM {src}, th{i} WHERE {c} >= min_thresh AND {c} <= max_thresh)")
        src = f"f{i}"
    return "WITH " + ",\n".join(ctes) + f"\nSELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {', '.join(LI_NUM)} FROM {src}"


@query("remove_outliers", _remove_sql())
def q_remove_outliers(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *LI_NUM)
    return O.clean_outliers(li, LI_NUM, "remove", sequential=True)


@query("replace_outliers", f"""
WITH t AS ({' UNION ALL '.join(_threshold_sql('lineitem', c) for c in LI_NUM)}),
th AS (SELECT t.feature, {_threshold_cols()} FROM t)
SELECT l_orderkey, l_linenumber, l_partkey, """ + ", ".join(
    f"""round(CASE WHEN {c} > (SELECT max_thresh FROM th WHERE feature = '{c}') THEN (SELECT max_thresh FROM th WHERE feature = '{c}')
              WHEN {c} < (SELECT min_thresh FROM th WHERE feature = '{c}') THEN (SELECT min_thresh FROM th WHERE feature = '{c}')
              ELSE {c} END, 6) AS {c}""" for c in LI_NUM) + " FROM lineitem")
def q_replace_outliers(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", *LI_NUM)
    return round_doubles(O.clean_outliers(li, LI_NUM, "replace"), 6)


# ---------------------------------------------------------------- encoding
from churnspark.operators import encode as G  # noqa: E402

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("dummies", "SELECT c_custkey, " + ", ".join(
    f"CAST(c_mktsegment = '{s}' AS INTEGER) AS c_mktsegment_{s}" for s in SEGMENTS[1:]) + " FROM customer")
def q_dummies(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return G.dummies(c, ["c_mktsegment"], drop_first=True)


@query("minmax", """
SELECT s_suppkey,
  round((s_acctbal - (SELECT min(s_acctbal) FROM supplier)) / ((SELECT max(s_acctbal) FROM supplier) - (SELECT min(s_acctbal) FROM supplier)), 6) AS s_acctbal,
  round((s_nationkey - (SELECT min(s_nationkey) FROM supplier)) / CAST((SELECT max(s_nationkey) FROM supplier) - (SELECT min(s_nationkey) FROM supplier) AS DOUBLE), 6) AS s_nationkey
FROM supplier""")
def q_minmax(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal", "s_nationkey")
    return round_doubles(G.minmax_scale(s, ["s_acctbal", "s_nationkey"]), 6)


@query("standard_scale", """
SELECT c_custkey,
  round((c_acctbal - (SELECT avg(c_acctbal) FROM customer)) / (SELECT stddev_pop(c_acctbal) FROM customer), 6) AS c_acctbal,
  round((c_nationkey - (SELECT avg(c_nationkey) FROM customer)) / (SELECT stddev_pop(c_nationkey) FROM customer), 6) AS c_nationkey
FROM customer""")
def q_standard_scale(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    return round_doubles(G.standard_scale(c, ["c_acctbal", "c_nationkey"]), 6)


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
STATUSES = ["F", "O", "P"]


@query("one_hot", "SELECT o_orderkey, " + ", ".join(
    [f"CAST(o_orderstatus = '{s}' AS DOUBLE) AS \"o_orderstatus_{s}\"" for s in STATUSES]
    + [f"CAST(o_orderpriority = '{p}' AS DOUBLE) AS \"o_orderpriority_{p}\"" for p in PRIORITIES]) + " FROM orders")
def q_one_hot(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return G.one_hot(o, ["o_orderstatus", "o_orderpriority"])


@query("scale_encode", "SELECT " + ", ".join(
    [f"round((CAST({c} AS DOUBLE) - (SELECT avg({c}) FROM customer)) / (SELECT stddev_pop({c}) FROM customer), 6) AS {c}"
     for c in ["c_custkey", "c_nationkey", "c_acctbal"]]
    + [f"CAST(c_mktsegment = '{s}' AS DOUBLE) AS c_mktsegment_{s}" for s in SEGMENTS]) + " FROM customer")
def q_scale_encode(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    return round_doubles(G.ScaleEncode().fit(c).transform(c), 6)


# ---------------------------------------------------------------- association
from churnspark.operators import assoc as V  # noqa: E402
from churnspark.operators.kendall import kendall_tau  # noqa: E402


@query("pearson_regression", """
SELECT 'o_custkey' AS feature, regr_count(o_totalprice, o_custkey) AS n,
       round(regr_slope(o_totalprice, o_custkey), 6) AS slope, round(regr_intercept(o_totalprice, o_custkey), 4) AS intercept,
       round(corr(o_custkey, o_totalprice), 9) AS r FROM orders
UNION ALL
SELECT 'o_orderkey', regr_count(o_totalprice, o_orderkey), round(regr_slope(o_totalprice, o_orderkey), 6),
       round(regr_intercept(o_totalprice, o_orderkey), 4), round(corr(o_orderkey, o_totalprice), 9) FROM orders""")
def q_pearson_regression(spark, sf_dir):
    t = V.pearson_table(table(spark, sf_dir, "orders"), "o_totalprice", ["o_custkey", "o_orderkey"])
    return round_doubles(t.select("feature", "n", "slope", "intercept", "r"), 6, {"intercept": 4, "r": 9})


@query("spearman", """
WITH p AS (SELECT l_quantity AS x, l_extendedprice AS y FROM lineitem WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL),
r AS (SELECT (2 * rank() OVER (ORDER BY x) + count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx,
             (2 * rank() OVER (ORDER BY y) + count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry FROM p)
SELECT count(*) AS n, round(corr(rx, ry), 9) AS spearman FROM r""")
def q_spearman(spark, sf_dir):
    s = V.spearman(table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice")
    return round_doubles(s.select("n", "spearman"), 9)


def _kendall_sql(tbl, x, y):
    return f"""
WITH p AS (SELECT row_number() OVER () AS i, CAST({x} AS DOUBLE) AS x, CAST({y} AS DOUBLE) AS y FROM {tbl}
           WHERE {x} IS NOT NULL AND {y} IS NOT NULL),
s AS (SELECT sum(sign(b.x - a.x) * sign(b.y - a.y)) AS s FROM p a JOIN p b ON a.i < b.i),
n AS (SELECT count(*) AS n FROM p),
tx AS (SELECT sum(c * (c - 1) / 2) AS t FROM (SELECT count(*) AS c FROM p GROUP BY x)),
ty AS (SELECT sum(c * (c - 1) / 2) AS t FROM (SELECT count(*) AS c FROM p GROUP BY y))
SELECT n.n AS n, round(s.s / sqrt((n.n * (n.n - 1) / 2 - tx.t) * (n.n * (n.n - 1) / 2 - ty.t)), 9) AS kendalltau
FROM s, n, tx, ty"""


@query("kendall", _kendall_sql("supplier", "s_acctbal", "s_nationkey"))
def q_kendall(spark, sf_dir):
    k = kendall_tau(table(spark, sf_dir, "supplier"), "s_acctbal", "s_nationkey")
    return round_doubles(k.select("n", "kendalltau"), 9)


@query("kendall_orders", _kendall_sql("orders", "o_custkey", "o_totalprice"))
def q_kendall_orders(spark, sf_dir):
    k = kendall_tau(table(spark, sf_dir, "orders"), "o_custkey", "o_totalprice")
    return round_doubles(k.select("n", "kendalltau"), 9)


@query("kendall_lineitem", """
WITH p AS (SELECT l_quantity AS x, l_discount AS y, CAST(count(*) AS DOUBLE) AS w FROM lineitem
           WHERE l_quantity IS NOT NULL AND l_discount IS NOT NULL GROUP BY 1, 2),
s AS (SELECT sum(sign(b.x - a.x) * sign(b.y - a.y) * a.w * b.w) AS s FROM p a JOIN p b ON a.x < b.x),
n AS (SELECT CAST(sum(w) AS BIGINT) AS n FROM p),
tx AS (SELECT sum(c * (c - 1) / 2) AS t FROM (SELECT sum(w) AS c FROM p GROUP BY x)),
ty AS (SELECT sum(c * (c - 1) / 2) AS t FROM (SELECT sum(w) AS c FROM p GROUP BY y))
SELECT n.n AS n, round(s.s / sqrt((n.n * (n.n - 1) / 2 - tx.t) * (n.n * (n.n - 1) / 2 - ty.t)), 9) AS kendalltau
FROM s, n, tx, ty""")
def q_kendall_lineitem(spark, sf_dir):
    """V3 on a table of many rows and heavy ties."""
    k = kendall_tau(table(spark, sf_dir, "lineitem"), "l_quantity", "l_discount")
    return round_doubles(k.select("n", "kendalltau"), 9)


CHI2_SQL = """
WITH t AS (SELECT o_orderstatus AS a, o_orderpriority AS b, CAST(count(*) AS DOUBLE) AS o FROM orders
           WHERE o_orderstatus IS NOT NULL AND o_orderpriority IS NOT NULL GROUP BY 1, 2),
m AS (SELECT o, sum(o) OVER (PARTITION BY a) AS ra, sum(o) OVER (PARTITION BY b) AS cb, a, b FROM t)
SELECT round(sum(o) * sum(o * o / (ra * cb)) - sum(o), 6) AS chi2,
       CAST((count(DISTINCT a) - 1) * (count(DISTINCT b) - 1) AS DOUBLE) AS dof FROM m"""


@query("chi2", CHI2_SQL)
def q_chi2(spark, sf_dir):
    c = V.chi2_test(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority")
    return round_doubles(c.select("chi2", "dof"), 6)


CHI2_YATES_SQL = """
WITH d AS (SELECT CASE WHEN l_returnflag = 'R' THEN 'returned' ELSE 'kept' END AS a, l_linestatus AS b FROM lineitem
           WHERE l_returnflag IS NOT NULL AND l_linestatus IS NOT NULL),
t AS (SELECT a, b, CAST(count(*) AS DOUBLE) AS o FROM d GROUP BY 1, 2),
ra AS (SELECT a, sum(o) AS r FROM t GROUP BY a), cb AS (SELECT b, sum(o) AS c FROM t GROUP BY b),
n AS (SELECT sum(o) AS n FROM t),
cells AS (SELECT ra.a, cb.b, ra.r * cb.c / n.n AS e, coalesce(t.o, 0) AS o
          FROM ra CROSS JOIN cb CROSS JOIN n LEFT JOIN t ON t.a = ra.a AND t.b = cb.b)
SELECT round(sum(power(abs(o - e) - least(0.5, abs(o - e)), 2) / e), 6) AS chi2, 1.0 AS dof FROM cells"""


@query("chi2_yates", CHI2_YATES_SQL)
def q_chi2_yates(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") == "R", "returned").when(F.col("l_returnflag").isNotNull(), "kept").alias("a"),
        "l_linestatus")
    c = V.chi2_test(li, "a", "l_linestatus")
    return round_doubles(c.select("chi2", "dof"), 6)


def _tt_sql(welch: bool):
    if welch:
        t = "(m1 - m2) / sqrt(v1 / n1 + v2 / n2)"
        dof = "power(v1 / n1 + v2 / n2, 2) / (power(v1 / n1, 2) / (n1 - 1) + power(v2 / n2, 2) / (n2 - 1))"
    else:
        t = "(m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1.0 / n1 + 1.0 / n2))"
        dof = "CAST(n1 + n2 - 2 AS DOUBLE)"
    return f"""
WITH g AS (SELECT l_linestatus AS c, count(*) AS n, avg(l_extendedprice) AS m, var_samp(l_extendedprice) AS v
           FROM lineitem WHERE l_linestatus IS NOT NULL AND l_extendedprice IS NOT NULL GROUP BY 1),
a AS (SELECT c AS g1, n AS n1, m AS m1, v AS v1 FROM g ORDER BY c LIMIT 1),
b AS (SELECT c AS g2, n AS n2, m AS m2, v AS v2 FROM g ORDER BY c DESC LIMIT 1)
SELECT g1 AS group_1, g2 AS group_2, round({t}, 6) AS ttest, round({dof}, 4) AS df FROM a, b"""


@query("ttest_pooled", _tt_sql(False))
def q_ttest_pooled(spark, sf_dir):
    t = V.ttest(table(spark, sf_dir, "lineitem"), "l_extendedprice", "l_linestatus", equal_var=True)
    return round_doubles(t.select("group_1", "group_2", "ttest", "df"), 6, {"df": 4})


@query("ttest_welch", _tt_sql(True))
def q_ttest_welch(spark, sf_dir):
    t = V.ttest(table(spark, sf_dir, "lineitem"), "l_extendedprice", "l_linestatus", equal_var=False)
    return round_doubles(t.select("group_1", "group_2", "ttest", "df"), 6, {"df": 4})


ANOVA_SQL = """
WITH g AS (SELECT c_mktsegment AS c, count(*) AS n, avg(c_acctbal) AS m, var_samp(c_acctbal) AS v
           FROM customer WHERE c_mktsegment IS NOT NULL AND c_acctbal IS NOT NULL GROUP BY 1),
t AS (SELECT sum(n) AS nn, count(*) AS k, sum(n * m) / sum(n) AS gm FROM g)
SELECT round((sum(n * power(m - gm, 2)) / (k - 1)) / (sum(coalesce((n - 1) * v, 0)) / (nn - k)), 6) AS F,
       CAST(k - 1 AS DOUBLE) AS df_between, CAST(nn - k AS DOUBLE) AS df_within
FROM g, t GROUP BY k, nn"""


@query("anova", ANOVA_SQL)
def q_anova(spark, sf_dir):
    a = V.anova(table(spark, sf_dir, "customer"), "c_acctbal", "c_mktsegment")
    return round_doubles(a.select("F", "df_between", "df_within"), 6)


@query("anova_valid_groups", ANOVA_SQL.replace("GROUP BY 1),", "GROUP BY 1 HAVING count(*) >= 2),"))
def q_anova_valid(spark, sf_dir):
    a = V.anova(table(spark, sf_dir, "customer"), "c_acctbal", "c_mktsegment", valid_only=True)
    return round_doubles(a.select("F", "df_between", "df_within"), 6)


@query("anova_one_row_group", """
WITH s AS (SELECT CASE WHEN c_custkey = 1 THEN 'ALONE' ELSE c_mktsegment END AS c, c_acctbal AS x FROM customer),
v AS (SELECT c, x FROM s WHERE c IN (SELECT c FROM s GROUP BY c HAVING count(*) >= 2)),
g AS (SELECT c, count(*) AS n, avg(x) AS m, var_samp(x) AS v FROM v GROUP BY c), t AS (SELECT avg(x) AS m FROM v)
SELECT round((sum(n * (g.m - t.m) * (g.m - t.m)) / (count(*) - 1)) / (sum((n - 1) * v) / (sum(n) - count(*))), 6) AS f,
       CAST(count(*) - 1 AS DOUBLE) AS df_between, CAST(sum(n) - count(*) AS DOUBLE) AS df_within FROM g, t""")
def q_anova_one_row_group(spark, sf_dir):
    """V8 where one group holds a single row, which has no part in F."""
    segment = F.when(F.col("c_custkey") == 1, F.lit("ALONE")).otherwise(F.col("c_mktsegment"))
    c = table(spark, sf_dir, "customer").select("c_acctbal", segment.alias("segment"))
    a = V.anova(c, "c_acctbal", "segment", valid_only=True)
    return round_doubles(a.select(F.col("F").alias("f"), "df_between", "df_within"), 6)


@query("pairwise_welch", """
WITH g AS (SELECT c_mktsegment AS c, count(*) AS n, avg(c_acctbal) AS m, var_samp(c_acctbal) AS v
           FROM customer WHERE c_mktsegment IS NOT NULL AND c_acctbal IS NOT NULL GROUP BY 1 HAVING count(*) >= 2)
SELECT a.c AS group_a, b.c AS group_b, round((a.m - b.m) / sqrt(a.v / a.n + b.v / b.n), 6) AS ttest,
       round(power(a.v / a.n + b.v / b.n, 2) / (power(a.v / a.n, 2) / (a.n - 1) + power(b.v / b.n, 2) / (b.n - 1)), 4) AS df,
       round(0.05 / ((SELECT count(*) FROM g) * ((SELECT count(*) FROM g) - 1) / 2), 3) AS bonferroni_alpha
FROM g a JOIN g b ON a.c < b.c""")
def q_pairwise_welch(spark, sf_dir):
    p = V.pairwise_welch(table(spark, sf_dir, "customer"), "c_acctbal", "c_mktsegment")
    return round_doubles(p.select("group_a", "group_b", "ttest", "df", "bonferroni_alpha"), 6, {"df": 4, "bonferroni_alpha": 3})


@query("bivariate_table")
def q_bivariate_table(spark, sf_dir):
    """V13 over customer with a churn-style binary target (negative balance) and the order features."""
    from churnspark.plans.domain import customer_table
    from churnspark.session import cut_lineage
    customers = cut_lineage(customer_table(spark, sf_dir).drop("c_custkey"))  # read by every job of the table
    return V.bivariate_table(customers, "churn")


@query("bivariate_statistics", """
WITH o AS (SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 9 > 0 THEN o_orderstatus END AS o_orderstatus, o_orderpriority AS p FROM orders),
long AS (SELECT 'o_totalprice' AS feature, o_totalprice AS x, p FROM o UNION ALL SELECT 'o_orderkey', CAST(o_orderkey AS DOUBLE), p FROM o),
g AS (SELECT feature, p, count(*) AS n, avg(x) AS m, var_samp(x) AS v FROM long GROUP BY 1, 2),
gm AS (SELECT feature, avg(x) AS gm, skewness(x) AS sk, count(DISTINCT x) AS u FROM long GROUP BY 1),
f AS (SELECT feature, u, sk, (sum(n * (m - gm) * (m - gm)) / (count(*) - 1)) / (sum((n - 1) * v) / (sum(n) - count(*))) AS f
      FROM g JOIN gm USING (feature) GROUP BY feature, u, sk),
c AS (SELECT o_orderstatus AS s, p, CAST(count(*) AS DOUBLE) AS n FROM o WHERE o_orderstatus IS NOT NULL GROUP BY 1, 2),
e AS (SELECT n, sum(n) OVER (PARTITION BY s) AS r, sum(n) OVER (PARTITION BY p) AS k, sum(n) OVER () AS t FROM c)
SELECT feature, CAST(0 AS DOUBLE) AS missing, u AS unique_values, round(sk, 3) AS skew, CAST(NULL AS DOUBLE) AS chi2, round(f, 3) AS f FROM f
UNION ALL SELECT 'o_orderstatus', (SELECT round(100.0 * count_if(o_orderstatus IS NULL) / count(*), 3) FROM o), (SELECT count(DISTINCT s) FROM c),
NULL, (SELECT round(sum(n * n / (r * k)) * max(t) - max(t), 3) FROM e), NULL""")
def q_bivariate_statistics(spark, sf_dir):
    """V13's chi-squared and ANOVA families against a categorical target, all features from one grouped pass."""
    status = F.when(F.col("o_orderkey") % 9 > 0, F.col("o_orderstatus"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", status.alias("o_orderstatus"), "o_orderpriority")
    out = V.bivariate_table(o, "o_orderpriority")
    return round_doubles(out.select("feature", "missing", "unique_values", "skew", "chi2", F.col("F").alias("f")), 3)


@query("regression_summary")
def q_regression_summary(spark, sf_dir):
    return V.regression_summary(table(spark, sf_dir, "supplier"), "s_acctbal", "s_nationkey")


# ---------------------------------------------------------------- sampling (M1-M3, M5, L3)
from churnspark.operators import sampling as M  # noqa: E402
from churnspark.operators.models import class_weights  # noqa: E402


@query("stratified_split", """
WITH c AS (SELECT quality, count(*) AS cnt FROM labels GROUP BY quality),
t AS (SELECT sum(cnt) AS n, CAST(ceil(0.2 * sum(cnt)) AS BIGINT) AS n_test FROM c),
a AS (SELECT quality, cnt, cnt * n_test / n AS cont, floor(cnt * n_test / n) AS fl, n_test FROM c, t),
r AS (SELECT *, n_test - sum(fl) OVER () AS need,
             row_number() OVER (ORDER BY cont - fl DESC, quality ASC) AS rk FROM a),
k AS (SELECT quality, cnt, CAST(fl + CASE WHEN rk <= need THEN 1 ELSE 0 END AS BIGINT) AS n_te FROM r)
SELECT 'test' AS split, quality, n_te AS count FROM k
UNION ALL SELECT 'train', quality, cnt - n_te FROM k""")
def q_stratified_split(spark, sf_dir):
    t = M.split_labels(table(spark, sf_dir, "labels"), "quality", "doc_id", test_size=0.2, seed=42)
    return t.groupBy("split", "quality").agg(F.count(F.lit(1)).alias("count"))


@query("under_sample", """
SELECT quality, (SELECT min(c) FROM (SELECT count(*) AS c FROM labels GROUP BY quality)) AS count
FROM labels GROUP BY quality""")
def q_under_sample(spark, sf_dir):
    u = M.under_sample(table(spark, sf_dir, "labels"), "quality", "doc_id", seed=42)
    return u.groupBy("quality").agg(F.count(F.lit(1)).alias("count"))


@query("kfold_sizes", """
WITH c AS (SELECT quality, count(*) AS cnt FROM labels GROUP BY quality),
s AS (SELECT quality, cnt, sum(cnt) OVER (ORDER BY quality) - cnt AS a FROM c),
f AS (SELECT CAST(i AS INTEGER) AS fold, quality,
             CAST(floor((a + cnt - 1 - i) / 5.0) - floor((a - 1 - i) / 5.0) AS BIGINT) AS count
      FROM s, range(5) t(i))
SELECT fold, quality, count FROM f WHERE count > 0""")
def q_kfold_sizes(spark, sf_dir):
    k = M.stratified_kfold(table(spark, sf_dir, "labels"), "quality", "doc_id", n_splits=5)
    return k.groupBy("fold", "quality").agg(F.count(F.lit(1)).alias("count"))


@query("class_weights", """
SELECT quality, round(n / (k * cnt) * CASE WHEN quality = 1 THEN 9.0 ELSE 1.0 END, 9) AS weight
FROM (SELECT quality, count(*) AS cnt FROM labels GROUP BY quality),
     (SELECT count(*) AS n, count(DISTINCT quality) AS k FROM labels)""")
def q_class_weights(spark, sf_dir):
    w = class_weights(table(spark, sf_dir, "labels"), "quality", positive_weight=9.0)
    return spark.createDataFrame([(int(k), round(float(v) + 1e-13, 9)) for k, v in w.items()], "quality int, weight double")


# ---------------------------------------------------------------- metrics
from churnspark.operators import metrics as L  # noqa: E402

SCORED_CTE = """sc AS (
  SELECT l.doc_id, l.quality AS label, (d.n_chars % 1000) / 1000.0 AS score,
         CASE WHEN (d.n_chars % 1000) / 1000.0 > 0.5 THEN 1.0 ELSE 0.0 END AS prediction
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


def scored_labels(spark, sf_dir, variant: int = 0):
    """A deterministic score per labelled document (the metric operators' input)."""
    lab = table(spark, sf_dir, "labels")
    doc = table(spark, sf_dir, "documents")
    base = (F.col("n_chars") % 1000) / 1000.0 if variant == 0 else (F.col("doc_id") % 997) / 997.0
    return (lab.join(doc, "doc_id").select("doc_id", F.col("quality").alias("label"), base.alias("score"))
               .withColumn("prediction", (F.col("score") > 0.5).cast("double")))


@query("confusion_metrics", f"""WITH {SCORED_CTE},
c AS (SELECT CAST(count_if(label = 1 AND prediction = 1) AS DOUBLE) AS tp, CAST(count_if(label = 0 AND prediction = 1) AS DOUBLE) AS fp,
             CAST(count_if(label = 0 AND prediction = 0) AS DOUBLE) AS tn, CAST(count_if(label = 1 AND prediction = 0) AS DOUBLE) AS fn FROM sc)
SELECT round((tp + tn) / (tp + fp + tn + fn), 9) AS accuracy,
       round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 9) AS precision,
       round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 9) AS recall,
       round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 9) AS f1,
       CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(tn AS BIGINT) AS tn, CAST(fn AS BIGINT) AS fn FROM c""")
def q_confusion_metrics(spark, sf_dir):
    return round_doubles(L.confusion_metrics(scored_labels(spark, sf_dir), "label", "prediction"), 9)


@query("roc_auc", f"""WITH {SCORED_CTE},
r AS (SELECT label, (2 * rank() OVER (ORDER BY score) + count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rk FROM sc),
a AS (SELECT sum(CASE WHEN label = 1 THEN rk ELSE 0 END) AS rs, CAST(count_if(label = 1) AS DOUBLE) AS n1,
             CAST(count_if(label = 0) AS DOUBLE) AS n0 FROM r)
SELECT round((rs - n1 * (n1 + 1) / 2) / (n1 * n0), 9) AS roc_auc FROM a""")
def q_roc_auc(spark, sf_dir):
    return round_doubles(L.roc_auc(scored_labels(spark, sf_dir), "label", "score"), 9)


PR_SQL = f"""WITH {SCORED_CTE},
s AS (SELECT score AS s, count(*) AS c, count_if(label = 1) AS p FROM sc GROUP BY score),
w AS (SELECT s, p, sum(c) OVER (ORDER BY s DESC) AS allc, sum(p) OVER (ORDER BY s DESC) AS tp,
             sum(p) OVER () AS npos FROM s)"""


@query("pr_curve", PR_SQL + """
SELECT round(s, 9) AS threshold, round(tp / allc, 9) AS precision, round(tp / npos, 9) AS recall FROM w""")
def q_pr_curve(spark, sf_dir):
    c = L.pr_curve(scored_labels(spark, sf_dir), "label", "score").drop("__dp")
    return round_doubles(c, 9)


@query("average_precision", PR_SQL + """
SELECT round(sum(p * (tp / allc)) / sum(p), 9) AS average_precision FROM w""")
def q_average_precision(spark, sf_dir):
    return round_doubles(L.average_precision(scored_labels(spark, sf_dir), "label", "score"), 9)


@query("class_report", f"""WITH {SCORED_CTE},
e AS (SELECT CAST(label AS VARCHAR) AS y, CAST(CAST(prediction AS INTEGER) AS VARCHAR) AS p FROM sc),
k AS (SELECT cls, sum(sup) AS support, sum(pred) AS predicted, sum(tp) AS tp FROM (
        SELECT y AS cls, 1 AS sup, 0 AS pred, CASE WHEN y = p THEN 1 ELSE 0 END AS tp FROM e
        UNION ALL SELECT p, 0, 1, 0 FROM e) GROUP BY cls),
m AS (SELECT cls AS class, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS precision,
             CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall, support FROM k),
f AS (SELECT class, precision, recall,
             CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1,
             CAST(support AS BIGINT) AS support FROM m)
SELECT class, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, support FROM f
UNION ALL SELECT 'macro avg', round(avg(precision), 9), round(avg(recall), 9), round(avg(f1), 9), CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 9), round(sum(recall * support) / sum(support), 9),
                 round(sum(f1 * support) / sum(support), 9), CAST(sum(support) AS BIGINT) FROM f""")
def q_class_report(spark, sf_dir):
    s = scored_labels(spark, sf_dir).withColumn("prediction", F.col("prediction").cast("int"))
    return round_doubles(L.classification_report(s, "label", "prediction"), 9)


# ---------------------------------------------------------------- skew (K2-K5, K9)
from churnspark.operators import skew as K  # noqa: E402


@query("power_search", """
WITH g AS (SELECT i AS j, 1.01 + i * ((50 - 1.01) / 99) AS p FROM range(100) t(i)),
v AS (SELECT j, p, skewness(power(value, 1 / p)) AS sk FROM g, events WHERE value IS NOT NULL GROUP BY j, p)
SELECT CAST(j AS INTEGER) AS j, round(1 / p, 6) AS exponent, round(sk, 6) AS skew FROM v""")
def q_power_search(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    grid = K.power_grid(50)
    sk = K.candidate_skews(ev, [("value", str(j), "pow", 1.0 / p, 0.0) for j, p in enumerate(grid)])
    rows = [(j, 1.0 / p, sk[("value", str(j))]) for j, p in enumerate(grid)]
    return round_doubles(spark.createDataFrame(rows, "j int, exponent double, skew double"), 6)


@query("log_transform", "SELECT event_id, round(ln(value + 1e-7), 6) AS value_log FROM events")
def q_log_transform(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return round_doubles(ev.select("event_id", K.log_expr(F.col("value")).alias("value_log")), 6)


@query("binary_fallback", """
SELECT event_id, CASE WHEN value IS NULL OR value <> (SELECT min(value) FROM events) THEN 1 ELSE 0 END AS value_binary
FROM events""")
def q_binary_fallback(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "value")
    lo = ev.agg(F.min("value")).first()[0]
    return K.fallback_to_binary(ev, "value", True, lo, None).select("event_id", "value_binary")


@query("yeo_johnson")
def q_yeo_johnson(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "value")
    m = K.YeoJohnson(inputCols=["value"]).fit(ev)
    return m.transform(ev)


@query("reduce_skew")
def q_reduce_skew(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    m = K.ReduceSkew(exclude=["event_id"]).fit(ev)
    return m.transform(ev)


@query("correct_skew")
def q_correct_skew(spark, sf_dir):
    out, results, name = K.correct_skew(table(spark, sf_dir, "events").select("event_id", "value"), "value")
    return out


# ---------------------------------------------------------------- sources and sinks
from churnspark.session import scratch_path  # noqa: E402
from churnspark.sources import io as IO  # noqa: E402


@query("csv_roundtrip", "SELECT * FROM customer")
def q_csv_roundtrip(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "csv")
    IO.write_csv(c, path)
    return IO.read_csv(spark, path, c.schema)


@query("load_with_fallback", "SELECT * FROM orders")
def q_load_with_fallback(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "fallback")
    IO.write_csv(o, path)
    return IO.load_table(spark, scratch_path(spark, "missing"), fallback=path, schema=o.schema)


@query("dataset_manifest", """
SELECT 'customer' AS name, 'training' AS context, count(*) AS num_rows, count(*) * 5 AS num_elements,
       TRUE AS signature_ok FROM customer""")
def q_dataset_manifest(spark, sf_dir):
    """S5 + S8: stored dataset, manifest row, and the stored signature checked against a fresh read."""
    root = scratch_path(spark, "store")
    c = table(spark, sf_dir, "customer")
    m = IO.log_dataset(c, root, "customer", f"{sf_dir}/customer.parquet", "training")
    ok = IO.check_signature(IO.load_logged_dataset(spark, root, "customer"), m.first()["schema_json"])
    return m.select("name", "context", "num_rows", "num_elements", F.lit(ok).alias("signature_ok"))


# ---------------------------------------------------------------- models
from churnspark.session import cut_lineage  # noqa: E402
from churnspark.operators import explain as X  # noqa: E402
from churnspark.operators import models as ML  # noqa: E402
from churnspark.operators.encode import ScaleEncode  # noqa: E402


def document_matrix(spark, sf_dir):
    """labels joined to documents: size, language and source as features, ``quality`` as target."""
    lab = table(spark, sf_dir, "labels")
    doc = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang", "source")
    d = lab.select("doc_id", "quality").join(doc, "doc_id")
    enc = ScaleEncode(exclude=["doc_id", "quality"]).fit(d).transform(d)
    return ML.FeatureAssembler(exclude=["doc_id", "quality", "weight"]).transform(enc)


def _weighted_split(spark, sf_dir):
    m = document_matrix(spark, sf_dir)
    tagged = M.split_labels(m, "quality", "doc_id", 0.2, 42)
    train = tagged.where(F.col("split") == "train")
    n = sum(M.class_counts(train, "quality").values())
    train = ML.with_weights(train, "quality", ML.class_weights(train, "quality", positive_weight=9.0))
    return cut_lineage(ML.right_size(train, n)), tagged.where(F.col("split") == "test"), m


@query("gbt_score")
def q_gbt_score(spark, sf_dir):
    train, val, _ = _weighted_split(spark, sf_dir)
    model = ML.boosted_trees("quality").fit(train)
    return ML.predict(model, val).select("doc_id", "quality", "score", "prediction")


@query("logistic_score")
def q_logistic_score(spark, sf_dir):
    train, val, _ = _weighted_split(spark, sf_dir)
    wsum = train.agg(F.sum("weight")).first()[0]
    model = ML.logistic("quality", weight_sum=wsum).fit(train)
    return ML.predict(model, val).select("doc_id", "quality", "score", "prediction")


@query("cross_validate")
def q_cross_validate(spark, sf_dir):
    m = document_matrix(spark, sf_dir)
    folds = M.stratified_kfold(m, "quality", "doc_id", 5)
    folds = ML.with_weights(folds, "quality", ML.class_weights(folds, "quality", positive_weight=9.0))
    folds = ML.right_size(folds, sum(M.class_counts(folds, "quality").values()))
    return ML.cross_validate(ML.boosted_trees("quality"), folds, "quality", "fold", 5)


def _doc_model(spark, sf_dir):
    train, val, m = _weighted_split(spark, sf_dir)
    model = ML.boosted_trees("quality").fit(train)
    names = ML.FeatureAssembler(exclude=["doc_id", "quality", "weight", "split"]).feature_columns(
        train.drop("features"))
    return model, names, val


@query("feature_importance")
def q_feature_importance(spark, sf_dir):
    model, names, _ = _doc_model(spark, sf_dir)
    return ML.top_k(ML.tree_importance(model, names), "gain_importance", 10)


@query("select_features")
def q_select_features(spark, sf_dir):
    model, names, _ = _doc_model(spark, sf_dir)
    kept = ML.select_by_importance(ML.tree_importance(model, names))
    return spark.createDataFrame([(f,) for f in kept], "feature string")


@query("scored_predictions", """SELECT 0 AS n_bad, CAST(ceil(0.2 * count(*)) AS BIGINT) AS n FROM labels JOIN documents USING (doc_id)""")
def q_scored_predictions(spark, sf_dir):
    """L2, L4: test rows whose score is no probability or whose prediction is not score > 0.5."""
    train, val, _ = _weighted_split(spark, sf_dir)
    model = ML.logistic("quality", weight_sum=train.agg(F.sum("weight")).first()[0]).fit(train)
    out = ML.predict(model, val)
    wrong = ~F.col("score").between(0, 1) | (F.col("prediction") != (F.col("score") > 0.5).cast("double"))
    return out.agg(F.count_if(F.coalesce(wrong, F.lit(True))).alias("n_bad"), F.count(F.lit(1)).alias("n"))


@query("importance_invariants", """SELECT 0 AS n_bad, TRUE AS all_counted FROM labels HAVING count(*) > 0""")
def q_importance_invariants(spark, sf_dir):
    """Features kept below the median number of splits or dropped from there on; every split is counted."""
    model, names, _ = _doc_model(spark, sf_dir)
    imp = cut_lineage(ML.tree_importance(model, names))
    kept = ML.select_by_importance(imp)
    bad = (F.col("split_importance") >= F.lit(imp.agg(F.median("split_importance")).first()[0])) != F.col("feature").isin(kept)
    splits = X.tree_nodes(model).where("leftChild >= 0").count()
    return imp.agg(F.count_if(bad).alias("n_bad"), (F.sum("split_importance") == splits).alias("all_counted"))


@query("tree_shap")
def q_tree_shap(spark, sf_dir):
    model, names, val = _doc_model(spark, sf_dir)
    return X.tree_shap(model, val, "doc_id", names)


@query("shap_summary")
def q_shap_summary(spark, sf_dir):
    """Mean absolute SHAP per feature, the data behind the summary plot."""
    model, names, val = _doc_model(spark, sf_dir)
    return X.shap_summary(X.tree_shap(model, val, "doc_id", names))


@query("shap_additivity", """SELECT 0 AS n_bad, (SELECT count(*) FROM labels JOIN documents USING (doc_id)) > 0 AS some""")
def q_shap_additivity(spark, sf_dir):
    """Rows whose SHAP values and base do not add up to the model's margin."""
    model, names, val = _doc_model(spark, sf_dir)
    total = X.tree_shap(model, val, "doc_id", names).groupBy("id").agg(F.sum("shap").alias("total"))
    margins = X.margin(model, val).select(F.col("doc_id").cast("string").alias("id"), "margin")
    off = F.abs(F.col("total") - F.col("margin")) > 1e-9
    return margins.join(total, "id", "left").agg(F.count_if(F.coalesce(off, F.lit(True))).alias("n_bad"), (F.count(F.lit(1)) > 0).alias("some"))


@query("pipeline_signature", """SELECT * FROM (VALUES ('same', 'accepted'), ('missing', 'refused'), ('retyped', 'refused'), ('extra', 'refused'),
('label', 'accepted')) t(frame, verdict) WHERE EXISTS (SELECT 1 FROM customer)""")
def q_pipeline_signature(spark, sf_dir):
    """S6 + S8: a saved and reloaded pipeline takes frames of its signature and refuses others."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    path = scratch_path(spark, "signed")
    IO.save_pipeline(Pipeline(stages=[ScaleEncode(exclude=["c_custkey"])]).fit(c), path, example=c, allowed=["churn"])
    frames = {"same": c, "missing": c.drop("c_acctbal"), "retyped": c.withColumn("c_acctbal", F.col("c_acctbal").cast("string")),
              "extra": c.withColumn("more", F.lit(1)), "label": c.withColumn("churn", F.lit(1))}

    def verdict(frame):
        try:
            IO.load_pipeline(path).transform(frame)
            return "accepted"
        except IO.SignatureError:
            return "refused"
    return spark.createDataFrame([(k, verdict(f)) for k, f in frames.items()], "frame string, verdict string")


@query("scored_customers_saved", "SELECT count(*) AS n, 0 AS n_bad FROM customer")
def q_scored_customers_saved(spark, sf_dir):
    """Rows that a pipeline transforms otherwise after it was saved and loaded."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    model = Pipeline(stages=[O.ReplaceOutliers(exclude=["c_custkey"]), ScaleEncode(exclude=["c_custkey"])]).fit(c)
    path = scratch_path(spark, "saved")
    IO.save_pipeline(model, path)
    one, two = model.transform(c), IO.load_pipeline(path).transform(c)
    rows = c.select(F.lit(0).alias("bad")).unionByName(one.exceptAll(two).select(F.lit(1).alias("bad")))
    return rows.agg(F.count_if(F.col("bad") == 0).alias("n"), F.count_if(F.col("bad") == 1).alias("n_bad"))


@query("run_record", """SELECT 'metric' AS kind, 'rows' AS key, CAST(count(*) AS VARCHAR) AS value FROM customer
UNION ALL SELECT 'param', 'depth', '5' FROM (SELECT 1) WHERE EXISTS (SELECT 1 FROM customer)""")
def q_run_record(spark, sf_dir):
    """Parameters and metrics of a run, appended and read back."""
    root = scratch_path(spark, "runs")
    n = table(spark, sf_dir, "customer").count()
    IO.log_run(spark, root, "other", {"depth": 9}, {"rows": -1})
    return IO.log_run(spark, root, "this", {"depth": 5}, {"rows": n}).select("kind", "key", "value")


@query("model_comparison", f"""WITH {SCORED_CTE.replace('sc AS', 'sa AS')},
{SCORED_CTE.replace('sc AS', 'sb AS').replace('(d.n_chars % 1000) / 1000.0', '(l.doc_id % 997) / 997.0')},
m AS (
  SELECT 'a' AS model, label, prediction, score FROM sa UNION ALL SELECT 'b', label, prediction, score FROM sb),
r AS (SELECT model, label, (2 * rank() OVER (PARTITION BY model ORDER BY score)
                            + count(*) OVER (PARTITION BY model, score) - 1) / 2.0 AS rk FROM m),
u AS (SELECT model, sum(CASE WHEN label = 1 THEN rk ELSE 0 END) AS rs, CAST(count_if(label = 1) AS DOUBLE) AS n1,
             CAST(count_if(label = 0) AS DOUBLE) AS n0 FROM r GROUP BY model),
c AS (SELECT model, CAST(count_if(label = 1 AND prediction = 1) AS DOUBLE) AS tp, CAST(count_if(label = 0 AND prediction = 1) AS DOUBLE) AS fp,
             CAST(count_if(label = 0 AND prediction = 0) AS DOUBLE) AS tn, CAST(count_if(label = 1 AND prediction = 0) AS DOUBLE) AS fn
      FROM m GROUP BY model),
v AS (SELECT model, 'accuracy' AS metric, (tp + tn) / (tp + fp + tn + fn) AS value FROM c
      UNION ALL SELECT model, 'precision', CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END FROM c
      UNION ALL SELECT model, 'recall', CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END FROM c
      UNION ALL SELECT model, 'f1', CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END FROM c
      UNION ALL SELECT model, 'roc_auc', (rs - n1 * (n1 + 1) / 2) / (n1 * n0) FROM u)
SELECT metric, round(max(CASE WHEN model = 'a' THEN value END), 9) AS a, round(max(CASE WHEN model = 'b' THEN value END), 9) AS b
FROM v GROUP BY metric""")
def q_model_comparison(spark, sf_dir):
    tabs = []
    for name, variant in (("a", 0), ("b", 1)):
        tabs.append(L.metrics_table(scored_labels(spark, sf_dir, variant), name, "label", "prediction", "score"))
    return round_doubles(L.compare_models(tabs), 9)


# ---------------------------------------------------------------- composed plans
from churnspark.plans import scenario as SC  # noqa: E402


@query("preprocessed_matrix")
def q_preprocessed_matrix(spark, sf_dir):
    """Merged client + price features, fitted preprocessing applied to all clients."""
    from churnspark.plans import domain as dm
    from churnspark.plans.preprocess import preprocess_estimator
    from churnspark.session import cut_lineage
    merged = cut_lineage(SC.merged_with_labels(dm.client_table(spark, sf_dir), dm.price_table(spark, sf_dir),
                                               dm.churn_labels(spark, sf_dir)))
    return preprocess_estimator([dm.ID, "churn"]).fit(merged).transform(merged)


@query("scenario_effect")
def q_scenario_effect(spark, sf_dir):
    return SC.scenario_effect(spark, sf_dir)


@query("scenario_summary")
def q_scenario_summary(spark, sf_dir):
    return SC.scenario_summary(SC.scenario_comparison(SC.fit_churn_model(spark, sf_dir)))


@query("batch_inference")
def q_batch_inference(spark, sf_dir):
    """C6 + S6 + S7: fit, store, reload the full pipeline and score the validation clients."""
    from churnspark.plans import domain as dm
    fitted = SC.fit_churn_model(spark, sf_dir)
    path = scratch_path(spark, "pipeline")
    IO.save_pipeline(fitted.model, path)
    model = IO.load_pipeline(path)
    ids = fitted.validation_ids
    out = SC.batch_inference(model, M.aligned_split(fitted.client, ids, dm.ID), M.aligned_split(fitted.prices, ids, dm.ID),
                             fitted.labels)
    IO.log_run(spark, scratch_path(spark, "runs"), "inference", {"n_estimators": 100, "scale_pos_weight": 9.0},
               out.first().asDict())
    return out


@query("scenario_scores", """
WITH b AS (SELECT c_custkey, c_custkey % 2 AS churn, (c_custkey % 97) / 97.0 AS p FROM customer WHERE c_custkey % 3 > 0),
d AS (SELECT c_custkey, c_custkey % 2 AS churn, (c_custkey % 89) / 89.0 AS p FROM customer WHERE c_custkey % 5 > 0)
SELECT c_custkey, CAST(coalesce(b.churn, d.churn) AS INTEGER) AS churn, round(b.p, 6) AS prob_churned, round(d.p, 6) AS prob_churned_discount
FROM b FULL JOIN d USING (c_custkey)""")
def q_scenario_scores(spark, sf_dir):
    """Base and scenario scores of partly different clients side by side."""
    c, key = table(spark, sf_dir, "customer"), F.col("c_custkey")
    scored = lambda skip, m: c.where(key % skip > 0).select(
        "c_custkey", (key % 2).cast("int").alias("churn"), ((key % m) / F.lit(float(m))).alias("prob_churned"))
    return round_doubles(SC.compare_scores(scored(3, 97), scored(5, 89)), 6)


@query("aligned_rows", """SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey IN (
SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def q_aligned_rows(spark, sf_dir):
    """Series rows that follow their entity into a split."""
    ids = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return M.aligned_split(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), ids, "o_custkey")


@query("kfold_rows", """
WITH c AS (SELECT quality, count(*) AS n FROM labels GROUP BY 1),
s AS (SELECT quality, coalesce(sum(n) OVER (ORDER BY quality ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a,
             sum(n) OVER (ORDER BY quality) AS b FROM c),
f AS (SELECT quality, i, sum(floor((b - 1 - i) / 5.0) - floor((a - 1 - i) / 5.0)) OVER (PARTITION BY quality ORDER BY i) AS upto
      FROM s, range(5) t(i)),
r AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY doc_id) - 1 AS pos FROM labels)
SELECT doc_id, r.quality, CAST(min(i) AS INTEGER) AS fold FROM r JOIN f ON r.quality = f.quality AND pos < upto GROUP BY 1, 2""")
def q_kfold_rows(spark, sf_dir):
    """M5: the fold of every labelled document."""
    return M.stratified_kfold(table(spark, sf_dir, "labels").select("doc_id", "quality"), "quality", "doc_id", 5).select("doc_id", "quality", "fold")


@query("split_sizes", """
WITH c AS (SELECT quality, count(*) AS n FROM labels GROUP BY 1), m AS (SELECT min(n) AS m FROM c)
SELECT 'split' AS what, CAST(ceil(0.2 * sum(n)) AS BIGINT) AS n, 0 AS n_bad FROM c
UNION ALL SELECT 'under', CAST(m * (SELECT count(*) FROM c) AS BIGINT), 0 FROM m""")
def q_split_sizes(spark, sf_dir):
    """M1, M3: rows taken, and rows taken that are no label row or taken twice."""
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    parts = {"split": M.stratified_split(lab, "quality", "doc_id", 0.2, 42)[1], "under": M.under_sample(lab, "quality", "doc_id", 7)}
    out = None
    for what, part in parts.items():
        one = part.groupBy("doc_id", "quality").agg(F.count(F.lit(1)).alias("k")).join(
            lab.withColumn("known", F.lit(True)), ["doc_id", "quality"], "left").agg(
            F.lit(what).alias("what"), F.sum("k").alias("n"), F.count_if((F.col("k") > 1) | F.col("known").isNull()).alias("n_bad"))
        out = one if out is None else out.unionByName(one)
    return out


@query("log_choice", """SELECT event_id, round(ln(value + CASE WHEN lo < 0 THEN abs(lo) + 1 ELSE 0 END + 1e-7), 6) AS value_log
FROM events, (SELECT min(value) AS lo FROM events)""")
def q_log_choice(spark, sf_dir):
    """K8: the expression of a chosen logarithm."""
    ev = table(spark, sf_dir, "events").select("event_id", "value")
    lo = ev.agg(F.min("value")).first()[0]
    return round_doubles(ev.select("event_id", K.transform_expr(ev, "value", "log", True, lo, None).alias("value_log")), 6)


# ---------------------------------------------------------------- density outliers
from churnspark.operators import density as DB  # noqa: E402

DB_POINTS_CTE = """s AS (
  SELECT s_suppkey AS k, (s_acctbal - mn1) / (mx1 - mn1) AS f0, (CAST(s_nationkey AS DOUBLE) - mn2) / (mx2 - mn2) AS f1
  FROM supplier, (SELECT min(s_acctbal) AS mn1, max(s_acctbal) AS mx1, CAST(min(s_nationkey) AS DOUBLE) AS mn2,
                         CAST(max(s_nationkey) AS DOUBLE) AS mx2 FROM supplier)),
pr AS (SELECT a.k AS p, b.k AS q, abs(a.f0 - b.f0) + abs(a.f1 - b.f1) AS d FROM s a, s b)"""

_STEP = "CAST(0.01 AS DOUBLE)"
_I0 = f"CAST(greatest(ceil(d / {_STEP}) - 1, 0) AS BIGINT)"

DBSCAN_TABLE_SQL = f"""WITH {DB_POINTS_CTE},
g AS (SELECT p, q, CASE WHEN d > {_STEP} + {_I0} * {_STEP} THEN {_I0} + 1
                        WHEN {_I0} > 0 AND d <= {_STEP} + ({_I0} - 1) * {_STEP} THEN {_I0} - 1 ELSE {_I0} END AS gi FROM pr),
core AS (SELECT q, gi AS cg FROM (SELECT q, gi, row_number() OVER (PARTITION BY q ORDER BY gi) AS rn FROM g) WHERE rn = 5),
reach AS (SELECT g.p, min(greatest(g.gi, core.cg)) AS r FROM g JOIN core ON g.q = core.q GROUP BY g.p),
pts AS (SELECT s.k, reach.r FROM s LEFT JOIN reach ON s.k = reach.p),
noise AS (SELECT i, count_if(r IS NULL OR r > i) AS nz, count(*) AS n FROM range(500) t(i), pts GROUP BY i),
stp AS (SELECT coalesce(min(i), 499) AS si FROM noise WHERE nz = 0)
SELECT round({_STEP} + i * {_STEP}, 6) AS eps, round_even(100.0 * nz / n, 2) AS "percentage_outliers(%)",
       round(abs(round_even(100.0 * nz / n, 2) - 2.0), 6) AS diff
FROM noise, stp WHERE i <= si"""


@query("dbscan_eps_table", DBSCAN_TABLE_SQL)
def q_dbscan_eps_table(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal", "s_nationkey")
    t, _ = DB.search_eps(s, "s_suppkey", "manhattan", min_samples=5, eps_step=0.01, desired_percentage_outliers=0.02)
    return round_doubles(t, 6)


@query("dbscan_clean", f"""WITH {DB_POINTS_CTE},
w AS (SELECT * FROM pr WHERE d <= 0.05),
core AS (SELECT q FROM w GROUP BY q HAVING count(*) >= 5),
reached AS (SELECT DISTINCT p FROM w JOIN core USING (q))
SELECT s_suppkey, s_acctbal, s_nationkey FROM supplier WHERE s_suppkey IN (SELECT p FROM reached)""")
def q_dbscan_clean(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal", "s_nationkey")
    return DB.clean_outliers_dbscan(s, "s_suppkey", 0.05, "manhattan", 5)


# One dense cell and one far outlier: cubed balances, nine in ten of them shrunk a thousandfold, one customer far off.
DENSE_SQL = """dense AS (SELECT c_custkey AS k, CASE WHEN c_custkey = 1 THEN CAST(1e9 AS DOUBLE)
    WHEN c_custkey % 10 = 0 THEN c_acctbal * c_acctbal / 1000 ELSE c_acctbal * c_acctbal / 1000000 END AS x,
    CAST(c_nationkey AS DOUBLE) / 1000 AS y FROM customer)"""


def dense_points(spark, sf_dir):
    bal = F.col("c_acctbal")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") == 1, F.lit(1e9)).when(F.col("c_custkey") % 10 == 0, bal * bal / 1000)
        .otherwise(bal * bal / 1000000).alias("x"), (F.col("c_nationkey").cast("double") / 1000).alias("y"))


@query("dbscan_dense_cell", f"""WITH {DENSE_SQL},
lim AS (SELECT min(x) AS a, max(x) - min(x) AS b, min(y) AS c, max(y) - min(y) AS e FROM dense),
pts AS (SELECT k, (x - a) / b AS f0, (y - c) / e AS f1 FROM dense, lim),
pr AS (SELECT a.k AS p, b.k AS q FROM pts a, pts b WHERE abs(a.f0 - b.f0) + abs(a.f1 - b.f1) <= CAST(0.01 AS DOUBLE)),
core AS (SELECT q FROM pr GROUP BY q HAVING count(*) >= 5)
SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT p FROM pr JOIN core USING (q))""")
def q_dbscan_dense_cell(spark, sf_dir):
    """O11 on points of which nearly all share one cell of side eps."""
    return DB.clean_outliers_dbscan(dense_points(spark, sf_dir), "c_custkey", 0.01, "manhattan", 5).select("c_custkey")


@query("dbscan_canberra", f"""WITH {DB_POINTS_CTE.split("pr AS")[0].rstrip().rstrip(",")},
pr AS (SELECT a.k AS p, b.k AS q, CASE WHEN a.f0 + b.f0 > 0 THEN abs(a.f0 - b.f0) / (a.f0 + b.f0) ELSE 0 END
    + CASE WHEN a.f1 + b.f1 > 0 THEN abs(a.f1 - b.f1) / (a.f1 + b.f1) ELSE 0 END AS d FROM s a, s b),
w AS (SELECT * FROM pr WHERE d <= 0.05),
core AS (SELECT q FROM w GROUP BY q HAVING count(*) >= 5)
SELECT s_suppkey, s_acctbal, s_nationkey FROM supplier WHERE s_suppkey IN (SELECT p FROM w JOIN core USING (q))""")
def q_dbscan_canberra(spark, sf_dir):
    """O11 with a metric that has no coordinates: the search goes by pivot distances."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal", "s_nationkey")
    return DB.clean_outliers_dbscan(s, "s_suppkey", 0.05, "canberra", 5)


@query("nearest_neighbours", f"""WITH {DENSE_SQL},
pr AS (SELECT a.k AS p, b.k AS q, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS d FROM dense a, dense b WHERE a.k <> b.k)
SELECT p, rank, round(d, 6) AS d FROM (SELECT p, d, row_number() OVER (PARTITION BY p ORDER BY d, q) AS rank FROM pr) WHERE rank <= 5""")
def q_nearest_neighbours(spark, sf_dir):
    """The distances to the five nearest others of every customer, densities thousands of times apart."""
    from churnspark.operators.neighbours import nearest_neighbours
    pts = dense_points(spark, sf_dir).withColumnRenamed("c_custkey", "__id")
    return round_doubles(nearest_neighbours(pts, ["x", "y"], 5, "euclidean").select("p", F.col("rank").cast("bigint").alias("rank"), "d"), 6)


# ---------------------------------------------------------------- imputation


@query("impute_outliers")
def q_impute_outliers(spark, sf_dir):
    """Lineitem outliers (by the threshold rule) set missing and re-estimated from the other columns."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
                                                  "l_discount", "l_tax", "l_returnflag")
    return O.clean_outliers(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "impute",
                            output_column="l_returnflag")


@query("iterative_impute")
def q_iterative_impute(spark, sf_dir):
    """Customer balances missing by key rule, estimated from nation and segment."""
    c = customer_with_nulls(spark, sf_dir).select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    from churnspark.operators.impute import iterative_impute
    return iterative_impute(c, targets=["c_acctbal"], predictors=["c_nationkey", "c_acctbal", "c_mktsegment"])


@query("impute_invariants", """SELECT count(*) AS n, 0 AS n_changed, 0 AS n_missing FROM customer""")
def q_impute_invariants(spark, sf_dir):
    """Observed balances that the imputer changed, and balances that it left missing."""
    from churnspark.operators.impute import iterative_impute
    c = customer_with_nulls(spark, sf_dir).select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    out = iterative_impute(c, targets=["c_acctbal"], predictors=["c_nationkey", "c_acctbal", "c_mktsegment"])
    both = out.select("c_custkey", F.col("c_acctbal").alias("new")).join(c.select("c_custkey", "c_acctbal"), "c_custkey")
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("c_acctbal") != F.col("new")).alias("n_changed"),
                    F.count_if(F.col("new").isNull() | F.isnan("new")).alias("n_missing"))


@query("smote_invariants", """
WITH d AS (SELECT quality, n_chars FROM labels JOIN documents USING (doc_id)), c AS (SELECT quality, count(*) AS n FROM d GROUP BY 1)
SELECT quality, (SELECT max(n) FROM c) AS n, 0 AS n_outside FROM c""")
def q_smote_invariants(spark, sf_dir):
    """M4: class sizes after oversampling, and new rows outside the box of their class's own."""
    out = q_smote(spark, sf_dir)
    box = out.where("doc_id is not null").groupBy(F.col("quality").alias("of")).agg(
        *[f(c).alias(f"{t}_{c}") for c in ("n_chars", "n_words") for f, t in ((F.min, "lo"), (F.max, "hi"))])
    far = [~F.col(c).between(F.col(f"lo_{c}") - 1e-9, F.col(f"hi_{c}") + 1e-9) for c in ("n_chars", "n_words")]
    return out.join(box, F.col("quality") == F.col("of")).groupBy("quality").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(far[0] | far[1]).alias("n_outside"))


@query("smote")
def q_smote(spark, sf_dir):
    """Minority documents (by quality) oversampled in (n_chars, doc length in words) space."""
    d = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents"), "doc_id").select(
        "doc_id", "quality", F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split(F.col("text"), r"\s+")).cast("double").alias("n_words"))
    return M.smote(d, "quality", "doc_id", ["n_chars", "n_words"], k=5, seed=42)


# ---------------------------------------------------------------- composed branches (C1-C3) with twins
from churnspark.plans import domain as DM  # noqa: E402
from churnspark.plans import preprocess as PP  # noqa: E402

CLIENT_SQL = """
WITH f AS (SELECT o_custkey, min(o_orderdate) AS d FROM orders GROUP BY o_custkey)
SELECT c.c_custkey, c.c_nationkey, c.c_acctbal, c.c_mktsegment,
       date_diff('day', f.d, f.d + INTERVAL 3650 DAY) AS contract_length,
       date_diff('day', f.d + INTERVAL 3650 DAY, TIMESTAMP '2020-01-01') AS days_until_end,
       date_diff('day', f.d + INTERVAL 365 DAY, TIMESTAMP '2020-01-01') AS days_until_renewal,
       date_diff('day', f.d + INTERVAL 30 DAY, TIMESTAMP '2020-01-01') AS days_since_modification
FROM customer c JOIN f ON c.c_custkey = f.o_custkey"""


@query("client_features", CLIENT_SQL)
def q_client_features(spark, sf_dir):
    """Parse the contract dates (five layouts), drop incomplete clients, derive day counts."""
    return PP.client_branch(DM.client_table(spark, sf_dir), DM.DATE_COLUMNS)


PRICE_SQL = """
WITH o AS (SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice,
                  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS pos FROM orders),
g AS (SELECT o_custkey, count(*) AS n, avg(o_totalprice) AS m, stddev_samp(o_totalprice) AS s,
             first(o_totalprice ORDER BY o_orderdate DESC, o_orderkey ASC) AS lst,
             first(o_totalprice ORDER BY o_orderdate ASC, o_orderkey ASC) AS fst,
             regr_slope(o_totalprice, pos) AS slope FROM o GROUP BY o_custkey)
SELECT o_custkey AS c_custkey, round(m, 4) AS mean_o_totalprice, round(lst, 4) AS last_o_totalprice,
       round(lst - fst, 4) AS difference_o_totalprice, round(CASE WHEN n >= 2 THEN slope END, 4) AS o_totalprice_slope,
       round(s, 4) AS std_o_totalprice FROM g"""


@query("price_features", PRICE_SQL)
def q_price_features(spark, sf_dir):
    """Drop incomplete price rows, one aggregation of series features per client."""
    p = PP.price_branch(DM.price_table(spark, sf_dir), DM.PRICE_COLUMNS, DM.ID, "price_date", ["price_seq"])
    return round_doubles(p, 4)


@query("merged_features", f"""WITH cl AS ({CLIENT_SQL}), pr AS ({PRICE_SQL})
SELECT cl.*, pr.mean_o_totalprice, pr.last_o_totalprice, pr.difference_o_totalprice, pr.o_totalprice_slope,
       pr.std_o_totalprice FROM cl JOIN pr ON cl.c_custkey = pr.c_custkey""")
def q_merged_features(spark, sf_dir):
    """Client and price branches joined on the key."""
    m = PP.merge_inputs(DM.client_table(spark, sf_dir), DM.price_table(spark, sf_dir), DM.ID, DM.DATE_COLUMNS,
                        DM.PRICE_COLUMNS, "price_date", ["price_seq"])
    return round_doubles(m, 4, {"c_acctbal": 6})


@query("discount_projection", """
SELECT l_orderkey, l_linenumber, round(l_extendedprice * 0.85, 6) AS l_extendedprice, round(l_tax * 0.85, 6) AS l_tax
FROM lineitem""")
def q_discount_projection(spark, sf_dir):
    """Prices x (1 - 0.15)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_tax")
    return round_doubles(PP.discount_prices(li, ["l_extendedprice", "l_tax"], 0.15), 6)


# ---------------------------------------------------------------- summaries

@query("regression_stats", """
WITH p AS (SELECT CAST(s_acctbal AS DOUBLE) AS x, CAST(s_nationkey AS DOUBLE) AS y FROM supplier
           WHERE s_acctbal IS NOT NULL AND s_nationkey IS NOT NULL),
r AS (SELECT x, y, (2 * rank() OVER (ORDER BY x) + count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx,
             (2 * rank() OVER (ORDER BY y) + count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry FROM p)
SELECT round(regr_slope(y, x), 3) AS slope, round(regr_intercept(y, x), 3) AS intercept, round(corr(x, y), 3) AS pearson_r,
       round(corr(rx, ry), 3) AS spearman, round(skewness(x), 3) AS skew_1, round(skewness(y), 3) AS skew_2 FROM r""")
def q_regression_stats(spark, sf_dir):
    """V10 without tail probabilities (those are unit-tested)."""
    s = V.regression_summary(table(spark, sf_dir, "supplier"), "s_acctbal", "s_nationkey", 3, with_kendall=False)
    return s.select("slope", "intercept", "pearson_r", "spearman", "skew_1", "skew_2")


@query("bar_summary", ANOVA_SQL.replace("GROUP BY 1),", "GROUP BY 1 HAVING count(*) >= 2),"))
def q_bar_summary(spark, sf_dir):
    """More than two valid groups -> ANOVA over the valid groups (pairwise Welch separately)."""
    _, test, _ = V.bar_summary(table(spark, sf_dir, "customer"), "c_acctbal", "c_mktsegment")
    return round_doubles(test.select("F", "df_between", "df_within"), 6)


@query("heatmap_summary", _shares_sql("PARTITION BY o_orderpriority"))
def q_heatmap_summary(spark, sf_dir):
    """Counts with column shares (the chi-squared part is the ``chi2`` query)."""
    shares, _ = V.heatmap_summary(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority", axis_sum=0)
    return round_doubles(shares, 6)


# ---------------------------------------------------------------- skew helpers

@query("binary_conversion", "SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"""CASE WHEN (SELECT skewness({c}) FROM lineitem) > 0
             THEN CAST({c} IS NULL OR {c} <> (SELECT min({c}) FROM lineitem) AS INTEGER)
             ELSE CAST({c} IS NULL OR {c} <> (SELECT max({c}) FROM lineitem) AS INTEGER) END AS {c}"""
    for c in ["l_quantity", "l_discount"]) + " FROM lineitem")
def q_binary_conversion(spark, sf_dir):
    """Direction from the skew of the frame being converted."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    mm = li.agg(F.min("l_quantity"), F.max("l_quantity"), F.min("l_discount"), F.max("l_discount")).first()
    return K.convert_to_binary(li, ["l_quantity", "l_discount"], {"l_quantity": mm[0], "l_discount": mm[2]},
                               {"l_quantity": mm[1], "l_discount": mm[3]})


@query("subsample_counts", """
SELECT least(count(value), 5000) AS sampled, count(value) AS available FROM events""")
def q_subsample_counts(spark, sf_dir):
    """K1: rows without a missing value, at most 5000 chosen by a seeded hash."""
    ev = table(spark, sf_dir, "events")
    s = K.subsample(ev, "value", 5000, 42)
    return s.agg(F.count(F.lit(1)).alias("sampled")).withColumn(
        "available", ev.where(F.col("value").isNotNull()).agg(F.count(F.lit(1))).scalar())


@query("skew_candidates")
def q_skew_candidates(spark, sf_dir):
    """K5-K7: every candidate's skew and the chosen transformation for the events value."""
    ev = table(spark, sf_dir, "events")
    sk = {"value": ev.agg(adj_skew_col("value")).first()[0]}
    res = K.evaluate_candidates(ev, ["value"], sk)["value"]
    best, ok = K.select_best_transformation(res)
    return spark.createDataFrame([(k, float(v), k == best, ok) for k, v in res.items()],
                                 "candidate string, skew double, chosen boolean, within_threshold boolean")


def adj_skew_col(c):
    from churnspark.functions.exprs import adj_skew
    return adj_skew(F.col(c))


# ---------------------------------------------------------------- top-k reports


@query("top_scores", f"""WITH {SCORED_CTE}
SELECT doc_id, label, round(score, 9) AS score FROM sc ORDER BY score DESC, doc_id ASC LIMIT 20""")
def q_top_scores(spark, sf_dir):
    """L16 + L11: the 20 highest scores (a top-k report: the limit is the feature; ties by key)."""
    s = scored_labels(spark, sf_dir).select("doc_id", "label", "score")
    return round_doubles(s.orderBy(F.col("score").desc(), F.col("doc_id").asc()).limit(20), 9)


@query("univariate_profile_approx")
def q_univariate_profile_approx(spark, sf_dir):
    """U1-U9 with sketch quartiles (the option for very large tables)."""
    ev = table(spark, sf_dir, "events")
    return P.univariate_profile(ev, 3, columns=["event_id", "user_id", "event_type", "value"], exact=False)


@query("compose_transforms", """
SELECT l_orderkey, l_linenumber,
       CAST(l_discount IS NULL OR l_discount <> (SELECT min(l_discount) FROM lineitem) AS INTEGER) AS l_discount,
       round(power(l_quantity, 0.5), 6) AS l_quantity, round(l_tax, 6) AS l_tax FROM lineitem""")
def q_compose_transforms(spark, sf_dir):
    """Binary / power column sets in one projection, other columns passed through."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_quantity", "l_tax")
    lo = li.agg(F.min("l_discount")).first()[0]
    out = K.compose_transforms(li, binary={"l_discount": (lo, None, True)}, power={"l_quantity": 0.5})
    return round_doubles(out, 6)


@query("aligned_split")
def q_aligned_split(spark, sf_dir):
    """The orders of the clients drawn into the validation split follow them."""
    from churnspark.plans import domain as dm
    tagged = M.split_labels(dm.churn_labels(spark, sf_dir), "churn", dm.ID, 0.2, 42)
    ids = tagged.where(F.col("split") == "test").select(dm.ID)
    return M.aligned_split(dm.price_table(spark, sf_dir), ids, dm.ID)


HIST_AUTO_SQL = """
WITH r AS (SELECT min(value) AS lo, max(value) AS hi, count(value) AS n,
                  quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS iqr FROM events),
k AS (SELECT lo, hi, n, CAST(greatest(ceil(log2(n)) + 1,
                 CASE WHEN iqr > 0 THEN ceil((hi - lo) / (2.0 * iqr * power(n, -1.0 / 3.0))) ELSE 0 END, 1) AS INTEGER) AS nb FROM r),
b AS (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((value - lo) / ((hi - lo) / nb)), nb - 1) END AS INTEGER) AS bin,
             lo, hi, n, nb FROM events, k WHERE value IS NOT NULL)
SELECT 'value' AS feature, bin, round(lo + bin * ((hi - lo) / nb), 6) AS bin_start,
       round(lo + (bin + 1) * ((hi - lo) / nb), 6) AS bin_end, count(*) AS count,
       round(count(*) / (n * ((hi - lo) / nb)), 6) AS density
FROM b GROUP BY bin, lo, hi, n, nb
"""


@query("histogram_auto", HIST_AUTO_SQL)
def q_histogram_auto(spark, sf_dir):
    """A11 with the automatic bin count (Sturges / Freedman-Diaconis, whichever gives more bins)."""
    return round_doubles(P.histogram(table(spark, sf_dir, "events"), "value", bins="auto"), 6)
