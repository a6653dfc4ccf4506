"""Association between a feature and a target.

* Pearson / simple regression from ``regr_*`` aggregates (pairwise deletion).
* Spearman from average ranks: value counts per side, running counts
  (skew-safe, ``order.with_cumsum``), a weighted Pearson over the
  compressed ``(x, y, count)`` table.
* Kendall tau-b: ``kendall.py``.
* Chi-squared of independence from the long contingency table:
  ``chi2 = sum(o^2 / e) - N`` over non-empty cells (zero cells add nothing),
  Yates-corrected when the table is 2x2.
* t-tests and ANOVA from per-group ``count, mean, var_samp``.

p-values are tail probabilities of the statistic, evaluated per result row
by ``functions.dist`` (one row per feature, Arrow-batched).
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnspark.functions import dist
from churnspark.functions.dist import chi2_pvalue_udf, f_pvalue_udf, t_pvalue_udf
from churnspark.functions.exprs import adj_skew, as_double, is_boolean, is_numeric
from churnspark.operators.order import with_cumsum
from churnspark.session import drop_scratch, scratch_table


def _dtypes(df):
    return dict((f.name, f.dataType) for f in df.schema.fields)


def _num(df, c):
    return as_double(F.col(f"`{c}`"), _dtypes(df)[c])


def _pair(df, x, y, x_numeric=True, y_numeric=True):
    xs = _num(df, x) if x_numeric else F.col(f"`{x}`").cast("string")
    ys = _num(df, y) if y_numeric else F.col(f"`{y}`").cast("string")
    return df.select(xs.alias("x"), ys.alias("y")).where(F.col("x").isNotNull() & F.col("y").isNotNull())


# ------------------------------------------------------------------ V1 Pearson / regression

def pearson_table(df: DataFrame, target: str, features: list[str]) -> DataFrame:
    """V1 for many numeric features in one aggregate:
    ``feature, n, slope, intercept, r, t, pearson_pvalue``."""
    y = _num(df, target)
    aggs = []
    for i, f in enumerate(features):
        x = _num(df, f)
        aggs += [F.regr_count(y, x).alias(f"n{i}"), F.regr_slope(y, x).alias(f"b{i}"),
                 F.regr_intercept(y, x).alias(f"a{i}"), F.corr(x, y).alias(f"r{i}")]
    row = df.agg(*aggs)
    rows = [F.struct(F.lit(f).alias("feature"), F.col(f"n{i}").alias("n"), F.col(f"b{i}").alias("slope"),
                     F.col(f"a{i}").alias("intercept"), F.col(f"r{i}").alias("r")) for i, f in enumerate(features)]
    t = row.select(F.explode(F.array(*rows)).alias("s")).select("s.*")
    return _with_r_test(t, "r", "n", "pearson_pvalue")


def _with_r_test(t: DataFrame, r: str, n: str, pname: str) -> DataFrame:
    """t = r sqrt((n-2)/(1-r^2)) with n-2 degrees of freedom (|r| = 1 -> p = 0)."""
    rr = F.col(r)
    tstat = F.when(F.abs(rr) >= 1, F.signum(rr) * F.lit(float("inf"))).otherwise(
        rr * F.sqrt((F.col(n) - 2) / (1 - rr * rr)))
    return t.withColumn(f"__t_{pname}", tstat).withColumn(
        pname, t_pvalue_udf(F.col(f"__t_{pname}"), (F.col(n) - 2).cast("double"))).drop(f"__t_{pname}")


# ------------------------------------------------------------------ V2 Spearman

def average_ranks(values: DataFrame, col: str, weight: str = "__w") -> DataFrame:
    """``(col, rank)`` with average (1-based) ranks for ties, from a weighted value table."""
    vc = values.groupBy(col).agg(F.sum(weight).alias("__cnt")).withColumn("__k", F.lit(0))
    cum = with_cumsum(vc, ["__k"], [col], "__cnt", "__c0")
    return cum.select(col, (F.col("__c0") + (F.col("__cnt") + 1) / 2.0).alias(f"rank_{col}"))


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """V2: ``n, spearman, spearman_pvalue`` for one pair (missing pairs dropped)."""
    from churnspark.session import cut_lineage
    pairs = cut_lineage(_pair(df, x, y).groupBy("x", "y").agg(F.count(F.lit(1)).alias("__w")))  # read 3 times
    rx, ry = average_ranks(pairs, "x"), average_ranks(pairs, "y")
    r = pairs.join(rx, "x").join(ry, "y")
    w, a, b = F.col("__w"), F.col("rank_x"), F.col("rank_y")
    s = r.agg(F.sum(w).alias("n"), F.sum(w * a).alias("sa"), F.sum(w * b).alias("sb"),
              F.sum(w * a * a).alias("saa"), F.sum(w * b * b).alias("sbb"), F.sum(w * a * b).alias("sab"))
    n = F.col("n").cast("double")
    cov = F.col("sab") / n - (F.col("sa") / n) * (F.col("sb") / n)
    va = F.col("saa") / n - (F.col("sa") / n) ** 2
    vb = F.col("sbb") / n - (F.col("sb") / n) ** 2
    out = s.select(F.col("n"), F.when((va > 0) & (vb > 0), cov / F.sqrt(va * vb)).alias("spearman"))
    return _with_r_test(out, "spearman", "n", "spearman_pvalue")


def spearman_many(df: DataFrame, target: str, features: list[str]) -> DataFrame:
    """V2 for many features against one target in one pipeline: ``feature, n, spearman, spearman_pvalue``.

    Long ``(feature, x, y)`` pairs (pairwise deletion), average ranks per
    feature for both sides from value counts and skew-safe running counts."""
    parts = [F.struct(F.lit(f).alias("feature"), _num(df, f).alias("x")) for f in features]
    long = (df.select(_num(df, target).alias("y"), F.explode(F.array(*parts)).alias("s"))
              .select("s.feature", "s.x", "y").where(F.col("x").isNotNull() & F.col("y").isNotNull()))
    from churnspark.session import cut_lineage
    pairs = cut_lineage(long.groupBy("feature", "x", "y").agg(F.count(F.lit(1)).alias("__w")))  # read 3 times

    def ranks(col):
        vc = pairs.groupBy("feature", col).agg(F.sum("__w").alias("__cnt"))
        cum = with_cumsum(vc, ["feature"], [col], "__cnt", "__c0")
        return cum.select("feature", col, (F.col("__c0") + (F.col("__cnt") + 1) / 2.0).alias(f"rank_{col}"))

    r = pairs.join(ranks("x"), ["feature", "x"]).join(ranks("y"), ["feature", "y"])
    w, a, b = F.col("__w"), F.col("rank_x"), F.col("rank_y")
    s = r.groupBy("feature").agg(F.sum(w).alias("n"), F.sum(w * a).alias("sa"), F.sum(w * b).alias("sb"),
                                 F.sum(w * a * a).alias("saa"), F.sum(w * b * b).alias("sbb"), F.sum(w * a * b).alias("sab"))
    n = F.col("n").cast("double")
    cov = F.col("sab") / n - (F.col("sa") / n) * (F.col("sb") / n)
    va = F.col("saa") / n - (F.col("sa") / n) ** 2
    vb = F.col("sbb") / n - (F.col("sb") / n) ** 2
    out = s.select("feature", "n", F.when((va > 0) & (vb > 0), cov / F.sqrt(va * vb)).alias("spearman"))
    return _with_r_test(out, "spearman", "n", "spearman_pvalue")


# ------------------------------------------------------------------ V4 chi-squared

def chi2_test(df: DataFrame, a: str, b: str, correction: bool = True) -> DataFrame:
    """V4: ``chi2, dof, chi2_pvalue`` of the contingency table of two categorical columns.

    Without correction ``chi2 = N * sum(o^2 / (row * col)) - N`` over the
    non-empty cells.  When the table is 2x2 (dof 1) the Yates term needs the
    empty cells too; then the table has at most four cells and they are
    read with the margins (bounded by the shape check)."""
    t = (df.select(F.col(f"`{a}`").cast("string").alias("a"), F.col(f"`{b}`").cast("string").alias("b"))
           .where(F.col("a").isNotNull() & F.col("b").isNotNull())
           .groupBy("a", "b").agg(F.count(F.lit(1)).cast("double").alias("o")))
    t = t.withColumns({"ra": F.sum("o").over(Window.partitionBy("a")), "cb": F.sum("o").over(Window.partitionBy("b"))})
    g = t.agg(F.sum("o").alias("N"), F.count_distinct("a").alias("R"), F.count_distinct("b").alias("C"),
              F.sum(F.col("o") * F.col("o") / (F.col("ra") * F.col("cb"))).alias("q"))
    dof = ((F.col("R") - 1) * (F.col("C") - 1)).cast("double")
    shape = g.select("R", "C").first()
    if correction and shape is not None and shape["R"] == 2 and shape["C"] == 2:
        cells = t.collect()  # exactly the non-empty cells of a 2x2 table: at most 4 rows
        ras = {r["a"]: r["ra"] for r in cells}
        cbs = {r["b"]: r["cb"] for r in cells}
        obs = {(r["a"], r["b"]): r["o"] for r in cells}
        n = sum(ras.values())
        stat = 0.0
        for ka, va in ras.items():
            for kb, vb in cbs.items():
                e = va * vb / n
                d = abs(obs.get((ka, kb), 0.0) - e)
                stat += (d - min(0.5, d)) ** 2 / e
        out = g.select(F.lit(stat).alias("chi2"), dof.alias("dof"))
    else:
        out = g.select((F.col("q") * F.col("N") - F.col("N")).alias("chi2"), dof.alias("dof"))
    return out.withColumn("chi2_pvalue", chi2_pvalue_udf(F.col("chi2"), F.col("dof")))


# ------------------------------------------------------------------ V5-V9 t-tests, ANOVA

def group_moments(df: DataFrame, numeric: str, category: str) -> DataFrame:
    """``category, n, mean, var`` per group (missing pairs dropped)."""
    p = _pair(df, numeric, category, True, False)
    return p.groupBy(F.col("y").alias("category")).agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean"),
                                                        F.var_samp("x").alias("var"))


def _two_groups(g: DataFrame) -> DataFrame:
    """First and second group (sorted by category) side by side, on one row."""
    a = g.agg(F.min_by(F.struct("category", "n", "mean", "var"), "category").alias("g1"),
              F.max_by(F.struct("category", "n", "mean", "var"), "category").alias("g2"),
              F.count(F.lit(1)).alias("k"))
    return a.select(F.col("g1.category").alias("group_1"), F.col("g2.category").alias("group_2"),
                    F.col("g1.n").alias("n1"), F.col("g2.n").alias("n2"), F.col("g1.mean").alias("m1"),
                    F.col("g2.mean").alias("m2"), F.col("g1.var").alias("v1"), F.col("g2.var").alias("v2"), "k")


def ttest_from_groups(g: DataFrame, equal_var: bool = True) -> DataFrame:
    """V5 (pooled) / V6 (Welch) for a two-group moment table: ``group_1, group_2, ttest, df, ttest_pvalue``.

    The sign is group_1 (smaller category) minus group_2."""
    r = _two_groups(g)
    n1, n2, v1, v2 = (F.col(c).cast("double") for c in ("n1", "n2", "v1", "v2"))
    diff = F.col("m1") - F.col("m2")
    if equal_var:
        dof = n1 + n2 - 2
        sp2 = ((n1 - 1) * v1 + (n2 - 1) * v2) / dof
        t = diff / F.sqrt(sp2 * (1 / n1 + 1 / n2))
    else:
        s1, s2 = v1 / n1, v2 / n2
        t = diff / F.sqrt(s1 + s2)
        dof = (s1 + s2) ** 2 / (s1 * s1 / (n1 - 1) + s2 * s2 / (n2 - 1))
    out = r.select("group_1", "group_2", t.alias("ttest"), dof.alias("df"))
    return out.withColumn("ttest_pvalue", t_pvalue_udf(F.col("ttest"), F.col("df")))


def ttest(df: DataFrame, numeric: str, category: str, equal_var: bool = True) -> DataFrame:
    return ttest_from_groups(group_moments(df, numeric, category), equal_var)


def anova_from_groups(g: DataFrame) -> DataFrame:
    """One-way ANOVA over the groups of the table: ``F, df_between, df_within, F_pvalue``."""
    gm = F.lit(g.agg(F.sum(F.col("n") * F.col("mean")) / F.sum("n")).first()[0])  # grand mean: one number
    s = g.agg(F.sum("n").alias("N"), F.count(F.lit(1)).alias("k"),
                        F.sum(F.col("n") * (F.col("mean") - gm) ** 2).alias("ssb"),
                        F.sum(F.coalesce((F.col("n") - 1) * F.col("var"), F.lit(0.0))).alias("ssw"))
    d1, d2 = (F.col("k") - 1).cast("double"), (F.col("N") - F.col("k")).cast("double")
    f = (F.col("ssb") / d1) / (F.col("ssw") / d2)
    out = s.select(f.alias("F"), d1.alias("df_between"), d2.alias("df_within"))
    return out.withColumn("F_pvalue", f_pvalue_udf(F.col("F"), F.col("df_between"), F.col("df_within")))


def anova(df: DataFrame, numeric: str, category: str, valid_only: bool = False) -> DataFrame:
    """V7 (F over all groups) / V8 (F over groups with at least two rows)."""
    g = group_moments(df, numeric, category)
    if valid_only:
        g = g.where(F.col("n") >= 2)
    return anova_from_groups(g)


def pairwise_welch(df: DataFrame, numeric: str, category: str, alpha: float = 0.05, round_to: int = 3) -> DataFrame:
    """V9: Welch t for every pair of valid groups, with the Bonferroni alpha.

    The pair table is groups x groups (the output itself), never rows x rows."""
    g = group_moments(df, numeric, category).where(F.col("n") >= 2)
    a = g.select(*[F.col(c).alias(f"{c}_a") for c in g.columns])
    b = g.select(*[F.col(c).alias(f"{c}_b") for c in g.columns])
    p = a.join(b, F.col("category_a") < F.col("category_b"))
    s1, s2 = F.col("var_a") / F.col("n_a"), F.col("var_b") / F.col("n_b")
    t = (F.col("mean_a") - F.col("mean_b")) / F.sqrt(s1 + s2)
    dof = (s1 + s2) ** 2 / (s1 * s1 / (F.col("n_a") - 1) + s2 * s2 / (F.col("n_b") - 1))
    k = g.agg(F.count(F.lit(1)).alias("k")).scalar()
    out = p.select(F.col("category_a").alias("group_a"), F.col("category_b").alias("group_b"),
                   t.alias("ttest"), dof.alias("df"),
                   F.round(F.lit(alpha) / (k * (k - 1) / 2), round_to).alias("bonferroni_alpha"))
    return out.withColumn("ttest_pvalue", t_pvalue_udf(F.col("ttest"), F.col("df")))


# ------------------------------------------------------------------ V10-V12 summaries

def regression_summary(df: DataFrame, x: str, y: str, round_to: int = 3, with_kendall: bool = True) -> DataFrame:
    """Slope, intercept, Pearson, Spearman, Kendall (+p) and both skews, one row."""
    dt = _dtypes(df)
    for c in (x, y):
        if not (is_numeric(dt[c]) or is_boolean(dt[c])):
            raise TypeError(f"{c} holds no numbers: a regression needs two numeric columns")
    p = _pair(df, x, y)
    lin = p.agg(F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("intercept"),
                F.corr("x", "y").alias("pearson_r"), F.count(F.lit(1)).alias("n"),
                adj_skew("x").alias("skew_1"), adj_skew("y").alias("skew_2"))
    lin = _with_r_test(lin, "pearson_r", "n", "pearson_p")
    sp = spearman(p, "x", "y")
    extra = {"spearman": sp.select("spearman").scalar(), "spearman_p": sp.select("spearman_pvalue").scalar()}
    if with_kendall:
        from churnspark.operators.kendall import kendall_tau
        kd = kendall_tau(p, "x", "y")
        extra.update({"kendall": kd.select("kendalltau").scalar(), "kendall_p": kd.select("kendalltau_pvalue").scalar()})
    out = lin.withColumns(extra)
    cols = [c for c in out.columns if c != "n"]
    return out.select(*[F.round(c, round_to).alias(c) for c in cols])


def bar_summary(df: DataFrame, numeric: str, category: str, alpha: float = 0.05, plot_type: str = "bar"):
    """Group summary, then Welch t (two valid groups) or ANOVA over valid groups plus pairwise Welch."""
    from churnspark.operators.profile import group_summary
    summary = group_summary(df, numeric, category, plot_type)
    g = group_moments(df, numeric, category).where(F.col("n") >= 2)
    k = g.count()  # number of valid groups (one row per category)
    if k < 2:
        raise ValueError(f"{category} has fewer than two groups of two rows or more: nothing to compare")
    if k == 2:
        return summary, ttest_from_groups(g, equal_var=False), None
    return summary, anova_from_groups(g), pairwise_welch(df, numeric, category, alpha)


def heatmap_summary(df: DataFrame, a: str, b: str, axis_sum=None):
    """Contingency counts with shares, and the chi-squared test."""
    from churnspark.operators.profile import contingency_shares
    return contingency_shares(df, a, b, axis_sum), chi2_test(df, a, b)


# ------------------------------------------------------------------ V13 full table

STATISTICS = ["skew", "pearson_pvalue", "r", "y = mx + b", "spearman", "spearman_pvalue", "kendalltau",
              "kendalltau_pvalue", "chi2", "chi2_pvalue", "ttest", "ttest_pvalue", "F", "F_pvalue"]


def _group_cells(df: DataFrame, target: str, numeric: dict[str, bool]) -> DataFrame:
    """``(feature, g, o, n, mean, var)`` of every feature that is not numeric like the target, from one grouped pass.

    g: the category whose groups are compared; o: the target's category where
    both are categorical (then n is the contingency table), else null; mean and
    var: of the numeric side in the group."""
    text = lambda c: F.col(f"`{c}`").cast("string")
    nothing, none = F.lit(None).cast("double"), F.lit(None).cast("string")
    parts = []
    for c, is_number in numeric.items():
        if c == target or (is_number and numeric[target]):
            continue
        g = text(target) if is_number else text(c)
        o = none if is_number or numeric[target] else text(target)
        x = _num(df, c) if is_number else _num(df, target) if numeric[target] else nothing
        parts.append(F.struct(F.lit(c).alias("feature"), g.alias("g"), o.alias("o"), x.alias("x"),
                              (g.isNotNull() & (x.isNotNull() | o.isNotNull())).alias("pair")))
    return (df.select(F.explode(F.array(*parts)).alias("s")).select("s.*").where("pair").groupBy("feature", "g", "o")
              .agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean"), F.var_samp("x").alias("var")))


def _group_summaries(cells: DataFrame) -> dict[str, dict]:
    """Per feature, from the groups alone: counts, the first and last (valid) group, the sums of squares."""
    groups = cells.where("o is null")
    one = F.struct("n", "mean", "var")
    valid = F.col("n") >= 2
    sums = groups.groupBy("feature").agg(
        F.sum("n").alias("N"), F.count(F.lit(1)).alias("k"), F.count_if(valid).alias("k_valid"),
        (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("grand"),
        F.sum(F.coalesce((F.col("n") - 1) * F.col("var"), F.lit(0.0))).alias("ssw"),
        F.min_by(one, "g").alias("first"), F.max_by(one, "g").alias("last"),
        F.min_by(F.when(valid, one), F.when(valid, F.col("g"))).alias("first_valid"),
        F.max_by(F.when(valid, one), F.when(valid, F.col("g"))).alias("last_valid"))
    out = {r["feature"]: r.asDict() for r in sums.collect()}  # one row per column
    if out:
        grand = F.broadcast(cells.sparkSession.createDataFrame([(f, r["grand"]) for f, r in out.items()], "feature string, grand double"))
        away = F.col("n") * (F.col("mean") - F.col("grand")) ** 2
        for r in groups.join(grand, "feature").groupBy("feature").agg(F.sum(away).alias("ssb")).collect():
            out[r["feature"]]["ssb"] = r["ssb"]
    return out


def _contingency_summaries(cells: DataFrame) -> dict[str, dict]:
    """Per feature: N, rows R, columns C, q = sum(o^2 / (row * column)) and the sums of 1 / margin."""
    table = cells.where("o is not null").select("feature", "g", "o", F.col("n").cast("double").alias("n"))
    row = table.groupBy("feature", "g").agg(F.sum("n").alias("r"))
    column = table.join(row, ["feature", "g"]).groupBy("feature", "o").agg(F.sum(F.col("n") * F.col("n") / F.col("r")).alias("s"),
                                                                            F.sum("n").alias("c"))
    by_column = column.groupBy("feature").agg(F.sum("c").alias("N"), F.count(F.lit(1)).alias("C"), F.sum(F.col("s") / F.col("c")).alias("q"),
                                              F.sum(1 / F.col("c")).alias("by_c"))
    by_row = row.groupBy("feature").agg(F.count(F.lit(1)).alias("R"), F.sum(1 / F.col("r")).alias("by_r"))
    return {r["feature"]: r.asDict() for r in by_column.join(by_row, "feature").collect()}  # one row per column


def chi2_of(t: dict) -> tuple[float, float]:
    """Chi-squared and its degrees of freedom from a contingency summary.

    In a 2x2 table all four cells are off by the same d, and the statistic is
    d^2 N by_r by_c; Yates's correction takes up to 1/2 off d."""
    stat, dof = t["q"] * t["N"] - t["N"], (t["R"] - 1) * (t["C"] - 1)
    if t["R"] == t["C"] == 2:
        unit = t["N"] * t["by_r"] * t["by_c"]
        d = math.sqrt(max(stat, 0.0) / unit)
        stat = (d - min(0.5, d)) ** 2 * unit
    return stat, float(dof)


def pooled_t(a, b) -> tuple[float, float]:
    """t and degrees of freedom of two groups ``(n, mean, var)``."""
    dof = a["n"] + b["n"] - 2
    if dof <= 0:
        return math.nan, float(dof)
    pooled = ((a["n"] - 1) * (a["var"] or 0.0) + (b["n"] - 1) * (b["var"] or 0.0)) / dof
    spread = math.sqrt(pooled * (1 / a["n"] + 1 / b["n"]))
    diff = a["mean"] - b["mean"]
    return (diff / spread if spread else math.copysign(math.inf, diff) if diff else math.nan), float(dof)


def f_of(g: dict) -> tuple[float, float, float]:
    """F and its degrees of freedom over all groups of a summary."""
    between, within = g["k"] - 1, g["N"] - g["k"]
    if between <= 0 or within <= 0:
        return math.nan, float(between), float(within)
    left, right = g["ssb"] / between, g["ssw"] / within
    return (left / right if right else math.inf if left else math.nan), float(between), float(within)


def _compared(is_number: bool, target_number: bool, n: int, u: int, groups: dict | None, table: dict | None) -> dict[str, float]:
    """The statistics of one feature that is not numeric like the target, by the reference's order of rules."""
    if n < 2 or u == 1:
        return {}
    if table is not None:
        stat, dof = chi2_of(table)
        return {"chi2": stat, "chi2_pvalue": dist.chi2_upper(stat, dof)}
    two, k = None, groups["k"]
    if k == 2:
        two = groups["first"], groups["last"]
    elif k == n or groups["k_valid"] < 2:
        return {}
    elif groups["k_valid"] == 2:
        two = groups["first_valid"], groups["last_valid"]
    out = {} if target_number and k == 2 else {"skew": None}  # None: filled in by the caller
    if two:
        t, dof = pooled_t(*two)
        return {**out, "ttest": t, "ttest_pvalue": dist.t_two_sided(t, dof)}
    f, between, within = f_of(groups)
    return {**out, "F": f, "F_pvalue": dist.f_upper(f, between, within)}


def bivariate_table(df: DataFrame, target: str, round_to: int = 3, with_kendall: bool = True) -> DataFrame:
    """One row per feature with the statistic family chosen by the types.

    Columns: ``feature, missing (%), type, unique_values, skew, pearson_pvalue,
    r, y = mx + b, spearman, spearman_pvalue, kendalltau, kendalltau_pvalue,
    chi2, chi2_pvalue, ttest, ttest_pvalue, F, F_pvalue``.  The number of jobs
    does not depend on the number of features: one grouped pass makes the
    group moments and contingency tables of all of them, one counts distinct
    numbers, one aggregate gives counts and skews; numeric pairs share theirs.
    """
    from churnspark.operators.profile import pandas_dtype
    dt = _dtypes(df)
    numeric = {c: is_numeric(dt[c]) or is_boolean(dt[c]) for c in df.columns}
    feats = [c for c in df.columns if c != target]
    spark = df.sparkSession
    side = {c: _num(df, c) if numeric[c] else F.col(f"`{c}`").cast("string") for c in df.columns}
    paired = {c: side[c].isNotNull() & side[target].isNotNull() for c in feats}
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(feats):
        aggs.append(F.count_if(paired[c]).alias(f"n{i}"))
        if numeric[c] != numeric[target]:
            aggs.append(adj_skew(F.when(paired[c], side[c] if numeric[c] else side[target])).alias(f"s{i}"))
    counts = df.agg(*aggs).first()
    numbers = [c for c in feats if numeric[c]]
    unique = {}
    if numbers:  # exact, as it is a column of the result
        values = F.explode(F.array(*[F.struct(F.lit(c).alias("f"), F.when(paired[c], side[c]).alias("v")) for c in numbers]))
        per = df.select(values.alias("s")).select("s.*").where("v is not null").groupBy("f", "v").agg(F.lit(1).alias("one"))
        unique = {r["f"]: r["u"] for r in per.groupBy("f").agg(F.count(F.lit(1)).alias("u")).collect()}
    groups, tables = {}, {}
    if any(not (numeric[c] and numeric[target]) for c in feats):
        cells = scratch_table(_group_cells(df, target, numeric), "bivariate-cells")
        groups, tables = _group_summaries(cells), _contingency_summaries(cells)
        drop_scratch(cells)
    rows, both = [], []
    for i, c in enumerate(feats):
        n = counts[f"n{i}"]
        u = unique.get(c, 0) if numeric[c] else tables[c]["R"] if c in tables else groups[c]["k"] if c in groups else 0
        found: dict = {}
        if numeric[c] and numeric[target]:
            if n >= 2 and u != 1:
                both.append(c)
        elif c in groups or c in tables:
            found = _compared(numeric[c], numeric[target], n, u, groups.get(c), tables.get(c))
            if "skew" in found:
                found["skew"] = counts[f"s{i}"]
        missing = (counts["rows"] - n) / counts["rows"] * 100 if counts["rows"] else None
        rows.append((c, missing, pandas_dtype(dt[c]), int(u), *[found.get(s) for s in STATISTICS]))
    kinds = ", ".join(f"`{s}` {'string' if s == 'y = mx + b' else 'double'}" for s in STATISTICS)
    out = spark.createDataFrame(rows, f"feature string, missing double, type string, unique_values bigint, {kinds}")
    rounded = [s for s in ("missing", *STATISTICS) if s != "y = mx + b"]
    out = out.withColumns({s: F.round(F.when(~F.isnan(s), F.col(s)), round_to) for s in rounded})
    if both:
        block = _numeric_block(df, target, both, round_to, with_kendall)
        own = block.columns[1:]
        block = block.select("feature", *[F.col(f"`{s}`").alias(f"of {s}") for s in own])
        out = out.join(block, "feature", "left").select(
            "feature", "missing", "type", "unique_values",
            *[F.coalesce(F.col(f"`of {s}`"), F.col(f"`{s}`")).alias(s) if s in own else F.col(f"`{s}`") for s in STATISTICS])
    return out


def _numeric_block(df, target, feats, round_to, with_kendall):
    """All numeric-numeric features at once: Pearson/regression and skew in one aggregate,
    Spearman in one pipeline, Kendall in one keyed set of running sums."""
    from churnspark.operators.kendall import kendall_many
    y = _num(df, target)
    pe = pearson_table(df, target, feats)
    sk_row = df.agg(*[adj_skew(F.when(y.isNotNull(), _num(df, f))).alias(f"k{i}") for i, f in enumerate(feats)])
    sk = sk_row.select(F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"k{i}").alias("skew"))
                                          for i, f in enumerate(feats)])).alias("s")).select("s.*")
    out = pe.join(sk, "feature").join(spearman_many(df, target, feats).drop("n"), "feature")
    if with_kendall:
        out = out.join(kendall_many(df, target, feats).drop("n"), "feature")
    else:
        out = out.withColumns({"kendalltau": F.lit(None).cast("double"), "kendalltau_pvalue": F.lit(None).cast("double")})
    r = lambda c: F.round(c, round_to)
    return out.select("feature", r("skew").alias("skew"), r("pearson_pvalue").alias("pearson_pvalue"), r("r").alias("r"),
                      F.concat(F.lit("y = "), r("slope").cast("string"), F.lit("x + "), r("intercept").cast("string")).alias("y = mx + b"),
                      r("spearman").alias("spearman"), r("spearman_pvalue").alias("spearman_pvalue"),
                      r("kendalltau").alias("kendalltau"), r("kendalltau_pvalue").alias("kendalltau_pvalue"))
