"""Comparing distributions: two-sample Kolmogorov-Smirnov, fits by AIC, analysis of variance."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def kolmogorov(d: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sided p-value of the statistic."""
    e = F.sqrt(n * m / (n + m))
    x = (e + F.lit(0.12) + F.lit(0.11) / e) * d
    term = lambda k: F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * x * x)
    p = 2 * F.aggregate(F.sequence(F.lit(1), F.lit(50)), F.lit(0.0), lambda total, k: total + term(k))
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.when(x < 0.2, 1.0).otherwise(p)))


def ks_two_sample(df: DataFrame, group: str, side: str, value: str, least: int = 5) -> DataFrame:
    """AGG6: df(group, side in ('a','b'), value): the largest distance of the two distributions in each group.

    Values meet as counts per distinct value, so a window holds distinct values, not rows. Ties share a
    value and count together. Fewer than ``least`` rows on a side: insufficient_data.
    """
    per = df.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.sum((F.col(side) == "a").cast("bigint")).alias("na"), F.sum((F.col(side) == "b").cast("bigint")).alias("nb"))
    upto = Window.partitionBy(group).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy(group)
    steps = per.select(group, F.sum("na").over(upto).alias("ca"), F.sum("nb").over(upto).alias("cb"), F.sum("na").over(every).alias("n"), F.sum("nb").over(every).alias("m"))
    gap = F.abs(F.col("ca") / F.greatest("n", F.lit(1)) - F.col("cb") / F.greatest("m", F.lit(1)))
    d = steps.groupBy(group).agg(F.max(gap).alias("d"), F.max("n").alias("n"), F.max("m").alias("m"))
    enough = (F.col("n") >= least) & (F.col("m") >= least)
    p = kolmogorov(F.col("d"), F.col("n").cast("double"), F.col("m").cast("double"))
    band = F.when(~enough, "insufficient_data").when(p > 0.10, "good").when(p > 0.05, "acceptable").when(p > 0.01, "marginal").otherwise("poor")
    return d.select(group, F.col("n").alias("n_a"), F.col("m").alias("n_b"), F.when(enough, F.round("d", 4)).alias("ks_statistic"), F.when(enough, F.round(p, 4)).alias("p_value"), band.alias("verdict"))


def normal_cdf(z: Column) -> Column:
    """Standard normal distribution function by a rational approximation (error below 1e-7)."""
    t = 1 / (1 + 0.2316419 * F.abs(z))
    tail = 0.3989422804014327 * F.exp(-z * z / 2) * t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.when(z >= 0, 1 - tail).otherwise(tail)


def fit_ks(df: DataFrame, group: str, value: str, least: int = 10) -> DataFrame:
    """AGG7: one-sample Kolmogorov-Smirnov distance of the positive values to each fit. The window holds distinct values, not rows."""
    x = F.col(value).cast("double")
    per = df.where(x > 0).groupBy(group, x.alias("x")).agg(F.count("*").alias("k"))
    every = Window.partitionBy(group)
    upto = F.sum("k").over(every.orderBy("x").rowsBetween(Window.unboundedPreceding, 0))
    n, k = F.sum("k").over(every), F.col("k")
    mean, log_mean = F.sum(F.col("x") * k).over(every) / n, F.sum(F.log("x") * k).over(every) / n
    steps = per.select(group, "x", "k", upto.alias("c"), n.alias("n"), mean.alias("m"), log_mean.alias("lm"))
    steps = steps.select("*", F.sqrt(F.sum((F.col("x") - F.col("m")) ** 2 * k).over(every) / F.col("n")).alias("sd"), F.sqrt(F.sum((F.log("x") - F.col("lm")) ** 2 * k).over(every) / F.col("n")).alias("lsd"))
    tiny = F.lit(1e-300)

    def gap(z: Column) -> Column:
        p = normal_cdf(z)
        return F.max(F.greatest(F.abs(F.col("c") / F.col("n") - p), F.abs((F.col("c") - k) / F.col("n") - p)))

    own = steps.groupBy(group).agg(F.max("n").alias("n"), gap((F.col("x") - F.col("m")) / F.greatest("sd", tiny)).alias("a"), gap((F.log("x") - F.col("lm")) / F.greatest("lsd", tiny)).alias("b"))
    return own.where(F.col("n") >= least).select(group, F.round("a", 4).alias("ks_normal"), F.round("b", 4).alias("ks_lognormal"))


def fit_lengths(df: DataFrame, group: str, value: str, least: int = 10) -> DataFrame:
    """AGG7: normal against lognormal by AIC from the moments, for positive values."""
    x = F.col(value).cast("double")
    s = df.where(x > 0).groupBy(group).agg(F.count("*").alias("n"), F.avg(x).alias("mean"), F.stddev_pop(x).alias("sd"), F.avg(F.log(x)).alias("log_mean"), F.stddev_pop(F.log(x)).alias("log_sd")).where(F.col("n") >= least)
    half = F.lit(0.5 * math.log(2 * math.pi) + 0.5)

    def aic(sd: Column, extra: Column) -> Column:
        return 4 + 2 * F.col("n") * (half + F.log(F.greatest(sd, F.lit(1e-300)))) + 2 * F.col("n") * extra

    normal, log_normal = aic(F.col("sd"), F.lit(0.0)), aic(F.col("log_sd"), F.col("log_mean"))
    return s.select(group, "n", F.round(normal, 2).alias("aic_normal"), F.round(log_normal, 2).alias("aic_lognormal"), F.when(log_normal < normal, "lognormal").otherwise("normal").alias("best_fit"))


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (Lentz)."""
    tiny, c = 1e-300, 1.0
    d = 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    out = d
    for m in range(1, 300):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + num * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + num / c
            c = c if abs(c) > tiny else tiny
            out *= d * c
        if abs(d * c - 1) < 1e-12:
            break
    return out


def f_upper_tail(f: float, df1: float, df2: float) -> float:
    """P(F > f): the closed form on two degrees of freedom, computed once on the driver."""
    if not f > 0:
        return 1.0
    x, a, b = df2 / (df2 + df1 * f), df2 / 2, df1 / 2
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    return front * _beta_fraction(a, b, x) / a if x < (a + 1) / (a + b + 2) else 1 - front * _beta_fraction(b, a, 1 - x) / b


def _anova_p(f: pd.Series, df1: pd.Series, df2: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(x) else f_upper_tail(float(x), float(a), float(b)) for x, a, b in zip(f, df1, df2)], dtype=object)


def anova(df: DataFrame, group: str, value: str) -> DataFrame:
    """AGG5: one-way analysis of variance from n, mean and variance of each group; rows without a group are left out."""
    g = df.where(F.col(group).isNotNull() & F.col(value).isNotNull()).groupBy(group).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.coalesce(F.var_pop(value), F.lit(0.0)).alias("v"))
    r = g.agg(F.sum("n").alias("n"), F.count("*").alias("k"), F.sum(F.col("n") * F.col("mean")).alias("s"), F.sum(F.col("n") * F.col("mean") * F.col("mean")).alias("q"), F.sum(F.col("n") * F.col("v")).alias("within"))
    between = F.col("q") - F.col("s") * F.col("s") / F.col("n")
    df1, df2 = F.col("k") - 1, F.col("n") - F.col("k")
    f = F.when((df1 > 0) & (df2 > 0) & (F.col("within") > 0), (between / df1) / (F.col("within") / df2))
    return r.select(df1.alias("df_between"), df2.alias("df_within"), F.round(between, 4).alias("ss_between"), F.round("within", 4).alias("ss_within"), F.round(f, 4).alias("f_statistic"), F.round(F.pandas_udf(_anova_p, "double")(f, df1, df2), 6).alias("p_value"))
