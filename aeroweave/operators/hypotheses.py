"""Tests of group differences: Welch's t, analysis of variance, chi-square."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroweave.functions.special import chi_square_p_value, f_p_value, t_p_value


def known_p(p: Column) -> Column:
    """Null in place of the NaN that a tail gives for unknown arguments."""
    return F.when(~F.isnan(p), p)


def group_moments(df: DataFrame, measures, group: str, by=()) -> DataFrame:
    """measure, group, n, mean, squares (sum of squared deviations), varies: one pass, a row per task, measure and group.

    Unknown values, NaN and unknown groups are left out.
    """
    cells = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("v")) for m in measures])
    long = df.filter(F.col(group).isNotNull()).select(*by, F.col(group).alias("group"), F.explode(cells).alias("_c")).select(*by, "group", "_c.*")
    known = long.filter(F.col("v").isNotNull() & ~F.isnan("v"))
    return known.groupBy(*by, "measure", "group").agg(
        F.count("*").alias("n"), F.avg("v").alias("mean"), (F.var_pop("v") * F.count("*")).alias("squares"),
        F.min("v").alias("lowest"), F.max("v").alias("highest")).select(
        *by, "measure", "group", "n", "mean", F.when(F.col("lowest") < F.col("highest"), F.col("squares")).otherwise(0.0).alias("squares"),
        "lowest", "highest")


def t_tests(df: DataFrame, measures, group: str, first, second, by=()) -> DataFrame:
    """measure, difference, statistic, freedom, n_first, n_second, p_value: Welch's test of two groups' means.

    Null statistics where a group has fewer than two values or neither varies.
    """
    moments = group_moments(df.filter(F.col(group).isin(first, second)), measures, group, by)
    side = lambda value, c: F.max(F.when(F.col("group") == value, F.col(c)))
    both = moments.groupBy(*by, "measure").agg(*[
        side(value, c).alias(f"{c}_{name}") for name, value in (("first", first), ("second", second)) for c in ("n", "mean", "squares")])
    error = lambda s: F.when(F.col(f"n_{s}") > 1, F.col(f"squares_{s}") / (F.col(f"n_{s}") - 1) / F.col(f"n_{s}"))
    both = both.withColumns({"_a": error("first"), "_b": error("second"), "difference": F.col("mean_first") - F.col("mean_second")})
    whole = F.col("_a") + F.col("_b")
    freedom = F.try_divide(whole * whole, F.col("_a") * F.col("_a") / (F.col("n_first") - 1) + F.col("_b") * F.col("_b") / (F.col("n_second") - 1))
    count = lambda s: F.coalesce(f"n_{s}", F.lit(0)).cast("bigint").alias(f"n_{s}")
    tested = both.select(
        *by, "measure", "difference", F.try_divide("difference", F.sqrt(whole)).alias("statistic"), freedom.alias("freedom"),
        count("first"), count("second"))
    return tested.withColumn("p_value", known_p(t_p_value("statistic", "freedom")))


def anova(df: DataFrame, measures, group: str, by=()) -> DataFrame:
    """measure, statistic, between, within (degrees of freedom), eta_squared, groups, n, p_value: one-way analysis of variance.

    Null statistics with fewer than two groups, without degrees of freedom within them, or where nothing varies within any group.
    """
    moments = group_moments(df, measures, group, by)
    totals = moments.groupBy(*by, "measure").agg(
        F.count("*").alias("groups"), F.sum("n").alias("n"), F.sum("squares").alias("_within"),
        F.sum(F.col("n") * F.col("mean")).alias("_nm"),
        F.collect_list(F.struct("n", "mean")).alias("_means"))
    grand = F.col("_nm") / F.col("n")
    squares = F.aggregate("_means", F.lit(0.0), lambda a, g: a + g["n"] * (g["mean"] - grand) * (g["mean"] - grand))
    tested = totals.withColumns({
        "_between": squares, "between": F.col("groups") - 1, "within": F.col("n") - F.col("groups")})
    can = (F.col("between") > 0) & (F.col("within") > 0) & (F.col("_within") > 0)
    statistic = F.when(can, (F.col("_between") / F.col("between")) / F.try_divide("_within", "within"))
    return tested.select(
        *by, "measure", statistic.alias("statistic"), "between", "within",
        F.try_divide(F.col("_between"), F.col("_between") + F.col("_within")).alias("eta_squared"), "groups", "n",
    ).withColumn("p_value", known_p(f_p_value("statistic", F.col("between").cast("double"), F.col("within").cast("double"))))


def chi_square_tests(df: DataFrame, pairs, by=()) -> DataFrame:
    """a, b, statistic, freedom, cramers_v, n, p_value: independence of pairs of categorical columns.

    Rows that do not know both are left out. Empty cells of the table count; they are not listed, since their share is what the
    expected counts of the other cells leave. Null statistics with fewer than two categories on a side.
    """
    cells = F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(a).cast("string").alias("va"), F.col(b).cast("string").alias("vb")) for a, b in pairs])
    long = df.select(*by, F.explode(cells).alias("_c")).select(*by, "_c.*").dropna(subset=["va", "vb"])
    counts = long.groupBy(*by, "a", "b", "va", "vb").agg(F.count("*").alias("o"))
    on = [*by, "a", "b"]
    rows = counts.groupBy(*on, "va").agg(F.sum("o").alias("r"))
    columns = counts.groupBy(*on, "vb").agg(F.sum("o").alias("c"))
    sizes = rows.groupBy(*on).agg(F.count("*").alias("nr"), F.sum("r").alias("n"))
    sizes = sizes.join(columns.groupBy(*on).agg(F.count("*").alias("nc")), on)
    filled = counts.join(rows, [*on, "va"]).join(columns, [*on, "vb"]).join(sizes, on)
    expected = F.col("r") * F.col("c").cast("double") / F.col("n")
    seen = filled.withColumn("e", expected).groupBy(*on, "nr", "nc", "n").agg(
        F.sum((F.col("o") - F.col("e")) * (F.col("o") - F.col("e")) / F.col("e")).alias("_seen"), F.sum("e").alias("_e"))
    smaller = F.least("nr", "nc") - 1
    statistic = F.when(smaller > 0, F.col("_seen") + F.greatest(F.col("n") - F.col("_e"), F.lit(0.0)))
    return seen.select(
        *on, statistic.alias("statistic"), ((F.col("nr") - 1) * (F.col("nc") - 1)).alias("freedom"),
        F.sqrt(F.try_divide(statistic, F.col("n") * smaller)).alias("cramers_v"), "n",
    ).withColumn("p_value", known_p(chi_square_p_value("statistic", F.col("freedom").cast("double"))))


def group_tests(df: DataFrame, measures, group: str, by=()) -> DataFrame:
    """measure, test, a, b, statistic, freedom, p_value: analysis of variance over all groups, and Welch's test of each two.

    Pairs come from the table of moments, which has one row per group: so many pairs as the groups that are compared.
    """
    moments = group_moments(df, measures, group, by)
    on = [*by, "measure"]
    error = F.when(F.col("n") > 1, F.col("squares") / (F.col("n") - 1) / F.col("n"))
    listed = moments.select(*on, F.col("group").cast("string").alias("g"), "n", "mean", error.alias("e"))
    each = listed.groupBy(*on).agg(F.sort_array(F.collect_list(F.struct("g", "n", "mean", "e"))).alias("gs"))
    # all groups of a measure in one row, whose pairs are formed in place
    pairs = each.select(*on, "gs", F.posexplode("gs").alias("i", "x")).select(
        *on, "x", F.explode(F.slice("gs", F.col("i") + 2, F.size("gs"))).alias("y"))
    whole = F.col("x.e") + F.col("y.e")
    part = lambda s: F.col(f"{s}.e") * F.col(f"{s}.e") / (F.col(f"{s}.n") - 1)
    two = pairs.select(
        *on, F.lit("t").alias("test"), F.col("x.g").alias("a"), F.col("y.g").alias("b"),
        F.try_divide(F.col("x.mean") - F.col("y.mean"), F.sqrt(whole)).alias("statistic"),
        F.try_divide(whole * whole, F.when(F.col("x.n") > 1, part("x")) + F.when(F.col("y.n") > 1, part("y"))).alias("freedom"))
    two = two.withColumn("p_value", known_p(t_p_value("statistic", "freedom")))
    none = F.lit(None).cast("string")
    all_groups = anova(df, measures, group, by).select(
        *on, F.lit("anova").alias("test"), none.alias("a"), none.alias("b"), "statistic", F.col("within").cast("double").alias("freedom"), "p_value")
    return all_groups.unionByName(two)
