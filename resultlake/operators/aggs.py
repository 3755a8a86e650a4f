"""Aggregations: counts, moments, sufficient statistics, errors and classification metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from resultlake.functions.columns import finite
from resultlake.operators.shape import attach
from resultlake.operators.windows import avg_rank, quantiles, ranked


def counts(df: DataFrame, by: list[str]) -> DataFrame:
    """Rows of each group, the most first; ties by the group."""
    return df.groupBy(*by).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *by)


def split_counts(df: DataFrame, date: str, cutoff: str) -> DataFrame:
    """Count, first and last date by year and by side of a cutoff."""
    d = F.col(date).cast("date")
    return df.groupBy(F.year(d).alias("year"), (d >= F.lit(cutoff).cast("date")).alias("is_test")).agg(F.count("*").alias("n"), F.min(d).alias("first_date"), F.max(d).alias("last_date"))


def window_counts(df: DataFrame, date: str, n: int = 1) -> DataFrame:
    """Count and last date by windows of ``n`` months, from counts by month."""
    d = F.col(date).cast("date")
    month = df.groupBy(F.trunc(d, "month").alias("month")).agg(F.count("*").alias("n"), F.max(d).alias("last_date"))
    if n == 1:
        return month
    from resultlake.functions.columns import window_of

    start, _ = window_of("month", "month", n)
    return month.groupBy(start.alias("month")).agg(F.sum("n").alias("n"), F.max("last_date").alias("last_date"))


def conditional_counts(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """One row with the count of each condition, in a single pass."""
    return df.agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])


def distinct_counts(df: DataFrame, by: list[str], columns: dict[str, list[str]]) -> DataFrame:
    """Exact distinct counts of columns or of combinations for each group."""
    return df.groupBy(*by).agg(*[F.count_distinct(*c).alias(name) for name, c in columns.items()])


def quantile(x: Column | str, q: float | list[float], exact: bool = True) -> Column:
    """Quantiles by linear interpolation, which hold a group's distinct values in memory; approximate ones, to one part in 10,000, do not."""
    q = F.lit(q) if isinstance(q, float) else F.array(*map(F.lit, q))
    return F.percentile(x, q) if exact else F.percentile_approx(x, q, 10_000)


def moments(df: DataFrame, by: list[str], column: str, exact: bool = True) -> DataFrame:
    """n, mean, deviation with ddof 1 and 0, and median of finite values.

    The exact median is found without holding a group's values in one task; the other is
    approximate and takes one pass.
    """
    x = finite(column)
    measures = [F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.stddev_pop(x).alias("std_pop")]
    if not exact:
        return df.groupBy(*by).agg(*measures, quantile(x, 0.5, False).alias("median"))
    middle = quantiles(df.select(*by, x.alias("__x")), by, "__x", [0.5])
    return _beside(df.groupBy(*by).agg(*measures), middle, by).withColumn("median", F.get("p", 0)).drop("p")


def _beside(a: DataFrame, b: DataFrame, by: list[str]) -> DataFrame:
    """Groups of ``a`` with ``p`` of ``b``; null keys are keys."""
    if not by:
        return attach(a, b.select("p"))
    on = reduce(lambda x, y: x & y, [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in by])
    return a.alias("x").join(b.alias("y"), on, "left").select("x.*", "y.p")


def latest(df: DataFrame, key: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """The last values of each key by an order."""
    return df.groupBy(*key).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("__v")).select(*key, "__v.*")


def two_members(df: DataFrame, key: list[str], order: str, columns: list[str]) -> DataFrame:
    """The first and the last member of each group side by side, as name_1 and name_2; a single one has no second."""
    s = F.struct(*columns)
    g = df.groupBy(*key).agg(F.min_by(s, order).alias("a"), F.max_by(s, order).alias("b"), F.min(order).alias("lo"), F.max(order).alias("hi"))
    second = F.col("hi") > F.col("lo")
    return g.select(*key, *[F.col(f"a.{c}").alias(f"{c}_1") for c in columns], *[F.when(second, F.col(f"b.{c}")).alias(f"{c}_2") for c in columns])


def modal(df: DataFrame, by: list[str], column: str, stat: str) -> DataFrame:
    """The most common value of each group, ties by value, with the deviation of ``stat`` among its rows."""
    per = df.filter(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count("*").alias("n"), F.stddev_samp(stat).alias("stat_std"))
    w = Window.partitionBy(*by).orderBy(F.desc("n"), column)
    return per.withColumn("__r", F.row_number().over(w)).filter("__r = 1").drop("__r")


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls of each column, one row (A10)."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def suff_stats(df: DataFrame, by: list[str], s: str, y: str) -> DataFrame:
    """n and sums of s, y, sy, s², y² over rows in which both are finite."""
    a, b = finite(s), finite(y)
    ok = df.select(*by, a.alias("__s"), b.alias("__y")).dropna(subset=["__s", "__y"])
    x, z = F.col("__s"), F.col("__y")
    return ok.groupBy(*by).agg(F.count("*").alias("n"), F.sum(x).alias("s1"), F.sum(z).alias("y1"), F.sum(x * z).alias("sy"), F.sum(x * x).alias("s2"), F.sum(z * z).alias("y2"))


def normal_equations(df: DataFrame, xs: list[str], y: str) -> DataFrame:
    """One row with the sums of x_i x_j and x_i y, the constant included as x0."""
    cols = {"x0": F.lit(1.0)} | {f"x{i}": finite(c) for i, c in enumerate(xs, 1)}
    ok = df.select(*[c.alias(k) for k, c in cols.items()], finite(y).alias("y")).dropna()
    k = list(cols)
    pairs = [(a, b) for i, a in enumerate(k) for b in k[i:]]
    return ok.agg(*[F.sum(F.col(a) * F.col(b)).alias(f"{a}{b}") for a, b in pairs], *[F.sum(F.col(a) * F.col("y")).alias(f"{a}y") for a in k], F.count("*").alias("n"))


def simple_line(df: DataFrame, x: str, y: str, by: list[str] | None = None) -> DataFrame:
    """Slope and intercept of the regression of y on x."""
    a, b = finite(x), finite(y)
    return df.groupBy(*(by or [])).agg(F.regr_slope(b, a).alias("slope"), F.regr_intercept(b, a).alias("intercept"), F.regr_count(b, a).alias("n"))


def pearson(df: DataFrame, x: str, y: str, by: list[str] | None = None) -> DataFrame:
    """Correlation of finite pairs; null with fewer than three or a constant side."""
    ok = df.select(*(by or []), finite(x).alias("__x"), finite(y).alias("__y")).dropna(subset=["__x", "__y"])
    g = ok.groupBy(*(by or [])).agg(F.count("*").alias("n"), F.corr("__x", "__y").alias("r"), F.stddev_pop("__x").alias("__a"), F.stddev_pop("__y").alias("__b"))
    return g.withColumn("r", F.when((F.col("n") >= 3) & (F.col("__a") > 0) & (F.col("__b") > 0), F.col("r"))).drop("__a", "__b")


def spearman(df: DataFrame, by: list[str], x: str, y: str, small_groups: bool = True) -> DataFrame:
    """Rank correlation of each group, ties by mean rank.

    Groups such as sections fit a task each; for groups of any size ``small_groups`` is False.
    """
    ok = df.select(*by, finite(x).alias("__x"), finite(y).alias("__y")).dropna(subset=["__x", "__y"])
    if small_groups:
        both = ok.withColumns({"__rx": avg_rank(by, "__x"), "__ry": avg_rank(by, "__y")})
    else:
        both = ranked(ranked(ok, by, "__x", "__rx"), by, "__y", "__ry")
    return pearson(both, "__rx", "__ry", by).withColumnRenamed("r", "spearman")


def errors(df: DataFrame, y: str, yhat: str, by: list[str] | None = None) -> DataFrame:
    """MAE, RMSE, bias and ratio of variances."""
    e = F.col(yhat) - F.col(y)
    return df.groupBy(*(by or [])).agg(F.count(e).alias("n"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(e).alias("bias"), F.try_divide(F.var_pop(yhat), F.var_pop(y)).alias("variance_ratio"))


def coverage(df: DataFrame, y: str, yhat: str, half: Column, by: list[str] | None = None) -> DataFrame:
    """Share of rows whose value is within ``half`` of the prediction."""
    return df.groupBy(*(by or [])).agg(F.avg((F.abs(F.col(y) - F.col(yhat)) <= half).cast("double")).alias("coverage"))


def having(df: DataFrame, by: list[str], least: int) -> DataFrame:
    """Groups of ``least`` rows or more."""
    return df.groupBy(*by).agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def player_scores(df: DataFrame, player, seats: dict[str, str], score: str, session: str) -> DataFrame:  # noqa: ANN001
    """Mean score of a player by session: {seat column: 'NS' or 'EW'}; EW scores are 1 - score."""
    seat = F.coalesce(*[F.when(F.col(c) == player, F.lit(side)) for c, side in seats.items()])
    own = F.when(seat == "NS", F.col(score)).when(seat == "EW", 1 - F.col(score))
    return df.withColumn("__own", own).filter("__own IS NOT NULL").groupBy(session).agg(F.avg("__own").alias("score"), F.count("*").alias("boards"))


def class_counts(df: DataFrame, y: str, classes: DataFrame) -> DataFrame:
    """Rows of each class of a list, 0 for those without."""
    n = df.groupBy(y).agg(F.count("*").alias("n"))
    return classes.join(n, y, "left").withColumn("n", F.coalesce("n", F.lit(0)))


def classification_metrics(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """Accuracy, share of the largest class and mean F1 of the classes, from confusion counts."""
    pairs = df.groupBy(F.col(y).alias("t"), F.col(yhat).alias("p")).agg(F.count("*").alias("n"))
    sides = pairs.select(F.explode(F.array(F.struct(F.col("t").alias("c"), F.col("n").alias("true"), F.lit(0).cast("long").alias("pred"), F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(0).alias("hit")), F.struct(F.col("p").alias("c"), F.lit(0).cast("long").alias("true"), F.col("n").alias("pred"), F.lit(0).cast("long").alias("hit")))).alias("s")).select("s.*")
    per = sides.groupBy("c").agg(F.sum("true").alias("true"), F.sum("pred").alias("pred"), F.sum("hit").alias("hit"))
    f1 = F.when(F.col("true") + F.col("pred") > 0, 2.0 * F.col("hit") / (F.col("true") + F.col("pred"))).otherwise(0.0)
    return per.agg((F.sum("hit") / F.sum("true")).alias("accuracy"), (F.max("true") / F.sum("true")).alias("majority"), F.avg(f1).alias("macro_f1"), F.sum("true").alias("n"))


def distributions(df: DataFrame, columns: list[str], exact: bool = True) -> DataFrame:
    """n, mean, deviation and p10, p25, p50, p75, p90 of each measure, one row for each.

    Exact quantiles are found without holding a measure's values in one task; the others are
    approximate and take one pass.
    """
    at = [0.1, 0.25, 0.5, 0.75, 0.9]
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("measure"), finite(c).alias("v")) for c in columns])).alias("m")).select("m.*")
    measures = [F.count("v").alias("n"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std")]
    if exact:
        g = _beside(long.groupBy("measure").agg(*measures), quantiles(long, ["measure"], "v", at), ["measure"])
    else:
        g = long.groupBy("measure").agg(*measures, quantile("v", at, False).alias("p"))
    return g.select("measure", "n", "mean", "std", *[F.get("p", i).alias(f"p{q}") for i, q in enumerate((10, 25, 50, 75, 90))])


def bucket_confusion(df: DataFrame, y: str, yhat: str, bucket) -> DataFrame:  # noqa: ANN001
    """Shares of predicted buckets among the rows of each actual bucket; ``bucket`` maps a column to one."""
    n = df.groupBy(bucket(F.col(y)).alias("actual"), bucket(F.col(yhat)).alias("predicted")).agg(F.count("*").alias("n"))
    return n.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("actual")))


def contract_bucket(c: Column) -> Column:
    """pass, part, game or slam of a contract such as 4SN."""
    level = F.coalesce(F.substring(c, 1, 1).try_cast("int"), F.lit(0))
    strain = F.substring(c, 2, 1)
    game = F.when(strain == "N", 3).when(strain.isin("S", "H"), 4).otherwise(5)
    return F.when(level == 0, "pass").when(level >= 6, "slam").when(level >= game, "game").otherwise("part")
