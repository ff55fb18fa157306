"""Statistics of groups, cohorts and ordered panels with explicit rules for ties, nulls and cutoffs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from .quality import unused


def rate(made: Column, tried: Column, scale: float = 1.0) -> Column:
    """A rate from totals, never a mean of rates."""
    total = F.sum(tried)
    return F.when(total > 0, scale * F.sum(made) / F.nullif(total, F.lit(0.0)))


def exact_sum(x: Column) -> Column:
    """The sum of doubles, whatever order they come in: equal multisets sum alike, so ranks tie where they should.

    Values of up to 8 decimals and 20 digits before them add as decimals. A group with any other, NaN and
    infinities among them, adds as doubles do, in the order of its rows.
    """
    fixed = x.try_cast("decimal(28,8)")
    fits = fixed.cast("double") == x
    return F.when(F.count(x) == F.count(F.when(fits, x)), F.sum(F.when(fits, fixed)).cast("double")).otherwise(F.sum(x))


def weighted_mean(x: Column, w: Column) -> Column:
    """Rows that miss either count in neither sum."""
    both = x.isNotNull() & w.isNotNull()
    total = F.sum(F.when(both, w))
    return F.when(total > 0, F.sum(F.when(both, x * w)) / F.nullif(total, F.lit(0.0)))


def weighted_slope(x: Column, y: Column, w: Column) -> Column:
    """Weighted least squares from moments, one pass."""
    sw, sx, sy, sxx, sxy = F.sum(w), F.sum(w * x), F.sum(w * y), F.sum(w * x * x), F.sum(w * x * y)
    den = sw * sxx - sx * sx
    return F.when(den > 1e-9, (sw * sxy - sx * sy) / F.nullif(den, F.lit(0.0)))


def correlation(a: Column, b: Column) -> Column:
    """Pearson's correlation over rows that have both; null where one is constant, which corr() refuses to divide by in ANSI mode."""
    x, y = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    return F.covar_pop(x, y) / F.nullif(F.stddev_pop(x) * F.stddev_pop(y), F.lit(0.0))


def leave_one_out_mean(x: Column, group: WindowSpec) -> Column:
    """Mean of the others of a group: its total less the row, without a self-join."""
    n = F.count(x).over(group) - F.when(x.isNotNull(), 1).otherwise(0)
    return F.when(n > 0, (F.sum(x).over(group) - F.coalesce(x, F.lit(0.0))) / F.nullif(n, F.lit(0)))


def share(x: Column, group: WindowSpec) -> Column:
    """Share of the group's total; missing if any member's value is."""
    total = F.sum(x).over(group)
    return F.when((F.count(F.lit(1)).over(group) == F.count(x).over(group)) & (total > 0), x / F.nullif(total, F.lit(0.0)))


def percent_rank(x: Column, *by: Column | str) -> Column:
    """Average rank over the count, missing values neither ranked nor counted."""
    order, group, tie = Window.partitionBy(*by).orderBy(x.asc_nulls_last()), Window.partitionBy(*by), Window.partitionBy(*by, x)
    return F.when(x.isNotNull(), (F.rank().over(order) + (F.count(F.lit(1)).over(tie) - 1) / F.lit(2.0)) / F.count(x).over(group))


def doubled_rank(x: Column, *by: Column | str) -> Column:
    """Twice the average rank, an integer, so that blends tie exactly."""
    order, tie = Window.partitionBy(*by).orderBy(x), Window.partitionBy(*by, x)
    return (2 * F.rank().over(order) + F.count(F.lit(1)).over(tie) - 1).cast("long")


def standing(df: DataFrame, value: str, buckets: int = 256) -> DataFrame:
    """(value, less, ties): of each distinct value, how many rows have less, and how many it.

    Ranks over a whole table without a task that holds it: rows are counted by value, values fall into
    ``buckets`` between approximate quantiles, and a bucket's running sum begins at the rows of the
    buckets before it. Rows without a value don't count.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("ties"))
    edges = counts.agg(F.percentile_approx(value, [k / buckets for k in range(1, buckets)], 10_000)).first()[0] or []
    placed = counts.withColumn("bucket", F.size(F.filter(F.array(*[F.lit(x) for x in sorted(set(edges))]), lambda x: x <= F.col(value))))
    sums = placed.groupBy("bucket").agg(F.sum("ties").alias("rows"))
    earlier = sums.select("bucket", (F.sum("rows").over(Window.orderBy("bucket")) - F.col("rows")).alias("offset"))
    below = F.coalesce(F.sum("ties").over(Window.partitionBy("bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return placed.withColumn("below", below).join(earlier, "bucket").select(value, (F.col("offset") + F.col("below")).alias("less"), "ties")


def numbered(df: DataFrame, order: list[Column], bucket: Column, name: str) -> DataFrame:
    """The rows numbered from 1 in an order, given a bucket that grows with it, such as a hash's head: numbers within a bucket and the rows of buckets before it."""
    rows = df.withColumn("bucket of rows", bucket)
    sums = rows.groupBy(F.col("bucket of rows").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    earlier = sums.select("b", (F.sum("n").over(Window.orderBy("b")) - F.col("n")).alias("rows before"))
    j = rows.join(earlier, rows["bucket of rows"].eqNullSafe(earlier["b"]))
    at = F.row_number().over(Window.partitionBy("bucket of rows").orderBy(*order))
    return j.withColumn(name, F.col("rows before") + at).select(*df.columns, name)


def as_of(facts: DataFrame, cutoffs: DataFrame, on: list[str], ts: str, cutoff: str, within_days: int | None = None, tie: str | None = None) -> DataFrame:
    """The last fact strictly before each cutoff, at most ``within_days`` old; cutoffs without one keep nulls.

    One shuffle on the key: facts meet cutoffs in an equi-join, and a maximum by (time, tie) picks.
    Keys without a cutoff row give nothing: an unknown cutoff is never guessed.
    """
    keys = [*on, cutoff]
    fact = F.struct(ts, *([tie] if tie else []), *[c for c in facts.columns if c not in (*on, ts, tie)])
    known = facts.select(*[F.col(c).alias(f"of {c}") for c in on], fact.alias("the fact"))
    cuts = cutoffs.select(*keys).distinct()
    near = (F.col("the fact")[ts] < F.col(cutoff)) & F.lit(True)
    if within_days is not None:
        near &= F.datediff(F.col(cutoff), F.col("the fact")[ts]) <= within_days
    for c in on:
        near &= F.col(c) == F.col(f"of {c}")
    picked = cuts.join(known, near).groupBy(*keys).agg(F.max("the fact").alias("the fact"))
    return cutoffs.join(picked, keys, "left").select(*cutoffs.columns, "the fact.*")


def islands(df: DataFrame, key: str, day: str) -> DataFrame:
    """(key, first, last, days) of runs of consecutive days with a row."""
    days = df.select(key, F.col(day).alias("_d")).distinct()
    run = F.date_sub(F.col("_d"), F.row_number().over(Window.partitionBy(key).orderBy("_d")))
    return days.withColumn("_run", run).groupBy(key, "_run").agg(F.min("_d").alias("first"), F.max("_d").alias("last"), F.count(F.lit(1)).alias("days")).drop("_run")


def before(order: WindowSpec) -> WindowSpec:
    """All rows that come earlier, the current one left out."""
    return order.rowsBetween(Window.unboundedPreceding, -1)


def two_regressor_residual(y: Column, x: Column, z: Column, group: WindowSpec, least: int) -> Column:
    """Residual of least squares on two regressors within a group, from its moments; missing in groups under ``least`` rows or with collinear regressors."""
    mean = lambda c: F.avg(c).over(group)
    cov = lambda a, b: F.covar_pop(a, b).over(group)
    det = F.nullif(cov(x, x) * cov(z, z) - cov(x, z) * cov(x, z), F.lit(0.0))
    bx, bz = (cov(x, y) * cov(z, z) - cov(z, y) * cov(x, z)) / det, (cov(z, y) * cov(x, x) - cov(x, y) * cov(x, z)) / det
    return F.when(F.count(F.lit(1)).over(group) >= least, y - mean(y) - bx * (x - mean(x)) - bz * (z - mean(z)))


def permuted(df: DataFrame, key: str, strata: list[str], value: list[str], seed: int) -> DataFrame:
    """The rows with ``value`` columns dealt to others of the stratum and null pattern, as one vector, by a seeded hash: a control that breaks the link to the key only."""
    null = {c: unused(f"{c} is null", df) for c in value}
    at, to = unused("own place", df), unused("dealt place", df)
    rows = df.withColumns({n: F.col(c).isNull().cast("int") for c, n in null.items()})
    by = [*strata, *null.values()]
    own, dealt = Window.partitionBy(*by).orderBy(key), Window.partitionBy(*by).orderBy(F.sha2(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")), 256))
    left = rows.drop(*value).withColumn(at, F.row_number().over(own))
    of = {c: unused(f"of {c}", df) for c in by}
    right = rows.select(*[F.col(c).alias(n) for c, n in of.items()], *value, F.row_number().over(dealt).alias(to))
    same = F.col(at) == F.col(to)
    for c, n in of.items():
        same &= F.col(c).eqNullSafe(F.col(n))
    return left.join(right, same).select(*df.columns)


def paired_deltas(df: DataFrame, on: list[str], arm: str, value: str, base: str) -> DataFrame:
    """(arm, n, mean_delta, wins): each arm against the base arm over the units that have both, one row for each unit and arm expected."""
    other = df.where((F.col(arm) != base) & F.col(value).isNotNull())
    real = df.where((F.col(arm) == base) & F.col(value).isNotNull()).select(*on, F.col(value).alias("_base"))
    delta = F.col(value) - F.col("_base")
    return other.join(real, on).groupBy(arm).agg(F.count(F.lit(1)).alias("n"), F.avg(delta).alias("mean_delta"), F.count_if(delta > 0).alias("wins"))
