"""Statistics of cohorts over time: peers, seasons, shrinkage, walk-forward folds, blends by coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from .panel import correlation, doubled_rank


def _only(df: DataFrame) -> Column:
    """The one row of an aggregate, as a scalar subquery."""
    return df.select(F.struct("*")).scalar()


def peer_rank(x: Column, group: list[str]) -> Column:
    """Where a value stands among the group's others: those below and half of those equal, over their number; missing values neither rank nor count."""
    order, tie = Window.partitionBy(*group).orderBy(x.asc_nulls_last()), Window.partitionBy(*group, x)
    others = F.count(x).over(Window.partitionBy(*group)) - 1
    return F.when(x.isNotNull() & (others > 0), (F.rank().over(order) - 1 + (F.count(F.lit(1)).over(tie) - 1) / F.lit(2.0)) / F.nullif(others, F.lit(0)))


def first_and_last_means(df: DataFrame, key: str, day: str, value: str, first: tuple[int, ...], last: int) -> DataFrame:
    """(key, first_n..., last_n): means of the first n days from a key's first day and of the last n up to its last, from two passes of aggregates, no window."""
    ends = df.groupBy(key).agg(F.min(day).alias("begin"), F.max(day).alias("end"))
    j = df.join(ends, key)
    heads = [F.avg(F.when(F.datediff(day, "begin") < n, F.col(value))).alias(f"first_{n}") for n in first]
    return j.groupBy(key).agg(*heads, F.avg(F.when(F.datediff("end", day) < last, F.col(value))).alias(f"last_{last}"))


def spread_sample(df: DataFrame, key: str, order: list[str], most: int) -> DataFrame:
    """Of each key's snapshots, up to ``most`` an equal number of places apart from the first on, and always the last."""
    w = Window.partitionBy(key)
    n, place = F.count(F.lit(1)).over(w), F.row_number().over(w.orderBy(*order)) - 1
    rows = df.withColumns({"n": n, "place": place})
    step = F.greatest(F.lit(1), F.floor(F.col("n") / most))
    even = (F.col("place") % step == 0) & (F.col("place") < step * most)
    return rows.where(even | (F.col("place") == F.col("n") - 1)).drop("n", "place")


def still_growing(df: DataFrame, key: str, season: str, value: str, within: int = 2, least: float = 0.5) -> DataFrame:
    """(key, flag): 1 if the value rose by ``least`` from the first to the last of the seasons within ``within`` of the last one, 0 if not, null with one such season."""
    rows = df.where(F.col(value).isNotNull() & F.col(season).isNotNull())
    last = rows.groupBy(key).agg(F.max(season).alias("last"))
    near = rows.join(last, key).where(F.col(season) >= F.col("last") - within)
    g = near.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.max_by(value, season).alias("b"), F.min_by(value, season).alias("a"))
    return g.select(key, F.when(F.col("n") >= 2, (F.col("b") - F.col("a") >= least).cast("int")).alias("flag"))


def same_place_gap(df: DataFrame, key: str, season: str, place: str) -> DataFrame:
    """(key, gap): 1 if two seasons in a row of a key, more than one apart, are of one place."""
    w = Window.partitionBy(key).orderBy(season, place)
    rows = df.select(key, season, place).withColumns({"before": F.lag(season).over(w), "there": F.lag(place).over(w)})
    return rows.groupBy(key).agg(F.max(F.coalesce(((F.col(season) - F.col("before") > 1) & (F.col(place) == F.col("there"))).cast("int"), F.lit(0))).alias("gap"))


def season_lines(df: DataFrame, keys: list[str], games: str, minutes: str, by_games: list[str], by_minutes: list[str]) -> DataFrame:
    """Rows of one season made one: minutes a game from totals, per-game values weighted by games over all games, rates by minutes over those that have one; seasons without minutes go."""
    total = F.col(games) * F.col(minutes)
    out = [F.sum(games).alias(games), (F.sum(total) / F.nullif(F.sum(games), F.lit(0))).alias(minutes)]
    out += [F.when(F.count(c) > 0, F.sum(F.coalesce(F.col(games) * F.col(c), F.lit(0.0))) / F.nullif(F.sum(games), F.lit(0))).alias(c) for c in by_games]
    out += [(F.sum(total * F.col(c)) / F.nullif(F.sum(F.when(F.col(c).isNotNull(), total)), F.lit(0.0))).alias(c) for c in by_minutes]
    return df.groupBy(*keys).agg(*out, F.sum(total).alias("all minutes")).where("`all minutes` > 0").drop("all minutes")


def beta_posterior(df: DataFrame, group: str, made: str, tried: str, least: int, bounds: tuple[float, float] = (2.0, 200.0)) -> DataFrame:
    """The rows with ``posterior``: a rate shrunk to a Beta prior by the method of moments, of the row's group where it has ``least`` rates, else of all rows."""
    rate = F.when(F.col(tried) > 0, F.col(made) / F.nullif(F.col(tried), F.lit(0.0)))
    rows = df.withColumn("rate", rate)

    def prior() -> list[Column]:
        m, v = F.avg("rate"), F.var_pop("rate")
        k = F.when(v > 0, m * (1 - m) / F.nullif(v, F.lit(0.0)) - 1).otherwise(bounds[1])
        return [m.alias("m"), F.least(F.greatest(k, F.lit(bounds[0])), F.lit(bounds[1])).alias("k"), F.count("rate").alias("n")]

    groups = rows.groupBy(F.col(group).alias("g")).agg(*prior()).where(F.col("n") >= least)
    j = rows.join(groups, rows[group] == groups["g"], "left").withColumn("all", _only(rows.agg(*prior())))
    m, k = F.coalesce("m", "all.m"), F.coalesce("k", "all.k")
    return j.select(*df.columns, ((F.col(made) + m * k) / (F.col(tried) + k)).alias("posterior"))


def fixed_posterior(made: Column, tried: Column, mean: float, strength: float) -> Column:
    """(made + mean * strength) / (tried + strength); null unless 0 <= made <= tried."""
    return F.when((made >= 0) & (made <= tried), (made + mean * strength) / (tried + strength))


def reliable(x: Column, sample: Column, half: float, mean: Column) -> Column:
    """A value drawn to the training mean by its reliability, sample over sample plus ``half``."""
    r = sample / (sample + half)
    return r * x + (1 - r) * mean


def shrunk_slopes(df: DataFrame, key: str, cohort: str, x: str, y: str) -> DataFrame:
    """(key, cohort, n, slope, shrunk): least-squares slopes of keys with two points, drawn by N / (N + 2) to the mean raw slope of keys of earlier cohorts; unshrunk where there are none. Cohorts are added up before any window sees them."""
    n, sx, sy, sxx, sxy = F.count(F.lit(1)), F.sum(x), F.sum(y), F.sum(F.col(x) * F.col(x)), F.sum(F.col(x) * F.col(y))
    rows = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    den = F.nullif(n * sxx - sx * sx, F.lit(0.0))
    raw = rows.groupBy(key, cohort).agg(n.alias("n"), F.when(n >= 2, (n * sxy - sx * sy) / den).alias("slope"))
    of = raw.groupBy(F.col(cohort).alias("of cohort")).agg(F.sum("slope").alias("s"), F.count("slope").alias("k"))
    earlier = Window.orderBy("of cohort").rowsBetween(Window.unboundedPreceding, -1)
    prior = of.select("of cohort", (F.sum("s").over(earlier) / F.nullif(F.sum("k").over(earlier), F.lit(0))).alias("population"))
    weight = F.col("n") / (F.col("n") + 2)
    return raw.join(prior, raw[cohort] == prior["of cohort"]).select(key, cohort, "n", "slope", F.when(F.col("population").isNull(), F.col("slope")).otherwise(weight * F.col("slope") + (1 - weight) * F.col("population")).alias("shrunk"))


def rank_correlation(df: DataFrame, cohort: str, a: str, b: str, least: int = 12) -> DataFrame:
    """(rho, n): the mean of the cohorts' Spearman correlations, weighted by rows, over cohorts with ``least`` complete rows in which neither column is constant."""
    rows = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    ranks = rows.select(cohort, doubled_rank(F.col(a), cohort).cast("double").alias("a"), doubled_rank(F.col(b), cohort).cast("double").alias("b"))
    one = ranks.groupBy(cohort).agg(F.count(F.lit(1)).alias("n"), correlation(F.col("a"), F.col("b")).alias("r"), F.stddev_pop("a").alias("sa"), F.stddev_pop("b").alias("sb")).where((F.col("n") >= least) & (F.col("sa") > 0) & (F.col("sb") > 0))
    return one.agg((F.sum(F.col("r") * F.col("n")) / F.nullif(F.sum("n"), F.lit(0))).alias("rho"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def residual_correlations(df: DataFrame, y: str, pick: str, columns: list[str]) -> DataFrame:
    """(name, r): correlation of each column with what is left of y after least squares on log(pick), from moments in one pass."""
    lp = F.log(F.greatest(F.col(pick).cast("double"), F.lit(1.0)))
    rows = df.where(F.col(y).isNotNull() & F.col(pick).isNotNull()).withColumn("lp", lp)
    slope = rows.agg((F.covar_pop("lp", y) / F.nullif(F.var_pop("lp"), F.lit(0.0))).alias("b"))
    res = rows.withColumn("left", F.col(y) - _only(slope)["b"] * F.col("lp"))
    one = res.agg(*[correlation(F.col(c), F.col("left")).alias(c) for c in columns])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("r")) for c in columns])).alias("x")).select("x.*")


def thin(df: DataFrame, columns: list[str]) -> DataFrame:
    """The rows with ``covered``, how many columns they have, and ``thin``: whether that lies strictly below the median of all rows. The median comes from counts by coverage, not from a sort of rows."""
    covered = sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0))
    rows = df.withColumn("covered", covered)
    counts = rows.groupBy("covered").agg(F.count(F.lit(1)).alias("n"))
    median = counts.agg(F.expr("percentile(covered, 0.5, n)").alias("median"))
    return rows.withColumn("thin", (F.col("covered") < _only(median)["median"]).cast("int"))


def one_prediction(prediction: Column, inputs: list[str]) -> Column:
    """Rows with the same inputs, nulls alike, get the mean of their predictions."""
    return F.avg(prediction).over(Window.partitionBy(*inputs))


def horizon_labels(df: DataFrame, key: str, season: str, value: str, weights: dict[str, list[float]]) -> DataFrame:
    """(key, a column for each scheme): sums of values by season number, 1 the first, weighted by the scheme's weight of that season; missing seasons count as nothing."""
    cell = lambda k: F.sum(F.when(F.col(season) == k + 1, F.col(value)))
    return df.groupBy(key).agg(*[sum((w * F.coalesce(cell(k), F.lit(0.0)) for k, w in enumerate(ws)), F.lit(0.0)).alias(name) for name, ws in weights.items()])


def top_seasons(df: DataFrame, key: str, value: str, k: int = 2) -> DataFrame:
    """(key, top): the sum of a key's k best values."""
    best = F.slice(F.sort_array(F.collect_list(value), asc=False), 1, k)
    return df.groupBy(key).agg(F.aggregate(best, F.lit(0.0), lambda a, x: a + x).alias("top"))


def walk_forward(df: DataFrame, tests: DataFrame, cohort: str, season: str, gap: int = 2) -> DataFrame:
    """Rows for training at each test year: cohorts up to ``gap`` years before it, and of them the labels of seasons that had ended a year before."""
    t = tests.select(F.col("test_year"))
    return df.join(t, (F.col(cohort) <= F.col("test_year") - gap) & (F.col(season) <= F.col("test_year") - 1))


def truth(df: DataFrame, key: str, season: str, value: str, seasons: list[int]) -> DataFrame:
    """(key, full, complete): the sum of the seasons' values with missing ones as 0; and the same only where none is missing."""
    rows = df.where(F.col(season).isin(*seasons)).groupBy(key, season).agg(F.sum(value).alias("v"))
    g = rows.groupBy(key).agg(F.coalesce(F.sum("v"), F.lit(0.0)).alias("full"), F.count("v").alias("n"))
    return df.select(key).distinct().join(g, key, "left").select(key, F.coalesce("full", F.lit(0.0)).alias("full"), F.when(F.col("n") == len(seasons), F.col("full")).alias("complete"))


def with_prefix(df: DataFrame, *prefixes: str) -> list[str]:
    """Names of the columns that begin with one of the prefixes, in order."""
    return [c for c in df.columns if c.startswith(prefixes)]


def normalised_coverage(df: DataFrame, columns: list[str], train: Column, low: float = 0.05, high: float = 0.95) -> DataFrame:
    """The rows with ``coverage``: columns that they have, placed between two quantiles of the training rows' counts and clipped to [0, 1]."""
    n = sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0))
    rows = df.withColumn("covered", n)
    q = rows.where(train).groupBy("covered").agg(F.count(F.lit(1)).alias("n")).agg(F.expr(f"percentile(covered, array({low}, {high}), n)").alias("q"))
    span = F.nullif(F.col("q")[1] - F.col("q")[0], F.lit(0.0))
    place = F.least(F.greatest((F.col("covered") - F.col("q")[0]) / span, F.lit(0.0)), F.lit(1.0))
    rows = rows.withColumn("q", _only(q)["q"])
    return rows.withColumn("coverage", F.coalesce(place, (F.col("covered") >= F.col("q")[0]).cast("double"))).drop("covered", "q")


def most_important(importance: DataFrame, column: str, weight: str, most: int = 100) -> DataFrame:
    """The columns of the greatest weight, ties by name, each with its place: an order with a limit, so a top-k."""
    best = importance.orderBy(F.desc(weight), column).limit(most)
    return best.withColumn("place", F.row_number().over(Window.orderBy(F.desc(weight), column)))


def decorrelated(df: DataFrame, ranked: list[str], most: int = 10, bound: float = 0.9) -> list[str]:
    """Columns taken in their order while the correlation with every one taken stays under the bound in size; all correlations come from one pass. A constant column correlates with none."""
    pairs = [(a, b) for i, a in enumerate(ranked) for b in ranked[:i]]
    got = df.agg(F.lit(0).alias("zero"), *[correlation(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{i}") for i, (a, b) in enumerate(pairs)]).first()
    r = {p: got[str(i)] for i, p in enumerate(pairs)}
    taken: list[str] = []
    for c in ranked:
        if len(taken) < most and all(r[c, t] is None or abs(r[c, t]) < bound for t in taken):
            taken.append(c)
    return taken


def clean_ranks(df: DataFrame, group: list[str], rank: str, order: list[str], bounds: tuple[int, int] = (1, 200)) -> DataFrame:
    """The rows with a rank within the bounds, the first by ``order`` of each rank of a group."""
    w: WindowSpec = Window.partitionBy(*group, rank).orderBy(*order)
    return df.where(F.col(rank).between(*bounds)).withColumn("place", F.row_number().over(w)).where("place = 1").drop("place")
