"""Mergeable centred moments of one or two amounts, and what is derived from them.

A group is its number of rows, its means, and the sums of squared and multiplied deviations from them.
Groups are merged from these alone: the deviations add up, and so do the squares of the groups' distances
from the common mean, weighted by their rows. Nothing like a difference of two large sums occurs, so
amounts near 1e9 keep their digits, and one scan serves several grains.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Names of the columns: rows, means, squared deviations, multiplied deviations.
N, MEAN_X, MEAN_Y, XX, YY, XY = "_n", "_mean_x", "_mean_y", "_xx", "_yy", "_xy"


def moments(x: Column, y: Column | None = None) -> dict[str, Column]:
    """Aggregates of the rows in which all given amounts are known."""
    x = x.cast("double")
    if y is None:
        count = F.count(x)
        return {N: count, MEAN_X: F.avg(x), XX: F.var_pop(x) * count}
    y = y.cast("double")
    both = x.isNotNull() & y.isNotNull()
    x, y, count = F.when(both, x), F.when(both, y), F.count_if(both)
    return {
        N: count, MEAN_X: F.avg(x), MEAN_Y: F.avg(y),
        XX: F.var_pop(x) * count, YY: F.var_pop(y) * count, XY: F.covar_pop(x, y) * count,
    }


def merged(groups: DataFrame) -> tuple[dict[str, Column], dict[str, Column]]:
    """Aggregates over rows of ``moments``: of the whole, and of the spread between the groups.

    The common means are a subquery over the same aggregated rows, whose exchange Spark reuses.
    """
    paired = MEAN_Y in groups.columns
    means = {m: F.sum(F.col(N) * F.col(m)) / F.sum(N) for m in (MEAN_X, MEAN_Y) if m in groups.columns}
    common = {m: groups.agg(value.alias(m)).scalar() for m, value in means.items()}
    gap = {m: F.col(m) - common[m] for m in means}
    squares = {XX: (MEAN_X, MEAN_X)} | ({YY: (MEAN_Y, MEAN_Y), XY: (MEAN_X, MEAN_Y)} if paired else {})
    between = {name: F.sum(F.col(N) * gap[a] * gap[b]) for name, (a, b) in squares.items()}
    whole = {N: F.sum(N)} | {name: F.sum(name) + value for name, value in between.items()}
    return whole, between


def correlation(xx: Column, yy: Column, xy: Column) -> Column:
    """Pearson's correlation; NULL where an amount does not vary."""
    return F.try_divide(xy, F.sqrt(xx) * F.sqrt(yy))


#: Lanczos' coefficients for the gamma function (fixed values).
LANCZOS_G = 7
LANCZOS = [
    0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059,
    12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7,
]


def log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function of x >= 0.5."""
    z = x - 1
    series = F.lit(LANCZOS[0])
    for place, value in enumerate(LANCZOS[1:], 1):
        series = series + F.lit(value) / (z + place)
    t = z + LANCZOS_G + 0.5
    return F.log(F.sqrt(F.lit(2.0) * F.pi())) + (z + 0.5) * F.log(t) - t + F.log(series)


def beta_share(a: Column, b: Column, x: Column, steps: int = 400) -> Column:
    """The regularised incomplete beta function, by its continued fraction (modified Lentz)."""

    def near(a: Column, b: Column, x: Column) -> Column:
        front = F.exp(
            log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.log(x) + b * F.log(F.lit(1.0) - x)
        ) / a
        some = lambda v: F.when(F.abs(v) < 1e-300, F.lit(1e-300)).otherwise(v)

        def term(state: Column, c: Column, upper: Column) -> Column:
            d = F.lit(1.0) / some(upper * state["d"] + 1.0)
            c = some(F.lit(1.0) + upper / state["c"])
            return F.struct(c.alias("c"), d.alias("d"), (state["h"] * c * d).alias("h"))

        def step(state: Column, m: Column) -> Column:
            even = m * (b - m) * x / ((a + m * 2 - 1) * (a + m * 2))
            state = term(state, state["c"], even)
            return term(state, state["c"], -(a + m) * (a + b + m) * x / ((a + m * 2) * (a + m * 2 + 1)))

        d = F.lit(1.0) / some(F.lit(1.0) - (a + b) * x / (a + 1))
        start = F.struct(F.lit(1.0).alias("c"), d.alias("d"), d.alias("h"))
        places = F.transform(F.sequence(F.lit(1), F.lit(steps)), lambda m: m.cast("double"))
        return front * F.aggregate(places, start, step)["h"]

    low = x < (a + 1) / (a + b + 2)
    return F.when(x <= 0, 0.0).when(x >= 1, 1.0).when(low, near(a, b, x)).otherwise(
        F.lit(1.0) - near(b, a, F.lit(1.0) - x)
    )


def f_test(between: Column, within: Column, groups: Column, rows: Column) -> tuple[Column, Column]:
    """F of a one-way analysis of variance, and the chance of a larger one if all groups are alike.

    NULL with fewer than two groups, without degrees of freedom, or where nothing varies.
    """
    above, below = (groups - 1).cast("double"), (rows - groups).cast("double")
    fair = (above > 0) & (below > 0)
    ratio = F.when(fair, F.try_divide(between / above, F.try_divide(within, below)))
    share = below / (below + above * ratio)
    return ratio, F.when(ratio.isNotNull(), beta_share(below / 2, above / 2, share))
