"""Wood's lactation curve y(t) = a * t^b * exp(-c t)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirrorset.config import DEFAULT_LIMITS, Limits
from mirrorset.operators.joins import lookup_join
from mirrorset.sources.staging import stage


def wood_value(a: Column, b: Column, c: Column, day: Column) -> Column:
    return a * F.pow(day, b) * F.exp(-c * day)


def wood_fit(df: DataFrame, day: str, measure: str, by: Sequence[str]) -> DataFrame:
    """Least squares of ln y on ln t and t per group: ``(by…, n, a, b, c)``.

    One aggregation collects the sums; groups whose days do not vary get NULL.
    """
    usable = df.where((F.col(day) > 0) & (F.col(measure) > 0))
    x1, x2, y = F.ln(F.col(day)), F.col(day).cast("double"), F.ln(F.col(measure))
    sums = usable.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(v).alias(name) for name, v in (("m1", x1), ("m2", x2), ("my", y))],
        F.covar_pop(x1, x1).alias("s11"),
        F.covar_pop(x2, x2).alias("s22"),
        F.covar_pop(x1, x2).alias("s12"),
        F.covar_pop(x1, y).alias("s1y"),
        F.covar_pop(x2, y).alias("s2y"),
    )
    det = F.col("s11") * F.col("s22") - F.col("s12") * F.col("s12")
    solvable = det > F.lit(1e-9) * F.col("s11") * F.col("s22")
    b = F.when(solvable, (F.col("s1y") * F.col("s22") - F.col("s2y") * F.col("s12")) / det)
    slope = F.when(solvable, (F.col("s2y") * F.col("s11") - F.col("s1y") * F.col("s12")) / det)
    solved = sums.withColumn("b", b).withColumn("c", -slope)
    a = F.exp(F.col("my") - F.col("b") * F.col("m1") + F.col("c") * F.col("m2"))
    return solved.select(*by, "n", a.alias("a"), "b", "c")


#: Sums of a round: of the squared derivatives by pairs, of the derivatives times what is left, and of its squares.
_PAIRS = ("h11", "h12", "h13", "h22", "h23", "h33")
_SUMS = (*_PAIRS, "g1", "g2", "g3", "sse")


def step_of(h: dict[str, object], g: Sequence, damping, divide) -> list:
    """The step of Gauss and Newton with ``damping`` times the diagonal added, by Cramer's rule; works on columns and on text alike."""
    a, b, c = h["h11"] * (1.0 + damping), h["h22"] * (1.0 + damping), h["h33"] * (1.0 + damping)
    p, q, r = h["h12"], h["h13"], h["h23"]
    det = a * (b * c - r * r) - p * (p * c - r * q) + q * (p * r - b * q)
    first = g[0] * (b * c - r * r) - p * (g[1] * c - r * g[2]) + q * (g[1] * r - b * g[2])
    second = a * (g[1] * c - r * g[2]) - g[0] * (p * c - r * q) + q * (p * g[2] - g[1] * q)
    third = a * (b * g[2] - g[1] * r) - p * (p * g[2] - g[1] * q) + g[0] * (p * r - b * q)
    return [divide(top, det) for top in (first, second, third)]


def wood_fit_nls(
    df: DataFrame,
    day: str,
    measure: str,
    by: Sequence[str],
    rounds: int = 12,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Least squares of y itself per group: ``(by…, n, a, b, c, sse)``, with the sum of squares left.

    The fit of the logarithms is the start. Each of the fixed ``rounds`` is one aggregate over the rows: the normal equations and the sum
    of squares at every group's trial values. A trial that is no worse is kept and the damping falls to a
    tenth, else it grows tenfold and the step is taken anew. Groups that have no start stay NULL.
    """
    usable = df.where((F.col(day) > 0) & (F.col(measure) > 0)).select(
        *by, F.ln(F.col(day)).alias("_x1"), (-F.col(day).cast("double")).alias("_x2"), F.col(measure).cast("double").alias("_y")
    )
    rows = stage(usable, "measured")
    start = wood_fit(df, day, measure, by)
    null = F.lit(None).cast("double")
    state = start.select(
        *[F.col(g).alias(f"_by{i}") for i, g in enumerate(by)],
        "n",
        *[null.alias(c) for c in ("t1", "t2", "t3", *_SUMS)],
        F.lit(0.1).alias("damping"),
        F.ln("a").alias("u1"),
        F.col("b").alias("u2"),
        F.col("c").alias("u3"),
    )
    state = stage(state, "curves")
    small = limits.small(state.count())
    keys = [f"_by{i}" for i in range(len(by))]
    for _ in range(rounds):
        trial = state.select(*keys, "u1", "u2", "u3")
        joined = lookup_join(rows, trial, dict(zip(by, keys)), "inner", small, limits, null_safe=True)
        curve = F.exp(F.col("u1") + F.col("u2") * F.col("_x1") + F.col("u3") * F.col("_x2"))
        at = joined.withColumn("_f", curve).withColumn("_r", F.col("_y") - F.col("_f"))
        f2, fr, x1, x2 = F.col("_f") * F.col("_f"), F.col("_f") * F.col("_r"), F.col("_x1"), F.col("_x2")
        terms = [f2, f2 * x1, f2 * x2, f2 * x1 * x1, f2 * x1 * x2, f2 * x2 * x2, fr, fr * x1, fr * x2, F.col("_r") * F.col("_r")]
        sums = at.groupBy(*keys).agg(*[F.sum(t).alias(f"_{name}") for t, name in zip(terms, _SUMS)])
        sums = sums.select(*[F.col(k).alias(f"_{k}") for k in keys], *[f"_{name}" for name in _SUMS])
        both = lookup_join(state, sums, {k: f"_{k}" for k in keys}, "left", small, limits, null_safe=True)
        better = F.coalesce(F.col("sse").isNull() | (F.col("_sse") <= F.col("sse")), F.lit(False))
        kept = both.select(
            *keys,
            "n",
            *[F.when(better, F.col(f"u{i}")).otherwise(F.col(f"t{i}")).alias(f"t{i}") for i in (1, 2, 3)],
            *[F.when(better, F.col(f"_{name}")).otherwise(F.col(name)).alias(name) for name in _SUMS],
            F.when(better, F.col("damping") / 10).otherwise(F.col("damping") * 10).alias("damping"),
        )
        step = step_of({h: F.col(h) for h in _PAIRS}, [F.col("g1"), F.col("g2"), F.col("g3")], F.col("damping"), F.try_divide)
        state = stage(kept.select("*", *[(F.col(f"t{i}") + d).alias(f"u{i}") for i, d in zip((1, 2, 3), step)]), "curves")
    named = [F.col(k).alias(g) for k, g in zip(keys, by)]
    return state.select(*named, "n", F.exp("t1").alias("a"), F.col("t2").alias("b"), F.col("t3").alias("c"), "sse")


def wood_curve(
    rows: DataFrame,
    fitted: DataFrame,
    by: Sequence[str],
    day: str,
    name: str = "predicted",
    small: bool = False,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Value of the fitted curve of each row's group on the row's day.

    The groups may be few and hot; ``small`` states that ``fitted`` was counted and may be broadcast.
    """
    curves = fitted.select(*[F.col(g).alias(f"_by{i}") for i, g in enumerate(by)], "a", "b", "c")
    on = {g: f"_by{i}" for i, g in enumerate(by)}
    joined = lookup_join(rows, curves, on, "left", small, limits).drop(*on.values())
    value = wood_value(F.col("a"), F.col("b"), F.col("c"), F.col(day))
    return joined.withColumn(name, value).drop("a", "b", "c")
