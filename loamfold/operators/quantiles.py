"""Exact, interpolated quantiles of groups of any size.

``percentile`` keeps every distinct value of a group in one buffer, which a
group with a third of all rows cannot afford. Here a mergeable sketch first
brackets each wanted rank; only the values inside a bracket are then counted
one by one and put in order, of all others the number below each bracket is
enough. The result equals ``percentile`` (linear interpolation)
exactly. There is one plan for every size.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamfold.operators.ordering import cumulated
from loamfold.session import stored

ACCURACY = 1000
#: Rows that a group of ``many_medians`` may have; its buffers then stay below some ten megabytes a column.
MOST = 100_000


def _doubles(df: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    return df.select(*keys, *[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in columns])


def long_form(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """One row per key and column: ``(*keys, metric, value)``; NaN becomes NULL."""
    return _doubles(df, columns, keys).unpivot(list(keys), list(columns), "metric", "value")


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str], names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[name]) for k, name in zip(keys, names, strict=True)])


def _brackets(column: str, fractions: Sequence[float], accuracy: int) -> list[Column]:
    """``(lo, hi)`` per fraction, around its rank; the whole range in small groups and at the ends."""
    slack = 2.0 / accuracy
    probes = [min(max(p, 0.0), 1.0) for f in fractions for p in (f - slack, f + slack)]
    least, most, found = F.min(column), F.max(column), F.percentile_approx(column, probes, accuracy)
    out = []
    for i, fraction in enumerate(fractions):
        whole = F.count(column) <= 4 * accuracy
        low = F.lit(True) if fraction <= slack else whole
        high = F.lit(True) if fraction >= 1.0 - slack else whole
        out.append(F.struct(F.when(low, least).otherwise(found[2 * i]).alias("lo"), F.when(high, most).otherwise(found[2 * i + 1]).alias("hi")))
    return out


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], fractions: Sequence[float], keys: Sequence[str] = (), accuracy: int = ACCURACY
) -> DataFrame:
    """Exact quantiles of several columns: ``(*keys, metric, n, q0, q1, …)``.

    A group with no value keeps a row with ``n = 0`` and NULL quantiles. Of a
    group with more than ``4 * accuracy`` values, about ``4 / accuracy`` of the
    distinct values are put in order, per fraction. The table is read three
    times: for the sketches, for the numbers of values below each bracket, which
    are plain aggregates of the wide row, and for the values inside a bracket,
    the only ones that become rows of their own.
    """
    keys, columns = list(keys), list(columns)
    values = _doubles(df, columns, keys)
    sketch = values.groupBy(*keys).agg(
        *[F.struct(F.count(c).alias("n"), F.array(*_brackets(c, fractions, accuracy)).alias("b")).alias(f"_b{j}") for j, c in enumerate(columns)]
    )
    bounds = stored(sketch, "quantile-bounds")
    if keys:
        named = bounds.withColumnsRenamed({k: f"_k{j}" for j, k in enumerate(keys)})
        bounded = values.join(named, _same(values, named, keys, [f"_k{j}" for j in range(len(keys))])).drop(*[f"_k{j}" for j in range(len(keys))])
    else:
        bounded, row = values, bounds.first()

    def bracket(j: int, i: int, end: str) -> Column:
        # without keys there is one row of bounds, two numbers per column and fraction: literals
        return F.col(f"_b{j}")["b"][i][end] if keys else F.lit(row[f"_b{j}"]["b"][i][end]).cast("double")

    places = range(len(fractions))
    counted = bounded.groupBy(*keys).agg(*[F.count_if(F.col(c) < bracket(j, i, "lo")).alias(f"_c{j}_{i}") for j, c in enumerate(columns) for i in places])
    below = [F.struct(F.lit(j).alias("_j"), F.array(*[F.col(f"_c{j}_{i}") for i in places]).alias("_below")) for j in range(len(columns))]
    # as arrays, so that the expression stays small with any number of columns and fractions
    if keys:
        brackets = F.array(*[F.col(f"_b{j}")["b"] for j in range(len(columns))])
    else:
        brackets = F.array(*[F.array(*[F.struct(bracket(j, i, "lo").alias("lo"), bracket(j, i, "hi").alias("hi")) for i in places]) for j in range(len(columns))])

    def entry(cell: Column, j: Column) -> Column:
        value = cell["value"]
        inside = F.exists(cell["brackets"], lambda b: value.between(b["lo"], b["hi"]))
        return F.when(inside, F.struct(j.alias("_j"), (value + F.lit(0.0)).alias("_value")))

    entries = F.transform(F.arrays_zip(F.array(*[F.col(c) for c in columns]).alias("value"), brackets.alias("brackets")), entry)
    held = bounded.select(*keys, F.filter(entries, lambda e: e.isNotNull()).alias("_held")).where(F.size("_held") > 0)
    cells = held.select(*keys, F.inline("_held")).groupBy(*keys, "_j", "_value").agg(F.count("*").alias("rows"))
    ranked = stored(cumulated(cells, [*keys, "_j"], ["_value"], ["rows"]), "quantile-cells")

    named = [F.struct(F.lit(j).alias("_j"), F.lit(c).alias("metric"), F.col(f"_b{j}")["n"].alias("n"), F.col(f"_b{j}")["b"]["lo"].alias("_lo")) for j, c in enumerate(columns)]
    groups = bounds.select(*keys, F.inline(F.array(*named)))
    ends = [*keys, "_j"]

    def beside(left: DataFrame, right: DataFrame) -> DataFrame:
        renamed = right.withColumnsRenamed({k: f"_g{j}" for j, k in enumerate(ends)})
        return left.join(renamed, _same(left, renamed, ends, [f"_g{j}" for j in range(len(ends))]), "left").drop(*[f"_g{j}" for j in range(len(ends))])

    whole = beside(groups, counted.select(*keys, F.inline(F.array(*below))))
    # a rank, less the values below its bracket, counts from the first cell of the bracket
    first = [F.coalesce(F.sum(F.when(F.col("_value") < F.col("_lo")[i], F.col("rows"))), F.lit(0)).alias(f"_f{i}") for i in places]
    shifts = beside(groups, ranked).groupBy(*ends).agg(*first)
    whole = beside(whole, shifts)
    picked = []
    for i, fraction in enumerate(fractions):
        for name, rank in (("below", F.floor), ("above", F.ceil)):
            at = rank(F.lit(float(fraction)) * (F.col("n") - 1)) - F.col("_below")[i] + F.col(f"_f{i}")
            holds = (F.col("before_rows") <= at) & (at < F.col("before_rows") + F.col("rows"))
            picked.append(F.max(F.when(holds, F.col("_value"))).alias(f"_{name}{i}"))
    found = beside(whole, ranked).groupBy(*keys, "metric").agg(F.max("n").alias("n"), *picked)
    results = []
    for i, fraction in enumerate(fractions):
        position = F.lit(float(fraction)) * (F.col("n") - 1)
        below, above = F.col(f"_below{i}"), F.col(f"_above{i}")
        lost = (F.col("n") > 0) & (below.isNull() | above.isNull())
        value = below + (above - below) * (position - F.floor(position))
        results.append(F.when(lost, F.raise_error(F.lit("a rank lies outside its bracket")).cast("double")).otherwise(value).alias(f"q{i}"))
    return found.select(*keys, "metric", "n", *results)


def exact_medians(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), accuracy: int = ACCURACY) -> DataFrame:
    """Wide exact medians: one row per key, or one row in all without keys."""
    medians = exact_quantiles(df, columns, [0.5], keys, accuracy)
    return medians.groupBy(*keys).agg(*[F.max(F.when(F.col("metric") == c, F.col("q0"))).alias(c) for c in columns])


def many_medians(df: DataFrame, columns: Sequence[str], keys: Sequence[str], most: int = MOST) -> DataFrame:
    """Exact medians of very many groups, each of at most ``most`` rows: ``(*keys, *columns)``; a larger group is an error.

    One buffer per group and column holds its distinct values with their counts. Groups without such a bound use
    ``exact_medians``.
    """
    held = df.groupBy(*keys).agg(F.count("*").alias("_rows"), *[F.median(F.nanvl(F.col(c).cast("double"), F.lit(None))).alias(c) for c in columns])
    over = F.raise_error(F.format_string("a group has %d rows, more than %d; use exact_medians", F.col("_rows"), F.lit(most))).cast("double")
    return held.select(*keys, *[F.when(F.col("_rows") > most, over).otherwise(F.col(c)).alias(c) for c in columns])
