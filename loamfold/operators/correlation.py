"""Correlation matrices over complete pairs, safe for constant columns.

For the Pearson matrix each task folds its rows into one block of co-moments
(matrix products over Arrow batches, no copy of a row per pair); blocks of
tasks are merged by pair. Elsewhere a row is turned into one small record per
pair of columns, and the records are combined by pair on the map side. Either
way one partial result per pair and task is shuffled, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamfold.operators.ordering import cumulated
from loamfold.session import stored

#: What a task knows of a pair: complete rows, means, centred sums of squares and products, least and greatest values.
MOMENTS = "pair int, n long, mx double, my double, cxx double, cyy double, cxy double, lx double, hx double, ly double, hy double"


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson correlation over the rows where both are present; NULL without spread."""
    both = x.isNotNull() & y.isNotNull()
    px, py = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(px, py), F.stddev_pop(px) * F.stddev_pop(py))


def lower_triangle(columns: Sequence[str], diagonal: bool) -> list[tuple[str, str]]:
    return [(a, b) for i, a in enumerate(columns) for b in columns[: i + 1 if diagonal else i]]


def _names(column: Column, names: Sequence[str]) -> Column:
    return F.get(F.lit(list(names)), column)


def pair_rows(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """``(pair, x, y)`` for each row and pair with both values present."""
    columns = sorted({c for pair in pairs for c in pair})
    place = {c: i for i, c in enumerate(columns)}
    values = df.select(F.array(*[F.col(c).cast("double") for c in columns]).alias("_v"))
    numbered = values.select("_v", F.explode(F.sequence(F.lit(0), F.lit(len(pairs) - 1))).alias("pair"))
    first, second = ([place[pair[side]] for pair in pairs] for side in (0, 1))
    picked = numbered.select(
        "pair",
        F.get("_v", F.get(F.lit(first), F.col("pair"))).alias("x"),
        F.get("_v", F.get(F.lit(second), F.col("pair"))).alias("y"),
    )
    return picked.where(F.col("x").isNotNull() & F.col("y").isNotNull())


def _all_pairs(results: DataFrame, pairs: Sequence[tuple[str, str]], measures: Sequence[str]) -> DataFrame:
    """One row per pair, also for pairs without a complete row."""
    numbers = results.sparkSession.range(len(pairs)).select(F.col("id").cast("int").alias("pair"))
    return numbers.join(results, "pair", "left").select(
        _names(F.col("pair"), [a for a, _ in pairs]).alias("x_name"),
        _names(F.col("pair"), [b for _, b in pairs]).alias("y_name"),
        *measures,
    )


def _plain_corr(x: str, y: str) -> Column:
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def _of_batch(values: np.ndarray) -> list[np.ndarray]:
    """Matrices over pairs of columns (NaN: missing): ``[i, j]`` is about column i in the rows where i and j are present."""
    here = ~np.isnan(values)
    some = here.any(axis=0)
    # sums are taken from a value of the column, so that no digits are lost to its size
    shift = np.where(some, values[here.argmax(axis=0), np.arange(values.shape[1])], 0.0)
    moved = np.where(here, values - shift, 0.0)
    mask = here.astype(np.float64)
    n = mask.T @ mask
    safe = np.maximum(n, 1)
    total = moved.T @ mask
    mean = total / safe
    squares = np.maximum((moved * moved).T @ mask - total * mean, 0)
    products = moved.T @ moved - total * mean.T
    low, high = np.full(n.shape, np.inf), np.full(n.shape, -np.inf)
    whole = here.all(axis=0)
    above, below = np.where(here, values, np.inf), np.where(here, values, -np.inf)
    low[:, whole], high[:, whole] = above.min(axis=0)[:, None], below.max(axis=0)[:, None]
    for j in np.flatnonzero(~whole & some):
        rows = here[:, j]
        low[:, j], high[:, j] = above[rows].min(axis=0), below[rows].max(axis=0)
    return [n, mean + shift[:, None], squares, products, low, high]


def _merged(one: list[np.ndarray] | None, other: list[np.ndarray]) -> list[np.ndarray]:
    """Moments of both parts, from their distances to each other, not from sums of squares of all values."""
    if one is None:
        return other
    n = one[0] + other[0]
    safe = np.maximum(n, 1)
    apart = np.where((one[0] > 0) & (other[0] > 0), other[1] - one[1], 0.0)
    weight = one[0] * other[0] / safe
    mean = np.where(one[0] == 0, other[1], one[1] + apart * other[0] / safe)
    return [n, mean, one[2] + other[2] + apart**2 * weight, one[3] + other[3] + apart * apart.T * weight, np.minimum(one[4], other[4]), np.maximum(one[5], other[5])]


def co_moments(df: DataFrame, columns: Sequence[str], pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """One row per task and pair with complete rows in it (``MOMENTS``). NULL and NaN are missing."""
    columns = list(columns)
    place = {c: k for k, c in enumerate(columns)}
    i, j = (np.array([place[pair[side]] for pair in pairs], dtype=np.int64) for side in (0, 1))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            if batch.num_rows:
                state = _merged(state, _of_batch(np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])))
        if state is None:
            return
        n, mean, squares, products, low, high = state
        found = np.flatnonzero(n[i, j] > 0)
        a, b = i[found], j[found]
        parts = [found.astype(np.int32), n[a, b].astype(np.int64), mean[a, b], mean[b, a], squares[a, b], squares[b, a], products[a, b], low[a, b], high[a, b], low[b, a], high[b, a]]
        yield pa.RecordBatch.from_arrays([pa.array(p) for p in parts], names=[f.split()[0] for f in MOMENTS.split(", ")])

    numbers = df.select(*[F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate(columns)])
    return numbers.mapInArrow(fold, MOMENTS)


def pearson(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Lower triangle without the diagonal, all pairs in one pass: ``(x_name, y_name, r)``; NULL without spread."""
    pairs = lower_triangle(columns, diagonal=False)
    blocks = stored(co_moments(df, columns, pairs), "co-moments")
    means = blocks.groupBy("pair").agg(*[(F.sum(F.col("n") * F.col(f"m{v}")) / F.sum("n")).alias(f"g{v}") for v in "xy"])
    centred = blocks.join(means, "pair")
    dx, dy = F.col("mx") - F.col("gx"), F.col("my") - F.col("gy")
    whole = centred.groupBy("pair").agg(
        F.sum(F.col("cxx") + F.col("n") * dx * dx).alias("xx"),
        F.sum(F.col("cyy") + F.col("n") * dy * dy).alias("yy"),
        F.sum(F.col("cxy") + F.col("n") * dx * dy).alias("xy"),
        ((F.min("lx") < F.max("hx")) & (F.min("ly") < F.max("hy"))).alias("spread"),
    )
    r = F.when(F.col("spread"), F.try_divide(F.col("xy"), F.sqrt("xx") * F.sqrt("yy")))
    return _all_pairs(whole.select("pair", r.alias("r")), pairs, ["r"])


def spearman(df: DataFrame, columns: Sequence[str], key: str = "ID", parts: int | None = None) -> DataFrame:
    """Lower triangle with the diagonal. Ranks are taken again inside each complete pair, ties averaged.

    One row per column and distinct value carries, for each partner column, how
    many rows share the value while the partner is present. One global order of
    those rows gives the ranks of all pairs at once; no pair is sorted on its own.
    ``key`` must be unique.
    """
    columns = list(columns)
    width = len(columns)
    present = [f"_has_{i}" for i in range(width)]
    flagged = df.select(
        key,
        *[F.col(c).cast("double").alias(f"{i}") for i, c in enumerate(columns)],
        *[F.col(c).isNotNull().cast("int").alias(p) for c, p in zip(columns, present)],
    )
    rows = (
        flagged.unpivot([key, *present], [f"{i}" for i in range(width)], "place", "value")
        .where(F.col("value").isNotNull())
        .withColumn("place", F.col("place").cast("int"))
    )
    counts = rows.groupBy("place", "value").agg(*[F.sum(p).alias(p) for p in present])
    ranked = cumulated(counts, ["place"], ["value"], present, parts)
    tables = ranked.select(
        "place",
        "value",
        F.array(*[F.col(f"before_{p}") + (F.col(p) + 1) / F.lit(2.0) for p in present]).alias("ranks"),
    )
    per_row = (
        rows.select(key, "place", "value")
        .join(tables, ["place", "value"])
        .groupBy(key)
        .agg(F.collect_list(F.struct("place", "ranks")).alias("entries"))
    )
    # A row has at most one entry per column, so its pairs are bounded by the matrix.
    pairs = (
        per_row.select("entries", F.explode("entries").alias("a"))
        .select("a", F.explode("entries").alias("b"))
        .where(F.col("a.place") >= F.col("b.place"))
        .select(
            F.col("a.place").alias("i"),
            F.col("b.place").alias("j"),
            F.get("a.ranks", F.col("b.place")).alias("x"),
            F.get("b.ranks", F.col("a.place")).alias("y"),
        )
    )
    results = pairs.groupBy("i", "j").agg(_plain_corr("x", "y").alias("r"))
    pair_number = (F.col("i") * (F.col("i") + 1) / 2).cast("int") + F.col("j")
    return _all_pairs(
        results.select(pair_number.alias("pair"), "r"), lower_triangle(columns, diagonal=True), ["r"]
    )


def transformed(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """For each pair the raw, semi-log and log-log correlation over complete rows.

    A logarithm is used only if the column has no negative value in the pair's rows.
    """
    logs = pair_rows(df, pairs).withColumns({f"l{v}": F.log1p(F.when(F.col(v) >= 0, F.col(v))) for v in ("x", "y")})
    facts = logs.groupBy("pair").agg(
        (F.min("x") >= 0).alias("x_log"),
        (F.min("y") >= 0).alias("y_log"),
        safe_corr(F.col("x"), F.col("y")).alias("r_raw"),
        safe_corr(F.col("x"), F.col("ly")).alias("semi"),
        safe_corr(F.col("lx"), F.col("y")).alias("reverse"),
        safe_corr(F.col("lx"), F.col("ly")).alias("both"),
    )
    chosen = (
        F.when(F.col("x_log") & F.col("y_log"), F.col("both"))
        .when(F.col("y_log"), F.col("semi"))
        .when(F.col("x_log"), F.col("reverse"))
        .otherwise(F.col("r_raw"))
    )
    results = facts.select(
        "pair", "r_raw", F.when(F.col("y_log"), F.col("semi")).alias("r_semilog"), chosen.alias("r_log")
    )
    return _all_pairs(results, pairs, ["r_raw", "r_semilog", "r_log"])
