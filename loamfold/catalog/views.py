"""Sample, mask, date, cell, scene and daily views over the star-schema test tables.

Every view is a list of column expressions over one table. The two engines
read the same expressions; only the few functions that are spelled
differently come from a dialect.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from loamfold.functions.fixed import TARGETS

# One odd multiplier per target, for arithmetic that differs by target.
MULTIPLIERS = [2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31, 37, 41]


@dataclass(frozen=True)
class Dialect:
    spark: bool

    @property
    def text(self) -> str:
        return "STRING" if self.spark else "VARCHAR"

    def name(self, column: str) -> str:
        return f"`{column}`" if self.spark else f'"{column}"'

    def div(self, a: str, b: str) -> str:
        return f"({a} div {b})" if self.spark else f"({a} // {b})"

    def months(self, day: str, n: str) -> str:
        if self.spark:
            return f"add_months({day}, CAST({n} AS INT))"
        return f"CAST({day} + to_months(CAST({n} AS INTEGER)) AS DATE)"

    def days(self, day: str, n: str) -> str:
        if self.spark:
            return f"date_add({day}, CAST({n} AS INT))"
        return f"CAST({day} + to_days(CAST({n} AS INTEGER)) AS DATE)"

    def dmy(self, day: str) -> str:
        return f"date_format({day}, 'dd/MM/yyyy')" if self.spark else f"strftime({day}, '%d/%m/%Y')"

    def iso(self, day: str) -> str:
        return f"date_format({day}, 'yyyy-MM-dd')" if self.spark else f"strftime({day}, '%Y-%m-%d')"

    def hours(self, expression: str) -> str:
        """An array over ``h`` = 0…23."""
        if self.spark:
            return f"transform(sequence(0, 23), h -> {expression})"
        return f"list_transform(range(24), lambda h: {expression})"


SPARK, DUCK = Dialect(True), Dialect(False)

LAT = "((user_id * 37) % 700) / 1e1 - 35e0"
LON = "((user_id * 53) % 700) / 1e1 - 2e1"


def _place(expr: str) -> str:
    return f"CASE WHEN event_id % 97 = 5 THEN NULL ELSE {expr} END"


def _depth() -> str:
    cases = ["0-20", "20-50", "0 - 20", "30", None, "0-20", "20-50", "abc", "20-", "1.5-2.5", "0-20"]
    whens = " ".join(
        f"WHEN {i} THEN {'NULL' if c is None else repr(c)}" for i, c in enumerate(cases)
    )
    return f"CASE event_id % 11 {whens} END"


def _start(d: Dialect) -> str:
    return d.months("CAST(ts AS DATE)", "-12 * (event_id % 17)")


def _end(d: Dialect) -> str:
    return d.days(_start(d), "event_id % 900")


def _start_text(d: Dialect) -> str:
    return (
        f"CASE event_id % 13 WHEN 3 THEN {d.iso(_start(d))} WHEN 7 THEN 'n/a' WHEN 9 THEN NULL "
        f"ELSE {d.dmy(_start(d))} END"
    )


def _end_text(d: Dialect) -> str:
    return f"CASE event_id % 11 WHEN 4 THEN 'unknown' WHEN 6 THEN NULL ELSE {d.dmy(_end(d))} END"


def target_value(i: int) -> str:
    p = MULTIPLIERS[i]
    return (
        f"CASE WHEN (event_id + {i}) % {3 + i} = 0 THEN NULL WHEN (event_id + {i}) % 23 = 0 THEN 0e0 "
        f"ELSE value * (1e0 + ((event_id * {p}) % 11) / 1e1) END"
    )


def _sample_columns(d: Dialect) -> list[tuple[str, str]]:
    return [
        ("ID", "event_id"),
        ("site", "user_id"),
        ("Latitude", _place(LAT)),
        ("Longitude", _place(LON)),
        ("Depth_cm", _depth()),
        ("horizon_upper", f"CASE WHEN event_id % 4 = 1 THEN NULL ELSE CAST(event_id % 30 AS {d.text}) END"),
        ("horizon_lower", f"CASE WHEN event_id % 6 = 1 THEN NULL ELSE CAST(event_id % 30 + 10 + event_id % 5 AS {d.text}) END"),
        ("start_date", _start_text(d)),
        ("end_date", _end_text(d)),
        (
            "ph",
            f"CASE event_id % 19 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'n/a' "
            f"ELSE CAST((40 + event_id % 45) / 1e1 AS {d.text}) END",
        ),
        ("electrical_conductivity", "CASE WHEN event_id % 5 = 0 THEN NULL ELSE value / 1e1 END"),
        ("C_organic", "CASE WHEN event_id % 6 = 0 THEN NULL ELSE value / 2e1 - 1e0 END"),
        ("C_total", "CASE WHEN event_id % 7 = 0 THEN NULL ELSE value / 1e1 END"),
        *[(t, target_value(i)) for i, t in enumerate(TARGETS)],
    ]


def _prediction(i: int, shift: int) -> str:
    p = MULTIPLIERS[i]
    return (
        f"CASE WHEN (event_id + {i + shift}) % 31 = 0 THEN NULL "
        f"ELSE ((event_id * {p} + {shift}) % 1009) / 1e1 - 5e0 END"
    )


NO_TEST_COLUMNS = {"horizon_upper", "horizon_lower", "ph", "electrical_conductivity", "C_organic", "C_total", *TARGETS}


def view_parts(name: str, d: Dialect) -> tuple[str, list[tuple[str, str]], str | None]:
    """Base table, columns and filter of a view."""
    samples = _sample_columns(d)
    test_only = "event_id % 8 = 0"
    if name == "samples":
        return "events", samples, None
    if name == "train":
        return "events", samples, "event_id % 8 <> 0"
    if name == "test":
        return "events", [(n, e) for n, e in samples if n not in NO_TEST_COLUMNS], test_only
    if name == "test_measured":
        return "events", samples, test_only
    if name == "test_undated":
        dated = NO_TEST_COLUMNS | {"start_date", "end_date"}
        return "events", [(n, e) for n, e in samples if n not in dated], test_only
    if name == "train_numeric":
        numeric = [(n, e) for n, e in samples if n not in {"ph", "start_date", "end_date", "horizon_upper", "horizon_lower"}]
        ph = "CASE WHEN event_id % 19 < 3 THEN NULL ELSE (40 + event_id % 45) / 1e1 END"
        return "events", [*numeric, ("ph", ph)], "event_id % 8 <> 0"
    if name == "dates":
        return (
            "events",
            [
                ("ID", "event_id"),
                ("set", "CASE WHEN event_id % 8 = 0 THEN 'Test' ELSE 'Train' END"),
                ("start_date", _start_text(d)),
                ("end_date", f"CASE event_id % 11 WHEN 4 THEN 'unknown' ELSE {d.dmy(_end(d))} END"),
            ],
            "event_id % 9 <> 0",
        )
    if name == "mask":
        eighth = d.div("event_id", "8")
        cells = [
            (t, f"CASE WHEN ({eighth} * {MULTIPLIERS[i]}) % 7 < 3 THEN 0 ELSE 1 END") for i, t in enumerate(TARGETS)
        ]
        return "events", [("ID", "event_id"), *cells], f"{test_only} AND {eighth} % 13 <> 0"
    if name == "full_mask":
        _, columns, _ = view_parts("mask", d)
        return "events", columns, test_only
    if name in ("preds_a", "preds_b"):
        shift = 0 if name == "preds_a" else 7
        cells = [(f"Target_{t}", _prediction(i, shift)) for i, t in enumerate(TARGETS)]
        return "events", [("ID", "event_id"), *cells], test_only
    if name == "cells":
        return (
            "customer",
            [
                ("row", d.div("c_custkey", "30")),
                ("col", "c_custkey % 30"),
                ("bio1", "CASE WHEN c_acctbal < 0 THEN -9999e0 ELSE c_acctbal END"),
                ("bio12", "CASE WHEN c_nationkey = 3 THEN -9999e0 ELSE CAST(c_nationkey AS DOUBLE) END"),
            ],
            None,
        )
    if name == "pixels":
        lat = LAT.replace("user_id", "(s_suppkey % 150)")
        lon = LON.replace("user_id", "(s_suppkey % 150)")
        return (
            "supplier",
            [
                ("pixel_id", "s_suppkey"),
                ("Latitude", f"{lat} + ((s_suppkey * 7) % 11 - 5) / 1e3"),
                ("Longitude", lon),
            ],
            None,
        )
    if name == "scenes":
        shift = "CASE l_orderkey % 3 WHEN 0 THEN 264 WHEN 1 THEN 216 ELSE 156 END"
        return (
            "lineitem",
            [
                ("pixel_id", "l_suppkey"),
                ("sensor", "CASE l_orderkey % 3 WHEN 0 THEN 'S2' WHEN 1 THEN 'L8' ELSE 'L7' END"),
                ("ts", d.months("CAST(l_shipdate AS DATE)", shift)),
                ("cloud_pct", "l_partkey % 100"),
                ("blue", "2e-2 + l_quantity / 1e3"),
                ("green", "3e-2 + (l_partkey % 97) / 1e3"),
                ("red", "4e-2 + l_tax"),
                ("nir", "2e-1 + floor(l_extendedprice / 1e1) / 1e5"),
                ("nir_narrow", "21e-2 + l_discount"),
                ("swir1", "1e-1 + (l_orderkey % 200) / 1e3"),
                ("swir2", "5e-2 + l_linenumber / 1e2"),
            ],
            None,
        )
    if name == "daily":
        return (
            "events",
            [
                ("ID", "user_id"),
                ("temps", d.hours("CASE WHEN (event_id + h) % 5 = 0 THEN NULL ELSE value / 1e1 + h END")),
                ("rains", d.hours("CASE WHEN (event_id + h) % 7 = 0 THEN NULL ELSE value * (h % 4) END")),
            ],
            None,
        )
    if name == "oof":
        return (
            "events",
            [
                ("ID", "event_id"),
                ("target", "event_type"),
                ("fold", "CAST(event_id % 5 AS INT)"),
                ("y", "value"),
                ("pred", "value * (8e-1 + (event_id % 7) / 1e1) - 1e0"),
            ],
            "event_id % 8 <> 0",
        )
    if name == "cache":
        return (
            "events",
            [
                ("ID", f"{d.div('event_id', '4')} * 3"),
                ("seq", "event_id"),
                ("a", "CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END"),
                ("b", "CASE WHEN event_id % 2 = 0 THEN NULL ELSE value * 2e0 END"),
            ],
            None,
        )
    if name == "soil":
        lat = LAT.replace("user_id", "(s_suppkey % 150)")
        lon = LON.replace("user_id", "(s_suppkey % 150)")
        return (
            "supplier",
            [
                ("s_suppkey", "s_suppkey"),
                ("lat", lat),
                ("lon", lon),
                ("nation", "s_nationkey"),
                ("base", "s_acctbal"),
            ],
            None,
        )
    raise KeyError(name)


def spark_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table, columns, condition = view_parts(name, SPARK)
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    df = df if condition is None else df.where(condition)
    return df.selectExpr(*[f"{expr} AS {SPARK.name(column)}" for column, expr in columns])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def duck_view(name: str) -> str:
    base, columns, condition = view_parts(name, DUCK)
    listed = ", ".join(f"{expr} AS {DUCK.name(column)}" for column, expr in columns)
    where = "" if condition is None else f" WHERE {condition}"
    return f"{name} AS (SELECT {listed} FROM {base}{where})"


def with_views(names: list[str], body: str, recursive: bool = False) -> str:
    """``WITH`` clauses for the views, before a body that may bring clauses of its own."""
    clauses = ", ".join(duck_view(n) for n in names)
    word = "WITH RECURSIVE " if recursive else "WITH "
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"{word}{clauses}, {body[5:]}" if clauses else f"{word}{body[5:]}"
    return f"{word}{clauses} {body}" if clauses else body
