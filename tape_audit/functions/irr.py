"""Discounted-cash-flow operators over a cash-flow table.

Flows are first added up per (group, day), so what is gathered per group is bounded by the calendar, not by
the number of flows. The bisection is a fold of built-in higher-order functions: no Python runs.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tape_audit.functions.money import euros, micros


def xnpv(flows: DataFrame, by: list[str], date: str, amount: str, rate: float) -> DataFrame:
    """Net present value per group at a fixed annual rate, 365-day years from the first flow."""
    daily = _daily(flows, by, date, {"_cf": F.col(amount)})
    first_day = F.min(date).over(Window.partitionBy(*by))
    years = F.datediff(F.col(date), F.col("_t0")) / F.lit(365.0)
    return (
        daily.withColumn("_t0", first_day)
        .groupBy(*by)
        .agg(F.sum(F.col("_cf") / F.pow(F.lit(1.0 + rate), years)).alias("npv"))
    )


def _daily(flows: DataFrame, by: list[str], date: str, values: dict[str, Column]) -> DataFrame:
    sums = flows.groupBy(*by, date).agg(
        *[F.try_sum(micros(c)).alias(name) for name, c in values.items()]
    )
    return sums.select(*by, date, *[euros(F.col(n)).alias(n) for n in values])


def _present_value(flows: Column, rate: Column) -> Column:
    return F.aggregate(
        flows, F.lit(0.0),
        lambda acc, f: acc + F.try_divide(f["cf"], F.pow(F.lit(1.0) + rate, f["years"])),
    )


def solve(flows: Column, low: float, high: float, tol: float = 1e-7, max_iter: int = 200) -> Column:
    """Root of the present value of ``array<struct<years, cf>>`` by bisection, NULL without a bracket."""
    steps = min(max_iter, math.ceil(math.log2((high - low) / tol)) + 1)
    start = F.struct(
        F.lit(low).alias("lo"), F.lit(high).alias("hi"),
        _present_value(flows, F.lit(low)).alias("f_lo"),
        F.lit(None).cast("double").alias("root"),
    )

    def step(state: Column, _i: Column) -> Column:
        mid = (state["lo"] + state["hi"]) / 2.0

        def advance(f_mid: Column) -> Column:
            left = state["f_lo"] * f_mid < 0
            hit = (F.abs(f_mid) < tol) | ((state["hi"] - state["lo"]) / 2.0 < tol)
            return F.struct(
                F.when(left, state["lo"]).otherwise(mid).alias("lo"),
                F.when(left, mid).otherwise(state["hi"]).alias("hi"),
                F.when(left, state["f_lo"]).otherwise(f_mid).alias("f_lo"),
                F.when(hit, mid).alias("root"),
            )

        # a one-element transform binds the present value once per step
        moved = F.get(F.transform(F.array(_present_value(flows, mid)), advance), F.lit(0))
        return F.when(state["root"].isNotNull(), state).otherwise(moved)

    end = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step)
    bracket = _present_value(flows, F.lit(low)) * _present_value(flows, F.lit(high)) <= 0
    two_signed = F.exists(flows, lambda f: f["cf"] < 0) & F.exists(flows, lambda f: f["cf"] > 0)
    return F.when((F.size(flows) >= 2) & two_signed & bracket,
                  F.coalesce(end["root"], (end["lo"] + end["hi"]) / 2.0))


def xirr(
    flows: DataFrame, by: list[str], date: str, amounts: dict[str, str],
    low: float = -0.99, high: float = 10.0,
) -> DataFrame:
    """Annualised IRR per group. ``amounts`` maps an output name to a flow column, so several timings of the
    same cash are solved after one shuffle."""
    daily = _daily(flows, by, date, {f"_cf_{n}": F.col(c) for n, c in amounts.items()})
    gathered = daily.groupBy(*by).agg(
        F.array_sort(F.collect_list(F.struct(
            F.col(date).alias("day"), *[F.col(f"_cf_{n}") for n in amounts]
        ))).alias("_days")
    )
    for name in amounts:
        cf = f"_cf_{name}"
        with_flow = F.filter("_days", lambda f: f[cf] != 0)
        gathered = gathered.withColumn(f"_f_{name}", with_flow)
        gathered = gathered.withColumn(
            f"_f_{name}",
            F.transform(f"_f_{name}", lambda f: F.struct(
                (F.datediff(f["day"], F.get(F.col(f"_f_{name}"), F.lit(0))["day"]) / 365.0).alias("years"),
                f[cf].alias("cf"),
            )),
        )
    return gathered.select(
        *by, *[solve(F.col(f"_f_{n}"), low, high).alias(n) for n in amounts]
    )
