"""Exact quantiles from a state that merges over lanes: how often each value occurs.

A lane's summary keeps the state instead of its quantiles; states of lanes are added up by value,
and the quantiles of the sum are those of all values together, which no quantiles of the lanes could
give. Ranks are running sums over tiles of values, so no task holds all values of a key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.operators.intervals import running


def quantile_state(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, value (double), n: how many rows have each value. Null and NaN values and rows with a null key are left out."""
    fit = rows.where(" and ".join(f"`{c}` is not null" for c in (*keys, value))).select(*keys, F.col(value).cast("double").alias("value"))
    return fit.where(~F.isnan("value")).groupBy(*keys, "value").agg(F.count("*").alias("n"))


def merge_states(parts: DataFrame, keys: list[str]) -> DataFrame:
    """The states of several lanes as one: keys are those to keep, and lanes differ in others."""
    return parts.groupBy(*keys, "value").agg(F.sum("n").alias("n"))


def state_quantiles(state: DataFrame, keys: list[str], shares: tuple[float, ...] = (0.0, 0.25, 0.5, 0.75, 1.0), tile: float = 1024) -> DataFrame:
    """keys, n, quantiles: the values at shares of the ranks, with linear interpolation between neighbouring ranks.

    `tile` is how wide a range of values is summed in one place.
    """
    one = "_all"
    held = state.select(F.lit(1).alias(one), *keys, F.col("value").alias("at"), "n")
    by = [one, *keys]
    totals = held.groupBy(*by).agg(F.sum("n").alias("_total"))
    ranked = running(held, by, ["n"], tile).join(totals, by)
    rank = lambda p: p * (F.col("_total") - 1)

    def parts(i: int, p: float):
        low = F.floor(rank(F.lit(p)))
        here = (low >= F.col("sum_n") - F.col("n")) & (low < F.col("sum_n"))
        after = F.when(low + 1 < F.col("sum_n"), F.col("at")).otherwise(F.coalesce("next", "at"))
        return F.max(F.when(here, F.col("at") + (rank(F.lit(p)) - low) * (after - F.col("at")))).alias(f"_q{i}")

    found = ranked.groupBy(*by, "_total").agg(*[parts(i, p) for i, p in enumerate(shares)])
    return found.select(*keys, F.col("_total").alias("n"), F.array(*[F.col(f"_q{i}") for i in range(len(shares))]).alias("quantiles"))
