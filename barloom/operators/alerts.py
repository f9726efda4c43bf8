"""Changes of level in the history of checks, by cumulative sums with reset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Runs that set a level before deviations count, the deviation that is let pass, and the sum that raises an alert; the
#: last two in units of the spread.
WARM_UP, SLACK, LIMIT = 8, 1.0, 6.0


def level_alerts(
    history: DataFrame, check: str = "check_name", run: str = "checked_at", value: str = "failing_count",
    warm_up: int = WARM_UP, slack: float = SLACK, limit: float = LIMIT,
) -> DataFrame:
    """One row per check and run: the value, the ``level`` and ``spread`` it is held against (null while they are being
    set), the sums ``up`` and ``down``, and ``alert``: up, down, or null.

    The level is the mean of the runs since the last alert, the spread their sample deviation, at least 1. From the
    ``warm_up``-th of them on, each run adds its deviation in spreads, less ``slack``, to the sum of its direction, which
    never falls below zero. A sum above ``limit`` is an alert; level and sums then start anew with that run, so a shift
    is told once, on the run in which it adds up, which a large one does at once.

    A check has one row per run, so its ordered history is a short list, folded in one pass inside the engine. Runs
    without a value are left out; of runs at the same time the smaller value comes first.
    """
    runs = history.where(F.col(value).isNotNull()).groupBy(check).agg(
        F.array_sort(F.collect_list(F.struct(F.col(run).alias("run"), F.col(value).cast("double").alias("value")))).alias("runs")
    )
    row = "run: timestamp, value: double, level: double, spread: double, up: double, down: double, alert: string"
    run_type = history.schema[run].dataType.simpleString()
    row = row.replace("run: timestamp", f"run: {run_type}")
    start = F.struct(
        F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("squares"), F.lit(0.0).alias("up"), F.lit(0.0).alias("down"),
        F.array().cast(f"array<struct<{row}>>").alias("out"),
    )

    def step(state: Column, now: Column) -> Column:
        n, mean, x = state["n"], state["mean"], now["value"]
        ready = n >= warm_up
        spread = F.greatest(F.sqrt(state["squares"] / F.greatest(n - 1, F.lit(1.0))), F.lit(1.0))
        deviation = (x - mean) / spread
        up = F.when(ready, F.greatest(state["up"] + deviation - slack, F.lit(0.0))).otherwise(0.0)
        down = F.when(ready, F.greatest(state["down"] - deviation - slack, F.lit(0.0))).otherwise(0.0)
        alert = F.when(up > limit, "up").when(down > limit, "down")
        fresh = alert.isNotNull()
        later = mean + (x - mean) / (n + 1)
        told = F.struct(
            now["run"].alias("run"), x.alias("value"), F.when(ready, mean).alias("level"), F.when(ready, spread).alias("spread"),
            up.alias("up"), down.alias("down"), alert.alias("alert"),
        )
        return F.struct(
            F.when(fresh, 1.0).otherwise(n + 1).alias("n"),
            F.when(fresh, x).otherwise(later).alias("mean"),
            F.when(fresh, 0.0).otherwise(state["squares"] + (x - mean) * (x - later)).alias("squares"),
            F.when(fresh, 0.0).otherwise(up).alias("up"),
            F.when(fresh, 0.0).otherwise(down).alias("down"),
            F.concat(state["out"], F.array(told)).alias("out"),
        )

    folded = runs.select(check, F.inline(F.aggregate("runs", start, step, lambda state: state["out"])))
    return folded.withColumnRenamed("run", run).withColumnRenamed("value", value)
