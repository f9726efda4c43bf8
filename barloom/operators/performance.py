"""Performance over any range of dates, from summaries of blocks of days that can be merged.

A summary describes consecutive bars of one entity: the first and the last price, count, sum and sum of squares of the
returns between its normal bars, the highest and the lowest price, and the deepest drawdown with its peak and trough.
One bar is a summary; neighbouring summaries merge into that of all of them: one more return leads across each border,
and a lowest price is held against the highest before it. A range is then whole blocks, whose summaries are stored, and
at most two parts of blocks, the only bars that are read.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.spec import NORMAL, PanelSpec

#: Calendar days of a block.
BLOCK_DAYS = 32
PERFORMANCE_COLUMNS = (
    "first_date", "last_date", "n_sessions", "n_returns", "total_return", "vol_ann", "max_drawdown", "peak_date",
    "trough_date", "current_drawdown",
)
SUMMARY = (
    "first", "last", "first_normal", "last_normal", "n_bars", "n", "total", "squares", "top", "bottom", "deepest",
)


def block_of(day: str, days: int) -> Column:
    return F.floor(F.unix_date(day) / days).cast("int").alias("block")


def one_bar_summaries(bars: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """(entity, date, block, summary columns): each bar, given with its block, as a summary of itself. A larger ``top`` is a higher price, or the
    same price on an earlier date; a smaller ``deepest`` is a deeper drawdown, then an earlier trough, then peak."""
    day, price = F.col(spec.date), F.col("adjclose")
    bar = F.struct(day.alias("day"), price.alias("price"))
    normal = F.when(F.col("volume_status") == NORMAL, bar)
    return bars.select(
        *spec.key,
        "block",
        bar.alias("first"),
        bar.alias("last"),
        normal.alias("first_normal"),
        normal.alias("last_normal"),
        F.lit(1).cast("bigint").alias("n_bars"),
        F.lit(0).cast("bigint").alias("n"),
        F.lit(0.0).alias("total"),
        F.lit(0.0).alias("squares"),
        F.struct(price.alias("price"), (-F.unix_date(day)).alias("negated_day")).alias("top"),
        F.struct(price.alias("price"), day.alias("day")).alias("bottom"),
        F.struct(F.lit(0.0).alias("drawdown"), day.alias("trough"), day.alias("peak")).alias("deepest"),
    )


def _merge(rows: str, keys: str) -> str:
    """SQL: the summary of all ``rows`` of each key, in order of their days."""
    return f"""
        SELECT {keys}, min(first) AS first, max(last) AS last, min(first_normal) AS first_normal, max(last_normal) AS last_normal,
            sum(n_bars) AS n_bars, sum(n) + count(across) AS n, sum(total) + coalesce(sum(across), 0D) AS total,
            sum(squares) + coalesce(sum(across * across), 0D) AS squares, max(top) AS top, min(bottom) AS bottom,
            min(least(deepest, CASE WHEN high IS NOT NULL THEN named_struct('drawdown', bottom.price / high.price - 1, 'trough', bottom.day,
                'peak', date_from_unix_date(-high.negated_day)) END)) AS deepest
        FROM (
            SELECT *, first_normal.price / (last(last_normal, true) OVER earlier).price - 1 AS across, max(top) OVER earlier AS high
            FROM {rows} WINDOW earlier AS (PARTITION BY {keys} ORDER BY first.day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
        GROUP BY {keys}"""


def block_summaries(bars: DataFrame, spec: PanelSpec = PanelSpec(), days: int = BLOCK_DAYS) -> DataFrame:
    """(entity, block, summary columns): one row per entity and block of days that has bars. One shuffle, on entity and
    block, so that a long series is spread over its blocks."""
    placed = bars.select(*spec.key, "adjclose", "volume_status", block_of(spec.date, days))
    return bars.sparkSession.sql(_merge("{rows}", f"{spec.entity}, block"), rows=one_bar_summaries(placed, spec))


def store_blocks(bars: DataFrame, folder: str, spec: PanelSpec = PanelSpec(), days: int = BLOCK_DAYS) -> None:
    """Write ``bars`` and ``blocks`` below ``folder``. Bars lie in a folder per block, so that a range opens the files of
    its two edge blocks only; a large block is dealt to several files by entity."""
    kept = bars.select(*spec.key, "adjclose", "volume_status", block_of(spec.date, days))
    ordered = kept.repartitionByRange("block", spec.entity).sortWithinPartitions("block", *spec.key)
    ordered.write.partitionBy("block").parquet(f"{folder}/bars")
    block_summaries(bars, spec, days).sortWithinPartitions("block", spec.entity).write.parquet(f"{folder}/blocks")


def register_window_performance(
    spark: SparkSession, folder: str, name: str = "window_performance", spec: PanelSpec = PanelSpec(), days: int = BLOCK_DAYS
) -> None:
    """The SQL table function ``name(start_date, end_date)`` over the tables below ``folder``, for this session.

    It gives the measures of the bars from start to end, both included, as if nothing stood outside: the first bar is
    the base of the total return, the first normal one has no return. Entities without a bar in the range have no row;
    volatility is null with fewer than two returns. A range without a whole block is answered by its bars alone."""
    spark.read.parquet(f"{folder}/blocks").createOrReplaceTempView(f"{name}_blocks")
    one_bar_summaries(spark.read.parquet(f"{folder}/bars"), spec).createOrReplaceTempView(f"{name}_bars")
    first, last = f"ceil(unix_date(start_date) / {days}D)", f"floor((unix_date(end_date) + 1) / {days}D) - 1"
    columns = ", ".join(SUMMARY)
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(start_date DATE, end_date DATE) RETURNS TABLE (
            {spec.entity} STRING, first_date DATE, last_date DATE, n_sessions BIGINT, n_returns BIGINT, total_return DOUBLE, vol_ann DOUBLE,
            max_drawdown DOUBLE, peak_date DATE, trough_date DATE, current_drawdown DOUBLE)
        RETURN
        WITH pieces AS (
            SELECT {spec.entity}, {columns} FROM {name}_blocks WHERE block BETWEEN {first} AND {last}
            UNION ALL
            SELECT {spec.entity}, {columns} FROM {name}_bars
            WHERE block IN (floor(unix_date(start_date) / {days}D), floor(unix_date(end_date) / {days}D))
                AND NOT block BETWEEN {first} AND {last} AND {spec.date} BETWEEN start_date AND end_date),
        merged AS ({_merge("pieces", spec.entity)})
        SELECT {spec.entity}, first.day, last.day, n_bars, n, last.price / first.price - 1,
            CASE WHEN n > 1 THEN sqrt(greatest((squares - total * total / n) / (n - 1), 0D) * {spec.annualization}) END,
            deepest.drawdown, deepest.peak, deepest.trough, last.price / top.price - 1
        FROM merged""")


def window_performance(
    spark: SparkSession, start: datetime.date, end: datetime.date, name: str = "window_performance"
) -> DataFrame:
    """The registered function as a frame."""
    return spark.sql(f"SELECT * FROM {name}(CAST(:start AS DATE), CAST(:end AS DATE))", args={"start": start, "end": end})
