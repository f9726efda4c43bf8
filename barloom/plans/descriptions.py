"""Comments for the published measure tables and their columns."""

_LINEAGE = {
    "source_run_id": "Id of the source run the rows were landed by.",
    "source_ingested_at": "Newest ingestion time among the source rows.",
    "pipeline_run_id": "Id of the run that wrote this table.",
    "built_at": "When that run built its tables.",
}

GOLD_COMMENTS: dict[str, tuple[str, dict[str, str]]] = {
    "dim_ticker": (
        "Entity dimension, from the configured universe.",
        {"ticker": "Entity key.", **_LINEAGE},
    ),
    "fact_daily_metrics": (
        "Measures per entity and trading date since the common base date; prices are adjusted closes.",
        {
            "ticker": "Entity; first part of the key.",
            "trade_date": "Trading date; second part of the key.",
            "volume_status": "normal, zero_all_tickers (no entity traded that day) or zero_partial (others did).",
            "normalized_index": "Adjusted close as a percentage of its value on the base date.",
            "daily_return": "Simple return against the previous normal row; NULL on flagged rows and on the first row.",
            "vol_60d_ann": "Annualised sample deviation of the latest returns in the window; NULL until it is full.",
            "running_peak": "Largest adjusted close so far.",
            "drawdown": "Distance below the running peak as a fraction; zero or negative.",
            "rel_volume_60d": "Volume over the mean of the preceding normal rows in the window; NULL until it is full.",
            **_LINEAGE,
        },
    ),
    "fact_monthly_metrics": (
        "Return and mean volume per entity and calendar month.",
        {
            "ticker": "Entity; first part of the key.",
            "month_start": "First day of the month; second part of the key.",
            "monthly_return": "Last adjusted close of the month over that of the month before, less one.",
            "avg_daily_volume": "Mean volume of the month's normal rows.",
            "is_partial": "Whether the month is the entity's first, or not yet over at the last date of the data.",
            **_LINEAGE,
        },
    ),
    "fact_yearly_metrics": (
        "Return per entity and calendar year.",
        {
            "ticker": "Entity; first part of the key.",
            "year": "Calendar year; second part of the key.",
            "yearly_return": "Last adjusted close of the year over that of the year before, less one.",
            "is_partial": "Whether the year is the entity's first, or not yet over at the last date of the data.",
            **_LINEAGE,
        },
    ),
    "ticker_summary": (
        "Full-period measures per entity since the common base date.",
        {
            "ticker": "Entity key.",
            "total_return": "Last adjusted close over the one on the base date, less one.",
            "vol_full_ann": "Annualised sample deviation of all daily returns.",
            "max_drawdown": "The most negative drawdown.",
            "peak_date": "Day the peak before the deepest drawdown was set.",
            "trough_date": "First day of the deepest drawdown.",
            "current_drawdown": "Drawdown on the entity's last date.",
            "base_date": "First date on which every entity traded normally.",
            "last_trade_date": "Entity's last date.",
            **_LINEAGE,
        },
    ),
}
