"""DataFrame-to-DataFrame operators."""

from tickframe.operators.dedup import (
    best_per_key,
    keep_first,
    last_rows,
    latest_per_minute,
    latest_per_symbol,
    serving_rows,
)
from tickframe.operators.enrich import enrich, metric_rows, profile_rows, quote_rows
from tickframe.operators.incremental import (
    analyze_new,
    continue_trailing,
    drop_processed,
    look_back,
    minute_rows,
    with_trailing,
)
from tickframe.operators.indicators import derive_indicators
from tickframe.operators.quality import column_availability, freshness, null_counts, profile, quality_report
from tickframe.operators.rolling import moving_average, trailing_range, trailing_rows
from tickframe.operators.rollups import (
    daily_average,
    daily_moving_average,
    daily_summary,
    hourly_price,
    hourly_volatility,
    run_summary,
)
from tickframe.operators.serving import detail_table, kpi_texts, kpis, recent_history
from tickframe.operators.universe import choose_universe, restrict

__all__ = [name for name in dir() if not name.startswith("_")]
