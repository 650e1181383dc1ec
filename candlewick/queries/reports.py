"""Analytic queries over the models."""

from __future__ import annotations

from candlewick.adapters import AS_OF, SPAN, ticks
from candlewick.plans import reports
from candlewick.queries.base import CANDLE_X_NUMBERS, NOW, query, sql
from candlewick.queries.models import ohlcv_by_exchange, stg, stg_latest, stg_summary

_SINCE = f">= {NOW} - INTERVAL 31 DAYS"


def _d(column: str, digits: int = 2) -> str:
    return f"CAST(round(CAST({column} AS DECIMAL(38,12)), {digits}) AS DOUBLE)"


@query(
    "q_current_prices",
    sql(
        f"""SELECT symbol, {_d('latest_price')} AS current_price, {_d('price_change_pct_24h')} AS change_24h_pct,
                   {_d('volume_24h')} AS total_volume_24h, {_d('spread_percentage', 4)} AS spread_pct,
                   strftime(last_updated, '%Y-%m-%d %H:%M:%S') AS last_update FROM latest""",
        "latest",
    ),
)
def q_current_prices(spark, sf_dir):
    return reports.current_prices(stg_latest(spark, sf_dir))


def _movers(sign: str, direction: str, name: str) -> str:
    return sql(
        f"""SELECT symbol, {_d('latest_price')} AS price, {_d('price_change_pct_24h')} AS {name} FROM latest
            WHERE price_change_pct_24h {sign} 0 ORDER BY price_change_pct_24h {direction}, symbol LIMIT 5""",
        "latest",
    )


@query("q_top_gainers", _movers(">", "DESC", "gain_pct"))
def q_top_gainers(spark, sf_dir):
    return reports.top_gainers(stg_latest(spark, sf_dir))


@query("q_top_losers", _movers("<", "ASC", "loss_pct"))
def q_top_losers(spark, sf_dir):
    return reports.top_losers(stg_latest(spark, sf_dir))


@query(
    "q_most_active",
    sql(
        f"""SELECT symbol, updates_24h, {_d('volume_24h')} AS total_volume_24h, {_d('latest_price')} AS current_price
            FROM latest ORDER BY updates_24h DESC, symbol LIMIT 10""",
        "latest",
    ),
)
def q_most_active(spark, sf_dir):
    return reports.most_active(stg_latest(spark, sf_dir))


@query(
    "q_symbol_windows",
    sql(
        f"""SELECT strftime(window_start, '%Y-%m-%d %H:%M') AS period, symbol, {_d('min_price')} AS low,
                   {_d('avg_price')} AS average, {_d('max_price')} AS high,
                   {_d('price_range_percentage')} AS volatility_pct, update_count AS updates, activity_level
            FROM summary WHERE symbol = 'purchase' AND window_start {_SINCE}""",
        "summary",
    ),
)
def q_symbol_windows(spark, sf_dir):
    return reports.symbol_windows(stg_summary(spark, sf_dir), "purchase", SPAN, AS_OF)


@query(
    "q_most_volatile",
    sql(
        f"""SELECT strftime(window_start, '%Y-%m-%d %H:%M') AS period, symbol,
                   {_d('price_range_percentage')} AS price_range_pct, {_d('coefficient_of_variation')} AS cv_pct,
                   activity_level
            FROM summary WHERE window_start {_SINCE} AND price_range_percentage > 0.5
            ORDER BY price_range_percentage DESC, window_start, symbol LIMIT 10""",
        "summary",
    ),
)
def q_most_volatile(spark, sf_dir):
    return reports.most_volatile(stg_summary(spark, sf_dir), SPAN, AS_OF)


@query(
    "q_activity_heatmap",
    sql(
        f"""SELECT symbol, strftime(window_start, '%Y-%m-%d %H:%M') AS time_slot, activity_level, update_count
            FROM summary WHERE window_start {_SINCE}""",
        "summary",
    ),
)
def q_activity_heatmap(spark, sf_dir):
    return reports.activity_heatmap(stg_summary(spark, sf_dir), SPAN, AS_OF)


@query(
    "q_avg_spreads",
    sql(
        f"""SELECT symbol, count(*) AS windows, {_d('avg(avg_spread)', 4)} AS avg_spread,
                   {_d('avg(avg_spread_pct)', 4)} AS avg_spread_pct, {_d('max(max_spread)', 4)} AS max_spread_seen
            FROM summary WHERE window_start {_SINCE} GROUP BY 1""",
        "summary",
    ),
)
def q_avg_spreads(spark, sf_dir):
    return reports.average_spreads(stg_summary(spark, sf_dir), SPAN, AS_OF)


@query(
    "q_price_vs_avg",
    sql(
        f"""SELECT l.symbol, {_d('l.latest_price')} AS current_price, {_d('p.avg_price')} AS window_avg,
                   {_d('(CAST(l.latest_price AS DOUBLE) - CAST(p.avg_price AS DOUBLE)) / CAST(p.avg_price AS DOUBLE) * 100')} AS diff_pct
            FROM latest l JOIN (SELECT DISTINCT ON (symbol) symbol, avg_price FROM summary WHERE window_start {_SINCE}
                                ORDER BY symbol, window_start DESC) p ON l.symbol = p.symbol""",
        "latest summary",
    ),
)
def q_price_vs_avg(spark, sf_dir):
    return reports.price_vs_average(stg_latest(spark, sf_dir), stg_summary(spark, sf_dir), SPAN, AS_OF)


@query(
    "q_daily_stats",
    sql(
        f"""SELECT count(DISTINCT symbol) AS active_symbols, CAST(sum(updates_24h) AS BIGINT) AS total_updates_24h,
                   {_d('avg(price_change_pct_24h)')} AS avg_change_pct, {_d('sum(volume_24h)')} AS total_volume_24h
            FROM latest""",
        "latest",
    ),
)
def q_daily_stats(spark, sf_dir):
    return reports.daily_statistics(stg_latest(spark, sf_dir))


@query(
    "q_stale_symbols",
    sql(
        f"""SELECT symbol, strftime(last_updated, '%Y-%m-%d %H:%M:%S') AS last_update,
                   (epoch_us({NOW}) - epoch_us(last_updated)) / 1000000.0 / 60 AS minutes_since_update
            FROM latest WHERE last_updated < {NOW} - INTERVAL 5 MINUTES""",
        "latest",
        "minutes_since_update",
    ),
)
def q_stale_symbols(spark, sf_dir):
    return reports.stale_symbols(stg_latest(spark, sf_dir), as_of=AS_OF)


@query(
    "q_window_completeness",
    sql(
        f"""SELECT strftime(window_start, '%Y-%m-%d %H:%M') AS "window", count(DISTINCT symbol) AS symbols_count,
                   CAST(sum(update_count) AS BIGINT) AS total_updates
            FROM summary WHERE window_start {_SINCE} GROUP BY 1""",
        "summary",
    ),
)
def q_window_completeness(spark, sf_dir):
    return reports.window_completeness(stg_summary(spark, sf_dir), SPAN, AS_OF)


@query(
    "q_irregular_symbols",
    sql(
        f"""SELECT symbol, count(*) AS windows_with_data, {_d('avg(update_count)')} AS avg_updates_per_window,
                   min(update_count) AS min_updates, max(update_count) AS max_updates
            FROM summary WHERE window_start {_SINCE} GROUP BY 1 HAVING count(*) < 2976""",
        "summary",
    ),
)
def q_irregular_symbols(spark, sf_dir):
    return reports.irregular_symbols(stg_summary(spark, sf_dir), SPAN, AS_OF, expected=31 * 96)


@query(
    "q_model_refresh",
    sql(
        f"""SELECT 'latest_prices' AS model, max(refreshed_at) AS last_refresh,
                   (epoch_us({NOW}) - epoch_us(max(refreshed_at))) / 60000000.0 AS minutes_since_refresh FROM latest
            UNION ALL SELECT 'price_summary', max(updated_at), (epoch_us({NOW}) - epoch_us(max(updated_at))) / 60000000.0
            FROM summary""",
        "latest summary",
        "minutes_since_refresh",
    ),
)
def q_model_refresh(spark, sf_dir):
    models = {
        "latest_prices": (stg_latest(spark, sf_dir), "refreshed_at"),
        "price_summary": (stg_summary(spark, sf_dir), "updated_at"),
    }
    return reports.model_refresh(models, AS_OF)


@query(
    "q_row_counts",
    sql(
        """SELECT 'latest_prices' AS model, count(*) AS row_count FROM latest
           UNION ALL SELECT 'price_summary', count(*) FROM summary UNION ALL SELECT 'stg_ticks', count(*) FROM stg""",
        "stg latest summary",
    ),
)
def q_row_counts(spark, sf_dir):
    return reports.row_counts(
        {
            "stg_ticks": stg(spark, sf_dir),
            "latest_prices": stg_latest(spark, sf_dir),
            "price_summary": stg_summary(spark, sf_dir),
        }
    )


@query(
    "q_recent_candles",
    sql("SELECT * FROM candles_x ORDER BY bucket DESC, symbol, exchange LIMIT 10", "candles_x", CANDLE_X_NUMBERS),
)
def q_recent_candles(spark, sf_dir):
    return reports.recent_candles(ohlcv_by_exchange(spark, sf_dir))


@query(
    "q_summary_stats",
    sql(
        """SELECT count(DISTINCT symbol) AS unique_symbols, count(*) AS total_windows,
                  strftime(max(window_start), '%Y-%m-%d %H:%M') AS latest_window FROM summary""",
        "summary",
    ),
)
def q_summary_stats(spark, sf_dir):
    return reports.summary_statistics(stg_summary(spark, sf_dir))


@query(
    "q_recent_windows",
    sql(
        f"""SELECT symbol, strftime(window_start, '%H:%M') AS "time", {_d('avg_price')} AS avg_price, update_count,
                   activity_level FROM summary WHERE window_start {_SINCE} ORDER BY window_start DESC, symbol LIMIT 5""",
        "summary",
    ),
)
def q_recent_windows(spark, sf_dir):
    return reports.recent_windows(stg_summary(spark, sf_dir), SPAN, AS_OF)


@query(
    "q_incremental_check",
    sql(
        """SELECT max(window_start) AS newest_window, count(*) AS windows FROM summary
           WHERE window_start >= TIMESTAMP '2024-01-30 00:00:00'""",
        "summary",
    ),
)
def q_incremental_check(spark, sf_dir):
    return reports.incremental_check(stg_summary(spark, sf_dir), "2024-01-30 18:00:00")


@query(
    "q_windows_by_symbol",
    sql(f"SELECT symbol, count(*) AS windows FROM summary WHERE window_start {_SINCE} GROUP BY 1", "summary"),
)
def q_windows_by_symbol(spark, sf_dir):
    return reports.windows_by_symbol(stg_summary(spark, sf_dir), SPAN, AS_OF)


@query("q_raw_summary", sql("SELECT count(*) AS row_count, max(time) AS last_time FROM ticks", "ticks"))
def q_raw_summary(spark, sf_dir):
    return reports.raw_summary(ticks(spark, sf_dir))


@query(
    "q_check_prices",
    sql(
        f"""SELECT symbol, max(time) AS latest, count(*) AS total, {_d('avg(price)')} AS avg_price
           FROM ticks GROUP BY 1""",
        "ticks",
    ),
)
def q_check_prices(spark, sf_dir):
    return reports.check_prices(ticks(spark, sf_dir))
