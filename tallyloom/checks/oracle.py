"""DuckDB SQL for each registered query, over views named like the test tables."""

from __future__ import annotations

from .bindings import BACKFILL_END, BACKFILL_START, ORDERS_SQL, RUN_DATE, SALES_SQL, SPLIT

ORDERS = ORDERS_SQL.format(orders="orders")
SALES = SALES_SQL.format(events="events")
KEY = "customer_id, order_month"
DATA_DAY = f"DATE '{RUN_DATE}' - INTERVAL 1 DAY"

# Latest month before the split, as the stored state has it.
MARK = (
    "(SELECT MAX(CAST(DATE_TRUNC('month', order_date) AS DATE)) FROM ord "
    f"WHERE order_status = 'completed' AND order_date < TIMESTAMP '{SPLIT}')"
)

SALES_COLUMNS = (
    "order_id, customer_id, product_id, CAST(amount AS DOUBLE) AS amount, status, created_at"
)
ORDER_COLUMNS = (
    "customer_id, order_id, CAST(order_amount AS DOUBLE) AS order_amount, order_date, order_status"
)


def growth(cur: str, prev: str) -> str:
    base = f"NULLIF(CAST({prev} AS DOUBLE), 0)"
    return f"ROUND(CAST({cur} - {prev} AS DOUBLE) * 100.0 / {base}, 2)"


def months_of(source: str) -> str:
    """Customer-months of the finished orders; revenue still a decimal."""
    return f"""
    SELECT customer_id, CAST(DATE_TRUNC('month', order_date) AS DATE) AS order_month,
           COUNT(DISTINCT order_id) AS monthly_orders, SUM(order_amount) AS revenue,
           CAST(SUM(order_amount) AS DOUBLE) / COUNT(order_amount) AS avg_order_value
    FROM {source} WHERE order_status = 'completed' GROUP BY ALL"""


REVENUE = "CAST(revenue AS DOUBLE) AS monthly_revenue"
MONTH_COLUMNS = f"{KEY}, monthly_orders, {REVENUE}, avg_order_value"


# Fixed values, written out here and not taken from the code under test.
SEGMENTS = """
    CASE WHEN revenue >= 10000 THEN 'VIP' WHEN revenue >= 5000 THEN 'Premium'
         WHEN revenue >= 1000 THEN 'Regular' ELSE 'Basic' END AS revenue_segment,
    CASE WHEN monthly_orders >= 20 THEN 'Frequent' WHEN monthly_orders >= 10 THEN 'Active'
         WHEN monthly_orders >= 1 THEN 'Occasional' ELSE 'Inactive' END AS frequency_segment,
    CASE WHEN avg_order_value >= 500 THEN 'High AOV' WHEN avg_order_value >= 200 THEN 'Medium AOV'
         ELSE 'Low AOV' END AS aov_segment"""

RETENTION = """
    CASE WHEN p_month IS NULL THEN 'New'
         WHEN MONTH(order_month) - MONTH(p_month) = 1 THEN 'Retained'
         ELSE 'Reactivated' END AS retention_status"""

GROWTHS = f"""
    {growth('monthly_orders', 'p_orders')} AS orders_mom_growth_pct,
    {growth('revenue', 'p_revenue')} AS revenue_mom_growth_pct,
    {growth('avg_order_value', 'p_aov')} AS aov_mom_growth_pct,
    {growth('monthly_orders', 'y_orders')} AS orders_yoy_growth_pct"""

# p_ columns: previous month; y_ columns: the year before.
ACTIVE = """
    SELECT *, LAG(monthly_orders) OVER w AS p_orders, LAG(revenue) OVER w AS p_revenue,
           LAG(avg_order_value) OVER w AS p_aov, LAG(monthly_orders, 12) OVER w AS y_orders,
           LAG(order_month) OVER w AS p_month
    FROM mon WINDOW w AS (PARTITION BY customer_id ORDER BY order_month NULLS LAST)"""

CALENDAR = """
    SELECT mon.*, p.monthly_orders AS p_orders, p.revenue AS p_revenue,
           p.avg_order_value AS p_aov, y.monthly_orders AS y_orders,
           LAG(mon.order_month) OVER (PARTITION BY mon.customer_id ORDER BY mon.order_month)
               AS p_month
    FROM mon
    LEFT JOIN mon p ON p.customer_id = mon.customer_id
                   AND p.order_month = mon.order_month - INTERVAL 1 MONTH
    LEFT JOIN mon y ON y.customer_id = mon.customer_id
                   AND y.order_month = mon.order_month - INTERVAL 1 YEAR"""

KPI_HEAD = f"""{MONTH_COLUMNS}, p_orders AS prev_month_orders,
    CAST(p_revenue AS DOUBLE) AS prev_month_revenue"""
KPI_ACTIVE = f"SELECT {KPI_HEAD}, {GROWTHS}, {SEGMENTS}, {RETENTION} FROM prev"
KPI_CALENDAR = (
    f"SELECT {KPI_HEAD}, y_orders AS prev_year_orders, {GROWTHS}, {SEGMENTS}, {RETENTION} FROM prev"
)

WITH_SALES = f"WITH sal AS ({SALES})"
WITH_ORDERS = f"WITH ord AS ({ORDERS})"
WITH_MONTHS = f"{WITH_ORDERS}, mon AS ({months_of('ord')})"
WITH_ACTIVE = f"{WITH_MONTHS}, prev AS ({ACTIVE})"
WITH_CALENDAR = f"{WITH_MONTHS}, prev AS ({CALENDAR})"

EARLY = f"ord WHERE order_date < TIMESTAMP '{SPLIT}'"
WITH_STORED_KPI = f"""{WITH_ORDERS}, early AS (SELECT * FROM {EARLY}),
    mon AS ({months_of('early')}), prev AS ({CALENDAR})"""

WITH_STATE_AND_BATCH = f"""{WITH_ORDERS}, early AS (SELECT * FROM {EARLY}),
    late AS (SELECT * FROM ord WHERE order_date >= {MARK}),
    state AS ({months_of('early')}), batch AS ({months_of('late')})"""

BATCH_COLUMNS = (
    "b.customer_id, b.order_month, b.monthly_orders, "
    "CAST(b.revenue AS DOUBLE) AS monthly_revenue, b.avg_order_value"
)


def earlier(side: str, alias: str, interval: str) -> str:
    return (
        f"LEFT JOIN {side} {alias} ON {alias}.customer_id = b.customer_id "
        f"AND {alias}.order_month = b.order_month - INTERVAL {interval}"
    )


def prev_month_join(side: str) -> str:
    return f"""{WITH_STATE_AND_BATCH} SELECT {BATCH_COLUMNS},
        p.monthly_orders AS prev_month_orders, CAST(p.revenue AS DOUBLE) AS prev_month_revenue,
        p.avg_order_value AS prev_avg_order_value
    FROM batch b {earlier(side, 'p', '1 MONTH')}"""


def prev_year_join(side: str) -> str:
    return f"""{WITH_STATE_AND_BATCH} SELECT {BATCH_COLUMNS},
        y.monthly_orders AS prev_year_orders
    FROM batch b {earlier(side, 'y', '1 YEAR')}"""


def stats(source: str, by: str = "") -> str:
    """Daily totals; ``by`` is a further grouping column, defined in the source."""
    return f"""SELECT customer_id{by}, COALESCE(CAST(SUM(amount) AS DOUBLE), 0.0) AS daily_total,
        COUNT(order_id) AS daily_orders
    FROM {source} WHERE customer_id IS NOT NULL GROUP BY ALL"""


LABELLED = "*, CAST(CAST(created_at AS DATE) + INTERVAL 1 DAY AS DATE) AS date"
WITH_DAYS = f"""{WITH_SALES}, days AS (SELECT {LABELLED} FROM sal),
    done AS (SELECT * FROM days WHERE status = 'completed'),
    uniq AS (SELECT DISTINCT * FROM done)"""
DONE = "(SELECT * FROM sal WHERE status = 'completed')"
DAILY = "customer_id, daily_total, daily_orders, date"

ORACLE: dict[str, str] = {
    # sources and sinks
    "scan_sales": f"{WITH_SALES} SELECT {SALES_COLUMNS} FROM sal",
    "scan_orders": f"{WITH_ORDERS} SELECT {ORDER_COLUMNS} FROM ord",
    "namespaced_table": f"{WITH_SALES} SELECT {SALES_COLUMNS} FROM sal",
    "read_target_state": f"{WITH_CALENDAR} {KPI_CALENDAR}",
    "stage_roundtrip": f"{WITH_SALES} SELECT {SALES_COLUMNS} FROM {DONE}",
    "append_sink": f"""{WITH_DAYS}, once AS ({stats('done', ', date')})
        SELECT {DAILY} FROM once UNION ALL SELECT {DAILY} FROM once""",
    "upsert_daily": f"""{WITH_DAYS}, old AS ({stats('days', ', date')}),
        new AS ({stats('uniq', ', date')})
        SELECT customer_id, COALESCE(new.daily_total, old.daily_total) AS daily_total,
               COALESCE(new.daily_orders, old.daily_orders) AS daily_orders, date
        FROM old FULL JOIN new USING (customer_id, date)""",
    "materialize_full": f"{WITH_ACTIVE} {KPI_ACTIVE}",
    "materialize_incremental": f"{WITH_CALENDAR} {KPI_CALENDAR}",
    "first_run_branch": f"""{WITH_ORDERS}
        SELECT {ORDER_COLUMNS}, FALSE AS incremental FROM ord UNION ALL
        SELECT {ORDER_COLUMNS}, TRUE AS incremental FROM ord WHERE order_date >= {MARK}""",
    # projections, filters, predicates
    "project_columns": f"""{WITH_ORDERS}
        SELECT customer_id, order_date, CAST(order_amount AS DOUBLE) AS order_amount FROM ord""",
    "filter_day_equality": f"""{WITH_SALES} SELECT {SALES_COLUMNS} FROM sal
        WHERE CAST(created_at AS DATE) = CAST({DATA_DAY} AS DATE)""",
    "filter_half_open_range": f"""{WITH_SALES} SELECT {SALES_COLUMNS} FROM sal
        WHERE created_at >= {DATA_DAY} AND created_at < DATE '{RUN_DATE}'""",
    "filter_completed": f"{WITH_SALES} SELECT {SALES_COLUMNS} FROM {DONE}",
    "distinct_rows": f"{WITH_SALES} SELECT DISTINCT {SALES_COLUMNS} FROM sal",
    "filter_bound_params": f"""{WITH_SALES} SELECT {SALES_COLUMNS} FROM {DONE}
        WHERE created_at >= DATE '{BACKFILL_START}' AND created_at < DATE '{RUN_DATE}'""",
    "rename_columns": f"""{WITH_SALES}, s AS ({stats('sal')})
        SELECT daily_total, daily_orders FROM s""",
    "constant_date_column": f"""{WITH_SALES}, s AS ({stats('sal')})
        SELECT *, DATE '{RUN_DATE}' AS date FROM s""",
    "filter_high_water_mark": f"""{WITH_ORDERS}
        SELECT {ORDER_COLUMNS} FROM ord WHERE order_date >= {MARK}""",
    "empty_input_guard": f"{WITH_SALES} SELECT {SALES_COLUMNS} FROM {DONE}",
    "tautology_predicate": f"{WITH_SALES} SELECT {SALES_COLUMNS} FROM {DONE} WHERE 1 = 1",
    # joins
    "join_segments": f"{WITH_MONTHS} SELECT {MONTH_COLUMNS}, {SEGMENTS} FROM mon",
    "join_retention": f"{WITH_ACTIVE} SELECT {MONTH_COLUMNS}, {RETENTION} FROM prev",
    "kpi_joined": f"{WITH_ACTIVE} {KPI_ACTIVE}",
    "join_state_prev_month": prev_month_join("state"),
    "join_batch_prev_month": prev_month_join("batch"),
    "join_state_prev_year": prev_year_join("state"),
    "join_batch_prev_year": prev_year_join("batch"),
    "join_last_month": f"""{WITH_STATE_AND_BATCH} SELECT {BATCH_COLUMNS}, l.last_month
        FROM batch b LEFT JOIN
            (SELECT customer_id, MAX(order_month) AS last_month FROM state GROUP BY ALL) l
            ON l.customer_id = b.customer_id""",
    # aggregations
    "daily_customer_stats": f"{WITH_SALES} {stats(DONE)}",
    "monthly_customer_orders": f"{WITH_MONTHS} SELECT {MONTH_COLUMNS} FROM mon",
    "count_distinct_orders": f"{WITH_MONTHS} SELECT {KEY}, monthly_orders FROM mon",
    "sum_revenue": f"{WITH_MONTHS} SELECT {KEY}, {REVENUE} FROM mon",
    "avg_order_value": f"{WITH_MONTHS} SELECT {KEY}, avg_order_value FROM mon",
    "global_max_month": f"""WITH ord AS ({ORDERS}), months AS ({months_of('ord')})
        SELECT MAX(order_month) AS order_month FROM months""",
    "customer_last_month": f"""WITH ord AS ({ORDERS}), months AS ({months_of('ord')})
        SELECT customer_id, MAX(order_month) AS order_month FROM months GROUP BY ALL""",
    "row_count_metrics": f"""{WITH_SALES}
        SELECT 'extracted' AS step, COUNT(*) AS row_count FROM {DONE} UNION ALL
        SELECT 'transformed', COUNT(DISTINCT customer_id) FROM {DONE}""",
    # windows
    "lag_prev_orders": f"{WITH_ACTIVE} SELECT {KEY}, p_orders AS prev_month_orders FROM prev",
    "lag_prev_revenue": f"""{WITH_ACTIVE}
        SELECT {KEY}, CAST(p_revenue AS DOUBLE) AS prev_month_revenue FROM prev""",
    "lag_prev_aov": f"{WITH_ACTIVE} SELECT {KEY}, p_aov AS prev_avg_order_value FROM prev",
    "lag_prev_year_orders": f"{WITH_ACTIVE} SELECT {KEY}, y_orders AS prev_year_orders FROM prev",
    "lag_prev_order_month": f"{WITH_ACTIVE} SELECT {KEY}, p_month AS prev_order_month FROM prev",
    # derived expressions
    **{
        name: f"{WITH_ACTIVE}, full_kpi AS ({KPI_ACTIVE}) SELECT {KEY}, {column} FROM full_kpi"
        for name, column in {
            "orders_mom_growth": "orders_mom_growth_pct",
            "revenue_mom_growth": "revenue_mom_growth_pct",
            "aov_mom_growth": "aov_mom_growth_pct",
            "orders_yoy_growth": "orders_yoy_growth_pct",
            "revenue_segment": "revenue_segment",
            "frequency_segment": "frequency_segment",
            "aov_segment": "aov_segment",
            "retention_status": "retention_status",
        }.items()
    },
    "coalesce_prev_values": f"""{WITH_STATE_AND_BATCH} SELECT b.customer_id, b.order_month,
        COALESCE(bm.order_month, sm.order_month, l.order_month) AS prev_order_month,
        COALESCE(bm.monthly_orders, sm.monthly_orders) AS prev_month_orders,
        CAST(COALESCE(bm.revenue, sm.revenue) AS DOUBLE) AS prev_month_revenue,
        COALESCE(bm.avg_order_value, sm.avg_order_value) AS prev_avg_order_value,
        COALESCE(yb.monthly_orders, ys.monthly_orders) AS prev_year_orders
        FROM batch b {earlier('batch', 'bm', '1 MONTH')} {earlier('state', 'sm', '1 MONTH')}
            {earlier('batch', 'yb', '1 YEAR')} {earlier('state', 'ys', '1 YEAR')}
        LEFT JOIN (SELECT customer_id, MAX(order_month) AS order_month FROM state
                   WHERE order_month < {MARK} GROUP BY ALL) l ON l.customer_id = b.customer_id""",
    # scalar functions
    **{
        name: f"{WITH_ORDERS} SELECT order_id, {expression} FROM ord"
        for name, expression in {
            "fn_date_trunc_month": "CAST(DATE_TRUNC('month', order_date) AS DATE) AS order_month",
            "fn_date_part_month": "DATE_PART('month', order_date) AS month",
            "fn_to_date": "CAST(order_date AS DATE) AS day",
            "fn_minus_month": "CAST(order_date - INTERVAL 1 MONTH AS DATE) AS day",
            "fn_minus_year": "CAST(order_date - INTERVAL 1 YEAR AS DATE) AS day",
            "fn_minus_day": "CAST(order_date - INTERVAL 1 DAY AS DATE) AS day",
            "fn_format_date": "STRFTIME(order_date, '%Y-%m-%d') AS day",
            "fn_round2": "CAST(ROUND(order_amount, 2) AS DOUBLE) AS amount",
            "fn_nullif": "NULLIF(customer_id, 0) AS customer",
            "fn_case_when": "CASE WHEN order_amount >= 2000 THEN 'large' "
            "WHEN order_amount >= 500 THEN 'medium' ELSE 'small' END AS size",
        }.items()
    },
    "fn_coalesce": f"""{WITH_ACTIVE}
        SELECT {KEY}, COALESCE(y_orders, monthly_orders) AS orders FROM prev""",
    "fn_percent_arithmetic": f"""{WITH_ACTIVE} SELECT {KEY},
        CAST(monthly_orders - p_orders AS DOUBLE) * 100.0 / NULLIF(CAST(p_orders AS DOUBLE), 0)
            AS change_pct FROM prev""",
    "fn_is_null": f"""{WITH_ACTIVE}
        SELECT {KEY}, p_orders IS NULL OR p_orders = 0 AS nothing_before FROM prev""",
    "fn_concat_key": f"""{WITH_MONTHS}
        SELECT CAST(customer_id AS VARCHAR) || CAST(order_month AS VARCHAR) AS row_key,
               monthly_orders FROM mon""",
    # sorting
    "order_kpi": f"{WITH_MONTHS} SELECT {MONTH_COLUMNS} FROM mon ORDER BY {KEY}",
    "order_daily": f"{WITH_SALES} {stats(DONE)} ORDER BY customer_id",
    # complete jobs
    "daily_job_v1": f"""{WITH_DAYS}, s AS ({stats('done', ', date')})
        SELECT customer_id, date, daily_total, daily_orders FROM s WHERE date = DATE '{RUN_DATE}'""",
    "daily_job_v2": f"""{WITH_DAYS}, s AS ({stats('uniq', ', date')})
        SELECT {DAILY} FROM s WHERE date = DATE '{RUN_DATE}'""",
    "daily_backfill": f"""{WITH_DAYS}, s AS ({stats('uniq', ', date')})
        SELECT {DAILY} FROM s
        WHERE date BETWEEN DATE '{BACKFILL_START}' AND DATE '{BACKFILL_END}'""",
    "customer_kpi_full": f"{WITH_ACTIVE} {KPI_ACTIVE} ORDER BY {KEY}",
    "customer_kpi_calendar": f"{WITH_CALENDAR} {KPI_CALENDAR}",
    "customer_kpi_incremental": f"{WITH_CALENDAR} {KPI_CALENDAR}",
    "kpi_calendar_retention": f"""{WITH_CALENDAR}
        SELECT {KEY}, CASE WHEN p_month IS NULL THEN 'New'
            WHEN p_month + INTERVAL 1 MONTH = order_month THEN 'Retained'
            ELSE 'Reactivated' END AS retention_status FROM prev""",
    # kept state
    **{
        name: f"{WITH_CALENDAR} {KPI_CALENDAR}"
        for name in (
            "kpi_refresh_kept_activity",
            "kpi_refresh_late_orders",
            "rebuild_by_switch",
            "upsert_in_buckets",
        )
    },
    "customer_point_read": f"""{WITH_CALENDAR}
        SELECT * FROM ({KPI_CALENDAR}) WHERE customer_id = 7""",
    "last_active_months": f"""{WITH_MONTHS}
        SELECT customer_id, MAX(order_month) AS order_month FROM mon
        WHERE order_month < DATE_TRUNC('month', TIMESTAMP '{SPLIT}') GROUP BY customer_id""",
    "source_month_digests": f"""{WITH_ORDERS}
        SELECT CAST(DATE_TRUNC('month', order_date) AS DATE) AS order_month, COUNT(*) AS n_rows
        FROM ord WHERE order_status = 'completed' GROUP BY 1""",
    "backfill_with_ledger": f"""{WITH_DAYS}, s AS ({stats('uniq', ', date')})
        SELECT {DAILY} FROM s
        WHERE date BETWEEN DATE '{BACKFILL_START}' AND DATE '{BACKFILL_END}'""",
    "noted_days": f"""{WITH_DAYS}, s AS ({stats('uniq', ', date')})
        SELECT CAST(day AS DATE) AS date, day IN (SELECT date FROM s) AS has_rows
        FROM GENERATE_SERIES(DATE '{BACKFILL_START}', DATE '{BACKFILL_END}', INTERVAL 1 DAY) t(day)""",
}
