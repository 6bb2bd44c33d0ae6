from .aggregates import (
    daily_stats,
    high_water_mark,
    last_month,
    max_month,
    monthly_orders,
    with_row_metrics,
)
from .filters import (
    COMPLETED,
    EmptyInput,
    completed,
    dedupe,
    guard_nonempty,
    in_range,
    on_day,
    require,
    sales_between,
    since_high_water_mark,
    where_all,
    with_run_date,
)
from .joins import left_join, lookup
from .sinks import (
    append,
    drop_partition,
    drop_target,
    materialize,
    replace_partitions,
    upsert,
)
from .sorting import sort_daily, sort_kpi
from .windows import lag_metric, months_back, previous_active, previous_calendar

__all__ = [
    "COMPLETED",
    "EmptyInput",
    "append",
    "completed",
    "daily_stats",
    "dedupe",
    "drop_partition",
    "drop_target",
    "guard_nonempty",
    "high_water_mark",
    "in_range",
    "lag_metric",
    "last_month",
    "left_join",
    "lookup",
    "materialize",
    "max_month",
    "monthly_orders",
    "months_back",
    "on_day",
    "previous_active",
    "previous_calendar",
    "replace_partitions",
    "require",
    "sales_between",
    "since_high_water_mark",
    "sort_daily",
    "sort_kpi",
    "upsert",
    "where_all",
    "with_row_metrics",
    "with_run_date",
]
