from .readers import (
    SchemaMismatch,
    balanced_slices,
    conform,
    hour_counts_query,
    jdbc_day_slices,
    read_jdbc_sales,
    read_orders,
    read_sales,
    scratch_dir,
    stage,
    table_name,
)
from .targets import (
    Target,
    daily_target,
    digests_target,
    exists,
    find_state,
    kpi_target,
    last_active_target,
    ledger_target,
    read_state,
    require_same_table,
    stored_parts,
    table_detail,
)

__all__ = [
    "SchemaMismatch",
    "Target",
    "balanced_slices",
    "conform",
    "daily_target",
    "digests_target",
    "exists",
    "find_state",
    "hour_counts_query",
    "jdbc_day_slices",
    "kpi_target",
    "last_active_target",
    "ledger_target",
    "read_jdbc_sales",
    "read_orders",
    "read_sales",
    "read_state",
    "require_same_table",
    "scratch_dir",
    "stage",
    "stored_parts",
    "table_detail",
    "table_name",
]
