from tallyhouse.sources.dumps import (
    audit_dumps, expected_dumps, list_dumps, missing_dumps, one_place_each, read_dumps,
)
from tallyhouse.sources.spines import date_bounds, date_spine, hour_spine, hours_between
from tallyhouse.sources.tables import (
    read_daily, read_fact, read_hourly, read_ledger, read_monthly, read_refused, read_rejects,
    read_rollups, read_tally,
)

__all__ = [
    "audit_dumps", "date_bounds", "date_spine", "expected_dumps", "hour_spine",
    "hours_between", "list_dumps", "missing_dumps", "one_place_each", "read_daily",
    "read_dumps", "read_fact", "read_hourly", "read_ledger", "read_monthly", "read_refused",
    "read_rejects", "read_rollups", "read_tally",
]
