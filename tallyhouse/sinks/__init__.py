from tallyhouse.sinks.jdbc import append_jdbc
from tallyhouse.sinks.tables import (
    append_ledger, land_dumps, observed, replace_dimension, tally_sizes, write_daily, write_fact, write_hourly,
    write_monthly, write_refused, write_rejects, write_rollups, write_tally,
)

__all__ = [
    "append_jdbc", "append_ledger", "land_dumps", "observed", "replace_dimension", "tally_sizes", "write_daily",
    "write_fact", "write_hourly", "write_monthly", "write_refused", "write_rejects", "write_rollups",
    "write_tally",
]
