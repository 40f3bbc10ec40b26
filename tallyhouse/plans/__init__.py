from tallyhouse.plans.audit import RunAudit, log_lines
from tallyhouse.plans.jobs import (
    ConstraintError, append_months, build_dimensions, combine_days, combine_months, convert,
    ingest_folder, ingest_stream, load_fact, load_jdbc, load_months, report, sweep_warehouse, to_months, write_hours,
)
from tallyhouse.plans.warehouse import Warehouse

__all__ = [
    "ConstraintError", "RunAudit", "Warehouse", "append_months", "build_dimensions",
    "combine_days", "combine_months", "convert", "ingest_folder", "ingest_stream", "load_fact",
    "load_jdbc", "load_months", "log_lines", "report", "sweep_warehouse", "to_months", "write_hours",
]
