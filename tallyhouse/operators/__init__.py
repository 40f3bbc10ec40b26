from tallyhouse.operators.dims import dim_date, dim_date_between, dim_time
from tallyhouse.operators.gates import (
    complete_days, complete_months, gate_days, gate_months, hour_violations,
)
from tallyhouse.operators.hourly import (
    combine, hourly_of_tally, hourly_pageviews, new_dumps, no_lines, ordered_hours,
    rejects_of_tally, row_counts, tally,
)
from tallyhouse.operators.keys import calendar_keys, load_frame, with_fact_id
from tallyhouse.operators.ledger import ledger_rows, pending
from tallyhouse.operators.parse import (
    between_dates, dumps_of, keep_listed_pages, keep_pages, line_rejects, split_lines, stamp, well_formed,
    with_reject_reason,
)
from tallyhouse.operators.quality import (
    fk_violations, key_clashes, length_violations, not_null_violations, partition_range_violations,
    pk_violations, repeated_keys, rule_counts, with_broken_rules, with_repeated_keys,
)
from tallyhouse.operators.star import (
    grain_for, rollups_of, star_join, views_by, views_from_rollups,
)

__all__ = [
    "between_dates", "calendar_keys", "combine", "complete_days", "complete_months", "dim_date",
    "dim_date_between", "dim_time", "dumps_of", "fk_violations", "gate_days", "gate_months",
    "grain_for", "hour_violations", "hourly_of_tally", "hourly_pageviews", "keep_listed_pages",
    "keep_pages", "key_clashes", "ledger_rows", "length_violations", "line_rejects", "load_frame", "new_dumps",
    "no_lines", "not_null_violations", "ordered_hours", "partition_range_violations", "pending",
    "pk_violations", "rejects_of_tally", "repeated_keys", "rollups_of", "row_counts", "rule_counts", "split_lines", "stamp",
    "star_join", "tally", "views_by", "views_from_rollups", "well_formed", "with_broken_rules", "with_fact_id",
    "with_reject_reason", "with_repeated_keys",
]
