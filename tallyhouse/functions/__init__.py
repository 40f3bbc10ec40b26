from tallyhouse.functions.calendar import (
    as_date_id, calendar_day, days_in_month, month_key, sunday_week, time_of_hour, weekend,
)
from tallyhouse.functions.names import (
    clock_text, collection_date, collection_time, dump_name, file_clock_of, file_date_of,
    path_dump_name, path_place,
)
from tallyhouse.functions.text import field, fields, view_count

__all__ = [
    "as_date_id", "calendar_day", "clock_text", "collection_date", "collection_time",
    "days_in_month", "dump_name", "field", "fields", "file_clock_of", "file_date_of",
    "month_key", "path_dump_name", "path_place", "sunday_week", "time_of_hour", "view_count", "weekend",
]
