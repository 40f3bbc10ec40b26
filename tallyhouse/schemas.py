"""Table schemas and the fixed values of the warehouse."""

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
COMPANY_PAGES = ["Google", "Facebook", "Amazon", "Microsoft", "Apple", "Walmart"]
DUMP_BASE_URL = "https://dumps.wikimedia.org/other/pageviews"
HOURS_PER_DAY = 24
DIM_DATE_START, DIM_DATE_END = "2015-01-01", "2025-12-31"
FIRST_PARTITION_YEAR, LAST_PARTITION_YEAR = 2015, 2030
FACT_TEXT_LIMITS = {"domain": 30, "pagename": 30}
DIM_DATE_TEXT_LIMITS = {"month_name": 20, "day_name": 10}
JDBC_BATCH_ROWS = 10_000
# ----------------------------------------------------------------------------

# One row per dump line.
RAW_LINE = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("file_name", T.StringType()),
])

# Views of one (domain, page) in one hourly dump.
HOURLY = T.StructType([
    T.StructField("domain", T.StringType()),
    T.StructField("pagename", T.StringType()),
    T.StructField("sumpageviewcount", T.LongType()),
    T.StructField("date_collection", T.StringType()),
    T.StructField("time_collection", T.StringType()),
])

# What became of the lines of a dump. One row per (domain, page) kept, per
# distinct malformed line, and per dump for all the lines of other pages. place is
# where the dump lay, so that a copy from elsewhere is known as one.
TALLY = T.StructType([
    T.StructField("file_name", T.StringType()),
    T.StructField("place", T.StringType()),
    T.StructField("domain", T.StringType()),
    T.StructField("pagename", T.StringType()),
    T.StructField("line", T.StringType()),
    T.StructField("sumpageviewcount", T.LongType()),
    T.StructField("lines", T.LongType()),
    T.StructField("file_date", T.DateType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("file_month", T.StringType()),
    T.StructField("outcome", T.StringType()),
])

# Malformed lines of a dump, and how often each occurs.
REJECTS = T.StructType([
    T.StructField("file_name", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("line", T.StringType()),
    T.StructField("lines", T.LongType()),
    T.StructField("batch_id", T.StringType()),
])

# The date and time in the dump's name. They differ from the collection date
# for midnight dumps, and group the files into days and months.
FILE_KEYS = T.StructType([
    T.StructField("file_date", T.DateType()),
    T.StructField("file_time", T.StringType()),
])

CALENDAR_KEYS = T.StructType([
    T.StructField("date_id", T.IntegerType()),
    T.StructField("time_id", T.IntegerType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
])

MONTHLY = T.StructType(HOURLY.fields + CALENDAR_KEYS.fields)

LOAD_COLUMNS = [
    "date_id", "time_id", "domain", "pagename", "sumpageviewcount", "year", "month",
]
FACT_COLUMNS = ["fact_id", *LOAD_COLUMNS]

FACT = T.StructType([
    T.StructField("fact_id", T.LongType()),
    T.StructField("date_id", T.IntegerType()),
    T.StructField("time_id", T.IntegerType()),
    T.StructField("domain", T.StringType()),
    T.StructField("pagename", T.StringType()),
    T.StructField("sumpageviewcount", T.LongType()),
    T.StructField("load_month", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
])

# Rows a load has refused: what the fact would have, and why not.
REFUSED = T.StructType([*FACT.fields, T.StructField("broken_rules", T.StringType())])

# Sums of a load's facts, finer for some attributes and without the others.
ROLLUPS = T.StructType([
    T.StructField("date_id", T.IntegerType()),
    T.StructField("time_id", T.IntegerType()),
    T.StructField("domain", T.StringType()),
    T.StructField("pagename", T.StringType()),
    T.StructField("sumpageviewcount", T.LongType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("load_month", T.StringType()),
    T.StructField("grain", T.StringType()),
])

DIM_DATE = T.StructType([
    T.StructField("date_id", T.IntegerType()),
    T.StructField("date", T.DateType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("quarter", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("month_name", T.StringType()),
    T.StructField("week_of_year", T.IntegerType()),
    T.StructField("day", T.IntegerType()),
    T.StructField("day_name", T.StringType()),
    T.StructField("is_weekend", T.BooleanType()),
])

DIM_TIME = T.StructType([
    T.StructField("time_id", T.IntegerType()),
    T.StructField("time_creation", T.StringType()),
])

LEDGER = T.StructType([
    T.StructField("file_name", T.StringType()),
    T.StructField("stage", T.StringType()),
    T.StructField("batch_id", T.StringType()),
])

AUDIT = T.StructType([
    T.StructField("event_time", T.TimestampType()),
    T.StructField("stage", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("metrics", T.MapType(T.StringType(), T.LongType())),
    T.StructField("run_id", T.StringType()),
])
