"""The same queries as plain SQL over the given tables."""

from tallyhouse.schemas import DIM_DATE_END, DIM_DATE_START, DUMP_BASE_URL
from tallyhouse.workload.mapping import PAGES
from tallyhouse.workload.queries import CUT

DUMP_NAME = r"^pageviews-(\d{8})-(\d{6})\.gz$"
PAGE_LIST = ", ".join(f"'{page}'" for page in PAGES)

# --- dump lines -------------------------------------------------------------

EVENT_VALUE = "event_type || ' page' || (user_id % 10) || ' ' || cast(floor(value) as bigint) || ' 0'"


def event_name(hour_shift: int = 0) -> str:
    return (
        "'pageviews-' || strftime(ts, '%Y%m%d') || '-' || "
        f"lpad(cast(hour(ts) + {hour_shift} as varchar), 2, '0') || '0000.gz'"
    )


def raw(hour_shift: int = 0, value: str = EVENT_VALUE) -> str:
    return f"select {value} as value, {event_name(hour_shift)} as file_name from events"


RAW = raw()

RAW_DIRTY = f"""
select case when event_id % 97 = 0 then event_type || ' page' || (user_id % 10)
            when event_id % 89 = 0 then event_type || ' page' || (user_id % 10) || ' x 0'
            else {EVENT_VALUE} end as value,
       case when event_id % 83 = 0 then 'pageviews_20240101.gz'
            else {event_name()} end as file_name
from events"""

ITEM_VALUE = (
    "l_returnflag || ' page' || (l_partkey % 10) || ' ' || cast(floor(l_quantity) as bigint) || ' 0'"
)
ITEM_HOUR = "lpad(cast((l_orderkey + l_linenumber) % 24 as varchar), 2, '0') || '0000.gz'"


def raw_long(years: int = 20) -> str:
    return f"""
select {ITEM_VALUE} as value,
       'pageviews-' || strftime(cast(l_shipdate as date) + interval {years} year, '%Y%m%d')
       || '-' || {ITEM_HOUR} as file_name
from lineitem"""


RAW_LONG = raw_long()

RAW_DENSE = f"""
select {ITEM_VALUE} as value,
       'pageviews-' || strftime(date '2015-01-01'
           + cast((cast(l_shipdate as date) - date '1995-01-01') // 30 as integer), '%Y%m%d')
       || '-' || {ITEM_HOUR} as file_name
from lineitem"""

# --- shared steps, as chains of common table expressions ----------------------

NAME_DATE = f"cast(try_strptime(regexp_extract(file_name, '{DUMP_NAME}', 1), '%Y%m%d') as date)"
NAME_TIME = f"nullif(regexp_extract(file_name, '{DUMP_NAME}', 2), '')"


def parsed(lines: str) -> str:
    return f"""
lines as ({lines}),
cut as (select file_name, value, string_split(value, ' ') as parts from lines),
parsed as (
    select file_name, value, parts[1] as domain, parts[2] as pagename,
           try_cast(parts[3] as bigint) as pageview, len(parts) as fields,
           {NAME_DATE} as fd, {NAME_TIME} as ft
    from cut)"""


def hourly(lines: str) -> str:
    return f"""{parsed(lines)},
hourly as (
    select domain, pagename, cast(sum(pageview) as bigint) as sumpageviewcount,
           strftime(case when ft = '000000' then fd - 1 else fd end, '%Y-%m-%d') as date_collection,
           ft[1:2] || ':' || ft[3:4] || ':' || ft[5:6] as time_collection,
           strftime(fd, '%Y-%m-%d') as file_date, ft as file_time, fd
    from parsed where pagename in ({PAGE_LIST}) and fd is not null
    group by domain, pagename, fd, ft)"""


def keyed(lines: str) -> str:
    return f"""{hourly(lines)},
keyed as (
    select * exclude (fd), fd,
           cast(replace(date_collection, '-', '') as integer) as date_id,
           cast(time_collection[1:2] as integer) as time_id,
           cast(date_collection[1:4] as integer) as year,
           cast(date_collection[6:7] as integer) as month,
           strftime(fd, '%Y-%m') as file_month
    from hourly)"""


HOURLY_OUT = "domain, pagename, sumpageviewcount, date_collection, time_collection"
LOAD_OUT = "date_id, time_id, domain, pagename, sumpageviewcount, year, month"
MONTH_OUT = f"{HOURLY_OUT}, date_id, time_id, year, month, file_month"


FACT_ID = (
    "(cast(date_id % 100 * 32 + time_id as bigint) << 52)"
    " + cast(('0x' || md5(concat_ws(' ', domain, pagename))[1:13]) as bigint)"
)


def fact_ids(source: str, carry: str = "") -> str:
    return f"""
fact as (select {FACT_ID} as fact_id, {LOAD_OUT}{carry} from {source})"""


LOADED = ", file_month as load_month"

COMPLETE_DAYS = """
complete_days as (
    select fd from (select distinct file_name, fd, ft from parsed where fd is not null)
    group by fd
    having count(*) = 24
       and count(distinct case when ft like '__0000' and ft < '24' then ft end) = 24)"""

COMPLETE_MONTHS = """
complete_months as (
    select strftime(first_day, '%Y-%m') as file_month
    from (select date_trunc('month', fd) as first_day, count(distinct fd) as days
          from {days} where fd is not null group by 1)
    where days = day(last_day(first_day)))"""


def dim_date(days: str, weekend: str = "isodow(d) = 7") -> str:
    return f"""
dim_date as (
    select cast(strftime(d, '%Y%m%d') as integer) as date_id, strftime(d, '%Y-%m-%d') as date,
           cast(year(d) as integer) as year, cast(quarter(d) as integer) as quarter,
           cast(month(d) as integer) as month, monthname(d) as month_name,
           cast(strftime(d, '%U') as integer) as week_of_year,
           cast(day(d) as integer) as day, dayname(d) as day_name, {weekend} as is_weekend
    from ({days}))"""


FIXED_DAYS = (
    f"select cast(unnest(generate_series(date '{DIM_DATE_START}', date '{DIM_DATE_END}',"
    " interval 1 day)) as date) as d"
)
DATA_DAYS = (
    "select cast(unnest(generate_series(min(fd), max(fd), interval 1 day)) as date) as d from parsed"
)
DIM_TIME = """
dim_time as (
    select cast(h as integer) as time_id, lpad(cast(h as varchar), 2, '0') || ':00:00' as time_creation
    from range(24) as hours(h))"""

STAR = f"""{dim_date(FIXED_DAYS)}, {DIM_TIME},
star as (
    select k.date_id, k.time_id, k.domain, k.pagename, k.sumpageviewcount,
           d.* exclude (date_id), t.time_creation
    from keyed k join dim_date d using (date_id) join dim_time t using (time_id))"""


def views_by(lines: str, keys: str) -> str:
    return f"""with {keyed(lines)}, {STAR}
select {keys}, cast(sum(sumpageviewcount) as bigint) as views from star group by {keys}"""


def kept_views(keys: str) -> str:
    kept = STAR.replace("from keyed k", "from (from keyed where file_month not like '2018-%' or time_id > 0) k")
    return f"""with {keyed(RAW_LONG)}, {kept}
select {keys}, cast(sum(sumpageviewcount) as bigint) as views from star group by {keys}"""


MANIFEST = f"""
manifest as (
    select strftime(d, '%Y-%m-%d') as file_date, cast(h as integer) as hour,
           'pageviews-' || strftime(d, '%Y%m%d') || '-' || lpad(cast(h as varchar), 2, '0')
           || '0000.gz' as file_name,
           '{DUMP_BASE_URL}' || strftime(d, '/%Y/%Y-%m/') as folder
    from days, range(24) as hours(h))"""

REASON = (
    "case when fd is null then 'bad_file_name' when fields < 3 then 'short_line' "
    "when pageview is null then 'bad_count' end"
)

DENSE_MONTHS = f"""{keyed(RAW_DENSE)}, {COMPLETE_DAYS},
{COMPLETE_MONTHS.format(days="complete_days")}"""

LONG_MONTHS = f"""{keyed(RAW_LONG)},
{COMPLETE_MONTHS.format(days="parsed")}"""

COLUMNS = LOAD_OUT.split(", ")
NULLED = ", ".join(f"case when time_id % 8 <> {n} then {name} end as {name}" for n, name in enumerate(COLUMNS))
NULL_NAMES = "concat_ws(',', " + ", ".join(f"case when {name} is null then '{name}' end" for name in COLUMNS) + ")"
NULLS_SHOWN = ", ".join(
    f"coalesce({name}, {chr(39) * 2 if name in ('domain', 'pagename') else -1}) as {name}" for name in COLUMNS
)

RULES_YEARS = 28


def data_days_dim(weekend: str = "isodow(d) = 7") -> str:
    return f"with {parsed(RAW_LONG)}, {dim_date(DATA_DAYS, weekend)}"


DENSE_OUT = f"""
with {DENSE_MONTHS}
select {MONTH_OUT} from keyed where file_month in (from complete_months)
and fd in (from complete_days)"""
ALL_HOURLY = f"with {hourly(RAW)} select {HOURLY_OUT}, file_date, file_time from hourly"
ALL_FACT = f"""with {keyed(RAW_LONG)}, {fact_ids("keyed", LOADED)} select * from fact"""

ORACLES = {
    "scan_dump_text": RAW,
    "expected_hour_manifest": f"""
with {parsed(RAW_LONG)}, days as (select distinct fd as d from parsed), {MANIFEST}
select file_date, hour, file_name, folder || file_name as url from manifest""",
    "missing_hours": f"""
with {parsed(RAW_LONG)}, days as ({DATA_DAYS}), {MANIFEST}
select file_date, hour, file_name from manifest
where file_name not in (select file_name from lines)""",
    "gz_magic_audit": f"""
with {parsed(RAW)}
select distinct file_name, case when fd < date '{CUT}' then 'ok' else 'not_gzip' end as verdict
from parsed""",
    "gz_deep_audit": f"""
with {parsed(RAW)}
select distinct file_name, case when fd < date '{CUT}' then 'ok' else 'truncated' end as verdict
from parsed""",
    "scan_hourly_schema": ALL_HOURLY,
    "scan_daily_schema": f"""
with {keyed(RAW_DENSE)}
select {HOURLY_OUT}, file_date, file_time, file_month from keyed""",
    "scan_month_schema": f"with {keyed(RAW_LONG)} select {MONTH_OUT} from keyed",
    "date_spine": f"""
with {parsed(RAW_LONG)} select strftime(d, '%Y-%m-%d') as date from ({DATA_DAYS})""",
    "hour_spine": "select distinct cast(hour(ts) as integer) as time_id from events",
    "write_hourly_roundtrip": ALL_HOURLY,
    "write_daily_roundtrip": ALL_HOURLY,
    "write_month_roundtrip": f"with {keyed(RAW_DENSE)} select {MONTH_OUT} from keyed",
    "dim_replace_roundtrip": f"{data_days_dim()} select * from dim_date",
    "fact_partitioned_write": ALL_FACT,
    "fact_reload_idempotent": ALL_FACT,
    "fact_reload_shrunk": f"""with {keyed(RAW_LONG)}, {fact_ids("keyed", LOADED)}
select * from fact where load_month not like '2018-%' or time_id > 0""",
    "pk_load_violations": f"""with {keyed(RAW_LONG)}, {fact_ids("keyed", LOADED)}
select fact_id, year, month, '2018-03' as load_month, load_month as loaded_month from fact
where load_month = '2018-02' and time_id = 3""",
    "fact_load_refused": f"""with {keyed(RAW_LONG)}, {fact_ids("keyed", LOADED)}
select *, '' as broken_rules from fact
union all by name
select * replace ('2018-03' as load_month), 'primary_key' as broken_rules from fact
where load_month = '2018-02' and time_id = 3""",
    "processed_ledger": f"""
with {parsed(RAW)},
files as (select distinct file_name, fd < date '{CUT}' as early from parsed)
select file_name, 'hourly' as stage, case when early then '1' else '2' end as batch_id from files
union all
select file_name, 'daily' as stage, '1' as batch_id from files where early""",
    "parse_lines": f"""
with {parsed(RAW_DIRTY)}
select file_name, domain, pagename, coalesce(pageview, -1) as pageview from parsed""",
    "page_filter": f"""
with {parsed(RAW)}
select file_name, domain, pagename, pageview from parsed where pagename in ({PAGE_LIST})""",
    "page_filter_semi": f"""
with {parsed(RAW)}
select file_name, domain, pagename, pageview from parsed
where pagename in (select 'page' || (c_custkey * 3 % 15) from customer where c_acctbal < 0)""",
    "collection_stamp": f"""
with {parsed(RAW)}
select value, file_name, strftime(fd, '%Y-%m-%d') as file_date, ft as file_time,
       strftime(case when ft = '000000' then fd - 1 else fd end, '%Y-%m-%d') as date_collection,
       ft[1:2] || ':' || ft[3:4] || ':' || ft[5:6] as time_collection
from parsed""",
    "file_name_parse": f"""
with {parsed(RAW_DIRTY)}
select distinct file_name, coalesce(strftime(fd, '%Y-%m-%d'), '') as file_date,
       coalesce(ft, '') as file_time
from parsed""",
    "calendar_keys": f"""
with {keyed(RAW)}
select {HOURLY_OUT}, file_date, file_time, date_id, time_id, year, month from keyed""",
    "load_frame": f"with {keyed(RAW_LONG)} select {LOAD_OUT} from keyed",
    "complete_days": f"""
with {parsed(RAW_DENSE)}, {COMPLETE_DAYS}
select strftime(fd, '%Y-%m-%d') as file_date from complete_days""",
    "gate_day": f"""
with {hourly(RAW)}, {COMPLETE_DAYS}
select {HOURLY_OUT}, file_date, file_time from hourly where fd in (from complete_days)""",
    "complete_months": f"""
with {parsed(RAW_LONG)}, {COMPLETE_MONTHS.format(days="parsed")}
select file_month from complete_months""",
    "gate_month": f"""
with {LONG_MONTHS}
select {HOURLY_OUT}, file_date, file_time, file_month from keyed
where file_month in (from complete_months)""",
    "hour_domain_check": f"""
with {keyed(raw(hour_shift=10))}
select {LOAD_OUT} from keyed where time_id not between 0 and 23""",
    "pending_files": f"""
with {parsed(RAW)} select distinct file_name from parsed where fd >= date '{CUT}'""",
    "star_join": f"with {keyed(RAW)}, {STAR} select * from star",
    "hourly_pageviews": ALL_HOURLY,
    "hourly_pageviews_long": f"""
with {hourly(RAW_LONG)} select {HOURLY_OUT}, file_date, file_time from hourly""",
    "day_row_counts": f"""
with {hourly(RAW_LONG)} select file_date, count(*) as rows from hourly group by file_date""",
    "views_by_weekday": views_by(RAW, "day_name, is_weekend"),
    "views_by_month": views_by(RAW_LONG, "year, quarter, month, month_name"),
    "views_by_hour": views_by(RAW_LONG, "time_id, time_creation, domain"),
    "views_of_quarter": f"""with {keyed(RAW_LONG)}, {STAR}
select year, month_name, pagename, cast(sum(sumpageviewcount) as bigint) as views
from star where quarter = 2 group by all""",
    "kept_views_by_weekday": kept_views("day_name, is_weekend"),
    "kept_views_by_page": kept_views("year, month, pagename"),
    "fact_surrogate_key": f"""
with {keyed(RAW_LONG)}, {fact_ids("keyed")} select * from fact""",
    "hourly_sorted": ALL_HOURLY,
    "combine_day": ALL_HOURLY,
    "combine_month": f"""
with {DENSE_MONTHS}
select {MONTH_OUT}, file_date, file_time from keyed
where file_month in (from complete_months)""",
    "dim_date": f"{data_days_dim()} select * from dim_date",
    "dim_date_two_day_weekend": f"""
{data_days_dim("isodow(d) >= 6")} select date_id, day_name, is_weekend from dim_date""",
    "dim_time": """
select distinct cast(hour(ts) as integer) as time_id,
       lpad(cast(hour(ts) as varchar), 2, '0') || ':00:00' as time_creation
from events""",
    "not_null_violations": f"""
with {keyed(RAW_DIRTY)}, planted as (select {NULLED} from keyed)
select {NULLS_SHOWN}, {NULL_NAMES} as null_columns from planted where {NULL_NAMES} <> ''""",
    "length_violations": f"""
with {keyed(raw(value="repeat(event_type, 5) || substr(" + EVENT_VALUE + ", length(event_type) + 1)"))},
longer as (select * replace (repeat(pagename, time_id % 8 + 1) as pagename) from keyed)
select {LOAD_OUT}, concat_ws(',', case when length(domain) > 30 then 'domain' end,
       case when length(pagename) > 30 then 'pagename' end) as long_columns
from longer where length(domain) > 30 or length(pagename) > 30""",
    "dim_text_violations": f"""
{data_days_dim()}, longer as (
    select date_id, repeat(month_name, quarter) as month_name, repeat(day_name, day % 2 + 1) as day_name from dim_date)
select *, concat_ws(',', case when length(month_name) > 20 then 'month_name' end,
       case when length(day_name) > 10 then 'day_name' end) as long_columns
from longer where length(month_name) > 20 or length(day_name) > 10""",
    "partition_range_violations": f"""
with {keyed(raw_long(32))}
select {LOAD_OUT} from keyed where year not between 2015 and 2030""",
    "pk_violations": f"""
with {keyed(RAW)}, {fact_ids("keyed")}
select fact_id, year, month, cast(2 as bigint) as copies from fact where time_id = 0""",
    "pk_natural_violations": f"""
with {keyed(RAW)}
select date_id, time_id, domain, pagename, cast(2 as bigint) as copies from keyed where time_id = 0""",
    "pk_dim_violations": f"""
{data_days_dim()}
select 'dim_date' as dimension, date_id as key, cast(2 as bigint) as copies from dim_date where date_id % 7 = 0
union all
select 'dim_time', cast(h as integer), cast(2 as bigint)
from (select distinct hour(ts) as h from events) where h % 7 = 0""",
    "fk_date_violations": f"""
with {keyed(raw_long(RULES_YEARS))}, {dim_date(FIXED_DAYS)}
select {LOAD_OUT} from keyed where date_id not in (select date_id from dim_date)""",
    "fk_time_violations": f"""
with {keyed(raw(hour_shift=10))}
select {LOAD_OUT} from keyed where time_id > 23""",
    "broken_rules": f"""
with {keyed(RAW_LONG)}, {dim_date(FIXED_DAYS)},
planted as (
    select date_id + case when time_id = 4 then 300000 else 0 end as date_id,
           time_id + case when time_id = 5 then 24 else 0 end as time_id,
           case when time_id <> 1 then domain end as domain,
           repeat(pagename, case when time_id = 2 then 8 else 1 end) as pagename, sumpageviewcount,
           year + case when time_id = 3 then 100 else 0 end as year, month
    from (from keyed union all from keyed where time_id = 6)),
fact as (select *, {FACT_ID} as fact_id from planted),
broken as (
    select 'not_null' as rule from fact where {" or ".join(f"{name} is null" for name in COLUMNS)}
    union all select 'length' from fact where length(domain) > 30 or length(pagename) > 30
    union all select 'partition_range' from fact where not (year between 2015 and 2030 and month between 1 and 12)
    union all select 'fk_date' from fact where date_id not in (select date_id from dim_date)
    union all select 'fk_time' from fact where time_id not between 0 and 23
    union all select 'primary_key' from (
        select count(*) over (partition by fact_id, year, month) as copies from fact) where copies > 1)
select rule, count(*) as rows from broken group by rule""",
    "line_rejects": f"""
with {parsed(RAW_DIRTY)}
select file_name, value, {REASON} as reason from parsed where {REASON} is not null""",
    "line_tally": f"""
with {parsed(RAW_DIRTY)},
fates as (
    select file_name, pageview,
           case when fields < 3 then 'short_line' when pageview is null then 'bad_count'
                when pagename in ({PAGE_LIST}) then 'kept' else 'other' end as outcome
    from parsed)
select file_name, outcome, count(*) as lines,
       cast(sum(case when outcome = 'kept' then pageview else 0 end) as bigint) as views
from fates group by file_name, outcome""",
    "incremental_ingest": ALL_HOURLY,
    "run_audit": f"""
with {DENSE_MONTHS}, {fact_ids("keyed")},
gated_days as (select * from keyed where fd in (from complete_days)),
gated_months as (select * from gated_days where file_month in (from complete_months)),
tallied as (
    select distinct file_name, outcome, case when outcome = 'kept' then domain end,
           case when outcome = 'kept' then pagename end
    from (select *, case when pagename in ({PAGE_LIST}) then 'kept' else 'other' end as outcome
          from parsed))
select 'hourly' as stage, 'lines tallied by hour' as message, count(*) as rows from tallied
union all select 'daily', 'day sets written', count(*) from gated_days
union all select 'monthly', 'month sets written', count(*) from gated_months
union all select 'fact', 'facts loaded', count(*) from gated_months
          where date_id >= 20150101""",
    "dumps_to_months": DENSE_OUT,
    "ingest_twice_same_batch": DENSE_OUT,
    "ingest_resumed": DENSE_OUT,
    "months_to_fact": f"""
with {LONG_MONTHS},
gated as (select * from keyed where file_month in (from complete_months)),
{fact_ids("gated", LOADED)} select * from fact""",
}
