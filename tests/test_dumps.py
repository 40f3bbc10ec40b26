import gzip
import random

import pytest
from pyspark.sql import functions as F

from dumpfiles import MIDNIGHT, ONE_O_CLOCK, write_day, write_dump
from tallyhouse.operators import (
    complete_days, complete_months, hourly_of_tally, hourly_pageviews, keep_listed_pages,
    keep_pages, line_rejects, rejects_of_tally, split_lines, tally, well_formed,
)
from tallyhouse.schemas import COMPANY_PAGES
from tallyhouse.sinks import land_dumps, write_tally
from tallyhouse.sources.dumps import CHUNK
from tallyhouse.sources import audit_dumps, list_dumps, one_place_each, read_dumps, read_tally

GOLDEN = {
    ("2015-09-01", "000000", "2015-08-31", "de", "Apple", 7),
    ("2015-09-01", "000000", "2015-08-31", "en", "Google", 15),
    ("2015-09-01", "010000", "2015-09-01", "en", "Google", 3),
    ("2015-09-01", "010000", "2015-09-01", "en.m", "Amazon", 4),
}
PARITY_NULLS = {
    ("2015-09-01", "010000", "2015-09-01", "en", "Walmart", None),
    ("2015-09-01", "010000", "2015-09-01", "short", "Google", None),
}


@pytest.fixture
def golden(tmp_path):
    folder = tmp_path / "a-folder"  # a hyphen in the folder must not matter
    folder.mkdir()
    write_dump(folder, "pageviews-20150901-000000.gz", MIDNIGHT)
    write_dump(folder, "pageviews-20150901-010000.gz", ONE_O_CLOCK)
    return folder


def sums(hourly):
    return {
        (str(r.file_date), r.file_time, r.date_collection, r.domain, r.pagename, r.sumpageviewcount)
        for r in hourly.collect()
    }


def test_golden_hours_keep_null_sums(spark, golden):
    parsed = split_lines(read_dumps(spark, str(golden)))
    assert sums(hourly_pageviews(keep_pages(parsed, COMPANY_PAGES))) == GOLDEN | PARITY_NULLS


def test_golden_hours_without_malformed_lines(spark, golden):
    parsed = split_lines(read_dumps(spark, str(golden)))
    assert sums(hourly_pageviews(keep_pages(well_formed(parsed), COMPANY_PAGES))) == GOLDEN
    assert {(r.value, r.reason) for r in line_rejects(parsed).collect()} == {
        ("short Google", "short_line"), ("en Walmart x 0", "bad_count"),
    }


def test_page_list_as_table(spark, golden):
    parsed = split_lines(read_dumps(spark, str(golden)))
    pages = spark.createDataFrame([(p,) for p in COMPANY_PAGES + COMPANY_PAGES], "pagename string")
    want = sorted(map(tuple, keep_pages(parsed, COMPANY_PAGES).select("value").collect()))
    assert sorted(map(tuple, keep_listed_pages(parsed, pages).select("value").collect())) == want


def test_tally_conserves_lines_and_sums(spark, golden):
    write_dump(golden, "pageviews_20150901.gz", ["en Google 1000 0", "en Bing 1 0"])
    write_dump(golden, "pageviews-20151301-010000.gz", ["en Google 1000 0"])
    lines = read_dumps(spark, str(golden))
    tallies = tally(lines, COMPANY_PAGES).cache()
    assert tallies.agg(F.sum("lines")).first()[0] == lines.count() == 13
    assert sums(hourly_of_tally(tallies)) == GOLDEN
    rejects = {tuple(r) for r in rejects_of_tally(tallies).collect()}
    assert rejects == {
        ("pageviews-20150901-010000.gz", "short_line", "short Google", 1),
        ("pageviews-20150901-010000.gz", "bad_count", "en Walmart x 0", 1),
        ("pageviews_20150901.gz", "bad_file_name", None, 2),
        ("pageviews-20151301-010000.gz", "bad_file_name", None, 1),
    }
    tallies.unpersist()


def test_dump_cut_over_batches_and_files(spark, golden, tmp_path):
    """Landed dumps, and tallies of parts of dumps, give the same sums."""
    lines = read_dumps(spark, str(golden))
    landed = str(tmp_path / "landed")
    land_dumps(lines, landed)
    again = read_dumps(spark, landed)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, lines.collect()))
    store = str(tmp_path / "tally")
    first = F.col("value").endswith("5 0") | F.col("value").endswith("3 0")
    write_tally(tally(lines.where(first), COMPANY_PAGES), store, "1")
    write_tally(tally(lines.where(~first), COMPANY_PAGES), store, "2")
    write_tally(tally(lines.where(~first), COMPANY_PAGES), store, "2")
    assert sums(hourly_of_tally(read_tally(spark, store))) == GOLDEN


def test_audit(spark, golden):
    (golden / "pageviews-20150901-020000.gz").write_bytes(b"<html>not found</html>")
    (golden / "pageviews-20150901-030000.gz").write_bytes(b"")
    whole = gzip.compress(b"en Google 1 0\n" * 5000)
    (golden / "pageviews-20150901-040000.gz").write_bytes(whole[:-20])
    (golden / "pageviews-20150901-050000.gz").write_bytes(whole + whole)  # two members
    write_dump(golden, "pageviews_20150901.gz", ["en Google 1 0"])
    assert list_dumps(spark, str(golden)).count() == 6  # all but the empty one
    verdicts = {
        r.file_name: r.verdict for r in audit_dumps(spark, str(golden), deep=True).collect()
    }
    assert verdicts == {
        "pageviews-20150901-000000.gz": "ok",
        "pageviews-20150901-010000.gz": "ok",
        "pageviews-20150901-020000.gz": "not_gzip",
        "pageviews-20150901-040000.gz": "truncated",
        "pageviews-20150901-050000.gz": "ok",
        "pageviews_20150901.gz": "bad_name",
    }
    shallow = {r.file_name: r.verdict for r in audit_dumps(spark, str(golden)).collect()}
    assert shallow["pageviews-20150901-040000.gz"] == "ok"
    assert shallow["pageviews-20150901-020000.gz"] == "not_gzip"


def test_audit_of_dumps_longer_than_a_chunk(spark, golden):
    """What a check holds at once is a chunk; these are several, packed or unpacked."""
    noise = gzip.compress(random.Random(1).randbytes(3 * CHUNK), 1)
    zeros = gzip.compress(bytes(40 * CHUNK))
    assert len(noise) > 2 * CHUNK > len(zeros)
    for hour, content in enumerate([noise, noise[:-1], noise + zeros, zeros + noise[:CHUNK], noise[:2 * CHUNK] + b"x" + noise[2 * CHUNK + 1:]]):
        (golden / f"pageviews-20150902-{hour:02d}0000.gz").write_bytes(content)
    found = audit_dumps(spark, str(golden), deep=True).where("file_name like 'pageviews-20150902%'").orderBy("file_name")
    assert [r.verdict for r in found.collect()] == ["ok", "truncated", "ok", "truncated", "truncated"]


def test_unreadable_dump_fails_the_scan(spark, golden):
    whole = gzip.compress(b"en Google 1 0\n" * 5000)
    (golden / "pageviews-20150901-040000.gz").write_bytes(whole[:-20])
    with pytest.raises(Exception):
        read_dumps(spark, str(golden)).count()


def names(spark, day_hours):
    return spark.createDataFrame(
        [(f"pageviews-{day}-{clock}.gz",) for day, clock in day_hours], "file_name string"
    )


def test_day_gate(spark):
    hours = [f"{h:02d}0000" for h in range(24)]
    files = names(spark, [
        *[("20150901", c) for c in hours], ("20150901", "000000"),  # complete, one name twice
        *[("20150902", c) for c in hours[:-1]],                      # an hour short
        *[("20150903", c) for c in hours], ("20150903", "003000"),  # a file too many
        *[("20150904", c) for c in hours[:-1]], ("20150904", "223000"),  # 24 files, 23 hours
        *[("20150905", c) for c in hours[:-1]], ("20150905", "240000"),  # hour 24
    ])
    assert [str(r.file_date) for r in complete_days(files).collect()] == ["2015-09-01"]


@pytest.mark.parametrize("first, days, complete", [
    ("2015-02-01", 28, True), ("2016-02-01", 28, False), ("2016-02-01", 29, True),
    ("2015-04-01", 30, True), ("2015-05-01", 30, False), ("2015-05-01", 31, True),
])
def test_month_gate(spark, first, days, complete):
    dates = spark.range(days).select(
        F.date_add(F.lit(first).cast("date"), F.col("id").cast("int")).alias("file_date")
    )
    found = complete_months(dates.union(dates)).collect()
    assert [r.file_month for r in found] == ([first[:7]] if complete else [])


def test_write_day_fixture(spark, tmp_path):
    write_day(tmp_path, "20150901")
    assert read_dumps(spark, str(tmp_path)).count() == 48


def test_folders_below_and_copies(spark, golden):
    (golden / "2015" / "deep").mkdir(parents=True)
    write_dump(golden / "2015" / "deep", "pageviews-20150901-020000.gz", ["en Google 1 0"])
    write_dump(golden / "2015" / "deep", "pageviews-20150901-010000.gz", ["en Google 1 0"])
    names = [r.file_name for r in read_dumps(spark, str(golden)).select("file_name").distinct().collect()]
    assert sorted(names) == [f"pageviews-20150901-0{h}0000.gz" for h in range(3)]
    files = list_dumps(spark, str(golden))
    kept = one_place_each(files).collect()
    assert (files.count(), len(kept)) == (4, 3)
    again = {r.path for r in kept if r.file_name.endswith("-010000.gz")}
    assert again == {min(r.path for r in files.collect() if r.file_name.endswith("-010000.gz"))}
