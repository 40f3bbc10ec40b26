import sys

from dumpfiles import write_day, write_dump
from tallyhouse.__main__ import arguments, run
from tallyhouse.operators import calendar_keys
from tallyhouse.plans import Warehouse
from tallyhouse.schemas import FACT
from tallyhouse.sinks import write_fact
from tallyhouse.sources import read_daily, read_fact, read_hourly, read_monthly


def command(spark, monkeypatch, *words):
    monkeypatch.setattr(sys, "argv", ["tallyhouse", *map(str, words)])
    run(spark, arguments())


def test_dumps_to_report(spark, monkeypatch, tmp_path, capsys):
    folder, house = tmp_path / "dumps", tmp_path / "house"
    folder.mkdir()
    for day in range(1, 29):
        write_day(folder, f"201502{day:02d}")
    command(spark, monkeypatch, "dims", "--warehouse", house)
    command(spark, monkeypatch, "ingest", "--warehouse", house, "--dumps", folder)
    command(spark, monkeypatch, "load", "--warehouse", house)
    command(spark, monkeypatch, "report", "--warehouse", house, "--by", "month_name", "is_weekend")
    out = capsys.readouterr().out
    assert "672 dumps converted" in out
    assert [line.split("\t")[0] for line in out.splitlines() if "\t" in line] == [
        "month_name", "February", "February", "January",
    ]
    assert read_fact(spark, Warehouse(str(house)).fact).count() == 672


def test_month_sets_of_another_layout(spark, tmp_path):
    """Columns the files lack are NULL, and int sums widen to bigint."""
    old = spark.sql("SELECT 'en' AS domain, 7 AS sumpageviewcount, '2015-09' AS file_month")
    old.write.partitionBy("file_month").parquet(str(tmp_path / "monthly"))
    row = read_monthly(spark, str(tmp_path / "monthly")).first()
    assert (row.domain, row.sumpageviewcount, row.pagename, row.date_id) == ("en", 7, None, None)
    assert row.file_month == "2015-09"


def test_every_row_is_shown(spark, monkeypatch, tmp_path, capsys):
    folder, house = tmp_path / "dumps", tmp_path / "house"
    folder.mkdir()
    write_day(folder, "20150901")
    write_day(folder, "20150902", hours=range(6))
    sites = [f"site{n:02d} Google 1 0" for n in range(30)]
    write_dump(folder, "pageviews-20150901-000000.gz", [*sites, "short Google"])
    command(spark, monkeypatch, "audit", "--warehouse", house, "--dumps", folder)
    assert capsys.readouterr().out.count("\tok\n") == 30
    command(spark, monkeypatch, "audit", "--warehouse", house, "--dumps", folder, "--limit", "5")
    assert capsys.readouterr().out.count("\tok\n") == 5
    command(spark, monkeypatch, "ingest", "--warehouse", house, "--dumps", folder)
    command(spark, monkeypatch, "rejects", "--warehouse", house)
    assert "short_line\tshort Google\t1" in capsys.readouterr().out
    command(spark, monkeypatch, "hours", "--warehouse", house)
    assert read_hourly(spark, Warehouse(str(house)).hourly).count() == 23 + 30
    command(spark, monkeypatch, "dims", "--warehouse", house)
    rows = calendar_keys(read_daily(spark, Warehouse(str(house)).daily)).selectExpr("*", "'2015-09' as load_month", "1L as fact_id")
    write_fact(rows.select(FACT.names), Warehouse(str(house)).fact)
    command(spark, monkeypatch, "report", "--warehouse", house, "--by", "domain")
    assert len(capsys.readouterr().out.splitlines()) == 1 + 31
    command(spark, monkeypatch, "report", "--warehouse", house, "--by", "domain", "--out", tmp_path / "out")
    assert spark.read.option("header", True).option("sep", "\t").csv(str(tmp_path / "out")).count() == 31
