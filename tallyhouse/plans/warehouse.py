"""Where the tables of a warehouse lie."""

from dataclasses import dataclass


@dataclass(frozen=True)
class Warehouse:
    root: str

    def _table(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def tally(self) -> str:
        return self._table("tally")

    @property
    def hourly(self) -> str:
        return self._table("hourly")

    @property
    def daily(self) -> str:
        return self._table("daily")

    @property
    def monthly(self) -> str:
        return self._table("monthly")

    @property
    def fact(self) -> str:
        return self._table("fact_pageviews")

    @property
    def rollups(self) -> str:
        return self._table("fact_rollups")

    @property
    def rejects(self) -> str:
        return self._table("rejected_lines")

    @property
    def refused(self) -> str:
        return self._table("refused_rows")

    @property
    def dim_date(self) -> str:
        return self._table("dim_date")

    @property
    def dim_time(self) -> str:
        return self._table("dim_time")

    @property
    def ledger(self) -> str:
        return self._table("ledger")

    @property
    def audit(self) -> str:
        return self._table("run_audit")

    @property
    def stream_checkpoint(self) -> str:
        return self._table("stream_checkpoint")
