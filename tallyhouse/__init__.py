"""Hourly page-view dumps to a star-schema warehouse, on Spark DataFrames."""

from tallyhouse.schemas import COMPANY_PAGES

__all__ = ["COMPANY_PAGES"]
