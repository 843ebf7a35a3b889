"""Retail star schema and KPI tables as Spark DataFrame jobs."""

from salesmart.plans.mart import KPI_TABLES, TABLES, build_mart, build_table
from salesmart.sinks.store import MartStore
from salesmart.sources.raw import RawFiles

__all__ = ["KPI_TABLES", "TABLES", "MartStore", "RawFiles", "build_mart", "build_table"]
