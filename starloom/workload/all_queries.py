"""Importing this module registers every query."""

from starloom.workload import (  # noqa: F401
    calendar_queries,
    cleansing_queries,
    dimension_queries,
    fact_queries,
    flow_queries,
    merge_queries,
    quality_queries,
    watermark_queries,
    xml_queries,
)
from starloom.workload.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
