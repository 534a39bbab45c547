"""The tables of the warehouse, declared once and used by both flows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from starloom.operators.scd import DimensionSpec
from starloom.plans import dimensions as dim
from starloom.plans.fact import fact_delta


@dataclass(frozen=True)
class TableConfig:
    """One target: how it is built, what it is built from, and how changes are merged."""

    name: str
    kind: str
    build: Callable[..., DataFrame]
    sources: tuple[str, ...]
    spec: DimensionSpec | None = None
    scd_type: int | None = None
    watermark_column: str = "StartDate"
    #: Hash buckets of the business key in which a large dimension is stored; a merge rewrites those that it changes.
    buckets: int = 1

    def __post_init__(self):
        if self.kind not in ("dimension", "fact"):
            raise ValueError("kind must be dimension or fact")
        if self.kind == "dimension" and self.scd_type not in (1, 2):
            raise ValueError("a dimension needs scd_type 1 or 2")


def _dimension(spec: DimensionSpec, build, *sources: str, scd_type: int = 2, buckets: int = 1) -> TableConfig:
    return TableConfig(spec.name, "dimension", build, sources, spec, scd_type, buckets=buckets)


_ADDRESS_SOURCES = ("business_entity_address", "address", "address_type", "state_province", "country_region")

REGISTRY: dict[str, TableConfig] = {
    c.name: c
    for c in [
        _dimension(dim.CUSTOMER, dim.dim_customer, "customer", "person", "email_address", *_ADDRESS_SOURCES, buckets=512),
        _dimension(dim.PRODUCT, dim.dim_product, "product", "product_model", "product_subcategory", "product_category", buckets=64),
        _dimension(dim.PROMOTION, dim.dim_promotion, "special_offer"),
        _dimension(dim.SALES_REASON, dim.dim_sales_reason, "sales_reason", "order_reason", buckets=2048),
        _dimension(dim.TERRITORY, dim.dim_territory, "sales_territory", "country_region"),
        _dimension(dim.SHIP_METHOD, dim.dim_ship_method, "ship_method", "order_header"),
        _dimension(dim.STORE, dim.dim_store, "store", *_ADDRESS_SOURCES, buckets=64),
        TableConfig("FactSales", "fact", fact_delta, ("order_header", "order_detail")),
    ]
}
DIMENSIONS = [n for n, c in REGISTRY.items() if c.kind == "dimension"]
FACTS = [n for n, c in REGISTRY.items() if c.kind == "fact"]
