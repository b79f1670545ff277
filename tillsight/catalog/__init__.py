"""Checked queries: each operator over the star tables, with its SQL twin."""

from tillsight.catalog import churn, etl, extras, forecasting, live, market, metrics, relational, segmentation  # noqa: F401
from tillsight.catalog.base import REGISTRY

__all__ = ["REGISTRY"]
