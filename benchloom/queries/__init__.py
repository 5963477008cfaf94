"""Ready-made queries; importing the package fills the catalogue."""

from benchloom.queries import cleaning, forecasting, modelling, preparation, profiling, reporting, scoring  # noqa: F401
from benchloom.queries.catalog import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
