"""Every operator bound to the test tables, with the SQL it must agree with."""

from . import cleaning, encoding, files, forecasts, jobs, models, profiles, quality, series, splits
from .common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
