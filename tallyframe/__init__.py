"""Cohort indicator reports on Spark."""

from tallyframe.plans.catalog import Catalog, Cell
from tallyframe.plans.report import CohortReport
from tallyframe.plans.standard_cells import standard_catalog

__all__ = ["Catalog", "Cell", "CohortReport", "standard_catalog"]
