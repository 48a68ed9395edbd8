from tallyframe.plans.adhoc import adhoc_sql
from tallyframe.plans.catalog import Catalog, Cell, ResolvedCell, bind
from tallyframe.plans.report import CohortReport
from tallyframe.plans.standard_cells import standard_catalog
from tallyframe.plans.windows import window_report

__all__ = ["Catalog", "Cell", "CohortReport", "ResolvedCell", "adhoc_sql", "bind", "standard_catalog", "window_report"]
