from tallyframe.operators.counts import count_levels, group_counts, long_counts, spread_levels
from tallyframe.operators.increments import State, count_state, median_state
from tallyframe.operators.medians import exact_medians
from tallyframe.operators.periods import periods, report_windows, window_bounds, window_table
from tallyframe.operators.prepare import prepare_input, publish_input
from tallyframe.operators.reconcile import accuracy_summary, compare_expected, report_rows
from tallyframe.operators.subsets import is_listed, listed_subset, subset_list

__all__ = [
    "State",
    "accuracy_summary",
    "compare_expected",
    "count_levels",
    "count_state",
    "exact_medians",
    "group_counts",
    "is_listed",
    "listed_subset",
    "long_counts",
    "median_state",
    "periods",
    "prepare_input",
    "publish_input",
    "report_rows",
    "report_windows",
    "spread_levels",
    "subset_list",
    "window_bounds",
    "window_table",
]
