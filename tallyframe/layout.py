"""Fixed values of the participant record layout and of the report.

Everything in this module has to agree with the data files and with published
report conventions, so it is stated as plain text.
"""

# --- fixed values: participant record columns --------------------------------

RAW_PREFIX = "PIRL"
PREPARED_PREFIX = "p"

KEPT_COLUMNS = [
    "PIRL202", "PIRL301", "PIRL401", "PIRL413", "PIRL808", "PIRL900", "PIRL901", "PIRL904",
    "PIRL918", "PIRL923", "PIRL1000", "PIRL1001", "PIRL1002", "PIRL1007", "PIRL1100", "PIRL1101",
    "PIRL1102", "PIRL1103", "PIRL1104", "PIRL1105", "PIRL1107", "PIRL1112", "PIRL1113",
    "PIRL1201", "PIRL1602", "PIRL1606", "PIRL1704", "PIRL3000",
]

DATE_COLUMNS = [
    "p1000", "p1001", "p1002", "p1007", "p1100", "p1101", "p1102", "p1103", "p1104", "p1105",
    "p1107", "p1112", "p1113", "p1201", "p900", "p901",
]

CODE_COLUMNS = [
    "p202", "p301", "p401", "p413", "p808", "p904", "p918", "p923", "p1602", "p1606",
]

WAGE_COLUMN = "p1704"
SUBSET_COLUMN = "p3000"

# --- fixed values: reporting periods -----------------------------------------

COHORTS_TABLE = "PRS_Report_Cohorts"
MEASURES_TABLE = "PRS_Report_Measures"
DEFAULT_QUARTER = 13
REPORT_TYPE = 1
PREVIOUS_SEQUENCE_STEP = 12
PROGRAM_START = "2016-07-01"

# window parameter pair -> measure whose current period supplies it
WINDOWS = ("r4q", "cq", "ptd")

WINDOW_MEASURES = {
    "abc": "Number Served (Reportable Individual)",
    "exit2q": "Employment Rate Second Quarter After Exit",
    "exit4q": "Employment Rate Fourth Quarter After Exit",
}

# --- fixed values: subsets, statuses, report ----------------------------------

# 50 states, DC and outlying areas
STATIC_SUBSETS = [
    "AK", "AL", "AR", "AS", "AZ", "CA", "CO", "CT", "DC", "DE", "FL", "GA", "GU", "HI", "IA",
    "ID", "IL", "IN", "KS", "KY", "LA", "MA", "MD", "ME", "MI", "MN", "MO", "MP", "MS", "MT",
    "NC", "ND", "NE", "NH", "NJ", "NM", "NV", "NY", "OH", "OK", "OR", "PA", "PR", "PW", "RI",
    "SC", "SD", "TN", "TX", "UT", "VA", "VI", "VT", "WA", "WI", "WV", "WY",
]

NATIONAL = "ALL"
OK = "OK"
MISSING = "MISSING"
FAILED = "FAILED"
UNDEFINED = "undefined"
ZERO_DENOMINATOR = "a/0"

REPORT_COLUMNS = [
    "cell", "subset", "value", "numerator", "denominator", "expected", "actual", "match", "query",
]
