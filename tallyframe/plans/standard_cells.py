"""The standard indicator report, built from its row and column rules.

A cell is named by report column and row. Columns come in pairs, one of counts and
one of rates: F/G everybody, H/I veterans, J/K people with a disability, L/M
disconnected youth or parents. Helper operands of a rate carry a suffix. Some
definitions break the pattern of their row or column; they are part of the report,
are kept as they are, and carry a note.
"""

from __future__ import annotations

from tallyframe.plans.catalog import COUNT, MEDIAN, RATIO, REFINE, Catalog, Cell

# --- fixed values: conditions of report columns and rows ------------------------

PARTICIPANT = "p918 = 1"
REPORTABLE = "p918 = 2"
ACTIVE = "p900 <= :abc_end AND (p901 >= :abc_start OR p901 IS NULL)"
CONTACTED = "(p1002 >= :abc_start OR p1007 >= :abc_start)"
TRAINED = "(p1000 IS NOT NULL OR p1001 IS NOT NULL)"
NOT_EXCLUDED = "p923 = 00"
EXIT_2Q = "p901 >= :exit2q_start AND p901 <= :exit2q_end"
EXIT_4Q = "p901 >= :exit4q_start AND p901 <= :exit4q_end"
EARNING = "p1704 > 0 AND p1704 < 999999.99"

VETERAN = "p401 IN (1, 2, 3, 5)"
DISABLED = "p301 > 0"
YOUTH = "p413 IN (1, 2)"
LOW_INCOME = "p904 IN (1, 2, 3)"
SEX = "p202 = 1"
SCHOOLING = "p808 IN (1, 2, 3, 4, 5)"

CONTACT_ROWS = {"12": "p1101", "13": "p1100", "14": "p1103"}
SERVICE_ROWS = {
    "17": "p1102",
    "18": "p1104",
    "19": "p1105",
    "20": "p1103",
    "21": "p1112",
    "22": "p1107",
    "23": "p1113",
    "24": "p1201",
}
EMPLOYED_2Q = "p1602 >= 1 AND p1602 <= 8"
EMPLOYED_4Q = "p1606 >= 1 AND p1606 <= 8"

NOTES = {
    "F10": "alternatives are not parenthesized: refinements bind to the last one only",
    "L31": "compares the constant 923, so no row qualifies",
    "J31": "does not test p923",
    "G19n": "tests p1102 where the row tests p1105",
    "G20n": "tests p1102 where the row tests p1103",
    "G16d": "asks for a set p901 where the pattern asks for a missing one",
    "L10": "does not test p413",
    "G24n": "refines the row 04 base",
    "I24p": "refines the row 04 base",
    "K24n": "refines the row 05 base",
    "M24n": "refines the row 04 base",
    "I10": "numerator is not contained in the denominator",
    "G05n": "tests p301 > 0 where F05 lists codes",
}


def _all(*conditions: str) -> str:
    return " AND ".join(conditions)


class _Builder:
    def __init__(self):
        self.cells: list[Cell] = []

    def _add(self, name: str, kind: str, **parts):
        self.cells.append(Cell(name, kind, note=NOTES.get(name), **parts))

    def count(self, name, *conditions):
        self._add(name, COUNT, predicate=_all(*conditions))

    def median(self, name, *conditions):
        self._add(name, MEDIAN, predicate=_all(*conditions))

    def refine(self, name, parent, *conditions):
        self._add(name, REFINE, parent=parent, predicate=_all(*conditions))

    def ratio(self, name, num, den):
        self._add(name, RATIO, num=num, den=den)

    def rate(self, name, suffix, parent, *conditions, over):
        """A helper count and the rate built on it."""
        self.refine(name + suffix, parent, *conditions)
        self.ratio(name, name + suffix, over)

    def contacts(self, column, parent):
        for row, date in CONTACT_ROWS.items():
            self.refine(column + row, parent, f"{date} >= :abc_start")

    def services(self, column):
        for row, date in SERVICE_ROWS.items():
            self.refine(column + row, column + "16", f"{date} IS NOT NULL")

    def service_rates(self, column, suffix, base, row24, over24, rows=SERVICE_ROWS):
        for row, date in rows.items():
            parent, over = (row24, over24) if row == "24" else (base, base)
            self.rate(column + row, suffix, parent, f"{date} IS NOT NULL", over=over)

    def exits(self, column, base, second, fourth):
        """Exit cohorts of rows 27 and 31, each with its employed part."""
        self.refine(column + "27", base, *second)
        self.refine(column + "26", column + "27", EMPLOYED_2Q)
        self.refine(column + "31", base, *fourth)
        self.refine(column + "30", column + "31", EMPLOYED_4Q)

    def outcomes(self, column, counts, *conditions):
        """Employment rates and median earnings of a rate column."""
        self.ratio(column + "28", counts + "26", counts + "27")
        self.median(column + "29", PARTICIPANT, *conditions, EARNING, EXIT_2Q, NOT_EXCLUDED)
        self.ratio(column + "32", counts + "30", counts + "31")


def _everybody(b: _Builder):
    b.count("F04p", PARTICIPANT)
    b.refine("F04", "F04p", ACTIVE)
    b.refine("F05", "F04", "p301 IN (1, 2, 3)")
    b.refine("F06", "F04", LOW_INCOME)
    b.refine("F07", "F04", SEX)
    b.refine("F08", "F04", SCHOOLING)
    b.count("F10", f"({PARTICIPANT} AND {ACTIVE}) OR ({REPORTABLE} AND {CONTACTED})")
    b.refine("F11", "F10", REPORTABLE)
    b.contacts("F", "F11")
    b.count("F16", PARTICIPANT, TRAINED, ACTIVE)
    b.services("F")
    b.exits("F", "F04p", (NOT_EXCLUDED, EXIT_2Q), (NOT_EXCLUDED, EXIT_4Q))

    b.rate("G05", "n", "F04", DISABLED, over="F04")
    b.rate("G06", "n", "F04", LOW_INCOME, over="F04")
    b.rate("G07", "n", "F04", SEX, over="F04")
    b.rate("G08", "n", "F04", SCHOOLING, over="F04")
    b.rate("G11", "n", "F10", REPORTABLE, over="F10")
    for row, date in CONTACT_ROWS.items():
        b.rate("G" + row, "n", "F11", f"{date} >= :abc_start", over="F11")
    b.refine("G16n", "F04", TRAINED)
    b.refine("G16d", "F04p", "(p901 >= :abc_start OR p901 IS NOT NULL)")
    b.ratio("G16", "G16n", "G16d")
    tested = SERVICE_ROWS | {"19": "p1102", "20": "p1102"}
    b.service_rates("G", "n", "F16", "F04", "F04", tested)
    b.outcomes("G", "F")


def _veterans(b: _Builder):
    b.refine("H04", "F04p", VETERAN, ACTIVE)
    b.refine("H05", "H04", DISABLED)
    b.refine("H06", "H04", LOW_INCOME)
    b.refine("H07", "H04", SEX)
    b.refine("H08", "H04", SCHOOLING)
    b.count("H10", "p918 IN (1, 2)", VETERAN, ACTIVE)
    b.count("H11", REPORTABLE, VETERAN, CONTACTED)
    b.contacts("H", "H11")
    b.refine("H16", "H10", PARTICIPANT, TRAINED)
    b.services("H")
    b.count("H27p", PARTICIPANT, VETERAN)
    b.exits("H", "H27p", (EXIT_2Q, NOT_EXCLUDED), (EXIT_4Q, NOT_EXCLUDED))

    b.rate("I04", "p", "F04", VETERAN, over="F04")
    b.rate("I05", "p", "H04", DISABLED, over="H04")
    b.rate("I06", "p", "H04", LOW_INCOME, over="H04")
    b.rate("I07", "p", "H04", SEX, over="H04")
    b.rate("I08", "p", "H04", SCHOOLING, over="H04")
    b.rate("I10", "p", "F10", VETERAN, over="H10")
    b.rate("I11", "p", "F11", VETERAN, over="F11")
    for row, date in CONTACT_ROWS.items():
        b.rate("I" + row, "p", "I11p", f"{date} >= :abc_start", over="F11")
    b.rate("I16", "p", "H04", TRAINED, over="H04")
    b.service_rates("I", "p", "H16", "H04", "H04")
    b.outcomes("I", "H", VETERAN)


def _disabled(b: _Builder):
    b.refine("J05", "F04p", DISABLED)
    b.refine("J06", "J05", VETERAN)
    b.refine("J07", "J05", LOW_INCOME)
    b.refine("J08", "J05", SCHOOLING)
    b.count("J10", "p918 IN (1, 2)", DISABLED, ACTIVE)
    b.count("J11", REPORTABLE, DISABLED, CONTACTED)
    b.contacts("J", "J11")
    b.count("J16", PARTICIPANT, DISABLED, ACTIVE, TRAINED)
    b.services("J")
    b.exits("J", "F04p", (DISABLED, EXIT_2Q, NOT_EXCLUDED), (DISABLED, EXIT_4Q))

    b.rate("K05", "n", "F04", DISABLED, over="F04")
    b.rate("K06", "n", "J05", VETERAN, over="J05")
    b.rate("K07", "n", "J05", LOW_INCOME, over="J05")
    b.rate("K08", "n", "J05", SCHOOLING, over="J05")
    b.rate("K10", "n", "J10", VETERAN, over="J10")
    b.rate("K11", "n", "F11", DISABLED, over="F11")
    for row, date in CONTACT_ROWS.items():
        b.rate("K" + row, "n", "K11n", f"{date} >= :abc_start", over="F11")
    b.rate("K16", "n", "J05", TRAINED, over="J05")
    b.service_rates("K", "n", "J16", "J05", "J16")
    b.outcomes("K", "J", DISABLED)


def _youth(b: _Builder):
    b.refine("L04", "F04", YOUTH)
    b.refine("L05", "L04", DISABLED)
    b.refine("L06", "L04", VETERAN)
    b.refine("L07", "L04", LOW_INCOME)
    b.refine("L08", "L04", SCHOOLING)
    b.count("L10", "p918 IN (1, 2)", ACTIVE)
    b.count("L11", REPORTABLE, YOUTH, CONTACTED)
    b.contacts("L", "L11")
    b.refine("L16", "F04p", YOUTH, ACTIVE, TRAINED)
    b.services("L")
    b.exits("L", "F04p", (YOUTH, EXIT_2Q, NOT_EXCLUDED), (YOUTH, EXIT_4Q, "923 = 00"))

    b.rate("M04", "n", "F04", YOUTH, over="F04")
    b.rate("M05", "n", "L04", DISABLED, over="L04")
    b.rate("M06", "n", "L04", VETERAN, over="L04")
    b.rate("M07", "n", "L04", LOW_INCOME, over="L04")
    b.rate("M08", "n", "L04", SCHOOLING, over="L04")
    b.rate("M10", "n", "F10", YOUTH, over="F10")
    b.rate("M11", "n", "F11", YOUTH, over="F11")
    for row, date in CONTACT_ROWS.items():
        b.rate("M" + row, "n", "F11", YOUTH, f"{date} >= :abc_start", over="F11")
    b.rate("M16", "n", "L04", TRAINED, over="L04")
    b.service_rates("M", "n", "L16", "L04", "L04")
    b.outcomes("M", "L", YOUTH)


def standard_catalog(wrap: bool = False) -> Catalog:
    """The 252 cells of the standard report in report order."""
    builder = _Builder()
    for column_pair in (_everybody, _veterans, _disabled, _youth):
        column_pair(builder)
    return Catalog(builder.cells, wrap=wrap)
