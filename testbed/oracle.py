"""The same results in DuckDB SQL, written against the test tables."""

from __future__ import annotations

from tallyframe import layout, standard_catalog
from tallyframe.plans.catalog import COUNT, MEDIAN, RATIO, REFINE
from testbed.participants import COHORT_SPANS, MEASURES, QUARTER_NUMBER, column_sql
from testbed.queries import BOUNDS, COMPARED, CONTAINED, HARMLESS, LISTED, MEDIANS, PREDICATES, RATIO_CELLS, REFINEMENTS, WINDOWED

KEY = "CASE WHEN length(p3000) < 3 THEN p3000 END"


def _raw() -> str:
    columns = column_sql("strftime({}, '%Y%m%d')")
    listed = ",\n    ".join(f"{e} AS PIRL{n}" for n, e in columns.items())
    return (
        f"SELECT {listed}\n  FROM lineitem JOIN orders ON l_orderkey = o_orderkey "
        "JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"
    )


def _input() -> str:
    typed = []
    for name in layout.KEPT_COLUMNS:
        target = name.replace("PIRL", "p")
        if target in layout.DATE_COLUMNS:
            typed.append(f"CAST(try_strptime({name}, '%Y%m%d') AS DATE) AS {target}")
        elif target in layout.CODE_COLUMNS:
            typed.append(f"TRY_CAST({name} AS INTEGER) AS {target}")
        elif target == "p1704":
            typed.append(f"TRY_CAST({name} AS FLOAT) AS {target}")
        else:
            typed.append(f"{name} AS {target}")
    return f"SELECT {', '.join(typed)} FROM raw"


BASE = f"raw AS (\n  {_raw()}\n),\ninput AS (\n  {_input()}\n),\nkeyed AS (SELECT *, {KEY} AS k FROM input)"


def with_input(body: str, *ctes: str) -> str:
    return f"WITH {', '.join((BASE, *ctes))}\n{body}"


DECLARED = standard_catalog()


def dated(condition: str) -> str:
    """Window names, longest first, replaced by their days."""
    for name in sorted(BOUNDS, key=len, reverse=True):
        condition = condition.replace(f":{name}", f"DATE '{BOUNDS[name]}'")
    return condition


def joined(cell: str) -> str:
    """A cell's whole condition from what is declared of it and its parents, without the engine's own resolution."""
    own, parent = DECLARED[cell].predicate, DECLARED[cell].parent
    return f"{joined(parent)} AND {own}" if parent else own


def text(cell: str) -> str:
    return dated(joined(cell))


# The refined cells of three depths, written out by hand: neither declarations nor joining of texts are shared with the engine.
ACTIVE = "(p900 <= DATE '2001-06-30' AND (p901 IS NULL OR p901 >= DATE '2000-07-01'))"
BRIEF = "(p918 = 2 AND (p1002 >= DATE '2000-07-01' OR p1007 >= DATE '2000-07-01'))"
ENTERED = "(p1000 IS NOT NULL OR p1001 IS NOT NULL)"
SPELLED = {
    "F04": f"p918 = 1 AND {ACTIVE}",
    "H16": f"p918 = 1 AND p401 IN (1, 2, 3, 5) AND {ACTIVE} AND {ENTERED}",
    "J12": f"{BRIEF} AND p301 > 0 AND p1101 >= DATE '2000-07-01'",
    "F05": f"p918 = 1 AND {ACTIVE} AND p301 BETWEEN 1 AND 3",
    "F12": f"(p918 = 1 AND {ACTIVE}) OR ({BRIEF} AND p1101 >= DATE '2000-07-01')",
    "H17": f"p918 = 1 AND p401 IN (1, 2, 3, 5) AND {ACTIVE} AND {ENTERED} AND p1102 IS NOT NULL",
    "L05": f"p918 = 1 AND {ACTIVE} AND p413 IN (1, 2) AND p301 > 0",
    "K12n": f"(p918 = 1 AND {ACTIVE}) OR ({BRIEF} AND p301 > 0 AND p1101 >= DATE '2000-07-01')",
    "M05n": f"p918 = 1 AND {ACTIVE} AND p413 IN (1, 2) AND p301 > 0",
}
WRAPPED_F12 = f"{BRIEF} AND p1101 >= DATE '2000-07-01'"


def median_of(condition: str) -> str:
    return (
        "CAST(CAST(quantile_cont(CAST(p1704 AS DOUBLE), 0.5) "
        f"FILTER (WHERE {condition}) AS FLOAT) AS DOUBLE)"
    )


def levels(aggregates: dict[str, str], source: str = "keyed") -> str:
    """CTE ``agg``: every aggregate per listed subset and for all rows."""
    shown = ", ".join(f'{e} AS "{n}"' for n, e in aggregates.items())
    return (
        "agg AS MATERIALIZED (SELECT * FROM (SELECT CASE WHEN grouping(k) = 1 THEN 'ALL' ELSE k END AS subset, "
        f"{shown} FROM {source} GROUP BY ROLLUP (k)) WHERE subset IS NOT NULL)"
    )


def count_of(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


def stacked(names, column: str = "n", cast: str | None = None, where: str = "true") -> str:
    value = (lambda n: f'CAST("{n}" AS {cast})') if cast else (lambda n: f'"{n}"')
    return "\nUNION ALL ".join(
        f"SELECT '{n}' AS cell, subset, {value(n)} AS {column} FROM agg WHERE {where}" for n in names
    )


def counted(conditions: dict[str, str], source: str = "keyed", **options) -> str:
    aggregates = {n: count_of(c) for n, c in conditions.items()}
    return with_input(stacked(conditions, **options), levels(aggregates, source))


# --- periods ---------------------------------------------------------------------


def _reference() -> str:
    rows = ", ".join(f"({i}, '{n}', {t})" for i, n, t in MEASURES)
    spans = ", ".join(str(s) for s in COHORT_SPANS)
    return (
        f"measures AS (SELECT * FROM (VALUES {rows}) AS t(MeasureID, Measure, ReportTypeID)),\n"
        f"quarters AS (SELECT {QUARTER_NUMBER} AS QuarterID, "
        "CAST(date_trunc('quarter', min(o_orderdate)) AS DATE) AS first FROM orders GROUP BY 1),\n"
        f"spans AS (SELECT * FROM (VALUES {spans}) AS t(m, a, b, e)),\n"
        "cohorts AS (SELECT m AS MeasureID, QuarterID, a AS IsActive, "
        "CAST(first + to_months(CAST(b AS INTEGER)) AS DATE) AS s, "
        "CAST(first + to_months(CAST(e AS INTEGER)) AS DATE) - 1 AS t FROM quarters, spans)"
    )


PERIODS = f"""WITH {_reference()},
periods AS (
  SELECT CASE QuarterID WHEN 13 THEN 'Current' WHEN 12 THEN 'Previous' END AS period, m.Measure AS measure,
    c.s AS "start", c.t AS "end", CAST(m.MeasureID + CASE QuarterID WHEN 12 THEN 12 ELSE 0 END AS INTEGER) AS sequence
  FROM cohorts c JOIN measures m USING (MeasureID)
  WHERE QuarterID IN (12, 13) AND IsActive = 1 AND ReportTypeID = 1
)"""


def window(start: str) -> str:
    names = " ".join(f"WHEN '{m}' THEN '{n}'" for n, m in layout.WINDOW_MEASURES.items())
    return (
        f"{PERIODS} SELECT CASE measure {names} END AS name, measure, "
        f'{start} AS "start", "end" FROM periods WHERE period = \'Current\''
    )


def _window_grid() -> str:
    """Each window of each quarter joined to every record, its bounds as columns."""
    start = "CASE w WHEN 'cq' THEN CAST(t + 1 - INTERVAL 3 MONTH AS DATE) WHEN 'ptd' THEN DATE '2016-07-01' ELSE s END"
    dates = ", ".join(
        f"max({e}) FILTER (WHERE Measure = '{m}') AS {n}_{side}" for n, m in layout.WINDOW_MEASURES.items() for side, e in (("start", start), ("end", "t"))
    )
    catalog = standard_catalog()
    plain = lambda c: joined(c).replace(":", "")
    counts = [c for c in WINDOWED if catalog[c].kind in (COUNT, REFINE)]
    aggregates = ", ".join(f'{count_of(plain(c))} AS "{c}"' for c in counts)
    rows = value_rows(counts).replace("subset,", "quarter, w AS \"window\", subset,")
    ratios = ratio_rows(_ratios(c for c in WINDOWED if catalog[c].kind == RATIO)).replace("subset,", "quarter, w AS \"window\", subset,")
    return (
        f"WITH {BASE}, {_reference()}, spans_of AS (SELECT QuarterID AS quarter, w, {dates} FROM cohorts JOIN measures USING (MeasureID), "
        "(VALUES ('r4q'), ('cq'), ('ptd')) AS t(w) WHERE QuarterID IN (12, 13) AND IsActive = 1 AND ReportTypeID = 1 GROUP BY 1, 2),\n"
        f"agg AS (SELECT * FROM (SELECT quarter, w, CASE WHEN grouping(k) = 1 THEN 'ALL' ELSE k END AS subset, {aggregates} "
        "FROM keyed, spans_of GROUP BY GROUPING SETS ((quarter, w, k), (quarter, w))) WHERE subset IS NOT NULL)\n"
        f"{rows}\nUNION ALL {ratios}"
    )


# --- ratios ------------------------------------------------------------------------


def ratio_rows(ratios: dict[str, tuple[str, str]], where: str = "true") -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{r}' AS cell, subset, CASE WHEN \"{d}\" <> 0 THEN CAST(\"{n}\" AS DOUBLE) / \"{d}\" END AS value, "
        f'CAST("{n}" AS DOUBLE) AS numerator, CAST("{d}" AS DOUBLE) AS denominator, '
        f"CASE WHEN \"{d}\" = 0 THEN 'a/0' ELSE 'OK' END AS status FROM agg WHERE {where}"
        for r, (n, d) in ratios.items()
    )


def value_rows(names, where: str = "true") -> str:
    """Counts and medians with the columns of a ratio row."""
    return "\nUNION ALL ".join(
        f"SELECT '{n}' AS cell, subset, CAST(\"{n}\" AS DOUBLE) AS value, CAST(NULL AS DOUBLE) AS numerator, "
        f"CAST(NULL AS DOUBLE) AS denominator, CASE WHEN \"{n}\" IS NULL THEN 'undefined' ELSE 'OK' END AS status "
        f"FROM agg WHERE {where}"
        for n in names
    )


def _ratios(names) -> dict[str, tuple[str, str]]:
    catalog = standard_catalog()
    return {n: (catalog[n].num, catalog[n].den) for n in names}


def _catalog_rows() -> tuple[dict[str, str], str]:
    catalog = standard_catalog()
    counts, medians = catalog.names(COUNT, REFINE), catalog.names(MEDIAN)
    aggregates = {n: count_of(text(n)) for n in counts} | {n: median_of(text(n)) for n in medians}
    return aggregates, value_rows([*counts, *medians]) + "\nUNION ALL " + ratio_rows(_ratios(catalog.names(RATIO)))


def _catalog_report() -> str:
    aggregates, body = _catalog_rows()
    return with_input(body, levels(aggregates))


def _reconciled_all() -> str:
    """Outcomes follow from which of the six forms an expected line has."""
    form = "(ascii(substr(subset, 2, 1)) + ascii(substr(cell, 3, 1))) % 6"
    aggregates, body = _catalog_rows()
    return with_input(
        f"SELECT cell, subset, value, numerator, denominator, CASE WHEN {form} < 2 THEN 'true' ELSE 'false' END AS match, "
        f"CASE WHEN {form} < 2 THEN 'hit' WHEN {form} IN (2, 5) THEN 'miss' ELSE 'missing' END AS outcome, "
        f"CASE WHEN status <> 'OK' THEN status END AS status FROM ({body})",
        levels(aggregates),
    )


def _fused() -> str:
    catalog = standard_catalog()
    counts, medians = catalog.names(COUNT, REFINE), catalog.names(MEDIAN)
    aggregates = {n: count_of(text(n)) for n in counts} | {n: median_of(text(n)) for n in medians}
    return with_input(stacked([*counts, *medians], "value", "DOUBLE"), levels(aggregates))


def _resolved() -> str:
    """Roots and depths by walking the declared parents, counts by one scan."""
    catalog = standard_catalog()
    names = catalog.names(COUNT, REFINE)
    order = {c.name: i for i, c in enumerate(catalog)}
    declared = ", ".join(
        f"({order[n]}, '{n}', " + (f"'{catalog[n].parent}'" if catalog[n].parent else "NULL") + ")" for n in names
    )
    chain = (
        f"declared AS (SELECT * FROM (VALUES {declared}) AS t(ordinal, cell, parent)),\n"
        "chain AS (SELECT ordinal, cell, cell AS root, parent AS upward, 0 AS depth FROM declared\n"
        "  UNION ALL SELECT c.ordinal, c.cell, d.cell, d.parent, c.depth + 1 "
        "FROM chain c JOIN declared d ON c.upward = d.cell)"
    )
    counts = levels({n: count_of(text(n)) for n in names})
    body = (
        "SELECT CAST(ordinal AS INTEGER) AS ordinal, c.cell, root, CAST(depth AS INTEGER) AS depth, n "
        "FROM chain c JOIN counts ON c.cell = counts.cell WHERE upward IS NULL"
    )
    national = stacked(names, where="subset = 'ALL'")
    return f"WITH RECURSIVE {BASE}, {counts}, {chain}, counts AS ({national})\n{body}"


# --- reconciliation -----------------------------------------------------------------


def _compared() -> str:
    """CTE ``compared`` with the nine report columns and the outcome."""
    queries = ", ".join("('{}', '{}')".format(c, text(c).replace("'", "''")) for c in COMPARED)
    variant = "ascii(substr(subset, 2, 1)) % 4"
    return (
        f"actuals AS ({stacked(COMPARED)}),\n"
        f"queries AS (SELECT * FROM (VALUES {queries}) AS t(cell, query)),\n"
        f"expected AS (SELECT cell, subset, CASE {variant} WHEN 0 THEN CAST(n AS VARCHAR) "
        f"WHEN 1 THEN CAST(n + 1 AS VARCHAR) ELSE '' END AS e FROM actuals WHERE {variant} < 3),\n"
        "compared AS (SELECT a.cell, a.subset, CAST(n AS VARCHAR) AS value, '' AS numerator, '' AS denominator, "
        "CASE WHEN coalesce(e, '') = '' THEN 'MISSING' ELSE e END AS expected, CAST(n AS VARCHAR) AS actual, "
        "CASE WHEN e = CAST(n AS VARCHAR) THEN 'true' ELSE 'false' END AS match, query, "
        "CASE WHEN coalesce(e, '') = '' THEN 'missing' WHEN e = CAST(n AS VARCHAR) THEN 'hit' ELSE 'miss' END AS outcome "
        "FROM actuals a LEFT JOIN expected x ON a.cell = x.cell AND a.subset = x.subset "
        "JOIN queries q ON q.cell = a.cell)"
    )


def reconciled(body: str) -> str:
    return with_input(body, levels({c: count_of(text(c)) for c in COMPARED}), _compared())


def _listed_values(codes) -> str:
    return ", ".join(f"('{c}')" for c in codes)


def _statuses() -> str:
    parts = [
        "SELECT 'ok' AS cell, subset, CAST(ok AS DOUBLE) AS value, 'OK' AS status FROM agg",
        "SELECT 'never', subset, 0.0, 'OK' FROM agg",
        "SELECT 'middle', subset, middle, CASE WHEN middle IS NULL THEN 'undefined' ELSE 'OK' END FROM agg",
        "SELECT 'empty', subset, NULL, 'undefined' FROM agg",
        "SELECT 'zero', subset, NULL, 'a/0' FROM agg",
        "SELECT 'broken', subset, NULL, 'FAILED' FROM agg",
        "SELECT 'unset', subset, NULL, 'FAILED' FROM agg",
        "SELECT 'half', subset, CASE WHEN ok <> 0 THEN 1.0 END, CASE WHEN ok = 0 THEN 'a/0' ELSE 'OK' END FROM agg",
        "SELECT 'bad', 'ALL', NULL, 'FAILED'",
        "SELECT 'orphan', 'ALL', NULL, 'FAILED'",
        "SELECT 'unknown', 'ALL', NULL, 'MISSING'",
    ]
    parts += [f"SELECT '{n}', 'ALL', NULL, 'FAILED'" for n in (*CONTAINED, "regex_median")]
    parts += [f"SELECT '{n}', subset, CAST({n} AS DOUBLE), 'OK' FROM agg" for n in HARMLESS]
    aggregates = {"ok": count_of("p918 = 1"), "middle": median_of("p918 = 1 AND p1704 > 0")}
    aggregates |= {
        "comment": count_of("p918 = 1"),
        "code_as_number": count_of("try_cast(p3000 AS INTEGER) = 1"),
        "date_as_text": count_of("p900 >= try_cast('junk' AS DATE)"),
        "division": count_of("p918 - 1 > 0"),
        "good_regex": count_of("p3000 IN ('NA', 'NB', 'NC')"),
    }
    return with_input("\nUNION ALL ".join(parts), levels(aggregates))


def oracles() -> dict[str, str]:
    prepared = ", ".join(
        "CAST(p1704 AS DOUBLE) AS p1704" if n == "PIRL1704" else n.replace("PIRL", "p") for n in layout.KEPT_COLUMNS
    )
    chosen = _ratios(n for n in RATIO_CELLS if standard_catalog()[n].kind == RATIO)
    operands = dict.fromkeys(x for pair in chosen.values() for x in pair)
    ratio_levels = levels({n: count_of(text(n)) for n in operands})
    zero_cells = ("F04", "F26", "L31")
    listed = ", ".join(f"'{c}'" for c in LISTED)
    listed_medians = "\nUNION ALL ".join(
        f"SELECT '{m}' AS cell, l.subset, v AS value, CASE WHEN v IS NULL THEN 'undefined' ELSE 'OK' END AS status "
        f"FROM listed l LEFT JOIN (SELECT k, {median_of(text(m))} AS v FROM keyed GROUP BY k) ON l.subset = k"
        for m in MEDIANS
    )
    median_levels = levels({m: median_of(text(m)) for m in MEDIANS})
    both = ["F04", "F10", "H16", "G05n"]
    return {
        "full_report": _catalog_report(),
        "scan_input": f"WITH {BASE} SELECT * FROM raw",
        "prepare_input": f"WITH {BASE} SELECT {prepared} FROM input",
        "converted_input": f"WITH {BASE} SELECT {prepared} FROM input",
        "input_count": with_input('SELECT count(*) AS "rows" FROM input'),
        "subset_list": with_input(
            "SELECT DISTINCT p3000 AS subset FROM input WHERE length(p3000) < 3 ORDER BY subset"
        ),
        "expected_values": (
            "SELECT concat('C', o_orderkey) AS cell, "
            "CASE o_orderpriority WHEN '1-URGENT' THEN 'NA' WHEN '4-NOT SPECIFIED' THEN 'NB' ELSE 'ALL' END AS subset, "
            "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS expected "
            "FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED')"
        ),
        "typed_cohorts": (
            "SELECT CAST(o_orderkey AS INTEGER) AS QuarterID, CASE WHEN o_custkey % 3 < 2 THEN CAST(o_custkey AS INTEGER) END AS MeasureID, "
            "CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS IsActive, strftime(o_orderdate, '%Y-%m-%d 00:00:00') AS CoveredDataStartDate, "
            "strftime(o_orderdate, '%Y-%m-%d') AS CoveredDataEndDate FROM orders"
        ),
        "rejected_lines": (
            "WITH t AS (SELECT o_orderkey % 11 = 0 AS q, o_custkey % 5 = 1 AS m, o_orderstatus NOT IN ('F', 'O') AS a, "
            "CASE WHEN o_custkey % 5 <> 2 THEN o_custkey END AS id, concat_ws(',', CASE WHEN o_orderkey % 11 = 0 THEN ' ' ELSE CAST(o_orderkey AS VARCHAR) END, "
            "CASE o_custkey % 5 WHEN 0 THEN concat(o_custkey, '.0') WHEN 1 THEN 'none' WHEN 2 THEN '' ELSE CAST(o_custkey AS VARCHAR) END, "
            "CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '0' ELSE o_orderstatus END, strftime(o_orderdate, '%Y-%m-%d'), '') AS line FROM orders), "
            "judged AS (SELECT *, concat_ws('; ', CASE WHEN m THEN 'MeasureID: no int' END, CASE WHEN q THEN 'QuarterID: nothing given' END, "
            "CASE WHEN a THEN 'IsActive: no int' END) AS reason FROM t) "
            "SELECT 'kept' AS reason, count(*) AS n, CAST(sum(id) AS BIGINT) AS ids FROM judged WHERE reason = '' "
            "UNION ALL SELECT reason, count(*), count(DISTINCT line) FROM judged WHERE reason <> '' GROUP BY reason"
        ),
        "static_subsets": "SELECT concat(upper(substr(n_name, 1, 2)), n_nationkey) AS subset FROM nation",
        "prepare_odd_forms": (
            "SELECT CAST(o_orderdate AS DATE) AS p900, CASE WHEN o_custkey % 4 < 3 THEN CAST(o_custkey AS INTEGER) END AS p918, "
            "CAST(CAST(CAST(o_totalprice AS VARCHAR) AS FLOAT) AS DOUBLE) AS p1704, CAST(o_orderkey AS VARCHAR) AS p3000 FROM orders"
        ),
        "cell_catalog": (
            "SELECT concat('P', p_partkey) AS cell, "
            "CASE p_partkey % 4 WHEN 0 THEN 'count' WHEN 1 THEN 'median' WHEN 2 THEN 'refine' ELSE 'ratio' END AS kind, "
            "CASE WHEN p_partkey % 4 = 2 THEN concat('P', p_partkey - 1) END AS parent, "
            "CASE p_partkey % 4 WHEN 0 THEN concat('p202 = ', p_size, ' AND p901 IS NOT NULL') "
            "WHEN 1 THEN concat('p301 > ', p_size, ' AND p901 >= :exit2q_start') "
            "WHEN 2 THEN concat('( p413 = ', p_size, ' OR p900 IS NULL )') END AS predicate, "
            "CASE WHEN p_partkey % 4 = 1 THEN 'p1704' END AS value, "
            "CASE WHEN p_partkey % 4 = 3 THEN concat('P', p_partkey - 3) END AS num, "
            "CASE WHEN p_partkey % 4 = 3 THEN concat('P', p_partkey - 1) END AS den FROM part"
        ),
        "periods": f"{PERIODS} SELECT * FROM periods ORDER BY sequence",
        "report_window_r4q": window('"start"'),
        "report_window_cq": window('CAST("end" + 1 - INTERVAL 3 MONTH AS DATE)'),
        "report_window_ptd": window("DATE '2016-07-01'"),
        **{
            name: counted({k: dated(v) for k, v in texts.items()})
            for name, texts in PREDICATES.items()
        },
        **{
            name: counted({c: SPELLED[c] for c in cells}, column="value", cast="DOUBLE")
            for name, cells in REFINEMENTS.items()
        },
        "refine_or_precedence": counted({"textual": SPELLED["F12"], "wrapped": WRAPPED_F12}),
        "count_national": counted(
            {c: text(c) for c in ("F04", "F16", "H11", "J10", "L31")},
            column="value", cast="DOUBLE", where="subset = 'ALL'",
        ),
        "count_by_subset": with_input(
            f"SELECT k AS subset, count(*) AS n FROM keyed WHERE k IS NOT NULL AND {text('F04')} GROUP BY k ORDER BY k"
        ),
        "count_zero_fill": with_input(
            "\nUNION ALL ".join(
                f"SELECT '{c}' AS cell, l.subset, coalesce(n, 0) AS n FROM listed l LEFT JOIN "
                f"(SELECT p3000, count(*) AS n FROM input WHERE {text(c)} GROUP BY p3000) ON l.subset = p3000"
                for c in zero_cells
            ),
            f"listed AS (SELECT * FROM (VALUES {_listed_values(LISTED)}) AS t(subset))",
        ),
        "count_rollup_listed": counted(
            {c: text(c) for c in ("F04", "F10", "H04")}, source="(SELECT * FROM keyed WHERE k IS NOT NULL)"
        ),
        "count_rollup_all": counted({c: text(c) for c in ("F04", "F10", "H04")}),
        "median_national": with_input(stacked(MEDIANS, "median", where="subset = 'ALL'"), median_levels),
        "median_by_subset": with_input(
            listed_medians, f"listed AS (SELECT * FROM (VALUES {_listed_values(LISTED)}) AS t(subset))"
        ),
        "median_rollup": with_input(
            f"SELECT * FROM ({stacked(MEDIANS, 'median')}) WHERE median IS NOT NULL", median_levels
        ),
        "fused_cells": _fused(),
        "resolved_catalog": _resolved(),
        "ratio_national": with_input(ratio_rows(chosen, "subset = 'ALL'"), ratio_levels),
        "ratio_by_subset": with_input(ratio_rows(chosen, "subset <> 'ALL'"), ratio_levels),
        "ratio_status": with_input(
            "SELECT 'G05' AS cell, subset, CAST(NULL AS DOUBLE) AS value, 'FAILED' AS status FROM agg "
            "UNION ALL SELECT 'M32', subset, NULL, 'a/0' FROM agg",
            levels({"n": "count(*)"}),
        ),
        "safe_ratio": (
            "SELECT l_suppkey, l_returnflag, CASE WHEN den <> 0 THEN CAST(num AS DOUBLE) / den END AS ratio, "
            "CASE WHEN num IS NULL OR den IS NULL THEN 'FAILED' WHEN den = 0 THEN 'a/0' ELSE 'OK' END AS status FROM ("
            "SELECT l_suppkey, l_returnflag, sum(CASE WHEN l_returnflag = 'R' THEN l_linenumber END) AS num, "
            "sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) * (l_suppkey % 3) AS den "
            "FROM lineitem GROUP BY l_suppkey, l_returnflag)"
        ),
        "window_grid": _window_grid(),
        "cell_status": _statuses(),
        "reconcile_all": _reconciled_all(),
        "compare_expected": reconciled("SELECT * FROM compared"),
        "report_rows": reconciled(
            "SELECT cell, subset, value, numerator, denominator, expected, actual, match, query FROM compared "
            "ORDER BY CASE WHEN subset = 'ALL' THEN cell ELSE concat(cell, '-', subset) END"
        ),
        "accuracy_summary": reconciled(
            "SELECT count(*) FILTER (WHERE outcome = 'hit') AS hits, count(*) FILTER (WHERE outcome = 'miss') AS misses, "
            "count(*) FILTER (WHERE outcome = 'missing') AS missing, "
            "CAST(count(*) FILTER (WHERE outcome = 'hit') AS DOUBLE) / count(*) * 100 AS accuracy FROM compared"
        ),
        "run_selection": with_input(
            "SELECT 'F04' AS cell, subset, CAST(f AS DOUBLE) AS value, 'OK' AS status FROM agg "
            "UNION ALL SELECT 'F05', subset, CAST(f5 AS DOUBLE), 'OK' FROM agg "
            f"UNION ALL SELECT 'G29', 'ALL', (SELECT {median_of(text('G29'))} FROM input), 'OK' "
            "UNION ALL SELECT 'G05', 'ALL', NULL, 'FAILED' UNION ALL SELECT 'nope', 'ALL', NULL, 'MISSING'",
            levels(
                {"f": count_of(text("F04")), "f5": count_of(text("F05"))},
                "(SELECT * FROM keyed WHERE k IS NOT NULL)",
            ),
        ),
        **dict.fromkeys(("report_both_modes", "report_from_loads"), with_input(
            stacked(both, "value", "DOUBLE")
            + "\nUNION ALL SELECT 'G29', subset, \"G29\" FROM agg"
            + "\nUNION ALL SELECT 'G05', subset, CASE WHEN \"F04\" <> 0 THEN CAST(\"G05n\" AS DOUBLE) / \"F04\" END FROM agg",
            levels({c: count_of(text(c)) for c in both} | {"G29": median_of(text("G29"))}),
        )),
        "run_stats": with_input(
            'SELECT count(*) AS "rows", CAST(252 AS BIGINT) AS cells, count(DISTINCT k) AS subsets, '
            "252 * count(DISTINCT k) AS cell_values, 252 * count(DISTINCT k) * count(*) AS calculations FROM keyed"
        ),
        "adhoc_sql": with_input(
            "SELECT p3000 AS subset, count(*) AS n, max(p900) AS latest FROM input "
            "WHERE p918 = 1 AND p901 IS NULL GROUP BY p3000 ORDER BY n DESC, subset NULLS LAST LIMIT 10"
        ),
    }
