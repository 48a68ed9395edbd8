import json

import pyarrow.parquet as pq
import pytest

from tallyframe import CohortReport, layout, standard_catalog
from tallyframe.operators import periods
from tallyframe.plans import adhoc_sql
from tallyframe.plans.catalog import COUNT, MEDIAN, RATIO, REFINE
from tallyframe.sources import (
    catalog_from,
    csv_to_parquet,
    parse_definitions,
    publish_reference,
    read_abbreviations,
    read_catalog,
    read_expected,
    read_names,
    read_participants,
    read_reference_csv,
    read_reference_jdbc,
    read_subset_codes,
    stored_bytes,
    write_prepared,
    write_report,
)


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_expected_values(spark, tmp_path):
    text = "// heading\n\nF04-AK = 12\n  F04-ALL = 3 \nF05\nF06-AL =\nF07-AK = a = b\nF04-AK = 13\nG05 = 0.5\nF08-A-B = 7"
    rows = {(r["cell"], r["subset"]): r["expected"] for r in read_expected(spark, write(tmp_path, "e.txt", text)).collect()}
    assert rows == {
        ("F04", "AK"): "13",
        ("F04", "ALL"): "3",
        ("F05", "ALL"): "",
        ("F06", "AL ="): "",
        ("F07", "AK"): "",
        ("G05", "ALL"): "0.5",
        ("F08", "A-B"): "7",
    }


def test_last_expected_line_counts_over_many_splits(spark, tmp_path):
    lines = "\n".join(f"F{i % 50}-AK = {i}" for i in range(5000))
    path = write(tmp_path, "many.txt", lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = {r["cell"]: r["expected"] for r in read_expected(spark, path).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {f"F{i}": str(4950 + i) for i in range(50)}


def test_lists(spark, tmp_path):
    assert read_names(spark, write(tmp_path, "c.txt", "// x\np900\n\np901 \n//p1\n")) == ["p900", "p901"]
    assert read_subset_codes(spark, write(tmp_path, "s.txt", "WY,AK, AL\n// ignored,ZZ\n")) == ["AK", "AL", "WY"]
    assert len(layout.STATIC_SUBSETS) == 57
    short = read_abbreviations(spark, write(tmp_path, "a.txt", "// note\n_x_ = IS NULL\n"))
    assert short == {"_x_": "IS NULL"}


DEFINITIONS = [
    {"id": "F04p", "type": "count", "query": "_scfIw_ p918 = 1"},
    {"id": "F04", "type": "formula-concatenator", "query": "F04p :: AND p900 <= _endAbc_ AND p901 _in_"},
    {"id": "W", "type": "formula-concatenator", "query": "F04p :: OR p918 = 2"},
    {"id": "G", "type": "formula-division", "query": "F04/F04p"},
    {"id": "G29", "type": "median", "query": "_swfIw_ p1704 > 0"},
]


def test_definition_file(spark, tmp_path):
    catalog = read_catalog(spark, write(tmp_path, "d.json", json.dumps(DEFINITIONS, indent=1)))
    assert catalog.names() == ["F04p", "F04", "W", "G", "G29"]
    assert [c.kind for c in catalog] == [COUNT, REFINE, REFINE, RATIO, MEDIAN]
    assert catalog.resolve("F04").predicate == "p918 = 1 AND p900 <= :abc_end AND p901 IS NULL"
    assert catalog.resolve("W").predicate == "p918 = 1 OR p918 = 2"
    assert (catalog["G"].num, catalog["G"].den) == ("F04", "F04p")
    assert (catalog["G29"].predicate, catalog["G29"].value) == ("p1704 > 0", "p1704")


@pytest.mark.parametrize(
    "kind, query",
    [
        ("average", "_scfIw_ p918 = 1"),
        ("formula-concatenator", "A :: AND b :: AND c"),
        ("formula-concatenator", "A :: , b"),
        ("count", "p918 = 1"),
    ],
)
def test_unusable_definitions_are_refused(spark, kind, query):
    frame = spark.createDataFrame([("X", kind, query)], "id string, type string, query string")
    with pytest.raises(ValueError):
        catalog_from(parse_definitions(frame))


def test_reference_tables_from_csv(spark, tmp_path):
    cohorts = write(
        tmp_path, "cohorts.csv",
        "QuarterID,MeasureID,Extra,IsActive,CoveredDataStartDate,CoveredDataEndDate\n13,1,x,1,2000-07-01 00:00:00,2001-06-30 00:00:00\n",
    )
    measures = write(tmp_path, "measures.csv", 'MeasureID,Measure,ReportTypeID\n1,"Number, Served",1\n2,Other,\n')
    c, m = read_reference_csv(spark, cohorts, measures)
    assert tuple(c.first()) == (1, 13, 1, "2000-07-01 00:00:00", "2001-06-30 00:00:00")
    assert [tuple(r) for r in m.collect()] == [(1, "Number, Served", 1), (2, "Other", None)]
    period_table = periods(m, c)
    publish_reference(c, m, period_table)
    assert adhoc_sql(spark, "SELECT period FROM periods").first()[0] == "Current"
    rows = adhoc_sql(spark, "SELECT m.Measure FROM measures m JOIN cohorts c USING (MeasureID)").collect()
    assert [r[0] for r in rows] == ["Number, Served"]
    for view in ("cohorts", "measures", "periods"):
        spark.catalog.uncacheTable(view)


def test_reference_tables_over_jdbc_ask_for_the_right_tables(spark):
    """The reader is a stand-in: no database is started for a test."""
    tables = {
        "PRS_Report_Cohorts": spark.createDataFrame(
            [("1", 13, True, "2000-07-01", "2001-06-30")],
            "MeasureID string, QuarterID bigint, IsActive boolean, CoveredDataStartDate string, CoveredDataEndDate string",
        ),
        "PRS_Report_Measures": spark.createDataFrame([(1, "m", 1)], "MeasureID int, Measure string, ReportTypeID int"),
    }
    calls = []

    class Reader:
        def jdbc(self, url, table, properties):
            calls.append((url, table, properties))
            return tables[table]

    class Session:
        read = Reader()

    cohorts, measures = read_reference_jdbc(Session(), "jdbc:x", {"user": "u"})
    assert calls == [("jdbc:x", t, {"user": "u"}) for t in tables]
    assert tuple(cohorts.first()) == (1, 13, 1, "2000-07-01", "2001-06-30")
    assert measures.count() == 1


def test_report_round_trip_through_csv(spark, tmp_path):
    rows = [('A,"x"', "A'K", "1", "", "", "MISSING", "1", "false", 'p1 IN (1, 2) AND p2 = "q"'), ("B", "ALL", *[""] * 6, "")]
    report = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in layout.REPORT_COLUMNS))
    write_report(report, str(tmp_path / "out"))
    files = [p for p in (tmp_path / "out").iterdir() if p.suffix == ".csv"]
    assert len(files) == 1
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "out"))
    assert back.columns == layout.REPORT_COLUMNS
    assert tuple(v or "" for v in back.first()) == rows[0]


def test_sorted_report_stays_sorted_in_the_file(spark, tmp_path, make_input):
    data = make_input([{"p918": "1", "p3000": chr(65 + i % 26) + chr(65 + i % 7)} for i in range(300)])
    expected = spark.createDataFrame([], "cell string, subset string, expected string")
    cells = ["F04p", "J05", "F04"]
    run = CohortReport(data, standard_catalog(), mode="both", cells=cells)
    write_report(run.report(expected), str(tmp_path / "sorted"))
    (file,) = [p for p in (tmp_path / "sorted").iterdir() if p.suffix == ".csv"]
    keys = [",".join(line.split(",")[:2]) for line in file.read_text().splitlines()[1:]]
    compound = [k.replace(",ALL", "").replace(",", "-") for k in keys]
    assert compound == sorted(compound) and len(compound) > 100


def test_bulk_conversion(spark, tmp_path):
    source = write(tmp_path, "in.csv", "\n".join(f"{i},{i % 7}" for i in range(1000)))
    for n in (4, 8):
        target = str(tmp_path / f"p{n}")
        csv_to_parquet(spark, source, target, n)
        files = [p for p in (tmp_path / f"p{n}").iterdir() if p.suffix == ".parquet"]
        assert len(files) == n
        got = spark.read.parquet(target)
        assert got.count() == 1000 and got.exceptAll(spark.read.csv(source)).count() == 0


def groups_read(folder, column, value):
    """Row groups whose footer allows the value, all row groups, and rows of each file."""
    allowed, every, rows = 0, 0, []
    for path in sorted(folder.glob("*.parquet")):
        footer = pq.ParquetFile(path).metadata
        rows.append(footer.num_rows)
        for g in range(footer.num_row_groups):
            chunk = footer.row_group(g).column(footer.schema.names.index(column)).statistics
            every += 1
            allowed += chunk is None or not chunk.has_min_max or chunk.min <= value <= chunk.max
    return allowed, every, rows


def scanned_rows(frame):
    """Rows that the scan of an executed frame handed on."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    while plan.children().size():
        plan = plan.children().head()
    return plan.metrics().apply("numOutputRows").value()


def test_clustered_conversion_deals_evenly_and_skips(spark, tmp_path):
    # a third of all rows in one subset, half without an exit date, and equal records by the thousand
    code = "CASE WHEN id % 3 = 0 THEN 'NA' ELSE concat('N', chr(cast(66 + id % 20 AS int))) END"
    rows = spark.range(60_000).selectExpr(
        f"{code} AS PIRL3000", "CASE WHEN id % 2 = 0 THEN date_format(date_add(date'2000-01-01', cast(id % 700 AS int)), 'yyyyMMdd') END AS PIRL901",
        "CASE WHEN id % 3 = 0 THEN '1' ELSE cast(id AS string) END AS PIRL918",
    )
    rows.repartition(4).write.option("header", True).csv(str(tmp_path / "csv"))
    source = str(tmp_path / "csv")
    size = stored_bytes(spark, source)
    assert size >= sum(p.stat().st_size for p in (tmp_path / "csv").glob("*.csv"))
    csv_to_parquet(spark, source, str(tmp_path / "plain"), header=True, part_bytes=size // 11 + 1)
    csv_to_parquet(spark, source, str(tmp_path / "near"), header=True, cluster_by=["PIRL3000", "PIRL901"], part_bytes=size // 11 + 1)
    plain, near = (groups_read(tmp_path / name, "PIRL3000", "NC") for name in ("plain", "near"))
    assert len(plain[2]) == len(near[2]) == 11
    assert plain[0] == plain[1] and near[0] <= 2 < near[1]
    assert max(near[2]) <= 1.5 * 60_000 / 11  # neither the hot subset nor its equal records make a large file
    back = spark.read.parquet(str(tmp_path / "near"))
    assert back.exceptAll(rows).count() == 0 and back.count() == 60_000
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        read = [scanned_rows(spark.read.parquet(str(tmp_path / n)).where("PIRL3000 = 'NC'").select("PIRL918")) for n in ("plain", "near")]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert read[0] == 60_000 and read[1] <= 2 * max(near[2])


def test_conversion_of_nothing(spark, tmp_path):
    write(tmp_path, "in.csv", "a,b\n")
    csv_to_parquet(spark, str(tmp_path / "in.csv"), str(tmp_path / "out"), header=True, cluster_by=["a"])
    assert spark.read.parquet(str(tmp_path / "out")).columns == ["a", "b"]


def test_clustered_records_by_row_groups(spark, tmp_path, make_input):
    rows = [{"p3000": "N" + chr(65 + i % 26), "p901": f"2000{1 + i % 12:02d}15", "p1704": str(i)} for i in range(20_000)]
    data = make_input(rows)
    write_prepared(data, str(tmp_path / "near"), partitions=2, cluster_by=["p3000", "p901"], row_group_bytes=1 << 14)
    allowed, every, files = groups_read(tmp_path / "near", "p3000", "NC")
    assert len(files) == 2 and allowed < every
    back = spark.read.parquet(str(tmp_path / "near"))
    assert back.schema == data.schema and back.exceptAll(data).count() == 0 and back.count() == 20_000


def test_prepared_records_round_trip(spark, tmp_path, make_input):
    data = make_input([{"p918": str(i % 3), "p900": "20200101", "p1704": "1.5", "p3000": "AK"} for i in range(50)])
    write_prepared(data, str(tmp_path / "prep"), partitions=2)
    back = read_participants(spark, str(tmp_path / "prep"))
    assert back.schema == data.schema and back.exceptAll(data).count() == 0


def test_adhoc_sql_limits_rows(spark):
    spark.range(100).createOrReplaceTempView("hundred")
    assert adhoc_sql(spark, "SELECT * FROM hundred").count() == 10
    assert [r[0] for r in adhoc_sql(spark, "SELECT id FROM hundred ORDER BY id DESC", 3).collect()] == [99, 98, 97]
