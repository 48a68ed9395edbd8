from tallyframe.sources.definitions import catalog_from, parse_definitions, read_catalog
from tallyframe.sources.readers import (
    parse_expected,
    publish_reference,
    read_abbreviations,
    read_expected,
    read_names,
    read_participants,
    read_reference_csv,
    read_reference_jdbc,
    read_subset_codes,
    subset_codes,
)
from tallyframe.sources.rejects import definition_rows, expected_rows, read_reference_checked, reference_rows
from tallyframe.sources.sinks import clustered, csv_to_parquet, stored_bytes, write_prepared, write_report

__all__ = [
    "catalog_from",
    "clustered",
    "csv_to_parquet",
    "definition_rows",
    "expected_rows",
    "parse_definitions",
    "parse_expected",
    "publish_reference",
    "read_abbreviations",
    "read_catalog",
    "read_expected",
    "read_names",
    "read_participants",
    "read_reference_checked",
    "read_reference_csv",
    "read_reference_jdbc",
    "read_subset_codes",
    "reference_rows",
    "stored_bytes",
    "subset_codes",
    "write_prepared",
    "write_report",
]
