"""Queries with a DuckDB equivalent, on the smallest tables and on rows with nulls, repeats and control strings."""

import os

import pytest

import __spark_entry__ as entry_point
from compare import TABLES, difference, duck
from tallyframe.llm.oracles import ORACLES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")
@pytest.mark.parametrize("name", list(ORACLES))
def test_on_given_tables(spark, name):
    assert difference(entry_point.queries()[name](spark, SF_DIR), duck(SF_DIR), entry_point.oracle_sql()[name]) is None


@pytest.fixture(scope="module")
def odd_tables(spark, tmp_path_factory):
    """Documents of two large languages and a null one, good ones with few symbols; repeated rows, empty and null texts."""
    folder = str(tmp_path_factory.mktemp("tables"))
    docs, labels = [], []
    for i in range(9000):
        words = [f"word{(i * 7 + j * j) % 997}" for j in range(20)] + (["#" * (i % 90)] if i % 4000 == 1 else [])
        docs.append((i, " ".join(words), ["en", "de", None][i % 3 if i % 50 == 0 else i % 2]))
        labels.append((i, 0 if i % 11 == 0 else 1, 0))
    texts = [None, "", " \n\t ", "nine words only " * 2, "a b c d e f g h i j\n" * 3, "ONE TWO # $ THREE four five six seven eight nine ten\n\nONE", "x" * 30000 + " y"]
    docs += [(9000 + i, t, "en") for i, t in enumerate(texts * 2)] + docs[:3] + [(None, "no id " + "z y x " * 4, None)]
    docs = [(*d, ["a", "b", None, ""][k % 4]) for k, d in enumerate(docs)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([*labels, labels[5], (5, 0, 0), (None, 1, 0), (7, None, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    said = ["<|im_end|>", "a <\\|im_end|> b", "[INST]x[/INST]", "<</SYS>>", "", None, "é\n<s>"]
    turns = [(c, t, ["user", "assistant", None][(c + t) % 3], said[(c * t) % 7]) for c in range(20) for t in range(c)]
    turns += [turns[3], (None, None, "assistant", "lost"), (5, None, "assistant", "early")]
    spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    return folder


@pytest.mark.parametrize("name", list(ORACLES))
def test_on_odd_rows(spark, odd_tables, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "labels", "conversations"):
        assert table in TABLES
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{odd_tables}/{table}.parquet/*.parquet')")
    frame = entry_point.queries()[name](spark, odd_tables)
    assert difference(frame, con, ORACLES[name]) is None
