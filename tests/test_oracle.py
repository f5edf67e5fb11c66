"""Every registered query against its SQL on the smallest driver tables."""

import oracle
import pytest

from rosterflow.queries import QUERIES, SQL, files

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    if name in SQL:
        assert oracle.differences(df, db, SQL[name]) == []
    else:
        assert not df.isEmpty()


def test_damaged_csv_in_many_files(spark, db, monkeypatch):
    write = files.write_parts
    monkeypatch.setattr(files, "write_parts", lambda rows, folder, header: write(rows, folder, header, file_rows=20))
    assert oracle.differences(QUERIES["io_damaged_csv"](spark, FOLDER), db, SQL["io_damaged_csv"]) == []


def test_no_sql_without_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__

    assert not __spark_entry__.entry(spark).isEmpty()
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
