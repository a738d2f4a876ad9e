import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(__file__))

from conftest_rows import ODD  # noqa: E402

TABLES = ["documents"]


@pytest.fixture(scope="session")
def make(spark, tmp_path_factory):
    """make(rows, labels=...) writes a small documents table and its labels and gives their folder."""

    def write(rows, schema="doc_id long, text string, lang string, source string, n_chars long", labels=()):
        path = str(tmp_path_factory.mktemp("docs"))
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{path}/documents.parquet")
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
        return path

    return write


@pytest.fixture(scope="session")
def sql():
    """Rows of an oracle over the tables of a folder, as a sorted list of dicts."""

    def run(query, sf_dir):
        con = duckdb.connect()
        for t in TABLES:
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet/*.parquet')")
        r = con.sql(query)
        return sorted([dict(zip(r.columns, x, strict=True)) for x in r.fetchall()], key=repr)

    return run


@pytest.fixture(scope="session")
def odd(make):
    return make(ODD)


@pytest.fixture(scope="session")
def empty(make):
    return make([])
