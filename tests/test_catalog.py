"""Every registered query that has SQL gives the rows that the SQL gives in DuckDB."""

import math
import os

import duckdb
import pytest

from rollkeep.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "~"
    if isinstance(value, bool):
        return str(value)
    return f"{value:.9g}" if isinstance(value, (int, float)) else str(value)


@pytest.fixture(scope="module")
def duck(folder):
    db = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{folder}/{t}.parquet"):
            db.sql(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return db


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(name, spark, folder, duck):
    got = catalog.QUERIES[name](spark, folder)
    columns = sorted(got.columns)
    rows = sorted(tuple(plain(r[c]) for c in columns) for r in got.collect())
    wanted = duck.sql(catalog.SQL[name])
    assert sorted(wanted.columns) == columns
    place = [wanted.columns.index(c) for c in columns]
    assert rows == sorted(tuple(plain(r[i]) for i in place) for r in wanted.fetchall())


@pytest.mark.parametrize("name", ["xml_features", "xml_programs", "xml_relationships"])
def test_parsed_once(name, spark, folder):
    """Every element is parsed once, by all tasks."""
    got = catalog.QUERIES[name](spark, folder)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("from_xml(") == 1
    assert got.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_flagship(spark, folder):
    rows = catalog.flagship(spark, folder).collect()
    assert rows and all(r.entity_type in ("Individual", "Entity") for r in rows)
    assert [r.fixed_ref for r in rows] == sorted(r.fixed_ref for r in rows)


def test_driver_contract():
    import __spark_entry__ as entry

    assert set(catalog.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
