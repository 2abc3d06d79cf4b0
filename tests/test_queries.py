"""Every registered query against its DuckDB oracle on the smallest driver tables,
plus the flagship entry and the consolidation job."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from wattle.sources.tables import TABLES

QUERIES = E.queries()
TYPE_MAP = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}
ORACLES = E.oracle_sql()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in recs]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["date", "year"] and "data_completeness" in df.columns


def test_every_query_has_a_docstring_and_most_have_oracles():
    assert len(QUERIES) >= 90
    assert set(ORACLES) <= set(QUERIES)
    from wattle.plans import catalog
    assert len(catalog.ORACLES) / len(catalog.QUERIES) > 0.9
    for n, fn in QUERIES.items():
        assert fn.__doc__, n


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    cur = duck.execute(ORACLES[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    dtypes = {r[0]: TYPE_MAP.get(r[1], r[1]) for r in duck.execute(f"DESCRIBE {ORACLES[name]}").fetchall()}
    assert {f.name: f.dataType.simpleString() for f in sdf.schema.fields} == dtypes
    assert _rows(sdf.columns, [tuple(r) for r in sdf.collect()]) == _rows(dcols, drows)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() > 0


def test_consolidation_job_report(spark, tmp_path):
    from wattle.plans.job import run
    rep = {r.source: r for r in run(spark, SF_SMALL, str(tmp_path / "out")).collect()}
    assert set(rep) == {"electricity", "carbon", "climate", "production", "gas", "economy"}
    assert all(r.status == "ok" and r.rows > 0 for r in rep.values())
    from wattle.sources import versions
    cons = versions.read(spark, str(tmp_path / "out" / "consolidated"))
    assert cons.filter(F.col("aggregation_level") == "monthly").count() > 0
    src_rows = sum(r.rows for r in rep.values())
    assert cons.count() <= src_rows
    desc = spark.read.option("sep", ";").option("header", True).csv(str(tmp_path / "out" / "reports" / "describe"))
    assert desc.count() > 10 and "p50" in desc.columns
    assert any("," in (r.mean or "") for r in desc.collect())          # decimal comma
    avail = spark.read.option("sep", ";").option("header", True).csv(str(tmp_path / "out" / "reports" / "availability"))
    assert avail.count() == desc.count()


def test_materialised_tables_are_reused_and_released(spark):
    import os
    from wattle.plans.materialize import consolidated_table, release
    a = consolidated_table(spark, SF_SMALL)
    b = consolidated_table(spark, SF_SMALL)
    assert a.inputFiles() == b.inputFiles()          # written once, scanned from the shared folder
    path = a.inputFiles()[0].split("/aggregation_level=")[0].replace("file:", "")
    assert os.path.isdir(path)
    assert release(spark) >= 1
    assert not os.path.exists(path)


def test_queries_still_run_after_release(spark):
    from wattle.plans.materialize import release
    QUERIES["forecast_metrics"](spark, SF_SMALL).count()
    release(spark)
    assert QUERIES["forecast_metrics"](spark, SF_SMALL).count() > 0
