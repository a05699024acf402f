"""Driver contract: entry() and queries() against oracle_sql() in DuckDB (sf0.001)."""

import os

import duckdb
import pytest

import __spark_entry__ as se
from conftest import SF_SMALL
from txlens.plans import oracle

sys_path = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_flagship(spark):
    df = se.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["merchant", "window_start", "window_end"]


def test_the_input_can_fail_the_operators(spark):
    """Every kind of spoilt row reaches the operators, and the validity filter rejects some."""
    from conftest import SF_MID
    from txlens.plans import batch
    from txlens.sources import fixtures
    from pyspark.sql import functions as F

    rows = batch.fields(spark, SF_MID)
    kept = batch.transactions(spark, SF_MID)
    assert kept.count() < rows.count()
    for c in ("transaction_id", "user_id", "merchant", "currency", "is_international", "transaction_time", "amount"):
        assert rows.where(F.col(c).isNull()).count() > 0, c
    for c in ("user_id", "merchant", "currency", "is_international", "transaction_time"):
        assert kept.where(F.col(c).isNull()).count() > 0, c
    assert kept.where("isnan(amount)").count() > 0 and kept.where("amount = double('Infinity')").count() > 0
    assert kept.where("amount < 0.01").count() > 0 and kept.where("amount > 1e17 AND amount < 1e18").count() > 0
    log = fixtures.fixture_envelope(spark, SF_MID)
    assert log.where("cast(value as string) = '{not json'").count() > 0


def test_every_oracle_has_a_query():
    assert set(se.oracle_sql()) <= set(se.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ["events"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize(
    "name",
    [n for n in oracle.sql() if "stream" not in n],
)
def test_query_matches_oracle(spark, duck, name):
    df = se.queries()[name](spark, SF_SMALL)
    rel = duck.sql(se.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    norm = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    assert {c: norm.get(t, t) for c, t in df.dtypes} == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert _norm([tuple(r) for r in df.collect()], df.columns) == _norm(rel.fetchall(), rel.columns)


def test_runs_without_an_explicit_session_time_zone(spark):
    """A caller's session may leave spark.sql.session.timeZone at its default."""
    spark.conf.unset("spark.sql.session.timeZone")
    try:
        assert se.queries()["normalize_epoch"](spark, SF_SMALL).count() == 1000
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
