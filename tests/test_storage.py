"""Measured storage against the files themselves."""

import glob
import os

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from conftest import SF_SMALL
from txlens.operators import record_size_profile
from txlens.operators.storage import column_chunks, measured_storage, raw_field_bytes, storage_by_field
from txlens.plans import batch


@pytest.fixture
def stored(spark, tmp_shared):
    batch.fields(spark, SF_SMALL).repartition(5).write.partitionBy("currency").parquet(tmp_shared)
    return tmp_shared


def _local(path):
    return path.removeprefix("file:")


def _files(path):
    return glob.glob(os.path.join(_local(path), "**", "*.parquet"), recursive=True)


def test_bytes_equal_the_files(spark, stored):
    files = _files(stored)
    assert len(files) > 5
    found = {r["field"]: r for r in measured_storage(column_chunks(spark, stored)).collect()}
    # another reader of footers
    want = duckdb.sql(f"SELECT path_in_schema, sum(num_values)::BIGINT, sum(total_uncompressed_size)::BIGINT, sum(total_compressed_size)::BIGINT FROM parquet_metadata({files}) GROUP BY 1").fetchall()
    assert {f: (r["n_values"], r["encoded_bytes"], r["stored_bytes"]) for f, r in found.items() if f} == {f: tuple(v) for f, *v in want}
    # with what is not a column chunk, all bytes of the files are told
    assert sum(r["stored_bytes"] for r in found.values()) == sum(os.path.getsize(f) for f in files)


def test_sums_are_file_sizes_less_footers(spark, tmp_shared):
    """Files without page indexes: chunks, footer, its length and the two marks are the whole file."""
    os.makedirs(_local(tmp_shared))
    for i, n in enumerate((1000, 0, 3)):
        t = pa.table({"a": pa.array(range(n), pa.int64()), "s": pa.array([None, "x"] * (n // 2) + ["y"] * (n % 2), pa.string()), "l": pa.array([[1, 2]] * n, pa.list_(pa.int32()))})
        pq.write_table(t, os.path.join(_local(tmp_shared), f"part {i}.parquet"), row_group_size=300)
    rows = column_chunks(spark, tmp_shared).collect()
    by_file = {}
    for r in rows:
        by_file.setdefault(r["path"], []).append(r)
    assert len(by_file) == 3
    for chunks in by_file.values():
        assert chunks[0]["file_bytes"] == sum(c["stored_bytes"] or 0 for c in chunks) + chunks[0]["footer_bytes"] + 12
    found = {r["field"]: r for r in measured_storage(column_chunks(spark, tmp_shared)).collect()}
    assert found["s"]["n_nulls"] == 501 and found["a"]["n_values"] == 1003 and found["l.list.element"]["n_values"] == 2006


def test_raw_bytes_are_those_of_the_estimate(spark, stored):
    tx = spark.read.parquet(stored)
    profile = record_size_profile(tx).first()
    raw = raw_field_bytes(tx).collect()
    assert sum(r["raw_bytes"] for r in raw) == profile["raw_bytes"] and {r["records"] for r in raw} == {profile["records"]}


def test_factor_is_measured(spark, tmp_shared):
    batch.fields(spark, SF_SMALL).coalesce(1).write.parquet(tmp_shared)
    rows = storage_by_field(spark, tmp_shared).collect()
    assert len(rows) == 9
    for r in rows:
        assert r["measured_compression"] == pytest.approx(r["raw_bytes"] / r["stored_bytes"])
    # a field of four values compresses better than the ids
    factor = {r["field"]: r["measured_compression"] for r in rows}
    assert factor["currency"] > factor["transaction_id"]
