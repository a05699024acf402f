"""The compacted parts table: bounded reads, atomic commits, replays, pruning."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from txlens.session import scratch_path
from txlens.streaming.parts import Manifest, PartsTable
from txlens.streaming.queries import merged_batch_writer

T0 = 1704067200
SCHEMA = "merchant string, window_start timestamp, window_end timestamp, v bigint, batch_id bigint"
KEYS = ["merchant", "window_start", "window_end"]


def rows_of(spark, batch, rows):
    def at(s):
        return dt.datetime.fromtimestamp(T0 + s, dt.timezone.utc)

    return spark.createDataFrame([(m, at(s), at(s + 300), v, batch) for m, s, v in rows], SCHEMA).coalesce(1)


def add(table, spark, batch, rows):
    return table.commit(table.write_segment(rows_of(spark, batch, rows), 0, batch, batch), batch)


def content(df):
    return sorted((r["merchant"] or "", int(r["window_start"].timestamp()) - T0, r["v"]) for r in df.collect())


@pytest.fixture
def table(spark):
    return PartsTable(spark, scratch_path(spark, "parts"), KEYS, 600, fanout=4)


def test_latest_part_of_each_key_survives_merges(spark, table):
    r, want = random.Random(1), {}
    for b in range(22):
        rows = {(r.choice(["a", None]), 60 * r.randrange(5)): r.randrange(1000) for _ in range(4)}
        want.update(rows)
        add(table, spark, b, [(m, s, v) for (m, s), v in rows.items()])
    schema = rows_of(spark, 0, [("a", 0, 1)]).schema
    assert content(table.read(schema)) == sorted((m or "", s, v) for (m, s), v in want.items())
    assert content(table.read(schema, since=T0 + 120)) == sorted((m or "", s, v) for (m, s), v in want.items() if s >= 120)
    assert max(s.level for s in table.manifest().segments) >= 2


def test_reads_do_not_grow_over_200_batches(spark, table):
    """As time goes on, closed windows leave; a batch reads a constant number of segments and rows."""
    schema = rows_of(spark, 0, [("a", 0, 1)]).schema
    read, held = [], []
    for b in range(200):
        m = add(table, spark, b, [("a", 60 * (b + k), b) for k in range(-4, 1)])
        read.append(len(m.segments))
        held.append(sum(s.rows for s in m.segments))
    assert max(read[20:]) <= 12 and max(read[100:]) <= max(read[20:100])
    assert max(held[100:]) <= max(held[20:100]) + 5
    newest = content(table.read(schema, since=T0 + 60 * 190))
    assert newest == [("a", 60 * s, min(199, s + 4)) for s in range(190, 200)]


def test_replayed_and_half_written_batches_are_invisible(spark, table):
    schema = rows_of(spark, 0, [("a", 0, 1)]).schema
    add(table, spark, 0, [("a", 0, 1)])
    table.write_segment(rows_of(spark, 1, [("a", 0, 99)]), 0, 1, 1)  # failed before its manifest
    table.files.publish(f"{table.root}/ledger/{5:020d}.json.abc.draft", "{")  # failed while writing one
    assert content(table.read(schema)) == [("a", 0, 1)]
    before = add(table, spark, 1, [("a", 0, 2)])
    again = add(table, spark, 1, [("a", 0, 2)])  # played again after its commit
    assert before == again and content(table.read(schema)) == [("a", 0, 2)]
    assert table.commit(table.write_segment(rows_of(spark, 2, []), 0, 2, 2), 2).batch_id == 2  # a batch without rows
    assert content(table.read(schema)) == [("a", 0, 2)]
    other = PartsTable(spark, table.root, KEYS, 600)
    with pytest.raises(Exception):  # a second writer cannot put another manifest in this one's place
        other.files.publish(f"{table.root}/ledger/{table.manifest().version:020d}.json", Manifest().to_json())
    assert content(table.read(schema)) == [("a", 0, 2)]


def test_vacuum_removes_what_nothing_names(spark, table):
    schema = rows_of(spark, 0, [("a", 0, 1)]).schema
    for b in range(9):
        add(table, spark, b, [("a", 60 * b, b)])
    table.write_segment(rows_of(spark, 9, [("a", 0, 99)]), 0, 9, 9)
    before = content(table.read(schema))
    assert table.vacuum(keep=1) > 0
    assert content(table.read(schema)) == before
    assert len(table.files.names(f"{table.root}/ledger")) == 1
    assert len(table.files.names(f"{table.root}/segments")) == len(table.manifest().segments)


def test_merged_batches_equal_all_parts(spark):
    """The writer's records after every batch equal the merge of all parts so far, replays included."""
    r = random.Random(2)
    root, out = scratch_path(spark, "mp"), scratch_path(spark, "mo")
    write = merged_batch_writer(root, "parquet", out, None, fanout=3)
    schema = "merchant string, window_start timestamp, window_end timestamp, bucket int, _n bigint, _total double, _n_amount bigint, _min double, _max double, _users bigint, _currencies array<string>"
    latest = {}
    for b in range(8):
        rows = {(r.choice(["a", "b", None]), 60 * (b + r.randrange(3)), r.randrange(2)): r.randrange(1, 9) for _ in range(6)}
        latest.update(rows)
        data = []
        for (m, s, k), n in rows.items():
            t = dt.datetime.fromtimestamp(T0 + s, dt.timezone.utc)
            data.append((m, t, t + dt.timedelta(seconds=300), k, n, float(n), n, 1.0, float(n), n, ["USD"] * (k + 1)))
        batch = spark.createDataFrame(data, schema)
        write(batch, b)
        if b % 3 == 1:
            write(batch, b)
        found = spark.read.parquet(f"{out}/batch_id={b}").select("key", F.from_json("value", "window_start timestamp, total_transactions bigint").alias("v"))
        got = {(x["key"], int(x["v"]["window_start"].timestamp()) - T0): x["v"]["total_transactions"] for x in found.collect()}
        want = {}
        for (m, s, _), n in latest.items():
            if (m, s) in {x[:2] for x in rows}:
                want[(m, s)] = want.get((m, s), 0) + n
        assert got == want
