"""Load run: generate transactions and publish them as keyed JSON records, as one
Spark job parallel by partition; report the rate against the producer target.

``python -m txlens.sources.load --rows 10000000 --out DIR`` (files) or
``--format kafka --bootstrap-servers HOST:PORT`` (topic).
"""

from __future__ import annotations

import argparse
import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlens.schema import PRODUCER_TARGET_MSGS_PER_SEC, SOURCE_TOPIC, TOPIC_PARTITIONS
from txlens.session import build_session, size_session
from txlens.sources.envelope import publish_transactions, read_envelope
from txlens.sources.generate import generate_transactions


def run_load(
    spark: SparkSession,
    rows: int,
    path: str | None = None,
    fmt: str = "parquet",
    kafka_options: dict[str, str] | None = None,
    topic: str = SOURCE_TOPIC,
    partitions: int = TOPIC_PARTITIONS,
    seed: int = 42,
    num_partitions: int | None = None,
    target: int = PRODUCER_TARGET_MSGS_PER_SEC,
    rate_per_sec: int = PRODUCER_TARGET_MSGS_PER_SEC,
) -> dict:
    """Publish ``rows`` generated transactions (event time advancing at
    ``rate_per_sec``); return messages, wall seconds, rate."""
    gen = generate_transactions(
        spark, n=rows, seed=seed, rate_per_sec=rate_per_sec,
        num_partitions=num_partitions or spark.sparkContext.defaultParallelism,
    )
    t0 = time.perf_counter()
    publish_transactions(gen, path, fmt, topic, partitions, kafka_options=kafka_options)
    elapsed = time.perf_counter() - t0
    rate = rows / elapsed if elapsed > 0 else 0.0
    return {
        "messages": rows,
        "elapsed_sec": round(elapsed, 3),
        "msgs_per_sec": round(rate),
        "target_msgs_per_sec": target,
        "target_reached": rate >= target,
    }


def partition_report(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Per log partition: records, bytes, first and last append time of a file log."""
    env = read_envelope(spark, path, fmt)
    return env.groupBy("partition").agg(
        F.count(F.lit(1)).alias("records"),
        F.sum(F.octet_length("value") + F.coalesce(F.octet_length("key"), F.lit(0))).alias("bytes"),
        F.min("timestamp").alias("first_timestamp"),
        F.max("timestamp").alias("last_timestamp"),
    )


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description="publish generated transactions")
    p.add_argument("--rows", type=int, default=1_000_000)
    p.add_argument("--out")
    p.add_argument("--format", default="parquet")
    p.add_argument("--bootstrap-servers")
    p.add_argument("--topic", default=SOURCE_TOPIC)
    p.add_argument("--seed", type=int, default=42)
    a = p.parse_args(argv)
    spark = build_session(master=None, app_name="txlens-load")
    size_session(spark)
    kopts = {"kafka.bootstrap.servers": a.bootstrap_servers} if a.format == "kafka" else None
    print(json.dumps(run_load(spark, a.rows, a.out, a.format, kopts, a.topic, seed=a.seed)))
    spark.stop()


if __name__ == "__main__":
    main()
