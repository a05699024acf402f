"""Measured storage: what each field of a Parquet table takes, read from the footers of its files.

The size estimate (:func:`txlens.operators.reports.record_size_profile`) divides by an assumed factor of compression.
Here the factor is measured. Files are listed by Spark and dealt over tasks; a task reads footers only (the end of a
file), one file after the other, and gives one row for each column chunk. Sums over chunks are plain aggregates.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlens.operators.reports import FIXED_FIELD_BYTES, STRING_FIELDS

CHUNKS = "path string, file_bytes bigint, footer_bytes bigint, row_group int, field string, codec string, n_values bigint, n_nulls bigint, encoded_bytes bigint, stored_bytes bigint"
#: Files whose footers one task reads (a footer is some kB; the time is that of opening the file).
FILES_PER_TASK = 256


def table_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of the Parquet files of a table, partition folders included; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    return files.select("path", "length")


def open_file(path: str):
    """A file by the URI that Spark gives it (``file:/a``, ``hdfs://...``, ``s3a://...``), at random access."""
    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        return pa.fs.LocalFileSystem().open_input_file(unquote("/" + (rest if colon else path).lstrip("/")))
    fs, inner = pa.fs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + ":" + rest)
    return fs.open_input_file(inner)


def _chunks_of(path: str, length: int) -> Iterator[dict]:
    with open_file(path) as f:
        meta = pq.read_metadata(f)
        head = {"path": path, "file_bytes": length, "footer_bytes": meta.serialized_size}
        if not meta.num_row_groups:
            yield head
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            for c in range(group.num_columns):
                chunk = group.column(c)
                stats = chunk.statistics
                yield head | {
                    "row_group": g,
                    "field": chunk.path_in_schema,
                    "codec": chunk.compression,
                    "n_values": chunk.num_values,
                    "n_nulls": stats.null_count if stats is not None and stats.has_null_count else None if chunk.num_values else 0,
                    "encoded_bytes": chunk.total_uncompressed_size,
                    "stored_bytes": chunk.total_compressed_size,
                }


def column_chunks(spark: SparkSession, path: str) -> DataFrame:
    """One row for each column chunk of each file of the Parquet table at ``path``: its values, nulls (null where the file
    does not say), bytes after encoding and bytes after compression. A file without rows gives one row without a field.

    Nested fields go by their dotted path. The files' footers are read by tasks of ``FILES_PER_TASK`` files.
    """
    files = table_files(spark, path)
    n = files.count()
    tasks = max(1, -(-n // FILES_PER_TASK), min(spark.sparkContext.defaultParallelism, n))
    schema = pa.schema([(f.name, {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}[f.dataType.simpleString()]) for f in spark.createDataFrame([], CHUNKS).schema])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, length in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                yield pa.RecordBatch.from_pylist(list(_chunks_of(name, length)), schema)

    return files.repartition(tasks, "path").mapInArrow(read, CHUNKS)


def measured_storage(chunks: DataFrame) -> DataFrame:
    """Per field: values, nulls, encoded and stored bytes and the factor between them; and a last row, field null, for
    what the files hold beside column chunks (footers, indexes, marks), so that stored bytes add up to the files."""
    fields = chunks.where("field IS NOT NULL").groupBy("field").agg(
        F.sum("n_values").alias("n_values"),
        F.when(F.count("n_nulls") == F.count(F.lit(1)), F.sum("n_nulls")).alias("n_nulls"),
        F.sum("encoded_bytes").alias("encoded_bytes"),
        F.sum("stored_bytes").alias("stored_bytes"),
    )
    per_file = chunks.groupBy("path").agg(F.max("file_bytes").alias("size"), F.coalesce(F.sum("stored_bytes"), F.lit(0)).alias("of_chunks"))
    nothing = F.lit(None).cast("bigint")
    rest = per_file.agg(F.coalesce(F.sum(F.col("size") - F.col("of_chunks")), F.lit(0)).alias("stored_bytes")).select(
        F.lit(None).cast("string").alias("field"), nothing.alias("n_values"), nothing.alias("n_nulls"), F.col("stored_bytes").alias("encoded_bytes"), "stored_bytes"
    )
    both = fields.unionByName(rest)
    return both.withColumn("encoding_factor", F.try_divide(F.col("encoded_bytes").cast("double"), F.col("stored_bytes").cast("double")))


def raw_field_bytes(tx: DataFrame) -> DataFrame:
    """(field, records, raw_bytes): the size estimate's raw bytes of each transaction field; nulls of strings take none."""
    sizes = {f: F.coalesce(F.sum(F.octet_length(f)), F.lit(0)).cast("bigint") for f in STRING_FIELDS}
    sizes |= {f: (F.count(F.lit(1)) * F.lit(n)).cast("bigint") for f, n in FIXED_FIELD_BYTES.items()}
    one = tx.agg(F.count(F.lit(1)).alias("records"), *[c.alias(f) for f, c in sizes.items()])
    return one.unpivot(["records"], list(sizes), "field", "raw_bytes").select("field", "records", "raw_bytes")


def storage_by_field(spark: SparkSession, path: str, tx: DataFrame | None = None) -> DataFrame:
    """The size estimate beside the measurement for the transactions stored at ``path``, per field: records, raw bytes,
    values and nulls by the footers, encoded and stored bytes, and the measured factor raw / stored (what the estimate
    takes as one constant). ``tx`` is the table itself if it is at hand."""
    tx = spark.read.parquet(path) if tx is None else tx
    measured = measured_storage(column_chunks(spark, path))
    return raw_field_bytes(tx).join(F.broadcast(measured), "field").withColumn(  # a row a field
        "measured_compression", F.try_divide(F.col("raw_bytes").cast("double"), F.col("stored_bytes").cast("double"))
    )
