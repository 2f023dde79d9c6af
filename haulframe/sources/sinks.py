"""Writers for files."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulframe.sources.scratch import new_path

MODES = ("overwrite", "append", "ignore", "error")
DOCUMENT_BYTES = 64 << 20  # of a JSON document, which one task reads


def write_files(
    df: DataFrame, path: str, fmt: str, mode: str = "error", codec: str | None = None, **options: object
) -> None:
    """Write to a folder in any installed format: csv, json, xml, parquet, orc, text or an add-on.

    A gzip text file is read by one task. Give ``maxRecordsPerFile`` to bound its size.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if codec is not None:
        options["compression"] = codec
    df.write.format(fmt).mode(mode).options(**options).save(path)


def write_csv(df: DataFrame, path: str, mode: str = "error", codec: str | None = None, **options: object) -> None:
    write_files(df, path, "csv", mode, codec, **options)


def write_xml(df: DataFrame, path: str, row_tag: str, mode: str = "error") -> None:
    write_files(df, path, "xml", mode, rowTag=row_tag, rootTag=f"{row_tag}s")


def write_json_documents(
    df: DataFrame, path: str, key: str, documents: int | None = None, document_bytes: int = DOCUMENT_BYTES
) -> None:
    """Multi-line JSON arrays, one per file, ordered by ``key`` and even in bytes.

    A document is read by one task, so it is cut by size: about ``document_bytes`` each, or as many bytes as make
    ``documents`` of them. Rows are dealt by range of key and a hash of the row, so that one key may fill many
    parts, and written; running totals of bytes, over the parts and within each, say which document a row
    falls into. Each document is then one task, which streams its rows between brackets.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).alias("key"), F.to_json(F.struct(*df.columns), {"pretty": "true"}).alias("value"))
    rows = rows.withColumns({"mix": F.xxhash64("value"), "bytes": (F.octet_length("value") + 2).cast("bigint")})
    parts_path = new_path(spark, "json-parts")
    dealt = rows.repartitionByRange("key", "mix").withColumn("part", F.spark_partition_id())
    dealt.write.parquet(parts_path)
    parts = spark.read.schema(dealt.schema).parquet(parts_path)
    sizes = parts.groupBy("part").agg(F.sum("bytes").alias("size"))
    total = sizes.agg(F.sum("size")).first()[0] or 0
    if documents is not None:
        document_bytes = max(1, -(-total // documents))
    before = F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("part", before.alias("start"))  # one line per part
    within = Window.partitionBy("part").orderBy("key", "mix").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    place = F.col("start") + F.sum("bytes").over(within) - F.col("bytes")
    placed = parts.join(starts, "part").withColumn("document", F.floor(place / document_bytes).cast("int"))
    count = max(1, -(-total // document_bytes))
    ordered = placed.repartitionById(count, "document").sortWithinPartitions("key", "mix").select("value")
    ordered.mapInArrow(_between_brackets, "value string").write.text(path)


def _between_brackets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    start = "["
    for batch in batches:
        lines = []
        for record in batch.column(0).to_pylist():
            lines += [start, record]
            start = ","
        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])
    if start == ",":
        yield pa.RecordBatch.from_arrays([pa.array(["]"], pa.string())], ["value"])


def convert(df: DataFrame, path: str, fmt: str) -> None:
    """Rewrite a frame read from one format in another."""
    write_files(df, path, fmt, "overwrite")
