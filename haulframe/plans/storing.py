"""Queries: file sinks, save modes, codecs. Each writes whole tables and returns what is on disk."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from haulframe.plans import inputs as src
from haulframe.plans.landing import CLIENTS_SQL, DDL, NAMES, clients
from haulframe.plans.registry import query
from haulframe.sources import readers, sinks
from haulframe.sources.scratch import new_path


@query("sink_csv_overwrite", CLIENTS_SQL)
def sink_csv_overwrite(spark, sf_dir):
    path = new_path(spark, "csv-overwrite")
    sinks.write_csv(src.table(spark, sf_dir, "supplier"), path, "overwrite", "gzip", header=False)
    sinks.write_csv(clients(spark, sf_dir), path, "overwrite", "gzip", header=False)
    return readers.read_csv(spark, path, DDL)


@query("sink_csv_append", f"{CLIENTS_SQL} UNION ALL {CLIENTS_SQL}")
def sink_csv_append(spark, sf_dir):
    path = new_path(spark, "csv-append")
    for _ in range(2):
        sinks.write_csv(clients(spark, sf_dir), path, "append", "gzip", header=True)
    return readers.read_csv(spark, path, DDL, header=True)


@query("sink_csv_pipe", "SELECT event_id, user_id, event_type, value, props FROM events")
def sink_csv_pipe(spark, sf_dir):
    # props holds quotes, so it has to survive quoting.
    path = new_path(spark, "csv-pipe")
    events = src.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "props")
    sinks.write_csv(events, path, "append", "gzip", sep="|", header=True, escape='"')
    ddl = "event_id bigint, user_id bigint, event_type string, value double, props string"
    return readers.read_csv(spark, path, ddl, sep="|", header=True, escape='"')


_MODES_SQL = " UNION ALL ".join(
    CLIENTS_SQL.replace("SELECT", f"SELECT '{mode}' AS saved_by,", 1) for mode in ("overwrite", "append", "append", "ignore")
)


def _by_modes(spark, sf_dir, fmt, overwrite_codec, other_codec="snappy"):
    """Overwrite in one folder, append twice in another, write and then ignore in a third."""
    rows = clients(spark, sf_dir)
    paths = {mode: new_path(spark, f"{fmt}-{mode}") for mode in ("overwrite", "append", "ignore")}
    sinks.write_files(rows, paths["overwrite"], fmt, "overwrite", overwrite_codec)
    sinks.write_files(rows, paths["append"], fmt, "append", other_codec)
    sinks.write_files(rows, paths["append"], fmt, "append", other_codec)
    sinks.write_files(rows, paths["ignore"], fmt, "ignore", other_codec)
    sinks.write_files(rows.where("balance > 0"), paths["ignore"], fmt, "ignore", other_codec)
    parts = [
        readers.read_formatted(spark, fmt, path, DDL).select(F.lit(mode).alias("saved_by"), *NAMES)
        for mode, path in paths.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("sink_json", _MODES_SQL)
def sink_json(spark, sf_dir):
    return _by_modes(spark, sf_dir, "json", "gzip")


@query("sink_parquet", _MODES_SQL)
def sink_parquet(spark, sf_dir):
    return _by_modes(spark, sf_dir, "parquet", "gzip")


@query("sink_orc", _MODES_SQL)
def sink_orc(spark, sf_dir):
    return _by_modes(spark, sf_dir, "orc", "zlib")


@query("sink_xml", f"{CLIENTS_SQL} UNION ALL {CLIENTS_SQL}")
def sink_xml(spark, sf_dir):
    rows = clients(spark, sf_dir)
    ignored, replaced = new_path(spark, "xml-ignore"), new_path(spark, "xml-overwrite")
    sinks.write_xml(rows, ignored, "cust", "ignore")
    sinks.write_xml(rows.where("balance > 0"), ignored, "cust", "ignore")
    sinks.write_xml(rows.where("balance > 0"), replaced, "usage", "overwrite")
    sinks.write_xml(rows, replaced, "usage", "overwrite")
    first = readers.read_xml(spark, ignored, "cust", DDL)
    return first.unionByName(readers.read_xml(spark, replaced, "usage", DDL))


@query("sink_format_generic", "SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part")
def sink_format_generic(spark, sf_dir):
    path = new_path(spark, "generic")
    part = src.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")
    for mode in ("overwrite", "ignore"):
        sinks.write_files(part, path, "parquet", mode)
    return readers.read_formatted(spark, "parquet", path)


@query(
    "convert_orc_parquet",
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders",
)
def convert_orc_parquet(spark, sf_dir):
    old, new = new_path(spark, "orc"), new_path(spark, "parquet")
    orders = src.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    sinks.write_files(orders, old, "orc", "overwrite", "zlib")
    sinks.convert(spark.read.orc(old), new, "parquet")
    return spark.read.parquet(new)


_ORDERS_SQL = "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders"


def _halves(spark, sf_dir):
    orders = src.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return orders.where("o_orderstatus = 'F'"), orders.where("o_orderstatus <> 'F'")


def _second_write(spark, sf_dir, mode):
    path = new_path(spark, f"mode-{mode}")
    first, second = _halves(spark, sf_dir)
    sinks.write_files(first, path, "parquet")
    sinks.write_files(second, path, "parquet", mode)
    return spark.read.parquet(path)


@query("mode_overwrite", f"{_ORDERS_SQL} WHERE o_orderstatus <> 'F'")
def mode_overwrite(spark, sf_dir):
    return _second_write(spark, sf_dir, "overwrite")


@query("mode_append", _ORDERS_SQL)
def mode_append(spark, sf_dir):
    return _second_write(spark, sf_dir, "append")


@query("mode_ignore", f"{_ORDERS_SQL} WHERE o_orderstatus = 'F'")
def mode_ignore(spark, sf_dir):
    return _second_write(spark, sf_dir, "ignore")


@query("mode_error", f"{_ORDERS_SQL} WHERE o_orderstatus = 'F'")
def mode_error(spark, sf_dir):
    path = new_path(spark, "mode-error")
    first, second = _halves(spark, sf_dir)
    sinks.write_files(first, path, "parquet")
    try:
        sinks.write_files(second, path, "parquet", "error")
    except AnalysisException as refused:
        if refused.getCondition() != "PATH_ALREADY_EXISTS":
            raise
    else:
        raise AssertionError("a second write in error mode must be refused")
    return spark.read.parquet(path)
