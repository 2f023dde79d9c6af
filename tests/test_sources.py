"""Readers, writers, save modes, codecs, tables and the shared folder, on small rows of our own."""

import os
from collections import Counter

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from haulframe.plans.landing import DIRTY_STRUCT
from haulframe.sources import readers, scratch, sinks, tables

CLIENTS = [(1, "Asha", 31, "PREPAID"), (2, None, 45, "POSTPAID"), (3, "Lena, M.", None, "PREPAID")]
DDL = "id int, name string, age int, plan string"


@pytest.fixture(scope="module")
def clients(spark):
    return spark.createDataFrame(CLIENTS, DDL).repartition(2)


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def files(path, ending):
    return [f for _, _, names in os.walk(path) for f in names if f.startswith("part-") and f.endswith(ending)]


@pytest.mark.parametrize(
    "fmt, codec, ending",
    [
        ("csv", "gzip", ".csv.gz"),
        ("json", "gzip", ".json.gz"),
        ("json", "snappy", ".json.snappy"),
        ("parquet", "gzip", ".gz.parquet"),
        ("parquet", "snappy", ".snappy.parquet"),
        ("orc", "zlib", ".zlib.orc"),
        ("orc", "snappy", ".snappy.orc"),
    ],
)
def test_round_trip_and_codec(spark, clients, folder, fmt, codec, ending):
    path = folder("trip")
    sinks.write_files(clients, path, fmt, "overwrite", codec)
    assert files(path, ending)
    assert bag(readers.read_formatted(spark, fmt, path, DDL)) == bag(clients)


def test_modes(spark, clients, folder):
    path = folder("modes")
    sinks.write_files(clients, path, "parquet")
    sinks.write_files(clients, path, "parquet", "append")
    assert spark.read.parquet(path).count() == 6
    sinks.write_files(clients.limit(1), path, "parquet", "ignore")
    assert spark.read.parquet(path).count() == 6
    with pytest.raises(AnalysisException):
        sinks.write_files(clients.limit(1), path, "parquet", "error")
    assert spark.read.parquet(path).count() == 6
    sinks.write_files(clients, path, "parquet", "overwrite")
    assert bag(spark.read.parquet(path)) == bag(clients)
    with pytest.raises(ValueError):
        sinks.write_files(clients, path, "parquet", "replace")


def test_xml(spark, clients, folder):
    path = folder("xml")
    sinks.write_xml(clients, path, "cust", "overwrite")
    assert bag(readers.read_xml(spark, path, "cust", DDL)) == bag(clients)


def test_add_on_format_missing(clients, folder):
    # The connector is not installed here; the generic writer passes the format on and Spark says so.
    with pytest.raises(Exception, match="(?i)delta"):
        sinks.write_files(clients, folder("addon"), "delta", "overwrite")


@pytest.mark.parametrize("sep", ["~", "|", "\t"])
def test_delimiters_and_quotes(spark, clients, folder, sep):
    path = folder("sep")
    sinks.write_csv(clients, path, sep=sep, header=True)
    assert bag(readers.read_csv(spark, path, DDL, sep=sep, header=True)) == bag(clients)


def test_raw_names_and_inference(spark, clients, folder):
    path = folder("raw")
    sinks.write_csv(clients, path)
    raw = readers.read_csv(spark, path)
    assert raw.dtypes == [(f"_c{i}", "string") for i in range(4)]
    assert readers.read_csv(spark, path, inferSchema=True).dtypes[0] == ("_c0", "int")
    assert raw.toDF("id", "name", "age", "plan").columns == ["id", "name", "age", "plan"]


def test_tower_files_found_four_ways(spark, folder):
    root = folder("towers")
    schema = "event_id int, customer_id int, tower_id string, signal int"
    region1 = spark.createDataFrame([(11, 1, "T1", -80), (12, 1, "T1", -71)], schema)
    region2 = spark.createDataFrame([(13, 2, "T5", -75)], schema)
    sinks.write_csv(region1, f"{root}/region1", sep="|", header=True)
    sinks.write_csv(region2, f"{root}/region2", sep="|", header=True)
    region1.write.json(f"{root}/region3")
    options = {"sep": "|", "header": True}
    ways = [
        readers.read_csv(spark, [f"{root}/region1", f"{root}/region2"], schema, **options),
        readers.read_csv(spark, f"{root}/region[12]", schema, **options),
        readers.read_csv(spark, f"{root}/*", schema, pathGlobFilter="*.csv", **options),
        readers.read_csv(spark, root, schema, recursiveFileLookup=True, pathGlobFilter="*.csv", **options),
    ]
    assert all(bag(way) == bag(region1) + bag(region2) for way in ways)


DIRTY = ["1,Ana,Lee,30,Pilot", "2,Bo,Ray,40", "3,Cy,Fox,ten,Nurse", "4,Di,,50,", "5,Ed,Orr,60,Cook,extra", "x,Fi,Kay,33,Vet"]


@pytest.fixture
def dirty(spark, folder):
    path = folder("dirty")
    sinks.write_files(spark.createDataFrame([(line,) for line in DIRTY], "value string"), path, "text")
    return path


def test_permissive_keeps_all_rows(spark, dirty):
    rows = {r.firstname: r for r in readers.read_csv(spark, dirty, DIRTY_STRUCT, mode="PERMISSIVE").collect()}
    assert len(rows) == 6
    assert rows["Bo"].profession is None and rows["Cy"].age is None and rows["Fi"].id is None
    assert rows["Ed"].profession == "Cook" and rows["Di"].lastname is None


def test_dropmalformed_counts_what_it_collects(spark, dirty):
    valid = readers.read_valid_csv(spark, dirty, DIRTY_STRUCT)
    assert {r.firstname for r in valid.collect()} == {"Ana", "Di"}
    assert valid.count() == 2
    assert valid.select("id").count() == 2


def test_staging_loses_nothing(spark, dirty):
    staged = readers.read_csv(spark, dirty, readers.text_schema(DIRTY_STRUCT.names))
    assert {r.age for r in staged.collect()} == {"30", "40", "ten", "50", "60", "33"}


def test_declared_not_null_is_not_enforced(spark, dirty):
    schema = readers.text_schema(DIRTY_STRUCT.names)
    schema["profession"].nullable = False
    assert readers.read_csv(spark, dirty, schema).schema["profession"].nullable


def test_json_lines_with_broken_document(spark, folder):
    path = folder("json")
    lines = ['{"id": 1, "name": "a"}', '{"id": 2, "na', '{"id": "x"}']
    sinks.write_files(spark.createDataFrame([(line,) for line in lines], "value string"), path, "text")
    rows = readers.read_json_lines(spark, path, "id int, name string").collect()
    assert len(rows) == 3
    assert sum(r[readers.CORRUPT] is not None for r in rows) == 2


def test_json_documents(spark, folder):
    path = folder("documents")
    df = spark.range(35).select("id", F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"))
    df = df.unionByName(spark.createDataFrame([(None, "no id")], "id bigint, name string"))
    sinks.write_json_documents(df, path, "id", documents=4)
    assert len(files(path, ".txt")) == 4
    assert bag(readers.read_json_documents(spark, path, "id bigint, name string").select("id", "name")) == bag(df)


def test_json_documents_are_even_in_bytes(spark, folder):
    # a third of the rows share a key, and rows differ in size
    df = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("id"), F.repeat(F.lit("x"), F.col("id").cast("int") % 200).alias("name"))
    counts = []
    for size in (50_000, 200_000):
        path = folder("documents")
        sinks.write_json_documents(df, path, "id", document_bytes=size)
        sizes = [os.path.getsize(os.path.join(path.removeprefix("file:"), f)) for f in files(path, ".txt")]
        assert all(size * 0.99 < s < size * 1.02 for s in sorted(sizes)[1:])
        assert bag(readers.read_json_documents(spark, path, "id bigint, name string")) == bag(df)
        counts.append(len(sizes))
    assert counts[0] > 3 * counts[1]


def test_json_documents_of_no_rows(spark, folder):
    path = folder("documents")
    sinks.write_json_documents(spark.range(0), path, "id")
    assert readers.read_json_documents(spark, path, "id bigint").count() == 0


def test_listing_and_preview(spark, clients, folder):
    path = folder("list")
    sinks.write_csv(clients, path, header=True)
    listed = readers.list_files(spark, path)
    assert listed.columns == ["path", "modificationTime", "length"]
    assert all(r.length > 0 for r in listed.where(F.col("path").contains("part-")).collect())
    plain = folder("plain")
    spark.createDataFrame([("z",), ("a",), ("m",)], "value string").coalesce(1).write.text(plain)
    assert [r.value for r in readers.preview_text(spark, plain, 2).collect()] == ["z", "a"]
    assert readers.list_folders(spark, plain) == [f"file:{plain}".replace("file:file:", "file:")]


def test_lines_in_a_column(spark):
    lines = spark.createDataFrame([("1\tx",), ("2\t",)], "value string")
    assert bag(readers.parse_lines(lines, "id int, v string", sep="\t")) == Counter({(1, "x"): 1, (2, None): 1})


def test_tables(spark, clients):
    schema = tables.scratch_schema(spark)
    tables.save_table(clients, f"{schema}.t1")
    tables.empty_clone(spark, f"{schema}.t1", f"{schema}.t2")
    assert spark.table(f"{schema}.t2").count() == 0
    assert spark.table(f"{schema}.t2").columns == clients.columns
    tables.replace_rows(clients.select("plan", "age", "name", "id"), f"{schema}.t2")
    tables.replace_rows(clients, f"{schema}.t2")
    assert bag(spark.table(f"{schema}.t2")) == bag(clients)
    assert "CREATE TABLE" in tables.table_ddl(spark, f"{schema}.t1").first()[0]
    assert tables.drop_table(spark, f"{schema}.t1")
    assert not spark.catalog.tableExists(f"{schema}.t1")


def test_partitioned_table_is_pruned(spark, clients):
    schema = tables.scratch_schema(spark)
    tables.save_table(clients, f"{schema}.p", partition_by=("plan",))
    back = spark.table(f"{schema}.p")
    assert bag(back.select(*clients.columns)) == bag(clients)
    plan = back.where("plan = 'PREPAID'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(plan" in plan


def test_scratch_folder_is_the_shared_one(spark):
    named = spark.conf.get(scratch.SHARED_FOLDER_SETTING, None)
    path = scratch.new_path(spark, "x")
    if named:
        assert path.startswith(named)
    assert path != scratch.new_path(spark, "x")


def test_without_a_named_folder_the_warehouse_is_used():
    class Conf:
        def get(self, name, default=None):
            return {"spark.master": "yarn", "spark.sql.warehouse.dir": "hdfs://x/warehouse/"}.get(name, default)

    class Session:
        conf = Conf()

    assert scratch.scratch_root(Session()) == "hdfs://x/warehouse/_scratch"


def test_a_table_is_read_as_its_files_are_now(spark, folder):
    from haulframe.plans.inputs import table

    root = folder("tables")
    spark.range(5).write.parquet(f"{root}/orders.parquet")
    assert table(spark, root, "orders").count() == 5
    spark.range(7).write.mode("append").parquet(f"{root}/orders.parquet")
    assert table(spark, root, "orders").count() == 12
    other = spark.newSession()
    assert table(other, root, "orders").sparkSession is other


def test_names_are_not_spliced_into_sql(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(tables, "new_path", lambda spark, label: f"{tmp_path}/it's here")
    schema = tables.scratch_schema(spark)
    tables.save_table(spark.range(3), f"{schema}.odd_name")
    tables.empty_clone(spark, f"{schema}.odd_name", f"{schema}.clone")
    assert spark.table(f"{schema}.clone").count() == 0
    assert "odd_name" in tables.table_ddl(spark, f"{schema}.odd_name").first()[0]
    assert tables.drop_table(spark, f"{schema}.odd_name")
