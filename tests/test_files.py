import os
import time

import pytest
from pyspark.sql import functions as F

from eventlake import schemas as S
from eventlake.sources import files as CSV


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as handle:
        handle.write(text)


@pytest.fixture
def here(tmp_path):
    return {name: str(tmp_path / name) for name in ("landing", "table", "checkpoint", "archive", "ledger", "root")}


CLIENTS = CSV.DropSource("client_master", "clients*.csv", S.CLIENT_MASTER)
HEADER = "client_id,client_name,tax_id,bank_id\n"


def take(spark, here, source=CLIENTS, **options):
    CSV.ingest(spark, source, here["landing"], here["table"], here["checkpoint"], **options)
    return CSV.read_table(spark, here["table"])


def test_each_file_is_read_once_with_provenance(spark, here):
    put(here["landing"], "clients_1.csv", HEADER + "c1,Ana,111,b1\n")
    put(here["landing"], "other.csv", "x\n1\n")
    assert take(spark, here).count() == 1
    assert take(spark, here).count() == 1
    put(here["landing"], "clients_2.csv", HEADER + "c2,Bea,222,b1\n")
    rows = take(spark, here).orderBy("client_id").collect()
    assert [(r.client_id, r.tax_id, r._source_file.rsplit("/", 1)[-1]) for r in rows] == [
        ("c1", "111", "clients_1.csv"),
        ("c2", "222", "clients_2.csv"),
    ]
    assert all(r._ingested_at is not None and r._rescued_data is None for r in rows)


def test_new_columns_and_other_orders_are_matched_by_name(spark, here):
    put(here["landing"], "clients_1.csv", HEADER + "c1,Ana,111,b1\n")
    take(spark, here)
    put(here["landing"], "clients_2.csv", "segment,client_id,client_name,tax_id,bank_id\ngold,c2,Bea,222,b1\n")
    put(here["landing"], "clients_3.csv", "tax_id,client_id\n333,c3\n")
    rows = {r.client_id: r for r in take(spark, here).collect()}
    assert (rows["c1"].segment, rows["c2"].segment, rows["c3"].segment) == (None, "gold", None)
    assert (rows["c3"].tax_id, rows["c3"].client_name) == ("333", None)
    assert all(r._rescued_data is None for r in rows.values())
    names = CSV.stored_schema(spark, here["table"]).fieldNames()
    assert names[:4] == S.CLIENT_MASTER.fieldNames() and names[-1] == "segment"


def test_rows_that_do_not_fit_are_rescued(spark, here):
    put(here["landing"], "clients_1.csv", HEADER + "c1,Ana,111,b1\nc2,short\nc3,Cid,3,b1,extra,more\n")
    rows = {r.client_id: r for r in take(spark, here).collect()}
    assert rows["c1"]._rescued_data is None
    assert rows["c2"]._rescued_data == "c2,short"
    assert rows["c3"]._rescued_data == "c3,Cid,3,b1,extra,more"


def test_columns_with_an_underscore_or_another_case_are_kept(spark, here):
    put(here["landing"], "clients_1.csv", HEADER + "c1,Ana,111,b1\n")
    put(here["landing"], "clients_2.csv", "Client_ID,_score,_source_file\nc2,7,x\n")
    rows = {r.client_id: r for r in take(spark, here).collect()}
    assert (rows["c2"]._score, rows["c2"]._source_file_2) == ("7", "x")
    assert rows["c2"]._source_file.endswith("clients_2.csv")
    assert (rows["c1"].client_name, rows["c1"]._score) == ("Ana", None)


def test_a_new_checkpoint_neither_loses_nor_doubles_rows(spark, here):
    put(here["landing"], "clients_1.csv", HEADER + "c1,Ana,111,b1\n")
    take(spark, here)
    os.rename(os.path.join(here["landing"], "clients_1.csv"), here["root"])
    put(here["landing"], "clients_2.csv", HEADER + "c2,Bea,222,b1\n")
    take(spark, here)
    rows = take(spark, here | {"checkpoint": here["checkpoint"] + "-2"}).collect()
    assert sorted(r.client_id for r in rows) == ["c1", "c2"]


def test_the_newer_file_wins(spark):
    from eventlake.operators.enrich import newest_master

    rows = spark.createDataFrame(
        [("c1", "Zoe", 1, "a"), ("c1", "Ana", 2, "b")], "client_id string, client_name string, t int, _source_file string"
    ).select("client_id", "client_name", F.timestamp_seconds("t").alias("_file_modified"), "_source_file")
    assert newest_master(rows).first().client_name == "Ana"


def test_type_hints(spark, here):
    source = CSV.DropSource("amounts", "a*.csv", S.row(id=S.STRING), hints="id STRING, amount DECIMAL(10,2)")
    put(here["landing"], "a1.csv", "id,amount\n007,1.50\n")
    row = take(spark, here, source).first()
    assert (row.id, str(row.amount)) == ("007", "1.50")
    hinted = S.apply_hints(S.row(id=S.LONG, note=S.STRING), "id STRING, extra INT")
    assert hinted.simpleString() == "struct<id:string,note:string,extra:int>"


def test_files_per_batch_and_archive(spark, here):
    for n in range(3):
        put(here["landing"], f"clients_{n}.csv", HEADER + f"c{n},N,1,b\n")
        os.utime(os.path.join(here["landing"], f"clients_{n}.csv"), (n + 1, n + 1))
    rows = take(spark, here, max_files=1, archive=here["archive"])
    assert rows.count() == 3
    batches = sorted(name.rsplit("-", 1)[1] for name in os.listdir(f"{here['table']}/data") if name.startswith("batch="))
    assert batches == ["0", "1", "2"]
    archived = [name for _, _, names in os.walk(here["archive"]) for name in names if name.endswith(".csv")]
    assert set(archived) <= {f"clients_{n}.csv" for n in range(3)} and archived


def test_overwritten_file_is_taken_again(spark, here):
    put(here["landing"], "clients_1.csv", HEADER + "c1,Ana,111,b1\n")
    args = (spark, CLIENTS, here["landing"], here["table"], here["ledger"])
    assert CSV.ingest_overwritten(*args) == 1
    assert CSV.ingest_overwritten(*args) == 0
    put(here["landing"], "clients_1.csv", HEADER + "c1,Anna,111,b1\n")
    later = time.time() + 10
    os.utime(os.path.join(here["landing"], "clients_1.csv"), (later, later))
    assert CSV.ingest_overwritten(*args) == 1
    assert sorted(r.client_name for r in CSV.read_table(spark, here["table"]).collect()) == ["Ana", "Anna"]


def test_one_stream_feeds_several_tables(spark, here):
    put(here["landing"], "clients_1.csv", HEADER + "c1,Ana,111,b1\n")
    put(here["landing"], "banks.csv", "bank_id,name\nb1,Um\nb2,Dois\n")
    CSV.route_by_file(spark, here["landing"], here["root"], here["checkpoint"], CSV.DROP_SOURCES)
    assert CSV.read_table(spark, f"{here['root']}/client_master").count() == 1
    assert CSV.read_table(spark, f"{here['root']}/banks").count() == 2


def test_csv_round_trip(spark, here):
    rows = spark.createDataFrame([("s1", 'Seguradora "A", B'), ("s2", None)], S.INSURERS)
    CSV.write_csv(rows, here["landing"])
    back = CSV.read_csv(spark, here["landing"], S.INSURERS)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))


def test_partition_columns_come_from_folders(spark, here):
    spark.range(4).withColumn("day", F.col("id") % 2).write.partitionBy("day").parquet(here["root"])
    read = spark.read.parquet(here["root"])
    assert read.filter("day = 1").count() == 2
    plan = read.filter("day = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_schema_changes_are_listed():
    before = S.row(a=S.STRING, b=S.INT, c=S.LONG)
    after = S.row(a=S.STRING, b=S.STRING, d=S.DATE)
    assert S.schema_changes(before, before) == []
    assert S.schema_changes(before, after) == [("added", "d", "date"), ("removed", "c", "bigint"), ("type", "b", "int -> string")]
