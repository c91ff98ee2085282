import pytest
from pyspark.sql import functions as F

from eventlake import schemas as S
from eventlake.functions.masking import create_sql_functions
from eventlake.operators import governance as G
from eventlake.sources import catalog as C


@pytest.fixture
def state(spark):
    rows = [
        ("c1", "b1", "ins-1", "Ana", "123.456.789-00", None, "t", 1, "a", ["x"], "active"),
        ("c2", "b2", "ins-2", None, None, None, "t", 2, "a", ["x"], "revoked"),
        ("c3", "b2", None, "Cid", "9", None, "t", 3, "a", ["x"], "active"),
    ]
    return spark.createDataFrame(rows, S.STATE)


@pytest.fixture
def rights(spark):
    members = spark.createDataFrame([("eva", "data_engineers"), ("ann", "analysts")], "member string, grp string")
    insurers = spark.createDataFrame([("ann", "ins-1"), ("ann", "ins-2"), ("bob", "ins-2")], "member string, insurer_id string")
    return members, insurers


def view(state, rights, caller):
    return {r.client_id: r for r in G.secured_view(state, *rights, caller).collect()}


def test_masks(state, rights):
    rows = view(state, rights, "ann")
    assert (rows["c1"].tax_id, rows["c1"].client_name) == ("***.***.***-00", "CLIENTE PROTEGIDO")
    assert (rows["c2"].tax_id, rows["c2"].client_name) == (None, "CLIENTE PROTEGIDO")


def test_row_filter_fails_closed(state, rights):
    assert set(view(state, rights, "ann")) == {"c1", "c2"}
    assert set(view(state, rights, "bob")) == {"c2"}
    assert view(state, rights, "nobody") == {}


def test_privileged_caller_sees_all(state, rights):
    rows = view(state, rights, "eva")
    assert len(rows) == 3 and rows["c1"].tax_id == "123.456.789-00" and rows["c1"].client_name == "Ana"


def test_composite_filter_and_context_mask(state, rights):
    _, insurers = rights
    mine = G.entitled_insurers(insurers, "ann")
    kept = G.row_filtered_view(state, F.lit(False), mine, also=F.col("status") == "active")
    assert [r.client_id for r in kept.collect()] == ["c1"]
    masked = {r.client_id: r.tax_id for r in G.masked_by_context(state, F.lit(False), ["b1"]).collect()}
    assert masked == {"c1": "123.456.789-00", "c2": None, "c3": "***.***.***-9"}
    assert "tax_id" not in G.without_columns(state, "tax_id").columns


def test_sql_functions(spark):
    create_sql_functions(spark)
    row = spark.sql(
        "SELECT mask_tax_id('123-45', false) a, mask_tax_id('123-45', true) b, mask_tax_id(NULL, false) c, "
        "mask_name('Ana', false) d, own_insurer('i', 'i', false) e, own_insurer('i', NULL, false) f, "
        "own_insurer('i', NULL, true) g"
    ).first()
    assert tuple(row) == ("***.***.***-45", "123-45", None, "CLIENTE PROTEGIDO", True, False, True)


def test_permanent_functions_in_a_view(spark, state):
    spark.sql("CREATE DATABASE IF NOT EXISTS fn_silver")
    create_sql_functions(spark, "fn_silver")
    state.createOrReplaceTempView("t_state")
    rows = spark.sql(
        "SELECT * EXCEPT (tax_id), fn_silver.mask_tax_id(tax_id, false) AS tax_id FROM t_state "
        "WHERE fn_silver.own_insurer(insurer_id, 'ins-1', false)"
    ).collect()
    assert [(r.client_id, r.tax_id) for r in rows] == [("c1", "***.***.***-00")]


def test_bootstrap_twice_and_by_environment(spark):
    names = C.bootstrap(spark, "t1")
    assert C.bootstrap(spark, "t1") == names
    C.bootstrap(spark, "t2")
    assert {"t1_bronze", "t1_gold", "t2_silver"} <= {d.name for d in spark.catalog.listDatabases()}
    assert spark.table("t1_silver.consents").columns[-1] == "bank_id"
    partitions = [r.col_name for r in spark.sql("DESCRIBE t1_gold.daily_metrics").collect()]
    assert "# Partition Information" in partitions


def test_missing_columns_are_added_once(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS t3")
    spark.sql("CREATE TABLE IF NOT EXISTS t3.banks (bank_id STRING, name STRING) USING parquet")
    spark.sql("INSERT INTO t3.banks VALUES ('b1', 'Um')")
    wanted = C.TABLES["banks"][1]
    assert C.add_missing_columns(spark, "t3.banks", wanted) == ["_ingested_at", "_source_file", "_file_modified", "_rescued_data"]
    assert C.add_missing_columns(spark, "t3.banks", wanted) == []
    assert spark.table("t3.banks").first()._rescued_data is None


def test_members_of_groups_in_groups(spark, tmp_path):
    edges = [("ana", "a"), ("a", "b"), ("b", "c"), ("c", "a"), ("bob", "c"), ("a", "b"), ("eve", "z"), (None, "a"), ("dan", None)]
    rows = spark.createDataFrame(edges, "member string, grp string")
    kept = []

    def keep(part):
        kept.append(str(tmp_path / str(len(kept))))
        part.write.parquet(kept[-1])
        return spark.read.schema(part.schema).parquet(kept[-1])

    got = [tuple(r) for r in G.all_memberships(rows, keep).collect()]
    circle = [(m, g) for m in ("a", "b", "c", "ana", "bob") for g in ("a", "b", "c")]
    assert sorted(got) == sorted([*circle, ("eve", "z")])
    assert G.all_memberships(rows.filter("false"), keep).count() == 0
    secured = G.is_member(G.all_memberships(rows, keep), "ana", "c")
    assert spark.range(1).select(secured.alias("in")).first()["in"]
