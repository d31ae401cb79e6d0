"""Every registered query against another engine on the same tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from catalogue.oracles import ORACLES
from catalogue.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "date": "DATE", "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def other():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_every_oracle_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) == set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, other, name):
    frame = contract.queries()[name](spark, SF)
    columns = sorted(frame.columns)
    found = [tuple(r) for r in frame.select(*columns).collect()]
    answer = other.execute(contract.oracle_sql()[name])
    types = {d[0]: str(d[1]) for d in answer.description}
    names = [d[0] for d in answer.description]
    expected = [tuple(dict(zip(names, r))[c] for c in columns) for r in answer.fetchall()]

    def order(row):
        return tuple((v is None, str(v)) for v in row)

    assert sorted(names) == columns
    assert {c: TYPES[t] for c, t in frame.dtypes} == types
    assert sorted(found, key=order) == sorted(expected, key=order)

    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan


def test_every_order_of_a_known_customer_is_read(spark):
    rows = contract.queries()["slot_coverage"](spark, SF).collect()
    assert [r.slot for r in sorted(rows)] == [1, 2, 3, 4, 5, 6]
    orders, customers = spark.read.parquet(f"{SF}/orders.parquet"), spark.read.parquet(f"{SF}/customer.parquet")
    known = orders.join(customers, orders.o_custkey == customers.c_custkey, "left_semi").count()
    assert sum(r.orders_read for r in rows) == known
    assert sum(r.orders_in_table for r in rows) == orders.count()


def test_every_part_has_a_header_however_the_tables_are_joined(spark, tmp_path):
    """Lines of wide rows and their headers may be read by differently many tasks."""
    n = 3000
    spark.range(n).selectExpr("id AS c_custkey", "CAST(id % 900 AS DOUBLE) AS c_acctbal", "'BUILDING' AS c_mktsegment").write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(n).selectExpr(
        "id AS o_orderkey", "id AS o_custkey", "'F' AS o_orderstatus", "CAST(id AS DOUBLE) AS o_totalprice", "TIMESTAMP'1997-03-04' AS o_orderdate"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    settings = {"spark.sql.shuffle.partitions": "7", "spark.sql.autoBroadcastJoinThreshold": "40k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        found = {r.rejection_reason: r.rows_found for r in contract.queries()["malformed_rows"](spark, str(tmp_path)).collect()}
    finally:
        for name in settings:
            spark.conf.set(name, before[name]) if before[name] else spark.conf.unset(name)
    # a long line is a row of its own for each variant but the copies; those without a bill count as missing
    surplus = sum(rows for reason, rows in found.items() if "malformed_row" in reason.split("|"))
    longer = [i for i in range(1, n + 1) if i % 11 == 0 and i % 37]
    assert surplus == len(longer) + sum(i % 97 == 0 for i in longer) + sum(i % 89 == 0 for i in longer)


def test_entry(spark):
    found = contract.entry(spark).collect()
    assert [r.alert_status for r in sorted(found)][0] == "BASELINE" and len(found) == 6
