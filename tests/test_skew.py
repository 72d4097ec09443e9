"""Hot keys and large groups of copies: results stay whole and equal to the oracles.

Two thirds of the lines are added to the small tables: half of them share one
order, flight and month, the other half are copies of one line. One customer
places a third of the orders.
"""

import shutil

import duckdb
import pytest

import __spark_entry__ as entry_points
from conftest import DATA
from oracle_compare import TABLES, connect, differences

SOURCE = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    con = connect(SOURCE)
    con.execute(f"""
        COPY (SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 5 ELSE o_custkey END AS o_custkey)
              FROM orders) TO '{folder}/orders.parquet' (FORMAT parquet)""")
    con.execute(f"""
        COPY (SELECT * FROM lineitem
              UNION ALL
              SELECT * REPLACE (77 AS l_orderkey, 55 AS l_partkey,
                                TIMESTAMP '1997-03-01' + to_days((l_suppkey % 31)::INTEGER)
                                    AS l_shipdate) FROM lineitem
              UNION ALL
              SELECT one.* FROM (SELECT * FROM lineitem ORDER BY ALL LIMIT 1) AS one,
                                range((SELECT count(*) FROM lineitem)))
        TO '{folder}/lineitem.parquet' (FORMAT parquet)""")
    for table in set(TABLES) - {"orders", "lineitem"}:
        shutil.copyfile(f"{SOURCE}/{table}.parquet", folder / f"{table}.parquet")
    return str(folder)


@pytest.fixture()
def eager_skew_handling(spark):
    """Shuffle joins only, and a skew threshold that this little data reaches."""
    options = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in options.items():
        spark.conf.set(key, value)
    yield
    for key in options:
        spark.conf.unset(key)


@pytest.mark.parametrize("name", [
    "bronze_bookings", "fact_ticket_sales", "fact_key_range", "fact_resolution",
    "revenue_by_route_month_tier", "revenue_as_was_as_is", "fact_loaded_as_of",
    "booking_flight_fan_out", "contract_violations", "partition_key_filter", "key_duplicates",
])
def test_skewed_tables(spark, skewed, eager_skew_handling, name):
    con: duckdb.DuckDBPyConnection = connect(skewed)
    df = entry_points.queries()[name](spark, skewed)
    assert differences(df, con, entry_points.oracle_sql()[name]) == []
