"""Raw trips derived from the shared TPC-H-style ``orders`` table.

The mapping text is shared verbatim with the DuckDB oracle (see
``__spark_entry__.oracle_sql``), so both engines start from identical rows.
It yields one ride per order with gaps in dates, negative and zero durations,
NULL stations, and one station id that carries two names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TRIPS_FROM_ORDERS_SQL = """
select
  cast(o_orderkey as string) as ride_id,
  case when o_orderkey % 3 = 0 then 'electric_bike' else 'classic_bike' end as rideable_type,
  o_orderdate + interval '1' second * ((o_orderkey * 7919) % 86400) as started_at,
  o_orderdate + interval '1' second * ((o_orderkey * 7919) % 86400 + (o_orderkey * 104729) % 7200 - 60) as ended_at,
  case when o_custkey % 97 = 0 then null
       else concat('Station ', cast(o_custkey % 40 as string),
            case when o_custkey % 40 = 7 and o_orderkey % 5 = 0 then ' (moved)' else '' end) end as start_station_name,
  case when o_custkey % 97 = 0 then null else cast(o_custkey % 40 as string) end as start_station_id,
  case when o_orderkey % 50 = 0 then null
       else concat('Station ', cast((o_custkey * 7 + o_orderkey) % 40 as string)) end as end_station_name,
  case when o_orderkey % 50 = 0 then null
       else cast((o_custkey * 7 + o_orderkey) % 40 as string) end as end_station_id,
  cast(40.60 + (o_custkey % 40) * 0.005 as double) as start_lat,
  cast(-74.05 + (o_custkey % 40) * 0.0045 as double) as start_lng,
  case when o_orderkey % 50 = 0 then null
       else cast(40.60 + ((o_custkey * 7 + o_orderkey) % 40) * 0.005 as double) end as end_lat,
  case when o_orderkey % 50 = 0 then null
       else cast(-74.05 + ((o_custkey * 7 + o_orderkey) % 40) * 0.0045 as double) end as end_lng,
  case when o_custkey % 2 = 0 then 'member' else 'casual' end as member_casual,
  'orders' as filename
from orders
"""


# Declared schemas of the shared tables this package reads (only the columns
# it uses), so no Parquet footer is read to infer them.
TABLE_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = TABLE_SCHEMAS.get(name)
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def trips_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips (``RAW_WITH_FILE`` columns) mapped from ``orders``."""
    orders = read_table(spark, sf_dir, "orders")
    return spark.sql(TRIPS_FROM_ORDERS_SQL.replace("from orders", "from {orders}"), orders=orders)
