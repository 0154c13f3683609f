"""Declared table contracts (A1, A19): explicit StructTypes, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

DRIVER_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                 "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                 "l_linestatus string, l_shipdate timestamp_ntz"),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

# Catalog CSVs of the reference (countries, regions) as declared contracts.
CATALOG_SCHEMAS = {
    "countries": "country_id int, code string, name string, continent string, wikipedia_link string, keywords string",
    "regions": ("region_id int, code string, local_code string, name string, continent string, iso_country string, "
                "wikipedia_link string, keywords string"),
}


def struct(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def read_typed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan a driver table with its declared schema (no inference)."""
    return spark.read.schema(struct(DRIVER_SCHEMAS[name])).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def conforms(df: DataFrame, ddl: str) -> bool:
    """Column names and types equal the declared contract."""
    want = struct(ddl)
    return [(f.name, f.dataType) for f in df.schema.fields] == [(f.name, f.dataType) for f in want.fields]
