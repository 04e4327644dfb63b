"""IO1: Parquet table scans with explicit column projection.

``read_table`` only ever reads the columns the caller lists, so Catalyst's
``ReadSchema`` stays narrow and filters placed on the result reach the scan as
``PushedFilters``.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

# The driver's tables and their columns (fixed schema, as loaded).
TABLES = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
               "o_orderpriority"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                 "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                 "l_shipdate"],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
    "labels": ["doc_id", "quality", "toxic"],
    "embeddings": ["vec_id", "embedding", "label"],
}


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str] | None = None) -> DataFrame:
    """Scan one table, projecting to ``columns`` (all known columns if None)."""
    df = spark.read.parquet(table_path(sf_dir, name))
    cols = columns if columns is not None else TABLES.get(name)
    return df.select(*cols) if cols else df


def read_if_exists(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """The Parquet table at ``path``, or None if nothing is there. Other errors are raised."""
    try:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
