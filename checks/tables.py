"""The test tables as source tables, copies and control data.

Control data is derived from the rows of the test tables, so that the work of
every query grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
DB = "whs"
SOURCE_TYPES = {
    "bigint": "bigint",
    "int": "integer",
    "decimal(18,2)": "numeric(18,2)",
    "timestamp_ntz": "timestamp without time zone",
    "string": "character varying",
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def source(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The table as the warehouse holds it: amounts are ``numeric(18,2)``."""
    df = read(spark, sf_dir, table)
    amounts = {c: F.col(c).cast("decimal(18,2)") for c, kind in df.dtypes if kind == "double"}
    return df.withColumns(amounts)


def as_text_copy(df: DataFrame) -> DataFrame:
    """What an offload writes: every column as text."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def type_map_of(df: DataFrame, schema: str) -> DataFrame:
    """The type maps of a family's tables, named in ``table``, whose copies are all text."""
    columns = [(c, kind) for c, kind in df.dtypes if c != "table" and kind in SOURCE_TYPES]
    rows = [
        F.struct(
            F.lit(ordinal).alias("ordinal"),
            F.lit(column).alias("gp_column"),
            F.lit(SOURCE_TYPES[kind]).alias("gp_type"),
            F.lit(column).alias("ext_column"),
            F.lit("string").alias("ext_type"),
        )
        for ordinal, (column, kind) in enumerate(columns, 1)
    ]
    tables = df.select(F.lit(DB).alias("db"), F.lit(schema).alias("schema"), "table").distinct()
    return tables.select(*tables.columns, F.inline(F.array(*rows)))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table list with one table per customer."""
    return read(spark, sf_dir, "customer").select(
        F.lit(DB).alias("db"),
        F.lit("sales").alias("schema"),
        F.concat(F.lit("cust_"), F.col("c_custkey").cast("string")).alias("table"),
    )


def order_table(prefix: str = "cust_"):
    """The customer's table an order belongs to."""
    return F.concat(F.lit(prefix), F.col("o_custkey").cast("string"))


def master_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric configuration with one line per order; the last of a customer counts."""
    columns = (
        F.when(F.col("o_orderstatus") == "F", " o_totalprice")
        .when(F.col("o_orderstatus") == "O", "None")
        .otherwise("o_totalprice, o_orderkey,,")
    )
    predicate = F.when(F.col("o_orderpriority") == "2-HIGH", " o_totalprice > 0 ").otherwise("none")
    full = F.concat_ws("|", F.lit(DB), F.lit(" sales "), order_table(), columns, predicate)
    short = F.concat_ws("|", F.lit(DB), F.lit("sales"), order_table(), columns)
    return read(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderpriority") == "5-LOW", short).otherwise(full).alias("value"),
        F.lit("master.cfg").alias("path"),
        F.col("o_orderkey").alias("ordinal"),
    )


def order_type_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A type map in which every order is a column of its customer's table."""
    kinds = F.array(*[F.lit(t) for t in TYPE_NAMES])
    held = F.when(F.col("o_orderstatus") == "P", "bytea").when(F.col("o_orderstatus") == "O", "STRING").otherwise("varchar(20)")
    column = F.concat(F.lit("c_"), F.col("o_orderkey").cast("string"))
    return read(spark, sf_dir, "orders").select(
        F.lit(DB).alias("db"),
        F.lit("sales").alias("schema"),
        order_table().alias("table"),
        F.col("o_orderkey").alias("ordinal"),
        column.alias("gp_column"),
        F.element_at(kinds, (F.col("o_orderkey") % len(TYPE_NAMES) + 1).cast("int")).alias("gp_type"),
        column.alias("ext_column"),
        held.alias("ext_type"),
    )


# Source types that the type rules are tried on.
TYPE_NAMES = [
    "numeric(18,2)", "decimal(10, 4)", "NUMERIC", "decimal", "numeric (12)",
    "character varying(20)", "varchar", "char(3)", "TEXT", "string",
    "int", "integer", "bigint", "smallint", "date",
    "time without time zone", "timestamp with time zone", " Timestamp ",
    "float", "real", "double precision", "boolean", "bytea", "uuid",
    "interval", "json", "jsonb", "xml", "geometry(point)", "point", "line",
    "polygon", "circle", "integer[]", "text[]", "datetime",
]
