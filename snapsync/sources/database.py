"""Database scans through JDBC and statements with bind values."""

import logging

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType

logger = logging.getLogger(__name__)


def jdbc_scan(
    spark: SparkSession,
    options: dict,
    query: str | None = None,
    table: str | None = None,
    split: dict | list | None = None,
    empty_as_null=False,
    single_task=False,
    fetch_size=10_000,
) -> DataFrame:
    """Read a query or a table. `split` makes the read parallel: either predicates, one per task
    (`splits.plan_splits`), or partitionColumn, lowerBound, upperBound, numPartitions. Without it the
    database sends all rows to one task, which must be asked for by `single_task`.

    The statement is logged, without the options, when the database refuses it.
    """
    if (query is None) == (table is None):
        raise ValueError("give either a query or a table")
    if not split and not single_task:
        raise ValueError("give split, or single_task=True for a small result")
    reader = spark.read.format("jdbc").options(**{"fetchsize": str(fetch_size), **options})
    by_predicates = split if isinstance(split, list) else None
    if split and by_predicates is None:
        # The JDBC source splits tables only; a query becomes a derived table.
        reader = reader.options(**split).option("dbtable", table or f"({query}) q")
    elif not split:
        reader = reader.option("query", query) if query else reader.option("dbtable", table)
    try:
        if by_predicates:
            source = table or f"({query}) q"
            properties = {"fetchsize": str(fetch_size), **options}
            df = spark.read.jdbc(properties.pop("url"), source, predicates=by_predicates, properties=properties)
        else:
            df = reader.load()
    except Exception:
        logger.exception("statement failed: %s", query or table)
        raise
    return empty_to_null(df) if empty_as_null else df


def empty_to_null(df: DataFrame) -> DataFrame:
    """Store '' as null, as some databases do."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in texts})


def bound_query(spark: SparkSession, sql: str, fill_nulls=True, **binds) -> DataFrame:
    """Run a statement with named bind values; by default null strings come back as ''."""
    df = spark.sql(sql, args=binds)
    return df.fillna("") if fill_nulls else df


def append_jdbc(df: DataFrame, options: dict, table: str) -> None:
    df.write.format("jdbc").options(**options).option("dbtable", table).mode("append").save()
