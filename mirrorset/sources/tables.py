"""Reading and writing the tables of a data set."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mirrorset.schema import enforce_schema
from mirrorset.sources.sqlite import register_sqlite


def load_tables(
    spark: SparkSession,
    location: str,
    names: Iterable[str],
    fmt: str = "parquet",
    per_table: Mapping[str, Mapping[str, str]] | None = None,
    **options: str,
) -> dict[str, DataFrame]:
    """One lazy frame per table name.

    For file formats ``location`` is the folder that holds ``<name>.<fmt>``; for
    ``fmt="jdbc"`` it is the database URL and each name becomes ``dbtable``
    (the driver jar must be on the class path). For ``fmt="sqlite"`` it is a SQLite file, or a
    folder of such files. ``per_table`` holds further options of single tables, such as
    ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` of a large table read by JDBC.
    """
    per_table = per_table or {}
    if fmt == "sqlite":
        register_sqlite(spark)

    def load(name: str) -> DataFrame:
        reader = spark.read.format(fmt).options(**{**options, **per_table.get(name, {})})
        if fmt == "jdbc":
            return reader.option("url", location).option("dbtable", name).load()
        if fmt == "sqlite":
            return reader.option("dbtable", name).load(location)
        return reader.load(f"{location.rstrip('/')}/{name}.{fmt}")

    return {name: load(name) for name in names}


def register_tables(tables: Mapping[str, DataFrame]) -> None:
    """Make the frames visible to ``spark.sql`` under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def dictionary_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct non-NULL codes of a dictionary column."""
    return df.select(column).where(F.col(column).isNotNull()).distinct()


def empty_like(df: DataFrame) -> DataFrame:
    """A frame without rows that has the columns of ``df``."""
    return df.sparkSession.createDataFrame([], df.schema)


def write_table(df: DataFrame, path: str, schema: StructType | None = None, mode: str = "errorifexists") -> DataFrame:
    """Write ``df``, retyped to ``schema``, and return the written table.

    The default refuses an existing path, so a table is never overwritten while
    it is being read; ``mode="append"`` adds rows to one.
    """
    out = df if schema is None else enforce_schema(df, schema)
    out.write.mode(mode).parquet(path)
    return df.sparkSession.read.parquet(path)


def copy_tables(
    tables: Mapping[str, DataFrame],
    names: Iterable[str],
    root: str,
    schemas: Mapping[str, StructType] | None = None,
) -> dict[str, DataFrame]:
    """Append the named tables unchanged, but for their declared types, under ``root``."""
    schemas = schemas or {}
    return {n: write_table(tables[n], f"{root.rstrip('/')}/{n}", schemas.get(n), "append") for n in names}
