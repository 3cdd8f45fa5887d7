"""The warehouse folders as SQL tables of the session catalog.

``register_tables`` exposes hourly, daily, hourly_recent and
station_metadata as external Parquet tables of one database, so they can be
queried with ``spark.sql``; ``drop_tables`` is the SQL form of the table
reset (DROP TABLE IF EXISTS for each table, then the database).
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from gaugeflow.schemas import DAILY, HOURLY, STATIONS
from gaugeflow.sources.tables import Warehouse

TABLES = ["hourly", "daily", "hourly_recent", "station_metadata"]


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def register_tables(spark: SparkSession, wh: Warehouse, database: str = "hydro") -> None:
    """Create (if missing) the database and its four external tables over
    the warehouse folders; partitioned tables pick up their folders."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    parts = "`month` string, `sbucket` int"
    for name, schema, partitioned in [
        ("hourly", HOURLY, True),
        ("daily", DAILY, True),
        ("hourly_recent", HOURLY, True),
        ("station_metadata", STATIONS, False),
    ]:
        cols = _ddl(schema) + (", " + parts if partitioned else "")
        part_clause = " PARTITIONED BY (`month`, `sbucket`)" if partitioned else ""
        location = getattr(wh, name)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({cols}) USING parquet{part_clause} "
            f"LOCATION '{location}'"
        )
        if partitioned:
            spark.sql(f"ALTER TABLE `{database}`.`{name}` RECOVER PARTITIONS")
        else:
            spark.sql(f"REFRESH TABLE `{database}`.`{name}`")


def drop_tables(spark: SparkSession, database: str = "hydro") -> None:
    """DROP TABLE IF EXISTS for the four tables, then DROP DATABASE IF EXISTS
    (external tables: the folders stay; ``sinks.tables.reset_tables`` empties
    them)."""
    for name in TABLES:
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
    spark.sql(f"DROP DATABASE IF EXISTS `{database}`")
