"""Marts as catalogue tables over versioned folders: a new version is written whole before the table points to it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemill.session import scratch_path


def publish(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` as the next version of table ``name`` and return the table.

    The rows go to a folder of their own below ``folder`` (by default the scratch area); only when that is complete
    does the catalogue entry move to it, so a failed write leaves the old version in place and readers never see half
    of a new one. Queries planned before keep reading the version they were planned on.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"mart-{name}") if folder is None else f"{folder.rstrip('/')}/{scratch_path(spark, name).rsplit('/', 1)[1]}"
    df.write.parquet(path)
    written = spark.read.parquet(path)
    if spark.catalog.tableExists(name) and spark.table(name).schema == written.schema:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        spark.catalog.refreshTable(name)
    else:
        # Other columns need another entry; the old version's files stay where they are.
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    return spark.table(name)


def location(spark: SparkSession, name: str) -> str:
    """Folder of the version that a table points to."""
    described = spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Location'").first()
    return described["data_type"]
