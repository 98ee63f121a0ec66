"""Row edits of a relational store expressed as new DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.ordering import global_row_number


def update_where(df: DataFrame, rules: list[tuple[Column, dict[str, Column]]]) -> DataFrame:
    """Apply update rules one after the other; a later rule sees the result of the earlier ones."""
    for condition, changes in rules:
        hit = F.coalesce(condition, F.lit(False))
        df = df.withColumns({name: F.when(hit, value).otherwise(F.col(name)) for name, value in changes.items()})
    return df


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Remove the rows for which the condition is true; rows where it is unknown stay."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def insert_rows(df: DataFrame, rows: DataFrame, defaults: dict[str, Column] | None = None) -> DataFrame:
    """Append rows that may lack columns; missing ones take their default or null."""
    defaults = defaults or {}
    filled = rows.withColumns({c: v for c, v in defaults.items() if c not in rows.columns})
    present = {c: F.coalesce(F.col(c), v) for c, v in defaults.items() if c in rows.columns}
    return df.unionByName(filled.withColumns(present) if present else filled, allowMissingColumns=True)


def with_identity(df: DataFrame, order: list[str], out: str, start: int = 1) -> DataFrame:
    """Auto-increment column following ``order``, numbered without a single-task window."""
    return global_row_number(df, order, out, start)


def set_null_reference(children: DataFrame, deleted_keys: DataFrame, reference: str) -> DataFrame:
    """ON DELETE SET NULL: references to deleted keys become null, the rows stay."""
    gone = deleted_keys.select(F.col(deleted_keys.columns[0]).alias("_gone")).distinct()
    joined = children.join(gone, F.col(reference) == F.col("_gone"), "left")
    return joined.withColumn(reference, F.when(F.col("_gone").isNull(), F.col(reference))).drop("_gone")


def cascade_delete(children: DataFrame, deleted_keys: DataFrame, reference: str) -> DataFrame:
    """ON DELETE CASCADE: children of deleted keys are removed."""
    gone = deleted_keys.select(F.col(deleted_keys.columns[0]).alias("_gone"))
    return children.join(gone, F.col(reference) == F.col("_gone"), "left_anti")


def audit_rows(inserted: DataFrame, message: Column, out: str = "message") -> DataFrame:
    """AFTER INSERT log: one message per inserted row."""
    return inserted.select(message.alias(out))
