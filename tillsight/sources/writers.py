"""Writing result tables and exports."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tillsight.functions.scalars import iso_date, iso_datetime
from tillsight.sources import versions
from tillsight.sources.schemas import LOAD_ORDER, REPLACED_TABLES

log = logging.getLogger(__name__)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_processed_csv(tables: Mapping[str, DataFrame], folder: str) -> None:
    """One ``<name>_processed.csv`` directory for each cleaned table."""
    for name, df in tables.items():
        write_csv(df, f"{folder.rstrip('/')}/{name}_processed.csv")


def replace_table(df: DataFrame, path: str) -> None:
    """Make ``df`` the content of a table, also one that it is read from.

    The old rows stay readable until the new ones are complete, and if the job
    dies half-way; ``readers.read_table`` reads the current ones.
    """
    versions.replace(df, path)


def create_table(df: DataFrame, path: str) -> None:
    """Write a table that must not exist yet."""
    df.write.mode("errorifexists").parquet(path)


def load_tables(tables: Mapping[str, DataFrame], folder: str) -> list[str]:
    """Write tables parents first.

    Base tables must be new, result tables are replaced, and a table without
    rows is skipped.  Names outside the fixed order are summaries: replaced too.
    """
    folder = folder.rstrip("/")
    names = [n for n in LOAD_ORDER if n in tables] + [n for n in tables if n not in LOAD_ORDER]
    written = []
    for name in names:
        df = tables[name]
        if name in LOAD_ORDER and df.isEmpty():
            log.info("%s has no rows, not loaded", name)
            continue
        if name in LOAD_ORDER and name not in REPLACED_TABLES:
            create_table(df, f"{folder}/{name}")
        else:
            replace_table(df, f"{folder}/{name}")
        written.append(name)
    return written


def export_sheets(sheets: Mapping[str, DataFrame], folder: str, fmt: str = "csv") -> None:
    """One directory per named sheet."""
    for name, df in sheets.items():
        writer = df.write.mode("overwrite")
        if fmt == "csv":
            writer = writer.option("header", True)
        writer.format(fmt).save(f"{folder.rstrip('/')}/{name}")


def json_rows(df: DataFrame, zero_if_null: tuple[str, ...] = ()) -> DataFrame:
    """Rows as JSON text: ISO dates and times, decimals as numbers, chosen nulls as 0."""

    def shaped(field: T.StructField) -> Column:
        c = F.col(field.name)
        if isinstance(field.dataType, T.DateType):
            c = iso_date(c)
        elif isinstance(field.dataType, T.TimestampType | T.TimestampNTZType):
            c = iso_datetime(c)
        elif isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        if field.name in zero_if_null:
            c = F.coalesce(c, F.lit(0).cast(field.dataType))
        return c.alias(field.name)

    return df.select(F.to_json(F.struct(*[shaped(f) for f in df.schema.fields])).alias("json"))
