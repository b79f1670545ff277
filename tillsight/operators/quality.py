"""Data-quality counters over whole tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tillsight.functions.scalars import flag, to_col

# Column in which the CSV reader counts the values of a row that did not fit their types.
BAD_VALUES = "bad_values"

LOG_COLUMNS = ("table_name", "check_type", "status", "error_count", "total_records",
               "error_details", "checked_at")


def _missing(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.DoubleType | T.FloatType):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def _count(condition: Column) -> Column:
    return F.coalesce(F.sum(flag(condition).cast("bigint")), F.lit(0))


def invalid_email(c: str | Column = "email") -> Column:
    return ~F.coalesce(F.contains(to_col(c), F.lit("@")), F.lit(False))


def invalid_age(c: str | Column = "age") -> Column:
    c = to_col(c)
    return (c < 0) | (c > 120)


def table_rules(table: str, as_of: Column) -> dict[str, Column]:
    """The extra checks of a table, as row conditions."""
    rules = {
        "customers": {"invalid_emails": invalid_email(), "invalid_ages": invalid_age()},
        "products": {"negative_prices": F.col("price") < 0,
                     "negative_stock": F.col("stock_quantity") < 0},
        "orders": {"negative_amounts": F.col("total_amount") < 0,
                   "future_dates": F.col("order_date") > as_of},
    }
    return rules.get(table, {})


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total_records"))


def _long(one_row: DataFrame, names: Iterable[str], key: str, value: str) -> DataFrame:
    cells = [F.struct(F.lit(n).alias(key), F.col(f"`{n}`").alias(value)) for n in names]
    return one_row.select(F.inline(F.array(*cells)))


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values (null or NaN) of every column, in one pass."""
    fields = df.schema.fields
    counted = df.agg(*[_count(_missing(f)).alias(f.name) for f in fields])
    return _long(counted, [f.name for f in fields], "column_name", "null_count")


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in full; copies collapse before the shuffle."""
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    return copies.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_count"))


def data_types(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(df.dtypes, "column_name string, data_type string")


def rule_counts(table: str, df: DataFrame, as_of: Column) -> DataFrame:
    """Counts of rows breaking the table's own rules, in one pass."""
    rules = table_rules(table, as_of)
    counted = df.agg(*[_count(c).alias(n) for n, c in rules.items()])
    return _long(counted, rules, "check_type", "error_count")


def quality_report(tables: Mapping[str, DataFrame], as_of: Column,
                   checked_at: dt.datetime | Column | None = None) -> DataFrame:
    """All checks of all tables in long form, ready for the log table.

    Equal rows are brought together once, copies collapsing map-side; every
    check is then a sum over the distinct rows weighted by their copies.
    """
    stamp = F.current_timestamp() if checked_at is None else F.lit(checked_at).cast("timestamp")
    copies = F.col("_copies")
    parts = []
    for table, df in tables.items():
        broken = {f"null_count:{f.name}": _missing(f) for f in df.schema.fields if f.name != BAD_VALUES}
        broken |= table_rules(table, as_of)
        checks = {n: F.sum(F.when(c, copies)) for n, c in broken.items()}
        checks["duplicate_count"] = F.sum(copies - 1)
        if BAD_VALUES in df.columns:
            checks[BAD_VALUES] = F.sum(F.col(BAD_VALUES) * copies)
        checks["total_records"] = F.lit(0)
        counted = (df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
                   .agg(F.coalesce(F.sum(copies), F.lit(0)).alias("_rows"),
                        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(n) for n, c in checks.items()]))
        cells = [F.struct(F.lit(n).alias("check_type"), F.col(f"`{n}`").alias("error_count"),
                          F.col("_rows").alias("total_records")) for n in checks]
        parts.append(counted.select(F.inline(F.array(*cells))).withColumn("table_name", F.lit(table)))
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    failed = F.col("error_count") > 0
    return report.select(
        "table_name", "check_type", F.when(failed, "failed").otherwise("passed").alias("status"),
        "error_count", "total_records",
        F.when(failed, F.concat(F.col("error_count").cast("string"), F.lit(" of "),
                                F.col("total_records").cast("string"), F.lit(" rows"))).alias("error_details"),
        stamp.alias("checked_at"))


def latest_checks(log: DataFrame, limit: int = 50) -> DataFrame:
    return (log.select("table_name", "check_type", "status", "error_count", "total_records", "checked_at")
            .orderBy(F.col("checked_at").desc(), "table_name", "check_type").limit(limit))


def not_null_violations(tables: Mapping[str, DataFrame],
                        required: Mapping[str, Iterable[str]]) -> DataFrame:
    parts = []
    for table, columns in required.items():
        columns = list(columns)
        counted = tables[table].agg(*[_count(F.col(c).isNull()).alias(c) for c in columns])
        parts.append(_long(counted, columns, "column_name", "violations")
                     .select(F.lit(table).alias("table_name"), "column_name", "violations"))
    return _union(parts)


def unique_violations(tables: Mapping[str, DataFrame],
                      keys: Mapping[str, Iterable[tuple[str, ...]]]) -> DataFrame:
    """For each key: values used more than once and the rows too many."""
    parts = []
    for table, table_keys in keys.items():
        for key in table_keys:
            counts = tables[table].dropna(subset=list(key)).groupBy(*key).agg(F.count("*").alias("_n"))
            parts.append(counts.agg(
                F.lit(table).alias("table_name"), F.lit(",".join(key)).alias("key_columns"),
                _count(F.col("_n") > 1).alias("repeated_keys"),
                F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("extra_rows")))
    return _union(parts)


def orphan_counts(tables: Mapping[str, DataFrame],
                  references: Iterable[tuple[str, str, str, str]]) -> DataFrame:
    """Child rows whose parent is missing.

    Child keys are counted before the join, so a hot key is one row in it.
    """
    parts = []
    for child, child_key, parent, parent_key in references:
        used = (tables[child].filter(F.col(child_key).isNotNull())
                .groupBy(F.col(child_key).alias("_k")).agg(F.count("*").alias("_n")))
        known = tables[parent].select(F.col(parent_key).alias("_k"))
        parts.append(used.join(known, "_k", "left_anti").agg(
            F.lit(child).alias("child_table"), F.lit(child_key).alias("child_column"),
            F.lit(parent).alias("parent_table"), F.count("*").alias("orphan_keys"),
            F.coalesce(F.sum("_n"), F.lit(0)).alias("orphan_rows")))
    return _union(parts)


def printed_summary(report: DataFrame) -> DataFrame:
    """The few counters shown after a run, one row per table."""
    shown = ["duplicate_count", "invalid_emails", "negative_prices", "negative_amounts"]
    value = lambda n: F.max(F.when(F.col("check_type") == n, F.col("error_count"))).alias(n)
    return report.groupBy("table_name").agg(F.max("total_records").alias("total_records"),
                                            *[value(n) for n in shown])


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
