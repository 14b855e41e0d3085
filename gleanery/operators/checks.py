"""Collection checks. Each gives rows of check_name, passed, n_errors, detail."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def missing_fields(df: DataFrame, fields: dict[str, list[Column]]) -> DataFrame:
    """field, n_missing: a field is there if any of its aliases is neither null nor empty. One
    pass over the table, then one row is turned to a row for each field."""
    counts = df.agg(*[F.count_if(F.coalesce(*[F.nullif(a.cast("string"), F.lit("")) for a in aliases]).isNull()).alias(name) for name, aliases in fields.items()])
    return counts.unpivot([], list(fields), "field", "n_missing")


def dimension_counts(df: DataFrame, vectors: dict[str, tuple[Column, int]]) -> DataFrame:
    """model, n_correct, n_wrong, n_missing."""
    cells = []
    for name, (v, size) in vectors.items():
        cells.append(F.struct(F.lit(name).alias("model"), F.count_if(F.size(v) == size).alias("n_correct"), F.count_if(v.isNotNull() & (F.size(v) != size)).alias("n_wrong"), F.count_if(v.isNull()).alias("n_missing")))
    return df.agg(F.array(*cells).alias("a")).select(F.inline("a"))


def duplicate_ids(df: DataFrame, *ids: str) -> DataFrame:
    return df.groupBy(*ids).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def sampled(df: DataFrame, key: str, n: int) -> DataFrame:
    """A fixed sample: the n least digests of the key."""
    return df.orderBy(F.md5(F.col(key).cast("string").cast("binary")), key).limit(n)


def check(name: str, errors: DataFrame, detail: Column) -> DataFrame:
    """One row from a one-row table of errors (n_errors, ...)."""
    return errors.select(F.lit(name).alias("check_name"), (F.col("n_errors") == 0).alias("passed"), F.col("n_errors").cast("long").alias("n_errors"), detail.cast("string").alias("detail"))


def first_errors(errors: DataFrame, id_col: str, n: int = 20) -> DataFrame:
    """One row: n_errors, and as detail the n least ids among them, as JSON."""
    total = errors.agg(F.count("*").alias("n_errors"))
    some = errors.select(F.col(id_col).alias("id")).orderBy("id").limit(n).agg(F.to_json(F.array_sort(F.collect_list(F.col("id").cast("string")))).alias("detail"))
    return total.crossJoin(some)  # one row each


def bad_entries(df: DataFrame, id_col: str, value: str) -> DataFrame:
    """Ids whose value in a hash file isn't text of hexadecimal digits."""
    return df.where(~F.coalesce(F.col(value).rlike("^[0-9a-fA-F]+$"), F.lit(False))).select(id_col)


def report(checks: list[DataFrame]) -> DataFrame:
    """All checks with the verdict over all of them."""
    every = reduce(DataFrame.unionByName, checks)
    verdict = every.agg(F.bool_and("passed").alias("all_passed"))
    return every.crossJoin(F.broadcast(verdict))  # one row


def validation(checks: dict[str, DataFrame], slow: frozenset[str] = frozenset(), quick: bool = False) -> DataFrame:
    """The report over named checks (n_errors, detail); a quick one leaves out those that are slow."""
    return report([check(name, errors, F.col("detail")) for name, errors in checks.items() if not (quick and name in slow)])


def report_json(rows: DataFrame, date: str) -> DataFrame:
    """The report as one JSON document: a few rows, one for each check."""
    return rows.agg(F.to_json(F.struct(F.lit(date).alias("timestamp"), F.bool_and("passed").alias("overall_passed"), F.array_sort(F.collect_list(F.struct("check_name", "passed", "n_errors", "detail"))).alias("checks"))).alias("value"))
