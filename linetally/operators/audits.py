"""Audits of what the declared tables promise: keys, references, required values, domains."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linetally.sources.schemas import Reference, Table


def _stack(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def key_violations(rows: DataFrame, table: str, key: tuple[str, ...]) -> DataFrame:
    """Key values that occur more than once or contain a null: (table_name, key, n).

    The key is shown as JSON, where a null and a text, or two texts and one with a separator,
    differ.
    """
    shown = F.to_json(F.struct(*key), {"ignoreNullFields": "false"})
    has_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in key])
    return (
        rows.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("n"))
        .where((F.col("n") > 1) | has_null)
        .select(F.lit(table).alias("table_name"), shown.alias("key"), "n")
    )


def pk_violations(tables: dict[str, DataFrame], declared: Iterable[Table]) -> DataFrame:
    return _stack(key_violations(tables[t.name], t.name, t.key) for t in declared)


def orphans(
    child: DataFrame, child_name: str, references: Iterable[Reference], parents: dict[str, DataFrame]
) -> DataFrame:
    """One row (child, column_name, n) per reference: rows whose non-null value has no parent.

    The child is read once for all its references, and counted per value before the join, so
    a value that most rows share arrives as one row per map task.
    """
    references = list(references)
    columns = [reference.column for reference in references]
    value = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("ref")) for c in columns])
    )
    used = (
        child.select(value.alias("v"))
        .select("v.*")
        .where("ref is not null")
        .groupBy("column_name", "ref")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    known = _stack(
        parents[r.parent].select(
            F.lit(r.column).alias("column_name"), F.col(r.parent_column).cast("string").alias("ref")
        )
        for r in references
    )
    lost = used.join(known, ["column_name", "ref"], "left_anti").groupBy("column_name").agg(F.sum("n").alias("n"))
    names = child.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, columns))).alias("column_name"))
    return names.join(lost, "column_name", "left").select(
        F.lit(child_name).alias("child"), "column_name", F.coalesce("n", F.lit(0).cast("bigint")).alias("n")
    )


def fk_orphans(tables: dict[str, DataFrame], declared: Iterable[Table]) -> DataFrame:
    return _stack(orphans(tables[t.name], t.name, t.references, tables) for t in declared if t.references)


def null_counts(rows: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """One row (table_name, column_name, n) per column, from one pass over the rows."""
    counts = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "n").select(
        F.lit(table).alias("table_name"), "column_name", "n"
    )


def not_null_violations(tables: dict[str, DataFrame], declared: Iterable[Table]) -> DataFrame:
    return _stack(null_counts(tables[t.name], t.name, t.required) for t in declared)


def domain_violations(
    rows: DataFrame, table: str, column: str, allowed: tuple[str, ...]
) -> DataFrame:
    """Values outside the domain with their row count: (table_name, column_name, value, n).

    A null passes, as in a CHECK; a required column reports it as a null violation.
    """
    return (
        rows.where(~F.col(column).isin(*allowed))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "value", "n")
    )


def state_domain_violations(tables: dict[str, DataFrame], declared: Iterable[Table]) -> DataFrame:
    return _stack(
        domain_violations(tables[t.name], t.name, column, allowed)
        for t in declared
        for column, allowed in t.domains.items()
    )


def all_audits(tables: dict[str, DataFrame], declared: Iterable[Table]) -> dict[str, DataFrame]:
    """Audit name to DataFrame; rows with a positive n are violations."""
    declared = list(declared)
    return {
        "pk_violations": pk_violations(tables, declared),
        "fk_orphans": fk_orphans(tables, declared),
        "not_null_violations": not_null_violations(tables, declared),
        "state_domain_violations": state_domain_violations(tables, declared),
    }
