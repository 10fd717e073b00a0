"""Row changes as DataFrame transformations: update, delete, merge. A table that keeps versions applies them to its files."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MATCHED, NOT_MATCHED_BY_TARGET, NOT_MATCHED_BY_SOURCE = "matched", "not matched by target", "not matched by source"


def _condition(condition: Column | str | None) -> Column:
    return F.lit(True) if condition is None else F.expr(condition) if isinstance(condition, str) else condition


def update(table: DataFrame, assignments: dict[str, Column | str], condition: Column | str | None = None) -> DataFrame:
    """table with the assigned columns changed where condition is true; all assignments see the old values."""
    if unknown := set(assignments) - set(table.columns):
        raise ValueError(f"no such column: {', '.join(sorted(unknown))}; nested fields cannot be assigned")
    hit = _condition(condition)
    value = lambda c: F.expr(assignments[c]) if isinstance(assignments[c], str) else assignments[c]
    return table.select(*[F.when(hit, value(c)).otherwise(F.col(c)).cast(table.schema[c].dataType).alias(c) if c in assignments else F.col(c) for c in table.columns])


def delete(table: DataFrame, condition: Column | str | None = None) -> DataFrame:
    """table without the rows for which condition is true; rows for which it is null stay."""
    return table.filter(~F.coalesce(_condition(condition), F.lit(False)))


@dataclass
class When:
    """A merge clause. action: update, delete, insert, nothing or error; assignments read t.<column> and s.<column>."""

    kind: str
    action: str
    condition: Column | str | None = None
    assignments: dict[str, Column | str] = field(default_factory=dict)
    message: str = ""


def merge_rows(target: DataFrame, source: DataFrame, on: str, clauses: list[When], row_id: str, source_order: list[str]) -> DataFrame:
    """All rows after a merge, with merge_action (UPDATE, INSERT, DELETE or null for rows left alone); deleted rows are listed
    with their old values.

    Clauses are tried in order; the first that fits a row's kind and condition has it. A target row that several source rows
    match takes the first of the changes by source_order. row_id: a column of target that names its rows. Columns of either side
    may have any other names than merge_action and those that begin with "_merge ".
    """
    t = target.withColumn("_merge target", F.lit(1)).alias("t")
    s = source.withColumn("_merge source", F.lit(1)).alias("s")
    joined = t.join(s, F.expr(on), "full_outer")
    in_t, in_s = F.col("_merge target").isNotNull(), F.col("_merge source").isNotNull()
    kinds = {MATCHED: in_t & in_s, NOT_MATCHED_BY_TARGET: ~in_t & in_s, NOT_MATCHED_BY_SOURCE: in_t & ~in_s}
    chosen = F.lit(-1)
    for i, c in reversed(list(enumerate(clauses))):
        fits = kinds[c.kind] & F.coalesce(_condition(c.condition), F.lit(False))
        number = F.lit(i) if c.action != "error" else F.raise_error(F.lit(f"merge error condition when {c.kind}: {c.message}")).cast("int")
        chosen = F.when(fits, number).otherwise(chosen)
    joined = joined.withColumn("_merge clause", chosen)
    acts = {i: c.action for i, c in enumerate(clauses)}
    action = F.create_map(*[x for i, a in acts.items() for x in (F.lit(i), F.lit(a.upper() if a in ("update", "insert", "delete") else None))])[F.col("_merge clause")]
    joined = joined.withColumn("merge_action", action)

    def column(name: str) -> Column:
        value = F.col(f"t.{name}")
        for i, c in enumerate(clauses):
            if c.action == "update" and name in c.assignments or c.action == "insert":
                new = c.assignments.get(name)
                new = F.lit(None) if new is None else F.expr(new) if isinstance(new, str) else new
                value = F.when(F.col("_merge clause") == i, new).otherwise(value)
        return value.cast(target.schema[name].dataType).alias(name)

    out = [*[column(c) for c in target.columns], "merge_action"]
    inserted = joined.filter(~in_t & (F.col("merge_action") == "INSERT")).select(*out)
    first = Window.partitionBy(f"t.{row_id}").orderBy(F.col("merge_action").isNull(), *[F.col(f"s.{c}") for c in source_order])
    kept = joined.filter(in_t).withColumn("_merge place", F.row_number().over(first)).filter(F.col("_merge place") == 1).select(*out)
    return kept.unionByName(inserted)


def merge(target: DataFrame, source: DataFrame, on: str, clauses: list[When], row_id: str, source_order: list[str]) -> DataFrame:
    """The table after the merge."""
    return merge_rows(target, source, on, clauses, row_id, source_order).filter("merge_action is null or merge_action <> 'DELETE'").drop("merge_action")
