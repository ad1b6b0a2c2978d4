"""Declarative data checks executed as Spark jobs.

Five check types with the usual semantics of schema tests; ``failures`` is:

* ``not_null``            rows where the column is null
* ``unique``              non-null values that occur more than once
* ``accepted_values``     distinct non-null values outside the list
* ``relationships``       non-null child rows whose key has no parent row
* ``unique_combination``  column combinations that occur more than once

All not_null / accepted_values checks of one table run in one aggregate (one
scan); each uniqueness check is a group-by with partial aggregation; the
relationship check is a left-anti join. The report is one DataFrame: the union
of all checks, with one row per check.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REPORT_COLUMNS = ["layer", "table_name", "column_name", "check_name", "failures", "status"]


@dataclass(frozen=True)
class Check:
    layer: str
    table: str
    kind: str
    columns: tuple[str, ...]
    values: tuple = field(default=())
    parent: tuple[str, str] | None = None

    @property
    def column(self) -> str:
        return ",".join(self.columns)


class DataQualityError(RuntimeError):
    pass


def not_null(layer, table, col) -> Check:
    return Check(layer, table, "not_null", (col,))


def unique(layer, table, col) -> Check:
    return Check(layer, table, "unique", (col,))


def accepted_values(layer, table, col, values: Sequence) -> Check:
    return Check(layer, table, "accepted_values", (col,), tuple(values))


def relationships(layer, table, col, parent_table, parent_col) -> Check:
    return Check(layer, table, "relationships", (col,), (), (parent_table, parent_col))


def unique_combination(layer, table, cols: Sequence[str]) -> Check:
    return Check(layer, table, "unique_combination", tuple(cols))


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _s(text) -> str:
    return "'" + str(text).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _v(value) -> str:
    return _s(value) if isinstance(value, str) else repr(value)


def _meta_sql(c: Check) -> str:
    return (f"'layer', {_s(c.layer)}, 'table_name', {_s(c.table)}, "
            f"'column_name', {_s(c.column)}, 'check_name', {_s(c.kind)}")


# Each part is built from a few SQL expression strings: the plan is the same as
# with Column objects, but a suite of checks costs tens of driver->JVM calls
# instead of thousands.

def _row_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    counts = []
    for i, c in enumerate(checks):
        col = _q(c.columns[0])
        if c.kind == "not_null":
            counts.append(f"count_if({col} IS NULL) AS f{i}")
        else:
            values = ", ".join(_v(v) for v in c.values)
            counts.append(f"count(DISTINCT CASE WHEN NOT ({col} IN ({values})) THEN {col} END) AS f{i}")
    rows = ", ".join(f"named_struct({_meta_sql(c)}, 'failures', CAST(f{i} AS BIGINT))"
                     for i, c in enumerate(checks))
    return df.selectExpr(*counts).selectExpr(f"inline(array({rows}))")


def _count_row(df: DataFrame, c: Check) -> DataFrame:
    """One report row: the number of rows of ``df`` as the check's failures."""
    return df.selectExpr(f"named_struct({_meta_sql(c)}, 'failures', CAST(count(1) AS BIGINT)) AS r") \
        .selectExpr("r.*")


def _duplicates(df: DataFrame, c: Check) -> DataFrame:
    base = df.selectExpr(*[_q(x) for x in c.columns])
    if c.kind == "unique":
        base = base.where(f"{_q(c.columns[0])} IS NOT NULL")
    return _count_row(base.groupBy(*c.columns).count().where("count > 1"), c)


def _orphans(child: DataFrame, parent: DataFrame, c: Check) -> DataFrame:
    _, pc = c.parent
    ch = child.selectExpr(f"{_q(c.columns[0])} AS __k").where("__k IS NOT NULL")
    pa = parent.selectExpr(f"{_q(pc)} AS __k")
    return _count_row(ch.join(pa, "__k", "left_anti"), c)


def run_checks(frames: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """One report row per check (lazy; one Spark job when collected or written)."""
    checks = list(checks)
    parts: list[DataFrame] = []
    row_level: dict[tuple[str, str], list[Check]] = defaultdict(list)
    for c in checks:
        if c.kind in ("not_null", "accepted_values"):
            row_level[(c.layer, c.table)].append(c)
    for (_, table), cs in row_level.items():
        parts.append(_row_checks(frames[table], cs))
    for c in checks:
        if c.kind in ("unique", "unique_combination"):
            parts.append(_duplicates(frames[c.table], c))
        elif c.kind == "relationships":
            parts.append(_orphans(frames[c.table], frames[c.parent[0]], c))
    # pairwise (balanced) unions: each union re-analyses its inputs, so a
    # left-deep chain would cost quadratic driver time in the number of parts
    while len(parts) > 1:
        parts = [parts[i].unionByName(parts[i + 1]) if i + 1 < len(parts) else parts[i]
                 for i in range(0, len(parts), 2)]
    return parts[0].selectExpr(
        "*", "CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status")


def assert_passed(report: DataFrame, layer: str | None = None) -> None:
    """Raise when any check (of ``layer``) failed; reads only the failing rows."""
    failing = report.where(F.col("failures") > 0)
    if layer is not None:
        failing = failing.where(F.col("layer") == layer)
    rows = failing.collect()  # at most one row per declared check
    if rows:
        detail = "; ".join(f"{r.table_name}.{r.column_name} {r.check_name}={r.failures}" for r in rows)
        raise DataQualityError(f"{len(rows)} failing checks: {detail}")
