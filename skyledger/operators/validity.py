"""Telling usable rows from unusable ones, by named checks.

Checks are SQL predicates that hold for unusable rows, in the order in which they give the reason.
Usable rows are filtered by the plain predicates, which Spark can push down to the scan one by one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "reject_reason"
RAISED = "unusable row: "

Checks = Mapping[str, str]


class UnusableRowError(ValueError):
    """An input has a row that its checks do not let pass."""


def reason(checks: Checks) -> Column:
    """Name of the first check that holds for a row, null if the row is usable."""
    return F.coalesce(*[F.when(F.expr(check), F.lit(name)) for name, check in checks.items()])


def accepted(rows: DataFrame, checks: Checks) -> DataFrame:
    for check in checks.values():
        rows = rows.filter(f"NOT ({check})")
    return rows


def rejected(rows: DataFrame, checks: Checks) -> DataFrame:
    return rows.withColumn(REASON, reason(checks)).filter(F.col(REASON).isNotNull())


def guarded(rows: DataFrame, checks: Checks) -> DataFrame:
    """The rows, of which an unusable one fails the job that reads them.

    Part of the plan, so the input is read once. The condition counts as not deterministic, so that no filter behind it,
    such as ``accepted``, is pushed past it and drops an unusable row unseen.
    """
    usable = F.when(reason(checks).isNull(), F.monotonically_increasing_id() >= 0).otherwise(
        F.raise_error(F.concat(F.lit(RAISED), reason(checks))).cast("boolean")
    )
    return rows.filter(usable)


@contextmanager
def raising_unusable() -> Iterator[None]:
    """Turns the failure of a job at an unusable row into ``UnusableRowError``."""
    try:
        yield
    except PySparkException as error:
        found = re.search(f"{RAISED}(\\w+)", str(error))
        if not found:
            raise
        raise UnusableRowError(found[0]) from error
