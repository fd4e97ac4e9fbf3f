"""Exact money arithmetic.

Amounts arrive as double. A double sum depends on the order of its terms, that is on
partitioning, retries and lost executors; reports summed that way change from run to
run. So each amount becomes DECIMAL(26,8) before it is summed, and sums are DECIMAL(36,8).
Decimal sums are exact, hence also associative: partial sums of partial sums give the same
figure, which is what lets the reports run on pre-aggregated cells. Figures turn back into
double, and are rounded, only at the edge of a report. An amount that does not fit (10^18 or
more, or not a number) is an error in ANSI mode and outside it; nothing becomes null on the way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = "decimal(26,8)"


def exact_amount(col: str) -> str:
    """An amount as exact decimal; one that does not fit fails the job in either ANSI mode."""
    return (f"CASE WHEN {col} IS NOT NULL THEN coalesce(try_cast({col} AS {MONEY}), "
            f"raise_error(concat('amount out of range: ', CAST({col} AS string)))) END")


def exact(df: DataFrame, *names: str) -> DataFrame:
    """Amount columns as exact decimals; columns that are decimal already (partial sums) stay."""
    raw = [n for n in names if not isinstance(df.schema[n].dataType, DecimalType)]
    return df.withColumns({n: F.expr(exact_amount(n)) for n in raw}) if raw else df


def amount(name: str) -> str:
    """An exact amount with a missing value as zero."""
    return f"coalesce({name}, 0)"


def total(col: str, when: str | None = None) -> str:
    """Sum over the group, over the rows where ``when`` holds; 0 if there are none."""
    return f"coalesce({total_or_null(col, when)}, 0)"


def total_or_null(col: str, when: str | None = None) -> str:
    """As ``total``, but null where no row of the group qualifies."""
    return f"sum({col})" if when is None else f"sum(CASE WHEN {when} THEN {col} END)"


def half_even(col: str, digits: int = 0) -> str:
    """Rounding to the even neighbour on ties."""
    return f"bround({col}, {digits})"


def figures(df: DataFrame, keys, **sums: str) -> DataFrame:
    """Grouped sums: ``name=expression`` per figure."""
    return df.groupBy(*keys).agg(*[F.expr(f"{expr} AS {name}") for name, expr in sums.items()])


def as_double(df: DataFrame) -> DataFrame:
    """The report edge: exact figures as double, other columns untouched."""
    return df.selectExpr(*[f"CAST({f.name} AS double) AS {f.name}" if isinstance(f.dataType, DecimalType) else f.name
                           for f in df.schema.fields])
