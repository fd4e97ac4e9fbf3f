"""Apply reviewers' decisions, kept in a log, to a table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from returnsmith.operators.bitmaps import may_match, same_rows
from returnsmith.operators.lookup import key_match
from returnsmith.session import settle

ACTION = "lower(coalesce(record_action, ''))"
IS_PENDING = "NOT (status <=> 'DONE')"


def with_status(log: DataFrame) -> DataFrame:
    """A log nobody has worked on yet has no status: all its rows are pending."""
    return log if "status" in log.columns else log.selectExpr("*", "'PENDING' AS status")


def listed_keys(listed: DataFrame, keys: Sequence[str]) -> DataFrame:
    return listed.selectExpr(*[f"{k} AS _k_{k}" for k in keys])


def in_full(df: DataFrame, listed: DataFrame, keys: Sequence[str]) -> bool:
    """Whether the keys are all columns, of the same types on both sides: then hashes of them can be compared first."""
    return set(keys) == set(df.columns) and all(df.schema[k].dataType == listed.schema[k].dataType for k in keys)


def met_in_full(df: DataFrame, listed: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The rows that bitmaps tell are not listed, and the others with ``_listed``. A left join: Spark would move a semi or an anti
    join below the bitmaps, and shuffle all rows for it."""
    side, pairs = listed_keys(listed, keys), {k: f"_k_{k}" for k in keys}
    marked = may_match(df, keys, side, "_may")
    found = marked.where("_may").join(side.distinct().selectExpr("*", "true AS _hit"), F.expr(same_rows(pairs)), "left")
    return marked.where("NOT _may").drop("_may"), found.selectExpr(*df.columns, "_hit IS NOT NULL AS _listed")


def delete_listed(df: DataFrame, listed: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Rows whose key is not listed; missing keys meet missing keys.

    Where whole rows are compared, bitmaps of the listed ones' hashes tell which rows are not listed; these are not shuffled.
    """
    keys = list(df.columns if keys is None else keys)
    if not in_full(df, listed, keys):
        return df.join(listed_keys(listed, keys), F.expr(key_match({k: f"_k_{k}" for k in keys}, True)), "left_anti")
    clear, met = met_in_full(df, listed, keys)
    return clear.unionByName(met.where("NOT _listed").drop("_listed"))


def take_listed(df: DataFrame, listed: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """The rows that ``delete_listed`` leaves out."""
    keys = list(df.columns if keys is None else keys)
    if not in_full(df, listed, keys):
        return df.join(listed_keys(listed, keys).distinct(), F.expr(key_match({k: f"_k_{k}" for k in keys}, True)), "left_semi")
    return met_in_full(df, listed, keys)[1].where("_listed").drop("_listed")


def split_listed(df: DataFrame, listed: DataFrame, keys: Sequence[str] | None = None,
                 share: Callable[[DataFrame, str], DataFrame] = settle) -> tuple[DataFrame, DataFrame]:
    """What ``take_listed`` and ``delete_listed`` give, the latter written. Where whole rows are compared, both come from one comparison."""
    keys = list(df.columns if keys is None else keys)
    if not in_full(df, listed, keys):
        return share(take_listed(df, listed, keys), "removed"), share(delete_listed(df, listed, keys), "not_removed")
    clear, met = met_in_full(df, listed, keys)
    met = share(met, "met")
    left = clear.unionByName(met.where("NOT _listed").drop("_listed"))
    return met.where("_listed").drop("_listed"), share(left, "not_removed")


def mark_done(log: DataFrame) -> DataFrame:
    """The log, with the status of the rows that ``apply_actions`` acts on set to done."""
    handled = f"{IS_PENDING} AND {ACTION} IN ('delete', 'update', 'insert')"
    return log.withColumn("status", F.expr(f"CASE WHEN {handled} THEN 'DONE' ELSE status END"))


def apply_actions(df: DataFrame, log: DataFrame, keys: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Delete, replace and add rows as the pending log rows say, and mark those rows done.

    ``keys`` tell which rows a log row is about (default: all columns). An update removes its rows
    and adds the log row, so one anti join serves deletes and updates. Done rows are
    skipped: a second run changes nothing.
    """
    log = with_status(log)
    pending = log.where(IS_PENDING)
    kept = delete_listed(df, pending.where(f"{ACTION} IN ('delete', 'update')"), keys)
    added = pending.where(f"{ACTION} IN ('update', 'insert')").select(*df.columns)
    return kept.unionByName(added), mark_done(log)
