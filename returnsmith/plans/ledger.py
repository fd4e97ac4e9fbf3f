"""Ledger enrichment."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from returnsmith.functions import rules
from returnsmith.operators.lookup import apply_chain
from returnsmith.plans.chains import LEDGER_CHAIN


def enrich_ledger(df: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Chart of accounts, side, guarantee class, derivative account and signed amount."""
    return apply_chain(df, LEDGER_CHAIN, dims).selectExpr(
        *df.columns, "rv_coa", "coalesce(guarantee, '') AS g", "ale", "currency AS ccy",
        "coalesce(positive_code, negative_code) AS derivatives", f"{rules.SIGNED_LEDGER_AMOUNT} AS amount")
