"""Facility enrichment: guarantee class and risk country."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from returnsmith.functions import rules
from returnsmith.operators.lookup import apply_chain
from returnsmith.plans.chains import FACILITY_CHAIN


def enrich_facility(df: DataFrame, register: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """``register`` is the computed register, asked by customer like any other lookup table."""
    coded = df.selectExpr("*", f"{rules.account_tail('deal_type')} AS ap_code")
    return apply_chain(coded, FACILITY_CHAIN, {**dims, "register": register}).selectExpr(
        *coded.columns, "coalesce(guarantee_found, '') AS guarantee", f"{rules.FACILITY_COUNTRY} AS risk_country")
