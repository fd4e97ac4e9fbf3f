"""Checks that feed the review log."""

from __future__ import annotations

from pyspark.sql import DataFrame

from returnsmith.functions.nulls import not_zero, sum_present, text

# reasons as reviewers know them (fixed values)
NO_KEY = "NA key with non-zero rca"
BAD_VALUATION = "ERROR估值 with non-zero rca_mtm"
FALSE_FLAG = "False check flag found"
BOOK_MEASURES = ("rca_accrint", "rca_bookv", "rca_marketv", "rca_prov_coll", "rca_prov_indi")


def position_issues(df: DataFrame) -> DataFrame:
    """Positions without a sector although they carry amounts, and derivatives without a valuation
    account although they are valued. A row with both faults is listed twice; both checks are
    made in one pass over the positions."""
    no_key = f"(vis_sector IS NULL AND {sum_present(*BOOK_MEASURES)} <> 0)"
    bad_valuation = f"(valuation_code <=> 'ERROR' AND {not_zero('(rca_mtm_negative + rca_mtm_positive)')})"
    reasons = f"array(CASE WHEN {no_key} THEN {text(NO_KEY)} END, CASE WHEN {bad_valuation} THEN {text(BAD_VALUATION)} END)"
    return df.where(f"{no_key} OR {bad_valuation}").selectExpr(
        "*", f"explode(array_compact({reasons})) AS log_reason", "'' AS record_action")


def register_issues(df: DataFrame) -> DataFrame:
    """Register rows that differ from the period before."""
    return df.where("check_country = 'false' OR check_type = 'false'").selectExpr(
        "*", f"{text(FALSE_FLAG)} AS log_reason", "'' AS record_action")
