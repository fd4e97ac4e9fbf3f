"""Position enrichment: return line, key, account codes, maturity and risk bearer."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from returnsmith.functions import rules
from returnsmith.operators.lookup import apply_chain, chosen_lookup
from returnsmith.plans.chains import ACCOUNT_CHAIN, POSITION_CHAIN
from returnsmith.session import in_two_methods

Dims = Mapping[str, DataFrame]

# derived columns in dependency order: a rule may read the ones above it
ROW_RULES = {
    "category": rules.CATEGORY,
    "vis_country": rules.COUNTERPARTY_COUNTRY,
    "vis_sector": rules.COUNTERPARTY_SECTOR,
    "key": rules.KEY,
    "source_class": rules.SOURCE_CLASS,
    "deal_code": rules.DEAL_CODE,
    "nationality_derived": rules.NATIONALITY,
}
ACCOUNT_RULES = {
    "interest_code": rules.INTEREST_CODE,
    "valuation_code": rules.VALUATION_CODE,
    "rv_mat_remaining_derived": rules.REMAINING_MATURITY,
}
RISK_RULES = {
    "risk_in": rules.RISK_COUNTRY,
    "risk_transfer": rules.RISK_TRANSFER,
    "risk_in_sector": rules.RISK_SECTOR,
}


def add_rules(df: DataFrame, derived: Mapping[str, str], *names: str) -> DataFrame:
    """Derived columns (all, or the named ones), each of which may read those before it."""
    return df.selectExpr("*", *[f"{derived[n]} AS {n}" for n in (names or derived)])


def _made_by(*chains) -> list[str]:
    return [n for chain in chains for step in chain for n in (*step.values.values(), step.flag) if n]


def map_positions(df: DataFrame, dims: Dims) -> DataFrame:
    return apply_chain(df, POSITION_CHAIN, dims)


MAPPED = ("ale", "report_ccy")
# row rules that ask no lookup's helper columns: after a shuffle they are made again from what the rows hold, so they aren't shuffled
LATE_RULES = ("vis_country", "key", "nationality_derived")


def code_positions(df: DataFrame, dims: Dims, *names: str) -> DataFrame:
    """The first half of the enrichment: lookups of the raw columns and the row rules (all, or the named ones), up to the account code."""
    helpers = set(_made_by(POSITION_CHAIN)) - set(MAPPED)
    return add_rules(map_positions(df, dims), ROW_RULES, *names).drop(*helpers)


def add_accounts(coded: DataFrame, dims: Dims) -> DataFrame:
    """The second half: what goes by the account code."""
    return add_rules(apply_chain(coded, ACCOUNT_CHAIN, dims), ACCOUNT_RULES).drop(*_made_by(ACCOUNT_CHAIN))


def enrich_positions(df: DataFrame, dims: Dims) -> DataFrame:
    """Everything that needs no register: lookups, row rules, lookups by the derived account code. Each half is a generated method of its own."""
    return add_accounts(in_two_methods(code_positions(df, dims)), dims)


def enrich_with_risk(df: DataFrame, dims: Dims, register: DataFrame) -> DataFrame:
    """Raw positions enriched, and their risk added (``enrich_positions``, then ``add_risk``).

    The register is asked between the two halves of the enrichment: its join parts the work into two generated methods, either of
    which the JVM compiles. In one they pass 8000 bytes of bytecode and are interpreted, at some four times the time. The
    rows are shuffled before they have the columns of the second half and those of ``LATE_RULES``.
    """
    found, helpers = _registered(code_positions(df, dims, *[n for n in ROW_RULES if n not in LATE_RULES]), register)
    risky = add_rules(add_accounts(add_rules(found, ROW_RULES, *LATE_RULES), dims), RISK_RULES).drop(*helpers)
    return risky.select(*df.columns, *MAPPED, *ROW_RULES, *ACCOUNT_RULES, *RISK_RULES)


def _registered(df: DataFrame, register: DataFrame) -> tuple[DataFrame, tuple[str, ...]]:
    """The rows with what the register says of them, and the names of those columns."""
    found = chosen_lookup(df, register, rules.IS_FEE, "customer_nr", "ide_linkage_ref", {"this_country": "registered"},
                          {"this_country": "registered", "this_type": "type_by_ref"}, "listed")
    return found, ("registered", "type_by_ref", "listed")


def add_risk(df: DataFrame, register: DataFrame) -> DataFrame:
    """Ultimate risk country, transfer flag and risk sector.

    Fee rows ask the register by customer, all others by reference; the risk sector always goes by
    reference. Every row is joined once, by the key that it chooses; the distinct keys of the fee rows are read by themselves.
    """
    found, helpers = _registered(df, register)
    return add_rules(found, RISK_RULES).drop(*helpers)
