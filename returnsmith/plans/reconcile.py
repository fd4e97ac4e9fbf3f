"""Reconciliations: sub-ledger to ledger, off-balance, derivatives.

Positions are read once, into *cells*: exact sums per combination of account codes,
currency, key and risk country. There are few such combinations however many positions
there are, so all later steps run on small tables. Each cell keeps the lowest and
highest ``seq`` of its rows, which is all that first-wins and last-wins need; numeric buffers
only, hence a hash aggregate with map-side combine.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from returnsmith.functions.money import MONEY, as_double, exact, figures, half_even, total
from returnsmith.functions.nulls import all_present, one_of, sum_present, text, texts
from returnsmith.functions.rules import FEE_CODE
from returnsmith.operators.lookup import Lookup, apply_chain, inline_table, routed_lookup
from returnsmith.session import settle

LEDGER_KEYS = ("ap_code", "ap_name", "ccy", "coa", "ale")
# accounts whose ledger total moves onto another account (fixed values)
MOVED_CODES, MOVED_TO = ("7448", "8578"), "7271"
DIFF_LABELS = ("'0'", "'rt30 - mis'", "'rt30 + mis'")
GUARANTEE_CHECKS = (("G", "guarantees", "Guarantees Checking"), ("F", "commitments", "Credit commitments Checking"))

# derivative accounts by group (fixed values); groups 1, 3, 5 are the asset side
DERIVATIVE_GROUPS = {
    "1": ("7444", "7801", "7802"),
    "2": ("8576", "8801", "8802"),
    "3": ("7444", "7804", "7805"),
    "4": ("8576", "8804", "8805"),
    "5": ("7342", "7811", "7812", "7814", "7815", "7816", "7817", "7818", "7823", "7830", "7831", "7832",
          "7833", "7834", "7835", "7836"),
    "6": ("8342", "8811", "8812", "8814", "8815", "8816", "8817", "8818", "8823", "8830", "8831", "8832",
          "8833", "8834", "8835", "8836"),
}
# accounts that stand in two groups, told apart by product
PRODUCT_OF = {("1", "7444"): "6108", ("2", "8576"): "6108", ("3", "7444"): "6114", ("4", "8576"): "6114"}


# ---- cells ------------------------------------------------------------------------------------

CELL_KEYS = ("deal_code", "interest_code", "valuation_code", "currency", "key", "risk_in")
CELL_SUMS = {
    "book_a": total("rca_bookv", "ale = 'A'"), "book_l": total("rca_bookv", "ale = 'L'"),
    "fee": total("rca_deferred_fee"), "fee_a": total("rca_deferred_fee", "ale = 'A'"),
    "fee_l": total("rca_deferred_fee", "ale = 'L'"), "accr": total("rca_accrint"),
    "accr_a": total("rca_accrint", "ale = 'A'"), "accr_l": total("rca_accrint", "ale = 'L'"),
    "mtm": f"{total('rca_mtm_negative')} + {total('rca_mtm_positive')}",
}
CELL_ROWS = "cell_rows"
# which role of an account each sum belongs to; deferred fees all belong to the fee account
ROLE_SUMS = {"deal": ("book_a", "book_l", "fee_a", "fee_l"), "interest": ("accr", "accr_a", "accr_l"),
             "valuation": ("mtm",), "fee": ("fee",)}
ROLE_CODES = {"deal": "deal_code", "interest": "interest_code", "valuation": "valuation_code", "fee": text(FEE_CODE)}


def position_cells(positions: DataFrame) -> DataFrame:
    """One pass over the positions: sums by account codes, currency, key and risk country."""
    rows = exact(positions, "rca_bookv", "rca_accrint", "rca_deferred_fee", "rca_mtm_negative", "rca_mtm_positive")
    return figures(rows, CELL_KEYS, **CELL_SUMS, seq_first="min(seq)", seq_last="max(seq)", **{CELL_ROWS: "count(*)"})


def account_cells(positions: DataFrame) -> DataFrame:
    """The same sums without key and risk country: what the account measures alone need of the positions."""
    rows = exact(positions, "rca_bookv", "rca_accrint", "rca_deferred_fee", "rca_mtm_negative", "rca_mtm_positive")
    return figures(rows, [k for k in CELL_KEYS if k not in ("key", "risk_in")], **CELL_SUMS)


def valuation_cells(positions: DataFrame) -> DataFrame:
    """Valuation amounts by valuation account: what the derivatives check needs of the positions."""
    rows = exact(positions, "rca_mtm_negative", "rca_mtm_positive")
    return figures(rows, ["valuation_code"], mtm=CELL_SUMS["mtm"])


def _roles(*roles: str, code: str = "{}") -> str:
    return "inline(array(" + ", ".join(
        f"struct({text(r)} AS role, {code.format(ROLE_CODES[r])} AS code)" for r in roles) + "))"


def account_measures(cells: DataFrame) -> DataFrame:
    """Position sums by account and currency, for the account in each of its roles: of the deal,
    of its interest, of its valuation, of fees. Rows without the code or the currency belong to no
    ledger account."""
    rows = cells.selectExpr("currency", *CELL_SUMS, _roles(*ROLE_CODES)).where(all_present("currency", "code"))
    return figures(rows, ("code", "currency"), **{
        name: total(name, f"role = {text(role)}") for role, names in ROLE_SUMS.items() for name in names})


def account_owners(cells: DataFrame) -> DataFrame:
    """Key of the first and risk country of the last position of an account and currency, by role.
    Missing codes and currencies are 'NA' here; equal ``seq`` are told apart by value."""
    rows = cells.selectExpr("coalesce(currency, 'NA') AS currency", "key", "risk_in", "seq_first", "seq_last",
                            _roles("deal", "interest", code="coalesce({}, 'NA')"))
    return figures(rows, ("role", "code", "currency"), first_key="min(struct(seq_first, key)).key",
                   last_risk_in="max(struct(seq_last, risk_in)).risk_in")


# ---- sub-ledger to ledger ---------------------------------------------------------------------

def ledger_pivot(ledger: DataFrame) -> DataFrame:
    """Ledger totals by account; rows without account name or chart code form groups of their own."""
    rows = exact(ledger.where("ale IN ('A', 'L') AND derivatives IS NULL"), "aud_equivalent")
    totals = figures(rows.withColumnRenamed("rv_coa", "coa"), LEDGER_KEYS, total=total("aud_equivalent"))
    return totals.selectExpr("*", "CASE ale WHEN 'A' THEN 'L' WHEN 'L' THEN 'A' END AS ale_opposite")


def add_adjustment(pivot: DataFrame) -> DataFrame:
    """Ledger total of the moved accounts, per currency, on the account they move to."""
    moved = pivot.where(f"ap_code IN ({texts(MOVED_CODES)}) AND ccy IS NOT NULL")
    moved = figures(moved.withColumnRenamed("ccy", "_ccy"), ("_ccy",), _moved=total("total"))
    return pivot.join(moved, F.expr("ccy = _ccy"), "left").selectExpr(
        *pivot.columns, f"CASE WHEN ap_code = '{MOVED_TO}' THEN _moved ELSE 0 END AS adjustment")


def add_measures(pivot: DataFrame, measures: DataFrame) -> DataFrame:
    """Book value of the own side less the opposite one (plus, for fees), interest, fees, valuation,
    and what stands on the opposite side."""
    sums = [n for n in measures.columns if n not in ("code", "currency")]
    side = measures.selectExpr("code AS _code", "currency AS _ccy", *[f"{n} AS _{n}" for n in sums])
    joined = pivot.join(side, F.expr("ap_code = _code AND ccy = _ccy"), "left")
    sign = f"CASE WHEN ap_code = '{FEE_CODE}' THEN 1 ELSE -1 END"
    own, other = (f"CASE WHEN ale = 'A' THEN coalesce(_book_{x}, 0) ELSE coalesce(_book_{y}, 0) END" for x, y in ("al", "la"))
    impact = (f"CASE WHEN ale_opposite = 'A' THEN {sum_present('_book_a', '_fee_a', '_accr_a')} "
              f"ELSE {sum_present('_book_l', '_fee_l', '_accr_l')} END")
    return joined.selectExpr(
        *pivot.columns, f"{own} + ({sign}) * ({other}) AS rca_bookv", "coalesce(_accr, 0) AS rca_accrint",
        f"CASE WHEN ap_code = '{FEE_CODE}' THEN coalesce(_fee, 0) ELSE 0 END AS rca_deferred_fee",
        "coalesce(_mtm, 0) AS rca_mtm", f"{impact} AS impact_a", f"{impact} AS impact_l")


def add_diff(rec: DataFrame) -> DataFrame:
    """Sub-ledger total against ledger total; assets are negative in the ledger."""
    is_debt = f"(ap_code <=> '{FEE_CODE}' OR coalesce(startswith(coa, 'BLS-LIA'), false))"

    def by_class(moved: str, debt: str, asset: str) -> str:
        return (f"CASE WHEN {one_of('ap_code', MOVED_CODES)} THEN {moved} WHEN {is_debt} THEN {debt} "
                f"WHEN startswith(coa, 'BLS-AST') THEN {asset} END")

    parts = sum_present("rca_bookv", "rca_accrint", "rca_deferred_fee", "rca_mtm", "adjustment")
    diff = by_class("0", "rt30_total - total", "rt30_total + total")
    return rec.selectExpr("*", f"{parts} AS rt30_total", f"{half_even(diff, 1)} AS diff",
                          f"{by_class(*DIFF_LABELS)} AS diff_desc")


def _routes(interest: str, moved: str, fixed: str, chain: tuple[str, ...]) -> str:
    """Which accounts to ask for an owner, by ledger account, most wanted first."""
    def ask(*steps: tuple[str, str]) -> str:
        return "array(" + ", ".join(f"struct({text(role)} AS role, {code} AS code, ccy AS currency)"
                                    for role, code in steps) + ")"

    return (f"CASE WHEN ap_code = '7451' THEN {ask(('interest', text(interest)))} "
            f"WHEN ap_code IN ({texts(MOVED_CODES)}) THEN {ask(('deal', text(moved)))} "
            f"WHEN ap_code = '8451' THEN {ask(('deal', text(fixed)))} "
            f"WHEN ap_code = '8453' THEN {ask(*[('deal', text(code)) for code in chain])} "
            f"ELSE {ask(('deal', 'ap_code'), ('interest', 'ap_code'))} END")


OWNER = ("role", "code", "currency")
SECTOR_ROUTES = _routes("7431", "7271", "7121", ("7217", "7216", "7211"))
COUNTRY_ROUTES = _routes("7431", "7211", "7121", ("7211", "7216"))


def add_owner(rec: DataFrame, owners: DataFrame) -> DataFrame:
    """Key, country and risk country of the account, from the positions booked on it."""
    rec = routed_lookup(rec, SECTOR_ROUTES, owners, OWNER, "first_key", "key")
    rec = rec.selectExpr("*", "right(key, 2) AS vis_country")
    return routed_lookup(rec, COUNTRY_ROUTES, owners, OWNER, "last_risk_in", "risk_in")


def reconcile(ledger: DataFrame, cells: DataFrame) -> DataFrame:
    """Sub-ledger to ledger, in exact figures: what the reports build on."""
    pivot = add_adjustment(ledger_pivot(ledger))
    return add_owner(add_diff(add_measures(pivot, account_measures(cells))), account_owners(cells))


def gl_reconciliation(ledger: DataFrame, positions: DataFrame) -> DataFrame:
    """Sub-ledger to ledger as a report. The cells serve sums and owners, so they are settled first."""
    return as_double(reconcile(ledger, settle(position_cells(positions), "cells")))


def gl_breaks(rec: DataFrame) -> DataFrame:
    """Accounts that do not reconcile; an account without a difference rule is one of them."""
    return rec.where(f"NOT ({half_even('diff')} <=> 0)")


# ---- off-balance ------------------------------------------------------------------------------

def off_balance_check(ledger: DataFrame, facility: DataFrame, part_e: DataFrame) -> DataFrame:
    """Per guarantee class: ledger against facilities by currency, then the ledger total, the total
    of the country report, and their sum. Only currency lines meet a facility figure."""
    kinds = texts(g for g, _, _ in GUARANTEE_CHECKS)
    booked = exact(ledger.where(f"g IN ({kinds}) AND ccy IS NOT NULL").withColumnRenamed("g", "guarantee"), "aud_equivalent")
    booked = figures(booked, ("guarantee", "ccy"), ledger_sum=total("aud_equivalent"))
    granted = exact(facility.where(f"guarantee IN ({kinds})"), "obs_amount").withColumnsRenamed(
        {"guarantee": "_g", "currency": "_ccy"})
    granted = figures(granted, ("_g", "_ccy"), facility=total("obs_amount"))
    # class totals of the ledger and of the report; the latter has a line for every class
    reported = exact(part_e, "guarantees", "commitments").agg(
        *[F.expr(f"{half_even(total(measure), 1)} AS {measure}") for _, measure, _ in GUARANTEE_CHECKS])
    reported = reported.selectExpr("inline(array(" + ", ".join(
        f"struct({text(g)} AS guarantee, {measure} AS reported)" for g, measure, _ in GUARANTEE_CHECKS) + "))")
    sums = booked.unionByName(reported, allowMissingColumns=True)
    sums = figures(sums, ("guarantee",), booked=half_even(total("ledger_sum"), 1), reported=total("reported"))
    label = "CASE guarantee " + " ".join(f"WHEN {text(g)} THEN {text(name)}" for g, _, name in GUARANTEE_CHECKS) + " END"
    totals = sums.selectExpr("guarantee", f"""inline(array(
        struct(2 AS line, 'Grand Total' AS ccy, booked AS ledger_sum), struct(3 AS line, '731.3B' AS ccy, reported AS ledger_sum),
        struct(4 AS line, {label} AS ccy, booked + reported AS ledger_sum)))""")
    by_ccy = booked.selectExpr("guarantee", "1 AS line", "ccy", "ledger_sum")
    joined = by_ccy.unionByName(totals).join(granted, F.expr("guarantee = _g AND ccy = _ccy"), "left")
    return joined.selectExpr("guarantee", "line", "ccy", "ledger_sum", "facility", "ledger_sum + facility AS diff")


# ---- derivatives ------------------------------------------------------------------------------

def derivative_accounts(spark: SparkSession) -> DataFrame:
    """The accounts to check, with their product where one account stands in two groups."""
    rows = [(group, i, code, PRODUCT_OF.get((group, code)))
            for group, codes in DERIVATIVE_GROUPS.items() for i, code in enumerate(codes, 1)]
    return inline_table(spark, "group line code product", rows)


def derivatives_check(cells: DataFrame, ledger: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Valuation of the positions against the ledger by account, with a total line per group."""
    named = Lookup("account", {"code": "ap_code"}, {"suffix_name": "name"})
    accounts = apply_chain(derivative_accounts(ledger.sparkSession), [named], dims)
    valued = figures(cells.where("valuation_code IS NOT NULL"), ("valuation_code",), rca_mtm=half_even(total("mtm"), 1))
    codes = texts(sorted({code for group in DERIVATIVE_GROUPS.values() for code in group}))
    booked = exact(ledger.where(f"ap_code IN ({codes}) AND prod_code IS NOT NULL"), "aud_equivalent")
    booked = figures(booked, ("ap_code", "prod_code"), booked=total("aud_equivalent"))
    joined = (accounts.join(valued, F.expr("code = valuation_code"), "left")
              .join(booked, F.expr("code = ap_code AND (product IS NULL OR product = prod_code)"), "left"))
    lines = figures(joined, ("`group`", "line", "code", "name", "rca_mtm"), dm010=half_even(total("booked"), 1))
    sign = "CASE WHEN `group` IN ('1', '3', '5') THEN 1 ELSE -1 END"
    lines = lines.selectExpr("*", f"coalesce(rca_mtm, 0) + ({sign}) * dm010 AS diff")
    totals = figures(lines, ("`group`",), diff=total("diff")).selectExpr(
        "`group`", "99 AS line", "'TOTAL' AS code", "CAST(NULL AS string) AS name", f"CAST(NULL AS {MONEY}) AS rca_mtm",
        f"CAST(NULL AS {MONEY}) AS dm010", "diff")
    return lines.unionByName(totals)
