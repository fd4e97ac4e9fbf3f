"""The extraction layer: warehouse tables at a reporting date become positions, facilities and ledger.

``tables`` maps the names used here to DataFrames (parquet, catalog or JDBC alike). The
transaction kinds are aligned and stacked first, then joined to customers once; likewise
both position kinds go through one join to the transactions. Dates are predicates on stored
columns, so they reach the scans, and prune partitions where a table is stored by date.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from returnsmith.functions.nulls import text, texts
from returnsmith.functions.rules import FEE_CODE, account_tail
from returnsmith.schemas import POSITIONS

Tables = Mapping[str, DataFrame]

# fixed values of the source systems
FOREVER = "DATE '9999-12-31'"
MTM_TYPES = ("ORI MTM_POSITIVE", "ORI MTM_NEGATIVE")
FEE_VALUATION = "DEFERRED_FEE"
COMMITMENT_VALUATION = "OBS Commitment"
FEE_SOURCE = "FASM"
POSITION_LINKS = ("1", "2", "3", "5", "6", "8", "9", "10", "11")
FEE_LINK = "12"
OWN_SYSTEM = "022"
EXCLUDED_LEDGER_SOURCES = ("777",)
CUSTOMER = ("nationality", "domicile", "customer_legal_name")
DEAL = ("entity", "deal_id", "customer_nr", "deal_type", "currency", "tfi_id", "source_table",
        "value_date", "maturity_date", "source_system")


def shaped(df: DataFrame, columns: Sequence[str], **derived: str) -> DataFrame:
    """``columns`` in order, each as it is or by its expression in ``derived``."""
    return df.selectExpr(*[f"{derived[n]} AS {n}" if n in derived else n for n in columns])


def _left(df: DataFrame, right: DataFrame, match: str) -> DataFrame:
    return df.join(right, F.expr(match), "left")


def _where_entity(df: DataFrame, entity: str | None) -> DataFrame:
    return df if entity is None else df.where(f"entity = {text(entity)}")


def valid_at(df: DataFrame, as_of: date | str, start: str = "start_validity_date",
             end: str = "end_validity_date", entity: str | None = None) -> DataFrame:
    """Row versions in force on a day, both ends included."""
    return _where_entity(df.where(f"{start} <= DATE '{as_of}' AND {end} >= DATE '{as_of}'"), entity)


def snapshot(df: DataFrame, as_of: date | str, date_col: str, types: Sequence[str] | None = None,
             entity: str | None = None) -> DataFrame:
    """Rows of one day, of the given valuation types."""
    kind = "" if types is None else f" AND valuation_type IN ({texts(types)})"
    return _where_entity(df.where(f"{date_col} = DATE '{as_of}'{kind}"), entity)


def with_customer(df: DataFrame, customers: DataFrame, attributes: Sequence[str] = CUSTOMER) -> DataFrame:
    """Attributes of the customer version in force; rows without a customer stay."""
    side = customers.selectExpr("customer_nr AS _customer", *attributes)
    return _left(df, side, "customer_nr = _customer").drop("_customer")


def _instrument(df: DataFrame, master: DataFrame) -> DataFrame:
    """Deals with the maturity of their instrument."""
    return _left(df.drop("maturity_date"), master.selectExpr("tfi_id AS _tfi", "maturity_date"), "tfi_id = _tfi")


def _valued(df: DataFrame, valuations: DataFrame) -> DataFrame:
    """Derivative deals in the currency of their valuation, once per valuation; 'NA' without one."""
    side = valuations.selectExpr("deal_id AS _deal", "currency AS _currency", "valuation_type AS _type")
    joined = _left(df.drop("currency"), side, "deal_id = _deal")
    return joined.selectExpr("*", f"CASE WHEN _type IN ({texts(MTM_TYPES)}) THEN _currency ELSE 'NA' END AS currency")


def transactions(tables: Tables, as_of: date | str, entity: str) -> DataFrame:
    """The seven transaction kinds in force, one shape, with their customer."""
    def deals(name: str) -> DataFrame:
        return valid_at(tables[name], as_of, entity=entity)

    def valuations(name: str, **more) -> DataFrame:
        return snapshot(tables[name], as_of, "valuation_date", MTM_TYPES, **more)

    def kind(df: DataFrame, name: str, **derived: str) -> DataFrame:
        return shaped(df, DEAL, **{"tfi_id": "CAST(NULL AS string)", "source_table": text(name), **derived})

    own = {"source_system": text(OWN_SYSTEM)}
    bonds = valid_at(tables["bond"], as_of).where(f"object_origin = {text(entity)}")
    options = _valued(deals("option_deal"), valuations("option_valuation", entity=entity))
    stacked = [
        kind(deals("interest_account"), "iba"),
        kind(deals("loan"), "loan"),
        kind(_instrument(deals("bond_deal"), bonds), "bond", tfi_id="tfi_id", **own),
        kind(_valued(deals("forex"), valuations("forex_valuation")), "forex", **own),
        kind(_instrument(options, valid_at(tables["option"], as_of)), "option", **own),
        kind(_valued(deals("swap"), valuations("swap_valuation", entity=entity)), "swap", **own),
        kind(snapshot(tables["back_office_balance"], as_of, "balance_date", entity=entity), "back_office",
             deal_type="element6", value_date=FOREVER, maturity_date=FOREVER, source_system="'backoffice'"),
    ]
    return with_customer(reduce(DataFrame.unionByName, stacked), valid_at(tables["customer"], as_of))


def _as_positions(df: DataFrame, **derived: str) -> DataFrame:
    return df.selectExpr(*[f"CAST({derived.get(f.name, f.name)} AS {f.dataType.simpleString()}) AS {f.name}"
                           for f in POSITIONS.fields])


def fee_positions(tables: Tables, as_of: date | str, entity: str, lot_type: int) -> DataFrame:
    """Fee deals shaped as position rows: deferred amount only, everything else zero."""
    fees = valid_at(tables["fee"], as_of, entity=entity).where(f"source_system = '{FEE_SOURCE}'")
    amounts = snapshot(tables["fee_valuation"], as_of, "valuation_date", [FEE_VALUATION])
    amounts = amounts.selectExpr("deal_id AS _deal", "amount AS _amount", "true AS _valued")
    customers = valid_at(tables["customer"], as_of)
    joined = with_customer(_left(fees, amounts, "deal_id = _deal"), customers,
                           (*CUSTOMER, "customer_attribute1", "intercompany"))
    zeros = dict.fromkeys(("rca_accrint", "rca_bookv", "rca_marketv", "rca_prov_coll", "rca_prov_indi", "rv_mat_original",
                           "rv_mat_remaining", "rca_mtm_negative", "rca_mtm_positive"), "0")
    return _as_positions(
        joined, **zeros, ide_internal_party_ref="entity", ide_linkage_ref="deal_id", ide_linkage_type=text(FEE_LINK),
        ide_sourcesys_ref="source_system", lot_type_fk=str(lot_type), rv_cpty_type="coalesce(customer_attribute1, 'NA')",
        rv_rel_party_type="coalesce(intercompany, 'NA')", rv_currency_sub_group="currency",
        rca_deferred_fee="CASE WHEN _valued THEN _amount ELSE 0 END", nationality="coalesce(nationality, 'NA')",
        domicile="coalesce(domicile, 'NA')", deal_type=text(FEE_CODE), tfi_id="NULL", source_table="source_system",
        source_system="'fee'")


# a named source system, or none and no internal counterpart; trailing blanks do not count,
# and a missing value is neither
HAS_ORIGIN = "(rtrim(ide_sourcesys_ref) <> '' OR (rtrim(ide_sourcesys_ref) = '' AND rtrim(ide_internal_one) = ''))"


def record_filter(on_balance: DataFrame, lot_type: int) -> DataFrame:
    return on_balance.where(
        f"lot_type_fk = {lot_type} AND {HAS_ORIGIN} AND ide_linkage_type IN ({texts(POSITION_LINKS)})")


RECORD = ("ide_internal_party_ref", "ide_linkage_ref", "ide_linkage_type", "ide_sourcesys_ref", "lot_type_fk", "rca_accrint",
          "rca_bookv", "rca_marketv", "rca_prov_coll", "rca_prov_indi", "rv_coa", "rv_cpty_type", "rv_rel_party_type",
          "rv_currency_sub_group", "rv_mat_original", "rv_mat_remaining", "rca_deferred_fee", "rca_mtm_negative",
          "rca_mtm_positive", "is_derivative")


def record_positions(tables: Tables, deals: DataFrame, lot_type: int) -> DataFrame:
    """On-balance and derivative records with their transaction (several, if it was valued twice)."""
    filled = {n: f"coalesce({n}, 0)" for n in RECORD if n.startswith(("rca_", "rv_mat_"))}
    zeros = dict.fromkeys(filled, "0D")
    on_balance = shaped(record_filter(tables["records_on_balance"], lot_type), RECORD, **{
        **filled, "rca_mtm_negative": "0D", "rca_mtm_positive": "0D", "is_derivative": "false"})
    derivative = shaped(tables["records_derivative"].where(f"lot_type_fk = {lot_type}"), RECORD, **{
        **zeros, "rca_mtm_negative": "rca_mtm_negative", "rca_mtm_positive": "rca_mtm_positive",
        "rv_mat_original": "0", "rv_mat_remaining": filled["rv_mat_remaining"], "rv_coa": "rv_coa_deriv",
        "rv_currency_sub_group": "CAST(NULL AS string)", "is_derivative": "true"})
    joined = _left(on_balance.unionByName(derivative), deals, "ide_linkage_ref = deal_id")
    return _as_positions(joined, rv_currency_sub_group="CASE WHEN is_derivative THEN currency ELSE rv_currency_sub_group END",
                         source_system=f"CASE WHEN is_derivative THEN '{OWN_SYSTEM}' ELSE source_system END")


def positions(tables: Tables, deals: DataFrame, as_of: date | str, entity: str, lot_type: int) -> DataFrame:
    """All position rows of a reporting date: fees, on-balance and derivative records."""
    return fee_positions(tables, as_of, entity, lot_type).unionByName(record_positions(tables, deals, lot_type))


def facilities(tables: Tables, as_of: date | str, entity: str) -> DataFrame:
    """Off-balance commitments with their amount of the day and their customer."""
    amounts = snapshot(tables["facility_valuation"], as_of, "valuation_date", [COMMITMENT_VALUATION])
    amounts = amounts.selectExpr("facility_nr AS _facility", "amount AS _amount", "true AS _valued")
    joined = _left(valid_at(tables["facility"], as_of, entity=entity), amounts, "facility_nr = _facility")
    joined = with_customer(joined, valid_at(tables["customer"], as_of),
                           ("customer_attribute1", "domicile", "customer_legal_name"))
    return joined.selectExpr(
        "entity", "facility_nr", "customer_nr", "customer_legal_name", "deal_type",
        f"{account_tail('deal_type')} AS ap_code", "currency",
        "CAST(CASE WHEN _valued THEN _amount ELSE 0 END AS double) AS obs_amount", "ccy_amount",
        "coalesce(customer_attribute1, 'N/A') AS counterparty_type", "coalesce(domicile, 'N/A') AS domicile",
        "source_system")


def ledger(view: DataFrame, as_of: date | str, entity: str,
           exclude: Sequence[str] = EXCLUDED_LEDGER_SOURCES) -> DataFrame:
    """Ledger balances of the day; rows of an excluded or unknown source drop out."""
    return snapshot(view, as_of, "date", entity=entity).where(f"source_system NOT IN ({texts(exclude)})")


def extract(tables: Tables, as_of: date | str, entity: str, lot_type: int) -> dict[str, DataFrame]:
    """The three raw tables of a reporting date."""
    deals = transactions(tables, as_of, entity)
    return {"positions": positions(tables, deals, as_of, entity, lot_type),
            "ledger": ledger(tables["ledger_view"], as_of, entity),
            "facility": facilities(tables, as_of, entity)}
