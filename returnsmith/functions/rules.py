"""Business rules of the position, ledger, register and facility tables, one expression each.

Every rule reads columns of its own row only. In a ``CASE`` the first true condition wins.
"""

from __future__ import annotations

from returnsmith.functions.maturity import ON_DEMAND, tenor_code
from returnsmith.functions.nulls import not_zero, one_of, text, texts

FEE_CODE = "8475"
# instrument classes whose account code is the tail of the deal type (fixed values)
DEAL_CLASSES = ("DEPOSIT", "LOAN", "BOND", "FOREX", "OPTION", "IR_SWAP")
BACK_OFFICE_CLASS = "BALANCE_BOC"
FEE_CLASS = "FEE"
DERIVATIVE_LINKS = ("8", "9", "11")
REGISTER_SYSTEMS = ("2", "002")
LOAN_COAS = ("BLS-AST-LOANS-PLAIN", "BLS-AST-LOANS-TF")
HOME_CUSTOMER = "1060000001"


def china_if_unknown(col: str) -> str:
    """'XX' stands for the home group's country."""
    return f"CASE WHEN {col} = 'XX' THEN 'CN' ELSE {col} END"


def account_tail(col: str) -> str:
    return f"right({col}, 4)"


def period_check(now: str, before: str) -> str:
    """'NEW' without a value of the period before, else whether both agree."""
    return (f"CASE WHEN {before} IS NULL OR {before} = '' THEN 'NEW' WHEN {before} = {now} THEN 'true' "
            "ELSE 'false' END")


# return line: by side, and for off-balance rows by the sign of their valuation
CATEGORY = """CASE ale WHEN 'A' THEN cat_asset WHEN 'L' THEN cat_liability
    WHEN 'OB' THEN CASE WHEN rca_mtm_negative = 0 THEN cat_off_asset ELSE cat_off_liability END
    ELSE 'NA' END"""

COUNTERPARTY_COUNTRY = """CASE WHEN customer_nr = 'NULL' THEN 'NULL' WHEN upper(domicile) = 'XX' THEN 'CN'
    ELSE coalesce(domicile, 'NULL') END"""

COUNTERPARTY_SECTOR = f"""CASE WHEN ale = 'L' AND category = '(7)' THEN 'Unallocated'
    WHEN ide_linkage_type = '1' AND customer_nr = {text(HOME_CUSTOMER)} THEN 'Unallocated'
    WHEN rv_rel_party_type IN ('DE', 'DEFAULT') THEN sector_by_party
    ELSE sector_by_related END"""

KEY = "concat_ws('|', coalesce(report_ccy, 'NA'), coalesce(vis_sector, 'NA'), coalesce(vis_country, 'NA'))"

SOURCE_CLASS = "CASE WHEN ide_linkage_type = '10' THEN class_by_coa ELSE class_by_link END"

DEAL_CODE = f"""CASE WHEN source_class IN ({texts(DEAL_CLASSES)}) THEN {account_tail('deal_type')}
    WHEN source_class = {text(BACK_OFFICE_CLASS)} THEN left(ide_linkage_ref, 4)
    WHEN source_class = {text(FEE_CLASS)} THEN {text(FEE_CODE)} ELSE 'NA' END"""

INTEREST_CODE = "coalesce(interest_found, 'NA')"

# valuation account of a derivative; a missing valuation counts as non-zero
VALUATION_CODE = f"""CASE WHEN {one_of('ide_linkage_type', DERIVATIVE_LINKS)} THEN
    CASE WHEN {not_zero('rca_mtm_negative')} THEN account_if_negative
         WHEN {not_zero('rca_mtm_positive')} THEN account_if_positive ELSE 'ERROR' END
    ELSE 'NA' END"""

NATIONALITY = f"coalesce(nullif(nationality, 'YY'), {china_if_unknown('domicile')}, 'NULL')"

REMAINING_MATURITY = f"""CASE WHEN source_table = 'FASM' THEN {tenor_code('value_date', 'maturity_date')}
    WHEN is_on_demand THEN {ON_DEMAND}
    ELSE coalesce(CAST(rv_mat_remaining AS int), 0) END"""

IS_FEE = f"(deal_code <=> {text(FEE_CODE)})"

# registered country of a listed row (even if blank there), else by nationality; fee rows are
# listed by customer, all others by reference
RISK_COUNTRY = """CASE WHEN listed THEN registered
    WHEN nationality = 'YY' THEN vis_country ELSE nationality_derived END"""

RISK_TRANSFER = "CASE WHEN risk_in = vis_country THEN 'N' ELSE 'Y' END"

RISK_SECTOR = f"CASE WHEN source_system IN ({texts(REGISTER_SYSTEMS)}) THEN type_by_ref ELSE vis_sector END"

SIGNED_LEDGER_AMOUNT = f"CASE WHEN ap_code = {text(FEE_CODE)} THEN -aud_equivalent ELSE aud_equivalent END"

# a missing book value passes
IS_LOAN = f"rv_coa IN ({texts(LOAN_COAS)}) AND {not_zero('rca_bookv')}"

REGISTER_COUNTRY = "coalesce(this_country, CASE WHEN nationality = 'YY' THEN domicile ELSE nationality END)"

REGISTER_TYPE = f"CASE WHEN trim(ide_sourcesys_ref) IN ({texts(REGISTER_SYSTEMS)}) THEN this_type ELSE vis_sector END"

FACILITY_COUNTRY = f"coalesce(registered, {china_if_unknown('domicile')}, 'N/A')"
