"""The SQL twins of the registered queries, for DuckDB.

Written from the meaning of each operator with windows and plain joins, independently of how the Spark
side computes it. ``V`` holds shared views; each query pulls in the ones it names.
"""

from __future__ import annotations

import re

from returnsmith.plans.positions import ACCOUNT_RULES, ROW_RULES
from returnsmith.plans.reconcile import DERIVATIVE_GROUPS
from returnsmith.schemas import POSITIONS
from catalog.adapter import AS_OF, BASE_SCHEMAS, BODIES, DIM_ROWS, ENTITY, LOT, duckdb_body



def m(col: str) -> str:
    return f"CAST(CAST({col} AS VARCHAR) AS DECIMAL(38,8))"


def dbl(expr: str, name: str) -> str:
    return f"CAST({expr} AS DOUBLE) AS {name}"


def sums(col: str, when: str | None = None) -> str:
    return f"coalesce(sum({m(col)}){f' FILTER (WHERE {when})' if when else ''}, 0)"


def first_of(dim: str, keys: str) -> str:
    return f"SELECT * FROM {dim} QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY seq) = 1"


VALID = f"start_validity_date <= DATE '{AS_OF}' AND end_validity_date >= DATE '{AS_OF}'"
MTM = "('ORI MTM_POSITIVE', 'ORI MTM_NEGATIVE')"
DEAL = "t.entity, t.deal_id, t.customer_nr, tc.nationality, tc.domicile, tc.customer_legal_name, t.deal_type"


def _deal(name: str, kind: str, currency: str = "t.currency", tfi: str = "NULL", matures: str = "t.maturity_date",
          system: str = "'022'", joins: str = "", where: str | None = None) -> str:
    where = where or f"{VALID} AND entity = '{ENTITY}'"
    return f"""SELECT {DEAL}, {currency} AS currency, CAST({tfi} AS VARCHAR) AS tfi_id, '{kind}' AS source_table,
      t.value_date, {matures} AS maturity_date, {system} AS source_system
    FROM (SELECT * FROM {name} WHERE {where}) t LEFT JOIN valid_customer tc ON tc.customer_nr = t.customer_nr {joins}"""


def _valuations(name: str, entity: bool) -> str:
    more = f" AND entity = '{ENTITY}'" if entity else ""
    return f"""LEFT JOIN (SELECT * FROM {name} WHERE valuation_date = DATE '{AS_OF}'{more} AND valuation_type IN {MTM}) v
      ON v.deal_id = t.deal_id"""


VALUED = f"CASE WHEN v.valuation_type IN {MTM} THEN v.currency ELSE 'NA' END"
POSITION_COLUMNS = """ide_internal_party_ref, ide_linkage_ref, ide_linkage_type, ide_sourcesys_ref, lot_type_fk, rca_accrint,
  rca_bookv, rca_marketv, rca_prov_coll, rca_prov_indi, rv_coa, rv_cpty_type, rv_rel_party_type, rv_currency_sub_group,
  rv_mat_original, rv_mat_remaining, rca_deferred_fee, rca_mtm_negative, rca_mtm_positive, entity, deal_id, customer_nr,
  nationality, domicile, customer_legal_name, deal_type, currency, tfi_id, source_table, value_date, maturity_date,
  source_system"""
NO_TFI = POSITION_COLUMNS.replace("tfi_id, ", "")
OWNED = """coalesce(currency, 'NA') AS currency, key, risk_in, seq"""
CONTENT = ", ".join(n for n in POSITIONS.names if n != "customer_nr")
# labels as the report matches them (fixed values)
SECTOR_TESTS = {
    "banking": "regexp_matches({c}, '^Banking:.*') AND {c} <> 'Banking: central banks'",
    "central_banks": "regexp_matches({c}, 'Banking: central bank')",
    "government": "regexp_matches({c}, 'General government')",
    "non_bank_financial": "regexp_matches({c}, 'Non-banking financial institutions')",
    "non_financial": "regexp_matches({c}, 'Non-financial corporations')",
    "households": "regexp_matches({c}, 'Households and non-profits')",
    "unallocated": "regexp_matches({c}, 'Unallocated')",
}
BUCKETS = {"le_3m": "> 1000000 AND {c} <= 1003000", "m3_12m": "> 1003000 AND {c} <= 1012000",
           "y1_2y": "> 1012000 AND {c} <= 1024000", "y2_5y": "> 1024000 AND {c} <= 1060000", "ge_5y": "> 1060000"}


def exposure(country: str, when: str) -> str:
    """Exposure by country the long way: measures and the deducted account summed separately."""
    rows = f"ale = 'A' AND ({when})"
    return f"""SELECT {country} AS country, {sums('rca_bookv')} - 2 * {sums('rca_bookv', "deal_code = '8754'")}
      - {sums('rca_deferred_fee')} + {sums('rca_accrint')} AS x FROM risk WHERE {rows} AND {country} IS NOT NULL GROUP BY 1"""


_sector_part = {}
for _p, _col, _country in (("b", "vis_sector", "vis_country"), ("d", "risk_in_sector", "risk_in")):
    for _n, _t in SECTOR_TESTS.items():
        _sector_part[f"x_{_p}_{_n}"] = exposure(_country, _t.format(c=_col))
_EXPOSURES = {
    **{f"x_a_{n}": exposure("vis_country", "rv_mat_remaining_derived " + t.format(c="rv_mat_remaining_derived"))
       for n, t in BUCKETS.items()},
    "x_here": exposure("vis_country", "true"), "x_risk": exposure("risk_in", "true"),
    "x_c_outward": exposure("vis_country", "risk_transfer = 'Y'"), "x_c_inward": exposure("risk_in", "risk_transfer = 'Y'"),
    **_sector_part,
    "x_late": f"SELECT vis_country AS country, {sums('rca_deferred_fee')} AS x FROM risk WHERE ale = 'A' AND rv_mat_remaining > 1060000 AND vis_country IS NOT NULL GROUP BY 1",
    "x_gl": "SELECT vis_country AS country, -round_even(coalesce(sum(diff), 0), 0) AS x FROM rec WHERE ale = 'A' AND vis_country IS NOT NULL GROUP BY 1",
    "x_derivatives": f"SELECT risk_in AS country, {sums('rca_mtm_positive')} AS x FROM risk WHERE ale = 'OB' AND risk_in IS NOT NULL GROUP BY 1",
    "x_guarantees": f"SELECT risk_country AS country, {sums('obs_amount')} AS x FROM fac WHERE guarantee = 'G' GROUP BY 1",
    "x_commitments": f"SELECT risk_country AS country, {sums('obs_amount')} AS x FROM fac WHERE guarantee = 'F' GROUP BY 1",
}
_measured = "SELECT c.country, c.country_name" + "".join(f", {n}.x AS {n[2:]}" for n in _EXPOSURES) + " FROM country c " + " ".join(
    f"LEFT JOIN {n} ON {n}.country = c.country" for n in _EXPOSURES)


def _sector_select(p: str, overall: str) -> str:
    cols = {n: f"{p}_{n}" + (" + gl" if n == "non_financial" else "") for n in SECTOR_TESTS}
    check = f"round_even({overall} + gl - (" + " + ".join(f"coalesce({c}, 0)" for c in cols.values()) + "), 0)"
    return ", ".join([*[f"{e} AS {p}_{n}" for n, e in cols.items()], f"{overall} + gl AS {p}_total", f"{check} AS {p}_check"])


FULL_RULES = """
SELECT *, CASE WHEN ap_code IN ('7448', '8578') THEN 0
    WHEN ap_code = '8475' OR coa LIKE 'BLS-LIA%' THEN round_even(rt30_total - total, 1)
    WHEN coa LIKE 'BLS-AST%' THEN round_even(rt30_total + total, 1) END AS diff,
  CASE WHEN ap_code IN ('7448', '8578') THEN '0' WHEN ap_code = '8475' OR coa LIKE 'BLS-LIA%' THEN 'rt30 - mis'
    WHEN coa LIKE 'BLS-AST%' THEN 'rt30 + mis' END AS diff_desc
FROM (SELECT *, rca_bookv + rca_accrint + rca_deferred_fee + rca_mtm + coalesce(adjustment, 0) AS rt30_total FROM rec_measures)"""


def sector_owner(t: str) -> str:
    def deal(code):
        return f"(SELECT first_key FROM owners o WHERE o.role = 'deal' AND o.code = {code} AND o.currency = {t}.ccy)"

    def interest(code):
        return f"(SELECT first_key FROM owners o WHERE o.role = 'interest' AND o.code = {code} AND o.currency = {t}.ccy)"

    return f"""CASE WHEN {t}.ap_code = '7451' THEN {interest("'7431'")} WHEN {t}.ap_code IN ('7448', '8578') THEN {deal("'7271'")}
      WHEN {t}.ap_code = '8451' THEN {deal("'7121'")}
      WHEN {t}.ap_code = '8453' THEN coalesce({deal("'7217'")}, {deal("'7216'")}, {deal("'7211'")})
      ELSE coalesce({deal(f'{t}.ap_code')}, {interest(f'{t}.ap_code')}) END"""


def country_owner(t: str) -> str:
    return f"""CASE WHEN {t}.ap_code = '7451' THEN {_risk(t, 'interest', "'7431'")}
      WHEN {t}.ap_code IN ('7448', '8578') THEN {_risk(t, 'deal', "'7211'")}
      WHEN {t}.ap_code = '8451' THEN {_risk(t, 'deal', "'7121'")}
      WHEN {t}.ap_code = '8453' THEN coalesce({_risk(t, 'deal', "'7211'")}, {_risk(t, 'deal', "'7216'")})
      ELSE coalesce({_risk(t, 'deal', f'{t}.ap_code')}, {_risk(t, 'interest', f'{t}.ap_code')}) END"""


def _risk(t: str, role: str, code: str) -> str:
    return (f"(SELECT nullif(last_risk_in, '') FROM owners o WHERE o.role = '{role}' AND o.code = {code} "
            f"AND o.currency = {t}.ccy)")


V: dict[str, str] = {
    **{f"d_{n}": "" for n in DIM_ROWS},
    "u_category": first_of("d_category", "coa"), "u_ccy": first_of("d_ccy", "currency_group"),
    "u_sector": first_of("d_sector", "party_type"), "u_class2": first_of("d_source_class", "linkage_type, coa"),
    "u_class1": first_of("d_source_class", "linkage_type"), "u_account": first_of("d_account", "ap_code"),
    "u_guarantee": first_of("d_guarantee", "deal_type"),

    "mapped": """
SELECT p.*, k.ale, k.cat_asset, k.cat_liability, k.cat_off_asset, k.cat_off_liability, y.report_ccy,
  s1.sector AS sector_by_party, s2.sector AS sector_by_related, f2.source_class AS class_by_coa, f1.source_class AS class_by_link
FROM positions p LEFT JOIN u_category k ON p.rv_coa = k.coa LEFT JOIN u_ccy y ON p.rv_currency_sub_group = y.currency_group
LEFT JOIN u_sector s1 ON p.rv_cpty_type = s1.party_type LEFT JOIN u_sector s2 ON p.rv_rel_party_type = s2.party_type
LEFT JOIN u_class2 f2 ON p.ide_linkage_type = f2.linkage_type AND p.rv_coa = f2.coa
LEFT JOIN u_class1 f1 ON p.ide_linkage_type = f1.linkage_type""",
    "coded": """
SELECT *, CASE WHEN ale = 'L' AND category = '(7)' THEN 'Unallocated'
    WHEN ide_linkage_type = '1' AND customer_nr = '1060000001' THEN 'Unallocated'
    WHEN rv_rel_party_type IN ('DE', 'DEFAULT') THEN sector_by_party ELSE sector_by_related END AS vis_sector,
  CASE WHEN source_class IN ('DEPOSIT', 'LOAN', 'BOND', 'FOREX', 'OPTION', 'IR_SWAP') THEN right(deal_type, 4)
    WHEN source_class = 'BALANCE_BOC' THEN left(ide_linkage_ref, 4) WHEN source_class = 'FEE' THEN '8475' ELSE 'NA' END AS deal_code,
  coalesce(CASE WHEN nationality = 'YY' THEN NULL ELSE nationality END, CASE WHEN domicile = 'XX' THEN 'CN' ELSE domicile END, 'NULL')
    AS nationality_derived
FROM (SELECT *, CASE WHEN ale = 'A' THEN cat_asset WHEN ale = 'L' THEN cat_liability
    WHEN ale = 'OB' AND rca_mtm_negative = 0 THEN cat_off_asset WHEN ale = 'OB' THEN cat_off_liability ELSE 'NA' END AS category,
  CASE WHEN customer_nr = 'NULL' THEN 'NULL' WHEN upper(domicile) = 'XX' THEN 'CN' ELSE coalesce(domicile, 'NULL') END AS vis_country,
  CASE WHEN ide_linkage_type = '10' THEN class_by_coa ELSE class_by_link END AS source_class FROM mapped)""",
    "enriched": """
SELECT c.* EXCLUDE (cat_asset, cat_liability, cat_off_asset, cat_off_liability, sector_by_party, sector_by_related, class_by_coa,
    class_by_link),
  concat_ws('|', coalesce(report_ccy, 'NA'), coalesce(vis_sector, 'NA'), coalesce(vis_country, 'NA')) AS key,
  coalesce(i.interest_code, 'NA') AS interest_code,
  CASE WHEN ide_linkage_type IN ('8', '9', '11') THEN CASE WHEN rca_mtm_negative <> 0 OR rca_mtm_negative IS NULL THEN v.negative_code
    WHEN rca_mtm_positive <> 0 OR rca_mtm_positive IS NULL THEN v.positive_code ELSE 'ERROR' END ELSE 'NA' END AS valuation_code,
  CASE WHEN source_table = 'FASM' THEN CASE WHEN maturity_date < value_date THEN NULL
      WHEN (maturity_date - value_date) // 365 >= 5 THEN 1060000 + (maturity_date - value_date) % 365
      ELSE 1000000 + 1000 * ((maturity_date - value_date) // 30) + (maturity_date - value_date) % 365 END
    WHEN deal_code IN (SELECT ap_code FROM d_on_demand) THEN 1001000 ELSE coalesce(rv_mat_remaining, 0) END::INT AS rv_mat_remaining_derived
FROM coded c LEFT JOIN d_interest i ON c.deal_code = i.principal_code LEFT JOIN d_valuation v ON c.deal_code = v.exposure_code""",
    "register": f"""
SELECT *, CASE WHEN last_country = '' THEN 'NEW' WHEN last_country = this_country THEN 'true' ELSE 'false' END AS check_country,
  CASE WHEN last_type IS NULL OR last_type = '' THEN 'NEW' WHEN last_type = this_type THEN 'true' ELSE 'false' END AS check_type
FROM (SELECT e.ide_linkage_ref, e.customer_nr, e.vis_sector, e.ide_sourcesys_ref, t.book AS rca_bookv, e.customer_legal_name,
  e.nationality, e.domicile, coalesce(n.country, CASE WHEN e.nationality = 'YY' THEN e.domicile ELSE e.nationality END) AS this_country,
  CASE WHEN trim(e.ide_sourcesys_ref) IN ('2', '002') THEN n.type ELSE e.vis_sector END AS this_type,
  coalesce(l.country, '') AS last_country, l.type AS last_type, e.seq
FROM (SELECT *, sum({m('rca_bookv')}) OVER (PARTITION BY ide_linkage_ref) AS tot FROM enriched) e
CROSS JOIN LATERAL (SELECT CAST(round_even(e.tot, 1) AS DOUBLE) AS book) t
LEFT JOIN register_now n ON e.ide_linkage_ref = n.deal_id LEFT JOIN register_last l ON e.ide_linkage_ref = l.deal_id
WHERE e.rv_coa IN ('BLS-AST-LOANS-PLAIN', 'BLS-AST-LOANS-TF') AND (e.rca_bookv <> 0 OR e.rca_bookv IS NULL))""",
    "reg_ref": """SELECT * FROM register QUALIFY row_number() OVER (PARTITION BY ide_linkage_ref
      ORDER BY seq, this_country NULLS FIRST, this_type NULLS FIRST) = 1""",
    "reg_customer": """SELECT * FROM register QUALIFY row_number() OVER (PARTITION BY customer_nr
      ORDER BY seq, this_country NULLS FIRST) = 1""",
    "risk": """
SELECT *, CASE WHEN risk_in = vis_country THEN 'N' ELSE 'Y' END AS risk_transfer FROM (
SELECT e.*, CASE WHEN e.deal_code = '8475' AND c.seq IS NOT NULL THEN c.this_country
    WHEN e.deal_code <> '8475' AND r.seq IS NOT NULL THEN r.this_country WHEN e.nationality = 'YY' THEN e.vis_country
    ELSE e.nationality_derived END AS risk_in,
  CASE WHEN e.source_system IN ('2', '002') THEN r.this_type ELSE e.vis_sector END AS risk_in_sector
FROM enriched e LEFT JOIN reg_customer c ON e.customer_nr IS NOT DISTINCT FROM c.customer_nr
LEFT JOIN reg_ref r ON e.ide_linkage_ref IS NOT DISTINCT FROM r.ide_linkage_ref)""",
    "gl": """
SELECT l.*, a.coa AS rv_coa, coalesce(g.guarantee, '') AS g, k.ale, l.currency AS ccy,
  coalesce(vp.positive_code, vn.negative_code) AS derivatives,
  CASE WHEN l.ap_code = '8475' THEN -l.aud_equivalent ELSE l.aud_equivalent END AS amount
FROM ledger l LEFT JOIN u_account a ON l.ap_code = a.ap_code LEFT JOIN u_guarantee g ON l.ap_code = g.deal_type
LEFT JOIN u_category k ON a.coa = k.coa LEFT JOIN d_valuation vp ON l.ap_code = vp.positive_code
LEFT JOIN d_valuation vn ON l.ap_code = vn.negative_code""",
    "fac": """
SELECT f.*, right(f.deal_type, 4) AS ap_code, coalesce(g.guarantee, '') AS guarantee,
  CASE WHEN r.this_country IS NOT NULL THEN r.this_country WHEN f.domicile = 'XX' THEN 'CN'
    WHEN f.domicile IS NOT NULL THEN f.domicile ELSE 'N/A' END AS risk_country
FROM facility f LEFT JOIN u_guarantee g ON right(f.deal_type, 4) = g.deal_type
LEFT JOIN reg_customer r ON f.customer_nr IS NOT DISTINCT FROM r.customer_nr""",

    # warehouse
    "valid_customer": f"SELECT * FROM wh_customer WHERE {VALID}",
    "trn": " UNION ALL ".join([
        _deal("wh_interest_account", "iba", system="t.source_system"), _deal("wh_loan", "loan", system="t.source_system"),
        _deal("wh_bond_deal", "bond", tfi="t.tfi_id", matures="b.maturity_date",
              joins=f"LEFT JOIN (SELECT * FROM wh_bond WHERE {VALID} AND object_origin = '{ENTITY}') b ON b.tfi_id = t.tfi_id"),
        _deal("wh_forex", "forex", currency=VALUED, joins=_valuations("wh_forex_valuation", False)),
        _deal("wh_option_deal", "option", currency=VALUED, matures="o.maturity_date", joins=_valuations("wh_option_valuation", True)
              + f" LEFT JOIN (SELECT * FROM wh_option WHERE {VALID}) o ON o.tfi_id = t.tfi_id"),
        _deal("wh_swap", "swap", currency=VALUED, joins=_valuations("wh_swap_valuation", True)),
        _deal("(SELECT *, element6 AS deal_type, DATE '9999-12-31' AS value_date, DATE '9999-12-31' AS maturity_date "
              "FROM wh_back_office_balance)", "back_office", system="'backoffice'",
              where=f"balance_date = DATE '{AS_OF}' AND entity = '{ENTITY}'")]),
    "fee_rows": f"""
SELECT f.entity AS ide_internal_party_ref, f.deal_id AS ide_linkage_ref, '12' AS ide_linkage_type, f.source_system AS ide_sourcesys_ref,
  {LOT} AS lot_type_fk, 0.0e0 AS rca_accrint, 0.0e0 AS rca_bookv, 0.0e0 AS rca_marketv, 0.0e0 AS rca_prov_coll, 0.0e0 AS rca_prov_indi,
  f.rv_coa, coalesce(tc.customer_attribute1, 'NA') AS rv_cpty_type, coalesce(tc.intercompany, 'NA') AS rv_rel_party_type,
  f.currency AS rv_currency_sub_group, 0 AS rv_mat_original, 0 AS rv_mat_remaining,
  CASE WHEN v.valuation_type = 'DEFERRED_FEE' THEN v.amount ELSE 0.0e0 END AS rca_deferred_fee, 0.0e0 AS rca_mtm_negative,
  0.0e0 AS rca_mtm_positive, f.entity, f.deal_id, f.customer_nr, coalesce(tc.nationality, 'NA') AS nationality,
  coalesce(tc.domicile, 'NA') AS domicile, tc.customer_legal_name, '8475' AS deal_type, f.currency, CAST(NULL AS VARCHAR) AS tfi_id,
  f.source_system AS source_table, f.value_date, f.maturity_date, 'fee' AS source_system
FROM (SELECT * FROM wh_fee WHERE {VALID} AND source_system = 'FASM' AND entity = '{ENTITY}') f
LEFT JOIN wh_fee_valuation v ON f.deal_id = v.deal_id AND v.valuation_type = 'DEFERRED_FEE' AND v.valuation_date = DATE '{AS_OF}'
LEFT JOIN valid_customer tc ON tc.customer_nr = f.customer_nr""",
    "on_balance": f"""
SELECT * FROM wh_records_on_balance WHERE lot_type_fk = {LOT} AND (rtrim(ide_sourcesys_ref) <> ''
  OR (rtrim(ide_sourcesys_ref) = '' AND ide_internal_one = '')) AND ide_linkage_type IN ('1','2','3','5','6','8','9','10','11')""",
    "record_rows": f"""
SELECT r.ide_internal_party_ref, r.ide_linkage_ref, r.ide_linkage_type, r.ide_sourcesys_ref, r.lot_type_fk,
  coalesce(r.rca_accrint, 0) AS rca_accrint, coalesce(r.rca_bookv, 0) AS rca_bookv, coalesce(r.rca_marketv, 0) AS rca_marketv,
  coalesce(r.rca_prov_coll, 0) AS rca_prov_coll, coalesce(r.rca_prov_indi, 0) AS rca_prov_indi, r.rv_coa, r.rv_cpty_type,
  r.rv_rel_party_type, r.rv_currency_sub_group, coalesce(r.rv_mat_original, 0) AS rv_mat_original,
  coalesce(r.rv_mat_remaining, 0) AS rv_mat_remaining, coalesce(r.rca_deferred_fee, 0) AS rca_deferred_fee,
  0.0e0 AS rca_mtm_negative, 0.0e0 AS rca_mtm_positive, t.entity, t.deal_id, t.customer_nr, t.nationality, t.domicile,
  t.customer_legal_name, t.deal_type, t.currency, t.tfi_id, t.source_table, t.value_date, t.maturity_date, t.source_system
FROM on_balance r LEFT JOIN trn t ON r.ide_linkage_ref = t.deal_id
UNION ALL
SELECT r.ide_internal_party_ref, r.ide_linkage_ref, r.ide_linkage_type, r.ide_sourcesys_ref, r.lot_type_fk, 0, 0, 0, 0, 0,
  r.rv_coa_deriv, r.rv_cpty_type, r.rv_rel_party_type, t.currency, 0, coalesce(r.rv_mat_remaining, 0), 0, r.rca_mtm_negative,
  r.rca_mtm_positive, t.entity, t.deal_id, t.customer_nr, t.nationality, t.domicile, t.customer_legal_name, t.deal_type, t.currency,
  t.tfi_id, t.source_table, t.value_date, t.maturity_date, '022'
FROM (SELECT * FROM wh_records_derivative WHERE lot_type_fk = {LOT}) r LEFT JOIN trn t ON r.ide_linkage_ref = t.deal_id""",

    # quality and review
    "dups": f"""SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY {CONTENT}
  ORDER BY customer_nr ASC NULLS FIRST, seq DESC) AS n FROM feed) WHERE n > 1""",
    "dedup": f"""SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY {CONTENT}
  ORDER BY customer_nr DESC NULLS LAST, seq) AS n FROM feed) WHERE n = 1""",
    "log_all": """
SELECT * EXCLUDE (record_action), CASE currency WHEN 'AUD' THEN 'Delete' WHEN 'USD' THEN 'UPDATE' WHEN 'CNY' THEN 'insert'
    WHEN 'EUR' THEN '' END AS record_action, CASE WHEN ide_sourcesys_ref = '022' THEN 'DONE' ELSE 'PENDING' END AS status FROM issues""",
    "todo_all": "SELECT *, lower(coalesce(record_action, '')) AS act FROM log_all WHERE status <> 'DONE'",
    "issues": """
SELECT *, 'NA key with non-zero rca' AS log_reason, '' AS record_action FROM enriched
WHERE vis_sector IS NULL AND coalesce(rca_accrint, 0) + coalesce(rca_bookv, 0) + coalesce(rca_marketv, 0) + coalesce(rca_prov_coll, 0)
  + coalesce(rca_prov_indi, 0) <> 0
UNION ALL
SELECT *, 'ERROR估值 with non-zero rca_mtm', '' FROM enriched WHERE valuation_code = 'ERROR'
  AND (rca_mtm_negative + rca_mtm_positive <> 0 OR rca_mtm_negative + rca_mtm_positive IS NULL)""",
    "log": """
SELECT seq, ide_linkage_ref, customer_nr, currency, rca_bookv, rca_accrint, vis_sector, log_reason,
  CASE currency WHEN 'AUD' THEN 'Delete' WHEN 'USD' THEN 'UPDATE' WHEN 'CNY' THEN 'insert' WHEN 'EUR' THEN '' END AS record_action,
  CASE WHEN ide_sourcesys_ref = '022' THEN 'DONE' ELSE 'PENDING' END AS status FROM issues""",
    "data": "SELECT seq, ide_linkage_ref, customer_nr, currency, rca_bookv, rca_accrint, vis_sector FROM enriched",
    "todo": "SELECT *, lower(coalesce(record_action, '')) AS act FROM log WHERE status <> 'DONE'",

    # reconciliation
    "gl_pivot": f"""
SELECT ap_code, ap_name, ccy, rv_coa AS coa, ale, {sums('aud_equivalent')} AS total,
  CASE ale WHEN 'A' THEN 'L' WHEN 'L' THEN 'A' END AS ale_opposite
FROM gl WHERE ale IN ('A', 'L') AND derivatives IS NULL GROUP BY ap_code, ap_name, ccy, rv_coa, ale""",
    "adjusted": """
SELECT p.*, CASE WHEN p.ap_code = '7271' THEN a.moved ELSE 0 END AS adjustment FROM gl_pivot p LEFT JOIN
  (SELECT ccy, sum(total) AS moved FROM gl_pivot WHERE ap_code IN ('7448', '8578') GROUP BY ccy) a ON p.ccy = a.ccy""",
    "ale_sum": f"SELECT deal_code, currency, ale, {sums('rca_bookv')} AS book, {sums('rca_deferred_fee')} AS fee FROM risk GROUP BY ALL",
    "int_sum": f"SELECT interest_code, currency, {sums('rca_accrint')} AS accr FROM risk GROUP BY ALL",
    "int_ale_sum": f"SELECT interest_code, currency, ale, {sums('rca_accrint')} AS accr FROM risk GROUP BY ALL",
    "fee_sum": f"SELECT currency, {sums('rca_deferred_fee')} AS fee FROM risk GROUP BY ALL",
    "val_sum": f"SELECT valuation_code, currency, {sums('rca_mtm_negative')} + {sums('rca_mtm_positive')} AS mtm FROM risk GROUP BY ALL",
    "rec_measures": """
SELECT p.*, CASE WHEN p.ap_code = '8475' THEN coalesce(b.book, 0) + coalesce(o.book, 0)
    ELSE coalesce(b.book, 0) - coalesce(o.book, 0) END AS rca_bookv, coalesce(i.accr, 0) AS rca_accrint,
  CASE WHEN p.ap_code = '8475' THEN coalesce(f.fee, 0) ELSE 0 END AS rca_deferred_fee, coalesce(v.mtm, 0) AS rca_mtm,
  coalesce(o.book, 0) + coalesce(o.fee, 0) + coalesce(io.accr, 0) AS impact_a,
  coalesce(o.book, 0) + coalesce(o.fee, 0) + coalesce(io.accr, 0) AS impact_l
FROM adjusted p LEFT JOIN ale_sum b ON b.deal_code = p.ap_code AND b.currency = p.ccy AND b.ale = p.ale
LEFT JOIN ale_sum o ON o.deal_code = p.ap_code AND o.currency = p.ccy AND o.ale = p.ale_opposite
LEFT JOIN int_sum i ON i.interest_code = p.ap_code AND i.currency = p.ccy
LEFT JOIN int_ale_sum io ON io.interest_code = p.ap_code AND io.currency = p.ccy AND io.ale = p.ale_opposite
LEFT JOIN fee_sum f ON f.currency = p.ccy LEFT JOIN val_sum v ON v.valuation_code = p.ap_code AND v.currency = p.ccy""",
    "owner_rows": f"""SELECT 'deal' AS role, coalesce(deal_code, 'NA') AS code, {OWNED} FROM risk
UNION ALL SELECT 'interest', coalesce(interest_code, 'NA'), {OWNED} FROM risk""",
    "owners": """SELECT f.role, f.code, f.currency, f.key AS first_key, l.risk_in AS last_risk_in FROM
  (SELECT * FROM owner_rows QUALIFY row_number() OVER (PARTITION BY role, code, currency ORDER BY seq, key) = 1) f JOIN
  (SELECT * FROM owner_rows QUALIFY row_number() OVER (PARTITION BY role, code, currency ORDER BY seq DESC, risk_in DESC NULLS LAST) = 1) l
  ON f.role = l.role AND f.code = l.code AND f.currency = l.currency""",
    "rec_diff": FULL_RULES,
    "rec": f"""SELECT t.*, right(t.key, 2) AS vis_country FROM
  (SELECT r.*, {sector_owner('r')} AS key, {country_owner('r')} AS risk_in FROM rec_diff r) t""",
    "accounts": "SELECT ap_code, currency AS ccy, count(*) AS entries FROM ledger GROUP BY ap_code, currency",

    # country return
    **_EXPOSURES,
    "measured": _measured,
    "wide": f"""
SELECT country, country_name, gl AS a_gl_adj, a_le_3m + gl AS a_le_3m, a_m3_12m, a_y1_2y, a_y2_5y, a_ge_5y - late AS a_ge_5y,
  -late AS a_maturity_adj, here + gl AS a_total,
  here + gl - (a_le_3m + gl) - a_m3_12m - a_y1_2y - a_y2_5y - (a_ge_5y - late) AS a_unallocated, gl AS b_gl_adj,
  {_sector_select('b', 'here')}, c_outward, c_inward, coalesce(c_inward, 0) - coalesce(c_outward, 0) AS c_net,
  {_sector_select('d', 'risk')}, derivatives AS e_derivatives, guarantees AS e_guarantees, commitments AS e_commitments
FROM measured""",
    "booked": f"SELECT g AS guarantee, ccy, {sums('aud_equivalent')} AS ledger_sum FROM gl WHERE g IN ('G', 'F') AND ccy IS NOT NULL GROUP BY ALL",
    "granted": f"SELECT guarantee, currency AS ccy, {sums('obs_amount')} AS facility FROM fac GROUP BY ALL",
    "ob_lines": """
SELECT guarantee, 1 AS line, ccy, ledger_sum FROM booked
UNION ALL SELECT k.guarantee, 2, 'Grand Total', round_even(coalesce((SELECT sum(ledger_sum) FROM booked b WHERE b.guarantee = k.guarantee), 0), 1)
  FROM (VALUES ('G'), ('F')) k(guarantee)
UNION ALL SELECT 'G', 3, '731.3B', round_even(coalesce(sum(e_guarantees), 0), 1) FROM wide
UNION ALL SELECT 'F', 3, '731.3B', round_even(coalesce(sum(e_commitments), 0), 1) FROM wide""",
    "ob": """
SELECT l.guarantee, l.line, l.ccy, l.ledger_sum, f.facility, l.ledger_sum + f.facility AS diff FROM (SELECT * FROM ob_lines UNION ALL
  SELECT guarantee, 4, CASE guarantee WHEN 'G' THEN 'Guarantees Checking' ELSE 'Credit commitments Checking' END, sum(ledger_sum)
  FROM ob_lines WHERE line IN (2, 3) GROUP BY guarantee) l LEFT JOIN granted f ON f.guarantee = l.guarantee AND f.ccy = l.ccy""",
    "wide_adj": """
SELECT w.*, CASE WHEN country = 'AU' THEN -round_even(coalesce((SELECT sum(diff) FROM ob WHERE guarantee = 'G'), 0), 2) END AS e_guarantees_adj,
  CASE WHEN country = 'AU' THEN -round_even(coalesce((SELECT sum(diff) FROM ob WHERE guarantee = 'F'), 0), 2) END AS e_commitments_adj
FROM wide w""",
}


def _doubles(names: str) -> str:
    return ", ".join(dbl(n, n) for n in names.split())


ENRICHED = ", ".join([*[n for n in POSITIONS.names if n != "tfi_id"], "seq", "ale", "report_ccy", *ROW_RULES, *ACCOUNT_RULES])
REC_KEYS = "ap_code, ap_name, ccy, coa, ale"
LOGGED = "seq, ide_linkage_ref, customer_nr, currency, rca_bookv, rca_accrint, vis_sector"
A_COLUMNS = "a_gl_adj a_le_3m a_m3_12m a_y1_2y a_y2_5y a_ge_5y a_maturity_adj a_total a_unallocated"
SECTOR_NAMES = "banking central_banks government non_bank_financial non_financial households unallocated total check"
B_COLUMNS = "b_gl_adj " + " ".join(f"b_{n}" for n in SECTOR_NAMES.split())
C_COLUMNS = "c_outward c_inward c_net"
D_COLUMNS = " ".join(f"d_{n}" for n in SECTOR_NAMES.split())
E_COLUMNS = "e_derivatives e_guarantees e_commitments"
E_ADJ_COLUMNS = f"{E_COLUMNS} e_guarantees_adj e_commitments_adj"
ALL_COLUMNS = " ".join([A_COLUMNS, B_COLUMNS, C_COLUMNS, D_COLUMNS, E_ADJ_COLUMNS])


def _part(columns: str, view: str = "wide") -> str:
    return "SELECT country, country_name, " + ", ".join(dbl(n, n[2:]) for n in columns.split()) + f" FROM {view}"


def _scaled() -> str:
    """Lines of a part with any non-zero figure, in millions, one row per figure (missing ones too)."""
    out = []
    for part, columns in zip("abcde", (A_COLUMNS, B_COLUMNS, C_COLUMNS, D_COLUMNS, E_ADJ_COLUMNS)):
        scaled = {n: f"round_even({n} / 1e6, 3)" for n in columns.split()}
        any_left = " OR ".join(f"coalesce({e}, 0) <> 0" for e in scaled.values())
        out += [f"SELECT '{part}' AS part, country, country_name, '{n[2:]}' AS measure, CAST({e} AS DOUBLE) AS millions "
                f"FROM wide_adj WHERE {any_left}" for n, e in scaled.items()]
    return " UNION ALL ".join(out)


UNMATCHED = " UNION ALL ".join(
    f"SELECT {i} AS step, '{table}' AS lookup_table, '{key}' AS data_key, count(*) AS unmatched_rows FROM positions p "
    f"WHERE NOT EXISTS (SELECT 1 FROM d_{table} d WHERE {match})" for i, (table, key, match) in enumerate((
        ("category", "rv_coa", "d.coa = p.rv_coa"), ("ccy", "rv_currency_sub_group", "d.currency_group = p.rv_currency_sub_group"),
        ("sector", "rv_cpty_type", "d.party_type = p.rv_cpty_type"), ("sector", "rv_rel_party_type", "d.party_type = p.rv_rel_party_type"),
        ("source_class", "ide_linkage_type+rv_coa", "d.linkage_type = p.ide_linkage_type AND d.coa = p.rv_coa"),
        ("source_class", "ide_linkage_type", "d.linkage_type = p.ide_linkage_type"))))

_ACCOUNTS = ", ".join(f"('{g}', {i}, '{code}')" for g, codes in DERIVATIVE_GROUPS.items() for i, code in enumerate(codes, 1))
V["derivative_lines"] = f"""
SELECT *, CASE WHEN grp IN ('1', '3', '5') THEN coalesce(rca_mtm, 0) + dm010 ELSE coalesce(rca_mtm, 0) - dm010 END AS diff FROM (
SELECT t.grp, t.line, t.code, a.suffix_name AS name, v.mtm AS rca_mtm, round_even(coalesce((SELECT {sums('aud_equivalent')} FROM gl
    WHERE gl.ap_code = t.code AND gl.prod_code IS NOT NULL AND CASE WHEN t.code IN ('7444', '8576') AND t.grp IN ('1', '2')
      THEN gl.prod_code = '6108' WHEN t.code IN ('7444', '8576') AND t.grp IN ('3', '4') THEN gl.prod_code = '6114' ELSE true END), 0), 1)
    AS dm010
FROM (VALUES {_ACCOUNTS}) t(grp, line, code) LEFT JOIN u_account a ON a.ap_code = t.code
LEFT JOIN (SELECT valuation_code, round_even({sums('rca_mtm_negative')} + {sums('rca_mtm_positive')}, 1) AS mtm FROM risk
  WHERE valuation_code IS NOT NULL GROUP BY 1) v ON v.valuation_code = t.code)"""
V["asset_lines"] = f"""
SELECT *, loans + securities + other AS total FROM (SELECT report_ccy, vis_sector, vis_country,
  {sums('rca_bookv', "category = '(4)' AND ale = 'A'")} AS loans, {sums('rca_marketv', "category = '(5)' AND ale = 'A'")} AS securities,
  {sums('rca_bookv', "category = '(6)' AND ale = 'A'")} + {sums('rca_accrint', "category IN ('(4)', '(5)') AND ale = 'A'")}
    + {sums('rca_mtm_positive', "category = '(6)' AND ale = 'OB'")} AS other
FROM enriched WHERE ale IN ('A', 'OB') AND report_ccy IS NOT NULL AND vis_sector IS NOT NULL AND vis_country IS NOT NULL GROUP BY ALL)"""
V["liability_lines"] = f"""
SELECT *, issues_le_1y + issues_gt_1y AS issues, loans + issues_le_1y + issues_gt_1y + other AS total FROM (
SELECT report_ccy, vis_sector, vis_country, {sums('rca_bookv', "category = '(4)' AND ale = 'L'")} AS loans,
  {sums('rca_bookv', "category = '(7)' AND ale = 'L' AND rv_mat_remaining <= 1012000")} AS issues_le_1y,
  {sums('rca_bookv', "category = '(7)' AND ale = 'L' AND rv_mat_remaining > 1012000")} AS issues_gt_1y,
  {sums('rca_bookv', "category = '(8)' AND ale = 'L'")} + {sums('rca_accrint', "category IN ('(4)', '(7)') AND ale = 'L'")}
    + {sums('rca_deferred_fee', "category = '(8)' AND ale = 'L'")} + {sums('rca_mtm_negative', "category = '(8)' AND ale = 'L'")} AS other
FROM enriched WHERE ale IN ('L', 'OB') AND report_ccy IS NOT NULL AND vis_sector IS NOT NULL AND vis_country IS NOT NULL GROUP BY ALL)"""
V["key_adj"] = """
SELECT 'A' AS side, key, round_even(-(coalesce(sum(diff), 0) - 2 * coalesce(sum(diff) FILTER (WHERE ap_code = '8475'), 0)), 1) AS adjustment
FROM rec WHERE ale = 'A' AND key IS NOT NULL GROUP BY key
UNION ALL SELECT 'L', key, round_even(-coalesce(sum(diff), 0), 1) FROM rec WHERE ale = 'L' AND key IS NOT NULL GROUP BY key"""

_LINES = "report_ccy, vis_sector, vis_country, "
_REC = "total rca_bookv rca_accrint rca_deferred_fee rca_mtm impact_a impact_l adjustment rt30_total diff"
_NO_NULL = "CASE WHEN {0} IN ('-1.#IND','1.#QNAN','1.#IND','-1.#QNAN','#N/A N/A','#N/A','N/A','n/a','<NA>','#NA','NULL','null','NaN','-NaN','nan','-nan','None','') THEN NULL ELSE {0} END AS {0}"
_KEYS_OF = "l.ide_linkage_ref IS NOT DISTINCT FROM d.ide_linkage_ref AND l.customer_nr IS NOT DISTINCT FROM d.customer_nr"
_ALL_OF = " AND ".join(f"l.{n} IS NOT DISTINCT FROM d.{n}" for n in ENRICHED.split(", "))


def _acted(match: str) -> str:
    return (f"SELECT {LOGGED} FROM data d WHERE NOT EXISTS (SELECT 1 FROM todo l WHERE act IN ('delete', 'update') AND {match}) "
            f"UNION ALL SELECT {LOGGED} FROM todo WHERE act IN ('update', 'insert')")


FINAL: dict[str, str] = {
    "src_position_union": "SELECT * FROM trn",
    "src_fee_positions": f"SELECT {NO_TFI} FROM fee_rows",
    "src_three_way_union": f"SELECT {POSITION_COLUMNS} FROM (SELECT * FROM fee_rows UNION ALL SELECT * FROM record_rows)",
    "src_facilities": f"""
SELECT f.entity, f.facility_nr, f.customer_nr, tc.customer_legal_name, f.deal_type, right(f.deal_type, 4) AS ap_code, f.currency,
  CASE WHEN v.valuation_type = 'OBS Commitment' THEN v.amount ELSE 0.0e0 END AS obs_amount, f.ccy_amount,
  coalesce(tc.customer_attribute1, 'N/A') AS counterparty_type, coalesce(tc.domicile, 'N/A') AS domicile
FROM wh_facility f LEFT JOIN wh_facility_valuation v ON v.facility_nr = f.facility_nr AND v.valuation_type = 'OBS Commitment'
  AND v.valuation_date = DATE '{AS_OF}' LEFT JOIN valid_customer tc ON tc.customer_nr = f.customer_nr
WHERE f.{VALID.replace(' AND end', ' AND f.end')} AND f.entity = '{ENTITY}'""",
    "src_typed_select": f"SELECT {NO_TFI}, seq FROM positions",
    "src_null_tokens": "SELECT seq, " + ", ".join(_NO_NULL.format(n) for n in (
        "customer_nr", "nationality", "rv_rel_party_type", "source_system")) + " FROM positions",
    "src_bundle_roundtrip": """SELECT 'ledger' AS name, ap_code AS code, currency, aud_equivalent AS amount FROM ledger
UNION ALL SELECT 'facility', deal_type, currency, obs_amount FROM facility""",
    "flt_valid_at": "SELECT * FROM valid_customer",
    "flt_linkage": "SELECT ide_linkage_ref, ide_linkage_type, ide_sourcesys_ref, ide_internal_one, rca_bookv FROM on_balance",
    "flt_not_in": f"""SELECT date, ap_code, source_system, currency, aud_equivalent FROM ledger
WHERE date = DATE '{AS_OF}' AND entity = '{ENTITY}' AND source_system NOT IN ('777')""",
    "jn_valid_at_customer": f"""SELECT t.deal_id, t.customer_nr, c.customer_legal_name, c.nationality, c.domicile, t.value_date
FROM (SELECT * FROM wh_loan WHERE {VALID} AND entity = '{ENTITY}') t LEFT JOIN valid_customer c ON c.customer_nr = t.customer_nr""",
    "jn_left_residual": f"""SELECT f.facility_nr, f.currency, v.valuation_type, v.amount FROM wh_facility f LEFT JOIN wh_facility_valuation v
ON f.facility_nr = v.facility_nr AND v.valuation_type = 'OBS Commitment' AND v.valuation_date = DATE '{AS_OF}'""",
    "jn_position_trn": """SELECT ide_linkage_ref, ide_linkage_type, deal_id, rv_currency_sub_group, source_system, source_table,
  customer_legal_name, rca_bookv, rca_accrint, rca_mtm_negative, rca_mtm_positive, rv_mat_remaining, maturity_date FROM record_rows""",
    "map_lookup_single": """SELECT p.seq, p.rv_currency_sub_group, u.report_ccy FROM positions p LEFT JOIN u_ccy u
ON p.rv_currency_sub_group = u.currency_group""",
    "map_lookup_composite": "SELECT seq, ide_linkage_type, rv_coa, class_by_coa FROM mapped",
    "map_lookup_unmatched": UNMATCHED,
    "map_chain": """SELECT seq, ale, cat_asset, cat_liability, cat_off_asset, cat_off_liability, report_ccy, sector_by_party,
  sector_by_related, class_by_coa, class_by_link FROM mapped""",
    "map_reloaded_lookups": """SELECT seq, ale, cat_asset, cat_liability, cat_off_asset, cat_off_liability, report_ccy,
  sector_by_party, sector_by_related, class_by_coa, class_by_link FROM mapped""",
    "map_registered_lookup": """SELECT f.facility_nr, f.customer_nr, r.this_country AS registered, r.seq IS NOT NULL AS listed
FROM facility f LEFT JOIN reg_customer r ON f.customer_nr IS NOT DISTINCT FROM r.customer_nr""",
    "lkp_first_wins": "SELECT role, currency, code, first_key FROM owners",
    "lkp_last_wins": "SELECT role, currency, code, last_risk_in FROM owners",
    "lkp_fallback_sector": f"SELECT a.*, {sector_owner('a')} AS key FROM accounts a",
    "lkp_fallback_country": f"SELECT a.*, {country_owner('a')} AS risk_in FROM accounts a",
    "pos_category": "SELECT seq, ale, rca_mtm_negative, category FROM coded",
    "pos_country": "SELECT seq, customer_nr, domicile, vis_country FROM coded",
    "pos_sector": "SELECT seq, ale, category, rv_rel_party_type, vis_sector FROM coded",
    "pos_key": "SELECT seq, key FROM enriched",
    "pos_source_class": "SELECT seq, ide_linkage_type, rv_coa, source_class FROM coded",
    "pos_deal_code": "SELECT seq, source_class, deal_type, deal_code FROM coded",
    "pos_interest_code": "SELECT seq, deal_code, interest_code FROM enriched",
    "pos_valuation_code": "SELECT seq, deal_code, rca_mtm_negative, rca_mtm_positive, valuation_code FROM enriched",
    "pos_nationality": "SELECT seq, nationality, domicile, nationality_derived FROM coded",
    "pos_maturity_code": "SELECT seq, source_table, deal_code, rv_mat_remaining, rv_mat_remaining_derived FROM enriched",
    "pos_risk_transfer": "SELECT seq, customer_nr, ide_linkage_ref, risk_in, risk_transfer FROM risk",
    "pos_risk_sector": "SELECT seq, ide_linkage_ref, source_system, risk_in_sector FROM risk",
    "pos_enriched": "SELECT * EXCLUDE (tfi_id) FROM risk",
    "gl_enriched": "SELECT ap_code, ap_name, prod_code, ccy, rv_coa, ale, g, derivatives, amount FROM gl",
    "rmd_register": "SELECT * EXCLUDE (check_country, check_type) FROM register",
    "rmd_period_check": """SELECT seq, ide_linkage_ref, this_country, last_country, check_country, this_type, last_type, check_type
FROM register""",
    "facility_enriched": "SELECT facility_nr, customer_nr, ap_code, guarantee, domicile, risk_country, obs_amount FROM fac",
    "dq_duplicates": "SELECT * EXCLUDE (tfi_id) FROM dups",
    "dq_dedup_keep": "SELECT * EXCLUDE (tfi_id) FROM dedup",
    "dq_duplicate_sets": """SELECT seq, customer_nr, currency, rv_coa, value_date, rca_bookv FROM positions
QUALIFY count(*) OVER (PARTITION BY customer_nr, currency, rv_coa, value_date) > 1""",
    "dq_duplicate_log_merge": """SELECT * EXCLUDE (tfi_id, seq) FROM dups UNION SELECT * EXCLUDE (tfi_id, seq) FROM dups
WHERE currency = 'AUD'""",
    "dq_position_issues": """SELECT seq, vis_sector, valuation_code, rca_bookv, rca_mtm_negative, log_reason, record_action FROM issues""",
    "dq_register_issues": """SELECT seq, ide_linkage_ref, check_country, check_type, 'False check flag found' AS log_reason,
  '' AS record_action FROM register WHERE check_country = 'false' OR check_type = 'false'""",
    "rev_status_default": f"SELECT {LOGGED}, log_reason, record_action, 'PENDING' AS status FROM issues",
    "rev_delete": f"""SELECT {LOGGED} FROM data d WHERE NOT EXISTS (SELECT 1 FROM log l WHERE lower(l.record_action) = 'delete'
  AND {_KEYS_OF})""",
    "rev_apply_actions": _acted(_KEYS_OF),
    "rev_apply_actions_all_columns": f"""SELECT {ENRICHED} FROM enriched d WHERE NOT EXISTS (SELECT 1 FROM todo_all l
WHERE act IN ('delete', 'update') AND l.seq = d.seq AND {_ALL_OF})
UNION ALL SELECT {ENRICHED} FROM todo_all WHERE act IN ('update', 'insert')""",
    "rev_status": f"""SELECT {LOGGED}, log_reason, record_action, CASE WHEN lower(coalesce(record_action, ''))
  IN ('delete', 'update', 'insert') THEN 'DONE' ELSE status END AS status FROM log""",
    "rec_gl_pivot": f"SELECT {REC_KEYS}, {_doubles('total')}, ale_opposite FROM gl_pivot",
    "rec_gl_full": f"SELECT {REC_KEYS}, ale_opposite, diff_desc, key, vis_country, risk_in, {_doubles(_REC)} FROM rec",
    "rec_gl_bookv": f"SELECT {REC_KEYS}, ale_opposite, {_doubles('rca_bookv')} FROM rec_measures",
    "rec_gl_measures": f"SELECT {REC_KEYS}, {_doubles('rca_accrint rca_deferred_fee rca_mtm')} FROM rec_measures",
    "rec_gl_diff": f"SELECT {REC_KEYS}, {_doubles('rt30_total total diff')}, diff_desc FROM rec_diff",
    "rec_gl_impact": f"SELECT {REC_KEYS}, {_doubles('impact_a impact_l')} FROM rec_measures",
    "rec_gl_adjustment": f"SELECT {REC_KEYS}, {_doubles('total adjustment')} FROM adjusted",
    "rec_gl_breaks": f"""SELECT {REC_KEYS}, ale_opposite, diff_desc, key, vis_country, risk_in, {_doubles(_REC)} FROM rec
WHERE diff IS NULL OR round_even(diff, 0) <> 0""",
    "rec_off_balance": f"SELECT guarantee, line, ccy, {_doubles('ledger_sum facility diff')} FROM ob",
    "rec_derivatives": f"""SELECT grp AS "group", line, code, name, {_doubles('rca_mtm dm010 diff')} FROM derivative_lines
UNION ALL SELECT grp, 99, 'TOTAL', NULL, NULL, NULL, CAST(sum(diff) AS DOUBLE) FROM derivative_lines GROUP BY grp""",
    "rpt_assets_core": f"SELECT {_LINES}{_doubles('loans securities other total')} FROM asset_lines",
    "rpt_assets": f"""SELECT {_LINES}{_doubles('loans securities other total adjustment')} FROM asset_lines r LEFT JOIN key_adj k
ON k.side = 'A' AND k.key = concat_ws('|', report_ccy, vis_sector, vis_country)""",
    "rpt_liabilities": f"""SELECT {_LINES}{_doubles('loans issues_le_1y issues_gt_1y issues other total adjustment')} FROM liability_lines r
LEFT JOIN key_adj k ON k.side = 'L' AND k.key = concat_ws('|', report_ccy, vis_sector, vis_country)""",
    "rpt_gl_adjustment": f"SELECT side, key, {_doubles('adjustment')} FROM key_adj",
    "rpt_b_exposure": f"""SELECT country, {', '.join(dbl(f'{v}.x', n) for n, v in (
        ('here_total', 'x_here'), ('risk_total', 'x_risk'), ('c_outward', 'x_c_outward'), ('c_inward', 'x_c_inward')))}
FROM (SELECT vis_country AS country FROM risk WHERE ale IN ('A', 'OB') UNION SELECT risk_in FROM risk WHERE ale IN ('A', 'OB')) c
LEFT JOIN x_here USING (country) LEFT JOIN x_risk USING (country) LEFT JOIN x_c_outward USING (country)
LEFT JOIN x_c_inward USING (country) WHERE country IS NOT NULL""",
    "rpt_b_part_a": _part(A_COLUMNS), "rpt_b_part_b": _part(B_COLUMNS), "rpt_b_part_c": _part(C_COLUMNS),
    "rpt_b_part_d": _part(D_COLUMNS), "rpt_b_part_e": _part(E_COLUMNS), "rpt_b_part_e_adj": _part(E_ADJ_COLUMNS, "wide_adj"),
    "rpt_b_wide": f"SELECT country, country_name, {_doubles(ALL_COLUMNS)} FROM wide_adj",
    "rpt_b_scaled": _scaled(),
}


# the runs work on the feed: what the reports call positions is what the run before left
_AFTER_FIRST = {"positions": "SELECT * FROM dedup"}
_AFTER_ACTIONS = {"positions": "SELECT * FROM dedup WHERE NOT coalesce(currency = 'AUD' AND ide_linkage_type = '1', false)"}
RUNS: dict[str, tuple[str, dict[str, str]]] = {
    "run_initial_positions": ("SELECT * EXCLUDE (tfi_id) FROM positions", _AFTER_FIRST),
    "run_initial_register": (FINAL["rmd_register"], _AFTER_FIRST),
    "run_initial_duplicates": (FINAL["dq_duplicate_log_merge"], {}),
    "run_initial_position_log": (FINAL["dq_position_issues"], _AFTER_FIRST),
    "run_review_positions": (FINAL["pos_enriched"], _AFTER_FIRST),
    "run_final_assets": (FINAL["rpt_assets"], _AFTER_ACTIONS),
    "run_final_country": (FINAL["rpt_b_wide"], _AFTER_ACTIONS),
    "run_final_position_log": ("""SELECT seq, risk_in, 'delete' AS record_action, 'DONE' AS status FROM risk
WHERE currency = 'AUD' AND ide_linkage_type = '1'""", _AFTER_FIRST),
}
_COUNTS = f"""SELECT 'duplicates: rows' AS what, count(*) AS n FROM ({FINAL['dq_duplicate_log_merge']}) GROUP BY ALL
UNION ALL SELECT 'positions_log: issue: ' || log_reason, count(*) FROM issues GROUP BY ALL
UNION ALL SELECT 'register_log: issue: ' || log_reason, count(*) FROM ({FINAL['dq_register_issues']}) GROUP BY ALL
UNION ALL SELECT 'after_review: issue: ' || log_reason, count(*) FROM log_all GROUP BY ALL
UNION ALL SELECT 'after_review: action: ' || lower(coalesce(record_action, '')) || ', ' || status, count(*) FROM log_all GROUP BY ALL"""
RUNS["run_initial_counts"] = (_COUNTS, _AFTER_FIRST)
RUNS.update({name: (body, _AFTER_ACTIONS) for name, body in {
    "run_difference_positions": FINAL["pos_enriched"], "run_difference_register": FINAL["rmd_register"],
    "run_difference_measures": f"SELECT {REC_KEYS}, {_doubles('rca_bookv rca_accrint rca_deferred_fee rca_mtm')} FROM rec_measures",
    "run_difference_owners": "SELECT role, currency, code, first_key, last_risk_in FROM owners"}.items()})
_FALSE = "FROM register WHERE check_country = 'false' OR check_type = 'false'"
_REGISTER_LOG = "this_country, this_type, check_country, check_type, 'False check flag found' AS log_reason, '' AS record_action"
RUNS["run_review_register_log"] = (f"""SELECT seq, ide_linkage_ref, CASE WHEN ide_linkage_ref IS NOT NULL THEN
  CAST(round_even(sum({m('rca_bookv')}) OVER (PARTITION BY ide_linkage_ref), 1) AS DOUBLE) END AS rca_bookv, {_REGISTER_LOG}, 'PENDING' AS status
{_FALSE} UNION ALL SELECT seq, ide_linkage_ref, rca_bookv, {_REGISTER_LOG}, NULL {_FALSE}""", _AFTER_FIRST)
RUNS["run_review_start"] = ("""SELECT log_reason, 'PENDING' AS status, count(*) AS n, 'raw' AS begins_with FROM issues GROUP BY ALL""", _AFTER_FIRST)
FINAL["dq_duplicate_log_grown"] = FINAL["dq_duplicate_log_merge"]
FINAL["map_written_counts"] = FINAL["map_lookup_unmatched"]
FINAL["map_prepared_lookups"] = FINAL["map_reloaded_lookups"]
FINAL["rpt_saved_in_order"] = f"""SELECT *, row_number() OVER (ORDER BY report_ccy, vis_sector, vis_country)::INT AS line
FROM ({FINAL['rpt_assets_core']})"""
_JOB = "ale, cat_asset, report_ccy, sector_by_party, class_by_link"
FINAL["job_mapped_positions"] = f"SELECT 'parquet' AS source, seq, {_JOB} FROM mapped UNION ALL SELECT 'table', seq, {_JOB} FROM mapped"
FINAL.update({name: body for name, (body, _) in RUNS.items()})


def _body(name: str, instead: dict[str, str]) -> str:
    if name in instead:
        return instead[name]
    if name in BODIES or name.startswith("d_"):
        return re.sub(r"<(\w+)>", r"\1", duckdb_body(name))
    return V[name]


def _mentioned(body: str) -> list[str]:
    """The views a text names, in order. Names are matched where a table can stand."""
    found = re.findall(r"\b(?:FROM|JOIN)\s+\(?\s*([a-z_0-9]+)\b", body)
    found += [n for n in re.findall(r"\b([a-z_0-9]+) [a-z]\b", body)]
    return [n for n in dict.fromkeys(found) if (n in BODIES or n in V) and n not in BASE_SCHEMAS]


def _needed(body: str, out: list[str], instead: dict[str, str]) -> None:
    for name in _mentioned(body):
        if name not in out:
            _needed(_body(name, instead), out, instead)
            out.append(name)


def oracle_query(name: str) -> str:
    instead = RUNS[name][1] if name in RUNS else {}
    steps: list[str] = []
    _needed(FINAL[name], steps, instead)
    # the runs name some steps many times: each is computed once
    kept = "MATERIALIZED " if name in RUNS else ""
    ctes = ", ".join(f"{step} AS {kept}({_body(step, instead)})" for step in steps)
    return f"WITH {ctes} {FINAL[name]}" if ctes else FINAL[name]
