"""The driver's test tables seen as domain tables.

Every body below is SQL both Spark and DuckDB run; only the day count differs. The Spark
queries and their SQL twins thus start from the same rows, and everything after that is
computed independently.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from returnsmith.operators.lookup import inline_table
from returnsmith.schemas import LEDGER, POSITIONS
from returnsmith.session import drop_settled, settle

AS_OF, ENTITY, LOT = "1998-07-31", "106", 992
COUNTRY_CODES = "AUCNUSGBSGHKJPDEFRNZKRINIDTHMYPHVNTWCAMXBRZAAEXXNL"
COUNTRY = f"substr('{COUNTRY_CODES}', 2 * c_nationkey + 1, 2)"
CURRENCY = ("CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'AUD' WHEN '2' THEN 'USD' WHEN '3' THEN 'CNY' "
            "WHEN '4' THEN 'EUR' ELSE 'GBP' END")

# no rounding involved, as the days left over are taken first
TENOR_CODE = """CASE WHEN tenor_days >= 1825 THEN 1060000 + tenor_days % 365
  ELSE 1000000 + 1000 * CAST((tenor_days - tenor_days % 30) / 30 AS INT) + tenor_days % 365 END"""

_LEDGER_SET = {
    "date": "last_day(CAST(o_orderdate AS DATE))", "entity": "'106'", "ap_code": """
      CASE o_orderkey % 14 WHEN 0 THEN '7211' WHEN 1 THEN '7271' WHEN 2 THEN '7121' WHEN 3 THEN '8211' WHEN 4 THEN '8311'
       WHEN 5 THEN '8475' WHEN 6 THEN '7448' WHEN 7 THEN '8578' WHEN 8 THEN '7451' WHEN 9 THEN '8453' WHEN 10 THEN '7444'
       WHEN 11 THEN '8801' WHEN 12 THEN '6101' ELSE '6201' END""",
    "ap_name": "CASE WHEN o_orderkey % 14 = 4 THEN NULL ELSE o_orderstatus END",
    "prod_code": "CASE o_orderstatus WHEN 'O' THEN '6108' WHEN 'F' THEN '6114' ELSE NULL END",
    "source_system": "CASE o_orderkey % 7 WHEN 0 THEN '777' WHEN 1 THEN NULL ELSE '022' END",
    "currency": CURRENCY,
    "aud_equivalent": "CASE WHEN o_orderkey % 14 IN (0,1,2,6,8,10) THEN -o_totalprice ELSE o_totalprice END",
}
_KINDS = {"string": "STRING", "double": "DOUBLE", "date": "DATE"}
_LEDGER_COLUMNS = ", ".join(
    f"{_LEDGER_SET.get(f.name) or f'CAST(NULL AS {_KINDS[f.dataType.simpleString()]})'} AS {f.name}"
    for f in LEDGER.fields)


def _valuation(deal_kind: int) -> str:
    body = ("SELECT deal_id, entity, '{sort}' AS valuation_type, concat('V', substr(currency, 2, 2)) AS currency, "
            "CASE status WHEN 'F' THEN DATE '" + AS_OF + "' ELSE DATE '1998-06-30' END AS valuation_date "
            "FROM <deals> WHERE kind = " + str(deal_kind) + " AND flag IN ({flags})")
    return (body.format(sort="ORI MTM_POSITIVE", flags="'A', 'R'") + " UNION ALL "
            + body.format(sort="ORI MTM_NEGATIVE", flags="'R'"))


def _deal_kind(kind: int, more: str = "") -> str:
    return f"SELECT * FROM <deals> WHERE kind = {kind}{more}"


def _register(statuses: str, shift: int) -> str:
    return f"""
SELECT o_orderkey AS seq, CAST(o_orderkey AS STRING) AS deal_id,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL
       ELSE substr('{COUNTRY_CODES}', 2 * CAST((o_orderkey + {shift}) % 25 AS INT) + 1, 2) END AS country,
  CASE o_orderkey % 2 WHEN 0 THEN 'Non-financial corporations' ELSE 'Banking: other banks' END AS type
FROM <orders> WHERE o_orderstatus IN ({statuses})"""


# name -> body; <x> is a driver table or another body
_POSITION_NAMES = ", ".join(POSITIONS.names)
_COPY = 10 ** 16  # above every row number
# what the positions are joined from; the Spark side joins the same tables in another order
JOINED = ("<lineitem> JOIN <orders> ON o_orderkey = l_orderkey JOIN <customer> ON c_custkey = o_custkey "
          "JOIN <part> ON p_partkey = l_partkey")

BODIES = {
    "position_rows": f"""
SELECT '106' AS ide_internal_party_ref,
  CASE WHEN l_linenumber = 2 THEN concat('7211', CAST(l_orderkey AS STRING)) ELSE CAST(l_orderkey AS STRING) END AS ide_linkage_ref,
  CASE l_linenumber WHEN 1 THEN '1' WHEN 2 THEN '2' WHEN 3 THEN '8' WHEN 4 THEN '9' WHEN 5 THEN '10' WHEN 6 THEN '11' ELSE '12' END AS ide_linkage_type,
  CASE l_suppkey % 3 WHEN 0 THEN '2' WHEN 1 THEN '002' ELSE '022' END AS ide_sourcesys_ref,
  992 AS lot_type_fk,
  l_extendedprice * l_tax AS rca_accrint,
  CASE WHEN l_linenumber IN (3,4,6) THEN 0.0e0 ELSE l_extendedprice END AS rca_bookv,
  l_extendedprice * (1 - l_discount) AS rca_marketv,
  0.0e0 AS rca_prov_coll, 0.0e0 AS rca_prov_indi,
  CASE WHEN l_linenumber IN (3,4,6) THEN 'OBS-DERV' WHEN p_type = 'ECONOMY' THEN 'BLS-AST-LOANS-PLAIN'
       WHEN p_type = 'STANDARD' THEN 'BLS-AST-LOANS-TF' WHEN p_type = 'PROMO' THEN 'BLS-AST-SEC'
       WHEN p_type = 'SMALL' THEN 'BLS-LIA-DEP' WHEN p_type = 'MEDIUM' THEN 'BLS-LIA-SEC'
       WHEN l_linenumber = 7 THEN 'BLS-LIA-OTHER' ELSE 'BLS-AST-OTHER' END AS rv_coa,
  c_mktsegment AS rv_cpty_type,
  CASE WHEN l_returnflag = 'R' THEN 'DE' WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'DEFAULT' ELSE c_mktsegment END AS rv_rel_party_type,
  {CURRENCY} AS currency,
  abs(DAYS(CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))) AS tenor_days,
  CASE WHEN l_linenumber = 7 THEN l_quantity * l_discount ELSE 0.0e0 END AS rca_deferred_fee,
  CASE WHEN l_linenumber NOT IN (3,4,6) THEN 0.0e0 WHEN l_returnflag = 'R' THEN -l_quantity
       WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN NULL ELSE 0.0e0 END AS rca_mtm_negative,
  CASE WHEN l_linenumber IN (3,4,6) AND l_returnflag = 'A' THEN l_quantity ELSE 0.0e0 END AS rca_mtm_positive,
  '106' AS entity, CAST(l_orderkey AS STRING) AS deal_id,
  CASE WHEN o_custkey % 97 = 0 THEN NULL WHEN o_custkey % 89 = 0 THEN 'NULL' ELSE CAST(o_custkey AS STRING) END AS customer_nr,
  CASE WHEN c_nationkey = 22 THEN NULL WHEN c_nationkey = 24 THEN 'YY' ELSE {COUNTRY} END AS nationality,
  CASE WHEN c_nationkey = 21 THEN NULL WHEN c_nationkey = 20 THEN 'xx' ELSE {COUNTRY} END AS domicile,
  c_name AS customer_legal_name,
  concat('LDG', CASE WHEN l_linenumber IN (3,6) THEN '9001' WHEN l_linenumber = 4 THEN '9002'
       WHEN p_type = 'ECONOMY' THEN '7211' WHEN p_type = 'STANDARD' THEN '7271' WHEN p_type = 'PROMO' THEN '7121'
       WHEN p_type = 'SMALL' THEN '8211' WHEN p_type = 'MEDIUM' THEN '8311' ELSE '8754' END) AS deal_type,
  CASE WHEN l_linenumber = 7 THEN 'FASM' WHEN l_linenumber IN (3,4,6) THEN 'swap' ELSE 'loan' END AS source_table,
  CAST(o_orderdate AS DATE) AS value_date, CAST(l_shipdate AS DATE) AS maturity_date,
  CASE l_suppkey % 3 WHEN 0 THEN '2' WHEN 1 THEN '002' ELSE 'fee' END AS source_system,
  CAST(((l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey) * 64 + l_quantity AS BIGINT) AS seq
FROM <lineitem> JOIN <orders> ON o_orderkey = l_orderkey JOIN <customer> ON c_custkey = o_custkey JOIN <part> ON p_partkey = l_partkey""",

    "position_base": f"""
SELECT ide_internal_party_ref, ide_linkage_ref, ide_linkage_type, ide_sourcesys_ref, lot_type_fk, rca_accrint, rca_bookv,
  rca_marketv, rca_prov_coll, rca_prov_indi, rv_coa, rv_cpty_type, rv_rel_party_type, currency AS rv_currency_sub_group,
  CAST({TENOR_CODE} AS INT) AS rv_mat_original, CAST({TENOR_CODE} AS INT) AS rv_mat_remaining, rca_deferred_fee, rca_mtm_negative, rca_mtm_positive,
  entity, deal_id, customer_nr, nationality, domicile, customer_legal_name, deal_type, currency,
  CAST(NULL AS STRING) AS tfi_id, source_table, value_date, maturity_date, source_system, seq
FROM <position_rows>""",

    "positions": "SELECT * FROM <position_base>",

    # the feed as delivered: some positions again under another customer or none, some as they are
    "feed": f"""
SELECT {_POSITION_NAMES}, seq FROM <position_base>
UNION ALL SELECT {_POSITION_NAMES.replace("customer_nr", "CASE WHEN seq % 3 = 0 THEN NULL ELSE '9' || customer_nr END AS customer_nr")},
  seq + {_COPY} FROM <position_base> WHERE seq % 7 = 0
UNION ALL SELECT {_POSITION_NAMES}, seq + 2 * {_COPY} FROM <position_base> WHERE seq % 5 = 0""",

    "ledger": f"SELECT {_LEDGER_COLUMNS} FROM <orders>",

    "facility": f"""
SELECT '106' AS entity, CAST(o_orderkey AS STRING) AS facility_nr, CAST(o_custkey AS STRING) AS customer_nr,
  c_name AS customer_legal_name,
  concat('FAC', CASE o_orderkey % 3 WHEN 0 THEN '6101' WHEN 1 THEN '6201' ELSE '6301' END) AS deal_type,
  {CURRENCY} AS currency, o_totalprice AS obs_amount, c_mktsegment AS counterparty_type,
  CASE WHEN c_nationkey = 21 THEN NULL ELSE {COUNTRY} END AS domicile, CAST(NULL AS STRING) AS source_system
FROM <orders> JOIN <customer> ON c_custkey = o_custkey""",

    "register_now": _register("'F', 'P'", 0),
    "register_last": _register("'F', 'O'", 1),

    "country": f"""
SELECT CAST(n_nationkey AS BIGINT) AS seq, substr('{COUNTRY_CODES}', 2 * n_nationkey + 1, 2) AS country,
  n_name AS country_name FROM <nation>""",

    # warehouse tables of the extraction layer
    "wh_customer": f"""
SELECT CAST(c_custkey AS STRING) AS customer_nr, c_name AS customer_legal_name,
  CASE WHEN c_nationkey = 3 THEN NULL ELSE c_mktsegment END AS customer_attribute1,
  CASE WHEN c_nationkey = 4 THEN NULL ELSE 'DE' END AS intercompany,
  CASE WHEN c_nationkey = 22 THEN NULL ELSE {COUNTRY} END AS nationality,
  CASE WHEN c_nationkey = 21 THEN NULL ELSE {COUNTRY} END AS domicile,
  DATE '1995-01-01' AS start_validity_date, DATE '1998-07-30' AS end_validity_date FROM <customer>
UNION ALL
SELECT CAST(c_custkey AS STRING), concat(c_name, ' v2'),
  CASE WHEN c_nationkey = 3 THEN NULL ELSE c_mktsegment END, CASE WHEN c_nationkey = 4 THEN NULL ELSE 'DE' END,
  CASE WHEN c_nationkey = 22 THEN NULL ELSE {COUNTRY} END, CASE WHEN c_nationkey = 21 THEN NULL ELSE {COUNTRY} END,
  DATE '1998-07-31', DATE '9999-12-31' FROM <customer> WHERE c_acctbal >= 0""",

    "deals": f"""
SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS deal_id,
  CASE WHEN o_orderpriority = '5-LOW' THEN '107' ELSE '106' END AS entity, CAST(o_custkey AS STRING) AS customer_nr,
  l_linenumber AS kind, l_returnflag AS flag, l_linestatus AS status, concat('LDG', CAST(7210 + l_linenumber AS STRING)) AS deal_type,
  {CURRENCY} AS currency, CAST(l_partkey AS STRING) AS tfi_id, CAST(o_orderdate AS DATE) AS value_date,
  CAST(l_shipdate AS DATE) AS maturity_date, CAST(o_orderdate AS DATE) AS start_validity_date,
  CAST(l_shipdate AS DATE) AS end_validity_date, CASE l_returnflag WHEN 'N' THEN 'OTHER' ELSE 'FASM' END AS source_system,
  l_quantity AS quantity, l_extendedprice AS price, CASE WHEN l_tax = 0 THEN NULL ELSE l_extendedprice * l_tax END AS interest,
  CASE WHEN l_discount = 0 THEN 991 ELSE 992 END AS lot_type_fk
FROM <lineitem> JOIN <orders> ON o_orderkey = l_orderkey""",

    "wh_interest_account": _deal_kind(1, " AND status = 'F'"),
    "wh_loan": _deal_kind(1, " AND status = 'O'"),
    "wh_bond_deal": _deal_kind(5),
    "wh_forex": _deal_kind(4),
    "wh_option_deal": _deal_kind(6),
    "wh_swap": _deal_kind(3),
    "wh_fee": "SELECT *, 'BLS-LIA-OTHER' AS rv_coa FROM <deals> WHERE kind = 7",
    "wh_forex_valuation": _valuation(4),
    "wh_option_valuation": _valuation(6),
    "wh_swap_valuation": _valuation(3),
    "wh_bond": """
SELECT CAST(p_partkey AS STRING) AS tfi_id, CASE WHEN p_size < 40 THEN '106' ELSE '107' END AS object_origin,
  DATE '1995-01-01' AS start_validity_date, CASE WHEN p_type = 'PROMO' THEN DATE '1998-07-31' ELSE DATE '2005-12-31' END AS end_validity_date,
  CASE WHEN p_type = 'SMALL' THEN DATE '2000-02-29' ELSE DATE '2003-06-15' END AS maturity_date FROM <part>""",
    "wh_option": """
SELECT CAST(p_partkey AS STRING) AS tfi_id, DATE '1998-07-31' AS start_validity_date, DATE '2005-12-31' AS end_validity_date,
  CASE WHEN p_type = 'SMALL' THEN DATE '2000-02-29' ELSE DATE '2003-06-15' END AS maturity_date FROM <part> WHERE p_type <> 'LARGE'""",
    "wh_back_office_balance": f"""
SELECT deal_id, entity, customer_nr, substr(deal_type, 4, 4) AS element6, currency,
  CASE status WHEN 'F' THEN DATE '{AS_OF}' ELSE DATE '1998-06-30' END AS balance_date FROM <deals> WHERE kind = 2""",
    "wh_fee_valuation": f"""
SELECT deal_id, CASE flag WHEN 'A' THEN 'DEFERRED_FEE' ELSE 'OTHER' END AS valuation_type, quantity AS amount,
  DATE '{AS_OF}' AS valuation_date FROM <deals> WHERE kind = 7 AND status = 'F'""",
    "wh_records_on_balance": """
SELECT entity AS ide_internal_party_ref, deal_id AS ide_linkage_ref,
  CASE kind WHEN 1 THEN '1' WHEN 2 THEN '2' WHEN 3 THEN '8' WHEN 4 THEN '4' WHEN 5 THEN '10' WHEN 6 THEN '11' ELSE '12' END AS ide_linkage_type,
  CASE WHEN flag = 'A' THEN '022' WHEN flag = 'R' THEN '  ' WHEN status = 'O' THEN NULL ELSE '2' END AS ide_sourcesys_ref,
  CASE status WHEN 'F' THEN '' ELSE 'x' END AS ide_internal_one, lot_type_fk, interest AS rca_accrint, price AS rca_bookv,
  CAST(NULL AS DOUBLE) AS rca_marketv, CAST(NULL AS DOUBLE) AS rca_prov_coll, 1.5e0 AS rca_prov_indi, 'BLS-AST-OTHER' AS rv_coa,
  'HOUSEHOLD' AS rv_cpty_type, 'DE' AS rv_rel_party_type, currency AS rv_currency_sub_group, CAST(NULL AS INT) AS rv_mat_original,
  1003000 AS rv_mat_remaining, quantity AS rca_deferred_fee FROM <deals>""",
    "wh_records_derivative": """
SELECT entity AS ide_internal_party_ref, deal_id AS ide_linkage_ref,
  CASE kind WHEN 3 THEN '8' WHEN 4 THEN '9' ELSE '11' END AS ide_linkage_type, '022' AS ide_sourcesys_ref, lot_type_fk,
  CASE WHEN flag = 'R' THEN -quantity ELSE 0.0e0 END AS rca_mtm_negative, CASE WHEN flag = 'A' THEN quantity ELSE 0.0e0 END AS rca_mtm_positive,
  'OBS-DERV' AS rv_coa_deriv, CASE WHEN flag = 'N' THEN NULL ELSE 1012000 END AS rv_mat_remaining, 'HOUSEHOLD' AS rv_cpty_type,
  'DE' AS rv_rel_party_type FROM <deals> WHERE kind IN (3, 4, 6)""",
    "wh_facility": f"""
SELECT '106' AS entity, CAST(o_orderkey AS STRING) AS facility_nr, CAST(o_custkey AS STRING) AS customer_nr,
  concat('FAC', CASE o_orderkey % 3 WHEN 0 THEN '6101' WHEN 1 THEN '6201' ELSE '6301' END) AS deal_type, {CURRENCY} AS currency,
  o_totalprice AS ccy_amount, CAST(NULL AS STRING) AS source_system, CAST(o_orderdate AS DATE) AS start_validity_date,
  CASE o_orderstatus WHEN 'O' THEN DATE '{AS_OF}' ELSE DATE '9999-12-31' END AS end_validity_date FROM <orders>""",
    "wh_facility_valuation": f"""
SELECT CAST(o_orderkey AS STRING) AS facility_nr, CASE o_orderstatus WHEN 'F' THEN 'OTHER' ELSE 'OBS Commitment' END AS valuation_type,
  o_totalprice / 4 AS amount, CASE WHEN o_orderpriority = '1-URGENT' THEN DATE '1998-06-30' ELSE DATE '{AS_OF}' END AS valuation_date FROM <orders>""",
}

# small lookup tables: columns, rows; all text, '' for blank; seq is the row order
DIM_ROWS = {
    "category": ("coa ale cat_asset cat_liability cat_off_asset cat_off_liability", [
        ("BLS-AST-LOANS-PLAIN", "A", "(4)", "", "", ""), ("BLS-AST-LOANS-TF", "A", "(4)", "", "", ""),
        ("BLS-AST-SEC", "A", "(5)", "", "", ""), ("BLS-AST-OTHER", "A", "(6)", "", "", ""),
        ("BLS-LIA-DEP", "L", "", "(4)", "", ""), ("BLS-LIA-SEC", "L", "", "(7)", "", ""),
        ("BLS-LIA-OTHER", "L", "", "(8)", "", ""), ("OBS-DERV", "OB", "", "", "(6)", "(8)")]),
    "ccy": ("currency_group report_ccy", [
        ("AUD", "AUD"), ("USD", "USD"), ("EUR", "EUR"), ("GBP", "GBP"), ("CNY", "OTH"), ("AUD", "DUP")]),
    "sector": ("party_type sector", [
        ("BUILDING", "Banking: central bank"), ("AUTOMOBILE", "Banking: other banks"),
        ("MACHINERY", "Non-financial corporations"), ("HOUSEHOLD", "Households and non-profits"),
        ("DE", "Unallocated"), ("DEFAULT", "Unallocated")]),
    "source_class": ("linkage_type coa source_class", [
        ("1", "", "LOAN"), ("2", "", "BALANCE_BOC"), ("8", "", "IR_SWAP"), ("9", "", "FOREX"), ("11", "", "OPTION"),
        ("12", "", "FEE"), ("10", "BLS-AST-SEC", "BOND"), ("10", "BLS-AST-LOANS-PLAIN", "LOAN"),
        ("10", "BLS-AST-LOANS-TF", "LOAN"), ("10", "BLS-AST-OTHER", "LOAN"), ("10", "BLS-LIA-DEP", "LOAN"),
        ("10", "BLS-LIA-SEC", "LOAN")]),
    "interest": ("principal_code interest_code", [("7211", "7431"), ("7271", "7451"), ("8211", "8451")]),
    "valuation": ("exposure_code positive_code negative_code", [("9001", "7801", "8801"), ("9002", "7444", "8576")]),
    "on_demand": ("ap_code", [("7121",), ("8211",)]),
    "account": ("ap_code coa suffix_name", [
        ("7211", "BLS-AST-LOANS-PLAIN", "loans"), ("7271", "BLS-AST-LOANS-TF", "trade"), ("7121", "BLS-AST-SEC", "bonds"),
        ("7448", "BLS-AST-OTHER", "claims"), ("7451", "BLS-AST-OTHER", "interest"), ("8211", "BLS-LIA-DEP", "deposits"),
        ("8311", "BLS-LIA-SEC", "issues"), ("8475", "BLS-LIA-OTHER", "fees"), ("8578", "BLS-LIA-OTHER", "payables"),
        ("8453", "BLS-LIA-OTHER", "interest"), ("7444", "OBS-DERV", "forward"), ("8801", "OBS-DERV", "swap"),
        ("7801", "OBS-DERV", "swap claim"), ("8576", "OBS-DERV", "forward debt")]),
    "guarantee": ("deal_type guarantee", [("6101", "G"), ("6201", "F"), ("6301", "")]),
}
DIM_TABLES = ("register_now", "register_last", "country")


BASE_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
              "o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
}


def refs(body: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"<(\w+)>", body)))


def in_order(*names: str) -> list[str]:
    """The bodies to define before the named ones, and those themselves."""
    out: list[str] = []
    for name in names:
        if name not in BASE_SCHEMAS:
            used = refs(BODIES[name]) if name in BODIES else []
            out += [n for n in [*in_order(*used), name] if n not in out]
    return out


class Warehouse(dict):
    """Warehouse tables by name, made when asked for."""

    def __init__(self, feed: Feed):
        self.feed = feed

    def __missing__(self, name: str) -> DataFrame:
        return self.feed.table("ledger" if name == "ledger_view" else f"wh_{name}")


class Feed:
    """The domain tables of one data folder, built on demand."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self._made = spark, folder, {}

    def once(self, name: str, make: Callable[[], DataFrame]):
        if name not in self._made:
            self._made[name] = make()
        return self._made[name]

    def table(self, name: str) -> DataFrame:
        return self.once(f"<{name}>", lambda: self._make(name))

    def written(self, name: str) -> DataFrame:
        """The table written once, for what reads it several times: its joins are made once, and each read takes its own columns."""
        return self.once(f"written <{name}>", lambda: settle(self.table(name), name))

    def drop_feed(self) -> None:
        """Drop the positions that the feed was read from, once all that was made of it is written; who asks for either again has them made anew."""
        self._made.pop("<feed>", None)
        if "written <positions>" in self._made:
            drop_settled(self._made.pop("written <positions>"))

    def _sold(self) -> DataFrame:
        """``JOINED`` in the order that shuffles the line items, by far the most rows, twice, and while they are narrow: of the
        supplier and the day of shipping they hold what ``position_rows`` takes of them."""
        ordered = self.table("orders").join(self.table("customer"), F.expr("c_custkey = o_custkey"))
        lines = self.table("lineitem").withColumns({"l_suppkey": F.expr("l_suppkey % 3"), "l_shipdate": F.expr("CAST(l_shipdate AS DATE)")})
        return (lines.join(self.table("part"), F.expr("p_partkey = l_partkey"))
                .join(ordered, F.expr("o_orderkey = l_orderkey")))

    def _delivered(self) -> DataFrame:
        """The body ``feed`` by one read of the positions, each of which comes once for every part of the union that takes it."""
        part = {1: "seq % 7 = 0", 2: "seq % 5 = 0"}
        times = (f"CASE WHEN {part[1]} AND {part[2]} THEN array(0L, 1L, 2L) WHEN {part[1]} THEN array(0L, 1L) "
                 f"WHEN {part[2]} THEN array(0L, 2L) ELSE array(0L) END")
        other = "CASE WHEN _part <> 1 THEN customer_nr WHEN seq % 3 = 0 THEN NULL ELSE '9' || customer_nr END AS customer_nr"
        rows = self.written("positions").selectExpr("*", f"explode({times}) AS _part")
        return rows.selectExpr(*[other if n == "customer_nr" else n for n in POSITIONS.names], f"seq + _part * {_COPY} AS seq")

    def _made_already(self, name: str) -> DataFrame:
        return self._sold() if name == "sold" else self.table(name)

    def _make(self, name: str) -> DataFrame:
        if name in BASE_SCHEMAS:
            return self.spark.read.schema(BASE_SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")
        if name == "feed":
            return self._delivered()
        steps = in_order(name)
        texts = {step: BODIES[step].replace(JOINED, "<sold>") for step in steps}
        base = {ref for text in texts.values() for ref in refs(text) if ref not in steps}
        bodies = {step: re.sub(r"<(\w+)>", lambda m: f"{{{m[1]}}}" if m[1] in base else m[1], text) for step, text in texts.items()}
        ctes = ", ".join(f"{step} AS ({body})" for step, body in bodies.items())
        sql = f"WITH {ctes} SELECT * FROM {name}".replace("DAYS(", "-datediff(")
        return self.spark.sql(sql, **{ref: self._made_already(ref) for ref in base})

    def rows(self, name: str) -> DataFrame:
        columns, rows = DIM_ROWS[name]
        return inline_table(self.spark, f"seq {columns}", [(i, *row) for i, row in enumerate(rows)])

    def dims(self) -> dict[str, DataFrame]:
        small = self.once("dims", lambda: {name: self.rows(name) for name in DIM_ROWS})
        return {**small, **{name: self.table(name) for name in DIM_TABLES}}

    def warehouse(self) -> Warehouse:
        return Warehouse(self)


def duckdb_body(name: str) -> str:
    """The body for the SQL twin: same text, day count as a date difference, plain names."""
    if name.startswith("d_"):
        columns, rows = DIM_ROWS[name[2:]]
        values = ", ".join("(" + ", ".join([str(i), *[f"'{v}'" for v in row]]) + ")" for i, row in enumerate(rows))
        return f"SELECT * FROM (VALUES {values}) t(seq, {columns.replace(' ', ', ')})"
    return re.sub(r"DAYS\((.*?AS DATE\)), ", r"(\1 - ", BODIES[name])
