"""Column types of the domain tables.

Identifiers are text (leading zeros and codes survive), amounts are double as
delivered, coded maturities are integers, dates are dates. ``seq`` is the row order
of the producer: every "first wins" / "last wins" rule reads it.
"""

from __future__ import annotations

from pyspark.sql.types import (DataType, DateType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType)

TEXT, AMOUNT, CODE, DAY, ORDER = StringType(), DoubleType(), IntegerType(), DateType(), LongType()


def _table(*parts: tuple[DataType, str]) -> StructType:
    return StructType([StructField(name, kind) for kind, names in parts for name in names.split()])


POSITIONS = _table(
    (TEXT, "ide_internal_party_ref ide_linkage_ref ide_linkage_type ide_sourcesys_ref"),
    (CODE, "lot_type_fk"),
    (AMOUNT, "rca_accrint rca_bookv rca_marketv rca_prov_coll rca_prov_indi"),
    (TEXT, "rv_coa rv_cpty_type rv_rel_party_type rv_currency_sub_group"),
    (CODE, "rv_mat_original rv_mat_remaining"),
    (AMOUNT, "rca_deferred_fee rca_mtm_negative rca_mtm_positive"),
    (TEXT, "entity deal_id customer_nr nationality domicile customer_legal_name deal_type currency "
           "tfi_id source_table"),
    (DAY, "value_date maturity_date"),
    (TEXT, "source_system"),
)

LEDGER = _table(
    (DAY, "date"),
    (TEXT, "entity dbu_obu state organisation_code resp_center deal_id ap_code ap_name sub_code prod_code "
           "a_l_e mgt_item source_system p1 p2 p3 p4 control_type control_dept office p_dept currency"),
    (AMOUNT, "original_amount aud_equivalent yearly_average_balance_ori yearly_average_balance_aud "
             "monthly_average_balance_ori monthly_average_balance_aud last_mth_end_ytd_ori "
             "last_mth_end_ytd_aud last_year_end_ytd_ori last_year_end_ytd_aud "
             "last_year_mth_end_ytd_ori last_year_mth_end_ytd_aud budget"),
)

FACILITY = _table(
    (TEXT, "entity facility_nr customer_nr customer_legal_name deal_type currency"),
    (AMOUNT, "obs_amount"),
    (TEXT, "counterparty_type domicile source_system"),
)

REGISTER = _table(
    (TEXT, "ide_linkage_ref customer_nr vis_sector ide_sourcesys_ref"),
    (AMOUNT, "rca_bookv"),
    (TEXT, "customer_legal_name nationality domicile this_country this_type last_country last_type"),
)

# text the source systems use for "no value"; 'NA' is a real marker and stays (fixed values)
NULL_TOKENS = ("-1.#IND", "1.#QNAN", "1.#IND", "-1.#QNAN", "#N/A N/A", "#N/A", "N/A", "n/a", "<NA>",
               "#NA", "NULL", "null", "NaN", "-NaN", "nan", "-nan", "None", "")

MEASURES = ("rca_accrint", "rca_bookv", "rca_marketv", "rca_prov_coll", "rca_prov_indi",
            "rca_deferred_fee", "rca_mtm_negative", "rca_mtm_positive")
