"""Which lookups enrich which table, in order."""

from returnsmith.operators.lookup import Lookup

POSITION_CHAIN = (
    Lookup("category", {"rv_coa": "coa"}, {"ale": "ale", "cat_asset": "cat_asset", "cat_liability": "cat_liability",
                                           "cat_off_asset": "cat_off_asset", "cat_off_liability": "cat_off_liability"}),
    Lookup("ccy", {"rv_currency_sub_group": "currency_group"}, {"report_ccy": "report_ccy"}),
    Lookup("sector", {"rv_cpty_type": "party_type"}, {"sector": "sector_by_party"}),
    Lookup("sector", {"rv_rel_party_type": "party_type"}, {"sector": "sector_by_related"}),
    Lookup("source_class", {"ide_linkage_type": "linkage_type", "rv_coa": "coa"}, {"source_class": "class_by_coa"}),
    Lookup("source_class", {"ide_linkage_type": "linkage_type"}, {"source_class": "class_by_link"}),
)

# asked with the account code the row rules derive
ACCOUNT_CHAIN = (
    Lookup("interest", {"deal_code": "principal_code"}, {"interest_code": "interest_found"}),
    Lookup("valuation", {"deal_code": "exposure_code"},
           {"positive_code": "account_if_positive", "negative_code": "account_if_negative"}),
    Lookup("on_demand", {"deal_code": "ap_code"}, flag="is_on_demand"),
)

LEDGER_CHAIN = (
    Lookup("account", {"ap_code": "ap_code"}, {"coa": "rv_coa"}),
    Lookup("guarantee", {"ap_code": "deal_type"}, {"guarantee": "guarantee"}),
    Lookup("category", {"rv_coa": "coa"}, {"ale": "ale"}),
    Lookup("valuation", {"ap_code": "positive_code"}, {"positive_code": "positive_code"}),
    Lookup("valuation", {"ap_code": "negative_code"}, {"negative_code": "negative_code"}),
)

REGISTER_CHAIN = (
    Lookup("register_now", {"ide_linkage_ref": "deal_id"}, {"country": "this_country", "type": "this_type"}),
    Lookup("register_last", {"ide_linkage_ref": "deal_id"}, {"country": "last_country", "type": "last_type"}),
)

FACILITY_CHAIN = (
    Lookup("guarantee", {"ap_code": "deal_type"}, {"guarantee": "guarantee_found"}),
    Lookup("register", {"customer_nr": "customer_nr"}, {"this_country": "registered"}, null_safe=True),
)
