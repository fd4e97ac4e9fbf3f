import pytest

from returnsmith.operators.lookup import inline_table
from returnsmith.plans import reconcile as rec
from returnsmith.plans import reports
from returnsmith.plans.register import build_register, refresh_register_log

SCHEMA = ("seq long, ale string, category string, report_ccy string, vis_sector string, vis_country string, key string, "
          "currency string, deal_code string, interest_code string, valuation_code string, rv_mat_remaining int, "
          "rv_mat_remaining_derived int, risk_in string, risk_transfer string, risk_in_sector string, rca_bookv double, "
          "rca_accrint double, rca_deferred_fee double, rca_marketv double, rca_mtm_negative double, rca_mtm_positive double, "
          "rca_prov_coll double, rca_prov_indi double")
DEFAULTS = dict(zip([c.split()[0] for c in SCHEMA.split(", ")], [
    1, "A", "(4)", "AUD", "Unallocated", "AU", "AUD|Unallocated|AU", "AUD", "7211", "7431", "NA", 1000500, 1000500, "AU", "N",
    "Unallocated", 100.0, 1.0, 2.0, 50.0, 0.0, 0.0, 0.0, 0.0]))


@pytest.fixture
def positions(spark):
    def make(*changes):
        return spark.createDataFrame([tuple({**DEFAULTS, **change}.values()) for change in changes], SCHEMA)
    return make


@pytest.fixture
def countries(spark):
    return inline_table(spark, "country country_name", [("AU", "Australia"), ("US", "States"), ("NZ", "Zealand")])


def figures(df):
    return {r.country: r.asDict() for r in df.collect()}


def test_exposure_and_countries_without_rows(positions):
    found = figures(reports.country_figures(positions(
        {}, {"deal_code": "8754"}, {"vis_country": "US", "rca_bookv": None, "rca_accrint": None, "rca_deferred_fee": None},
        {"vis_country": "NZ", "ale": "L"})))
    assert float(found["AU"]["here_total"]) == (100 - 2 + 1) + (100 - 200 - 2 + 1)
    assert float(found["US"]["here_total"]) == 0 and found["US"]["a_m3_12m"] is None
    assert "NZ" not in found and float(found["AU"]["risk_total"]) == -2


def test_sector_labels_overlap_as_stated(positions):
    found = figures(reports.country_figures(positions(
        {"vis_sector": "Banking: central bank"}, {"vis_sector": "Banking: central banks"}, {"vis_sector": None},
        {"vis_sector": "x General government"})))["AU"]
    assert (float(found["b_banking"]), float(found["b_central_banks"]), float(found["b_government"])) == (99, 198, 99)


def test_missing_ledger_difference_spreads(positions, countries, spark):
    rec_rows = spark.createDataFrame([("A", "AU", "k", 10.5, "7211")], "ale string, vis_country string, key string, diff double, ap_code string")
    facility = spark.createDataFrame([("G", "US", 5.0)], "guarantee string, risk_country string, obs_amount double")
    table = reports.country_report(positions({}, {"vis_country": "US"}), facility, rec_rows, countries)
    by_country = figures(reports.wide(table))
    assert by_country["AU"]["a_gl_adj"] == -10.0 and by_country["AU"]["a_total"] == 89.0
    assert by_country["US"]["a_total"] is None and by_country["US"]["a_le_3m"] is None
    assert by_country["NZ"]["c_net"] == 0 and by_country["US"]["e_guarantees"] == 5.0
    # without rows of its sector the ledger difference has nowhere to go, and the check shows it
    assert by_country["AU"]["b_non_financial"] is None and by_country["AU"]["b_check"] == -10.0
    parts = reports.scaled(table)
    assert set(parts) == set("abcde") and parts["e"].count() == 0


def test_report_totals_are_sums_of_parts(positions):
    rows = positions({}, {"category": "(5)"}, {"category": "(6)"}, {"ale": "OB", "category": "(6)", "rca_mtm_positive": 4.0},
                     {"ale": "L", "category": "(7)", "rv_mat_remaining": None}, {"vis_sector": None})
    line = reports.asset_lines(rows).collect()
    assert len(line) == 1
    assert [float(line[0][n]) for n in ("loans", "securities", "other", "total")] == [100, 50, 106, 256]
    debt = {r.issues: r for r in reports.liability_lines(rows).collect()}
    assert [float(v) for v in debt] == [0.0]
    assert reports.asset_lines(rows.where("ale = 'E'")).count() == 0


@pytest.mark.parametrize("values, rounded", [([0.25], 0.2), ([0.35], 0.4), ([-0.25], -0.2), ([0.1, 0.05], 0.2), ([0.15, 0.1], 0.2)])
def test_adjustment_rounds_half_to_even_both_signs(spark, values, rounded):
    rows = spark.createDataFrame([("L", "k", "1", -v) for v in values], "ale string, key string, ap_code string, d double")
    rows = rows.selectExpr("ale", "key", "ap_code", "CAST(d AS decimal(18,4)) AS diff")
    assert float(reports.key_adjustment(rows, "L").first().adjustment) == rounded


def test_reconciliation_rules(positions, spark):
    ledger = spark.createDataFrame([
        ("7211", "n", "AUD", "BLS-AST-X", "A", None, -90.0), ("7271", "n", "AUD", "BLS-AST-X", "A", None, 0.0),
        ("7448", "n", "AUD", "BLS-AST-X", "A", None, -5.0), ("8475", None, "AUD", None, "L", None, 2.0),
        ("8453", "n", "AUD", "OTHER", "L", None, 3.0), ("7451", "n", "AUD", "BLS-AST-X", "A", None, 1.0),
        ("7211", "n", None, "BLS-AST-X", "A", None, 4.0), ("9999", "n", "AUD", "BLS-AST-X", "A", "1", 4.0)],
        "ap_code string, ap_name string, ccy string, rv_coa string, ale string, derivatives string, aud_equivalent double")
    cells = rec.position_cells(positions(
        {"seq": 2, "key": "late"}, {"seq": 1, "key": "early", "risk_in": "US"}, {"seq": 3, "ale": "L", "risk_in": ""},
        {"seq": 4, "currency": None}, {"seq": 5, "deal_code": "7216", "risk_in": "NZ", "interest_code": None}))
    found = {(r.ap_code, r.ccy): r for r in rec.reconcile(ledger, cells).collect()}
    assert len(found) == 7
    main = found["7211", "AUD"]
    assert float(main.rca_bookv) == 200 - 100 and float(main.impact_a) == 102 and float(main.diff) == 10
    assert main.key == "early" and main.risk_in is None and main.vis_country == "ly"
    assert float(found["7271", "AUD"].adjustment) == -5 and float(found["7448", "AUD"].diff) == 0
    assert found["8475", "AUD"].diff_desc == "rt30 - mis" and float(found["8475", "AUD"].rca_deferred_fee) == 8
    assert found["8453", "AUD"].diff is None and found["8453", "AUD"].key == "AUD|Unallocated|AU"
    assert found["8453", "AUD"].risk_in == "NZ"
    assert float(found["7211", None].rca_bookv) == 0 and found["7211", None].key is None
    assert {r.ap_code for r in rec.gl_breaks(rec.reconcile(ledger, cells)).collect()} >= {"7211", "8453"}


def test_register_totals_cover_all_rows(spark, rows):
    columns = ("ide_linkage_ref string, customer_nr string, vis_sector string, ide_sourcesys_ref string, rca_bookv double, "
               "customer_legal_name string, nationality string, domicile string, rv_coa string, seq long")
    loans = spark.createDataFrame([
        ("r", "1", "s", " 2 ", 1.05, "n", "YY", "AU", "BLS-AST-LOANS-TF", 1), ("r", "1", "s", "022", 2.2, "n", "DE", "AU", "OTHER", 2),
        ("q", "2", "s", "022", None, "n", None, "AU", "BLS-AST-LOANS-PLAIN", 3), (None, "2", "s", "022", 7.0, "n", "US", "AU", "BLS-AST-LOANS-TF", 4),
        ("z", "2", "s", "022", 0.0, "n", "US", "AU", "BLS-AST-LOANS-TF", 5)], columns)
    period = "seq long, deal_id string, country string, type string"
    now = spark.createDataFrame([(1, "r", None, "t")], period)
    last = spark.createDataFrame([(1, "r", "AU", "t"), (2, "q", "US", "s")], period)
    register = build_register(loans, now, last)
    names = ("seq", "rca_bookv", "this_country", "this_type", "check_country", "check_type")
    assert rows(register, *names) == [
        (1, 3.2, "AU", "t", "true", "true"), (3, 0.0, None, "s", "false", "true"), (4, None, "US", "s", "NEW", "NEW")]
    assert refresh_register_log(register).count() == 3
