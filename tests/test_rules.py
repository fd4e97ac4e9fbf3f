from datetime import date, timedelta

import pytest

from returnsmith.functions import rules
from returnsmith.functions.maturity import BUCKETS, in_bucket, tenor_code
from returnsmith.functions.nulls import tokens_to_null
from returnsmith.plans.quality import position_issues
from returnsmith.schemas import NULL_TOKENS, POSITIONS
from returnsmith.sources.readers import clean_header, conform, normalise_nulls, read_table


@pytest.mark.parametrize("days, code", [
    (0, 1000000), (29, 1000029), (30, 1001030), (364, 1012364), (365, 1012000), (1799, 1059339), (1800, 1060340),
    (1824, 1060364), (1825, 1060000), (1826, 1060001), (None, None), (-1, None)])
def test_tenor_code(spark, days, code):
    start = date(2020, 1, 1)
    end = None if days is None else start + timedelta(days=days)
    df = spark.createDataFrame([(start, end)], "s date, e date")
    assert df.selectExpr(f"{tenor_code('s', 'e')} AS code").first().code == code


@pytest.mark.parametrize("code, bucket", [
    (0, None), (1000000, None), (1000001, "le_3m"), (1003000, "le_3m"), (1003001, "m3_12m"), (1012000, "m3_12m"),
    (1012001, "y1_2y"), (1024001, "y2_5y"), (1060000, "y2_5y"), (1060001, "ge_5y")])
def test_buckets_are_open_below_and_closed_above(spark, code, bucket):
    df = spark.createDataFrame([(code,)], "c int").selectExpr(*[f"{in_bucket('c', lo, hi)} AS {n}" for n, lo, hi in BUCKETS])
    assert [n for n, hit in df.first().asDict().items() if hit] == ([bucket] if bucket else [])


@pytest.mark.parametrize("ale, neg, out", [
    ("A", None, "a"), ("L", 0.0, "l"), ("OB", 0.0, "oa"), ("OB", -1.0, "ol"), ("OB", None, "ol"), (None, 0.0, "NA"), ("E", 0.0, "NA")])
def test_category(spark, ale, neg, out):
    df = spark.createDataFrame([(ale, neg, "a", "l", "oa", "ol")], "ale string, rca_mtm_negative double, cat_asset string, "
                               "cat_liability string, cat_off_asset string, cat_off_liability string")
    assert df.selectExpr(f"{rules.CATEGORY} AS x").first().x == out


@pytest.mark.parametrize("link, neg, pos, out", [
    ("8", None, 0.0, "N"), ("9", 0.0, None, "P"), ("11", 0.0, 2.0, "P"), ("8", -1.0, 2.0, "N"), ("8", 0.0, 0.0, "ERROR"),
    ("1", -1.0, 0.0, "NA"), (None, -1.0, 0.0, "NA")])
def test_valuation_code(spark, link, neg, pos, out):
    df = spark.createDataFrame([(link, neg, pos, "P", "N")], "ide_linkage_type string, rca_mtm_negative double, "
                               "rca_mtm_positive double, account_if_positive string, account_if_negative string")
    assert df.selectExpr(f"{rules.VALUATION_CODE} AS x").first().x == out


@pytest.mark.parametrize("customer, domicile, out", [
    ("NULL", "AU", "NULL"), ("1", "xx", "CN"), ("1", None, "NULL"), (None, "US", "US")])
def test_counterparty_country(spark, customer, domicile, out):
    df = spark.createDataFrame([(customer, domicile)], "customer_nr string, domicile string")
    assert df.selectExpr(f"{rules.COUNTERPARTY_COUNTRY} AS x").first().x == out


@pytest.mark.parametrize("nationality, domicile, out", [
    ("YY", "XX", "CN"), ("YY", None, "NULL"), ("DE", "XX", "DE"), (None, "xx", "xx")])
def test_nationality(spark, nationality, domicile, out):
    df = spark.createDataFrame([(nationality, domicile)], "nationality string, domicile string")
    assert df.selectExpr(f"{rules.NATIONALITY} AS x").first().x == out


@pytest.mark.parametrize("now, before, out", [
    ("AU", "", "NEW"), ("AU", None, "NEW"), ("AU", "AU", "true"), ("AU", "US", "false"), (None, "US", "false")])
def test_period_check(spark, now, before, out):
    df = spark.createDataFrame([(now, before)], "a string, b string")
    assert df.selectExpr(f"{rules.period_check('a', 'b')} AS x").first().x == out


def test_null_tokens_keep_the_real_marker(spark, rows):
    df = spark.createDataFrame([(t,) for t in (*NULL_TOKENS, "NA", " ", None)], "t string")
    assert rows(df.selectExpr(f"{tokens_to_null('t', NULL_TOKENS)} AS t").where("t IS NOT NULL")) == [(" ",), ("NA",)]
    numbers = spark.createDataFrame([("NULL", 1)], "t string, n int")
    assert rows(normalise_nulls(numbers)) == [(None, 1)]


def test_header_and_types(spark):
    df = spark.createDataFrame([("1", "2")], "`a.1` string, ` b ` string")
    assert clean_header(df).columns == ["a", "b"]
    with pytest.raises(ValueError):
        clean_header(spark.createDataFrame([(1, 2)], "`a.1` int, a int"))
    with pytest.raises(KeyError):
        conform(df, POSITIONS)
    with pytest.raises(ValueError):
        read_table(spark, {"type": "xlsb"})
    assert read_table(spark, {"type": "sql", "query": "SELECT :d AS d", "params": {"d": 7}}).first().d == 7


def test_a_row_with_both_faults_is_listed_twice(spark, rows):
    df = spark.createDataFrame([(1, None, 1.0, "ERROR", 1.0, 0.0), (2, None, 0.0, "ERROR", 1.0, -1.0), (3, "x", 1.0, "ERROR", None, 0.0),
                                (4, None, -1.0, "NA", 1.0, 0.0)],
                               "id int, vis_sector string, rca_bookv double, valuation_code string, rca_mtm_negative double, "
                               "rca_mtm_positive double")
    df = df.selectExpr("*", *[f"CAST(NULL AS double) AS {n}" for n in ("rca_accrint", "rca_marketv", "rca_prov_coll", "rca_prov_indi")])
    listed = rows(position_issues(df), "id", "log_reason")
    assert [(i, reason[:5]) for i, reason in listed] == [(1, "ERROR"), (1, "NA ke"), (3, "ERROR"), (4, "NA ke")]
