"""Amounts: what fits is exact, what does not fit is an error, with ANSI mode on and off."""

import pytest
from pyspark.sql import functions as F

from returnsmith.functions.money import exact, figures, total


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.set("spark.sql.ansi.enabled", before)


def summed(df):
    return float(figures(exact(df, "x"), (), s=total("x")).first()["s"])


def test_large_amounts_are_kept(spark, ansi):
    assert summed(spark.createDataFrame([(2e14,), (1.0,), (None,)], "x double")) == 200000000000001.0


def test_small_digits_add_up(spark, ansi):
    assert summed(spark.range(1_000_000).select(F.lit(0.00004).alias("x"))) == 40.0


@pytest.mark.parametrize("bad", [1e18, -3e20, float("nan"), float("inf")])
def test_an_amount_that_does_not_fit_is_an_error(spark, ansi, bad):
    with pytest.raises(Exception, match="out of range"):
        summed(spark.createDataFrame([(bad,), (1.0,)], "x double"))
