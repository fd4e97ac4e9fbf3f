"""The register of ultimate risk bearers, built from loan positions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from returnsmith.functions import rules
from returnsmith.functions.money import exact_amount, half_even, total
from returnsmith.operators.lookup import apply_chain
from returnsmith.plans.chains import REGISTER_CHAIN
from returnsmith.schemas import REGISTER

# rules over the joined registers of both periods, replacing the columns of the same name
FILLED = {"this_country": rules.REGISTER_COUNTRY, "this_type": rules.REGISTER_TYPE,
          "last_country": "coalesce(last_country, '')"}
CHECKS = {"check_country": rules.period_check("this_country", "last_country"),
          "check_type": rules.period_check("this_type", "last_type")}


def loans(df: DataFrame) -> DataFrame:
    return df.where(rules.IS_LOAN)


def reference_totals(df: DataFrame) -> DataFrame:
    """Book value per reference. An aggregate rather than a window: a hot reference is summed
    before the shuffle and the result has one row per reference."""
    book = half_even(total(exact_amount("rca_bookv")), 1)
    return (df.where("ide_linkage_ref IS NOT NULL").groupBy(F.expr("ide_linkage_ref AS _ref"))
            .agg(F.expr(f"CAST({book} AS double) AS rca_bookv")))


def with_reference_total(df: DataFrame, all_rows: DataFrame) -> DataFrame:
    """Each row's book value replaced by the total of its reference over ``all_rows``. Compared
    null-safely like other large lookups, so that the rows of a hot reference can be split."""
    totals = reference_totals(all_rows)
    return df.drop("rca_bookv").join(totals, F.expr("ide_linkage_ref <=> _ref"), "left").drop("_ref")


def register_rules(df: DataFrame) -> DataFrame:
    """Risk country and type of this period, those of the last, and whether they agree."""
    kept = [n for n in df.columns if n not in CHECKS]
    filled = df.selectExpr(*[f"{FILLED[n]} AS {n}" if n in FILLED else n for n in kept])
    return filled.selectExpr("*", *[f"{rule} AS {n}" for n, rule in CHECKS.items()])


def build_register(positions: DataFrame, now: DataFrame, last: DataFrame) -> DataFrame:
    """The register of the enriched positions. ``seq`` of the positions stays: it tells which entry
    of a customer or reference comes first."""
    listed = apply_chain(loans(positions), REGISTER_CHAIN, {"register_now": now, "register_last": last})
    columns = [*REGISTER.names, *(["seq"] if "seq" in positions.columns else [])]
    return register_rules(with_reference_total(listed, positions).select(*columns))


def refresh_register_log(log: DataFrame) -> DataFrame:
    """The register rules again over a reviewed log, whose rows are all kept."""
    return register_rules(with_reference_total(log, log).select(*log.columns))
