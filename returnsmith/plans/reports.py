"""The returns: assets and liabilities by currency, sector and country, and the five-part
country return.

Each report is one grouped pass of conditional sums over the positions, followed by joins
of report-sized tables. The country return makes a single pass for all its parts: every
measure is summed per pair of counterparty country and risk country, and each pair then
counts once for the one and once for the other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from returnsmith.functions.maturity import BUCKETS, FIVE_YEARS, ONE_YEAR, in_bucket
from returnsmith.functions.money import amount, as_double, exact, figures, half_even, total, total_or_null
from returnsmith.functions.nulls import all_present, sum_present, text, texts
from returnsmith.functions.rules import FEE_CODE
from returnsmith.schemas import MEASURES

REPORT_KEYS = ("report_ccy", "vis_sector", "vis_country")
HOME = "AU"

# sector columns: label text to search for, and a label to leave out (fixed values)
SECTORS = (
    ("banking", "Banking:", "Banking: central banks"),
    ("central_banks", "Banking: central bank", None),
    ("government", "General government", None),
    ("non_bank_financial", "Non-banking financial institutions", None),
    ("non_financial", "Non-financial corporations", None),
    ("households", "Households and non-profits", None),
    ("unallocated", "Unallocated", None),
)


# ---- assets and liabilities -------------------------------------------------------------------

def _line(side: str, categories: Sequence[str], measure: str, when: str = "true") -> str:
    return total(measure, f"ale = '{side}' AND category IN ({texts(categories)}) AND {when}")


ASSET_LINES = {
    "loans": _line("A", ["(4)"], "rca_bookv"),
    "securities": _line("A", ["(5)"], "rca_marketv"),
    "other": " + ".join([_line("A", ["(6)"], "rca_bookv"), _line("A", ["(4)", "(5)"], "rca_accrint"),
                         _line("OB", ["(6)"], "rca_mtm_positive")]),
}
LIABILITY_LINES = {
    "loans": _line("L", ["(4)"], "rca_bookv"),
    "issues_le_1y": _line("L", ["(7)"], "rca_bookv", f"rv_mat_remaining <= {ONE_YEAR}"),
    "issues_gt_1y": _line("L", ["(7)"], "rca_bookv", f"rv_mat_remaining > {ONE_YEAR}"),
    "other": " + ".join([_line("L", ["(8)"], "rca_bookv"), _line("L", ["(4)", "(7)"], "rca_accrint"),
                         _line("L", ["(8)"], "rca_deferred_fee"), _line("L", ["(8)"], "rca_mtm_negative")]),
}


def _grouped(positions: DataFrame, sides: Sequence[str], lines: dict[str, str]) -> DataFrame:
    rows = positions.where(f"ale IN ({texts(sides)}) AND {all_present(*REPORT_KEYS)}")
    return figures(exact(rows, *MEASURES), REPORT_KEYS, **lines)


def asset_lines(positions: DataFrame) -> DataFrame:
    """Claims by currency, sector and country; securities at market value."""
    return _grouped(positions, ("A", "OB"), ASSET_LINES).selectExpr("*", "loans + securities + other AS total")


def liability_lines(positions: DataFrame) -> DataFrame:
    """Liabilities by currency, sector and country; issues split at one year of remaining maturity."""
    return _grouped(positions, ("L", "OB"), LIABILITY_LINES).selectExpr(
        "*", "issues_le_1y + issues_gt_1y AS issues", "loans + issues + other AS total")


def key_adjustment(rec: DataFrame, side: str) -> DataFrame:
    """What the ledger differences of one side add to each report key; on the asset side fee
    accounts count the other way round."""
    diff = total("diff")
    if side == "A":
        diff = f"{diff} - 2 * {total('diff', f'ap_code = {text(FEE_CODE)}')}"
    return figures(rec.where(f"ale = '{side}' AND key IS NOT NULL"), ("key",), adjustment=half_even(f"-({diff})", 1))


def _adjusted(lines: DataFrame, rec: DataFrame, side: str) -> DataFrame:
    joined = lines.join(key_adjustment(rec, side), F.expr(f"concat_ws('|', {', '.join(REPORT_KEYS)}) = key"), "left")
    return as_double(joined.drop("key"))


def assets_report(positions: DataFrame, rec: DataFrame) -> DataFrame:
    return _adjusted(asset_lines(positions), rec, "A")


def liabilities_report(positions: DataFrame, rec: DataFrame) -> DataFrame:
    return _adjusted(liability_lines(positions), rec, "L")


# ---- country return ---------------------------------------------------------------------------

def _in_sector(col: str, label: str, leave_out: str | None) -> str:
    hit = f"startswith({col}, {text(label)})" if label.endswith(":") else f"contains({col}, {text(label)})"
    return hit if leave_out is None else f"{hit} AND {col} <> {text(leave_out)}"


def exposure(deduct_code: str) -> str:
    """Book value less twice that of the deducted account, less deferred fees, plus interest. Never
    null, so a sum of it is null only where no row qualifies."""
    book = amount("rca_bookv")
    return (f"(CASE WHEN deal_code = {text(deduct_code)} THEN -{book} ELSE {book} END "
            f"- {amount('rca_deferred_fee')} + {amount('rca_accrint')})")


def country_measures(deduct_code: str = "8754") -> dict[str, tuple[str, str, str]]:
    """Measure name -> (side, rows, figure); the side tells which country it is reported under."""
    value, moved = exposure(deduct_code), "ale = 'A' AND risk_transfer = 'Y'"
    found = {f"a_{name}": ("here", f"ale = 'A' AND {in_bucket('rv_mat_remaining_derived', low, high)}", value)
             for name, low, high in BUCKETS}
    found["late_fee"] = ("here", f"ale = 'A' AND rv_mat_remaining > {FIVE_YEARS}", amount("rca_deferred_fee"))
    found["here_total"] = ("here", "ale = 'A'", value)
    found["risk_total"] = ("risk", "ale = 'A'", value)
    found["c_outward"] = ("here", moved, value)
    found["c_inward"] = ("risk", moved, value)
    for name, label, leave_out in SECTORS:
        found[f"b_{name}"] = ("here", f"ale = 'A' AND {_in_sector('vis_sector', label, leave_out)}", value)
        found[f"d_{name}"] = ("risk", f"ale = 'A' AND {_in_sector('risk_in_sector', label, leave_out)}", value)
    found["e_derivatives"] = ("risk", "ale = 'OB'", amount("rca_mtm_positive"))
    return found


def country_figures(positions: DataFrame, deduct_code: str = "8754") -> DataFrame:
    """All measures of the return by country, in one pass over the positions. A measure is null where
    no row of the country qualifies, and a number where one does, even if its amounts are missing."""
    measures = country_measures(deduct_code)
    rows = exact(positions.where("ale IN ('A', 'OB')"), "rca_bookv", "rca_accrint", "rca_deferred_fee",
                 "rca_mtm_positive")
    pairs = figures(rows, ("vis_country", "risk_in"),
                    **{name: total_or_null(value, when) for name, (_, when, value) in measures.items()})
    sides = pairs.selectExpr(*measures, """inline(array(struct('here' AS side, vis_country AS country),
        struct('risk' AS side, risk_in AS country)))""").where("country IS NOT NULL")
    return figures(sides, ("country",), **{
        name: total_or_null(name, f"side = '{side}'") for name, (side, _, _) in measures.items()})


def ledger_adjustment(rec: DataFrame) -> DataFrame:
    """Asset-side ledger differences by country, in whole units, counted the other way round."""
    rows = rec.where("ale = 'A' AND vis_country IS NOT NULL").withColumnRenamed("vis_country", "country")
    return figures(rows, ("country",), gl_adj=f"-{half_even(total('diff'))}")


def facility_figures(facility: DataFrame) -> DataFrame:
    """Guarantees and commitments by risk country."""
    rows = exact(facility.where("guarantee IN ('G', 'F') AND risk_country IS NOT NULL"), "obs_amount")
    return figures(rows.withColumnRenamed("risk_country", "country"), ("country",),
                   e_guarantees=total_or_null(amount("obs_amount"), "guarantee = 'G'"),
                   e_commitments=total_or_null(amount("obs_amount"), "guarantee = 'F'"))


def with_countries(countries: DataFrame, *tables: DataFrame) -> DataFrame:
    """Every listed country with its figures, whether it has any or not."""
    out = countries.select("country", "country_name")
    for i, df in enumerate(tables):
        out = out.join(df.withColumnRenamed("country", f"_country{i}"), F.expr(f"country = _country{i}"), "left")
    return out


def _sector_columns(part: str, overall: str) -> dict[str, str]:
    """Claims by sector, with a check that the sectors add up to the total."""
    out = {f"{part}_{name}": f"{part}_{name}" for name, _, _ in SECTORS}
    out[f"{part}_non_financial"] += " + gl_adj"
    out[f"{part}_total"] = f"{overall} + gl_adj"
    out[f"{part}_check"] = half_even(f"{overall} + gl_adj - {sum_present(*list(out.values())[:len(SECTORS)])}")
    return out


# report columns from the figures, by part. Ledger differences go into the first maturity bucket, late
# fees into the last; a country without them has no figure there.
_BUCKETS = {f"a_{name}": f"a_{name}" for name, _, _ in BUCKETS} | {
    "a_le_3m": "(a_le_3m + gl_adj)", "a_ge_5y": "(a_ge_5y - late_fee)"}
COUNTRY_COLUMNS = {
    "a_gl_adj": "gl_adj", **_BUCKETS, "a_maturity_adj": "-late_fee", "a_total": "here_total + gl_adj",
    "a_unallocated": " - ".join(["here_total + gl_adj", *_BUCKETS.values()]),
    "b_gl_adj": "gl_adj", **_sector_columns("b", "here_total"),
    "c_outward": "c_outward", "c_inward": "c_inward", "c_net": "coalesce(c_inward, 0) - coalesce(c_outward, 0)",
    **_sector_columns("d", "risk_total"),
    "e_derivatives": "e_derivatives", "e_guarantees": "e_guarantees", "e_commitments": "e_commitments",
}
PARTS = ("a", "b", "c", "d", "e")


def country_table(measured: DataFrame, facility: DataFrame, rec: DataFrame, countries: DataFrame) -> DataFrame:
    """All parts side by side, one row per country, columns named ``<part>_<measure>``."""
    joined = with_countries(countries, measured, ledger_adjustment(rec), facility_figures(facility))
    return joined.selectExpr("country", "country_name", *[f"{expr} AS {name}" for name, expr in COUNTRY_COLUMNS.items()])


def country_report(positions: DataFrame, facility: DataFrame, rec: DataFrame, countries: DataFrame,
                   deduct_code: str = "8754") -> DataFrame:
    """The country return before the off-balance check, in exact figures."""
    return country_table(country_figures(positions, deduct_code), facility, rec, countries)


def part(table: DataFrame, letter: str) -> DataFrame:
    """One part of the return with its own column names."""
    return table.selectExpr("country", "country_name",
                            *[f"{n} AS {n[2:]}" for n in table.columns if n.startswith(f"{letter}_")])


def parts(table: DataFrame) -> dict[str, DataFrame]:
    return {letter: part(table, letter) for letter in PARTS}


def with_off_balance(table: DataFrame, check: DataFrame) -> DataFrame:
    """Off-balance differences, counted the other way round, on the home country's line."""
    home = exact(check, "diff").selectExpr(f"'{HOME}' AS _home", "guarantee", "diff")
    home = figures(home, ("_home",), e_guarantees_adj="-" + half_even(total("diff", "guarantee = 'G'"), 2),
                   e_commitments_adj="-" + half_even(total("diff", "guarantee = 'F'"), 2))
    return table.join(home, F.expr("country = _home"), "left").drop("_home")


def wide(table: DataFrame) -> DataFrame:
    return as_double(table)


def scaled(table: DataFrame) -> dict[str, DataFrame]:
    """Each part in millions with three decimals, without its empty lines."""
    out = {}
    for letter, df in parts(table).items():
        names = df.columns[2:]
        df = df.selectExpr("country", "country_name",
                           *[f"CAST({half_even(n, -3)} AS double) / 1e6D AS {n}" for n in names])
        out[letter] = df.where(" OR ".join(f"coalesce({n}, 0) <> 0" for n in names))
    return out
