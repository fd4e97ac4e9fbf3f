"""Lookup joins: enrich a table from a keyed reference table.

Nothing here carries a broadcast hint. Spark broadcasts a lookup table by itself when
its size estimate, or the size AQE measures at run time, is below
``spark.sql.autoBroadcastJoinThreshold``; a larger one gets a sort-merge join whose hot
keys AQE splits on the data side (a left join may split its left side). So a lookup
table may grow without any change here; no size is looked at.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from returnsmith.functions.nulls import all_present, text


@dataclass(frozen=True)
class Lookup:
    """One step of an enrichment chain: data columns -> lookup keys, lookup values -> new columns.

    ``flag`` names an additional column that tells whether the key was found. Lookup tables hold ''
    instead of null, so plain equality matches all that a null-safe one would; a computed table
    with missing keys needs ``null_safe``.
    """

    table: str
    on: Mapping[str, str]
    values: Mapping[str, str] = field(default_factory=dict)
    flag: str | None = None
    null_safe: bool = False


class Prepared(Mapping):
    """A lookup set whose tables hold one row per key already, for the keys and values that some steps ask for.

    As a mapping it is the set of tables. ``ready`` maps (table, keys, values) to the keys and ``value_<name>`` columns; steps
    that it does not know pick their rows themselves.
    """

    def __init__(self, tables: Mapping[str, DataFrame], ready: Mapping[tuple, DataFrame]):
        self.tables, self.ready = dict(tables), dict(ready)

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    def __iter__(self):
        return iter(self.tables)

    def __len__(self) -> int:
        return len(self.tables)

    def with_tables(self, tables: Mapping[str, DataFrame]) -> Prepared:
        """The set with further or other tables, which are not ready."""
        return Prepared({**self.tables, **tables}, {k: df for k, df in self.ready.items() if k[0] not in tables})


def inline_table(spark: SparkSession, columns: str, rows: Sequence[Sequence]) -> DataFrame:
    """A fixed table (text or whole numbers) as literal rows of the plan, hence in one partition: picking one
    row per key needs no shuffle."""
    def literal(value) -> str:
        if value is None:
            return "CAST(NULL AS string)"
        return text(value) if isinstance(value, str) else str(value)

    body = ", ".join("(" + ", ".join(map(literal, row)) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(columns.split())})").coalesce(1)


def key_match(pairs: Mapping[str, str], null_safe: bool) -> str:
    """Equality of the column pairs; ``null_safe`` lets missing keys meet missing keys."""
    return " AND ".join(f"{a} {'<=>' if null_safe else '='} {b}" for a, b in pairs.items())


def one_per_key(dim: DataFrame, keys: Mapping[str, str], values: Mapping[str, str], order_by: str,
                keep: str = "first") -> DataFrame:
    """The first (or last) row of each key in ``order_by``; rows equal in it are told apart by
    their values. An aggregate, not a window: copies of a hot key are combined before the shuffle."""
    pick = {"first": "min", "last": "max"}[keep]
    held = "".join(f", {v} AS _v{i}" for i, v in enumerate(values))
    picked = (dim.groupBy(*[F.expr(f"{k} AS {n}") for k, n in keys.items()])
              .agg(F.expr(f"{pick}(struct({order_by} AS _order{held})) AS _row")))
    return picked.selectExpr(*keys.values(), *[f"_row._v{i} AS {n}" for i, n in enumerate(values.values())])


def _join(df: DataFrame, dim: DataFrame, step: Lookup, number: int, order_by: str | None, keep: str,
          trim_keys: bool = False) -> tuple[DataFrame, list[str]]:
    """The joined frame and the names of the helper columns it still carries.

    AQE splits a hot key only where the join shuffles both sides itself. Grouped by its key, a lookup
    side would be joined as it stands; compared null-safely it is not. So keys are always compared
    null-safely, and where missing ones must not meet they are taken out of the lookup side first.
    """
    keys = {f"trim({k})" if trim_keys else k: f"_k{number}_{i}" for i, k in enumerate(dict.fromkeys(step.on.values()))}
    if not step.null_safe:
        dim = dim.where(all_present(*keys))
    flag = f"_hit{number}"
    if order_by:
        dim = one_per_key(dim, keys, step.values, order_by, keep)
        if step.flag:
            dim = dim.selectExpr("*", f"true AS {flag}")
    else:
        dim = dim.selectExpr(*[f"{k} AS {n}" for k, n in keys.items()],
                             *[f"{v} AS {n}" for v, n in step.values.items()], *([f"true AS {flag}"] if step.flag else []))
    pairs = {(f"trim({main})" if trim_keys else main): keys[f"trim({key})" if trim_keys else key]
             for main, key in step.on.items()}
    df = df.join(dim, F.expr(key_match(pairs, True)), "left")
    if step.flag:
        df = df.selectExpr("*", f"coalesce({flag}, false) AS {step.flag}")
    return df, [*keys.values(), *([flag] if step.flag else [])]


def _refuse_clash(df: DataFrame, steps: Sequence[Lookup]) -> None:
    made = list(df.columns)
    for step in steps:
        new = [*step.values.values(), *([step.flag] if step.flag else [])]
        clash = set(new) & set(made)
        if clash:
            raise ValueError(f"lookup '{step.table}' would overwrite {sorted(clash)}")
        made += new


def lookup(df: DataFrame, dim: DataFrame, on: Mapping[str, str], values: Mapping[str, str],
           order_by: str | None = "seq", keep: str = "first", null_safe: bool = True,
           match_flag: str | None = None, trim_keys: bool = False) -> DataFrame:
    """Left join ``dim`` on ``on`` (data column -> lookup key) and add ``values`` (lookup column -> new name).

    One row per key survives (``keep``, in ``order_by``; None if keys are unique already), so
    the row count never changes. ``match_flag`` names a column telling whether a key was found.
    """
    step = Lookup("lookup", on, values, match_flag, null_safe)
    _refuse_clash(df, [step])
    joined, helpers = _join(df, dim, step, 0, order_by, keep, trim_keys)
    return joined.drop(*helpers)


def apply_chain(df: DataFrame, steps: Sequence[Lookup], dims: Mapping[str, DataFrame]) -> DataFrame:
    """All lookups of a chain in order; a later one may read columns of an earlier one."""
    missing = [s.table for s in steps if s.table not in dims]
    if missing:
        raise ValueError(f"lookup tables not found: {missing}")
    _refuse_clash(df, steps)
    helpers: list[str] = []
    for number, step in enumerate(steps):
        ready = dims.ready.get((step.table, tuple(step.on.values()), tuple(step.values))) if isinstance(dims, Prepared) else None
        if ready is None:
            df, more = _join(df, dims[step.table], step, number, "seq", "first")
        else:  # one row a key: nothing to pick
            known = replace(step, values={f"value_{v}": n for v, n in step.values.items()})
            df, more = _join(df, ready, known, number, None, "first")
        helpers += more
    return df.drop(*helpers)


def unmatched(df: DataFrame, steps: Sequence[Lookup], dims: Mapping[str, DataFrame]) -> DataFrame:
    """Rows without a lookup entry, one line per step of the chain, in one pass over the data."""
    flagged = [Lookup(s.table, s.on, s.values, f"found{i}", s.null_safe) for i, s in enumerate(steps)]
    counts = apply_chain(df, flagged, dims).agg(*[F.expr(f"count_if(NOT {s.flag}) AS {s.flag}") for s in flagged])
    lines = ", ".join(
        f"struct({i} AS step, {text(s.table)} AS lookup_table, {text('+'.join(s.on))} AS data_key, {s.flag} AS unmatched_rows)"
        for i, s in enumerate(flagged))
    return counts.selectExpr(f"inline(array({lines}))")


def keyed_entries(dim: DataFrame, kinds: Mapping[str, str], values: Sequence[str], order_by: str = "seq") -> DataFrame:
    """(kind, key, *values): the first entry by ``order_by`` of each key of each kind, in one aggregate.

    ``kinds`` names the key column of each kind. A missing key is a key of its own.
    """
    each = ", ".join(f"struct({text(kind)} AS kind, {column} AS key)" for kind, column in kinds.items())
    rows = dim.selectExpr(order_by, *values, f"explode(array({each})) AS _k")
    held = ", ".join([order_by, *values])
    first = rows.groupBy(F.expr("_k.kind AS kind"), F.expr("_k.key AS key")).agg(F.expr(f"min(struct({held})) AS _row"))
    return first.selectExpr("kind", "key", *[f"_row.{v} AS {v}" for v in values])


def chosen_lookup(df: DataFrame, dim: DataFrame, two_keys: str, special: str, common: str, special_values: Mapping[str, str],
                  common_values: Mapping[str, str], found: str, order_by: str = "seq") -> DataFrame:
    """Lookup by a key that each row chooses; every row of ``df`` is joined once.

    All rows look up ``common``. Rows for which ``two_keys`` holds take ``special_values`` and whether they were ``found`` by
    the key ``special`` instead. ``special`` and ``common`` are columns of both sides; values map a column of ``dim`` to its new name, and
    a name that is in both mappings is one column. Both keys of a row are looked up in one table of answers: the entries of ``common``, and the
    pairs of keys that ``two_keys`` rows hold. The pairs are read from ``df`` by themselves, three columns wide, and joined
    as distinct rows, which are as many as the keys, not as the rows.
    """
    wanted = list(dict.fromkeys([*special_values, *common_values]))
    entries = keyed_entries(dim, {"special": special, "common": common}, wanted, order_by)
    by_common = entries.where("kind = 'common'")
    by_special = entries.where("kind = 'special'").selectExpr("key AS _special", *[f"{v} AS _s_{v}" for v in special_values], "true AS _hit")
    pairs = df.where(two_keys).selectExpr(f"{special} AS _a", f"{common} AS _b").distinct()
    both = pairs.join(by_special, F.expr("_a <=> _special"), "left").join(
        by_common.selectExpr("key AS _common", *[f"{v} AS _c_{v}" for v in common_values]), F.expr("_b <=> _common"), "left")
    names = {n: (v, None) for v, n in common_values.items()}
    names.update({n: (names.get(n, (None, None))[0], v) for v, n in special_values.items()})  # name: column by common, by special
    for_pairs = [f"{f'_s_{s}' if s else f'_c_{c}'} AS _n_{n}" for n, (c, s) in names.items()]
    for_rest = [f"{c if c else 'NULL'} AS _n_{n}" for n, (c, _) in names.items()]
    answers = (both.selectExpr("true AS _pair", "_a", "_b", "coalesce(_hit, false) AS _found", *for_pairs)
               .unionByName(by_common.selectExpr("false AS _pair", "CAST(NULL AS string) AS _a", "key AS _b", "true AS _found", *for_rest)))
    chosen = f"coalesce({two_keys}, false)"
    joined = df.join(answers, F.expr(f"{chosen} <=> _pair AND CASE WHEN {chosen} THEN {special} END <=> _a AND {common} <=> _b"), "left")
    return joined.selectExpr(*df.columns, f"coalesce(_found, false) AS {found}", *[f"_n_{n} AS {n}" for n in names])


def routed_lookup(df: DataFrame, route: str, dim: DataFrame, on: Sequence[str], value: str, name: str,
                  tries: int = 3) -> DataFrame:
    """Lookup whose keys are chosen by row, with fallbacks.

    ``route`` is an array of structs holding the key fields ``on``, most wanted first, ``tries`` at most (a longer one
    is an error); the first one that finds a value other than null or '' wins. One join per candidate, so every row of
    ``df`` stays as it is, equal ones too. ``dim`` is unique by ``on``.
    """
    own = df.columns
    out = df.selectExpr("*", f"{route} AS _route").selectExpr(
        *own, f"CASE WHEN size(_route) > {tries} THEN raise_error('route too long') ELSE _route END AS _route")
    for i in range(tries):
        found = dim.selectExpr(*[f"{k} AS _d{i}_{k}" for k in on], f"CASE WHEN {value} <> '' THEN {value} END AS _found{i}")
        out = out.join(found, F.expr(key_match({f"get(_route, {i}).{k}": f"_d{i}_{k}" for k in on}, False)), "left")
    return out.selectExpr(*own, f"coalesce({', '.join(f'_found{i}' for i in range(tries))}) AS {name}")
