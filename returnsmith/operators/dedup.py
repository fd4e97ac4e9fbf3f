"""Duplicates of a feed: find, log and remove them.

Most rows of a feed are unique. A first read counts the rows by a 64-bit hash of their content; the hashes that occur
twice or more are written once. They become bitmaps of a bounded size, which the second read asks about every
row: a row whose bit is not set has no copy and is kept as it stands, without a shuffle. The others, copies and a few rows that share a bit
with one, are compared in full, so neither a shared bit nor a clash of hashes drops or logs anything. Kept rows and log follow
from the one split. Most copies come in pairs: hashes that occur twice at most have a bitmap of their own, and one aggregate
gives what is kept and logged of their rows. The others take one more join. A group of copies may hold a large part of the feed: equal rows are
combined before they are shuffled, and each step on a group is an aggregate or a join that adaptive execution can split.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from returnsmith.operators.bitmaps import BITMAP, asked, bitmaps_of, hash_of, same_rows
from returnsmith.operators.lookup import key_match
from returnsmith.session import settle

BITMAPS = 8192      # 32 MB of them at most of either sort go to every executor, whatever the feed; more hashes only share more bits
BITS_PER_HASH = 32


@dataclass(frozen=True)
class Split:
    """A feed in three: rows that have no copy (``single``), those that may have one, and ``many``, that may have more."""

    single: DataFrame
    pairs: DataFrame
    many: DataFrame
    ignore: str
    order_by: str | None
    found: DataFrame | None = None  # ``picked`` as written, where the kept rows and the log are both made of it

    @property
    def several(self) -> DataFrame:
        """The rows that may have a copy."""
        return self.pairs.unionByName(self.many)

    def _content(self) -> list[str]:
        return [n for n in self.single.columns if n not in (self.ignore, self.order_by)]

    def _place(self) -> str:
        return f"struct({self.ignore} AS _value{f', -{self.order_by} AS _order' if self.order_by else ''})"

    def _sets(self, rows: DataFrame) -> DataFrame:
        """Number and highest place of each set; the hash in front is what they are sorted by."""
        return rows.groupBy(F.expr(f"{hash_of(self._content())} AS _hash"), *self._content()).agg(
            F.expr("count(*) AS _rows"), F.expr(f"max({self._place()}) AS _best"))

    def _paired(self) -> DataFrame:
        """The sets of ``pairs``, dealt out by their hash, of which the feed has two rows at most."""
        return self._sets(self.pairs.repartition(F.expr(hash_of(self._content()))))

    def _highest(self, sets: DataFrame, *more: str) -> DataFrame:
        held = {self.ignore: "_best._value", self.order_by: "-_best._order"}
        return sets.selectExpr(*[f"{held[n]} AS {n}" if n in held else n for n in self.single.columns], *more)

    def picked(self) -> DataFrame:
        """The kept row of each set among ``several``, with ``_logged``: whether it is the row that the log has of a pair."""
        pairs, many = self._paired(), self._sets(self.many)
        return self._highest(pairs, "_rows > 1 AS _logged").unionByName(self._highest(many, "false AS _logged"))

    def written(self, share: Callable[[DataFrame, str], DataFrame]) -> Split:
        """The same split, whose sets are made once, for kept rows and log."""
        return replace(self, found=share(self.picked(), "kept"))

    def best(self) -> DataFrame:
        """The kept row of each set among ``several``."""
        if self.found is not None:
            return self.found.drop("_logged")
        return self._highest(self._paired().unionByName(self._sets(self.many)))

    def kept(self) -> DataFrame:
        """One row per set of rows equal but for ``ignore``: the one with its highest value, a missing
        value being the lowest. ``order_by`` (a row number, not content) settles ties: earliest first."""
        return self.single.unionByName(self.best())

    def logged(self) -> DataFrame:
        """All rows of each set of rows equal but for ``ignore``, except one: that with the lowest value, the latest of those.

        Of two rows that is the highest one. Of more, rows equal in everything are counted, not ranked: the one that is left
        out is taken off its count.
        """
        names, content = self.single.columns, self._content()
        counted = self.many.groupBy(*names).agg(F.expr("count(*) AS _rows"))
        least = counted.groupBy(*[F.expr(f"{n} AS _k_{n}") for n in content]).agg(F.expr(f"min({self._place()}) AS _least"))
        joined = counted.join(least, F.expr(same_rows({n: f"_k_{n}" for n in content})))
        left = joined.selectExpr(*names, f"_rows - CASE WHEN {self._place()} <=> _least THEN 1 ELSE 0 END AS _left").where("_left > 0")
        pairs = self._highest(self._paired().where("_rows > 1")) if self.found is None else self.found.where("_logged").drop("_logged")
        return pairs.unionByName(
            left.selectExpr(*names, "explode(sequence(1L, _left)) AS _each").drop("_each"))


def split_repeats(df: DataFrame, ignore: str, order_by: str | None = None,
                  share: Callable[[DataFrame, str], DataFrame] = settle, write_single: bool = True) -> Split:
    """Split a feed with two reads of it; what the split is read from again is written by ``share``. Without ``write_single`` the rows
    that have no copy are not written, for what asks for the others only; reading them reads the feed once more."""
    hashed = hash_of([n for n in df.columns if n not in (ignore, order_by)])
    often = share(df.groupBy(F.expr(f"{hashed} AS _hash")).agg(F.expr("count(*) AS _n")).where("_n > 1").selectExpr("_hash", "_n > 2 AS _more"),
                  "hashes")
    bitmaps = min(BITMAPS, 1 << max(0, -(-often.count() * BITS_PER_HASH // BITMAP) - 1).bit_length())
    maps = bitmaps_of(often, bitmaps, _often="true", _many="_more")
    marked = asked(df, hashed, maps, bitmaps, "_often", "_many")
    held = share(marked if write_single else marked.where("_often"), "split")
    single, pairs, many = [rows.drop("_often", "_many") for rows in (
        (held if write_single else marked).where("NOT _often"), held.where("_often AND NOT _many"), held.where("_many"))]
    return Split(single, pairs, many, ignore, order_by)


def drop_repeats(df: DataFrame, ignore: str, order_by: str | None = None) -> DataFrame:
    """The kept rows of a feed (``Split.kept``)."""
    return split_repeats(df, ignore, order_by).kept()


def repeats(df: DataFrame, ignore: str, order_by: str | None = None) -> DataFrame:
    """The logged rows of a feed (``Split.logged``)."""
    return split_repeats(df, ignore, order_by, write_single=False).logged()


def duplicate_sets(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row whose key occurs more than once; missing keys count as equal."""
    often = df.groupBy(*[F.expr(f"{k} AS _k_{k}") for k in keys]).agg(F.expr("count(*) AS _n")).where("_n > 1")
    return df.join(often, F.expr(key_match({k: f"_k_{k}" for k in keys}, True)), "left_semi")


def merge_log(previous: DataFrame, new: DataFrame) -> DataFrame:
    """Distinct rows of an accumulated log and its additions."""
    return previous.unionByName(new).dropDuplicates()
