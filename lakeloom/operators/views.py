"""Aggregates kept up to date from what has changed.

A view is a versioned table of one row a group. Its source is a versioned table too, and the view's ledger holds the version of it that
the view shows. A refresh reads the files that two versions do not share, sums their rows with signs by group, and upserts the
groups touched, with the new source version, in one commit.

Besides its measures a group holds its number of rows and the sum of their hashes. Summed over groups these must be the source's, which is
one scan without a shuffle of rows; where they are not, the view has drifted and is made anew.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

if TYPE_CHECKING:
    from ..sources.versioned import Version, VersionedTable

_SOURCE = "source"


@dataclass
class AggregateView:
    """Counts, sums, least and greatest values by group of ``source``, kept in ``target``.

    ``sums`` must be of exact types (whole numbers or decimals), as differences of floating sums drift. Null groups are groups. Null
    values count for nothing; a group without any has null for its sum.
    """

    source: VersionedTable
    target: VersionedTable
    groups: list[str]
    sums: dict[str, str]
    least: dict[str, str]
    greatest: dict[str, str]

    def _row_hash(self, rows: DataFrame) -> Column:
        parts = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in sorted(x for x in rows.columns if x != "__sign")]
        return F.xxhash64(*parts).cast("decimal(38, 0)")

    def _aggregated(self, rows: DataFrame, extremes: bool = True) -> DataFrame:
        """By group: rows, hash, sums and how many values each has, over rows with ``__sign``."""
        signed = lambda c: F.sum(F.col("__sign") * c)
        measures = [F.sum("__sign").cast("long").alias("n"), signed(self._row_hash(rows)).cast("decimal(38, 0)").alias("__hash")]
        for name, column in self.sums.items():
            measures += [signed(F.coalesce(F.col(column), F.lit(0))).cast("decimal(38, 6)").alias(name), F.sum(F.when(F.col(column).isNotNull(), F.col("__sign")).otherwise(0)).cast("long").alias(f"__n_{name}")]
        if extremes:
            measures += [F.min(c).alias(n) for n, c in self.least.items()] + [F.max(c).alias(n) for n, c in self.greatest.items()]
        return rows.groupBy(*self.groups).agg(*measures)

    def _all(self, version: int) -> DataFrame:
        return self._aggregated(self.source.read(version).withColumn("__sign", F.lit(1)))

    def read(self) -> DataFrame:
        """(groups, n, measures) as of the last refresh."""
        rows = self.target.read()
        sums = [F.when(F.col(f"__n_{s}") > 0, F.col(s)).alias(s) for s in self.sums]
        return rows.select(*self.groups, "n", *sums, *self.least, *self.greatest)

    def drifted(self) -> bool:
        """Whether the view's rows and hashes are not those of the source version that it shows."""
        shown = self.target.version().ledger[_SOURCE]
        facts = lambda df, n, h: df.agg(F.sum(n).alias("n"), F.sum(h).alias("h")).first()
        rows = self.source.read(shown)
        return facts(rows, F.lit(1), self._row_hash(rows)) != facts(self.target.read(), "n", "__hash")

    def refresh(self, check: bool = False) -> Version:
        """Bring the view up to the source's newest version: by what has changed, or anew.

        Anew if there is no view yet, if the version that it shows is no longer kept, or, with ``check``, if it has drifted.
        """
        newest, held = self.source.version().number, self.target.version()
        shown = held.ledger.get(_SOURCE) if held else None
        if shown is None or shown not in self.source.versions() or (check and self.drifted()):
            # a ledger only moves on, so a view made anew at the version shown takes no batch number
            return self._replaced(newest)
        if shown == newest:
            return held
        delta = self._aggregated(self.source.changes(shown, newest), extremes=False)
        same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"__g_{g}")) for g in self.groups])
        added = [c for c in delta.columns if c not in self.groups]
        # rows that were written anew as they were cancel out, and their groups are not touched
        delta = delta.where(reduce(lambda a, b: a | b, [F.col(c) != 0 for c in added]))
        change = delta.select(*[F.col(g).alias(f"__g_{g}") for g in self.groups], *[F.col(c).alias(f"__d_{c}") for c in added])
        if self.least or self.greatest:
            # what is least can't be told from what went, so the groups touched are read again
            touched = change.select(*[f"__g_{g}" for g in self.groups])
            again = self.source.read(newest).join(touched, same, "left_semi").groupBy(*self.groups)
            now = again.agg(*[F.min(c).alias(n) for n, c in self.least.items()], *[F.max(c).alias(n) for n, c in self.greatest.items()])
            change = change.join(now, same, "left").drop(*self.groups)
        old = self.target.read(held.number).drop(*self.least, *self.greatest)
        both = change.join(old, same, "left")
        sums = [(F.coalesce(F.col(c), F.lit(0)) + F.col(f"__d_{c}")).cast(delta.schema[c].dataType).alias(c) for c in added]
        rows = both.select(*[F.col(f"__g_{g}").alias(g) for g in self.groups], *sums, *self.least, *self.greatest)
        return self.target.upsert(rows.select(*self.target.read(held.number).columns), self.groups, batch=(_SOURCE, newest), keep=F.col("n") > 0)

    def _replaced(self, newest: int) -> Version:
        rows = self._all(newest)
        return self.target.replace(rows, floor=0, ledger={_SOURCE: newest})
