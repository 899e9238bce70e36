"""Constraints of a load, counted while its rows are staged (C2, C3 and the rejects' reasons).

The counts are observed metrics of the one pass that writes the staging table,
so a feed is not read again to check it.  ``LoadLimits`` says what a load may
hold; a load beyond them stops before any warehouse table is written, and its
staged rows, with the flags that say what is wrong, stay where they are as
quarantine.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

#: NOT NULL columns of the feed.
REQUIRED = ("order_id", "line_no", "order_date", "product_id", "quantity", "customer_id", "time_id")
FLAGS = ("missing_customer", "missing_product", "missing_supplier", "bad_amount")


@dataclass(frozen=True)
class LoadLimits:
    """Largest share of rows without a fact, and numbers of NULLs and of flagged rows (no entry: no limit)."""

    reject_share: float = 1.0
    nulls: Mapping[str, int] = field(default_factory=dict)
    flagged: Mapping[str, int] = field(default_factory=dict)
    least_rows: int = 0


class LoadStopped(Exception):
    """A load beyond its limits; ``staged`` is the path of its flagged rows."""

    def __init__(self, breaches: list[str], report: dict[str, int], staged: str) -> None:
        super().__init__(f"load stopped: {'; '.join(breaches)}; its rows are in {staged}")
        self.breaches, self.report, self.staged = breaches, report, staged


def _count(condition) -> F.Column:
    return F.count(F.when(condition, 1))


class LoadCheck:
    """Observes the feed and its flagged rows; the report is there once they have been written."""

    def __init__(self) -> None:
        self.feed_counts, self.row_counts = Observation(), Observation()

    def feed(self, feed: DataFrame) -> DataFrame:
        return feed.observe(self.feed_counts, F.count(F.lit(1)).alias("rows"), *(_count(F.col(c).isNull()).alias(f"null_{c}") for c in REQUIRED))

    def rows(self, flagged: DataFrame) -> DataFrame:
        return flagged.observe(self.row_counts, _count(F.col("matched")).alias("matched"), *(_count(F.col(c)).alias(c) for c in FLAGS))

    def report(self, staged: DataFrame) -> dict[str, int]:
        """The counts; of an empty feed, whose plan may have been cut short, zeros."""
        if staged.isEmpty():
            return dict.fromkeys(("rows", *(f"null_{c}" for c in REQUIRED), "matched", *FLAGS), 0)
        return {**self.feed_counts.get, **self.row_counts.get}


def breaches(report: Mapping[str, int], limits: LoadLimits) -> list[str]:
    found = []
    rows, rejected = report["rows"], report["rows"] - report["matched"]
    if rows < limits.least_rows:
        found.append(f"{rows} rows, {limits.least_rows} expected")
    if rejected > limits.reject_share * rows:
        found.append(f"{rejected} of {rows} rows have no fact")
    found += [f"{report[f'null_{c}']} rows without {c}" for c, most in limits.nulls.items() if report[f"null_{c}"] > most]
    found += [f"{report[c]} rows with {c}" for c, most in limits.flagged.items() if report[c] > most]
    return found
