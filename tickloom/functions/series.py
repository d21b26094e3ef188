"""Windows over one symbol's ordered series, as SQL expression text.

A symbol's daily series holds at most one row per calendar day (its key), so a partition of these
windows is bounded by the calendar however large the table grows; feeds are aggregated or
de-duplicated to that key before any window sees them. All helpers of a chain share one
(partition, order) pair, so the chain costs one shuffle and one sort.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Series:
    """Window expressions over rows of one key in one order."""

    key: str = "stock_code"
    order: str = "trade_date"

    def over(self, call: str, frame: str = "") -> str:
        return f"{call} OVER (PARTITION BY {self.key} ORDER BY {self.order} {frame})"

    def lag(self, x: str, rows: int = 1) -> str:
        return self.over(f"lag({x}, {rows})")

    def lead(self, x: str, rows: int = 1) -> str:
        return self.over(f"lead({x}, {rows})")

    def last_rows(self, call: str, n: int) -> str:
        """Over this row and the n-1 before it, fewer at the start of the series."""
        return self.over(call, f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW")

    def so_far(self, call: str) -> str:
        return self.over(call, "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW")

    def whole(self, call: str) -> str:
        return f"{call} OVER (PARTITION BY {self.key})"

    def diff(self, x: str) -> str:
        return f"({x} - {self.lag(x)})"

    def mean(self, x: str, n: int) -> str:
        return self.last_rows(f"avg({x})", n)

    def full_mean(self, x: str, n: int, digits: int) -> str:
        """Rolling mean that stays NULL until n values are present; ties round to even."""
        enough = self.last_rows(f"count({x})", n)
        return f"if({enough} >= {n}, bround({self.mean(x, n)}, {digits}), NULL)"

    def sum(self, x: str, n: int) -> str:
        return self.last_rows(f"sum({x})", n)

    def max(self, x: str, n: int) -> str:
        return self.last_rows(f"max({x})", n)

    def min(self, x: str, n: int) -> str:
        return self.last_rows(f"min({x})", n)

    def longer(self, x: str, *rows: int) -> str:
        """A sum that is never NULL over more rows: its value here and at rows so far back, zero before the start."""
        return f"({' + '.join([x, *(self.over(f'lag({x}, {n}, 0D)') for n in rows)])})"

    def std(self, x: str, n: int) -> str:
        """Sample standard deviation; NULL while the window holds a single value."""
        return self.last_rows(f"stddev_samp({x})", n)

    def values(self, x: str, n: int) -> str:
        return self.last_rows(f"collect_list({x})", n)


BARS = Series()


def mean_abs_deviation(values: str, mean: str) -> str:
    """Mean distance of collected window values from the window mean."""
    total = f"aggregate({values}, 0D, (total, v) -> total + abs(v - {mean}))"
    return f"try_divide({total}, double(size({values})))"
