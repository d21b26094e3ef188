"""As-of join: each row takes the newest period already known on its date.

A range join would emit rows x periods per symbol. Here both sides are laid on one time line per
symbol and a running maximum carries the newest known period forward: one shuffle, linear work.
"Newest" is the greatest period, so a late restatement of an older period never wins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tickloom.functions.series import Series


def asof_newest(
    rows: DataFrame,
    periods: DataFrame,
    by: str,
    on: str,
    known_from: str,
    period: str,
    payload: Sequence[str],
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """``rows`` with ``period`` and ``payload`` of the newest period whose ``known_from`` <= ``on``.

    ``known_from`` is an expression over ``periods``. A period known from day d serves rows of day
    d. Periods whose ``known_from`` is NULL are never used; rows before the first known period get
    NULLs. ``tie_break`` orders periods of equal date.
    """
    carried = ", ".join((period, *tie_break, *payload))
    # A new name for the key lets the union keep the partitioning that both sides may have by it.
    own = [c for c in rows.columns if c != by]
    known = periods.selectExpr(
        f"{by} AS _by", f"{known_from} AS _day", "0 AS _side", f"struct({carried}) AS _state"
    ).where("_day IS NOT NULL")
    asked = rows.selectExpr(
        f"{by} AS _by", f"{on} AS _day", "1 AS _side", f"struct({', '.join(own)}) AS _row"
    )
    newest = Series("_by", "_day, _side").so_far("max(_state)")
    line = known.unionByName(asked, allowMissingColumns=True)
    found = line.selectExpr("_by", "_side", "_row", f"{newest} AS _newest").where("_side = 1")
    return found.selectExpr(
        f"_by AS {by}", *(f"_row.{c} AS {c}" for c in own), *(f"_newest.{c} AS {c}" for c in (period, *payload))
    )
