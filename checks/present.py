"""One output form for both engines: settled doubles, text dates, 64-bit integers."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from checks.duck_fundamentals import PARTS
from tickloom.functions.scalar import settle
from tickloom.session import tuned
from tickloom.sources.sqltext import compose

Build = Callable[[SparkSession, str], DataFrame]


def duck_settle(x: str, digits: int = 4) -> str:
    return f"floor(CAST({x} AS DOUBLE) * 1e{digits} + 0.500001e0) / 1e{digits}"


@dataclass(frozen=True)
class Check:
    """A query and its oracle; column names are listed by output form."""

    name: str
    build: Build
    sql: str | None
    keys: str = ""
    floats: str = ""
    dates: str = ""
    ints: str = ""

    def query(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.build(tuned(spark), sf_dir)
        return df.selectExpr(
            *self.keys.split(),
            *(f"{settle(c)} AS {c}" for c in self.floats.split()),
            *(f"date_format({c}, 'yyyy-MM-dd') AS {c}" for c in self.dates.split()),
            *(f"cast({c} AS bigint) AS {c}" for c in self.ints.split()),
        )

    @property
    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        columns = [
            *self.keys.split(),
            *(f"{duck_settle(c)} AS {c}" for c in self.floats.split()),
            *(f"strftime({c}, '%Y-%m-%d') AS {c}" for c in self.dates.split()),
            *(f"CAST({c} AS BIGINT) AS {c}" for c in self.ints.split()),
        ]
        text = f"SELECT {', '.join(columns)} FROM (\n{self.sql.strip()}\n) AS answer"
        return compose(text, PARTS)
