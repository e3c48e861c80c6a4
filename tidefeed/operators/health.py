"""Health of connectors, structured and rate-limited logs."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FINE = ("RUNNING", "UNASSIGNED")


def health(states: DataFrame) -> DataFrame:
    """``(connector, ok)`` of ``states(connector, http, state, task)``: every answer is 200 and every state acceptable. Tasks of a connector that isn't are not looked at."""
    up = (F.col("http") == 200) & F.col("state").isin(*FINE)
    return states.groupBy("connector").agg(F.bool_and(F.coalesce(up & F.col("task").isin(*FINE), F.lit(False))).alias("ok"))


def exit_code(states: DataFrame) -> int:
    """0 if all is well, else 1; no connector is well."""
    return int(health(states).where("NOT ok").limit(1).count() > 0)


def log_line(message: str, **data: Column) -> Column:
    """A message and what it is about, as JSON."""
    return F.to_json(F.struct(F.lit(message).alias("message"), F.struct(*(c.alias(n) for n, c in data.items())).alias("data")))


@dataclass
class RateLimit:
    """Lets the first call through, then one as soon as ``seconds`` have passed."""

    seconds: float = 300.0
    clock: Callable[[], float] = time.monotonic
    last: float | None = field(default=None, init=False)

    def __call__(self) -> bool:
        now = self.clock()
        if self.last is not None and now - self.last <= self.seconds:
            return False
        self.last = now
        return True
