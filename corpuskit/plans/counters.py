"""Rows that stages leave, counted while they run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class Counters:
    """Counts rows at named places of a plan, without a pass of their own."""

    def __init__(self):
        self.observed: dict[str, Observation] = {}

    def watch(self, df: DataFrame, name: str) -> DataFrame:
        self.observed[name] = Observation(name)
        return df.observe(self.observed[name], F.count(F.lit(1)).alias("rows"))

    def rows(self) -> dict[str, int]:
        """Rows at each place, in the order of the plan; only after the plan has run."""
        return {k: o.get["rows"] for k, o in self.observed.items()}
