"""Counts that a write makes on its way."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Observation


class Counts:
    """Aggregates over the rows of a frame, computed by the action that writes them.

    Spark drops the counting together with a plan that turns out to be empty while it
    runs; every count is then ``None``.
    """

    def __init__(self):
        self._seen = Observation()

    def of(self, df, *aggregates):
        return df.observe(self._seen, *aggregates)

    def __getitem__(self, name: str):
        try:
            return self._seen.get[name]
        except Py4JJavaError:
            return None
