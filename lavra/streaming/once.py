"""Batches of a stream that are published exactly once."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from lavra.folders import read_text
from lavra.sources.published import published


class Once:
    """Names the batches of one start of a query and tells which one was published before.

    The name joins the id that a checkpoint gives its query for good with the batch's number, so
    batches of another checkpoint replace nothing. Only the first batch of a start can be one that
    was published just before a crash and comes again.
    """

    def __init__(self, spark: SparkSession, checkpoint: str, path: str):
        self.spark, self.checkpoint, self.path = spark, checkpoint.rstrip("/"), path
        self.query = ""

    def identity(self, batch_id: int) -> str | None:
        """The batch's name; None where the table at `path` has it already."""
        first = not self.query
        if first:
            self.query = json.loads(read_text(self.spark, f"{self.checkpoint}/metadata"))["id"]
        name = f"{self.query}:{batch_id}"
        return None if first and published(self.spark, self.path, name) else name
