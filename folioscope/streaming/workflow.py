"""Workflow state over streams: the document registry and the stage machine."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.operators.workflow import STAGES
from folioscope.streaming.ordered import InOrder, judged


def first_uploads(uploads: DataFrame, content: str) -> DataFrame:
    """A stream of the uploads that create a document: the first of each content, for good.

    Idempotency is permanent, so the state holds every checksum seen; a watermark would forget them.
    """
    return uploads.withColumn("checksum", F.sha2(F.col(content).cast("binary"), 256)).dropDuplicates(["checksum"])


class Stages(InOrder):
    """Accepts a request for the stage after the key's current one; the rank of that one is all it keeps."""

    def __init__(self, key: str, stages: list[str]):
        super().__init__(key)
        self.stages = stages

    def init(self, handle) -> None:
        super().init(handle)
        self.rank = handle.getValueState("rank", "rank int")

    def take(self, due: list[tuple], now: int) -> Iterator[dict]:
        rank = self.rank.get()[0] if self.rank.exists() else 0
        before = rank
        out = []
        for at, request_id, stage in due:
            ok = stage in self.stages and self.stages.index(stage) == rank + 1
            rank += ok
            out.append({"at_us": at, "request_id": request_id, "stage": stage, "accepted": ok, "state": self.stages[rank]})
        if rank != before:
            self.rank.update((rank,))
        yield from out


def stage_machine(requests: DataFrame, key: str, stages: list[str] = STAGES, delay: str = "1 minute") -> DataFrame:
    """A stream of (key, at, request_id, stage, accepted, state): each request (key, at, request_id, stage) judged against its key's state, in order of time and id."""
    rows = judged(requests, Stages(key, stages), "request_id", "stage", "at_us long, request_id long, stage string, accepted boolean, state string", delay)
    return rows.select(key, F.timestamp_micros("at_us").alias("at"), "request_id", "stage", "accepted", "state")
