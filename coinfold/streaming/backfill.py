"""Backfill a height range, then follow the head, on the same tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from coinfold.plans.ingest import backfill_range, ingest_raw
from coinfold.sources.raw import raw_block_stream, read_raw_blocks
from coinfold.streaming.follow import Follow, run_follow

MODES = ("backfill", "stream", "backfill_then_stream")


@dataclass
class Outcome:
    """Range that was backfilled, none when up to date or not asked for; the query if one
    was started."""

    backfilled: tuple[int, int] | None = None
    query: StreamingQuery | None = None


def run(
    landing: str,
    follow: Follow,
    mode: str = "backfill_then_stream",
    network: str = "main",
    start: int = 0,
    end: int | None = None,
    interval: str | None = None,
) -> Outcome:
    """A backfill that fails raises, and no stream starts."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}, known are {', '.join(MODES)}")
    if follow.ledger is None:
        raise ValueError("tables are needed to backfill and to resume")
    spark = follow.ledger.spark
    outcome = Outcome()
    if mode != "stream":
        raw = read_raw_blocks(spark, landing)
        head = raw.agg(F.max("height")).first()[0] if end is None else end
        if head is not None:
            outcome.backfilled = backfill_range(follow.ledger, start, head)
        if outcome.backfilled is not None:
            batch_id = "backfill-{}-{}".format(*outcome.backfilled)
            ingest_raw(raw, follow.ledger, network, *outcome.backfilled, batch_id=batch_id)
    if mode != "backfill":
        outcome.query = run_follow(raw_block_stream(spark, landing), follow, interval)
    return outcome
