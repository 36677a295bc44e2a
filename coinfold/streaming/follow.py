"""Following the head: landed raw blocks into tables or topics, micro-batch by micro-batch.

Every micro-batch may run again after a failure. All it writes is keyed by its number or by
row keys, so a second run replaces the first.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from coinfold.operators.coerce import item_rows
from coinfold.operators.enrich import enrich_transactions, outpoints, output_counts
from coinfold.operators.heights import resume_height
from coinfold.operators.items import block_items, transaction_items, with_item_id
from coinfold.plans.ingest import load_flat
from coinfold.schemas import CORRUPT, RAW_BLOCK
from coinfold.sources import files
from coinfold.sources.items import COMPRESSION
from coinfold.sources.tables import Ledger

TOPICS = ("blocks", "transactions")
MISSING_FIELD = "block without hash or height"


@dataclass
class Follow:
    """Settings of a stream.

    ``state`` is a folder for the checkpoint and the blocks that wait for the lag.
    ``ledger`` receives rows, ``topics`` receives items below ``<topics>.blocks`` and
    ``<topics>.transactions``, ``flat`` is a folder for the flat tables; ``sink`` is called
    with topic, lines and micro-batch number, see :func:`console` and :func:`format_sink`. At least
    one is needed. ``dead_letters`` collects unusable blocks; without it the first one ends
    the stream.
    """

    state: str
    ledger: Ledger | None = None
    topics: str | None = None
    start: int | None = None
    lag: int = 0
    enrich: bool = False
    dead_letters: str | None = None
    flat: str | None = None
    sink: Callable[[str, DataFrame, int], None] | None = None


def start_height(follow: Follow) -> int:
    """The first height the stream takes: as given, otherwise behind the stored blocks. Topics
    keep no height to ask for.

    A stream without given start keeps the height it began with in its state. A restart takes
    that one, not what is stored by then: files land in any order, and which were taken the
    checkpoint knows.
    """
    if follow.start is not None:
        return follow.start
    if follow.ledger is None:
        raise ValueError("a stream into topics needs a start height")
    spark, path = follow.ledger.spark, f"{follow.state}/first"
    kept = _read(spark, path, T.StructType([T.StructField("first", T.LongType())])).first()
    if kept is not None:
        return kept[0]
    first = resume_height(follow.ledger.table("blocks"))
    spark.range(1).select(F.lit(first).cast("bigint").alias("first")).write.parquet(path)
    return first


def run_follow(
    source: DataFrame, follow: Follow, interval: str | None = None
) -> StreamingQuery:
    """Start the stream over parsed raw blocks. Without ``interval`` it takes what has
    landed and stops."""
    if not any((follow.ledger, follow.topics, follow.flat, follow.sink)):
        raise ValueError("a stream needs tables, topics or a sink to write to")
    first = start_height(follow)
    seen = source.observe(
        OBSERVED, F.max("height").alias("head"), F.count("height").alias("blocks"), F.count(CORRUPT).alias("unusable")
    )
    writer = (
        seen.writeStream.option("checkpointLocation", f"{follow.state}/checkpoint")
        .foreachBatch(lambda batch, number: process_batch(batch, number, follow, first))
    )
    if interval is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


def process_batch(batch: DataFrame, number: int, follow: Follow, first: int) -> None:
    """One micro-batch: quarantine, lag, enrichment, then the sinks."""
    spark = batch.sparkSession
    landed = f"{follow.state}/landed/slot={_slot(number)}"
    batch.select(*RAW_BLOCK.names, CORRUPT).write.mode("overwrite").parquet(landed)
    landed_blocks = spark.read.schema(_raw_with_corrupt()).parquet(landed)
    _quarantine(landed_blocks, number, follow)
    usable = landed_blocks.where(_error().isNull() & (F.col("height") >= first)).drop(CORRUPT)
    due = _due(spark, usable, number, follow)
    if not due.take(1):
        return
    blocks = with_item_id(block_items(due))
    transactions = with_item_id(transaction_items(due))
    if follow.enrich:
        transactions = _enriched(transactions, follow)
    # Every sink reads the items, and enrichment reads the tables the sinks are about to
    # change: computed once and kept.
    kept = f"{follow.state}/items/slot={_slot(number)}"
    transactions.write.mode("overwrite").parquet(kept)
    transactions = spark.read.schema(transactions.schema).parquet(kept)
    if follow.ledger is not None:
        follow.ledger.write(item_rows(blocks, transactions), batch_id=f"{_stream_id(follow)}-{number}")
    if follow.flat is not None:
        load_flat(spark, follow.flat, blocks, transactions)
    if follow.topics is not None:
        write_topics(blocks, transactions, follow.topics, number)
    if follow.sink is not None:
        for topic, items in zip(TOPICS, (blocks, transactions)):
            _sink_once(spark, follow, topic, items, number)


def _sink_once(spark: SparkSession, follow: Follow, topic: str, items: DataFrame, number: int) -> None:
    """Give a topic's items of a micro-batch to the sink unless it had them. What it had is noted by one file for each
    topic and micro-batch, put in place when the sink has returned: a micro-batch that is run again skips it.
    A sink that breaks off midway gets the same items again under the same number."""
    noted = f"{follow.state}/sunk/{topic}"
    name = f"{number:012d}"
    if name in files.names(spark, noted):
        return
    follow.sink(topic, _lines(items), number)
    files.put(spark, f"{noted}/{name}", _stream_id(follow))


def write_topics(blocks: DataFrame, transactions: DataFrame, topics: str, number: int) -> None:
    """Items of a micro-batch as JSON lines in compressed files, one folder per topic."""
    for topic, items in zip(TOPICS, (blocks, transactions)):
        lines = _lines(items).write.mode("overwrite")
        lines.text(f"{topics}.{topic}/batch={number}", compression=COMPRESSION)


def console(topic: str, lines: DataFrame, number: int) -> None:
    """Items as lines on the driver's standard output, one partition at a time."""
    for row in lines.toLocalIterator():
        print(f"{topic}\t{row.value}")


def format_sink(kind: str, topic_option: str = "topic", **options):
    """A sink that writes lines in any format Spark has a writer for, such as a message broker; the topic
    goes to the option named."""

    def write(topic: str, lines: DataFrame, number: int) -> None:
        writer = lines.write.format(kind).mode("append").options(**options)
        writer.option(topic_option, topic).save()

    return write


def _lines(items: DataFrame) -> DataFrame:
    return items.select(
        F.to_json(F.struct(*items.columns), {"ignoreNullFields": "false"}).alias("value")
    )


#: Name under which each micro-batch reports highest height, blocks and unusable lines.
OBSERVED = "landed_blocks"


class Progress(StreamingQueryListener):
    """What the running streams report: one row for each micro-batch, with head, current and remaining heights.

    The head is what ``head`` tells, such as a node's height, or else the highest height that landed, less the lag;
    current is the next height behind what the micro-batches have given on. The rest comes with the progress of the
    query, so nothing is read or counted for it. Add it with ``spark.streams.addListener``.
    """

    def __init__(self, lag: int = 0, start: int = 0, head: Callable[[], int] | None = None) -> None:
        self.lag = max(0, lag)
        self.start = start
        self.head = head
        self.rows: list[dict] = []
        self._seen: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        """Nothing to note yet."""

    def onQueryIdle(self, event) -> None:
        """Nothing new."""

    def onQueryTerminated(self, event) -> None:
        """The rows stay."""

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(OBSERVED)
        if seen is None:
            return
        query = str(progress.id)
        if seen["head"] is not None:
            self._seen[query] = max(seen["head"], self._seen.get(query, seen["head"]))
        if query not in self._seen:
            return
        # what the lag holds back is not given on yet
        given = self._seen[query] - self.lag
        head = given if self.head is None else self.head() - self.lag
        current = max(self.start, given + 1)
        self.rows.append(
            {
                "query": query, "batch": progress.batchId, "head": head, "current": current,
                "remaining": max(0, head - current + 1), "blocks": seen["blocks"], "unusable": seen["unusable"],
                "rows_per_second": progress.processedRowsPerSecond,
            }
        )


def catch_up(blocks: DataFrame, head: int, lag: int = 0) -> DataFrame:
    """How far the tables are behind: one row with head, next height and what remains."""
    target = head - max(0, lag)
    return blocks.agg(F.max("height").alias("_stored")).select(
        F.lit(target).cast("bigint").alias("head"),
        F.coalesce(F.col("_stored") + 1, F.lit(0)).cast("bigint").alias("current"),
        (F.lit(target) - F.coalesce(F.col("_stored") + 1, F.lit(0)) + 1)
        .cast("bigint")
        .alias("remaining"),
    )


def _stream_id(follow: Follow) -> str:
    """Tells the commits of streams over the same tables apart, and is the same after a restart."""
    return f"stream-{zlib.crc32(follow.state.rstrip('/').encode()):08x}"


def _slot(number: int) -> int:
    """Two folders take turns: a micro-batch reads what the one before it left and only
    ever overwrites what is older."""
    return number % 2


def _error():
    incomplete = F.col("hash").isNull() | F.col("height").isNull()
    return F.when(F.col(CORRUPT).isNotNull(), F.col(CORRUPT)).when(
        incomplete, F.lit(MISSING_FIELD)
    )


def _quarantine(blocks: DataFrame, number: int, follow: Follow) -> None:
    bad = blocks.select("height", _error().alias("error")).where(F.col("error").isNotNull())
    if follow.dead_letters is None:
        first = bad.take(1)
        if first:
            raise RuntimeError(f"unusable block at height {first[0][0]}: {first[0][1][:200]}")
        return
    bad.write.mode("overwrite").json(f"{follow.dead_letters}/batch={number}")


def _due(spark: SparkSession, usable: DataFrame, number: int, follow: Follow) -> DataFrame:
    """Blocks far enough behind the highest height seen; the others wait for a later batch.

    Waiting blocks and the highest height are written per micro-batch, reading only what
    the one before it left.
    """
    lag = max(0, follow.lag)
    if lag == 0:
        return usable
    waiting = _read(spark, f"{follow.state}/waiting/slot={_slot(number - 1)}", RAW_BLOCK)
    seen = _read(
        spark, f"{follow.state}/head/slot={_slot(number - 1)}",
        T.StructType([T.StructField("head", T.LongType())]),
    )
    together = usable.unionByName(waiting)
    heads = together.select(F.col("height").alias("head")).unionByName(seen)
    head = heads.agg(F.max("head").alias("head")).first()[0]
    spark.range(1).select(F.lit(head).cast("bigint").alias("head")).write.mode(
        "overwrite"
    ).parquet(f"{follow.state}/head/slot={_slot(number)}")
    limit = F.lit(head) - F.lit(lag)
    together.where(F.col("height") > limit).write.mode("overwrite").parquet(
        f"{follow.state}/waiting/slot={_slot(number)}"
    )
    return together.where(F.col("height") <= limit)


def _enriched(transactions: DataFrame, follow: Follow) -> DataFrame:
    """Look spent outputs up in the stored ones and in the micro-batch itself.

    Of the stored rows only those that the micro-batch spends are joined further. Their keys are
    unique already.
    """
    outputs = outpoints(transactions).dropDuplicates(["txid", "vout"])
    counts = output_counts(transactions).groupBy("txid").agg(F.max("vout_count").alias("vout_count"))
    if follow.ledger is not None:
        spent = transactions.select(F.explode("inputs").alias("i")).select(
            F.col("i.txid").alias("txid"),
            F.col("i.vout").cast("bigint").alias("vout"),
        )
        wanted = spent.where("txid is not null").distinct()
        stored = follow.ledger.table("txouts").select(
            "txid",
            F.col("vout").cast("bigint").alias("vout"),
            F.when(F.col("address").isNotNull(), F.array("address")).alias("addresses"),
            F.lit(None).cast("bigint").alias("required_signatures"),
            F.col("script_type").alias("type"),
            (F.col("value_sat").cast("decimal(28,8)") / F.lit(100_000_000))
            .cast("decimal(28,8)")
            .cast("string")
            .alias("value"),
            F.col("asset_id").alias("asset"),
        )
        stored = stored.join(wanted, ["txid", "vout"], "left_semi")
        new = outputs.select("txid", "vout")
        outputs = outputs.unionByName(stored.join(new, ["txid", "vout"], "left_anti"))
        known = follow.ledger.table("transactions").select("txid", "vout_count")
        known = known.join(wanted.select("txid"), "txid", "left_semi")
        counts = counts.unionByName(known.join(counts.select("txid"), "txid", "left_anti"))
    return enrich_transactions(transactions, outputs, counts)


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _raw_with_corrupt() -> T.StructType:
    return T.StructType([*RAW_BLOCK.fields, T.StructField(CORRUPT, T.StringType())])
