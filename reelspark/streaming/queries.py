"""Streaming twins of batch queries: the events file read as a stream, each batch that is there, then done."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.folders import fresh_folder
from reelspark.functions.numeric import median_bits
from reelspark.functions.text import url_join
from reelspark.operators import playlist
from reelspark.operators.detections import MODELS
from reelspark.streaming import metrics, resume, sinks, state, sync
from reelspark.streaming.sinks import collected
from reelspark.streaming.source import in_order

GAP = 6 * 3600 * 1_000_000


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream, eight files a batch, in no order. The table is a file or a folder of files."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 8).parquet(f"{sf_dir}/{name}.parque[t]")  # a plain path must be a folder


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source(spark, sf_dir, "events")


def events_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events are short, and each batch calls Python once for each user in it: so few batches, of many rows."""
    return in_order(spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", "ts", "event_id"), F.unix_micros(F.col("ts").cast("timestamp")), 10_000_000)


def stream_frame_numbering(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events_in_order(spark, sf_dir).where("event_id % 7 <> 0").select("user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), "event_id")
    return collected(state.number_rows(rows, "user_id", ["us", "event_id"]).select("user_id", "event_id", "frame_number"), spark)


def stream_debounce(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events_in_order(spark, sf_dir).select("user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    return collected(state.debounce(rows, "user_id", "us", GAP), spark)


def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events_in_order(spark, sf_dir).select("user_id", F.date_format("ts", "yyyyMMddHH").alias("segment"), F.col("ts").cast("timestamp").alias("ts"))
    seen = rows.withWatermark("ts", "30 days").dropDuplicatesWithinWatermark(["user_id", "segment"])
    return collected(seen.select("user_id", "segment"), spark)


def camera_cuts(spark: SparkSession, sf_dir: str, least: int, gap: int) -> DataFrame:
    """Cuts of a stream of frame features. Every seventh frame has none: it is skipped and gets no number."""
    e = in_order(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id"))
    bits = F.when(F.col("vec_id") % 7 != 0, median_bits(F.col("embedding")))
    frames = e.select(F.col("label").cast("bigint").alias("match_id"), "vec_id", bits.alias("bits"), F.col("embedding").alias("vector"))
    return collected(state.camera_cuts(frames, "match_id", "vec_id", gap, least=least), spark)


def stream_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return camera_cuts(spark, sf_dir, 20, 25)


def stream_cuts_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return camera_cuts(spark, sf_dir, 32, 3)


POLL = "concat_ws(chr(10), '#EXTINF:4,', concat('../s_', cast(o_orderkey div 3 as string), '.ts'), '#EXTINF:4,', concat('s_', cast(o_orderkey div 3 + 1 as string), '.ts'))"


#: A segment is known for as long after its first poll: longer than any playlist of the table is polled.
LISTED = "3650 days"


def stream_new_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polls of sliding playlists (an order is a poll, a customer a playlist): each segment URL once, whichever poll lists it."""
    polls = source(spark, sf_dir, "orders").select(F.struct("o_custkey", "o_orderdate").alias("poll"), F.expr(POLL).alias("body"))
    found = playlist.lines(polls, "poll", "body").select("poll.*", "line").where(F.endswith("line", F.lit(playlist.SEGMENT)))
    url = url_join(F.concat(F.lit("http://h.example/live/"), F.col("o_custkey").cast("string"), F.lit("/list.m3u8?t=1")), F.col("line"))
    seen = found.select("o_custkey", url.alias("url"), F.col("o_orderdate").cast("timestamp").alias("at")).withWatermark("at", LISTED)
    return collected(seen.dropDuplicatesWithinWatermark(["o_custkey", "url"]).select("o_custkey", "url"), spark)


def csv_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections appended to CSV files by a stream, arrays as JSON, and read again."""
    at = fresh_folder(spark, "csv")
    box = F.array(F.col("event_id").cast("int"), F.lit(2))
    sinks.csv_append(events(spark, sf_dir).select("event_id", "event_type", box.alias("box")), f"{at}/rows", f"{at}/checkpoint").awaitTermination()
    back = spark.read.option("header", True).schema("event_id bigint, event_type string, box string").csv(f"{at}/rows")
    return back.select("event_id", "event_type", F.from_json("box", "array<int>")[0].cast("bigint").alias("box"))


def upsert_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream into a keyed table, the last row of a key winning; rows of a negative or missing value are set aside."""
    at = fresh_folder(spark, "upsert")
    table = sinks.KeyedTable(spark, f"{at}/table", ["user_id", "event_type"], F.col("value") >= 20)
    rows = events(spark, sf_dir).select("user_id", "event_type", "ts", "event_id", "value")
    sinks.upsert_stream(rows, table, ["ts", "event_id"], f"{at}/checkpoint").awaitTermination()
    good = table.read().select("user_id", "event_type", "event_id", F.lit("stored").alias("at"))
    return good.unionByName(table.rejected().select("user_id", "event_type", "event_id", F.lit("rejected").alias("at")))


def upsert_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two queries into one table, the second (odd events) by another process with a checkpoint of its own; its batch is run again after the commit. What is told of the first is only in the table's folder."""
    at = fresh_folder(spark, "restart")
    rows = events(spark, sf_dir).select("user_id", "event_type", "ts", "event_id", "value")
    for part in (0, 1):
        table = sinks.KeyedTable(spark, f"{at}/table", ["user_id", "event_type"], buckets=16)
        sinks.upsert_stream(rows.where(F.col("event_id") % 2 == part), table, ["ts", "event_id"], f"{at}/checkpoint-{part}").awaitTermination()
        table.upsert(spark.createDataFrame([], rows.schema), 0, ["ts", "event_id"], f"{at}/checkpoint-{part}")
    return sinks.KeyedTable(spark, f"{at}/table", ["user_id", "event_type"]).read().select("user_id", "event_type", "event_id", "value")


def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames numbered into a table by a query that ends in the middle of a segment, and by a second one that has no checkpoint and finds its place in the table."""
    at = fresh_folder(spark, "resume")
    bounds = spark.read.parquet(f"{sf_dir}/events.parquet").agg(F.min("ts"), F.max("ts")).first()
    half = bounds[0] + (bounds[1] - bounds[0]) / 2
    rows = events_in_order(spark, sf_dir).where("event_id % 7 <> 0").select("user_id", "ts", F.date_format("ts", "yyyyMMdd").cast("int").alias("segment_number"), F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), "event_id")
    for k, part in enumerate((rows.where(F.col("ts") <= F.lit(half)), rows)):
        table = sinks.KeyedTable(spark, f"{at}/table", ["user_id", "event_id"], buckets=16)
        numbers = resume.resumed(part.drop("ts"), table.read(), "user_id", "segment_number", ["us", "event_id"])
        sinks.upsert_stream(numbers, table, ["frame_number"], f"{at}/checkpoint-{k}").awaitTermination()
    return sinks.KeyedTable(spark, f"{at}/table", ["user_id", "event_id"]).read().select("user_id", "event_id", "frame_number")


def stream_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as frames and their first three lines as models' answers, dealt over two batches without order; a frame far ahead in time ends the wait for the answers that never come."""
    at = fresh_folder(spark, "sync")
    time = lambda c: F.timestamp_seconds(F.col(c) + 86_400).alias("at")  # noqa: E731  a watermark begins at 1970, and what is not behind it is late
    frames = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("frame_number"), time("o_orderkey"))
    line = spark.read.parquet(f"{sf_dir}/lineitem.parquet").where("l_linenumber <= 3").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("q"))
    model = F.element_at(F.array(*map(F.lit, MODELS)), F.col("l_linenumber").cast("int"))
    answers = line.select(F.col("l_orderkey").alias("frame_number"), time("l_orderkey"), model.alias("model"), F.array(F.array(F.col("q").cast("double"))).alias("boxes"), F.array(F.lit(0.5)).alias("confidences"), F.array(F.col("l_linenumber").cast("double")).alias("classes"))
    both = frames.unionByName(answers, allowMissingColumns=True)
    far = frames.agg((F.max("frame_number") * 3 + 1_000_000).alias("frame_number")).select("frame_number", time("frame_number"))
    both.repartition(16, F.xxhash64("frame_number", "model")).write.parquet(f"{at}/in/1")
    far.coalesce(1).write.parquet(f"{at}/in/2")
    schema = both.schema
    stream = lambda k: spark.readStream.schema(schema).option("maxFilesPerTrigger", 8).parquet(f"{at}/in/{k}")
    greatest, n = frames.agg(F.max("frame_number"), F.count("*")).first()
    wide = sync.synchronised(stream("*").where("model is null").select("frame_number", "at"), stream("1").where("model is not null"), ["frame_number"], "at", 1000, lateness=f"{2 * (greatest or 0)} seconds", buckets=max(64, n // 4096))
    first = lambda c: F.coalesce(F.get(F.get(c, F.lit(0)), F.lit(0)), F.lit(0.0))
    return collected(wide.select("frame_number", F.size("cricket_model_boxes").alias("complete"), first(F.col("cricket_model_boxes")).alias("cricket"), first(F.col("person_detection_model_boxes")).alias("person")), spark)


def stream_flushes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of each user in flushes of twelve; the user's last event flushes what is held."""
    at = fresh_folder(spark, "flush")
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), "event_id")
    ends = e.groupBy("user_id").agg(F.max(F.struct("us", "event_id"))["event_id"].alias("end"))
    e.join(ends, "user_id").select("user_id", "us", "event_id", (F.col("event_id") == F.col("end")).alias("last")).write.parquet(f"{at}/in")
    stream = spark.readStream.schema("user_id bigint, us bigint, event_id bigint, last boolean").parquet(f"{at}/in")  # one batch: files of one write have no order
    out = sync.flushed(stream, "user_id", ["us", "event_id"], every_ms=None, last="last")
    return collected(out.select("user_id", "event_id", "flush", "why"), spark)


def stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two queries over the events, the second started after the first one's progress; their counts as the table of progress has them."""
    at = fresh_folder(spark, "metrics")

    def start(name: str, flag: str):
        rows = metrics.counted(events(spark, sf_dir).select("event_id", "event_type", "value"), name, chosen=F.expr(flag))
        return lambda: rows.writeStream.queryName(f"{name}-{uuid.uuid4().hex}").format("parquet").option("path", f"{at}/{name}").option("checkpointLocation", f"{at}/{name}-checkpoint").trigger(availableNow=True).start()

    table = metrics.ProgressTable(spark, f"{at}/progress")
    with table:
        for query in metrics.staged(start("metadata", "event_type = 'click'"), start("detections", "value > 50"), timeout=300):
            query.awaitTermination()
        metrics.settled(table, 2, timeout=60)
    totals = table.read().withColumn("name", F.substring_index("name", "-", 1)).groupBy("name").agg(F.sum("input_rows").alias("input_rows"), F.sum(F.col("counts")["rows"]).alias("rows"), F.sum(F.col("counts")["chosen"]).alias("chosen"))
    return totals.where("name in ('metadata', 'detections')")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"stream_frame_numbering": stream_frame_numbering, "stream_debounce": stream_debounce, "stream_dedupe": stream_dedupe} | {f.__name__: f for f in (stream_cuts, stream_cuts_strict, stream_new_segments, csv_append, upsert_detections, upsert_restart, stream_resume, stream_sync, stream_flushes, stream_metrics)}
