"""Registered queries over the synthetic tables, each with the DuckDB SQL that gives the same rows.

events stand for a stream of frames (user = match), embeddings for frame features (label = match), lineitem for detections (order = frame), pages for
segment addresses, documents for playlist text, orders for playlists whose lines are made from their keys.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark import analyzers
from reelspark.analyzers import models
from reelspark.functions import arrays as A
from reelspark.functions import games
from reelspark.functions import numeric as N
from reelspark.functions import text as T
from reelspark.operators import cuts, detections, frames, playlist
from reelspark.plans import pictures
from reelspark.sources import probes
from reelspark.streaming import queries as streaming

GAP = 6 * 3600 * 1_000_000  # of events, in microseconds
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return QUERIES | pictures.queries() | streaming.queries()


def oracle_sql() -> dict[str, str]:
    return SQL | pictures.oracle_sql() | {"stream_frame_numbering": STREAM_NUMBERING_SQL, "stream_debounce": SQL["debounce_events"], "stream_dedupe": STREAM_DEDUPE_SQL, "stream_new_segments": STREAM_SEGMENTS_SQL, "csv_append": CSV_SQL, "upsert_detections": UPSERT_SQL, "upsert_restart": RESTART_SQL, "stream_resume": STREAM_NUMBERING_SQL, "stream_sync": SQL["three_model_merge"], "stream_flushes": FLUSH_SQL, "stream_metrics": METRICS_SQL} | STREAM_CUTS_SQL


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Cuts ------------------------------------------------------------------------------------------------------------------------


def frame_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    placed = frames.number_frames(e.withColumn("segment", F.expr("vec_id div 1000")), "label", "segment", ["vec_id"], F.lit(True))
    return placed.select(F.col("label").cast("bigint").alias("match_id"), "frame_number", F.col("embedding").alias("vector"), N.median_bits(F.col("embedding")).alias("bits"))


COMPARED_SQL = """
WITH RECURSIVE f AS (
  SELECT label::BIGINT AS match_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS frame_number, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
g AS (SELECT *, list_transform(v, lambda x: x > (list_sort(v)[(len(v) + 1) // 2] + list_sort(v)[len(v) // 2 + 1]) / 2) AS b FROM f),
p AS (SELECT *, lag(v) OVER w AS u, lag(b) OVER w AS a FROM g WINDOW w AS (PARTITION BY match_id ORDER BY frame_number)),
c AS (
  SELECT match_id, frame_number, list_sum(list_transform(range(1, len(v) + 1), lambda i: (a[i] <> b[i])::INT))::INT AS hamming,
    (list_sum(list_transform(range(1, len(v) + 1), lambda i: u[i] * v[i])) - list_sum(u) * list_sum(v) / len(v)) /
    nullif(sqrt((list_sum(list_transform(u, lambda x: x * x)) - list_sum(u) ** 2 / len(v)) * (list_sum(list_transform(v, lambda x: x * x)) - list_sum(v) ** 2 / len(v))), 0) AS correlation
  FROM p)"""


@query(COMPARED_SQL + " SELECT match_id, frame_number, coalesce(hamming, -1) AS hamming, round(correlation, 5) AS correlation, coalesce(hamming >= 20 AND (correlation IS NULL OR correlation < 0.9), false) AS is_cut FROM c")
def cut_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = cuts.compared(frame_features(spark, sf_dir))
    return seen.select("match_id", "frame_number", F.coalesce("hamming", F.lit(-1)).alias("hamming"), F.round("correlation", 5).alias("correlation"), cuts.is_cut().alias("is_cut"))


def kept_cuts(spark: SparkSession, sf_dir: str, least: int, gap: int) -> DataFrame:
    return cuts.debounce(cuts.compared(frame_features(spark, sf_dir)).where(cuts.is_cut(least)), "match_id", "frame_number", gap)


def kept_sql(least: int, gap: int) -> str:
    return f"""{COMPARED_SQL},
e AS (SELECT match_id AS k, frame_number AS f FROM c WHERE hamming >= {least} AND (correlation IS NULL OR correlation < 0.9)),
r AS (
  SELECT k, min(f) AS f FROM e GROUP BY k
  UNION ALL
  SELECT k, nf FROM (SELECT r.k, (SELECT min(e.f) FROM e WHERE e.k = r.k AND e.f >= r.f + {gap}) AS nf FROM r) WHERE nf IS NOT NULL)"""


@query(kept_sql(20, 25) + " SELECT k AS match_id, f - 1 AS frame_number, f AS cut_frame FROM r")
def cut_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = kept_cuts(spark, sf_dir, 20, 25)
    return kept.select("match_id", (F.col("frame_number") - 1).alias("frame_number"), F.col("frame_number").alias("cut_frame"))


@query(kept_sql(32, 3) + " SELECT k AS match_id, f - 1 AS frame_number, f AS cut_frame FROM r")
def cut_events_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = kept_cuts(spark, sf_dir, 32, 3)
    return kept.select("match_id", (F.col("frame_number") - 1).alias("frame_number"), F.col("frame_number").alias("cut_frame"))


@query(kept_sql(32, 3) + " SELECT match_id, frame_number, (1 + count(k) OVER (PARTITION BY match_id ORDER BY frame_number))::BIGINT AS shot_id FROM f LEFT JOIN r ON k = match_id AND r.f = frame_number")
def shot_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cuts.shots(frame_features(spark, sf_dir).select("match_id", "frame_number"), kept_cuts(spark, sf_dir, 32, 3), "match_id", "frame_number")


@query(kept_sql(32, 3) + " SELECT g.match_id, g.frame_number, coalesce(r.f, 0) AS cut_frame FROM g ASOF LEFT JOIN r ON r.k = g.match_id AND g.frame_number >= r.f")
def asof_shot(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cuts.latest_cut(frame_features(spark, sf_dir).select("match_id", "frame_number"), kept_cuts(spark, sf_dir, 32, 3), "match_id", "frame_number")
    return found.select("match_id", "frame_number", F.coalesce("cut_frame", F.lit(0)).alias("cut_frame"))


@query("""
SELECT label::BIGINT AS match_id, vec_id, list_position(list_transform(range(8), lambda b: len(list_filter(embedding, lambda x: floor((x::DOUBLE + 4) * 8 / 8) = b))), 0) IS NULL AS full_range,
  len(list_filter(embedding, lambda x: floor((x::DOUBLE + 4) * 8 / 8) = 4))::INT AS bin_4, len(list_filter(embedding, lambda x: floor((x::DOUBLE + 4) * 8 / 8) = 3))::INT AS bin_3 FROM embeddings""")
def histogram_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = A.counts_by_bin(F.transform("embedding", lambda x: x.cast("double") + 4), 8, 8.0)
    e = table(spark, sf_dir, "embeddings").select(F.col("label").cast("bigint").alias("match_id"), "vec_id", counts.alias("c"))
    return e.select("match_id", "vec_id", (~F.array_contains("c", 0)).alias("full_range"), F.get("c", 4).alias("bin_4"), F.get("c", 3).alias("bin_3"))


# Streams of frames -----------------------------------------------------------------------------------------------------------


def micros(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))


@query(f"""
WITH RECURSIVE e AS (SELECT DISTINCT user_id AS k, epoch_us(ts) AS f FROM events),
r AS (
  SELECT k, min(f) AS f FROM e GROUP BY k
  UNION ALL
  SELECT k, nf FROM (SELECT r.k, (SELECT min(e.f) FROM e WHERE e.k = r.k AND e.f >= r.f + {GAP}) AS nf FROM r) WHERE nf IS NOT NULL)
SELECT k AS user_id, f AS us FROM r""")
def debounce_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cuts.debounce(micros(spark, sf_dir), "user_id", "us", GAP)


NUMBERED_SQL = """
WITH n AS (SELECT *, row_number() OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY ts, event_id) - 1 AS ts_frame FROM events),
m AS (
  SELECT user_id, event_id, strftime(ts, '%Y%m%d')::INT AS segment_number, ts_frame::INT AS ts_frame, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS frame_number, ts
  FROM n WHERE event_id % 7 <> 0)"""


def numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("segment_number", F.date_format("ts", "yyyyMMdd").cast("int"))
    return frames.number_frames(e, "user_id", "segment_number", ["ts", "event_id"], F.col("event_id") % 7 != 0)


@query(NUMBERED_SQL + " SELECT user_id, event_id, segment_number, ts_frame, frame_number FROM m")
def frame_numbering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered(spark, sf_dir).select("user_id", "event_id", "segment_number", "ts_frame", "frame_number")


NEWEST_SQL = NUMBERED_SQL + ", t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rank FROM m) WHERE rank <= 30)"


@query(NEWEST_SQL + " SELECT user_id, event_id, segment_number, frame_number, rank::INT AS rank FROM t")
def topn_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.newest(numbered(spark, sf_dir), "user_id", ["ts", "event_id"], 30).select("user_id", "event_id", "segment_number", "frame_number", "rank")


RESUME_SQL = " SELECT u.user_id, CASE WHEN u.user_id % 3 <> 0 THEN coalesce(p.s, {s}) ELSE {s} END::BIGINT AS segment_number, CASE WHEN u.user_id % 3 <> 0 THEN coalesce(p.f, 1) ELSE 1 END::BIGINT AS frame_number FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN p USING (user_id)"


def resumed(spark: SparkSession, sf_dir: str, how, segment: int) -> DataFrame:
    matches = table(spark, sf_dir, "events").select("user_id").distinct()
    return frames.with_default(matches, how(frames.newest(numbered(spark, sf_dir), "user_id", ["ts", "event_id"], 30), "user_id"), "user_id", F.col("user_id") % 3 != 0, segment)


@query(NEWEST_SQL + ", x AS (SELECT user_id, max(segment_number) AS s FROM t GROUP BY user_id), p AS (SELECT user_id, s, min(frame_number) AS f FROM t JOIN x USING (user_id) WHERE segment_number = s GROUP BY ALL)" + RESUME_SQL.format(s=0))
def resume_position_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resumed(spark, sf_dir, frames.resume_latest, 0)


@query(NEWEST_SQL + ", x AS (SELECT user_id, list_reverse_sort(list(DISTINCT segment_number)) AS l FROM t GROUP BY user_id), p AS (SELECT user_id, segment_number + 1 AS s, max(frame_number) + 1 AS f FROM t JOIN x USING (user_id) WHERE segment_number = coalesce(l[2], l[1]) GROUP BY ALL)" + RESUME_SQL.format(s=1))
def resume_position_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resumed(spark, sf_dir, frames.resume_before_latest, 1)


@query(NUMBERED_SQL + " SELECT user_id, array_to_string(list_sort(list(DISTINCT segment_number)), ',') AS segments, list_sort(list(DISTINCT segment_number))[-1] AS latest FROM m GROUP BY user_id")
def distinct_sorted_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = numbered(spark, sf_dir).groupBy("user_id").agg(F.sort_array(F.collect_set("segment_number")).alias("s"))
    return found.select("user_id", F.array_join(F.transform("s", lambda x: x.cast("string")), ",").alias("segments"), F.element_at("s", -1).alias("latest"))


@query("SELECT event_id, event_id // 8 AS batch_id, ((event_id // 8) % 4)::INT AS queue_id FROM events")
def batch_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.assign_batches(table(spark, sf_dir, "events").select("event_id"), "event_id", 8, 4)


@query("SELECT event_id, user_id, value FROM events WHERE event_id % 600 = 0")
def sampled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").where("event_id % 600 = 0").select("event_id", "user_id", "value")


@query("SELECT event_id, (props->>'$.k')::BIGINT AS k, coalesce((props->>'$.missing')::BIGINT, -1) AS missing FROM events")
def props_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.from_json("props", "k bigint, missing bigint")
    return table(spark, sf_dir, "events").select("event_id", p["k"].alias("k"), F.coalesce(p["missing"], F.lit(-1)).cast("bigint").alias("missing"))


@query("SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def dedupe_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id", "value")
    return detections.last_wins(e, ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id", "value")


@query("""
SELECT 'clicks' AS analyzer, event_id AS id, value FROM events WHERE event_type = 'click' AND value > 50
UNION ALL BY NAME SELECT 'orders' AS analyzer, o_orderkey AS id, o_orderstatus AS status FROM orders WHERE o_totalprice > 200000""")
def request_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "events").where("event_type = 'click' and value > 50").select(F.lit("clicks").alias("analyzer"), F.col("event_id").alias("id"), "value")
    b = table(spark, sf_dir, "orders").where("o_totalprice > 200000").select(F.lit("orders").alias("analyzer"), F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))
    return a.unionByName(b, allowMissingColumns=True)


# Playlists -------------------------------------------------------------------------------------------------------------------

PLAYLISTS = """
SELECT o_orderkey AS k, CASE o_orderkey % 5
  WHEN 0 THEN concat('#EXTM3U\\n#EXT-X-STREAM-INF:BANDWIDTH=1,RESOLUTION=854x480\\nv', o_orderkey, '_480p.m3u8\\n#EXT-X-STREAM-INF:RESOLUTION=1920x1080\\nv', o_orderkey, '_1080p.m3u8')
  WHEN 1 THEN concat('#EXTM3U\\n#EXTINF:6.25,\\ns_', o_orderkey, '.ts\\n#EXTINF:', o_custkey % 9 + 1, ',\\ns_', o_orderkey + 1, '.ts\\n#EXT-X-ENDLIST')
  WHEN 2 THEN concat('#EXT-X-PLAYLIST-TYPE:EVENT\\n#EXTINF:4,\\n s_', o_orderkey, '.ts ')
  WHEN 3 THEN concat('#EXT-X-STREAM-INF:RESOLUTION=640x360\\na', o_orderkey, '.m3u8\\n#EXT-X-STREAM-INF:RESOLUTION=360x640\\nb.m3u8\\n#EXT-X-STREAM-INF:BANDWIDTH=5')
  ELSE concat('#EXTM3U\\n#EXTINF:5.5,\\ns_x.ts') END AS body FROM orders"""
LINES_SQL = "WITH b AS (" + PLAYLISTS.replace("\\n", "' || chr(10) || '") + "), l AS (SELECT k, i - 1 AS line_no, trim(string_split(body, chr(10))[i]) AS line FROM b, unnest(range(1, len(string_split(body, chr(10))) + 1)) AS t(i))"


def playlists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(PLAYLISTS.replace("FROM orders", "FROM {orders}"), orders=table(spark, sf_dir, "orders"))


def playlist_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return playlist.lines(playlists(spark, sf_dir), "k", "body")


@query("""
WITH l AS (SELECT doc_id, i - 1 AS line_no, trim(string_split(text, chr(10))[i]) AS line FROM documents, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS t(i))
SELECT doc_id, count(*) AS lines, count(*) FILTER (line LIKE '%.') AS ends, count(*) FILTER (line LIKE 'The%') AS starts, max(length(line))::BIGINT AS longest FROM l GROUP BY doc_id""")
def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = playlist.lines(table(spark, sf_dir, "documents"), "doc_id", "text")
    flag = lambda c: F.sum(c.cast("bigint"))
    return found.groupBy("doc_id").agg(F.count("*").alias("lines"), flag(F.endswith("line", F.lit("."))).alias("ends"), flag(F.startswith("line", F.lit("The"))).alias("starts"), F.max(F.length("line")).cast("bigint").alias("longest"))


@query(LINES_SQL + " SELECT k, line_no::INT AS line_no, line, ends_with(line, '.ts') AS is_segment, starts_with(line, '#EXT-X-STREAM-INF') AS is_variant, line = '#EXT-X-ENDLIST' AS is_end FROM l")
def playlist_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return playlist.kinds(playlist_rows(spark, sf_dir))


VARIANTS_SQL = LINES_SQL + """, p AS (SELECT *, lead(line) OVER (PARTITION BY k ORDER BY line_no) AS url FROM l),
v AS (SELECT k, line_no::INT AS line_no, regexp_extract(line, 'RESOLUTION=(\\d+)x(\\d+)', 1)::BIGINT * regexp_extract(line, 'RESOLUTION=(\\d+)x(\\d+)', 2)::BIGINT AS pixels, url
  FROM p WHERE starts_with(line, '#EXT-X-STREAM-INF') AND line LIKE '%RESOLUTION=%' AND url IS NOT NULL)"""


@query(VARIANTS_SQL + " SELECT k, line_no, pixels, url FROM v")
def next_line_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return playlist.variants(playlist_rows(spark, sf_dir), "k")


@query(VARIANTS_SQL + " SELECT k, pixels, url FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY pixels DESC, line_no) AS r FROM v) WHERE r = 1")
def best_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return playlist.best_variant(playlist_rows(spark, sf_dir), "k")


@query(LINES_SQL + " SELECT k, arg_min(line, line_no) FILTER (ends_with(line, '_480p.m3u8')) AS url FROM l GROUP BY k")
def variant_by_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return playlist.with_suffix(playlist_rows(spark, sf_dir), "k", "_480p.m3u8")


@query(LINES_SQL + " SELECT k, coalesce(live::VARCHAR, 'as its best variant') AS is_live FROM (SELECT k, CASE WHEN bool_or(line IN ('#EXT-X-ENDLIST', '#EXT-X-PLAYLIST-TYPE:VOD')) THEN false WHEN bool_or(line = '#EXT-X-PLAYLIST-TYPE:EVENT') THEN true WHEN bool_or(starts_with(line, '#EXT-X-STREAM-INF')) THEN NULL ELSE true END AS live FROM l GROUP BY k)")
def is_live_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return playlist.is_live(playlist_rows(spark, sf_dir), "k").select("k", F.coalesce(F.col("is_live").cast("string"), F.lit("as its best variant")).alias("is_live"))


@query(LINES_SQL.split(", l AS")[0] + " SELECT k, coalesce(list_sum(list_transform(regexp_extract_all(body, '#EXTINF:([0-9.]+),', 1), lambda x: x::DOUBLE)), 0)::DOUBLE AS seconds, len(regexp_extract_all(body, '#EXTINF:([0-9.]+),', 1))::BIGINT AS segments FROM b")
def duration_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return playlist.total_duration(playlists(spark, sf_dir), "k", "body")


@query(LINES_SQL + " SELECT k % 100 AS k, line, min(k) AS poll FROM l WHERE ends_with(line, '.ts') GROUP BY ALL")
def new_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    polls = playlist_rows(spark, sf_dir).withColumnRenamed("k", "poll").withColumn("k", F.col("poll") % 100)
    return playlist.new_segments(polls, "k", "poll").select("k", "line", "poll")


@query("""
SELECT page_id, string_split(url, '/')[-1] AS base_name, regexp_replace(url, '/[^/]*$', '') AS base,
  regexp_replace(url, '/[^/]*$', '') || '/seg_' || page_id || '.ts' AS naive, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || '/live/x.ts' AS rooted,
  try_cast(string_split(string_split('v_480p_' || lpad(page_id::VARCHAR, 5, '0') || '.ts', '_')[-1], '.')[1] AS INT) AS segment_number FROM pages""")
def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    name = F.concat(F.lit("v_480p_"), F.lpad(F.col("page_id").cast("string"), 5, "0"), F.lit(".ts"))
    return table(spark, sf_dir, "pages").select(
        "page_id", T.basename(url).alias("base_name"), T.base_url(url).alias("base"), T.naive_join(T.base_url(url), F.concat(F.lit("seg_"), F.col("page_id").cast("string"), F.lit(".ts"))).alias("naive"),
        T.url_join(url, F.lit("/live/x.ts")).alias("rooted"), T.segment_number(name).alias("segment_number"),
    )


# Numbers ---------------------------------------------------------------------------------------------------------------------


@query("""
WITH t AS (SELECT o_orderkey, o_orderkey / 25.0::DOUBLE AS s FROM orders)
SELECT o_orderkey, printf('%02d:%02d:%06.3f', (floor(s / 3600))::INT, (floor(s % 3600 / 60))::INT, s - floor(s / 60) * 60) AS full_form,
  printf('%02d_%02d_%02d', (floor(s / 3600))::INT, (floor(s % 3600 / 60))::INT, (floor(s - floor(s / 60) * 60))::INT) AS short_form, printf('%.3f', s) AS seconds FROM t""")
def timecodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    f, fps = F.col("o_orderkey"), F.lit(25.0)
    return table(spark, sf_dir, "orders").select("o_orderkey", N.timecode(f, fps, "HH:MM:SS.mmm").alias("full_form"), N.timecode(f, fps, "HH_MM_SS").alias("short_form"), N.timecode(f, fps, "Seconds").alias("seconds"))


@query("SELECT l_orderkey, l_linenumber, round_even(l_quantity / 8 + l_linenumber / 16.0::DOUBLE, 2) AS rounded FROM lineitem")
def round_half_even(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", N.half_even(F.col("l_quantity") / 8 + F.col("l_linenumber") / 16).alias("rounded"))


# Detections ------------------------------------------------------------------------------------------------------------------

CLASS = "CASE l_linenumber % 4 WHEN 0 THEN 0 WHEN 1 THEN 17 WHEN 2 THEN 32 ELSE 5 END"


@query(f"SELECT l_orderkey, l_linenumber, CASE {CLASS} WHEN 0 THEN 1 WHEN 17 THEN 2 WHEN 32 THEN 0 END::INT AS class_id FROM lineitem WHERE {CLASS} IN (0, 17, 32)")
def class_remap(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.expr(CLASS).alias("cls")).where(F.col("cls").isin(detections.ALLOWED))
    return d.select("l_orderkey", "l_linenumber", F.get(A.remap(F.array("cls"), detections.REMAP), F.lit(0)).alias("class_id"))


def detection_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("frame_number"), F.struct("l_linenumber", "l_quantity", "l_discount", F.expr(CLASS).alias("cls")).alias("d"))
    rows = d.groupBy("frame_number").agg(F.sort_array(F.collect_list("d")).alias("d"))
    return rows.select("frame_number", F.transform("d", lambda d: F.array(d["l_quantity"])).alias("boxes"), F.transform("d", lambda x: x["l_discount"]).alias("confidences"), F.transform("d", lambda x: x["cls"].cast("double")).alias("classes"))


@query(f"SELECT l_orderkey AS frame_number, count(*) FILTER ({CLASS} = 0)::INT AS persons, coalesce(string_agg(l_quantity::INT, ',' ORDER BY l_linenumber, l_quantity) FILTER ({CLASS} = 0), '') AS boxes FROM lineitem GROUP BY l_orderkey")
def person_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = detections.person_only(detection_arrays(spark, sf_dir))
    return kept.select("frame_number", F.size("classes").alias("persons"), F.array_join(F.transform("boxes", lambda b: F.get(b, 0).cast("int").cast("string")), ",").alias("boxes"))


MODEL = "CASE l_linenumber WHEN 1 THEN 'cricket_model' WHEN 2 THEN 'person_head_model' WHEN 3 THEN 'person_detection_model' END"


@query("""
WITH w AS (SELECT l_orderkey, max(l_quantity) FILTER (l_linenumber = 1) AS a, max(l_quantity) FILTER (l_linenumber = 2) AS b, max(l_quantity) FILTER (l_linenumber = 3) AS c FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey AS frame_number, (a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL)::INT AS complete,
  CASE WHEN a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL THEN a ELSE 0 END AS cricket, CASE WHEN a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL THEN c ELSE 0 END AS person
FROM orders LEFT JOIN w ON l_orderkey = o_orderkey""")
def three_model_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem").where("l_linenumber <= 3").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("q"))
    d = line.select(F.col("l_orderkey").alias("frame_number"), F.expr(MODEL).alias("model"), F.array(F.array("q")).alias("boxes"), F.array(F.lit(0.5)).alias("confidences"), F.array("l_linenumber").alias("classes"))
    every = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("frame_number"))
    wide = detections.merge_models(every, d, ["frame_number"])
    first = lambda c: F.coalesce(F.get(F.get(c, F.lit(0)), F.lit(0)), F.lit(0.0))
    return wide.select("frame_number", F.size("cricket_model_boxes").alias("complete"), first(F.col("cricket_model_boxes")).alias("cricket"), first(F.col("person_detection_model_boxes")).alias("person"))


@query(f"SELECT l_orderkey AS match_id, l_linenumber::BIGINT AS frame_number, round_even(l_extendedprice::FLOAT::DOUBLE, 2)::DECIMAL(10,2)::DOUBLE AS box, round_even(l_discount::FLOAT::DOUBLE, 2)::DECIMAL(10,2)::DOUBLE AS confidence, ({CLASS})::INT AS class_id FROM lineitem")
def items_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.array(F.array(F.col("l_extendedprice").cast("float"))).alias("boxes"), F.array(F.col("l_discount").cast("float")).alias("conf"), F.expr(CLASS).cast("int").alias("class_id"))
    return x.select(F.col("l_orderkey").alias("match_id"), F.col("l_linenumber").cast("bigint").alias("frame_number"), F.get(F.get(A.nested_decimals(F.col("boxes")), F.lit(0)), F.lit(0)).cast("double").alias("box"), F.get(A.decimals(F.col("conf")), F.lit(0)).cast("double").alias("confidence"), "class_id")


@query("SELECT o_orderkey AS frame_number, o_orderstatus AS status, l_linenumber, l_quantity AS box FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F'")
def detections_x_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("frame_number"), F.col("o_orderstatus").alias("status"))
    d = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("frame_number"), "l_linenumber", F.col("l_quantity").alias("box"))
    return every.join(d, "frame_number")


@query("SELECT p_partkey, p_brand, CASE WHEN p_brand IN ('Brand#11', 'Brand#23', 'Brand#45') THEN p_brand ELSE 'default' END AS folder, 'models/' || CASE WHEN p_brand IN ('Brand#11', 'Brand#23', 'Brand#45') THEN p_brand ELSE 'default' END || '/latest.pt' AS location FROM part")
def model_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = detections.model_folder(F.col("p_brand"), ["Brand#11", "Brand#23", "Brand#45"])
    return table(spark, sf_dir, "part").select("p_partkey", "p_brand", folder.alias("folder"), T.model_location(F.lit("models"), folder).alias("location"))


@query("SELECT c_custkey, c_name FROM customer c WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def registry_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").join(o, "c_custkey", "left_semi").select("c_custkey", "c_name")


@query("SELECT c_custkey, c_name FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def registry_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").join(o, "c_custkey", "left_anti").select("c_custkey", "c_name")


@query("SELECT r_name AS region, n_name AS nation, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL")
def dimension_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    counted = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").alias("c"))
    joined = counted.join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.groupBy(F.col("r_name").alias("region"), F.col("n_name").alias("nation")).agg(F.sum("c").alias("customers"))


# The rest of the functions and records ----------------------------------------------------------------------------------------


@query("""
WITH t AS (SELECT o_orderkey, (o_orderkey % 50) * 1000 AS num, CASE o_custkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 1000 ELSE 1001 END AS den FROM orders)
SELECT o_orderkey, CASE WHEN den = 0 THEN 0 ELSE round(num::DOUBLE / nullif(den, 0), 6) END::DOUBLE AS fps FROM t""")
def frame_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratio = F.expr("concat(o_orderkey % 50 * 1000, '/', case o_custkey % 3 when 0 then 0 when 1 then 1000 else 1001 end)")
    return table(spark, sf_dir, "orders").select("o_orderkey", N.frame_rate(ratio).alias("fps"))


@query("SELECT o_orderkey, o_orderkey / 25.0::DOUBLE AS seconds, trunc(o_totalprice * 29.97::DOUBLE)::BIGINT AS frame, trunc(o_custkey * 12.5::DOUBLE)::BIGINT AS total FROM orders")
def frame_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select("o_orderkey", N.frame_to_seconds(f, F.lit(25.0)).alias("seconds"), N.seconds_to_frame(F.col("o_totalprice"), F.lit(29.97)).alias("frame"), N.total_frames(F.col("o_custkey"), F.lit(12.5)).alias("total"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS stamp FROM events")
def utc_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", T.utc_stamp(F.col("ts")).alias("stamp"))


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 3 > 0 THEN 'zone-' || s_nationkey END AS region FROM supplier""")
def queue_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.expr("case when s_suppkey % 3 > 0 then concat('https://sqs.zone-', s_nationkey, '.example.com/1/q') else s_name end")
    return table(spark, sf_dir, "supplier").select("s_suppkey", T.queue_region(url).alias("region"))


@query("""
WITH t AS (SELECT o_orderkey, o_orderkey / 25.0::DOUBLE AS s FROM orders)
SELECT o_orderkey, printf('%02d:%02d:%02d', (floor(s / 3600))::INT, (floor(s % 3600 / 60))::INT, (floor(s - floor(s / 60) * 60))::INT) AS clock,
  printf('%02d_%02d_%.3f', (floor(s / 3600))::INT, (floor(s % 3600 / 60))::INT, s - floor(s / 60) * 60) AS file_form, '00:00:00.000' AS no_rate, NULL::VARCHAR AS no_form FROM t""")
def timecode_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    f, fps = F.col("o_orderkey"), F.lit(25.0)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", N.timecode(f, fps, "HH:MM:SS").alias("clock"), N.timecode(f, fps, "HH_MM_SS_mmm").alias("file_form"), N.timecode(f, F.lit(0.0), "HH:MM:SS").alias("no_rate"), N.timecode(f, fps, "other").alias("no_form")
    )


@query("""
WITH t AS (SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS host, split_part(split_part(url, '?', 1), '#', 1) AS plain, split_part(url, ':', 1) AS scheme, url FROM pages),
b AS (SELECT *, regexp_replace(plain, '/[^/]*$', '') AS folder FROM t)
SELECT page_id, CASE page_id % 8
  WHEN 0 THEN folder || '/c.ts' WHEN 1 THEN host || '/live/c.ts' WHEN 2 THEN CASE WHEN length(folder) > length(host) THEN regexp_replace(folder, '/[^/]*$', '') ELSE host END || '/up/c.ts' WHEN 3 THEN 'http://x.example/a/../c.ts' WHEN 4 THEN scheme || '://y.example/c.ts'
  WHEN 5 THEN folder || '/e.ts?a=../b' WHEN 6 THEN host || '/c/' ELSE plain || '?k=1' END AS url FROM b""")
def url_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    forms = ["c.ts", "/live/c.ts", "../up/c.ts", "http://x.example/a/../c.ts", "//y.example/c.ts", "./d/../e.ts?a=../b", "../../../c/x/..", "?k=1"]
    relative = F.element_at(F.array(*map(F.lit, forms)), (F.col("page_id") % 8 + 1).cast("int"))
    return table(spark, sf_dir, "pages").select("page_id", T.url_join(F.col("url"), relative).alias("url"))


GAMES_SQL = "(VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in games.GAMES.items()) + ") AS g(game, game_id)"
NAME_SQL = "CASE WHEN p_partkey % 3 = 0 THEN 'cricket' WHEN p_partkey % 3 = 1 THEN 'judo' WHEN p_partkey % 5 = 0 THEN 'fencing' WHEN p_partkey % 5 = 1 THEN 'table_tennis_olympics' WHEN p_partkey % 5 = 2 THEN 'cricket-2' ELSE p_brand END"


@query(f"SELECT p_partkey, n.game, game_id FROM (SELECT p_partkey, {NAME_SQL} AS game FROM part) n LEFT JOIN {GAMES_SQL} ON n.game = g.game")
def game_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return games.with_game_id(table(spark, sf_dir, "part").select("p_partkey", F.expr(NAME_SQL).alias("game")))


@query(f"SELECT p_partkey, CASE {NAME_SQL} WHEN 'judo' THEN 'combat' WHEN 'fencing' THEN 'athletic' WHEN 'table_tennis_olympics' THEN 'racket' END AS family FROM part")
def sport_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", games.family(F.expr(NAME_SQL)).alias("family"))


@query(f"SELECT p_partkey, {NAME_SQL} IN ('cricket', 'cricket-2') AND p_size % 2 = 0 AS three FROM part")
def three_model_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = games.with_game_id(table(spark, sf_dir, "part").select("p_partkey", F.expr(NAME_SQL).alias("game"), F.expr("case when p_size % 2 = 0 then 'false' when p_size % 3 = 0 then 'True' end").alias("flag")))
    return named.select("p_partkey", detections.three_model_mode(F.col("game_id"), F.col("flag")).alias("three"))


@query("""
WITH w AS (SELECT l_orderkey AS k, max(l_quantity) FILTER (l_linenumber = 1) AS a, max(l_quantity) FILTER (l_linenumber = 2) AS b, max(l_quantity) FILTER (l_linenumber = 3) AS c FROM lineitem GROUP BY l_orderkey)
SELECT k AS frame_number, CASE WHEN a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL THEN 'three_model' ELSE 'single' END AS shape,
  CASE WHEN a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL THEN 3 ELSE 1 END::INT AS parts, CASE WHEN a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL THEN c ELSE -1 END AS person FROM w""")
def stored_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(*[F.max(F.when(F.col("l_linenumber") == k + 1, F.col("l_quantity"))).alias(f"q{k}") for k in range(3)])
    arrays = lambda q, prefix: [F.when(q.isNotNull(), F.array(F.array(q))).alias(f"{prefix}boxes"), F.array(F.lit(0.5)).alias(f"{prefix}confidences"), F.array(F.lit(0)).alias(f"{prefix}classes")]
    wide = line.select(F.lit("m").alias("match_id"), F.col("l_orderkey").alias("frame_number"), *arrays(F.lit(-1.0), ""), *[c for k, m in enumerate(detections.MODELS) for c in arrays(F.col(f"q{k}"), f"{m}_")])
    items, person = detections.stored_items(wide), F.lit("person_detection_model")
    boxes = F.coalesce(F.try_element_at("items", person), F.try_element_at("items", F.lit("single")))["boxes"]
    return items.select("frame_number", "shape", F.size("items").alias("parts"), F.get(F.get(boxes, 0), 0).alias("person"))


@query(f"SELECT l_orderkey AS frame_number, coalesce(string_agg(l_linenumber, ',' ORDER BY l_linenumber, l_quantity) FILTER (l_discount >= 0.05), '') AS kept FROM lineitem GROUP BY l_orderkey")
def confidence_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("frame_number"), F.struct("l_linenumber", "l_quantity", "l_discount").alias("d"))
    rows = d.groupBy("frame_number").agg(F.sort_array(F.collect_list("d")).alias("d"))
    part = lambda c: F.transform("d", lambda x: x[c])
    kept = detections.confident(rows.select("frame_number", F.transform("d", lambda x: F.array(x["l_quantity"])).alias("boxes"), part("l_discount").alias("confidences"), part("l_linenumber").alias("classes")), 0.05)
    return kept.select("frame_number", F.array_join(F.transform("classes", lambda x: x.cast("string")), ",").alias("kept"))


@query(kept_sql(32, 3) + " SELECT r.k AS match_id, row_number() OVER (PARTITION BY r.k ORDER BY r.f) AS change_id, r.f AS idx, printf('%02d_%02d_%02d', 0, (r.f // 1500)::INT, (r.f % 1500 // 25)::INT) AS tc, round(c.correlation, 5) AS sim FROM r JOIN c ON c.match_id = r.k AND c.frame_number = r.f")
def cuts_detailed(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = cuts.compared(frame_features(spark, sf_dir)).join(kept_cuts(spark, sf_dir, 32, 3), ["match_id", "frame_number"], "left_semi")
    return cuts.change_records(kept, 25.0, form="HH_MM_SS").withColumn("sim", F.round("sim", 5))


BINS_SQL = """
WITH p AS (SELECT vec_id, floor((embedding[3 * i + 1]::DOUBLE + 1) * 128 * 50 / 256)::INT AS h, floor((embedding[3 * i + 2]::DOUBLE + 1) * 128 * 50 / 256)::INT AS s, floor((embedding[3 * i + 3]::DOUBLE + 1) * 128 * 50 / 256)::INT AS v
  FROM embeddings, unnest(range(0, len(embedding) // 3)) AS t(i)),
b AS (SELECT vec_id, (h * 50 + s) * 50 + v AS bin, count(*) AS count FROM p WHERE h BETWEEN 0 AND 49 AND s BETWEEN 0 AND 49 AND v BETWEEN 0 AND 49 GROUP BY ALL)"""


def picture_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = lambda k: F.get("embedding", F.col("i") * 3 + k)
    pixels = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.explode(F.sequence(F.lit(0), F.floor(F.size("embedding") / 3).cast("int") - 1)).alias("i"))
    scaled = pixels.select("vec_id", *[((value(k).cast("double") + 1) * 128).alias(c) for k, c in enumerate("hsv")])
    return cuts.histogram_3d(scaled, ["vec_id"], ("h", "s", "v"))


@query(BINS_SQL + " SELECT vec_id, bin, count FROM b")
def histogram_3d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return picture_bins(spark, sf_dir)


@query(BINS_SQL + " SELECT vec_id, bin, round(count / sqrt(sum(count * count) OVER (PARTITION BY vec_id)), 6) AS share FROM b")
def histogram_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cuts.normalised(picture_bins(spark, sf_dir), ["vec_id"]).select("vec_id", "bin", F.round("share", 6).alias("share"))


ADDRESS_SQL = "concat('http://h.example/x/', CASE WHEN o_orderkey % 5 = 1 THEN concat('v', o_orderkey - 1, '_1080p.m3u8') WHEN o_orderkey % 5 = 4 THEN concat('a', o_orderkey - 1, '.m3u8') ELSE concat('p', o_orderkey, '.m3u8') END)"


def addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.expr(ADDRESS_SQL).alias("url"))


@query("SELECT o_orderkey AS k, CASE o_orderkey % 5 WHEN 2 THEN true WHEN 4 THEN true WHEN 3 THEN EXISTS (SELECT 1 FROM orders p WHERE p.o_orderkey = o.o_orderkey + 1) ELSE false END AS is_live FROM orders o")
def is_live_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return playlist.is_live_resolved(playlist_rows(spark, sf_dir), addresses(spark, sf_dir), "k", "url")


@query(f"SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 = 0 THEN concat('http://h.example/x/v', o_orderkey, '_480p.m3u8') ELSE {ADDRESS_SQL} END AS url FROM orders")
def rendition_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return playlist.rendition(playlist_rows(spark, sf_dir), addresses(spark, sf_dir), "k", "url", "_480p.m3u8")


PROBE_JSON = 'concat(\'{"streams":[{"width":\', o_custkey, \',"height":720,"r_frame_rate":"\', CASE WHEN o_orderkey % 4 = 0 THEN \'0/0\' ELSE \'30000/1001\' END, \'"}]}\')'


@query("SELECT o_orderkey, o_custkey::INT AS width, 720 AS height, CASE WHEN o_orderkey % 4 = 0 THEN 0 ELSE 29.97003 END::DOUBLE AS fps FROM orders")
def stream_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probes.stream_probe(table(spark, sf_dir, "orders").select("o_orderkey", F.expr(PROBE_JSON).alias("json"))).drop("json")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 0 ELSE 29.97003 END::DOUBLE AS fps, CASE WHEN o_orderkey % 4 = 0 THEN 0 ELSE trunc(o_totalprice * 29.97003::DOUBLE) END::BIGINT AS total_frames FROM orders")
def media_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probes.media_info(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.expr(PROBE_JSON).alias("json")), "o_totalprice").select("o_orderkey", "fps", "total_frames")


FRAMES_JSON = 'CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN \'no json\' WHEN 2 THEN \'{"frames":[{"pkt_pts_time":"0.5"},{},{"pkt_pts_time":"1.25"}]}\' ELSE \'{"frames":[{"pkt_pts_time":"2.0"}]}\' END'


def segment_probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("match_id"), F.expr("concat('http://h/v_480p_', o_orderkey, '.ts')").alias("segment"), F.col("o_orderkey").alias("arrival"), F.expr(FRAMES_JSON).alias("json"))


@query("SELECT o_custkey::VARCHAR AS match_id, 'v_480p_' || o_orderkey || '.ts' AS segment, CASE o_orderkey % 4 WHEN 0 THEN 'no output' ELSE 'no frames' END AS reason FROM orders WHERE o_orderkey % 4 < 2")
def failed_probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probes.failed_probes(segment_probes(spark, sf_dir))


@query("""
WITH f AS (SELECT o_custkey, o_orderkey, unnest([0, 2]) AS ts_frame FROM orders WHERE o_orderkey % 4 = 2 UNION ALL SELECT o_custkey, o_orderkey, 0 FROM orders WHERE o_orderkey % 4 = 3)
SELECT o_custkey::VARCHAR AS match_id, 'v_480p_' || o_orderkey || '.ts' AS segment, CASE WHEN o_orderkey % 4 = 3 THEN 2 WHEN ts_frame = 0 THEN 0.5 ELSE 1.25 END::DOUBLE AS ptstime, ts_frame::INT AS ts_frame,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey, ts_frame) AS frame_number, o_orderkey::INT AS segment_number FROM f""")
def probed_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probes.probed_frames(segment_probes(spark, sf_dir)).withColumn("ptstime", F.col("ptstime").cast("double"))


def embedded_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.concat(F.lit("m"), F.col("vec_id") % 3).alias("match_id"), F.col("vec_id").alias("frame_number"), F.col("embedding").alias("vector"))


CENTROIDS_SQL = """
WITH v AS (SELECT vec_id, label::INT AS label, list_transform(embedding, lambda x: x::DOUBLE) AS x FROM embeddings),
c AS (SELECT label, list(m ORDER BY i) AS m FROM (SELECT label, i, avg(x[i]) AS m FROM v, unnest(range(1, len(x) + 1)) AS t(i) GROUP BY label, i) GROUP BY label),
s AS (SELECT vec_id, c.label, list_dot_product(x, m) / sqrt(list_dot_product(x, x) * list_dot_product(m, m)) AS cosine FROM v CROSS JOIN c)"""


@query(CENTROIDS_SQL + """,
best AS (SELECT vec_id, arg_max(label, cosine) AS label, max(cosine) AS cosine FROM s GROUP BY vec_id),
three AS (SELECT vec_id, label % 3 AS k, arg_max(label, cosine) AS label, max(cosine) AS cosine FROM s GROUP BY vec_id, label % 3),
wide AS (SELECT vec_id, min(cosine) >= 0.05 AND count(*) = 3 AS complete, max(label) FILTER (k = 2) AS label FROM three GROUP BY vec_id)
SELECT 0 AS request, 'OD' AS analyzer_type, 'm1' AS match_id, vec_id AS frame_number, label::VARCHAR AS object_label, round(cosine, 5) AS confidence, NULL::DOUBLE AS class FROM best WHERE vec_id % 3 = 1 AND cosine >= 0.25
UNION ALL SELECT 1, 'three', 'm2', vec_id, NULL, NULL, CASE WHEN complete THEN label ELSE -1 END FROM wide WHERE vec_id % 3 = 2""")
def analyzer_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two requests over frame vectors with models that are fitted to them: one model with a threshold, and three models of which each knows a third of the labels and may not answer."""
    vectors = table(spark, sf_dir, "embeddings")
    one = models.shipped(spark, models.fit_centroids(vectors, "label", "embedding"), "all.npz")
    files = [models.shipped(spark, models.fit_centroids(vectors.where(F.col("label") % 3 == k), "label", "embedding"), f"third-{k}.npz") for k in range(3)]
    asked = [
        {"analyzer_type": "OD", "streamUrl": "u", "matchId": "m1", "threshold": "0.25", "batch_size": "8", "model": one},
        {"analyzer_type": "three", "streamUrl": "u", "matchId": "m2", "batch_size": "8", "files": files, "least": "0.05"},
    ]
    found = analyzers.run(asked, {"OD": models.CentroidAnalyzer, "three": models.CentroidModels}, embedded_frames(spark, sf_dir))
    cls = F.when(F.col("request") == 1, F.coalesce(F.get("person_detection_model_classes", 0), F.lit(-1.0))).cast("double")
    return found.select("request", "analyzer_type", "match_id", "frame_number", "object_label", F.round("confidence", 5).alias("confidence"), cls.alias("class"))


STREAM_CUTS_SQL = {
    name: kept_sql(least, gap).replace("FROM embeddings)", "FROM embeddings WHERE vec_id % 7 <> 0)") + " SELECT k AS match_id, f - 1 AS frame_number, f AS cut_frame FROM r" for name, least, gap in (("stream_cuts", 20, 25), ("stream_cuts_strict", 32, 3))
}
STREAM_SEGMENTS_SQL = """
SELECT DISTINCT o_custkey, url FROM (
  SELECT o_custkey, 'http://h.example/live/s_' || (o_orderkey // 3) || '.ts' AS url FROM orders
  UNION ALL SELECT o_custkey, 'http://h.example/live/' || o_custkey || '/s_' || (o_orderkey // 3 + 1) || '.ts' FROM orders)"""
CSV_SQL = "SELECT event_id, event_type, event_id AS box FROM events"
METRICS_SQL = """
SELECT 'metadata' AS name, count(*) AS input_rows, count(*) AS rows, count(*) FILTER (event_type = 'click') AS chosen FROM events
UNION ALL SELECT 'detections', count(*), count(*), count(*) FILTER (value > 50) FROM events"""
FLUSH_SQL = """
WITH n AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS c FROM events)
SELECT user_id, event_id, i // 12 + 1 AS flush, CASE WHEN i < c // 12 * 12 THEN 'count' ELSE 'end' END AS why FROM n"""
RESTART_SQL = "SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id % 2 DESC, ts DESC, event_id DESC) AS r FROM events) WHERE r = 1"
UPSERT_SQL = """
SELECT user_id, event_type, event_id, 'stored' AS at FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events WHERE value >= 20) WHERE r = 1
UNION ALL SELECT user_id, event_type, event_id, 'rejected' FROM events WHERE value < 20"""
STREAM_NUMBERING_SQL = "SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS frame_number FROM events WHERE event_id % 7 <> 0"
STREAM_DEDUPE_SQL = "SELECT DISTINCT user_id, strftime(ts, '%Y%m%d%H') AS segment FROM events"
