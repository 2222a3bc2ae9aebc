"""Playlists: lines, variants, live or recorded, durations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelspark.folders import stored
from reelspark.functions import text as T

#: Fixed values of the playlist format.
VARIANT, END, SEGMENT = "#EXT-X-STREAM-INF", "#EXT-X-ENDLIST", ".ts"
RECORDED, EVENT = "#EXT-X-PLAYLIST-TYPE:VOD", "#EXT-X-PLAYLIST-TYPE:EVENT"


def lines(playlists: DataFrame, key: str, text: str) -> DataFrame:
    """key, line_no (from 0) and the trimmed line."""
    return playlists.select(key, F.posexplode(F.split(text, "\r?\n")).alias("line_no", "line")).withColumn("line", F.trim("line"))


def kinds(of: DataFrame) -> DataFrame:
    line = F.col("line")
    return of.withColumns({"is_segment": F.endswith(line, F.lit(SEGMENT)), "is_variant": F.startswith(line, F.lit(VARIANT)), "is_end": line == END})


def variants(of: DataFrame, key: str) -> DataFrame:
    """Each variant marker that has a resolution, with the line after it as its URL, tag or not; a marker in the last line has none."""
    w = Window.partitionBy(key).orderBy("line_no")
    paired = of.withColumn("url", F.lead("line").over(w)).where(F.startswith(F.col("line"), F.lit(VARIANT)))
    return paired.withColumn("pixels", T.resolution(F.col("line"))).where("pixels is not null and url is not null").select(key, "line_no", "pixels", "url")


def best_variant(of: DataFrame, key: str) -> DataFrame:
    """The variant with the most pixels; of equal ones, the first listed."""
    best = variants(of, key).groupBy(key).agg(F.max(F.struct("pixels", (-F.col("line_no")).alias("l"), "url")).alias("_top"))
    return best.select(key, F.col("_top.pixels").alias("pixels"), F.col("_top.url").alias("url"))


def with_suffix(of: DataFrame, key: str, suffix: str) -> DataFrame:
    """The first line that ends in ``suffix``; null without one."""
    return of.groupBy(key).agg(F.min_by("line", F.when(F.endswith("line", F.lit(suffix)), F.col("line_no"))).alias("url"))


def is_live(of: DataFrame, key: str) -> DataFrame:
    """Recorded type or end marker: false; event type: true; a list of variants: null, for its best variant decides; otherwise true."""
    line = F.col("line")
    seen = of.groupBy(key).agg(F.bool_or((line == END) | (line == RECORDED)).alias("over"), F.bool_or(line == EVENT).alias("event"), F.bool_or(F.startswith(line, F.lit(VARIANT))).alias("master"))
    return seen.select(key, F.when(F.col("over"), False).when(F.col("event"), True).when(F.col("master"), F.lit(None).cast("boolean")).otherwise(True).alias("is_live"))


def rendition(of: DataFrame, playlists: DataFrame, key: str, url: str, suffix: str) -> DataFrame:
    """key, url: the line that ends in ``suffix``, joined with the playlist's own URL; without such a line (or a line at all) that URL itself."""
    found = with_suffix(of, key, suffix).withColumnRenamed("url", "_line")
    return playlists.select(key, url).join(found, key, "left").select(key, F.when(F.col("_line").isNull(), F.col(url)).otherwise(T.url_join(F.col(url), F.col("_line"))).alias("url"))


def is_live_resolved(of: DataFrame, addresses: DataFrame, key: str, url: str) -> DataFrame:
    """key, is_live of each playlist of ``addresses`` (key, url): a list of variants is as live as its best variant, looked up by URL, and so on to any depth.

    What can't be resolved is not live: a playlist without lines, without variants, whose variant has no playlist, or that leads back to itself. Of several playlists with one URL the one with the least key counts.
    Each round looks twice as far as the one before it, so that rounds grow with the logarithm of the longest chain; direct verdicts are found once.
    """
    direct = is_live(of, key)
    found = addresses.select(key, url).join(direct, key, "left").join(best_variant(of, key).withColumnRenamed("url", "_line"), key, "left")
    verdict = F.when(F.col("_line").isNull(), F.coalesce("is_live", F.lit(False))).otherwise(F.col("is_live"))
    known = stored(found.select(key, F.col(url).alias("_url"), verdict.alias("_live"), F.when(verdict.isNull(), T.url_join(F.col(url), F.col("_line"))).alias("_next")), "live")
    # Each URL's verdict, or where it leads to. A chain that is open after as many doublings as there are URLs can only be a circle.
    links = stored(known.groupBy("_url").agg(F.min_by(F.struct("_live", "_next"), key).alias("_to")).select("_url", "_to.*"), "live")
    open_ones = links.where("_next is not null").count()
    for _ in range(open_ones.bit_length()):
        ahead = links.select(F.col("_url").alias("_at"), F.col("_live").alias("_then"), F.col("_next").alias("_after"))
        seen = links.join(ahead, F.col("_next") == F.col("_at"), "left")
        lost = F.col("_next").isNotNull() & F.col("_at").isNull()
        links = stored(seen.select("_url", F.when(lost, False).otherwise(F.coalesce("_live", "_then")).alias("_live"), F.when(F.col("_live").isNull() & F.col("_then").isNull(), F.col("_after")).alias("_next")), "live")
        left = links.where("_next is not null").count()
        if left in (0, open_ones):
            break
        open_ones = left
    ends = links.select(F.col("_url").alias("_at"), F.col("_live").alias("_then"))
    out = known.join(ends, F.col("_next") == F.col("_at"), "left")
    return out.select(key, F.coalesce("_live", "_then", F.lit(False)).alias("is_live"))


def new_segments(of: DataFrame, key: str, poll: str) -> DataFrame:
    """Each segment line once, at the first poll that lists it."""
    found = of.where(F.endswith("line", F.lit(SEGMENT)))
    return found.groupBy(key, "line").agg(F.min(F.struct(poll, "line_no")).alias("_top")).select(key, "line", F.col(f"_top.{poll}").alias(poll), F.col("_top.line_no").alias("line_no"))


def total_duration(playlists: DataFrame, key: str, text: str) -> DataFrame:
    found = T.durations(F.col(text))
    return playlists.select(key, F.aggregate(found, F.lit(0.0), lambda s, x: s + F.coalesce(x, F.lit(0.0))).alias("seconds"), F.size(found).cast("bigint").alias("segments"))
