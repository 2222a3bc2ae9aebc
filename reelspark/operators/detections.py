"""Detections of several models: merging, filtering, stored items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelspark.functions import arrays as A
from reelspark.functions.games import GAMES

#: The three models, the allowed classes and their new numbers, and the games with a model of their own.
MODELS = ("cricket_model", "person_head_model", "person_detection_model")
ALLOWED = [0, 17, 32]
REMAP = {0: 1, 17: 2, 32: 0}


def person_only(frames: DataFrame) -> DataFrame:
    """boxes, confidences, classes of detections of class 0."""
    kept = A.unzipped(A.keep_classes(A.zipped("boxes", "confidences", "classes"), [0]))
    return frames.withColumns({"boxes": kept["box"], "confidences": kept["conf"], "classes": kept["cls"]})


def merge_models(frames: DataFrame, detections: DataFrame, keys: list[str], models: tuple[str, ...] = MODELS) -> DataFrame:
    """One wide row for each frame. All models must have answered, or all of the frame's columns are empty arrays."""
    parts = ("boxes", "confidences", "classes")
    wide = detections.groupBy(*keys).pivot("model", list(models)).agg(*[F.any_value(c, True).alias(c) for c in parts])
    joined = frames.join(wide, keys, "left")
    complete = F.lit(True)
    for m in models:
        complete = complete & F.col(f"{m}_boxes").isNotNull()
    return joined.select(*keys, *[F.when(complete, F.col(f"{m}_{c}")).otherwise(F.array()).alias(f"{m}_{c}") for m in models for c in parts])


def model_folder(game: Column, own: list[str]) -> Column:
    """The game's folder if it has a model of its own, otherwise (or without a game) the default one."""
    return F.when(game.isin(own), game).otherwise(F.lit("default"))


def confident(frames: DataFrame, least: float) -> DataFrame:
    """boxes, confidences, classes of detections of at least this confidence."""
    kept = A.unzipped(A.at_least(A.zipped("boxes", "confidences", "classes"), least))
    return frames.withColumns({"boxes": kept["box"], "confidences": kept["conf"], "classes": kept["cls"]})


def three_model_mode(game_id: Column, single_model: Column) -> Column:
    """Whether a match runs all three models: the game that has three, with the flag for one model set to 'false' (a flag that isn't set is 'True')."""
    return F.coalesce((game_id == GAMES["cricket"]) & (F.coalesce(single_model, F.lit("True")) == "false"), F.lit(False))


def stored_items(rows: DataFrame, models: tuple[str, ...] = MODELS) -> DataFrame:
    """match_id, frame_number, shape, items: a row that has the boxes of all models is stored as a map from model to its arrays, another as the arrays of one model, under its name 'single'."""
    arrays = ("boxes", "confidences", "classes")
    entry = lambda prefix: F.struct(*[F.col(f"{prefix}{c}").alias(c) for c in arrays])
    three = F.lit(True)
    for m in models:
        three = three & F.col(f"{m}_boxes").isNotNull()
    items = F.when(three, F.create_map(*[x for m in models for x in (F.lit(m), entry(f"{m}_"))])).otherwise(F.create_map(F.lit("single"), entry("")))
    return rows.select("match_id", "frame_number", F.when(three, "three_model").otherwise("single").alias("shape"), items.alias("items"))


def last_wins(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Of rows with one key, the last by ``order``: an idempotent upsert's outcome. One aggregate with partial sums, no sort."""
    rest = [c for c in rows.columns if c not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_last"))
    return last.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in rest])
