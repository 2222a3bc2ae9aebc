"""Chat formatting by multi-party perspective rotation.

For every participant of a conversation the dialogue is rendered once with that speaker as the assistant and the others as named users; only the assistant's
words are trained on. The result has a row for each perspective and turn, in place of one long text for each, so that a conversation of any length is
rendered by as many tasks as it needs: a perspective's rows in the order of ``turn`` and ``tie`` are its dialogue. ``dialogues`` puts them together where a conversation fits into a row.

Roles in ``aside`` (system) speak in every perspective and are nobody's. A null role is a user without a name. Null text is empty. Rows whose conversation
id is null make one conversation. Repeated rows are rendered each for itself. Rows of one turn stand in the order of role (none first), then of text: ``tie`` numbers them, 0 for
the first, and rows that are equal in all of that are interchangeable. A conversation without participants, and an empty table, give no row. "<|" in a text or role is written "< |", so that no text can end its turn. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ASIDE = ("system",)


def rotate(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", aside: tuple[str, ...] = ASIDE) -> DataFrame:
    """conv_id, perspective, turn, tie, role, segment, mask_start, mask_end: each turn as the perspective sees it; characters [mask_start, mask_end) of the segment are trained on."""
    safe = lambda c: F.replace(c, F.lit("<|"), F.lit("< |"))
    base = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    same_turn = Window.partitionBy("conv_id", "turn").orderBy(F.asc_nulls_first("role"), "text")
    base = base.withColumn("tie", (F.row_number().over(same_turn) - 1).cast("long"))
    speakers = base.where(F.col("role").isNotNull() & ~F.col("role").isin(*aside)).select(F.col("conv_id").alias("of"), F.col("role").alias("perspective")).distinct()
    seen = base.join(speakers, F.col("conv_id").eqNullSafe(F.col("of")))
    own = F.coalesce(F.col("role") == F.col("perspective"), F.lit(False))
    head = (
        F.when(own, F.lit("<|assistant|>\n"))
        .when(F.col("role").isin(*aside), F.concat(F.lit("<|"), safe(F.col("role")), F.lit("|>\n")))
        .when(F.col("role").isNull(), F.lit("<|user|>\n"))
        .otherwise(F.concat(F.lit("<|user name="), safe(F.col("role")), F.lit("|>\n")))
    )
    body = safe(F.col("text"))
    start = F.when(own, F.length(head)).otherwise(0)
    return seen.select("conv_id", "perspective", "turn", "tie", "role", F.concat(head, body, F.lit("<|end|>\n")).alias("segment"), start.cast("long").alias("mask_start"), F.when(own, start + F.length(body) + F.length(F.lit("<|end|>\n"))).otherwise(0).cast("long").alias("mask_end"))


def dialogues(rotated: DataFrame) -> DataFrame:
    """conv_id, perspective, text, masks: each perspective as one text, with the [start, past) characters that are trained on, from the rows of ``rotate``.

    A dialogue is one row and must fit into a task; take the rows of ``rotate`` where conversations may be longer than that.
    """
    one = rotated.groupBy("conv_id", "perspective").agg(F.sort_array(F.collect_list(F.struct("turn", "tie", "segment", "mask_start", "mask_end"))).alias("rows"))
    empty = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,past:bigint>>").alias("masks"))
    folded = F.aggregate(
        "rows",
        empty,
        lambda s, r: F.struct(
            (s["at"] + F.length(r["segment"])).alias("at"),
            F.when(r["mask_end"] > r["mask_start"], F.array_append(s["masks"], F.struct((s["at"] + r["mask_start"]).alias("start"), (s["at"] + r["mask_end"]).alias("past")))).otherwise(s["masks"]).alias("masks"),
        ),
    )
    return one.select("conv_id", "perspective", F.array_join(F.transform("rows", lambda r: r["segment"]), "").alias("text"), folded["masks"].alias("masks"))
