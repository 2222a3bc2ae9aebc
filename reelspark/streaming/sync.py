"""The answers of several models to the frames of a stream, put together as they come."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from reelspark.operators.detections import MODELS

PARTS = {"boxes": "array<array<double>>", "confidences": "array<double>", "classes": "array<double>"}


#: Keys and answers as text: exact for doubles, and for times of a microsecond.
AS_JSON = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
#: What a row of the state is, where it is no answer (answers: the model's place).
FRAME, DONE = -1, -2
HELD = ["id", "due", "kind", "answer"]


def packed(held: pd.DataFrame) -> bytes:
    table, out = pa.Table.from_pandas(held, pa.schema([("id", pa.string()), ("due", pa.int64()), ("kind", pa.int64()), ("answer", pa.string())]), preserve_index=False), pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return out.getvalue().to_pybytes()


def merged(held: pd.DataFrame, fresh: pd.DataFrame, models: int, wait_ms: int, watermark: int) -> tuple[pd.DataFrame, pd.DataFrame]:
    """What is to be given now (id, complete, a0 and so on: an answer for each model) and what is held from now on. held, fresh: rows in the order of their coming; ``due`` of fresh ones is the row's time."""
    rows = pd.concat([held, fresh], ignore_index=True) if len(held) else fresh.reset_index(drop=True)
    code, ids = pd.factorize(rows["id"])
    kind, answer, time, old = rows["kind"].to_numpy(np.int64), rows["answer"].to_numpy(object), rows["due"].to_numpy(np.int64), len(held)
    due, latest = np.full(len(ids), -1), np.full(len(ids), -1)
    due[code[:old]] = time[:old]
    np.maximum.at(latest, code[old:], time[old:] + wait_ms)
    renewed = np.bincount(code[old:], minlength=len(ids)) > 0
    due = np.where(renewed, np.maximum(latest, watermark + 1), due)
    there, done = (np.bincount(code[kind == k], minlength=len(ids)) > 0 for k in (FRAME, DONE))
    at = np.full((models, len(ids)), -1)
    for m in range(models):
        rows_of = np.flatnonzero((kind == m) & rows["answer"].notna().to_numpy())
        which, first = np.unique(code[rows_of], return_index=True)
        at[m, which] = rows_of[first]
    whole = there & ~done & (at >= 0).all(0)
    over = due < watermark
    missing = there & ~done & ~whole & over
    given = pd.concat([pd.DataFrame({"id": ids[which], "complete": full} | {f"a{m}": answer[at[m, which]] if full else None for m in range(models)}, dtype=object) for full, which in ((True, np.flatnonzero(whole)), (False, np.flatnonzero(missing)))])
    ended, open_ = ~over & (done | whole), ~over & ~done & ~whole
    parts = [(np.flatnonzero(ended), DONE, None), (np.flatnonzero(open_ & there), FRAME, None)]
    parts += [(which := np.flatnonzero(open_ & (at[m] >= 0)), m, answer[at[m, which]]) for m in range(models)]
    return given, pd.concat([pd.DataFrame({"id": ids[which], "due": due[which], "kind": k, "answer": x}) for which, k, x in parts], ignore_index=True)


def synchronised(frames: DataFrame, answers: DataFrame, keys: list[str], at: str, wait_ms: int, models: tuple[str, ...] = MODELS, lateness: str = "0 seconds", buckets: int = 64) -> DataFrame:
    """keys, complete and each model's boxes, confidences and classes: one row for each frame, as soon as all models have answered, or with empty arrays once the frame's time is ``wait_ms`` behind the watermark.

    frames: keys and ``at``, a timestamp. answers: the same with model, boxes, confidences and classes. Both are streams in any order; an answer may come before its frame. The
    watermark is ``lateness`` behind the greatest time of either: rows behind it are too late and are dropped. Of several answers of one model the first counts. Answers without a frame give no row, and
    answers of other models are ignored. A frame's answers are removed when its time is over.

    State is kept for each of ``buckets`` groups of frames, dealt by a hash of the keys, and each group is brought up to date as a whole: choose so many that a group has some thousand open frames.
    """
    every = frames.select(*keys, at, F.lit(None).cast("string").alias("model"), *[F.lit(None).cast(kind).alias(c) for c, kind in PARTS.items()])
    both = every.unionByName(answers.where(F.col("model").isin(*models)).select(*keys, at, "model", *[F.col(c).cast(kind).alias(c) for c, kind in PARTS.items()]))
    place = F.coalesce(F.array_position(F.array(*map(F.lit, models)), F.col("model")) - 1, F.lit(FRAME))
    answer = F.when(F.col("boxes").isNotNull(), F.to_json(F.struct(*PARTS), AS_JSON))
    named = both.select(F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("bucket"), F.to_json(F.struct(*keys), AS_JSON).alias("id"), at, F.unix_millis(at).alias("due"), place.cast("bigint").alias("kind"), answer.alias("answer"))
    timed = named.withWatermark(at, lateness)
    own = [f"a{m}" for m in range(len(models))]

    def step(_: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        none = pd.DataFrame({c: pd.Series(dtype="int64" if c in ("due", "kind") else object) for c in HELD})
        held = pa.ipc.open_stream(bytes(state.get[0])).read_pandas() if state.exists else none
        fresh = none if state.hasTimedOut else pd.concat([none, *[chunk[HELD] for chunk in chunks]], ignore_index=True)
        watermark = state.getCurrentWatermarkMs()
        given, held = merged(held, fresh, len(models), wait_ms, watermark)
        if len(held):
            state.update((packed(held),))
            state.setTimeoutTimestamp(max(int(held["due"].min()), watermark + 1))
        elif state.exists:
            state.remove()
        yield given

    given = timed.groupBy("bucket").applyInPandasWithState(step, ", ".join(["id string", "complete boolean", *[f"{a} string" for a in own]]), "held binary", "append", GroupStateTimeout.EventTimeTimeout)
    kinds, kind = ", ".join(f"{k} {frames.schema[k].dataType.simpleString()}" for k in keys), ", ".join(f"{c} {x}" for c, x in PARTS.items())
    read = given.select(F.from_json("id", kinds, AS_JSON).alias("id"), "complete", *[F.from_json(a, kind, AS_JSON).alias(a) for a in own])
    empty = lambda c: F.array().cast(PARTS[c])
    return read.select(*[F.col("id")[k].alias(k) for k in keys], "complete", *[F.when(F.col("complete"), F.col(a)[c]).otherwise(empty(c)).alias(f"{m}_{c}") for a, m in zip(own, models, strict=True) for c in PARTS])


def flushed(rows: DataFrame, key: str, order: list[str], most: int = 12, every_ms: int | None = 250, last: str | None = None) -> DataFrame:
    """rows in flushes: ``flush`` (running number in the key) and ``why``: 'count' when ``most`` rows are held, 'time' when ``every_ms`` have passed since the last rows came, whether or not others follow, 'end' for
    what is held when a row with ``last`` true comes. Rows that are held are state: at most ``most`` - 1 of a key. null keys are keys like others.
    every_ms None: no flush by time, for queries that end with what is there (Spark runs one with such timers until it is stopped)."""
    columns = [f.name for f in rows.schema]
    held_kinds = ", ".join(f"{f.name} array<{f.dataType.simpleString()}>" for f in rows.schema)

    def step(group: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        flush, *held = state.get if state.exists else (0, *[[] for _ in columns])
        batch = pd.DataFrame(dict(zip(columns, map(list, held), strict=True)))
        why = "time"
        if not state.hasTimedOut:
            fresh = pd.concat(list(chunks)).sort_values(order, kind="stable")
            batch = pd.concat([batch, fresh], ignore_index=True) if len(batch) else fresh.reset_index(drop=True)
            why = "end" if last and bool(fresh[last].fillna(False).any()) else None
        whole = len(batch) // most * most
        for k in range(0, whole, most):
            flush += 1
            yield batch.iloc[k : k + most].assign(flush=flush, why="count")
        batch = batch.iloc[whole:]
        if why and len(batch):
            flush += 1
            yield batch.assign(flush=flush, why=why)
            batch = batch.iloc[:0]
        state.update((flush, *[[x.item() if hasattr(x, "item") else x for x in batch[c]] for c in columns]))
        if len(batch) and every_ms is not None:
            state.setTimeoutDuration(every_ms)

    schema = ", ".join([*[f"{f.name} {f.dataType.simpleString()}" for f in rows.schema], "flush bigint", "why string"])
    return rows.groupBy(key).applyInPandasWithState(step, schema, f"flush_number bigint, {held_kinds}", "append", GroupStateTimeout.NoTimeout if every_ms is None else GroupStateTimeout.ProcessingTimeTimeout)
