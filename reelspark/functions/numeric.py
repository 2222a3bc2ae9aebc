"""Numbers: frame rates, rounding, timecodes, bits, vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def frame_rate(ratio: Column) -> Column:
    """num/den to six places; 0 for a zero denominator."""
    num, den = F.split_part(ratio, F.lit("/"), F.lit(1)).try_cast("double"), F.split_part(ratio, F.lit("/"), F.lit(2)).try_cast("double")
    return F.when(den == 0, F.lit(0.0)).otherwise(F.round(num / F.nullif(den, F.lit(0.0)), 6))


def half_even(x: Column, places: int = 2) -> Column:
    """Rounding half to even of a 32-bit number, widened first."""
    return F.bround(x.cast("float").cast("double"), places)


def decimal2(x: Column) -> Column:
    return F.bround(x.cast("double"), 2).cast("decimal(10,2)")


def frame_to_seconds(frame: Column, rate: Column) -> Column:
    return frame / rate


def seconds_to_frame(seconds: Column, rate: Column) -> Column:
    return (seconds * rate).cast("bigint")


def total_frames(duration: Column, rate: Column) -> Column:
    """Whole frames in a duration in seconds."""
    return seconds_to_frame(duration, rate)


def timecode(frame: Column, fps: Column, form: str) -> Column:
    """One of five forms; a rate of zero gives 00:00:00.000, an unknown form null."""
    total = frame.cast("double") / F.nullif(fps.cast("double"), F.lit(0.0))
    hours, minutes = F.floor(total / 3600).cast("int"), F.floor(total % 3600 / 60).cast("int")
    seconds = total - F.floor(total / 60) * 60
    made = {
        "HH:MM:SS.mmm": F.format_string("%02d:%02d:%06.3f", hours, minutes, seconds),
        "HH:MM:SS": F.format_string("%02d:%02d:%02d", hours, minutes, F.floor(seconds).cast("int")),
        "Seconds": F.format_string("%.3f", total),
        "HH_MM_SS": F.format_string("%02d_%02d_%02d", hours, minutes, F.floor(seconds).cast("int")),
        "HH_MM_SS_mmm": F.format_string("%02d_%02d_%.3f", hours, minutes, seconds),
    }
    return F.when(fps == 0, F.lit("00:00:00.000")).otherwise(made[form]) if form in made else F.lit(None).cast("string")


def hamming(a: Column, b: Column) -> Column:
    """Bits that differ in two longs."""
    return F.bit_count(a.bitwiseXOR(b))


def median_bits(vector: Column) -> Column:
    """A long with a bit for each of 64 values: whether it is above their median."""
    ordered = F.sort_array(F.transform(vector, lambda x: x.cast("double")))
    n = F.size(vector)
    middle = (F.get(ordered, F.floor((n - 1) / 2).cast("int")) + F.get(ordered, F.floor(n / 2).cast("int"))) / 2
    bits = lambda m: F.aggregate(vector, F.lit(0).cast("bigint"), lambda acc, x: F.shiftleft(acc, 1).bitwiseOR((x.cast("double") > m).cast("bigint")))
    return F.get(F.transform(F.array(middle), bits), F.lit(0))  # the median is bound once, not sorted for again at each value


def correlation(a: Column, b: Column) -> Column:
    """Pearson correlation of two arrays; null if one is constant or null."""
    d = lambda v: F.transform(v, lambda x: x.cast("double"))
    total = lambda v: F.aggregate(v, F.lit(0.0), lambda s, x: s + x)
    product = lambda u, v: total(F.zip_with(u, v, lambda x, y: x * y))
    x, y, n = d(a), d(b), F.size(a).cast("double")
    sums = F.struct(total(x).alias("x"), total(y).alias("y"), product(x, y).alias("xy"), product(x, x).alias("xx"), product(y, y).alias("yy"))

    def ratio(s: Column) -> Column:
        spread = (s["xx"] - s["x"] * s["x"] / n) * (s["yy"] - s["y"] * s["y"] / n)
        return (s["xy"] - s["x"] * s["y"] / n) / F.nullif(F.sqrt(F.greatest(spread, F.lit(0.0))), F.lit(0.0))

    return F.get(F.transform(F.array(sums), ratio), F.lit(0))


def sparse_correlation(at_a: Column, a: Column, at_b: Column, b: Column, size: int) -> Column:
    """Pearson correlation of two arrays of ``size`` values that are 0 but at the given places; null if one is constant or null."""
    d = lambda v: F.transform(v, lambda x: x.cast("double"))
    total = lambda v: F.aggregate(v, F.lit(0.0), lambda s, x: s + x)
    square = lambda v: total(F.transform(v, lambda x: x * x))
    x, y, n = d(a), d(b), F.lit(float(size))

    def ratio(known: Column) -> Column:
        product = total(F.zip_with(at_b, y, lambda k, v: F.coalesce(F.try_element_at(known, k), F.lit(0.0)) * v))
        spread = (square(x) - total(x) * total(x) / n) * (square(y) - total(y) * total(y) / n)
        return (product - total(x) * total(y) / n) / F.nullif(F.sqrt(F.greatest(spread, F.lit(0.0))), F.lit(0.0))

    return F.get(F.transform(F.array(F.map_from_arrays(at_a, x)), ratio), F.lit(0))
