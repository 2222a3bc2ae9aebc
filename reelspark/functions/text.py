"""Expressions over URLs, playlist lines and other text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def basename(url: Column) -> Column:
    return F.substring_index(url, "/", -1)


def base_url(url: Column) -> Column:
    """Text before the last slash; a text without one stays."""
    return F.regexp_replace(url, "/[^/]*$", "")


def segment_number(name: Column) -> Column:
    """The integer between the last underscore and the first dot after it; null if that isn't one."""
    return F.substring_index(F.substring_index(name, "_", -1), ".", 1).try_cast("int")


def naive_join(base: Column, relative: Column) -> Column:
    return F.when(F.startswith(relative, F.lit("http")), relative).otherwise(F.concat(base, F.lit("/"), relative))


def url_join(base: Column, relative: Column) -> Column:
    """A reference resolved against a base URL: absolute, scheme-relative, root-relative or relative; dot segments are resolved, as RFC 3986 has it.

    A null base or reference gives null.
    """
    scheme = F.regexp_extract(base, "^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    host = F.regexp_extract(base, "^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    folder = F.concat(host, F.coalesce(F.nullif(F.regexp_extract(F.regexp_replace(base, "[?#].*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://[^/]*(.*/)", 1), F.lit("")), F.lit("/")))
    return (
        F.when(relative.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), relative)
        .when(F.startswith(relative, F.lit("//")), F.concat(scheme, F.lit(":"), relative))
        .when(F.startswith(relative, F.lit("/")), F.concat(host, without_dots(relative)))
        .when(relative == "", base)
        .when(F.startswith(relative, F.lit("?")), F.concat(F.regexp_replace(base, "[?#].*$", ""), relative))
        .when(F.startswith(relative, F.lit("#")), F.concat(F.regexp_replace(base, "#.*$", ""), relative))
        .otherwise(F.concat(host, without_dots(F.concat(F.substr(folder, F.length(host) + 1), relative))))
    )


def without_dots(path: Column) -> Column:
    """A path that begins with a slash, without its segments . and .. (each .. takes the segment before with it); what follows ? or # stays."""
    plain, rest = F.regexp_extract(path, "^[^?#]*", 0), F.regexp_extract(path, "[?#].*$", 0)
    parts = F.split(plain, "/")
    fold = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda kept, x: F.when(x == ".", kept).when(x == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(1)))).otherwise(F.array_append(kept, x)),
    )
    folder = F.when(F.element_at(parts, -1).isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
    return F.concat(F.array_join(fold, "/"), folder, rest)


def resolution(line: Column) -> Column:
    """Pixels of a RESOLUTION=WxH attribute; null without one."""
    part = lambda k: F.nullif(F.regexp_extract(line, r"RESOLUTION=(\d+)x(\d+)", k), F.lit("")).try_cast("bigint")
    return part(1) * part(2)


def durations(text: Column) -> Column:
    """All segment durations of a playlist."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"#EXTINF:([0-9.]+),"), F.lit(1)), lambda x: x.try_cast("double"))


def queue_region(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"sqs\.([^.]+)\.", 1), F.lit(""))


def model_location(base: Column, folder: Column) -> Column:
    return F.concat_ws("/", base, folder, F.lit("latest.pt"))


def utc_stamp(ts: Column) -> Column:
    """ISO 8601 with milliseconds and Z; ts must be read in UTC."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
