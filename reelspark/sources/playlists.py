"""A growing playlist as a stream of its segments, each once and in order; ends for good at the end marker, fails when nothing new comes for too long."""

from __future__ import annotations

import ast
import time
from collections.abc import Iterator
from hashlib import blake2b
from urllib.parse import urljoin, urlsplit
from urllib.request import urlopen

from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

#: Fixed values of the playlist format.
END, SEGMENT = "#EXT-X-ENDLIST", ".ts"


def segments(text: str) -> list[str]:
    """Segment lines before the end marker, first occurrences only."""
    found: dict[str, None] = {}
    for line in map(str.strip, text.splitlines()):
        if line == END:
            break
        if line.endswith(SEGMENT):
            found.setdefault(line)
    return list(found)


def known_as(url: str) -> str:
    """What an offset keeps of a URL: 64 bits of its hash."""
    return blake2b(url.encode(), digest_size=8).hexdigest()


class PlaylistStream(DataSource):
    """format("playlist").load(path or http URL, read by the driver alone): playlist string, position bigint, segment string, url string, error string.

    Options: ``base``, the URL that segment lines are joined with (the path, if it isn't given); ``idleTimeout``, seconds without a new segment after which
    the stream fails with TimeoutError (none, if it isn't given); ``maxSegments``, the most segments of a batch (all, if it isn't given); ``after``, the number of segments that are known from elsewhere, such as
    a table of results: as many are passed over at the start; ``errors``: "rows" gives a row with ``error`` for a poll that failed and goes on, where otherwise the stream fails with the poll.

    A segment is known by the URL that its line makes with the base, whichever line that is and however often it leaves the list and comes back: each URL is given once. An offset keeps 64 bits
    of each URL that has been given (16 characters; a day of 6-second segments is 240 kB), what a full batch left over, and the rows that came with it, so that a batch which is run again gives the same rows.

    The end marker is kept too: after it, and when all that was left over has been given, the playlist isn't read any more, and no timeout follows. ``until_end`` stops a query then.
    """

    @classmethod
    def name(cls) -> str:
        return "playlist"

    def schema(self) -> str:
        return "playlist string, position bigint, segment string, url string, error string"

    def simpleStreamReader(self, schema: StructType) -> SimpleDataSourceStreamReader:
        idle, most = self.options.get("idleTimeout"), self.options.get("maxSegments")
        return PlaylistReader(
            self.options["path"], self.options.get("base") or self.options["path"], None if idle is None else float(idle), None if most is None else int(most), int(self.options.get("after", 0)), self.options.get("errors") == "rows"
        )


class PlaylistReader(SimpleDataSourceStreamReader):
    def __init__(self, path: str, base: str | None = None, idle: float | None = None, most: int | None = None, after: int = 0, errors: bool = False):
        self.path, self.base, self.idle, self.most, self.after, self.errors = path, base or path, idle, most, after, errors
        self.latest = time.time()

    def initialOffset(self) -> dict:
        return {"count": 0, "seen": [], "rows": [], "left": [], "ended": False, "failed": 0}

    def _text(self) -> str:
        if urlsplit(self.path).scheme in ("http", "https", "file"):
            with urlopen(self.path, timeout=10) as got:
                return got.read().decode("utf-8")
        with open(self.path, encoding="utf-8") as f:
            return f.read()

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        left, ended, seen, problem = start["left"], start["ended"], start["seen"], None
        if not ended:
            try:
                text = self._text()
            except (OSError, UnicodeDecodeError) as e:
                if not self.errors:
                    raise
                text, problem = "", f"{type(e).__name__}: {e}"
            urls = {known_as(url): [line, url] for line in segments(text) for url in [urljoin(self.base, line)]}
            ended = any(line.strip() == END for line in text.splitlines())
            fresh = [k for k in urls if k not in set(seen)]
            passed = max(0, self.after - len(seen))  # segments that were given in a former life
            left, seen = left + [urls[k] for k in fresh[passed:]], seen + fresh
        given, left = (left, []) if self.most is None else (left[: self.most], left[self.most :])
        if given:
            self.latest = time.time()
        elif not ended and self.idle is not None and time.time() - self.latest > self.idle:
            raise TimeoutError(f"no new segment in {self.path} for {self.idle} seconds")
        if not given and not problem and ended == start["ended"] and len(seen) == len(start["seen"]):
            return iter([]), start
        first = start["count"] if start["seen"] else self.after
        rows = [[first + i, line, url, None] for i, (line, url) in enumerate(given)] + ([[None, None, None, problem]] if problem else [])
        end = {"count": first + len(given), "seen": seen, "rows": rows, "left": left, "ended": ended, "failed": start["failed"] + bool(problem)}
        return self.readBetweenOffsets(start, end), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return iter([(self.path, *row) for row in end["rows"]])


def until_end(query: StreamingQuery, poll: float = 0.2, timeout: float | None = None) -> bool:
    """Waits until all playlists of the query have ended and every segment has gone through, then stops it in peace; False if ``timeout`` seconds pass before. A query that fails raises its error."""
    began = time.time()
    while query.isActive and (timeout is None or time.time() - began < timeout):
        last = query.lastProgress
        offsets = [s["endOffset"] for s in last["sources"]] if last else []
        offsets = [ast.literal_eval(x) if isinstance(x, str) else x for x in offsets if x]  # progress shows an offset as Python would
        if offsets and last["numInputRows"] == 0 and all(o["ended"] and not o["left"] for o in offsets if "ended" in o):
            query.stop()
            return True
        time.sleep(poll)
    if query.exception() is not None:
        raise query.exception()
    return not query.isActive
