"""Files of raw frames, each of a fixed number of bytes, as a table with a row for each frame."""

from __future__ import annotations

from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

CHANNELS = 3


class Ranges(InputPartition):
    """Frames [first, past) of files: (path, first, past) of each."""

    def __init__(self, ranges: list[tuple[str, int, int]]):
        super().__init__(ranges)
        self.ranges = ranges


class RawFrames(DataSource):
    """format("raw_frames").load(file or folder): segment string, ts_frame int, width int, height int, frame binary (blue, green and red bytes of each pixel, row by row).

    Options: ``width``, ``height``; ``framesPerPartition``, the frames of a range at most (256); ``rangesPerPartition``, the ranges that a task reads one after another at most (1; more for many short files); ``suffix``, which files of a folder are read (all, if it isn't given).

    A file ends at its last whole frame: what is left behind it, a frame that was cut short, is no frame. An empty file gives no row. ts_frame counts the frames of a file from 0; segment is its name.
    Partitions are ranges of bytes, so that a long file is read by many tasks and no task holds more than one frame at a time. Paths are those of pyarrow's file systems: a folder that
    all nodes mount, or an address such as hdfs:// or s3://.
    """

    @classmethod
    def name(cls) -> str:
        return "raw_frames"

    def schema(self) -> str:
        return "segment string, ts_frame int, width int, height int, frame binary"

    def reader(self, schema: StructType) -> DataSourceReader:
        o = self.options
        return FrameReader(o["path"], int(o["width"]), int(o["height"]), int(o.get("framesPerPartition", 256)), o.get("suffix", ""), int(o.get("rangesPerPartition", 1)))


class FrameReader(DataSourceReader):
    def __init__(self, path: str, width: int, height: int, each: int, suffix: str, ranges: int = 1):
        if min(width, height, each, ranges) < 1:
            raise ValueError("width, height, framesPerPartition and rangesPerPartition must be 1 or more")
        self.path, self.width, self.height, self.each, self.suffix, self.ranges = path, width, height, each, suffix, ranges
        self.size = CHANNELS * width * height

    def partitions(self) -> list[Ranges]:
        store, at = fs.FileSystem.from_uri(self.path)
        info = store.get_file_info(at)
        files = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(at))
        files = sorted((f.path, f.size // self.size) for f in files if f.type == fs.FileType.File and f.path.endswith(self.suffix))
        found = [(path, a, min(a + self.each, n)) for path, n in files for a in range(0, n, self.each)]
        return [Ranges(found[k : k + self.ranges]) for k in range(0, len(found), self.ranges)]

    def read(self, part: Ranges) -> Iterator[tuple]:
        store, _ = fs.FileSystem.from_uri(self.path)
        for path, first, past in part.ranges:
            segment = path.rsplit("/", 1)[-1]
            with store.open_input_file(path) as f:
                f.seek(first * self.size)
                for k in range(first, past):
                    frame = f.read(self.size)
                    if len(frame) < self.size:  # the file has become shorter
                        break
                    yield segment, k, self.width, self.height, frame


def write_frames(key: tuple, frames: list[bytes], folder: str, name: str) -> int:
    """Writes the frames one after another as a file of the folder, and gives its bytes."""
    store, at = fs.FileSystem.from_uri(folder)
    store.create_dir(at, recursive=True)
    with store.open_output_stream(f"{at}/{name}") as f:
        for frame in frames:
            f.write(frame)
    return sum(map(len, frames))
