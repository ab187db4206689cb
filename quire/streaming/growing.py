"""Files that grow, as a stream of lines: an offset is the bytes read of each file, and only whole lines are given.

    growing.register(spark)
    spark.readStream.format("quire_growing").load("/feeds/incoming")

A run ends each file at its last line break; what stands behind it waits until it is complete.  A file that was appended between two runs
gives each line once.  Large appends are cut into ranges, each a task of its own: a line belongs to the range in which it begins.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from quire.sources import stores

RANGE = 64 << 20  # bytes of a task
BLOCK = 1 << 20


class Range(InputPartition):
    def __init__(self, name: str, begin: int, start: int, stop: int, end: int):
        """Lines that begin in [start, stop) of the new part [begin, end) of a file."""
        super().__init__((name, begin, start, stop, end))


def whole_lines(path: str, start: int, size: int) -> int:
    """The place behind the last line break of [start, size), read from the end; start where there is none."""
    store, at = stores.opened(path)
    with store.open_input_file(at) as f:
        stop = size
        while stop > start:
            begin = max(start, stop - BLOCK)
            f.seek(begin)
            found = f.read(stop - begin).rfind(b"\n")
            if found >= 0:
                return begin + found + 1
            stop = begin
    return start


class GrowingReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.suffix, self.range = options["path"].rstrip("/"), options.get("suffix", ""), int(options.get("range", RANGE))
        self.known: dict[str, tuple[int, int]] = {}  # size seen and place of its last line break, so that files at rest are not read

    def initialOffset(self) -> dict:  # noqa: N802
        return {}

    def latestOffset(self) -> dict:  # noqa: N802
        for name, size in stores.sizes(self.path, self.suffix).items():
            before = self.known.get(name, (0, 0))
            if size < before[0]:
                raise ValueError(f"{name} has become shorter: {before[0]} bytes before, {size} now")
            if size > before[0]:
                self.known[name] = (size, whole_lines(f"{self.path}/{name}", before[1], size))
        return {name: end for name, (_, end) in sorted(self.known.items()) if end}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        found = []
        for name, stop in end.items():
            begin = start.get(name, 0)
            found += [Range(name, begin, at, min(at + self.range, stop), stop) for at in range(begin, stop, self.range)]
        return found

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        name, begin, at, stop, end = partition.value
        store, path = stores.opened(f"{self.path}/{name}")
        with store.open_input_file(path) as f:
            left, read = b"", at - 1
            f.seek(max(read, 0))
            while at > begin:  # the line that runs into this range is the range's before; one that begins here follows a break
                block = f.read(min(BLOCK, end - read))
                if not block:
                    return
                if (k := block.find(b"\n")) >= 0:
                    at = read + k + 1
                    break
                read += len(block)
            if at >= stop:
                return
            f.seek(at)
            place, read = at, at
            while place < stop:
                block = f.read(min(BLOCK, end - read))
                read += len(block)
                left += block
                *lines, left = left.split(b"\n")
                out = []
                for line in lines:
                    if place >= stop:
                        break
                    out.append((place, line))
                    place += len(line) + 1
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(out)), pa.array([x for x, _ in out], pa.int64()), pa.array([x.decode("utf-8", "replace") for _, x in out], pa.string())], ["file", "start", "value"])
                if not block:
                    break

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


class GrowingSource(DataSource):
    """Options: suffix of the files, range (bytes of a task)."""

    @classmethod
    def name(cls) -> str:
        return "quire_growing"

    def schema(self) -> str:
        return "file string, start long, value string"

    def streamReader(self, schema) -> GrowingReader:  # noqa: N802
        return GrowingReader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(GrowingSource)
