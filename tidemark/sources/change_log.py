"""A change log in JSON-lines files as a Spark data source: batch, or a stream with offsets by position.

Files are named ``<first position>.jsonl``; a file holds the events from its
position up to the next file's, an event a line, in ascending order, and every line begins
``{"pos": <number>,``.  So the files of a span are known by name, and the lines of
a span without parsing them; Spark parses what it gets.  :func:`read_log` gives the events
after one position and up to another; :func:`stream_log` gives a stream that restarts where its
checkpoint left off and whose batches end with commits.  It starts ``latest`` (unless a checkpoint says
otherwise), ``earliest`` or behind a number; ``maxFilesPerTrigger`` bounds a batch, but
for the first one after a restart.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "pos long, kind string, db string, tbl string, table_id long, is_commit boolean, mark_id string, statement string, changes array<struct<before:string,after:string>>"
END = (1 << 62) - 1
BLOCK = 8 << 20
TAIL = 1 << 16
_POS = re.compile(rb'\s*\{\s*"pos"\s*:\s*(\d+)')
_LINES = pa.schema([("value", pa.string())])


class Span(InputPartition):
    """Lines of a file with low < pos <= high; ``whole`` if that is all of them."""

    def __init__(self, name: str, low: int, high: int, whole: bool) -> None:
        self.name, self.low, self.high, self.whole = name, low, high, whole


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")


def _files(path: str) -> list[tuple[int, str]]:
    from pyarrow import fs

    files, base = _open(path)
    found = files.get_file_info(fs.FileSelector(base, allow_not_found=True))
    return sorted((int(f.base_name.split(".")[0]), f.path) for f in found if f.base_name.endswith(".jsonl"))


def spans(path: str, low: int, high: int) -> list[Span]:
    """The files that may hold events of the span, by their names."""
    files = _files(path)
    out = []
    for k, (first, name) in enumerate(files):
        following = files[k + 1][0] if k + 1 < len(files) else None
        if first <= high and (following is None or following > low + 1):
            out.append(Span(name, low, high, first > low and (high >= END or following is not None and following <= high + 1)))
    return out


def position(line: bytes) -> int:
    if (found := _POS.match(line)) is None:
        raise ValueError(f"a line of the log begins with its pos, not {line[:40]!r}")
    return int(found[1])


def lines(path: str, span: Span) -> Iterator[bytes]:
    """The lines of a span, a block at a time."""
    files, _ = _open(path)
    rest = b""
    with files.open_input_stream(span.name) as f:
        while block := f.read(BLOCK):
            *whole, rest = (rest + block).split(b"\n")
            for line in whole:
                if line.strip() and (span.whole or span.low < position(line) <= span.high):
                    yield line
    if rest.strip() and (span.whole or span.low < position(rest) <= span.high):
        yield rest


def _batches(path: str, span: Span) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for line in lines(path, span):
        held.append(line.decode())
        size += len(line)
        if size >= BLOCK:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], schema=_LINES)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], schema=_LINES)


def _last(path: str, name: str, wanted=lambda event: True) -> int | None:
    """The position of the last such event of a file, read from its end."""
    files, _ = _open(path)
    with files.open_input_file(name) as f:
        size, take = f.size(), TAIL
        while True:
            begin = max(0, size - take)
            f.seek(begin)
            parts = f.read(size - begin).split(b"\n")
            for line in reversed(parts if begin == 0 else parts[1:]):  # the first part may be half a line
                if line.strip() and wanted(event := json.loads(line)):
                    return event["pos"]
            if begin == 0:
                return None
            take *= 4


def head(path: str) -> int:
    """The position of the last event, or -1; looks at the end of the last file that has one."""
    return next((pos for _, name in reversed(_files(path)) if (pos := _last(path, name)) is not None), -1)


def last_commit(path: str, names: list[str] | None = None) -> int:
    """The position of the last commit, or -1: what lies behind it belongs to an open transaction."""
    names = [n for _, n in _files(path)] if names is None else names
    return next((pos for name in reversed(names) if (pos := _last(path, name, lambda e: e.get("is_commit"))) is not None), -1)


class _Batch(DataSourceReader):
    def __init__(self, path: str, options) -> None:
        self.path, self.low, self.high = path, int(options.get("after", "-1")), int(options.get("upto", str(END)))

    def partitions(self):
        return spans(self.path, self.low, self.high) or [Span("", 0, 0, False)]  # Spark wants one

    def read(self, partition):
        return _batches(self.path, partition) if partition.name else iter(())


class _Stream(DataSourceStreamReader):
    def __init__(self, path: str, options) -> None:
        self.path, self.start, self.most, self.at = path, options.get("startingPosition", "latest"), int(options.get("maxFilesPerTrigger", "1000")), None

    def initialOffset(self):
        self.at = last_commit(self.path) if self.start == "latest" else -1 if self.start == "earliest" else int(self.start)
        return {"pos": self.at}

    def latestOffset(self):
        files = _files(self.path)
        names = [name for _, name in files]
        if self.at is None:  # after a restart the checkpoint knows the start, and this reader doesn't
            self.at = last_commit(self.path, names)
            return {"pos": self.at}
        done = sum(first <= self.at for first, _ in files)
        end = last_commit(self.path, names[: done + self.most])
        if end <= self.at:  # a transaction longer than a batch of files
            end = last_commit(self.path, names)
        self.at = max(self.at, end)
        return {"pos": self.at}

    def partitions(self, start, end):
        self.at = end["pos"]
        return spans(self.path, start["pos"], end["pos"])

    def read(self, partition):
        return _batches(self.path, partition)


class ChangeLog(DataSource):
    """The lines of a log; options ``path``, and for a batch ``after`` and ``upto``."""

    @classmethod
    def name(cls) -> str:
        return "change_log"

    def schema(self) -> str:
        return "value string"

    def reader(self, schema):
        return _Batch(self.options["path"], self.options)

    def streamReader(self, schema):
        return _Stream(self.options["path"], self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ChangeLog)


def _parsed(rows: DataFrame) -> DataFrame:
    """Events; rows of tables stay JSON text until their columns are known.  A line that is no event is an error."""
    return rows.select(F.from_json("value", SCHEMA, {"mode": "FAILFAST"}).alias("e")).select("e.*")


def read_log(spark: SparkSession, path: str, after: int = -1, upto: int = END) -> DataFrame:
    """Events with after < pos <= upto; only files that may hold some are opened."""
    register(spark)
    return _parsed(spark.read.format("change_log").option("after", str(after)).option("upto", str(upto)).load(path))


def stream_log(spark: SparkSession, path: str, start: int | str = "latest", files: int = 1000) -> DataFrame:
    register(spark)
    return _parsed(spark.readStream.format("change_log").option("startingPosition", str(start)).option("maxFilesPerTrigger", str(files)).load(path))
