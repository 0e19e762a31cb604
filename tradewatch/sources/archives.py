"""The landing zone as a Spark data source, ``trade_archives``.

Batch and stream read the same rows. With ``content`` (the default) a row is a
piece of whole CSV lines of one archive; without it a row is the archive itself
and no archive is opened. The options ``days`` and ``symbols`` name the wanted
archives: others get no task and are not opened. They are options and not
pushed filters (``pushFilters``), as Spark 4.1 keeps one pushed state per loaded
frame: a frame that was filtered once gave its filtered rows to later queries
without the filter. Small archives share a task, packed by size.

The stream's offset is the set of archives handed out, kept as ranges of days
per symbol, so it grows with the gaps in the calendar and not with the number
of archives, and an archive that lands late for an earlier day is still found.
An archive delivered again under a name handed out before is not read again; one
that was seen to be gone in between is. Other zip files are ignored
(:func:`tradewatch.sources.landing.ignored_files` lists them).
"""

from __future__ import annotations

import re
import sys
import weakref
import zipfile
from collections.abc import Iterable, Iterator
from datetime import date

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from tradewatch.sources import landing

# As in landing.py: executors need not have the package.
try:
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass

NAME = "trade_archives"
SMALLEST_TASK = 4 << 20  # bytes of archives that are worth a task; also what opening one counts as
LARGEST_TASK = 128 << 20

_FILE = "_source_file string, symbol string, trade_date date"
_SCHEMAS = {True: f"text string, {_FILE}", False: f"{_FILE}, size_bytes bigint"}


class Archive:
    """Name, size, symbol and day of a file in the landing folder."""

    @staticmethod
    def listed(folder: str) -> list[tuple[str, int, str, date]]:
        from pyarrow import fs

        store, inner = landing._fs(folder)
        out = []
        for info in store.get_file_info(fs.FileSelector(inner)):
            named = re.match(landing.NAME_RE, info.base_name)
            if info.is_file and named:
                try:
                    out.append((info.base_name, info.size, named[1], date.fromisoformat(named[2])))
                except ValueError:  # a day that does not exist
                    continue
        return sorted(out)


def packed(found: list[tuple[str, int, str, date]], tasks: int) -> list[InputPartition]:
    """Archives dealt to tasks of about equal bytes: for ``tasks`` at once, within the two bounds above."""
    if not found:
        return []
    cost = [size + SMALLEST_TASK for _, size, _, _ in found]
    room = min(LARGEST_TASK, max(SMALLEST_TASK, sum(cost) // max(1, tasks)))
    out, used = [], room + 1
    for one, c in sorted(zip(found, cost), key=lambda x: (-x[1], x[0])):
        if used + c > room:
            out.append([])
            used = 0
        out[-1].append(one)
        used += c
    return [InputPartition(part) for part in out]


class _Rows:
    """What batch and stream readers share: options and the rows of a task's archives."""

    def __init__(self, options: dict[str, str]):
        self.folder = options["path"].rstrip("/")
        self.content = options.get("content", "true").lower() == "true"
        self.tasks = int(options.get("tasks", "1"))
        self.chunk = int(options.get("chunkBytes", landing.CHUNK_BYTES))
        self.days, self.symbols = (None if options.get(o) is None else set(filter(None, options[o].split(","))) for o in ("days", "symbols"))

    def listed(self) -> list[tuple[str, int, str, date]]:
        """The wanted archives that are there."""
        return [
            a
            for a in Archive.listed(self.folder)
            if (self.symbols is None or a[2] in self.symbols) and (self.days is None or str(a[3]) in self.days)
        ]

    def read(self, partition: InputPartition | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # Spark's one task where no archive is left
            return
        named = pa.schema([("_source_file", pa.string()), ("symbol", pa.string()), ("trade_date", pa.date32())])
        for name, size, symbol, day in partition.value:
            if not self.content:
                yield pa.record_batch([[name], [symbol], [day], [size]], schema=named.append(pa.field("size_bytes", pa.int64())))
                continue
            path = f"{self.folder}/{name}"
            with landing._open(path) as raw, zipfile.ZipFile(raw) as archive:
                with archive.open(landing._csv_member(archive, path)) as member:
                    for lines in landing._line_blocks(member, self.chunk):
                        text = pa.array([lines.decode("utf-8")], pa.string())
                        yield pa.record_batch([text, [name], [symbol], [day]], schema=pa.schema([("text", pa.string()), *named]))


class ArchiveReader(_Rows, DataSourceReader):
    def partitions(self) -> list[InputPartition]:
        return packed(self.listed(), self.tasks)


def ranges(days: Iterable[int]) -> str:
    """Numbers as ``first-last`` pieces joined by commas."""
    out: list[list[int]] = []
    for d in sorted(set(days)):
        if out and out[-1][1] == d - 1:
            out[-1][1] = d
        else:
            out.append([d, d])
    return ",".join(f"{a}-{b}" for a, b in out)


def within(day: int, text: str) -> bool:
    """Whether ``ranges`` text holds a number."""
    pieces = (p.split("-") for p in text.split(",") if p)
    return any(int(a) <= day <= int(b) for a, b in pieces)


class ArchiveStreamReader(_Rows, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        days: dict[str, list[int]] = {}
        for _, _, symbol, day in self.listed():
            days.setdefault(symbol, []).append(day.toordinal())
        return {s: ranges(days[s]) for s in sorted(days)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        def new(symbol: str, day: int) -> bool:
            return within(day, end.get(symbol, "")) and not within(day, start.get(symbol, ""))

        return packed([a for a in self.listed() if new(a[2], a[3].toordinal())], self.tasks)


class ArchiveSource(DataSource):
    """``path`` with a scheme; ``days`` and ``symbols``: the wanted ones, joined by commas (empty: none, left out:
    all); ``content``: lines (true) or the archives themselves (false); ``tasks``: tasks that run at once;
    ``chunkBytes``: size of a piece of lines."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return _SCHEMAS[self.options.get("content", "true").lower() == "true"]

    def reader(self, schema) -> DataSourceReader:
        return ArchiveReader(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return ArchiveStreamReader(dict(self.options))


_known: weakref.WeakSet = weakref.WeakSet()


def register(spark: SparkSession) -> None:
    """Makes ``trade_archives`` known to a session."""
    if spark not in _known:
        spark.dataSource.register(ArchiveSource)
        _known.add(spark)


def _options(spark: SparkSession, content: bool, days: Iterable | None, symbols: Iterable[str] | None) -> dict[str, str]:
    register(spark)
    wanted = {"days": days, "symbols": symbols}
    return {
        "content": str(content).lower(),
        "tasks": str(spark.sparkContext.defaultParallelism),
        "chunkBytes": str(landing.CHUNK_BYTES),
        **{o: ",".join(map(str, some)) for o, some in wanted.items() if some is not None},
    }


def read_archives(
    spark: SparkSession,
    landing_dir: str,
    days: Iterable[date] | None = None,
    symbols: Iterable[str] | None = None,
    content: bool = True,
) -> DataFrame:
    """The archives of ``landing_dir`` (of some days and symbols only, if given): pieces of their lines, or one row each."""
    source = spark.read.format(NAME).options(**_options(spark, content, days, symbols))
    return source.load(landing.qualified(spark, landing_dir))


def stream_archives(
    spark: SparkSession, landing_dir: str, symbols: Iterable[str] | None = None, content: bool = True
) -> DataFrame:
    """The same as a stream: every archive once, when it has landed."""
    source = spark.readStream.format(NAME).options(**_options(spark, content, None, symbols))
    return source.load(landing.qualified(spark, landing_dir))
