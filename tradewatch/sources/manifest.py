"""Commit log of the warehouse: which version of a day's facts is the valid one.

The fact tables of a load belong together, but a file system replaces one folder at a time. So a
load writes its days under a new *version* (``<table>/<day>/[symbol=..]/version=..``), beside the
one in use, and then adds one small file to the log that names the version of each (day, symbol)
it covers. Readers go by the log, so they see all tables of all days of a load or none; a load
that dies before its commit leaves files that nobody reads and the next load of the day removes.

A commit is a file with the next number. It is written aside and moved into place by a rename that
fails if the number is taken, so of two loads that commit at once one has to look again: it takes
the number after the other's if their days differ, and fails if they share one. Every
``FULL_EVERY``-th commit lists all entries, and readers start from the last of those: a reader
opens ``FULL_EVERY`` files at most, of one short entry a (day, symbol).
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from tradewatch.sources.layers import _fs, child_names

FULL_EVERY = 32


class CommitConflict(RuntimeError):
    """Another load has committed one of this load's days since this one began."""


@dataclass(frozen=True)
class Entry:
    """What the log says of one (day, symbol); ``symbol`` is empty for tables without symbols."""

    day: str
    symbol: str
    version: str
    tables: tuple[str, ...] = ()  # those that have rows
    keys: tuple[int, int, int] | None = None  # number, least and greatest of the loaded trade ids

    @property
    def slice(self) -> tuple[str, str]:
        return self.day, self.symbol


@dataclass(frozen=True)
class Manifest:
    number: int = 0  # of the last commit; 0 before the first
    entries: dict[tuple[str, str], Entry] = field(default_factory=dict)

    def next_version(self) -> str:
        """Unique name of a version; it sorts behind all committed ones."""
        return f"{self.number + 1:08d}-{uuid.uuid4().hex[:8]}"


def _read(spark: SparkSession, path: str) -> dict:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _numbers(spark: SparkSession, root: str) -> list[int]:
    return [int(n[:8]) for n in child_names(spark, root) if n[:8].isdigit() and n.endswith(".json")]


def load_manifest(spark: SparkSession, root: str) -> Manifest:
    """The log's state: its last full commit and those after it."""
    numbers, later = _numbers(spark, root), []
    for n in reversed(numbers):
        later.append(_read(spark, f"{root}/{n:08d}.json"))
        if later[-1]["full"]:
            break
    entries: dict[tuple[str, str], Entry] = {}
    for commit in reversed(later):
        for e in commit["entries"]:
            got = Entry(e["day"], e["symbol"], e["version"], tuple(e["tables"]), tuple(e["keys"]) if e["keys"] else None)
            entries[got.slice] = got
    return Manifest(max(numbers, default=0), entries)


def _put(spark: SparkSession, root: str, number: int, text: str) -> bool:
    """Adds a file to the log; False if its number is taken."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    aside, final = f"{root}/_new-{uuid.uuid4().hex}", f"{root}/{number:08d}.json"
    fs, p = _fs(spark, aside)
    out = fs.create(p, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    to = _fs(spark, final)[1]
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), fs.getConf())
    options = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        context.rename(fs.makeQualified(p), fs.makeQualified(to), options)
        return True
    except Exception:
        if not fs.exists(to):
            raise
        return False
    finally:
        fs.delete(p, False)


def commit(spark: SparkSession, root: str, base: Manifest, changed: list[Entry]) -> Manifest:
    """Makes ``changed`` valid in one step, on top of ``base`` and whatever was committed beside it since."""
    now = base
    while True:
        entries = {**now.entries, **{e.slice: e for e in changed}}
        number = now.number + 1
        full = number % FULL_EVERY == 1
        body = [e.__dict__ for e in (entries.values() if full else changed)]
        if _put(spark, root, number, json.dumps({"full": full, "entries": body})):
            return Manifest(number, entries)
        now = load_manifest(spark, root)
        taken = [e.slice for e in changed if now.entries.get(e.slice) != base.entries.get(e.slice)]
        if taken:
            raise CommitConflict(f"committed meanwhile by another load: {taken}")
