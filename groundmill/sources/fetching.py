"""Paced fetching as a data source, for tables and streams of addresses.

    register(spark)
    spark.read.format("paced_fetch").options(addresses=path, get="module:function", rate=10, tasks=4).load()
    spark.readStream.format("paced_fetch").options(...).load()

``addresses`` is a folder of Parquet files with a column ``url``, at any depth. Driver and tasks open it with pyarrow, so it
is an address that pyarrow knows (a path, file:, hdfs:, s3:, gs:). The driver reads the files' footers alone. Rows are cut
into ``tasks`` ranges of like length; range i asks at i, i + tasks, i + 2 tasks ... ticks of 1 / ``rate`` seconds, so that all
of them together keep to the rate, however many run at once. An address without a ``landing`` zone is asked for
whenever its range is read; with one, its bytes are kept there first, in a file named by the address's digest, and whoever
reads the address again (a task that is tried again, a batch that is repeated, another run) takes these.

A stream's offset is the name of the last file that it has taken; files that are added later must sort behind it.
"""

from __future__ import annotations

import functools
import hashlib
import importlib
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from groundmill.config import Config

from .registry import http_get

SCHEMA = "url string, content binary"
#: Bytes of content that a task hands over at once, about.
AT_ONCE = 4 << 20


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The store of an address and the path in it."""
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def address_files(uri: str) -> list[str]:
    """Names of Parquet files below ``uri``, relative to it and sorted; hidden ones and those still being written have a name that begins with a dot or underscore."""
    store, path = opened(uri)
    found = store.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True))
    names = [f.path[len(path.rstrip("/")) + 1 :] for f in found if f.is_file and f.path.endswith(".parquet")]
    return sorted(n for n in names if not any(p[0] in "._" for p in n.split("/")))


@dataclass
class Range(InputPartition):
    """Rows [begin, end) of each file, for the task ``number``."""

    number: int
    parts: list[tuple[str, int, int]]


def ranges(uri: str, names: list[str], tasks: int) -> list[Range]:
    """All rows of these files in ``tasks`` ranges, fewer where there are fewer rows."""
    store, path = opened(uri)
    sizes = [pq.read_metadata(f"{path}/{n}", filesystem=store).num_rows for n in names]
    total = sum(sizes)
    cuts = sorted({total * i // tasks for i in range(tasks + 1)})
    out = []
    for number, (low, high) in enumerate(zip(cuts, cuts[1:])):
        at, parts = 0, []
        for name, size in zip(names, sizes):
            begin, end = max(low, at), min(high, at + size)
            if begin < end:
                parts.append((name, begin - at, end - at))
            at += size
        out.append(Range(number, parts))
    return out


def rows_between(uri: str, name: str, begin: int, end: int) -> Iterator[str | None]:
    """Addresses of rows [begin, end) of a file; groups of rows outside are not read."""
    store, path = opened(uri)
    with store.open_input_file(f"{path}/{name}") as f:
        file, at = pq.ParquetFile(f), 0
        for g in range(file.num_row_groups):
            size = file.metadata.row_group(g).num_rows
            if at < end and at + size > begin:
                urls = file.read_row_group(g, columns=["url"]).column("url")
                yield from urls.slice(max(0, begin - at), min(size, end - at) - max(0, begin - at)).to_pylist()
            at += size


class Pace:
    """Lets one of ``tasks`` callers pass at its own ticks of 1 / ``rate`` seconds; one that is late takes its next tick, and does not hurry after."""

    def __init__(self, rate: float, tasks: int, number: int, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> None:
        self.step, self.next, self.clock, self.sleep = tasks / rate, clock() + number / rate, clock, sleep

    def wait(self) -> None:
        now = self.clock()
        if now < self.next:
            self.sleep(self.next - now)
            now = self.next
        self.next = max(self.next + self.step, now + self.step)


class Landing:
    """Bytes by address below a folder; a file appears whole or not at all."""

    def __init__(self, uri: str) -> None:
        self.store, self.path = opened(uri)

    def _at(self, url: str) -> str:
        digest = hashlib.sha256(url.encode()).hexdigest()
        return f"{self.path}/{digest[:2]}/{digest}"

    def get(self, url: str) -> bytes | None:
        try:
            with self.store.open_input_file(self._at(url)) as f:
                return f.read()
        except FileNotFoundError:
            return None

    def put(self, url: str, content: bytes) -> None:
        at = self._at(url)
        self.store.create_dir(at.rpartition("/")[0], recursive=True)
        aside = f"{at}.{uuid.uuid4().hex}"
        with self.store.open_output_stream(aside) as f:
            f.write(content)
        self.store.move(aside, at)


def _named(name: str) -> Callable[[str], bytes]:
    module, _, attribute = name.partition(":")
    return functools.reduce(getattr, attribute.split("."), importlib.import_module(module))


class _Fetching:
    """What table and stream share: settings, ranges, and the reading of one."""

    def __init__(self, options) -> None:
        missing = [k for k in ("addresses", "get") if not options.get(k)]
        if missing:
            raise ValueError(f"paced_fetch needs the options {', '.join(missing)}")
        self.addresses, self.get, self.landing = options["addresses"], options["get"], options.get("landing")
        self.rate, self.tasks, self.attempts = float(options.get("rate", "10")), int(options.get("tasks", "1")), int(options.get("attempts", "4"))
        if self.rate <= 0 or self.tasks < 1 or self.attempts < 1:
            raise ValueError("paced_fetch: rate, tasks and attempts must be positive")

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        """(url, content), null for a null address. What fails is asked for again at later ticks, after growing waits; the last failure is raised."""
        get, pace, landing = _named(self.get), Pace(self.rate, self.tasks, partition.number), Landing(self.landing) if self.landing else None

        def one(url: str) -> bytes:
            if landing and (held := landing.get(url)) is not None:
                return held
            for k in range(self.attempts):
                pace.wait()
                try:
                    content = get(url)
                    break
                except Exception:
                    if k + 1 == self.attempts:
                        raise
                    time.sleep(min(20, 2**k))
            if landing:
                landing.put(url, content)
            return content

        urls: list[str | None] = []
        contents: list[bytes | None] = []
        size = 0
        for name, begin, end in partition.parts:
            for url in rows_between(self.addresses, name, begin, end):
                urls.append(url)
                contents.append(None if url is None else one(url))
                size += len(contents[-1] or b"") + len(url or "")
                if size >= AT_ONCE:
                    yield _batch(urls, contents)
                    urls, contents, size = [], [], 0
        if urls:
            yield _batch(urls, contents)


def _batch(urls: list, contents: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(urls, pa.string()), pa.array(contents, pa.binary())], ["url", "content"])


class _Table(_Fetching, DataSourceReader):
    def partitions(self) -> list[Range]:
        return ranges(self.addresses, address_files(self.addresses), self.tasks)


class _Stream(_Fetching, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"after": ""}

    def latestOffset(self) -> dict:
        return {"after": max(address_files(self.addresses), default="")}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        return ranges(self.addresses, [n for n in address_files(self.addresses) if start["after"] < n <= end["after"]], self.tasks)

    def commit(self, end: dict) -> None:
        """Nothing is held for a batch."""


class PacedFetch(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paced_fetch"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Table(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Stream(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PacedFetch)


def over_http(url: str) -> bytes:
    """What ``get`` names for a real archive; the settings say how to introduce oneself."""
    return http_get(url, Config().user_agent)


def echo(url: str) -> bytes:
    """Stands in for a server, without a network: a body that tells its address."""
    return f"body of {url}".encode()
