"""Structured completion: a client per task, a table of responses instead of a cache of files, or captured runs."""

from __future__ import annotations

import functools
import importlib
import itertools
import json
import threading
import time
import urllib.request
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundmill.config import Config
from groundmill.sources.scratch import exists

from .prompts import cache_key


#: Answers that a task hands over at once.
ANSWERS = 64


class CompletionError(RuntimeError):
    """A response is missing or is not what the schema asks for."""


class Client(Protocol):
    def complete_json(self, *, model: str, system: str, user: str, schema: dict, key: str) -> dict: ...


class HttpClient:
    """Client of a server with the widespread chat interface: one request per completion, whose answer must fit a JSON schema.

    ``post`` takes the address, headers and body of a request and gives the answer's bytes; by default it goes over
    the network. Failures are tried again after growing waits; an answer that is no JSON object is a failure too.
    """

    def __init__(self, url: str, secret: str, max_tokens: int, temperature: float, attempts: int = 4, wait: float = 1.0, post: Callable[[str, dict, bytes], bytes] | None = None) -> None:
        self.url, self.secret, self.limits = url.rstrip("/"), secret, {"max_tokens": max_tokens, "temperature": temperature}
        self.attempts, self.wait, self.post = attempts, wait, post or _post

    def complete_json(self, *, model: str, system: str, user: str, schema: dict, key: str) -> dict:
        said = [{"role": role, "content": text} for role, text in (("system", system), ("user", user))]
        form = {"type": "json_schema", "json_schema": {"name": "answer", "schema": schema}}
        body = json.dumps({"model": model, "messages": said, "response_format": form, **self.limits}, ensure_ascii=False).encode()
        headers = {"Content-Type": "application/json", "Authorization": f"Bearer {self.secret}"}
        for k in range(self.attempts):
            try:
                answer = json.loads(self.post(f"{self.url}/chat/completions", headers, body))
                value = json.loads(answer["choices"][0]["message"]["content"])
                if isinstance(value, dict):
                    return value
                problem: Exception = ValueError("the answer is no JSON object")
            except (OSError, ValueError, LookupError, TypeError) as e:
                problem = e
            if k + 1 < self.attempts:
                time.sleep(min(20.0, self.wait * 2**k))
        raise CompletionError(f"no answer for {key} after {self.attempts} attempts: {problem}") from problem


class EchoClient:
    """Stands in for a server, without a network: an answer that tells the length of what was asked."""

    def complete_json(self, *, model: str, system: str, user: str, schema: dict, key: str) -> dict:
        return {"asked": len(user)}


def _post(url: str, headers: dict, body: bytes) -> bytes:
    with urllib.request.urlopen(urllib.request.Request(url, data=body, headers=headers), timeout=120) as r:
        return r.read()


def client_factory(cfg: Config, name: str | None = None) -> Callable[[], Client]:
    """What makes a client in each task: the function ``name`` ("module:function"), which takes the settings, or clients of the server that they name.

    Without either there is nothing to ask, which is told before any work begins.
    """
    if name:
        module, _, attribute = name.partition(":")
        make = getattr(importlib.import_module(module), attribute)
        return functools.partial(make, cfg)
    if not cfg.api_url:
        raise CompletionError("no server is set (QA_API_URL); give captured runs to replay or a client's name")
    return functools.partial(HttpClient, cfg.api_url, cfg.api_key, cfg.max_output_tokens, cfg.temperature)


@dataclass(frozen=True)
class Limits:
    """How requests go out: ``in_flight`` at once from a task; ``tokens_per_minute`` over all ``tasks`` together, 0 for any number.

    A budget of tokens needs the number of tasks, since each keeps to its share. With ``tasks`` 0 requests stay in the
    partitions that they come in.
    """

    in_flight: int = 1
    tokens_per_minute: int = 0
    tasks: int = 0

    def __post_init__(self) -> None:
        if self.in_flight < 1 or self.tasks < 0 or self.tokens_per_minute < 0:
            raise ValueError("a request at a time at least; tasks and tokens are not negative")
        if self.tokens_per_minute and not self.tasks:
            raise ValueError("a budget of tokens is shared among a known number of tasks")


class TokenBudget:
    """Lets requests pass so that their tokens keep to a rate: each waits until those before it are paid for. Any thread may wait."""

    def __init__(self, per_second: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> None:
        self.per_second, self.clock, self.sleep, self.paid, self.lock = per_second, clock, sleep, clock(), threading.Lock()

    def wait(self, tokens: float) -> None:
        with self.lock:
            now = self.clock()
            start = max(now, self.paid)
            self.paid = start + tokens / self.per_second
        if start > now:
            self.sleep(start - now)


def estimated_tokens(request: dict, max_output: int) -> int:
    """Four characters a token, and all that the answer may be."""
    return sum(max(1, len(request[c] or "") // 4) for c in ("system", "user")) + max_output


def in_order(rows: Iterable, work: Callable, in_flight: int) -> Iterator:
    """``work`` of each row, in the order of the rows, with ``in_flight`` of them under way at most.

    Rows are drawn when there is room, so that neither requests nor answers pile up behind a slow one. The first
    failure is raised in its turn; what was not begun by then is not.
    """
    if in_flight == 1:
        yield from map(work, rows)
        return
    under_way: deque[Future] = deque()
    pool = ThreadPoolExecutor(in_flight)
    try:
        for row in rows:
            if len(under_way) == in_flight:
                yield under_way.popleft().result()
            under_way.append(pool.submit(work, row))
        while under_way:
            yield under_way.popleft().result()
    finally:
        pool.shutdown(wait=True, cancel_futures=True)


def complete(requests: DataFrame, make_client: Callable[[], Client], schema: dict, limits: Limits = Limits(), max_output_tokens: int = 4096) -> DataFrame:
    """(key, response) for requests (key, model, system, user), in the order of a task's requests; each thread of a task makes one client. Responses are JSON text."""
    rows = requests.select("key", "model", "system", "user")
    if limits.tasks:
        rows = rows.repartition(limits.tasks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = threading.local()
        budget = TokenBudget(limits.tokens_per_minute / 60 / limits.tasks) if limits.tokens_per_minute else None

        def ask(r: dict) -> tuple[str, str]:
            if not hasattr(own, "client"):
                own.client = make_client()
            if budget:
                budget.wait(estimated_tokens(r, max_output_tokens))
            answer = own.client.complete_json(model=r["model"], system=r["system"], user=r["user"], schema=schema, key=r["key"])
            return r["key"], json.dumps(answer, ensure_ascii=False)

        answered = in_order((r for b in batches for r in b.to_pylist()), ask, limits.in_flight)
        while some := list(itertools.islice(answered, ANSWERS)):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*some)], ["key", "response"])

    return rows.mapInArrow(run, "key string, response string")


def with_hash(requests: DataFrame) -> DataFrame:
    return requests.withColumn("hash", cache_key(F.col("model"), F.col("system"), F.col("user")))


def cache_misses(requests: DataFrame, cache: DataFrame) -> DataFrame:
    """Requests without a response in ``cache`` (hash, response), one per hash."""
    return with_hash(requests).join(cache.select("hash"), "hash", "left_anti").dropDuplicates(["hash"])


def complete_cached(requests: DataFrame, cache_path: str, make_client: Callable[[], Client], schema: dict, limits: Limits = Limits(), max_output_tokens: int = 4096) -> DataFrame:
    """Responses from the cache table; misses are called, appended and then read like the others.

    A run that is repeated calls only what its earlier attempts did not write. Two runs that share a table may both
    call a request that neither found; of responses to one request one is taken, the same for all that read them.
    """
    spark = requests.sparkSession
    kind = "hash string, response string"
    held = lambda: spark.read.schema(kind).parquet(cache_path) if exists(spark, cache_path) else spark.createDataFrame([], kind)
    misses = cache_misses(requests, held())
    called = complete(misses.withColumn("key", F.col("hash")), make_client, schema, limits, max_output_tokens).withColumnRenamed("key", "hash")
    called.write.mode("append").parquet(cache_path)
    cache = held().groupBy("hash").agg(F.min("response").alias("response"))
    return with_hash(requests).join(cache, "hash").select("key", "response")


def replay(requests: DataFrame, captured: DataFrame, on: list[str]) -> DataFrame:
    """Requests with their captured responses; a request without one ends the run."""
    missing = requests.join(captured.select(*on), on, "left_anti").select(*on).limit(5).collect()
    if missing:
        raise CompletionError(f"no captured response for {[tuple(r) for r in missing]}")
    return requests.join(captured, on)
