"""Completions by jobs: many requests are submitted at once, asked after, and collected when they are done.

What a run knows is in tables below one folder, so that it can be stopped anywhere and started again:

    plan/       (hash, job, model, system, user): written once, each request in one job of a bounded size
    states/     (job, state, handle): one row for each step that a job has taken
    results/    (job, hash, response)

A job's name is made from its requests. A server that knows a name already gives its handle, so that a job whose
submission was not noted is not submitted twice; results that were written before their state are not fetched again.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundmill.sources.scratch import exists

from .completion import CompletionError, cache_misses, with_hash

PLAN, STATE, RESULT = "hash string, job string, model string, system string, user string", "job string, state string, handle string", "job string, hash string, response string"
#: Requests of a job at most, on average; steps of a job in their order.
JOB_SIZE = 1000
SUBMITTED, DONE, COLLECTED, FAILED = "submitted", "done", "collected", "failed"


class BatchClient(Protocol):
    """A server that takes jobs. ``find`` gives the handle of a job that was submitted under this name, or None."""

    def find(self, name: str) -> str | None: ...

    def submit(self, name: str, requests: list[dict], schema: dict) -> str: ...

    def status(self, handle: str) -> str:
        """"running", "done" or "failed"."""

    def results(self, handle: str) -> dict[str, dict]:
        """Answers by the requests' keys."""


class EchoJobs:
    """Stands in for a server of jobs, without a network; a handle is what its answers are."""

    def find(self, name: str) -> str | None:
        return None

    def submit(self, name: str, requests: list[dict], schema: dict) -> str:
        return json.dumps({r["key"]: {"asked": len(r["user"])} for r in requests})

    def status(self, handle: str) -> str:
        return DONE

    def results(self, handle: str) -> dict[str, dict]:
        return json.loads(handle)


def _table(spark: SparkSession, path: str, kind: str) -> DataFrame:
    return spark.read.schema(kind).parquet(path) if exists(spark, f"{path}/_SUCCESS") else spark.createDataFrame([], kind)


def plan_jobs(requests: DataFrame, path: str, cache: DataFrame | None = None, size: int = JOB_SIZE) -> DataFrame:
    """The plan below ``path``: as it was written, or made of ``requests`` (model, system, user) that have no response in ``cache``; equal requests are one."""
    spark, at = requests.sparkSession, f"{path}/plan"
    if not exists(spark, f"{at}/_SUCCESS"):
        missing = cache_misses(requests, cache) if cache is not None else with_hash(requests).dropDuplicates(["hash"])
        jobs = max(1, -(-missing.count() // size))
        # a job's name is a digest of the requests' own digests, so that the same plan has the same names
        dealt = missing.withColumn("part", F.pmod(F.xxhash64("hash"), F.lit(jobs)))
        names = dealt.groupBy("part").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("hash")), ","), 256).alias("job"))  # JOB_SIZE digests or so
        dealt.join(names, "part").select("hash", "job", "model", "system", "user").write.mode("overwrite").parquet(at)
    return spark.read.schema(PLAN).parquet(at)


def states(spark: SparkSession, path: str) -> DataFrame:
    """(job, state, handle): the last step of each job of the plan; one that has taken none has null."""
    rank = F.element_at(F.create_map(*[F.lit(x) for k, s in enumerate((SUBMITTED, DONE, FAILED, COLLECTED)) for x in (s, k)]), F.col("state"))
    last = _table(spark, f"{path}/states", STATE).groupBy("job").agg(F.max_by("state", rank).alias("state"), F.max("handle").alias("handle"))
    fetched = _table(spark, f"{path}/results", RESULT).select("job").distinct().withColumn("fetched", F.lit(True))
    jobs = _table(spark, f"{path}/plan", PLAN).select("job").distinct().join(last, "job", "left").join(fetched, "job", "left")
    return jobs.select("job", F.when(F.col("fetched"), COLLECTED).otherwise(F.col("state")).alias("state"), "handle")


def _note(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(f"{path}/states")


def submit(spark: SparkSession, path: str, make_client: Callable[[], BatchClient], schema: dict) -> None:
    """Submit the jobs that were not, each by one task that has the job's requests."""
    new = states(spark, path).where("state IS NULL").select("job")

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        client, name = make_client(), pdf["job"].iloc[0]
        handle = client.find(name)
        if handle is None:
            pdf = pdf.sort_values("hash")
            handle = client.submit(name, [{"key": h, "model": m, "system": s, "user": u} for h, m, s, u in zip(pdf["hash"], pdf["model"], pdf["system"], pdf["user"])], schema)
        return pd.DataFrame({"job": [name], "state": [SUBMITTED], "handle": [handle]})

    _note(_table(spark, f"{path}/plan", PLAN).join(new, "job", "left_semi").groupBy("job").applyInPandas(one, STATE), path)


def poll(spark: SparkSession, path: str, make_client: Callable[[], BatchClient]) -> int:
    """Ask after the jobs that are submitted and note those that have ended; the number of those that have not."""
    waiting = states(spark, path).where(F.col("state") == SUBMITTED)

    def ask(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()
        for pdf in parts:
            yield pdf.assign(state=[client.status(h) for h in pdf["handle"]])[["job", "state", "handle"]]

    _note(waiting.mapInPandas(ask, STATE).where(F.col("state").isin(DONE, FAILED)), path)
    return states(spark, path).where(F.col("state") == SUBMITTED).count()


def collect(spark: SparkSession, path: str, make_client: Callable[[], BatchClient]) -> None:
    """Fetch the answers of jobs that are done and were not fetched."""
    done = states(spark, path).where(F.col("state") == DONE).select("job", "handle").repartition("job")

    def fetch(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()
        for pdf in parts:
            for job, handle in zip(pdf["job"], pdf["handle"]):
                answers = client.results(handle)
                yield pd.DataFrame({"job": job, "hash": list(answers), "response": [json.dumps(a, ensure_ascii=False) for a in answers.values()]})

    done.mapInPandas(fetch, RESULT).write.mode("append").parquet(f"{path}/results")
    _note(states(spark, path).where(F.col("state") == COLLECTED), path)


def complete_by_jobs(requests: DataFrame, path: str, make_client: Callable[[], BatchClient], schema: dict, cache: DataFrame | None = None, size: int = JOB_SIZE, wait: float = 30.0, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """(key, response) of all ``requests`` (key, model, system, user) by jobs below ``path``, with the responses that ``cache`` (hash, response) holds.

    A call that is repeated after it was stopped goes on after the last step that was taken: no request is submitted and
    no answer fetched twice. Failed jobs, and requests that a job left unanswered, end the run when all others are
    collected.
    """
    spark = requests.sparkSession
    plan = plan_jobs(requests, path, cache, size)
    submit(spark, path, make_client, schema)
    while poll(spark, path, make_client):
        collect(spark, path, make_client)
        sleep(wait)
    collect(spark, path, make_client)
    results = _table(spark, f"{path}/results", RESULT).groupBy("hash").agg(F.min("response").alias("response"))
    lost = plan.join(results, "hash", "left_anti").select("job").distinct().limit(5).collect()
    if lost:
        raise CompletionError(f"no answers from jobs {[r['job'] for r in lost]}")
    known = results if cache is None else results.unionByName(cache.select("hash", "response")).groupBy("hash").agg(F.min("response").alias("response"))
    return with_hash(requests).join(known, "hash").select("key", "response")
