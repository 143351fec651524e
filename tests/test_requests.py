"""Requests in flight, budgets of tokens, and jobs that are submitted, asked after and collected."""

import json
import os
import threading
import time
from functools import partial

import pytest

from groundmill.operators import jobs
from groundmill.operators.completion import CompletionError, Limits, TokenBudget, complete, estimated_tokens, in_order

KIND = "key string, model string, system string, user string"


def asked(spark, n):
    return spark.createDataFrame([(f"k{i}", "m", "s", f"question {i}") for i in range(n)], KIND)


class Slow:
    """Answers after a delay that differs; notes how many are under way at once in a folder."""

    lock, now, most = threading.Lock(), 0, 0

    def __init__(self, folder):
        self.folder = folder

    def complete_json(self, *, model, system, user, schema, key):
        with Slow.lock:
            Slow.now += 1
            Slow.most = max(Slow.most, Slow.now)
            with open(f"{self.folder}/most-{os.getpid()}", "w") as f:
                f.write(str(Slow.most))
        time.sleep(0.05 + 0.02 * (int(key[1:]) % 3))
        with Slow.lock:
            Slow.now -= 1
        if user.endswith(" 99"):
            raise ValueError("no answer to 99")
        return {"of": user}


def test_many_in_flight_give_the_rows_of_one(spark, tmp_path):
    rows = asked(spark, 48).coalesce(1)
    out, took = [], []
    for n in (1, 8):
        (tmp_path / str(n)).mkdir()
        began = time.time()
        out.append([tuple(r) for r in complete(rows, partial(Slow, str(tmp_path / str(n))), {}, Limits(n)).collect()])
        took.append(time.time() - began)
    assert out[0] == out[1] == [(f"k{i}", json.dumps({"of": f"question {i}"})) for i in range(48)]
    assert took[1] < took[0] / 2
    assert max(int(p.read_text()) for p in (tmp_path / "8").iterdir()) <= 8
    with pytest.raises(Exception, match="no answer to 99"):
        complete(asked(spark, 100), partial(Slow, str(tmp_path)), {}, Limits(4)).collect()


def test_no_more_is_drawn_than_is_under_way():
    drawn, given = [], []
    for x in in_order((drawn.append(i) or i for i in range(40)), lambda i: i * i, 5):
        given.append(x)
        assert len(drawn) - len(given) <= 5
    assert given == [i * i for i in range(40)]
    begun = []

    def work(i):
        begun.append(i)
        if i == 3:
            raise KeyError(i)
        return i

    got = []
    with pytest.raises(KeyError):
        for x in in_order(range(1000), work, 4):
            got.append(x)
    assert got == [0, 1, 2] and len(begun) <= 8


def test_tokens_keep_to_their_rate():
    now, slept = [0.0], []
    budget = TokenBudget(100, lambda: now[0], slept.append)
    for tokens in (50, 200, 10):
        budget.wait(tokens)
    assert slept == [0.5, 2.5]
    now[0] = 100.0
    budget.wait(1000)
    assert slept == [0.5, 2.5]  # time that nobody used is not saved up beyond the first request
    assert estimated_tokens({"system": None, "user": "x" * 40}, 7) == 18
    for wrong in (dict(in_flight=0), dict(tokens_per_minute=5), dict(tasks=-1)):
        with pytest.raises(ValueError):
            Limits(**wrong)


def test_the_budget_is_shared_by_tasks(spark, tmp_path):
    rows = asked(spark, 12)
    began = time.time()
    assert complete(rows, partial(Slow, str(tmp_path)), {}, Limits(4, tokens_per_minute=60 * 2 * 40, tasks=2), max_output_tokens=17).count() == 12
    assert time.time() - began >= 5 * 20 / 40  # six requests a task, of 20 tokens, at 40 a second


class Server:
    """Keeps its jobs in a folder; ``stop`` ends the run at a named step, once, before or after the step's work."""

    def __init__(self, folder, stop=None):
        self.folder, self.stop = folder, stop

    def _step(self, step):
        if self.stop == step and not os.path.exists(f"{self.folder}/stopped-{step}"):
            open(f"{self.folder}/stopped-{step}", "w").close()
            raise RuntimeError(f"stopped at {step}")

    def _note(self, what):
        with open(f"{self.folder}/log", "a") as f:
            f.write(what + "\n")

    def find(self, name):
        return f"h-{name}" if os.path.exists(f"{self.folder}/job-{name}") else None

    def submit(self, name, requests, schema):
        self._step("before submit")
        assert not os.path.exists(f"{self.folder}/job-{name}")
        with open(f"{self.folder}/job-{name}", "w") as f:
            json.dump(requests, f)
        self._note(f"submit {name}")
        self._step("after submit")
        return f"h-{name}"

    def status(self, handle):
        self._step("status")
        seen = f"{self.folder}/seen-{handle}"
        if os.path.exists(f"{self.folder}/failing"):
            return "failed"
        if os.path.exists(seen):
            return "done"
        open(seen, "w").close()
        return "running"

    def results(self, handle):
        self._step("before results")
        with open(f"{self.folder}/job-{handle[2:]}") as f:
            requests = json.load(f)
        self._note(f"results {handle[2:]}")
        return {r["key"]: {"of": r["user"]} for r in requests}


@pytest.mark.parametrize("stop", [None, "plan", "before submit", "after submit", "submitted", "status", "polled", "before results", "results written"])
def test_a_stopped_run_calls_nothing_twice(spark, tmp_path, monkeypatch, stop):
    make, path = partial(Server, str(tmp_path), stop), str(tmp_path / "run")
    rows = asked(spark, 23).unionByName(spark.createDataFrame([("again", "m", "s", "question 3")], KIND))
    after = {"plan": "plan_jobs", "submitted": "submit", "polled": "poll"}
    with monkeypatch.context() as m:
        if stop in after:  # the driver goes down when the step is done
            whole = getattr(jobs, after[stop])

            def cut_short(*a, **b):
                whole(*a, **b)
                raise RuntimeError("the driver went down")

            m.setattr(jobs, after[stop], cut_short)
        if stop == "results written":
            m.setattr(jobs, "_note", lambda df, p, note=jobs._note: (_ for _ in ()).throw(RuntimeError("down")) if os.path.exists(f"{path}/results/_SUCCESS") else note(df, p))
        if stop:
            with pytest.raises(Exception):
                jobs.complete_by_jobs(rows, path, make, {}, size=10, wait=0)
    got = {r["key"]: json.loads(r["response"])["of"] for r in jobs.complete_by_jobs(rows, path, make, {}, size=10, wait=0).collect()}
    assert got == {f"k{i}": f"question {i}" for i in range(23)} | {"again": "question 3"}
    log = (tmp_path / "log").read_text().split("\n")[:-1]
    names = {x.split()[1] for x in log}
    assert sorted(log) == sorted(f"{step} {n}" for n in names for step in ("submit", "results"))
    assert {r["state"] for r in jobs.states(spark, path).collect()} == {"collected"}


def test_cached_answers_are_not_asked_for_and_failures_are_told(spark, tmp_path):
    from groundmill.operators.completion import with_hash

    rows = asked(spark, 6)
    cache = with_hash(rows.limit(4)).selectExpr("hash", "'{\"of\": \"cache\"}' AS response")
    got = jobs.complete_by_jobs(rows, str(tmp_path / "run"), partial(Server, str(tmp_path)), {}, cache, wait=0).collect()
    assert sorted(json.loads(r["response"])["of"] for r in got) == ["cache"] * 4 + ["question 4", "question 5"]
    (tmp_path / "failing").touch()
    with pytest.raises(CompletionError, match="no answers"):
        jobs.complete_by_jobs(rows, str(tmp_path / "run2"), partial(Server, str(tmp_path)), {}, wait=0)
