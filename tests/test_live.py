"""Live runs against a stand-in client: command line, target, stream, landing zone, and the client of a server."""

import json
import os

import pytest
from pyspark.sql import functions as F

from groundmill.__main__ import main
from groundmill.config import Config
from groundmill.operators import completion
from groundmill.operators.chunks import chunk_documents
from groundmill.operators.judging import stats, stats_of
from groundmill.plans import dataset
from groundmill.sources import fetching, registry
from groundmill.streaming.drops import pairs_stream

from . import standin

SMALL = Config(min_chunk_chars=10, max_chunk_chars=300, chunk_overlap_chars=20, questions_per_chunk=1)


def chunks(spark, n=40):
    texts = [(i, "".join(f"Item {k}. Part {k}\n\nLamp number {i * 9 + k} burns for {i} days in town {k}. It is sold there.\n\n" for k in (1, 2, 3))) for i in range(n)]
    return dataset.with_meta(chunk_documents(spark.createDataFrame(texts, "doc_id long, text string"), SMALL), {"company": "Lamp Works"})


@pytest.fixture
def calls(tmp_path, monkeypatch):
    at = tmp_path / "calls"
    at.mkdir()
    monkeypatch.setenv(standin.CALLS, str(at))
    return lambda: len(os.listdir(at))


def test_command_line_asks_a_client(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.setenv("QA_CACHE_DIR", str(tmp_path / "cache"))
    monkeypatch.delenv("QA_API_URL", raising=False)
    (tmp_path / "r.htm").write_text("<body><p>Item 1. Business</p><p>" + "We sell lamps in many towns. " * 30 + "</p></body>")
    args = ["run", "--html", str(tmp_path / "r.htm"), "--company", "Lamp Works", "--fiscal-year", "2024", "--out", str(tmp_path / "out"), "--run-name", "t"]
    main([*args, "--client", "tests.standin:make"])
    assert "accepted 1, rejected 0" in capsys.readouterr().out
    assert spark.read.parquet(str(tmp_path / "out/t_dataset.parquet")).first()["source_passage"] == "We sell lamps in many towns."
    with pytest.raises(completion.CompletionError):
        main(args)  # neither a server, nor a client, nor captured runs


def test_a_run_stops_at_its_target(spark, tmp_path):
    from dataclasses import replace

    some = chunks(spark).persist()
    made = standin.Client
    run = dataset.run_to_target(some, made, str(tmp_path / "cache"), replace(SMALL, target_pairs=20), str(tmp_path / "judged"))
    found, asked = run.accepted.count(), spark.read.parquet(str(tmp_path / "cache/generation")).count()
    assert 20 <= found <= asked < some.count()
    whole = dataset.run_to_target(some, made, str(tmp_path / "cache"), replace(SMALL, target_pairs=10**6), str(tmp_path / "judged"))
    assert spark.read.parquet(str(tmp_path / "cache/generation")).count() == some.count() >= whole.accepted.count() > found
    some.unpersist()
    got, want = (f.first().asDict() for f in (stats_of(whole.decided, dataset.ORDER), stats(whole.accepted, whole.rejected)))
    assert got == want and got["n_accepted"] == whole.accepted.count()


def test_stream_answers_from_its_cache(spark, tmp_path):
    pages = [(i, "u", f"<body><p>Item 1. Part</p><p>Lamp {i} burns for long. It is bright.</p></body>") for i in range(6)]
    at = {k: str(tmp_path / k) for k in ("in", "out", "state", "state2", "cache")}
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(at["in"])
    pairs_stream(spark, at["in"], at["out"], at["state"], at["cache"], standin.Client, SMALL).awaitTermination()
    first = spark.read.parquet(at["cache"] + "/generation").count()
    assert spark.read.parquet(at["out"] + "/decided").where("accepted").count() == first == 6
    # another stream over the same drops and one more calls for the new page alone
    spark.createDataFrame([(9, "u", pages[0][2].replace("Lamp 0", "Lamp nine"))], "page_id long, url string, html string").write.mode("append").parquet(at["in"])
    pairs_stream(spark, at["in"], at["out"], at["state2"], at["cache"], standin.Client, SMALL).awaitTermination()
    assert spark.read.parquet(at["cache"] + "/generation").count() == 7


def test_landing_zone_fetches_once(spark, tmp_path):
    seen = tmp_path / "seen"
    seen.mkdir()

    def get(url):
        assert not (seen / url).exists()
        (seen / url).write_text("")
        return url.encode() * 3

    zone = str(tmp_path / "zone")
    for urls in (["a", "b", "a", None], ["b", "c"], []):
        got = registry.land(spark.createDataFrame([(u,) for u in urls], "url string"), zone, get, 0.0)
        assert {r["url"]: bytes(r["content"]) for r in got.collect()} == {u: u.encode() * 3 for u in urls if u}


def test_server_client_tries_again_and_reads_json():
    said = []

    def post(url, headers, body):
        said.append((url, headers, json.loads(body)))
        if len(said) == 1:
            raise OSError("busy")
        content = "no json" if len(said) == 2 else "[1]" if len(said) == 3 else '{"verdict": "PARTIAL"}'
        return json.dumps({"choices": [{"message": {"content": content}}]}).encode()

    client = completion.HttpClient("http://h/v1/", "s", 50, 0.1, wait=0.0, post=post)
    assert client.complete_json(model="m", system="a", user="b", schema={"type": "object"}, key="k") == {"verdict": "PARTIAL"}
    url, headers, body = said[-1]
    assert url == "http://h/v1/chat/completions" and headers["Authorization"] == "Bearer s" and body["max_tokens"] == 50 and len(said) == 4
    with pytest.raises(completion.CompletionError, match="k after 2 attempts"):
        completion.HttpClient("http://h", "", 1, 0, attempts=2, wait=0.0, post=lambda *a: b"{}").complete_json(model="m", system="a", user="b", schema={}, key="k")


def test_names_by_form(spark):
    text = "\n".join(f"Item {i}. Title {i}\n" + "Lamps burn for a long time. " * 3 for i in ("1", "2", "5"))
    t = spark.createDataFrame([(0, text)], "doc_id long, text string")
    names = lambda cfg: [r["section_name"] for r in chunk_documents(t, cfg).orderBy("chunk_ord").collect()]
    assert names(Config(min_chunk_chars=10, form="10-Q")) == ["Financial Statements", "Management's Discussion and Analysis (MD&A)"]
    assert names(Config(min_chunk_chars=10))[:2] == ["Business", "Properties"]
    assert names(Config(min_chunk_chars=10, form="20-F")) == ["Title 1", "Title 2", "Title 5"]


def test_running_sum_equals_a_loop(spark):
    import random

    from groundmill.operators.running import running_sum

    rng = random.Random(1)
    rows = [(rng.choice("aab"), rng.randrange(300), i, rng.randint(0, 3)) for i in range(2000)]
    t = spark.createDataFrame(rows, "g string, d long, i long, v long")
    for slices in (1, 7, 64):
        got = {r["i"]: r["s"] for r in running_sum(t, ["g"], ["d", "i"], "v", "s", slices).collect()}
        at, want = {}, {}
        for g, _, i, v in sorted(rows, key=lambda r: (r[1], r[2])):
            want[i] = at[g] = at.get(g, 0) + v
        assert got == want
    assert running_sum(t.where("false"), ["g"], ["d", "i"], "v", "s", 4).agg(F.count("*")).first()[0] == 0


# --- paced fetching as a data source ---------------------------------------------------------------------------
def asked_of_disk(url: str) -> bytes:
    """A stand-in that notes each request in a file beside the addresses; the word "down" in an address fails until a file says otherwise."""
    folder, _, name = url.removeprefix("disk:").rpartition("/")
    with open(f"{folder}/asked", "a") as f:
        f.write(f"{name}\n")
    if name.startswith("down") and not os.path.exists(f"{folder}/up"):
        raise OSError(f"{name} is down")
    return name.encode() * 3


def drop(spark, folder, number, names):
    spark.createDataFrame([(n if n is None else f"disk:{folder}/{n}",) for n in names], "url string").coalesce(1).write.parquet(f"{folder}/list/drop-{number:04}")


def asked(folder):
    path = folder / "asked"
    return sorted(path.read_text().split()) if path.exists() else []


def source(spark, folder, stream=False, **more):
    fetching.register(spark)
    return (spark.readStream if stream else spark.read).format("paced_fetch").options(addresses=str(folder / "list"), get="tests.test_live:asked_of_disk", rate="500", tasks="3", attempts="1", **more).load()


def test_fetched_table(spark, tmp_path):
    drop(spark, tmp_path, 1, ["a", "b", None, "c"])
    drop(spark, tmp_path, 2, ["d", "a"])
    rows = [(r["url"] and r["url"].rpartition("/")[2], r["content"] and bytes(r["content"])) for r in source(spark, tmp_path).collect()]
    assert sorted(rows, key=str) == sorted([(n, n and n.encode() * 3) for n in ("a", "b", None, "c", "d", "a")], key=str)
    assert asked(tmp_path) == ["a", "a", "b", "c", "d"]
    assert source(spark, tmp_path).rdd.getNumPartitions() == 3


def test_landing_spares_what_was_fetched(spark, tmp_path):
    drop(spark, tmp_path, 1, ["a", "b", "down1", "c"])
    landed = dict(landing=str(tmp_path / "landing"))
    with pytest.raises(Exception, match="down1"):
        source(spark, tmp_path, **landed).collect()
    before = asked(tmp_path)
    (tmp_path / "up").touch()
    assert source(spark, tmp_path, **landed).count() == 4
    after = asked(tmp_path)
    assert {n: after.count(n) for n in "abc"} == {"a": 1, "b": 1, "c": 1} and after.count("down1") == before.count("down1") + 1
    assert {bytes(r["content"]) for r in source(spark, tmp_path, **landed).collect()} == {b"aaa", b"bbb", b"ccc", b"down1" * 3} and asked(tmp_path) == after


def test_a_stream_resumes_without_a_second_fetch(spark, tmp_path):
    def run():
        q = source(spark, tmp_path, stream=True, landing=str(tmp_path / "landing")).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        q.awaitTermination(120)
        assert q.exception() is None

    drop(spark, tmp_path, 1, ["a", "b"])
    run()
    drop(spark, tmp_path, 2, ["c", "down2", "d"])
    with pytest.raises(Exception, match="down2"):
        run()
    (tmp_path / "up").touch()
    run()
    drop(spark, tmp_path, 3, ["e", "a"])
    run()
    run()
    got = sorted(r["url"].rpartition("/")[2] for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == ["a", "a", "b", "c", "d", "down2", "e"]
    assert all(asked(tmp_path).count(n) == 1 for n in "abcde")


def test_pace_is_shared_and_never_made_up_for():
    now, passed = [0.0], []

    def sleep(s):
        now[0] += s

    paces = [fetching.Pace(10, 4, i, lambda: now[0], sleep) for i in range(4)]
    for p in paces * 5:
        p.wait()
        passed.append(now[0])
    assert all(b - a >= 0.1 - 1e-9 for a, b in zip(passed, passed[1:])) and passed[-1] == pytest.approx(1.9)
    now[0] = 60.0
    late = fetching.Pace(10, 4, 0, lambda: now[0], sleep)
    late.wait()
    now[0] += 30
    late.wait()
    late.wait()
    assert now[0] == pytest.approx(90.4)


def test_ranges_cut_all_rows_once(spark, tmp_path):
    drop(spark, tmp_path, 1, [str(i) for i in range(7)])
    drop(spark, tmp_path, 2, [])
    drop(spark, tmp_path, 3, [str(i) for i in range(7, 20)])
    folder = str(tmp_path / "list")
    for tasks in (1, 3, 50):
        cut = fetching.ranges(folder, fetching.address_files(folder), tasks)
        each = [[u.rpartition("/")[2] for part in r.parts for u in fetching.rows_between(folder, *part)] for r in cut]
        assert [x for e in each for x in e] == [str(i) for i in range(20)] and max(map(len, each)) - min(map(len, each)) <= 1
    assert fetching.ranges(folder, [], 4) == [] and fetching.address_files(str(tmp_path / "none")) == []
    with pytest.raises(Exception, match="get"):
        fetching._Table({"addresses": folder})
