"""Command line: one report, from a local file or the registry, with a live model or captured completions."""

from __future__ import annotations

import argparse
from dataclasses import replace
from functools import partial

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from groundmill.config import Config
from groundmill.operators.completion import client_factory
from groundmill.operators.judging import stats
from groundmill.operators.merge import merge_captures, merge_summary
from groundmill.plans.dataset import chunks_from_html, run_live, run_replay, run_to_target
from groundmill.sources.files import read_captures, read_raw_captures, read_reports
from groundmill.sources.registry import find_report, http_get, land, patient
from groundmill.sources.sinks import write_captures, write_outputs


def parse(args: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="groundmill", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="verified pairs from a report")
    run.add_argument("--html", help="the report's file; without it the registry is asked")
    run.add_argument("--cik")
    run.add_argument("--skip", type=int, default=0, help="0 is the latest report, 1 the one before")
    run.add_argument("--captures", help="folder of captured runs to replay; without it a model is asked")
    run.add_argument("--client", help="module:function that makes clients instead of the server that QA_API_URL names")
    run.add_argument("--form", default="10-K")
    for name in ("company", "ticker", "fiscal-year", "accession", "period"):
        run.add_argument(f"--{name}", default="")
    run.add_argument("--run-name")
    run.add_argument("--out")
    run.add_argument("--max-chunks", type=int)
    run.add_argument("--questions-per-chunk", type=int)
    run.add_argument("--target", type=int)
    merge = sub.add_parser("merge", help="join captured generations and verdicts")
    merge.add_argument("--raw", required=True)
    merge.add_argument("--out", required=True)
    return p.parse_args(args)


def main(args: list[str] | None = None) -> None:
    a = parse(args)
    spark = SparkSession.builder.appName("groundmill").getOrCreate()
    if a.command == "merge":
        merged = merge_captures(*read_raw_captures(spark, a.raw))
        write_captures(merged, a.out)
        print(merge_summary(merged).first().asDict())
        return
    given = {"run_name": a.run_name, "output_dir": a.out, "max_chunks": a.max_chunks, "questions_per_chunk": a.questions_per_chunk, "target_pairs": a.target, "form": a.form}
    cfg = Config.from_env(**{k: v for k, v in given.items() if v is not None})
    make_client = None if a.captures else client_factory(cfg, a.client)
    if a.html:
        meta = {"company": a.company or "Unknown", "ticker": a.ticker or None, "fiscal_year": a.fiscal_year or a.period[:4], "accession": a.accession, "form": a.form, "period": a.period}
        files = read_reports(spark, a.html).select(F.lit(0).cast("long").alias("doc_id"), "content")
    else:
        get = partial(http_get, user_agent=cfg.user_agent)
        found = find_report(patient(get, cfg.pause_seconds), a.ticker or None, a.cik, a.form, a.skip)
        meta = {k: found[k] for k in ("company", "fiscal_year", "accession", "form", "period")} | {"ticker": a.ticker or None}
        address = spark.createDataFrame([(found["url"],)], "url string")
        files = land(address, f"{cfg.data_dir}/raw", get, cfg.pause_seconds).select(F.lit(0).cast("long").alias("doc_id"), "content")
        if not a.run_name:
            cfg = replace(cfg, run_name=f"{a.ticker or a.cik}_{found['fiscal_year']}".lower())
    chunks = chunks_from_html(files, cfg, meta)
    if a.captures:
        result = run_replay(chunks, read_captures(spark, a.captures), cfg)
    else:
        live = run_live if a.target is None else run_to_target
        result = live(chunks, make_client, cfg.cache_dir, cfg, f"{cfg.cache_dir}/judged/{cfg.run_name}")
    record = stats(result.accepted, result.rejected).first()
    print(f"accepted {record['n_accepted']}, rejected {record['n_rejected']}, rate {record['acceptance_rate']}")
    print(f"by type {record['by_question_type']}, by difficulty {record['by_difficulty']}")
    paths = write_outputs(result.accepted, result.decided, cfg.output_dir, cfg.run_name, meta)
    for kind, path in paths.items():
        print(f"{kind}: {path}")


if __name__ == "__main__":
    main()
