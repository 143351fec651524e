"""Registry of reporting companies: lookup of a ticker, the n-th latest report, its address, paced fetching."""

from __future__ import annotations

import json
import time
import urllib.request
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import exists

#: Addresses of the public registry.
TICKERS_URL = "https://www.sec.gov/files/company_tickers.json"
SUBMISSIONS_URL = "https://data.sec.gov/submissions/CIK{cik}.json"
ARCHIVE_URL = "https://www.sec.gov/Archives/edgar/data/{cik}/{accession}/{document}"


class NotFound(LookupError):
    pass


def resolve(tickers: DataFrame, wanted: DataFrame) -> DataFrame:
    """(ticker, cik) for ``wanted`` (ticker): keys match in upper case and trimmed; the first row of a ticker counts; numbers are padded to ten digits."""
    norm = lambda c: F.upper(F.trim(c))
    index = tickers.groupBy(F.upper("ticker").alias("_key")).agg(F.min_by("cik", "pos").alias("cik"))
    asked = wanted.select("ticker", norm(F.col("ticker")).alias("_key"))
    return asked.join(index, "_key").select("ticker", F.lpad(F.col("cik").cast("string"), 10, "0").alias("cik"))


def unresolved(tickers: DataFrame, wanted: DataFrame) -> DataFrame:
    return wanted.join(resolve(tickers, wanted), "ticker", "left_anti")


def resolve_one(tickers: DataFrame, ticker: str) -> str:
    found = resolve(tickers, tickers.sparkSession.createDataFrame([(ticker,)], "ticker string")).first()
    if found is None:
        raise NotFound(f"ticker {ticker!r} is not in the index")
    return found["cik"]


def nth_latest(history: DataFrame, form: str, skip: int = 0, by: str = "cik", pos: str = "pos") -> DataFrame:
    """The report number ``skip`` of exactly this form, for each company, in the order of the history."""
    return history.where(F.col("form") == form).withColumn("_n", F.row_number().over(Window.partitionBy(by).orderBy(pos))).where(F.col("_n") == skip + 1).drop("_n")


def explode_history(submissions: DataFrame) -> DataFrame:
    """Rows of a history that is kept as parallel arrays (form, accession, document, filed, period)."""
    zipped = F.arrays_zip("form", "accession", "document", "filed", "period")
    return submissions.select("cik", "company", F.posexplode(zipped).alias("pos", "r")).select("cik", "company", "pos", "r.*")


def archive_url(cik: Column, accession: Column, document: Column) -> Column:
    return F.concat(F.lit(ARCHIVE_URL.split("{")[0]), cik.cast("bigint").cast("string"), F.lit("/"), F.replace(accession, F.lit("-"), F.lit("")), F.lit("/"), document)


def http_get(url: str, user_agent: str, timeout: float = 60) -> bytes:
    with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": user_agent}), timeout=timeout) as r:
        return r.read()


def find_report(get: Callable[[str], bytes], ticker: str | None = None, cik: str | None = None, form: str = "10-K", skip: int = 0) -> dict:
    """One company's report: the number, given or looked up by ticker, then the ``skip``-th of this form in its history.

    Two small documents of the registry are read; for many companies use the tables' functions.
    """
    if not ticker and not cik:
        raise ValueError("a ticker or a company number is needed")
    if not cik:
        wanted = ticker.upper().strip()
        cik = next((str(r["cik_str"]) for r in json.loads(get(TICKERS_URL)).values() if r["ticker"].upper() == wanted), None)
        if cik is None:
            raise NotFound(f"ticker {ticker!r} is not in the index")
    cik = str(cik).zfill(10)
    history = json.loads(get(SUBMISSIONS_URL.format(cik=cik)))
    recent = history["filings"]["recent"]
    places = [i for i, f in enumerate(recent["form"]) if f == form]
    if skip >= len(places):
        raise NotFound(f"company {cik} has {len(places)} reports of form {form}; number {skip} was asked for")
    i = places[skip]
    accession, document = recent["accessionNumber"][i], recent["primaryDocument"][i]
    url = ARCHIVE_URL.format(cik=int(cik), accession=accession.replace("-", ""), document=document)
    return {"company": history.get("name", "Unknown"), "cik": cik, "form": form, "filed": recent["filingDate"][i], "period": recent["reportDate"][i], "accession": accession, "document": document, "url": url, "fiscal_year": recent["reportDate"][i][:4]}


def patient(get: Callable[[str], bytes], pause: float, attempts: int = 4) -> Callable[[str], bytes]:
    """``get`` after a pause, tried again after growing waits from 1 to 20 seconds; the last failure is raised."""

    def slow(url: str) -> bytes:
        for k in range(attempts):
            time.sleep(pause)
            try:
                return get(url)
            except Exception:
                if k + 1 == attempts:
                    raise
                time.sleep(min(20, 2**k))

    return slow


def fetch(addresses: DataFrame, get: Callable[[str], bytes], pause: float, tasks: int, attempts: int = 4) -> DataFrame:
    """(url, content) for addresses (url). At most ``tasks`` run at once, and each waits so long that all of them keep to one request per ``pause`` seconds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slow = patient(get, pause * tasks, attempts)
        for b in batches:
            for url in b.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([url]), pa.array([slow(url)], pa.binary())], ["url", "content"])

    return addresses.select("url").repartition(tasks).mapInArrow(run, "url string, content binary")


def land(addresses: DataFrame, path: str, get: Callable[[str], bytes], pause: float, tasks: int = 1, attempts: int = 4) -> DataFrame:
    """(url, content) of all ``addresses`` (url) from the landing zone at ``path``; only those that are not there yet are fetched and added.

    Content is kept byte for byte. An address that is asked for twice is fetched once.
    """
    spark = addresses.sparkSession
    kind = "url string, content binary"
    wanted = addresses.select("url").where("url IS NOT NULL").distinct()
    missing = wanted.join(spark.read.schema(kind).parquet(path).select("url"), "url", "left_anti") if exists(spark, path) else wanted
    fetch(missing, get, pause, tasks, attempts).write.mode("append").parquet(path)
    landed = spark.read.schema(kind).parquet(path)
    return landed.join(wanted, "url", "left_semi").dropDuplicates(["url"])
