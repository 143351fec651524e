"""State by key across batches: the best pair of each question key so far, and groups that are filled up to a target.

Both are ``transformWithState`` operators, so that what earlier batches saw is in the checkpoint: a stream that is stopped
and started again goes on with it. State is one small row a key, in RocksDB, with a time to live if one is given.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from groundmill.functions.text import question_key
from groundmill.operators.judging import accepted_rows

#: Parts of a key that meet before the key does, so that one of a third of all rows is thinned in as many tasks.
SALTS = 16
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SURE = ["verifier_confidence", "grounding_overlap"]


def _plain(v):
    return None if v is None or v is pd.NA or v != v else v.item() if hasattr(v, "item") else v


class Best(StatefulProcessor):
    """Passes a row on when it beats all rows of its key before, in this batch or earlier ones; of a batch only the best.

    Rows have the columns of ``sure``, of which more is better and null the least, then ``order``, of which less is
    better, and ``row``. ``revision`` counts the rows that were passed on for a key, from 1.
    """

    def __init__(self, state: StructType, order: list[str], ttl_ms: int | None, revision: bool) -> None:
        self.state, self.columns, self.order, self.ttl_ms, self.revision = state, [*SURE, *order], order, ttl_ms, revision

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.best = handle.getValueState("best", self.state, self.ttl_ms)

    def _rank(self, values: tuple) -> tuple:
        sure = [(v is None, -(v or 0.0)) for v in values[: len(SURE)]]
        return (*sure, *values[len(SURE) :])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = tuple(self.best.get()) if self.best.exists() else None
        best = held and self._rank(held[1:])
        found = None
        for part in rows:
            for values in part[[*self.columns, "row"]].itertuples(index=False, name=None):
                own = tuple(map(_plain, values[:-1]))
                if best is None or self._rank(own) < best:
                    best, found = self._rank(own), (own, values[-1])
        if found is not None:
            n = held[0] + 1 if held else 1
            self.best.update((n, *found[0]))
            out = dict(zip(self.columns, found[0])) | {"row": found[1]}
            names = list(key)
            yield pd.DataFrame([[names[0], *(out[c] for c in self.columns), out["row"], *([n] if self.revision else [])]], columns=["group", *self.columns, "row", *(["revision"] if self.revision else [])])


class UpTo(StatefulProcessor):
    """Passes rows of a group on until it has ``target``; of a batch that fills it, those that come first by ``order``."""

    def __init__(self, target: int, order: list[str], columns: list[str]) -> None:
        self.target, self.order, self.columns = target, order, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", StructType([StructField("n", LongType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self.count.get()[0] if self.count.exists() else 0
        room = self.target - held
        if room <= 0:
            return
        kept = pd.DataFrame(columns=[*self.order, "row"])
        for part in rows:
            kept = pd.concat([x for x in (kept, part[[*self.order, "row"]]) if len(x)] or [kept]).sort_values(self.order, kind="stable").head(room)
        if len(kept):
            self.count.update((held + len(kept),))
            yield pd.DataFrame({"row": kept["row"].astype(str)})


def _state_types(stream: DataFrame, order: list[str]) -> list[StructField]:
    return [*[StructField(c, DoubleType()) for c in SURE], *[StructField(c, stream.schema[c].dataType) for c in order]]


def best_by_question(accepted: DataFrame, order: list[str], ttl_ms: int | None = None) -> DataFrame:
    """The stream ``accepted`` with ``question_key`` and ``revision``: each pair that is the best of its key so far.

    Revision 1 is the first of a key, a later one replaces it; ``latest`` of all of them is what ``judging.dedupe`` gives
    for all rows at once, in whatever batches they came. A row that comes again changes nothing. ``ttl_ms``: a key that no
    better row came for in that time is forgotten, and then is new. ``order`` must be without nulls.
    """
    kind = accepted.schema
    fields = _state_types(accepted, order)
    state = StructType([StructField("revision", LongType()), *fields])
    passed = StructType([StructField("group", StringType()), *fields, StructField("row", StringType())])
    mode = "ProcessingTime" if ttl_ms else "None"
    rows = accepted.select(
        F.coalesce(F.concat(F.lit("="), question_key(F.col("question"))), F.lit("")).alias("group"), F.pmod(F.xxhash64(*order), F.lit(SALTS)).alias("salt"),
        *[F.col(c).cast("double").alias(c) for c in SURE], *order, F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("row"),
    )
    thinned = rows.groupBy("group", "salt").transformWithStateInPandas(Best(state, order, ttl_ms, False), passed, "Append", mode)
    best = thinned.groupBy("group").transformWithStateInPandas(Best(state, order, ttl_ms, True), StructType([*passed.fields, StructField("revision", LongType())]), "Append", mode)
    back = F.from_json("row", kind)
    own = F.when(F.col("group") != "", F.substring("group", 2, 1 << 30))  # no key is a key of its own, as in a table
    return best.select(back.alias("r"), own.alias("question_key"), "revision").select("r.*", "question_key", "revision")


def up_to(stream: DataFrame, by: str, target: int, order: list[str]) -> DataFrame:
    """Rows of ``stream`` until each value of ``by`` has ``target`` of them, over all batches and restarts; a null value is a group."""
    kind = stream.schema
    rows = stream.select(F.to_json(F.struct(F.col(by))).alias("group"), *order, F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("row"))
    out = rows.groupBy("group").transformWithStateInPandas(UpTo(target, order, stream.columns), StructType([StructField("row", StringType())]), "Append", "None")
    return out.select(F.from_json("row", kind).alias("r")).select("r.*")


def latest(revisions: DataFrame) -> DataFrame:
    """The last revision of each key of a table that ``best_by_question`` has written. Few rows share a key."""
    last = Window.partitionBy("question_key").orderBy(F.desc("revision"))
    return revisions.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n", "revision")


def _stateful(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)


def dedupe_stream(spark: SparkSession, source: str, schema: StructType, out: str, checkpoint: str, order: list[str], ttl_ms: int | None = None, files_per_batch: int = 100, every: str = "10 seconds") -> StreamingQuery:
    """Accepted pairs of decisions that drop as Parquet into ``source`` (such as ``pairs_stream`` leaves), as revisions in ``out``.

    The stream ends when what is there now is read. With a time to live its clock goes on without rows, so it runs until
    it is stopped, with a batch ``every`` so often.
    """
    _stateful(spark)
    drops = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", "true").parquet(source)
    kept = best_by_question(accepted_rows(drops), order, ttl_ms)
    writer = kept.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(processingTime=every) if ttl_ms else writer.trigger(availableNow=True)).start()


def target_stream(spark: SparkSession, source: str, schema: StructType, out: str, checkpoint: str, by: str, target: int, order: list[str], files_per_batch: int = 100) -> StreamingQuery:
    """``target`` accepted pairs, of different question keys, of each value of ``by``; later ones of a full group are left out."""
    _stateful(spark)
    drops = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", "true").parquet(source)
    new = best_by_question(accepted_rows(drops), order).where("revision = 1").drop("revision")
    return up_to(new, by, target, order).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
