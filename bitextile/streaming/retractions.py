"""The published lexicon kept by a stream of signed counts: editions that come, change or go only touch their own surfaces.

Between two states of the editions signed_counts() sums what each key gains and loses; keys that end where they began are
not in it. A stateful operator holds the lexemes of each surface, method and base text; a batch gives all rows of a touched
surface anew, with shares, and rows that went with a count of 0. Surfaces that no batch touches are never read again.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.joins import state_diff
from ..session import by_value

GROUP = ["surface", "method", "base_text"]
SIGNED = "surface string, method string, base_text string, lexeme string, count long, high long"
ROWS = SIGNED + ", share double, hi_conf double"
STORE = "spark.sql.streaming.stateStore.providerClass"


def signed_counts(old: DataFrame, new: DataFrame, edition: str = "edition") -> DataFrame:
    """What the counts of each key change by, from one state of the editions to another.

    old and new: edition, sha (of what it holds), and its rows surface, method, base_text, lexeme, count, high. Only
    editions that state_diff() has as added, updated or deleted are summed.
    """
    state = lambda df: df.select(edition, "sha").distinct()
    diff = state_diff(state(old), state(new), edition, "sha")
    changed = lambda df, kinds, sign: df.join(diff.where(F.col("change").isin(*kinds)).select(edition), edition, "left_semi").select(*GROUP, "lexeme", (sign * F.col("count")).alias("count"), (sign * F.col("high")).alias("high"))
    both = changed(new, ("add", "update"), 1).unionByName(changed(old, ("delete", "update"), -1))
    return both.groupBy(*GROUP, "lexeme").agg(F.sum("count").cast("long").alias("count"), F.sum("high").cast("long").alias("high")).where("count <> 0 OR high <> 0").select("surface", "method", "base_text", "lexeme", "count", "high")


class Shares(StatefulProcessor):
    """The lexemes of one surface with their counts; signed rows come in, all rows of the surface go out."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.lexemes = handle.getMapState("lexemes", "lexeme string", "count long, high long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        change: dict[str, list[int]] = {}
        for r in rows:
            own = change.setdefault(r["lexeme"], [0, 0])
            own[0] += r["count"]
            own[1] += r["high"]
        gone = []
        for lexeme, (count, high) in change.items():
            if (had := self.lexemes.getValue((lexeme,)) if self.lexemes.containsKey((lexeme,)) else None) is not None:
                count, high = count + had[0], high + had[1]
            if count < 0 or high < 0 or high > count:
                raise ValueError(f"more of {key} {lexeme} goes than there is")
            if count:
                self.lexemes.updateValue((lexeme,), (count, high))
            elif had is not None:
                self.lexemes.removeKey((lexeme,))
                gone.append(lexeme)
        have = [(k[0], v[0], v[1]) for k, v in self.lexemes.iterator()]
        total = sum(count for _, count, _ in have)
        for lexeme, count, high in have:
            yield Row(**dict(zip(GROUP, key, strict=True)), lexeme=lexeme, count=count, high=high, share=count / total, hi_conf=high / count)
        for lexeme in gone:
            yield Row(**dict(zip(GROUP, key, strict=True)), lexeme=lexeme, count=0, high=0, share=0.0, hi_conf=0.0)

    def close(self) -> None:
        pass


@contextmanager
def _store(spark: SparkSession):
    """A state store that the operator can use, for as long as its stream runs."""
    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.unset(STORE) if before is None else spark.conf.set(STORE, before)


def advance(spark: SparkSession, signed: str, top: str) -> None:
    """Apply the signed rows (Parquet files under `signed`) that no run before has; top: a folder that executors share.

    Each batch writes what it changed under its number, and writes the same again if it is run again.
    """

    def save(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number).cast("long")).write.mode("overwrite").parquet(f"{top}/out/n={number}")

    by_value(__name__)
    with _store(spark):
        stream = spark.readStream.schema(SIGNED).parquet(signed)
        rows = stream.groupBy(*GROUP).transformWithState(Shares(), ROWS, "Update", "None")
        q = rows.writeStream.outputMode("update").trigger(availableNow=True).option("checkpointLocation", f"{top}/state").queryName(f"q{uuid.uuid4().hex}").foreachBatch(save).start()
        try:
            q.awaitTermination()
        finally:
            q.stop()


def recomputed(spark: SparkSession, top: str) -> DataFrame:
    """How many rows each batch gave anew."""
    return spark.read.parquet(f"{top}/out").groupBy("batch").agg(F.count(F.lit(1)).alias("rows"))


def lexicon(spark: SparkSession, top: str) -> DataFrame:
    """The lexicon as the last batches left it."""
    rows = spark.read.parquet(f"{top}/out")
    last = rows.groupBy(*GROUP, "lexeme").agg(F.max_by(F.struct("count", "high", "share", "hi_conf"), "batch").alias("x"))
    return last.select(*GROUP, "lexeme", "x.*").where("count > 0")
