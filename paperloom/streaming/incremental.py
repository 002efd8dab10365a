"""Incremental runs: high-water marks over batches, and the same as a stream of files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paperloom.sources.store import Store


def above_mark(df: DataFrame, mark: int | None, id_col: str = "id") -> DataFrame:
    """Rows after the mark; ids must grow with arrival.  Changes of older rows are not seen."""
    return df if mark is None else df.filter(F.col(id_col) > mark)


def run_batch(store: Store, source: DataFrame, work: Callable[[DataFrame], DataFrame], target: str, state_key: str, id_col: str = "id", full: bool = False) -> int:
    """Works on the rows after the stored mark, upserts the result and advances the mark.  full: clears the target and starts over."""
    if full:
        store.clear(target)
    raw = None if full else store.get_state(state_key)
    mark = int(raw) if raw and raw.lstrip("-").isdigit() else None
    part = above_mark(source, mark, id_col)
    top = part.agg(F.max(id_col)).first()[0]
    if top is None:
        return 0
    # bounded above too: rows that arrive while this runs belong to the next run
    store.upsert(target, work(part.filter(F.col(id_col) <= top)))
    store.set_state(state_key, str(top))
    return int(top)


def run_stream(spark: SparkSession, folder: str, schema: StructType, work: Callable[[DataFrame], DataFrame], store: Store, target: str, checkpoint: str, key: str = "source_id") -> None:
    """All files that have arrived since the last run, through the same work and upsert; the checkpoint remembers them."""

    def each(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            store.upsert(target, work(batch), key)

    q = spark.readStream.schema(schema).parquet(folder).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def first_seen(stream: DataFrame, key: str, time: str, delay: str = "62 days") -> DataFrame:
    """Each key once, within the time that late rows may take: state older than the watermark is dropped."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def windowed_counts(stream: DataFrame, time: str, width: str, slide: str | None = None, delay: str = "1 hour", by: tuple[str, ...] = ()) -> DataFrame:
    """Rows per event-time window (tumbling, or sliding with ``slide``)."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, width, slide) if slide else F.window(time, width), *by).agg(F.count("*").alias("n"))


def counters(df: DataFrame, name: str, **tests):
    """The frame with counters observed while it runs, and the observation to read them from."""
    from pyspark.sql import Observation

    o = Observation(name)
    return df.observe(o, F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(k) for k, c in tests.items()]), o
