"""Live figures over a stream: running totals, top sums and newest rows.

State is kept in tables by epoch (:mod:`sluice.streaming.epochs`), so a restart goes on
where it stopped and a replayed epoch gives the same state. Late rows count like any
others; no watermark drops them.

* :class:`BlockedSums` keeps ``sum(value)`` per key. Keys are cut into blocks (days of a
  time bucket, hash ranges of a name). A batch rewrites only the blocks it touches; a
  small index (one row per block) says which epoch holds each block's rows, and the
  block's sum. A late row so rewrites its own block, and every later running total is
  corrected by the prefix over the index, without reading the blocks between.
* :class:`TopRows` keeps the first ``n`` rows of an order: the first ``n`` of the state
  and the batch together, which is exact because the choice is mergeable.

Defined cases: a NULL key is a key of its own (its block NULL, last in the running
order); NULL values add nothing; a key whose values are all NULL has the sum NULL; an
empty batch changes nothing.
"""
from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.functions.timefn import trunc_ntz
from sluice.streaming.epochs import EpochTable


class BlockedSums:
    """Exact ``sum(value)`` per key of all batches so far, in blocks of keys.

    ``block`` maps the key column to its block. ``best`` > 0 also keeps each block's
    ``best`` largest sums in the index, so a top list reads the index alone."""

    def __init__(self, spark: SparkSession, path: str, key: Column, value: Column, block: Callable[[Column], Column],
                 key_type: str, block_type: str, sum_type: str = "decimal(38,2)", best: int = 0):
        self.key, self.value, self.block, self.best, self.sum_type, self.block_type = key, value, block, best, sum_type, block_type
        path = path.rstrip("/")
        self.rows = EpochTable(spark, f"{path}/rows", f"block {block_type}, key {key_type}, amount {sum_type}")
        self.index = EpochTable(spark, f"{path}/index", f"block {block_type}, version long, total {sum_type}, "
                                                        f"best array<struct<amount: {sum_type}, key: {key_type}>>")

    def _held(self, index: DataFrame) -> DataFrame:
        """The key rows that an index stands for."""
        versions = [r.version for r in index.select("version").distinct().collect()]  # at most one per block
        if not versions:
            return self.rows.spark.createDataFrame([], self.rows.schema)
        parts = [self.rows.at(v).withColumn("__version", F.lit(v)) for v in versions]
        rows = parts[0]
        for p in parts[1:]:
            rows = rows.unionByName(p)
        i = index.select(F.col("block").alias("__block"), "version")
        same = F.col("block").eqNullSafe(F.col("__block")) & (F.col("__version") == F.col("version"))
        return rows.join(i, same, "left_semi").drop("__version")

    def update(self, batch: DataFrame, epoch: int) -> None:
        delta = (batch.groupBy(self.key.alias("key")).agg(F.sum(self.value).cast(self.sum_type).alias("amount"))
                 .select(self.block(F.col("key")).cast(self.block_type).alias("block"), "key", "amount").persist())
        try:
            before = self.index.before(epoch)
            merged, kept = delta, None
            if before is not None:
                touched = delta.select(F.col("block").alias("__block")).distinct()
                same = F.col("block").eqNullSafe(F.col("__block"))
                merged = (self._held(before.join(touched, same, "left_semi")).unionByName(delta)
                          .groupBy("block", "key").agg(F.sum("amount").cast(self.sum_type).alias("amount")))
                kept = before.join(touched, same, "left_anti")
            self.rows.write(epoch, merged.select("block", "key", "amount").repartition("block").sortWithinPartitions("block", "key"))
            new = self._index_rows(self.rows.at(epoch), epoch)
            self.index.write(epoch, (kept.unionByName(new) if kept is not None else new).coalesce(1))
        finally:
            delta.unpersist()
        held = set()
        done = self.index.epochs()
        newest = [e for e in done if e <= epoch][-2:]
        for e in newest:
            held |= {r.version for r in self.index.at(e).select("version").distinct().collect()}
        self.rows.trim(held, epoch)
        self.index.trim(set(newest), epoch)

    def _index_rows(self, rows: DataFrame, epoch: int) -> DataFrame:
        amount = F.sum("amount").cast(self.sum_type).alias("total")
        version = F.lit(epoch).cast("long").alias("version")
        if not self.best:
            return rows.groupBy("block").agg(amount).select("block", version, "total", F.lit(None).cast(self._best_type()).alias("best"))
        w = Window.partitionBy("block").orderBy(F.desc_nulls_last("amount"), F.asc_nulls_last("key"))
        ranked = rows.withColumn("__r", F.row_number().over(w))
        first = F.when(F.col("__r") <= self.best, F.struct("amount", "key"))  # at most ``best`` a block
        return (ranked.groupBy("block").agg(amount, F.collect_list(first).alias("best"))
                .select("block", version, "total", F.col("best").cast(self._best_type()).alias("best")))

    def _best_type(self) -> str:
        return self.index.schema.split(", best ", 1)[1]

    def sums(self) -> DataFrame:
        """block, key, amount of every key."""
        return self._held(self.index.last())

    def running(self, name: str = "cumulative") -> DataFrame:
        """key and ``name`` = ``SUM(amount) OVER (ORDER BY key)``, NULL key last; blocks must
        be monotone in the key. The prefix runs over the index (one row per block), the
        windows over single blocks."""
        index = self.index.last()
        w = Window.orderBy(F.col("block").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
        base = index.select(F.col("block").alias("__block"), F.sum("total").over(w).alias("__base"))
        within = F.sum("amount").over(Window.partitionBy("block").orderBy(F.asc_nulls_last("key"))
                                      .rangeBetween(Window.unboundedPreceding, Window.currentRow))
        rows = self._held(index).withColumn("__within", within)
        total = F.when(F.col("__base").isNull(), F.col("__within")).otherwise(F.coalesce("__within", F.lit(0)) + F.col("__base"))
        return rows.join(base, F.col("block").eqNullSafe(F.col("__block"))).select("key", total.alias(name))

    def top(self, n: int) -> DataFrame:
        """key, amount of the ``n`` largest sums (ties by key), from the index alone."""
        if n > self.best:
            raise ValueError(f"the index keeps {self.best} sums a block")
        one = self.index.last().select(F.explode("best").alias("b")).select("b.key", "b.amount")
        return one.orderBy(F.desc_nulls_last("amount"), F.asc_nulls_last("key")).limit(n)


class TopRows:
    """The first ``n`` rows of all batches so far in an order of all their columns."""

    def __init__(self, spark: SparkSession, path: str, schema: str, order: Sequence[Column], n: int):
        self.table, self.order, self.n = EpochTable(spark, path, schema), list(order), n
        self.names = spark.createDataFrame([], schema).columns

    def update(self, batch: DataFrame, epoch: int) -> None:
        before = self.table.before(epoch)
        first = batch.select(*self.names).orderBy(*self.order).limit(self.n)
        if before is not None:
            first = first.unionByName(before).orderBy(*self.order).limit(self.n)
        self.table.write(epoch, first)
        self.table.trim(set(self.table.epochs()[-2:]), epoch)

    def rows(self) -> DataFrame:
        return self.table.last()


def running_revenue(spark: SparkSession, path: str, ts: str = "registration_date", amount: str = "order_amount") -> BlockedSums:
    """Revenue per second in blocks of a day, for the cumulative series."""
    return BlockedSums(spark, path, trunc_ntz("second", F.col(ts)), F.col(amount), F.to_date, "timestamp_ntz", "date")


def revenue_by(spark: SparkSession, path: str, dim: str = "country", n: int = 10, amount: str = "order_amount",
               blocks: int = 64) -> BlockedSums:
    """Revenue per value of a dimension, with each hash block's ``n`` best."""
    return BlockedSums(spark, path, F.col(dim), F.col(amount), lambda c: F.pmod(F.xxhash64(c), F.lit(blocks)), "string", "long", best=n)


def newest_rows(spark: SparkSession, path: str, n: int = 20) -> TopRows:
    """The dashboard's newest rows; equal ids in the order of their other columns."""
    schema = "user_id bigint, first_name string, last_name string, email string, country string, order_amount decimal(10,2)"
    names = [c.split()[0] for c in schema.split(", ")]
    return TopRows(spark, path, schema, [F.desc_nulls_last("user_id"), *map(F.asc_nulls_first, names[1:])], n)


def start_live(stream: DataFrame, figures: Sequence[BlockedSums | TopRows | object], checkpoint: str, trigger: dict | None = None):
    """Keep several figures up to date from one stream; each batch is computed once."""
    def each(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()
        try:
            for f in figures:
                f.update(batch, epoch)
        finally:
            batch.unpersist()

    return (stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(each)
            .trigger(**(trigger or {"processingTime": "2 seconds"})).start())
