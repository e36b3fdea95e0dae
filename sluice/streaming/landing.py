"""Streaming landing with ``foreachBatch``.

Per micro-batch:

0. with ``evolve=True``, widen the spec by the new payload keys (one rule with
   ``evolve.evolved_columns``); a key that has a landed column keeps its type;
1. validate once (persisted for the two outputs, unpersisted after);
2. write the error rows first, each with its key, payload and every reason, so
   no rejected record is lost;
3. drop re-delivered records: keep the first copy per (topic, partition,
   offset) inside the batch, and leave out offsets that earlier batches landed.
   Those are kept as intervals (:mod:`sluice.streaming.intervals`), as many as the
   log has gaps, so no landed row is read again, however late a record comes;
4. append the good rows.

Each batch writes its own ``_epoch`` partition with dynamic overwrite, so a
batch replayed after a failure replaces its earlier attempt instead of adding
to it: together with the checkpointed source offsets this lands every record
exactly once. Old epochs can be compacted at any time
(:mod:`sluice.streaming.manifest`); a compacted epoch is settled, and its replay
writes nothing. With ``evolve=True`` new payload keys become new columns
(old rows read back as NULL via ``mergeSchema``).
"""
from __future__ import annotations

import dataclasses
import datetime as _dt
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.timefn import from_epoch_millis
from sluice.operators import dedup, landing, nested
from sluice.operators.evolve import SPARK_TYPE, evolved_columns
from sluice.operators.intervals import not_in, offset_intervals
from sluice.operators.spec import ColumnSpec, TableSpec
from sluice.session import checkpoint_path
from sluice.streaming.intervals import IntervalStore
from sluice.streaming.manifest import LandedTable

KEYS = ("topic", "partition", "offset")
KEEP = ("topic", "partition", "offset", "key", "push_time")


@dataclass
class LandingState:
    """Driver-side progress of a landing query (read by the monitor)."""
    batches: int = 0
    rows_in: int = 0
    rows_landed: int = 0
    rows_error: int = 0
    error_history: list[int] = field(default_factory=list)
    errors_by_epoch: dict[int, int] = field(default_factory=dict)
    abort: bool = False
    columns: list[str] = field(default_factory=list)


def _write_epoch(df: DataFrame, path: str, epoch: int) -> None:
    (df.withColumn("_epoch", F.lit(epoch).cast("long"))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("_epoch").parquet(path))


def evolved_spec(batch: DataFrame, spec: TableSpec, landed: DataFrame | None = None,
                 max_new_columns: int = 1000) -> TableSpec:
    """The spec widened by the new keys of this batch. A key that an earlier batch
    landed keeps its column's type, so a value that does not fit is an error row. A
    batch with more than ``max_new_columns`` new keys (ids used as keys) is refused."""
    if spec.nested:
        return _nested_spec(batch, spec, landed, max_new_columns)
    known = {f.name.lower(): f.dataType.simpleString() for f in landed.schema} if landed is not None else {}
    new = (evolved_columns(batch, spec).where("is_new").select("column_name", "data_type")
           .limit(max_new_columns + 1).collect())
    if len(new) > max_new_columns:
        raise ValueError(f"a batch for {spec.name} has over {max_new_columns} new payload keys")
    cols = [ColumnSpec(r.column_name, known.get(r.column_name, SPARK_TYPE.get(r.data_type, "string")))
            for r in sorted(new)]
    return TableSpec(spec.name, (*spec.columns, *cols), evolve=True)


def _nested_spec(batch: DataFrame, spec: TableSpec, landed: DataFrame | None, max_new_columns: int) -> TableSpec:
    """As above, with objects and arrays as structs and arrays. A landed column gets the
    new fields of its objects; the fields it has keep their types."""
    declared = {c.name.lower() for c in spec.columns}
    known = {f.name.lower(): f.dataType for f in landed.schema} if landed is not None else {}
    new = {k: t for k, t in nested.column_types(nested.path_summary(batch)).items() if k not in declared}
    if len(new) > max_new_columns:
        raise ValueError(f"a batch for {spec.name} has over {max_new_columns} new payload keys")
    cols = [ColumnSpec(k, nested.ddl(nested.widened(known.get(k, t), t))) for k, t in sorted(new.items())]
    return dataclasses.replace(spec, columns=(*spec.columns, *cols))


def _count_errors(state: LandingState, spark: SparkSession, errors: str, epoch: int, n: int) -> None:
    """Errors per epoch, taken from the error table by a new state (after a restart); a
    replayed epoch replaces its count. The monitor aborts when their total grew."""
    if not state.errors_by_epoch:
        before = LandedTable(spark, errors).read()
        if before is not None:
            state.errors_by_epoch = {r["_epoch"]: r["count"] for r in before.where(F.col("_epoch") < epoch)
                                     .groupBy("_epoch").count().collect()}
    grew = bool(state.batches or state.errors_by_epoch) and n > 0 and epoch not in state.errors_by_epoch
    state.errors_by_epoch[epoch] = n
    state.rows_error = sum(state.errors_by_epoch.values())
    state.error_history.append(state.rows_error)
    state.abort = state.abort or grew


def land_batch(batch: DataFrame, epoch: int, spec: TableSpec, target: str, errors: str,
               state: LandingState | None = None, text_fixes: dict | None = None,
               intervals: str | None = None) -> None:
    """``intervals``: folder of the sets of landed offsets (default: beside the target)."""
    spark = batch.sparkSession
    table = LandedTable(spark, target)
    if epoch <= table.manifest()["through"]:                 # settled and compacted
        return
    if spec.evolve:
        spec = evolved_spec(batch, spec, table.read())
    v = landing.validate(batch, spec, keep=KEEP, text_fixes=text_fixes).persist()
    try:
        good, bad = landing.split_errors(v, from_epoch_millis(F.col("push_time")), (*KEYS, "key", "value"))
        _write_epoch(bad, errors, epoch)                     # errors first
        good = dedup.keep_first(good.drop("value"), KEYS, order=("push_time",))
        store = IntervalStore(spark, intervals or target.rstrip("/") + "-intervals")
        seen = store.before(epoch)
        if seen is None:                                     # a table landed without sets
            prior = table.read()
            seen = offset_intervals(prior.where(F.col("_epoch") < epoch)) if prior is not None else None
        if seen is not None:
            good = not_in(good, seen)
        _write_epoch(good, target, epoch)
        landed = f"{target.rstrip('/')}/_epoch={epoch}"
        if table.files.exists(landed):
            store.write(epoch, spark.read.parquet(landed).select(*KEYS), seen)
        if state is not None:
            counts = v.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("is_valid")).alias("e")).first()
            _count_errors(state, spark, errors, epoch, counts.e)
            state.batches += 1
            state.rows_in += counts.n
            state.columns = spec.names
    finally:
        v.unpersist()


def start_landing(stream: DataFrame, spec: TableSpec, target: str, errors: str,
                  checkpoint: str | None = None, trigger: dict | None = None,
                  state: LandingState | None = None, text_fixes: dict | None = None,
                  query_name: str | None = None):
    """Start the landing query; returns (StreamingQuery, LandingState)."""
    spark = stream.sparkSession
    state = state or LandingState()
    checkpoint = checkpoint or checkpoint_path(spark, "landing", spec.name)
    w = (stream.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda df, epoch: land_batch(df, epoch, spec, target, errors, state, text_fixes)))
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(**(trigger or {"processingTime": "2 seconds"}))
    return w.start(), state


def fresh_checkpoint(spark: SparkSession, name: str) -> str:
    """Restart a channel from scratch: a new checkpoint folder (new run id)."""
    stamp = _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S")
    return checkpoint_path(spark, "landing", f"{name}-{stamp}-{uuid.uuid4().hex[:8]}")


def read_landed(spark: SparkSession, target: str) -> DataFrame:
    df = LandedTable(spark, target).read()
    if df is None:
        raise FileNotFoundError(f"nothing landed at {target} yet")
    return df.drop("_epoch")


def append_table(df: DataFrame, table: str) -> None:
    """Append to a catalog table, creating it on the first write (never
    replacing an existing one)."""
    df.write.mode("append").saveAsTable(table)


def append_existing_table(df: DataFrame, table: str) -> None:
    """Iceberg-style target: the table must exist and its schema is not
    evolved (``writeTo(...).append()``)."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        raise ValueError(f"target table {table} must exist (no auto-create for this format)")
    cols = spark.table(table).columns
    if set(df.columns) - set(cols):
        raise ValueError(f"columns {sorted(set(df.columns) - set(cols))} are not in {table}")
    df.select(*cols).writeTo(table).append()
