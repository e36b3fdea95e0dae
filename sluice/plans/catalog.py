"""The query catalog: one named plan per operator of the blueprint.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
test tables (or views Spark derives from them). Output columns are named so
they match :mod:`sluice.plans.oracle`.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.timefn import from_epoch_millis, lit_ntz
from sluice.operators import dashboard as dash
from sluice.operators import dedup, delivery, evolve, forecast, intervals, landing, monitor, nested, rollups, shaping
from sluice.operators.semantic import users_view
from sluice.operators.spec import TableSpec
from sluice.sources import fixtures as fx
from sluice.streaming import live
from sluice.tables import read_table

# Fixed values shared with the oracle SQL.
AS_OF = "2024-02-01 00:00:00"
AS_OF_DATE = "2024-02-01"
WAIT_START = "2024-01-10 00:00:00"
WAIT_TIMEOUT_HOURS = 2
TOPIC_MAP = "signup_events:SIGNUPS,purchase_events:ORDERS,view_events:ORDERS,c.*_events:CLICKSTREAM"
CRITICAL_DROP_RATE = 0.2
ERROR_CAP = 5

USERS = TableSpec.from_tuples("users", fx.USERS_DECLARED)
ENVELOPE = TableSpec.from_tuples("envelopes", [
    ("meta", "struct<offset:bigint,tags:array<string>,pushes:array<struct<ms:bigint>>>", None),
    ("body", "struct<props:struct<k:bigint>,date_of_birth:string>", None)])
FIXES = {"address": landing.newline_to_comma}
META = ("topic", "partition", "offset")

ORDERS_PIPE = [
    shaping.PipeField("$.USER_ID", "bigint", "order_id"),
    shaping.PipeField("$['First_Name']", "string", "customer_name"),
    shaping.PipeField("$.order_amount", "decimal(10,2)", "order_total"),
    shaping.PipeField("meta:topic", "string", "source_topic"),
    shaping.PipeField("meta:offset", "bigint", "kafka_offset"),
]

Query = Callable[[SparkSession, str], DataFrame]


# -- shared inputs ---------------------------------------------------------

def users(spark, sf) -> DataFrame:
    """The landed users table: log records matched to the declared columns."""
    return landing.land_by_name(fx.log_records(spark, sf), USERS, as_of=AS_OF, text_fixes=FIXES)


def validated_bad(spark, sf) -> DataFrame:
    return landing.validate(fx.log_records_bad(spark, sf), USERS,
                            keep=(*META, "key", "push_time"), text_fixes=FIXES)


def _users_out(df: DataFrame) -> DataFrame:
    return df.withColumn("order_amount", F.col("order_amount").cast("double"))


# -- queries -------------------------------------------------------------------

def q_land_by_name(spark, sf):
    return _users_out(users(spark, sf))


def q_sample_rows(spark, sf):
    return _users_out(dash.sample_rows(users(spark, sf), "user_id", 10))


def q_channel_assignment(spark, sf):
    lr = fx.log_records(spark, sf)
    return (lr.groupBy("topic", "partition")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.min("offset").alias("first_offset"),
                 F.max("offset").alias("last_offset"))
            .withColumn("channel", shaping.channel_name(F.upper("topic"), F.col("partition"))))


def q_committed_offsets(spark, sf):
    return delivery.committed_offsets(fx.log_records(spark, sf))


def q_advanced_commits(spark, sf):
    return delivery.advanced_commits(fx.channel_status(spark, sf))


def q_resume_from_committed(spark, sf):
    return delivery.resume_points(fx.log_records(spark, sf), fx.progress(spark, sf))


def q_commit_wait(spark, sf):
    return delivery.commit_wait(fx.channel_status(spark, sf), lit_ntz(WAIT_START), WAIT_TIMEOUT_HOURS)


def q_route_topics(spark, sf):
    lr = fx.log_records(spark, sf)
    return (lr.groupBy("topic", shaping.route_topics(F.col("topic"), TOPIC_MAP).alias("target_table"))
            .agg(F.count(F.lit(1)).alias("n_records")))


def q_error_cap(spark, sf):
    return delivery.error_cap(validated_bad(spark, sf), ERROR_CAP)


def q_parse_or_raw(spark, sf):
    return landing.parse_or_raw(fx.log_records_bad(spark, sf))


def q_pipe_transform(spark, sf):
    out = shaping.pipe_transform(fx.log_records(spark, sf), ORDERS_PIPE, where="order_total > 100")
    return out.withColumn("order_total", F.col("order_total").cast("double"))


def q_json_paths(spark, sf):
    lr = fx.log_records(spark, sf).withColumn("__v", F.try_parse_json("value"))
    return lr.select(*META,
                     F.try_variant_get("__v", "$.props.k", "int").alias("props_k"),
                     F.try_variant_get("__v", "$['Email']", "string").alias("email"),
                     F.try_variant_get("__v", "$.country", "string").alias("country"))


def q_mask_columns(spark, sf):
    u = users(spark, sf).select("user_id", "email", "phone_number", "first_name")
    return shaping.mask_columns(u, {"email": "email_domain", "phone_number": "last4",
                                    "first_name": "hash"})


def q_record_metadata(spark, sf):
    m = shaping.with_record_metadata(fx.log_records(spark, sf))
    return m.select(*[F.col(f"record_metadata.{f}").alias(a) for f, a in (
        ("topic", "meta_topic"), ("partition", "meta_partition"), ("offset", "meta_offset"),
        ("CreateTime", "meta_create_time"), ("ConnectorPushTime", "meta_push_time"),
        ("key", "meta_key"))])


def q_record_content(spark, sf):
    out = shaping.two_variant_layout(fx.log_records(spark, sf))
    return out.select(F.to_json("record_content").alias("record_content"),
                      F.col("record_metadata.topic").alias("meta_topic"),
                      F.col("record_metadata.offset").alias("meta_offset"))


def q_sanitize_table_names(spark, sf):
    e = read_table(spark, sf, "events")
    raw = F.concat(F.col("event_type"), F.lit("-prod.v"), (F.col("user_id") % 3).cast("string"))
    return (e.groupBy(raw.alias("raw_topic")).agg(F.count(F.lit(1)).alias("n_records"))
            .withColumn("table_name", shaping.sanitize_table_name(F.col("raw_topic"))))


def q_age_groups(spark, sf):
    v = users_view()
    return users(spark, sf).select("user_id", "date_of_birth",
                                   v.dimension("age", AS_OF_DATE).alias("age"),
                                   v.dimension("age bracket", AS_OF_DATE).alias("age_group"))


def q_semantic_filtered(spark, sf):
    return users_view().query(users(spark, sf), ["town"], ["user count", "revenue"],
                              filters={"province": "S7"}, as_of=AS_OF_DATE)


def q_validate_types(spark, sf):
    return landing.type_errors(validated_bad(spark, sf), META)


def q_validate_lengths(spark, sf):
    return landing.length_errors(validated_bad(spark, sf), USERS, META)


def _error_table(spark, sf):
    _, bad = landing.split_errors(validated_bad(spark, sf), from_epoch_millis(F.col("push_time")), META)
    return bad


def q_error_table(spark, sf):
    return _error_table(spark, sf)


def q_recent_errors(spark, sf):
    return _error_table(spark, sf).orderBy(F.desc("error_timestamp"), *META).limit(20)


def q_dead_letters(spark, sf):
    return landing.dead_letters(validated_bad(spark, sf), (*META, "key"))


def q_evolve_schema(spark, sf):
    return evolve.evolved_columns(fx.log_records_bad(spark, sf), USERS)


def q_infer_types(spark, sf):
    return evolve.infer_key_types(fx.log_records_bad(spark, sf))


def q_infer_paths(spark, sf):
    """Types by path, in the records as envelopes (the payload inside)."""
    return nested.infer_paths(fx.log_envelopes(spark, sf))


def q_land_nested(spark, sf):
    """Envelopes landed into a struct and an array column, one row per record."""
    d = landing.land_by_name(fx.log_envelopes(spark, sf), ENVELOPE)
    return d.select(F.col("meta.offset").alias("meta_offset"), F.element_at("meta.tags", 1).alias("first_tag"),
                    F.col("meta.pushes")[0]["ms"].alias("push_ms"), F.col("body.props.k").alias("props_k"),
                    F.col("body.date_of_birth").alias("date_of_birth"))


def q_unknown_fields(spark, sf):
    return landing.unknown_field_counts(fx.log_records_bad(spark, sf), USERS)


def q_null_profile(spark, sf):
    landed = landing.land_by_name(fx.log_records_bad(spark, sf), USERS, text_fixes=FIXES)
    return landing.null_profile(landed, USERS.names)


def q_malformed_classes(spark, sf):
    return landing.malformed_classes(fx.log_records_bad(spark, sf))


DUP_COLS = ("topic", "partition", "offset", "key", "value", "timestamp", "push_time")


def _dups(spark, sf):
    return fx.log_records_dup(spark, sf).select(*DUP_COLS)


def q_dedup_keep_first(spark, sf):
    return dedup.keep_first(_dups(spark, sf))


def q_drop_duplicated_keys(spark, sf):
    return dedup.drop_duplicated_keys(_dups(spark, sf))


def q_duplicate_groups(spark, sf):
    return dedup.duplicate_groups(_dups(spark, sf))


def q_distinct_copy(spark, sf):
    return dedup.distinct_copy(_dups(spark, sf))


def q_row_count(spark, sf):
    return dash.row_count(users(spark, sf))


def q_dashboard_totals(spark, sf):
    return dash.totals(users(spark, sf))


def q_dashboard_latest(spark, sf):
    return dash.latest(users(spark, sf))


def q_top_countries(spark, sf):
    return dash.top_by_revenue(users(spark, sf), "country", n=10)


def q_run_summary(spark, sf):
    return dash.run_summary(users(spark, sf))


def q_recent_records(spark, sf):
    return dash.recent_records(users(spark, sf), 20)


def q_cumulative_revenue(spark, sf):
    return dash.cumulative_revenue(users(spark, sf))


def q_semantic_totals(spark, sf):
    return users_view().query(users(spark, sf), [], [
        "total_users", "total_revenue", "avg_order_value", "max_order", "min_order",
        "unique_countries", "unique_cities", "unique_states"], as_of=AS_OF_DATE)


def q_semantic_by_country(spark, sf):
    return users_view().query(users(spark, sf), ["users.country"], ["users.total_revenue", "users.total_users"],
                              order_by=[F.desc("total_revenue"), F.asc("country")], limit=5,
                              as_of=AS_OF_DATE)


def q_semantic_by_age_group(spark, sf):
    return users_view().query(users(spark, sf), ["age_group"], ["total_users", "avg_order_value"],
                              order_by=[F.desc("avg_order_value"), F.asc("age_group")], as_of=AS_OF_DATE)


def q_semantic_by_hour(spark, sf):
    return users_view().query(users(spark, sf), ["registration_hour"], ["total_users", "total_revenue"],
                              order_by=["registration_hour"], as_of=AS_OF_DATE)


def q_channel_status(spark, sf):
    vb = validated_bad(spark, sf)
    return monitor.status_rollup(vb, shaping.channel_name(F.upper("topic"), F.col("partition")))


def q_tower_daily(spark, sf):
    d = fx.tower_daily(spark, sf)
    return d.select("tower", "day", "call_volume", "dropped_calls",
                    F.round("drop_rate", 6).alias("drop_rate"),
                    F.round("data_usage_mb", 4).alias("data_usage_mb"))


def q_latency_profile(spark, sf):
    return monitor.latency_profile(fx.channel_status(spark, sf))


def q_rollup_users_daily(spark, sf):
    """Rows and distinct countries per day, merged from the hours' sketches (exact for
    so few values)."""
    hours = rollups.hourly(users(spark, sf), F.col("registration_date"), {"countries": F.col("country")})
    return rollups.figures(rollups.merged(hours, [F.to_date("hour").alias("day")]))


def q_rollup_latency_daily(spark, sf):
    """Percentiles of the raw records' push latency per topic and day, merged from the
    hours' sketches (no SQL: estimates with a bounded rank error)."""
    records = fx.log_records(spark, sf)
    sent = from_epoch_millis(F.col("push_time"))
    hours = rollups.hourly(records, sent, measured={"latency_ms": F.timestamp_diff("MILLISECOND", F.col("timestamp"), sent)}, by=["topic"])
    return rollups.figures(rollups.merged(hours, ["topic", F.to_date("hour").alias("day")]), (0.5, 0.95, 0.99))


def q_error_growth(spark, sf):
    return monitor.error_growth(fx.channel_status(spark, sf))


def q_offset_lag(spark, sf):
    return monitor.offset_lag(fx.channel_status(spark, sf))


def q_metric_growth(spark, sf):
    return monitor.metric_growth(fx.channel_status(spark, sf))


def q_abort_point(spark, sf):
    return monitor.abort_point(fx.channel_status(spark, sf))


def q_ingestion_lag(spark, sf):
    return monitor.ingestion_lag(fx.channel_status(spark, sf))


def q_unhealthy_channels(spark, sf):
    return monitor.unhealthy_channels(fx.channel_status(spark, sf))


def q_slowest_rows(spark, sf):
    return monitor.slowest(fx.log_records(spark, sf), AS_OF, 10)


def q_throughput(spark, sf):
    return monitor.throughput(fx.log_records(spark, sf))


def q_assigned_partitions(spark, sf):
    return monitor.assigned_partitions(fx.channel_status(spark, sf))


def q_client_leaks(spark, sf):
    return monitor.client_leaks(fx.channel_status(spark, sf))


def q_tower_forecast(spark, sf):
    return forecast.forecast(fx.tower_daily(spark, sf), 7)


def q_critical_towers(spark, sf):
    return forecast.critical(forecast.forecast(fx.tower_daily(spark, sf), 7), CRITICAL_DROP_RATE)


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}


# -- streaming forms ---------------------------------------------------------------

def _stage_input(spark, df: DataFrame, name: str) -> str:
    """Write a derived input under the shared checkpoint folder so a file
    stream can read it (each call gets a fresh folder)."""
    import uuid

    from sluice.session import checkpoint_path
    path = checkpoint_path(spark, "inputs", f"{name}-{uuid.uuid4().hex[:10]}")
    df.write.parquet(path)
    return path


#: Records of the log for which each group of log partitions gets one more file.
STAGED_RECORDS = 1 << 20


def _by_log_partition(spark, sf, df: DataFrame, groups: int = 6) -> DataFrame:
    """The records of each group of log partitions in files of their own, as many as the
    log's length asks for, cut by offset; all copies of a record are in one file."""
    n = max(1, -(-read_table(spark, sf, "events").count() // STAGED_RECORDS))
    group = F.pmod(F.hash("topic", "partition"), F.lit(groups))
    part = F.pmod(F.xxhash64("offset"), F.lit(n)).cast("int")
    return df.repartitionById(groups * n, group * n + part)


def _files_per_trigger(spark, path: str, batches: int = 4) -> int:
    """Files per micro-batch so a staged input replays in about ``batches``
    micro-batches whatever the number of files the write produced."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    n = sum(1 for st in fs.listStatus(p) if st.getPath().getName().endswith(".parquet"))
    return max(1, -(-n // batches))


def q_stream_land(spark, sf):
    """Log records landed by the streaming job (availableNow): the same rows
    as the batch split, each exactly once."""
    import uuid

    from sluice.session import checkpoint_path
    from sluice.sources.log_source import file_stream
    from sluice.streaming import landing as sl
    src = _stage_input(spark, fx.log_records_bad(spark, sf), "log_records_bad")
    run = checkpoint_path(spark, "stream_land", uuid.uuid4().hex[:10])
    q, _ = sl.start_landing(file_stream(spark, src, max_files_per_trigger=_files_per_trigger(spark, src)),
                            USERS, run + "/landed",
                            run + "/errors", checkpoint=run + "/ckpt", trigger={"availableNow": True},
                            text_fixes=FIXES)
    q.awaitTermination()
    return _users_out(sl.read_landed(spark, run + "/landed")
                      .select(*META, *USERS.names))


def q_stream_dedup(spark, sf):
    """Streaming de-dup of re-delivered records over several micro-batches, one
    group of log partitions after the other, so most arrive late."""
    import uuid

    from sluice.session import checkpoint_path
    from sluice.sources.log_source import file_stream
    from sluice.streaming.ops import dedup_exact
    src = _stage_input(spark, _by_log_partition(spark, sf, fx.log_records_dup(spark, sf)), "log_records_dup")
    run = checkpoint_path(spark, "stream_dedup", uuid.uuid4().hex[:10])
    out = dedup_exact(file_stream(spark, src, max_files_per_trigger=_files_per_trigger(spark, src)))
    q = (out.writeStream.format("parquet").option("checkpointLocation", run + "/ckpt")
         .option("path", run + "/out").outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(run + "/out").select("topic", "partition", "offset", "key", "value", "timestamp")


def _gapped(spark, sf) -> DataFrame:
    """The log with re-deliveries and without some records that were lost."""
    lost = ((F.col("partition") == 1) & (F.col("offset") % 40 == 17)) | ((F.col("partition") == 2) & (F.col("offset") % 500 == 100))
    return fx.log_records_dup(spark, sf).where(~lost)


def q_offset_intervals(spark, sf):
    return intervals.offset_intervals(_gapped(spark, sf))


def q_contiguous_commits(spark, sf):
    return intervals.contiguous_commits(intervals.offset_intervals(_gapped(spark, sf)))


def q_contiguous_from_progress(spark, sf):
    return intervals.contiguous_commits(intervals.offset_intervals(_gapped(spark, sf)), fx.progress(spark, sf))


def q_stream_dedup_intervals(spark, sf):
    """The same de-dup as ``stream_dedup`` with interval sets as its state."""
    import uuid

    from sluice.session import checkpoint_path
    from sluice.sources.log_source import file_stream
    from sluice.streaming.intervals import start_dedup
    src = _stage_input(spark, _by_log_partition(spark, sf, fx.log_records_dup(spark, sf)), "log_records_dup")
    run = checkpoint_path(spark, "stream_dedup_intervals", uuid.uuid4().hex[:10])
    start_dedup(file_stream(spark, src, max_files_per_trigger=_files_per_trigger(spark, src)),
                run + "/out", run + "/ckpt", {"availableNow": True}).awaitTermination()
    return spark.read.parquet(run + "/out").select("topic", "partition", "offset", "key", "value", "timestamp")


def q_stream_land_compacted(spark, sf):
    """The landed rows after every settled epoch was merged into parts and the merged
    folders were removed."""
    import uuid

    from sluice.session import checkpoint_path
    from sluice.sources.log_source import file_stream
    from sluice.streaming import landing as sl
    from sluice.streaming.manifest import LandedTable
    src = _stage_input(spark, fx.log_records_bad(spark, sf), "log_records_bad")
    run = checkpoint_path(spark, "stream_land_compacted", uuid.uuid4().hex[:10])
    q, _ = sl.start_landing(file_stream(spark, src, max_files_per_trigger=_files_per_trigger(spark, src)),
                            USERS, run + "/landed", run + "/errors", checkpoint=run + "/ckpt",
                            trigger={"availableNow": True}, text_fixes=FIXES)
    q.awaitTermination()
    table = LandedTable(spark, run + "/landed")
    table.compact(fan=2)
    table.vacuum(keep=1)
    return _users_out(sl.read_landed(spark, run + "/landed").select(*META, *USERS.names))


def _live(spark, sf, name, figure):
    """Run one live figure over the landed stream, in several micro-batches."""
    import uuid

    from sluice.session import checkpoint_path
    from sluice.sources.log_source import file_stream
    from sluice.streaming.live import start_live
    src = _stage_input(spark, fx.log_records(spark, sf), "log_records")
    landed = landing.land_by_name(file_stream(spark, src, max_files_per_trigger=_files_per_trigger(spark, src)),
                                  USERS, as_of=AS_OF, text_fixes=FIXES)
    run = checkpoint_path(spark, name, uuid.uuid4().hex[:10])
    state = figure(run + "/state")
    start_live(landed, [state], run + "/ckpt", {"availableNow": True}).awaitTermination()
    return state


def q_stream_cumulative_revenue(spark, sf):
    """The dashboard's running total, kept by a stream (late rows correct later totals)."""
    state = _live(spark, sf, "stream_cumulative_revenue", lambda path: live.running_revenue(spark, path))
    return state.running("cumulative_revenue").select(
        F.col("key").alias("time_bucket"), F.col("cumulative_revenue").cast("double").alias("cumulative_revenue"))


def q_stream_top_countries(spark, sf):
    """Top countries by revenue from a stream's bounded candidates."""
    state = _live(spark, sf, "stream_top_countries", lambda path: live.revenue_by(spark, path, "country", 10))
    return state.top(10).select(F.col("key").alias("country"), F.col("amount").cast("double").alias("revenue"))


def q_stream_recent_records(spark, sf):
    """The newest 20 rows kept by a stream."""
    state = _live(spark, sf, "stream_recent_records", lambda path: live.newest_rows(spark, path, 20))
    return state.rows().withColumn("order_amount", F.col("order_amount").cast("double"))


QUERIES["rollup_users_daily"] = q_rollup_users_daily
QUERIES["rollup_latency_daily"] = q_rollup_latency_daily
QUERIES["stream_land"] = q_stream_land
QUERIES["stream_land_compacted"] = q_stream_land_compacted
QUERIES["stream_cumulative_revenue"] = q_stream_cumulative_revenue
QUERIES["stream_top_countries"] = q_stream_top_countries
QUERIES["stream_recent_records"] = q_stream_recent_records
QUERIES["stream_dedup"] = q_stream_dedup
QUERIES["offset_intervals"] = q_offset_intervals
QUERIES["contiguous_commits"] = q_contiguous_commits
QUERIES["contiguous_from_progress"] = q_contiguous_from_progress
QUERIES["stream_dedup_intervals"] = q_stream_dedup_intervals


def q_semantic_headline(spark, sf):
    """The first showcase query: total users, revenue and average order."""
    return users_view().query(users(spark, sf), [], ["users.total_users", "users.total_revenue",
                                                     "users.avg_order_value"], as_of=AS_OF_DATE)


def q_stream_dashboard(spark, sf):
    """Dashboard figures maintained by a streaming aggregation over the
    landed stream (complete mode, memory sink)."""
    import uuid

    from sluice.session import checkpoint_path
    from sluice.sources.log_source import file_stream
    from sluice.streaming.dashboard import start_live_dashboard
    src = _stage_input(spark, fx.log_records(spark, sf), "log_records")
    landed = landing.land_by_name(file_stream(spark, src, max_files_per_trigger=_files_per_trigger(spark, src)),
                                  USERS,
                                  as_of=AS_OF, text_fixes=FIXES)
    name = f"live_dashboard_{uuid.uuid4().hex[:8]}"
    q = start_live_dashboard(landed, name, checkpoint_path(spark, "dashboard", name),
                             trigger={"availableNow": True})
    q.awaitTermination()
    return spark.table(name)


QUERIES["semantic_headline"] = q_semantic_headline
QUERIES["stream_dashboard"] = q_stream_dashboard


COUNTER = TableSpec.from_tuples("counter", fx.COUNTER_DECLARED)


def q_counter_landing(spark, sf):
    """The row producers' example: rows landed with their offset token, the
    row time normalised from the three client forms."""
    landed = landing.land_by_name(fx.counter_records(spark, sf), COUNTER, keep=("offset",))
    return landed.select("c1", "c2", "ts", F.col("offset").cast("string").alias("offset_token"))


def q_counter_status(spark, sf):
    """Channel status at the end of the example run: latest committed token,
    rows inserted, rows in error."""
    v = landing.validate(fx.counter_records(spark, sf), COUNTER, keep=META)
    return monitor.status_rollup(v, shaping.channel_name(F.lit("COUNTER_CHANNEL"), F.col("partition")))


QUERIES["counter_landing"] = q_counter_landing
QUERIES["counter_status"] = q_counter_status


CDR = TableSpec.from_tuples("call_detail_records", fx.CDR_DECLARED)


def cdrs(spark, sf) -> DataFrame:
    return landing.land_by_name(fx.cdr_records(spark, sf), CDR)


def q_cdr_landing(spark, sf):
    """Call detail records landed by name, with text times parsed."""
    return cdrs(spark, sf).withColumn("charge_amount", F.col("charge_amount").cast("double"))


def _cdr_daily(spark, sf):
    c = cdrs(spark, sf)
    return (c.groupBy(F.col("cell_tower_id").alias("tower"), F.to_date("call_start").alias("day"))
            .agg(F.count(F.lit(1)).alias("call_volume"),
                 F.count_if(F.col("disposition") == "DROPPED").alias("dropped_calls"),
                 F.sum("data_usage_mb").alias("data_usage_mb"))
            .withColumn("drop_rate", F.col("dropped_calls") / F.col("call_volume")))


def q_cdr_tower_daily(spark, sf):
    """Per-tower daily features from the landed records: the forecast's inputs."""
    return _cdr_daily(spark, sf).select("tower", "day", "call_volume", "dropped_calls",
                                        F.round("drop_rate", 6).alias("drop_rate"),
                                        F.round("data_usage_mb", 4).alias("data_usage_mb"))


def q_cdr_tower_forecast(spark, sf):
    return forecast.forecast(_cdr_daily(spark, sf), 7)


def q_cdr_semantic_by_tower(spark, sf):
    from sluice.operators.semantic import cdr_view
    return cdr_view().query(cdrs(spark, sf), ["tower"], ["call volume", "call drop rate", "data usage"],
                            order_by=[F.desc("drop_rate"), "cell_tower_id"])


QUERIES["cdr_landing"] = q_cdr_landing
QUERIES["cdr_tower_daily"] = q_cdr_tower_daily
QUERIES["cdr_tower_forecast"] = q_cdr_tower_forecast
QUERIES["cdr_semantic_by_tower"] = q_cdr_semantic_by_tower
