"""Log-shaped views derived from the ``events`` table.

These are the inputs of the landing and monitoring operators when they run on
the driver's test tables. Each view is a pure DataFrame derivation of
``events``, so its size grows with the table; the same views are written as
DuckDB SQL in :mod:`sluice.plans.oracle` for the correctness check.

* ``log_records``: one Kafka-shaped record per event: topic, partition,
  offset (dense per topic-partition), key, JSON value, timestamp, push_time.
* ``log_records_bad``: the same with payload faults injected by
  ``event_id % 50`` (see ``FAULTS``).
* ``log_records_dup``: ``log_records`` plus a re-delivered copy of every
  record with ``event_id % 10 = 0`` (push_time + 1000 ms).
* ``progress``: committed offset per (topic, partition).
* ``channel_status``: one status row per channel per hour, like the polled
  channel status of the ingest client.
* ``tower_daily``: per-tower daily call features.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.functions.numbering import dense_sequence
from sluice.functions.plan import fence
from sluice.functions.timefn import epoch_millis, trunc_ntz
from sluice.tables import read_table

# Offsets are numbered in blocks of event ids (see functions.numbering).
OFFSET_BLOCK = 1 << 16

# Fixed fault cases, keyed by event_id % 50.
FAULTS = {
    1: "not-json",
    2: "{broken json: ",
    3: "",
    4: "null",
    5: "[1, 2, 3]",
    6: "{}",
    7: None,            # tombstone: SQL NULL value
    8: "missing fields",
    9: "explicit nulls",
    10: "keys differing by case",
    11: "BAD_ID",
    12: "INVALID_DATE",
    13: "INVALID_TS",
    14: "decimal overflow",
    15: "city too long",
    16: "extra key",
}
LITERAL_FAULTS = {1: "not-json", 2: "{broken json: ", 3: "", 4: "null", 5: "[1, 2, 3]", 6: "{}"}
TOMBSTONE_CASE = 7

# The declared landing table ("users"): (name, type, max length).
USERS_DECLARED = [
    ("user_id", "bigint", None),
    ("first_name", "string", 100),
    ("last_name", "string", 100),
    ("email", "string", 255),
    ("phone_number", "string", 50),
    ("address", "string", 500),
    ("city", "string", 100),
    ("state", "string", 100),
    ("country", "string", 100),
    ("date_of_birth", "date", None),
    ("registration_date", "timestamp_ntz", None),
    ("order_amount", "decimal(10,2)", None),
]


def _s(c: Column) -> Column:
    return c.cast("string")


def _payload(e: DataFrame, faults: bool) -> Column:
    """JSON payload text of a users row, built from one event. Keys use mixed
    case on purpose: landing matches them case-insensitively."""
    m = F.col("event_id") % 50
    uid = F.col("user_id")
    user_id_txt = _s(F.col("event_id"))
    city = F.concat(F.lit("C"), _s(uid % 12))
    dob = _s(F.date_add(F.lit("1944-01-01").cast("date"), ((uid * 173) % 22000).cast("int")))
    ts_txt = F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    amount = F.format_string("%.2f", F.col("value"))
    extra = F.lit("")
    if faults:
        user_id_txt = F.when(m == 11, F.lit('"BAD_ID"')).otherwise(user_id_txt)
        dob = F.when(m == 12, F.lit("INVALID_DATE")).otherwise(dob)
        ts_txt = F.when(m == 13, F.lit("INVALID_TS")).otherwise(ts_txt)
        amount = F.when(m == 14, F.lit("123456789.129")).otherwise(amount)
        city = F.when(m == 15, F.repeat(F.lit("x"), 120)).otherwise(city)
        extra = F.when(m == 16, F.lit(',"Loyalty_Tier":"gold","Signup_Day":"2024-02-01"')) \
                 .otherwise(F.lit(""))
    full = F.concat(
        F.lit('{"USER_ID":'), user_id_txt,
        F.lit(',"First_Name":"F'), _s(uid),
        F.lit('","last_name":"L'), _s(F.col("event_id") % 97),
        F.lit('","Email":"u'), _s(F.col("event_id")), F.lit("@example.com"),
        F.lit('","phone_number":"+1555'), F.lpad(_s(uid), 7, "0"),
        F.lit('","ADDRESS":"'), _s(F.col("event_id") % 1000), F.lit(" Main St\\nApt "), _s(uid),
        F.lit('","country":"'), F.col("event_type"),
        F.lit('","City":"'), city,
        F.lit('","STATE":"S'), _s(uid % 50),
        F.lit('","registration_date":"'), ts_txt,
        F.lit('","date_of_birth":"'), dob,
        F.lit('","order_amount":'), amount,
        F.lit(',"props":'), F.col("props"),
        extra,
        F.lit("}"),
    )
    if not faults:
        return full
    out = full
    for k, text in LITERAL_FAULTS.items():
        out = F.when(m == k, F.lit(text)).otherwise(out)
    out = F.when(m == TOMBSTONE_CASE, F.lit(None).cast("string")).otherwise(out)
    out = F.when(m == 8, F.concat(F.lit('{"USER_ID":'), _s(F.col("event_id")),
                                  F.lit(',"country":"'), F.col("event_type"), F.lit('"}'))) \
           .otherwise(out)
    out = F.when(m == 9, F.concat(F.lit('{"USER_ID":'), _s(F.col("event_id")),
                                  F.lit(',"First_Name":null,"City":null,"order_amount":null}'))) \
           .otherwise(out)
    out = F.when(m == 10, F.concat(F.lit('{"USER_ID":'), _s(F.col("event_id")),
                                   F.lit(',"City":"first","CITY":"second","country":"'),
                                   F.col("event_type"), F.lit('"}'))) \
           .otherwise(out)
    return out


def log_records_full(spark: SparkSession, sf_dir: str, faults: bool = False) -> DataFrame:
    """Log records with the source event columns kept (for derived views)."""
    e = read_table(spark, sf_dir, "events")
    d = e.select(
        "event_id", "ts", "user_id", "event_type", "value", "props",
        F.concat(F.col("event_type"), F.lit("_events")).alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
    )
    d = dense_sequence(d, ["topic", "partition"], "event_id",
                       F.floor(F.col("event_id") / OFFSET_BLOCK), "offset")
    return d.select(
        "event_id", "user_id", "event_type", "value", "topic", "partition",
        F.col("offset").cast("bigint").alias("offset"),
        _s(F.col("user_id")).alias("key"),
        _payload(d, faults).alias("value_json"),
        F.col("ts").alias("timestamp"),
        (epoch_millis(F.col("ts")) + F.col("event_id") % 5000).alias("push_time"),
    )


LOG_COLUMNS = ["topic", "partition", "offset", "key", "value", "timestamp", "push_time"]


def _kafka_shape(full: DataFrame) -> DataFrame:
    return full.select("topic", "partition", "offset", "key",
                       F.col("value_json").alias("value"), "timestamp", "push_time")


def log_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kafka_shape(log_records_full(spark, sf_dir))


def log_records_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kafka_shape(log_records_full(spark, sf_dir, faults=True))


def log_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records that are objects (of those with faults), as nested envelopes: meta
    data with arrays of text and of objects, and the payload as ``body``."""
    lr = fence(log_records_bad(spark, sf_dir))   # one value a record
    lr = lr.where(F.ltrim("value").startswith("{") & F.try_parse_json("value").isNotNull())
    value = F.concat(F.lit('{"meta":{"offset":'), _s(F.col("offset")), F.lit(',"tags":["'), F.col("topic"), F.lit('","p'),
                     _s(F.col("partition")), F.lit('"],"pushes":[{"ms":'), _s(F.col("push_time")),
                     F.lit('}]},"body":'), F.col("value"), F.lit("}"))
    return lr.withColumn("value", value)


def log_records_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record once, plus a second delivery of records with
    ``event_id % 10 = 0`` pushed 1 s later (same topic, partition, offset)."""
    full = log_records_full(spark, sf_dir)
    again = full.where(F.col("event_id") % 10 == 0) \
                .withColumn("push_time", F.col("push_time") + 1000)
    return _kafka_shape(full.unionByName(again))


def progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Committed offset per (topic, partition): half the highest offset;
    partition 2 has never committed (NULL)."""
    lr = log_records(spark, sf_dir)
    return (lr.groupBy("topic", "partition").agg(F.max("offset").alias("__mx"))
            .select("topic", "partition",
                    F.when(F.col("partition") == 2, F.lit(None).cast("bigint"))
                    .otherwise(F.floor(F.col("__mx") / 2).cast("bigint")).alias("committed")))


def channel_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status history: one row per channel and hour.

    The per-hour figures are a grouped aggregate over the raw records; the
    running counters are windows over the (small) hourly history per channel.
    """
    lr = log_records_full(spark, sf_dir)
    is_err = (F.col("event_type") == "error") & (F.col("value") > 150)
    hourly = (lr.groupBy(
                F.concat(F.lit("CH_P"), _s(F.col("partition"))).alias("channel"),
                "partition",
                trunc_ntz("hour", F.col("timestamp")).alias("poll_ts"))
              .agg(F.max("offset").alias("hour_max_offset"),
                   F.count(F.lit(1)).alias("n"),
                   F.count_if(is_err).alias("n_err"),
                   F.max(F.when(is_err, F.col("offset"))).alias("err_max_offset"),
                   F.avg(F.col("event_id") % 5000).alias("lat"),
                   F.avg("value").alias("dur"),
                   F.count_if((F.col("event_type") == "view") & (F.col("value") > 250)).alias("bp")))
    w = Window.partitionBy("channel").orderBy("poll_ts")
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s1 = hourly.select(
        "*",
        F.max("hour_max_offset").over(run).alias("sent_offset"),
        F.sum("n_err").over(run).alias("rows_error_count"),
        F.sum(F.col("n") - F.col("n_err")).over(run).alias("rows_inserted_count"),
        F.sum("bp").over(run).alias("backpressure_rewind_count"),
        F.sum(F.when((F.col("n_err") >= 1) & (F.col("n") % 2 == 0), 1).otherwise(0)).over(run).alias("channel_recovery_count"),
        F.max("err_max_offset").over(run).alias("err_upper"),
    )
    s2 = s1.withColumn("prev_sent", F.lag("sent_offset").over(w))
    s3 = s2.withColumn("committed_num", F.max(
        F.when(F.hour("poll_ts") % 3 == 0, F.col("prev_sent"))).over(run))
    bad_token = (F.col("channel") == "CH_P1") & (F.dayofmonth("poll_ts") == 2) & (F.hour("poll_ts") == 5)
    return s3.select(
        "channel",
        "poll_ts",
        F.when(F.col("n_err") >= 1, F.lit("ERR_CHANNEL_INVALID_ROWS"))
         .otherwise(F.lit("SUCCESS")).alias("status_code"),
        F.col("sent_offset").cast("bigint").alias("sent_offset"),
        (F.col("sent_offset") + F.col("n") % 7).cast("bigint").alias("latest_consumer_offset"),
        F.when(bad_token, F.lit("n/a")).otherwise(_s(F.col("committed_num"))).alias("committed_token"),
        F.col("rows_inserted_count").cast("bigint").alias("rows_inserted_count"),
        F.col("rows_error_count").cast("bigint").alias("rows_error_count"),
        F.round("lat", 3).alias("avg_latency_ms"),
        F.when(F.col("rows_error_count") > 0,
               F.concat(F.lit("invalid row at offset "), _s(F.col("err_upper"))))
         .alias("last_error_message"),
        _s(F.col("err_upper")).alias("last_error_offset_token_upper_bound"),
        F.col("n").cast("bigint").alias("put_records"),
        F.round("dur", 3).alias("put_duration_ms"),
        F.col("backpressure_rewind_count").cast("bigint").alias("backpressure_rewind_count"),
        F.col("channel_recovery_count").cast("bigint").alias("channel_recovery_count"),
        (F.col("partition") % 2).cast("int").alias("task_id"),
        F.concat(F.lit("client_"), _s(F.col("partition") % 2)).alias("client"),
        F.lit("USERS").alias("target_table"),
    )


def tower_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-tower daily features of call records: drop rate, call volume and data usage."""
    e = read_table(spark, sf_dir, "events")
    return (e.groupBy(F.concat(F.lit("TOWER_"), F.lpad(_s(F.col("user_id") % 12), 2, "0")).alias("tower"),
                      F.to_date("ts").alias("day"))
            .agg(F.count(F.lit(1)).alias("call_volume"),
                 F.count_if(F.col("event_type") == "error").alias("dropped_calls"),
                 F.sum("value").alias("data_usage_mb"))
            .select("tower", "day", "call_volume", "dropped_calls",
                    (F.col("dropped_calls") / F.col("call_volume")).alias("drop_rate"),
                    "data_usage_mb"))


# The example channel of the row producers: c1 = row index, c2 = its text,
# ts = row time; offset token = text of the index.
COUNTER_DECLARED = [("c1", "bigint", None), ("c2", "string", None), ("ts", "timestamp_auto", None)]


def counter_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per event in a single channel (topic ``counter``, partition
    0 -- every row in one hot partition). ``ts`` comes in the three client
    forms by ``event_id % 3``: epoch seconds as a JSON number (0), naive ISO
    text with microseconds (1), UTC ISO text with milliseconds and ``Z`` (2)."""
    e = read_table(spark, sf_dir, "events")
    us = F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col("ts"))
    secs = F.concat(_s(F.expr("div(__us, 1000000)")), F.lit("."), F.lpad(_s(F.col("__us") % 1000000), 6, "0"))
    iso6 = F.concat(F.lit('"'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit('"'))
    iso3 = F.concat(F.lit('"'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit('Z"'))
    form = F.col("event_id") % 3
    ts_json = F.when(form == 0, secs).when(form == 1, iso6).otherwise(iso3)
    value = F.concat(F.lit('{"c1":'), _s(F.col("event_id")), F.lit(',"c2":"'), _s(F.col("event_id")),
                     F.lit('","ts":'), ts_json, F.lit("}"))
    return (e.withColumn("__us", us)
            .select(F.lit("counter").alias("topic"), F.lit(0).alias("partition"),
                    F.col("event_id").alias("offset"), F.lit(None).cast("string").alias("key"),
                    value.alias("value"), F.col("ts").alias("timestamp"),
                    (F.col("__us") / 1000).cast("long").alias("push_time")))


# The value sets of the call detail records.
AREA_CODES = ["212", "310", "415", "512", "617", "702", "808", "904", "303", "206"]
CELL_TOWERS = ["LAX-001", "LAX-002", "NYC-010", "NYC-011", "SFO-005", "SFO-006",
               "AUS-003", "SEA-007", "DEN-004", "MIA-008", "BOS-009", "LAS-012"]
CALL_TYPES = ["VOICE", "SMS", "DATA", "MMS", "VOICEMAIL"]
NETWORKS = ["4G", "5G", "3G", "WIFI", "ROAMING"]
DISPOSITIONS = ["ANSWERED", "NO_ANSWER", "BUSY", "FAILED", "DROPPED"]
PLANS = ["BASIC", "STANDARD", "PREMIUM", "UNLIMITED", "PREPAID"]

CDR_DECLARED = [
    ("record_id", "bigint", None), ("caller_number", "string", None), ("callee_number", "string", None),
    ("call_type", "string", None), ("disposition", "string", None),
    ("call_start", "timestamp_ntz", None), ("call_end", "timestamp_ntz", None),
    ("duration_seconds", "bigint", None), ("data_usage_mb", "double", None),
    ("charge_amount", "decimal(10,2)", None), ("network_type", "string", None),
    ("cell_tower_id", "string", None), ("plan_type", "string", None), ("roaming", "boolean", None),
    ("event_timestamp", "timestamp_auto", None),
]


def _pick_from(values: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def cdr_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Call detail records as JSON log records, one per event: the caller is
    the record key, the partition ``user_id % 3``. Drops come from ``error``
    events; times are ``yyyy-MM-dd HH:mm:ss`` text, the end derived from the
    start plus the duration."""
    e = read_table(spark, sf_dir, "events")
    eid, uid = F.col("event_id"), F.col("user_id")
    phone = lambda area_idx, num: F.concat(
        F.lit("+1"), _pick_from(AREA_CODES, area_idx % 10), F.lpad(_s(num % 10000000), 7, "0"))
    d = e.select(
        "event_id", "ts", "user_id",
        phone(uid, uid * 7919).alias("caller"), phone(eid, eid * 104729).alias("callee"),
        _pick_from(CALL_TYPES, eid % 5).alias("ct"),
        F.when(F.col("event_type") == "error", F.lit("DROPPED"))
         .otherwise(_pick_from(DISPOSITIONS, F.expr("div(event_id, 5)") % 4)).alias("disp"),
        F.col("value"))
    dur = F.when(F.col("ct").isin("VOICE", "VOICEMAIL") & (F.col("disp") == "ANSWERED"),
                 5 + (F.col("event_id") * 37) % 3595).otherwise(F.lit(0))
    d = d.withColumn("dur", dur.cast("long")).withColumn("start", trunc_ntz("second", F.col("ts")))
    usage = F.when(F.col("ct") == "DATA", F.format_string("%.2f", F.col("value"))).otherwise(F.lit("0.0"))
    cents = F.col("event_id") % 1501
    charge = F.concat(_s(F.expr("div(event_id % 1501, 100)")), F.lit("."), F.lpad(_s(cents % 100), 2, "0"))
    net = _pick_from(NETWORKS, F.col("user_id") % 5)
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    value = F.concat(
        F.lit('{"record_id":'), _s(F.col("event_id")),
        F.lit(',"caller_number":'), q(F.col("caller")),
        F.lit(',"callee_number":'), q(F.col("callee")),
        F.lit(',"call_type":'), q(F.col("ct")),
        F.lit(',"disposition":'), q(F.col("disp")),
        F.lit(',"call_start":'), q(F.date_format("start", "yyyy-MM-dd HH:mm:ss")),
        F.lit(',"call_end":'), q(F.date_format(F.timestamp_add("SECOND", F.col("dur"), F.col("start")),
                                               "yyyy-MM-dd HH:mm:ss")),
        F.lit(',"duration_seconds":'), _s(F.col("dur")),
        F.lit(',"data_usage_mb":'), usage,
        F.lit(',"charge_amount":'), charge,
        F.lit(',"network_type":'), q(net),
        F.lit(',"cell_tower_id":'), q(_pick_from(CELL_TOWERS, F.col("user_id") % 12)),
        F.lit(',"plan_type":'), q(_pick_from(PLANS, F.expr("div(user_id, 12)") % 5)),
        F.lit(',"roaming":'), F.when(net == "ROAMING", F.lit("true")).otherwise(F.lit("false")),
        F.lit(',"event_timestamp":'), q(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))),
        F.lit("}"))
    return d.select(F.lit("cdr").alias("topic"), (F.col("user_id") % 3).cast("int").alias("partition"),
                    F.col("event_id").alias("offset"), F.col("caller").alias("key"), value.alias("value"),
                    F.col("ts").alias("timestamp"),
                    epoch_millis(F.col("ts")).alias("push_time"))
