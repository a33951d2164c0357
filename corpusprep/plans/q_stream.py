"""Streaming queries over the given tables, and over feeds of several files laid out from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusprep.functions.draws import sql_draw, sql_draw_hash
from corpusprep.operators import collate as co
from corpusprep.plans import fixtures as fx
from corpusprep.plans.catalog import query
from corpusprep.plans.q_collate import BYTES, SQL_COLLATE
from corpusprep.session import scratch_path
from corpusprep.streaming import file_order as fo
from corpusprep.streaming import stream as st

FILES = 10
SEED = 42
BUFFER = 20
TAKE = 2048
EVENT_COLS = ["event_id", "ts_us", "user_id", "event_type", "value", "props"]
SQL_EVENTS = "SELECT event_id, epoch_us(ts) AS ts_us, user_id, event_type, value, props FROM events"


def _events(spark, sf_dir):
    e = fx.table(spark, sf_dir, "events")
    # microseconds since the epoch of a zone-less timestamp, whatever the session time zone
    ts_us = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST(ts AS TIMESTAMP_NTZ))")
    return e.select("event_id", ts_us.alias("ts_us"), "user_id", "event_type", "value", "props")


def _feed(spark, sf_dir, parts=None, path=None):
    """Event ids as a feed of ``FILES`` files, part by remainder; all parts or those given."""
    e = _events(spark, sf_dir).select("event_id").withColumn("part", F.col("event_id") % FILES)
    path = path or scratch_path(spark, "events-feed")
    st.write_feed(e if parts is None else e.filter(F.col("part").isin(list(parts))), path, "part", FILES, "event_id")
    return path, "event_id BIGINT, part BIGINT"


def _run(spark, sf_dir, project):
    """The events table itself as a stream."""
    path = f"{sf_dir.rstrip('/')}/events.parque[t]"  # a pattern: the table may be one file or a folder
    schema = fx.table(spark, sf_dir, "events").schema
    s = project(st.read_stream(spark, path, schema, with_position=False))
    sink, ck = scratch_path(spark, "events-sink"), scratch_path(spark, "events-ckpt")
    st.run_available(s, sink, ck)
    return st.read_sink(spark, sink)


TS_US = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST(ts AS TIMESTAMP_NTZ)) AS ts_us"


@query("stream_scan", SQL_EVENTS)
def q_stream_scan(spark, sf_dir):
    return _run(spark, sf_dir, lambda s: s.selectExpr("event_id", TS_US, "user_id", "event_type", "value", "props")).select(*EVENT_COLS)


@query("stream_project", "SELECT event_id, ts_us, user_id, event_type FROM (" + SQL_EVENTS + ") e")
def q_stream_project(spark, sf_dir):
    """Columns dropped on the stream itself (pruned before the sink)."""
    return _run(spark, sf_dir, lambda s: s.drop("value", "props").selectExpr("event_id", TS_US, "user_id", "event_type")).select("event_id", "ts_us", "user_id", "event_type")


_SQL_FILES = f"SELECT event_id, {sql_draw_hash(SEED, 'files', '{epoch}', 'concat(\'part=\', event_id % ' + str(FILES) + ')')} AS fh, event_id % {FILES} AS part FROM events"


def _sql_arrival(epoch: int = 0) -> str:
    """Events in the order in which the files of an epoch come."""
    return f"SELECT event_id, row_number() OVER (ORDER BY fh, part, event_id) - 1 AS idx FROM ({_SQL_FILES.replace('{epoch}', str(epoch))}) f"


FILES_AT_ONCE = 3


@query("stream_file_order", "\nUNION ALL\n".join(f"SELECT event_id, CAST({e} AS INTEGER) AS epoch, idx + {e} * (SELECT count(*) FROM events) AS idx FROM ({_sql_arrival(e)}) a" for e in (0, 1)))
def q_stream_file_order(spark, sf_dir):
    """Two epochs of ten files, each in its own seeded order; stopped inside the first and inside the second, then resumed."""
    path, schema = _feed(spark, sf_dir)
    sink, state, ck = (scratch_path(spark, f"order-{x}") for x in ("sink", "state", "ckpt"))
    step = lambda pool, arrived, emitted, last: (pool.select("event_id", "epoch", "idx"), pool.limit(0))
    write = st.carried_writer(sink, state, step, fo.in_file_order)
    for until in (4, FILES + 5, None):
        fo.run_in_order(spark, path, schema, ck, write, SEED, 2, FILES_AT_ONCE, until)
    return st.read_sink(spark, sink).select("event_id", "epoch", "idx")


_SQL_SHUFFLE = f"""WITH f AS ({_sql_arrival()})
SELECT event_id, idx, row_number() OVER (ORDER BY CAST(idx AS HUGEINT) * 4294967296 + {BUFFER} * {sql_draw(SEED, 'buffer', '0', 'idx')}, idx) - 1 AS pos FROM f"""


@query("stream_shuffle", _SQL_SHUFFLE)
def q_stream_shuffle(spark, sf_dir):
    """Buffered shuffle of the file-order stream, three files a micro-batch; the buffer goes on from one to the next."""
    path, schema = _feed(spark, sf_dir)
    sink, state, ck = (scratch_path(spark, f"shuffle-{x}") for x in ("sink", "state", "ckpt"))
    step = st.shuffle_step(BUFFER, SEED)
    fo.run_in_order(spark, path, schema, ck, st.carried_writer(sink, state, step, fo.in_file_order), SEED, 1, FILES_AT_ONCE)
    st.finish_carried(spark, sink, state, step)
    return st.read_sink(spark, sink).select("event_id", "idx", "pos")


@query("stream_take", f"SELECT event_id FROM events ORDER BY event_id % {FILES}, event_id LIMIT {TAKE}")
def q_stream_take(spark, sf_dir):
    """First rows of the stream in arrival order; the stream stops once it has them."""
    path, schema = _feed(spark, sf_dir)
    sink, state, ck = (scratch_path(spark, f"take-{x}") for x in ("sink", "state", "ckpt"))
    st.run_take(st.read_stream(spark, path, schema), sink, state, ck, TAKE, ["file", "row_in_file"])
    return st.read_sink(spark, sink).select("event_id")


@query("stream_resume", "SELECT event_id, CAST(1 AS BIGINT) AS n_seen FROM events")
def q_stream_resume(spark, sf_dir):
    """Stop after four files, add the other six, restart on the same checkpoint: no loss, no repeat."""
    path = scratch_path(spark, "resume-feed")
    _, schema = _feed(spark, sf_dir, range(4), path)
    sink, ck = scratch_path(spark, "resume-sink"), scratch_path(spark, "resume-ckpt")
    keep = lambda b, i: b.select("event_id")
    st.run_available(st.read_stream(spark, path, schema, 3), sink, ck, keep)
    _feed(spark, sf_dir, range(4, FILES), path)
    st.run_available(st.read_stream(spark, path, schema, 3), sink, ck, keep)
    return st.read_sink(spark, sink).groupBy("event_id").agg(F.count(F.lit(1)).alias("n_seen"))


_PART = "idx // 37 % " + str(FILES)
_SQL_ARRIVED = f"""WITH v_arrived AS (SELECT row_number() OVER (ORDER BY {sql_draw_hash(SEED, 'files', '0', f"concat('part=', {_PART})")}, {_PART}, idx) - 1 AS idx, ids FROM v_labels),
"""


@query("stream_collate", SQL_COLLATE.replace("FROM v_labels", "FROM v_arrived").replace("WITH ", _SQL_ARRIVED, 1), ("v_labels",))
def q_stream_collate(spark, sf_dir):
    """Labels without a position, as ten files whose ends fall inside batches, three files a micro-batch: rows are
    numbered as they arrive, and batches that are not whole wait."""
    lab = fx.v_labels(spark, sf_dir).select(F.col("ids").alias("labels"), "idx", (F.floor(F.col("idx") / 37) % FILES).alias("part"))
    path = scratch_path(spark, "labels-feed")
    st.write_feed(lab, path, "part", FILES, "idx")
    sink, state, ck = (scratch_path(spark, f"labels-{x}") for x in ("sink", "state", "ckpt"))
    transform = lambda b: co.collate(b, batch_size=16, reserved=BYTES).select("idx", "batch_id", "decoder_input_ids", "labels")
    step = st.batch_step(16, transform)
    # the feed's own position is not read
    fo.run_in_order(spark, path, "labels ARRAY<INT>, part BIGINT", ck, st.carried_writer(sink, state, step, fo.in_file_order), SEED, 1, FILES_AT_ONCE)
    st.finish_carried(spark, sink, state, step)
    return st.read_sink(spark, sink).select("idx", "batch_id", "decoder_input_ids", "labels")
