"""End-to-end jobs composed from the operators."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.functions.draws import draw_hash
from corpusprep.operators import mix as mx
from corpusprep.operators.index import dense_index, hash_block
from corpusprep.operators.shard import SHARD_LIMIT, row_bytes
from corpusprep.operators.split import three_way_split
from corpusprep.session import checkpoint_dir, scratch_path, shuffles_dropped
from corpusprep.sources.sinks import materialise, shard_layout, write_sharded

def interleave_job(
    rows: DataFrame,
    weights,
    out: str,
    seed: int = 42,
    stop: str = mx.ALL_EXHAUSTED,
    test_ratio="0.005",
    valid_ratio="0.1",
    origin: str = "doc_id",
    order: Sequence[str] | None = None,
    shard_limit: int = SHARD_LIMIT,
    mode: str = "errorifexists",
    split_by: str = "origin",
) -> None:
    """Mix sources by weight, split by origin row, cut contiguous shards, write them.

    ``rows``: one row per source row with ``source_id`` (0..S-1 in weight
    order), a unique ``origin`` key and any payload.  ``order`` fixes each
    source's row order (default: ``origin``).

    Everything up to the write runs on narrow keys: (source, origin, k, bytes)
    for the rows and (slot, source, occurrence) for the mixture.  The payload is
    joined at the write only, on (source, k), with the salting of
    :func:`mix.join_rows`, so repeated rows of a small source never form a hot
    key, and in a bounded number of passes over the write tasks, so that the mixed
    rows are never all on their way at once.  A repeated ``origin`` is refused.  Output layout:
    ``out/split=<s>/shard=<i>/part-*.parquet``, rows in ``idx`` order.

    ``split_by="origin"`` (default) keeps all copies of a source row on one
    side; ``split_by="slot"`` splits the mixed rows themselves, as the
    reference does, so copies of one row can land in train and test.
    """
    if split_by not in ("origin", "slot"):
        raise ValueError(f"split_by must be 'origin' or 'slot', not {split_by!r}")
    w = mx.parse_weights(weights)
    order = list(order or [origin])
    spark = rows.sparkSession
    cols = list(dict.fromkeys(["source_id", origin, *order]))
    keys = rows.select(*cols, row_bytes(rows.drop("source_id")).alias("_bytes"))
    keys = dense_index(keys, order, "source_id", name="k", groups_bound=len(w))
    # the narrow key frame feeds every later branch: write it once to the shared folder
    checkpoint_dir(spark)
    keys = keys.checkpoint(eager=True)
    if not keys.groupBy(origin).count().filter("count > 1").isEmpty():
        raise ValueError(f"{origin!r} repeats; the job needs one row per origin")
    sizes = dict(keys.groupBy("source_id").count().collect())  # one row per source
    taken, _, counts = mx.mix_slots(spark, sizes, w, seed, stop)
    used = F.element_at(F.create_map(*[F.lit(x) for s in sizes for x in (s, min(sizes[s], counts[s]))]), F.col("source_id"))
    origins = keys.filter(F.col("k") < used).select("source_id", origin, "k", "_bytes")
    if split_by == "origin":
        narrow = mx.join_rows(taken, three_way_split(origins, origin, test_ratio, valid_ratio, seed), sizes, counts)
    else:
        narrow = three_way_split(mx.join_rows(taken, origins, sizes, counts), "slot", test_ratio, valid_ratio, seed)
    h = draw_hash(seed, "order", "slot")
    shards, plan = shard_layout(narrow, [h, "slot"], "split", shard_limit, splits_bound=3, bytes_col="_bytes", block=hash_block(h), blocks_bound=65536)
    shards = materialise(shards.select("slot", "source_id", "occ", "split", "idx", "shard", "part"), scratch_path(spark, "places"))
    payload = origins.drop("_bytes").join(rows, ["source_id", origin])  # one row per used origin, with its k
    # files are those of one pass, as every row has its write task; the last pass marks the folder as complete
    passes = [(0, plan.parts)] if mode == "ignore" else plan.passes(spark.sparkContext.defaultParallelism)
    for lo, hi in passes:
        here = shards.filter((F.col("part") >= lo) & (F.col("part") < hi))
        options = {} if hi == plan.parts else {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}
        with shuffles_dropped(spark):
            write_sharded(mx.join_rows(here, payload, sizes, counts), out, mode=mode if lo == 0 else "append", plan=plan, **options)
