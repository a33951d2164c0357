from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusprep.functions.draws import SPACE, bucket, draw, ladder, threshold
from corpusprep.operators.index import block_rank, dense_index, lag_in_order
from corpusprep.operators.mix import parse_weights


def test_ladder_and_threshold():
    assert ladder(["0.5", "0.5"]) == [SPACE // 2, SPACE]
    assert threshold(0) == 0 and threshold(1) == SPACE
    assert ladder(parse_weights("0.126,0.157,0.167,0.151,0.282,0.102,0.014,0.001"))[0] == 541165879
    with pytest.raises(ValueError):
        threshold(1.5)


def test_parse_weights_validation():
    assert parse_weights("0.25, 0.75") == [Decimal("0.25"), Decimal("0.75")]
    for bad in ("0.5,0.6", "0.5,-0.5,1.0", ""):
        with pytest.raises(ValueError):
            parse_weights(bad)
    with pytest.raises(ValueError):
        parse_weights("0.5,0.5", count=3)


def test_draw_is_md5_prefix(spark):
    import hashlib

    row = spark.range(1).select(draw(42, "mix", F.lit(7)).alias("u")).first()
    assert row.u == int(hashlib.md5(b"42:mix:7").hexdigest()[:8], 16)


def test_bucket_matches_python(spark):
    thr = ladder(["0.2", "0.3", "0.5"])
    df = spark.range(2000).select("id", draw(1, "b", "id").alias("u"))
    got = {r.id: r.s for r in df.select("id", "u", bucket(F.col("u"), thr).alias("s")).collect()}
    us = {r.id: r.u for r in df.collect()}
    for i, u in us.items():
        assert got[i] == next(j for j, t in enumerate(thr) if u < t)


@pytest.mark.parametrize("parts", [1, 4, 13])
def test_dense_index_matches_row_number(spark, parts):
    d = spark.range(3000).select(F.col("id"), (F.col("id") % 7).alias("g"), (F.col("id") * 7919 % 3001).alias("k"))
    d = d.withColumn("g", F.when(F.col("g") == 0, F.lit(None)).otherwise(F.col("g")))
    got = dense_index(d.repartition(parts), ["k", "id"], "g", partitions=parts, groups_bound=8)
    want = d.select("id", (F.row_number().over(Window.partitionBy("g").orderBy("k", "id")) - 1).alias("w"))
    bad = got.join(want, "id").filter(F.col("idx") != F.col("w")).count()
    assert bad == 0 and got.count() == 3000


def test_lag_and_block_rank(spark):
    d = spark.range(500).select("id", (F.col("id") % 3).alias("g"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("t"))
    got = lag_in_order(d, "g", ["id"], "t", "prev")
    want = d.select("id", F.lag("t").over(Window.partitionBy("g").orderBy("id")).alias("w"))
    assert got.join(want, "id").filter(~F.col("prev").eqNullSafe(F.col("w"))).count() == 0
    r = block_rank(d, "id", "g", name="occ", block=16)
    want = d.select("id", (F.row_number().over(Window.partitionBy("g").orderBy("id")) - 1).alias("w"))
    assert r.join(want, "id").filter(F.col("occ") != F.col("w")).count() == 0


def test_blocked_index_matches_generic(spark):
    from corpusprep.functions.draws import draw_hash
    from corpusprep.operators.index import hash_block

    d = spark.range(2000).select("id", (F.col("id") % 3).alias("g"), draw_hash(5, "t", "id").alias("h"))
    a = dense_index(d, ["h", "id"], "g", groups_bound=3)
    b = dense_index(d, ["h", "id"], "g", groups_bound=3, block=hash_block("h", 8), blocks_bound=256)
    c = dense_index(d, ["h", "id"], "g", block=hash_block("h", 8))  # offsets joined, not broadcast
    key = lambda df: sorted((r.id, r.idx) for r in df.select("id", "idx").collect())
    assert key(a) == key(b) == key(c)
