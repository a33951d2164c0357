"""Trie of conversation prefixes, with count-min screening of what has to be shuffled.

A prefix is named by a 128-bit digest that a running exclusive-or of place-bound turn
hashes gives, so a conversation of any length is cut into blocks like any other table.
All digests go into one count-min sketch, whose counters stop at two since only "one"
matters: an estimate of one proves that a single conversation starts so. Such tails are
complete where they stand and their nodes are emitted there; only prefixes that may be
shared are shuffled and grouped exactly. A hash clash in the sketch costs a shuffled row
and changes no result.

Sums over subtrees need no walk over levels. The smallest member of a node is the
smallest member of its whole subtree where it passes, so a conversation names one run of
nodes, from some depth to its end. What a node sums is then a sum over its members: the
whole run of each, and for its smallest member the part of the run from here on.
"""

from __future__ import annotations

import hashlib
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.llm.common import shuffle_partitions, stored
from corpusprep.llm.words import mix, odd_numbers
from corpusprep.operators.index import dense_index

#: Rows and counters a row of the sketch: 16 MB in a task, 2 MB sent to all. Beyond some 4 million
#: prefixes more rows are shuffled that need not be; results stay the same.
SKETCH_ROWS, SKETCH_BITS = 4, 22
#: Counters in one slice of the sketch, as slices are merged.
SLICE = 1 << 19
#: Turns in one block of a conversation, ids in one piece of text that is hashed.
BLOCK, IDS = 4096, 4096
#: Conversations c - c % GROUP .. share their first turns, crc32(c) % HEADS of them.
GROUP, HEADS = 5, 9

EMPTY_SHA = hashlib.sha256(b"").hexdigest()
KEY = ["p1", "p2", "depth"]


# --- conversations to prefixes ----------------------------------------------------------

def running(df: DataFrame, by: str, pos: str, how, **cols: str) -> DataFrame:
    """Adds for each ``name=column`` the aggregate ``how`` over rows of ``by`` up to ``pos`` (from 1, unique).

    Windows hold a block of ``BLOCK`` positions; blocks after the first are joined to the
    totals before them, which only groups of more than one block have.
    """
    df = df.withColumn("blk", F.expr(f"({pos} - 1) div {BLOCK}"))
    w = Window.partitionBy(by, "blk").orderBy(pos)
    totals = df.groupBy(by, "blk").agg(*[how(c).alias(n) for n, c in cols.items()], F.max("blk").alias("top"))
    before = Window.partitionBy(by).orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(by, "blk", *[how(n).over(before).alias(f"{n}_before") for n in cols]).where("blk > 0")
    inside = df.select("*", *[how(c).over(w).alias(f"{n}_here") for n, c in cols.items()])
    joined = inside.join(totals, [by, "blk"], "left")
    both = {n: F.array(F.col(f"{n}_before"), F.col(f"{n}_here")) for n in cols}
    return joined.select(*df.drop("blk").columns, *[_fold(how, both[n]).alias(n) for n in cols])


def _fold(how, pair: Column) -> Column:
    first, second = F.coalesce(pair[0], F.lit(0).cast("long")), pair[1]
    return first.bitwiseXOR(second) if how is F.bit_xor else first + second


def original_turns(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, pos from 0, mark, bytes): turns in order of turn (null first), role and digest; 16 bytes stand for a turn."""
    r, t = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    mark = F.unhex(F.md5(F.concat(F.char_length(r).cast("string"), F.lit(":"), r, t)))
    narrow = rows.select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), r.alias("role"), mark.alias("mark"), F.octet_length(t).cast("long").alias("bytes")
    ).where("conv is not null")
    return dense_index(narrow, ["turn", "role", "mark"], by="conv", name="pos").select("conv", "pos", "mark", "bytes")


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(convs, rows): (conv, length) and (conv, depth from 1, mark, bytes, is_end) of the rebuilt conversations."""
    lens = turns.groupBy("conv").agg(F.count("*").alias("len"))
    own = lens.select("*", _heads("conv").alias("heads"), F.expr(f"conv - conv % {GROUP}").alias("base"))
    base = lens.select(F.col("conv").alias("base"), F.col("len").alias("base_len"))
    convs = own.join(base, "base", "left").withColumn("taken", F.least("heads", F.coalesce("base_len", F.lit(0))))
    convs = stored(convs.withColumn("length", F.expr("taken + greatest(len - heads, 0)")), "convs")
    first = turns.where(f"pos < {HEADS - 1}").withColumnRenamed("conv", "base")
    head = convs.join(first, "base").where("pos < taken")
    tail = turns.withColumn("heads", _heads("conv")).where("pos >= heads").drop("heads").join(convs.select("conv", "taken", "heads", "length"), "conv")
    rows = head.select("conv", (F.col("pos") + 1).alias("depth"), "mark", "bytes", "length").unionByName(
        tail.select("conv", F.expr("pos + 1 + taken - heads").alias("depth"), "mark", "bytes", "length")
    )
    return convs.select("conv", "length"), rows.select("conv", "depth", "mark", "bytes", (F.col("depth") == F.col("length")).alias("is_end"))


def _heads(conv: str) -> Column:
    return F.crc32(F.col(conv).cast("string").cast("binary")) % HEADS


def prefixes(rows: DataFrame) -> DataFrame:
    """Adds ``p1, p2`` (digest of the turns up to here) and ``q1, q2`` (up to the one before)."""
    own = rows.select("*", *[F.xxhash64(F.lit(k), "mark", "depth").alias(f"h{k}") for k in (1, 2)]).drop("mark")
    out = running(own, "conv", "depth", F.bit_xor, p1="h1", p2="h2")
    return out.select("conv", "depth", "p1", "p2", F.col("p1").bitwiseXOR(F.col("h1")).alias("q1"), F.col("p2").bitwiseXOR(F.col("h2")).alias("q2"), "bytes", "is_end")


# --- count-min sketch -------------------------------------------------------------------

def cells(p1: np.ndarray, p2: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """Counter of each digest in each row of the sketch."""
    a, b = p1.astype(np.int64).view(np.uint64), p2.astype(np.int64).view(np.uint64)
    for k in range(SKETCH_ROWS):
        f, g = odd_numbers(2, 200 + k)
        yield (mix(a * f + mix(b * g)) >> np.uint64(64 - bits)).astype(np.int64)


def _longs(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def _sketched(bits: int):
    slice_size = min(SLICE, 1 << bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros((SKETCH_ROWS, 1 << bits), dtype=np.uint8)
        for batch in batches:
            for row, at in zip(counters, cells(_longs(batch, "p1"), _longs(batch, "p2"), bits)):
                at, n = np.unique(at, return_counts=True)
                row[at] = np.minimum(row[at] + np.minimum(n, 2), 2)
        parts = counters.reshape(-1, slice_size)
        for slot in np.flatnonzero(parts.any(axis=1)):
            once, twice = (np.packbits(parts[slot] >= k).tobytes() for k in (1, 2))
            yield pa.RecordBatch.from_arrays([pa.array([slot], pa.int64()), pa.array([once], pa.binary()), pa.array([twice], pa.binary())], names=["slot", "once", "twice"])

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices in order of ``slot``, added one by one: held by two partitions, or twice in one."""
    slot = once = twice = None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([slot], pa.int64()), pa.array([twice.tobytes()], pa.binary())], names=["slot", "twice"])

    for batch in batches:
        for k, a, b in zip(*(batch.column(i).to_pylist() for i in range(3))):
            a, b = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
            if k != slot:
                if slot is not None:
                    yield done()
                slot, once, twice = k, a, b
            else:
                once, twice = once | a, twice | b | (once & a)
    if slot is not None:
        yield done()


def sketch(found: DataFrame, bits: int = SKETCH_BITS) -> np.ndarray:
    """Bits of the counters that reached two, a row of bytes for each row of the sketch."""
    parts = found.select("p1", "p2").mapInArrow(_sketched(bits), "slot long, once binary, twice binary")
    whole = parts.repartition("slot").sortWithinPartitions("slot").mapInArrow(_merged, "slot long, twice binary")
    out = np.zeros((SKETCH_ROWS << bits) // 8, dtype=np.uint8)
    size = min(SLICE, 1 << bits) // 8
    for row in whole.collect():  # at most SKETCH_ROWS << bits bits
        out[row.slot * size : (row.slot + 1) * size] = np.frombuffer(row.twice, np.uint8)
    return out.reshape(SKETCH_ROWS, -1)


def _screened(twice, bits: int, names: list[str]):
    def shared(p1: np.ndarray, p2: np.ndarray) -> np.ndarray:
        out = np.ones(len(p1), dtype=bool)
        for row, at in zip(twice.value, cells(p1, p2, bits)):
            out &= (row[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = shared(_longs(batch, "p1"), _longs(batch, "p2"))
            above = shared(_longs(batch, "q1"), _longs(batch, "q2")) | (_longs(batch, "depth") == 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own), pa.array(above)], names=[*names, "shared", "parent_shared"])

    return run


# --- digests of ends --------------------------------------------------------------------

def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of at most ``IDS`` ids of one node as one comma-joined text."""
    key, ids, out = None, [], []

    def close():
        if ids:
            out.append((*key, ids[0], ",".join(map(str, ids))))
        ids.clear()

    def flushed():
        cols = list(zip(*out)) or [()] * 5
        out.clear()
        types = [pa.int64()] * 4 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=[*KEY, "conv", "ids"])

    for batch in batches:
        for p1, p2, depth, conv in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if key != (p1, p2, depth) or len(ids) >= IDS:
                close()
                key = (p1, p2, depth)
            ids.append(conv)
        if len(out) >= 1000:
            yield flushed()
    close()
    yield flushed()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the pieces of each node, fed one after the other."""
    key, state, out = None, None, []

    def flushed():
        cols = list(zip(*out)) or [()] * 4
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 3 + [pa.string()])], names=[*KEY, "ends"])

    for batch in batches:
        for p1, p2, depth, ids in zip(*(_column(batch, n) for n in (*KEY, "ids"))):
            if key != (p1, p2, depth):
                if state:
                    out.append((*key, state.hexdigest()))
                key, state = (p1, p2, depth), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield flushed()
    if state:
        out.append((*key, state.hexdigest()))
    yield flushed()


def _column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def end_digests(ends: DataFrame) -> DataFrame:
    """(p1, p2, depth, ends): digest of the ids of each node, ascending. Ids are written out in parallel, whatever
    their number at one node; one task then only hashes the pieces of a node in order."""
    spark = ends.sparkSession
    keys = [*KEY, "conv"]
    pieces = ends.select(*keys).repartitionByRange(shuffle_partitions(spark), *keys).sortWithinPartitions(*keys)
    pieces = pieces.mapInArrow(_pieces, "p1 long, p2 long, depth long, conv long, ids string")
    return pieces.repartition(*KEY).sortWithinPartitions(*keys).mapInArrow(_hashed, "p1 long, p2 long, depth long, ends string")


# --- nodes ------------------------------------------------------------------------------

def prefix_trie(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", sketch_bits: int = SKETCH_BITS
) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): a row for each node.

    Turns of a conversation are ordered by turn (null first); rows that tie are ordered
    by role and digest of the text, so repeated rows count each and their order does not
    matter. Null role or text is empty; rows with a null conversation id are dropped.
    Conversations that are rebuilt without a turn end at the root. An empty table gives
    an empty result; other columns are ignored, whatever their names; texts of any length
    are read whole. Ids are whole numbers; ``c % 5`` has the sign of ``c``.
    """
    convs, rebuilt = rebuilt_turns(stored(original_turns(rows, conv_col, turn_col, role_col, text_col), "turns"))
    found = stored(prefixes(rebuilt), "prefixes")
    twice = rows.sparkSession.sparkContext.broadcast(sketch(found, sketch_bits))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema) + ", shared boolean, parent_shared boolean"
    judged = found.mapInArrow(_screened(twice, sketch_bits, found.columns), schema)

    single = judged.where("not shared")
    zero = F.lit(0).cast("long")
    root = convs.select("conv", zero.alias("depth"), zero.alias("p1"), zero.alias("p2"), zero.alias("q1"), zero.alias("q2"), zero.alias("bytes"),
                        (F.col("length") == 0).alias("is_end"), F.lit(True).alias("shared"), F.lit(True).alias("parent_shared"))
    member = stored(judged.where("shared").unionByName(root), "members")
    nodes = stored(
        member.groupBy(*KEY).agg(
            F.count("*").alias("n"), F.min("conv").alias("conv"), F.max("bytes").alias("bytes"), F.sum(F.col("is_end").cast("long")).alias("n_ends"),
            F.max("q1").alias("q1"), F.max("q2").alias("q2"), F.max("parent_shared").alias("parent_shared"),
        ),
        "nodes",
    ).withColumn("value", F.expr("(n - 1) * bytes"))
    top = nodes.where("depth = 0").select("conv").head()
    top = F.lit(None if top is None else top[0]).cast("long")

    # what each conversation brings to a sum: its leaf and the values of the nodes it names
    leaf = nodes.where("n = n_ends").select("conv").unionByName(single.where("is_end").select("conv"))
    brings = leaf.select("conv", F.lit(1).cast("long").alias("leaves"), zero.alias("value")).unionByName(nodes.where("value > 0").select("conv", zero.alias("leaves"), "value"))
    brings = stored(brings.groupBy("conv").agg(F.sum("leaves").alias("leaves"), F.sum("value").alias("value")), "brings")

    # links to parents: exact nodes, and the first node of each tail
    tops = single.where("parent_shared").select("conv", "depth", "q1", "q2", "is_end")
    link = nodes.where("parent_shared and depth > 0").select("conv", "depth", "q1", "q2").unionByName(tops.drop("is_end"))
    child = link.select(F.col("q1").alias("p1"), F.col("q2").alias("p2"), (F.col("depth") - 1).alias("depth"), zero.alias("leaves"), zero.alias("value"), F.lit(1).cast("long").alias("children"))
    sums = member.select("conv", *KEY).join(brings, "conv").select(*KEY, "leaves", "value", zero.alias("children")).unionByName(child)
    sums = sums.groupBy(*KEY).agg(F.sum("leaves").alias("n_leaves"), F.sum("value").alias("in_all"), F.sum("children").alias("n_children"))
    name = nodes.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), (F.col("depth") + 1).alias("depth"), F.col("conv").alias("parent")).where("depth > 1")
    parent = link.where("depth > 1").join(name, ["q1", "q2", "depth"]).select("conv", "depth", "parent")
    parent = parent.unionByName(link.where("depth = 1").select("conv", "depth", top.alias("parent")))
    parent = parent.withColumnRenamed("parent", "parent_conv_id")

    ends = end_digests(member.where("is_end"))
    out_of = lambda n: F.sha2(n.cast("string"), 256)
    exact = running(nodes.withColumn("place", F.col("depth") + 1), "conv", "place", F.sum, so_far="value")
    exact = exact.join(sums, KEY, "left").join(ends, KEY, "left").join(parent, ["conv", "depth"], "left")
    exact = exact.select(
        F.col("conv").alias("conv_id"), "depth", F.when(F.col("parent_shared") & (F.col("depth") > 0), F.col("parent_conv_id")).when(F.col("depth") > 0, F.col("conv")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.coalesce("n_children", zero).alias("n_children"), F.coalesce("n_leaves", zero).alias("n_leaves"),
        (F.coalesce("in_all", zero) - F.col("so_far") + F.col("value")).alias("saved_tokens"),
        F.coalesce("ends", F.lit(EMPTY_SHA)).alias("ends_sha256"),
    )
    below = tops.join(parent, ["conv", "depth"]).unionByName(single.where("not parent_shared").select("conv", "depth", "q1", "q2", "is_end", F.col("conv").alias("parent_conv_id")))
    one = F.lit(1).cast("long")
    tails = below.select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", one.alias("n_convs"), F.when(F.col("is_end"), zero).otherwise(one).alias("n_children"),
        one.alias("n_leaves"), zero.alias("saved_tokens"), F.when(F.col("is_end"), out_of(F.col("conv"))).otherwise(EMPTY_SHA).alias("ends_sha256"),
    )
    return exact.unionByName(tails)


__all__ = ["prefix_trie", "sketch"]
