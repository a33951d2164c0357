"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusprep.session import checkpoint_dir, scratch_path, session_settings, shuffles_dropped
from corpusprep.sources.files import _hadoop_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str, settings: dict[str, str] | None = None) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back: work done once, lineage cut, shuffle files deleted.

    ``settings`` of the session hold while it is written.
    """
    path = scratch_path(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession), session_settings(df.sparkSession, settings or {}):
        df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def forget(*tables: DataFrame) -> None:
    """Delete ``stored`` tables that nothing will read again, as what was made of them is written too."""
    for t in tables:
        p, fs = _hadoop_path(t.sparkSession, t.stored_at)
        fs.delete(p, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many underscores before it as it takes to differ from the columns of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n = f"_{n}"
        taken.add(n.lower())
        out.append(n)
    return out


def row_key(id_col: str, text_col: str) -> Column:
    """64-bit key of a row; rows equal in id and text share it. A null id or text is hashed as such."""
    return F.xxhash64(F.col(id_col), F.col(text_col), F.col(id_col).isNull(), F.col(text_col).isNull())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components by distributed union-find: rows (node, root), root = least node of the component.

    Every round each node takes the least root among its neighbours' roots and its
    own, then the root of that root (path halving); minima are combined before the
    shuffle, so a hub with many links is no hot group. Rounds end when nothing moves.
    An empty edge table gives an empty result; self links and repeated links are harmless.
    """
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null")
    both = stored(both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "links")
    last = stored(both.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.least("u", "v").alias("root")), "roots")
    while True:
        roots = last.select("node", "root")
        offers = both.join(roots, both.v == roots.node).groupBy("u").agg(F.min("root").alias("offer"))
        step = roots.join(offers, roots.node == offers.u, "left").select(
            "node", "root", F.least("root", F.coalesce("offer", "root")).alias("next")
        )
        up = roots.select(F.col("node").alias("n2"), F.col("root").alias("r2"))
        step = stored(
            step.join(up, step.next == up.n2, "left").select(
                "node", F.col("root").alias("was"), F.least("next", F.coalesce("r2", "next")).alias("root")
            ),
            "roots",
        )
        forget(last)
        last = step
        if step.where("root < was").isEmpty():
            forget(both)
            return step.select("node", "root")


def _joined(roots: DataFrame, ends: DataFrame) -> DataFrame:
    """``roots`` (node, root) after the components ``ra`` and ``rb`` of each row of ``ends`` are joined."""
    joined = components(ends, "ra", "rb").toDF("old", "new")
    return stored(roots.join(joined, F.col("root") == F.col("old"), "left").select("node", F.coalesce("new", "root").alias("root")), "roots")


#: Rounds in which every bucket that is still in several components compares one node of each with one of them.
HUB_ROUNDS = 1
#: The same for buckets of rare tokens.
RARE_ROUNDS = 2


def shared_buckets(buckets: DataFrame, settings: dict[str, str] | None = None) -> DataFrame:
    """The distinct (node, key, ...) rows whose key two or more nodes hold, written under ``settings`` of the session.

    Rows are dealt by key once, for counting and for finding them again; most keys have one
    node and end there, so that the others are looked up and rows are not sorted.
    """
    dealt = buckets.repartition(shuffle_partitions(buckets.sparkSession), "key")
    several = dealt.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi").select("key")
    return stored(dealt.join(several.hint("shuffle_hash"), "key").select(*buckets.columns).distinct(), "members", settings)


def _linked(roots: DataFrame, pairs: DataFrame, verify, items: DataFrame) -> DataFrame:
    """``roots`` after the pairs that ``verify`` keeps are linked; the tables this was made of are deleted."""
    edges = stored(verify(pairs, items), "edges")
    forget(pairs)
    if edges.isEmpty():
        forget(edges)
        return roots
    ends = edges.join(roots.toDF("a", "ra"), "a").join(roots.toDF("b", "rb"), "b").select("ra", "rb").where("ra <> rb").distinct()
    out = _joined(roots, ends)
    forget(edges, roots)
    return out


def _meetings(now: DataFrame, k: int) -> DataFrame:
    """Distinct pairs of (node, key, root) rows in which one node of each component of a key meets its hub.

    Components, not nodes, are compared, and a key of one component has no pair. Where the share
    ``alone`` of each node is known, nodes that have little of their own stand for the others: near copies of one
    text are more like its least changed copies than like each other.
    """
    mark = F.xxhash64("node", F.lit(k))
    if "alone" in now.columns:
        mark = F.struct((F.col("alone") * (1 + k * F.pmod(mark, F.lit(1024)) / 1024)).alias("alone"), mark.alias("mark"))
    marked = now.select("key", "root", F.struct(mark.alias("mark"), "node").alias("rep"))
    reps = stored(marked.groupBy("key", "root").agg(F.min("rep").alias("rep")), "reps")
    hubs = reps.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct("rep", "root")).alias("hub")).where("n > 1").select("key", "hub")
    met = reps.join(hubs, "key").where("root <> hub.root").select(F.col("rep.node").alias("node"), F.col("hub.rep.node").alias("other"))
    pairs = stored(met.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct(), "pairs")
    forget(reps)
    return pairs


def _prefixes(weights: DataFrame, similarity: float) -> DataFrame:
    """(node, key, before, total, excess, alone): the rarest tokens of each node until they weigh more than 1 - ``similarity``
    of it, each with the share of the node's weight that comes before it; ``total`` is the weight of the node,
    ``excess`` what its tokens weigh above 1 each, ``alone`` the share of tokens that no other node has.

    Two nodes are only similar if their common tokens weigh ``similarity`` or more of
    each: then, in any one order of all tokens, what comes before the first common token
    weighs 1 - ``similarity`` at most in both, so that token is among these of both. The order
    is by number of nodes, so a token of a passage that many nodes share comes late. Weights are 1 or more.
    """
    common = weights.groupBy("token").agg(F.count("*").alias("df"))
    order, node = Window.partitionBy("node").orderBy("df", "token"), Window.partitionBy("node")
    placed = weights.join(common, "token").select(
        "node", "token", "df", F.coalesce(F.sum("w").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("before"),
        F.sum("w").over(node).alias("total"), F.count("*").over(node).alias("n"), F.sum(F.when(F.col("df") == 1, F.col("w")).otherwise(0.0)).over(node).alias("alone"),
    )
    placed = placed.withColumns({"before": F.col("before") / F.col("total"), "alone": F.col("alone") / F.col("total")}).where(F.col("before") <= 1 - similarity + 1e-9)
    # nothing shares the others
    return placed.where("df > 1").select("node", F.col("token").alias("key"), "before", "total", (F.col("total") - F.col("n")).alias("excess"), "alone")


#: Counters by which ``counted_prefixes`` orders tokens: 16 MB sent to all tasks, whatever the input.
COUNTERS = 1 << 20


def counted_prefixes(tokens: DataFrame, similarity: float) -> DataFrame:
    """As ``_prefixes`` for sets, (node, n, token) rows with the size of each set, with tokens in the order of a counter
    that each shares with others, ``COUNTERS`` in all.

    Any one order of all tokens loses no pair. This one puts tokens of many nodes late without
    an exchange of tokens: only counters are exchanged, and tokens stay where their
    nodes are dealt. Which tokens a node has alone is not known; they end in ``shared_buckets``.
    """
    counter = F.pmod("token", F.lit(COUNTERS)).cast("int")
    counts = tokens.groupBy(counter.alias("counter")).agg(F.count("*").alias("df"))
    placed = tokens.withColumn("counter", counter).join(F.broadcast(counts), "counter")
    ranked = placed.groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("ranked"))
    rare = ranked.select("node", "n", F.posexplode(F.expr(f"slice(ranked, 1, int(floor({1 - similarity + 1e-9!r}D * n)) + 1)")).alias("i", "t"))
    return rare.selectExpr("node", "t.token as key", "i / double(n) as before", "double(n) as total", "0D as excess")


def _within_reach(similarity: float) -> str:
    """SQL: whether nodes a and b can reach ``similarity``, by what comes before their first common token.

    Let u and v be the shares of a and b that are not common, so u >= before_a and v >= before_b. A common token
    weighs 1 or more, so (1 - u) total_a is at most the number of common tokens and excess_a, and
    that number at most (1 - v) total_b: each of u and v bounds the other. For sets the
    similarity is 1 / (1 / (1 - u) + 1 / (1 - v) - 1) = (1 - u)(1 - v) / (1 - uv). For the probability
    Jaccard similarity a common token of weights p and q adds at most pq / (q + vp) and
    pq / (p + uq), both concave and homogeneous in (p, q), so their sums are at most the same at
    (1 - u, 1 - v): again (1 - u)(1 - v) / (1 - uv), which falls in u and v.
    """
    u = "greatest(before_a, 1 - ((1 - before_b) * total_b + excess_a) / total_a)"
    v = "greatest(before_b, 1 - ((1 - before_a) * total_a + excess_b) / total_b)"
    return f"(1 - {u}) * (1 - {v}) >= {similarity} * (1 - {u} * {v}) - 1e-9"


#: Tokens of a node that come before one of its rare tokens: the last one, and those least or greatest in two orders that have nothing to do with rank.
WITNESSES = {"w0": "lag(key, 1, 0L)", "w1": "min(key)", "w2": "max(key)", "w3": "min(xxhash64(key))", "w4": "max(xxhash64(key))", "w5": "min(xxhash64(key, 1))", "w6": "max(xxhash64(key, 1))"}


def _witnessed(rare: DataFrame) -> DataFrame:
    """The (node, key, before, ...) rows of ``rare`` with ``WITNESSES`` among the node's rows before each; null for its first."""
    frames = {c: "partition by node order by before" + ("" if e.startswith("lag") else " rows between unbounded preceding and 1 preceding") for c, e in WITNESSES.items()}
    return rare.selectExpr("*", *[f"nullif({e} over ({frames[c]}), 0L) as {c}" for c, e in WITNESSES.items()])


def _met_here() -> str:
    """SQL: whether no witness tells that nodes a and b also share an earlier token than this one.

    Two equal witnesses are one token that both nodes have before this one, in the order of all tokens, so the pair
    meets there or earlier. At its first common token no witness can be equal: no pair is lost, and
    one that shares many tokens is seldom made more than once.
    """
    return " and ".join(f"not ({c}_a <=> {c}_b and {c}_a is not null)" for c in WITNESSES)


#: Most nodes of a bucket that all meet where nodes have a sketch; larger buckets go by rare tokens. A node of the latter costs
#: some 8 ms for its tokens; among 256 unlike lines some 20 have like sketches, of which each pair is verified in 0.15 ms.
PAIRWISE = 256


def _sketched(x: str, sketch) -> list[Column]:
    """The columns ``sketch`` of one side of a pair; never null, as the JVM does not compile a condition of much code."""
    return [F.coalesce(F.col(c), F.lit(0)).alias(f"{x}_{c}") for c in sketch]


def _meet(rows: DataFrame, columns, condition: str) -> DataFrame:
    """Distinct pairs (a, b) of the (node, key, root, ...) rows of one key and different roots that meet ``condition``, written."""
    one, two = (rows.select(F.col("node").alias(x), "key", F.col("root").alias(f"r{x}"), *columns(x)) for x in "ab")
    return stored(one.join(two, "key").where(f"a < b and ra <> rb and {condition}").select("a", "b").distinct(), "pairs")


def bucket_classes(members: DataFrame, payload, verify, weights, similarity: float, counted: bool = False, sketch=(), alike: str = "true") -> DataFrame:
    """Classes of ``shared_buckets`` rows: nodes of one key are candidates, ``verify(pairs, items) -> edges`` decides.

    ``payload(nodes)`` gives the (node, ...) items of candidate nodes, read once. First every
    node meets the hub of its largest bucket, then one node of
    each component of a bucket meets one of them (``HUB_ROUNDS`` times, another each time). What is left are buckets
    of nodes that share what the bucket stands for (a common passage) but are not linked
    to it. For their nodes ``weights(items) -> (node, token, w)`` gives all
    tokens, and every pair of different components that can reach ``similarity`` meets: its
    nodes share a token of their rarest ones (``_prefixes``, ``_within_reach``), which loses no pair of them. Links inside a class,
    which cannot change it, are not spelled out. ``counted`` orders tokens by counters
    (``counted_prefixes``), for sets of many tokens in small items. ``sketch`` are columns of the items by which the SQL condition
    ``alike`` (on a_... and b_...) tells most pairs that are not similar; with one, all nodes of the
    open buckets of ``PAIRWISE`` nodes or less meet, and only nodes of larger ones go by rare tokens.
    Returns (node, root) of the nodes given.
    """
    items = stored(payload(members.select("node").distinct()), "items")
    roots = stored(members.select("node").distinct().withColumn("root", F.col("node")), "roots")
    sizes = members.groupBy("key").agg(F.count("*").alias("size"), F.min_by("node", F.xxhash64("node")).alias("hub"))
    sizes = stored(sizes, "sizes")
    first = members.join(sizes, "key").groupBy("node").agg(F.max_by("hub", F.struct("size", "key")).alias("hub"))
    pairs = first.where("node <> hub").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    pairs = stored(pairs, "pairs")
    forget(sizes)
    roots = _linked(roots, pairs, verify, items)
    for k in range(HUB_ROUNDS):
        pairs = _meetings(members.join(roots, "node"), k)
        if pairs.isEmpty():
            forget(pairs, items)
            return roots
        roots = _linked(roots, pairs, verify, items)
    def still_open() -> tuple[DataFrame, DataFrame]:
        now = members.join(roots, "node")
        several = now.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("size")).where("lo <> hi")
        return now, several.select("key", "size")

    now, several = still_open()
    if sketch:
        sketches = items.select("node", *sketch)
        few = stored(now.join(several.where(F.col("size") <= PAIRWISE).select("key"), "key").join(sketches, "node"), "few")
        pairs = _meet(few, lambda x: _sketched(x, sketch), alike)
        forget(few)
        roots = _linked(roots, pairs, verify, items)
        now, several = still_open()
        several = several.where(F.col("size") > PAIRWISE)
    still = now.join(several.select("key"), "key").select("node").distinct()
    open_items = items.join(still, "node", "left_semi")
    if counted:  # dealt by node once, as short texts: the tokens of a node then stay together
        near = stored(open_items, "open-items")
        dealt = near.repartition(shuffle_partitions(items.sparkSession), "node")
        rare = shared_buckets(counted_prefixes(weights(dealt), similarity))
        forget(near)
    else:
        tokens = stored(weights(open_items), "tokens")
        rare = shared_buckets(_prefixes(tokens, similarity))
        forget(tokens)
    for k in range(RARE_ROUNDS):
        roots = _linked(roots, _meetings(rare.join(roots, "node"), k), verify, items)
    now = _witnessed(rare).join(roots, "node")
    now = stored(now.join(sketches, "node") if sketch else now, "open")
    named = lambda x: [F.col(c).alias(f"{c}_{x}") for c in ("before", "total", "excess", *WITNESSES)] + _sketched(x, sketch)
    pairs = _meet(now, named, f"{_met_here()} and {_within_reach(similarity)} and {alike}")
    forget(rare, now)
    roots = _linked(roots, pairs, verify, items)
    forget(items)
    return roots


__all__ = ["bucket_classes", "checkpoint_dir", "components", "forget", "row_key", "scratch_path", "shared_buckets", "shuffle_partitions", "stored", "table", "unused"]
