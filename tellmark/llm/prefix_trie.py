"""The trie of conversation prefixes, with totals over all subtrees.

A node is a distinct sequence of first turns; it is known by its depth and its smallest conversation,
and every conversation is a path of nodes. Nodes come from one grouping of all (conversation, depth)
rows, whose key is a running hash of the turns.

Totals over subtrees are rolled up by centroid decomposition, whatever the depth and the fan-out of
the trie. A component is a connected part of the parent edges, at first all of them. What lies below
a node is weighed in rows of conversations, which the grouping has counted. The nodes with more than
half of a component's weight form a path down from its top; the last of them is the centroid. The
total of what lies at and below the centroid is added to all nodes of that path, the part's weight is
taken from them, and the component is split into the centroid, a component for each of its children,
and the rest, each of at most half the weight. So the rounds are as many as the weight has bits.
Whether a node lies below a centroid is looked up in its own conversation's path, at the centroid's
depth. Components of few nodes are split further inside a task, many at a time, in the same way.
"""
from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from tellmark.llm.common import present, shuffle_parts
from tellmark.session import stored

#: Nodes of a component from which on it is split by joins, and nodes that a task splits at a time.
SMALL = 4096
PACK = 1 << 16
#: Turns whose running hash is formed in one task.
STRETCH = 4096
#: Conversation ids of one range that are joined into one string.
RANGE = 4096
SHARED = 6
FAMILY = 100
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


# -- conversations as rows ------------------------------------------------------------------------

def numbered(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, position, h1, h2, chars): the turns of each conversation, from 1.

    By turn, null first; rows of one turn follow each other by a hash of their content. Null roles
    and texts are empty, rows without a conversation are left out. Rows are sorted over all tasks, so a conversation of any length, or
    one row repeated any number of times, is spread; only ranges of rows are numbered in one task.
    """
    role, text = present(F.col(role_col)), present(F.col(text_col))
    rows = conversations.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("bigint").alias("conv_id"), F.col(turn_col).alias("turn"), F.xxhash64(role, text).alias("h1"),
        F.xxhash64(F.lit(7), text, role).alias("h2"), F.length(text).cast("bigint").alias("chars"), F.monotonically_increasing_id().alias("row"))
    order = ["conv_id", F.asc_nulls_first("turn"), "h1", "h2", "row"]
    rows = rows.repartitionByRange(shuffle_parts(rows), *order).sortWithinPartitions(*order)
    rows = stored(rows.select("conv_id", "h1", "h2", "chars", F.monotonically_increasing_id().alias("at")), "turns")
    task = F.shiftright("at", 33)
    # Where each task's rows of a conversation begin, and how many of it lie in tasks before.
    parts = rows.groupBy("conv_id", task.alias("task")).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = W.partitionBy("conv_id").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select("conv_id", "task", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first") + 1).alias("shift"))
    return rows.withColumn("task", task).join(parts, ["conv_id", "task"]).select(
        "conv_id", (F.col("at") + F.col("shift")).alias("position"), "h1", "h2", "chars")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations as their families share them: (conv_id, n_turns) and the rows of `numbered`.

    Conversation c begins with the first h turns of conversation c - c % 100 (all if it has fewer)
    and goes on with its own after its first h, where h = crc32(c) % 6.
    """
    turns = stored(turns, "numbered")
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    shares = sizes.withColumns({"h": F.crc32(F.col("conv_id").cast("string")) % SHARED, "base": F.col("conv_id") - F.col("conv_id") % FAMILY})
    given = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    shares = stored(shares.join(given, "base", "left").select(
        "conv_id", "base", "h", "n", F.least("h", F.coalesce("n_base", F.lit(0))).alias("taken")), "shares")
    heads = turns.filter(F.col("position") < SHARED).withColumnRenamed("conv_id", "base")  # five rows each
    taken = shares.select("conv_id", "base", "taken").join(heads, "base").filter("position <= taken")
    own = turns.join(shares.select("conv_id", "h", "taken"), "conv_id").filter("position > h")
    own = own.withColumn("position", F.col("position") - F.col("h") + F.col("taken"))
    columns = ["conv_id", "position", "h1", "h2", "chars"]
    return shares.select("conv_id", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n_turns")), \
        taken.select(*columns).unionAll(own.select(*columns))


def _paths(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """(conv_id, depth, p1, p2, q1, q2, chars, n_turns): a node's key and its parent's, for every
    conversation and depth. Keys are running XORs of the hashes of (position, turn), 128 bits."""
    rows = turns.select(
        "conv_id", F.col("position").alias("depth"), "chars", F.expr(f"position div {STRETCH}").alias("stretch"),
        F.xxhash64("position", "h1", "h2").alias("x1"), F.xxhash64(F.lit(3), "position", "h2", "h1").alias("x2"))
    totals = rows.groupBy("conv_id", "stretch").agg(F.bit_xor("x1").alias("t1"), F.bit_xor("x2").alias("t2"))
    before = W.partitionBy("conv_id").orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select("conv_id", "stretch", *[F.coalesce(F.bit_xor(f"t{i}").over(before), F.lit(0)).alias(f"o{i}") for i in (1, 2)])
    inside = W.partitionBy("conv_id", "stretch").orderBy("depth").rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.select("*", *[F.bit_xor(f"x{i}").over(inside).alias(f"r{i}") for i in (1, 2)]).join(offsets, ["conv_id", "stretch"])
    rows = rows.select("conv_id", "depth", "chars", "x1", "x2", *[F.col(f"r{i}").bitwiseXOR(F.col(f"o{i}")).alias(f"p{i}") for i in (1, 2)])
    rows = rows.withColumns({f"q{i}": F.col(f"p{i}").bitwiseXOR(F.col(f"x{i}")) for i in (1, 2)}).drop("x1", "x2")
    return rows.join(convs, "conv_id")


# -- digests of members ----------------------------------------------------------------------------

def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash the strings of each node, which arrive one after the other; only one hash is held."""
    now, running = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"depth": pa.array([now[0]]), "p1": pa.array([now[1]]), "p2": pa.array([now[2]]), "ends_sha256": pa.array([running.hexdigest()])})

    for batch in batches:
        c, done = batch.to_pydict(), []
        for key, text in zip(zip(c["depth"], c["p1"], c["p2"]), c["ids"]):
            if key == now:
                running.update(b"," + text.encode())
                continue
            if now is not None:
                done.append(row())
            now, running = key, hashlib.sha256(text.encode())
        yield from done
    if now is not None:
        yield row()


def ends_of(ends: DataFrame) -> DataFrame:
    """(depth, p1, p2, ends_sha256) of rows (depth, p1, p2, conv_id), each id once in its node.

    Ids are joined by ranges of RANGE values in parallel; the ranges of one node are then hashed in
    order by one task, as SHA-256 has to be, which holds no more than a batch of them.
    """
    key = ["depth", "p1", "p2"]
    ranges = ends.groupBy(*key, F.floor(F.col("conv_id") / RANGE).alias("range")).agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    ordered = ranges.repartition(shuffle_parts(ranges), *key).sortWithinPartitions(*key, "range")
    return ordered.select(*key, "ids").mapInArrow(_digests, "depth bigint, p1 bigint, p2 bigint, ends_sha256 string")


# -- the rollup ----------------------------------------------------------------------------------------

def split_forest(depth: np.ndarray, parent: np.ndarray, comp: np.ndarray, weight: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Totals of `values` (columns) over the subtree of every node inside its component.

    Nodes are numbered by place: `parent` is -1 at the top of a component, `comp` its top, `weight`
    what lies at and below a node. All components are split at once, by their centroids.
    """
    weight, comp, total = weight.copy(), comp.copy(), np.zeros_like(values)
    active = np.arange(len(depth))
    while len(active):
        heavy = active[2 * weight[active] > weight[comp[active]]]
        by_depth = heavy[np.lexsort((depth[heavy], comp[heavy]))]
        last = by_depth[np.append(comp[by_depth[1:]] != comp[by_depth[:-1]], True)]
        centroid = np.full(len(depth), -1)
        centroid[comp[last]] = last
        of = centroid[comp]
        top = parent.copy()  # of the new component, by jumping up to it
        tops = (np.arange(len(depth)) == of) | (parent == of) | (parent < 0) | (np.arange(len(depth)) == comp)
        top[tops] = np.flatnonzero(tops)
        while (top[top[active]] != top[active]).any():
            top[active] = top[top[active]]
        below = active[(top[active] == of[active]) | (parent[top[active]] == of[active])]
        part = np.zeros_like(values)
        np.add.at(part, comp[below], values[below])
        total[heavy] += part[comp[heavy]]
        above = heavy[heavy != of[heavy]]
        weight[above] -= weight[of[above]]
        comp[active] = top[active]
        active = active[active != of[active]]
    return total


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Split the components of a partition; they arrive whole and one after the other."""

    def totals(rows: pd.DataFrame) -> pa.RecordBatch:
        nodes = pd.MultiIndex.from_arrays([rows.conv_id, rows.depth])
        comp = nodes.get_indexer(pd.MultiIndex.from_arrays([rows.top_id, rows.top_depth]))
        parent = nodes.get_indexer(pd.MultiIndex.from_arrays([rows.parent_id.fillna(0).astype(np.int64), rows.depth - 1]))
        parent[comp == np.arange(len(rows))] = -1
        values = rows[["n_leaves", "saved"]].to_numpy(np.int64)
        found = split_forest(rows.depth.to_numpy(), parent, comp, rows.weight.to_numpy(), values) + rows[["sum_leaves", "sum_saved"]].to_numpy(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (rows.conv_id, rows.depth, found[:, 0], found[:, 1])], names=["conv_id", "depth", "sum_leaves", "sum_saved"])

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size < PACK:
            continue
        rows = pa.Table.from_batches(held).to_pandas()
        open_ = (rows.top_id == rows.top_id.iloc[-1]) & (rows.top_depth == rows.top_depth.iloc[-1])  # may go on
        if not open_.all():
            yield totals(rows[~open_].reset_index(drop=True))
        held = [pa.RecordBatch.from_pandas(rows[open_], batch.schema, preserve_index=False)]
        size = held[0].num_rows
    if size:
        yield totals(pa.Table.from_batches(held).to_pandas())


def rolled_up(nodes: DataFrame, steps: DataFrame, small: int = SMALL) -> DataFrame:
    """(conv_id, depth, sum_leaves, sum_saved) of every node, by centroid decomposition.

    `nodes`: conv_id, depth, parent_id, weight, n_leaves, saved. `steps`: for (conv_id, depth) of
    paths, the node there and its parent (node_id, parent_id), for the nodes' own conversations.
    """
    root = nodes.filter("depth = 0").select(F.col("conv_id").alias("top_id")).first()
    state = nodes.select("conv_id", "depth", "parent_id", "weight", "n_leaves", "saved", F.lit(root[0] if root else 0).cast("bigint").alias("top_id"), F.lit(0).cast("bigint").alias("top_depth"),
                         F.lit(0).cast("bigint").alias("sum_leaves"), F.lit(0).cast("bigint").alias("sum_saved"))
    columns, comp, sums = state.columns, ["top_id", "top_depth"], ["sum_leaves", "sum_saved"]
    ready, done = [], []
    total = nodes.count()
    while True:
        sizes = stored(state.groupBy(*comp).agg(F.max("weight").alias("all"), F.count("*").alias("n")), "components")
        large = sizes.filter(F.col("n") > small)
        ready.append(state.join(sizes.filter(F.col("n") <= small).select(*comp), comp).select(*columns))
        if large.isEmpty():
            break
        rows = state.join(large.select(*comp, "all"), comp).withColumn("heavy", 2 * F.col("weight") > F.col("all"))
        rows = stored(rows, "large")
        at = F.max(F.when(F.col("heavy"), F.struct("depth", "conv_id", "weight"))).alias("z")
        centroids = stored(rows.groupBy(*comp).agg(at).select(*comp, F.col("z.depth").alias("z_depth"), F.col("z.conv_id").alias("z_id"), F.col("z.weight").alias("z_weight")), "centroids")
        rows = rows.join(centroids, comp)
        deeper = F.col("depth") > F.col("z_depth")
        child = steps.select(F.col("conv_id").alias("s_conv"), F.col("depth").alias("s_depth"), F.col("node_id").alias("child"), F.col("parent_id").alias("child_parent"))
        found = rows.filter(deeper).join(child, (F.col("conv_id") == F.col("s_conv")) & (F.col("z_depth") + 1 == F.col("s_depth"))).drop("s_conv", "s_depth")
        found = found.withColumn("child", F.when(F.col("child_parent") == F.col("z_id"), F.col("child"))).drop("child_parent")
        rows = stored(found.unionByName(rows.filter(~deeper).withColumn("child", F.lit(None).cast("bigint"))), "below")
        is_z = (F.col("depth") == F.col("z_depth")) & (F.col("conv_id") == F.col("z_id"))
        parts = rows.filter(is_z | F.col("child").isNotNull()).groupBy(*comp).agg(F.sum("n_leaves").alias("t_leaves"), F.sum("saved").alias("t_saved"))
        gains = rows.filter("heavy").join(parts, comp)  # a path each
        gains = gains.select(*[c for c in rows.columns if c not in sums], *[(F.col(s) + F.col(f"t_{s[4:]}")).alias(s) for s in sums])
        done.append(gains.filter(is_z).select("conv_id", "depth", *sums))
        above = gains.filter(~is_z).withColumn("weight", F.col("weight") - F.col("z_weight"))
        rest = rows.filter(~F.col("heavy")).select(*above.columns).unionByName(above)
        inside = F.col("child").isNotNull()
        rest = rest.withColumns({"top_id": F.when(inside, F.col("child")).otherwise(F.col("top_id")), "top_depth": F.when(inside, F.col("z_depth") + 1).otherwise(F.col("top_depth"))})
        state = stored(rest.select(*columns), "state")
    packs = functools.reduce(DataFrame.unionAll, ready)
    packs = packs.repartition(max(shuffle_parts(packs), total // PACK + 1), *comp).sortWithinPartitions(*comp)
    finished = packs.mapInArrow(_finish, "conv_id bigint, depth bigint, sum_leaves bigint, sum_saved bigint")
    return functools.reduce(DataFrame.unionAll, [finished, *done])


# -- the trie ------------------------------------------------------------------------------------------

def trie(convs: DataFrame, turns: DataFrame, small: int = SMALL) -> DataFrame:
    """All nodes: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256.

    `convs`: (conv_id, n_turns), each once, turnless ones too; `turns`: the rows of `numbered`.
    Without conversations there is no node. Copies of a conversation, however many, meet only in
    counts, minima and the digest of their ids. Equal turns are told by 128 bits of hash.
    """
    paths = stored(_paths(convs, turns), "paths")
    weight = F.sum(F.col("n_turns") - F.col("depth") + 1).alias("weight")
    key = ["depth", "p1", "p2"]
    nodes = paths.groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("chars").alias("chars"), F.min("q1").alias("q1"), F.min("q2").alias("q2"), weight)
    zero = F.lit(0).cast("bigint")
    roots = convs.select("conv_id", "n_turns", zero.alias("depth")).groupBy("depth").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), weight).select(
        "depth", *[zero.alias(c) for c in ("p1", "p2")], "conv_id", "n_convs", *[zero.alias(c) for c in ("chars", "q1", "q2")], "weight")
    nodes = stored(nodes.unionByName(roots), "nodes")
    known = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_id"))
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(F.count("*").alias("n_children"))
    nodes = nodes.filter("depth > 0").join(known, ["depth", "q1", "q2"]).unionByName(nodes.filter("depth = 0").withColumn("parent_id", F.lit(None).cast("bigint")))
    nodes = nodes.join(children, key, "left").withColumn("n_children", F.coalesce("n_children", zero))
    nodes = stored(nodes.select(*key, "conv_id", "parent_id", "n_convs", "n_children", "weight", (F.col("n_children") == 0).cast("bigint").alias("n_leaves"),
                                ((F.col("n_convs") - 1) * F.col("chars")).alias("saved")), "linked")
    # The nodes along the paths of the conversations that stand for a node.
    own = nodes.select("conv_id").distinct()
    steps = paths.select("conv_id", *key).join(own, "conv_id", "left_semi").join(nodes.select(*key, F.col("conv_id").alias("node_id"), "parent_id"), key)
    sums = rolled_up(nodes, stored(steps.select("conv_id", "depth", "node_id", "parent_id"), "steps"), small)
    ends = paths.filter("depth = n_turns").select(*key, "conv_id")
    ends = ends.unionByName(convs.filter("n_turns = 0").select(*[zero.alias(c) for c in key], "conv_id"))
    out = nodes.join(ends_of(ends), key, "left").join(sums, ["conv_id", "depth"])
    return out.select("conv_id", "depth", F.col("parent_id").alias("parent_conv_id"), "n_convs", "n_children", F.col("sum_leaves").alias("n_leaves"),
                      F.col("sum_saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"))


def prefix_trie(conversations: DataFrame, small: int = SMALL, **columns: str) -> DataFrame:
    """The trie of conversations as they are in a table (columns by name, see `numbered`)."""
    turns = stored(numbered(conversations, **columns), "numbered")
    return trie(turns.groupBy("conv_id").agg(F.count("*").alias("n_turns")), turns, small)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, rebuilt as their families share their first turns."""
    convs, turns = rebuilt(numbered(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
    return trie(convs, turns)


_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(conv_id::VARCHAR, ''),
  lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))), lambda a, b: xor(xor(a, b) >> 1, 3988292384 * (xor(a, b) & 1))), 4294967295)"""
ORACLE = f"""
WITH own AS (
  SELECT conv_id, list(md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) ORDER BY turn NULLS FIRST, role, text) AS keys,
    list(length(coalesce(text, ''))::BIGINT ORDER BY turn NULLS FIRST, role, text) AS chars
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
),
shares AS (SELECT *, ({_CRC} % {SHARED})::BIGINT AS h FROM own),
whole AS (
  SELECT a.conv_id, list_concat(coalesce(b.keys, [])[1:a.h], a.keys[a.h + 1:]) AS keys, list_concat(coalesce(b.chars, [])[1:a.h], a.chars[a.h + 1:]) AS chars
  FROM shares a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % {FAMILY}
),
paths AS (
  SELECT conv_id, depth, len(keys) AS n_turns, array_to_string(keys[1:depth], ',') AS key, array_to_string(keys[1:depth - 1], ',') AS parent_key,
    coalesce(chars[depth], 0) AS chars
  FROM (SELECT *, unnest(generate_series(0, len(keys)::BIGINT)) AS depth FROM whole)
),
nodes AS (
  SELECT depth, key, min(conv_id) AS conv_id, count(*)::BIGINT AS n_convs, any_value(parent_key) AS parent_key, any_value(chars) AS chars,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n_turns = depth), '')) AS ends_sha256
  FROM paths GROUP BY depth, key
),
children AS (SELECT depth - 1 AS depth, parent_key AS key, count(*)::BIGINT AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
full_nodes AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children, p.conv_id AS parent_conv_id
  FROM nodes n LEFT JOIN children c ON c.depth = n.depth AND c.key = n.key
  LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.key = n.parent_key AND n.depth > 0
),
sums AS (
  SELECT a.depth, a.key, sum((n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum((n_convs - 1) * n.chars)::BIGINT AS saved_tokens
  FROM full_nodes n JOIN paths a ON a.conv_id = n.conv_id AND a.depth <= n.depth GROUP BY ALL
)
SELECT n.conv_id, n.depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM full_nodes n JOIN sums s ON s.depth = n.depth AND s.key = n.key
"""
