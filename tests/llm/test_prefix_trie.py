import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tellmark.llm import prefix_trie as pt

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows, share):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    whole = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = own.get(c - int(np.fmod(c, 100)), [])
        whole[c] = base[:h] + ts[h:] if share else ts
    nodes = {}
    for c, ts in whole.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(tuple(ts[:d]), []).append(c)
    children = {k: 0 for k in nodes}
    for k in nodes:
        if k:
            children[k[:-1]] += 1
    leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for k, members in nodes.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += children[k] == 0
            saved[k[:d]] += (len(members) - 1) * len(k[-1][1]) if k else 0
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted((min(m), len(k), min(nodes[k[:-1]]) if k else -1, len(m), children[k], leaves[k], saved[k], sha([c for c in m if len(whole[c]) == len(k)])) for k, m in nodes.items())


def result(df):
    assert df.columns == COLUMNS
    return sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in df.collect())


def table(seed, n=150):
    rng = np.random.default_rng(seed)
    rows = [(int(c), t, "user" if t % 2 else None, "x" * int(rng.integers(1, 4))) for c in rng.permutation(300)[:n] for t in range(int(rng.integers(1, 9)))]
    rows += [(c, t, "user", f"long {t}") for c in (1001, 1002) for t in range(60)]  # deep
    rows += [(c, t, "user", f"copy {t}") for c in range(2000, 2100) for t in range(3)]  # copies
    rows += [(3000, None, None, None), (3000, 4, "", ""), (3000, 4, "", ""), (3000, 5, "a", "b"), (None, 1, "a", "b"), (-205, 1, "a", "b"), (-200, 1, "a", "c"), (7, 1, "é", "漢😀")]
    return rows


@pytest.mark.parametrize("small", [6, 4096])
def test_against_brute_force(spark, monkeypatch, small):
    rows = table(small)
    monkeypatch.setattr(pt, "STRETCH", 7)
    monkeypatch.setattr(pt, "RANGE", 16)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("depth", F.lit("x")).repartition(3)
    assert result(pt.prefix_trie(df, small=small)) == brute(rows, False)


def test_rebuilt_families(spark):
    rows = table(5)
    convs, turns = pt.rebuilt(pt.numbered(spark.createDataFrame(rows, SCHEMA)))
    assert result(pt.trie(convs, turns)) == brute(rows, True)


def test_one_long_conversation_and_one_repeated_row(spark):
    rows = [(1, t // 2, "user", f"t{t % 7}") for t in range(900)] + [(2, 1, "user", "same")] * 700 + [(c, 0, "user", "t0") for c in range(3, 60)]
    assert result(pt.prefix_trie(spark.createDataFrame(rows, SCHEMA), small=300)) == brute(rows, False)


def test_empty(spark):
    df = spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)
    assert pt.prefix_trie(df).collect() == [] and pt.prefix_trie(df.limit(0)).collect() == []


@pytest.mark.parametrize("seed", range(30))
def test_forest_totals(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 80))
    parent = np.array([-1 if rng.random() < 0.1 or not i else rng.integers(max(0, i - rng.integers(1, 9)), i) for i in range(n)])
    depth, comp = np.zeros(n, int), np.arange(n)
    for i in range(n):
        if parent[i] >= 0:
            depth[i], comp[i] = depth[parent[i]] + 1, comp[parent[i]]
    own, values = rng.integers(1, 50, n), rng.integers(0, 9, (n, 2))
    weight, want = own.copy(), values.copy()
    for i in range(n - 1, -1, -1):
        if parent[i] >= 0:
            weight[parent[i]] += weight[i]
            want[parent[i]] += want[i]
    assert (pt.split_forest(depth, parent, comp, weight, values) == want).all()


def test_packs_cut_between_components(monkeypatch):
    """A partition larger than a pack gives the same totals."""
    import pyarrow as pa
    rows = [(c, d, c if d else None, 5 - d, int(d == 4), d, c, 0, 10, 20) for c in range(40) for d in range(5)]
    names = ["conv_id", "depth", "parent_id", "weight", "n_leaves", "saved", "top_id", "top_depth", "sum_leaves", "sum_saved"]
    batch = pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], names=names)
    batches = [batch.slice(i, 7) for i in range(0, 200, 7)]
    whole = pa.Table.from_batches(pt._finish(iter(batches))).to_pylist()
    monkeypatch.setattr(pt, "PACK", 20)
    assert pa.Table.from_batches(pt._finish(iter(batches))).to_pylist() == whole
    assert [(r["sum_leaves"], r["sum_saved"]) for r in whole[:5]] == [(11, 30), (11, 30), (11, 29), (11, 27), (11, 24)]
