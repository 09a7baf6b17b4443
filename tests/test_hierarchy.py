import random

import pytest

from sessionloom.operators import hierarchy as H
from sessionloom.plans.oracle import SQL


def brute(pairs):
    parent = {}
    for u, p in pairs:
        if parent.get(u) is None:
            parent[u] = p
    out = {}
    for u in parent:
        seen, x = set(), u
        while x not in seen:
            seen.add(x)
            if parent[x] is None or parent[x] not in parent:
                out[u] = (x, len(seen) - 1)
                break
            x = parent[x]
        else:
            out[u] = ("cycle", -1)
    return out


def test_random_trees_and_cycles_in_small_blocks(spark):
    r = random.Random(4)
    n = 120
    pairs = [(f"n{i}", f"n{r.randrange(max(0, i - 3), i)}" if i and r.random() < 0.95 else None) for i in range(n)]
    pairs += [("c0", "c5"), *[(f"c{i}", f"c{i - 1}") for i in range(1, 6)], ("below", "c3"), ("self", "self"), ("orphan", "gone"), ("n3", "n2")]
    df = spark.createDataFrame([(u, p, i, "x") for i, (u, p) in enumerate(pairs)], "uuid string, parent string, at long, root_uuid string")
    got = {r.uuid: (r.root_uuid, r.depth) for r in H.hierarchy(df, "uuid", "parent", "at", block_rows=9).collect()}
    assert got == brute(pairs)


def test_ids_are_normalised_and_empty(spark):
    df = spark.createDataFrame([(" A ", None), ("b", "a"), (None, "a"), ("  ", "a"), ("b", "a")], "u string, p string")
    assert {tuple(r) for r in H.hierarchy(df, "u", "p").collect()} == {("a", "a", 0), ("b", "a", 1)}
    assert H.hierarchy(df.limit(0), "u", "p").count() == 0


def test_long_chains_below_a_cycle_across_blocks(spark):
    pairs = []
    for k in range(12):  # of a cycle's two entries one has no other child: it may be spliced in the first rounds
        pairs += [(f"{k}a", f"{k}b"), (f"{k}b", f"{k}a"), *[(f"{k}c{i}", f"{k}c{i - 1}" if i else f"{k}a") for i in range(12)]]
    pairs += [(f"x{i}", f"x{i - 1}" if i else None) for i in range(12)]
    df = spark.createDataFrame([(u, p, i) for i, (u, p) in enumerate(pairs)], "uuid string, parent string, at long")
    got = {r.uuid: (r.root_uuid, r.depth) for r in H.hierarchy(df, "uuid", "parent", "at", block_rows=1).collect()}
    assert got == brute(pairs)


def test_entries_in_small_blocks_are_as_the_sql_says(spark):
    duckdb = pytest.importorskip("duckdb")
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view claude_entries as select * from '{sf}/claude_entries.parquet'")
    want = sorted(con.execute(SQL["p5_found"]).fetchall())
    links = H.entry_parents(spark.read.parquet(f"{sf}/claude_entries.parquet"))
    assert sorted(tuple(r) for r in H.hierarchy(links, "uuid", "parent", "row_id", block_rows=40).collect()) == want


def test_paths_and_descendants(spark):
    r = random.Random(7)
    pairs = [(f"n{i}", f"n{r.randrange(max(0, i - 3), i)}" if i else None) for i in range(90)]
    pairs += [("c0", "c1"), ("c1", "c0"), ("below", "c1"), ("orphan", "gone"), ("under", "orphan")]
    df = spark.createDataFrame([(u, p, i) for i, (u, p) in enumerate(pairs)], "uuid string, parent string, at long")
    parent = dict(pairs)
    want = {}
    for u, (root, depth) in brute(pairs).items():
        want[u] = [u][: depth + 1]
        while depth >= 0 and want[u][0] != root:
            want[u].insert(0, parent[want[u][0]])
    pieces = H.paths(df, "uuid", "parent", "at", block_rows=9, piece_ids=4, piece_block=20).cache()
    got, roots = {}, {}
    for x in sorted(pieces.collect(), key=lambda x: x.first_depth):
        assert len(x.path) <= 4 and x.first_depth == (len(got.get(x.uuid, [])) if x.depth >= 0 else -1)
        got[x.uuid] = got.get(x.uuid, []) + x.path
        roots[x.uuid] = (x.root_uuid, x.depth)
    assert got == want and roots == brute(pairs)
    below = sorted((a, u, len(p) - 1 - i) for u, p in want.items() for i, a in enumerate(p[:-1]))
    assert sorted(tuple(x) for x in H.descendants(pieces).collect()) == below
    assert H.paths(df.limit(0), "uuid", "parent").count() == 0
