"""Operators 11, 12 and 13 against brute force, their oracle SQL and edge cases."""

import hashlib
import os
import zlib
from collections import Counter, defaultdict
from functools import reduce

import duckdb
import numpy as np
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reshift.llm import lines, negatives, queries, trie
from tests.conftest import SF_MEDIUM, SF_SMALL

SPACE = " \t\n\x0b\x0c\r"


# -- op 11 ------------------------------------------------------------------------------------

def line_key(line, least):
    key = "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))
    return key if len(key) >= least else None


def cut_lines(rows, least=10, docs=3):
    """(doc_id, kept text, n_lines, n_dropped) of every (doc_id, text); a null id is the least one."""
    low = float("-inf")
    held, keeper = Counter(), {}
    for doc_id, text in rows:
        for key in {line_key(x, least) for x in (text or "").split("\n")} - {None}:
            held[key] += 1
            keeper[key] = max(keeper.get(key, low), low if doc_id is None else doc_id)
    out = []
    for doc_id, text in rows:
        mine = low if doc_id is None else doc_id
        all_lines = (text or "").split("\n")
        kept = [x for x in all_lines if held[line_key(x, least)] < docs or keeper[line_key(x, least)] == mine]
        out.append((doc_id, "\n".join(kept), len(all_lines), len(all_lines) - len(kept)))
    return sorted(out, key=repr)


def spark_lines(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = lines.drop_repeated_lines(df, 10, 3, **options).select("doc_id", "text", "line_dedup.*").collect()
    return sorted(map(tuple, out), key=repr)


def pages(n, seed=5):
    rng = np.random.default_rng(seed)
    common = [f"{'ÀB'[i % 2]}line number {i} of the common stock É{i}" for i in range(12)]
    rows = []
    for i in range(n):
        body = [f"own line {i} {j} with words" for j in range(rng.integers(0, 4))]
        body += [rng.choice(common[:rng.integers(1, 13)]) for _ in range(rng.integers(0, 6))]
        body = [x.upper() if x.isascii() and rng.random() < 0.2 else f" \t{x}\r" if rng.random() < 0.2 else x for x in body]
        rng.shuffle(body)
        rows.append((int(i), "\n".join(body)))
    return rows


@pytest.mark.parametrize(("batches", "fanout"), [(1, 2), (5, 2)])
def test_lines_equal_brute_force(spark, batches, fanout):
    rows = pages(150)
    assert spark_lines(spark, rows, batches=batches, fanout=fanout) == cut_lines(rows)


def test_lines_edge_cases(spark):
    shared = "a line that all of them hold"
    rows = [(1, None), (2, ""), (3, "\n\n"), (None, shared), (None, f"{shared}\nown"), (7, shared), (7, f"x\n{shared}\n{shared}"),
            (7, shared), (4, f"{shared}\n  {shared.upper()}\t"), (5, "É" * 9), (6, "É" * 10), (8, "É" * 10), (9, "é" * 10),
            (10, "ÉÉÉÉÉÉÉÉÉK"), (11, "ÉÉÉÉÉÉÉÉÉk"), (12, "ÉÉÉÉÉÉÉÉÉK"), (13, "ÉÉÉÉÉÉÉÉÉk"), (14, "word " * 40_000 + "\n" + shared)]
    got = spark_lines(spark, rows)
    assert got == cut_lines(rows)
    assert (7, "x", 3, 2) in got  # 14 keeps the line
    only_null = [(None, shared)] * 4
    assert spark_lines(spark, only_null) == cut_lines(only_null) == [(None, shared, 1, 0)] * 4
    assert spark_lines(spark, []) == []


def test_lines_other_columns_and_long_documents(spark):
    text = "\n".join(f"a line with the number {i % 700}" for i in range(5_000))
    rows = [(i, text, f"cut{i}", i, "a") for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, cut string, h1 int, Line_Dedup string")
    out = lines.drop_repeated_lines(df, 10, 3)
    assert out.columns == [*df.columns, "_line_dedup"]
    assert {(r["doc_id"], r["cut"], r["h1"], len(r["text"]), r["_line_dedup"]["n_dropped"]) for r in out.collect()} == {
        (i, f"cut{i}", i, len(text) if i == 3 else 0, 0 if i == 3 else 5_000) for i in range(4)}


def test_runs_are_disjoint_levels(spark):
    runs = lines.Runs(spark, 4, 2)
    seen, docs = {}, Counter()
    for b, keys in enumerate([range(0, 40), range(20, 70), range(10, 90, 3), range(0, 100, 7), range(95, 99)]):
        rows = [(k, -k, 1 + k % 3, 100 - b) for k in keys]
        runs.add(spark.createDataFrame(rows, "h1 long, h2 long, docs long, keeper long"))
        for k, _, n, keeper in rows:
            seen.setdefault(k, keeper)
            docs[k] += n
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    held = reduce(DataFrame.union, [run for level in runs.levels for run in level]).collect()
    assert len(held) == len(seen) and {r["h1"]: r["keeper"] for r in held} == seen
    heavy = {r["h1"]: r["keeper"] for r in runs.heavy(4).collect()}
    assert heavy == {k: seen[k] for k, n in docs.items() if n >= 4}
    plan = runs.levels[2][0].join(runs.levels[0][0].hint("merge"), ["h1", "h2"], "left_anti")._jdf.queryExecution().toString()
    assert "Exchange" not in plan.split("== Physical Plan ==")[1]  # runs meet in their buckets
    runs.forget()


def test_lines_stay_in_the_jvm(spark):
    plan = queries.op11_sorted_runs(spark, SF_SMALL)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# -- op 12 ------------------------------------------------------------------------------------

def trie_of(rows):
    """Every node by brute force; rows are (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(turns)] for c, turns in own.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = tuple(own.get(c - c % 100, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    below = {}
    for node in sorted(members, key=len, reverse=True):
        saved = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        kids = [below[k] for k in children[node]]
        below[node] = (sum(k[0] for k in kids) or 1, saved + sum(k[1] for k in kids))
    out = []
    for node, ids in members.items():
        ends = ",".join(str(c) for c in sorted(ids) if len(whole[c]) == len(node))
        out.append((min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), len(children[node]), *below[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


TURNS = "conv_id long, turn long, role string, text string"


def spark_trie(spark, rows, **options):
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    return sorted(map(tuple, trie.prefix_trie(df, **options).collect()), key=repr)


def talks(n, deep, seed=2):
    rng = np.random.default_rng(seed)
    rows = []
    for c in rng.choice(400, n, replace=False):
        length = deep if c % 9 == 0 else rng.integers(1, 9)
        rows += [(int(c), int(t), "user" if t % 2 else "bot", f"t{rng.integers(0, 2) if t < 7 else t}" * int(1 + t % 3))
                 for t in range(length)]
    return rows


@pytest.mark.parametrize("small", [2, 20_000])
def test_trie_equals_brute_force(spark, small):
    rows = talks(70, 30)
    assert spark_trie(spark, rows, small=small) == trie_of(rows)


def test_trie_of_one_chain_takes_few_levels(spark, monkeypatch):
    rows = [(c, t, "user", f"turn {t}") for c, n in ((0, 300), (1, 120), (2, 300)) for t in range(n)]
    levels = []
    split = trie._split
    monkeypatch.setattr(trie, "_split", lambda *a: levels.append(1) or split(*a))
    assert spark_trie(spark, rows, small=40) == trie_of(rows)
    assert len(levels) <= 4  # 300 nodes are halved to 40


def test_trie_edge_cases(spark):
    rows = [(None, 1, "user", "x"), (5, None, None, None), (5, None, "user", "b"), (5, 1, None, "z"), (5, 1, "a", None),
            (5, 1, "a", None), (100, 0, "u", "ab"), (100, 1, "u", "c"), (101, 0, "u", "zz"), (199, 3, "u", "é" * 1000),
            (301, 0, "u", "q"), (-7, 0, "u", "negative"), (-107, 2, "u", "below")]
    assert spark_trie(spark, rows, small=2) == trie_of(rows)
    assert spark_trie(spark, []) == []
    lone = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 1)
    assert spark_trie(spark, [(lone, 0, "u", "x")]) == [(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())]
    other = spark.createDataFrame([(1, 0, "u", "x", 4, "a")], f"{TURNS}, depth int, owner string")
    assert trie.prefix_trie(other).count() == len(trie_of([(1, 0, "u", "x")]))


def test_many_ends_of_one_node(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 8)
    rows = [(c, 0, "u", "same") for c in range(0, 30_000, 100)]
    assert spark_trie(spark, rows) == trie_of(rows)


# -- op 13 ------------------------------------------------------------------------------------

def mine(rows, every=50):
    """(anchor, positive, rank, negative, scores) by brute force; rows are (vec_id, label, vector)."""
    best = {}
    for vec_id, label, v in rows:
        if vec_id is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        kept = (label, [int(np.floor(float(x) * 256)) for x in v])
        best[vec_id] = min(best.get(vec_id, kept), kept)
    out = []
    for a, (label, v) in best.items():
        if a % every:
            continue
        scores = [(sum(x * y for x, y in zip(v, w, strict=True)), i, other) for i, (other, w) in best.items()
                  if i != a and len(w) == len(v)]
        scores.sort(key=lambda s: (-s[0], s[1]))
        for p, pid, _ in [s for s in scores if s[2] == label][:5]:
            hard = [s for s in scores if s[2] != label and 50 * p <= 100 * s[0] <= 95 * p][:3]
            out += [(a, pid, rank, nid, p, n) for rank, (n, nid, _) in enumerate(hard, 1)]
    return sorted(out)


VECTORS = "vec_id long, label int, embedding array<float>"


def spark_mine(spark, rows, every=50, **options):
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    out = negatives.hard_negatives(df, F.col("vec_id") % every == 0, **options)
    return sorted(map(tuple, out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()))


def test_negatives_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 8))
    rows = [(i, int(rng.integers(0, 3)), (centres[rng.integers(0, 6)] + rng.normal(size=8) * 0.3).astype(np.float32).tolist())
            for i in range(500)]
    expected = mine(rows, 10)
    assert len(expected) > 300
    assert spark_mine(spark, rows, 10) == expected
    assert spark_mine(spark, rows, 10, block=60, anchor_block=7) == expected


def test_negatives_ties_repeats_and_gaps(spark):
    rng = np.random.default_rng(4)
    rows = [(i, i % 3, [float(x) for x in rng.integers(-2, 3, 4) / 4]) for i in range(120)]  # many equal scores
    rows += [(None, 1, [1.0] * 4), (500, None, [1.0] * 4), (501, 1, None), (502, 1, [1.0, None, 0.0, 0.0]),
             (503, 1, [float("nan")] * 4), (504, 2, [float("inf")] * 4), (0, 2, [1.0, 1.0, 1.0, 1.0]), (50, 0, [0.0] * 4),
             (50, 0, [0.0] * 4), (600, 1, [0.5, 0.5]), (601, 1, [0.5, 0.5]), (602, 2, [0.4, 0.5]), (650, 1, []), (651, 1, []),
             (652, 2, []), (700, 4, [3e38, 1.0, 0.0, 0.0])]
    expected = mine(rows)
    assert {a for a, *_ in expected} >= {0, 50, 600, 650}
    assert spark_mine(spark, rows) == expected
    assert spark_mine(spark, rows, block=20) == expected
    assert spark_mine(spark, []) == []


def test_threshold_stops_early():
    rng = np.random.default_rng(7)
    v = np.floor(rng.normal(size=(4_000, 4)) * 20)
    v[::50] = v[::50] + 200
    lists = negatives.Lists(np.arange(4_000), rng.integers(0, 2, 4_000), v)
    read = []
    whole = negatives.scored
    negatives.scored = lambda m, a: read.append(len(m)) or whole(m, a)
    try:
        top = lists.top(0, int(lists.labels[0]), lists.v[0], True, [(negatives.LONG.min, negatives.LONG.max)], 5)
    finally:
        negatives.scored = whole
    assert sum(read) < 1_000 and len(top[0]) == 5
    assert whole(np.array([[2.0 ** 40, 3.0]]), np.array([2.0 ** 22, 1.0]))[0] == 2 ** 62 + 3  # exact beyond doubles


# -- oracle SQL -------------------------------------------------------------------------------

@pytest.mark.parametrize("name", ["op11_sorted_runs", "op12_centroid_trie", "op13_threshold_negatives"])
def test_new_oracles(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_MEDIUM, t)}.parquet')")
    answer = con.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in answer.description]
    found = queries.queries()[name](spark, SF_MEDIUM)
    assert sorted(found.columns) == sorted(columns)
    assert sorted(map(tuple, found.select(*columns).collect()), key=repr) == sorted(answer.fetchall(), key=repr)
