"""Nearest vectors, dataset trees and fill-in-the-middle samples against plain versions, and on odd cases."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tables import multiset, odd_rows, odd_table, plain

from undercut.llm import fill_middle, merkle, nearest

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


# Fill in the middle


def sample(doc_id, text):
    text, name = text or "", "" if doc_id is None else str(doc_id)
    digest = hashlib.sha256(f"1:{name}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(text) + 1), h[1] % (len(text) + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (doc_id, len(text), "plain", None, None, text, text)
    if h[3] % 100 < 20:
        return (doc_id, len(text), "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}", text)
    return (doc_id, len(text), "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}", text)


def test_samples_match_a_plain_version(spark):
    rng = random.Random(5)
    rows = odd_rows() + [(100 + i, "".join(rng.choice("a<PSM>\n\r$1\\\U0001f600é ") for _ in range(i))) for i in range(120)]
    made = fill_middle.transform(odd_table(spark, rows))
    back = made.withColumn("back", fill_middle.restored(F.col("output")))
    assert multiset(back.collect()) == multiset([sample(*row) for row in rows])
    assert {row.form for row in made.collect()} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("n", [0, 1, fill_middle.BLOCK - 1, fill_middle.BLOCK, 3 * fill_middle.BLOCK + 5])
def test_units_are_code_points(spark, n):
    df = spark.createDataFrame([("\U0001f600" * n,)], "t string")
    assert df.select(fill_middle.unit_count(F.col("t"))).first()[0] == n


def test_no_documents_no_samples(spark):
    assert fill_middle.transform(plain(spark, [])).count() == 0


# Dataset trees


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = [*row[:4], text]
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def reduced(nodes):
    """The root of nodes and each one's siblings up to it."""
    proofs, groups = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [nodes[k : k + 3] for k in range(0, len(nodes), 3)]
        for k, run in enumerate(runs):
            for j in range(len(run)):
                for i in groups[3 * k + j]:
                    proofs[i] += run[:j] + run[j + 1 :]
        groups = [sum(groups[k : k + 3], []) for k in range(0, len(nodes), 3)]
        nodes = [digest(*run) for run in runs]
    return nodes[0], proofs


def tree(rows):
    """(doc_id, leaf, subroot, root, proof) of each row."""
    by = defaultdict(list)
    for row in rows:
        by[row[1]].append((row[0], leaf(row, row[4])))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for found in by.values():
        found.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    subs = {s: reduced([h for _, h in by[s]]) for s in order}
    root, tops = reduced([subs[s][0] for s in order])
    return [
        (i, h, subs[s][0], root, "".join(proof + top))
        for s, top in zip(order, tops)
        for (i, h), proof in zip(by[s], subs[s][1])
    ]


def documents(spark, rows):
    return spark.createDataFrame(
        [(*row, "r", "p") for row in rows], "doc_id long, source string, lang string, n_chars long, text string, root string, path string"
    )


def planted(sizes, texts="line\nend"):
    rng, rows = random.Random(3), []
    for source, n in sizes.items():
        rows += [(rng.randrange(10**6), source, "en", n, f"{texts} {i}") for i in range(n)]
    return rows


@pytest.mark.parametrize(
    "rows",
    [
        planted({"a": 1}),
        planted({None: 4, "": 1, "a": 3, "b": 28, "é": 9, "z": 10}),
        planted({f"s{i}": 1 + i % 3 for i in range(11)}),
        [(i, None, None, None, None) for i in (1, 1, None, None)] + [(1, "x", "en", 3, "1\n2")] * 5,
        [(i, "h", "en", 1, t) for i, t in odd_rows()],
    ],
    ids=["one", "sizes", "small groups", "repeats and nulls", "odd texts"],
)
def test_trees_match_a_plain_version(spark, rows):
    found = merkle.manifest(documents(spark, rows), FIELDS, carry={"doc_id": F.col("doc_id")})
    found = found.select("doc_id", "leaf", "subroot", "root", merkle.siblings(F.col("path")))
    assert multiset(found.collect()) == multiset(tree(rows))


def test_a_changed_leaf_folds_to_another_root(spark):
    rows = planted({"a": 13, "b": 2, "c": 1})
    shown = F.when(F.col("doc_id") % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    carry = {"doc_id": F.col("doc_id"), "shown": merkle.leaf(*(F.col(c) for c in FIELDS[:-1]), shown)}
    found = merkle.manifest(documents(spark, rows), FIELDS, carry=carry)
    for row in found.select("doc_id", "root", merkle.folded(F.col("shown"), F.col("path")).alias("back")).collect():
        assert (row.back == row.root) == (row.doc_id % 2 == 1)


def test_other_arities_and_no_rows(spark):
    rows = planted({"a": 7})
    (two,) = {r.root for r in merkle.manifest(documents(spark, rows), FIELDS, arity=2).collect()}
    nodes = [h for _, h in sorted((r[0], leaf(r, r[4])) for r in rows)]
    while len(nodes) > 1:
        nodes = [digest(*nodes[k : k + 2]) for k in range(0, len(nodes), 2)]
    assert nodes == [two]
    empty = merkle.manifest(documents(spark, []), FIELDS, carry={"doc_id": F.col("doc_id")})
    assert empty.columns == ["leaf", "subroot", "root", "path", "doc_id"] and empty.count() == 0


# Nearest vectors


def vectors(spark, rows, kind="float"):
    return spark.createDataFrame([(*row, "n", 1) for row in rows], f"vec_id long, embedding array<{kind}>, name string, rank int")


def searched(spark, rows, k, kind="float"):
    found = defaultdict(list)
    for r in nearest.search(vectors(spark, rows, kind), F.col("vec_id") % 20 == 0, k).collect():
        found[r.query_id].append((r.rank, r.vec_id, r.score))
    return {q: [(i, s) for _, i, s in sorted(of)] for q, of in found.items()}


def brute(rows, k, kind=np.float32):
    kept = [(i, np.array(v, kind).astype(float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    best = {}
    for q, x in kept:
        if q % 20 == 0:
            scores = {}
            for i, y in kept:
                if i != q:
                    scores[i] = max(scores.get(i, -np.inf), float((x * y).sum()))
            best[q] = sorted(scores.items(), key=lambda p: (-p[1], p[0]))[:k]
    return best


def scattered(n, d=16, seed=1, scale=False):
    rng = np.random.default_rng(seed)
    points = rng.normal(size=(n, d)).astype(np.float32)
    if scale:
        points *= rng.lognormal(size=(n, 1)).astype(np.float32)
    return [(i, p.tolist()) for i, p in enumerate(points)]


@pytest.mark.parametrize("scale", [False, True])
def test_recall_and_scores(spark, monkeypatch, scale):
    monkeypatch.setattr(nearest, "LIST_SIZE", 32)
    monkeypatch.setattr(nearest, "BLOCK", 16)
    monkeypatch.setattr(nearest, "QUERY_BLOCK", 4)
    rows = scattered(1500, scale=scale)
    found, expect = searched(spark, rows, 10), brute(rows, 10)
    assert set(found) == set(expect) and all(len(f) == 10 for f in found.values())
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in expect[q]}) for q in expect)
    assert hits >= 0.9 * 10 * len(expect)
    points = {i: np.array(v) for i, v in rows}
    for q, of in found.items():
        assert all(np.isclose(s, points[q] @ points[i], rtol=1e-12) for i, s in of)
        assert of == sorted(of, key=lambda p: (-p[1], p[0]))


def test_copies_ties_and_vectors_that_take_no_part(spark):
    same = [1.0, 2.0, 0.0]
    rows = [(i, same) for i in range(200)] + [(i, [3.0, 1.0, -0.0]) for i in range(200, 230)]
    rows += [(300, None), (301, [0.0, 0.0, 0.0]), (320, [None, 1.0, 1.0]), (340, [float("nan"), 1.0, 1.0]), (360, [float("inf"), 0.0, 0.0])]
    rows += [(None, same), (221, [0.0, 0.0, 5.0]), (41, same)]
    assert searched(spark, rows, 20) == brute(rows, 20)
    doubles = [(i, [0.1 * i, 1.0 / (i + 1), 0.3]) for i in range(50)]
    found, expect = searched(spark, doubles, 20, "double"), brute(doubles, 20, np.float64)
    assert {q: [i for i, _ in of] for q, of in found.items()} == {q: [i for i, _ in of] for q, of in expect.items()}


def test_few_or_no_candidates(spark):
    assert searched(spark, [], 20) == {}
    assert searched(spark, [(20, None)], 20) == {}
    assert searched(spark, [(20, [1.0])], 20) == {}
    assert searched(spark, [(20, [1.0]), (1, [2.0]), (40, [-1.0])], 20) == {20: [(1, 2.0), (40, -1.0)], 40: [(20, -1.0), (1, -2.0)]}


def test_members_of_a_large_query_class_all_answer(spark):
    rows = [(20 * i, [1.0, 0.0]) for i in range(9000)] + [(1, [0.5, 0.5])]
    found = nearest.search(vectors(spark, rows), F.col("vec_id") % 20 == 0, 3)
    counts = Counter(r["count"] for r in found.groupBy("query_id").count().collect())
    assert counts == {3: 9000}
    assert found.where("vec_id = query_id").count() == 0


def test_graph_search_finds_the_nearest_centre():
    points = np.random.default_rng(0).normal(size=(4000, 12))
    lifted = nearest._lift(points, float(np.linalg.norm(points, axis=1).max()))
    centres = nearest.balanced_centres(lifted, 256)
    index = nearest.Index(centres, nearest.centre_graph(centres), 1.0, "<f4")
    seen, least = nearest.nearest_centres(lifted[:500], index, 1.1)
    true = np.sqrt(np.square(lifted[:500, None] - centres[None]).sum(axis=2)).min(axis=1)
    assert np.isclose(least, true, rtol=1e-5).mean() > 0.97


class Looked:
    """A graph that counts how often it is looked up."""

    def __init__(self, graph):
        self.graph, self.rounds = graph, 0

    def __getitem__(self, nodes):
        self.rounds += 1
        return self.graph[nodes]


def test_graph_search_ends_when_all_is_seen_and_takes_few_rounds():
    points = np.random.default_rng(0).normal(size=(8192, 64))
    points /= np.linalg.norm(points, axis=1)[:, None]
    lifted = nearest._lift(points, 1.0)
    centres = nearest.balanced_centres(lifted, 512)
    index = nearest.Index(centres, Looked(nearest.centre_graph(centres)), 1.0, "<f4")
    seen, least = nearest.nearest_centres(lifted[:200], index, 1.15)
    assert index.graph.rounds <= 12  # 71 before
    true = np.sqrt(np.square(lifted[:200, None] - centres[None]).sum(axis=2))
    assert np.allclose(least, true.min(axis=1), rtol=1e-5)
    inside = true <= true.min(axis=1, keepdims=True) * 1.15 * 0.9999
    assert np.isfinite(seen[inside]).mean() > 0.99  # some centres have no edge from a near one


def test_boundary_lists_follow_the_rule(monkeypatch):
    monkeypatch.setattr(nearest, "BOUNDARY", 1.6)
    rng = np.random.default_rng(5)
    centres, points = rng.normal(size=(40, 3)).astype(np.float32), rng.normal(size=(500, 3)).astype(np.float32)
    seen = np.sqrt(np.square(points[:, None] - centres).sum(axis=2))
    seen[rng.random(seen.shape) < 0.2] = np.inf
    expect = []
    for far in seen:
        chosen = []
        for j in np.argsort(far, kind="stable"):
            apart = all(np.square(centres[j] - centres[m]).sum() > far[j] ** 2 for m in chosen)
            if far[j] <= far.min() * 1.6 and len(chosen) < nearest.COPIES and apart:
                chosen.append(j)
        expect.append(chosen)
    assert nearest.boundary_lists(seen, seen.min(axis=1), nearest.squared_between(centres)) == expect
    assert {len(lists) for lists in expect} >= {1, 2, 3}


@pytest.mark.parametrize("scale", [1.0, 1e-200, 1e120])
def test_best_of_blocks(monkeypatch, scale):
    rng, k = np.random.default_rng(6), 5
    vectors = rng.integers(-3, 4, size=(900, 4)).astype(float)  # many ties
    vectors[:, 0] += 4
    vectors[::7] *= 100
    ids = [sorted(rng.choice(600, rng.integers(1, 4), replace=False).tolist()) for _ in vectors]  # also in several vectors
    queries, names = rng.integers(-3, 4, size=(30, 4)).astype(float) + [4, 0, 0, 0], [bytes([i]) for i in range(30)]
    best = nearest.Best(k)
    for at in range(0, 900, 60):
        best.meet(names, queries, vectors[at : at + 60] * scale, pa.array(ids[at : at + 60], pa.list_(pa.int64())))
        best.waiting += 1 << 16  # cut at each block
    found = defaultdict(list)
    for row in best.scored().to_pylist():
        found[row["query"]].append((row["score"], row["vec_id"]))
    for name, query in zip(names, queries):
        scores = {}
        for vector, of in zip(vectors * scale, ids):
            for i in of:
                scores[i] = max(scores.get(i, -np.inf), float(nearest.inner_products(query[None], vector[None])[0]))
        assert sorted(found[name], key=lambda p: (-p[0], p[1])) == sorted(((s, i) for i, s in scores.items()), key=lambda p: (-p[0], p[1]))[:k]
    assert best.scored().num_rows == 0


def test_exact_products_are_taken_of_few_pairs(monkeypatch):
    taken, exact = [], nearest.inner_products
    monkeypatch.setattr(nearest, "inner_products", lambda q, v: taken.append(len(q)) or exact(q, v))
    rng = np.random.default_rng(7)
    vectors, queries = rng.normal(size=(8000, 16)), rng.normal(size=(100, 16))
    best = nearest.Best(10)
    for at in range(0, 8000, 500):
        best.meet([bytes([i]) for i in range(100)], queries, vectors[at : at + 500], pa.array([[i] for i in range(at, at + 500)]))
    got = best.scored().to_pylist()
    true = queries @ vectors.T
    assert {(r["query"][0], r["vec_id"]) for r in got} == {(q, i) for q in range(100) for i in np.argsort(-true[q])[:10].tolist()}
    assert sum(taken) < 0.05 * 100 * 8000  # all pairs before


def test_registered_queries(spark):
    from undercut.llm.queries import QUERIES

    tables = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{tables}/embeddings.parquet").collect()]
    expect, hits = brute(rows, 20), 0
    found = defaultdict(set)
    for r in QUERIES["op11_posting_lists"](spark, tables).collect():
        found[r.query_id].add(r.vec_id)
    for q, of in expect.items():
        hits += len(found[q] & {i for i, _ in of})
    assert hits >= 0.9 * 20 * len(expect)

    docs = {r.doc_id: r for r in spark.read.parquet(f"{tables}/documents.parquet").select(*FIELDS).collect()}
    trees = {i: rest for i, *rest in tree([tuple(r) for r in docs.values()])}
    for r in QUERIES["op12_merkle_manifest"](spark, tables).collect():
        *expect, proof = trees[r.doc_id]
        assert [r.leaf, r.subroot, r.root] == expect and r.proof_sha256 == hashlib.sha256(proof.encode()).hexdigest()
        changed = zlib.crc32(str(r.doc_id).encode()) % 2 == 0 and "\n" in (docs[r.doc_id].text or "")
        assert r.verified == (not changed) == (r.folded_root == r.root)
    for r in QUERIES["op13_fill_in_middle"](spark, tables).collect():
        *expect, output, text = sample(r.doc_id, docs[r.doc_id].text)
        assert [*r[:5]] == expect
        assert (r.output_sha256, r.restored_sha256) == tuple(hashlib.sha256(t.encode()).hexdigest() for t in (output, text))
