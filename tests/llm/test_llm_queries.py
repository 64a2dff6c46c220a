"""The registered corpus queries and the pipeline over the smallest tables, against the contracts."""

import hashlib
import os
import sys
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

import corpus_pipeline  # noqa: E402
from __spark_entry__ import queries  # noqa: E402
from check import compare, open_tables  # noqa: E402
from undercut.llm.oracles import ORACLES  # noqa: E402
from undercut.llm.queries import QUERIES  # noqa: E402
from undercut.shared import materialise  # noqa: E402

TABLES = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(TABLES), reason="test tables are absent")


def read(spark, name):
    return [tuple(r) for r in spark.read.parquet(f"{TABLES}/{name}.parquet").collect()]


@pytest.fixture(scope="module")
def texts(spark):
    return {row[0]: row[1] for row in read(spark, "documents")}


def found(spark, name, *columns):
    rows = QUERIES[name](spark, TABLES).select(*columns).collect()
    return {r[0]: tuple(r[1:]) for r in rows}


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries() if n.startswith("op")) == list(range(1, 14))
    assert "pipeline" in queries() and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", ORACLES)
def test_sql(spark, name):
    rows, differences = compare(QUERIES[name](spark, TABLES), open_tables(TABLES), ORACLES[name])
    assert rows > 0 and not differences


def test_op1(spark, texts):
    rows = found(spark, "op1_personal_data", "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    assert rows == {i: brute.personal_row(t) for i, t in texts.items()}


def test_op2(spark, texts):
    windows, expect = brute.benchmark_windows(read(spark, "benchmark")), {}
    for i, t in texts.items():
        n, hit, items = brute.passages(t, windows)
        listed = ",".join(sorted(map(str, items)))
        expect[i] = (n, hit, len(items), hashlib.sha256(listed.encode()).hexdigest(), hit > 0 and 20 * hit >= n)
    assert found(spark, "op2_benchmark_passages", "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == expect


def test_op3(spark, texts):
    rows = QUERIES["op3_shard_by_bytes"](spark, TABLES).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {
        i: (len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in texts.items()
    }
    sizes = Counter()
    for r in rows:
        sizes[r.shard] += r.size
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
    assert all(abs(n - sum(sizes.values()) / 16) <= max(r.size for r in rows) for n in sizes.values())


def test_op5(spark, texts):
    ids = sorted(texts)
    roots, sizes = brute.components([texts[i] for i in ids], 2)
    rows = found(spark, "op5_near_duplicates", "doc_id", "n_shingles", "component_id", "kept")
    assert rows == {i: (sizes[k], ids[roots[k]], roots[k] == k) for k, i in enumerate(ids)}


def test_op6(spark, texts):
    names = "doc_id held_out n_tokens n_known train_tokens base_score score n_bytes".split()
    rows = found(spark, "op6_context_tree_scores", *names)
    for (i, _), row in zip(texts.items(), brute.word_scores(list(texts.items()))):
        assert rows[i][:4] == row[:4] and np.isclose(rows[i][4], row[4], rtol=1e-9)
    held = [r for r in rows.values() if r[0]]
    bits = -sum(r[5] for r in held) * np.log2(10) / sum(r[6] for r in held)
    assert bits < 2.6  # held-out bits per byte; a uniform byte takes 8


def test_op7(spark, texts):
    names = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept".split()
    rows = found(spark, "op7_quality_rules", *names)
    assert {i: r[:-1] for i, r in rows.items()} == {i: brute.measures(t) for i, t in texts.items()}
    for i, good, _ in read(spark, "labels"):
        assert rows[i][-1] == (bool(good) and not rows[i][-2])


def test_op8(spark, texts):
    library, places = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), defaultdict(list)
    pieces = defaultdict(list)
    for r in QUERIES["op8_best_fit_packing"](spark, TABLES).collect():
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        places[r.sequence_id].append((r.offset, r.length))
    total = 0
    for i, text in texts.items():
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 2], "<u4")
        first, at, expect = (len(ids) - 1) % 1024 + 1, 0, []
        for n in [first, *[1024] * ((len(ids) - first) // 1024)]:
            expect.append((len(expect), at, n, zlib.crc32(ids[at : at + n].tobytes())))
            at += n
        assert sorted(pieces[i]) == expect
        total += len(ids)
    for spots in places.values():
        ends = np.cumsum([n for _, n in sorted(spots)])
        assert [o for o, _ in sorted(spots)] == [0, *ends[:-1]] and ends[-1] <= 1024
    assert set(pieces) == set(texts) and len(places) <= -(-total // 1024) * 1.02 + 1


def test_op9(spark, texts):
    for r in QUERIES["op9_repeated_passages"](spark, TABLES).collect():
        passage = texts[r.doc_id].encode()[r.start : r.end]
        assert (r.first_doc_id, r.first_start) < (r.doc_id, r.start) and len(passage.split()) >= 16
        first = texts[r.first_doc_id].encode()[r.first_start :]
        assert os.path.commonprefix([passage, first])


def test_op10(spark, texts):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expect = {}
    for i, t in texts.items():
        n = len(library.encode(t, add_special_tokens=False).ids)
        expect[i] = (len(t.encode()), n, n > 2048)
    assert found(spark, "op10_token_counts", "doc_id", "n_bytes", "n_tokens", "over_limit") == expect


def test_pipeline_stages(spark):
    """Each stage over what the one before kept, against the contracts."""
    docs, columns = spark.read.parquet(f"{TABLES}/documents.parquet"), None
    windows, labels = brute.benchmark_windows(read(spark, "benchmark")), {r[0]: r[1] for r in read(spark, "labels")}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        columns = columns or docs.columns
        docs = materialise(stage(spark, docs, TABLES), "stage")
        rows = docs.collect()
        if name == "best-fit packing":
            assert {r.doc_id for r in rows} == set(before)
            break
        assert docs.columns == columns
        after = {r.doc_id: r for r in rows}
        assert len(after) == len(rows) and set(after) <= set(before)
        gone = set(before) - set(after)
        if name == "quality rules":
            assert {i for i, r in before.items() if brute.measures(r.text)[-1]} <= gone
            assert all((i in gone) == (not good) for i, good in labels.items() if not brute.measures(before[i].text)[-1])
        if name == "near duplicates":
            ids = sorted(before)
            roots, _ = brute.components([before[i].text for i in ids], 2)
            assert set(after) == {ids[k] for k in set(roots)}
        if name == "benchmark decontamination":
            hits = {i: brute.passages(r.text, windows) for i, r in before.items()}
            assert gone == {i for i, (n, hit, _) in hits.items() if hit and 20 * hit >= n}
        if name == "personal data":
            assert not gone and not any(brute.personal(r.text) for r in after.values())
            assert all(after[i] == r for i, r in before.items() if not brute.personal(r.text))
            assert any(after[i] != r for i, r in before.items())
        else:
            assert all(after[i] == before[i] for i in after)
    assert corpus_pipeline.run(spark, TABLES).count() == len(rows)
