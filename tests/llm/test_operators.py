"""Each corpus operator against its contract on the odd cases, and on nothing."""

import math
import os
import random
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tables import multiset, odd_rows, odd_table, plain, prose
from tokenizers import Tokenizer

from undercut import shared
from undercut.llm import (
    components,
    conversations,
    decontamination,
    language_model,
    near_duplicates,
    packing,
    personal_data,
    quality,
    sharding,
    substrings,
    token_counts,
    tokens,
)

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def benchmark(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def test_empty_tables(spark):
    none = odd_table(spark, [])
    items = benchmark(spark)
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    for result in (
        personal_data.find(none), personal_data.sanitise(none), decontamination.find_passages(none, items),
        sharding.shard_by_bytes(none), conversations.render(turns), near_duplicates.group(none), language_model.score(none),
        quality.judge(none), packing.pack(none, BYTES), substrings.repeated_passages(none), token_counts.count_tokens(none, WORDS),
    ):
        assert result.count() == 0


def test_sharding_is_contiguous_gapless_and_even(spark):
    rows = odd_rows() + [(i, prose(i, 1 + i % 60)) for i in range(100, 700)]
    laid = sharding.shard_by_bytes(odd_table(spark, rows), shards=16).collect()
    size = lambda t: len((t or "").encode()) + 1
    expect = multiset((i, size(t), zlib.crc32((t or "").encode())) for i, t in rows)
    assert multiset((r.doc_id, r.size, r.text_crc32) for r in laid) == expect
    total, order = sum(r.size for r in laid), []
    for shard in range(16):
        own = sorted((r for r in laid if r.shard == shard), key=lambda r: r.slot)
        assert [r.slot for r in own] == list(range(len(own)))
        assert abs(sum(r.size for r in own) - total / 16) <= max(r.size for r in laid)
        order += [(r.doc_id is not None, r.doc_id or 0) for r in own]
    assert order == sorted(order)


def test_quality_measures_and_carried_columns(spark):
    judged = quality.judge(odd_table(spark), carry=["doc_id", "text"]).collect()
    assert len(judged) == len(odd_rows())
    for r in judged:
        found = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert found == brute.measures(r.text)
        assert not (r.base_failed and r.kept) and 0 <= r.quality <= 1
    kept = quality.drop_rejected(odd_table(spark))
    assert kept.columns == odd_table(spark).columns and {r.own_1 for r in kept.collect()} == {"o"}


def test_quality_rejects_defects_and_keeps_prose(spark):
    loud = lambda t: " ".join(w.upper() + "!!" for w in t.split())
    junk = lambda t: " ".join(w + "$$$" for w in t.split())
    sentences = lambda s: " ".join(prose(s * 100 + i, 9).capitalize() for i in range(20))
    rows = [(i, sentences(i)) for i in range(60)] + [(100 + i, loud(sentences(i))) for i in range(4)]
    rows += [(200 + i, junk(sentences(i))) for i in range(4)]
    verdicts = {r.doc_id: r.kept for r in quality.judge(plain(spark, rows)).collect()}
    assert {i for i, kept in verdicts.items() if kept} == set(range(60))


def test_quality_estimation_is_expectation_maximisation():
    rng, truth = random.Random(3), []
    accuracies, votes = (0.95, 0.8, 0.7), Counter()
    for _ in range(4000):
        good = rng.random() < 0.7
        truth.append(good)
        votes[tuple((1 if good == (rng.random() < a) else -1) if rng.random() < 0.8 else 0 for a in accuracies)] += 1
    prior, habits = quality.estimate(list(votes), list(votes.values()), 3, rounds=200)
    assert abs(prior - 0.7) < 0.06
    assert all(abs(a - b) < 0.06 for a, b in zip(quality.accuracies(prior, habits), accuracies))


def test_personal_data_spans(spark):
    texts = [t for _, t in odd_rows()] + [
        "a@b.c_d@e.f g@h.i.j. k@l", "1.2.3.4.5.6.7.8 999.1.1.1 0255.01.1.1", "4111-1111 1111-1111 1234567890123456 79927398713",
        "+1 (234) 567-8901 +12 +4930123456789012 +", "é+49 30 1234567 x@y.z", "1" * 3000 + "@" + "a." * 3000 + "b", "a" * 20000,
    ]
    texts.append(" ".join(f"u{i}@host{i}.org" for i in range(400)))
    found = personal_data.find(plain(spark, list(enumerate(texts)))).collect()
    for r in found:
        assert [(s.kind, s.start, s.end) for s in r.base] == brute.personal(texts[r.doc_id])
    clean = personal_data.sanitise(odd_table(spark)).collect()
    assert len(clean) == len(odd_rows()) and all(not brute.personal(r.text) for r in clean)
    assert sum(r.text is None for r in clean) == 3 and {r.base for r in clean} == {"b"}


def test_personal_data_spans_of_one_start_go_by_kind(spark):
    """Addresses whose local part is a number or a card by itself: the address comes first, though it is longer."""
    texts = ["+14155550123@sms.example.com", "4111111111111111@x.com", "to +14155550123@sms.example.com and 4111111111111111@x.com."]
    for r in personal_data.find(plain(spark, list(enumerate(texts)))).collect():
        assert [(s.kind, s.start, s.end) for s in r.base] == brute.personal(texts[r.doc_id])
    assert [kind for kind, _, _ in brute.personal(texts[2])] == ["email", "phone", "email", "card"]


def test_disclosing_words_are_generalised_or_removed(spark):
    """'zorkmid' occurs only beside one address, 'tea' everywhere; 'wizardry' has kin far from it."""
    rows = [(i, f"{prose(i, 30)} the wizardry zorkmid tea zorkmid@x.org {prose(i + 50, 30)}") for i in range(6)]
    rows += [(100 + i, prose(i + 200, 60) + " wizened") for i in range(40)]
    found = {r.doc_id: r for r in personal_data.find(plain(spark, rows)).collect()}
    for i, text in rows[:6]:
        added = {text[s.start : s.end]: s.value for s in found[i].added}
        assert added == {"zorkmid": "", "wizardry": "wiz*"}
    assert not any(found[i].added or found[i].base for i, _ in rows[6:])
    clean = {r.doc_id: r.text for r in personal_data.sanitise(plain(spark, rows)).collect()}
    assert "zorkmid" not in clean[0] and "[EMAIL]" in clean[0] and "the wiz*  tea [EMAIL]" in clean[0]
    assert all(clean[i] == text for i, text in rows[6:])


def test_surroundings_are_whole_words_however_long(spark):
    """Long words beside an address: five on either side are its surroundings, and no part of a sixth."""
    for size in (30, 120, 156, 5000):
        words = [f"{chr(97 + i)}{str(i) * size}z" for i in range(12)]
        text = " ".join([*words[:6], "ann@x.org", *words[6:]])
        rows = [(i, f"{prose(i, 20)} {text} {prose(i + 50, 20)}") for i in range(3)]
        found = personal_data.find(plain(spark, rows)).collect()
        for r in found:
            added = {rows[r.doc_id][1][s.start : s.end] for s in r.added}
            assert added & set(words) == set(words[1:11]) and added <= set(words) | set(rows[r.doc_id][1].split())


def test_word_that_discloses_two_values_is_removed_if_either_asks(spark):
    """'zorkmid' is beside the address in all ten texts, beside the number in six; a third of its stem is elsewhere."""
    rows = [(i, f"{prose(i, 30)} ann@x.org zorkmid +49 30 1234567 {prose(i + 50, 30)}") for i in range(6)]
    rows += [(10 + i, f"{prose(i + 100, 30)} ann@x.org zorkmid {prose(i + 150, 30)}") for i in range(4)]
    rows += [(100 + i, f"{prose(i + 200, 60)} zorching") for i in range(5)]
    base = personal_data.base_spans(plain(spark, rows).withColumn("t1", F.xxhash64("text"))).where("size(base) > 0")
    given = {(r.value, r.word): r.generalised for r in personal_data.disclosing_words(plain(spark, rows), base).collect()}
    assert given["ann@x.org", "zorkmid"] == "" and given["+49 30 1234567", "zorkmid"] == "zor*"
    found = {r.doc_id: r for r in personal_data.find(plain(spark, rows)).collect()}
    for i, text in rows:
        added = [s.value for s in found[i].added if text[s.start : s.end] == "zorkmid"]
        assert added == ([""] if i < 100 else [])


def test_disclosing_words_go_from_texts_without_the_value(spark):
    """Two of eight texts with 'zorkmid' hold no personal data, one holds other data."""
    rows = [(i, f"{prose(i, 30)} zorkmid ann@x.org {prose(i + 50, 30)}") for i in range(6)]
    rows += [(10, f"{prose(10, 30)} Zorkmid, once"), (11, "zorkmid zorkmids"), (12, "zorkmid of 10.0.0.255"), (13, None), (13, None), (14, "")]
    found = {r.doc_id: r for r in personal_data.find(plain(spark, rows)).collect()}
    for i, text in rows:
        added = [text[s.start : s.end] for s in found[i].added] if text else found[i].added
        assert [a for a in added if "orkmid" in a] == ({10: ["Zorkmid"], 13: [], 14: []}.get(i, ["zorkmid"]))
        assert found[i].text == text
    clean = {r.doc_id: r.text for r in personal_data.sanitise(plain(spark, rows)).collect()}
    assert (clean[11], clean[12], clean[13], clean[14]) == (" zorkmids", " of [IP]", None, "")
    assert clean[10].endswith(" , once") and len(found) == len(clean) == 11


def test_benchmark_passages(spark):
    long_item, short_item = prose(900, 40), "tiny item of six odd words"
    items = [long_item, short_item, "single", None, "", short_item, " ".join(["again"] * 20)]
    rows = odd_rows() + [
        (20, prose(21, 50) + " " + " ".join(long_item.split()[5:30]) + " " + prose(22, 50)),
        (21, prose(23, 20) + " Tiny ITEM, of six-odd words " + prose(24, 20)),
        (22, "single single"), (23, " ".join(long_item.split()[:12])), (24, "again " * 30), (25, prose(901, 20) + long_item + long_item),
    ]
    windows = brute.benchmark_windows(enumerate(items))
    found = decontamination.find_passages(odd_table(spark, rows), benchmark(spark, *items), ("doc_id", "text")).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r.n_words, r.n_hit, set(r.items)) == brute.passages(r.text, windows)
        assert sum(s.end - s.start for s in r.spans) == r.n_hit
    kept = decontamination.drop_contaminated(odd_table(spark, rows), benchmark(spark, *items)).collect()
    clean = [t for _, t in rows if not (n := brute.passages(t, windows))[1] or 20 * n[1] < n[0]]
    assert multiset((r.text,) for r in kept) == multiset((t,) for t in clean)


def test_benchmark_items_of_every_length(spark):
    """Items of 1 to 14 words, alone and all in one table; documents as long, shorter and longer."""
    item = lambda n: " ".join(f"i{n}w{k}" for k in range(n))
    rows = []
    for n in range(1, 15):
        whole, part = item(n), " ".join(item(n).split()[1:])
        rows += [(10 * n, whole), (10 * n + 1, part), (10 * n + 2, f"{prose(n, 30)} {whole} {prose(n + 50, 30)}"), (10 * n + 3, f"x {whole}")]
    # The same four words as an item of their own and inside of a longer one.
    tables = [[item(4)], [item(5)], [item(n) for n in range(1, 15)], [item(4), f"a b {item(4)} c d"]]
    for items in tables:
        windows = brute.benchmark_windows(enumerate(items))
        for r in decontamination.find_passages(plain(spark, rows), benchmark(spark, *items), ("doc_id", "text")).collect():
            assert (r.n_words, r.n_hit, set(r.items)) == brute.passages(r.text, windows)
        kept = decontamination.drop_contaminated(plain(spark, rows), benchmark(spark, *items)).collect()
        clean = [i for i, t in rows if not (n := brute.passages(t, windows))[1] or 20 * n[1] < n[0]]
        assert sorted(r.doc_id for r in kept) == clean


@pytest.mark.parametrize(("width", "sent"), [(2, near_duplicates.SENT), (5, near_duplicates.SENT), (2, 0)])
def test_near_duplicates(spark, monkeypatch, width, sent):
    monkeypatch.setattr(near_duplicates, "SENT", sent)
    rng, rows = random.Random(width), odd_rows()
    for family in range(12):
        text = prose(300 + family, 60).split()
        for member in range(8):  # chains: each copy changes the one before
            text = text[:]
            for _ in range(rng.randrange(3)):
                text[rng.randrange(len(text))] = f"new{rng.randrange(10**6)}"
            rows.append((1000 - 100 * member + family, " ".join(text)))
    texts = [t for _, t in rows]
    roots, sizes = brute.components(texts, width)
    members = defaultdict(list)
    for i, root in enumerate(roots):
        members[root].append(i)
    least = {r: min((rows[i][0] for i in m if rows[i][0] is not None), default=None) for r, m in members.items()}
    grouped = near_duplicates.group(odd_table(spark, rows), width=width).collect()
    assert multiset((r.doc_id, r.text, r.n_shingles, r.component_id) for r in grouped) == multiset(
        (*row, sizes[i], least[roots[i]]) for i, row in enumerate(rows)
    )
    assert sum(r.keeper for r in grouped) == len(members)
    kept = near_duplicates.drop_duplicates(odd_table(spark, rows), width=width)
    assert kept.columns == odd_table(spark).columns and kept.count() == len(members)


def test_odd_sketch_estimates_high_similarity():
    rng = np.random.default_rng(1)
    for similarity in (0.95, 0.8, 0.4):
        n, far = 2000, []
        shared = round(2 * n * similarity / (1 + similarity))
        for _ in range(40):
            values = rng.integers(0, 2**63, 2 * n - shared).astype(np.uint64)
            a, b = (near_duplicates.odd_sketch(near_duplicates.minhash(np.sort(v))) for v in (values[:n], values[n - shared :]))
            far.append(sum(int(x).bit_count() for x in a ^ b))
        assert abs(np.mean(far) - near_duplicates.differing_bits(similarity)) < 6
        assert (max(far) <= near_duplicates.differing_bits(near_duplicates.SIFT)) == (similarity >= 0.8)


def test_components(spark):
    rng, n = random.Random(4), 300
    links = [(i, i + 1) for i in range(0, 120)] + [(rng.randrange(150, n), rng.randrange(150, n)) for _ in range(120)]
    links += [(200, i) for i in range(260, 290)] + [(5, 5)]
    parent = list(range(n))

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    found = {r.node: r.label for r in components.connected(spark.createDataFrame(links, "u long, v long")).collect()}
    linked = {x for pair in links if pair[0] != pair[1] for x in pair}
    assert found == {i: root(i) for i in linked}


def tasks_of(spark, work):
    """What ``work`` returns, and how many tasks it took."""
    sc, group = spark.sparkContext, f"tasks-{random.random()}"
    sc.setJobGroup(group, "counted")
    try:
        result, tracker = work(), sc.statusTracker()
        stages = {s for job in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(job).stageIds}
        return result, sum(info.numCompletedTasks for s in stages if (info := tracker.getStageInfo(s)))
    finally:
        sc._jsc.clearJobGroup()


@pytest.mark.parametrize("sent", [None, 0])
def test_components_take_few_shuffles(spark, sent):
    rng, n, more = random.Random(7), 400, {} if sent is None else {"sent": sent}
    order = rng.sample(range(n), n)
    paths = [(order[i], order[i + 1]) for i in range(n - 1) if i % 50 != 49]
    stars = [(1000 + 100 * i, 1000 + 100 * i - j) for i in range(1, 5) for j in range(1, 60)]
    links = spark.createDataFrame(paths + stars, "u long, v long").coalesce(1)
    before = {name: spark.conf.get(name) for name in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for name, value in zip(before, ("40", "false")):
            spark.conf.set(name, value)
        found, tasks = tasks_of(spark, lambda: components.connected(links, **more).collect())
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    labels = {i: min(order[at : at + 50]) for at in range(0, n, 50) for i in order[at : at + 50]}
    labels |= {1000 + 100 * i - j: 1000 + 100 * i - 59 for i in range(1, 5) for j in range(60)}
    assert {r.node: r.label for r in found} == labels and len(found) == len(labels)
    assert sent == 0 or tasks < 1100


def test_language_model(spark):
    rows = odd_rows() + [(i, prose(i, 40)) for i in range(30, 60)]
    rows = [r for r in rows if r[0] != 8]  # the plain recursion is slow
    scored = language_model.score(odd_table(spark, rows), depth=3, frequent_grams=50, frequent_words=5).collect()
    tree = brute.context_tree(rows, 3)
    expect = defaultdict(list)
    for (i, text), row in zip(rows, brute.word_scores(rows)):
        expect[i, row[1], len((" ".join(brute.tokens(text)[:-1]) + "\n").encode())].append((*row, tree(text)))
    assert len(scored) == len(rows)
    for r in scored:
        found = (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)
        same = expect[r.doc_id, r.n_tokens, r.n_bytes]
        assert any(found[:4] == e[:4] and np.allclose(found[4:], e[4:], rtol=1e-9) for e in same)
        assert math.isclose(r.bits_per_byte, -r.score * math.log2(10) / r.n_bytes)
    whole = language_model.score(odd_table(spark, odd_rows()))
    assert whole.count() == len(odd_rows()) and whole.where("score >= 0 or base_score >= 0").count() == 0


def test_pre_tokens_go_through_the_model_in_bounded_texts(monkeypatch):
    encode, spaced = tokens._units(BYTES)
    sizes = []

    class Watched:
        def encode_batch_fast(self, texts, **how):
            sizes.extend(len(t) for t in texts)
            return encode.encode_batch_fast(texts, **how)

    monkeypatch.setattr(tokens, "_units", lambda path: (Watched(), spaced))
    letters = "abcdefghijklmnopqrstuvwxyzé"
    units = [a + b + c + "x" for a in letters for b in letters for c in letters]
    for space in (True, False):
        assert tokens.ids_of_units(BYTES, units, space) == tokens.ids_of(BYTES, [" " * space + u for u in units])
        assert tokens.ids_of_units(BYTES, [], space) == []
    assert max(sizes) < 100_000 < sum(sizes)


def test_written_tables_leave_no_shuffle_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def files():
        return {f for top in folders for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_")}

    before, setting = files(), spark.conf.get(shared.CLEANED, None)
    counts = shared.materialise(spark.range(1000).selectExpr("id % 7 k").groupBy("k").count(), "counts")
    assert not files() - before and spark.conf.get(shared.CLEANED, None) == setting
    assert sum(r["count"] for r in counts.collect()) == 1000


def test_stretches_by_their_pre_tokens(monkeypatch):
    """Ids are the library's, also when stretches are forgotten, and stretches of plain pre-tokens do not pass through it whole."""
    rng, whole = random.Random(8), []
    alphabet = [*"abZ09.,$é ɏ\n\t'́½ ", " ", "  ", " the", "'s", "<|endoftext|>", "\r\n", "日"]
    texts = ["", " ", "a" * 500 + " " + "é" * 300 + " b"] + ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(2000)]
    words = [" ".join(f"{rng.choice('abé')}{rng.randint(0, 10**6)}.\nWé,&&& 1.2.3" for _ in range(20)) for _ in range(50)]
    expect = [np.array(x.ids, "<u4").tobytes() for x in Tokenizer.from_file(BYTES).encode_batch(texts + words, add_special_tokens=False)]
    monkeypatch.setattr(tokens, "REMEMBERED", 200)
    encoder = tokens.ByteEncoder(BYTES)
    for _ in range(2):
        assert [ids for at in range(0, 2053, 100) for ids in encoder.encode((texts + words)[at : at + 100])] == expect
    ids_of = tokens.ids_of
    monkeypatch.setattr(tokens, "ids_of", lambda path, these: whole.extend(these) or ids_of(path, these))
    assert tokens.ByteEncoder(BYTES).encode(words) == expect[2003:]
    assert len(whole) <= len(words) + 1


@pytest.mark.parametrize("capacity", [16, 1024])
def test_packing(spark, capacity):
    packed = packing.pack(odd_table(spark), BYTES, capacity=capacity, keep_ids=True).collect()
    library = Tokenizer.from_file(BYTES)
    expect = Counter(tuple([*library.encode(t or "", add_special_tokens=False).ids, 2]) for _, t in odd_rows())
    lengths, places = Counter(), defaultdict(list)
    for r in packed:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length and zlib.crc32(r.ids) == r.ids_crc32 and (r.piece == 0 or r.length == capacity)
        places[r.sequence_id].append((r.offset, r.length))
        lengths[r.doc_id] += r.length
    own = Counter()
    for (i, t) in odd_rows():
        own[i] += len(library.encode(t or "", add_special_tokens=False).ids) + 1
    assert lengths == own and len(packed) == sum(-(-len(k) // capacity) * n for k, n in expect.items())
    for spots in places.values():
        ends = np.cumsum([n for _, n in sorted(spots)])
        assert [o for o, _ in sorted(spots)] == [0, *ends[:-1]] and ends[-1] <= capacity
    lost = sum(own.values()) / capacity
    assert len(places) <= lost * 1.15 + 2
    whole = packing.sequences(packing.pack(odd_table(spark), BYTES, capacity=capacity, keep_ids=True)).collect()
    assert all(4 * r.length == len(r.ids) for r in whole) and sum(r.length for r in whole) == sum(own.values())


def _fewest(lengths, capacity, memo):
    """The least number of sequences, by trying all sets for the longest piece."""
    if not lengths:
        return 0
    if lengths not in memo:
        first, rest, best = lengths[0], lengths[1:], len(lengths)
        for chosen in range(1 << len(rest)):
            picked = [x for i, x in enumerate(rest) if chosen >> i & 1]
            if first + sum(picked) <= capacity:
                left = tuple(x for i, x in enumerate(rest) if not chosen >> i & 1)
                best = min(best, 1 + _fewest(left, capacity, memo))
        memo[lengths] = best
    return memo[lengths]


def test_packing_plan_reduces_without_loss():
    rng = random.Random(8)
    for _ in range(60):
        capacity = rng.choice([10, 20, 50])
        lengths = sorted((rng.randint(1, capacity) for _ in range(9)), reverse=True)
        counts = [lengths.count(k) for k in range(capacity + 1)]
        plan = packing.Plan(counts, capacity)
        assert not any(plan.left)
        fewest = _fewest(tuple(lengths), capacity, {})
        assert fewest <= plan.sequences <= fewest + 1
        reduced = packing.Plan.__new__(packing.Plan)
        reduced.capacity, reduced.left, reduced.used, reduced.runs, reduced.sequences = capacity, counts[:], [0] * (capacity + 1), [], 0
        reduced._reduce()
        left = tuple(k for k in range(capacity, 0, -1) for _ in range(reduced.left[k]))
        assert reduced.sequences + _fewest(left, capacity, {}) == fewest  # what was fixed costs nothing


def test_repeated_passages(spark):
    rng, rows, planted = random.Random(6), [(0, None), (1, ""), (None, "solo")], {}
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9)))
    for k in range(60):
        passage = " ".join(word() for _ in range(51))
        for doc in (10 + 2 * k, 11 + 2 * k):
            rows.append((doc, " ".join([*(word() for _ in range(rng.randrange(80))), passage, *(word() for _ in range(60))])))
        planted[11 + 2 * k] = (10 + 2 * k, passage)
    rows += [(500 + i, " ".join(word() for _ in range(300))) for i in range(20)] + [rows[-1]]
    df = odd_table(spark, rows)
    found = substrings.repeated_passages(df).collect()
    texts = dict(rows)
    assert {r.doc_id: r.first_doc_id for r in found} == {doc: first for doc, (first, _) in planted.items()}
    for r in found:
        raw = texts[r.doc_id].encode()[r.start : r.end]
        assert raw in texts[r.first_doc_id].encode() and raw.decode() in f" {planted[r.doc_id][1]} "
        assert len(raw.split()) >= 12
    cut = {r.doc_id: r.text for r in substrings.without_passages(plain(spark, rows[:-1]), substrings.repeated_passages(plain(spark, rows[:-1]))).collect()}
    assert all(cut[i] == t for i, t in rows if i is not None and i not in planted)
    assert all(len(cut[i]) < len(texts[i]) for i in planted)


def planted_passages():
    """(rows, passages by copy): one-letter words, periodic passages and words of any length in other surroundings."""
    rng, rows, planted = random.Random(11), [(0, None), (1, ""), (2, " \n ")], {}
    word = lambda low, high: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(low, high)))
    kinds = [
        lambda: " ".join(word(1, 1) for _ in range(51)),
        lambda: " ".join(word(1, 300) for _ in range(51)),
        lambda: " ".join(["no"] * 60),
        lambda: " ".join([word(1, 4), word(2, 2)] * 30),
        lambda: " ".join([*(word(3, 3) for _ in range(26)), *["eh", "oh", "ah"] * 9]),
        lambda: " ".join([*["uh"] * 26, *(word(1, 2) for _ in range(25))]),
        lambda: " ".join([word(2, 2), word(3, 3)] * 90) + "\n" + " ".join(["la"] * 120),
    ]
    for k in range(84):
        passage = kinds[k % len(kinds)]()
        for doc in (10 + 2 * k, 11 + 2 * k):
            more = rng.choice(["no no no ", "uh uh ", "", "\n", "ah "])
            rows.append((doc, f"{' '.join(word(1, 9) for _ in range(rng.randrange(40)))} {more}{passage} {word(1, 9)} {more}{word(2, 8)}"))
        planted[11 + 2 * k] = passage
    return rows, planted


def test_every_passage_of_over_fifty_words_is_met(spark):
    rows, planted = planted_passages()
    texts, met = dict(rows), defaultdict(int)
    for r in substrings.repeated_passages(plain(spark, rows)).collect():
        run = texts[r.doc_id].encode()[r.start : r.end].decode()
        at = texts[r.doc_id].index(planted[r.doc_id]) if r.doc_id in planted else None
        if at is not None and r.start < at + len(planted[r.doc_id]) and r.end > at:
            met[r.doc_id] = max(met[r.doc_id], len(run.split()))
    assert set(met) == set(planted) and min(met.values()) >= 16


def test_repeated_passages_are_those_of_brute_force(spark):
    rows = planted_passages()[0] + [(300 + i, prose(i % 7, 90) + prose(i, 40)) for i in range(20)] + [(None, prose(3, 90)), (8, prose(4, 3000))]
    found = substrings.repeated_passages(plain(spark, [*rows, rows[-2], rows[5]])).collect()
    assert multiset(found) == multiset(brute.repeated_passages(rows, substrings))


def test_chunks_are_the_texts_and_resist_shifts(spark):
    rows = [r for r in odd_rows() if r[0] in (7, 8, 9, 10)] + [(99, "inserted here " + prose(4, 30_000))]
    found = defaultdict(list)
    for r in substrings.chunks(plain(spark, rows)).collect():
        found[r.doc_id].append((r.offset, r.length, r.words, (r.d1, r.d2)))
    for i, text in rows:
        own = sorted(found[i])
        assert [o for o, *_ in own] == [0, *np.cumsum([n for _, n, *_ in own])[:-1]]
        assert sum(n for _, n, *_ in own) == len(text.encode()) and sum(w for *_, w, _ in own) == len(brute.SPACED.findall(text))
    old, new = ({d for *_, d in found[i]} for i in (8, 99))
    assert len(new - old) <= 3


@pytest.mark.parametrize("frequent", [3, 1 << 18])
def test_token_counts(spark, frequent):
    rows = odd_rows() + [(70, "İstanbul ΣΊΣΥΦΟΣ don't <|startoftext|>x<|endoftext|> \x85   ﬁ 12345 á")]
    counted = token_counts.count_tokens(odd_table(spark, rows), WORDS, frequent=frequent).collect()
    library = Tokenizer.from_file(WORDS)
    expect = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
    assert multiset((r.doc_id, r.n_bytes, r.n_tokens) for r in counted) == multiset(expect)


def test_conversations(spark):
    turns = lambda c, *texts: [(c, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(texts)]
    rows = turns(1, "a", "b") + turns(2, "a", "b", "c") + turns(3, "a", "b", "c", "d") + turns(5, "a", "b", "c", "d")
    rows += turns(4, "a", "x") + turns(6, "a") + turns(7, *(f"t{i}" for i in range(200)))
    rows += turns(8, *(f"t{i}" for i in range(130))) + [(9, 0, None, None), (9, 1, "user", ""), (9, None, "user", "last")]
    rows += [(None, 0, "user", "alone"), (None, 0, "user", "alone"), (None, 1, "user", "alone too"), (None, 0, "user", "a")]
    rows += rows[:5]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, place string")
    found = conversations.render(df).collect()
    assert {(r.conv_id, r.turns, r.copies) for r in found} == {(3, 4, 2), (4, 2, 1), (7, 200, 1), (9, 3, 1), (None, 1, 1)}
    assert sorted(r.segment for r in found if r.conv_id == 7) == [0, 1, 2, 3]
    whole = "".join(r.text for r in sorted((r for r in found if r.conv_id == 7), key=lambda r: r.segment))
    assert whole == "".join(f"<|{'user' if i % 2 == 0 else 'assistant'}|>\nt{i}\n<|end|>\n" for i in range(200))
    assert next(r.text for r in found if r.conv_id == 9) == "<||>\n\n<|end|>\n<|user|>\n\n<|end|>\n<|user|>\nlast\n<|end|>\n"
    # A lone first turn that begins longer conversations is their prefix.
    assert sum(r.conv_id is None for r in found) == 2
