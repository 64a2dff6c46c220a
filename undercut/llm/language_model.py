"""Texts scored by word counts and by context-tree weighting over bytes, learned from the corpus.

A text is modelled as its words in lower case with a space between two and a line end
after the last: the same tokens that the word model scores.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from undercut.llm.textbytes import SPACED, Words, mix, slices
from undercut.shared import materialise

#: Bytes of context. A gram is the next byte and its context in one number: the next byte
#: lowest, then the last byte, the one before it, and so on.
DEPTH = 5
BETWEEN, END = 0x20, 0x0A
GRAM, TOKEN = 0, 1
#: The token that ends each text; no word's hash, but for a chance of 2 to the power -64.
END_TOKEN = mix(np.array([0x656E64], np.uint64))[0]
#: Distinct keys gathered before they leave a task.
GATHERED = 1 << 20
#: The most frequent grams and words that go to all tasks, 16 bytes each: 20 MB at most.
FREQUENT_GRAMS, FREQUENT_WORDS = 1 << 20, 1 << 18
SMOOTHING = 0.1


def held_out(doc_id: str = "doc_id") -> Column:
    """One document in ten, by a checksum of its id; a null id counts as an empty one."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 10 == 0


class Stream:
    """The tokens of many texts, and the gram at each of their bytes."""

    def __init__(self, texts: pa.Array, depth: int = DEPTH):
        self.words = words = Words(texts, SPACED)
        n = len(words.texts) - 1
        data, keep = words.data.copy(), words.inside.copy()
        keep[words.ends] = True
        data[words.ends] = BETWEEN
        last = np.where(words.counts > 0, words.ends[words.first[1:] - 1] if len(words.ends) else 0, words.texts[1:] - 1)
        keep[last] = True
        data[last] = END
        lengths = np.add.reduceat(keep.astype(np.int64), words.texts[:-1]) if n else np.zeros(0, np.int64)
        self.starts = np.concatenate(([0], np.cumsum(lengths)))
        self.grams = self._grams(data[keep], depth)

    def _grams(self, stream: np.ndarray, depth: int) -> np.ndarray:
        """Before a text lie line ends, as after any other."""
        place = np.arange(len(stream)) - np.repeat(self.starts[:-1], np.diff(self.starts))
        code = stream.astype(np.uint64)
        for back in range(1, depth + 1):
            byte = np.full(len(stream), END, np.uint64)
            byte[back:] = np.where(place[back:] >= back, stream[:-back], END)
            code |= byte << np.uint64(8 * back)
        return code

    @functools.cached_property
    def tokens(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the tokens, ends included, and where each text's begin."""
        words, n = self.words, len(self.words.texts) - 1
        starts = words.first + np.arange(n + 1)
        keys = np.full(len(words.starts) + n, END_TOKEN, np.uint64)
        is_word = np.ones(len(keys), bool)
        is_word[starts[1:] - 1] = False
        keys[is_word] = words.hashes
        return keys, starts


class _Tally:
    """Counts by key, put together from many arrays."""

    def __init__(self, kind: int):
        self.kind, self.keys, self.counts = kind, np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray, weights: np.ndarray) -> None:
        found, at = np.unique(keys, return_inverse=True)
        counts = np.bincount(at, weights, len(found)).astype(np.int64)
        self.keys, at = np.unique(np.concatenate((self.keys, found)), return_inverse=True)
        self.counts = np.bincount(at, np.concatenate((self.counts, counts)), len(self.keys)).astype(np.int64)

    def take(self) -> pa.RecordBatch:
        kinds = np.full(len(self.keys), self.kind, np.int32)
        out = pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(self.keys.view(np.int64)), pa.array(self.counts)], ["kind", "key", "n"])
        self.__init__(self.kind)
        return out


def _gather(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[pa.RecordBatch]:
    """Counts of grams and tokens in training texts; what only held-out texts have counts 0."""
    tallies = _Tally(GRAM), _Tally(TOKEN)
    for batch in batches:
        for rows in slices(batch):
            stream = Stream(rows.column("text"), depth)
            learned = ~rows.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            tallies[GRAM].add(stream.grams, np.repeat(learned, np.diff(stream.starts)))
            keys, starts = stream.tokens
            counted = np.repeat(learned, np.diff(starts))
            tallies[TOKEN].add(keys[counted], np.ones(int(counted.sum())))
            for tally in tallies:
                if len(tally.keys) > GATHERED:
                    yield tally.take()
    for tally in tallies:
        yield tally.take()


def _log_gamma(x: np.ndarray) -> np.ndarray:
    shift = sum(np.log(x + i) for i in range(8))
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - shift


def _estimated(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log probability that the Krichevsky-Trofimov estimator gives all bits seen at a node."""
    zeros, ones = zeros.astype(float), ones.astype(float)
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - np.log(np.pi) - _log_gamma(zeros + ones + 1)


def _weighted(estimated: np.ndarray, deeper: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log of half the node's own estimate plus half of its deeper contexts', and the first one's share."""
    log_weighted = np.logaddexp(estimated, deeper) - np.log(2)
    return log_weighted, np.exp(estimated - np.log(2) - log_weighted)


def _next(counts: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """The estimator's probability of a bit after the counts (zeros, ones) of its node."""
    return (np.where(bit, counts[:, 1], counts[:, 0]) + 0.5) / (counts.sum(axis=1) + 1)


class Level:
    """The nodes of one depth among the bits of some grams: counts, and each bit's node."""

    def __init__(self, context: np.ndarray, node: np.ndarray, bit: np.ndarray, n: np.ndarray):
        self.keys, self.at = np.unique(context << np.uint64(8) | node, return_inverse=True)
        size = len(self.keys)
        self.counts = np.stack([np.bincount(self.at, np.where(bit == b, n, 0), size) for b in (0, 1)], axis=1)
        self.first = np.zeros(size, np.int64)
        self.first[self.at] = np.arange(len(self.at))
        self.weighted, self.share = _estimated(*self.counts.T), np.ones(size)

    def above(self, deeper: Level) -> None:
        """Weigh this level against the one below."""
        sums = np.bincount(self.at[deeper.first], deeper.weighted, len(self.keys))
        self.weighted, self.share = _weighted(self.weighted, sums)

    def mixed(self, bit: np.ndarray, deeper: np.ndarray | None = None) -> np.ndarray:
        own = _next(self.counts, np.zeros(len(self.keys), bool))[self.at]
        own = np.where(bit == 1, 1 - own, own)
        share = self.share[self.at]
        return own if deeper is None else share * own + (1 - share) * deeper


def bits_of(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 8 decisions of each gram's next byte: the node in the byte's binary tree, and the bit."""
    byte = (grams & np.uint64(255)).astype(np.int64)[:, None]
    place = np.arange(8)[None, :]
    node = (1 << place) | (byte >> (8 - place))
    return node.astype(np.uint64).ravel(), (byte >> (7 - place) & 1).ravel()


#: Depth from which one task holds a subtree: all contexts that end with the same two bytes.
SHARED = 2


def _subtree(frame: pd.DataFrame, depth: int) -> pd.DataFrame:
    """One subtree's grams with the probability of each bit, mixed from the deepest contexts up to its root.

    The root's nodes come along on the gram where they are seen first.
    """
    grams = frame["key"].to_numpy().view(np.uint64)
    order = np.argsort(grams)
    grams, n = grams[order], frame["n"].to_numpy()[order]
    node, bit = bits_of(grams)
    many, wide = np.repeat(n, 8), np.repeat(grams, 8) >> np.uint64(8)
    levels = [Level(wide & np.uint64((1 << 8 * d) - 1), node, bit, many) for d in range(SHARED, depth + 1)]
    chance = levels[-1].mixed(bit)
    for above, below in zip(levels[-2::-1], levels[:0:-1], strict=True):
        above.above(below)
    for level in levels[-2::-1]:
        chance = level.mixed(bit, chance)
    root = levels[0]
    owner, nodes = root.first // 8, root.keys & np.uint64(255)
    by_gram = [[] for _ in grams]
    for i, x in enumerate(zip(nodes.tolist(), *root.counts.T.tolist(), root.weighted.tolist(), strict=True)):
        by_gram[owner[i]].append(dict(zip(("node", "zeros", "ones", "weighted"), x, strict=True)))
    return pd.DataFrame({"key": grams.view(np.int64), "n": n, "chances": list(chance.reshape(-1, 8)), "nodes": by_gram})


class Top:
    """Contexts of one byte and of none: at most 65 280 and 255 nodes, in dense arrays."""

    def __init__(self, rows: list):
        one = np.zeros((256 * 256, 3))
        for row in rows:
            one[row["last"] * 256 + row["node"]] = row["zeros"], row["ones"], row["weighted"]
        self.one = one[:, :2]
        weighted, self.one_share = _weighted(_estimated(*self.one.T), one[:, 2])
        self.none = self.one.reshape(256, 256, 2).sum(axis=0)
        _, self.none_share = _weighted(_estimated(*self.none.T), weighted.reshape(256, 256).sum(axis=0))

    def log10(self, grams: np.ndarray, chances: np.ndarray) -> np.ndarray:
        """Log probability of each gram's byte, from its bits' chances in longer contexts."""
        node, bit = bits_of(grams)
        node = node.astype(np.int64)
        at = np.repeat((grams >> np.uint64(8) & np.uint64(255)).astype(np.int64), 8) * 256 + node
        share = self.one_share[at]
        chance = share * _next(self.one[at], bit == 1) + (1 - share) * chances.ravel()
        share = self.none_share[node]
        chance = share * _next(self.none[node], bit == 1) + (1 - share) * chance
        return np.log10(chance).reshape(-1, 8).sum(axis=1)


def _gram_scores(batches: Iterator[pa.RecordBatch], top: Top) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        grams = batch.column("key").to_numpy().view(np.uint64)
        chances = batch.column("chances").flatten().to_numpy()
        scores = pa.array(top.log10(grams, chances))
        yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("n"), scores], ["key", "n", "value"])


def context_tree(grams: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Log10 probability of the next byte for each gram: (key, n, value).

    Every byte is eight binary decisions. At each context of 0 to ``depth`` bytes, a
    decision's node holds the counts of its bits in training; its weighted probability
    is half that of its own estimator and half the product of those of all contexts one
    byte longer. The chance of a bit mixes the estimators along its context by their
    posterior shares; nodes never seen give one half. Contexts that end with the same two
    bytes are one group of distinct grams; what lies above those groups is summed natively
    and collected, 65 280 rows at most.
    """
    group = F.shiftright("key", 8).bitwiseAND(F.lit((1 << 8 * SHARED) - 1))
    nodes = "array<struct<node:bigint,zeros:double,ones:double,weighted:double>>"
    trees = grams.groupBy(group.alias("ending")).applyInPandas(
        lambda frame: _subtree(frame, depth), f"key long, n long, chances array<double>, nodes {nodes}"
    )
    trees = materialise(trees, "context-trees")
    roots = trees.select(F.shiftright("key", 8).bitwiseAND(F.lit(255)).alias("last"), F.inline("nodes"))
    one = roots.groupBy("last", "node").agg(*(F.sum(c).alias(c) for c in ("zeros", "ones", "weighted")))
    top = Top(one.collect())
    return trees.select("key", "n", "chances").mapInArrow(functools.partial(_gram_scores, top=top), "key long, n long, value double")


class Lookup:
    """Values of frequent keys in a table of open addresses, for whole arrays at a time."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(2 * len(keys)).bit_length())
        self.mask, self.shift = (1 << bits) - 1, np.uint64(64 - bits)
        self.keys, self.values = np.zeros(1 << bits, np.uint64), np.full(1 << bits, np.nan)
        taken, left, self.probes = np.zeros(1 << bits, bool), np.arange(len(keys)), 0
        while len(left):
            at = self._slot(keys[left], self.probes)
            _, first = np.unique(at, return_index=True)
            free = first[~taken[at[first]]]
            taken[at[free]] = True
            self.keys[at[free]], self.values[at[free]] = keys[left[free]], values[left[free]]
            left = np.delete(left, free)
            self.probes += 1

    def _slot(self, keys: np.ndarray, probe: int) -> np.ndarray:
        return ((mix(keys) >> self.shift).astype(np.int64) + probe) & self.mask

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The values, or not-a-number."""
        found, left = np.full(len(keys), np.nan), None
        for probe in range(self.probes):
            wanted = keys if left is None else keys[left]
            at = self._slot(wanted, probe)
            hit = self.keys[at] == wanted
            if left is None:
                found[hit] = self.values[at[hit]]
                left = np.flatnonzero(~hit)
            else:
                found[left[hit]] = self.values[at[hit]]
                left = left[~hit]
            if not len(left):
                break
        return found


def _rare(kind: int, keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each row's distinct keys with their numbers."""
    order = np.lexsort((keys, rows))
    keys, rows = keys[order], rows[order]
    new = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])))) if len(keys) else np.zeros(0, int)
    return rows[new], np.full(len(new), kind, np.int32), keys[new].view(np.int64), np.diff(np.append(new, len(keys)))


def _scored(
    batches: Iterator[pa.RecordBatch], grams: tuple[np.ndarray, np.ndarray], words: tuple[np.ndarray, np.ndarray], all_: float, depth: int
) -> Iterator[pa.RecordBatch]:
    """Sums over each text's frequent grams and tokens, and how often it has which others."""
    gram_table, word_table = Lookup(*grams), Lookup(*words)
    for batch in batches:
        for rows in slices(batch):
            stream = Stream(rows.column("text"), depth)
            values = gram_table.find(stream.grams)
            missing = np.flatnonzero(np.isnan(values))
            of = lambda starts, at: np.searchsorted(starts, at, side="right") - 1
            rare_grams = _rare(GRAM, stream.grams[missing], of(stream.starts, missing))
            score = np.add.reduceat(np.nan_to_num(values, copy=False), stream.starts[:-1])
            keys, starts = stream.tokens
            counts = word_table.find(keys)
            missing = np.flatnonzero(np.isnan(counts))
            rare_words = _rare(TOKEN, keys[missing], of(starts, missing))
            known = ~np.isnan(counts)
            base = np.where(known, np.log10((np.nan_to_num(counts) + SMOOTHING) / all_), 0.0)
            sums = (np.diff(stream.starts), np.diff(starts), np.add.reduceat(known.astype(np.int64), starts[:-1]))
            rare = [np.concatenate(x) for x in zip(rare_grams, rare_words, strict=True)]
            order = np.argsort(rare[0], kind="stable")
            ends = np.searchsorted(rare[0][order], np.arange(rows.num_rows + 1)).astype(np.int32)
            others = pa.StructArray.from_arrays([pa.array(x[order]) for x in rare[1:]], ["kind", "key", "times"])
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"), rows.column("held_out"), *(pa.array(x) for x in sums), pa.array(np.add.reduceat(base, starts[:-1])),
                    pa.array(score), pa.ListArray.from_arrays(pa.array(ends), others),
                ],
                ["doc_id", "held_out", "n_bytes", "n_tokens", "n_known", "base_score", "score", "rare"],
            )


def frequent(counts: DataFrame, most: int) -> DataFrame:
    """The keys with the highest counts, ``most`` of them at most.

    Counts are told apart by quarters of a power of two, so that the bound is found from
    a few hundred numbers of keys and nothing is sorted or merged on the driver.
    """
    level = F.floor(4 * F.log2("n")).cast("int")
    sizes = counts.where("n > 0").groupBy(level.alias("level")).agg(F.count("*").alias("keys")).collect()
    left, lowest = most, None
    for row in sorted(sizes, key=lambda r: -r["level"]):
        left -= row["keys"]
        if left < 0:
            break
        lowest = row["level"]
    return counts.where((F.col("n") > 0) & (level >= lowest) if lowest is not None else F.lit(False))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole columns as bytes: 16 for each row on their way to the driver, and no objects."""
    for batch in batches:
        columns = (batch.column(name).to_numpy(zero_copy_only=False).tobytes() for name in ("key", "value"))
        yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in columns], ["keys", "values"])


def score(
    docs: DataFrame, depth: int = DEPTH, frequent_grams: int = FREQUENT_GRAMS, frequent_words: int = FREQUENT_WORDS
) -> DataFrame:
    """Every document's log10 probability by words (``base_score``) and by context trees (``score``).

    Both models learn from the documents that are not held out. Grams and words are
    counted with partial sums in each task. The most frequent of both, bounded tables, go
    to the tasks that score the texts; the rest of each text's gram and word frequencies
    meets the model in one equi-join, which so holds no hot key. ``bits_per_byte`` is the
    code length of the modelled bytes.

    A null or empty text is its end alone. Repeated rows each count and are each scored.
    An empty table gives no rows. Other columns are ignored. Words are told apart by
    64-bit hashes.
    """
    docs = docs.select("doc_id", "text", held_out().alias("held_out"))
    kind = dict(docs.dtypes)["doc_id"]
    counts = docs.select("text", "held_out").mapInArrow(functools.partial(_gather, depth=depth), "kind int, key long, n long")
    counts = materialise(counts.groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")
    tokens = counts.where(F.col("kind") == TOKEN)
    total = tokens.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("all"), F.count("*").alias("distinct")).first()
    all_ = total["all"] + SMOOTHING * (total["distinct"] + 1)
    grams = materialise(context_tree(counts.where(F.col("kind") == GRAM).select("key", "n"), depth), "gram-scores")

    def top(df: DataFrame, value: str, most: int) -> tuple[np.ndarray, np.ndarray]:
        found = frequent(df, most).select("key", F.col(value).cast("double").alias("value"))
        parts = found.mapInArrow(_packed, "keys binary, values binary").collect()
        keys, values = (b"".join(bytes(part[i]) for part in parts) for i in (0, 1))
        return np.frombuffer(keys, np.uint64), np.frombuffer(values, float)

    scored = functools.partial(_scored, grams=top(grams, "value", frequent_grams), words=top(tokens, "n", frequent_words), all_=all_, depth=depth)
    schema = (
        f"doc_id {kind}, held_out boolean, n_bytes long, n_tokens long, n_known long, base_score double, score double, "
        "rare array<struct<kind:int,key:bigint,times:bigint>>"
    )
    rows = docs.mapInArrow(scored, schema).withColumn("row", F.monotonically_increasing_id())
    # A first element of no kind carries the document's own columns; its number spreads
    # such rows over all partitions of the join, in which they find nothing.
    itself = F.array(F.struct(F.lit(-1).alias("kind"), F.col("row").alias("key"), F.lit(0).cast("long").alias("times")))
    own = ["doc_id", "held_out", "n_bytes", "n_tokens", "n_known", "base_score", "score"]
    rows = rows.select("row", *own, F.posexplode(F.concat(itself, "rare")).alias("at", "x"))
    rows = rows.select("row", *(F.when(F.col("at") == 0, F.col(c)).alias(c) for c in own), "x.*")
    values = grams.select(F.lit(GRAM).alias("kind"), "key", "value").union(
        tokens.select(F.lit(TOKEN).alias("kind"), "key", F.col("n").cast("double"))
    )
    joined = rows.join(values, ["kind", "key"], "left")
    count = F.coalesce("value", F.lit(0.0))
    is_word, is_gram = F.col("kind") == TOKEN, F.col("kind") == GRAM
    word = F.when(is_word, F.col("times") * F.log10((count + SMOOTHING) / F.lit(all_)))
    result = joined.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("held_out").alias("held_out"),
        F.max("n_bytes").alias("n_bytes"),
        F.max("n_tokens").alias("n_tokens"),
        F.sum(F.coalesce("n_known", F.when(is_word & (count > 0), F.col("times")), F.lit(0))).alias("n_known"),
        F.sum(F.coalesce("base_score", word, F.lit(0.0))).alias("base_score"),
        F.sum(F.coalesce("score", F.when(is_gram, F.col("times") * F.col("value")), F.lit(0.0))).alias("score"),
    )
    bits = -F.col("score") * float(np.log2(10)) / F.col("n_bytes")
    return result.drop("row").withColumns({"train_tokens": F.lit(int(total["all"])).cast("long"), "bits_per_byte": bits})
