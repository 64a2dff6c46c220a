"""Near-duplicate documents: MinHash bands propose, odd sketches sift, full shingle sets confirm."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from undercut.llm.columns import own_names
from undercut.llm.components import connected
from undercut.llm.textbytes import SPACED, Words, grams, mix, slices
from undercut.shared import Slots, materialise

#: Bands of MinHash samples. Two sets of similarity s agree in no band with probability
#: (1 - s^4)^32: at 0.8, 5 in a hundred million.
BANDS, ROWS = 32, 4
SAMPLES = BANDS * ROWS
#: Bits of the odd sketch, in 64-bit words, and the similarity that its estimate must
#: reach. At a true 0.8 the estimate falls short of 0.5 with 6 standard deviations.
SKETCH_WORDS, SIFT = 4, 0.5
_NUMBERS = mix(np.arange(1, 2 * SAMPLES + 1, dtype=np.uint64))
FLIP = (_NUMBERS[:SAMPLES] >> np.uint64(32)).astype(np.uint32)[:, None]
SPREAD = (_NUMBERS[SAMPLES:] >> np.uint64(32)).astype(np.uint32)[:, None] | np.uint32(1)
#: A finer sketch, for the pairs that a large group of copies leaves open: so many times
#: the samples, on 8192 bits. At a true 0.8 its estimate falls short of 0.75 with 5
#: standard deviations.
FINE, FINE_WORDS, FINE_SIFT = 32, 128, 0.75
#: Rounds in which the largest component of a bucket with more members than this sends
#: another one to meet the rest, before what is left is settled pair by pair.
RETRIES, CROWD = 3, 16
#: Shingles hashed for all samples at a time.
BLOCK = 4096
#: Classes, pairs of them or buckets that are sent to all tasks at most, as a few numbers each; more of
#: them are joined by shuffles, of the texts among others.
SENT = 2**18


def sets_of(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Each text's distinct shingles of ``width`` words as sorted hashes, or its few words as one."""
    words = Words(texts, SPACED)
    runs, first, counts = grams(words.hashes, width), words.first, words.counts
    for i, n in enumerate(counts):
        if n >= width:
            yield np.unique(runs[first[i] : first[i] + n - width + 1])
        else:
            yield grams(words.hashes[first[i] : first[i] + n], int(n)) ^ np.uint64(n) if n else np.zeros(0, np.uint64)


def minhash(shingles: np.ndarray, series: int = 0) -> np.ndarray:
    """The least of the shingles under each of the random orders; each series has its own."""
    if series:
        shingles = mix(shingles + np.uint64(series))
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(SAMPLES, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(low), BLOCK):
        order = low[None, at : at + BLOCK] ^ FLIP
        order *= SPREAD
        order ^= order >> np.uint32(15)
        order *= np.uint32(0x2C1B3C6D)
        np.minimum(least, order.min(axis=1), out=least)
    return least


def band_keys(samples: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band, different from band to band."""
    key = np.arange(1, BANDS + 1, dtype=np.uint64) << np.uint64(32)
    for j in range(ROWS):
        key = mix(key + samples[j::ROWS].astype(np.uint64))
    return key


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """A bitmap in which each sample flips one bit: parities of the samples that fall there."""
    bits = 64 * SKETCH_WORDS
    at = mix(samples.astype(np.uint64) ^ _NUMBERS[:SAMPLES]) % np.uint64(bits)
    odd = np.bincount(at.astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def fine_sketch(shingles: np.ndarray) -> np.ndarray:
    """The odd sketch of all series of samples."""
    bits, odd = 64 * FINE_WORDS, np.zeros(64 * FINE_WORDS, np.int64)
    for series in range(1, FINE + 1):
        at = mix((minhash(shingles, series).astype(np.uint64) ^ _NUMBERS[:SAMPLES]) + np.uint64(series)) % np.uint64(bits)
        odd += np.bincount(at.astype(np.int64), minlength=bits)
    return np.packbits((odd & 1).astype(np.uint8)).view(np.uint64)


def differing_bits(similarity: float, words: int = SKETCH_WORDS, samples: int = SAMPLES) -> int:
    """Bits expected to differ between odd sketches of sets this similar."""
    bits = 64 * words
    return round(bits / 2 * (1 - (1 - 2 / bits) ** (2 * samples * (1 - similarity))))


def _digests(sets: list[np.ndarray]) -> list[pa.Array]:
    """128 bits of each set, as two numbers."""
    halves = np.frombuffer(b"".join(xxhash.xxh3_128_digest(one.tobytes()) for one in sets), "<i8").reshape(-1, 2)
    return [pa.array(np.ascontiguousarray(halves[:, j])) for j in (0, 1)]


def _sketches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """In the place of texts, their sets' sizes, digests, sketches and bands."""
    for batch in batches:
        for rows in slices(batch):
            kept = [name for name in rows.schema.names if name != "text"]
            sizes, digests, sketches, keys = [], [], [], []
            for shingles in sets_of(rows.column("text"), width):
                sizes.append(len(shingles))
                digests.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                samples = minhash(shingles)
                sketches.append(odd_sketch(samples))
                keys.append(band_keys(samples))
            halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            sketch = np.array(sketches).view(np.int64)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(np.concatenate(keys).view(np.int64)), BANDS)
            columns = [
                *(rows.column(name) for name in kept), pa.array(sizes, pa.int64()), *(pa.array(np.ascontiguousarray(halves[:, j])) for j in (0, 1)),
                *(pa.array(np.ascontiguousarray(sketch[:, j])) for j in range(SKETCH_WORDS)), lists.cast(pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "n", "d1", "d2", *(f"s{j}" for j in range(SKETCH_WORDS)), "bands"])


def _shingles(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in slices(batch):
            sets = list(sets_of(rows.column("text"), width))
            ends = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
            values = pa.array(np.concatenate(sets).view(np.int64))
            yield pa.RecordBatch.from_arrays([*_digests(sets), pa.ListArray.from_arrays(pa.array(ends), values)], ["d1", "d2", "shingles"])


def _node_shingles(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """In the place of texts, their sets."""
    for batch in batches:
        for rows in slices(batch):
            sets = list(sets_of(rows.column("text"), width))
            ends = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
            values = pa.array(np.concatenate(sets).view(np.int64))
            yield pa.RecordBatch.from_arrays([rows.column("node"), pa.ListArray.from_arrays(pa.array(ends), values)], ["node", "shingles"])


def _with_digests(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in slices(batch):
            sets = list(sets_of(rows.column("text"), width))
            more = [pa.array([len(s) for s in sets], pa.int64()), *_digests(sets)]
            yield pa.RecordBatch.from_arrays([*rows.columns, *more], [*rows.schema.names, "n", "d1", "d2"])


def _fine_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = batch.column("shingles")
        ends, values = sets.offsets.to_numpy(), sets.values.to_numpy().view(np.uint64)
        sketches = [fine_sketch(values[a:b]).view(np.int64) for a, b in zip(ends[:-1], ends[1:])]
        columns = [batch.column("node"), pa.array(sketches, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["node", "fine"])


def _sent(written: DataFrame) -> DataFrame:
    """A written table of numbers of classes or buckets, sent to all tasks if its rows are counted and few enough."""
    return F.broadcast(written) if written.count() <= SENT else written


def _alike(percent: int) -> Column:
    """Whether sizes allow the similarity and the odd sketches of both sides speak for it."""
    fits = 100 * F.least("a.n", "b.n") >= percent * F.greatest("a.n", "b.n")
    differing = sum(
        (F.bit_count(F.col(f"a.s{j}").bitwiseXOR(F.col(f"b.s{j}"))) for j in range(SKETCH_WORDS)), F.lit(0)
    )
    return fits & (differing <= differing_bits(SIFT))


class _Links:
    """Exact links among classes of equal sets, from candidate pairs of classes."""

    def __init__(self, docs: DataFrame, classes: DataFrame, repeats: bool, width: int, percent: int, slots: Slots):
        self.docs, self.classes, self.repeats = docs, classes, repeats
        self.width, self.percent, self.slots = width, percent, slots
        self.bands = classes.select("node", "bands")
        self.sketches = classes.select("node", "n", *(f"s{j}" for j in range(SKETCH_WORDS)))

    def sifted(self, pairs: DataFrame) -> DataFrame:
        """Distinct pairs (u, v) whose sizes and odd sketches allow a link."""
        pairs = self.slots.put("pairs", pairs.distinct())
        few = pairs.count() <= SENT
        met = (F.broadcast(pairs) if few else pairs).join(self.sketches.alias("a"), F.col("a.node") == F.col("u"))
        met = (F.broadcast(met) if few else met).join(self.sketches.alias("b"), F.col("b.node") == F.col("v"))
        return self.slots.put("candidates", met.where(_alike(self.percent)).select("u", "v"))

    def sets(self, nodes: DataFrame) -> DataFrame:
        """The full shingle sets of classes, each from a document that has it.

        Documents are found by id. Few classes are sent to where the texts are, and of many the
        texts are shuffled once. Where ids repeat, the digest tells which document is meant.
        """
        wanted = self.classes.join(nodes, "node", "left_semi").select("node", "d1", "d2", "least")
        wanted = _sent(self.slots.put("involved", wanted))
        if not self.repeats:
            texts = self.docs.join(wanted.select("node", "least"), F.col("doc_id").eqNullSafe(F.col("least"))).select("node", "text")
            return self.slots.put("sets", texts.mapInArrow(functools.partial(_node_shingles, width=self.width), "node long, shingles array<bigint>"))
        texts = self.docs.join(wanted.select("least"), F.col("doc_id").eqNullSafe(F.col("least")), "left_semi").select("text")
        shingles = texts.mapInArrow(functools.partial(_shingles, width=self.width), "d1 long, d2 long, shingles array<bigint>")
        found = shingles.join(wanted.select("node", "d1", "d2"), ["d1", "d2"]).select("node", "shingles")
        return self.slots.put("sets", found.dropDuplicates(["node"]))

    def confirmed(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """The pairs whose full sets are similar enough."""
        both = pairs.join(sets.select(F.col("node").alias("u"), F.col("shingles").alias("x")), "u")
        both = both.join(sets.select(F.col("node").alias("v"), F.col("shingles").alias("y")), "v")
        shared = F.size(F.array_intersect("x", "y"))
        union = F.size("x") + F.size("y") - shared
        return self.slots.put("links", both.where(100 * shared >= self.percent * union).select("u", "v"))

    def checked(self, pairs: DataFrame) -> DataFrame:
        """The links among proposed pairs."""
        tried = self.sifted(pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")))
        nodes = tried.select(F.explode(F.array("u", "v")).alias("node"))
        return self.confirmed(tried, self.sets(F.broadcast(nodes) if tried.count() <= SENT else nodes.distinct()))

    def labels(self, links: DataFrame, before: DataFrame | None = None) -> DataFrame:
        """Components of the links and, with them, of those known before, whose labels alone are linked anew."""
        if before is None:
            found = connected(links, self.slots, SENT)
        else:
            known = before.select(F.col("node").alias("known"), "label")
            for end in ("u", "v"):
                links = links.join(known, F.col(end) == F.col("known"), "left").withColumn(end, F.coalesce("label", end)).select("u", "v")
            more = _sent(self.slots.put("joined", connected(links, self.slots, SENT)))
            again = more.select(F.col("node").alias("was"), F.col("label").alias("root"))
            found = before.join(again, F.col("label") == F.col("was"), "left").select("node", F.coalesce("root", "label").alias("label"))
            found = found.unionByName(more.join(before, "node", "left_anti"))
        found = _sent(self.slots.put("labels", found))
        self.slots.drop("edges", "hung", "rooted", "joined", "links", "candidates")
        return found

    def mixed(self, members: DataFrame, labels: DataFrame) -> DataFrame:
        """Members of buckets with several components: (key, node, label, largest, members).

        They are written in place of those of the round before, which hold them all.
        """
        labelled = members.select("key", "node").join(labels, "node", "left")
        labelled = labelled.select("key", "node", F.coalesce("label", "node").alias("label"))
        sizes = labelled.groupBy("key", "label").agg(F.count("*").alias("size"))
        tops = sizes.groupBy("key").agg(
            F.max(F.struct("size", "label")).alias("top"), F.count("*").alias("labels"), F.sum("size").alias("members")
        )
        tops = tops.where("labels > 1").select("key", F.col("top.label").alias("largest"), "members")
        tops = _sent(self.slots.put("tops", tops))
        return self.slots.put("open", labelled.join(tops, "key"))

    def retried(self, open_: DataFrame, attempt: int) -> DataFrame:
        """Links of another member of each crowded bucket's largest component with those outside of it."""
        crowded = open_.where(F.col("members") > CROWD)
        draw = F.min_by("node", F.xxhash64("node", F.lit(attempt)))
        leaders = crowded.where("label = largest").groupBy("key").agg(draw.alias("leader"))
        pairs = crowded.where("label <> largest").join(_sent(self.slots.put("leaders", leaders)), "key")
        return self.checked(pairs.select(F.col("node").alias("u"), F.col("leader").alias("v")))

    def unsettled(self, open_: DataFrame) -> DataFrame | None:
        """Links between components that the buckets' first links did not find.

        Two classes of one bucket and different components meet unless both lie in the
        bucket's largest component. Those whose sketches allow a link to any other are
        found by semi-joins, which give each class once. A shingle that no other of these
        classes has cannot be shared: what is left of a set bounds its overlap with any
        other, and with it the classes and pairs that are looked at; of these, finer odd
        sketches leave those near the similarity asked for.
        """
        open_ = self.slots.put("sketched", open_.drop("members").join(self.sketches, "node"))
        outside = open_.where("label <> largest")
        meet = (F.col("a.key") == F.col("b.key")) & (F.col("a.label") != F.col("b.label")) & _alike(self.percent)
        ones = outside.alias("a").join(open_.alias("b"), meet, "left_semi").select("node")
        others = open_.alias("b").join(outside.alias("a"), meet, "left_semi").select("node")
        sets = self.sets(ones.union(others).distinct())
        if sets.isEmpty():
            return None
        each = sets.select("node", F.explode("shingles").alias("shingle"))
        repeated = each.groupBy("shingle").agg(F.count("*").alias("classes")).where("classes > 1")
        most = each.join(repeated, "shingle", "left_semi").groupBy("node").agg(F.count("*").alias("most"))
        bounded = self.slots.put("bounded", open_.join(most, "node"))
        outside = bounded.where("label <> largest")
        overlap = F.least("a.most", "b.most")
        possible = meet & (100 * overlap >= self.percent * (F.col("a.n") + F.col("b.n") - overlap))
        # Places in buckets, not classes alone: what follows goes only where a partner is possible.
        ones = outside.alias("a").join(bounded.alias("b"), possible, "left_semi").select("key", "node")
        others = bounded.alias("b").join(outside.alias("a"), possible, "left_semi").select("key", "node")
        near = self.slots.put("near", ones.union(others).distinct())
        close_ones = _sent(self.slots.put("close", near.select("node").distinct()))
        # As many tasks as cores have a use for: a fine sketch takes long, and the sets are few.
        spread = sets.join(close_ones, "node", "left_semi").repartition(4 * sets.sparkSession.sparkContext.defaultParallelism, "node")
        fine = spread.mapInArrow(_fine_sketches, "node long, fine array<bigint>")
        fine = self.slots.put("fine", fine.join(self.bands.join(close_ones, "node", "left_semi"), "node"))
        placed = bounded.join(near, ["key", "node"], "left_semi")
        once = (F.col("b.label") == F.col("b.largest")) | (F.col("a.node") < F.col("b.node"))
        # Each pair counts in the first bucket it shares, not in all of them.
        first = F.get(F.array_intersect("a.bands", "b.bands"), F.lit(0)) == F.col("a.key")
        apart = F.zip_with("a.fine", "b.fine", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
        differing = F.aggregate(apart, F.lit(0), lambda total, n: total + n)
        close = differing <= differing_bits(FINE_SIFT, FINE_WORDS, FINE * SAMPLES)
        met = placed.where("label <> largest").join(fine, "node").alias("a").join(
            placed.join(fine, "node").alias("b"), possible & once & first & close
        )
        pairs = met.select(F.least("a.node", "b.node").alias("u"), F.greatest("a.node", "b.node").alias("v"))
        return self.confirmed(pairs.distinct(), sets)


def labelled(docs: DataFrame, width: int = 5, percent: int = 80, carry: tuple[str, ...] = ()) -> DataFrame:
    """Each document as (doc_id, those to carry, ``n``, ``d1``, ``d2``, ``root``, ``component_id``), without its text.

    ``n`` is the size of its set and ``d1`` and ``d2`` are 128 bits of it; documents of one ``root``
    are one component. A document without words has no root. See ``group``.

    ``docs`` is read again for the sets of candidates. Sketches are written once, and every
    table of a round is deleted when the next one has taken its place.
    """
    slots = Slots(docs.sparkSession)
    docs = docs.select("doc_id", *carry, "text")
    kinds = dict(docs.dtypes)
    names = "".join(f"{name} {kinds[name]}, " for name in ("doc_id", *carry))
    names += "n long, d1 long, d2 long, " + "".join(f"s{j} long, " for j in range(SKETCH_WORDS)) + "bands array<bigint>"
    sketched = slots.put("sketches", docs.mapInArrow(functools.partial(_sketches, width=width), names))
    ids = slots.put("ids", sketched.drop("bands", *(f"s{j}" for j in range(SKETCH_WORDS))))
    rest = ("n", *(f"s{j}" for j in range(SKETCH_WORDS)), "bands")
    classes = sketched.where("n > 0").groupBy("d1", "d2").agg(*(F.first(c).alias(c) for c in rest), F.min("doc_id").alias("least"))
    classes = slots.put("classes", classes.withColumn("node", F.monotonically_increasing_id()))
    slots.drop("sketches")
    total, distinct = ids.groupBy("doc_id").agg(F.count("*").alias("n")).agg(F.sum("n"), F.count("doc_id")).first()
    links = _Links(docs, classes, total != distinct, width, percent, slots)

    # Counts are combined before the shuffle, and the join's own one may be split where a bucket is hot.
    members = classes.select("node", F.explode("bands").alias("key"))
    shared = members.groupBy("key").agg(F.min("node").alias("leader"), F.count("*").alias("members")).where("members > 1")
    members = slots.put("open", members.join(shared.drop("members"), "key"))
    labels = links.labels(links.checked(members.where("node > leader").select(F.col("leader").alias("u"), F.col("node").alias("v"))))
    members = links.mixed(members, labels)
    for attempt in range(RETRIES):
        more = links.retried(members, attempt)
        if more.isEmpty():
            break
        labels = links.labels(more, labels)
        members = links.mixed(members, labels)
    more = links.unsettled(members)
    if more is not None and not more.isEmpty():
        labels = links.labels(more, labels)
    slots.drop("open", "sketched", "bounded", "near", "close", "fine", "sets", "involved", "links", "pairs", "candidates", "tops", "leaders")

    rooted = classes.select("d1", "d2", "least", "node").join(labels, "node", "left").withColumn("root", F.coalesce("label", "node"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    result = slots.put("components", rooted.join(least, "root").select("d1", "d2", "root", "component_id"))
    slots.drop("classes", "labels")
    named = ids.join(result, ["d1", "d2"], "left")
    return named.withColumn("component_id", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")))


def _keepers(found: DataFrame) -> DataFrame:
    """Of each component the document that stays, as (doc_id, d1, d2); several rows may be that document."""
    own = found.where(F.col("root").isNotNull() & F.col("doc_id").eqNullSafe(F.col("component_id")))
    chosen = own.groupBy("root").agg(F.first("doc_id").alias("doc_id"), F.min(F.struct("d1", "d2")).alias("set"))
    return chosen.select("doc_id", "set.d1", "set.d2")


def group(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The documents with ``row`` (a number of their own), ``n_shingles``, ``component_id`` and ``keeper``.

    Documents are linked when their sets of ``width``-word shingles have a Jaccard
    similarity of ``percent`` or more; ``component_id`` is the least doc_id that links
    reach, and ``keeper`` is true for one row of each component: one that has this id.
    Words are runs of non-white-space, A-Z in lower case; a text of fewer words is one
    shingle. Texts without words are linked with nothing.

    Equal sets are one class, and only classes are compared. Each band's bucket first
    links its members to its least one, and in a few more rounds to others, so that a
    bucket of n classes costs n pairs a round; only buckets that still hold several
    components go on to the next round. What is left of them then is looked at pair by pair
    (see ``_Links.unsettled``). No bucket is cut off. Full sets confirm each pair; bands and
    sketches, which propose, may miss a pair with the small probabilities stated at their
    sizes.

    Here the documents are written to the shared folder once, for the numbers;
    ``labelled`` and ``drop_duplicates`` do without. A null text has no words. Repeated
    rows share a class; one of them is the keeper. Rows without doc_id count last in a component,
    which has no id if all its rows lack one. An empty table gives no rows. Other columns
    are kept; one named like a result is replaced.
    """
    made = ("row", "n_shingles", "component_id", "keeper")
    docs = docs.select(*(c for c in docs.columns if c not in made))
    numbered = materialise(docs.withColumn("row", F.monotonically_increasing_id()), "documents")
    found = materialise(labelled(numbered, width, percent, carry=("row",)), "labelled")
    keepers = _keepers(found).withColumnRenamed("doc_id", "kept_id")
    same = (found["d1"] == keepers["d1"]) & (found["d2"] == keepers["d2"]) & found["doc_id"].eqNullSafe(keepers["kept_id"])
    first = found.join(keepers, same, "left_semi").groupBy("d1", "d2", "doc_id").agg(F.min("row").alias("row"))
    marked = found.join(first.select("row", F.lit(True).alias("first")), "row", "left")
    marked = marked.select(
        "row", F.col("n").alias("n_shingles"), "component_id", (F.col("first").isNotNull() | (F.col("n") == 0)).alias("keeper")
    )
    return numbered.join(materialise(marked, "marks"), "row")


def drop_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, with its own columns; those without words all stay.

    Documents with an id of their own are kept by it. Of those whose id others have too, or
    that have none, the digest of the set tells which is meant, and one of equal ones stays.
    """
    own, back = own_names(docs, "doc_id", "text")
    found = materialise(labelled(own.select("doc_id", "text"), width, percent), "labelled")
    chosen = _keepers(found)
    wordless = found.where("n = 0").select("doc_id", "d1", "d2")
    kept = materialise(chosen.union(wordless.distinct()), "kept")
    several = found.groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1 or doc_id is null").select("doc_id")
    several = materialise(several, "several")
    if several.isEmpty():
        return back(own.join(kept.select("doc_id"), "doc_id", "left_semi"))
    one = own.join(kept.join(several, "doc_id", "left_anti").select("doc_id"), "doc_id", "left_semi")
    # Null ids equal each other here.
    rows = own.join(several.withColumnRenamed("doc_id", "other"), F.col("doc_id").eqNullSafe(F.col("other")), "left_semi")
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields)
    rows = rows.mapInArrow(functools.partial(_with_digests, width=width), f"{types}, n long, d1 long, d2 long")
    names = kept.select(F.col("doc_id").alias("kept_id"), F.col("d1").alias("k1"), F.col("d2").alias("k2"))
    same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("d1") == F.col("k1")) & (F.col("d2") == F.col("k2"))
    rows = rows.join(names, same, "left_semi")
    order = Window.partitionBy("doc_id", "d1", "d2").orderBy(F.xxhash64("text"))
    numbered = rows.where("n > 0").withColumn("place", F.row_number().over(order)).where("place = 1")
    rest = numbered.select(*own.columns).unionByName(rows.where("n = 0").select(*own.columns))
    return back(one.unionByName(rest))
