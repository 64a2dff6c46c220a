"""Repeated passages, found as content-defined chunks with equal digests."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from undercut.llm.textbytes import SPACED, Words, mix, slices

#: The gear hash rolls over words: each shifts it by SHIFT of its 64 bits, so that COVERED
#: words have a say. A chunk begins where it is least in any run of WINDOW words, ties to
#: the last: every eight words or so, and never later than WINDOW. Those runs alone decide,
#: so copies of a passage of n words have n - COVERED - 2 * WINDOW + 1 words at least, 17 of
#: 51, in whole chunks that are the same.
COVERED, SHIFT, WINDOW = 3, 22, 16
#: Words of a run of repeated chunks that counts as a passage.
RUN_WORDS = 16
#: Where COVERED words or fewer go on and on, each such period is a chunk; further than
#: RUN_WORDS periods from both ends of the stretch, a chunk has so many of them.
PERIODS = 4


def units(words: Words) -> np.ndarray:
    """A hash for each word with the white space after it, which a text's last word is without."""
    if not len(words.starts):
        return words.hashes
    spaces = np.zeros(len(words.starts), np.uint64)
    wide = (words.starts[1:] - words.ends[:-1]).astype(np.uint64) << np.uint64(8)
    inner = words.rows[1:] == words.rows[:-1]
    spaces[:-1] = np.where(inner, wide + words.data[words.ends[:-1]], np.uint64(0))
    return mix(words.hashes + mix(spaces))


def gear_hashes(values: np.ndarray) -> np.ndarray:
    """At each word, the sum of the last words' values, each shifted by its age."""
    out = values.copy()
    for age in range(1, COVERED):
        out[age:] += values[:-age] << np.uint64(SHIFT * age)
    return out


def minima(hashes: np.ndarray, rows: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Words where a chunk begins, in order, given the text of each word and its place there."""
    least, width = np.arange(len(hashes)), 1
    while width < WINDOW:
        left, right = least[: max(0, len(least) - width)], least[width:]
        least, width = np.where(hashes[right] <= hashes[left], right, left), 2 * width
    begun = np.arange(len(least))
    inside = (places[begun] >= COVERED - 1) & (rows[begun] == rows[begun + WINDOW - 1])
    found = np.unique(least[inside])
    if not len(found):
        return found
    tied = (np.diff(hashes[found]) == 0) & (np.diff(found) <= COVERED) & (np.diff(rows[found]) == 0)
    order, no = np.arange(len(found)), np.array([False])
    first = np.maximum.accumulate(np.where(np.concatenate((no, tied)), 0, order))
    last = np.minimum.accumulate(np.where(np.concatenate((tied, no)), order[-1], order)[::-1])[::-1]
    into, left = order - first, last - order
    return found[(into <= RUN_WORDS) | (left <= RUN_WORDS) | ((into - RUN_WORDS) % PERIODS == 0)]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's chunks: byte offset, length, words begun in it, 128 bits of digest."""
    for batch in batches:
        for rows in slices(batch):
            words = Words(rows.column("text"), SPACED, lower=False)
            places = np.arange(len(words.starts)) - words.first[words.rows]
            begins = words.starts[minima(gear_hashes(units(words)), words.rows, places)]
            bounds = np.searchsorted(begins, words.texts)
            raw, offsets, firsts, digests, ends = memoryview(words.data), [], [], [], [0]
            for i in range(rows.num_rows):
                start, end = int(words.texts[i]), int(words.texts[i + 1]) - 1
                at = start
                for stop in [*begins[bounds[i] : bounds[i + 1]].tolist(), end]:
                    if stop > at:
                        offsets.append(at - start)
                        firsts.append((at, stop))
                        digests.append(xxhash.xxh3_128_digest(raw[at:stop]))
                        at = stop
                ends.append(len(offsets))
            spans = np.array(firsts, np.int64).reshape(-1, 2)
            begun = np.searchsorted(words.starts, spans)
            halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            chunks = pa.StructArray.from_arrays(
                [
                    pa.array(np.array(offsets, np.int32)),
                    pa.array((spans[:, 1] - spans[:, 0]).astype(np.int32)),
                    pa.array((begun[:, 1] - begun[:, 0]).astype(np.int32)),
                    pa.array(np.ascontiguousarray(halves[:, 0])),
                    pa.array(np.ascontiguousarray(halves[:, 1])),
                ],
                ["offset", "length", "words", "d1", "d2"],
            )
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("own"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), chunks)], ["doc_id", "own", "chunks"]
            )


def chunks(docs: DataFrame) -> DataFrame:
    """A row for each chunk of each text; concatenated they are the text."""
    own = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.lit(0).cast("long"))
    docs = docs.where("text is not null").select("doc_id", own.alias("own"), "text")
    kind = dict(docs.dtypes)["doc_id"]
    item = "struct<offset:int,length:int,words:int,d1:bigint,d2:bigint>"
    found = docs.mapInArrow(_chunks, f"doc_id {kind}, own long, chunks array<{item}>")
    return found.select("doc_id", "own", F.inline("chunks"))


def repeated_passages(docs: DataFrame, least_words: int = RUN_WORDS) -> DataFrame:
    """Runs of chunks that occur earlier in the corpus: where they are and where they were.

    The first occurrence of a chunk is that of the least (doc_id, offset), ids before
    null; every other one is a copy. Copies that follow on each other in a document make
    a run, which is returned when ``least_words`` words begin in it: doc_id, start and end
    in UTF-8 bytes, its words and chunks, and the document and place of its first chunk's
    first occurrence, with the least of the documents where its chunks came first. Removing
    the runs leaves each passage once in the corpus. A passage that repeats itself, such as
    one word over and over, is a copy of its own first chunk from there on, also in the
    document that has it first.

    Chunks begin at words that their surroundings choose (see ``WINDOW``), so a passage of
    51 words or more that occurs again, letter for letter, is always met by a run.

    Chunks are counted with partial sums, so that a chunk in a third of all documents is
    one row per task; only chunks that repeat at all are joined back, in an equi-join
    that may be split at hot digests.

    A null or empty text has no chunks. Repeated rows, with equal doc_id and text, are
    one document, and so are rows without doc_id that have equal texts. An empty table
    gives no rows. Other columns are ignored.
    """
    found = chunks(docs)
    place = F.struct(F.col("doc_id").isNull().alias("anonymous"), "doc_id", "own", "offset")
    firsts = found.groupBy("d1", "d2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    firsts = firsts.where(~F.col("first").eqNullSafe(F.col("last"))).select("d1", "d2", "first")
    copies = found.join(firsts, ["d1", "d2"]).where(~place.eqNullSafe(F.col("first"))).drop("d1", "d2").distinct()
    # Runs: the offset less all lengths of copies before is the same along a run.
    along = Window.partitionBy("doc_id", "own").orderBy("offset")
    run = F.col("offset") - F.coalesce(F.sum("length").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = copies.withColumn("run", run).groupBy("doc_id", "own", "run").agg(
        F.min("offset").cast("long").alias("start"),
        F.max(F.col("offset") + F.col("length")).cast("long").alias("end"),
        F.sum("words").alias("words"),
        F.count("*").alias("chunks"),
        F.min_by("first", "offset").alias("first"),
        F.min(F.col("first.doc_id")).alias("least_doc_id"),
    )
    return runs.where(F.col("words") >= least_words).select(
        "doc_id",
        "start",
        "end",
        "words",
        "chunks",
        F.col("first.doc_id").alias("first_doc_id"),
        F.col("first.offset").cast("long").alias("first_start"),
        "least_doc_id",
    )


def without_passages(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """The documents with their repeated runs cut out of the text; ids must be unique."""
    cuts = passages.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("cuts"))
    raw = F.col("text").cast("binary")
    kept = F.aggregate(
        "cuts",
        F.struct(F.lit(0).cast("long").alias("at"), F.lit(b"").alias("out")),
        lambda s, c: F.struct(
            c["end"].alias("at"),
            F.concat(s["out"], F.substring(raw, s["at"].cast("int") + 1, (c["start"] - s["at"]).cast("int"))).alias("out"),
        ),
        lambda s: F.concat(s["out"], F.substring(raw, s["at"].cast("int") + 1, F.length(raw))),
    )
    joined_ = docs.join(cuts, "doc_id", "left")
    return joined_.withColumn("text", F.when(F.col("cuts").isNull(), F.col("text")).otherwise(F.decode(kept, "UTF-8"))).select(docs.columns)
