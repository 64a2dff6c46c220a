"""Packing documents into training sequences: dominance reduction, then best fit.

Decisions are made on the number of pieces of each length, of which there are at most as
many as tokens fit into a sequence, whatever the corpus; pieces then find their places by
their rank among the pieces of the same length.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from undercut.llm.textbytes import slices
from undercut.llm.tokens import encoder
from undercut.shared import materialise

END_ID = 2
#: Bytes of text that are encoded together: equal words in them are looked up once.
AT_ONCE = 4 << 20
PIECES = "doc_id {id}, piece int, start long, length int, ids_crc32 long, ids binary, part int, rank long"


class Plan:
    """Places for pieces of each length, as runs of (rank from, pieces, sequence, pieces each, offset)."""

    def __init__(self, counts: list[int], capacity: int):
        self.capacity, self.left = capacity, list(counts)
        self.used = [0] * (capacity + 1)
        self.runs: list[tuple[int, int, int, int, int, int]] = []
        self.sequences = 0
        self._reduce()
        self.fixed = self.sequences
        self._best_fit()

    def _place(self, length: int, pieces: int, sequence: int, each: int, offset: int) -> None:
        self.runs.append((length, self.used[length], pieces, sequence, each, offset))
        self.used[length] += pieces
        self.left[length] -= pieces

    def _fix(self, lengths: list[int], times: int) -> None:
        """``times`` sequences that hold just these lengths."""
        offset = 0
        if len(lengths) == 2 and lengths[0] == lengths[1]:
            self._place(lengths[0], 2 * times, self.sequences, 2, 0)
        else:
            for length in lengths:
                self._place(length, times, self.sequences, 1, offset)
                offset += length
        self.sequences += times

    def _others(self, length: int) -> tuple[int, int]:
        """The two smallest pieces left beside one of ``length``; beyond any capacity if there are none."""
        found = []
        for other in range(1, self.capacity + 1):
            n = self.left[other] - (other == length)
            found += [other] * min(n, 2 - len(found))
            if len(found) == 2:
                return found[0], found[1]
        return (*found, *[self.capacity + 1] * 2)[:2]

    def _pairs(self, length: int, mate: int) -> int:
        return self.left[length] // 2 if mate == length else min(self.left[length], self.left[mate])

    def _dominating(self, length: int) -> tuple[list[int], int] | None:
        """A set that dominates all others with a piece of ``length``, and how often it may be fixed.

        A mate that fills the sequence dominates: whatever else would go along weighs no
        more and could take the mate's place. If nothing goes along, the piece is alone;
        if only one piece can, the largest that fits dominates the smaller ones.
        """
        room = self.capacity - length
        if room == 0:
            return [length], self.left[length]
        if times := self._pairs(length, room):
            return [length, room], times
        smallest, next_one = self._others(length)
        if smallest > room:
            return [length], self.left[length]
        if smallest + next_one > room:
            mate = next(k for k in range(room, 0, -1) if self._pairs(length, k))
            return [length, mate], self._pairs(length, mate)
        return None

    def _reduce(self) -> None:
        changed = True
        while changed:
            changed = False
            for length in range(self.capacity, 0, -1):
                while self.left[length] and (found := self._dominating(length)):
                    self._fix(*found)
                    changed = True

    def _best_fit(self) -> None:
        """Longest first, each into the fullest sequence that has room; equal ones at a time."""
        capacity = self.capacity
        open_: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by room: first sequence, number
        for length in range(capacity, 0, -1):
            while left := self.left[length]:
                room = next((r for r in range(length, capacity) if open_[r]), None)
                if room is None:
                    room, first, number = capacity, self.sequences, max(1, left // (capacity // length))
                    self.sequences += number
                else:
                    first, number = open_[room].pop()
                each = room // length
                full = min(number, left // each)
                if full:
                    self._place(length, full * each, first, each, capacity - room)
                    open_[room - each * length].append((first, full))
                    first, number = first + full, number - full
                if number and (rest := min(self.left[length], each - 1)) and not full:
                    self._place(length, rest, first, rest, capacity - room)
                    open_[room - rest * length].append((first, 1))
                    first, number = first + 1, number - 1
                if number:
                    open_[room].append((first, number))

    def arrays(self) -> np.ndarray:
        """The runs by length and rank."""
        return np.array(sorted(self.runs), np.int64).reshape(-1, 6)


def _cut(batches: Iterator[pa.RecordBatch], path: str, capacity: int, keep_ids: bool) -> Iterator[pa.RecordBatch]:
    """Pieces of each document, with their rank among those of the same length in this partition."""
    part, ranks, end = TaskContext.get().partitionId(), [0] * (capacity + 1), np.array([END_ID], "<u4").tobytes()
    for batch in batches:
        for rows in slices(batch, limit=AT_ONCE):
            texts = [t or "" for t in rows.column("text").to_pylist()]
            source, out = [], []
            for i, ids in enumerate(encoder(path).encode(texts)):
                ids += end
                n = len(ids) // 4
                start, piece = 0, 0
                while start < n:
                    length = (n - 1) % capacity + 1 if not start else capacity
                    data = ids[4 * start : 4 * (start + length)]
                    source.append(i)
                    out.append((piece, start, length, zlib.crc32(data), data if keep_ids else None, part, ranks[length]))
                    ranks[length] += 1
                    start, piece = start + length, piece + 1
            kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.int64())
            columns = [pa.array(values, kind) for values, kind in zip(zip(*out), kinds, strict=True)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids", "part", "rank"]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id").take(pa.array(source, pa.int32())), *columns], names)


def _places(batches: Iterator[pa.RecordBatch], runs: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The run of each piece by binary search, and its sequence and offset there."""
    order = runs[:, 0] << 48 | runs[:, 1]
    for batch in batches:
        length, rank = batch.column("length").to_numpy().astype(np.int64), batch.column("rank").to_numpy()
        run = runs[np.searchsorted(order, length << 48 | rank, side="right") - 1]
        within = rank - run[:, 1]
        sequence, offset = run[:, 3] + within // run[:, 4], run[:, 5] + within % run[:, 4] * length
        kept = [name for name in batch.schema.names if name != "rank"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(name) for name in kept), pa.array(sequence), pa.array(offset)], [*kept, "sequence_id", "offset"]
        )


def pack(docs: DataFrame, tokenizer: str, capacity: int = 1024, keep_ids: bool = False) -> DataFrame:
    """Every document's pieces with their sequence and their place in it.

    A document's ids, then the end id. One longer than ``capacity`` is cut into pieces of
    that length; its first piece takes what is over. ``keep_ids`` carries each piece's ids
    as little-endian unsigned 32-bit numbers.

    Pieces are written to the shared folder once, with ranks within their partition, and
    lifted to ranks in the corpus by counts per partition and length, so that no length,
    however common, meets in one task. The plan over lengths is made from at most
    ``capacity`` counts.

    A null or empty text is the end id alone. Repeated rows are packed each. An empty
    table gives no rows. Other columns are ignored.
    """
    kind = dict(docs.dtypes)["doc_id"]
    cut = functools.partial(_cut, path=tokenizer, capacity=capacity, keep_ids=keep_ids)
    pieces = materialise(docs.select("doc_id", "text").mapInArrow(cut, PIECES.format(id=kind)), "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    lifts = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("lift"))
    per_length = {row["length"]: row["n"] for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = Plan([per_length.get(length, 0) for length in range(capacity + 1)], capacity).arrays()
    ranked = pieces.join(lifts, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else []), (F.col("rank") + F.col("lift")).alias("rank")
    )
    kinds = {**dict(ranked.dtypes), "sequence_id": "long", "offset": "long"}
    kinds.pop("rank")
    schema = ", ".join(f"{name} {kind}" for name, kind in kinds.items())
    return ranked.mapInArrow(functools.partial(_places, runs=runs), schema)


def sequences(packed: DataFrame) -> DataFrame:
    """Whole sequences from pieces with ids: at most ``capacity`` tokens in a group."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"), F.aggregate(parts, F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids")
    )
