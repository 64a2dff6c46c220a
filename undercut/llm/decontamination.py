"""Benchmark passages in documents, found by winnowed fingerprints and extended word by word."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from undercut.llm.columns import own_names
from undercut.llm.textbytes import ALNUM, Words, grams, mix, slices

#: Words of a passage that counts as known.
SPAN = 13
HIT = "pos int, item_id {id}, at int, gram int, need int, around string"


def family(need: int) -> int:
    """The least span whose fingerprints serve spans of ``need`` words.

    One family serves all spans from 13 words, one those from 7 to 12; shorter spans are
    families of their own.
    """
    return SPAN if need >= SPAN else 7 if need >= 7 else need


def gram_size(kin: int) -> int:
    """Words in a fingerprinted gram of a family; a short span is a gram itself."""
    return {SPAN: 7, 7: 4}.get(kin, kin)


def winnow(words: Words, kin: int) -> tuple[np.ndarray, np.ndarray]:
    """Word indices and hashes of the grams kept in each text; all of equal least ones.

    The least gram hash is kept in every window of as many grams as the family's span
    holds, so that two equal spans keep the same gram. The family is part of the hash.
    """
    gram, rows = gram_size(kin), words.rows
    width = kin - gram + 1
    n = len(rows) - gram + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    found = mix(grams(words.hashes, gram) ^ np.uint64(kin))
    found[rows[:n] != rows[gram - 1 :]] = np.iinfo(np.uint64).max
    if n < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    least = found[: n - width + 1].copy()
    for j in range(1, width):
        np.minimum(least, found[j : n - width + 1 + j], out=least)
    least[rows[: n - width + 1] != rows[gram + width - 2 :]] = 0  # no window of one text
    kept = np.zeros(n, np.uint64)
    for j in range(width):
        np.maximum(kept[j : n - width + 1 + j], least, out=kept[j : n - width + 1 + j])
    at = np.flatnonzero((kept == found) & (found != np.iinfo(np.uint64).max))
    return at, found[at]


def _document_prints(batches: Iterator[pa.RecordBatch], families: list[int]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in slices(batch):
            words = Words(rows.column("text"), ALNUM)
            for kin in families:
                at, hashes = winnow(words, kin)
                pos = at - words.first[words.rows[at]]
                prints = pa.StructArray.from_arrays(
                    [pa.array(pos.astype(np.int32)), pa.array(hashes.view(np.int64))], ["pos", "hash"]
                )
                ends = np.searchsorted(at, words.first).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("t1"), rows.column("t2"), pa.ListArray.from_arrays(pa.array(ends), prints)], ["t1", "t2", "prints"]
                )


def _item_prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in slices(batch):
            words = Words(rows.column("text"), ALNUM)
            counts, source, out = words.counts, [], []
            for kin in sorted({family(min(SPAN, int(n))) for n in counts if n}):
                gram = gram_size(kin)
                for i, hashed in zip(*winnow(words, kin), strict=True):
                    row = int(words.rows[i])
                    first, n = int(words.first[row]), int(counts[row])
                    need = min(SPAN, n)
                    if family(need) != kin:
                        continue
                    pos = int(i) - first
                    left, right = max(0, pos - need + gram), min(n, pos + need)
                    around = b" ".join(words.word(first + j) for j in range(left, right)).decode()
                    source.append(row)
                    out.append((int(hashed.view(np.int64)), pos - left, gram, need, around))
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string())
            columns = [pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [rows.column("item_id").take(pa.array(source, pa.int32())), *columns],
                ["item_id", "hash", "at", "gram", "need", "around"],
            )


def _extended(words: list[bytes], hit: dict) -> tuple[int, int] | None:
    """The words that document and item share around a gram, if they are enough."""
    around, pos, at, gram = hit["around"].encode().split(b" "), hit["pos"], hit["at"], hit["gram"]
    if words[pos : pos + gram] != around[at : at + gram]:
        return None
    left = right = 0
    while left < min(at, pos) and words[pos - left - 1] == around[at - left - 1]:
        left += 1
    end, limit = pos + gram, min(len(words) - pos - gram, len(around) - at - gram)
    while right < limit and words[end + right] == around[at + gram + right]:
        right += 1
    return (pos - left, end + right) if left + gram + right >= hit["need"] else None


def _marked(batches: Iterator[pa.RecordBatch], item_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Documents with the number of words, the words hit, the hit spans and the items found."""
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        for rows in slices(batch):
            words = Words(rows.column("text"), ALNUM)
            counts, hits = words.counts, rows.column("hits")
            n_hit, spans, items = [0] * rows.num_rows, [[] for _ in range(rows.num_rows)], [[] for _ in range(rows.num_rows)]
            for i in np.flatnonzero(hits.is_valid().to_numpy(zero_copy_only=False)):
                own = [words.word(j) for j in range(words.first[i], words.first[i + 1])]
                mark, found = np.zeros(len(own) + 2, np.int8), {}
                for hit in hits[int(i)].as_py():
                    if (span := _extended(own, hit)) is not None:
                        mark[span[0] + 1 : span[1] + 1] = 1
                        found[hit["item_id"]] = None
                edges = np.flatnonzero(np.diff(mark))
                spans[i] = [{"start": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2], strict=True)]
                n_hit[i], items[i] = int(mark.sum()), list(found)
            kept = [name for name in rows.schema.names if name not in ("hits", "text")]
            columns = [
                pa.array(counts.astype(np.int64)), pa.array(n_hit, pa.int64()), pa.array(spans, spans_type),
                pa.array(items, pa.list_(item_type)),
            ]
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(name) for name in kept), *columns], [*kept, "n_words", "n_hit", "spans", "items"]
            )


def text_key(text: str = "text") -> dict[str, Column]:
    """128 bits that stand for a text."""
    return {"t1": F.xxhash64(F.col(text)), "t2": F.xxhash64(F.lit("second"), F.col(text))}


def find_passages(docs: DataFrame, benchmark: DataFrame, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in ``carry`` with the text's words, the words inside any benchmark window, their spans and the items.

    A window is 13 consecutive words of an item, or a shorter item whole. Fingerprints of
    documents meet those of the benchmark in one equi-join, which broadcasts the smaller
    side only below the session's threshold and splits hot fingerprints otherwise; hits
    carry the item's words around the gram, and are extended in the whole text. Equal
    texts are joined once and get the same result.

    A null text has no words. Items without words hold no window; an item with a null id
    hits words and stands in ``items`` as null. Repeated rows on either side change
    nothing but the number of rows returned. Empty tables give no rows, or no hits.
    Columns that are not named in ``carry`` are ignored.
    """
    docs = docs.select(*(F.col(c).alias(f"own_{i}") for i, c in enumerate(carry)), "text").withColumns(text_key())
    items = benchmark.select("item_id", "text")
    types = dict(docs.dtypes) | dict(items.dtypes)
    prints = items.mapInArrow(
        _item_prints, f"item_id {types['item_id']}, hash long, at int, gram int, need int, around string"
    ).distinct()
    families = sorted({family(row["need"]) for row in prints.select("need").distinct().collect()})  # 8 at most
    texts = docs.where("text is not null").select("text", "t1", "t2")
    found = texts.mapInArrow(
        functools.partial(_document_prints, families=families), "t1 long, t2 long, prints array<struct<pos:int,hash:bigint>>"
    ).select("t1", "t2", F.inline("prints"))
    hits = found.join(prints, "hash").groupBy("t1", "t2")
    fields = F.struct("pos", "item_id", "at", "gram", "need", "around")
    hits = hits.agg(F.collect_set(fields).alias("hits"))
    item_type = pa.schema(_arrow_field(items.schema["item_id"])).field(0).type
    own = [f"own_{i}" for i in range(len(carry))]
    schema = (
        "".join(f"{c} {types[c]}, " for c in own)
        + f"n_words long, n_hit long, spans array<struct<start:int,end:int>>, items array<{types['item_id']}>"
    )
    marked = docs.join(hits, ["t1", "t2"], "left").select(*own, "text", "hits").mapInArrow(
        functools.partial(_marked, item_type=item_type), schema
    )
    return marked.withColumnsRenamed(dict(zip(own, carry, strict=True)))


def _arrow_field(field):
    from pyspark.sql.pandas.types import to_arrow_type

    return [pa.field(field.name, to_arrow_type(field.dataType))]


def contaminated() -> Column:
    """At least a twentieth of the words are hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold too little of the benchmark, with their own columns."""
    own, back = own_names(docs, "text")
    return back(find_passages(own, benchmark, tuple(own.columns)).where(~contaminated()))
