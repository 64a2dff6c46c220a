"""Token counts from counts of distinct pre-tokens, without token ids of any document."""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from undercut.llm.language_model import frequent as most_frequent
from undercut.llm.textbytes import slices
from undercut.llm.tokens import library
from undercut.shared import materialise

#: Pre-tokens counted before they leave a task.
GATHERED = 300_000
#: The most frequent pre-tokens, of so many bytes at most, go to all tasks: 8 MB at most.
FREQUENT, SHORT = 1 << 18, 32


def pre_tokens(text: str) -> list[str]:
    """Runs without ASCII white space, which no piece of the tokenizer spans.

    Its normaliser turns white space into spaces and its pattern drops them; other white
    space stays inside a run and is left to the library.
    """
    for space in "\n\t\r":
        text = text.replace(space, " ")
    return [part for part in text.split(" ") if part]


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: Counter[str] = Counter()

    def counted() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], ["unit", "n"])

    for batch in batches:
        for rows in slices(batch):
            for text in rows.column("text").to_pylist():
                found.update(pre_tokens(text or ""))
            if len(found) > GATHERED:
                yield counted()
                found.clear()
    yield counted()


def _count(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """The number of pieces of each distinct pre-token, by the library."""
    for batch in batches:
        for rows in slices(batch, "unit", 1 << 20):
            found = library(path).encode_batch_fast(rows.column("unit").to_pylist(), add_special_tokens=False)
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array([len(x) for x in found], pa.int64())], [*rows.schema.names, "pieces"]
            )


def _split(batches: Iterator[pa.RecordBatch], frequent: dict[str, int]) -> Iterator[pa.RecordBatch]:
    """Each document's tokens in frequent pre-tokens, and how often it has which others."""
    element = pa.struct([("unit", pa.string()), ("n", pa.int64())])
    for batch in batches:
        for rows in slices(batch):
            tokens, sizes, ends, units, times = [], [], [0], [], []
            for text in rows.column("text").to_pylist():
                text, total = text or "", 0
                for unit, n in Counter(pre_tokens(text)).items():
                    pieces = frequent.get(unit)
                    if pieces is None:
                        units.append(unit)
                        times.append(n)
                    else:
                        total += n * pieces
                tokens.append(total)
                sizes.append(len(text.encode()))
                ends.append(len(units))
            rare = pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()),
                pa.StructArray.from_arrays([pa.array(units, pa.string()), pa.array(times, pa.int64())], fields=list(element)),
            )
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()), rare],
                ["doc_id", "n_bytes", "tokens", "rare"],
            )


def count_tokens(docs: DataFrame, tokenizer: str, frequent: int = FREQUENT) -> DataFrame:
    """Bytes and tokens of every document, as the library would count them.

    The corpus is reduced to distinct pre-tokens, which meet the library once each. The
    most frequent ones, a table of ``frequent`` rows at most whatever the partitions, are summed where the documents are; the rest of
    each document's pre-token frequencies is joined with the counts. Frequent pre-tokens
    are the hot keys of that join, so that none is left in it.

    A null or empty text has no bytes and no tokens. Repeated rows each get their own.
    An empty table gives no rows. Other columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    kind = dict(docs.dtypes)["doc_id"]
    units = docs.select("text").mapInArrow(_gather, "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n"))
    counted = units.mapInArrow(functools.partial(_count, path=tokenizer), "unit string, n long, pieces long")
    counted = materialise(counted, "pre-tokens")
    short = counted.where(F.octet_length("unit") <= SHORT)
    top = most_frequent(short, frequent).select("unit", "pieces").toArrow()
    split = functools.partial(_split, frequent=dict(zip(top["unit"].to_pylist(), top["pieces"].to_pylist())))
    schema = f"doc_id {kind}, n_bytes long, tokens long, rare array<struct<unit:string,n:bigint>>"
    rows = docs.mapInArrow(split, schema).withColumn("row", F.monotonically_increasing_id())
    # A first element without a unit stands for the document itself. It finds nothing in
    # the join, and its own number spreads such rows over all partitions.
    itself = F.array(F.struct(F.lit(None).cast("string").alias("unit"), F.lit(0).cast("long").alias("n")))
    rows = rows.select("row", "doc_id", "n_bytes", "tokens", F.posexplode(F.concat(itself, "rare")).alias("at", "x"))
    first = F.col("at") == 0
    rows = rows.select(
        "row",
        *(F.when(first, F.col(name)).alias(name) for name in ("doc_id", "n_bytes", "tokens")),
        F.col("x.unit").alias("unit"),
        F.col("x.n").alias("times"),
        F.when(first, F.col("row") + 1).otherwise(F.lit(0)).alias("own"),
    )
    known = counted.select("unit", "pieces", F.lit(0).cast("long").alias("own"))
    joined = rows.join(known, ["unit", "own"], "left")
    tokens = F.coalesce("tokens", F.col("times") * F.col("pieces"))
    summed = joined.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum(tokens).alias("n_tokens")
    )
    return summed.drop("row")
