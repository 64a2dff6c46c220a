"""Fill-in-the-middle samples: a pattern of counted quantifiers cuts and reorders a text in one match."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Units counted as one where a long text is counted, so that few pieces of it exist at a time.
BLOCK = 4096
#: Percentages of texts left as they are, and of the others that begin with the suffix.
PLAIN, SUFFIX_FIRST = 10, 20


def unit_count(text: Column) -> Column:
    """Code points of a text: matches of whole blocks, and of single units in what is left."""
    block = F.lit(f"(?s).{{{BLOCK}}}+")
    rest = F.regexp_replace(text, block, F.lit(""))
    return (F.regexp_count(text, block).cast("long") * BLOCK + F.regexp_count(rest, F.lit("(?s)."))).cast("long")


def draws(doc_id: Column, salt: str) -> list[Column]:
    """Eight unsigned 32-bit numbers that follow from an id; a null id draws as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(8)]


def _of_form(plain: str, psm: str, spm: str) -> Column:
    return F.when(F.col("form") == "plain", F.lit(plain)).when(F.col("form") == "psm", F.lit(psm)).otherwise(F.lit(spm))


def transform(docs: DataFrame, plain: int = PLAIN, suffix_first: int = SUFFIX_FIRST, salt: str = "1") -> DataFrame:
    """Every document as (doc_id, n, form, prefix_chars, middle_chars, output).

    A text of n code points is cut at two places drawn from its id. The pattern
    ``(.{a}+)(.{b-a}+)(.*+)``, made for each row, captures prefix, middle and suffix in one
    match, and the replacement of the row's form (``psm`` or ``spm``) puts them in order.
    Its quantifiers are possessive, so a match takes one pass whatever the text.

    A text that is empty, holds a marker, or is drawn for it stays ``plain``: as it is, with
    null lengths. A null text counts as empty and a null id as one without digits. Repeated
    rows give equal rows, an empty table none. Other columns are ignored.
    """
    first, second, kept, order, *_ = draws(F.col("doc_id"), salt)
    text = F.col("text")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("n", unit_count(text))
    cuts = [first % (F.col("n") + 1), second % (F.col("n") + 1)]
    marked = text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)
    form = F.when((F.col("n") == 0) | marked | (kept % 100 >= 100 - plain), "plain")
    form = form.when(order % 100 < suffix_first, "spm").otherwise("psm")
    rows = rows.select("doc_id", "text", "n", form.alias("form"), F.least(*cuts).alias("a"), F.greatest(*cuts).alias("b"))
    pattern = F.concat(
        F.lit(r"(?s)\A(.{"), F.col("a").cast("string"), F.lit("}+)(.{"), (F.col("b") - F.col("a")).cast("string"), F.lit(r"}+)(.*+)\z")
    )
    ordered = _of_form("$1$2$3", f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2", f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2")
    cut = F.col("form") != "plain"
    return rows.select(
        "doc_id",
        "n",
        "form",
        F.when(cut, F.col("a")).alias("prefix_chars"),
        F.when(cut, F.col("b") - F.col("a")).alias("middle_chars"),
        F.regexp_replace(text, pattern, ordered).alias("output"),
    )


def restored(output: Column) -> Column:
    """The text that an output was made from, by its column ``form``.

    A marker has no border of its own and the text holds none, so the first one found
    after the last part is the one that was set.
    """
    pattern = _of_form(
        r"(?s)\A(.*+)\z",
        rf"(?s)\A{PREFIX}(.*?){SUFFIX}(.*?){MIDDLE}(.*+)\z",
        rf"(?s)\A{SUFFIX}(.*?){PREFIX}(.*?){MIDDLE}(.*+)\z",
    )
    return F.regexp_replace(output, pattern, _of_form("$1", "$1$3$2", "$2$3$1"))
