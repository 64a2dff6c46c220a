"""Personal data in texts, and the words around it that would give it away."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from undercut.llm.columns import own_names
from undercut.shared import materialise

# Patterns with possessive repeats, which neither backtrack nor recurse. A match can only
# begin where a run of its first characters begins or where the last match ended (\G), so
# that long runs are passed once. Numbers too short for a card are no matches.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[\x20-]?+[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = tuple(PATTERNS)
#: A sign that every match of a kind has, looked for before its pattern is tried.
SIGNS = {"email": "@", "ip": ".", "phone": "+"}
#: Words on either side of a value that count as its surroundings, however long. They are
#: looked for within so many characters at first, then, where that holds too few, in more.
AROUND, NEAR = 5, (200, 4000)
#: A word discloses a value if, of all its occurrences, such a share is in surroundings of
#: that value, in so many distinct texts at least.
DISCLOSED, TEXTS = 0.5, 3
#: Letters of a word that its generalisation keeps.
STEM = 3
TERM = "term"
BETWEEN = r"[\s.,;:!?()\[\]{}\"'<>|]+"
WORD = r"[^\s.,;:!?()\[\]{}\"'<>|]+"
#: In this order spans sort as the contract lists them: by start, then kind.
SPAN = "struct<start:int,rank:int,end:int,kind:string,value:string>"
#: Matches or spans gone through in one step; lists are put together from such blocks.
BLOCK = 128


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the checksum of a card number holds."""
    values = F.filter(F.split(F.reverse(digits), ""), lambda d: d != "")
    values = F.transform(values, lambda d, i: F.struct(d.cast("int").alias("d"), (i % 2).alias("odd")))
    total = F.aggregate(
        values,
        F.lit(0),
        lambda s, x: s + F.when(x["odd"] == 0, x["d"]).otherwise(2 * x["d"] - F.when(x["d"] > 4, 9).otherwise(0)),
    )
    return total % 10 == 0


def _is(kind: str, match: Column) -> Column:
    """Whether a match of the pattern is of the kind."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        parts = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.substring(p, 1, 3).cast("int") <= 255))
    n = F.length(_digits(match))
    if kind == "phone":
        return n.between(9, 15)
    return F.when(n.between(12, 19), _luhn(_digits(match))).otherwise(F.lit(False))


def _passing(kind: str):
    return lambda span: _is(kind, span["value"])


def of_kind(spans: str, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def _blocks(column: str) -> Column:
    """An array column in blocks. It is named twice, so it is computed before this."""
    last = F.floor((F.greatest(F.size(column), F.lit(1)) - 1) / BLOCK).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(F.col(column), b * BLOCK + 1, BLOCK))


def _none() -> Column:
    return F.array().cast(f"array<{SPAN}>")


def with_spans(df: DataFrame, into: str, pattern: str, kind: str, rank: int, present: Column) -> DataFrame:
    """All matches of a pattern in ``text`` with their places in code points, as array ``into``.

    The stretches between matches and the matches come from one pattern, so their lengths
    add up to the places: within blocks first, then over blocks.
    """
    text = F.when(present, F.col("text"))
    gaps, matches = F.split(text, pattern), F.regexp_extract_all(text, F.lit(pattern), 0)
    pair = lambda g, v: F.struct(F.length(g).alias("gap"), v.alias("value"))
    df = df.withColumn("_pairs", F.when(present, F.zip_with(F.slice(gaps, F.lit(1), F.size(matches)), matches, pair)))

    def step(state, x):
        begin = state["at"] + x["gap"]
        end = begin + F.length(x["value"])
        parts = (begin.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"), x["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(F.struct(*parts))).alias("spans"))

    def lift(state, block):
        moved = F.transform(
            block["spans"],
            lambda s: F.struct(
                (s["start"] + state["at"]).alias("start"), s["rank"], (s["end"] + state["at"]).alias("end"), s["kind"], s["value"]
            ),
        )
        return F.struct((state["at"] + block["at"]).alias("at"), F.concat(state["done"], F.array(moved)).alias("done"))

    nothing = F.struct(F.lit(0).alias("at"), _none().alias("spans"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{SPAN}>>").alias("done"))
    within = F.transform(_blocks("_pairs"), lambda block: F.aggregate(block, nothing, step))
    placed = F.flatten(F.aggregate(within, start, lift, lambda s: s["done"]))
    return df.withColumn(into, F.when(F.size("_pairs") > 0, placed).otherwise(_none())).drop("_pairs")


def base_spans(docs: DataFrame) -> DataFrame:
    """The documents with ``base``: spans of addresses, card and phone numbers by start, then kind."""
    docs = docs.withColumn("text", F.coalesce(F.col("text"), F.lit("")))
    found = docs
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        sign = F.col("text").contains(SIGNS[kind]) if kind in SIGNS else F.lit(True)
        found = found.withColumn(f"_has_{kind}", sign & F.col("text").rlike(pattern))
        found = with_spans(found, f"_{kind}", pattern, kind, rank, F.col(f"_has_{kind}"))
    kinds = [F.filter(f"_{kind}", _passing(kind)) for kind in KINDS]
    return found.select(*docs.columns, F.array_sort(F.concat(*kinds)).alias("base"))


def word_counts(docs: DataFrame, stems: DataFrame) -> DataFrame:
    """Occurrences in the whole corpus of all words that begin with one of the stems.

    Partial sums by word leave each task, one row for each of its words.
    """
    words = docs.select(F.explode(F.split(F.lower("text"), BETWEEN)).alias("word")).where("word <> ''")
    counts = words.groupBy("word").agg(F.count("*").alias("n"))
    return counts.withColumn("stem", F.substring("word", 1, STEM)).join(stems, "stem")


def surroundings(text: Column, start: Column, end: Column) -> tuple[Column, Column]:
    """The AROUND words before a span, nearest first, and those after it, as in the whole text.

    A word at the edge of a stretch may be cut, so a stretch counts if it has one word more,
    or ends where the text does.
    """
    words = lambda stretch: F.regexp_extract_all(F.lower(stretch), F.lit(WORD), 0)
    left = F.slice(F.reverse(words(F.substring(text, F.lit(1), start))), 1, AROUND)
    right = F.slice(words(F.substring(text, end + 1, F.length(text))), 1, AROUND)
    for n in reversed(NEAR):
        before, after = words(F.substring(text, start - n + 1, F.lit(n))), words(F.substring(text, end + 1, F.lit(n)))
        left = F.when((start > n) & (F.size(before) > AROUND), F.slice(F.reverse(before), 1, AROUND)).otherwise(left)
        right = F.when(F.size(after) > AROUND, F.slice(after, 1, AROUND)).otherwise(right)
    return left, right


def disclosing_words(docs: DataFrame, found: DataFrame, share: float = DISCLOSED, texts: int = TEXTS) -> DataFrame:
    """(value, word, generalised): words that give away a value.

    ``docs`` is the corpus; ``found`` has the texts with base spans. For a word w and a
    protected value v, p(v | w) is the share of w's occurrences in the corpus that lie in
    surroundings of v. The pointwise mutual information of both is v's own information,
    -log p(v), less -log p(v | w). A word discloses v if no more than -log(share) of that
    information is missing and they meet in ``texts`` distinct texts: one text and its
    copies say nothing. It is generalised to its first letters if all words that begin
    so, taken together, stay under the share; otherwise it is to be removed.
    """
    near = found.select("t1", "text", F.explode("base").alias("span"))
    left, right = surroundings(F.col("text"), F.col("span.start"), F.col("span.end"))
    meetings = near.select("t1", F.col("span.value").alias("value"), F.explode(F.concat(left, right)).alias("word"))
    counts = meetings.groupBy("value", "word", "t1").agg(F.count("*").alias("n"))
    counts = counts.groupBy("value", "word").agg(F.sum("n").alias("met"), F.count("*").alias("texts"))
    counts = counts.where(F.col("texts") >= texts).withColumn("stem", F.substring("word", 1, STEM))
    candidates = materialise(counts, "meetings")
    totals = materialise(word_counts(docs, candidates.select("stem").distinct()), "words")
    by_stem = totals.groupBy("stem").agg(F.sum("n").alias("stem_n"))
    met_stem = candidates.groupBy("value", "stem").agg(F.sum("met").alias("stem_met"))
    judged = candidates.join(totals.select("word", "n"), "word").where(F.col("met") >= share * F.col("n"))
    judged = judged.join(met_stem, ["value", "stem"]).join(by_stem, "stem")
    wider = (F.col("stem_met") < share * F.col("stem_n")) & (F.length("word") > STEM)
    return judged.select("value", "word", F.when(wider, F.concat("stem", F.lit("*"))).otherwise("").alias("generalised"))


def find(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """The documents with ``base`` and ``added``: spans of personal data, and of words that disclose it.

    Base spans are the leftmost matches of each kind that pass its test. A span is added
    for each word of any text that discloses a value of the corpus (see
    ``disclosing_words``), whether or not the text holds the value, unless the span
    touches a base span; its value is the replacement. Places are in code points, ends
    exclusive. Distinct words of each text meet the disclosing words, one row each, in an
    equi-join: those are broadcast only below the session's threshold, and hot words are
    split otherwise.

    ``carry`` names the columns that come along (all by default). A null text counts as
    empty and stays null. Repeated rows are treated alike; copies of a text count once
    as evidence. An empty table gives no rows. A column named like a result is replaced.
    """
    made = ("base", "added", "t1", "t2")
    carry = [c for c in (docs.columns if carry is None else carry) if c not in made]
    rows = docs.select(*(c for c in docs.columns if c in carry or c == "text"), F.col("text").isNull().alias("_null"))
    rows = base_spans(rows).withColumns({"t1": F.xxhash64("text"), "t2": F.xxhash64(F.lit("second"), F.col("text"))})
    rows = materialise(rows, "spans")
    given = disclosing_words(docs.select("text"), rows.where("size(base) > 0").select("t1", "text", "base"))
    # A word may give away two values with different outcomes; the least, removal, wins.
    given = materialise(given.groupBy("word").agg(F.min("generalised").alias("generalised")), "disclosing")
    words = rows.select("t1", "t2", F.explode(F.array_distinct(F.split(F.lower("text"), BETWEEN))).alias("word"))
    terms = words.where("word <> ''").join(given, "word").groupBy("t1", "t2")
    terms = terms.agg(F.map_from_entries(F.array_sort(F.collect_set(F.struct("word", "generalised")))).alias("_terms"))
    joined = rows.join(terms, ["t1", "t2"], "left")
    joined = with_spans(joined, "_words", WORD, TERM, len(KINDS), F.col("_terms").isNotNull())
    # Only spans of the text's own terms are left before anything is compared with the base.
    named = F.filter("_words", lambda s: F.array_contains(F.map_keys("_terms"), F.lower(s["value"])))
    joined = joined.withColumn("_named", named)
    apart = F.filter("_named", lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    added = F.transform(
        apart,
        lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"], F.element_at("_terms", F.lower(s["value"])).alias("value")),
    )
    joined = joined.withColumn("added", F.coalesce(added.cast(f"array<{SPAN}>"), _none()))
    if "text" in carry:
        joined = joined.withColumn("text", F.when(~F.col("_null"), F.col("text")))
    return joined.select(*carry, "base", "added")


def span_list(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def sanitise(docs: DataFrame) -> DataFrame:
    """The documents with personal data replaced by its kind and disclosing words generalised or removed.

    ``n_chars`` follows the text where the table has it. Overlapping spans are replaced
    by the first one's kind. A text is put together in blocks of spans, so that the work
    stays near its length.
    """
    own, back = own_names(docs, "text", "n_chars")
    df = find(own).withColumn("_all", F.array_sort(F.concat("base", "added")))

    def inner(outer, segment):
        def step(state, s):
            label = F.when(s["kind"] == TERM, s["value"]).otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
            before = F.substring(segment, state["at"] - outer + 1, s["start"] - state["at"])
            piece = F.when(s["start"] >= state["at"], F.concat(before, label)).otherwise("")
            return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.concat(state["out"], piece).alias("out"))

        return step

    def outer(state, block):
        end = F.greatest(state["at"], F.array_max(F.transform(block, lambda s: s["end"])))
        segment = F.substring("text", state["at"] + 1, end - state["at"])
        begin = F.struct(state["at"].alias("at"), F.lit("").alias("out"))
        done = F.aggregate(block, begin, inner(state["at"], segment), lambda s: s["out"])
        return F.struct(end.alias("at"), F.concat(state["done"], F.array(done)).alias("done"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("done"))
    rest = lambda s: F.concat(F.array_join(s["done"], ""), F.substring("text", s["at"] + 1, F.length("text")))
    df = df.withColumn("text", F.when(F.size("_all") > 0, F.aggregate(_blocks("_all"), start, outer, rest)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        df = df.withColumn("n_chars", F.when(F.size("_all") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return back(df)
