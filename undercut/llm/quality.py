"""Quality rules as weak supervision: votes, estimated accuracies, posterior verdicts."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from undercut.llm.columns import own_names
from undercut.shared import materialise

SPACE = r"[ \t-\r]+"
#: EM steps, the accuracy every rule starts with, and the weight of that start in documents.
ROUNDS, START, START_WEIGHT = 25, 0.8, 10.0
MEASURES = "n_words word_chars n_symbols n_lines n_dup_lines n_repeat_words n_upper n_marks n_ends".split()
#: Votes: a good text, no opinion, a bad text.
GOOD, NONE, BAD = 1, 0, -1


def _neighbours(values: Column, make) -> Column:
    """``make`` over each value and the next one."""
    n = F.greatest(F.size(values) - 1, F.lit(0))
    return F.zip_with(F.slice(values, F.lit(1), n), F.slice(values, F.lit(2), n), make)


def measured(docs: DataFrame) -> DataFrame:
    """The documents with what the rules look at; one narrow pass without a shuffle.

    Words are runs of non-white-space. Repeated words lie in a 3-word window that occurs
    twice or more in the text. Windows are told apart by 64-bit hashes within one text.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.withColumns({"_text": text, "_words": F.filter(F.split(text, SPACE), lambda w: w != "")})
    df = df.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    last = F.greatest(F.size("_hashes") - 2, F.lit(0))
    df = df.withColumn(
        "_windows",
        F.zip_with(
            F.zip_with(
                F.slice("_hashes", F.lit(1), last), F.slice("_hashes", F.lit(2), last), lambda a, b: F.xxhash64(a, b)
            ),
            F.slice("_hashes", F.lit(3), last),
            lambda h, c: F.xxhash64(h, c),
        ),
    )
    df = df.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda line: line.rlike(r"[^ \t-\r]")))
    # Windows in the order of their hashes; equal neighbours are repeats. Positions of
    # both, in order, cover three words each, or as many as lie before the next one.
    df = df.withColumn("_repeats", F.size("_windows") > F.size(F.array_distinct("_windows")))
    repeats = F.col("_repeats")
    placed = F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("_placed", F.when(repeats, placed))
    pairs = _neighbours(F.col("_placed"), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    df = df.withColumn(
        "_at", F.when(repeats, F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull())))))
    )
    gaps = _neighbours(F.col("_at"), lambda a, b: F.least(b - a, F.lit(3)).cast("bigint"))
    covered = F.aggregate(gaps, F.lit(3).cast("bigint"), lambda total, gap: total + gap)
    letters = F.length("_text")

    def without(characters: str) -> Column:
        left = F.col("_text")
        for character in characters:
            left = F.replace(left, F.lit(character), F.lit(""))
        return F.length(left)

    measures = {
        "n_words": F.size("_hashes"),
        "word_chars": without(" \n\t\r\x0b\x0c"),
        "n_symbols": letters - without("#*$%&|<>"),
        "n_lines": F.size("_lines"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": F.when(repeats, covered).otherwise(F.lit(0)),
        "n_upper": letters - F.length(F.regexp_replace("_text", r"\p{Lu}+", "")),
        "n_marks": letters - without("!?"),
        "n_ends": F.regexp_count("_text", F.lit(r"[.!?](?=[ \t-\r]|$)")),
    }
    # Narrow rows from here on: the arrays are not carried along with the text.
    return df.select(*docs.columns, *(m.cast("long").alias(name) for name, m in measures.items()))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, F.lit(BAD)).when(good, F.lit(GOOD)).otherwise(F.lit(NONE)).cast("int")


def rule_votes() -> dict[str, Column]:
    """Each rule's vote on a measured document; shares are per word, character or line.

    Most rules know one defect and abstain on texts without it; ``prose`` also speaks for
    a text.
    """
    words, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    lines = F.greatest(F.col("n_lines"), F.lit(1))
    mean, upper = chars / words, F.col("n_upper") / chars
    symbols, marks = F.col("n_symbols") / words, F.col("n_marks") / words
    repeated, copied = F.col("n_repeat_words") / words, F.col("n_dup_lines") / lines
    sentence = words / F.greatest(F.col("n_ends"), F.lit(1))
    never = F.lit(False)
    prose = mean.between(3, 10) & (symbols < 0.05) & (marks < 0.1) & (upper < 0.3)
    return {
        "prose": _vote(prose & (sentence < 60), ~mean.between(2, 15)),
        "varied": _vote(never, (repeated > 0.4) | (copied > 0.4)),
        "symbols": _vote(never, symbols > 0.15),
        "capitals": _vote(never, upper > 0.5),
        "marks": _vote(never, marks > 0.3),
        "repetition": _vote(never, repeated > 0.3),
        "copied_lines": _vote(never, copied > 0.3),
    }


def _start(vote: int, good: bool) -> float:
    """The first opinion of a rule: it votes in half of all cases, and is right with START."""
    if vote == NONE:
        return 0.5
    return 0.5 * (START if (vote == GOOD) == good else 1 - START)


Votes = tuple[int, ...]
#: For each rule and class (good first), how likely each vote is.
Habits = list[list[dict[int, float]]]


def starting_habits(rules: int) -> Habits:
    return [[{v: _start(v, good) for v in (GOOD, NONE, BAD)} for good in (True, False)] for _ in range(rules)]


def estimate(patterns: list[Votes], counts: list[int], rules: int, rounds: int = ROUNDS) -> tuple[float, Habits]:
    """Prior of a good text and the voting habits of each rule, from votes alone.

    ``patterns`` holds the combinations of votes that occur and ``counts`` their numbers
    of documents: at most 3 to the power of the rules, whatever the corpus. Expectation
    maximisation for rules that vote or abstain independently given the class; each
    class keeps ``START_WEIGHT`` documents of the starting opinion.
    """
    prior, habits = 0.5, starting_habits(rules)
    for _ in range(rounds if patterns else 0):
        good = [_posterior(votes, prior, habits) for votes in patterns]
        mass = [[n * p for n, p in zip(counts, good, strict=True)], [n * (1 - p) for n, p in zip(counts, good, strict=True)]]
        sizes = [sum(m) + START_WEIGHT for m in mass]
        prior = sizes[0] / sum(sizes)
        for rule in range(rules):
            for side in (0, 1):
                found = {v: START_WEIGHT * _start(v, side == 0) for v in (GOOD, NONE, BAD)}
                for votes, m in zip(patterns, mass[side], strict=True):
                    found[votes[rule]] += m
                habits[rule][side] = {v: m / sizes[side] for v, m in found.items()}
    return prior, habits


def accuracies(prior: float, habits: Habits) -> list[float]:
    """How often each rule is right when it votes."""
    out = []
    for good, bad in habits:
        right = prior * good[GOOD] + (1 - prior) * bad[BAD]
        out.append(right / (right + prior * good[BAD] + (1 - prior) * bad[GOOD]))
    return out


def _posterior(votes: Votes, prior: float, habits: Habits) -> float:
    odds = math.log(prior / (1 - prior))
    for vote, (good, bad) in zip(votes, habits, strict=True):
        odds += math.log(good[vote] / bad[vote])
    return 1 / (1 + math.exp(-odds))


def posterior(rules: list[str], prior: float, habits: Habits) -> Column:
    """Probability of a good text given its votes, as a column."""
    odds = F.lit(math.log(prior / (1 - prior)))
    for name, (good, bad) in zip(rules, habits, strict=True):
        ratio = {v: F.lit(math.log(good[v] / bad[v])) for v in (GOOD, NONE, BAD)}
        odds = odds + F.when(F.col(name) == GOOD, ratio[GOOD]).when(F.col(name) == BAD, ratio[BAD]).otherwise(ratio[NONE])
    return 1 / (1 + F.exp(-odds))


def judge(docs: DataFrame, carry: list[str] | None = None, threshold: float = 0.5) -> DataFrame:
    """The documents with their measures, votes, ``quality`` (posterior) and ``kept``.

    A document is kept if its posterior reaches ``threshold`` and it does not fail the
    base rules (under 50 words, or more than half of them in repeated 3-word windows).
    Documents that fail those are no evidence for the habits of the rules. Columns named
    in ``carry`` (all by default) are carried along; texts are read once, and measures
    are written to the shared folder before votes are counted.

    A null or empty text has no words and fails. Repeated rows are judged alike and all
    count as evidence. An empty table gives no rows. A column named like a measure, a
    vote or a verdict is replaced.
    """
    votes = rule_votes()
    rules = list(votes)
    carry = docs.columns if carry is None else carry
    taken = {*MEASURES, *rules, "base_failed", "quality", "kept"}
    found = measured(docs.select("text", *(c for c in carry if c not in taken | {"text"})))
    found = materialise(found if "text" in carry else found.drop("text"), "measures")
    voted = found.withColumns({**votes, "base_failed": base_failed()})
    # A row for each combination of votes: 3 to the power of the rules at most.
    counted = voted.where("not base_failed").groupBy(*rules).agg(F.count("*")).collect()
    counted = sorted(tuple(row) for row in counted)
    prior, habits = estimate([row[:-1] for row in counted], [row[-1] for row in counted], len(rules))
    judged = voted.withColumn("quality", posterior(rules, prior, habits))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))


def drop_rejected(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with their own columns."""
    own, back = own_names(docs, "text")
    return back(judge(own).where("kept"))
