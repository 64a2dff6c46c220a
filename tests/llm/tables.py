"""Small document tables with the odd cases every operator must take."""

import random

PROSE = "the quick brown fox jumps over a lazy dog while seven wizards brew potent green tea near old stone bridges".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(PROSE) + rng.choice(["", "", "", str(rng.randrange(50))]) for _ in range(n)) + "."


def odd_rows():
    """(doc_id, text): nulls, empties, copies, repeated rows, other scripts, a very long text."""
    copied = prose(1, 120)
    return [
        (1, copied),
        (2, copied),
        (2, copied),
        (3, None),
        (3, None),
        (4, ""),
        (5, " \t\n\x0b\x0c\r "),
        (6, "Short."),
        (7, "Straße ÉTÉ 東京 \U0001f600 á <|endoftext|> it's  2 \x1c tabs\t\tand\n\n lines "),
        (None, prose(2, 80)),
        (None, prose(3, 90)),
        (None, None),
        (8, prose(4, 30_000)),
        (9, "word " * 500),
        (10, "x" * 5_000),
        (11, copied + " one more thing"),
        (12, "Mail a.b@c-d.example.org or call +49 (30) 123-456.78, host 10.0.0.255 or 10.0.0.256, card 4111 1111 1111 1111."),
    ]


#: Columns of the documents and others that operators might use themselves.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, row long, part int, base string, hits int, "
    "own_1 string, kept string, n_words string, quality string, prose string, root long, label long, t1 string, at int"
)


def odd_table(spark, rows=None):
    more = ("en", "web", 7, 5, 6, "b", 1, "o", "k", "n", "q", "p", 9, 8, "t", 3)
    return spark.createDataFrame([(*r, *more) for r in (odd_rows() if rows is None else rows)], SCHEMA)


def plain(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def multiset(rows):
    return sorted((tuple(r) for r in rows), key=repr)
