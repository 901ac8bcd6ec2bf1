"""Small documents with every odd case, and a reader of results."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, score double, kept string, row string, found string, `class` long"
EMPTY = "doc_id long, text string, lang string, source string, score double, kept string"


def prose(seed, words=40, lines=3):
    pick = random.Random(seed)
    vocabulary = [a + b + c for a in ("ba", "ko", "ri", "té", "Lu") for b in ("na", "so", "mi", "") for c in ("t", "r", "x")]
    out = []
    for _ in range(lines):
        out.append(" ".join(pick.choice(vocabulary) for _ in range(words // lines)).capitalize() + ".")
    return "\n".join(out)


def odd_rows():
    """(id, text): nulls, empties, blanks, repeated rows and ids, copies, near copies, long texts."""
    long = " ".join(prose(k, 60) for k in range(400))
    rows = [
        (1, prose(1)),
        (2, prose(2)),
        (3, prose(1)),
        (3, prose(1)),
        (4, prose(1).upper()),
        (5, None),
        (6, ""),
        (7, " \n\t \x0b "),
        (None, prose(2)),
        (None, None),
        (None, prose(2)),
        (8, "one two"),
        (9, "one two"),
        (10, "x"),
        (11, long),
        (12, long + " tail"),
        (13, "a" * 20_000),
        (14, "—…— ¿?"),
        (15, "日本語のテキスト です"),
        (16, "na " * 3_000),
        (17, prose(5, 120) + " changed " + prose(6, 20)),
        (18, prose(5, 120) + " Changed: " + prose(6, 20)),
        (19, prose(5, 120) + "\n" + prose(1) + "\n" + prose(7)),
        (20, "\r\nline one of the file\r\n\r\nline one of the file\r\n"),
        (20, "another text under the same id, with some words in it"),
        (-5, prose(9)),
    ]
    return rows


def documents(spark, rows=None, partitions=3):
    """A frame with further columns whose names the operators use inside."""
    rows = odd_rows() if rows is None else rows
    full = [(i, t, None, "s", 2.0, "kept", "row", None, 7) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(partitions)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def sorted_rows(frame, *columns):
    return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr)
