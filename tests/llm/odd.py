"""Documents that are odd in every way the operators must bear."""

from __future__ import annotations

LONG = "word other " * 30_000

ROWS = [
    (1, "The same text, in two rows.", "en", "a"),
    (2, "The same text,  in two\trows.", "en", "a"),
    (3, "The same text, in two rows.", None, "b"),
    (4, None, "en", "b"),
    (5, "", "de", None),
    (6, " \n\t ", "de", "a"),
    (7, LONG, "en", "a"),
    (7, LONG, "en", "a"),  # a repeated row
    (8, "one two", None, None),
    (9, "Über die Straße: ½ naïve ﬁn 日本語! <|endoftext|> it's", "de", "c"),
    (None, "a text without an id", "en", "a"),
    (10, "idiot moron trash scum clown", "en", "c"),
]

SCHEMA = "doc_id long, text string, lang string, source string"
# names that operators might use themselves
CLASHING = ("id", "hash", "norm", "size", "cid", "gid", "n", "row", "score", "label", "copies", "place", "target", "_dropped", "_utf8", "utf8")


def documents(spark, rows=ROWS):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.selectExpr("*", *[f"'x' AS {name}" for name in CLASHING])
