"""Rows that every document operator must take: nulls, empty and long texts, ties, repeated rows, clashing columns."""

LONG = "the long text of many words and more. " * 4000
TEXTS = [
    (1, "The quick brown fox and the lazy dog are in the house of the man."), (2, None), (3, ""), (4, " \t\n "), (5, LONG), (6, "naïve Σίσυφος ß ½ <|endoftext|> x"),
    (7, "The quick brown fox and the lazy dog are in the house of the man."), (7, "The quick brown fox and the lazy dog are in the house of the man."),
    (None, "no id here"), (8, "\U0001f600 emoji \u0378 unassigned \x1c control"),
]
#: Extra columns named as the operators name theirs.
SCHEMA = "doc_id long, text string, n_words long, fp string, words string, spans string, `__row` string, pii string, hashes string"


def documents(spark, rows=TEXTS):
    return spark.createDataFrame([(i, t, *[None] * 7) for i, t in rows], SCHEMA)
