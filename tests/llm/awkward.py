"""Small documents with everything that goes wrong."""

AWKWARD = [
    (1, "The cat sat on the mat.", "a"),
    (2, "the cat SAT on the mat.", "a"),
    (3, None, "b"),
    (4, "", None),
    (5, "  \n \n  ", "b"),
    (6, "İstanbul ΟΔΟΣ ÉTÉ été Straße ﬁne 漢字 🙂 don't I'LL <|endoftext|> x\x00y", "c"),
    (6, "the cat sat on the mat.", "a"),
    (None, "no key", "a"),
    (None, "no key", "a"),
    (7, "word " * 3000 + "end", "c"),
    (8, "x" * 5000, "c"),
    (9, "tabs\tand\r\nreturns\x0b\x0c and   runs \n of \n\n blanks ", "c"),
    (9, "tabs\tand\r\nreturns\x0b\x0c and   runs \n of \n\n blanks ", "c"),
]
SCHEMA = "doc_id bigint, text string, source string"


def documents(spark, rows=AWKWARD, partitions=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(partitions)


def clashing(docs):
    """The same documents with columns named like the operators' own."""
    from pyspark.sql import functions as F

    names = ("kept", "n_tokens", "token_ids", "row_number", "stable_row", "digest", "component_id", "score", "row_key", "row_text", "carry")
    return docs.select("*", *[F.lit(i).alias(name) for i, name in enumerate(names)])
