"""Small tables with the odd rows that every operator must bear."""

from __future__ import annotations

SF_DIR = "/root/testdata/sf0.001"
LONG = " ".join(f"wort{i % 997} and" for i in range(30_000))
ODD_TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from the big bad wolf."),
    (1, "The quick brown fox jumps over the lazy dog and runs away from the big bad wolf."),
    (2, None), (3, ""), (4, " \n\t "), (None, "a text without an id of its own"), (None, None),
    (5, "12345 67890 ... !!!"), (6, LONG), (7, "\x00\x7f 漢字 \U0001f600 Ω"), (8, "word"), (1, "another text under the id 1"),
]
# Names that operators might use themselves.
CLASHING = ["row", "score", "version", "words", "rep", "key", "bucket", "label", "none", "stat_log_words", "lang", "source", "n_chars"]


def odd_docs(spark, texts=ODD_TEXTS):
    rows = [(i, text, *("x" for _ in CLASHING)) for i, text in texts]
    return spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{name} string" for name in CLASHING))


def no_docs(spark):
    return odd_docs(spark, [])


def labels(spark, docs, column="quality"):
    rows = [(row["doc_id"], row["doc_id"] % 2) for row in docs.select("doc_id").collect() if row["doc_id"] is not None]
    return spark.createDataFrame(rows, f"doc_id long, {column} int")
