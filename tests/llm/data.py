"""Small document tables with the awkward cases every operator has to stand."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long, `Digest` string, tie int, text_key string"


def documents(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, lang); other columns clash with helpers' names."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, None, None, "x", 1, "k") for r in rows]
    return spark.createDataFrame(full, DOCS)


LONG = " ".join(f"word{i % 977} and so on" for i in range(20_000))

AWKWARD = [
    (1, None, "en"),
    (2, "", "en"),
    (3, " \t\n", "de"),
    (None, "a row without an id", "en"),
    (None, None, None),
    (5, "plain text here", "en"),
    (6, "plain text  here", "en"),
    (7, "plain text here", "en"),
    (7, "plain text here", "en"),
    (8, LONG, "en"),
    (9, LONG + " x", None),
    (10, "12345 !!! ---", "en"),
    (11, "été \U0001f600 中文 İ", "fr"),
]
