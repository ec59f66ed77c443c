"""Small tables with the awkward cases that every operator must stand."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, clash=()):
    """Documents from (doc_id, text[, lang, source]); ``clash`` adds columns of these names."""
    full = [(*r, *[None] * (4 - len(r)), len(r[1] or "")) for r in rows]
    frame = spark.createDataFrame([(*r, *[1] * len(clash)) for r in full], ", ".join([DOCS, *[f"{c} long" for c in clash]]))
    return frame


AWKWARD = [
    (1, None, "en", "a"),
    (2, "", None, "a"),
    (3, " \t\n", "en", None),
    (4, "The cat  sat\non the mat", "en", "a"),
    (5, "The cat sat on the mat", "en", "b"),
    (6, "the  cat sat on the mat", "en", "b"),
    (7, "word " * 30_000, "en", "b"),
    (8, "Übung macht den Meister 你好   x", "de", "c"),
    (8, "Übung macht den Meister 你好   x", "de", "c"),
    (None, "no identifier", None, None),
    (9, "0123 456 !!", "en", "c"),
    (10, "x", "xx", ""),
]
