"""Documents with everything that can go wrong: shared by the operators' tests."""

#: Columns of documents, then columns with the names of results, with characters that need quotes, and with names that operators use within, in another case.
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, score double, shard int, n_words long, "
DOCS += ", ".join(f"{n} int" for n in ("`a.b`", "`q``w`", "`two words`", "Grp", "Bucket", "KEY", "Word", "Item", "Span", "Mask", "Quota", "_Aside2", "Up", "Cell", "Kind", "Row", "H", "N"))


def documents(spark, rows):
    """rows: (doc_id, text[, lang, source]); more columns have the names of results."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or ""), -1, -1.0, -1, -1, *range(18)) for r in rows]
    return spark.createDataFrame(full, DOCS)


ODD = [
    (1, None, None, None),
    (2, "", "en", None),
    (3, " \n\t ", "fr", "b"),
    (4, "word " * 60000, "en", "a"),
    (5, "same text twice over here", "en", "a"),
    (5, "same text twice over here", "en", "a"),
    (6, "same text twice over here", None, "a"),
    (None, "no id at all, but some words", "en", "a"),
    (None, None, None, None),
    (8, "ÀÉ ß 漢字 \x00\x1f\x7f \U0001f600", "de", "ü"),
    (-9, "x" * 70000, "en", "a"),
    (2**62, "!!! 123 ???", "en", "z"),
]
