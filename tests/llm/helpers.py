"""Small tables with the odd cases that every operator has to take."""

from __future__ import annotations

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, h bigint, ids string, maybe int"

LONG = " ".join(f"word{i % 97}x{i % 13}" for i in range(60_000))


def odd_docs(spark, extra=()):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing extra columns."""
    rows = [(1, None, None, None, None, 1, "a", 1), (2, "", "en", "src0", 0, 2, None, None), (3, "  \n\t ", "en", None, 5, 3, "x", 0),
            (4, LONG, "en", "src0", len(LONG), 4, "x", 0), (5, LONG, None, "src1", len(LONG), 5, "y", 1),
            (6, "One line here.\nTwo lines here.", "fr", "src1", 29, 6, "z", 1), (6, "One line here.\nTwo lines here.", "fr", "src1", 29, 6, "z", 1),
            (None, "a row with no id", "de", "src2", 16, 7, "w", 0), (8, "é ü 漢字 \U0001f600 a\u0085b c", "de", "src2", 12, 8, "v", 1)]
    return spark.createDataFrame([*rows, *extra], DOC_SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
