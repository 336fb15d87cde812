"""Rows that every operator must live with, and the small tables."""

from tests.conftest import SF_MID, SF_SMALL  # noqa: F401

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, host string, class_id long"


def odd_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and extra columns
    whose names are those of results."""
    prose = " ".join(f"wort{i % 37} the plain{i % 11}" for i in range(60))
    rows = [
        (1, None, "en", "s", None, 1.0, "h", 1), (None, "null id here", "en", "s", 12, None, None, None),
        (2, "", "en", "s", 0, 0.5, "h", 9), (3, " \n\t\r\n ", None, None, 6, 0.5, "h", 9),
        (4, prose, "en", "s", len(prose), 0.1, "h", 9), (4, prose, "en", "s", len(prose), 0.1, "h", 9),
        (4, "same id, other text", "en", "s", 19, 0.1, "h", 9), (5, prose, "en", "s", len(prose), 0.1, "h", 9),
        (6, "word " * 30000, "en", "s", 150000, 0.1, "h", 9), (7, "x" * 100000, "en", "s", 100000, 0.1, "h", 9),
        (8, "mail a.b@c.d.e and é漢字🙂 10.0.0.1 then\n\nLicensed under CC BY-NC 4.0.\nend", "de", "t", 70, 0.1, "h", 9),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
