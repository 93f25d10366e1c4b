"""Small document tables with every oddity, and readers of results."""

import math

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, texts, start=0):
    """Documents numbered from ``start``; a pair gives the number itself."""
    rows = []
    for i, item in enumerate(texts, start):
        key, text = item if isinstance(item, tuple) else (i, item)
        rows.append((key, text, None, None, None if text is None else len(text)))
    return spark.createDataFrame(rows, SCHEMA)


def odd_documents(spark):
    """Null, empty and blank texts, null and repeated keys, repeated rows, a very long text and a very long word."""
    long_text = " ".join(f"w{i % 977}x{i}" for i in range(60_000))
    rows = [
        (0, None, None, None, None),
        (1, "", None, "a", 0),
        (2, " \t\n ", "en", "a", 4),
        (3, "one two three four five six seven eight nine ten eleven", "en", None, None),
        (3, "one two three four five six seven eight nine ten eleven", "en", None, None),
        (4, "One  two three four five six seven eight nine ten eleven", None, "b", 1),
        (5, long_text, "en", "b", len(long_text)),
        (6, "x" * 300_000, "en", "b", 300_000),
        (None, "no key at all", "en", "b", 3),
        (None, None, None, None, None),
        (7, "1234 !!! ???", None, None, 3),
        (8, "Ärger 漢字 \U0001f389 naïve", "de", "c", 9),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def with_clashes(df, *names):
    """More columns, under names that an operator uses itself."""
    for i, name in enumerate(names):
        df = df.selectExpr("*", f"'clash{i}' AS `{name}`")
    return df


def by_key(df, key="doc_id"):
    return {row[key]: row for row in df.collect()}


def bag(df):
    """The rows in a stable order, for comparison whatever the order they came in."""
    plain = lambda v: None if isinstance(v, float) and math.isnan(v) else v
    return sorted((tuple(plain(v) for v in row) for row in df.collect()), key=repr)
