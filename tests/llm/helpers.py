"""Small tables with the cases that every operator has to bear."""

from __future__ import annotations

DDL = "doc_id long, text string, lang string, source string, n_chars long, `key` string, h string, id string, `drop` string, label string, n string, body string, chunk string, bands string, hub string, shard string"
CLASHING = ("key", "h", "id", "drop", "label", "n", "body", "chunk", "bands", "hub", "shard")

LONG = "lorem ipsum dolor sit amet " * 20_000
ODD_ROWS = [
    (1, None, None, None),
    (2, "", "en", "s"),
    (3, "   \n\t ", "en", None),
    (4, "word", None, "s"),
    (5, LONG, "en", "s"),
    (6, LONG, "en", "t"),
    (6, LONG, "en", "t"),
    (None, "a text without an id of its own", "en", "s"),
    (None, None, None, None),
    (7, "Größe 😀 naïve ﬁn\x00\x85 end", "de", "s"),
    (8, "1234 5678 !!! ???", "en", "s"),
]


def table(spark, rows):
    """Documents of (doc_id, text, lang, source) rows, with further columns whose names operators use inside."""
    full = [(i, t, lang, source, None if t is None else len(t), *CLASHING) for i, t, lang, source in rows]
    return spark.createDataFrame(full, DDL)


def docs(spark, texts, lang="en", source="s"):
    return table(spark, [(i, t, lang, source) for i, t in texts])


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}
