"""Rows that every operator has to stand: nulls, empty and long texts, ties,
repeated rows, and extra columns whose names clash with inner ones."""

LONG = "word " * 30_000

DOCS = [
    (1, "the cat sat on the mat and looked at the moon for a very long time indeed"),
    (1, "the cat sat on the mat and looked at the moon for a very long time indeed"),
    (2, ""),
    (3, None),
    (None, "a text without an id, which is long enough to be judged by its words alone."),
    (4, LONG),
    (5, "\n\n  \t x"),
    (6, "Ünïcödé — “quotes” 🙂 ½ <|endoftext|> tail"),
]
SCHEMA = "doc_id long, text string"
EXTRA = "h", "fp", "crc", "spans", "seed", "at", "node", "shard", "digit", "_id", "_crc"


def docs(spark, rows=None):
    df = spark.createDataFrame(DOCS if rows is None else rows, SCHEMA)
    for name in EXTRA:
        df = df.selectExpr("*", f"7 AS `{name}`")
    return df


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
