"""Small tables with the odd cases that every operator must stand."""

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use for columns of their own.
CLASHES = ("id", "key", "row", "digest", "fingerprint", "component_id", "size", "copies", "score", "part", "hash", "kept", "at", "place", "data", "gram", "_text")


def documents(spark: SparkSession, rows: list[tuple], clashing: bool = False) -> DataFrame:
    """Rows (doc_id, text) or (doc_id, text, source) as a table of documents."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, SCHEMA).repartition(3)
    for name in CLASHES if clashing else ():
        df = df.withColumn(name, df["lang"])
    return df


def odd_rows(seed: int = 3) -> list[tuple]:
    """NULLs, empty and very long texts, ties and repeated rows."""
    draw = random.Random(seed)
    words = ["alpha", "beta", "Gamma", "delta,", "ÉTÉ", "漢字", "😀", "one", "two\n", "three.", "x", "it's"]

    def text(n: int) -> str:
        return " ".join(draw.choice(words) for _ in range(n))

    base = [text(draw.randint(1, 120)) for _ in range(12)]
    texts = [None, None, "", "", " ", "\t\n ", "a", "word " * 9000, text(30_000), *base, *base[:5], base[0].replace(" ", "  "), base[1] + " end"]
    rows = [(i, t, f"s{i % 3}") for i, t in enumerate(texts)]
    return [*rows, rows[9], rows[9], (None, base[2], None), (None, base[2], None), (None, None, None), (7, "another text of an id that is there", "s1")]
