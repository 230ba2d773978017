"""Small document tables with every awkward case."""

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, size int, rate double"


def words(prefix: str, n: int, start: int = 0) -> str:
    return " ".join(f"{prefix}{i}" for i in range(start, start + n))


def documents(spark, texts, langs=None):
    """Rows (id, text) with columns whose names clash with the operators' own."""
    langs = langs or {}
    rows = [(i, t, langs.get(i, "en"), "s", None if t is None else len(t), "k", 1, 0.5) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


def awkward(spark):
    """Null id, null text, empty and blank texts, a repeated row, a tie of ids, a very long text."""
    long = words("long", 30_000)
    return documents(spark, [
        (1, "alpha beta gamma delta epsilon"), (1, "alpha beta gamma delta epsilon"), (1, "another text altogether here now"),
        (None, "alpha beta gamma delta epsilon"), (None, None), (2, None), (3, ""), (4, "  \n\t "), (5, long), (6, long + " end"),
        (7, "<|endoftext|> x<|endoftext|>"), (8, "naïve façade — ½ 😀  z"),
    ])


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
