import pytest

#: A table as an operator may meet it: columns of other uses with names that operators use.
CLASHING = ("pos", "row", "hash", "n", "node", "label", "copy", "score", "ids", "spans", "kept", "h1", "text_hash")


@pytest.fixture(scope="session")
def documents(spark):
    """Build a documents table from (doc_id, text[, source]) rows, with clashing extra columns."""

    def build(rows, clashing=True):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "s") for r in rows]
        if not clashing:
            return spark.createDataFrame(full, "doc_id long, text string, source string")
        extra = tuple(f"x{i}" for i in range(len(CLASHING)))
        names = ", ".join(f"`{name}` string" for name in CLASHING)
        return spark.createDataFrame([r + extra for r in full], f"doc_id long, text string, source string, {names}")

    return build


@pytest.fixture(scope="session")
def awkward():
    """Nulls, empty, blank and very long texts, repeated rows, ties, rows without id or source."""
    return [
        (1, None), (2, ""), (3, " \t\n "), (4, "one two three four five six seven"),
        (4, "one two three four five six seven"), (5, "one two three four five six seven"),
        (None, "one two three four five six seven"), (6, "word " * 60000), (7, "x" * 60000, None),
        (8, "Été 日本 \x1c " * 50), (9, "A\nB\n\nA", None),
    ]
