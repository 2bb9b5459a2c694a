import random

import pytest

WORDS = "the of and a river stone light under water garden seven walks slowly over every morning while old trees stand".split()
MAIL, CARD = "anna.b@mail.example.org", "4539 1488 0343 6467"


def prose(seed: int, n: int) -> str:
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) + (str(pick.randrange(40)) if pick.random() < 0.5 else "") for _ in range(n))


def edge_rows() -> list[tuple]:
    """doc_id, text, lang, source, n_chars: nulls, empties, copies, near copies, a passage, a very long text."""
    base = prose(1, 120)
    near = base.replace(base.split()[60], "changed", 1)
    passage = prose(2, 60)
    texts = [
        base, base, near, base.upper(), None, "", " \n\t ", "one two three", "one  two\nthree", "Word", "word",
        prose(3, 80) + " " + passage + "\n" + prose(4, 80), prose(5, 90) + "\n" + passage + " " + prose(6, 70),
        "x" * 700, "x" * 900, "é" * 150 + "ü" * 150, ("the and of " * 30 + "\n") * 4, prose(7, 9000),
        "# * $ " * 60, f"Write to {MAIL} or call +49 30 123456-78, card {CARD}, host 10.0.0.255 and 1.2.3.256.",
        "a <|endoftext|> b <|im_end|> ▁ \x00 end", "line\n" * 80,
    ]
    rows = [(i, t, "en", None, len(t) if t is not None else None) for i, t in enumerate(texts)]
    return rows + [rows[0], rows[4], (None, prose(8, 100), None, "s", 3), (None, None, None, None, None)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def clashing(spark):
    """Columns named like the operators' own."""
    names = ["n_words", "kept", "candidates", "base", "all", "row", "__id", "copies", "spans", "node", "label", "place", "x.y"]
    df = spark.createDataFrame(edge_rows()[:12], SCHEMA)
    for i, name in enumerate(names):
        df = df.withColumns({name: __import__("pyspark.sql.functions", fromlist=["lit"]).lit(i)})
    return df


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
