import pytest


@pytest.fixture(scope="session")
def docs_schema():
    return "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark, docs_schema):
    """Nulls in every column, empty, blank and long texts, ties, repeated rows."""
    long = " ".join(f"word{i % 977} filler{i % 13}" for i in range(30_000))
    rows = [
        (1, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "s", 68),
        (1, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "s", 68),
        (2, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "s", 68),
        (3, None, "en", "s", None),
        (4, "", None, None, 0),
        (5, " \t\n", "fr", "s", 3),
        (6, long, "en", None, len(long)),
        (7, long, "en", "s", len(long)),
        (None, "The quick brown fox jumps over the lazy dog near the river bank today", None, None, None),
        (None, None, None, None, None),
        (8, "1234 5678 !!! ***", "de", "s", 17),
        (9, "ünïcödé tèxt 漢字 🎉 here\nand a second line that is shared\n", "de", "s", 50),
        (10, "and a second line that is shared\r\nAND A SECOND LINE THAT IS SHARED", "de", "s", 60),
    ]
    return spark.createDataFrame(rows, docs_schema).persist()


@pytest.fixture(scope="session")
def no_docs(spark, docs_schema):
    return spark.createDataFrame([], docs_schema)


@pytest.fixture(scope="session")
def prose(spark, docs_schema):
    """Seeded prose with exact copies, near copies and shared passages."""
    import random

    r = random.Random(5)
    vocabulary = ["".join(r.choice("abcdeghiklmnoprstu") for _ in range(r.randint(2, 9))) for _ in range(400)]
    text = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    shared = text(60)
    rows, at = [], 0
    for k in range(60):
        words = text(r.randint(30, 160)).split()
        rows.append(" ".join(words))
        if k % 4 == 0:
            for _ in range(3):
                edited = list(words)
                for _ in range(r.randint(0, 4)):
                    edited[r.randrange(len(edited))] = r.choice(vocabulary)
                rows.append(" ".join(edited))
        if k % 7 == 0:
            rows.append(text(20) + " " + shared + " " + text(20))
        if k % 9 == 0:
            rows.append("tok " * 150)
    r.shuffle(rows)
    return spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(rows)], docs_schema).persist()
