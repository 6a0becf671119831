import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rules string, row_key long, mix_rate double"


@pytest.fixture(scope="session")
def prose():
    """Words of an invented language, the same in every run."""
    rng = random.Random(5)
    words = ["".join(rng.choice(["the", "an", "er", "on", "ti", "re", "he", "in"]) for _ in range(rng.randint(1, 3))) for _ in range(300)]

    def text(n, seed):
        r = random.Random(seed)
        out = []
        for i in range(n):
            out.append(r.choice(words))
            if i % 9 == 8:
                out[-1] += ".\n" if i % 27 == 26 else "."
        return " ".join(out).replace("\n ", "\n")

    return text


@pytest.fixture(scope="session")
def odd_rows(prose):
    """Nulls in any column, empty and long texts, copies, repeated rows, a clash of column names."""
    shared = prose(80, 1)
    rows = [(1, shared), (2, prose(60, 2) + "\n" + shared), (3, shared), (3, shared), (4, None), (None, shared), (None, None), (5, ""),
            (6, " \n\t "), (7, "short"), (8, prose(20000, 3)), (9, "é" * 300), (10, "ab" * 400), (11, "x" * 30000),
            (12, "*** word$$$ " * 40), (13, prose(100, 4) + " " + prose(50, 2)), (14, "日本語 テスト a b"), (14, "other text")]
    return [(i, t, "en" if (i or 0) % 2 else None, None, None, "clash", 7, 0.5) for i, t in rows]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
