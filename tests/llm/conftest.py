import random

import pytest


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and repeated texts and rows, a long text, columns with clashing names."""
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(40)]
    say = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    passages = [say(rnd.randint(50, 120)) for _ in range(6)]
    texts = []
    for _ in range(60):
        texts.append(" ".join(rnd.choice(passages) if rnd.random() < 0.5 else say(rnd.randint(1, 80)) for _ in range(rnd.randint(0, 4))))
    texts += ["a " * 300, "a " * 260 + "b", None, "", "a b " * 100, "b a " * 80, texts[5], texts[5] + "  ", "x " * 20_000, "É\u00a0é\tZ\n", passages[0] + " q"]
    rows = [(i, t, "en", "s", 0, 1.0, 2, "k") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + rows[:2], "doc_id long, text string, lang string, source string, n_chars long, score double, spans int, fp string")


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)
