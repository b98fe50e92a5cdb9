import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Documents of texts; the ids, languages and sources follow from the places."""

    def made(texts, lang="en", source=None, first=0):
        rows = [(first + i, t, lang, source(i) if source else f"src{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, DOCS)

    return made


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def prose(seed, words, vocabulary=400):
    """Words in an order that hangs on the seed."""
    import random

    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(words))
