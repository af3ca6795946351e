import random

import pytest

WORDS = [a + b for a in ("ka", "lo", "mi", "ne", "ru", "sa", "te", "vo") for b in ("ba", "den", "fir", "gul", "hop", "jin", "x", "zor")]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text, lang, source, n_chars): nulls, empty and very long texts,
    repeated rows, copies, near copies and a passage in several documents."""
    rng = random.Random(5)
    base = sentence(rng, 120)
    near = base.split()
    near[40] = "changed"
    passage = "\n".join(sentence(rng, 20) for _ in range(6))
    texts = [None, "", "   \n ", "one", base, base, " ".join(near), "x" * 70_000, sentence(rng, 9000), "日本語 のテキスト é", "a\n\n\nb"]
    texts += [sentence(rng, 30) + "\n" + passage + "\n" + sentence(rng, 25) for _ in range(4)]
    texts += [sentence(rng, rng.randint(1, 200)) for _ in range(25)]
    rows = [(i, t, "en", None if i % 7 == 3 else f"s{i % 4}", len(t or "")) for i, t in enumerate(texts)]
    return rows + [rows[4], rows[8], rows[0]]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def clashing(odd_docs):
    """The same with more columns, of names that operators use themselves."""
    from pyspark.sql import functions as F

    names = ["score", "kept_lines", "spans", "key", "_row", "size", "shard", "th", "n", "rank", "label"]
    return odd_docs.select("*", *[F.lit(1).alias(n) for n in names])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
