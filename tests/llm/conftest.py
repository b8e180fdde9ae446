import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words string, _text string, node int"


def rows_of(texts):
    """Rows with further columns whose names clash with those the operators use inside."""
    return [(k, t, None if k % 3 else "en", "s", None if t is None else len(t), "clash", None, k) for k, t in texts]


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, long, tied and repeated texts."""
    r = random.Random(7)
    words = ["".join(r.choice("abcdeéß") for _ in range(r.randint(1, 7))) for _ in range(300)]
    prose = lambda n: " ".join(r.choice(words) for _ in range(n))
    base = prose(120)
    near = base.split()
    near[60] = "changed"
    texts = [None, "", " \t\n\x0b\x0c\r", "one", "One TWO three", base, base, " ".join(near), base.upper(), prose(4), prose(5), "a b c d e " * 40, prose(20000), "x" * 5000, "日本語 текст 🙂 ñ", prose(30) + "\n" + "same line here\n" * 3]
    return list(enumerate(texts))


@pytest.fixture(scope="session")
def odd_docs(spark, odd_texts):
    # The last document is there twice.
    return spark.createDataFrame(rows_of(odd_texts) + rows_of(odd_texts[-1:]), SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
