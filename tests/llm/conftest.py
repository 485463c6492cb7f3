import random

import pytest

WORDS = "the and of river stone cloud market window silver garden engine letter north summer paper".split()


def prose(seed, n=80):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "s", "ing", "er"]) for _ in range(n)) + "."


@pytest.fixture
def odd(spark):
    """Null and empty texts, null ids, repeated rows, a very long text, and columns with the operators' own names."""
    long_text = " ".join(prose(i, 50) for i in range(1000, 1900))
    rows = [(0, None, "en", "a"), (1, "", None, None), (2, " \n\t", "en", "a"), (3, long_text, "en", "a"),
            (4, prose(4), "en", "b"), (4, prose(4), "en", "b"), (None, prose(5), "en", "b"), (7, prose(4), None, "b"),
            (8, "é" * 60 + prose(8), "fr", None), (9, "x" * 100000, "en", "c")]
    schema = "doc_id long, text string, lang string, source string, id int, spans string, fp string, block string, n_chars long"
    return spark.createDataFrame([(*r, 1, "s", "f", "b", len(r[1] or "")) for r in rows], schema)


@pytest.fixture
def none(odd):
    return odd.limit(0)
