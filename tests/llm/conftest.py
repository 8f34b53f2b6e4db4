import random

import pytest

EXTRA = ["key", "fp", "normal", "bucket", "n", "owner", "size", "place", "_h", "lines", "words", "feature"]
TEXTS = [None, "", " \n\t ", "a", "A b\tc\nd e", "Same text here", "same TEXT here", "Same text here", "é à É ñ ß", "x" * 5000, "word " * 3000, "one two three four five\n" * 40, "<|im_end|> 'll 're $$$ ###"]


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, null and repeated ids, and extra columns whose names the operators use inside."""
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "a"), (3, "a"), (None, "a"), (None, None), (-5, "Same text here"), (2**40, None)]
    random.seed(5)
    words = ["alpha", "beta", "gamma", "delta", "omega", "tau"]
    rows += [(100 + i, " ".join(random.choice(words) for _ in range(random.randint(0, 80)))) for i in range(60)]
    return spark.createDataFrame([(i, t, "en", *[k] * len(EXTRA)) for k, (i, t) in enumerate(rows)], "doc_id bigint, text string, lang string, " + ", ".join(f"{c} int" for c in EXTRA)).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string, n int")
