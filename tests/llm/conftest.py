"""Small odd tables that every operator has to bear."""

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, ids string, n string, start string, size string"
LONG = " ".join(f"w{i % 977}x" for i in range(60_000))
TEXTS = [
    None, "", "  \n\t ", "one", "two words", "a b c d e f g", "naïve 漢字 😀😀  \n\n x\x1c y ", LONG, LONG, "same text here for two rows", "same text here for two rows",
    "It's they'll İ Σας <|endoftext|> </s>", "word " * 300,
]


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 1, "clash", "clash", "clash", "clash") for i, t, s in rows], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, None if i % 5 == 0 else f"s{i % 3}") for i, t in enumerate(TEXTS)]
    return table(spark, [*rows, rows[5], (None, "no id at all in this row", "s1"), (None, None, None)])


@pytest.fixture(scope="module")
def none(spark):
    return table(spark, [(1, "x", "s")]).where("false")
