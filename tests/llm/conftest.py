import random

import public_tokenizers
import pytest

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SYLLABLES = "th er in on an re es ti nd ha ou ing tion the of and is it".split()


def sentence(rng, n):
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def rng():
    return random.Random(17)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empties, ties, repeated rows and columns whose names the operators use themselves."""
    names = "key row item size digest norm block bands h g at n hit bucket start copies ids number".split()
    rows = [
        (1, None, None, None),
        (2, "", "", "s"),
        (None, "a b c d e f", "en", None),
        (3, "A B c D e f", "en", "s"),
        (3, "A B c D e f", "en", "s"),
        (4, "  \t\n", None, "t"),
        (5, "é́ ΑΣ 中文 \U0001f600 a\x1cb <|endoftext|> x|y |", "en", "t"),
        (6, "word " * 30_000, "de", "s"),
        (7, "WARC/1.1\r\n\r\n\x00 x", "de", "s"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return df.selectExpr("*", *(f"'x' AS `{n}`" for n in names))


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("1 = 0")
