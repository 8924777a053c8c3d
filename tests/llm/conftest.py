import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF = "/root/testdata/sf0.001"
#: Null, empty, white space only, short, repeated and long texts; ties; a huge text without spaces.
_P = "the quick brown fox jumps over the lazy dog while seven wizards mix jolly potions near a quiet harbour town at dawn and sing".split()
EDGE_TEXTS = [
    None, "", " \n\t ", "one", "a b c d", " ".join(_P), " ".join(_P), " ".join(_P + ["extra"]), " ".join(_P * 3), "x" * 70_000,
    "It's 12 o'clock… naïve  ЖЗИ 漢字 😀 \x1c tab\there\r\nline <|endoftext|> end", "A\x85B  c \n\n d", " ".join(f"w{i}" for i in range(3000)), "ends with space ", "…!?", "THE QUICK\nBROWN fox jumps over the lazy dog while seven wizards",
]


@pytest.fixture(scope="session")
def edges(spark):
    """Awkward rows with columns whose names clash with the operators' own."""
    rows = [(i, t, None if i % 4 == 3 else "en", None if i % 5 == 2 else f"s{i % 2}", i, i) for i, t in enumerate(EDGE_TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words int, matches int")


@pytest.fixture(scope="session")
def edge_rows():
    return list(enumerate(EDGE_TEXTS))


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("false")
