import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
FOLDER = "/root/testdata/sf0.001"

# Null, empty, blank, one word, ties and repeats, odd white space, a long text, several alphabets.
TEXTS = [
    None, "", "  \n\t ", "one", "one two three four", "The storm came and the storm went over the hills of the coast.",
    "The storm came and the storm went over the hills of the coast.", "a b a b a b a b a b a b a b",
    "line one here\nline one here\n\nline one here\n  \nother", "tab\there  two   three\r\nend ", " lead and trail ",
    "Ñandú größer ΟΔΟΣ κομήτης 日本語 テキスト", "### *** $$$ %%% | <b> & done", "x" * 5000, "word " * 4000,
    " ".join(f"w{i * i % 997}" for i in range(6000)), "nb\xa0space em space end<|endoftext|>",
]


@pytest.fixture(scope="session")
def texts():
    return list(TEXTS)


@pytest.fixture(scope="session")
def docs(spark):
    """Awkward documents: repeated rows, a null id, an extra column with a clashing name."""
    rows = [(i, t, f"s{i}", i * 1.5) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "s", 0.5), (None, TEXTS[5], "s", 1.0)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, start string, score double")


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.filter("false")


@pytest.fixture(scope="session")
def table(spark):
    if not os.path.isdir(FOLDER):
        pytest.skip("test tables not there")
    return lambda name: spark.read.parquet(f"{FOLDER}/{name}.parquet")
