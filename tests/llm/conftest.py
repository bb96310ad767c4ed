import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, body string, key long, part int"


def small_corpus():
    """Documents with exact and near copies, shared passages, repeated rows, ties, nulls, empty, blank
    and long texts, and columns whose names operators might use themselves."""
    rng = random.Random(4)
    words = [a + b for a in "ba ko mi tu re so".split() for b in "la ne ri do ku pa".split()]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, first = say(60), say(120)
    texts = [first, first, first + " " + say(3), say(40) + "\n" + passage, passage + "  " + say(30), say(200), None, "", " \t\n ",
             "a", "a b", "a a a a " * 60, "x" * 3000, "é" * 300 + " ü " + passage, say(3000), "Größe " * 20 + say(10),
             "mail me@site.example.com or 4111 1111 1111 1111, 10.0.0.300 1.2.3.4 +1 (202) 555-0143 x", "### $$$ %%% *** " * 40,
             "line one here\nline one here\n\n  \nline two", "<|endoftext|> it's\x85 1²3 \x1c 漢字"]
    texts += [passage.upper() + " " + say(50) for _ in range(3)] + [say(rng.randrange(1, 90)) for _ in range(40)]
    rows = [(i * 3 + 1, t, rng.choice(["en", "de"]), rng.choice(["s0", "s0", "s1"]), len(t or ""), "clash", i, 0) for i, t in enumerate(texts)]
    rows += [rows[0], rows[5], (None, first, None, None, None, None, None, None), (-5, passage, "en", "s0", 1, "b", 1, 1)]
    return rows


@pytest.fixture(scope="session")
def corpus(spark):
    return spark.createDataFrame(small_corpus(), SCHEMA).coalesce(3)


@pytest.fixture(scope="session")
def stored(corpus, tmp_path_factory):
    """The corpus as a table of files, whose scan is the same each time."""
    path = str(tmp_path_factory.mktemp("corpus") / "documents.parquet")
    corpus.write.parquet(path)
    return corpus.sparkSession.read.parquet(path)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def nulls(spark):
    return spark.createDataFrame([(None,) * 8] * 3, SCHEMA)
