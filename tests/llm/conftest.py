"""Small messy tables for the training-data operators."""

import os
import random
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ferry.session import ship_package  # noqa: E402

CLASHES = ["h", "m", "n", "fp", "key", "alive", "ids", "x", "_s", "_n", "_drop", "words", "line_hash", "id", "v"]


def word(rng):
    return "".join(rng.choice(["ba", "do", "ki", "lu", "me", "nɔ", "Ra", "su", "té"]) for _ in range(rng.randint(1, 4)))


def prose(rng, n):
    out = []
    for i in range(n):
        out.append(word(rng) + rng.choice(["", "", "", ",", "."]))
        out.append("\n" if rng.random() < 0.05 else " ")
    return "".join(out)


def messy_rows(seed=3):
    """(doc_id, text, lang, source, n_chars): nulls, empty and long texts, copies, near copies, shared lines, repeats."""
    rng = random.Random(seed)
    base = [prose(rng, rng.randint(1, 160)) for _ in range(60)]
    shared = [prose(rng, 70).replace("\n", " ") for _ in range(2)]
    rows = []
    for i, text in enumerate(base):
        if i % 3 == 0:
            text += "\n" + shared[0]
        if i % 4 == 0:
            text = shared[1] + "\n  " + shared[0].upper() + " \n" + text
        rows.append((100 + i, text, "en", f"s{i % 4}" if i % 7 else None, len(text)))
    rows += [(300 + i, base[5], "en", "s0", None) for i in range(12)]                      # exact copies
    rows += [(400 + i, base[7] + " " + word(rng), "en", "s0", 1) for i in range(8)]         # near copies
    rows += [(500, None, None, None, None), (501, "", "en", "s1", 0), (502, " \n\t\n", "en", "s1", 4)]
    rows += [(None, base[5], "en", "s2", 9), (None, None, None, None, None), (None, prose(rng, 80), "en", "s2", 1)]
    rows += [(503, prose(rng, 30_000), "en", "s3", 1)]                                     # very long
    rows += [rows[3], rows[3], (103, base[9], "en", "s1", 5)]                              # repeated id, one other text
    rows += [(504, "one two", "en", "s1", 7), (505, "    x \x1c y", "en", "s1", 7), (506, "İΣ é é don't 12.5", "x", "s", 1)]
    rng.shuffle(rows)
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def llm_spark(spark):
    ship_package(spark)
    return spark


@pytest.fixture(scope="session")
def messy(llm_spark):
    df = llm_spark.createDataFrame(messy_rows(), SCHEMA).repartition(5)
    return df.select("*", *[F.lit(f"clash {c}").alias(c) for c in CLASHES]).cache()


@pytest.fixture(scope="session")
def rows():
    return messy_rows()


@pytest.fixture(scope="session")
def no_docs(llm_spark):
    return llm_spark.createDataFrame([], SCHEMA)
