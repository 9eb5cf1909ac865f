from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng: random.Random, n: int, stems: str = "ab cd ef gh ij kl mn op qr st uv wx yz") -> str:
    stems = stems.split()
    return " ".join("".join(rng.choices(stems, k=rng.randint(1, 3))) for _ in range(n))


def corpus() -> list[tuple]:
    """Copies, near copies, shared passages, nulls, empty and long texts, repeated rows, odd white space."""
    rng = random.Random(7)
    rows = []
    passage = prose(rng, 60)
    for i in range(60):
        text = prose(rng, rng.randint(1, 120))
        if i % 3 == 0:
            text += "\n" + passage + " " + prose(rng, 5)
        rows.append([i, text, "en", f"s{i % 4}"])
    long = prose(rng, 3000)
    rows += [[100, long, "en", "s0"], [101, long + " tail", "de", "s0"], [102, f" {long}\n", "de", None]]
    rows += [[200 + k, "same  text here" + " " * (k % 3), "en", "s0"] for k in range(30)]
    rows += [[300, None, None, None], [301, "", "en", "s1"], [302, " \t\n\x0b\x0c\r ", "en", "s1"]]
    rows += [[None, "no id", "en", "s2"], [None, "no id", "en", "s2"], [7, rows[7][1], "en", "s3"]]
    rows += [[7, "another text of the same id", "en", "s3"], [400, "é ü 你好   x", "zz", "Ä"]]
    rows += [[500 + k, f"word{k}" + " word" * 100, "en", "s1"] for k in range(3)]
    return [(*r, None if r[1] is None else len(r[1])) for r in rows]


@pytest.fixture(scope="session")
def rows_in():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows_in):
    """Repartitioned, with extra columns whose names clash with those of results."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows_in, SCHEMA).repartition(3)
    clash = ("kept", "keep_id", "size", "taken", "score", "n_words", "_th", "start", "fp", "piece", "label")
    return df.select("*", *[F.lit("x").alias(c) for c in clash])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
