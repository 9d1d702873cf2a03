import random
import re

import pytest

SF = "/root/testdata/sf0.001"
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(autouse=True)
def workers(spark):
    from gaugeline.llm.common import workers_import_package
    workers_import_package(spark)


@pytest.fixture()
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture()
def rows_of():
    """Words drawn from a small vocabulary, the same for the same seed."""
    def make(seed: int, n: int, vocabulary: int = 500) -> str:
        rng = random.Random(seed)
        return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))
    return make


@pytest.fixture()
def odd_documents(spark, rows_of):
    """Nulls in every column, empty, blank and long texts, repeated rows and a clashing column."""
    long = rows_of(1, 30_000)
    rows = [(1, None, None), (2, "", "x"), (3, " \n\t ", "x"), (None, None, None),
            (None, rows_of(2, 60), "x"), (4, long, None), (5, rows_of(3, 60), "x"),
            (5, rows_of(3, 60), "x"), (6, "one", "x"), (7, "Größe ÀÉ \u0130 ½ 一 \U0001F600", "x"),
            (8, rows_of(3, 60).upper(), "x")]
    return spark.createDataFrame(
        [(i, t, x, x, x) for i, t, x in rows],
        "doc_id long, text string, kept string, component_id string, lang string")


def lower_ascii(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)
