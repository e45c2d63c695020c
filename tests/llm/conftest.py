import re

import pytest

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}


PROSE = " ".join(f"word{i} the of{i % 7}" for i in range(30)) + "."
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, PROSE), (5, PROSE), (6, PROSE), (None, PROSE), (None, None),
    (7, PROSE + " " + PROSE), (8, "x" * 50_000), (9, "a b " * 20_000), (10, 'token = "abc123def456"'), (11, "é ñ\xa0ü  ß\n\n 日本 " * 30),
]
CLASHING = "size int, shard string, slot string, secrets string, lines string, kept string, node string, component string, doc string, digest string, row string"


@pytest.fixture(scope="session")
def odd(spark):
    """Null ids and texts, empty and very long texts, repeated rows, and columns named like ones that operators add."""
    names = [part.split()[0] for part in CLASHING.split(", ")]
    rows = [(i, t, "en", "src", len(t) if t else None) + (None,) * len(names) for i, t in ODD]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}")


@pytest.fixture(scope="session")
def benchmark(spark):
    items = [(1, " ".join(PROSE.split()[5:40])), (2, None), (3, "too short"), (4, "")]
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(5, 1, 0), (5, 0, 0), (4, 0, 0), (9, 0, 0), (None, 1, 0), (7, None, None)], "doc_id long, quality int, toxic int")
