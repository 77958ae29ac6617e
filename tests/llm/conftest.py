import random

import pytest

WORDS = ["amber", "basalt", "cedar", "delta", "ember", "fjord", "garnet", "harbor", "iris", "juniper", "kelp", "linen", "moss", "nectar", "onyx", "pebble", "quartz", "river", "slate", "thyme"]
CLASHING = ["_row", "_key", "_hash", "_spans", "_stats", "_score", "_llr", "_n", "_s", "_id", "_own", "_salt"]
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, shard int, spans string, key long, id long, n long, label int, bucket int, size long, " + ", ".join(f"{c} int" for c in CLASHING)


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(n))


EDGE = [
    (1, prose(1, 60)),
    (2, prose(1, 60)),
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (6, "one"),
    (6, "one"),
    (None, prose(2, 30)),
    (7, prose(3, 20_000)),
    (8, "é😀 Ünïcode a@b.cd +1 (555) 123-4567 4111 1111 1111 1111 10.0.0.1"),
    (9, prose(1, 59) + " changed"),
    (10, "x" * 50_000),
]


def docs_of(spark, rows):
    """documents with more columns, whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), 0.5, 1, "x", 2, 3, 4, 1, 5, 6, *[7] * len(CLASHING)) for i, t in rows], DOCS)


@pytest.fixture(scope="session")
def edge(spark):
    return docs_of(spark, EDGE).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return docs_of(spark, [])
