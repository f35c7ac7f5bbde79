import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, score double, component_id long, length long, rank int, batch long, held boolean"


def make(spark, rows):
    """Documents with columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, lang, "s", len(t or ""), 7, 0.5, 3, 4, 5, 6, True) for i, t, lang in rows], SCHEMA)


def prose(seed, n, words=("the of and to harbour window garden stone river quiet letter morning engine copper velvet lantern orchard signal".split())):
    rng = random.Random(seed)
    return " ".join(rng.choice(words) + rng.choice(["", "", "", ",", "."]) for _ in range(n))


@pytest.fixture(scope="session")
def docs(spark):
    base = prose(1, 120)
    rows = [
        (1, base, "en"), (2, base, "en"), (3, base + " tail", "en"), (4, "der die das und nicht ein haus ist klein " * 9, "de"), (5, None, None), (6, "", "en"), (7, " \n\t ", None),
        (8, "!!! ??? 123", "de"), (9, "Ünïcode – “quotes” 日本語 текст", None), (9, "Ünïcode – “quotes” 日本語 текст", None), (None, "no id here", "en"), (None, None, None),
        (12, prose(2, 6000), "en"), (13, "word " * 5000, "en"), (14, "one two three", "en"), (15, "ONE two\x0bthree", "en"), (16, prose(3, 40), "en"), (17, "das haus und der garten sind nicht die stadt " * 6, "de"),
    ]
    return make(spark, rows)


@pytest.fixture(scope="session")
def nothing(spark):
    return make(spark, [])
