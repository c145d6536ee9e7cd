"""Small tables with the awkward cases every operator must survive."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, shard string, size string, " \
         "copies string, kept string, piece string, _key string, c0 string"


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    words = [f"w{rng.randrange(vocabulary)}" + rng.choice(["", "", "", ",", "."]) for _ in range(n)]
    return " ".join(words)


def awkward_rows() -> list[tuple]:
    same = prose(1, 120)
    rows = [
        (0, None, "en", "a"), (1, "", "en", "a"), (2, " \n\t ", None, "b"), (3, "one two three", "en", "b"),
        (4, prose(4, 30_000), "en", "a"), (5, same, "en", "b"), (6, same, "de", "c"), (6, same, "de", "c"),
        (None, prose(7, 60), "de", None), (8, "Größe   漢字 😀 ÄÖÜ <|endoftext|>  x\r\n\r\nWARC/1.1 y", None, ""),
        (50, same.upper(), "fr", "c"), (100, prose(9, 5), "fr", "c"), (-50, "x" * 5000, "en", "b"),
        (9, "a\n" * 40, "en", "a"), (10, "the end. " * 30, "en", "a")]
    return [(i, t, lang, source, 0 if t is None else len(t), "x", "x", "x", "x", "x", "x", "x", "x")
            for i, t, lang, source in rows]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
