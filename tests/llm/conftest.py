import random

import pytest


@pytest.fixture()
def documents(spark):
    """Rows (doc_id, text) as the table documents, with more columns whose names clash with results."""
    def make(*rows):
        return spark.createDataFrame([(i, t, "en", "s", 1, 0.5, "x") for i, t in rows],
                                     "doc_id long, text string, lang string, source string, n_chars long, score double, found string")
    return make


@pytest.fixture()
def folder(tmp_path):
    return str(tmp_path / "tables")


@pytest.fixture(scope="session")
def prose():
    """A maker of invented words and texts, the same on every run."""
    def make(seed, n, vocabulary=400, letters="etaoinshrdlu"):
        words = random.Random(seed % 7)
        known = ["".join(words.choice(letters) for _ in range(words.randint(2, 8))) for _ in range(vocabulary)]
        draw = random.Random(seed)
        return " ".join(draw.choice(known) + ("." if draw.random() < 0.1 else "") for _ in range(n))
    return make


@pytest.fixture()
def crowd(prose):
    """A maker of n texts that share a template at 0.6 to 0.7, of which the first ones have a copy at 0.75 to 0.8."""
    def make(n, pairs):
        draw, template, rows = random.Random(3), prose(11, 150), []
        for i in range(n):
            own = [f"o{i}x{k}" for k in range(draw.randint(34, 44))]
            rows.append((2 * i, template + " " + " ".join(own)))
            if i < pairs:
                rows.append((2 * i + 1, template + " " + " ".join(own[:-24] + [f"p{i}x{k}" for k in range(24)])))
        return rows
    return make


AWKWARD = [(1, None), (2, ""), (3, " \t\n"), (None, "some text without an id, and a second clause"), (4, "same"), (4, "same"), (5, "é😀 漢字 x\x00y"), (6, "a" * 30_000), (7, "b c. " * 8_000)]


@pytest.fixture()
def awkward():
    return AWKWARD
