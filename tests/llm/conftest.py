import random

import pytest

from tests.conftest import conf, spark  # noqa: F401 - the session of all tests

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns named like what the operators make themselves.
CLASHING = ("keep_id", "start", "key", "digest", "label", "sequence_id", "bucket", "host", "kept", "rank")


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def corpus():
    """Nulls, empty and one-word texts, copies, near-copies, shared passages, odd characters, and one very long text."""
    rng = random.Random(7)
    passage = words(rng, 60)
    base = words(rng, 300)
    texts = [words(rng, rng.randrange(1, 120)) for _ in range(40)]
    texts += [None, "", "", " \t\n ", "word", "word", "été à Noël", "日本語 テスト", "🙂🙂 🙂", "a  b\x0bc\r\n d", "12 34 !!"]
    texts += [base] * 3 + [texts[0]] * 4
    for _ in range(6):
        near = base.split()
        for at in rng.sample(range(300), 4):
            near[at] = "changed"
        texts.append(" ".join(near))
    texts += [f"{words(rng, 30)} {passage} {words(rng, 30)}" for _ in range(8)]
    texts += [words(rng, 30_000, 3000), "same " * 500]
    rows = [(i * 3 + 1, t, "en" if i % 3 else None, f"s{i % 4}" if i % 5 else None, 0) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):  # noqa: F811
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def wide(spark, docs):  # noqa: F811
    """The same with further columns of clashing names."""
    return docs.selectExpr("*", *[f"'x' AS {name}" for name in CLASHING])


@pytest.fixture(scope="session")
def empty(spark):  # noqa: F811
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def repeated(spark):  # noqa: F811
    """Repeated rows, ties and null ids."""
    rows = [(5, "a b c d e f", "en", "s", 1)] * 3 + [(None, "a b c d e f", None, None, None), (None, None, None, None, None)]
    return spark.createDataFrame([*rows, (5, "other text", "en", "s", 1), (9, None, "en", None, 0)], SCHEMA)
