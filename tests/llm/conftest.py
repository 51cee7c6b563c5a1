import random

import pytest

BLANKS = " \t\n\x0b\x0c\r"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(rng, n, words="alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omicron pi rho sigma tau".split()):
    return " ".join(rng.choice(words) + rng.choice(["", "", "s", "ed", "ing", "er"]) + rng.choice(["", "x", "yz", "q"]) for _ in range(n))


def documents():
    """Texts with copies, near copies, shared passages, odd white space, and nulls in every column."""
    rng = random.Random(4)
    passage = prose(rng, 70)
    long = prose(rng, 3000)
    texts = [prose(rng, rng.randint(5, 260)) for _ in range(40)]
    texts += [f"{prose(rng, 30)}\n{passage} {prose(rng, 20)}" for _ in range(6)]
    texts += [texts[3], texts[3], texts[4] + " more words here", long, long.replace("alpha", "omega", 1)]
    texts += ["", " \t\n ", "one", "two  words", "Á é ü 中文 \x1c x", "line\n" * 60, "### $$$ a b " * 40, "SHOUTING LOUD!! " * 30, None]
    rows = [(i, t, rng.choice(["en", "de", None]), rng.choice(["hot", "hot", "b", None]), None if t is None else len(t)) for i, t in enumerate(texts)]
    rows.append((5, texts[5], "en", "hot", 1))  # a repeated row
    rows.append((None, texts[6], None, None, None))
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(documents(), SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
