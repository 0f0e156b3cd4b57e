import random

import pytest

#: Texts that all operators must bear: nulls, empties, blanks, repeats, shared passages, a long one.
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def make_texts(seed: int, n: int = 60) -> list[str | None]:
    r = random.Random(seed)
    word = lambda: r.choice(WORDS) + str(r.randrange(40))
    base = [" ".join(word() for _ in range(r.randrange(5, 150))) for _ in range(n)]
    passage = " ".join(word() for _ in range(40))
    out: list[str | None] = [None, "", " ", "\n", "a", "ä b\n\n", "x " * 400, "Straße über " * 60]
    for i, t in enumerate(base):
        k = i % 6
        if k == 1:
            t = t + " " + passage
        elif k == 2:
            t = passage + "\n" + t
        elif k == 3:
            t = r.choice(base[: i + 1])
        elif k == 4:
            w = r.choice(base).split()
            w[r.randrange(len(w))] = "edited"
            t = " ".join(w)
        out.append(t)
    out.append(" ".join(word() for _ in range(9000)))
    return out


@pytest.fixture(scope="session")
def texts():
    return make_texts(7)


@pytest.fixture(scope="session")
def docs(spark, texts):
    """Ids aren't in the order of rows; columns that clash with names inside the operators."""
    rows = [((i * 37) % 997, t, ["en", "de", None][i % 3], ["b", "a", None, "c"][i % 4], None if t is None else len(t), "x", 1, "y") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key string, size int, pos string").repartition(5).cache()


@pytest.fixture(scope="session")
def by_id(docs):
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def empty(spark, docs):
    return spark.createDataFrame([], docs.schema)
