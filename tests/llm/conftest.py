import random

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def corpus():
    """Texts with copies, near copies, shared passages, junk, nulls, empties, ties and a very long one."""
    rng = random.Random(3)
    vocab = ["w" + "".join(rng.choices("abcdefghij", k=rng.randint(1, 6))) for _ in range(400)] + ["the", "of", "and"] * 30
    make = lambda n: [rng.choice(vocab) for _ in range(n)]
    passage = make(60)
    texts = [" ".join(make(rng.randint(1, 150))) for _ in range(40)]
    texts += [" ".join(make(30) + passage + make(20)) for _ in range(6)]
    base = make(160)
    for k in range(8):
        near = list(base)
        for _ in range(k):
            near[rng.randrange(160)] = rng.choice(vocab)
        texts.append(" ".join(near))
    texts += [texts[3], texts[3], texts[41], None, None, "", "   \n\t ", "x", "Of Of " * 60, "é" * 30 + " ü😀 　 ß", " ".join(make(9000))]
    texts += ["Mail a.b@c.example.org or call +1 (415) 555-0100 now, card 4111 1111 1111 1111 at 10.0.0.1. " + " ".join(make(70))]
    return list(enumerate(texts))


@pytest.fixture()
def documents(spark, corpus):
    return spark.createDataFrame([(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in corpus], DOC)


@pytest.fixture()
def empty(spark):
    return spark.createDataFrame([], DOC)
