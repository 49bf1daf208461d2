import random

import pytest


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from clickmarts.llm.common import ship
    return ship(spark)


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def texts():
    """Awkward texts: null, empty, blanks, one word, copies, near copies, edges, marks, very long ones."""
    r = random.Random(5)

    def prose(n, letters="etaoinshrdlu"):
        return " ".join("".join(r.choice(letters) for _ in range(r.randint(2, 9))) for _ in range(n))

    base = prose(300)
    words = base.split()
    near = words.copy()
    near[150] = "changed"
    far = [w if i % 9 else "other" + str(i) for i, w in enumerate(words)]
    chain = words.copy()
    for i in (20, 150):
        chain[i] = "links"
    shared = prose(60)
    out = [None, "", "   \n\t", "Word", "word", "two words", base, base, base.upper(), " ".join(near), " ".join(far),
           " ".join(chain), prose(40) + " " + shared + " " + prose(50), prose(80) + "\n" + shared, shared,
           "x" * 49, "x" * 50, "x" * 200, "é" * 120 + " ünï", "ab" * 100, "Mail a.b@c.example.org, call +1 (988) 555-2485.",
           "card 4944339490429605 at 55.63.178.142 or 300.1.1.1", "released under the MIT License. All rights reserved.",
           "a <|endoftext|> b  \n\n c 's 'll 12345 ???", " ".join([prose(5)] * 3000), "\x00\x01 \u2028 \U0001F600 ß İ",
           prose(3000), "the quick brown fox", "the quick brown fox", "the quick brown fox jumps"]
    return out + [prose(r.randint(1, 60)) for _ in range(30)]


@pytest.fixture(scope="session")
def docs(spark, texts):
    rows = [(i, t, "en", "s", 0 if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def rows(df, *keys):
    return sorted((tuple(r) for r in df.collect()), key=repr)
