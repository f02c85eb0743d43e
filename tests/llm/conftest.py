import random

import pytest

WORDS = [f"w{i}" for i in range(400)] + ["the", "of", "and", "a", "Étage", "straße", "naïve", "日本語"]


@pytest.fixture(scope="session")
def texts():
    """Small corpus with every awkward case: null, empty, blank, repeated, tied, long, shared passages, near copies."""
    rng = random.Random(5)
    line = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    passage = line(60)
    out = [None, "", " \t\n ", "One", "a b", "x" * 5000, "no break here   \u0001 end"]
    for i in range(30):
        out.append("\n".join(line(rng.randint(1, 40)) for _ in range(rng.randint(1, 8))))
    for i in range(6):
        out.append(line(15) + " " + passage + " " + line(12))
    base = out[9].split(" ")
    for i in range(5):                                   # near copies, one word apart
        w = list(base)
        w[rng.randrange(len(w))] = "changed%d" % (i % 2)
        out.append(" ".join(w))
    out += [out[10], out[10], passage, passage + " " + passage, "again and again " * 40, line(9000)]
    return out


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The corpus as documents: out of order, with extra columns whose names clash, a repeated row and null ids."""
    rows = [(3 * i + 1, t, "en", None if i % 7 == 0 else "s", len(t or "")) for i, t in enumerate(texts)]
    rows.append(rows[12])
    rows += [(None, texts[11], None, None, None), (None, None, None, None, None)]
    random.Random(1).shuffle(rows)
    extra = ("score", "hits", "items", "n_words", "fp", "same", "line", "all", "rest", "ids", "keep_id", "copies", "nth", "key", "Text2")
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in extra)
    return spark.createDataFrame([r + tuple(extra) for r in rows], schema).repartition(3)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("1 = 0")
