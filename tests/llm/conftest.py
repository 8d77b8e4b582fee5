import random

import pytest

#: names that operators use inside; tables may have them too
CLASHING = ["key", "row", "node", "size", "n", "path", "block", "words", "chars", "target", "takes", "spans", "kept", "score", "items"]
VOCABULARY = [f"w{i}" for i in range(400)] + ["the", "of", "and", "to", "ünder", "été"]


def make_documents(spark, rows):
    """A documents table of (doc_id, text, lang, source) with extra columns of clashing names."""
    full = [(i, t, lang, s, len(t or ""), *["x"] * len(CLASHING)) for i, t, lang, s in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, "
                                 + ", ".join(f"{c} string" for c in CLASHING))


def prose(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Rows with copies, near copies, shared passages, nulls, empty texts, a long text and repeated rows."""
    rng = random.Random(5)
    rows, passage = [], prose(rng, 60)
    for i in range(40):
        rows.append((i, prose(rng, rng.randint(1, 120)) + "\n" + prose(rng, 20), "en", f"s{i % 3}"))
    for i in range(40, 52):  # one passage in different places
        rows.append((i, prose(rng, rng.randint(0, 30)) + " " + passage + "\t" + prose(rng, rng.randint(0, 30)), "fr", "s1"))
    for i in range(52, 60):  # near copies of document 3, some of them exact
        words = (rows[3][1] + " " + passage).split(" ")
        for _ in range(i % 3):
            words[rng.randrange(len(words))] = "changed"
        rows.append((i, " ".join(words), "en", "s2"))
    rows += [(60, None, None, None), (61, "", "en", "s0"), (62, " \n\t ", "de", "s0"), (63, "one", "en", "s0"), (64, "one", "en", "s0"),
             (65, prose(rng, 6000), "en", "s2"), (66, "ab" * 400, "en", "s1"), (67, "same " * 300, "en", "s1")]
    return rows + [rows[5], rows[5], rows[60]]


@pytest.fixture(scope="session")
def documents(spark, corpus):
    return make_documents(spark, corpus).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return make_documents(spark, [(0, "x", "en", "s")]).limit(0)
