import datetime as dt

import pytest

LETTERS = {"en": "the thing and those other then", "de": "über schön größe straße der die", "fr": "où été garçon les élève"}


@pytest.fixture(scope="session")
def corpus(spark):
    """Small documents with every odd case, and columns whose names clash
    with those that operators add."""
    import random

    r = random.Random(7)

    def prose(lang, n):
        stems = LETTERS[lang].split()
        return " ".join("".join(r.choice(stems) for _ in range(r.randint(1, 2))) for _ in range(n))

    rows = []
    for i in range(60):
        lang = ("en", "de", "fr")[i % 3]
        rows.append((i, "\n".join(prose(lang, 25) for _ in range(3)), lang, f"s{i % 12}"))
    for i in range(60, 74):  # one line on all sites
        rows.append((i, "Shared line, the same here.\n" + prose("en", 40), "en", f"s{i % 12}"))
    base = prose("en", 200)
    rows += [(80, base, "en", "s1"), (81, base, "en", "s2"), (82, base.replace(base.split()[100], "changed"), None, "s3")]
    rows += [(90, None, None, None), (91, "", "en", "s1"), (92, "... !!! 12", None, "s1"), (93, "word", "en", None), (94, "word", "en", "s2")]
    rows += [(95, "x" * 5000 + " y" * 3000, "en", "s5"), (96, "\n\n  \n", "en", "s1")]
    rows += [(None, prose("en", 30), "en", "s1"), (80, base, "en", "s1")]  # no id; a repeated row
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, start string, shard int, removed string, text_hash string"
    return spark.createDataFrame([(*x, None if x[1] is None else len(x[1]), 0.5, "a", 1, "b", "c") for x in rows], schema)


@pytest.fixture()
def none(corpus):
    return corpus.limit(0)


TS = dt.datetime(2024, 2, 1)
