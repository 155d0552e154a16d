import random

import pytest

BENCHMARK = [(1, "Alpha beta GAMMA delta epsilon zeta eta theta iota kappa lambda mu"), (2, "one two three"), (10, "Ünïcode wörd-list; 42 things, and more words than ten in this item here"), (3, ""), (4, None), (None, "x y z"), (5, "one two three"), (11, "!!! ???")]


def _documents() -> list[tuple]:
    rng = random.Random(3)
    word = lambda: rng.choice(["alpha", "Beta", "gamma,", "delta", "été", "Straße", "zoo", "x1", "THE", "of"]) + str(rng.randrange(60))
    body = lambda n: " ".join(word() for _ in range(n))
    passage, long, base = body(60), body(9000), body(120)
    docs = [(0, None), (1, ""), (2, "   \n\t "), (3, "one"), (4, "One TWO"), (5, "!!!"), (6, "one two three"), (7, "a " * 80), (8, "the " * 500)]
    docs += [(20, body(300) + " " + passage + " " + body(40)), (21, passage + "\n" + body(50)), (22, body(30) + "\t" + passage), (23, body(200)), (24, long), (25, long), (26, long + " tail")]
    docs += [(30 + i, base) for i in range(6)]  # exact copies
    for i in range(12):  # near copies
        words = base.split()
        for _ in range(i // 3):
            words[rng.randrange(len(words))] = word()
        docs.append((40 + i, " ".join(words)))
    docs += [(60, "say " + BENCHMARK[0][1].lower() + " end"), (61, "beta gamma delta epsilon zeta eta theta iota kappa lambda"), (62, "ünïcode WÖRD list 42 things and more words than ten"), (63, "ÜNÏCODE wörd list 42 things and more words than ten in")]
    docs += [(70, 'set token = "1eb9c654e721b4f812088970e66a6345cee33dd6" now'), (71, "mail that.92@mail2.example.com or see/home/user42/files/page.html"), (72, "see commit 1eb9c654e721b4f812088970e66a6345cee33dd6 of that"), (73, "YOUR_API_KEY_12345678 is a placeholder")]
    docs += [(80, "Released under the MIT License.\nMore text."), (81, "mit license mit license"), (82, "GNU General Public  License and Apache-License"), (83, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files")]
    docs += [(23, body(200)), (90, passage), (90, passage), (91, base + " \x1c\x85  <|endoftext|> 日本語 " + "y" * 5000), (-5, "negative id")]
    docs += [(100 + i, body(rng.randrange(1, 90))) for i in range(60)]
    return docs


DOCUMENTS = _documents()


@pytest.fixture(scope="session")
def docs(spark):
    """Documents with nulls, empties, copies, near copies, very long texts, repeated rows and ids, and columns whose names clash with the operators' own."""
    rows = [(d, t, "en" if i % 3 else None, f"s{i % 2}", len(t or ""), i, "x", [i], 0.5, "b", 1) for i, (d, t) in enumerate(DOCUMENTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row long, found string, findings array<int>, score double, body string, n_rows int").repartition(5)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def benchmark(spark):
    return spark.createDataFrame([(i, t, "z") for i, t in BENCHMARK], "item_id long, text string, hits string")
