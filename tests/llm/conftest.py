import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def make(spark, rows):
    return spark.createDataFrame([(d, t, "en", "src0", len(t or "")) for d, t in rows], SCHEMA)


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty, short and long texts, exact and near copies, repeated rows, ties, shared passages, special strings."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice(["ta", "ke", "Lo", "mi", "é", "ß", "中", "na"]) for _ in range(rng.randint(1, 4)))
    text = lambda n: " ".join(word() for _ in range(n))
    base, passage = [word() for _ in range(120)], text(30)
    rows = [(0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, "one two three"), (5, "ONE two three"), (6, None)]
    rows += [(10 + i, text(rng.randint(5, 90))) for i in range(20)]
    rows += [(40 + i, " ".join(base)) for i in range(5)] + [(40, " ".join(base))]
    for i in range(25):  # near copies: some within the similarity, some not
        copy = list(base)
        for _ in range(i % 6):
            copy[rng.randrange(120)] = word()
        rows.append((60 + i, " ".join(copy)))
    rows += [(100 + i, f"{text(15)}\n{passage}\n{text(12)}") for i in range(8)]
    rows += [(120, "same word " * 300), (121, "x" * 5000), (122, text(6000)), (123, "line a b c\nline a b c\nother\nline a b c")]
    rows += [(124, "a<|endoftext|>b <|startoftext|> <|im_end|>"), (125, "It's  Ωmega ΣΑΣ ﬁ İ   　 é 12345 'll ...  "), (126, "\x1c\x1d a\x85b   c")]
    rows += [(None, "no id at all, one two three four"), (None, "no id at all, one two three four"), (-5, base[0] + " " + passage), (7, passage + " " + passage)]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return make(spark, odd_rows)


@pytest.fixture(scope="session")
def none(spark):
    return make(spark, [])


@pytest.fixture(scope="session")
def renamed(odd):
    """The same rows under other names, beside columns named like those the operators make."""
    clash = ["unit", "n_words", "n_tokens", "size", "slot", "shard", "kept", "rest", "length", "sig", "part", "slots", "key", "bucket", "probability", "component_id", "ids"]
    return odd.selectExpr("doc_id AS name", "text AS body", *[f"{i} AS {c}" for i, c in enumerate(clash)])
