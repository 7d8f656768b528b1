import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns whose names the operators use inside.
CLASHES = ["rk", "tk", "part", "blob", "shard", "score", "kind", "bucket", "rest", "label",
           "none", "_gone_id", "gone_id", "gone_text", "_again_id", "again_id", "n", "place", "block", "term", "own", "c0"]


def corpus(n: int = 60, seed: int = 5) -> list[tuple]:
    """Documents with near copies, exact copies, shared passages, repeats, nulls, empty, odd and long texts."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéfgß") for _ in range(rng.randint(2, 6))) for _ in range(300)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(70))
    texts: list = []
    for k in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([3, 12, 40, 90, 160]))]
        kind = rng.random()
        if texts and kind < 0.15:
            texts.append(rng.choice([t for t in texts if t]))
        elif texts and kind < 0.4:
            near = (rng.choice([t for t in texts if t])).split()
            for _ in range(rng.randint(1, 3)):
                near[rng.randrange(len(near))] = rng.choice(vocabulary)
            texts.append(" ".join(near))
        elif kind < 0.6:
            texts.append(" ".join(words) + ".\n" + passage + "\n" + " ".join(reversed(words)))
        else:
            texts.append("  ".join(words).title())
    texts += [None, "", " \n\t", "a", "A", "ab ab " * 4000, "x y   z <|endoftext|> \x1c q", "z" * 9000]
    rows = [(10 + 3 * k, t, "en", f"s{k % 3}", None if t is None else len(t)) for k, t in enumerate(texts)]
    rng.shuffle(rows)
    rows += [rows[0], (None, "no name at all", None, None, 14), (None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return frame.withColumns({c: F.lit(c) for c in CLASHES})


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
