import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

# Names that operators use inside, or give to results.
CLASHING = ["id", "words", "n_words", "labels", "score", "fp", "items", "spans", "tokens", "n_tokens", "slice", "digit",
            "kept", "found", "class", "line", "failures", "column_0", "gone_id", "hit_id"]


def syllables(rng, n):
    return " ".join("".join(rng.choice(["an", "er", "th", "ing", "lo", "mi", "é"]) for _ in range(rng.randint(1, 3)))
                    for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """Null, empty and blank texts, one very long one, ties, copies and shared passages."""
    rng = random.Random(4)
    passage = syllables(rng, 40)
    made = [None, "", " \n\t ", "x", "A", "a", "one two", "漢字 " * 30, "!" * 200, "=" * 999, syllables(rng, 30_000)]
    made += [syllables(rng, rng.randint(3, 120)) for _ in range(30)]
    made += [f"{syllables(rng, 10)} {passage} {syllables(rng, 10)}" for _ in range(10)]
    made += made[11:16]
    near = made[20].split(" ")
    made += [" ".join([*near[:-1], word]) for word in ("uno", "dos", "tres")]
    return made


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts with ids (one is null, one row comes twice) and columns of clashing names."""
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "a text without an id"), (3, texts[3])]
    width = len(CLASHING)
    schema = "doc_id bigint, text string, " + ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame([(*row, *["z"] * width) for row in rows], schema).repartition(3)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("doc_id < -1")


def clashing(df, names=CLASHING):
    """``df`` with more columns of those names, where it has none."""
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("z") for c in names if c not in df.columns})


def collected(df):
    return [tuple(r) for r in df.collect()]
