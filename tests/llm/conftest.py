import random

import pytest
from pyspark.sql import types as T

# Extra columns whose names the operators use inside.
CLASHES = ["key", "crc", "found", "row", "norm", "sha", "part", "rep", "label", "cell", "size", "shard", "_rank", "high", "bin", "kept", "doc"]
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *[T.StructField(c, T.StringType()) for c in CLASHES],
    ]
)


def make_texts(seed: int = 4) -> list[str | None]:
    """Copies, near copies, shared passages, long, short, empty and missing texts."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefgéñ") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    sentence = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passages = [sentence(n) for n in (25, 40, 60, 120)]
    texts: list[str | None] = [None, "", " ", "\n", "a", "one two", "one two", "ONE\ttwo", "日本語 ▁ x", "x" * 3000, "ab" * 400, "q" * 199]
    for _ in range(40):
        texts.append(" ".join(rng.choice([rng.choice(passages), sentence(rng.randint(1, 60))]) for _ in range(rng.randint(1, 5))))
    base = sentence(150).split()
    for _ in range(25):
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        texts.append(" ".join(copy))
    texts += [texts[20], texts[20], texts[21].replace(" ", "  "), sentence(20_000)]
    return texts


@pytest.fixture(scope="session")
def texts():
    return make_texts()


@pytest.fixture(scope="session")
def docs(spark, texts):
    """Keys with gaps, in no order, over several partitions; two identical rows; nulls in every column but the key."""
    rng = random.Random(9)
    ids = sorted(rng.sample(range(1000), len(texts)))
    rows = [(i, t, rng.choice(["en", "de", None]), rng.choice(["a", "a", "a", "b", None]), None, *["x" if k % 2 else None for k in range(len(CLASHES))]) for i, t in zip(ids, texts, strict=True)]
    rows.append(rows[30])
    rng.shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def no_key(spark):
    return spark.createDataFrame([(None, t, None, None, None, *[None] * len(CLASHES)) for t in ("same text here", "same text here", None, "z " * 300)], SCHEMA)
