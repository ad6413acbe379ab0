import pytest
from pyspark.sql import types as T

SMOKE = "/root/testdata/sf0.001"
LONG = "word" * 30_000 + " " + " ".join(f"w{i}" for i in range(20_000))
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog by the river bank today", "en", "b", 1),
    (2, "The quick brown fox jumps over the lazy dog by the river bank today", "en", "a", 1),
    (2, "The quick brown fox jumps over the lazy dog by the river bank today", "en", "a", 1),     # a repeated row
    (3, "", "en", "a", 0),
    (4, None, None, None, None),
    (5, "  \t\n ", "en", None, 5),
    (None, "no id at all but some words here", "en", "a", 1),
    (None, None, None, None, None),
    (6, LONG, "en", "b", len(LONG)),
    (7, "Straße ünï ▁ 日本語 🙂\x00 call +1 (437) 555-0689 or (437) 555-0689", "de", "a", 9),
    (8, "one", "en", "z", 3),
    (9, "ONE", "en", "z", 3),
]
#: further columns whose names the operators use themselves
CLASHES = ["size", "shard", "score", "node", "draws", "cell", "kind", "Doc_ID", "h"]


@pytest.fixture(scope="session")
def awkward(spark):
    shape = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                          T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                          *[T.StructField(c, T.StringType()) for c in CLASHES]])
    return spark.createDataFrame([(*r, *["x"] * len(CLASHES)) for r in ROWS], shape)


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.where("false")


@pytest.fixture(scope="session")
def vectors(spark):
    shape = "vec_id long, embedding array<float>, label int, score string, vector string"
    rows = [(i, [float((i * 7 + j * 3) % 11 - 5) / 8 for j in range(4)]) for i in range(60)]
    rows += [(0, rows[0][1]), (100, rows[0][1]), (101, None), (102, [1.0, None, 0.0, 0.0]), (103, [float("nan"), 0.0, 0.0, 0.0]),
             (104, [float("inf"), 0.0, 0.0, 0.0]), (105, [0.0] * 4), (106, [1.0]), (None, rows[1][1]), (107, [])]
    return spark.createDataFrame([(i, v, 0, "x", "x") for i, v in rows], shape)
