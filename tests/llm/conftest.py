import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    r = random.Random(seed)
    out = []
    for _ in range(n):
        out.append(f"w{r.randrange(vocabulary)}")
        out.append(r.choice([" ", " ", " ", "\n", "  "]))
    return "".join(out)


def edge_rows():
    """Nulls in every column, empty and blank texts, ties, repeated rows, copies
    that differ in white space, very long texts and long words."""
    base = prose(1, 120)
    near = base.split()
    near[60] = "changed"
    rows = [
        (1, base, "en", "a", 1), (2, base.replace(" ", "\t "), "en", "b", 2), (3, " ".join(near), "en", "a", 3),
        (4, None, "en", "a", None), (5, "", None, None, 0), (6, " \n\t ", "de", "b", 3), (6, " \n\t ", "de", "b", 3),
        (None, "text without an id", "en", "c", 5), (7, "one", "en", None, 1), (8, "one two", "fr", "c", 2),
        (9, prose(2, 30000), "en", "a", 9), (10, "x" * 70000, "en", "a", 9), (11, "Ünï cödé 漢字 🎉 " * 40, "de", "b", 9),
        (12, base, "en", "a", 1), (12, base, "en", "a", 1),
    ]
    return rows + [(20 + i, prose(100 + i, 60), "en", "abc"[i % 3], 1) for i in range(30)]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(spark, edge):
    """The edge rows with extra columns named like outputs and helper columns."""
    from pyspark.sql import functions as F
    names = ["shard", "slot", "rec", "h", "h2", "bucket", "rn", "size", "copies", "_src", "target", "len", "sha", "keep_id",
             "toxicity", "token_ids", "n_tokens", "decoded", "component_id", "n_shingles", "uid", "w", "a.b", "we`ird"]
    return edge.withColumns({n: F.lit(n) for n in names}).withColumn("m", F.create_map(F.lit("k"), F.lit(1)))
