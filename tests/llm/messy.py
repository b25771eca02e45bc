"""Small tables with every awkward case, shared by the operator tests."""

import random
from collections import Counter

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # extra columns with names that operators use themselves
    T.StructField("keep_id", T.StringType()), T.StructField("route", T.StringType()), T.StructField("Text", T.IntegerType()),
])

WORDS = "the of and alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi pi rho sigma tau".split()


def passage(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 99)) for _ in range(n))


def rows() -> list[tuple]:
    rng = random.Random(7)
    shared, other = passage(rng, 60), passage(rng, 45)
    out = [(i, passage(rng, rng.randint(1, 80)), rng.choice(["en", "de", None]), rng.choice(["a", "b", None, "c"])) for i in range(30)]
    out += [(30 + i, passage(rng, rng.randint(0, 30)) + " " + shared + " " + passage(rng, 5), "en", "a") for i in range(6)]
    out += [(40, shared, "en", "b"), (41, shared, "en", "b"), (42, other + "\n\n" + other, "de", "c"), (43, "x\t" + other, "de", "c")]
    out += [(50, None, None, None), (51, "", "en", "a"), (52, "   \n", "en", "a"), (53, "one", "en", "b"), (54, "one  two", "en", "b"),
            (55, "one two", None, "b"), (56, "a" * 700, "en", "a"), (57, "1 2 3 4", "en", None), (58, "été 漢字 😀".encode("utf-16", "surrogatepass").decode("utf-16"), "fr", "d")]
    out += [(60, "Word " * 9000, "en", "a"), (61, ("Word " * 9000).lower() + "end", "en", "a"), (-5, "one two", "en", "z")]
    out += [out[3], out[3], out[31]]  # repeated rows
    return [(*r, None if r[1] is None else len(r[1]), "k", "r", 1) for r in out]


def messy(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def texts() -> dict[int, str]:
    return {r[0]: r[1] or "" for r in rows()}


def as_counter(records) -> Counter:
    return Counter(tuple(r) for r in records)
