"""Small tables with the awkward cases every operator must handle."""

import random

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(n))


#: Names that operators use inside; as extra columns they must not clash.
CLASH = {"class": "x", "bucket": 1, "score": 2.0, "length": 3, "rank": 4, "spans": "y", "low": "z", "votes": 5, "root": "r"}


def awkward(spark, texts, name="doc_id", column="text"):
    """Rows (id, text) plus nulls, empty, blank, repeated and very long ones."""
    rows = list(texts)
    n = len(rows)
    rows += [(n, None), (n + 1, ""), (n + 2, " \n\t "), (None, rows[0][1]), (None, None), rows[0], rows[0]]
    rows += [(n + 3, prose(99, 20000)), (n + 4, "x" * 5000), (n + 5, "é" * 3 + " <tag token: " + "\U0001f600" * 9)]
    kinds = f"{name} bigint, {column} string, " + ", ".join(
        f"`{k}` {'string' if isinstance(v, str) else 'double' if isinstance(v, float) else 'int'}" for k, v in CLASH.items()
    )
    return spark.createDataFrame([(*r, *CLASH.values()) for r in rows], kinds).repartition(5), rows


def empty(spark, schema):
    return spark.createDataFrame([], schema)


def same(a, b):
    key = lambda r: tuple((x is None, str(x)) for x in r)
    a, b = sorted(map(tuple, a), key=key), sorted(map(tuple, b), key=key)
    assert len(a) == len(b)
    for x, y in zip(a, b, strict=True):
        assert x == y
