"""Small tables with the awkward rows every text operator must take."""

import random

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ing", str(rng.randint(0, 99))]) for _ in range(n))


def texts(seed=0, n=40):
    """Random prose, then copies, near copies, null, empty, blank, repeated characters and a long text."""
    rng = random.Random(seed)
    out = [prose(rng, rng.randint(5, 120)) for _ in range(n)]
    out += out[:4] + [out[-1] + " tail", "start " + out[1], None, "", None, " \n\t", "word", "a" * 3000, "ab " * 700]
    return out + [prose(rng, 4000), "Zoë naïve 漢字 😀 " * 5]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """A documents table; rows are texts or (doc_id, text)."""
    rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
    return spark.createDataFrame([(k, t, None, "s", None) for k, t in rows], SCHEMA)


CLASHES = ("k", "t", "id", "node", "bands", "tid", "digest", "bucket", "tokens", "host", "path", "rule", "shard", "slot", "rank",
           "lane", "length", "start", "size", "score", "y", "fold", "stats", "unit", "found", "spans", "secrets", "_key", "_digest")


def clashing(df):
    """The same rows with extra columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("x") for c in CLASHES if c not in df.columns})


def same(a, b):
    """Rows as an order-free list."""
    key = lambda r: [str(x) for x in r]
    return sorted(map(tuple, a), key=key) == sorted(map(tuple, b), key=key)
