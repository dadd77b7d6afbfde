"""Small tables with the cases every operator has to stand: nulls, empty and long texts, ties, repeated rows, clashing names."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rid long, h string, bits string"
WORDS = "alpha beta gamma delta eta theta iota kappa lambda mu nu xi omikron pi rho sigma tau".split()


def words(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def odd_docs(spark, texts, null_id=None):
    """One row per text with ids from 0, and columns whose names operators use themselves."""
    rows = [(i, t, "en", None, None, 7, "x", None) for i, t in enumerate(texts)]
    if null_id is not None:
        rows.append((None, null_id, None, None, None, None, None, None))
    return spark.createDataFrame(rows, SCHEMA)


def passages(seed, n=50):
    """Texts that share passages, with copies, an empty, a blank, a null and a long one."""
    rng = random.Random(seed)
    shared = [words(rng, rng.randint(8, 50)) for _ in range(5)]
    lines = lambda: "\n".join(rng.choice(shared) if rng.random() < 0.5 else words(rng, rng.randint(1, 30)) for _ in range(rng.randint(0, 6)))
    texts = [lines() for _ in range(n)]
    return texts + texts[:3] + ["", " \n ", None, words(rng, 30_000), "é " * 70]
