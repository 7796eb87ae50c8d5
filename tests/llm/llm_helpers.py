"""Small tables with the rows that every operator must bear, and plain versions of the operators."""

import hashlib

import numpy as np

DOCS = "doc_id long, text string, lang string, source string, n_chars int"


def docs(spark, rows, extra=""):
    full = [(i, t, "en", "s", None if t is None else len(t), *more) for i, t, *more in rows]
    return spark.createDataFrame(full, DOCS + extra).repartition(3)


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def words(rng, n, vocabulary=400):
    return [f"w{i}" for i in rng.integers(0, vocabulary, n)]


def corpus(seed, n=60, vocabulary=400):
    """Texts that share passages, copy each other and change a word here and there."""
    rng = np.random.default_rng(seed)
    passages = [words(rng, int(rng.integers(8, 120)), vocabulary) for _ in range(8)]
    out = []
    for i in range(n):
        if i and rng.random() < 0.35:
            own = out[int(rng.integers(0, len(out)))].split()
            for _ in range(int(rng.integers(0, 3))):
                if own:
                    own[int(rng.integers(0, len(own)))] = f"x{rng.integers(0, 50)}"
        else:
            own = []
            for _ in range(int(rng.integers(1, 5))):
                own += words(rng, int(rng.integers(0, 40)), vocabulary)
                if rng.random() < 0.6:
                    own += passages[int(rng.integers(0, len(passages)))]
        text = " ".join(own)
        out.append(text.replace(" w7 ", "\n").replace(" w9 ", " \t W9,\n "))
    return out


def blanks(text):
    """Words between the six blanks."""
    return (text or "").encode().split()


def component(n, links):
    """The least node that each node reaches."""
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return [root(i) for i in range(n)]
