"""Small corpora with planted cases."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def passage(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def make_corpus(seed=1, n=60):
    """(doc_id, text): fresh texts, exact and near copies, shared passages, repeats inside a text."""
    rng = random.Random(seed)
    shared = [passage(rng, 60) for _ in range(3)]
    texts = [passage(rng, rng.randrange(1, 300)) for _ in range(n)]
    texts += texts[:8]
    for t in texts[8:20]:
        w = t.split()
        if len(w) > 40:
            w[rng.randrange(len(w))] = "changed"
        texts.append(" ".join(w))
    for s in shared:
        texts += [passage(rng, 80) + " " + s + "\n" + passage(rng, 50) for _ in range(6)]
    texts += ["same " * 80, ("abc " * 7 + "x ") * 30, "", None, "one", "one two three", "ONE two three", "é" * 400, "long" * 9000]
    order = list(range(len(texts)))
    rng.shuffle(order)
    return [(k, texts[j]) for k, j in enumerate(order)]
