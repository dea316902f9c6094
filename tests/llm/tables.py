"""Small tables for the operator tests."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed: int, n: int = 300) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdeXYé") for _ in range(rng.randint(1, 7))) for _ in range(n)]


def corpus(seed: int = 3, n: int = 160) -> list[tuple]:
    """Near copies, exact copies, a shared passage and every odd row: (doc_id, text, lang, source, n_chars)."""
    rng, vocabulary = random.Random(seed), words(seed)
    base = [[rng.choice(vocabulary) for _ in range(rng.choice([3, 8, 40, 120]))] for _ in range(12)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(40))
    texts = [None, "", " \n\t ", "é", "a" * 400, "ab" * 300, "日本語 🙂 " * 40, "x", "A b C", "a B c"]
    for _ in range(n):
        t = list(rng.choice(base))
        for _ in range(rng.randint(0, max(1, len(t) // 25))):
            t[rng.randrange(len(t))] = rng.choice(vocabulary)
        t = " ".join(t)
        if rng.random() < 0.3:
            t = t[: len(t) // 2] + " " + passage + "\n" + t[len(t) // 2:]
        texts.append(t)
    texts += [" ".join(base[0])] * 4 + [" ".join(rng.choice(vocabulary) for _ in range(30_000))]
    rows = [(i, t, "en" if i % 3 else None, None if i % 7 == 0 else f"s{i % 4}", None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [(None, "no id at all", None, None, None), (None, texts[30], None, None, None)]
    return rows


def frame(spark, rows, schema=SCHEMA, parts=4):
    return spark.createDataFrame(rows, schema).repartition(parts)
