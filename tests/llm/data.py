"""Rows with nulls, empty and long texts, ties and repeats, and columns whose
names clash with the operators' own."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(n: int = 120, seed: int = 3) -> list[tuple]:
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 7))) for _ in range(300)]
    rows = []
    for i in range(n):
        words = [rnd.choice(vocabulary) for _ in range(rnd.choice([1, 2, 3, 60, 80, 120, 200]))]
        text = " ".join(words)
        if i % 7 == 0:
            text = text.replace(" ", "### ").upper()
        rows.append((i, text, "en", rnd.choice(["hot", "hot", "a", "b", None]), len(text)))
        if i % 5 == 0 and len(words) > 50:  # a near copy and an exact one
            words[rnd.randrange(len(words))] = "zzz"
            rows.append((1000 + i, " ".join(words), "en", "hot", None))
            rows.append((2000 + i, text, None, "hot", 1))
    rows += [(5000, None, None, None, None), (5001, "", "en", "a", 0), (5002, " \n\t", "en", "a", 3), (None, "null id " * 30, "en", "a", 1),
             (5003, "long " * 40_000 + "tail", "en", "hot", 1)]
    rows += [rows[3]] * 3 + [(None, None, None, None, None)] * 2  # rows that repeat
    return rows


def empty(spark, schema: str = SCHEMA):
    return spark.createDataFrame([], schema)


def table(spark, rows=None, parts: int = 4):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA).repartition(parts)
