import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, tkey string, hashes string, score string, size string, n_lines long, spans string, items string, key string"


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n))


def corpus(seed: int = 5) -> list[tuple]:
    """(doc_id, text, source): copies, near copies, shared passages, nulls, empties, one very long text, repeated rows."""
    rng = random.Random(seed)
    base = [words(rng, rng.randint(20, 160)) for _ in range(40)]
    passage = words(rng, 70)
    lines = ["\n".join(words(rng, rng.randint(3, 14)) for _ in range(rng.randint(2, 9))) for _ in range(20)]
    rows = [(i, t, f"s{i % 5}") for i, t in enumerate(base + lines)]
    at = len(rows)
    for k in range(12):  # near copies of one text, two words changed
        w = base[0].split()
        for _ in range(2):
            w[rng.randrange(len(w))] = words(rng, 1)
        rows.append((at + k, " ".join(w), "hot"))
    at = len(rows)
    rows += [(at + k, base[1], "hot") for k in range(9)]
    at = len(rows)
    for k in range(8):  # a passage between other words, and blocks of lines
        rows.append((at + k, f"{words(rng, 30)} {passage} {words(rng, 25)}", None))
    at = len(rows)
    for k in range(8):
        rows.append((at + k, "\n".join([words(rng, 9), *lines[k].split("\n")[:4], "", words(rng, 12), *lines[0].split("\n")]), "s1"))
    at = len(rows)
    rows += [(at, None, "s1"), (at + 1, "", "s1"), (at + 2, " \n\t ", None), (at + 3, words(rng, 30000), "s2"), (at + 4, "a", ""), (at + 5, "a b", "s3"), (at + 5, "a b", "s3"), (at + 6, base[2], "s1"), (at + 6, base[3], "s1")]
    rows += [(None, base[4], "s1"), (None, None, None), (None, words(rng, 60), "s2")]
    rows += [(at + 7, "é ü 漢字 😀 ＡＢＣ ſ İ " * 30, "s4"), (at + 8, "x " * 500, "s4")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None if i is None else "en", s, None if t is None else len(t), 1, "k", "h", "0.5", "9", 3, "1", "2", None) for i, t, s in rows], SCHEMA)


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return frame(spark, rows).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return frame(spark, [])
