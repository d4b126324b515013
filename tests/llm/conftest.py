import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "river bridge Field water stone the of and a over under mill boat grey winter letter road garden token night".split()


def prose(seed: int, n: int) -> str:
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) + str(rnd.randrange(40)) for _ in range(n))


def small_corpus() -> list[tuple]:
    """Plain rows, copies, near copies, shared passages, short, empty and null texts, ties and repeated rows."""
    rows = [(i, prose(i, 30 + 7 * i % 90), "en", f"src{i % 4}", 1) for i in range(40)]
    texts = [r[1] for r in rows]
    rows += [(100 + i, texts[i % 5], "en", "src0", 1) for i in range(20)]
    for i in range(12):
        words = texts[7].split()
        words[(5 * i) % len(words)] = f"changed{i}"
        rows.append((200 + i, " ".join(words), "en", "src1", 1))
    passage = prose(999, 25)
    rows += [(300 + i, f"{prose(500 + i, 20)}\n{passage}\t {prose(600 + i, 15)}", "en", "src2", 1) for i in range(6)]
    rows += [
        (400, "", "en", "src0", 0), (401, None, None, None, None), (402, " \t\n ", "en", None, 3), (403, "one", "en", "src9", 3), (404, "Two words", "en", "src9", 9),
        (405, "two WORDS", "en", "src9", 9), (406, "ßÄö É two words", "de", "src3", 9), (407, "ßÄö é two words", "de", "src3", 9),
        (None, texts[0], "en", "src0", 1), (None, "nobody's text", None, None, None),
        (3, texts[3], "en", "src3", 1), (3, texts[3], "en", "src3", 1), (119, texts[4], "en", "src0", 1), (9, "another text of number nine", "en", "src3", 1),
    ]
    return rows


@pytest.fixture(scope="session")
def corpus(spark):
    return spark.createDataFrame(small_corpus(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def wide(spark):
    """Documents with columns whose names the operators use themselves, and one very long text."""
    from pyspark.sql import functions as F

    rows = [*small_corpus()[::3], (900, prose(900, 80_000), "en", "src0", 1), (901, "x" * 600_000, "en", "src1", 1)]
    names = "key tie tag size kept score node set text_sha256 sha uid epoch taken position digest going id visits start spans items label word place first n docs".split()
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({name: F.lit(f"own {name}") for name in names}).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, int(i % 7 > 0), 0) for i in range(40)] + [(1, 0, 0), (2, None, 0), (None, 1, 0), (12345, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def benchmark(spark):
    passage = prose(999, 25).split()
    rows = [(1, " ".join(passage[3:20]).upper()), (2, "two words"), (3, None), (4, ""), (5, "nobody has this line of words in any text that is here"), (None, "another text of number nine"), (1, prose(5, 12)), (6, ".,;")]
    return spark.createDataFrame(rows, "item_id long, text string")
