import random

import pytest
from pyspark.sql import functions as F

WORDS = "the of and to in is that it was for on are as with his they at be this from".split()


def text_of(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + str(draw.randrange(40)) for _ in range(n))


def documents() -> list[tuple]:
    """(doc_id, text, lang, source): copies, near copies, shared lines, odd values, a very long text."""
    base = text_of(1, 120)
    words = base.split()
    near = " ".join([*words[:60], "changed", *words[61:]])
    line = "  One line That\tmany have. \t"
    rows = [
        (1, base, "en", "a"),
        (2, base, "en", "a"),
        (3, near, "en", "b"),
        (4, text_of(2, 40) + " " + " ".join(words[20:75]) + " " + text_of(3, 30), "en", None),
        (5, None, None, None),
        (6, "", "en", "a"),
        (7, " \t\n \x0b\f\r ", "en", "b"),
        (8, "a b c", "en", "c"),
        (9, "A B  C", "en", "c"),
        (10, "x " * 45, "en", "c"),
        (11, text_of(4, 30_000), "en", "d"),
        (12, "ÀÉ Straße 漢字 Kİ Ünder", "de", "é"),
        (13, text_of(5, 25), "en", "b"),
        (13, text_of(5, 25), "en", "b"),
        (None, text_of(6, 25), "fr", "b"),
        (None, None, None, None),
        (-4, near, "en", "b"),
    ]
    rows += [(100 + i, f"{text_of(50 + i, 12)}\n{line}\n\n{text_of(80 + i, 9)}", "en", "e") for i in range(12)]
    return rows


#: Names that the operators use inside or give to results.
CLASHING = "page bucket payload row pos n p node component size weight copies score shard slot version digest _text _bucket _tie _source chance".split()


@pytest.fixture(scope="session")
def docs(spark):
    frame = spark.createDataFrame(documents(), "doc_id long, text string, lang string, source string")
    return frame.repartition(3).withColumns({name: F.lit(name) for name in CLASHING})


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)


def rows_of(frame, *names):
    """Rows as sorted tuples, null last."""
    found = [tuple(r) for r in frame.select(*names).collect()]
    return sorted(found, key=lambda row: [(x is None, x) if not isinstance(x, list) else (False, x) for x in row])
