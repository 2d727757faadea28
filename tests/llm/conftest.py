import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words int, kept string, score string, key int, row int, host string, `group` int, places int, event string"


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeghilmnorstué") for _ in range(rng.randint(2, 8))) for _ in range(vocabulary)]
    return [rng.choice(words) for _ in range(n)]


def texts():
    """Nulls, blanks, repeats, near copies, shared passages, junk, other scripts, one long text."""
    base, other, passage = prose(1, 120), prose(2, 90), prose(3, 60)
    near = list(base)
    near[60:63] = ["xx", "yy"]
    return [
        None, "", "  \n\t ", "word", "one two three four", "One TWO three four", "a b c d e", " ".join(base), " ".join(base).upper(), " ".join(near), "\n".join(base), " ".join(near[:100]),
        " ".join(other), " ".join(other), " ".join(other[:40] + passage + other[40:]), " ".join(passage), " ".join(prose(4, 30) + passage), " ".join(["Der"] * 80), " ".join(["spam spam"] * 60),
        " ".join(w + "%%%" for w in prose(5, 80)), " | ".join(prose(6, 60)), "Größe ñandú 漢字 \U0001f600 <b>x</b> " * 12, " ".join(prose(7, 30_000, 5_000)), "tab\tand\x0bodd\x0cspace\rhere " * 9,
        "First line here.\nShared footer line\nLast", "Second text.\nShared footer line", "Licensed under the MIT License.\n" + " ".join(prose(8, 50)), "x" * 50_000, "\n\n\n", "Shared footer line",
    ]


@pytest.fixture(scope="session")
def documents(spark):
    rows = []
    for i, text in enumerate(texts()):
        rows.append((i * 7 % 31, text, "en", f"s{i % 2}" if i != 3 else None, None, 1, "k", "s", 2, 3, "h", 4, 5, "e"))
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)
