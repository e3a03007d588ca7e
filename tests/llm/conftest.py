import pytest

LONG = "word%d and " * 20_000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with nulls, empty and long texts, repeated rows and ids, and further columns
    that are named like those of results."""
    long = " ".join(f"word{i % 977} and{i % 13}" for i in range(40_000))
    rows = [
        (1, None, "en", "a"),
        (2, "", None, "a"),
        (3, " \n\t ", "en", None),
        (4, "one two three", "en", "a"),
        (5, "one two three", "en", "b"),
        (5, "another text with this id altogether", "en", "b"),
        (6, long, "en", "b"),
        (7, long + " end", "de", "b"),
        (None, "one two three", "en", "a"),
        (None, None, None, None),
        (8, "4711 * % 12", "en", "a"),
        (9, "one two three", "en", "b"),
        (9, "one two three", "en", "b"),
    ]
    further = "n_tokens string, runs int, items int, score string, lang_pred int, component string"
    names = [x.split()[0] for x in further.split(", ")]
    return spark.createDataFrame(
        [r + (0, str(i), i, i, "s", i) + ("x",) for i, r in enumerate(rows)],
        "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
            f"{n} {'string' if n in ('n_tokens', 'score', 'component') else 'int'}" for n in names
        ),
    )


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
