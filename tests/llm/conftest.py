import pytest

LONG = "word and more " * 40_000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and blank texts, a very long one, repeated rows, equal texts, and columns whose names
    the operators might use themselves."""
    rows = [(1, "Released under the MIT License."), (2, None), (3, ""), (4, " \n\t "), (5, LONG), (5, LONG),
            (6, "token = abcdef0123456789abcdef"), (7, "token = abcdef0123456789abcdef"), (None, "no key at all"),
            (8, "Ünïcode wörds ſtay Kelvin \u212a and \U0001f600 too"), (None, None), (9, "one")]
    names = "id node n words label score curve ids share text_ _text _key _copy level terms size".split()
    return spark.createDataFrame([(*r, "en", "s", 0, *["x"] * len(names)) for r in rows],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint, "
                                 + ", ".join(f"`{n}` string" for n in names))


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
