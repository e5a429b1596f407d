import tempfile

import pytest


@pytest.fixture(scope="session", autouse=True)
def shared(spark):
    """The folder for written tables, where the session names none."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="llm-tests-"))


@pytest.fixture(scope="session")
def tokenizer():
    from loadwitness.llm.queries import tokenizer_file

    return tokenizer_file()


#: Empty, blank, null, repeated, very long and odd texts; ids that are null and repeat; a clashing extra column.
TEXTS = [
    (1, "The cat sat on the mat.\nIt was a fine day.\nAll was well."),
    (2, "The cat sat on the mat.\nIt was a fine day.\nAll was well."),
    (3, "the cat  sat on the mat.\nIt was a fine day. All was well."),
    (4, ""),
    (5, None),
    (6, "   \n\t "),
    (7, "word " * 30000),
    (8, "x" * 50000),
    (9, "İstanbul ΣΑΣ naïve é́ <|endoftext|> don't stop now\x1cthen 12³ 文字 😀"),
    (9, "İstanbul ΣΑΣ naïve é́ <|endoftext|> don't stop now\x1cthen 12³ 文字 😀"),
    (None, "The cat sat on the mat.\nIt was a fine day.\nAll was well."),
    (None, "no id here"),
    (10, "12 34 !?"),
]


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(i, t, "en", i, "kept") for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, n_chars bigint, kept string")


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")
