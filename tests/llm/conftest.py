import pytest


@pytest.fixture
def table(spark):
    """A documents-like table from (doc_id, text) or (doc_id, text, lang) rows."""
    def make(rows, schema="doc_id long, text string"):
        return spark.createDataFrame(rows, schema)
    return make


#: Nulls, empty texts, ties, repeated rows, a long text.
EDGE = [(1, None), (2, ""), (3, " \t\n"), (4, "one two three"), (4, "one two three"), (5, "One TWO three"),
        (6, "x" * 5000 + " " + "word " * 3000), (7, "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 3), (None, "no id here")]
