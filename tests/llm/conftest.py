import pytest

HOSTILE = ["", " \n\t ", None, "<|im_end|>", "a", "ünï 日本語 🙂", "x" * 5000]


@pytest.fixture
def make_docs(spark):
    """Documents (doc_id, text, lang) with further columns whose names clash with those of results."""

    def make(rows, clash=True):
        table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        if not clash:
            return table
        extra = ("score", "ids", "kept", "h", "pos", "words", "row", "own", "size", "class_id", "start", "model", "source")
        return table.selectExpr("*", *[f"'x' AS `{c}`" for c in extra])

    return make
