"""Helpers that the text operators share."""

import pytest

from shelfmark.llm import common, exact


@pytest.mark.parametrize("hot", [2, 100])
def test_joined_hot(spark, monkeypatch, hot):
    """Keys of many rows are joined by broadcast, with the result of a plain join."""
    monkeypatch.setattr(common, "HOT_ROWS", hot)
    big = spark.createDataFrame([("a", i) for i in range(5)] + [("b", 9), ("c", 10), (None, 11)], "k string, x int")
    small = spark.createDataFrame([("a", 5, "one"), ("b", 1, "two"), ("d", 1, "none")], "k string, n long, v string")
    got = sorted(map(tuple, common.joined_hot(big, small, "k").select("k", "x", "v").collect()))
    assert got == [*[("a", i, "one") for i in range(5)], ("b", 9, "two")]


def test_without_tells_rows_by_id_and_text(spark):
    rows = spark.createDataFrame([(1, "x"), (1, "y"), (None, "x"), (None, None), (2, None), (2, "")], "doc_id long, text string")
    gone = spark.createDataFrame([(1, "x"), (None, None)], "doc_id long, text string").select("doc_id", common.text_key("text").alias("key"))
    left = {(r["doc_id"], r["text"]) for r in common.without(rows, gone).collect()}
    assert left == {(1, "y"), (None, "x"), (2, None), (2, "")}


def test_clashing_columns_pass_the_filters(spark):
    """Columns of the names that the filters' own once had."""
    names = ["__gone_id", "__gone_key", "__id", "__key", "__sha"]
    rows = spark.createDataFrame([(1, "x"), (2, "X"), (2, "X"), (3, "y"), (None, None)], "doc_id long, text string")
    rows = rows.selectExpr("*", *[f"'clash' AS {n}" for n in names])
    left = exact.drop_exact_duplicates(rows)
    assert left.columns == rows.columns
    assert sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=repr) == [(2, "X"), (3, "y"), (None, None)]


def test_no_shared_folder_is_an_error():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):  # noqa: N802
            return None

    class Session:
        sparkContext = Context()  # noqa: N815

        class conf:  # noqa: N801
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        common.shared_folder(Session())
