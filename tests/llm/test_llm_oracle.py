"""Queries of the subpackage against their SQL."""

import pytest
from check import difference

from tillwatch.llm import queries


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_query_equals_sql(spark, sf_dir, name):
    count, wrong = difference(spark, name, sf_dir)
    assert wrong is None
    assert count > 0


def test_vectors_that_link_with_nothing_and_copies(spark, tmp_path):
    vectors = [[1.0, 2.0], [1.0, 2.0], [2.0, 4.1], [-1.0, 2.0], None, [], [0.0, 0.0], [float("nan"), 1.0], [float("inf"), 1.0], [None, 1.0], [3e38, 3e38], [1e-38, 1e-38], [1.0]]
    rows = [(k, vector) for k, vector in enumerate(vectors)] + [(3, [-1.0, 2.0]), (4, None), (None, [1.0, 2.0]), (None, None)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1).write.parquet(str(tmp_path / "all"))
    next((tmp_path / "all").glob("*.parquet")).rename(tmp_path / "embeddings.parquet")
    count, wrong = difference(spark, "op5_hyperplane_embedding_dedup", str(tmp_path))
    assert (count, wrong) == (len(rows), None)


def test_statistics_of_odd_texts(spark, tmp_path):
    texts = ["", None, " \n\t ", "a", "é ü 日本語 𝒳", "a b c d e a b c d e f", "a a a a a a a a", "x\n\nx\n x\nx", "#*$%&|<>", "one\x0btwo\x0cthree\rfour\xa0five", "w " * 30000]
    rows = [(k, text) for k, text in enumerate(texts)] + [(3, "a"), (None, "a b c d e " * 5)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "all"))
    next((tmp_path / "all").glob("*.parquet")).rename(tmp_path / "documents.parquet")
    count, wrong = difference(spark, "quality_base_statistics", str(tmp_path))
    assert (count, wrong) == (len(rows), None)
