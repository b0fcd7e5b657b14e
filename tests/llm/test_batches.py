"""How many whole texts the pipeline's stages send to Python at once."""

import pyarrow as pa
import pytest

import corpus_pipeline


@pytest.mark.parametrize("limit, most", [("10000", 1000), ("0", 1000), ("300", 300)])
def test_texts_move_in_small_batches(spark, tmp_path, limit, most):
    """A stage's lazy result is computed with at most 1,000 rows a batch; the session's smaller limit stays."""
    own = spark.conf.get(corpus_pipeline.BATCH_ROWS)
    try:
        spark.conf.set(corpus_pipeline.BATCH_ROWS, limit)
        docs = spark.range(2500).selectExpr("id AS doc_id", "'a few words' AS text", "'en' AS lang").coalesce(1)
        out = corpus_pipeline.encoded(spark, docs, "")
        sizes = [r.n for r in docs.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches), "n long").collect()]
        assert max(sizes) == most and sum(sizes) == 2500
        assert out.where("lossless").count() == 2500
    finally:
        spark.conf.set(corpus_pipeline.BATCH_ROWS, own)
