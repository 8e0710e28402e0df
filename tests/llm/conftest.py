import uuid

import pytest


@pytest.fixture
def documents(spark, tmp_path):
    """Write rows ``doc_id, text, lang, source`` as files and read them back, with columns of clashing names."""

    def make(rows, files=3):
        schema = "doc_id long, text string, lang string, source string, copies int, fp string"
        path = str(tmp_path / f"docs-{uuid.uuid4().hex}.parquet")
        full = [(r + (None,) * 4)[:4] + (7, "x") for r in rows]
        spark.createDataFrame(full, schema).repartition(files).write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    return make
