import importlib.util

import pytest

collect_ignore_glob = [] if importlib.util.find_spec("tunesmith.llm") else ["test_*.py"]


@pytest.fixture(scope="session")
def docs_of(spark):
    """docs_of(rows) -> DataFrame of documents; rows are (doc_id, text[, lang[, source]])."""
    from tunesmith.llm.common import ARROW_ROWS

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))

    def make(rows, parts=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s0", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").repartition(parts)

    return make
