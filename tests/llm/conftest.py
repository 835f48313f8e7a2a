import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size string, id string, row string, label string, "
          "features string, score string, removed string, plan string, edge string, comp string, token string")


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text[, lang, source]); with columns whose names operators use inside."""

    def make(rows, partitions=3):
        full = []
        for r in rows:
            i, text, lang, source = (*r, *(None,) * (4 - len(r)))
            full.append((i, text, lang, source, len(text) if text else 0, *("clash",) * 11))
        return spark.createDataFrame(full, SCHEMA).repartition(partitions) if full else spark.createDataFrame([], SCHEMA)

    return make
