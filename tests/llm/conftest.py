import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

EXTRA = ", score double, n_tokens long, pii string, epoch int, predicted int, kept boolean, token_ids string, label string"


@pytest.fixture
def frame(spark):
    """Documents from (doc_id, text[, lang, source]) rows, with columns whose
    names the operators use for their own."""
    def make(rows, extra=True):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, r[3] if len(r) > 3 else None, len(r[1]) if r[1] is not None else None)
                + ((0.5, 7, "x", 3, 1, True, "y", "z") if extra else ()) for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long" + (EXTRA if extra else ""))
    return make
