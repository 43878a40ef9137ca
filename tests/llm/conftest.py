from __future__ import annotations

import pytest

from clickpath.llm.common import ship

#: names that operators use inside; extra columns of the input with them must do no harm
CLASHING = ["chunk", "bucket", "score", "row", "node", "block", "key", "size", "hits", "label", "mix_tokens", "n_words", "spans", "part"]


@pytest.fixture(scope="session")
def corpus(spark):
    """A maker of document tables: (id, text[, source, lang]) rows, with clashing extra columns."""
    ship(spark)

    def make(rows, extra=True):
        full = [(r[0], r[1], *(r[3:4] or ["en"]), *(r[2:3] or ["s"]), len(r[1]) if r[1] is not None else None) for r in rows]
        df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
        return df.selectExpr("*", *[f"'x' as `{c}`" for c in CLASHING]) if extra else df

    return make
