"""What the tests of this folder share."""

import pytest

SMALL = "/root/testdata/sf0.001"

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators give to their own columns.
CLASHING = (
    "doc", "id", "key", "size", "n", "bucket", "span", "spans", "base", "items", "component", "label",
    "quality", "taken", "score", "a", "b", "digest", "start", "end", "fingerprint", "cuts", "word",
)


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table from (doc_id, text) or (doc_id, text, lang, source) rows."""

    def make(*rows, extra=False):
        full = [(*r, *[None] * (4 - len(r)), len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCUMENT)
        if extra:
            for name in CLASHING:
                df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return make
