import pytest
from pyspark.sql import types as T

#: columns that clash with names the operators use themselves
CLASH = ["row", "out", "value", "text_key", "host", "hash", "key", "slice", "part", "n", "a", "spans", "ident", "root"]

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())]
                    + [T.StructField(c, T.StringType()) for c in CLASH])


@pytest.fixture()
def make_docs(spark):
    """Documents of (doc_id, text, source) with clashing extra columns."""
    def make(rows):
        return spark.createDataFrame(
            [(i, t, "en", s, len(t or "")) + tuple("x" for _ in CLASH) for i, t, s in rows], DOCS)
    return make


@pytest.fixture()
def awkward():
    """Nulls in any column, empty, blank and long texts, repeated rows, ties."""
    prose = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau"
    return [(1, prose, "s0"), (1, prose, "s0"), (1, prose, "s0"), (2, None, "s0"), (None, prose + " x", None),
            (None, None, None), (3, "", "s1"), (4, "   \n \n\t", "s1"), (5, "w" * 30_000, "s0"),
            (6, (prose + "\n") * 400, "s0"), (7, "one", "s1"), (8, "one two", "s1"),
            (9, "é ñ ü 梦 \U0001F600 ▁ ​ \x00 <s>", "s1"), (1, "another text of the same id", "s1")]
