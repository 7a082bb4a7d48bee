import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
#: Columns whose names also occur inside the operators or in their results.
CLASHING = ("bucket", "fp", "node", "score", "severity", "spans", "kept", "component_id", "slot", "group", "of")


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text) rows, with clashing columns on demand."""

    def make(rows, clashing=False, parts=3):
        df = spark.createDataFrame(rows, DOCS).repartition(parts)
        for c in CLASHING if clashing else ():
            from pyspark.sql import functions as F

            df = df.withColumn(c, F.lit("clash"))
        return df

    return make


@pytest.fixture(scope="session")
def ragged():
    """Nulls, empty and blank texts, ties, repeated rows and one long text."""
    long = " ".join(f"w{i * i % 977}" for i in range(30_000))
    same = "the quick brown fox jumps over the lazy dog and runs away from the big bad wolf in the dark wood again and again"
    return [
        (5, same), (5, same), (2, same + " today"), (9, None), (None, same), (None, None), (7, ""), (8, " \t\n"), (1, "one"),
        (3, "é ß \U0001f600 " + same), (11, long), (12, "before " + long[:5000] + " after"), (4, "a " * 500), (10, "a " * 600),
    ]
