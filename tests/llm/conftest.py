import pytest
from prose_llm import prose
from pyspark.sql import types as T

@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with null ids, null and empty texts, repeats and an extra column that clashes with inner names."""
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("text", T.StringType()),
            T.StructField("lang", T.StringType()),
            T.StructField("source", T.StringType()),
            T.StructField("n_chars", T.LongType()),
            T.StructField("_text", T.StringType()),
            T.StructField("component", T.StringType()),
        ]
    )

    def make(rows):
        full = [(i, t, "en", "s", len(t) if t is not None else None, "x", "y") for i, t in rows]
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    base = prose(300, 1)
    words = base.split()
    near = " ".join([*words[:150], "changed", *words[151:]])
    return [
        (5, base),
        (3, base.upper()),
        (9, near),
        (9, near),
        (None, base),
        (11, None),
        (12, ""),
        (13, " \n\t "),
        (14, "only three words"),
        (15, "Only three  words"),
        (16, prose(60_000, 2)),
        (17, prose(50, 3)),
    ]
