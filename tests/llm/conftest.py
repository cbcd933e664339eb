import pytest

FIELDS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text[, lang[, source]]), with extra columns whose names operators use themselves."""

    def build(rows, extra=True):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, FIELDS)
        if extra:
            from pyspark.sql import functions as F

            for name in ("fp", "rep", "ids", "n", "score", "x", "k", "row", "component_id", "_h", "_b", "sig", "y", "bits", "part", "block", "slot"):
                df = df.withColumn(name, F.lit("clash"))
        return df

    return build


@pytest.fixture(scope="session")
def words():
    import random

    r = random.Random(5)
    vocabulary = ["".join(r.choice("abcdefghilmnoprstu") for _ in range(r.randint(2, 9))) for _ in range(400)]

    def text(seed, n):
        q = random.Random(seed)
        return " ".join(q.choice(vocabulary) for _ in range(n))

    return text
