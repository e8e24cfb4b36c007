import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session")
def spark():
    from fieldops.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=4, app="fieldops-tests", extra={
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="fieldops-warehouse-")})
    yield s
    s.stop()


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, ties, and columns with clashing names."""
    long_text = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    base = " ".join(f"word{i}" for i in range(60))
    rows = [(1, base, "en", "a", 1), (1, base, "en", "a", 1), (2, base + " tail", None, "a", None), (3, "", "en", None, 0),
            (4, None, None, None, None), (None, base, "en", "b", 3), (None, None, None, None, None), (5, long_text, "en", "b", 9),
            (6, long_text[5_000:80_000], "en", "c", 9), (1, "other text under the same id", "en", "c", 2),
            (7, "x " * 200, "en", "a", 400), (8, "é ü 日本 \U0001f600", "en", "a", 7), (9, " \n\t ", "en", "d", 4)]
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    clash = ("did", "tk", "h", "z", "n_words", "kept", "size", "bucket", "fp", "score", "N_bytes", "s0s", "row", "rank", "label")
    return df.select("*", *[F.lit(1).alias(c) for c in clash])


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)
