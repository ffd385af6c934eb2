"""Word patterns on a very long word."""

import time

from pyspark.sql import functions as F

from wordloom.functions import patterns as P


def test_long_word_without_a_run(spark):
    df = spark.createDataFrame([("ab" * 60_000 + " been",)], "text string")
    t0 = time.time()
    for pattern, found in ((P.elongated(2), ["been"]), (P.vowel_cluster(), [])):
        assert df.select(F.regexp_extract_all("text", F.lit(pattern), 0)).first()[0] == found
    assert time.time() - t0 < 20
