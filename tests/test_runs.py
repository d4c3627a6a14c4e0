"""Runs of tokens counted over Arrow batches against the column expressions."""

import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import rows
from threadloom.functions import runs, text as X
from threadloom.operators import features as F1


@pytest.mark.parametrize("letters", ["abc", "a b", "ab "])
def test_runs_equal_the_sorted_ngrams(spark, letters, monkeypatch):
    monkeypatch.setattr(runs, "TOKENS", 50)
    draw = random.Random(7)
    # Tokens with blanks make runs of different lengths read the same.
    made = [[draw.choice(letters).replace(" ", "a b") for _ in range(draw.randint(0, 30))] for _ in range(200)] + [[], None, ["z"] * 60]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(made)], "id int, tokens array<string>")
    t = F.col("tokens")
    for found, items in ((F1.doc_topics(df), [2, 3]), (F1.doc_top_terms(df).withColumnRenamed("top_terms", "topics"), [1, 2, 3])):
        plain = X.top_counted(F.concat(*[t if n == 1 else X.ngrams(t, n) for n in items]))
        assert rows(found, "id", "topics") == rows(df.select("id", plain.alias("topics")), "id", "topics")
        assert "lambda" not in found._jdf.queryExecution().optimizedPlan().toString()
