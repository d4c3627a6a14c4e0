"""Every query: name to (Spark function, SQL or None)."""

from checks import ingest, texts, trade

ALL = {**ingest.QUERIES, **texts.QUERIES, **trade.QUERIES}
