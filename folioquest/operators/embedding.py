"""Texts to vectors through a provider, in batches on the executors."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioquest.functions import text
from folioquest.functions.providers import EmbeddingProvider

BATCH = 100


def embed(df: DataFrame, column: str, provider: EmbeddingProvider, out: str = "embedding", batch: int = BATCH) -> DataFrame:
    """Adds a vector for each text; a blank text is sent as one space."""

    @F.pandas_udf("array<float>")
    def vectors(texts: pd.Series) -> pd.Series:
        found: list = []
        values = texts.tolist()
        for lo in range(0, len(values), batch):
            found += list(provider.embed(values[lo : lo + batch]))
        return pd.Series(found, dtype=object)

    c: Column = F.col(column)
    return df.withColumn(out, vectors(F.when(F.coalesce(text.strip(c), F.lit("")) == "", " ").otherwise(c)))


def embed_query(query: str, provider: EmbeddingProvider) -> list[float]:
    return [float(x) for x in provider.embed([query if query.strip() else " "])[0]]
