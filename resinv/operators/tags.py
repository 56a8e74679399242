"""Token tags folded to entities, and tag ids mapped to names."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENTITY = T.ArrayType(T.StructType([T.StructField("mention", T.StringType()), T.StructField("label", T.StringType()), T.StructField("prob", T.DoubleType())]))
MASKED = -100


def tag_names(ids: Column, labels: Column, names: list[str]) -> Column:
    """The names of predicted tag ids where the label is not masked."""
    table = F.array(*map(F.lit, names))
    kept = F.filter(F.zip_with(ids, labels, lambda i, t: F.when(t != MASKED, F.element_at(table, (i + 1).cast("int")))), lambda x: x.isNotNull())
    return kept


def fold(words: list[str], tags: list[str], probs: list[float]) -> list[tuple[str, str, float]]:
    """Entities of a B-/I-/O tagged sentence with the mean probability of their words.

    An I that follows nothing, or an entity of another label, begins an entity of its own.
    """
    out: list[tuple[list[str], str, list[float]]] = []
    before = ""
    for word, tag, prob in zip(words, tags, probs):
        label = tag[2:] if tag[:2] in ("B-", "I-") else ""
        if label and tag[0] == "I" and before == label:
            out[-1][0].append(word)
            out[-1][2].append(prob)
        elif label:
            out.append(([word], label, [prob]))
        before = label
    return [(" ".join(w).strip(".,;:()[] "), label, sum(p) / len(p)) for w, label, p in out]


@F.pandas_udf(ENTITY)
def fold_tags(words: pd.Series, tags: pd.Series, probs: pd.Series) -> pd.Series:
    return pd.Series([fold(list(w), list(t), list(p)) if w is not None and t is not None and p is not None else [] for w, t, p in zip(words, tags, probs)], dtype=object)
