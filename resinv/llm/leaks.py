"""Evaluation texts leaking into a corpus: CGK embedding and bit-sampling LSH over item-sized windows.

Every run of ``window`` words of an item and of a document is embedded by the CGK random walk: the walk has
three times as many steps as the window has words, writes the word it stands on, and moves on by a random bit
of that word.  Windows at a small edit distance give words that differ in few places, so a few sampled places
of the walk serve as an LSH key; independent repetitions bring the recall of windows within ``max_edits`` to
the target.  Windows without edits agree on every key, so they are found with certainty.  Each candidate is
then verified by the exact edit distance of the two windows.

Scale: one pass over the corpus, vectorised over all windows of a batch; only windows whose key occurs among
the items' keys leave the scan.  Where the items' keys pass their bound (``max_filter_keys``, checked), the
filter is left out and the keys are joined instead.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from resinv.operators.lineage import cut

_PAD = np.uint64(0x51ED270B7A14C3D5)
# Window starts of a text in one slice, so that a batch is small however long texts are; rows broadcast.
SLICE_STARTS, MAX_BROADCAST_ROWS = 500, 100_000


def word_hashes(text: Column) -> Column:
    """64-bit hashes of the words (lower-cased maximal runs of letters and digits), in order."""
    return F.transform(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"([\p{L}\p{N}]+)"), 1), lambda w: F.xxhash64(w))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def walk_keys(tokens: np.ndarray, starts: np.ndarray, window: int, places: int, seed: int) -> np.ndarray:
    """The LSH key of the window at each start, for one seeded walk and one seeded choice of places."""
    rng = np.random.default_rng(seed)
    steps = 3 * window
    salts = rng.integers(0, 2**63, steps, dtype=np.uint64)
    # places early in the walk are still inside the window for sure; later ones may stand behind its end
    chosen = set(np.sort(rng.permutation(np.arange(1, 2 * window))[:places]).tolist())
    at = np.zeros(len(starts), dtype=np.int64)
    keys = np.full(len(starts), np.uint64(seed + 1))
    with np.errstate(over="ignore"):
        for t in range(max(chosen) + 1):
            inside = at < window
            where = starts + np.minimum(at, window - 1)
            if t in chosen:
                keys = _mix(keys * np.uint64(0x9E3779B97F4A7C15) + np.where(inside, tokens[where], _PAD))
            bits = (_mix(tokens ^ salts[t]) >> np.uint64(63)).astype(np.int64)
            at += np.where(inside, bits[where], 0)
    return keys


def collision_rate(window: int, places: int, edits: int, trials: int = 400, seed: int = 11) -> float:
    """The share of random windows with so many random edits that keep their key, over seeded walks."""
    if edits == 0:
        return 1.0
    rng = np.random.default_rng(seed)
    hits = 0
    for trial in range(trials):
        x = rng.integers(0, 2**63, window + edits, dtype=np.uint64)
        y = list(x)
        for _ in range(edits):
            kind, at = rng.integers(0, 3), int(rng.integers(0, window))
            if kind == 0:
                y[at] = rng.integers(0, 2**63, dtype=np.uint64)
            elif kind == 1:
                del y[at]
            else:
                y.insert(at, rng.integers(0, 2**63, dtype=np.uint64))
        y = np.array((y + list(x))[: window + edits], dtype=np.uint64)
        zero = np.zeros(1, dtype=np.int64)
        hits += int(walk_keys(x, zero, window, places, trial)[0] == walk_keys(y, zero, window, places, trial)[0])
    return max(hits / trials, 1 / trials)


def repetitions_for(window: int, places: int, edits: int, recall: float) -> int:
    """How many independent keys bring windows with so many edits to the target recall."""
    p = collision_rate(window, places, edits)
    return 1 if p >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - p))


def _window_keys(df: DataFrame, id_col: str, text_col: str, window: int, places: int, repetitions: int, known: np.ndarray | None) -> DataFrame:
    """``(id, pos, key, words)`` for every window and repetition, or only those with a known key."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for low in range(0, len(pdf), 500):
                part = pdf.iloc[low : low + 500]
                lists = [np.asarray(t, dtype=np.int64) for t in part["tokens"]]
                sizes = np.array([len(t) for t in lists])
                if sizes.max(initial=0) < window:
                    continue
                flat = np.concatenate(lists).view(np.uint64)
                begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                count = np.maximum(sizes - window + 1, 0)
                doc = np.repeat(np.arange(len(sizes)), count)
                pos = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                starts = begin[doc] + pos
                ids, before = part["id"].to_numpy(), part["before"].to_numpy()
                for r in range(repetitions):
                    keys = walk_keys(flat, starts, window, places, 101 + r).view(np.int64)
                    keep = np.arange(len(keys))
                    if known is not None:
                        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                        keep = np.flatnonzero(known[at] == keys)
                    for some in np.array_split(keep, max(1, len(keep) // 50_000)):
                        words = flat[starts[some][:, None] + np.arange(window)].view(np.int64)
                        yield pd.DataFrame({"id": ids[doc[some]], "pos": (before[doc[some]] + pos[some]).astype(np.int32), "key": keys[some], "words": list(words)})

    tokens = df.select(F.col(id_col).cast("long").alias("id"), word_hashes(F.col(text_col)).alias("tokens")).filter(F.col("id").isNotNull() & (F.size("tokens") >= window))
    # every window starts in one slice and ends in it, as slices overlap by a window less one word
    tokens = tokens.select("id", "tokens", F.explode(F.sequence(F.lit(0), F.greatest(F.size("tokens") - window, F.lit(0)), F.lit(SLICE_STARTS))).alias("before"))
    tokens = tokens.select("id", "before", F.slice("tokens", F.col("before") + 1, F.lit(SLICE_STARTS + window - 1)).alias("tokens"))
    return tokens.mapInPandas(run, "id long, pos int, key long, words array<long>")


def _edits(a: np.ndarray, b: np.ndarray, limit: int) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y)))
        if min(row) > limit:
            return limit + 1
    return row[-1]


@F.pandas_udf(T.IntegerType())
def _edit_distance(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([0 if np.array_equal(x, y) else _edits(x, y, len(x)) for x, y in zip(a, b)], dtype="int32")


def leaked_windows(
    corpus: DataFrame,
    corpus_id: str,
    corpus_text: str,
    items: DataFrame,
    item_id: str,
    item_text: str,
    window: int = 12,
    max_edits: int = 0,
    recall: float = 0.95,
    places: int = 6,
    max_filter_keys: int = 4_000_000,
) -> DataFrame:
    """``(item_id, item_pos, doc_id, doc_pos, edits)``: windows of the corpus within ``max_edits`` words of a
    window of an item.  Positions count words from 0.

    Null ids and null, empty or shorter texts have no window; repeated rows give repeated windows, which count
    once; an empty corpus or no items give an empty result.  Texts are read whole.
    """
    repetitions = repetitions_for(window, places, max_edits, recall)
    item_keys = _window_keys(items, item_id, item_text, window, places, repetitions, None)
    distinct = cut(item_keys.groupBy("key").agg(F.count("*").alias("n")))
    bounded = distinct.limit(max_filter_keys + 1).count() <= max_filter_keys
    known = None
    if bounded:
        known = np.sort(distinct.select("key").toArrow()["key"].to_numpy().astype(np.int64))  # checked: at most max_filter_keys, 8 bytes each
        if len(known) == 0:
            known = np.array([np.iinfo(np.int64).max], dtype=np.int64)
    doc_keys = _window_keys(corpus, corpus_id, corpus_text, window, places, repetitions, known)
    i = item_keys.select(F.col("id").alias("item_id"), F.col("pos").alias("item_pos"), "key", F.col("words").alias("iw"))
    c = doc_keys.select(F.col("id").alias("doc_id"), F.col("pos").alias("doc_pos"), "key", F.col("words").alias("dw"))
    # windows of items, 150 bytes each; a key counts as often as items repeat it
    small = (distinct.agg(F.sum("n")).first()[0] or 0) <= MAX_BROADCAST_ROWS
    pairs = c.join(F.broadcast(i) if small else i.hint("merge"), "key")
    if max_edits == 0:
        return pairs.filter("iw = dw").select("item_id", "item_pos", "doc_id", "doc_pos", F.lit(0).alias("edits")).distinct()
    # every word of the one window that the other lacks costs an edit: most pairs end here, in the JVM
    pairs = pairs.filter(F.size(F.array_except("iw", "dw")) <= max_edits)
    once = pairs.groupBy("item_id", "item_pos", "doc_id", "doc_pos").agg(F.min(F.struct("iw", "dw")).alias("w")).select("item_id", "item_pos", "doc_id", "doc_pos", "w.*")
    return once.withColumn("edits", _edit_distance("iw", "dw")).filter(F.col("edits") <= max_edits).select("item_id", "item_pos", "doc_id", "doc_pos", "edits")
