import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from resinv.llm.leaks import leaked_windows, repetitions_for, walk_keys
from resinv.llm.mixing import apportion, mix, token_counts
from resinv.llm.near import similar_sets, word_set
from resinv.llm.prose import SHARES, quality, statistics, units
from resinv.llm.ranking import beta_order, rank_aggregate
from resinv.llm.text import osa

WORDS = [f"w{i}" for i in range(400)]


def words(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


@settings(max_examples=300, deadline=None)
@given(st.text("abc", max_size=7), st.text("abc", max_size=7))
def test_osa_against_recursion(a, b):
    from functools import lru_cache

    @lru_cache(None)
    def d(i, j):
        if not i or not j:
            return i + j
        best = min(d(i - 1, j) + 1, d(i, j - 1) + 1, d(i - 1, j - 1) + (a[i - 1] != b[j - 1]))
        if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
            best = min(best, d(i - 2, j - 2) + 1)
        return best

    assert osa(a, b, 3) == min(d(len(a), len(b)), 4)


def near_texts(n=160, seed=1):
    r = random.Random(seed)
    out = []
    for i in range(n):
        if i % 3 and out:
            base = words(r.choice(out)[1])
            for _ in range(r.randint(0, 14)):
                base[r.randrange(len(base))] = r.choice(WORDS)
            r.shuffle(base)
        else:
            base = [r.choice(WORDS) for _ in range(r.randint(20, 60))]
        out.append((f"id{i:04d}", " ".join(base)))
    return out


def test_similar_sets_against_brute_force(spark):
    texts = near_texts()
    sets = {i: set(words(t)) for i, t in texts}
    truth = {(a, b) for a in sets for b in sets if a < b and 10 * len(sets[a] & sets[b]) > 7 * len(sets[a] | sets[b])}
    rows = [*texts, texts[0], (None, texts[1][1]), ("", "x y"), ("empty1", ""), ("empty2", None)]
    df = spark.createDataFrame(rows, "id string, t string").withColumn("rep", F.lit(1)).withColumn("key", F.lit(1)).withColumn("words", word_set("t"))
    links, members = similar_sets(df, "id", "words")
    m = {}
    for r in members.collect():
        m.setdefault(r.rep, []).append(r.id)
    got = {tuple(sorted((x, y))) for r in links.collect() for x in m[r.a] for y in m[r.b]} | {(x, y) for ids in m.values() for x in ids for y in ids if x < y}
    assert got == truth and len(truth) > 50
    nothing, none = similar_sets(df.limit(0), "id", "words")
    assert nothing.count() == none.count() == 0


def test_similar_sets_in_a_hot_group(spark):
    """300 texts of one page that differ by one word each: every pair is found, though all share their keys."""
    base = [f"h{i}" for i in range(60)]
    texts = [(f"{i:03d}", " ".join(base[: i % 60] + [f"own{i}"] + base[i % 60 + 1 :])) for i in range(300)]
    links, members = similar_sets(spark.createDataFrame(texts, "id string, t string").withColumn("words", word_set("t")), "id", "words")
    assert members.count() == 300 and links.select("a", "b").distinct().count() == links.count() == 300 * 299 // 2


@pytest.mark.parametrize("share", [0.05, 0.3, 0.6])
def test_junk_of_any_share_is_found(spark, share):
    good, _ = corpus()
    prose = [(i, t, "en") for i, t in good[:200]]
    n = int(share * len(prose) / (1 - share))
    lists = [(5000 + k, "\n".join(f"- {w} {w[0].upper()}{k}{i}" for i, w in enumerate(["genes", "maps", "cells"] * 9)), "en") for k in range(n)]
    got = {r.doc_id for r in quality(spark.createDataFrame(prose + lists, "doc_id long, text string, lang string")).filter("not prose").collect()}
    assert got == {i for i, *_ in lists}


def test_word_set_of_null_and_long_text(spark):
    df = spark.createDataFrame([(None,), ("",), ("B b a1_Ä " * 20_000,)], "t string")
    assert [r[0] for r in df.select(word_set("t")).collect()] == [[], [], ["a1", "b", "ä"]]


def test_equal_windows_share_all_keys():
    r = np.random.default_rng(1)
    x = r.integers(0, 2**63, 12, dtype=np.uint64)
    flat = np.concatenate([r.integers(0, 2**63, 5, dtype=np.uint64), x, x])
    for seed in range(20):
        k = walk_keys(flat, np.array([5, 17]), 12, 6, seed)
        assert k[0] == k[1]


def test_repetitions_grow_with_edits():
    assert repetitions_for(12, 6, 0, 0.95) == 1 < repetitions_for(12, 6, 1, 0.95) < repetitions_for(12, 6, 2, 0.95)


def leak_tables(spark, seed=2):
    r = random.Random(seed)
    items = [(i, " ".join(r.choice(WORDS) for _ in range(r.randint(14, 40)))) for i in range(30)]
    docs = []
    for i in range(120):
        t = [r.choice(WORDS) for _ in range(r.randint(5, 80))]
        if i % 2:
            w = words(r.choice(items)[1])
            n = r.randint(9, len(w))
            at = r.randint(0, len(w) - n)
            piece = w[at : at + n]
            if i % 6 == 1:
                piece[len(piece) // 2] = "changed"
            t[2:2] = [p.upper() if r.random() < 0.3 else p for p in piece]
        docs.append((i, ", ".join(t) if i % 4 else "\n".join(t)))
    return items, docs


def test_leaks_against_brute_force(spark):
    items, docs = leak_tables(spark)
    grams = lambda t: {tuple(words(t)[i : i + 12]) for i in range(len(words(t)) - 11)}
    truth = {(i, d) for i, a in items for d, b in docs if grams(a) & grams(b)}
    di = spark.createDataFrame([*items, (None, "x"), (99, None), (98, "")], "item_id long, text string").withColumn("key", F.lit(1))
    dd = spark.createDataFrame([*docs, docs[1], (None, "x"), (999, None), (998, "")], "doc_id long, text string").withColumn("pos", F.lit(1))
    found = leaked_windows(dd, "doc_id", "text", di, "item_id", "text")
    assert {(r.item_id, r.doc_id) for r in found.collect()} == truth and len(truth) > 20
    joined = leaked_windows(dd, "doc_id", "text", di, "item_id", "text", max_filter_keys=0)
    assert {(r.item_id, r.doc_id) for r in joined.collect()} == truth
    assert leaked_windows(dd.limit(0), "doc_id", "text", di, "item_id", "text").count() == 0
    assert leaked_windows(dd, "doc_id", "text", di.limit(0), "item_id", "text").count() == 0


def test_many_items_of_one_text_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr("resinv.llm.leaks.MAX_BROADCAST_ROWS", 100)
    text = " ".join(WORDS[:20])  # 9 windows
    di, dd = spark.range(40).select(F.col("id").alias("item_id"), F.lit(text).alias("text")), spark.range(3).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"))
    found = leaked_windows(dd, "doc_id", "text", di, "item_id", "text")
    assert "strategy=broadcast" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.count() == 40 * 3 * 9
    few = leaked_windows(dd, "doc_id", "text", di.limit(2), "item_id", "text")
    assert "strategy=broadcast" in few._jdf.queryExecution().optimizedPlan().toString() and few.count() == 2 * 3 * 9


def test_windows_of_a_long_text_are_read_in_slices(spark):
    from resinv.llm import leaks

    r = random.Random(4)
    long = [r.choice(WORDS) for _ in range(2600)]
    ends = [(0, 0), (1, 480), (2, 489), (3, 499), (4, 500), (5, 1000), (6, len(long) - 20), (7, len(long) - 12)]
    di = spark.createDataFrame([(i, " ".join(long[at : at + 20])) for i, at in ends], "item_id long, text string")
    dd = spark.createDataFrame([(1, " ".join(long)), (2, " ".join(long[:12])), (3, " ".join(long[:511])), (4, " ".join(long[:512]))], "doc_id long, text string")
    got = sorted((x.item_id, x.item_pos, x.doc_id, x.doc_pos) for x in leaked_windows(dd, "doc_id", "text", di, "item_id", "text").collect())
    sizes = {1: 2600, 2: 12, 3: 511, 4: 512}
    assert got == sorted((i, p, d, at + p) for i, at in ends for p in range(min(20, len(long) - at) - 11) for d, n in sizes.items() if at + p + 12 <= n)
    tokens = leaks._window_keys(dd, "doc_id", "text", 12, 6, 1, None)
    assert "sequence(0" in tokens._jdf.queryExecution().optimizedPlan().toString()


def test_leaks_with_edits_reach_the_recall(spark):
    items, docs = leak_tables(spark, 5)

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, row = row, [i]
            for j, y in enumerate(b, 1):
                row.append(min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y)))
        return row[-1]

    wins = lambda t: [words(t)[i : i + 12] for i in range(len(words(t)) - 11)]
    index = {}
    for i, t in items:
        for p, w in enumerate(wins(t)):
            for k in range(12):
                index.setdefault((k, tuple(w[:k] + w[k + 1 :])), set()).add((i, p))
    truth = set()
    for d, t in docs:
        for q, w in enumerate(wins(t)):
            for k in range(12):
                for i, p in index.get((k, tuple(w[:k] + w[k + 1 :])), ()):
                    truth.add((i, p, d, q))
    di, dd = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.item_id, r.item_pos, r.doc_id, r.doc_pos): r.edits for r in leaked_windows(dd, "doc_id", "text", di, "item_id", "text", max_edits=1).collect()}
    assert all(e <= 1 for e in got.values())
    assert len(truth & set(got)) >= 0.93 * len(truth) and len(truth) > 100


def test_beta_order_against_simulation(spark):
    r = np.random.default_rng(0)
    u = np.sort(r.random((200_000, 4)), axis=1)
    for n, k, x in ((4, 1, 0.2), (4, 2, 0.3), (4, 4, 0.9)):
        got = spark.range(1).select(beta_order(F.lit(x), k, n)).head()[0]
        assert got == pytest.approx((u[:, k - 1] <= x).mean(), abs=0.01)


def test_rank_aggregate_nulls_ties_and_scales(spark):
    data = [(f"p{i}", float(i), 1000.0 * i, 0.001 * i if i % 2 else None) for i in range(1, 41)] + [("none", None, None, None), ("nan", float("nan"), None, None)]
    df = spark.createDataFrame(data, "id string, a double, b double, c double").withColumn("rank", F.lit(0)).withColumn("key", F.lit(0)).withColumn("part", F.lit(0))
    got = {r.id: r for r in rank_aggregate(df, "id", ["a", "b", "c"]).collect()}
    assert len(got) == 42 and got["p39"].rank == 1 and got["none"].rho == 1.0 and got["none"].scored == 0 and got["nan"].scored == 0
    scaled = {r.id: r.rank for r in rank_aggregate(df.withColumn("b", F.col("b") * 1e9 - 5), "id", ["a", "b", "c"]).collect()}
    assert scaled == {k: r.rank for k, r in got.items()}
    tied = spark.createDataFrame([("x", 1.0), ("y", 1.0), ("z", 1.0)], "id string, a double")
    assert {r.rank for r in rank_aggregate(tied, "id", ["a"]).collect()} == {1}
    assert rank_aggregate(tied.limit(0), "id", ["a"]).count() == 0


def test_apportion_is_sainte_lague():
    assert apportion({"a": 53, "b": 24, "c": 23}, 7) == {"a": 3, "b": 2, "c": 2}
    assert sum(apportion({"a": 0.3, "b": 0.7, "c": 0.0}, 101).values()) == 101 and apportion({"a": 0.3, "c": 0.0}, 5) == {"a": 5, "c": 0}
    assert apportion({}, 5) == {}


def mix_tables(spark):
    docs = [(i, "big" if i % 3 else "small", 10 + i % 7) for i in range(3000)] + [(3000 + i, "tiny", 20) for i in range(20)] + [(9001, None, 5), (9002, "other", 5), (9003, "big", 0), (None, "big", 5), (0, "small", 10)]
    targets = [("big", 0.5, 1), ("small", 0.3, 2), ("tiny", 0.2, 4), ("absent", 0.1, 3), (None, 0.5, 1), ("zero", 0.0, 1)]
    return spark.createDataFrame(docs, "doc_id long, source string, tokens long").withColumn("share", F.lit(1)), spark.createDataFrame(targets, "source string, target_share double, max_repeats int")


def test_mix_reaches_the_shares_within_the_caps(spark):
    docs, targets = mix_tables(spark)
    mixture, report = mix(docs, "doc_id", "source", "tokens", targets, shards=4, blocks=200)
    r = {x.source: x for x in report.collect()}
    assert abs(r["big"].share - 0.5) < 0.02 and abs(r["small"].share - 0.3) < 0.02 and abs(r["tiny"].share - 0.2) < 0.02 and r["absent"].used == 0
    per = mixture.groupBy("source", "id").agg(F.sum("times").alias("t")).groupBy("source").agg(F.max("t").alias("t"), F.min("t").alias("least")).collect()
    caps = {"big": 1, "small": 2, "tiny": 4}
    assert all(p.t <= caps[p.source] for p in per)
    shards = {(s.source, s.shard): s.n for s in mixture.groupBy("source", "shard").agg(F.sum(F.col("tokens") * F.col("times")).alias("n")).collect()}
    big = [n for (s, _), n in shards.items() if s == "big"]
    assert len(big) == 4 and max(big) < 1.15 * min(big)
    again = mix(docs.repartition(7), "doc_id", "source", "tokens", targets, shards=4, blocks=200)[0]
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, mixture.collect()))


def test_mix_of_nothing(spark):
    docs, targets = mix_tables(spark)
    assert mix(docs.limit(0), "doc_id", "source", "tokens", targets)[0].count() == 0
    assert mix(docs, "doc_id", "source", "tokens", targets.limit(0))[0].count() == 0


def test_token_counts(spark):
    df = spark.createDataFrame([(1, "Hello world, hello"), (2, ""), (3, None), (4, "a" * 100_000)], "i long, text string").withColumn("tokens_", F.lit(1))
    got = {r.i: r.tokens for r in token_counts(df, "text").collect()}
    assert got[1] == 4 and got[2] == got[3] == 0 and got[4] > 1000


PROSE = "The portal was built by two groups. It holds many records of the genes, and users can search all of them by name. "


def corpus():
    r = random.Random(4)
    nouns = ["genes", "maps", "cells", "plants", "records", "lists", "groups", "users"]
    sentence = lambda: f"The {r.choice(nouns)} of the {r.choice(nouns)} were found in {r.randint(2, 900)} of the {r.choice(nouns)}, and the {r.choice(nouns)} can be seen by all {r.choice(nouns)}."
    docs = [(i, " ".join(sentence() for _ in range(r.randint(3, 9)))) for i in range(300)]
    wrapped = "\n".join(re.findall(r".{1,60}(?:\s|$)", docs[0][1]))
    good = [(1000, docs[1][1].upper()), (1001, docs[2][1].lower().replace(".", "").replace(",", "")), (1002, wrapped), (1003, "Results\n" + docs[3][1] + "\n- genes\n- maps")]
    shuffled = words(" ".join(d[1] for d in docs[4:7]))
    r.shuffle(shuffled)
    bad = [
        (2000, "\n".join(f"- {r.choice(nouns)} {r.choice('ABC')}{i}" for i in range(30))), (2001, "\n".join(f"{r.choice(nouns)}\t{r.randint(1, 99)}\t{r.randint(1, 99)}" for _ in range(30))),
        (2002, " ".join(shuffled)), (2003, "Xq3/zP0+" * 60), (2004, sentence() * 30), (2005, "\n".join(f"{n}: {i}" for i, n in enumerate(nouns * 3))), (2006, "#$% ^&* " * 40), (2007, docs[8][1][:80] + "\n" + "\n".join(f"* {n} {i}" for i, n in enumerate(nouns * 4))),
    ]
    return docs + good, bad


def test_quality_tells_prose_from_the_rest(spark):
    good, bad = corpus()
    rows = [(i, t, "en") for i, t in good + bad] + [(3000, None, None), (3001, "", "en"), (3002, "   \n ", ""), (1000, good[-4][1], "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("words", F.lit("clash"))
    out = quality(df)
    got = {r.doc_id: r for r in out.collect()}
    assert out.count() == len(rows) and {i for i, r in got.items() if not r.prose} == {i for i, _ in bad}
    assert got[3000].words == 0 and got[3000].lang == "und" and 0 <= got[5].words_percentile <= 1
    assert quality(df.limit(0)).count() == 0


def test_junk_is_flagged_where_it_is_frequent_and_in_small_languages(spark):
    good, bad = corpus()
    lists = [(5000 + k, "\n".join(f"- {w} {w[0].upper()}{k}{i}" for i, w in enumerate(["genes", "maps", "cells"] * 9))) for k in range(200)]
    rows = [(i, t, "en") for i, t in good + bad + lists]  # two fifths of the language
    rows += [(6000, lists[0][1], "fi"), (6001, "Tietokanta on avoin kaikille. Siihen kuuluu monta kuvaa, ja haku on helppo.", "fi")]
    got = {r.doc_id for r in quality(spark.createDataFrame(rows, "doc_id long, text string, lang string")).filter("not prose").collect()}
    assert got == {i for i, _ in bad + lists} | {6000}


def test_copied_junk_teaches_no_words(spark):
    good, bad = corpus()
    r = random.Random(6)
    salad = " ".join("".join(r.choice("bcdfgklmnprst") + r.choice("aeiou") for _ in range(3)) for _ in range(80))
    rows = [(i, t, "en") for i, t in good + bad] + [(7000 + k, salad if k % 2 else salad.upper() + ".", "en") for k in range(150)] + [(7500 + k, salad, None) for k in range(5)]
    got = {x.doc_id for x in quality(spark.createDataFrame(rows, "doc_id long, text string, lang string")).filter("not prose").collect()}
    assert got == {i for i, *_ in rows if i >= 7000} | {i for i, _ in bad}


def test_words_are_those_of_the_own_language(spark):
    good, _ = corpus()
    swap = {w: w[::-1] + "o" for _, t in good for w in words(t)}
    other = [(i, re.sub(r"[^\W\d_]+", lambda m: swap[m[0].lower()], t)) for i, t in good if i < 1000]
    english = [(10_000 * k + i, f"{t} {t2}", "en") for k in range(3) for (i, t), (_, t2) in zip(good[:300], good[k + 1 : 300])]
    theirs = [(100_000 + 10_000 * k + i, f"{t} {t2}", "xx") for k in range(3) for (i, t), (_, t2) in zip(other, other[k + 1 :])]
    wrong = (999_999, english[0][1], "xx")
    df = spark.createDataFrame([*english, *theirs, wrong], "doc_id long, text string, lang string")
    assert [x.doc_id for x in quality(df).filter("alien_words > 0.5").collect()] == [999_999]


def test_statistics_of_long_and_odd_texts():
    s = statistics(PROSE * 3000, set(words(PROSE)), set(zip(words(PROSE * 2), words(PROSE * 2)[1:])))
    assert s["repeats"] > 0.9 and s["words"] == 3000 * len(words(PROSE))
    assert statistics(None, set(), set())["not_prose"] == 0.0
    assert all(0 <= statistics("\x00� \n\n,,,", set(), set())[k] <= 1 for k in SHARES)


def test_units_join_wrapped_lines():
    text = "This sentence goes on over the end of\nthe line and ends here. Another one\nis also wrapped."
    assert [s for _, s in units(text)] == [""]
    assert [s for _, s in units("- one\n- two\n\nA | B | C\nD | E | F\nG | H | I")] == ["list_items", "list_items", "table_rows", "table_rows", "table_rows"]


def test_no_texts_or_keys_without_a_bound_are_broadcast(spark, monkeypatch, tmp_path):
    # the planner takes an array for one element, so draws and tokens pass for small
    from resinv.llm import near, queries

    plans, cut = [], near.cut

    def seen(df):
        plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return cut(df)

    monkeypatch.setattr(near, "cut", seen)
    monkeypatch.setattr(queries, "cut", seen)
    monkeypatch.setattr(near, "MOST_BROADCAST", 0)  # as if there were too many keys
    words = [f"word{i}" for i in range(40)]
    rows = [(str(i), " ".join(words[: 40 - i]), None) for i in range(4)] + [("9", " ".join(words), None), ("10", "quite other words", "")]
    spark.createDataFrame(rows, "id string, title string, abstract string").write.parquet(f"{tmp_path}/papers_metadata.parquet")
    out = queries.QUERIES["p5_found"](spark, str(tmp_path))
    plans.append(out._jdf.queryExecution().sparkPlan().toString())
    assert out.count() == 10
    assert not [p[:300] for p in plans if "Broadcast" in p]
