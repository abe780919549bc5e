"""Importance resampling against plain Python: words, n-grams, gains, scores and ranks."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from fleetlens.llm import importance as imp
from fleetlens.llm.common import load
from fleetlens_helpers import SF_SMOKE

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def features(text):
    ws = WORD.findall(lower(text))
    return len(ws), [" ".join(ws[i:i + n]) for n in (1, 2, 3) for i in range(len(ws) - n + 1)]


def bucket(f):
    return zlib.crc32(f.encode()) % 10000


def brute(docs, target):
    """doc_id -> (n_features, weight, score, rank) of every (doc_id, text), in input order."""
    s, t = Counter(), Counter()
    for _, x in docs:
        s.update(map(bucket, features(x)[1]))
    for x in target:
        t.update(map(bucket, features(x)[1]))
    S, T = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in range(10000)}
    rows = []
    for i, x in docs:
        n, f = features(x)
        w = sum(gain[bucket(y)] for y in f)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    fit = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], -1 if r[0] is None else r[0]))
    for k, r in enumerate(fit[:5 * len(fit) // 100]):
        r[4] = k + 1
    return [tuple(r[:5]) for r in rows]


def result(spark, docs, target):
    table = imp.gains(imp.bucket_counts(docs), imp.bucket_counts(target))
    rows = imp.stage(imp.scored(docs, table, ["doc_id"]), "test-scored")
    return [tuple(r) for r in imp.ranked(rows).select("doc_id", "n_features", "weight", "score", "rank").collect()]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple(-10 ** 18 if v is None else v for v in r))


def test_whole_table(spark):
    got = imp.op13_importance_resampling(spark, SF_SMOKE).collect()
    docs = [(r["doc_id"], r["text"]) for r in load(spark, SF_SMOKE, "documents").collect()]
    want = brute(docs, [r["text"] for r in load(spark, SF_SMOKE, "benchmark").collect()])
    assert ordered(map(tuple, got)) == ordered(want) and sum(r[4] is not None for r in got) > 5


def test_odd_texts_and_clashing_columns(spark):
    long_ = "Alpha beta " * 30000
    texts = [None, "", " \n", "Ä ÄB éé Z9z", "a\nb\x00c-d_e", "one two", long_, "İI ſs Σ", "x" * 200000, "two three　four"] + [f"w{i} the " * (9 + i % 4) for i in range(90)]
    docs = list(enumerate(texts)) + [(None, "n " * 25)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, score string, `N_words` int")
    target = spark.createDataFrame([(1, "the quick one two"), (2, None)], "item_id long, text string")
    assert ordered(result(spark, df, target)) == ordered(brute(docs, ["the quick one two", None]))


def test_repeated_rows_and_ties(spark):
    docs = [(5, "same words here " * 8)] * 300 + [(i, "other text now " * 8) for i in range(20)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    got = result(spark, df, spark.createDataFrame([("same words",)], "text string"))
    assert ordered(got) == ordered(brute(docs, ["same words"]))
    assert sorted(r[4] for r in got if r[4]) == list(range(1, 17))


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b c " * 10), (2, None)], "doc_id long, text string")
    assert result(spark, none, some) == []
    assert ordered(result(spark, some, none)) == ordered(brute([(1, "a b c " * 10), (2, None)], []))


@pytest.mark.parametrize("texts", [[], [b""], [b"", b"a"], [b"a", b"", b"b c"], [b"A b", b"c D e F"]])
def test_no_feature_crosses_texts(texts):
    f = imp.Features(texts)
    want = [features(t.decode())[1] for t in texts]
    assert f.count.tolist() == [len(w) for w in want]
    assert sorted(zip(f.doc.tolist(), f.bucket.tolist())) == sorted((i, bucket(x)) for i, w in enumerate(want) for x in w)


def test_resample_returns_the_drawn_texts(spark):
    df = load(spark, SF_SMOKE, "documents").withColumn("Score", imp.F.lit("s"))
    got = imp.resample(df, load(spark, SF_SMOKE, "benchmark"))
    assert got.columns == df.columns + ["draw_rank"]
    texts = {r["doc_id"]: r["text"] for r in df.collect()}
    ranks = {r["doc_id"]: r["rank"] for r in imp.op13_importance_resampling(spark, SF_SMOKE).collect() if r["rank"]}
    rows = got.collect()
    assert {r["doc_id"]: r["draw_rank"] for r in rows} == ranks and all(r["text"] == texts[r["doc_id"]] for r in rows)
