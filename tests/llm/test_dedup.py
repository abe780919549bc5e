"""Near-duplicates, embeddings, repeated strings and components against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from fleetlens.llm import capfilters, graph, minhash, suffixes

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(n, seed, vocabulary=4000):
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


def changed(ws, k, seed):
    r = random.Random(seed)
    ws = list(ws)
    for _ in range(k):
        ws[r.randrange(len(ws))] = f"z{r.randrange(10 ** 6)}"
    return ws


def table(spark, texts, ids=None):
    ids = ids or list(range(len(texts)))
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in zip(ids, texts)], DOCS)


def weighted_classes(texts, tables, least=0.8):
    """Components of the links of weighted Jaccard similarity >= least, by plain dictionaries."""
    sets = []
    for t in texts:
        h, _, n = minhash.doc_shingles([t.lower().encode()])
        sets.append({int(x): float(w) * int(k) for x, w, k in zip(h, minhash.idf(tables, h), n)})
    top = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            a, b = sets[i], sets[j]
            low = sum(min(a[x], b[x]) for x in a.keys() & b.keys())
            high = sum(a.values()) + sum(b.values()) - low
            if texts[i] == texts[j] or high and low >= least * high - 1e-9:
                x, y = top[i], top[j]
                top = [x if z == y else z for z in top]
    return [min(j for j in range(len(texts)) if top[j] == top[i]) for i in range(len(texts))]


def test_minhash_classes_match_brute_force(spark):
    base = [words(200, s) for s in range(12)]
    texts = [" ".join(b) for b in base]
    for s, b in enumerate(base):
        texts += [" ".join(changed(b, k, 31 * s + k)) for k in (1, 2, 3, 8)]
    texts += [texts[3]] * 4 + ["", "", "  ", "one two", "one  two", "one two three"]
    docs = table(spark, texts)
    table_, rows = minhash.frequency_sketch(docs)
    want = weighted_classes(texts, minhash.idf_tables(table_, rows))
    got = {r["doc_id"]: r["class_id"] for r in minhash.classes(docs).collect()}
    assert [got[i] for i in range(len(texts))] == want
    kept = sorted(r["doc_id"] for r in minhash.keep_one(docs).collect())
    assert kept == sorted(set(want))


def test_minhash_dense_group_uses_all_passes(spark, monkeypatch):
    """A group whose members spread around the threshold, with chunks far smaller than the group."""
    monkeypatch.setattr(minhash, "CHUNK", 8)
    base = words(150, 5)
    texts = [" ".join(changed(base, k % 9, k)) for k in range(70)]
    docs = table(spark, texts)
    table_, rows = minhash.frequency_sketch(docs)
    want = weighted_classes(texts, minhash.idf_tables(table_, rows))
    got = {r["doc_id"]: r["class_id"] for r in minhash.classes(docs).collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_minhash_odd_rows(spark):
    long_text = " ".join(words(20000, 9))
    docs = spark.createDataFrame([(1, None, "a"), (None, "x y z", "b"), (None, "x y z", "b"), (7, long_text, None), (8, long_text + " q", "c"), (7, long_text, None)],
                                 "doc_id long, text string, tid string")
    got = sorted((r["doc_id"] is None, r["doc_id"], r["class_id"]) for r in minhash.classes(docs).collect() if r["doc_id"] is not None)
    assert got == [(False, 1, 1), (False, 7, 7), (False, 7, 7), (False, 8, 7)]
    kept = minhash.keep_one(docs)
    assert kept.columns == ["doc_id", "text", "tid"]
    assert sorted((r["doc_id"] or 0, r["tid"] or "") for r in kept.collect()) == [(0, "b"), (1, "a"), (7, "")]
    assert minhash.classes(docs.limit(0)).count() == 0 and minhash.keep_one(docs.limit(0)).count() == 0


def test_samples_estimate_weighted_similarity():
    base = words(400, 1)
    texts = [" ".join(base), " ".join(changed(base, 10, 2)), " ".join(changed(base, 30, 3))]
    h, doc, n = minhash.doc_shingles([t.encode() for t in texts])
    s = minhash.samples(h, n.astype(float), minhash._starts(doc))
    sets = [Counter({int(x): int(k) for x, k, d in zip(h, n, doc) if d == i}) for i in range(3)]
    for j in (1, 2):
        a, b = sets[0], sets[j]
        low = sum((a & b).values())
        true = low / (sum(a.values()) + sum(b.values()) - low)
        assert abs((s[0] == s[j]).mean() - true) < 0.2


def test_components_of_chains_and_stars(spark):
    r = random.Random(4)
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 80)] + [(r.randrange(3000, 3100), r.randrange(3000, 3100)) for _ in range(60)]
    got = {x["node"]: x["label"] for x in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    top = {x: x for e in edges for x in e}
    for _ in range(400):
        for u, v in edges:
            top[u] = top[v] = min(top[u], top[v])
    assert got == {x: y for x, y in top.items() if any(x in e and e[0] != e[1] for e in edges)}


def test_components_empty(spark):
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("block", [512, 4])
def test_embedding_links_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(capfilters, "BLOCK", block)
    rng = np.random.default_rng(3)
    rows = []
    for c in range(30):
        centre = rng.standard_normal(32)
        for k in range(8):
            rows.append((centre + rng.standard_normal(32) * 0.12 * (k % 4)).astype(np.float32))
    rows += [rows[0]] * 5
    data = [(i, [float(x) for x in v], i % 2 if i < 240 else 0) for i, v in enumerate(rows)]
    nan = float("nan")
    data += [(900, None, 1), (901, [0.0] * 32, 1), (902, [nan] * 32, 1), (903, [1.0, None], 1), (904, data[0][1], None), (905, [1.0, 2.0], 0),
             (906, [2.0, 4.0], 0), (907, [float("inf")] * 32, 0), (908, [], 0), (None, data[0][1], 0)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in capfilters.near_vectors(df).collect()}
    ok = [(i, np.asarray(np.float32(v), dtype=float), lab) for i, v, lab in data if v and lab is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    links = {k: set() for k in range(len(ok))}
    for a in range(len(ok)):
        for b in range(a):
            x, y = ok[a][1], ok[b][1]
            if ok[a][2] == ok[b][2] and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93:
                links[a].add(b)
                links[b].add(a)
    for a, (i, _, _) in enumerate(ok):
        seen, todo = {a}, [a]
        while todo:
            for z in links[todo.pop()] - seen:
                seen.add(z)
                todo.append(z)
        least = min(ok[z][0] for z in seen if ok[z][0] is not None)
        assert got[i][:2] == (len(links[a]), least)
        assert got[i][2] == (i == least)
    for i in (900, 901, 902, 903, 904, 907, 908):
        assert got[i] == (0, i, True)
    assert capfilters.near_vectors(df.limit(0)).count() == 0


def removed_by_hand(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[i:i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for t in raw:
        gone = np.zeros(len(t) + 1, dtype=bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = True
        gone = gone[:-1]
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone])).hexdigest()))
    return out


def repeat_texts():
    passage = " ".join(words(120, 77))
    texts = [" ".join(words(100 + i, i)) + " " + passage + " " + " ".join(words(80, 500 + i)) for i in range(12)]
    texts += [passage[:450] + "é" * 30, "ab" * 900, "x" * 3000, None, "", passage[:399], passage[:400], texts[0], texts[0][40:900]]
    texts += [" ".join(changed(words(200, 8), 3, k)) for k in range(8)]
    return texts


@pytest.mark.parametrize("split", [512, 3, 1])
def test_repeated_strings_match_brute_force(spark, monkeypatch, split):
    texts = repeat_texts()
    monkeypatch.setattr(suffixes.repeated_spans, "__defaults__", (400, 128, split))
    got = {r["doc_id"]: r for r in suffixes.deduplicated(table(spark, texts)).collect()}
    for i, want in enumerate(removed_by_hand(texts, 400)):
        r = got[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want, i


def test_repeated_strings_odd_rows(spark):
    t = " ".join(words(300, 6))
    docs = spark.createDataFrame([(None, t, 1), (None, t, 1), (3, t[:700], 2)], "doc_id long, text string, spans long")
    got = sorted((r["n_bytes"], r["n_removed"]) for r in suffixes.deduplicated(docs).collect())
    assert got == [(700, 700), (len(t), len(t)), (len(t), len(t))]
    assert suffixes.deduplicated(docs.limit(0)).count() == 0


def test_maximal_repeats_report_all_occurrences():
    a, b = words(40, 1), words(40, 2)
    core = " ".join(words(30, 3))
    strings = [(" ".join(a) + core + "1").encode(), (" ".join(b) + core + "2").encode(), ("q" + core + "1").encode()]
    got = {(n, tuple(sorted(where))) for n, where in suffixes.maximal_repeats(strings, 60)}
    found = {}
    for i, s in enumerate(strings):
        for o in range(len(s)):
            for n in range(60, len(s) - o + 1):
                found.setdefault(s[o:o + n], []).append((i, o))
    want = set()
    for s, where in found.items():
        if len(where) < 2:
            continue
        left = {strings[i][o - 1] if o else -1 - i for i, o in where}
        right = {strings[i][o + len(s)] if o + len(s) < len(strings[i]) else -1 - i for i, o in where}
        if len(left) > 1 and len(right) > 1:
            want.add((len(s), tuple(sorted(where))))
    assert got == want
