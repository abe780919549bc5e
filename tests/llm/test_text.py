"""Mixing, packing, secrets, quality, extraction, fingerprints and the pipeline."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fleetlens.llm import extraction, fingerprint, mixing, packing, quality, secret_scan
from fleetlens.llm.textvec import Block, shingles

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(n, seed, upper=False):
    r = random.Random(seed)
    ws = ["".join(r.choice(["the", "an", "er", "ti", "on", "é", "ber", "los"]) for _ in range(r.randrange(1, 4))) for _ in range(n)]
    return " ".join(w.upper() + "!!" if upper else w + ("." if r.random() < 0.1 else "") for w in ws)


@pytest.fixture(scope="module")
def docs(spark):
    r = random.Random(3)
    rows = [(i, prose(r.choice([3, 40, 200, 900]), i), "en", r.choice(["a", "b", "b", "b", "é", "c", None]), 0) for i in range(160)]
    rows += [(500, None, None, None, None), (501, "", "en", "a", 0), (502, "  \n\t ", "en", "a", 0), (None, "lost words", "en", "b", 1),
             (7, "again and again", "en", "b", 2), (7, "again and again", "en", "b", 2), (503, prose(30000, 99), "en", "zz", 5)]
    return spark.createDataFrame(rows, DOCS).withColumn("size", F.lit("clash")).withColumn("target", F.lit(1))


# ---------------------------------------------------------------- mixing
def test_mix_matches_sql_and_contract(spark, docs):
    sizes = mixing.sized(docs)
    got = mixing.mixed(sizes, mixing.mix_plan(sizes)).toPandas()
    documents = docs.select("doc_id", "text", "source").toPandas().astype({"doc_id": "Int64"})  # noqa: F841  (read by DuckDB)
    want = duckdb.sql(mixing.SQL).df()
    cols = ["doc_id", "size", "source_size", "target", "taken"]
    key = lambda d: d[cols].astype(float).sort_values(cols).round(6).to_numpy()
    assert np.allclose(key(got), key(want), equal_nan=True)
    assert (got["taken"] <= 2 * got["size"]).all()
    one = got.assign(source=0).groupby(["source_size", "target"]).agg(taken=("taken", "sum"), most=("size", "max"))
    for (_, target), r in one.iterrows():
        assert abs(r["taken"] - target) <= max(r["most"], 6)
    assert math.isclose(sum(t for _, t in {(s, t) for s, t in zip(got["source_size"], got["target"])}), 1.5 * got["size"].sum(), rel_tol=1e-9)


def test_mix_repeats_rows_and_keeps_columns(spark, docs):
    sizes = mixing.sized(docs)
    want = Counter({r["doc_id"]: 0 for r in docs.collect()})
    for r in mixing.mixed(sizes, mixing.mix_plan(sizes)).where("size > 0").collect():
        want[r["doc_id"]] += r["taken"] // r["size"]
    out = mixing.apply_mix(docs)
    assert out.columns == docs.columns
    got = Counter(r["doc_id"] for r in out.where("length(trim(text)) > 0").collect() if r["text"].strip())
    assert all(got[k] == n for k, n in want.items())
    assert mixing.apply_mix(docs.limit(0)).count() == 0


# ---------------------------------------------------------------- packing
def test_packing_is_valid_and_tight(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    out = packing.pack_documents(docs, with_ids=True).toPandas()
    tok = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    want = Counter()
    for r in docs.collect():
        ids = tok.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        for k, (s, n) in enumerate(packing.cut(len(ids), 1024)):
            want[(r["doc_id"], k, s, n, zlib.crc32(np.array(ids[s:s + n], dtype="<u4").tobytes()))] += 1
    rows = out.astype(object).where(out.notna(), None)
    assert Counter(zip(rows["doc_id"], rows["piece"], rows["start"], rows["length"], rows["ids_crc32"])) == want
    for _, g in out.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g["offset"].tolist() == [0, *np.cumsum(g["length"])[:-1]] and g["length"].sum() <= 1024
    least = math.ceil(out["length"].sum() / 1024)
    assert out["sequence_id"].nunique() <= least * 1.05 + 3
    assert packing.pack_documents(docs.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plan_places_every_piece_once(seed):
    r = random.Random(seed)
    counts = Counter(r.choice([r.randrange(1, 1025), 300, 700, r.randrange(400, 600)]) for _ in range(r.choice([1, 50, 5000])))
    plan = packing.plan(dict(counts))
    for n, g in plan.groupby("length"):
        g = g.sort_values("first")
        assert g["first"].tolist() == [0, *np.cumsum(g["count"])[:-1]] and g["count"].sum() == counts[n]
    bins = {}
    for n, _, count, sequence, offset in plan.itertuples(index=False):
        for s in range(sequence, sequence + count):
            bins.setdefault(s, []).append((offset, n))
    for held in bins.values():
        at = 0
        for offset, n in sorted(held):
            assert offset == at
            at += n
        assert at <= 1024
    least = sum(n * c for n, c in counts.items()) / 1024
    assert len(bins) <= max(least * 1.25 + 2, sum(c for n, c in counts.items() if n > 512) * 1.02 + least * 0.1 + 2)


@pytest.mark.parametrize("text", ["", " ", "a  b", " a b ", "x\n\ny z", "x \n y", "don't we'll", "a b c", "tab\tb  c\n", "<|endoftext|> a<|endoftext|>",
                                  "é.ü,\nÄ!! ###", "a \x1c b", "w" * 5000 + " " + "1 2 3 " * 50])
def test_chunked_ids_equal_the_tokenizer(text):
    import public_tokenizers as P
    from tokenizers import Tokenizer
    want = Tokenizer.from_file(P.path(packing.VOCABULARY)).encode(text, add_special_tokens=False).ids
    for ranks in (None, P.path(packing.RANKS)):
        got = packing.token_bytes(text, packing.Encoder(P.path(packing.VOCABULARY), ranks))
        assert np.frombuffer(got, dtype="<u4").tolist() == want


@pytest.mark.parametrize("text", ["\n".join(f"QUJD{i:x}+/=" for i in range(5000)), "a\nb\n\nc\nd\n", "\n".join(["é,1!"] * 3000) + "\n \nx\ny."])
def test_many_lines_without_spaces(text):
    test_chunked_ids_equal_the_tokenizer(text)


def best_fit_decreasing(counts, capacity):
    bins = []
    free = Counter()
    for n in sorted(counts.elements(), reverse=True):
        room = min((f for f in free if f >= n and free[f]), default=None)
        if room is None:
            bins.append(1)
            room = capacity
        else:
            free[room] -= 1
        free[room - n] += 1
    return len(bins)


@pytest.mark.parametrize("kind", ["log-normal", "uniform", "few", "middle", "normal", "small"])
def test_plan_is_never_worse_than_best_fit_decreasing(kind):
    r = np.random.default_rng(3)
    lengths = {"log-normal": r.lognormal(5.5, 1, 4000), "uniform": r.integers(1, 1025, 4000), "few": r.choice([300, 341, 512, 700, 1024], 4000),
               "middle": r.integers(200, 701, 4000), "normal": r.normal(300, 60, 4000), "small": r.integers(1, 40, 4000)}[kind]
    counts = Counter(np.clip(lengths.astype(int), 1, 1024).tolist())
    slots = packing.plan(dict(counts))
    held = Counter()
    for row in slots.itertuples():
        for k in range(row.count):
            held[row.sequence + k] += row.length
    assert max(held.values()) <= 1024 and sum(held.values()) == sum(k * v for k, v in counts.items())
    assert Counter({k: int(v) for k, v in slots.groupby("length")["count"].sum().items()}) == counts
    plain = best_fit_decreasing(counts, 1024)
    assert len(held) <= plain
    if kind in ("middle", "normal"):
        assert len(held) < plain  # here the programme's configurations gain


def test_plan_solves_the_programme_also_where_best_fit_is_near_the_bound(monkeypatch):
    solved, whole = [], packing.linear_grouping
    monkeypatch.setattr(packing, "linear_grouping", lambda *a: solved.append(whole(*a)) or solved[-1])
    packing.plan({600: 1000, 424: 1000, 200: 5000, 24: 2})  # best fit alone is within a thousandth of the bound
    assert solved and sum(b[1] for b in solved[0]) > 1000


# ---------------------------------------------------------------- secrets
def spans_by_hand(text):
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m.group(2)) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(out)


SECRETS = ["é password = 'hunter2x' and TOKEN:abc", "Api_Key=AKIA" + "A1B2" * 5 + " AKIASHORT", "deadbeef" * 3 + " " + "0" * 23, None, "",
           "token=secret=abcdefgh token=token:abcdefgh", "apikey : \"" + "9f" * 20 + "\"", "x" * 50000 + " passwd=123456"]


def test_secret_base_spans(spark):
    ordinary = [f"{prose(5, i)} somelongerword{i % 7}withletters 4{i:015d}" for i in range(60)]
    hexes = [f"token = \"{hashlib.sha1(str(i).encode()).hexdigest()}\" ok" for i in range(60)]
    texts = SECRETS + ordinary + hexes + [f"loose {hashlib.md5(b'q').hexdigest()[:18]} value"]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, spans int")
    model = secret_scan.fit(df)
    for r in secret_scan.scan(df, model).collect():
        text = texts[r["doc_id"]] or ""
        want = spans_by_hand(text)
        joined = ",".join(f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e in want)
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == i for _, k, _ in want) for i in range(3)]
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) <= set(r["spans"].split(",")) | {""}
        if r["doc_id"] == len(texts) - 1:
            assert r["spans"] == "format:6:24"  # the learned format, shorter than any base match
        elif len(SECRETS) <= r["doc_id"] < len(SECRETS) + 60:
            assert r["spans"] == ""
    red = {r["doc_id"]: r["text"] for r in secret_scan.redact(df, model).collect()}
    assert red[0] == "é [SECRET]' and TOKEN:abc" and red[3] is None and red[8] == texts[8]
    empty = df.limit(0)
    assert secret_scan.scan(empty, secret_scan.fit(empty)).count() == 0


def credential(i, n=28):
    h = hashlib.sha256(str(i).encode()).hexdigest()
    return "ky" + "".join(c.upper() if k % 3 else c for k, c in enumerate(h))[:n]


def word_tokens(n):
    r = random.Random(11)
    return ["_".join("".join(r.choice(["lor", "em", "ip", "sum", "dol", "or"]) for _ in range(4)) for _ in range(2)) for _ in range(n)]


@pytest.mark.parametrize("share,same", [(0.05, False), (0.05, True), (0.3, False)])
def test_unlabelled_credentials_are_found_whatever_their_share(share, same):
    make = (lambda i: f"ky{i:04d}" + "QZ" * 12) if same else credential
    words = word_tokens(600)
    loose = [make(5000 + i) for i in range(int(600 * share))]
    model = secret_scan.Model({"assign": [make(i) for i in range(300)], "access": [], "hex": []}, [*words, *loose])
    assert np.mean([model.is_credential(t) for t in loose]) > 0.95
    assert np.mean([model.is_credential(t) for t in words]) < 0.01


def test_parts_beside_base_spans_are_scored():
    hexes, words = ["0123456789abcdef01234567", "f00dfacef00dfacef00dface"], word_tokens(300)
    model = secret_scan.Model({"assign": [credential(i, 24) + h + "Zq9" for i in range(200) for h in hexes], "access": [], "hex": []}, words)
    token = credential(9000, 24) + hexes[0] + "Zq9"
    text = f"see {token}, {words[0]}={hexes[1]} and {words[1]}"
    assert secret_scan.mask(text, model.spans(text)) == f"see [SECRET], {words[0]}=[SECRET] and {words[1]}"
    assert [text[s:e] for s, e in secret_scan.other_tokens(text, secret_scan.base_spans(text))][-2:] == [words[0] + "=", words[1]]


def test_automaton_likelihoods():
    a = secret_scan.Automaton(["0a" * 4 + "U"] * 50 + ["0a" * 5 + "U"] * 50)
    assert a.log_likelihood("0a0a0a0aU") > a.log_likelihood("UUUU")
    total = sum(math.exp(a.log_likelihood("0a" * k + "U")) for k in range(40))
    assert 0.9 < total <= 1.0001


# ---------------------------------------------------------------- quality
def test_quality_learns_and_keeps_clean_documents(spark):
    rows, labels = [], []
    for i in range(700):
        bad = i % 6 == 0
        text = prose(120, i, upper=True) if bad and i % 4 else " ".join(["again"] * 80) if bad else prose(120, i)
        rows.append((i, text, "en", f"src{i % 9}", len(text)))
        if i % 2 == 0:
            labels.append((i, 0 if bad else 1, 0))
    rows += [(9000, None, None, None, None), (9001, "", None, None, -1), (9002, prose(30000, 4), "xx", "y", 10), (3, prose(120, 3), "en", "src3", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    tags = spark.createDataFrame(labels + [(2, None, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    kept = quality.keep_good(docs.withColumn("quality_scores", F.lit(1)), tags)
    assert kept.columns == [*docs.columns, "quality_scores"]
    ids = {r["doc_id"] for r in kept.collect()}
    odd = [i for i in range(700) if i % 2]
    assert np.mean([(i in ids) == (i % 6 != 0) for i in odd]) > 0.97
    assert all(i in ids for i in odd if i % 6)
    assert quality.keep_good(docs, tags.limit(0)).count() == len(rows)  # nothing known: all stay
    assert quality.keep_good(docs, tags.where("quality = 1")).count() == len(rows)
    assert quality.keep_good(docs.limit(0), tags).count() == 0


def views_of(n, seed, clean=0.9):
    """Text and page views of n documents and their classes; the page tells the class for a share ``clean`` of them."""
    r = np.random.default_rng(seed)
    y = (r.random(n) < 0.7).astype(float)
    text = r.normal(size=(n, quality.N_TEXT))
    text[:, :5] += (y * 2 - 1)[:, None] * 0.9
    source = np.where(r.random(n) < clean, np.where(y > 0, r.integers(0, 10, n), r.integers(10, 20, n)), r.integers(0, 20, n))
    places = np.column_stack([np.zeros(n, int), 8 + source, np.full(n, 45)])
    page = np.zeros((n, quality.N_PAGE))
    page[np.arange(n)[:, None], places] = 1
    return [text, page], places, y


def pool_of(spark, views, places, parts):
    rows = [(list(map(float, t)), list(map(int, p))) for t, p in zip(views[0], places)]
    return spark.createDataFrame(rows, "text array<float>, page array<int>").repartition(parts)


def test_exchange_uses_every_unlabelled_document_and_helps_both_views(spark):
    known, _, y = views_of(120, 1)
    views, places, truth = views_of(4000, 2)
    got = []
    for parts in (1, 7):
        model = quality.CoTrained(known, y)
        before = [((o > 0) == (truth > 0)).mean() for o in model.odds(views)]
        given = quality.teach(model, pool_of(spark, views, places, parts), rounds=4, share=0.2, sure=math.log(9))
        labels = model.taught([views[0].astype(np.float32).astype(float), views[1]])
        assert given == [int((~np.isnan(v)).sum()) for v in labels]  # counted in Spark = told by the models
        assert min(given) > 1000  # far more than the labelled rows
        for v in labels:
            told = ~np.isnan(v)
            assert (v[told] == truth[told]).mean() > 0.93
        after = [((o > 0) == (truth > 0)).mean() for o in model.odds(views)]
        assert after[0] > before[0] + 0.02 and after[1] >= before[1] - 0.005
        got.append((given, [m.w for m in model.models]))
    assert got[0][0] == got[1][0]
    assert all(np.allclose(a, b, atol=1e-6) for a, b in zip(got[0][1], got[1][1]))


def test_exchange_ends_at_the_optimum_of_labels_and_pseudo_labels(spark):
    known, _, y = views_of(200, 3)
    views, places, _ = views_of(900, 4)
    model = quality.CoTrained(known, y)
    assert max(quality.teach(model, pool_of(spark, views, places, 3), rounds=1, share=0.1, sure=math.log(9))) > 0
    views[0] = views[0].astype(np.float32).astype(float)
    for m, v, g, (x, label) in zip(model.models, views, model.taught(views), model.known):
        told = ~np.isnan(g)
        z, every = m.inputs(np.vstack([x, v[told]])), np.append(label, g[told])
        weight = np.append(np.ones(len(x)), np.full(told.sum(), min(1.0, len(x) / max(told.sum(), 1))))
        p = 1 / (1 + np.exp(-np.clip(z @ m.w, -30, 30)))
        h = (z * (weight * p * (1 - p))[:, None]).T @ z + np.diag(m.pull)
        left = np.linalg.solve(h, z.T @ (weight * (every - p)) - m.pull * m.w)  # what one more Newton step would move
        assert np.abs(left).max() < quality.SETTLED


def test_thresholds_take_whole_bins_and_only_sure_ones():
    counts = {-2000: 3, -1500: 4, -10: 90, 1500: 2, 1600: 5, 3000: 6}
    assert quality.thresholds(counts, 0.5, 0.1, math.log(49)) == (-1500, 3000, 13)  # five a class: 3 + 4 and 6
    assert quality.thresholds(counts, 0.5, 1.0, math.log(49)) == (-1500, 1500, 20)
    low, high, n = quality.thresholds({}, 0.5, 0.1, 1.0)
    assert n == 0 and low < -10 ** 6 and high > 10 ** 6


# ---------------------------------------------------------------- extraction
def page(body, title="t"):
    return f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style></head><body>{body}</body></html>"


def test_extraction_of_single_pages(spark):
    cases = {
        page("<nav><ul><li>Home</li></ul></nav><article><h1>A &amp; B</h1><p><b>One\n two<br><p>Three&nbsp;four</article><footer>f"): "A & B\n\nOne two\n\nThree four",
        page("<header>h</header><div id='content'>loose <i>text</i><script>var t='<p>no</p>';</script><form>f</form></div><aside>a</aside>"): "loose text",
        page("<main><div class='cookie-notice'>c</div><p>x</p><section class='comments'><p>c</p></section><div class='advert'>a</div></main>"): "x",
        page("<article><p>keep</p><ol class=comment-list><li>no</ol></article><article class='comment'><p>no</p></article>"): "keep",
        page("<article><p class='notice'>n</p><p style='display: none'>h</p><p class=lead>lead</p><div role=complementary>r</div></article>"): "lead",
        "<p>a<p>b<!-- <p>c</p> --><table><tr><td>1<td>2<tr><td>3</table>": "a\n\nb\n\n1 2\n\n3",
        None: "", "": "", "<html><body></body>": "",
        "plain &lt;text&gt; <b>unclosed": "plain <text> unclosed",
        "<div>" * 3000 + "deep": "deep",
    }
    df = spark.createDataFrame([(i, None if i % 2 else f"http://h{i}.example/x", h, 1) for i, h in enumerate(cases)], "page_id long, url string, html string, text int")
    got = {r["page_id"]: r for r in extraction.extract(df).collect()}
    for i, want in enumerate(cases.values()):
        assert got[i]["text"] == want and got[i]["n_chars"] == len(want), i
    assert extraction.extract(df.limit(0)).count() == 0


def test_wrapper_drops_what_a_host_repeats(spark):
    rows = [(i, f"https://Host.example/{i}", page(f"<div class=w><p>Read more stories</p><p>{prose(20, i)}</p></div>")) for i in range(8)]
    rows += [(100 + i, f"https://other.example/{i}", page(f"<div class=w><p>Read more stories</p><p>{prose(20, i)}</p></div>")) for i in range(2)]
    rows += [(200 + i, "https://copy.example/a", page("<div><p>same page</p></div>")) for i in range(9)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    got = {r["page_id"]: r["text"] for r in extraction.extract(df).collect()}
    for i in range(8):
        assert got[i] == " ".join(prose(20, i).split())
    assert got[100].startswith("Read more stories\n\n") and got[205] == "same page"


def test_wrapper_keys_of_classed_roots_and_inline_markup(spark):
    fixed = ["<p><a href=/m>Read more</a></p>", "<p>Join our <b>list</b> now</p>", "<div class=box>Plain <i>words</i><p>inner</p></div>"]
    rows = [(100 * k + i, f"https://h{k}.example/{i}", page(f"<{tag}>{''.join(fixed)}<p>{prose(20, i)}</p></{tag.split()[0]}>"))
            for k, tag in enumerate(["article class='post wide'", "main class=m", "div class=w"]) for i in range(8)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    for r in extraction.extract(df).collect():
        assert r["text"] == " ".join(prose(20, r["page_id"] % 100).split()), r


@pytest.mark.parametrize("batch,parts", [(1000, 1), (7, 5), (1, 1)])
def test_wrapper_does_not_depend_on_batches_or_order(spark, batch, parts):
    rows = [(1000 * k + i, f"https://h{k}.example/{i}", page(f"<div><p>Odd page {k}</p></div>" if i == 3 else f"<div><p>Read more {k}</p><p>{prose(9, i)}</p></div>"))
            for i in range(10) for k in range(40)]
    rows += [(100000 + i, None, page(f"<div><p>No url here</p><p>{prose(9, i)}</p></div>")) for i in range(200)]
    df = spark.createDataFrame(random.Random(batch).sample(rows, len(rows)), "page_id long, url string, html string").repartition(parts)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, str(batch))
    try:
        got = extraction.extract(df).collect()
    finally:
        spark.conf.set(key, old)
    assert len(got) == len(rows)
    for r in got:
        i = r["page_id"] % 1000
        assert r["text"] == (f"Odd page {r['page_id'] // 1000}" if r["url"] and i == 3 else " ".join(prose(9, i).split()))


def test_simple_tree_matching_is_maximal():
    tree = lambda s: extraction.folded(extraction.parse(s))
    out = []
    a, b = tree("<div><h2>x</h2><ul><li>1</ul><p>c</p></div>"), tree("<div><ul><li>2</ul><h3>n</h3><p>c</p></div>")
    assert extraction.align(a, b, "", out) == 5  # page, div, ul, li, p
    assert [t for _, t in out] == ["c"]


# ---------------------------------------------------------------- fingerprints
def test_fingerprints_of_edited_texts(spark, docs):
    rows = docs.withColumn("h", F.xxhash64(F.coalesce("text", F.lit("")))).collect()
    order = sorted(rows, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["h"]))  # ties by content
    texts = [r["text"] or "" for r in order]
    want = Counter()
    own = [fingerprint.fingerprints([t])[0] for t in texts]
    for i, t in enumerate(texts):
        after, n = texts[(i + 1) % len(texts)], len(t) // 2
        edited = t[:len(t) - n] + after[:n]
        mark = fingerprint.fingerprints([edited])[0]
        want[(order[i]["doc_id"], len(t), hashlib.sha256(edited.encode()).hexdigest(), own[i], mark,
              round(float(fingerprint.likeness([own[i]], [mark])[0]), 9), round(float(fingerprint.likeness([own[i]], [own[(i + 1) % len(own)]])[0]), 9))] += 1
    for parts in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            got = Counter((r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"], round(r["near_edited"], 9), round(r["near_next"], 9))
                          for r in fingerprint.edited(docs).collect())
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
        assert got == want
    assert fingerprint.edited(docs.limit(0)).count() == 0
    single = fingerprint.edited(docs.where("doc_id = 500")).collect()
    assert len(single) == 1 and single[0]["near_next"] == 1.0


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distances_and_likeness():
    r = random.Random(8)
    a = ["".join(r.choices("ABc9+/", k=r.randrange(0, 65))) for _ in range(200)]
    b = ["".join(r.choices("ABc9+/", k=r.randrange(0, 65))) for _ in range(200)]
    assert fingerprint.edit_distances(a, b).tolist() == [edit_distance(x, y) for x, y in zip(a, b)]
    text = prose(2000, 1)
    near = text[:3000] + "changed here" + text[3010:]
    one, two, far = fingerprint.fingerprints([text, near, prose(2000, 2)])
    assert fingerprint.likeness([one, one, one], [one, two, far])[0] == 1
    assert fingerprint.likeness([one], [two])[0] > 0.8 and fingerprint.likeness([one], [far])[0] < 0.2
    assert fingerprint.fingerprints(["", None]) == ["3::", "3::"]


@pytest.mark.parametrize("seed", range(12))
def test_fingerprints_of_repeated_lines(seed):
    r = random.Random(seed)
    line = "".join(r.choice("abcdefgh ,.0123") for _ in range(99)) + "\n"
    text = line * r.choice([100, 400, 3000])
    tail, middle = text + "one more line, another one at the end of it all\n", text[:len(text) // 2] + "a line between the others\n" + text[len(text) // 2:]
    marks = fingerprint.fingerprints([text, tail, middle, prose(3000, seed)])
    for mark in marks:
        assert 16 <= len(mark.split(":")[1]) <= 64, mark
    near = fingerprint.likeness([marks[0]] * 3, marks[1:])
    assert near[0] > 0.8 and near[1] > 0.8 and near[2] < 0.2
    assert marks[0] != marks[1] and marks[0] != marks[2]


@pytest.mark.parametrize("seed", range(6))
def test_edits_count_wherever_they_are(seed):
    r = random.Random(seed)
    line = "".join(r.choice("abcdefgh ,.0123") for _ in range(399)) + "\n"
    marks = fingerprint.fingerprints([line * 400, line * 200 + prose(20000, seed), prose(20000, seed) + line * 200])
    assert (fingerprint.likeness([marks[0]] * 2, marks[1:]) < 0.8).all()


# ---------------------------------------------------------------- helpers and pipeline
def test_shingles_match_a_loop():
    texts = [b"a b c d e f g", b"", b"one two", b"x y z u v", b" lead  and\ttabs here now "]
    b = Block(texts)
    start, end, doc = b.words()
    words = [(int(d), bytes(b.buf[s:e])) for s, e, d in zip(start, end, doc)]
    assert words == [(i, w) for i, t in enumerate(texts) for w in t.split()]
    h, d = shingles(b.range_hash(start, end), doc, b.n)
    want = [max(1, len(t.split()) - 4) if t.split() else 0 for t in texts]
    assert np.bincount(d, minlength=len(texts)).tolist() == want
    again = Block([b"c d e f g a b"])
    h2, _ = shingles(again.range_hash(*again.words()[:2]), again.words()[2], 1)
    assert h[2] == h2[0] and h[0] not in h2


def test_pipeline_stages(spark, tmp_path):
    rows, labels = [], []
    for i in range(240):
        bad = i % 8 == 0
        text = " ".join(["junk"] * 60) + f" {i}" if bad else prose(150, i) + (f" token = \"{hashlib.sha1(bytes([i])).hexdigest()}\"" if i % 5 == 1 else "")
        rows.append((i, text, "en", "ab"[i % 2], len(text)))
        labels.append((i, 0 if bad else 1, 0))
    rows += [(1000 + k, rows[k][1], "en", "a", 1) for k in (1, 2, 3)] + [(1100, rows[5][1] + " more", "en", "b", 1), (2000, None, None, None, None)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("Tid", F.lit("x"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] and len(corpus_pipeline.STAGES) == 5
    held = docs
    ids = []
    for name, step in corpus_pipeline.STAGES[:-1]:
        held = step(spark, held, str(tmp_path))
        assert held.columns == docs.columns, name
        held = spark.createDataFrame(held.collect(), held.schema)
        ids.append(Counter(r["doc_id"] for r in held.collect()))
    clean = {r[0] for r in rows if r[0] % 8 or r[0] >= 1000}
    assert clean - {2000} <= set(ids[0]) and not {i for i in range(240) if i % 8 == 0} & set(ids[0])
    assert set(ids[0]) - set(ids[1]) == {1001, 1002, 1003, 1100} and max(ids[1].values()) == 1
    assert ids[2] == ids[1]
    assert set(ids[3]) <= set(ids[2]) and max(ids[3].values()) <= 2
    assert not [r for r in held.collect() if r["text"] and re.search(r"[0-9a-f]{40}", r["text"])]
    out = corpus_pipeline.STAGES[-1][1](spark, held, str(tmp_path))
    assert Counter(r["doc_id"] for r in out.where("piece = 0").collect()) == ids[3]
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == out.count()


def test_deep_equal_siblings_and_wide_pages(spark):
    import time
    chain = "<div>" * 5000 + "<p>deep words here</p>" + "</div>" * 5000
    deep = f"<html><body>{chain}{chain}</body></html>"
    wide = "<html><body>" + "<p>one block</p>" * 40000 + "</body></html>"
    df = spark.createDataFrame([(1, "http://a.example/1", deep), (2, "http://a.example/2", deep + "<p>end</p>"), (3, "http://b.example/1", wide)],
                               "page_id long, url string, html string")
    began = time.time()
    got = {r["page_id"]: r["text"] for r in extraction.extract(df).collect()}
    assert time.time() - began < 60
    assert got[3] == "\n\n".join(["one block"] * 40000) and set(got) == {1, 2, 3}
    root = extraction.parse(wide)
    began = time.time()
    assert [n.tag for n in extraction.content_roots(root)] == ["body"] and time.time() - began < 2
