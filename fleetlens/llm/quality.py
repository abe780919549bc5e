"""Quality classifier by co-training two views of a document.

View one is the text (byte classes, word and trigram variety, hashed words), view two the
page's metadata (language, source, length). Each view has a logistic regression; over a
few rounds each passes its most confident pseudo-labels for unlabelled documents to the
other. Both are then calibrated on held-out labels and combined as independent evidence:
the log-odds of the views add up, less those of the prior. Every document is scored.

Labels come from at most ``labelled_rows`` documents, those of least id hash (a fixed
choice). All other documents take part in the exchange: their views are stored once, and
each round is a few aggregations over them (a histogram of log-odds, from which the
thresholds of the round follow, and the sums of Newton steps). Whether a document has been
taught, and what, follows from the models and thresholds of the rounds so far, so no state
is kept by document. The pseudo-labels of a view weigh together at most as much as its
labels, so the exchange works alike at every size. Sums are whole numbers of small steps:
they do not depend on how the rows are split.

Defined results: a null text counts as empty, null metadata is a category of its own;
without labels of both classes every document is kept with the share of good labels (1.0
without labels) as its score; several labels of one id are averaged, null ones ignored;
repeated rows are scored (and teach) each; documents whose log-odds tie at a threshold are
taught together; an empty table gives no rows; other columns are kept by ``keep_good``.
"""

from __future__ import annotations

import copy
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from fleetlens.llm.common import fresh, load, query, stage
from fleetlens.llm.textvec import Block, blocks, shingles

LABELLED_ROWS = 6000
ROUNDS = 5
STEPS = 12  # most Newton steps of a round, from the models of the round before
SETTLED = 0.02  # a step that moves no weight by more is the last
SHARE_PER_ROUND = 0.05
HELD_OUT = 0.3
SURE = float(np.log(0.98 / 0.02))  # calibrated log-odds from which a view may teach the other
KEEP_AT = 0.5
HASHED_WORDS = 64
BINS = 256  # histogram bins of a unit of log-odds
STEP = 2.0 ** 32  # sums are kept in steps of its inverse
FAR = 30.0  # log-odds are clipped there
OUTLIER = 8.0  # standardised features are clipped there, so that no document decides a step alone

_CLASSES = np.full(256, 11, dtype=np.int64)  # other marks
for _i, _cs in enumerate((range(65, 91), range(97, 123), range(48, 58), (32,), (10, 13), (33,), (124,), (46,), (44,), (63, 58, 59), range(128, 256))):
    for _c in _cs:
        _CLASSES[_c] = _i
N_CLASSES = 12
N_TEXT = N_CLASSES + 6 + HASHED_WORDS
N_PAGE = 8 + 32 + 24


def text_view(texts) -> np.ndarray:
    """Content features, one row per text."""
    out = []
    for part in blocks(texts):
        b = Block(part)
        n = b.n
        size = np.maximum(b.end - b.start, 1)
        of = np.repeat(np.arange(n), b.end - b.start + 1)[:len(b.buf)]
        kinds = np.bincount(of * N_CLASSES + _CLASSES[b.buf], minlength=n * N_CLASSES).reshape(n, N_CLASSES) / size[:, None]
        start, end, doc = b.words()
        h = b.range_hash(start, end)
        words = np.maximum(np.bincount(doc, minlength=n), 1)
        again = np.zeros(len(h), dtype=bool)
        again[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
        three, of3 = shingles(h, doc, n, 3)

        def variety(x, d):
            _, at = np.unique(x * np.uint64(n) + d.astype(np.uint64), return_index=True)
            return np.bincount(d[at], minlength=n) / np.maximum(np.bincount(d, minlength=n), 1)

        hashed = np.bincount(doc * HASHED_WORDS + (h % np.uint64(HASHED_WORDS)).astype(np.int64), minlength=n * HASHED_WORDS)
        stats = [np.log1p(words), np.bincount(doc, end - start, n) / words, np.bincount(doc, again, n) / words,
                 variety(h, doc), variety(three, of3), (words > 1) * 1.0]
        out.append(np.column_stack([kinds, *stats, hashed.reshape(n, HASHED_WORDS) / words[:, None]]))
    return np.vstack(out).astype(np.float64) if out else np.zeros((0, N_TEXT))


def page_view(lang, source, n_chars) -> np.ndarray:
    """Metadata features, one row per document: hashed language and source, length class."""
    n = len(lang)
    out = np.zeros((n, N_PAGE))
    for i, (a, b, c) in enumerate(zip(lang, source, n_chars)):
        out[i, zlib.crc32(a.encode()) % 7 if isinstance(a, str) else 7] = 1
        out[i, 8 + (zlib.crc32(b.encode()) % 31 if isinstance(b, str) else 31)] = 1
        known = c is not None and c == c and c >= 0
        out[i, 40 + (min(22, int(np.log2(c + 1))) if known else 23)] = 1
    return out


class Logistic:
    """Ridge logistic regression by Newton steps, halved where they overshoot, on standardised features."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25):
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0)
        self.scale[self.scale < 1e-9] = 1.0
        self.pull = np.append(np.full(x.shape[1], ridge), 1e-6)
        self.w = np.zeros(x.shape[1] + 1)
        self.begin()
        for _ in range(steps):
            if self.step(self.sums(x, y)) < 1e-3:
                break

    def inputs(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.clip((x - self.mean) / self.scale, -OUTLIER, OUTLIER), np.ones(len(x))])

    def size(self) -> int:
        return len(self.w) * (len(self.w) + 1) + 1

    def sums(self, x: np.ndarray, y: np.ndarray, weight: float = 1.0) -> np.ndarray:
        """Curvature, slope and value of the log-likelihood of these rows, flat: they add up over parts of the data."""
        z = self.inputs(x)
        t = z @ self.w
        p = 1 / (1 + np.exp(-np.clip(t, -FAR, FAR)))
        curvature = (z * (p * (1 - p) + 1e-6)[:, None]).T @ z
        return weight * np.concatenate([curvature.ravel(), z.T @ (y - p), [(y * t - np.logaddexp(0, t)).sum()]])

    def begin(self) -> None:
        """Other rows follow: the value reached so far does not bind."""
        self.best = (-np.inf, self.w, self.w)

    def step(self, sums: np.ndarray) -> float:
        """Move by the sums over all rows; gives the largest move of a weight."""
        d = len(self.w)
        value = sums[-1] - (self.pull * self.w ** 2).sum() / 2
        if value < self.best[0] - 1e-6 * (1 + abs(value)):
            _, good, by = self.best
            self.best = (self.best[0], good, by / 2)
        else:
            by = np.linalg.solve(sums[:d * d].reshape(d, d) + np.diag(self.pull), sums[d * d:-1] - self.pull * self.w)
            self.best = (value, self.w, by)
        _, good, by = self.best
        self.w = good + by
        return float(np.abs(by).max())

    def margin(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.inputs(x) @ self.w, -FAR, FAR)


class CoTrained:
    """Two views' models, calibrated and combined; ``teach`` is a round of exchanged pseudo-labels."""

    def __init__(self, views: list[np.ndarray], label: np.ndarray):
        self.prior = float(label.mean()) if len(label) else 1.0
        self.models: list[Logistic] = []
        self.rounds: list[list[tuple]] = []  # per round and learning view: (teacher, its scale, low, high)
        if not 0 < self.prior < 1:
            return
        # every tenth labelled row from the seventh on is held out for calibration
        held = np.arange(len(label)) % 10 >= 10 * (1 - HELD_OUT)
        if len(set(label[held])) < 2 or len(set(label[~held])) < 2:
            held, fit = np.ones(len(label), dtype=bool), np.ones(len(label), dtype=bool)
        else:
            fit = ~held
        self.known = [(v[fit], label[fit]) for v in views]
        self.held = [(v[held], label[held]) for v in views]
        self.models = [Logistic(x, y) for x, y in self.known]
        self.calibrate()

    def light(self) -> CoTrained:
        """The same models without the labelled rows, as tasks need them."""
        out = copy.copy(self)
        out.known = out.held = None
        return out

    def calibrate(self) -> None:
        self.scales = [Logistic(m.margin(x)[:, None], y) for m, (x, y) in zip(self.models, self.held)]

    def odds(self, views: list[np.ndarray]) -> list[np.ndarray]:
        """Calibrated log-odds of each view."""
        return [s.margin(m.margin(v)[:, None]) for s, m, v in zip(self.scales, self.models, views)]

    def taught(self, views: list[np.ndarray]) -> list[np.ndarray]:
        """The pseudo-label that each view has been given so far for each document (nan: none).
        The first round that teaches a document decides."""
        out = [np.full(len(v), np.nan) for v in views]
        for learners in self.rounds:
            for given, (model, scale, low, high), v in zip(out, learners, reversed(views)):
                at = bins(scale.margin(model.margin(v)[:, None]))
                open_ = np.isnan(given)
                given[open_ & (at <= low)] = 0.0
                given[open_ & (at >= high)] = 1.0
        return out

    def score(self, views: list[np.ndarray]) -> list[np.ndarray]:
        """Calibrated probability of each view, and of both together."""
        if not self.models:
            return [np.full(len(views[0]), self.prior)] * 3
        odds = self.odds(views)
        both = odds[0] + odds[1] - np.log(self.prior / (1 - self.prior))
        return [1 / (1 + np.exp(-x)) for x in (*odds, both)]


def bins(odds: np.ndarray) -> np.ndarray:
    return np.floor(odds * BINS).astype(np.int64)


def stored_views(batch: pd.DataFrame) -> list[np.ndarray]:
    """Views of documents from their stored columns ``text`` (values) and ``page`` (places of the ones)."""
    text = np.array(batch["text"].tolist(), dtype=float).reshape(len(batch), N_TEXT)
    page = np.zeros((len(batch), N_PAGE))
    page[np.arange(len(batch))[:, None], np.array(batch["page"].tolist(), dtype=np.int64).reshape(len(batch), 3)] = 1
    return [text, page]


def thresholds(counts: dict[int, int], prior: float, share: float, sure: float) -> tuple[int, int, int]:
    """Bins up to which documents are taught as bad and from which as good, and how many these are.

    The most confident of a class until their share is reached, the bin that reaches it whole;
    none of log-odds under ``sure``.
    """
    total, taught, ends = sum(counts.values()), 0, []
    for sign, part in ((-1, 1 - prior), (1, prior)):
        left, end = int(share * total * part), sign * 2 ** 40
        for at in sorted(counts, reverse=sign > 0):
            if left <= 0 or sign * at < np.ceil(sure * BINS):
                break
            left, taught, end = left - counts[at], taught + counts[at], at
        ends.append(end)
    return ends[0], ends[1], taught


def teach(model: CoTrained, pool: DataFrame, rounds: int = ROUNDS, share: float = SHARE_PER_ROUND, sure: float = SURE) -> list[int]:
    """Rounds of the exchange over all documents of ``pool`` (columns text, page as stored).

    Gives the number of pseudo-labels that each view has been given. What a pass sends to the
    driver has a size set by the features and the bins alone.
    """
    n_taught = [0, 0]
    for _ in range(rounds if model.models else 0):
        def histogram(batches, model=model.light()):
            for batch in batches:
                views = stored_views(batch)
                for view, (odds, given) in enumerate(zip(model.odds(views), reversed(model.taught(views)))):
                    at, n = np.unique(bins(odds[np.isnan(given)]), return_counts=True)
                    yield pd.DataFrame({"view": np.full(len(at), view), "bin": at, "n": n})

        counts: list[dict[int, int]] = [{}, {}]
        for r in pool.mapInPandas(histogram, "view long, bin long, n long").groupBy("view", "bin").agg(F.sum("n").alias("n")).collect():
            counts[r["view"]][r["bin"]] = r["n"]
        ends = [thresholds(c, model.prior, share, sure) for c in counts]
        if not any(e[2] for e in ends):
            break
        # view 0 learns from view 1 and the other way round; the teachers stay as they are now
        model.rounds.append([(copy.copy(model.models[t]), model.scales[t], *ends[t][:2]) for t in (1, 0)])
        n_taught = [n_taught[v] + ends[1 - v][2] for v in (0, 1)]
        weights = [min(1.0, len(y) / n) if n else 0.0 for n, (_, y) in zip(n_taught, model.known)]
        for m in model.models:
            m.begin()
        for _ in range(STEPS):
            def newton(batches, model=model.light(), weights=weights):
                sums = [np.zeros(m.size()) for m in model.models]
                for batch in batches:
                    views = stored_views(batch)
                    for m, v, given, weight, s in zip(model.models, views, model.taught(views), weights, sums):
                        use = ~np.isnan(given)
                        if use.any():
                            s += m.sums(v[use], given[use], weight)
                flat = np.concatenate(sums)
                at = np.flatnonzero(flat)
                yield pd.DataFrame({"i": at, "x": np.rint(flat[at] * STEP).astype(np.int64)})

            total = np.zeros(sum(m.size() for m in model.models))
            for r in pool.mapInPandas(newton, "i long, x long").groupBy("i").agg(F.sum("x").alias("x")).collect():
                total[r["i"]] = r["x"] / STEP
            moved = 0.0
            for m, (x, y), part in zip(model.models, model.known, np.split(total, [model.models[0].size()])):
                moved = max(moved, m.step(m.sums(x, y) + part))
            if moved < SETTLED:
                break
        model.calibrate()
    return n_taught


def fit(docs: DataFrame, labels: DataFrame, labelled_rows: int = LABELLED_ROWS, rounds: int = ROUNDS) -> CoTrained:
    """Fit on the labelled documents of least id hash, then exchange pseudo-labels over all others."""
    label = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
             .agg((F.avg("quality") >= 0.5).cast("double").alias("label")))
    known = (label.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled_rows))

    @F.pandas_udf("text array<float>, page array<int>")
    def both(text: pd.Series, lang: pd.Series, source: pd.Series, n_chars: pd.Series) -> pd.DataFrame:
        page = page_view(lang, source, n_chars)
        return pd.DataFrame({"text": list(text_view(text).astype(np.float32)),
                             "page": list(np.nonzero(page)[1].reshape(len(page), 3).astype(np.int32))})

    rows = (docs.select("doc_id", "text", "lang", "source", "n_chars")
            .join(F.broadcast(known), "doc_id", "left")  # at most labelled_rows ids
            .select("doc_id", "label", both("text", "lang", "source", "n_chars").alias("x")))
    rows = stage(rows.select("doc_id", "label", "x.text", "x.page"), "quality-views")
    given = (rows.where("label IS NOT NULL").orderBy(F.xxhash64("doc_id"), "doc_id", "text", "page").limit(labelled_rows)
             .toPandas())
    model = CoTrained(stored_views(given), given["label"].to_numpy(dtype=float))
    teach(model, rows.where("label IS NULL").select("text", "page"), rounds)
    return model


def scores(model: CoTrained) -> Column:
    """Struct of text_score, page_score and quality for the columns of ``documents``."""
    model = model.light()

    @F.pandas_udf("text_score double, page_score double, quality double")
    def score(text: pd.Series, lang: pd.Series, source: pd.Series, n_chars: pd.Series) -> pd.DataFrame:
        got = model.score([text_view(text), page_view(lang, source, n_chars)])
        return pd.DataFrame(dict(zip(("text_score", "page_score", "quality"), got)))

    return score("text", "lang", "source", "n_chars")


def keep_good(docs: DataFrame, labels: DataFrame, at: float = KEEP_AT) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with their columns."""
    q = fresh(docs, "quality_scores")[0]
    return docs.withColumn(q, scores(fit(docs, labels))).where(F.col(q)["quality"] >= at).select(*docs.columns)


@query("op7_quality_classifier")
def op7_quality_classifier(spark, sf_dir):
    """Quality score and decision for every row of ``documents``."""
    docs = load(spark, sf_dir, "documents")
    model = fit(docs, load(spark, sf_dir, "labels"))
    s = docs.select("doc_id", scores(model).alias("s"))
    return s.select("doc_id", "s.text_score", "s.page_score", "s.quality", (F.col("s.quality") >= KEEP_AT).alias("kept"))
