"""Secret scans: fixed base patterns plus formats learned by grammar inference.

The base patterns find assigned values, access keys and long hex runs. Their values are
labelled credentials: a bounded sample of them, and one of ordinary long tokens, are each
made into a frequency prefix tree whose statistically compatible states are merged
(Hoeffding test, red-blue order) into a probabilistic automaton over character classes.
Every other long token of every text is then scored by the log-odds per character of its
best credential automaton against the automaton of ordinary tokens.

Defined results: a null text counts as empty (no spans); rows are handled one by one, so
repeated rows repeat their result; an empty table gives no rows and an empty model; other
columns are ignored by ``scan`` and kept by ``redact``; texts are scanned whole.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetlens.llm.common import load, query, stage
from fleetlens.llm.textvec import slices

KINDS = ("assign", "access", "hex", "format")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
TOKEN_MIN = 16
TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]{%d,}" % TOKEN_MIN)
ASSIGN_MIN = 6
SAMPLE = 3000  # labelled values per kind, and ordinary tokens, that the automata are fitted on
FIT_MAX_LENGTH = 256  # longer values are not fitted on; all are scored
ALPHA = 0.05
UNSEEN = math.log(1e-5)
MASK = "[SECRET]"

Span = tuple[int, int, int]  # start, kind (place in KINDS), end


def base_spans(text: str) -> list[Span]:
    """Base matches by start, then kind."""
    out: list[Span] = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_MIN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def other_tokens(text: str, base: list[Span]) -> Iterator[tuple[int, int]]:
    """Long tokens, and long parts of tokens beside base spans, in order."""
    held = sorted((s, e) for s, _, e in base)
    i, reach = 0, 0
    for m in TOKEN.finditer(text):
        at, end = max(m.start(), reach), m.end()
        while i < len(held) and held[i][0] < end:
            if held[i][0] - at >= TOKEN_MIN:
                yield at, held[i][0]
            reach = max(reach, held[i][1])
            at = max(at, reach)
            i += 1
        if end - at >= TOKEN_MIN:
            yield at, end


def mixed_tokens(text: str, base: list[Span]) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """Long tokens that hold access keys or hex runs and more: start, end and the parts beside them."""
    held = sorted((s, e) for s, k, e in base if k)
    assigned = [(s, e) for s, k, e in base if not k]
    i = 0
    for m in TOKEN.finditer(text) if held else ():
        (s, e), at, parts = m.span(), m.start(), []
        while i < len(held) and held[i][0] < e:
            if held[i][0] > at:
                parts.append((at, held[i][0]))
            at = max(at, held[i][1])
            i += 1
        if at > s and at < e:
            parts.append((at, e))
        if at > s and parts and not any(x < e and s < y for x, y in assigned):
            yield s, e, parts


_CLASS = {c: k for k, cs in {"0": "0123456789", "a": "abcdef", "l": "ghijklmnopqrstuvwxyz", "A": "ABCDEF",
                             "U": "GHIJKLMNOPQRSTUVWXYZ"}.items() for c in cs}


def symbols(token: str) -> str:
    """Character classes: digit, hex letter, other letter (each case), or the mark itself."""
    return "".join(_CLASS.get(c, c) for c in token)


class Automaton:
    """Probabilistic deterministic automaton: per state {symbol: (target, log p)} and log p of ending."""

    def __init__(self, strings: list[str], alpha: float = ALPHA):
        self.moves: list[dict[str, tuple[int, float]]] = []
        self.ends: list[float] = []
        if strings:
            self._infer(strings, alpha)

    def _infer(self, strings: list[str], alpha: float) -> None:
        child: list[dict[str, int]] = [{}]
        passed: list[dict[str, int]] = [{}]
        ended = [0]
        for s in strings:
            at = 0
            for c in s:
                passed[at][c] = passed[at].get(c, 0) + 1
                if c not in child[at]:
                    child[at][c] = len(child)
                    child.append({})
                    passed.append({})
                    ended.append(0)
                at = child[at][c]
            ended[at] += 1
        bound = math.sqrt(0.5 * math.log(2 / alpha))
        total = [ended[i] + sum(passed[i].values()) for i in range(len(child))]

        def differ(f1: int, n1: int, f2: int, n2: int) -> bool:
            return n1 > 0 < n2 and abs(f1 / n1 - f2 / n2) > bound * (n1 ** -0.5 + n2 ** -0.5)

        def compatible(a: int, b: int) -> bool:
            todo, seen = [(a, b)], set()
            while todo:
                x, y = todo.pop()
                if x == y or (x, y) in seen:
                    continue
                seen.add((x, y))
                if differ(ended[x], total[x], ended[y], total[y]):
                    return False
                for c in {*passed[x], *passed[y]}:
                    if differ(passed[x].get(c, 0), total[x], passed[y].get(c, 0), total[y]):
                        return False
                todo += [(child[x][c], child[y][c]) for c in child[x].keys() & child[y].keys()]
            return True

        def fold(a: int, b: int) -> None:
            todo = [(a, b)]
            while todo:
                x, y = todo.pop()
                ended[x] += ended[y]
                total[x] += total[y]
                for c, n in passed[y].items():
                    passed[x][c] = passed[x].get(c, 0) + n
                for c, t in child[y].items():
                    if c in child[x]:
                        todo.append((child[x][c], t))
                    else:
                        child[x][c] = t

        red = [0]
        is_red = {0}
        while True:
            blue = [(-total[t], r, c, t) for r in red for c, t in child[r].items() if t not in is_red]
            if not blue:
                break
            _, parent, c, b = min(blue)
            match = next((r for r in red if compatible(r, b)), None)
            if match is None:
                red.append(b)
                is_red.add(b)
            else:
                child[parent][c] = match
                fold(match, b)
        place = {r: i for i, r in enumerate(red)}
        for r in red:
            n = total[r] + 1e-9
            self.moves.append({c: (place[t], math.log(passed[r][c] / n)) for c, t in child[r].items()})
            self.ends.append(math.log(ended[r] / n) if ended[r] else UNSEEN)

    def log_likelihood(self, string: str) -> float:
        """Log probability; an unseen symbol costs ``UNSEEN`` and leaves the state as it is."""
        at, out = 0, 0.0
        for c in string:
            step = self.moves[at].get(c)
            if step is None:
                out += UNSEEN
            else:
                at = step[0]
                out += step[1]
        return out + self.ends[at]


class Model:
    """Credential automata by kind, the automaton of ordinary tokens, and a threshold per kind.

    A threshold is the larger of 0 and the lowest hundredth of the kind's own values, whatever
    share of the other tokens is above it. The ordinary sample may hold unlabelled credentials:
    those found are taken out of it and the rest is fitted again, until none is found.
    """

    def __init__(self, values: dict[str, list[str]], ordinary: list[str]):
        self.kinds = {k: Automaton([symbols(v) for v in sorted(vs)]) for k, vs in sorted(values.items()) if vs}
        held = {k: [symbols(v) for v in vs] for k, vs in values.items() if vs}
        left = [symbols(v) for v in sorted(ordinary)]
        while True:
            self.ordinary = Automaton(left)
            self.least = {k: max(sorted(self.odds(k, s) for s in vs)[len(vs) // 100], 0.0) for k, vs in held.items()}
            clean = [s for s in left if not self._above(s)]
            if len(clean) == len(left) or not clean:  # nothing ordinary is left: the last fit stands
                break
            left = clean

    def odds(self, kind: str, s: str) -> float:
        other = self.ordinary.log_likelihood(s) if self.ordinary.moves else UNSEEN * len(s)
        return (self.kinds[kind].log_likelihood(s) - other) / max(1, len(s))

    def _above(self, s: str) -> bool:
        return any((odds := self.odds(k, s)) > 0 and odds >= least for k, least in self.least.items())

    def is_credential(self, token: str) -> bool:
        return self._above(symbols(token))

    def spans(self, text: str) -> list[Span]:
        """All spans of a text, base ones first found, by start and then kind."""
        base = base_spans(text)
        learned = {(s, e) for s, e in other_tokens(text, base) if self.is_credential(text[s:e])}
        for s, e, parts in mixed_tokens(text, base):
            if self.is_credential(text[s:e]):  # a credential that a base pattern holds a run of: the rest of it too
                learned.update(parts)
        return sorted(base + [(s, 3, e) for s, e in learned])


def labelled(docs: DataFrame) -> DataFrame:
    """Distinct (label, value): values of base matches by kind, and ordinary long tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = set()
            for t in batch.column("text"):
                text = t.as_py() or ""
                base = base_spans(text)
                for s, k, e in base:
                    value = ASSIGN.match(text, s).group(2) if k == 0 else text[s:e]
                    seen.add((KINDS[k], value))
                seen.update(("ordinary", text[s:e]) for s, e in other_tokens(text, base))
            rows = [r for r in seen if len(r[1]) <= FIT_MAX_LENGTH]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], names=["label", "value"])

    return docs.select("text").mapInArrow(run, "label string, value string").distinct()


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` values per label, those of least hash (a fixed choice)."""
    rows = stage(labelled(docs), "secret-labels")
    got = {k: [r["value"] for r in rows.where(F.col("label") == k).orderBy(F.xxhash64("value"), "value").limit(sample).collect()]
           for k in (*KINDS[:3], "ordinary")}
    return Model({k: got[k] for k in KINDS[:3]}, got["ordinary"])


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, counts of the base kinds, digest of the base spans, all spans, learned count."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for t in batch.column("text"):
                spans = model.spans(t.as_py() or "")
                n = [sum(k == i for _, k, _ in spans) for i in range(4)]
                base = _joined([s for s in spans if s[1] < 3])
                rows.append((*n[:3], hashlib.sha256(base.encode()).hexdigest(), _joined(spans), n[3]))
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            cols = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *cols], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_format"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_format long")


def mask(text: str, spans: list[Span], by: str = MASK) -> str:
    """``text`` with every run of touching spans replaced by ``by``."""
    out, at = [], 0
    runs: list[list[int]] = []
    for s, _, e in sorted(spans):
        if runs and s <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], e)
        else:
            runs.append([s, e])
    for s, e in runs:
        out += [text[at:s], by]
        at = e
    return "".join(out) + text[at:]


def redact(docs: DataFrame, model: Model, by: str = MASK) -> DataFrame:
    """``docs`` with the secrets of ``text`` masked (and n_chars, where there is one, made to fit)."""
    @F.pandas_udf("string")
    def masked(texts):
        return texts.map(lambda t: mask(t, spans, by) if t and (spans := model.spans(t)) else t)

    out = docs.withColumn("text", masked("text"))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


@query("op3_secret_scan")
def op3_secret_scan(spark, sf_dir):
    """Base and learned secret spans of every whole text of ``documents``."""
    docs = load(spark, sf_dir, "documents")
    return scan(docs, fit(docs))
