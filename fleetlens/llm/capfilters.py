"""Near-duplicate embeddings by spherical-cap filters over a structured random product code.

A filter is a direction; a vector belongs to every filter whose cap it lies in (inner product
above a threshold). Directions come from a product code: after a seeded rotation the vector is
cut in two halves, each half has M random code words, and all M * M concatenations are filters.
A vector's filters are list-decoded: scores of the second half are sorted, so for each word of
the first half the exceeding words of the second are a prefix. Vectors that share a filter are
compared by cosine in double precision; a pair counts only in its first common filter.

Code size and threshold follow the largest label, so that a filter holds about ``OCCUPANCY``
vectors and a vector about ``LIST`` filters (never under half of that) at any size. Equal vectors are collapsed and
counted. A filter that holds many (a group of near copies) is cut into blocks and its block
pairs are compared as matrices: only sums and a spanning forest of the links leave a task.

Defined results: vectors that are null, empty, zero or hold null or non-finite components,
and those with a null label, link with nothing (component: their own id); so do vectors of
different length. A component's id is its smallest non-null vec_id. Repeated rows are
vectors of their own. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetlens.llm.common import load, query, stage
from fleetlens.llm.graph import components
from fleetlens.llm.minhash import _by_group, forest

COSINE = 0.93
OCCUPANCY = 50
LIST = 40
BLOCK = 512
SEED = 20240607


class ProductCode:
    """Rotation, two half codes of ``words`` unit vectors and the cap threshold for dimension ``dim``."""

    def __init__(self, dim: int, largest: int, seed: int = SEED):
        share = min(0.2, OCCUPANCY / max(largest, 1))
        self.words = max(2, int(np.ceil(np.sqrt(LIST / share))))
        self.least = NormalDist().inv_cdf(1 - share) / np.sqrt(dim)
        rng = np.random.default_rng([seed, dim])
        q, r = np.linalg.qr(rng.standard_normal((dim, dim)))
        self.turn = q * np.sign(np.diag(r))
        self.half = max(1, dim // 2)
        # concatenated words have unit length: each half is given its share of the dimensions
        self.codes = []
        for width in (self.half, dim - self.half):
            c = rng.standard_normal((self.words, width))
            self.codes.append(c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-300) * np.sqrt(width / dim))

    def filters(self, unit: np.ndarray) -> list[np.ndarray]:
        """Sorted filter numbers of each row of ``unit`` (rows of length one)."""
        x = unit @ self.turn
        s1, s2 = x[:, :self.half] @ self.codes[0].T, x[:, self.half:] @ self.codes[1].T
        order = np.argsort(-s2, axis=1, kind="stable")
        out = []
        for a, b, by in zip(s1, s2, order):
            least = self.least
            while True:
                n = np.searchsorted(-b[by], a - least, side="right")  # words of half two that exceed, best first
                if n.sum() >= min(LIST // 2, self.words ** 2):
                    break
                least -= 0.1 / np.sqrt(unit.shape[1])  # a vector that few caps hold: the caps next to it
            first = np.repeat(np.arange(self.words), n)
            rank = np.arange(len(first)) - np.repeat(np.cumsum(n) - n, n)
            out.append(np.sort(first * self.words + by[rank]).astype(np.int32))
        return out


def keyed_vectors(table: DataFrame) -> DataFrame:
    """vec_id, label, dim, cid (content key; null where nothing links) and raw (the components)."""
    id_type, label_type = (table.schema[c].dataType.simpleString() for c in ("vec_id", "label"))
    kind = np.float32 if table.schema["embedding"].dataType.elementType.simpleString() == "float" else np.float64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dim, cid, raw = [], [], []
            for x, label in zip(batch.column("embedding"), batch.column("label").to_pylist()):
                v = None if label is None or not x.is_valid or x.values.null_count else np.asarray(x.values, dtype=kind)
                if v is None or not len(v) or not np.isfinite(v).all() or not v.any():
                    dim.append(None), cid.append(None), raw.append(None)
                    continue
                v = v + kind(0)  # one zero
                dim.append(len(v))
                raw.append(v.tobytes())
                cid.append(hashlib.md5(f"{label!r}:".encode() + raw[-1]).digest())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(dim, pa.int32()),
                                              pa.array(cid, pa.binary()), pa.array(raw, pa.binary())], names=["vec_id", "label", "dim", "cid", "raw"])

    return table.select("vec_id", "label", "embedding").mapInArrow(run, f"vec_id {id_type}, label {label_type}, dim int, cid binary, raw binary"), kind


def unit_rows(raw: list[bytes], kind) -> np.ndarray:
    """Rows of length one in double precision (scaled first, so that squares stay finite)."""
    x = np.frombuffer(b"".join(raw), dtype=kind).reshape(len(raw), -1).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def decoded(distinct: DataFrame, largest: int, kind, payload: bool) -> DataFrame:
    """A row per vector and filter: bucket, cid (and raw, copies, its filters)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[int, ProductCode] = {}
        for batch in batches:
            dims = np.array(batch.column("dim"))
            labels = batch.column("label_key").to_pylist()
            raws = batch.column("raw").to_pylist()
            for d in np.unique(dims):
                rows = np.flatnonzero(dims == d)
                code = codes.setdefault(int(d), ProductCode(int(d), largest))
                for at in np.array_split(rows, len(rows) // 1024 + 1):
                    lists = code.filters(unit_rows([raws[i] for i in at], kind))
                    n = [len(x) for x in lists]
                    take = pa.array(np.repeat(at, n), pa.int64())
                    flat = np.concatenate(lists)
                    key = pa.array([f"{labels[i]}:{d}" for i in at]).take(pa.array(np.repeat(np.arange(len(at)), n)))
                    cols = [key, pa.array(flat, pa.int32()), batch.column("cid").take(take)]
                    names = ["space", "filter", "cid"]
                    if payload:
                        cols += [batch.column("raw").take(take), batch.column("copies").take(take),
                                 pa.array([x.tobytes() for x in lists], pa.binary()).take(pa.array(np.repeat(np.arange(len(at)), n)))]
                        names += ["raw", "copies", "filters"]
                    yield pa.RecordBatch.from_arrays(cols, names=names)

    more = ", raw binary, copies long, filters binary" if payload else ""
    return (distinct.select("dim", F.col("label").cast("string").alias("label_key"), "cid", "raw", "copies")
            .mapInArrow(run, f"space string, filter int, cid binary{more}"))


def _owned(same: np.ndarray, lists_a: list[np.ndarray], lists_b: list[np.ndarray], filter_: int) -> np.ndarray:
    """``same`` without the pairs that share a filter before ``filter_``."""
    early = [[x[x < filter_] for x in lists] for lists in (lists_a, lists_b)]
    common = np.intersect1d(np.concatenate(early[0]), np.concatenate(early[1]))
    if not len(common):
        return same
    has = []
    for lists in early:
        m = np.zeros((len(lists), len(common)), dtype=np.float32)
        row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        flat = np.concatenate(lists)
        at = np.minimum(np.searchsorted(common, flat), len(common) - 1)
        ok = common[at] == flat
        m[row[ok], at[ok]] = 1
        has.append(m)
    return same & (has[0] @ has[1].T == 0)


def vector_links(distinct: DataFrame, kind, cosine: float = COSINE) -> DataFrame:
    """u and n (copies of other classes linked to u), and u and v: a forest of the links."""
    largest = distinct.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0
    sizes = decoded(distinct, largest, kind, False).groupBy("space", "filter").count().where("count > 1")
    sizes = sizes.select("space", "filter", (F.col("count") / F.lit(BLOCK) + 1).cast("int").alias("blocks"))
    rows = decoded(distinct, largest, kind, True).join(sizes, ["space", "filter"])
    rows = rows.withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    group = F.xxhash64("space", "filter", F.least("block", "other"), F.greatest("block", "other"))
    side = F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2)
    rows = rows.select(group.alias("group"), side.alias("side"), "filter", "cid", "raw", "copies", "filters")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _by_group(batches, "group"):
            within = g["side"].iloc[0] == 0
            a, b = (g, g) if within else (g[g["side"] == 1], g[g["side"] == 2])
            if len(a) < 1 + within or not len(b):
                continue
            xa, xb = unit_rows(a["raw"].tolist(), kind), unit_rows(b["raw"].tolist(), kind)
            same = xa @ xb.T >= cosine
            if within:
                same = np.triu(same, 1)
            if not same.any():
                continue
            lists = [[np.frombuffer(f, dtype=np.int32) for f in x["filters"]] for x in (a, b)]
            same = _owned(same, *lists, int(g["filter"].iloc[0]))
            if not same.any():
                continue
            ca, cb = a["cid"].tolist(), b["cid"].tolist()
            of_a, of_b = same @ b["copies"].to_numpy(), same.T @ a["copies"].to_numpy()
            i, j = np.nonzero(same)
            tree = forest([(p, q if within else len(ca) + q) for p, q in zip(i.tolist(), j.tolist())])
            names = ca if within else ca + cb
            us = [c for c, n in zip(ca, of_a) if n] + [c for c, n in zip(cb, of_b) if n]
            ns = [int(n) for n in of_a if n] + [int(n) for n in of_b if n]
            yield pa.RecordBatch.from_arrays([pa.array(us + [names[p] for p, _ in tree], pa.binary()),
                                              pa.array([None] * len(us) + [names[q] for _, q in tree], pa.binary()),
                                              pa.array(ns + [0] * len(tree), pa.int64())], names=["u", "v", "n"])

    return rows.repartition("group").sortWithinPartitions("group").mapInArrow(compare, "u binary, v binary, n long")


def near_vectors(table: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row."""
    keyed, kind = keyed_vectors(table)
    keyed = stage(keyed, "cap-vectors")
    distinct = stage(keyed.where("cid IS NOT NULL").groupBy("cid").agg(
        F.first("label").alias("label"), F.first("dim").alias("dim"), F.first("raw").alias("raw"),
        F.count("*").alias("copies"), F.min("vec_id").alias("least")), "cap-distinct")
    found = stage(vector_links(distinct, kind, cosine), "cap-links")
    counted = found.where("v IS NULL").groupBy(F.col("u").alias("cid")).agg(F.sum("n").alias("n"))
    node = F.xxhash64("cid")  # links and components are kept by number
    label = components(found.where("v IS NOT NULL").select(F.xxhash64("u").alias("u"), F.xxhash64("v").alias("v"))).select(F.col("node").alias("nid"), F.col("label").alias("top"))
    of = (distinct.select("cid", "copies", "least", node.alias("nid")).join(counted, "cid", "left").join(label, "nid", "left")
          .withColumn("top", F.coalesce("top", "nid")))
    ids = of.groupBy("top").agg(F.min("least").alias("component_id"))
    of = of.join(ids, "top").select("cid", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"), "component_id")
    out = keyed.select("vec_id", "cid").join(of, "cid", "left")
    component = F.when(F.col("cid").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


@query("op2_embedding_dedup")
def op2_embedding_dedup(spark, sf_dir):
    """Links and components of all vectors of ``embeddings``."""
    return near_vectors(load(spark, sf_dir, "embeddings"))
