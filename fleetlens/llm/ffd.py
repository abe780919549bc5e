"""First-fit-decreasing packing with a tournament tree of bin capacities, in randomised groups.

1. Tasks tokenise whole texts. A document of more than ``capacity`` ids gives full sequences and a
   remainder; full ones leave their task as numbers only, remainders with their ids.
2. Every row is dealt to a group by a hash of its id and its place in the input, so that rows of
   one id are spread too. The number of groups follows from the bytes of all texts: a group holds
   about ``GROUP_BYTES`` of text whatever the corpus, and groups are packed independently.
3. Within a group the remainders, longest first, go each into the first bin with room for it. The
   tree over the bins' free capacities holds the larger child at every node, so that bin is found
   on one path from the root.
4. Documents may be cut, so what first fit leaves open is filled from the emptiest bins: their
   last pieces move, cut where a gap ends. One bin stays open; its ids become sequences whose
   lengths are powers of two, which need no padding. So a group is packed without any padding.

Defined results: a null or empty text is the end id alone; repeated rows are packed each, ties in
length by input order within the group; an empty table gives no rows; other columns are ignored.
The same files read with the same settings give the same packing.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetlens.llm.common import load, query
from fleetlens.llm.textvec import slices
from fleetlens.llm.wordpieces import WordEncoder

CAPACITY = 4096
END_ID = 2
VOCABULARY = "word_bpe_49k.json"
GROUP_BYTES = 4 << 20
ROW_BYTES = 64  # what a row without any text counts, so that short rows are bounded too

Piece = tuple[int, int, int]  # item, first id within it, ids


class Tournament:
    """Free capacity of up to ``bins`` bins; every inner node holds the larger one of its children."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(bins - 1, 0).bit_length()
        self.free = [capacity] * (2 * self.leaves)

    def first(self, size: int) -> int:
        """The first bin with ``size`` free; the root must have it."""
        free, node = self.free, 1
        while node < self.leaves:
            node *= 2
            if free[node] < size:
                node += 1
        return node - self.leaves

    def take(self, at: int, size: int) -> None:
        free, node = self.free, at + self.leaves
        free[node] -= size
        while node > 1:
            node //= 2
            larger = max(free[2 * node], free[2 * node + 1])
            if free[node] == larger:
                break
            free[node] = larger


def first_fit_decreasing(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Items of each bin, in the order in which they were placed; equal lengths in input order."""
    tree, bins = Tournament(len(lengths), capacity), []
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at = tree.first(lengths[item])
        tree.take(at, lengths[item])
        if at == len(bins):
            bins.append([])
        bins[at].append(item)
    return bins


def topped_up(bins: list[list[int]], lengths: list[int], capacity: int = CAPACITY) -> tuple[list[list[Piece]], list[Piece]]:
    """Full bins, and the pieces that are left (fewer than ``capacity`` ids).

    The emptiest bins give their pieces to the gaps of the fullest, cut where a gap ends.
    """
    held = [[(i, 0, lengths[i]) for i in b] for b in bins]
    used = [sum(lengths[i] for i in b) for b in bins]
    order = sorted(range(len(bins)), key=lambda b: -used[b])
    low, high = 0, len(order) - 1
    while low < high:
        to, giver = order[low], order[high]
        gap = capacity - used[to]
        if not gap:
            low += 1
        elif not used[giver]:
            high -= 1
        else:
            item, first, n = held[giver].pop()
            moved = min(n, gap)
            held[to].append((item, first + n - moved, moved))
            if n > moved:
                held[giver].append((item, first, n - moved))
            used[to] += moved
            used[giver] -= moved
    full = [held[b] for b in order if used[b] == capacity]
    rest = [p for b in order if used[b] < capacity for p in held[b]]
    return full, rest


def by_powers_of_two(rest: list[Piece]) -> list[list[Piece]]:
    """The pieces cut into sequences whose lengths are the powers of two in their sum, the largest first."""
    left, out = list(rest), []
    total = sum(n for _, _, n in rest)
    for bit in reversed(range(total.bit_length())):
        need, sequence = total & (1 << bit), []
        while need:
            item, first, n = left.pop()
            got = min(n, need)
            sequence.append((item, first, got))
            if n > got:
                left.append((item, first + got, n - got))
            need -= got
        if sequence:
            out.append(sequence)
    return out


def tokenised(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, place, start, length, doc_tokens of every full sequence (``ids`` null) and every remainder (with its ids, uint16)."""
    if vocabulary is None:
        import public_tokenizers
        vocabulary = public_tokenizers.path(VOCABULARY)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "place", "start", "length", "doc_tokens", "ids_crc32", "ids"]
    kinds = [pa.int64()] * 5 + [pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(vocabulary)
        end = np.array([end_id], dtype="<u2")
        for batch in slices(batches):
            rows, out = [], []
            for row, (text, place) in enumerate(zip(batch.column("text"), batch.column("place").to_pylist())):
                ids = np.concatenate([encoder.ids(text.as_py()), end])
                whole = len(ids) // capacity * capacity
                for start in range(0, whole, capacity):
                    rows.append(row)
                    out.append((place, start, capacity, len(ids), crc(ids[start:start + capacity]), None))
                if whole < len(ids):
                    rows.append(row)
                    out.append((place, whole, len(ids) - whole, len(ids), None, ids[whole:].tobytes()))
            cols = [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(rows, pa.int64())), *cols], names=names)

    source = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("place"))
    return source.mapInArrow(run, f"doc_id {id_type}, place long, start long, length long, doc_tokens long, ids_crc32 long, ids binary")


def crc(ids: np.ndarray) -> int:
    """crc32 of the ids as little-endian unsigned 32-bit numbers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def group_count(docs: DataFrame, group_bytes: int = GROUP_BYTES) -> int:
    size = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + ROW_BYTES).alias("n")).first()["n"]
    return 1 + (size or 0) // group_bytes


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
         group_bytes: int = GROUP_BYTES) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. ``capacity`` is a power of two."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    groups = group_count(docs, group_bytes)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def packed(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("place", "ascending"), ("start", "ascending")])
        group = table.column("group")[0].as_py()
        start, length, sums, ids = (table.column(c).to_pylist() for c in ("start", "length", "ids_crc32", "ids"))
        whole = [i for i, x in enumerate(ids) if x is None]
        cut = [i for i, x in enumerate(ids) if x is not None]
        full, rest = topped_up(first_fit_decreasing([length[i] for i in cut], capacity), [length[i] for i in cut], capacity)
        sequences = [[(i, 0, capacity)] for i in whole] + [[(cut[i], a, n) for i, a, n in s] for s in full + by_powers_of_two(rest)]
        rows, out = [], []
        for k, sequence in enumerate(sequences):
            offset = 0
            for i, a, n in sequence:
                rows.append(i)
                out.append((start[i] + a, n, sums[i] if ids[i] is None else crc(np.frombuffer(ids[i], "<u2")[a:a + n]), (group << 32) + k, offset))
                offset += n
        at, cols = pa.array(rows, pa.int64()), [pa.array([r[i] for r in out], pa.int64()) for i in range(5)]
        return pa.table([table.column("doc_id").take(at), *cols[:3], table.column("doc_tokens").take(at), *cols[3:]], names=names)

    rows = tokenised(docs, vocabulary, capacity, end_id).withColumn("group", F.pmod(F.xxhash64("doc_id", "place", "start"), F.lit(groups)))
    return rows.groupBy("group").applyInArrow(packed, f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


@query("op12_ffd_packing")
def op12_ffd_packing(spark, sf_dir):
    """Pack the whole ``documents`` table into sequences of up to 4,096 ids."""
    return pack(load(spark, sf_dir, "documents"))
