"""First-fit decreasing: the tokenizer's own ids, a plain first fit, and whole results without padding."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from fleetlens.llm import ffd
from fleetlens.llm.common import load
from fleetlens.llm.wordpieces import WordEncoder, parts
from fleetlens_helpers import SF_SMOKE

PATH = public_tokenizers.path(ffd.VOCABULARY)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return WordEncoder(PATH)


def test_ids_equal_the_tokenizer(tokenizer, encoder):
    r = random.Random(1)
    signs = "aabbeeioust'''sStTrRveVEmMlLdD0123.,;-_<|>\"~éÉßÿÀ×÷ªº²Σσςİıẞ́̈\xa0\x1c\x1d\x85 　 漢字かなٱلعربية٣😀힣가ﬁǅ’“…€ \n\t\r\x00\x07\x0b"
    texts = ["".join(r.choice(signs) for _ in range(r.randrange(40))) for _ in range(20000)]
    texts += ["<|endoftext|>a <|startoftext|>", "<|endoftext|", "x<|endoftext|>y it's", "", None, "it's 'sun ''s \"'s we'll l'été", "a" * 5000, "ab\n" * 3000, "é" * 3000]
    texts += ["".join(chr(c) for c in range(a, a + 64)) for a in range(0, 0xD7C0, 64)]
    for text, want in zip(texts, tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)):
        assert encoder.ids(text).tolist() == want.ids, repr(text)


def test_long_texts_are_cut_at_spaces_only(tokenizer, encoder):
    text = " ".join(["some", "words'll", "漢字", "x" * 50] * 200)
    assert " ".join(parts(text, 100)) == text and len(list(parts(text, 100))) > 50
    joined = np.concatenate([np.array(encoder._part(p)) for p in parts(text, 100)])
    assert joined.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def plain_first_fit(lengths, capacity):
    bins, free = [], []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        for b in range(len(bins)):
            if free[b] >= lengths[i]:
                break
        else:
            b = len(bins)
            bins.append([])
            free.append(capacity)
        bins[b].append(i)
        free[b] -= lengths[i]
    return bins


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_tree_equals_plain_first_fit_and_all_is_packed(lengths):
    bins = ffd.first_fit_decreasing(lengths, 64)
    assert bins == plain_first_fit(lengths, 64)
    full, rest = ffd.topped_up(bins, lengths, 64)
    last = ffd.by_powers_of_two(rest)
    assert len(full) == sum(lengths) // 64 and all(sum(n for _, _, n in s) == 64 for s in full)
    assert all(sum(n for _, _, n in s).bit_count() == 1 for s in last)
    seen = sorted((i, a, n) for s in full + last for i, a, n in s)
    for i, length in enumerate(lengths):
        at = 0
        for _, a, n in [p for p in seen if p[0] == i]:
            assert a == at and n > 0
            at += n
        assert at == length


def check(rows, texts, tokenizer, capacity=4096):
    """``texts``: (doc_id, text) pairs with ids that do not repeat."""
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append(r)
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= capacity and at.bit_count() == 1  # no padding
    pieces = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
    assert set(pieces) == {i for i, _ in texts}
    for i, text in texts:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        at = 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    return sequences


def test_whole_table(spark, tokenizer):
    df = load(spark, SF_SMOKE, "documents")
    texts = [(r["doc_id"], r["text"]) for r in df.collect()]
    rows = ffd.pack(df).collect()
    sequences = check(rows, texts, tokenizer)
    total = sum(r["length"] for r in rows)
    assert len(sequences) <= total / 4096 + 12 * ffd.group_count(df)
    assert len(rows) < 2 * len(texts) + total / 4096  # cut only where a gap asks for it


def test_odd_rows_repeated_ids_and_empty_tables(spark, tokenizer):
    long_ = " ".join(f"word{i}" for i in range(9000))
    texts = [(1, None), (2, ""), (3, "a"), (None, "null id"), (4, long_), (5, "<|endoftext|> x"), (6, " \n ")]
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumn("length", ffd.F.lit("clash")).withColumn("Group", ffd.F.lit(1))
    check(ffd.pack(df).collect(), texts, tokenizer)
    check(ffd.pack(df, group_bytes=100).collect(), texts, tokenizer)
    same = spark.createDataFrame([(7, "one two three")] * 500 + [(8, "x")], "doc_id long, text string")
    rows = ffd.pack(same, group_bytes=1000).collect()
    each = len(tokenizer.encode("one two three", add_special_tokens=False).ids) + 1
    assert sum(r["length"] for r in rows if r["doc_id"] == 7) == 500 * each
    assert len({r["sequence_id"] >> 32 for r in rows}) > 5  # one id is spread over groups
    assert ffd.pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_reruns_agree(spark):
    df = load(spark, SF_SMOKE, "documents")
    assert sorted(map(tuple, ffd.pack(df).collect())) == sorted(map(tuple, ffd.pack(df).collect()))
