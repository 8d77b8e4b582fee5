"""Substring and suffix dedup against brute force; rolling helpers."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from pyspark.sql import functions as F

from riskloom.llm import rolling, substring_dedup, suffix_dedup


def covered(counts, items, window):
    gone, last = [False] * len(items), None
    for i in range(len(items)):
        if i + window <= len(items) and counts[tuple(items[i:i + window])] > 1:
            last = i
        gone[i] = last is not None and i - last < window
    return gone


def expected(lists, window):
    counts = Counter(tuple(x[i:i + window]) for x in lists for i in range(len(x) - window + 1))
    return [covered(counts, x, window) for x in lists]


def test_substring_dedup_matches_brute_force(documents, corpus):
    window = 9
    lists = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t, _, _ in corpus]
    want = Counter()
    for (i, *_), words, gone in zip(corpus, lists, expected(lists, window)):
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        want[i, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    out = substring_dedup.dedupe(documents, window=window, k=4).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256)).collect()
    assert Counter(tuple(r) for r in out) == want
    assert sum(k[2] for k in want) > 1000


@pytest.mark.parametrize("bucket", [8192, 7])
def test_suffix_dedup_matches_brute_force(documents, corpus, bucket, monkeypatch):
    """Small buckets put many splitters inside groups of equal leading bytes."""
    length = 40
    monkeypatch.setattr(suffix_dedup, "BUCKET_SUFFIXES", bucket)
    lists = [(t or "").encode() for _, t, _, _ in corpus]
    want = Counter()
    for (i, *_), raw, gone in zip(corpus, lists, expected(lists, length)):
        g = np.array(gone, int)
        spans = int((np.diff(np.concatenate([[0], g])) == 1).sum())
        kept = bytes(b for b, x in zip(raw, gone) if not x)
        want[i, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    out = suffix_dedup.dedupe(documents, length=length, k=12).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()
    assert Counter(tuple(r) for r in out) == want


def test_empty_table(nothing):
    assert substring_dedup.dedupe(nothing).collect() == []
    assert suffix_dedup.dedupe(nothing).collect() == []


def test_multikey_sort_is_lexicographic():
    rng = np.random.default_rng(0)
    rows = rng.integers(0, 3, (500, 21)).astype(np.uint8)
    order, common = suffix_dedup.multikey_sort(rows)
    listed = [bytes(rows[i]) for i in order]
    assert listed == sorted(bytes(r) for r in rows)
    for i in range(1, 500):
        same = 0
        while same < 21 and listed[i][same] == listed[i - 1][same]:
            same += 1
        assert common[i] == same


def test_sliding_argmin_takes_the_leftmost():
    keys = np.random.default_rng(1).integers(0, 5, 3000).astype(np.uint64) << np.uint64(40)
    for w in (1, 2, 7, 24, 137):
        want = [i + int(np.argmin(keys[i:i + w])) for i in range(len(keys) - w + 1)]
        assert rolling.sliding_argmin(keys, w).tolist() == want


def test_word_bounds_do_not_cross_texts():
    import pyarrow as pa
    data, rows = rolling.text_bytes(pa.array(["ab c", None, "", "d", " e\n"]))
    starts, ends, first = rolling.word_bounds(data, rows)
    words = [bytes(data[a:b]) for a, b in zip(starts, ends)]
    assert words == [b"ab", b"c", b"d", b"e"] and first.tolist() == [0, 2, 2, 2, 3, 4]
    h = rolling.word_hashes(data, starts, ends)
    assert len(set(h.tolist())) == 4
