"""Near-duplicates and decontamination against brute force."""

import re
from collections import Counter

import numpy as np
import pytest

from riskloom.llm import decontaminate, near_dedup

from .conftest import make_documents, prose


def shingles(text, n):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(words) < n:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1))


def brute_components(rows, n, percent=80):
    sets = [shingles(t, n) for _, t, *_ in rows]
    ids = [r[0] for r in rows]
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            same_row = ids[a] == ids[b]
            if sets[a] and (same_row or 100 * both >= percent * len(sets[a] | sets[b])):
                label[find(a)] = find(b)
    low = {}
    for i in range(len(rows)):
        low[find(i)] = min(low.get(find(i), 10 ** 9), ids[i])
    return Counter((ids[i], len(sets[i]), low[find(i)]) for i in range(len(rows)))


@pytest.mark.parametrize("n", [2, 5])
def test_links_match_brute_force(documents, corpus, n):
    got = near_dedup.link(documents, shingle=n).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(tuple(r) for r in got) == brute_components(corpus, n)


def hub_and_others(rng, n):
    """Copies of a hub with up to 12 edits, chains that lead away from it, and unlike texts."""
    hub = prose(rng, 80).split(" ")
    rows = [(i, prose(rng, 40), "en", "s") for i in range(40)]
    for i in range(40, 40 + n):
        words = list(hub)
        for _ in range(rng.randint(0, 12)):
            words[rng.randrange(80)] = f"edit{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(words), "en", "s"))
    words = list(hub)
    for i in range(40 + n, 60 + n):  # each text is linked with the one before it, the last ones not with the hub
        for _ in range(3):
            words[rng.randrange(80)] = f"step{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(words), "en", "s"))
    return rows


@pytest.mark.parametrize("chunk", [20, 60])
def test_large_groups_lose_no_link(spark, monkeypatch, chunk):
    """Tree nodes and blocks far above a chunk: star, pairs of chunks of the rest, rest against the star."""
    import random
    rows = hub_and_others(random.Random(3), 160)
    monkeypatch.setattr(near_dedup, "CHUNK", chunk)
    monkeypatch.setattr(near_dedup, "SET_CHUNK", chunk * 80)
    leaves = near_dedup.tree_leaves
    monkeypatch.setattr(near_dedup, "tree_leaves", lambda nodes, trees: leaves(nodes, trees, small=16))
    got = near_dedup.link(make_documents(spark, rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(tuple(r) for r in got) == brute_components(rows, 2)


@pytest.mark.parametrize("limit", [40, 10 ** 6])
def test_star_edges_connect_what_brute_force_connects(spark, limit):
    """On given groups, where no tree decides: the same components at any chunk size."""
    import random
    rng = random.Random(8)
    texts = [t for _, t, *_ in hub_and_others(rng, 120)]
    sets = [sorted({hash(x) % 2 ** 63 for x in shingles(t, 2)}) for t in texts]
    loads = spark.createDataFrame([(i, bytearray(np.array(x, np.uint64).tobytes())) for i, x in enumerate(sets)], "node long, load binary")
    members = spark.createDataFrame([(g, i, 1) for g in (1, 2) for i in range(len(sets)) if g == 1 or i % 3], "group long, node long, weight int")
    for percent in (60, 80, 90):
        edges = near_dedup.star_edges(members, loads, near_dedup.Sets(percent), limit).collect()
        low = list(range(len(sets)))

        def find(x, low=low):
            while low[x] != x:
                x = low[x]
            return x
        for e in edges:
            both = len(set(sets[e.a]) & set(sets[e.b]))
            assert both or percent == 0
            low[max(find(e.a), find(e.b))] = min(find(e.a), find(e.b))
        want = brute_components([(i, t) for i, t in enumerate(texts)], 2, percent)
        assert {i: find(i) for i in range(len(sets))} == {i: c for i, _, c in want}


def test_a_third_of_the_rows_as_near_copies(spark):
    """Production settings; copies of one text with one edit each, exact repeats among them."""
    import random
    rng = random.Random(12)
    hub = prose(rng, 120).split(" ")
    rows = [(i, prose(rng, 60), "en", "s") for i in range(800)]
    for i in range(800, 1200):
        words = list(hub)
        words[rng.randrange(120)] = f"edit{i % 300}"
        rows.append((i, " ".join(words), "en", "s"))
    got = near_dedup.link(make_documents(spark, rows)).select("doc_id", "component_id").collect()
    assert {r.doc_id: r.component_id for r in got} == {i: min(i, 800) for i in range(1200)}


def test_map_columns_and_rows_without_words_pass(spark):
    table = spark.createDataFrame([(1, "a b c", {"x": 1}), (1, "a b c", {"x": 1}), (2, None, {}), (2, None, {}), (3, " ", None)],
                                  "doc_id long, text string, extra map<string, int>")
    assert sorted(r.doc_id for r in near_dedup.keep_one(table).collect()) == [1, 2, 2, 3]


def test_one_document_of_each_group_stays(documents, corpus):
    kept = near_dedup.keep_one(documents)
    assert kept.columns == documents.columns
    want = {i for (i, _, low) in brute_components(corpus, 2) if i == low}
    assert {r.doc_id for r in kept.collect()} == want


def test_null_and_repeated_rows_keep_one_of_each_group(spark):
    """Groups of null doc_ids, of one doc_id and of exact repeats, beside doc_ids that a double cannot hold."""
    import random
    rng = random.Random(6)
    big = 2 ** 53 + 1

    def copies():
        words = prose(rng, 80).split(" ")
        return [" ".join([*words[:79], x]) for x in ("one", "two", "three")]
    null, shared, repeated, mixed, equal = (copies() for _ in range(5))
    rows = [(None, t, "en", "s") for t in null] + [(7, t, "en", "s") for t in shared] + [(big, repeated[0], "en", "s")] * 3
    rows += [(big + 2, repeated[1], "en", "s"), (None, mixed[0], "en", "s"), (big + 4, mixed[1], "en", "s")]
    rows += [(None, equal[0], "en", "s")] * 3 + [(None, None, "en", "s")] * 2
    table = make_documents(spark, rows)
    kept = Counter((r.doc_id, next((n for n, g in (("null", null), ("shared", shared), ("equal", equal)) if r.text in g), r.text))
                   for r in near_dedup.keep_one(table).collect())
    assert kept == {(None, "null"): 1, (7, "shared"): 1, (big, repeated[0]): 1, (big + 4, mixed[1]): 1, (None, "equal"): 1, (None, None): 2}
    got = {r.component_id for r in near_dedup.link(table).collect()}
    assert got == {None, 7, big, big + 4}


def test_empty_tables(spark, nothing):
    assert near_dedup.link(nothing).collect() == [] and near_dedup.keep_one(nothing).collect() == []
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.scan(nothing, bench).collect() == []
    assert decontaminate.keep_clean(nothing, bench).collect() == []


def greedy_coverage(doc, item, match):
    """Greedy string tiling by its definition: mark the longest unmarked common run until none has ``match`` words."""
    in_doc, in_item, covered = [False] * len(doc), [False] * len(item), 0
    while True:
        best = (0, 0, 0)
        for a in range(len(doc)):
            for p in range(len(item)):
                n = 0
                while a + n < len(doc) and p + n < len(item) and doc[a + n] == item[p + n] and not in_doc[a + n] and not in_item[p + n]:
                    n += 1
                best = max(best, (n, -a, -p))
        n, a, p = best[0], -best[1], -best[2]
        if n < match:
            return covered / len(item)
        for j in range(n):
            in_doc[a + j] = in_item[p + j] = True
        covered += n


def words_of(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def test_tiling_matches_its_definition(spark):
    import random
    rng = random.Random(9)
    items = [(i, prose(rng, rng.randint(12, 30))) for i in range(6)] + [(6, None), (7, "too short")]
    docs = []
    for i in range(24):
        parts = items[i % 6][1].split(" ")
        cut = rng.randint(3, len(parts) - 3)
        pieces = [parts[cut:], parts[:cut]] if i % 2 else [parts[:cut]]  # passages in another order, or in part
        body = prose(rng, 8)
        for p in pieces:
            body += " " + " ".join(p).upper() + ", " + prose(rng, rng.randint(0, 5))
        docs.append((i, body, "en", "s"))
    docs += [(24, None, None, None), (25, "", "en", "s"), (26, prose(rng, 3000), "en", "s"), (27, (items[0][1] + " ") * 5, "en", "s")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {}
    for i, t, *_ in docs:
        hits = [(k, greedy_coverage(words_of(t), words_of(x), 5)) for k, x in items if len(words_of(x)) >= 5] if t and len(t) < 5000 else []
        want[i] = [(k, c) for k, c in hits if c >= 0.6]
    table = make_documents(spark, docs)
    for block in (10 ** 6, 30):
        with pytest.MonkeyPatch.context() as m:
            blocks = decontaminate.benchmark_blocks
            m.setattr(decontaminate, "benchmark_blocks", lambda b, match, i, t: blocks(b, match, i, t, block))
            got = {r.doc_id: [(x.item_id, x.coverage) for x in r["items"]] for r in decontaminate.scan(table, bench).collect()}
            kept = {r.doc_id for r in decontaminate.keep_clean(table, bench).collect()}
        assert {i: [k for k, _ in v] for i, v in got.items()} == {i: [k for k, _ in v] for i, v in want.items()}
        for i, v in want.items():
            assert np.allclose([c for _, c in v], [c for _, c in got[i]])
        assert kept == {i for i, v in want.items() if not v}
    assert sum(map(bool, want.values())) > 8
