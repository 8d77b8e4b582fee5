"""Token packing, chat formatting, licences, mixing, quality rules, classifier."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from riskloom.llm import chat_format, license_scan, line_crf, mix_sources, quality_rules, token_pack

from .conftest import make_documents, prose


@pytest.mark.parametrize("bits", [1, 5, 13, 15, 16, 17, 18, 24, 31])
def test_packing_round_trip(bits):
    for n in (0, 1, 7, 8, 9, 1000):
        ids = np.random.default_rng(n).integers(0, 1 << bits, n).astype(np.uint32)
        raw = token_pack.pack(ids, bits)
        assert bits == 16 or len(raw) == -(-n // 8) * bits
        assert (token_pack.unpack(raw, n, bits) == ids).all()


def test_tokens_match_the_library(spark, documents, corpus):
    import public_tokenizers
    from tokenizers import Tokenizer
    tk = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    odd = [(70, "  two  spaces\n and\t tabs   end ", "en", "s"), (71, "a<|endoftext|> b <|endoftext|>", "en", "s"), (72, " lead", "en", "s"),
           (73, "x  y　 z don't  'll\r\n  it's", "en", "s"), (74, "᠎ \x1c q " + "z" * 500 + " z", "en", "s")]
    rows = sorted(corpus + odd, key=lambda r: r[0])
    got = token_pack.encode_and_read(make_documents(spark, corpus + odd).repartition(3), block_ids=500).orderBy("start").collect()
    assert [r.doc_id for r in got] == [r[0] for r in rows]
    at = 0
    for r, (_, text, *_x) in zip(got, rows):
        ids = tk.encode(text or "", add_special_tokens=False).ids + [2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def token_corpus(spark, rows):
    path = token_pack.scratch_path(spark, "test-tokens")
    token_pack.write_tokens(make_documents(spark, rows), path, block_ids=300)
    return path


def test_any_ids_are_read_alone(spark, corpus):
    import public_tokenizers
    from tokenizers import Tokenizer
    tk = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = sorted((r for r in corpus if r[0] < 65), key=lambda r: (r[0], r[1] or ""))
    lists = [(r[0], tk.encode(r[1] or "", add_special_tokens=False).ids + [2]) for r in rows]
    path, every = token_corpus(spark, rows), [x for _, ids in lists for x in ids]
    for first, end in ((0, 1), (5, 5), (1, 20), (290, 1000), (len(every) - 3, len(every) + 50), (0, len(every))):
        got = token_pack.read_ids(spark, path, first, end).orderBy("start").collect()
        assert [x for r in got for x in r.ids] == every[first:end]
    want = sorted((d, ids) for d, ids in lists if d in (5, 60, 3))
    assert sorted((r.doc_id, r.ids) for r in token_pack.read_documents(spark, path, [5, 60, 3, 999]).collect()) == want
    assert token_pack.read_documents(spark, path, []).collect() == []
    for bits in (5, 13, 16, 17):
        ids = np.random.default_rng(bits).integers(0, 1 << bits, 100).astype(np.uint32)
        for a, b in ((0, 100), (3, 4), (8, 16), (7, 93), (50, 50)):
            assert (token_pack.unpack_between(token_pack.pack(ids, bits), bits, a, b) == ids[a:b]).all()


def test_full_cache_and_cut_texts(monkeypatch):
    """A cache too small for a batch, white space of all kinds, long words and marks: always the library's ids."""
    import random
    import public_tokenizers
    import pyarrow as pa
    from tokenizers import Tokenizer
    path, rng = public_tokenizers.path("byte_bpe_50k.json"), random.Random(3)
    tk = Tokenizer.from_file(path)
    monkeypatch.setattr(token_pack, "MAX_CACHED", 40)
    enc = token_pack._Encoder(path, 2)
    bits = ["a", "word", "été", "ß", "don't", "x.", "9,", "-.", "...", "'s", "é.", "naïveté;", "verylongwordofmanyletters", "Ωμέγα", "日本", "’", "—", "…",
            "​", "́", "😀", "12:30", "A:", "<b>"]
    gaps = [" "] * 30 + ["\n"] * 4 + ["  ", "\t", "\u00a0", "\u0085", "\u2003", "\u3000", "\u2028", "\u202f", "\u205f", "\u1680", " \n", "\n\n", "\x1c", "\x7f"]
    for _ in range(30):
        texts = [None, "", " ", "\n", "."]
        for _ in range(20):
            texts.append("".join(rng.choice(bits) + rng.choice(gaps[:rng.choice((34, 34, 48))]) for _ in range(rng.randint(1, 30))) + rng.choice(["", "end.", "e"]))
        rng.shuffle(texts)
        batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], ["d", "t"])
        got = []
        for _, data, rows in token_pack._handfuls(batch, 200):
            ids, ends = enc.encode(data, rows)
            got += [ids[a:b].tolist() for a, b in zip([0, *ends[:-1]], ends)]
        assert got == [tk.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]


def test_tokens_of_another_vocabulary(spark, nothing):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    tk = Tokenizer.from_file(path)
    docs = make_documents(spark, [(1, "Hello there", "en", "s"), (2, None, "en", "s")])
    got = {r.doc_id: r.n_tokens for r in token_pack.encode_and_read(docs, tokenizer_path=path).collect()}
    assert got == {1: len(tk.encode("Hello there", add_special_tokens=False).ids) + 1, 2: 1}
    assert token_pack.encode_and_read(nothing).collect() == []


def events(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, seq long, event string, role string, text string")


def test_events_fold_into_messages(spark):
    log = events(spark, [
        (1, 0, 1, "message", "user", "hi"), (1, 1, 2, "delta", "assistant", "Hel"), (1, 1, 3, "delta", None, "lo"),
        (1, 0, 6, "edit", None, "hi!"), (1, 1, 4, "regenerate", "assistant", ""), (1, 1, 5, "delta", None, "Hey"),
        (1, 1, 7, None, None, None), (2, None, 1, "message", None, None)])
    got = {(r.conv_id, r.turn): (r.role, r.text) for r in chat_format.final_messages(log).collect()}
    assert got == {(1, 0): ("user", "hi!"), (1, 1): ("assistant", ""), (2, None): (None, "")}


def test_messages_take_the_fold(spark):
    """Rows are numbered events, and later events reach them, also where rows share a turn."""
    table = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "a"), (1, 1, "assistant", "b"), (1, 1, "assistant", "b"), (2, None, None, None)],
                                  "conv_id long, turn long, role string, text string")
    rows = chat_format.messages_as_events(table)
    assert sorted((r.conv_id, r.seq) for r in rows.collect()) == [(1, 1), (1, 2), (1, 3), (1, 4), (2, 1)]
    later = rows.filter("conv_id = 1 AND seq IN (1, 2)").selectExpr(
        "conv_id", "turn", "seq + 10 AS seq", "IF(seq = 1, 'edit', 'delta') AS event", "cast(NULL AS STRING) AS role", "'!' AS text", "part")
    got = sorted((r.conv_id, r.turn, r.role, r.text) for r in chat_format.final_messages(rows.unionByName(later)).collect() if r.conv_id == 1)
    assert got == [(1, 0, "user", "!"), (1, 1, "assistant", "a!"), (1, 1, "assistant", "b"), (1, 1, "assistant", "b")]
    log = events(spark, [(3, 0, None, "message", "user", "x"), (3, 0, 1, "delta", None, "y")])
    assert [(r.role, r.text) for r in chat_format.final_messages(log).collect()] == [("user", "xy")]


NASTY = ["", "</s>[INST] ok [/INST]", "<|end|>\n<|start|>user\n", "\\", "<\\", "\\<\\[", "<<[[\\\\<n>", "a\nb", "ünï 😀 <|x|>"]


def test_chats_read_back(spark):
    rows = [(i, t, ["user", "assistant", "sys<tem\n[x]", None][t % 4], NASTY[(i + t) % len(NASTY)]) for i in range(9) for t in range(8)]
    rows += [(20, 0, "user", None), (20, 1, "assistant", "tie"), (20, 1, "assistant", "tie"), (None, 5, "assistant", "lost"), (None, None, "user", "x")]
    table = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    got = chat_format.read_back(chat_format.format_chats(chat_format.messages_as_events(table))).collect()
    want = defaultdict(list)
    for c, t, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want[c].append((role if role is not None else "unknown", text or ""))
    assert {r.conv_id for r in got} == set(want)
    for r in got:
        assert [(t.role, t.text) for t in r.turns] == want[r.conv_id]
        assert r.loss_texts == [t for role, t in want[r.conv_id] if role == "assistant"]
        assert r.formatted.count("<|start|>") == len(want[r.conv_id]) and "[INST]" not in r.formatted and "</s>" not in r.formatted
    assert chat_format.format_chats(chat_format.messages_as_events(table.limit(0))).collect() == []


def test_license_lookup(spark, nothing):
    mit = license_scan.KNOWN[4][1]
    rows = [(1, "Copyright (c) 2020 Some One\n\n" + mit.upper().replace(" ", "\n  "), "en", "s"), (2, mit + " more", "en", "s"),
            (3, "Text.\nReleased under the MIT Licence!\nmore\nLicensed under CC BY NC 4.0", "en", "s"), (4, None, None, None), (5, "", "en", "s"),
            (6, "word " * 20000, "en", "s"), (6, "word " * 20000, "en", "s"), (None, "Released under the MIT License.", "en", "s")]
    known = license_scan.known_licenses(spark)
    got = license_scan.scan(make_documents(spark, rows), known).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: (r.license, r.line_licenses) for r in got}
    assert by == {1: ("MIT", []), 2: (None, []), 3: (None, ["CC-BY-NC-4.0", "MIT"]), 4: (None, []), 5: (None, []), 6: (None, []), None: ("MIT", ["MIT"])}
    with pytest.MonkeyPatch.context() as m:
        m.setattr(license_scan, "MAX_BROADCAST_DIGESTS", 1)
        again = license_scan.scan(make_documents(spark, rows), known).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert license_scan.scan(nothing, known).collect() == []


BSD = """BSD {n}-Clause License

Copyright (c) 2021, Some One
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
{third}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
THIRD = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""


def test_whole_license_files(spark):
    """Files as they are published: title, copyright line, wrapped lines; SQL agrees on their digests."""
    import pathlib

    import duckdb

    from riskloom.llm import oracles
    mit = license_scan.KNOWN[4][1]
    files = [("BSD-2-Clause", BSD.format(n=2, third="")), ("BSD-3-Clause", BSD.format(n=3, third=THIRD)),
             ("MIT", "MIT License\n\nCopyright (c) 2019 Some One\n\n" + mit), ("MIT", "The MIT Licence (MIT)\r\n\r\nCopyright \u00a9 Some One\r\n" + mit),
             ("ISC", "ISC License\n\nCopyright 2004-2010 by Some One\n" + license_scan.KNOWN[5][1]), (None, "MIT License"), (None, mit[:-20])]
    folder = pathlib.Path("/usr/share/common-licenses")  # where the system has the published texts
    for name, file in (("Apache-2.0", "Apache-2.0"), ("GPL-2.0", "GPL-2"), ("GPL-3.0", "GPL-3"), ("LGPL-2.1", "LGPL-2.1"),
                       ("LGPL-3.0", "LGPL-3"), ("MPL-2.0", "MPL-2.0"), ("CC0-1.0", "CC0-1.0"), ("BSD-3-Clause", "BSD")):
        if (folder / file).exists():
            text = (folder / file).read_text(encoding="utf-8")
            files += [(name, text), (name, text.replace("\n", "\r\n"))]
    docs = make_documents(spark, [(i, t, "en", "s") for i, (_, t) in enumerate(files)])
    got = {r.doc_id: r for r in license_scan.scan(docs, license_scan.known_licenses(spark)).collect()}
    assert [got[i].license for i in range(len(files))] == [name for name, _ in files]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents(doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [(i, t) for i, (_, t) in enumerate(files)])
    sql = con.execute(f"SELECT doc_id, license, digest FROM ({oracles.SQL['op5_license_scan']})").fetchall()
    assert {(i, name, d) for i, name, d in sql} == {(i, r.license, r.digest) for i, r in got.items()}


def test_mixture_reaches_targets(spark):
    import random
    rng = random.Random(2)
    rows = [(i, prose(rng, rng.randint(0, 60)), "en", ["a", "b", "c", None][min(3, int(rng.random() ** 2 * 4))]) for i in range(800)]
    rows += [(900, None, "en", "a"), (901, "", "en", "empty"), rows[7], (None, "one two", "en", "b")]
    docs = make_documents(spark, rows)
    out = mix_sources.allot(docs).select("row.doc_id", "row.source", "size", "source_size", "target", F.size("takes").alias("n"),
                                         F.transform("takes", lambda t: t.shard).alias("shards")).toPandas()
    assert len(out) == len(rows)
    sizes = defaultdict(int)
    for _, t, _, s in rows:
        sizes[s] += len((t or "").split())
    want = mix_sources.targets(list(sizes.items()))
    assert abs(sum(want.values()) - sum(sizes.values())) < 1e-6 and all(want[s] <= 3 * sizes[s] + 1e-9 for s in sizes)
    for s, part in out.groupby(out.source.fillna("none")):
        key = None if s == "none" else s
        assert (part.source_size == sizes[key]).all() and (abs(part.target - want[key]) < 1e-9).all()
        assert abs((part["size"] * part.n).sum() - want[key]) <= 15
    assert (out.n <= 3).all() and {x for row in out.shards for x in row} == set(range(mix_sources.SHARDS))
    mixed = mix_sources.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == out.n.sum()
    again = mix_sources.mix(docs.repartition(5))
    assert sorted(map(str, mixed.collect())) == sorted(map(str, again.collect()))
    assert mix_sources.mix(docs.limit(0)).collect() == []


def test_mixture_takes_a_rest_of_a_whole_epoch(spark):
    """Targets half a word or less below whole multiples of the source's size."""
    rows = [(i, "a b", "en", "a") for i in range(5)] + [(10 + i, "a b", "en", "b") for i in range(9)] + [(20, "a", "en", "b")]
    docs = make_documents(spark, rows)
    for want, taken in ((9.7, 10), (19.7, 20), (29.7, 30), (30.0, 30)):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(mix_sources, "targets", lambda *a, want=want: {"a": want, "b": 7.0})
            got = mix_sources.allot(docs).filter("row.source = 'a'").selectExpr("sum(size * size(takes)) AS n").first().n
        assert got == taken


def test_mixture_of_null_ids(spark):
    """Rows without an id are units of their own: a source of them meets its target."""
    import random
    rng = random.Random(6)
    rows = [(None, prose(rng, 5), "en", "a") for _ in range(200)] + [(7, prose(rng, 5), "en", "b") for _ in range(200)]
    rows += [(i, prose(rng, 5), "en", "c") for i in range(200)]
    got = mix_sources.allot(make_documents(spark, rows)).selectExpr("row.source", "size * size(takes) AS n", "target")
    for r in got.groupBy("source", "target").sum("n").collect():
        assert r.target in (500, 1000, 1500) and abs(r["sum(n)"] - r.target) <= 5


def test_shards_hold_the_blocks_of_the_tree(spark, monkeypatch):
    """Each (source, epoch, block) lies in one shard, and a shard holds no more blocks than the tree gave it."""
    import random
    rng, drawn = random.Random(9), []
    tree = mix_sources.splitting_tree

    def kept(quotas, shards, generator):
        out = tree(quotas, shards, generator)
        drawn.append(out)
        return out
    monkeypatch.setattr(mix_sources, "splitting_tree", kept)
    rows = [(i, prose(rng, rng.randint(1, 20)), "en", "abc"[i % 3]) for i in range(900)]
    docs = make_documents(spark, rows)
    taken = mix_sources.allot(docs, shards=4).selectExpr("row.doc_id", "row.text", "row.source", "inline(takes)").toPandas()
    quotas = max(drawn, key=len)
    assert quotas.shape == (4, 3) and taken.shard.between(0, 3).all()
    keys = mix_sources.sized(docs).selectExpr("row.doc_id", "substring(_key, 1, 3) AS block").toPandas()
    taken = taken.merge(keys, on="doc_id")
    # the last block of a partial epoch also takes the closing document
    partial = taken.groupby("source").epoch.transform("max") == taken.epoch
    whole = taken[~partial].drop_duplicates(["source", "epoch", "block"])
    assert (taken[~partial].groupby(["source", "epoch", "block"]).shard.nunique() == 1).all()
    counts = whole.groupby(["shard", "source"]).size().unstack(fill_value=0).reindex(index=range(4), columns=list("abc"), fill_value=0)
    assert (counts.to_numpy() <= quotas).all() and len(whole) > 100


def test_splitting_tree_is_exact():
    quotas = np.array([1000, 0, 7, 123456])
    tree = mix_sources.splitting_tree(quotas, 13, np.random.default_rng(0))
    assert (tree.sum(axis=0) == quotas).all() and tree.min() >= 0 and len(tree) == 13
    share = tree.sum(axis=1) / quotas.sum()
    assert abs(share - 1 / 13).max() < 0.001


def brute_rules(text):
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = defaultdict(list)
    for i in range(len(words) - 2):
        grams[tuple(words[i:i + 3])].append(i)
    covered = {i + j for at in grams.values() if len(at) > 1 for i in at for j in range(3)}
    base = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), base)


def test_rule_counts_match_brute_force(spark, documents, corpus, nothing):
    more = [(80, "a b c a b c a b", "en", "s"), (81, "x y z\nx y z\n\n \nx y z", "en", "s"), (82, "#* $a |<b> &%" * 30, "xx", "s")]
    rows = corpus + more
    got = quality_rules.judge(make_documents(spark, rows)).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()
    want = sorted((i if i is not None else -1, *brute_rules(t)) for i, t, *_ in rows)
    assert sorted(tuple(r)[:7] for r in got) == want
    assert not any(r.kept and r.base_failed for r in got) and any(r.kept for r in got)
    kept = quality_rules.keep_good(documents)
    assert kept.columns == documents.columns
    assert quality_rules.judge(nothing).collect() == []


def test_distances_reject_another_distribution(spark):
    import random
    rng = random.Random(4)
    common = quality_rules.COMMON_WORDS["en"]

    def clean(n):
        return " ".join(rng.choice(common) if rng.random() < 0.5 else prose(rng, 1) for _ in range(n)) + "."
    rows = [(i, clean(rng.randint(60, 300)), "en", "s") for i in range(60)]
    rows += [(100, " | ".join(prose(rng, 1) for _ in range(300)), "en", "s"), (101, clean(200).upper().replace(" ", "!!# "), "en", "s")]
    kept = {r.doc_id for r in quality_rules.keep_good(make_documents(spark, rows)).collect()}
    assert kept == set(range(60))


@pytest.mark.parametrize("kind", ["source", "long"])
def test_reference_withstands_junk(spark, kind):
    """A third of the rows from one junk source, with copies, or one junk text longer than its language."""
    import random
    rng = random.Random(8)
    common = quality_rules.COMMON_WORDS["es"]

    def clean(n):
        return " ".join(rng.choice(common) if rng.random() < 0.5 else prose(rng, 1) for _ in range(n)) + "."

    def junk(n):
        return " ".join(f"$${rng.randrange(10 ** 6)}|" for _ in range(n))
    rows = [(i, clean(rng.randint(60, 300)), "es", "s") for i in range(60)]
    rows += [(100 + i, junk(rng.randint(300, 600)), "es", "junk") for i in range(25)] if kind == "source" else [(100, junk(60_000), "es", "junk")]
    rows += rows[-1:] * 5
    kept = {r.doc_id for r in quality_rules.keep_good(make_documents(spark, rows)).collect()}
    assert kept == set(range(60))


def test_marginals_match_enumeration():
    import itertools
    rng = np.random.default_rng(0)
    trans = rng.normal(size=(2, 2))
    scores, lengths = rng.normal(size=(3, 5)), np.array([5, 3, 1])
    p, pairs, log_z = line_crf.marginals(scores, lengths, trans)
    want_pairs, want_z = np.zeros((2, 2)), 0.0
    for d, n in enumerate(lengths):
        weight = {y: np.exp(sum(scores[d, i] * y[i] for i in range(n)) + sum(trans[y[i], y[i + 1]] for i in range(n - 1)))
                  for y in itertools.product((0, 1), repeat=int(n))}
        z = sum(weight.values())
        want_z += np.log(z)
        for i in range(n):
            assert abs(p[d, i] - sum(w for y, w in weight.items() if y[i]) / z) < 1e-9
        for y, w in weight.items():
            for i in range(n - 1):
                want_pairs[y[i], y[i + 1]] += w / z
    assert np.allclose(pairs, want_pairs) and abs(log_z - want_z) < 1e-9


def test_classifier_learns_and_holds_out(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    extra = spark.createDataFrame([(10 ** 6, None, "en", "s", 0), (10 ** 6 + 1, "", "en", "s", 0), (10 ** 6 + 2, "x " * 50000, "en", "s", 0)], docs.schema)
    got = line_crf.classify(docs.unionByName(extra), labels).toPandas()
    assert len(got) == docs.count() + 3 and got.score.between(0, 1).all()
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    assert (got.predicted == (got.score >= 0.3)).all()
    known = got.merge(labels.toPandas(), on="doc_id")
    assert (known.predicted == known.quality).mean() > 0.9


def test_classifier_without_labels(spark, documents, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in line_crf.classify(documents, none).collect()} == {0.5}
    one = spark.createDataFrame([(i, 1) for i in range(30)] + [(31, None), (None, 0)], "doc_id long, quality int")
    scores = [r.score for r in line_crf.classify(documents, one).collect()]
    assert max(scores) - min(scores) < 1e-9 and min(scores) > 0.9
    assert line_crf.classify(nothing, one).collect() == []


def test_classifier_sample_is_bounded_under_a_hot_id(spark):
    """A labelled doc_id with half of the rows: repeats count once, and the sample keeps its bound."""
    import random
    rng = random.Random(4)
    rows = [(i, prose(rng, 30) + ".\n" + prose(rng, 20), "en", "s") for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    plain = line_crf.fit(make_documents(spark, rows), labels)
    hot = next(i for i in range(60) if zlib.crc32(str(i).encode()) % 5)
    repeated = line_crf.fit(make_documents(spark, rows + [rows[hot]] * 60), labels)
    own, weight, first = line_crf.line_features(pa.array([t for _, t, *_ in rows]))
    assert np.allclose(plain.scores(own, weight, first), repeated.scores(own, weight, first))
    seen = []
    with pytest.MonkeyPatch.context() as m:
        train = line_crf.train
        m.setattr(line_crf, "train", lambda own, weight, first, label: seen.append(len(label)) or train(own, weight, first, label))
        line_crf.fit(make_documents(spark, rows + [(hot, prose(rng, 10), "en", "s") for _ in range(80)]), labels, sample=20)
    assert seen == [20]
