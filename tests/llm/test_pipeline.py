"""The pipeline against a brute-force version of its stages."""

import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import regex

import corpus_pipeline
from riskloom.llm import mix_sources, oracles, quality_rules as q

from .conftest import make_documents, prose
from .test_formats import brute_rules
from .test_near import brute_components, greedy_coverage, words_of


def histograms(text, lang):
    words = regex.findall(r"[^\x20\x09-\x0D]+", text)
    joined = "".join(words)
    symbols = sum(joined.count(c) for c in q.SYMBOLS)
    upper, letters, digits = (len(regex.findall(p, joined)) for p in (r"\p{Lu}", r"\p{L}", r"\p{N}"))
    chars = [len(text) - len(joined), symbols, upper, letters - upper, digits, len(joined) - symbols - letters - digits]
    plain = regex.findall(r"[^\x20\x09-\x0D]+", "".join(c for c in text if c not in q.STRIPPED).lower())
    found = [plain.count(w) for w in q.COMMON_WORDS.get(lang, [])]
    return np.array(chars, float), np.array(found + [len(plain) - sum(found)], float)


def distance(a, b):
    p, r = a / a.sum(), b / b.sum()
    m = (p + r) / 2
    half = sum(x * np.log2(x / y) for side in (p, r) for x, y in zip(side, m) if x > 0)
    return np.sqrt(max(0, half / 2))


def steps(counts, n):
    return np.floor(counts * float(n) / counts.sum() + 0.5) if counts.sum() else counts


def brute_quality(rows):
    """References: the mean shares of the distinct texts that pass the base rules and lie near the median shares."""
    def far(n, own, ref):
        return (distance(own[0], ref[0]) > q.MAX_CHAR_DISTANCE
                or len(own[1]) > 1 and distance(own[1], ref[1]) > q.MAX_WORD_DISTANCE + q.WORD_NOISE / np.sqrt(n))
    judged = {(r["lang"], r["text"] or ""): (brute_rules(r["text"]), histograms(r["text"] or "", r["lang"])) for r in rows}
    ref, size = {}, {}
    for lang in {lang for lang, _ in judged}:
        texts = [(rule[0], h) for (own, _), (rule, h) in judged.items() if own == lang and not rule[-1]]
        if texts:
            middle = [np.sort([steps(h[k], q.GRID) for _, h in texts], axis=0)[(len(texts) + 1) // 2 - 1] for k in (0, 1)]
            near = [h for n, h in texts if not far(n, h, middle)]
            ref[lang] = [sum(steps(h[k], q.SCALE) for h in near) for k in (0, 1)] if near else middle
            size[lang] = sum(h[1].sum() for _, h in texts)
    for r in rows:
        rule, h = judged[r["lang"], r["text"] or ""]
        if not rule[-1] and (size[r["lang"]] < q.REF_MIN_WORDS or not far(rule[0], h, ref[r["lang"]])):
            yield r


@pytest.mark.parametrize("kind", ["source", "long"])
def test_sql_and_brute_force_of_the_quality_rules_withstand_junk(spark, kind):
    """One definition in the operator, its SQL and the brute force, where junk is hot."""
    rng, common = random.Random(8), q.COMMON_WORDS["es"]

    def clean(n):
        return " ".join(rng.choice(common) if rng.random() < 0.5 else prose(rng, 1) for _ in range(n)) + "."

    def junk(n):
        return " ".join(f"$${rng.randrange(10 ** 6)}|" for _ in range(n))
    rows = [(i, clean(rng.randint(60, 90)), "es", "s") for i in range(60)]
    rows += [(100 + i, junk(rng.randint(300, 600)), "es", "junk") for i in range(25)] if kind == "source" else [(100, junk(6_000), "es", "junk")]
    rows += [(200 + i, *rows[-1][1:]) for i in range(5)]
    rows += [(300 + i, clean(80), None, "s") for i in range(9)] + [(400, junk(90), None, "s"), (401, None, "fr", "s"), (402, clean(70), "xx", "s")]
    docs = make_documents(spark, rows)
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "lang", "source").toPandas())
    sql = {i for i, kept in con.execute(f"SELECT doc_id, kept FROM ({oracles.SQL['op4_quality_rules']})").fetchall() if kept}
    brute = {r["doc_id"] for r in brute_quality([dict(zip(("doc_id", "text", "lang"), r)) for r in rows])}
    got = {r.doc_id for r in q.keep_good(docs).collect()}
    assert got == sql == brute and set(range(60)) <= got and not got & set(range(100, 205))


def test_stages_match_brute_force(spark, sf):
    import public_tokenizers
    from tokenizers import Tokenizer
    got, docs = {}, spark.read.parquet(f"{sf}/documents.parquet")
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(spark, stage(spark, docs, sf), f"test-{name}")
        got[name] = docs.collect()
        assert name == "token_output" or docs.columns == names
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    kept = list(brute_quality(rows))
    assert Counter(r.doc_id for r in got["quality_rules"]) == Counter(r.doc_id for r in kept)
    low = {(i, c) for i, _, c in brute_components([(r.doc_id, r.text) for r in kept], corpus_pipeline.NEAR_SHINGLE, corpus_pipeline.NEAR_PERCENT)}
    kept = [r for r in kept if (r.doc_id, r.doc_id) in low]
    assert Counter(r.doc_id for r in got["near_dedup"]) == Counter(r.doc_id for r in kept)
    bench = [words_of(b.text) for b in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    grams = [{tuple(b[i:i + 5]) for i in range(len(b) - 4)} for b in bench]

    def leaks(words):
        own = {tuple(words[i:i + 5]) for i in range(len(words) - 4)}
        for b, g in zip(bench, grams):
            if len(own & g) * 5 >= 0.6 * len(b):  # fewer shared grams cannot cover the item
                at = [i for i in range(len(words) - 4) if tuple(words[i:i + 5]) in g]
                if greedy_coverage(words[max(0, at[0] - 60):at[-1] + 65], b, 5) >= 0.6:
                    return True
        return False
    kept = [r for r in kept if not leaks(words_of(r.text))]
    assert Counter(r.doc_id for r in got["decontamination"]) == Counter(r.doc_id for r in kept)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in kept:
        sizes[r.source] += len((r.text or "").split())
    for r in got["source_mixture"]:
        taken[r.source] += len((r.text or "").split())
    largest = max(len((r.text or "").split()) for r in kept)
    for s, target in mix_sources.targets(list(sizes.items())).items():
        assert abs(taken[s] - target) <= largest / 2 + 1
    copies = Counter(r.doc_id for r in got["source_mixture"])
    assert set(copies) <= {r.doc_id for r in kept} and max(copies.values()) <= 3
    tk = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    at, want = 0, []
    for r in sorted(got["source_mixture"], key=lambda r: r.doc_id):
        ids = tk.encode(r.text or "", add_special_tokens=False).ids + [2]
        want.append((r.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(tuple(r) for r in got["token_output"]) == sorted(want)


def test_run_gives_the_last_stage(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() > 50
