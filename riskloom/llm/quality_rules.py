"""Quality rules by distribution divergence (operator 4, native).

Each document's histogram over character classes and its histogram over the
common words of its language are compared with the language's reference
histogram by the Jensen-Shannon distance (base 2, 0 to 1). A document is
rejected by the base rules (few words, repeated word windows) or by a distance
over its limit. Distances count only for texts of ``min_words`` words and
references of ``ref_min_words`` words (the minimum-length guards).

A reference does not follow volume: of the distinct texts of a language that
pass the base rules, those near the median share of each bin are kept, and the
reference is the mean of their shares. So neither junk, nor copies, nor long
texts draw it away while they are fewer than half of a language's texts.

Only built-in expressions. Each text is counted once; the counts are written
and serve the references and the verdicts. Shuffled are distinct histograms
(by language and text hash) and counts per language, bin and step.

Defined cases: a null text is an empty one (no words: ``base_failed``); a null
language is a language of its own without common words; a null ``doc_id``
stays null; repeated rows are judged alike, row by row; an empty table gives
no rows. Other columns of the input play no part and may have any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Common words by language (fixed values, most frequent function words).
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "a", "in", "is", "that", "it", "for", "was", "on", "with", "as", "be", "by"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "pour", "est", "par", "qui", "dans"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "nicht"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "se", "del", "las", "un", "con", "por", "no", "su", "una"],
}
N_COMMON = 16
SYMBOLS = "#*$%&|<>"
#: Stripped before words are looked up among the common ones.
STRIPPED = '.,;:!?"()' + SYMBOLS
#: space, symbol, upper-case letter, other letter, digit, other
N_CHAR_CLASSES = 6

MIN_WORDS = 50
REPEAT_PERCENT = 50
MAX_CHAR_DISTANCE = 0.28
#: the word limit falls with length: MAX_WORD_DISTANCE + WORD_NOISE / sqrt(words), as chance alone moves short histograms
MAX_WORD_DISTANCE = 0.11
WORD_NOISE = 1.75
REF_MIN_WORDS = 1000
#: steps of a share: for medians, and for sums of whole numbers (exact in any order)
GRID, SCALE = 10_000, 10 ** 9
MAX_BROADCAST_LANGUAGES = 10_000


def _common_words() -> str:
    whens = " ".join(f"WHEN '{lang}' THEN array({', '.join(repr(w) for w in words)})" for lang, words in COMMON_WORDS.items())
    return f"CASE _lang {whens} ELSE cast(array() AS ARRAY<STRING>) END"


def _histograms(docs: DataFrame) -> DataFrame:
    """``docs`` (columns _text, _lang and any others) with its character-class and common-word counts."""
    df = docs.withColumn("_w", F.array_remove(F.split("_text", r"[\x20\x09-\x0D]+"), "")).withColumn("_joined", F.array_join("_w", ""))
    df = df.withColumns({
        "_n_chars": F.char_length("_text"),
        "_solid": F.char_length("_joined"),
        "c_symbol": F.char_length("_joined") - F.char_length(F.regexp_replace("_joined", f"[{SYMBOLS}]+", "")),
        "c_upper": F.char_length("_joined") - F.char_length(F.regexp_replace("_joined", r"\p{Lu}+", "")),
        "_letters": F.char_length(F.regexp_replace("_joined", r"\P{L}+", "")),
        "c_digit": F.char_length("_joined") - F.char_length(F.regexp_replace("_joined", r"\p{N}+", "")),
        "_plain": F.array_remove(F.split(F.lower(F.regexp_replace("_text", f"[{STRIPPED}]+", "")), r"[\x20\x09-\x0D]+"), ""),
    })
    # one count per common word; higher-order functions keep the generated methods small enough to be compiled
    df = df.withColumn("_found", F.expr(f"transform({_common_words()}, k -> size(_plain) - size(array_remove(_plain, k)))"))
    df = df.withColumns({
        "chars": F.expr("array(_n_chars - _solid, c_symbol, c_upper, _letters - c_upper, c_digit, _solid - c_symbol - _letters - c_digit)"),
        "words": F.expr("concat(_found, array(size(_plain) - aggregate(_found, 0, (a, x) -> a + x)))"),
    })
    return df.drop("_plain", "_joined", "_found", "_n_chars", "_letters", "c_upper", "c_digit")


def distance_sql(own: str, ref: str) -> str:
    """SQL of the Jensen-Shannon distance (base 2) between two arrays of counts; null if either is empty."""
    def shares(x: str) -> str:
        return f"transform({x}, v -> v / cast(nullif(aggregate({x}, 0L, (a, y) -> a + y), 0) AS DOUBLE))"
    half = ("aggregate(zip_with({a}, {b}, (p, q) -> CASE WHEN p > 0 THEN p * ln(2 * p / (p + q)) ELSE 0D END), 0D, (a, x) -> a + x)")
    p, q = shares(own), shares(ref)
    return f"sqrt(greatest(0D, ({half.format(a=p, b=q)} + {half.format(a=q, b=p)}) / (2 * ln(2D))))"


def _repeat_words() -> str:
    """SQL: word positions covered by a 3-word window that the text has twice or more.

    Window hashes are packed with their position into one long, as many hash
    bits as the position leaves, and sorted as primitives; neighbours with
    equal hash bits are confirmed on the words themselves.
    """
    same = ("get(_w, cast(p & _mask AS INT)) = get(_w, cast(o & _mask AS INT)) AND "
            "get(_w, cast((p & _mask) + 1 AS INT)) = get(_w, cast((o & _mask) + 1 AS INT)) AND "
            "get(_w, cast((p & _mask) + 2 AS INT)) = get(_w, cast((o & _mask) + 2 AS INT))")

    def as_neighbour(shift: str) -> str:
        o = f"get(_packed, j {shift} 1)"
        return f"coalesce(shiftright(p, _bits) = shiftright({o}, _bits) AND {same.replace('o &', o + ' &')}, false)"
    return f"""sort_array(array_remove(transform(_packed, (p, j) ->
        CASE WHEN {as_neighbour('-')} OR {as_neighbour('+')} THEN p & _mask ELSE -1L END), -1L))"""


def base_counts(df: DataFrame) -> DataFrame:
    """``df`` (as _histograms gives it) with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    df = df.withColumns({
        "_lines": F.expr(r"filter(split(_text, '\n'), l -> l rlike '[^\\x20\\x09-\\x0D]')"),
    }).withColumns({
        "n_words": F.size("_w").cast("long"),
        "_bits": F.expr("length(bin(size(_w)))"),
        "_mask": F.expr("shiftleft(1L, length(bin(size(_w)))) - 1"),
    }).withColumn("_packed", F.expr(
        "sort_array(transform(slice(_w, 1, greatest(size(_w) - 2, 0)), (x, i) -> "
        "shiftleft(xxhash64(x, get(_w, i + 1), get(_w, i + 2)), _bits) | i))"))
    df = df.withColumn("_repeated", F.expr(_repeat_words()))
    return df.withColumns({
        "word_chars": F.col("_solid").cast("long"),
        "n_symbols": F.col("c_symbol").cast("long"),
        "n_dup_lines": F.expr("cast(size(_lines) - size(array_distinct(_lines)) AS LONG)"),
        "n_repeat_words": F.expr("""CASE WHEN size(_repeated) = 0 THEN 0L ELSE 3L + aggregate(
            transform(_repeated, (p, j) -> CASE WHEN j = 0 THEN 0L ELSE least(3L, p - get(_repeated, j - 1)) END), 0L, (a, x) -> a + x) END"""),
    }).drop("_w", "_lines", "_bits", "_mask", "_packed", "_repeated")


def _shares(name: str, scale: int):
    """Each count of the array ``name`` as a rounded share of their sum, in whole steps of 1 / ``scale``."""
    return F.expr(f"transform({name}, v -> coalesce(cast(round(v * {scale}D / nullif(aggregate({name}, 0L, (a, y) -> a + y), 0)) AS LONG), 0L))")


def _too_far(char_limit: float, word_limit: float, noise: float):
    """Whether ``char_distance`` or ``word_distance`` is over its limit for a text of ``n_words``."""
    return F.expr(f"char_distance > {char_limit} OR word_distance > {word_limit} + {noise} / sqrt(greatest(n_words, 1))")


def _with_distances(counted: DataFrame) -> DataFrame:
    return counted.withColumns({
        "char_distance": F.expr(distance_sql("chars", "r_chars")),
        # a language without common words has one bin, which says nothing
        "word_distance": F.expr(f"CASE WHEN size(words) > 1 THEN {distance_sql('words', 'r_words')} END"),
    })


def _medians(texts: DataFrame) -> DataFrame:
    """Per language the lower median share of each bin (r_lang, r_chars, r_words), by exact counts on a grid."""
    steps = texts.select("_lang", F.posexplode(F.concat(_shares("chars", GRID), _shares("words", GRID))).alias("bin", "step"))
    steps = steps.groupBy("_lang", "bin", "step").agg(F.count("*").alias("n"))
    bins = Window.partitionBy("_lang", "bin")  # at most GRID + 1 rows
    steps = steps.withColumn("upto", F.sum("n").over(bins.orderBy("step"))).withColumn("total", F.sum("n").over(bins))
    middle = steps.filter("2 * upto >= total").groupBy("_lang", "bin").agg(F.min("step").alias("step"))
    middle = middle.groupBy(F.col("_lang").alias("r_lang")).agg(F.sort_array(F.collect_list(F.struct("bin", "step"))).alias("bins"))
    return middle.select("r_lang", F.expr(f"transform(slice(bins, 1, {N_CHAR_CLASSES}), b -> b.step)").alias("r_chars"),
                         F.expr(f"transform(slice(bins, {N_CHAR_CLASSES + 1}, {N_COMMON + 1}), b -> b.step)").alias("r_words"))


def language_references(counted: DataFrame, max_char_distance: float = MAX_CHAR_DISTANCE,
                        max_word_distance: float = MAX_WORD_DISTANCE, word_noise: float = WORD_NOISE) -> DataFrame:
    """One row per language (null as null): r_lang, r_chars, r_words (whole steps) and r_size, the words it rests on.

    ``counted`` has _lang, _same (a hash of the text), chars, words, n_words and base_failed.
    """
    spark = counted.sparkSession
    texts = counted.filter("NOT base_failed").groupBy("_lang", "_same").agg(
        *[F.any_value(c).alias(c) for c in ("chars", "words", "n_words")])
    texts = written(spark, texts, "text-histograms")
    middle = bounded_references(_medians(texts), spark)
    near = _with_distances(texts.join(middle, F.col("_lang").eqNullSafe(F.col("r_lang"))))
    near = near.withColumn("_near", ~F.coalesce(_too_far(max_char_distance, max_word_distance, word_noise), F.lit(False)))
    near = near.withColumns({"s_chars": _shares("chars", SCALE), "s_words": _shares("words", SCALE)})

    def summed(name: str, bins: int):
        return F.array(*[F.sum(F.when(F.col("_near"), F.coalesce(F.get("s_" + name, F.lit(i)), F.lit(0)))) for i in range(bins)])
    found = near.groupBy("r_lang").agg(
        summed("chars", N_CHAR_CLASSES).alias("m_chars"), summed("words", N_COMMON + 1).alias("m_words"),
        F.any_value("r_chars").alias("r_chars"), F.any_value("r_words").alias("r_words"), F.max("_near").alias("some"),
        F.sum(F.expr("aggregate(words, 0L, (a, x) -> a + x)")).alias("r_size"))
    return found.select("r_lang", *[F.when(F.col("some"), F.col("m_" + c)).otherwise(F.col("r_" + c)).alias("r_" + c)
                                    for c in ("chars", "words")], "r_size")


def bounded_references(refs: DataFrame, spark) -> DataFrame:
    """The references, computed once: broadcast up to ``MAX_BROADCAST_LANGUAGES`` rows, an ordinary join side beyond."""
    rows = refs.limit(MAX_BROADCAST_LANGUAGES + 1).collect()
    if len(rows) > MAX_BROADCAST_LANGUAGES:
        return written(spark, refs, "language-references")
    return F.broadcast(spark.createDataFrame(rows, refs.schema))


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", min_words: int = MIN_WORDS,
          max_char_distance: float = MAX_CHAR_DISTANCE, max_word_distance: float = MAX_WORD_DISTANCE,
          word_noise: float = WORD_NOISE, ref_min_words: int = REF_MIN_WORDS) -> DataFrame:
    """All rows and columns of ``docs`` in the struct column ``row``, with counts, distances and ``kept``.

    Each text is counted once, for its language's reference and for its verdict.
    """
    spark = docs.sparkSession
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(text), F.lit("")).alias("_text"), F.col(lang).alias("_lang"))
    counted = base_counts(_histograms(rows)).select(
        "row", "_lang", F.xxhash64("_text").alias("_same"), "chars", "words", "n_words", "word_chars", "n_symbols",
        "n_dup_lines", "n_repeat_words",
        F.expr(f"n_words < {min_words} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words").alias("base_failed"))
    counted = written(spark, counted, "quality-counts")
    refs = bounded_references(language_references(counted, max_char_distance, max_word_distance, word_noise), spark)
    scored = _with_distances(counted.join(refs, F.col("_lang").eqNullSafe(F.col("r_lang")), "left"))
    far = F.expr(f"n_words >= {min_words} AND r_size >= {ref_min_words}") & _too_far(max_char_distance, max_word_distance, word_noise)
    return scored.select("row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         "char_distance", "word_distance",
                         (~F.col("base_failed") & ~F.coalesce(far, F.lit(False))).alias("kept"))


def keep_good(docs: DataFrame, **params) -> DataFrame:
    """The rows of ``docs`` that pass, with the columns of ``docs``.

    The filter must read the computed verdict. Pushed below the projection it
    would repeat the word arrays inside their own lambdas; a projection with a
    non-deterministic column stops that.
    """
    judged = judge(docs, **params).select("row", "kept", F.monotonically_increasing_id().alias("place"))
    return judged.filter("kept AND place >= 0").select("row.*")
