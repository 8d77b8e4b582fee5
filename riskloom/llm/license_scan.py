"""Licence scan by canonical digest lookup (operator 5, native).

A text is made canonical: lower case; equivalent spellings replaced; a known
title on the first line, lines that state a copyright and "all rights reserved"
dropped; everything but letters and digits dropped down to single spaces. The SHA-256 of the whole canonical text is the key of a hash
join with the digests of known licences, which are made canonical by the same
expressions. The same lookup runs over each line, so that a licence notice
inside a document is found as well as a document that is a licence.

Covered are the whole texts of ``KNOWN`` (MIT, ISC, one-line notices) and
``KNOWN_DIGESTS``, and those of a table given to ``known_licenses``. A licence of
several lines inside a longer document is not found: only whole texts and lines are.

Both lookups are hash joins with the known digests, broadcast only up to
``MAX_BROADCAST_DIGESTS`` rows. The lines of a document meet again by a partial
aggregate in the task that read them, so one small row per document is
shuffled and texts are not.

Defined cases: null and empty texts have the digest of the empty text and no
licence; null ``doc_id`` stays null; repeated rows are looked up one by one;
an empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_BROADCAST_DIGESTS = 100_000

#: Equivalent spellings (fixed values), applied in this order to lower-case text.
SPELLINGS = [
    ("licence", "license"), ("licenced", "licensed"), ("sub-license", "sublicense"), ("sub license", "sublicense"),
    ("non-commercial", "noncommercial"), ("per cent", "percent"),
    ("favour", "favor"), ("acknowledgement", "acknowledgment"), ("fulfil ", "fulfill "), ("https://", "http://"),
]

#: Known licences and notices: name, text (fixed values). ``known_licenses`` takes further ones from a table.
KNOWN = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
            "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
            "conditions: The above copyright notice and this permission notice shall be included in all copies or "
            "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
            "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
            "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
            "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
            "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies. THE "
            "SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING "
            "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
            "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
            "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
            "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
]


#: SHA-256 of the canonical form of whole published texts (fixed values): name, digest.
KNOWN_DIGESTS = [
    ("Apache-2.0", "95f35d79ea3bab75c250549d6a03cef242e0547d78c99e26fcede49936fb0184"),  # with appendix
    ("Apache-2.0", "f45538b138cf9aea39fa205de037a0bede8305e68281650e7ab809a8b3ebb2f0"),  # to the end of its terms
    ("Apache-2.0", "37599287c15c2f2ec060c3c3b55bdf69e3bc7a8aeeb9cd57e18800088789538a"),  # without the line that ends them
    ("Artistic-1.0", "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702"),
    ("BSD-2-Clause", "a56fee4b2f66331ed54da4950ef9c9391453fd1490b4d8ea202bc29683bcbd30"),
    ("BSD-3-Clause", "9b83d3dee0616d07b82a272dd9bf5134a9f402b750f5ee6188458073b0a32ff2"),  # of the copyright holder
    ("BSD-3-Clause", "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651"),  # of the Regents
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2", "15f6a8d360ffdecc988c29279c00f23e20de17f14f2a06572ab0d41de6e98b7b"),
    ("GFDL-1.3", "2d36daeff2ad303badb6dee8149748be25e22974dd468e1e8a55cf40f16fc01d"),
    ("GPL-1.0", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    ("GPL-2.0", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-3.0", "eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a"),
    ("LGPL-2.0", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.1", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "cbbde7eeab9b4d180dc00b34252f800e97fb1cddbab38ed8c0c73b956dc2cbf6"),
    ("MPL-2.0", "f82071285728ca3ec7685ee9bc4acdae0b8267142a4d20b8f1805eabedb4a98a"),
]

#: Title lines (fixed values), dropped where they are the first line of a text; lower case, after ``SPELLINGS``.
TITLES = [
    "the mit license [(]mit[)]", "the mit license", "mit license", "mit license [(]mit[)]", "the isc license", "isc license",
    "isc license [(]iscl[)]", "bsd license", "the bsd license", "new bsd license", "modified bsd license", "simplified bsd license",
    "bsd 2-clause license", "bsd 3-clause license", "the 2-clause bsd license", "the 3-clause bsd license",
]

#: Lines that state a copyright (with a year, or with the sign after the word) or reserve all rights.
_COPYRIGHT = ("(?m)^[^\\\\p{L}\\\\n]*((copyright|[(]c[)]|©)[^\\\\n]*[0-9]{4}[^\\\\n]*|copyright *([(]c[)]|©)[^\\\\n]*"
              "|all rights reserved[^\\\\p{L}\\\\n]*)$")


def canonical_sql(x: str) -> str:
    """SQL of the canonical form of ``x``; valid in Spark and, with global replacement flags, in DuckDB."""
    out = f"lower({x})"
    for old, new in SPELLINGS:
        out = f"replace({out}, '{old}', '{new}')"
    out = f"regexp_replace({out}, '^[^\\\\p{{L}}]*({'|'.join(TITLES)})[^\\\\p{{L}}\\\\p{{N}}\\\\n]*\\\\n', '')"
    out = f"regexp_replace({out}, '{_COPYRIGHT}', '')"
    return f"trim(regexp_replace({out}, '[^\\\\p{{L}}\\\\p{{N}}]+', ' '))"


def digest(col_sql: str):
    return F.expr(f"sha2({canonical_sql(col_sql)}, 256)")


def known_licenses(spark: SparkSession, more: DataFrame | None = None) -> DataFrame:
    """Columns digest, license: one row per digest (the smallest name where spellings agree). ``more``: name, text."""
    known = spark.createDataFrame(KNOWN, "name string, text string")
    if more is not None:
        known = known.unionByName(more.select("name", "text"))
    empty = F.sha2(F.lit(""), 256)
    known = known.select("name", digest("coalesce(text, '')").alias("digest"))
    known = known.unionByName(spark.createDataFrame(KNOWN_DIGESTS, "name string, digest string"))
    return (known.filter(F.col("digest") != empty)
            .groupBy("digest").agg(F.min("name").alias("license")))


def scan(docs: DataFrame, known: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, digest, license (whole text, else null) and line_licenses (sorted names)."""
    few = known.limit(MAX_BROADCAST_DIGESTS + 1).count() <= MAX_BROADCAST_DIGESTS
    known = F.broadcast(known) if few else known
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_t")).select(
        "doc_id", F.sha2("_t", 256).alias("_raw"), digest("_t").alias("digest"),
        F.expr(f"array_distinct(transform(split(_t, '\\n'), l -> sha2({canonical_sql('l')}, 256)))").alias("_lines"))
    # a first line of null keeps documents without lines; rows of one document leave their task as one row
    lines = texts.select("doc_id", "_raw", "digest", F.explode(F.expr("concat(array(cast(NULL AS STRING)), _lines)")).alias("_line"))
    lines = lines.join(known.select(F.col("digest").alias("_line"), F.col("license").alias("_name")), "_line", "left")
    lines = lines.withColumn("_copy", F.when(F.col("_line").isNull(), 1).otherwise(0))
    found = lines.groupBy("doc_id", "_raw", "digest").agg(
        F.array_sort(F.collect_set("_name")).alias("line_licenses"), F.sum("_copy").alias("_copies"))
    found = found.withColumn("_copy", F.explode(F.expr("sequence(1, cast(_copies AS INT))")))
    return found.join(known, "digest", "left").select("doc_id", "digest", "license", "line_licenses")
