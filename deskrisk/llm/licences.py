"""Licence scans by canonical digests.

A text is normalised line by line: lower case, equivalent spellings made one, punctuation and
blanks made single blanks, lines that only state a copyright left out. The digest of the whole
canonical text, and of every line of it, is joined with the digests of known licence texts and
notices, normalised in the same way.

Known texts are a parameter; the default are the notices below, the whole texts in ``licence_texts``,
and MIT, ISC and BSD texts, under their usual titles. The table is broadcast only if it has
``MOST_KNOWN`` rows at most, else joined like any table.

Defined results: a null or empty text holds no licence; rows equal in id and text are one
document; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MOST_KNOWN = 100_000

# Names and texts of known notices and licences.
_NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("CC-BY-4.0", "This work is licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    (
        "MIT",
        "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\n"
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        'the Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT '
        "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN "
        "THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n"
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
        "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN "
        "AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE.",
    ),
)
# Usual titles over texts that have none of their own.
TITLES = {
    "MIT": ("The MIT License (MIT)", "The MIT License", "MIT License (MIT)", "MIT", ""),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)", "ISC"),
    "BSD-2-Clause": ("", "BSD 2-Clause License", "The BSD 2-Clause License", "The 2-Clause BSD License", 'BSD 2-Clause "Simplified" License', "Simplified BSD License"),
    "BSD-3-Clause": ("", "BSD 3-Clause License", "The BSD 3-Clause License", "The 3-Clause BSD License", 'BSD 3-Clause "New" or "Revised" License', "New BSD License", "Modified BSD License", "BSD License", "The BSD License"),
}
_END = "END OF TERMS AND CONDITIONS"
_HOLDERS = (("the University", "the copyright holder"), ("REGENTS AND", "COPYRIGHT HOLDERS AND"), ("REGENTS OR", "COPYRIGHT HOLDER OR"))


def _whole_texts() -> list[tuple[str, str]]:
    """Names and whole texts, with their usual titles, and with and without what follows the terms."""
    found = []
    for path in sorted((Path(__file__).parent / "licence_texts").glob("*.txt")):  # shipped with the package, read on the driver
        text = path.read_text(encoding="utf-8", errors="replace")
        texts = [text] + ([text[: text.index(_END) + len(_END)], text[: text.index(_END)]] if _END in text else [])
        found += [(path.stem, t) for t in dict.fromkeys(v for t in texts for v in (t, t.replace("https://", "http://")))]
    regents = next(t for name, t in found if name == "BSD-3-Clause")
    holders = reduce(lambda t, pair: t.replace(*pair), _HOLDERS, regents)
    singular = [*_NOTICES[-2:], ("BSD-3-Clause", regents), ("BSD-3-Clause", holders)]
    for text in (regents, holders):
        third, end = text.index("3. Neither"), text.index("THIS SOFTWARE IS")
        singular.append(("BSD-2-Clause", text[:third] + text[end:]))
    for name, text in singular:
        body = text.removeprefix("MIT License\n\n")
        found += [(name, f"{title}\n\n{body}") for title in TITLES[name]]
    return found


KNOWN = (*_NOTICES, *_whole_texts())
# Equivalent spellings, as whole words after punctuation has become blanks.
SPELLINGS = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sub license", "sublicense"),
    ("copyright owner", "copyright holder"), ("copyright owners", "copyright holders"), ("non commercial", "noncommercial"),
    ("non infringement", "noninfringement"), ("merchantibility", "merchantability"), ("organisation", "organization"),
)
COPYRIGHT_LINE = r"^\s*(copyright\s|copr\.|©|\(c\)\s|all rights reserved)"
SEPARATORS = r"[^\p{L}\p{N}]+"


def canonical_line(line: Column) -> Column:
    """A line in canonical form; empty if it only states a copyright."""
    lowered = F.lower(line)
    plain = F.trim(F.regexp_replace(lowered, SEPARATORS, " "))
    spelled = plain
    for variant, usual in SPELLINGS:
        spelled = F.regexp_replace(spelled, rf"\b{variant}\b", usual)
    any_variant = rf"\b({'|'.join(v for v, _ in SPELLINGS)})\b"
    return F.when(lowered.rlike(COPYRIGHT_LINE), F.lit("")).when(plain.rlike(any_variant), spelled).otherwise(plain)


def canonical_lines(text: Column) -> Column:
    """The canonical lines of a text that are not empty."""
    return F.array_remove(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), canonical_line), "")


def known_digests(spark: SparkSession, known=KNOWN) -> DataFrame:
    """``digest``, ``licence``: one row for each canonical text; of equal texts the first name."""
    texts = spark.createDataFrame(list(known), "licence string, text string")
    digest = F.sha2(F.array_join(canonical_lines(F.col("text")), " "), 256).alias("digest")
    return texts.select(digest, "licence").groupBy("digest").agg(F.min("licence").alias("licence"))


def scan(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: lines that are known notices, the licences found, and the licence the whole text is."""
    known = known_digests(docs.sparkSession) if known is None else known
    if known.limit(MOST_KNOWN + 1).count() <= MOST_KNOWN:
        known = F.broadcast(known)
    lines = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"), canonical_lines(F.col(text_col)).alias("lines"))
    whole = F.struct(F.lit(True).alias("whole"), F.sha2(F.array_join("lines", " "), 256).alias("digest"))
    single = F.transform("lines", lambda line: F.struct(F.lit(False).alias("whole"), F.sha2(line, 256).alias("digest")))
    units = lines.select("id", "key", F.explode(F.array_append(single, whole)).alias("unit")).select("id", "key", "unit.*")
    return (
        units.join(known, "digest", "left").groupBy("id", "key")
        .agg(
            F.count_if(F.col("licence").isNotNull() & ~F.col("whole")).alias("n_notices"),
            F.array_join(F.array_sort(F.collect_set("licence")), ",").alias("licences"),
            F.coalesce(F.max(F.when(F.col("whole"), F.col("licence"))), F.lit("")).alias("whole_text"),
        )
        .select(F.col("id").alias(id_col), "n_notices", "licences", "whole_text")
    )
