"""Licence scan by canonical digests.

A text and each of its lines are brought to a canonical form (case, copyright lines,
punctuation, equivalent spellings, white space) and hashed; the digests are hash-joined to those
of known licence texts and notices. Built-in expressions only. The text itself is never shuffled:
a document's units are made, joined and pre-aggregated in the task that reads it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from operator import or_
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bundlelake.llm.common import let

#: Licence texts and notices, by identifier.
_PERMISSION = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
    "and associated documentation files (the \"Software\"), to deal in the Software without "
    "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
    "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
    "Software is furnished to do so, subject to the following conditions:\n\nThe above copyright "
    "notice and this permission notice shall be included in all copies or substantial portions of "
    "the Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR "
    "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
    "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE "
    "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
    "IN THE SOFTWARE."
)
_ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
    "without fee is hereby granted"
)
_ISC_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS "
    "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE "
    "AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
    "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
    "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
    "PERFORMANCE OF THIS SOFTWARE."
)
LICENSES: Mapping[str, Sequence[str]] = {
    "MIT": (
        _PERMISSION,
        "MIT License\n\n" + _PERMISSION,
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
    ),
    "ISC": (
        f"{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear "
        f"in all copies.\n\n{_ISC_WARRANTY}",
        "Licensed under the ISC License.",
    ),
    "0BSD": (f"{_ISC_GRANT}.\n\n{_ISC_WARRANTY}",),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\");",
    ),
    "GPL-2.0-only": (
        "This work is licensed under the GNU General Public License, version 2.",
        "Licensed under the GNU General Public License, version 2.",
    ),
    "GPL-3.0-only": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 3.",
    ),
    "LGPL-3.0-only": ("This work is licensed under the GNU Lesser General Public License, version 3.",),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "BSD-3-Clause": ("Released under the BSD 3-Clause License.", "Licensed under the BSD 3-Clause License."),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under CC BY 4.0."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under CC BY-SA 4.0."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under CC BY-NC 4.0."),
    "CC0-1.0": ("Released under CC0 1.0.", "Dedicated to the public domain under CC0 1.0."),
    "all-rights-reserved": ("All rights reserved.",),
}

#: Whole licence texts, one file each, named by identifier.
WHOLE_TEXTS = Path(__file__).with_name("licence_texts")

#: What a notice says before the licence's name.
_THINGS = ("work", "project", "software", "program", "code", "file", "library")
_VERBS = ("licensed under", "released under", "distributed under", "available under")
CARRIERS = (
    *(f"{s}{v} " for s in ("", *(f"This {t} is " for t in _THINGS)) for v in _VERBS),
    "License: ", "SPDX-License-Identifier: ",
)
#: Licences by full names, short names and version; an empty version for none.
_NAMED = (
    ("MIT", ("MIT License", "Expat License"), ("MIT",), ""),
    ("ISC", ("ISC License",), ("ISC",), ""),
    ("0BSD", ("BSD Zero Clause License", "Zero-Clause BSD License", "0BSD License"), ("0BSD",), ""),
    ("BSD-2-Clause", ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"), ("BSD-2-Clause",), ""),
    ("BSD-3-Clause", ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License"), ("BSD-3-Clause",), ""),
    ("Unlicense", ("Unlicense",), ("Unlicense",), ""),
    ("Apache-2.0", ("Apache License", "Apache Software License"), ("Apache",), "2.0"),
    ("MPL-1.1", ("Mozilla Public License",), ("MPL",), "1.1"),
    ("MPL-2.0", ("Mozilla Public License",), ("MPL",), "2.0"),
    *(
        (f"{short}-{v}", (f"GNU {long}", f"GNU {short}"), (short,), v)
        for short, long, versions in (
            ("GPL", "General Public License", ("1.0", "2.0", "3.0")),
            ("LGPL", "Lesser General Public License", ("2.1", "3.0")),
            ("LGPL", "Library General Public License", ("2.0",)),
            ("AGPL", "Affero General Public License", ("3.0",)),
        )
        for v in versions
    ),
    *(
        (f"CC-{c}-4.0", (f"Creative Commons {n}",), (f"CC {c}",), "4.0")
        for c, n in (
            ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"),
            ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
            ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
        )
    ),
    ("CC0-1.0", ("Creative Commons Zero", "Creative Commons CC0"), ("CC0",), "1.0"),
)


def _names(longs: Sequence[str], shorts: Sequence[str], version: str, kinds: Sequence[str]) -> set[str]:
    """Spellings of a licence's name; punctuation and case do not matter."""
    if not version:
        return {*longs, *shorts, *(f"the {x}" for x in longs), *(f"{t}{x} License" for x in shorts for t in ("", "the "))}
    out = set()
    for v in {version, version if version == "4.0" else version.removesuffix(".0")}:
        for name in (*longs, *shorts):
            plain = {f"{name} {w}{v}" for w in ("", "v", "version ", *(("v ",) if "Mozilla" in name else ()))}
            named = plain | {f"{x} {kind}" for x in plain for kind in kinds if name in shorts or kind != "License" or "Creative" in name}
            out |= named | {f"the {x}" for x in named} | {f"version {v} of the {name}"}
    return out


def notices() -> Iterator[tuple[str, str]]:
    """``license_id, license_text`` of one-line notices: each carrier phrase with each name."""
    for license_id, longs, shorts, version in _NAMED:
        gnu = license_id.partition("-")[0] in ("GPL", "LGPL", "AGPL")
        kinds = ("License", "International", "International License") if version == "4.0" else ("License",)
        ends = {"": ("", ' (the "License")')}
        if gnu:
            kinds, ends = (), {"-only": ("", " only"), "-or-later": (" or later", " or any later version")}
        elif license_id.startswith("CC"):
            ends = {"": ("",)}
            kinds = ("Universal", *kinds) if license_id == "CC0-1.0" else kinds
        for name in sorted(_names(longs, shorts, version, kinds)):
            for kind, many in ends.items():
                for end in many:
                    for carrier in CARRIERS:
                        yield license_id + kind, f"{carrier}{name}{end}"
                        if carrier.endswith("under ") and name.startswith(("the ", "version ")):
                            yield license_id + kind, f"{carrier}the terms of {name}{end}"


def whole_texts() -> Iterator[tuple[str, str]]:
    """``license_id, license_text`` of whole texts, also without what follows their terms."""
    for path in sorted(WHOLE_TEXTS.glob("*.txt")):
        text = path.read_text("utf-8")
        yield path.stem, text
        yield path.stem, re.sub(r"\n[^\n]*\[yyyy\][^\n]*", "", text)  # the line is filled in or left
        terms, end, _ = text.partition("END OF TERMS AND CONDITIONS")
        if end:
            yield path.stem, terms
            yield path.stem, terms + end


#: Word beginnings that count as equal, as pattern and replacement, after
#: punctuation has gone. A leading blank, line end or text start stands before each.
SPELLINGS = (
    ("(licen|sublicen|offen)c", "s"),
    ("(analy|authori|categori|customi|emphasi|initiali|maximi|minimi|optimi|organi|reali|recogni|utili)s", "z"),
    ("(col|fav|hon|lab|behavi)our", "or"),
    ("(acknowledg|judg)em", "m"),
    ("(cent)re", "er"),
    ("(whil)st", "e"),
    ("(cancel|label|model|signal)l", ""),
    ("(catalog|analog)ue", ""),
    ("(sub) licen", "licen"),
    ("(non) commercial", "commercial"),
    ("(per) cent", "cent"),
    ("(copyright) owner", " holder"),
    ("(http)s", ""),
)
#: One line that states a copyright: the word or sign with a year, or the sign alone in front.
COPYRIGHT_LINE = r"(^|\n)[^a-z0-9\n©(]*(copyright[^\n]*(\(c\)|©|[12][0-9]{3})|\(c\) |©)[^\n]*"
#: Known tables of up to this many rows are sent to every task; larger ones are shuffled.
BROADCAST_ROWS = 100_000


def canonical(text: Column) -> Column:
    """Canonical form with line ends kept: words of letters and digits, one blank between."""
    def bare(lower):
        stated = lower.contains("copyright") | lower.contains("(c)") | lower.contains("©")
        return F.when(stated, F.regexp_replace(lower, COPYRIGHT_LINE, "$1")).otherwise(lower)

    def respelled(value):
        out = value
        for pattern, ending in SPELLINGS:
            out = F.regexp_replace(out, rf"(^|[ \n]){pattern}", f"$1$2{ending}")
        any_of = [
            start + pattern.partition(")")[2]
            for pattern, _ in SPELLINGS
            for start in pattern[1:].partition(")")[0].split("|")
        ]
        return F.when(reduce(or_, (value.contains(x) for x in any_of)), out).otherwise(value)

    return let(F.regexp_replace(let(F.lower(text), bare), r"[^\p{L}\p{N}\n]+", " "), respelled)


def digest(line: Column) -> Column:
    """Digest of a canonical line; null when nothing is left."""
    return F.when(F.trim(line) != "", F.sha2(F.trim(line).cast("binary"), 256))


def whole_digest(text: Column) -> Column:
    """Digest of canonical text, line ends read as blanks."""
    return digest(F.regexp_replace(text, r"[ \n]+", " "))


def known_licenses(
    spark: SparkSession, texts: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """``license_id, license_text`` rows for :func:`scan`; the built-in set by default."""
    rows = [(k, t) for k, many in (LICENSES if texts is None else texts).items() for t in many]
    if texts is None:
        rows += [*whole_texts(), *notices()]
    return spark.createDataFrame(rows, "license_id string, license_text string")


def scan(
    documents: DataFrame, known: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Look up every document, and every line of it, among known licences.

    Returns one row per input row: the key, ``text_digest`` (null when the text has no letter or
    digit), ``license_id`` (the licence that the whole text is, else null), ``n_notice_lines`` (its
    lines that are a known notice or licence) and ``notices`` (their identifiers, sorted, comma
    joined, empty if none). Null and empty texts match nothing. Repeated rows stay separate rows.
    A digest known under several identifiers counts under the least. Other columns are ignored,
    whatever their names.
    """
    listed = (
        known.select("license_id", whole_digest(canonical(F.col("license_text"))).alias("digest"))
        .where("digest IS NOT NULL AND license_id IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("license_id").alias("license_id"))
    )
    if known.count() <= BROADCAST_ROWS:
        listed = F.broadcast(listed)

    def units(clean):
        lines = F.filter(F.split(clean, "\n"), lambda line: F.trim(line) != "")
        return F.concat(F.array(whole_digest(clean)), F.transform(lines, digest))

    numbered = documents.select(
        F.col(key).alias("key"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("text")
    )
    rows = numbered.select(
        "key",
        "row",
        F.posexplode(let(canonical(F.coalesce("text", F.lit(""))), units)).alias("unit", "digest"),
    )
    whole = F.col("unit") == 0
    return (
        rows.join(listed, "digest", "left")
        .groupBy("row", "key")
        .agg(
            F.max(F.when(whole, F.col("digest"))).alias("text_digest"),
            F.max(F.when(whole, F.col("license_id"))).alias("license_id"),
            F.count(F.when(~whole, F.col("license_id"))).alias("n_notice_lines"),
            F.array_join(
                F.sort_array(F.collect_set(F.when(~whole, F.col("license_id")))), ","
            ).alias("notices"),
        )
        .select(F.col("key").alias(key), "text_digest", "license_id", "n_notice_lines", "notices")
    )
