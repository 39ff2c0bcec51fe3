"""Licence scan by canonical digest lookup.

A text is normalised: case, lines that only state a copyright, equivalent
spellings, punctuation and white space.  The SHA-256 of the whole result is
hash-joined to the digests of known licence texts.  Besides the document
itself, its blocks (between blank lines) and its lines are looked up as
texts of their own, so a notice inside a document is found when it stands
by itself.  A licence of several blocks inside a document is found by its
sequence of block digests: where a block is the first one of a known text,
as many blocks as that text has are compared.  Whole texts lie beside the
module in ``license_texts``; titles that LICENSE files bear are listed.

Every known text holds one of the ``ANCHORS``; texts without any of them
cannot match and are not normalised (a lossless filter).  Only matches are
grouped and joined back; texts are never shuffled.  Spark broadcasts the
known texts where their size allows.  Everything is DataFrame and SQL
functions.

Edge cases: null and empty texts, and texts that are empty once
normalised, match nothing; rows with equal id and text get the same result
each; very long texts are searched whole, a line and a block at a time; an
empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
    "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
    "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
    "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE "
    "USE OR OTHER DEALINGS IN THE SOFTWARE.")
_ISC_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
    "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
    "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF "
    "USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF "
    "OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")
_BSD_WARRANTY = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
    "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
    "POSSIBILITY OF SUCH DAMAGE.")
_BSD_TERMS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright "
    "notice, this list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must "
    "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution.\n\n")

# Fixed values: (SPDX id, text) of full licences and of common notices.
KNOWN = [
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            'associated documentation files (the "Software"), to deal in the Software without restriction, '
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions:\n\nThe above copyright notice and this permission notice shall "
            "be included in all copies or substantial portions of the Software.\n\n" + _WARRANTY),
    ("MIT-0", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
              'associated documentation files (the "Software"), to deal in the Software without restriction, '
              "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
              "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
              "furnished to do so.\n\n" + _WARRANTY),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
            "is hereby granted, provided that the above copyright notice and this permission notice appear in all "
            "copies.\n\n" + _ISC_WARRANTY),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
             "is hereby granted.\n\n" + _ISC_WARRANTY),
    ("BSD-2-Clause", _BSD_TERMS + _BSD_WARRANTY),
    ("BSD-3-Clause", _BSD_TERMS + "3. Neither the name of the copyright holder nor the names of its contributors "
                     "may be used to endorse or promote products derived from this software without specific prior "
                     "written permission.\n\n" + _BSD_WARRANTY),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
                   "except in compliance with the License. You may obtain a copy of the License at\n\n"
                   "http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to "
                   'in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT '
                   "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
                   "specific language governing permissions and limitations under the License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "This work is licensed under the Apache License, Version 2.0."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This work is licensed under the MIT License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "Licensed under the GNU General Public License, version 3."),
    ("AGPL-3.0-only", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
                "the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
]
# Title lines of LICENSE files.
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"],
    "MIT-0": ["MIT No Attribution", "MIT No Attribution License"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)"],
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD", "BSD 0-Clause License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", "BSD License", "Simplified BSD License",
                     'BSD 2-Clause "Simplified" License'],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", "BSD License", "New BSD License",
                     "Modified BSD License", 'BSD 3-Clause "New" or "Revised" License'],
}


def whole_texts() -> list[tuple[str, str]]:
    """(SPDX id, text) of whole licences: those of several paragraphs in
    ``KNOWN`` and the files, in the layouts and with the ends they come with."""
    out = []
    for name, text in KNOWN:
        if name in TITLES and "\n\n" in text:
            marks = re.sub(r"(?m)^\d\. ", "* ", text)
            out += [(name, re.sub(r"\n\n(?=\d\. |\* )", gap, t)) for t in (text, marks) for gap in ("\n\n", "\n")]
    for file in sorted((Path(__file__).parent / "license_texts").glob("*.txt")):
        text = file.read_text(encoding="utf-8")
        terms = re.split(r"(?<=END OF TERMS AND CONDITIONS)", text)[0]
        for t in (text, terms):
            # With and without the first paragraph, which is a title.
            out += [(file.stem, t), (file.stem, re.split(r"\n[\x20\t]*\n", t.strip(), maxsplit=1)[1])]
    return list(dict.fromkeys(out))


def titled(whole: list[tuple[str, str]]) -> list[tuple[str, str]]:
    return [(name, f"{title}\n\n{text}") for name, text in whole for title in TITLES.get(name, [])]


# Equivalent spellings (fixed values), applied after lower-casing and before punctuation goes.
SPELLINGS = [(r"\blicence", "license"), (r"https://", "http://"), (r"\bsub-license", "sublicense"),
             (r"\bnon-infringement", "noninfringement"), (r"\bversion\s+v\.?", "version "),
             (r"\bv\.\s*(?=\d)", "version "), (r"\bcreative\s+commons\s+by\b", "cc by"), (r"&", " and ")]
ANCHORS = r"(?i)licen[sc]e|permission|redistribution"
COPYRIGHT_LINE = r"(?im)^[\x20\t#*/;-]*(copyright\b[^\n]*|\(c\)[^\n]*|©[^\n]*|all rights reserved\.?[\x20\t]*)$"


def canonical(text: Column) -> Column:
    """Lower case, no copyright lines, one spelling, words joined by one space."""
    out = F.lower(F.regexp_replace(text, COPYRIGHT_LINE, ""))
    out = reduce(lambda c, s: F.regexp_replace(c, *s), SPELLINGS, out)
    return F.trim(F.regexp_replace(out, r"[^\p{L}\p{N}]+", " "))


BLOCKS = r"\n[\x20\t]*\n"
# First blocks of known texts, which are a literal in the plan.
MOST_RUNS = 10000


def block_digests(text: Column) -> Column:
    """Digests of the blocks that are not empty once normalised."""
    blocks = F.filter(F.transform(F.split(text, BLOCKS), canonical), lambda x: x != "")
    return F.transform(blocks, lambda x: F.sha2(x, 256))


def _table(spark: SparkSession, known: list[tuple[str, str]]) -> DataFrame:
    kind = T.StructType([T.StructField("license", T.StringType()), T.StructField("text", T.StringType())])
    return spark.createDataFrame(known, kind)


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """``digest, license`` of the known texts, normalised like any text."""
    if known is None:
        known = KNOWN + (whole := whole_texts()) + titled(whole)
    return _table(spark, known).select(F.sha2(canonical(F.col("text")), 256).alias("digest"), "license").distinct()


def known_runs(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """``first, run, license``: the block digests of the known texts of several blocks."""
    return _table(spark, whole_texts() if known is None else known).select(
        block_digests(F.col("text")).alias("run"), "license").where("size(run) > 1") \
        .select(F.col("run")[0].alias("first"), "run", "license").distinct()


def find_runs(src: DataFrame, runs: DataFrame) -> DataFrame:
    """``doc, at, unit, no, license`` where blocks of a document are a run of known blocks."""
    firsts = [r[0] for r in runs.select("first").distinct().limit(MOST_RUNS + 1).collect()]
    if len(firsts) > MOST_RUNS:
        raise ValueError(f"more than {MOST_RUNS} known texts of several blocks")
    longest = runs.agg(F.coalesce(F.max(F.size("run")), F.lit(0))).first()[0]
    begin = F.array(*[F.lit(f) for f in firsts]).cast("array<string>")
    starts = src.select("doc", "at", block_digests(F.col("text")).alias("b")).where("size(b) > 1").withColumn(
        "n", F.explode(F.filter(F.sequence(F.lit(0), F.size("b") - 1), lambda i: F.array_contains(begin, F.get("b", i))))) \
        .select("doc", "at", F.col("n").alias("no"), F.slice("b", F.col("n") + 1, F.lit(max(longest, 1))).alias("blocks"))
    same = (F.col("blocks")[0] == F.col("first")) & (F.expr("slice(blocks, 1, size(run))") == F.col("run"))
    return starts.join(runs, same).select("doc", "at", F.lit("run").alias("unit"), "no", "license")


def scan_licenses(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id",
                  text_col: str = "text", runs: DataFrame | None = None) -> DataFrame:
    """One row per document: ``doc_id, whole_license`` (the document is that
    licence), ``licenses`` (comma-joined, of the document, its blocks, runs of
    blocks and lines) and ``n_matches`` (matching lines, blocks, runs and documents).
    ``known``: digest, license, ``runs``: first, run, license (at most
    ``MOST_RUNS`` first blocks); with ``known`` alone no runs are looked up."""
    if known is None and runs is None:
        runs = known_runs(docs.sparkSession)
    known = known if known is not None else known_digests(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")) \
        .withColumn("at", F.xxhash64("text"))
    units = src.where(F.col("text").rlike(ANCHORS)).select("doc", "at", F.explode(F.expr(
        r"""concat(array(named_struct('unit', 'text', 'no', 0, 'body', text)),
            transform(split(text, '\n[\\x20\t]*\n'), (x, i) -> named_struct('unit', 'block', 'no', i, 'body', x)),
            transform(split(text, '\n'), (x, i) -> named_struct('unit', 'line', 'no', i, 'body', x)))""")).alias("u")) \
        .select("doc", "at", "u.*").where(F.col("body").rlike(ANCHORS))
    digests = units.withColumn("body", canonical(F.col("body"))).where("body <> ''") \
        .select("doc", "at", "unit", "no", F.sha2("body", 256).alias("digest"))
    hits = digests.join(known, "digest").select("doc", "at", "unit", "no", "license")
    if runs is not None:
        hits = hits.unionByName(find_runs(src.where(F.col("text").rlike(ANCHORS)), runs))
    hits = hits.groupBy("doc", "at", "unit", "no") \
        .agg(F.min("license").alias("license"))
    found = hits.groupBy(F.col("doc").alias("d"), F.col("at").alias("a")).agg(
        F.max(F.when(F.col("unit") == "text", F.col("license"))).alias("whole_license"),
        F.array_join(F.array_sort(F.collect_set("license")), ",").alias("licenses"),
        F.count("*").alias("n_matches"))
    return src.select("doc", "at").join(
        found, F.col("doc").eqNullSafe(F.col("d")) & F.col("at").eqNullSafe(F.col("a")), "left").select(
        F.col("doc").alias("doc_id"), "whole_license", F.coalesce("licenses", F.lit("")).alias("licenses"),
        F.coalesce("n_matches", F.lit(0)).cast("long").alias("n_matches"))
