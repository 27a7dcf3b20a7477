"""Licence scans by canonical digest lookup.

A text is brought to a canonical form: lower case, copyright lines dropped,
equivalent spellings unified, punctuation and white space reduced to single
spaces. The SHA-256 of that form is looked up, by a hash join, among the
digests of known licence texts and notices. Whole documents are looked up, and
so is every line of them, so that a notice inside a document is found, too.

Known texts are few (:data:`KNOWN` and what the caller adds); they are digested
by the same function. A line is digested if it starts with the first word of a
known text. Null and empty texts, and texts of copyright lines
only, have an empty canonical form and match nothing. Repeated rows report
alike; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallow.llm.common import bounded_batches, per_document

# Licence identifiers and texts or notices that grant them.
KNOWN = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                   'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
                   "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                   "permissions and limitations under the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
            'documentation files (the "Software"), to deal in the Software without restriction, including without '
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
            "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
            "conditions: The above copyright notice and this permission notice shall be included in all copies or "
            'substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS '
            "OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
            "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
            "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
            "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
            'IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
            "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
            "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
            "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
            "USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
)
_CONDITIONS = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
               "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
               "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
               "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
               "with the distribution. ")
_NO_ENDORSEMENT = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                   "products derived from this software without specific prior written permission. ")
_DISCLAIMER = ('THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
               "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
               "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
               "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
               "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
               "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE "
               "USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
KNOWN += (("BSD-2-Clause", _CONDITIONS + _DISCLAIMER), ("BSD-3-Clause", _CONDITIONS + _NO_ENDORSEMENT + _DISCLAIMER))
KNOWN += tuple((i, f"SPDX-License-Identifier: {i}") for i in (
    "BSD-2-Clause", "BSD-3-Clause", "ISC", "MPL-2.0", "LGPL-2.1-only", "LGPL-3.0-only", "GPL-2.0-only", "CC0-1.0", "CC-BY-4.0", "CC-BY-NC-4.0"))
# Titles that licence files put before the whole text.
TITLES = {"MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"), "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
          "BSD-2-Clause": ("BSD 2-Clause License", 'BSD 2-Clause "Simplified" License'),
          "BSD-3-Clause": ("BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License')}
KNOWN += tuple((i, f"{title}\n\n{t}") for i, t in KNOWN if len(t) > 500 for title in TITLES.get(i, ()))
# Spellings that are the same for a licence match.
SPELLINGS = (("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sublicence", "sublicense"),
             ("organisation", "organization"), ("authorise", "authorize"), ("authorised", "authorized"),
             ("favour", "favor"), ("judgement", "judgment"), ("acknowledgement", "acknowledgment"),
             ("whilst", "while"), ("noncommercial", "non commercial"), ("v", "version"), ("ver", "version"),
             ("copyright owner", "copyright holder"), ("per cent", "percent"))
# A line that starts like this states whose copyright it is, not the licence.
COPYRIGHT = r"(?m)^[^\n\p{L}\p{N}(]*(?:copyright\b|\(c\)|©|all rights reserved)[^\n]*$"
_COPYRIGHT = re.compile(r"^(?:[^\w\n(]|_)*(?:copyright\b|\(c\)|©|all rights reserved)[^\n]*$", re.MULTILINE)
_WORD = re.compile(r"[^\W_]+")
_ONE_WORD = {a: b for a, b in SPELLINGS if " " not in a}
_MORE_WORDS = [(a, b) for a, b in SPELLINGS if " " in a]


def canonical(text: str) -> str:
    """The canonical form: lower-case words parted by single spaces."""
    lower = text.lower()
    if "copyright" in lower or "(c)" in lower or "©" in lower or "all rights" in lower:
        lower = _COPYRIGHT.sub("", lower)
    form = " ".join([_ONE_WORD.get(w, w) for w in _WORD.findall(lower)])
    for other, usual in _MORE_WORDS:
        if other in form:
            form = f" {form} ".replace(" ", "  ").replace(f" {other.replace(' ', '  ')} ", f" {usual} ")
            form = " ".join(w for w in form.split(" ") if w)
    return form


def text_digest(form: str) -> str:
    return hashlib.sha256(form.encode()).hexdigest()


def known_digests(spark: SparkSession, known: tuple[tuple[str, str], ...] = KNOWN) -> DataFrame:
    """``digest, licence``, one row per known text; as many rows as ``known``."""
    rows = sorted({(text_digest(canonical(t)), i) for i, t in known})
    return spark.createDataFrame(rows, "digest string, licence string")


def scan(docs: DataFrame, known: tuple[tuple[str, str], ...] = KNOWN) -> DataFrame:
    """``doc_id, text_digest, text_licence, notice_lines, notice_licences`` of every row.

    ``notice_licences`` are the distinct licences of matching lines, sorted and
    joined by commas. Notices are gathered by id and digest, so rows that
    repeat a document share them without being counted twice.
    """
    bounded_batches(docs.sparkSession)
    # As many rows as there are known texts: a proven bound for the broadcast.
    digests = F.broadcast(known_digests(docs.sparkSession, known))
    # A line can only equal a known text that starts with the same word.
    first_words = {canonical(t).split(" ", 1)[0] for _, t in known}

    def digest(text: str) -> tuple:
        lines = []
        for line in text.split("\n"):
            word = _WORD.search(line)
            if word:
                w = word.group().lower()
                if _ONE_WORD.get(w, w) in first_words or any(w.startswith(a.split(" ")[0]) for a, _ in _MORE_WORDS):
                    lines.append(text_digest(canonical(line)))
        return text_digest(canonical(text)), lines

    texts = per_document(docs, digest, "text_digest string, line_digests array<string>", ["doc_id"])
    lines = texts.select("doc_id", "text_digest", F.posexplode("line_digests").alias("line_no", "digest"))
    notices = lines.join(digests, "digest").groupBy("doc_id", "text_digest").agg(
        F.countDistinct("line_no").alias("notice_lines"),
        F.array_join(F.array_sort(F.collect_set("licence")), ",").alias("notice_licences"))
    whole = texts.select(F.col("doc_id").alias("id"), "text_digest").join(
        digests.select(F.col("digest").alias("text_digest"), F.col("licence").alias("text_licence")), "text_digest", "left")
    same = whole["id"].eqNullSafe(notices["doc_id"]) & (whole["text_digest"] == notices["text_digest"])
    return whole.join(notices, same, "left").select(
        F.col("id").alias("doc_id"), whole["text_digest"], "text_licence",
        F.coalesce("notice_lines", F.lit(0)).cast("long").alias("notice_lines"), "notice_licences")


def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _canonical_sql(text: str) -> str:
    """:func:`canonical` in DuckDB's SQL."""
    lower = f"regexp_replace(lower(coalesce({text}, '')), {_sql_text(COPYRIGHT)}, '', 'g')"
    # Two spaces between words, so that neighbours do not share one.
    words = f"'  ' || regexp_replace({lower}, '[^\\p{{L}}\\p{{N}}]+', '  ', 'g') || '  '"
    for other, usual in SPELLINGS:
        words = f"replace({words}, ' {other.replace(' ', '  ')} ', ' {usual.replace(' ', '  ')} ')"
    return f"trim(regexp_replace({words}, ' +', ' ', 'g'))"


ORACLE_SQL = f"""
WITH known AS (
  SELECT DISTINCT sha256({_canonical_sql('text')}) AS digest, licence
  FROM (VALUES {', '.join(f'({_sql_text(i)}, {_sql_text(t)})' for i, t in KNOWN)}) AS v(licence, text)),
texts AS (SELECT doc_id, text, sha256({_canonical_sql('text')}) AS text_digest FROM documents),
lines AS (
  SELECT doc_id, text_digest, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS line_no
  FROM texts),
notices AS (
  SELECT l.doc_id, l.text_digest, count(DISTINCT line_no) AS notice_lines,
         string_agg(DISTINCT licence, ',' ORDER BY licence) AS notice_licences
  FROM (SELECT *, sha256({_canonical_sql('line')}) AS digest FROM lines) l JOIN known USING (digest)
  GROUP BY ALL)
SELECT t.doc_id, t.text_digest, k.licence AS text_licence,
       CAST(coalesce(n.notice_lines, 0) AS BIGINT) AS notice_lines, n.notice_licences
FROM texts t LEFT JOIN known k ON k.digest = t.text_digest
LEFT JOIN notices n ON n.doc_id IS NOT DISTINCT FROM t.doc_id AND n.text_digest = t.text_digest
"""
