"""Licence scan by canonical digest lookup, in DataFrame functions only.

A text's canonical form has lower case, no copyright lines, no title line, one
spelling of words that licences spell two ways, and only letters and digits,
single-spaced.  A copyright line names a year, a mark or a holder and stands on
a line of its own; sentences of a licence stay wherever its lines are broken.
A title line ("The MIT License (MIT)") is a first line that names a licence and
is no sentence, with more text behind it.
Its digest is joined by hash with the digests of known licence texts; a
document whose entire text is a known licence gets the licence's id.  Each
line of a document is an entire text too: lines that are known notices
("Released under the MIT License.") give the document's notices.

Known texts are a table (license_id, text), canonicalised by the same
expression, so a caller's own corpus of licences can be passed in
(``known_from_files`` reads one from a folder of licence files);
``KNOWN_TEXTS`` holds short licences and common notices.  The table is one of
licences, so its first words are a short list; a line is digested only if it
begins with one of them, which no line that could match fails to do.

Digests of whole texts and of the lines that could be notices are computed in
one pass; from there on only digests are joined, so texts of any size and
lines that repeat everywhere never meet in a task.

Defined results: a null text counts as empty; texts without letters or digits
have the digest of the empty text and match nothing; when known texts share a
digest the least license_id counts; repeated rows give repeated results and an
empty table an empty one; only the asked columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WorkTables, tag_rows

# Spellings made equal: fixed values (whole words in lower case).
SPELLINGS = [
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sublicence", "sublicense"),
    ("sub license", "sublicense"), ("sub licence", "sublicense"), ("acknowledgement", "acknowledgment"),
    ("merchantibility", "merchantability"), ("non commercial", "noncommercial"), ("non infringement", "noninfringement"),
    ("copyright owner", "copyright holder"), ("copyright owners", "copyright holders"), ("organisation", "organization"),
    ("favour", "favor"), ("whilst", "while"), ("per cent", "percent"), ("http", "https"), ("version 2 0", "version 2"),
]

# Known licence texts and notices: fixed values.
KNOWN_TEXTS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "Apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License.""",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT-notice": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "BSD-3-notice": "Licensed under the BSD 3-Clause License.",
}

#: Words that follow "copyright" inside a licence's sentences, not in a copyright line.
BODY = ("holders?|owners?|ownership|notices?|laws?|licen[cs]es?|interests?|statements?|disclaimers?|infringements?|"
        "permissions?|protections?|treat(?:y|ies)|acts?|claims?|rights?|status|terms?|conditions?|information|messages?|"
        "materials?|works?|doctrines?|exceptions?|patents?|the (?:software|program|library|work)|and|or|in|is|are|as|to|on|"
        "of|for|that|which|this|may|will|shall|must|can|with|under|from|at|if|has|have|does|applies|notwithstanding")
#: A copyright line by itself: a mark, a year or a name follows.  "(c)" is also a list item, so a name there is a short line.
COPYRIGHT_LINE = (
    r"^[^\p{L}\p{N}\n]*(?:all rights reserved|©"
    rf"|(?:\(c\)[^\p{{L}}\p{{N}}\n]*)?copyright(?:[^\p{{L}}\p{{N}}\n]*(?:(?:19|20)\d\d|\(c\)|©)"
    rf"|[^\p{{L}}\p{{N}}\n,.;)]+(?!(?:{BODY})\b)\p{{L}})"
    r"|\(c\)[^\p{L}\p{N}\n]*(?:(?:19|20)\d\d|©)"
    rf"|\(c\)[ \t]+(?!(?:you|your|a|an|any|all|each|every|no|not|neither|such|it|its|by|copyright|{BODY})\b)"
    r"(?:\S+[ \t]+){0,5}\S*[^\s;,:][ \t\r]*$)[^\n]*$")
#: A title: up to nine words that are no sentence's, "licence", and perhaps a version or a name in brackets.
SENTENCE = "licen[cs]ed|under|released|permission|granted|this|see|terms|may|you|your|is|are|by"
TITLE = (rf"\A[^\p{{L}}\p{{N}}]*(?:(?!(?:{SENTENCE})\b)[\p{{L}}\p{{N}}.,'\"+-]+[ \t]+){{0,9}}licen[cs]e"
         r"(?:[ \t,]+(?:version|v\.?)?[ \t]*[0-9][0-9.]*)?(?:[ \t]*\([^()\n]{0,40}\))?[ \t.:\r]*\n(?=[^\p{L}\p{N}]*[\p{L}\p{N}])")


def bare(line: Column) -> Column:
    """Lower case, letters and digits only, single-spaced, one spelling."""
    c = F.concat(F.lit(" "), F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}]+", "  "), F.lit(" "))
    for old, new in SPELLINGS:  # words stand between two blanks, so neighbours don't share one
        c = F.replace(c, F.lit(f" {old.replace(' ', '  ')} "), F.lit(f" {new.replace(' ', '  ')} "))
    return F.trim(F.regexp_replace(c, " +", " "))


def canonical(text: Column) -> Column:
    """The canonical form of an entire text: copyright and title lines go, then all lines run together."""
    kept = F.regexp_replace(F.lower(F.coalesce(text.cast("string"), F.lit(""))), "(?md)" + COPYRIGHT_LINE, " ")
    return bare(F.regexp_replace(kept, TITLE, ""))


def digest(canon: Column) -> Column:
    return F.sha2(canon, 256)


def known_digests(known: DataFrame) -> DataFrame:
    """(digest, license_id) of a table (license_id, text)."""
    canon = canonical(F.col("text"))
    return (known.where(F.col("license_id").isNotNull() & (canon != "")).groupBy(digest(canon).alias("digest"))
            .agg(F.min("license_id").alias("license_id")))


def known_texts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(KNOWN_TEXTS.items()), "license_id string, text string")


def known_from_files(spark: SparkSession, folder: str) -> DataFrame:
    """(license_id, text) of a folder of licence files, named by their licence."""
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.(?:txt|md|template))?$", 1)
    return spark.read.text(folder, wholetext=True).select(name.alias("license_id"), F.col("value").alias("text"))


def first_words(known: DataFrame) -> list[str]:
    """The words, in lower case and every spelling, that a line must begin with to be a known text; one per licence at most,
    and its spellings."""
    canon = canonical(F.col("text"))
    begins = {r[0] for r in known.where(F.col("license_id").isNotNull() & (canon != "")).select(
        F.substring_index(canon, " ", 1)).distinct().collect()}
    return sorted(begins | {old.split(" ")[0] for old, new in SPELLINGS if new.split(" ")[0] in begins})


def scan(docs: DataFrame, known: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns, digest, license_id (of the whole text, else null) and notices (of lines, comma-joined)."""
    tables = WorkTables(docs.sparkSession, "licenses")
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    begins = first_words(known)
    lines = F.filter(F.split(t, "\n"), lambda x: F.lower(F.regexp_extract(x, r"[\p{L}\p{N}]+", 0)).isin(*begins))
    rows = tables.keep(tag_rows(docs.select(
        *keep, digest(canonical(t)).alias("digest"),
        F.array_distinct(F.transform(lines, lambda x: digest(canonical(x)))).alias("_lines"))), "digests")
    table = known_digests(known)
    notices = (rows.select("_pos", F.explode("_lines").alias("_line"))
               .join(table, F.col("_line") == table["digest"]).groupBy("_pos")
               .agg(F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias("notices"))
               .withColumnRenamed("_pos", "_at"))
    return (rows.join(table, "digest", "left").join(notices, F.col("_pos") == F.col("_at"), "left")
            .select(*keep, "digest", "license_id", F.coalesce("notices", F.lit("")).alias("notices")))


def license_report(docs: DataFrame) -> DataFrame:
    """The columns of the registered query."""
    return scan(docs, known_texts(docs.sparkSession), ["doc_id"])


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _sql_copyright(line: str) -> str:
    """COPYRIGHT_LINE on one line in lower case; without look-ahead, so by what follows and what must not."""
    gap, start = r"[^\p{L}\p{N}]*", r"^[^\p{L}\p{N}]*"
    word = rf"{start}(?:\(c\){gap})?copyright[^\p{{L}}\p{{N}},.;)]+"
    listed = r"you|your|a|an|any|all|each|every|no|not|neither|such|it|its|by|copyright|" + BODY
    rules = [rf"{start}(?:all rights reserved|©)", rf"{start}(?:\(c\){gap})?copyright{gap}(?:(?:19|20)\d\d|\(c\)|©)",
             rf"{start}\(c\){gap}(?:(?:19|20)\d\d|©)"]
    found = [f"regexp_matches({line}, {_sql_text(r)})" for r in rules]
    for good, bad in ((word + r"\p{L}", rf"{word}(?:{BODY})\b"),
                      (start + r"\(c\)[ \t]+(?:\S+[ \t]+){0,5}\S*[^\s;,:][ \t\r]*$", rf"{start}\(c\)[ \t]+(?:{listed})\b")):
        found.append(f"(regexp_matches({line}, {_sql_text(good)}) AND NOT regexp_matches({line}, {_sql_text(bad)}))")
    return "(" + " OR ".join(found) + ")"


def _sql_title(text: str) -> str:
    """The text without its title line."""
    head = (r"^[^\p{L}\p{N}]*((?:[\p{L}\p{N}.,'\"+-]+[ \t]+){0,9})licen[cs]e"
            r"(?:[ \t,]+(?:version|v\.?)?[ \t]*[0-9][0-9.]*)?(?:[ \t]*\([^()\n]{0,40}\))?[ \t.:\r]*\n")
    sentence = rf"(?:^|[ \t])(?:{SENTENCE})\b"
    return (f"CASE WHEN regexp_matches({text}, {_sql_text(head + r'[^' + chr(92) + 'p{L}' + chr(92) + 'p{N}]*[' + chr(92) + 'p{L}' + chr(92) + 'p{N}]')}) "
            f"AND NOT regexp_matches(regexp_extract({text}, {_sql_text(head)}, 1), {_sql_text(sentence)}) "
            f"THEN regexp_replace({text}, {_sql_text(head)}, '') ELSE {text} END")


def _sql_canonical(text: str) -> str:
    kept = (f"array_to_string(list_transform(string_split(lower({text}), chr(10)), "
            f"lambda x: CASE WHEN {_sql_copyright('x')} THEN ' ' ELSE x END), chr(10))")
    c = rf"' ' || regexp_replace({_sql_title(kept)}, '[^\p{{L}}\p{{N}}]+', '  ', 'g') || ' '"
    for old, new in SPELLINGS:
        c = f"replace({c}, ' {old.replace(' ', '  ')} ', ' {new.replace(' ', '  ')} ')"
    return f"trim(regexp_replace({c}, ' +', ' ', 'g'))"


ORACLE = f"""
WITH texts(license_id, text) AS (VALUES {', '.join(f'({_sql_text(k)}, {_sql_text(v)})' for k, v in KNOWN_TEXTS.items())}),
known AS (SELECT sha256({_sql_canonical('text')}) AS digest, min(license_id) AS license_id FROM texts GROUP BY 1),
d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
l AS (SELECT DISTINCT rid, sha256({_sql_canonical('line')}) AS line
      FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d)),
n AS (SELECT rid, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notices
      FROM l JOIN known ON line = digest GROUP BY rid)
SELECT doc_id, sha256({_sql_canonical('t')}) AS digest, license_id, coalesce(notices, '') AS notices
FROM d LEFT JOIN known ON known.digest = sha256({_sql_canonical('t')}) LEFT JOIN n USING (rid)
"""
