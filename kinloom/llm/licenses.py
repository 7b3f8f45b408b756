"""License scan: an exact set-similarity join of text blocks with license templates, beside plain phrases.

A template is the set of its words, beside words it ``needs`` (those that tell it from its neighbours) and words it
``bars``. Its blocks are the windows of twice its length in words, one at every multiple of its length (and the whole
text if that is shorter): any passage of the template's length lies inside one. A block meets a template if it holds at
least ``threshold`` of the template's words, all that it needs and none that it bars. The filters that find all such pairs:
 - words stand in one global order, the rarest first, by counts over all documents;
 - prefix: of a template with n words, needing a = ceil(threshold * n), a block must hold one of the n - a + 1 rarest;
 - length: a block with under a distinct words can't hold a of them;
 - positional: from the rarest prefix word a block holds, no more than the words behind it can match.
What passes is counted in full. Templates are a stated set of at most ``MAX_TEMPLATE_WORDS`` words, sent to all tasks.

Null or empty text: no words, no places, no labels, score 0. Repeated rows, and rows without an id, each get a row. An
empty table gives no rows; other columns are not touched.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_bytes, tune
from .decontaminate import words_of

MAX_TEMPLATE_WORDS = 100_000

#: Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Label, text (a whole license or the notice that its publisher recommends), words needed, words barred.
#: Several templates may share a label.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0", "apache 2", ""),
    ("apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
        the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
        applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
        governing permissions and limitations under the License.""", "apache", ""),
    ("mit", "Released under the MIT License", "mit license", ""),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to
        permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright
        notice and this permission notice shall be included in all copies or substantial portions of the Software. THE
        SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
        WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
        COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
        OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""", "permission sublicense", ""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
        WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
        PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
        INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
        GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
        LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT
        OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""", "redistributions", ""),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "redistribution binary", ""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
        PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
        WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT,
        OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION
        OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
        THIS SOFTWARE.""", "fee disclaims", ""),
    ("gpl", "This work is licensed under the GNU General Public License, version 3", "gnu general public", "lesser affero"),
    ("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
        details. You should have received a copy of the GNU General Public License along with this program. If not, see
        https://www.gnu.org/licenses/""", "gnu general public", "lesser affero"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", "gnu lesser", ""),
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation", "gnu affero", ""),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mozilla 2", ""),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License", "creative commons attribution", "noncommercial noderivatives sharealike nc nd sa"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "creative commons sharealike", "noncommercial"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", "creative commons noncommercial", "noderivatives sharealike"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", "cc by nc", "nd sa"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work", "waived neighboring", ""),
]


class Template:
    """What the join knows of a template; the words in ``order`` stand as ``frequency`` has them."""

    def __init__(self, label: str, text: str, needs: str, bars: str, frequency: dict[bytes, int], threshold: float):
        listed = words_of(text.encode())
        self.label, self.step = label, max(len(listed), 1)
        self.order = sorted(set(listed), key=lambda w: (frequency.get(w, 0), w))
        self.words = frozenset(self.order)
        self.least = max(1, math.ceil(threshold * len(self.order) - 1e-9))
        self.needs, self.bars = frozenset(needs.encode().split()), frozenset(bars.encode().split())


class Join:
    def __init__(self, templates: list[tuple[str, str, str, str]], frequency: dict[bytes, int], threshold: float):
        self.templates = [Template(*t, frequency, threshold) for t in templates]
        self.prefix: dict[bytes, list[tuple[int, int]]] = {}
        for k, t in enumerate(self.templates):
            for place, w in enumerate(t.order[: len(t.order) - t.least + 1]):
                self.prefix.setdefault(w, []).append((k, place))
        self.keys = frozenset(self.prefix)

    def matches(self, words: list[bytes]) -> dict[int, float]:
        """Template to its largest containment, for those that reach the threshold in a block."""
        present = self.keys.intersection(words)
        if not present:
            return {}
        spots: dict[int, dict[int, int]] = {}
        last = len(words) - 1
        for at, w in enumerate(words):
            if w in present:
                for k, place in self.prefix[w]:
                    step = self.templates[k].step
                    final = max(0, -(-(last + 1 - 2 * step) // step))
                    for block in range(max(0, at // step - 1), min(at // step, final) + 1):
                        known = spots.setdefault(k, {})
                        known[block] = min(place, known.get(block, place))
        out: dict[int, float] = {}
        for k, blocks in spots.items():
            t = self.templates[k]
            for block, place in blocks.items():
                if len(t.order) - place < t.least:  # positional filter
                    continue
                text = set(words[block * t.step : (block + 2) * t.step])
                if len(text) < t.least:  # length filter
                    continue
                found = len(t.words & text)
                if found >= t.least and t.needs <= text and not t.bars & text:
                    out[k] = max(out.get(k, 0.0), found / len(t.order))
        return out


def phrase_places(words: list[bytes], phrases: dict[bytes, str]) -> list[tuple[int, str]]:
    """(word place, label) of every occurrence of every phrase."""
    line = b" " + b" ".join(words) + b" "
    out = []
    for phrase, label in phrases.items():
        want, at, place, seen = b" " + phrase + b" ", line.find(b" " + phrase + b" "), 0, 0
        while at >= 0:
            place += line.count(b" ", seen, at)
            seen = at
            out.append((place, label))
            at = line.find(want, at + 1)
    return sorted(out)


def word_frequencies(docs: DataFrame, templates: list[tuple[str, str, str, str]]) -> dict[bytes, int]:
    """Occurrences of the templates' words in all of ``docs``; at most as many numbers as the templates have words."""
    vocabulary = frozenset(w for _, t, *_ in templates for w in words_of(t.encode()))
    if len(vocabulary) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates may have {MAX_TEMPLATE_WORDS} different words at most")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                total.update(filter(vocabulary.__contains__, words_of(text.as_py())))
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

    rows = docs.select(text_bytes().alias("text")).mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r.word): r.n for r in rows.collect()}


OUT = "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double"


def scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, threshold: float = 0.8) -> DataFrame:
    """One row per document; score is 1 with a phrase, else the largest containment that reaches the threshold."""
    tune(docs.sparkSession)
    frequency = word_frequencies(docs, templates)
    plain = {b" ".join(words_of(p.encode())): label for p, label in phrases.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        join = Join(templates, frequency, threshold)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64())
        names = [x.split(" ")[0] for x in OUT.split(", ")]
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = words_of(text.as_py())
                places = phrase_places(words, plain)
                found = join.matches(words)
                base = sorted({label for _, label in places})
                labels = sorted({*base, *(templates[k][0] for k in found)})
                rows.append((doc_id, len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None, ",".join(base), ",".join(labels), 1.0 if places else max(found.values(), default=0.0)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text")).mapInArrow(run, OUT)


def sql(templates=TEMPLATES, phrases=PHRASES, threshold: float = 0.8) -> str:
    """DuckDB SQL for ``scan``: every block against every template, without filters."""
    listed = lambda ws: "[" + ", ".join(f"'{w.decode()}'" for w in sorted(ws)) + "]::VARCHAR[]"
    known = [Template(*t, {}, threshold) for t in templates]
    rows = ",\n  ".join(f"({k}, '{t.label}', {t.step}, {t.least}, {listed(t.words)}, {listed(t.needs)}, {listed(t.bars)})" for k, t in enumerate(known))
    place = lambda p: "list_filter(range(0, len(w)), lambda i: " + " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(p.split(), 1)) + ")"
    found = [f"{place(p)} AS p{k}" for k, p in enumerate(phrases)]
    every = "flatten([" + ", ".join(f"p{k}" for k in range(len(phrases))) + "])"
    base = "list_filter([" + ", ".join(f"CASE WHEN len(p{k}) > 0 THEN '{v}' END" for k, v in enumerate(phrases.values())) + "], lambda x: x IS NOT NULL)"
    return rf"""
WITH t(k, label, step, least, words, needs, bars) AS (VALUES {rows}),
d AS (SELECT row_number() OVER () AS n, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
p AS (SELECT n, doc_id, len(w)::BIGINT AS n_words, {', '.join(found)} FROM d),
b AS (SELECT n, doc_id, n_words, {every} AS places, {base} AS base FROM p),
blocks AS (SELECT n, k, label, least, words, needs, bars, unnest(range(0, (greatest(0, (len(w) - 2 * step + step - 1) // step) + 1)::BIGINT)) AS i, step, w FROM d, t WHERE len(list_intersect(words, w)) >= least),
met AS (SELECT n, label, words, least, needs, bars, list_distinct(w[i * step + 1 : (i + 2) * step]) AS s FROM blocks),
hits AS (SELECT n, label, len(list_intersect(words, s))::DOUBLE / len(words) AS share FROM met WHERE len(list_intersect(words, s)) >= least AND len(list_intersect(needs, s)) = len(needs) AND len(list_intersect(bars, s)) = 0),
best AS (SELECT n, list(DISTINCT label) AS labels, max(share) AS share FROM hits GROUP BY n)
SELECT doc_id, n_words, len(places)::BIGINT AS n_base, list_min(places)::BIGINT AS first_word, list_max(places)::BIGINT AS last_word,
  array_to_string(list_sort(list_distinct(base)), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(base, coalesce(labels, []::VARCHAR[])))), ',') AS labels,
  CASE WHEN len(places) > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0::DOUBLE) END AS score
FROM b LEFT JOIN best USING (n)
"""
