"""Licence scans by sentence rules.

A text is normalised into one line of words a sentence, whatever its line ends: sentences end at a full stop, question or
exclamation mark before white space, or at a blank line. Known licence sentences are recognised in them, as a whole or as a clause
("docs under CC BY 4.0"), and give a sequence of identifiers, which is matched against ordered licence rules, the first that fits at a
place taking its sentences. Unknown sentences between known ones don't part a rule's sequence if they are no more than GAP.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import small_batches

#: Unknown sentences that may stand between two of one rule (headings, list numbers, names).
GAP = 2
# Identifier -> normalised sentence. {v} stands for a version number, {who} for any words of the sentence, {end} for its rest, {alone} for a sentence's bound, at its beginning, too.
SENTENCES = {
    "apache-ref": "under (the )?(terms of the )?apache( software foundation)? licen[sc]e( {v})?",
    "apache-use": "you may not use this file except in compliance with the licen[sc]e",
    "apache-copy": "you may obtain a copy of the licen[sc]e at{end}",
    "apache-asis": "unless required by applicable law or agreed to in writing software distributed under the licen[sc]e is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-see": "see the licen[sc]e for the specific language governing permissions and limitations under the licen[sc]e",
    "mit-ref": "under (the )?(terms of the )?mit licen[sc]e",
    "mit-name": "((the )?mit licen[sc]e( mit)?|licen[sc]e mit)( copyright|{alone})",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction{end}",
    "mit-notice": "the above copyright notice and this permission notice (including the next paragraph )?shall be included in all copies or substantial portions of the software",
    "mit-asis": "the software is provided as is without warranty of any kind express or implied{end}",
    "mit-liable": "in no event shall the authors or copyright holders be liable for any claim damages or other liability{end}",
    "gpl-ref": "under (the )?(terms of the )?(gnu )?(general public licen[sc]e( gpl)?|gpl)( licen[sc]e)?( ?{v})?",
    "gpl-free": "this {who} is free software you can redistribute it and/?or modify it under the terms of the gnu (?P<kind>lesser |affero )?general public licen[sc]e as published by the free software foundation either {v} of the licen[sc]e or at your option any later version",
    "gpl-hope": "this {who} is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-see": "see the gnu (lesser |affero )?general public licen[sc]e for more details",
    "gpl-copy": "you should have received a copy of the gnu (lesser |affero )?general public licen[sc]e along with this {who}{end}",
    "lgpl-ref": "under (the )?(terms of the )?(gnu )?(lesser general public licen[sc]e( lgpl)?|lgpl)( licen[sc]e)?( ?{v})?",
    "agpl-ref": "under (the )?(terms of the )?(gnu )?(affero general public licen[sc]e( agpl)?|agpl)( licen[sc]e)?( ?{v})?",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and/?or other materials provided with the distribution",
    "bsd-names": "neither the name of {who} nor the names of {who} may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-asis": "this software is provided by {who} as is and any express or implied warranties {who} are disclaimed",
    "bsd-ref": "under (the )?(terms of the )?bsd (?P<clauses>\\d|two|three) clause licen[sc]e",
    "mpl-form": "this source code form is subject to the terms of the mozilla public licen[sc]e( {v})?",
    "mpl-copy": "if a copy of the mpl was not distributed with this file you can obtain one at{end}",
    "mpl-ref": "under (the )?(terms of the )?(mozilla public licen[sc]e( mpl)?|mpl)( ?{v})?",
    "isc-grant": "permission to use copy modify and/?or distribute this software for any purpose with or without fee is hereby granted{end}",
    "isc-ref": "under (the )?(terms of the )?isc licen[sc]e",
    "cc-ref": "under (a |the )?(creative commons|cc) (?P<cc>by( (nc|sa|nd)){0,2}|zero|0|attribution( (noncommercial|sharealike|noderivatives)){0,2})( {v})?",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "spdx": "spdx identifier (?P<spdx>[\\w.+\u2011]+( (and|or|with) [\\w.+\u2011]+)*)",
    "reserved": "all rights reserved",
}
# Rules in order; a longer sequence stands before the shorter ones it begins with. Names in braces are those of the sentences' groups.
RULES = (
    ("Apache-{v}", ("apache-ref", "apache-use", "apache-copy", "apache-asis", "apache-see")),
    ("Apache-{v}", ("apache-ref", "apache-use", "apache-copy")),
    ("Apache-{v}", ("apache-ref",)),
    ("MIT", ("mit-name", "mit-grant", "mit-notice", "mit-asis", "mit-liable")),
    ("MIT", ("mit-ref", "mit-grant", "mit-notice", "mit-asis", "mit-liable")),
    ("MIT", ("mit-grant", "mit-notice", "mit-asis", "mit-liable")),
    ("MIT", ("mit-grant", "mit-notice", "mit-asis")),
    ("MIT", ("mit-ref",)),
    ("MIT", ("mit-name",)),
    ("{kind}GPL-{v}-or-later", ("gpl-free", "gpl-hope", "gpl-see", "gpl-copy")),
    ("{kind}GPL-{v}-or-later", ("gpl-free", "gpl-hope")),
    ("{kind}GPL-{v}-or-later", ("gpl-free",)),
    ("LGPL-{v}", ("lgpl-ref",)),
    ("AGPL-{v}", ("agpl-ref",)),
    ("GPL-{v}", ("gpl-ref",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names", "bsd-asis")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-asis")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("BSD-{clauses}-Clause", ("bsd-ref",)),
    ("MPL-{v}", ("mpl-form", "mpl-copy")),
    ("MPL-{v}", ("mpl-form",)),
    ("MPL-{v}", ("mpl-ref",)),
    ("ISC", ("isc-grant",)),
    ("ISC", ("isc-ref",)),
    ("CC-{cc}-{v}", ("cc-ref",)),
    ("Unlicense", ("unlicense",)),
    ("{spdx}", ("spdx",)),
    ("All-rights-reserved", ("reserved",)),
)
# How rule names show what their sentences say.
SHOWN = {
    "lesser ": "L", "affero ": "A", "two": "2", "three": "3", "attribution": "BY", "noncommercial": "NC", "sharealike": "SA", "noderivatives": "ND", "zero": "0",
}
#: Every form of every sentence has one of these words; found by the JVM, in texts without quotes, before any text goes to Python.
#: Single words alone: blanks in a sentence may be line ends or punctuation.
HINT = r"(?i)licen[sc]e|permission|redistribut|unencumbered|reserved|warrant|liab|gpl|mpl|commons|\bcc\b"
_SPDX = re.compile(r"spdx-licen[sc]e-identifier\s*:\s*([\w.+-]+(?:\s+(?:and|or|with)\s+[\w.+-]+)*)")
#: Comment signs and rules at a line's beginning or end, which would part words or make a line seem no blank one.
_MARGIN = re.compile(r"(?m)^[^\S\n]*(?:[*#;/|>%-]|<!--)+(?=\s|$)|[^\S\n]*(?:\*+/|-->|[*#|/-]+)?[^\S\n]*$")
_BOUND = re.compile(r"(?<!\d)[.!?]+[\"')\]]*\s+(?=\D)(?<!v\.\s)|\n\s*\n|\Z")
_DROP = re.compile("[^\\w./+\u2011]+|(?<!\\d)\\.|\\.(?!\\d)|/(?!\\w)")
_NOT = re.compile(r"\bnot (?:\w+ ){0,2}$")


def _compiled() -> dict[str, list[tuple[str, re.Pattern]]]:
    """First word -> its (identifier, pattern). A pattern begins at a word and doesn't pass a sentence's bound."""
    fill = {"{v}": r"(?:version ?|v ?)?(?P<v>\d+(?:\.\d+)*)", " {who}": r" [^\n]+?", "{end}": r"[^\n]*", "{alone}": r"(?=\n)"}
    out: dict[str, list[tuple[str, re.Pattern]]] = {}
    for name, p in SENTENCES.items():
        first = "mit licence license the".split() if name == "mit-name" else [p.split(" ", 1)[0]]
        for k, x in fill.items():
            p = p.replace(k, x, 1) if k == "{v}" else p.replace(k, x)
        if "(?=\\n)" in p:
            p = "(?<=\\n)" + p
        for word in first:
            out.setdefault(word, []).append((name, re.compile(p + r"(?![\w+])" if not p.endswith("*") else p)))
    return out


def normalised(text: str) -> str:
    """Sentences of lower-case words between line ends: no comment signs, no punctuation but for points between digits, single spaces."""
    text = _SPDX.sub(lambda m: "spdx identifier " + m[1].replace("-", "\u2011"), text.lower())
    parts = _BOUND.split(_MARGIN.sub("", text.replace("\r\n", "\n")))
    words = (" ".join(_DROP.sub(" ", x.replace("'", "").replace('"', "")).split()) for x in parts)
    return "\n" + "\n".join(x for x in words if x) + "\n"


def identified(text: str, heads=None) -> list[tuple[str, dict[str, str], int, int]]:
    """(identifier, what its groups say, sentences before its beginning and its end) of each known sentence, in order."""
    heads = heads or _compiled()
    line = normalised(text)
    out, at, seen, sentence = [], 0, 0, 0
    for m in re.finditer(r"(?:(?<= )|(?<=\n))(?:" + "|".join(heads) + r")(?= |\n)", line):
        if m.start() < at:
            continue
        hits = [(name, got) for name, p in heads[m[0]] if (got := p.match(line, m.start()))]
        if not hits or (m[0] == "under" and _NOT.search(line, max(0, m.start() - 60), m.start())):
            continue
        name, got = max(hits, key=lambda x: x[1].end())
        at = got.end()
        before = sentence + line.count("\n", seen, m.start())
        sentence, seen = before + line.count("\n", m.start(), at), at
        out.append((name, {k: v for k, v in got.groupdict().items() if v}, before, sentence))
    return out


def licences(found: list[tuple[str, dict[str, str], int, int]]) -> list[str]:
    """The licences whose rules the identifiers fit, in order of place."""
    out, i = [], 0
    while i < len(found):
        for name, needs in RULES:
            got = found[i : i + len(needs)]
            if tuple(x[0] for x in got) == needs and all(b[2] - a[3] <= GAP + 1 for a, b in zip(got, got[1:])):
                says = {"v": "unversioned", "kind": "", "cc": "", "spdx": "", "clauses": ""} | {k: v for x in reversed(got) for k, v in x[1].items()}
                says["kind"], says["clauses"] = SHOWN.get(says["kind"], ""), SHOWN.get(says["clauses"], says["clauses"])
                says["cc"] = "-".join(SHOWN.get(w, w.upper()) for w in says["cc"].split())
                says["spdx"] = says["spdx"].replace("\u2011", "-").replace(" ", "-")
                out.append(name.format(**says))
                i += len(needs)
                break
        else:
            i += 1
    return out


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    heads = _compiled()
    for batch in batches:
        ids, names = [], []
        for text in batch.column("text"):
            found = identified(text.as_py(), heads) if text.is_valid else []
            ids.append(",".join(x[0] for x in found))
            names.append(",".join(dict.fromkeys(licences(found))))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.string()), pa.array(names, pa.string())], ["doc_id", "sentence_ids", "licences"])


def scan_licences(docs: DataFrame) -> DataFrame:
    """doc_id, sentence_ids, licences (comma-joined, in order, '' if none) for each row of ``docs``.

    Null and empty texts have none. Texts and sentences of any length are read whole, however their lines are wrapped. Where two known
    sentences begin at one word the longer counts. Nothing is shuffled, and only texts with a word that every licence sentence needs go to
    Python. Repeated rows and rows without an id keep a row each; an empty table gives none; other columns, whatever their names, are ignored.
    """
    small_batches(docs.sparkSession)
    hinted = F.when(F.translate("text", "'\"", "").rlike(HINT), F.col("text"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), hinted.alias("text")).mapInArrow(_scan, "doc_id long, sentence_ids string, licences string")
