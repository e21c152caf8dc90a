"""Licence recognition by sentence identifiers and ordered rules."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

#: Known licence sentences, normalised, by identifier.
SENTENCES = {
    "cc-by-nc-4": "licensed under cc by nc 4 0",
    "gpl-3": "this work is licensed under the gnu general public license version 3",
    "apache-2": "licensed under the apache license version 2 0",
    "apache-2-compliance": "you may not use this file except in compliance with the license",
    "apache-2-copy": "you may obtain a copy of the license at",
    "mit": "released under the mit license",
}
#: (rule, licence, ordered sentence identifiers).
RULES = (
    ("apache-2-header", "Apache-2.0", ("apache-2", "apache-2-compliance", "apache-2-copy")),
    ("apache-2-short", "Apache-2.0", ("apache-2", "apache-2-compliance")),
    ("apache-2-line", "Apache-2.0", ("apache-2",)),
    ("cc-by-nc-4-line", "CC-BY-NC-4.0", ("cc-by-nc-4",)),
    ("gpl-3-line", "GPL-3.0", ("gpl-3",)),
    ("mit-line", "MIT", ("mit",)),
)
#: Genuine full sentences of licence texts, normalised; found across wrapped lines and comment leaders.
TEXTS = {
    "mit-full-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-full-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-full-warranty": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "bsd-head": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "apache-full": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
    "apache-asf": "the asf licenses this file to you under the apache license version 2 0 the license you may not use this file except in compliance with the license",
    "apache-at": "you may obtain a copy of the license at",
    "apache-at-http": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "apache-at-https": "you may obtain a copy of the license at https www apache org licenses license 2 0",
    "apache-unless": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "isc-grant-and": "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "isc-warranty": "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "mpl-2-form": "this source code form is subject to the terms of the mozilla public license v",
    "mpl-2-at-http": "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    "mpl-2-at-https": "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    "bsl-1": "distributed under the boost software license version 1 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "unlicense-grant": "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
    "zlib-warranty": "this software is provided as is without any express or implied warranty",
    "zlib-grant": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
}
#: Sentences known by their end, as a name stands in them.
ENDS = {"bsd-name": "may be used to endorse or promote products derived from this software without specific prior written permission"}
TEXT_RULES = (
    ("mit-full", "MIT", ("mit-full-grant", "mit-full-notice", "mit-full-warranty")),
    ("mit-full-short", "MIT", ("mit-full-grant", "mit-full-notice")),
    ("mit-full-end", "MIT", ("mit-full-notice", "mit-full-warranty")),
    *((f"{k}-line", "MIT", (k,)) for k in ("mit-full-grant", "mit-full-notice", "mit-full-warranty")),
    ("bsd-3-full", "BSD-3-Clause", ("bsd-head", "bsd-source", "bsd-binary", "bsd-name")),
    ("bsd-3-conditions", "BSD-3-Clause", ("bsd-source", "bsd-binary", "bsd-name")),
    ("bsd-3-end", "BSD-3-Clause", ("bsd-binary", "bsd-name")),
    ("bsd-2-full", "BSD-2-Clause", ("bsd-head", "bsd-source", "bsd-binary")),
    ("bsd-2-conditions", "BSD-2-Clause", ("bsd-source", "bsd-binary")),
    *((f"{first}-{at}", "Apache-2.0", (first, at, "apache-unless")) for first in ("apache-full", "apache-asf") for at in ("apache-at", "apache-at-http", "apache-at-https")),
    *((f"{k}-line", "Apache-2.0", (k,)) for k in ("apache-full", "apache-asf", "apache-at-http", "apache-at-https", "apache-unless")),
    *((f"{k}-full", "ISC", (k, "isc-warranty")) for k in ("isc-grant", "isc-grant-and")),
    *((f"{k}-line", "ISC", (k,)) for k in ("isc-grant", "isc-grant-and", "isc-warranty")),
    *((f"{k}-header", "MPL-2.0", ("mpl-2-form", k)) for k in ("mpl-2-at-http", "mpl-2-at-https")),
    *((f"{k}-line", "MPL-2.0", (k,)) for k in ("mpl-2-at-http", "mpl-2-at-https")),
    ("bsl-1-line", "BSL-1.0", ("bsl-1",)),
    ("unlicense-text", "Unlicense", ("unlicense", "unlicense-grant")),
    ("unlicense-line", "Unlicense", ("unlicense",)),
    ("zlib-text", "Zlib", ("zlib-warranty", "zlib-grant")),
    ("zlib-line", "Zlib", ("zlib-grant",)),
)
#: Further licences: identifier, its sentences in their order, and how many of the first ones tell it by themselves.
FURTHER = (
    ("MIT", "mit-liability", ("in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",), 1),
    ("MIT-0", "mit-0", ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so",), 1),
    ("0BSD", "0bsd", ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",), 1),
    ("ISC", "isc-liability", ("in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software",), 1),
    ("Zlib", "zlib-origin", ("the origin of this software must not be misrepresented you must not claim that you wrote the original software", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software", "this notice may not be removed or altered from any source distribution"), 3),
    ("BSL-1.0", "bsl-grant", ("permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following",), 1),
    ("NCSA", "ncsa", ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal with the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",), 1),
    ("PostgreSQL", "postgresql", ("permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies",), 1),
    ("HPND", "hpnd", ("permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted provided that the above copyright notice appear in all copies and that both that copyright notice and this permission notice appear in supporting documentation",), 1),
    ("MPL-1.1", "mpl-1.1", ("the contents of this file are subject to the mozilla public license version 1 1 the license you may not use this file except in compliance with the license", "you may obtain a copy of the license at http www mozilla org mpl", "software distributed under the license is distributed on an as is basis without warranty of any kind either express or implied"), 2),
    ("CDDL-1.0", "cddl", ("the contents of this file are subject to the terms of the common development and distribution license version 1 0 only the license",), 1),
    ("EPL-1.0", "epl-1", ("this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 which accompanies this distribution and is available at http www eclipse org legal epl v10 html",), 1),
    ("EPL-2.0", "epl-2", ("this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0",), 1),
    ("EPL-2.0", "epl-2-with", ("this program and the accompanying materials are made available under the terms of the eclipse public license v2 0 which accompanies this distribution and is available at https www eclipse org legal epl v20 html",), 1),
    ("EUPL-1.2", "eupl", ("licensed under the eupl version 1 2 or as soon they will be approved by the european commission subsequent versions of the eupl the licence", "you may not use this work except in compliance with the licence", "you may obtain a copy of the licence at"), 1),
    ("OFL-1.1", "ofl", ("this font software is licensed under the sil open font license version 1 1", "this license is copied below and is also available with a faq at https scripts sil org ofl"), 1),
    ("CC0-1.0", "cc0", ("to the extent possible under law the author s have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide", "this software is distributed without any warranty", "you should have received a copy of the cc0 public domain dedication along with this software"), 1),
    ("WTFPL", "wtfpl", ("you can redistribute it and or modify it under the terms of the do what the fuck you want to public license version 2 as published by sam hocevar",), 1),
    ("Artistic-2.0", "artistic", ("this program is free software you can redistribute it and or modify it under the terms of the artistic license 2 0",), 1),
    ("Beerware", "beerware", ("as long as you retain this notice you can do whatever you want with this stuff", "if we meet some day and you think this stuff is worth it you can buy me a beer in return"), 2),
    ("CECILL-2.1", "cecill", ("this software is governed by the cecill license under french law and abiding by the rules of distribution of free software",), 1),
    ("Unicode-3.0", "unicode", ("permission is hereby granted free of charge to any person obtaining a copy of data files and any associated documentation the data files or software and any associated documentation the software to deal in the data files or software without restriction including without limitation the rights to use copy modify merge publish distribute and or sell copies of the data files or software and to permit persons to whom the data files or software are furnished to do so provided that either a this copyright and permission notice appear with all copies of the data files or software or b this copyright and permission notice appear in associated documentation",), 1),
    ("MulanPSL-2.0", "mulan", ("you can use this software according to the terms and conditions of the mulan psl v2", "you may obtain a copy of mulan psl v2 at", "this software is provided on an as is basis without warranties of any kind either express or implied including but not limited to non infringement merchantability or fit for a particular purpose", "see the mulan psl v2 for more details"), 1),
)
#: The disclaimer that all BSD licences end with, and the clause that the oldest has besides; no licence by themselves.
BSD_MORE = {
    "bsd-warranty": "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "bsd-liability": "in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage",
    "bsd-advertising": "all advertising materials mentioning features or use of this software must display the following acknowledgement",
    "apache-see": "see the license for the specific language governing permissions and limitations under the license",
}
#: The GNU headers: identifier, name, versions. Each names a program or a library, and its version alone or later ones.
GNU = (("gpl", "gnu general public license", ("2", "3")), ("lgpl", "gnu lesser general public license", ("2.1", "3")), ("agpl", "gnu affero general public license", ("3",)))
#: Parts of the Creative Commons names, by the parts of their identifiers.
CC_PARTS = {"by": "attribution", "nc": "noncommercial", "nd": "noderivatives", "sa": "sharealike"}
CC_KINDS = ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd")
CC_VERSIONS = {"2.0": "generic", "2.5": "generic", "3.0": "unported", "4.0": "international"}
GFDL = ("1.1", "1.2", "1.3")


def _families() -> tuple[dict[str, str], list[tuple]]:
    """Sentences and rules of the GNU and Creative Commons families."""
    texts, rules = {}, []
    for thing in ("program", "library"):
        texts[f"gnu-{thing}-warranty"] = f"this {thing} is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"
    for key, name, versions in GNU:
        for v in versions:
            for thing in ("program", "library"):
                for later in (False, True):
                    this = f"{key}-{v}-{'later' if later else 'only'}-{thing}"
                    number = v.replace(".", " ")
                    end = f"either version {number} of the license or at your option any later version" if later else f"version {number} of the license"
                    texts[this] = f"this {thing} is free software you can redistribute it and or modify it under the terms of the {name} as published by the free software foundation {end}"
                    licence = f"{key.upper()}-{v if '.' in v else v + '.0'}"
                    rules += [(f"{this}-header", licence, (this, f"gnu-{thing}-warranty")), (f"{this}-line", licence, (this,))]
    for kind in CC_KINDS:
        for v, where in CC_VERSIONS.items():
            for word in ("a", "the"):
                this = f"cc-{kind}-{v}-{word}"
                name = " ".join(CC_PARTS[x] for x in kind.split("-"))
                texts[this] = f"this work is licensed under {word} creative commons {name} {v.replace('.', ' ')} {where} license"
                rules.append((f"{this}-line", f"CC-{kind.upper()}-{v}", (this,)))
    return texts, rules


def _runs(name: str, licence: str, ids: tuple[str, ...], telling: int) -> Iterator[tuple]:
    """Rules for every run of a licence's sentences that holds one of its first `telling`."""
    for i in range(min(telling, len(ids))):
        for j in range(i + 1, len(ids) + 1):
            yield f"{name}-{i + 1}-{j}", licence, ids[i:j]


def _further() -> tuple[dict[str, str], list[tuple]]:
    """Sentences and rules of FURTHER, of the GNU documentation licence, and of BSD texts with their disclaimer."""
    texts, rules = dict(BSD_MORE), []
    for licence, key, sentences, telling in FURTHER:
        ids = tuple(f"{key}-{k}" for k in range(1, len(sentences) + 1))
        texts |= dict(zip(ids, sentences))
        rules += _runs(key, licence, ids, telling)
    for v in GFDL:
        key = f"gfdl-{v}"
        texts[key] = f"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license version {v.replace('.', ' ')} or any later version published by the free software foundation"
        rules.append((f"{key}-line", f"GFDL-{v}", (key,)))
    rules += [
        ("bsd-4-full", "BSD-4-Clause", ("bsd-head", "bsd-source", "bsd-binary", "bsd-advertising", "bsd-name")), ("bsd-4-conditions", "BSD-4-Clause", ("bsd-source", "bsd-binary", "bsd-advertising", "bsd-name")),
        ("bsd-4-line", "BSD-4-Clause", ("bsd-advertising",)),
        ("bsd-3-whole", "BSD-3-Clause", ("bsd-head", "bsd-source", "bsd-binary", "bsd-name", "bsd-warranty", "bsd-liability")), ("bsd-2-whole", "BSD-2-Clause", ("bsd-head", "bsd-source", "bsd-binary", "bsd-warranty", "bsd-liability")),
    ]
    return texts, rules


for _texts, _rules in (_families(), _further()):
    TEXTS |= _texts
    TEXT_RULES = (*TEXT_RULES, *_rules)
#: Every text that holds an entry of TEXTS or ENDS, or a tag, matches this.
HINT = re.compile(r"licen[sc]e|software|copyright|redistribution|notice|stuff|mulan|eupl|psl|mpl|acknowledgement", re.I)
LINE = re.compile(r"[^\r\n]+")
LEADER = re.compile(r"[ \t]*(?:(?://+|/\*+|\*+/?|#+|;+|--+|%+|<!--|\(\*|rem\b|dnl\b|['\"]{3})[ \t]*)*", re.I)
ITEM = re.compile(r"\(?(?:\d+|[a-z])[.)][ \t]")
STOP = re.compile(r"\x00|[.!?]+(?=[ \x00]|$)")
TAG = re.compile(r"SPDX-License-Identifier:[ \t]*([^\r\n]*)")
BREAK = re.compile(r"\n+|[.!?;:]+(?=[ \t\r\n]|$)")
OTHER = re.compile(r"[^a-z0-9]+")


def normalise(sentence: str) -> str:
    return OTHER.sub(" ", sentence.lower()).strip()


def unwrapped(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, normalised) of the sentences of a text whose lines are joined again.

    Comment leaders are stripped; sentences end at .!? before white space, at lines that are blank or hold a
    leader alone, before numbered items and after a colon at a line's end (but for "free software:").
    """
    parts, begins, raws, size, last, above = [], [], [], 0, 0, ""
    for m in LINE.finditer(text):
        at = LEADER.match(text, m.start(), m.end()).end()
        line = text[at : m.end()].rstrip()
        if not line:
            above = "\x00"
            continue
        apart = text.count("\n", last, m.start()) > 1 or above == "\x00" or ITEM.match(line) or (above.endswith(":") and not above.lower().endswith("software:"))
        begins.append(size + 1)
        raws.append(at)
        parts += ["\x00" if apart else " ", line]
        size += 1 + len(line)
        last, above = m.end(), line
    joined, at = "".join(parts), 0
    raw = lambda x: raws[max(bisect_right(begins, x) - 1, 0)] + x - begins[max(bisect_right(begins, x) - 1, 0)]
    for cut, after in [*((m.start(), m.end()) for m in STOP.finditer(joined)), (len(joined), 0)]:
        part = joined[at:cut]
        if part.strip():
            yield raw(at + len(part) - len(part.lstrip())), raw(at + len(part.rstrip()) - 1) + 1, normalise(part)
        at = after


def declared(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, licence) of the identifiers in SPDX tags; exceptions after WITH are no licences."""
    for tag in TAG.finditer(text):
        before = ""
        for m in re.finditer(r"[A-Za-z0-9][A-Za-z0-9.+-]*", tag[1]):
            if m[0].upper() not in ("AND", "OR", "WITH") and before != "WITH":
                yield tag.start(1) + m.start(), tag.start(1) + m.end(), m[0]
            before = m[0].upper()


def recognise(ids: list[str], rules) -> Iterator[tuple[int, int, str, str]]:
    """(first, last, rule, licence): leftmost rule, the longest of those that start there; no sentence counts twice."""
    by_first: dict[str, list] = {}
    for name, licence, seq in sorted(rules, key=lambda r: (-len(r[2]), r[0])):
        by_first.setdefault(seq[0], []).append((name, licence, seq))
    i = 0
    while i < len(ids):
        for name, licence, seq in by_first.get(ids[i], ()):
            if tuple(ids[i : i + len(seq)]) == seq:
                yield i, i + len(seq) - 1, name, licence
                i += len(seq)
                break
        else:
            i += 1


def scan_licenses(
    docs: DataFrame, sentences: dict[str, str] = SENTENCES, rules=RULES, texts: dict[str, str] = TEXTS, ends: dict[str, str] = ENDS, text_rules=TEXT_RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row for each document: id, n_sentences known, licenses (distinct, sorted, joined by commas), matches.

    Statements: texts are cut at line ends and at .!?;: before white space; a sentence is normalised to its lower-case
    ASCII letters and digits. Known sentences become identifiers; rules match runs of successive identifiers,
    other sentences between them are passed over. Full licence texts and headers (`texts`, `ends`: normalised sentences and
    ends of sentences by identifier; `text_rules`) are found besides in the unwrapped sentences, which take the place of statements inside them, and SPDX tags by their
    identifiers, each of which counts as a sentence. matches: rule, licence, start and end in code points.
    The tables of sentences and rules travel with the tasks, so they are meant to hold thousands of entries,
    not millions. Nothing is shuffled. Null and empty texts have no match; repeated rows are scanned each, texts of any
    length whole; of rules that start at one sentence the longest wins. An empty table gives none; other columns are not read.
    """
    known = {text: key for key, text in sentences.items()}
    shortest = min(map(len, known), default=1)  # a sentence is no shorter than its normal form
    whole = {text: key for key, text in texts.items()}
    tails = tuple((end, key) for key, end in ends.items())
    rules = (*rules, *text_rules)
    hint = HINT if texts is TEXTS and ends is ENDS else re.compile("")  # other tables: every text is looked at

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, text in zip(batch["id"], batch["text"]):
                ids, spans, at = [], [], 0
                for cut in [*((m.start(), m.end()) for m in BREAK.finditer(text or "")), (len(text or ""), 0)]:
                    part = text[at : cut[0]] if text else ""
                    if len(part) >= shortest and (found := known.get(normalise(part))):
                        ids.append(found)
                        spans.append((at, cut[0]))
                    at = cut[1]
                tags: list[tuple[int, int, str]] = []
                if text and hint.search(text):
                    full = []
                    for lo, hi, sentence in unwrapped(text):
                        found = whole.get(sentence) or next((k for end, k in tails if sentence.endswith(end)), None)
                        if found and (found != "apache-at" or full):
                            full.append((lo, hi, found))
                    if full:
                        other = [(*span, i) for span, i in zip(spans, ids) if not any(span[0] < hi and lo < span[1] for lo, hi, _ in full)]
                        every = sorted([*full, *other])
                        ids, spans = [e[2] for e in every], [e[:2] for e in every]
                    tags = list(declared(text))
                matches = [(spans[a][0], spans[b][1], r, lic) for a, b, r, lic in recognise(ids, rules)] + [(lo, hi, "spdx-tag", lic) for lo, hi, lic in tags]
                out.append((key, len(ids) + len(tags), ",".join(sorted({m[3] for m in matches})), [{"rule": r, "license": lic, "start": lo, "end": hi} for lo, hi, r, lic in sorted(matches)]))
            yield pd.DataFrame(out, columns=["id", "n_sentences", "licenses", "matches"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    got = rows.mapInPandas(scan, f"id {kind}, n_sentences long, licenses string, matches array<struct<rule:string,license:string,start:long,end:long>>")
    return got.withColumnRenamed("id", id_col)
