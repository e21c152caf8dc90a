"""Verbatim wrapped licence headers, plain and as comments."""

import pytest

from cytoframe.llm import license_scan

MIT = """Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""
BSD2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice,
   this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution."""
BSD3 = BSD2 + """
3. Neither the name of Some Company, Inc. nor the names of its contributors
   may be used to endorse or promote products derived from this software
   without specific prior written permission."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
GPL3 = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""
GPL2 = GPL3.replace("software:", "software;").replace("version 3", "version 2")
LGPL = GPL3.replace("program", "library").replace("General Public License", "Lesser General Public License", 1).replace("version 3", "version 2.1").replace("software:", "software;")
AGPL = GPL3.replace("GNU General", "GNU Affero General", 1)
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
CC = """This work is licensed under a Creative Commons
Attribution-NonCommercial-ShareAlike 4.0 International License."""
UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any
means."""
WANT = [(LGPL, "LGPL-2.1", "lgpl-2.1-later-library-header"), (AGPL, "AGPL-3.0", "agpl-3-later-program-header"), (ISC, "ISC", "isc-grant-full"), (MPL, "MPL-2.0", "mpl-2-at-https-header"), (CC, "CC-BY-NC-SA-4.0", "cc-by-nc-sa-4.0-a-line"), (UNLICENSE, "Unlicense", "unlicense-text"), (MIT, "MIT", "mit-full"), (BSD2, "BSD-2-Clause", "bsd-2-full"), (BSD3, "BSD-3-Clause", "bsd-3-full"), (APACHE, "Apache-2.0", "apache-full-apache-at"), (GPL3, "GPL-3.0", "gpl-3-later-program-header"), (GPL2, "GPL-2.0", "gpl-2-later-program-header")]


@pytest.mark.parametrize("leader", ["", "# ", "// ", " * ", "-- "])
def test_wrapped_headers(spark, leader):
    texts = ["\n".join((leader + line).rstrip() for line in text.split("\n")) for text, _, _ in WANT]
    texts = [f"/*\n{t}\n */\nint x;" if "*" in leader else f"{t}\n\ncode here" for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in license_scan.scan_licenses(df).collect()}
    for i, (text, licence, rule) in enumerate(WANT):
        assert (got[i]["licenses"], [m["rule"] for m in got[i]["matches"]]) == (licence, [rule])
        m = got[i]["matches"][0]
        part = texts[i][m["start"] : m["end"]]
        assert part.split()[0] in text and part[-1].isalnum() or part[-1] == "/"


def test_tags_and_windows_line_ends(spark):
    df = spark.createDataFrame([(1, "// SPDX-License-Identifier: (MIT OR GPL-2.0-only WITH Classpath-exception-2.0)\r\nx"), (2, MIT.replace("\n", "\r\n"))], "doc_id long, text string")
    got = {r["doc_id"]: r["licenses"] for r in license_scan.scan_licenses(df).collect()}
    assert got == {1: "GPL-2.0-only,MIT", 2: "MIT"}


def test_every_rule_is_found_in_its_own_sentences():
    """No rule is dead: its sentences, put one behind the other, give it or a longer one of the same licence."""
    for tables, rules in ((license_scan.SENTENCES, license_scan.RULES), (license_scan.TEXTS | license_scan.ENDS, license_scan.TEXT_RULES)):
        for name, licence, seq in rules:
            assert all(k in tables for k in seq)
            found = list(license_scan.recognise(list(seq), rules))
            assert [(m[2], m[3]) for m in found] == [(name, licence)]
            assert all(license_scan.normalise(tables[k]) == tables[k] for k in seq)


def test_every_sentence_is_hinted_at():
    """Texts without a hint are passed over, so each known sentence has one."""
    for text in (license_scan.TEXTS | license_scan.ENDS).values():
        assert license_scan.HINT.search(text)


def test_tables_are_arguments(spark):
    texts = {"a-1": "anyone may use this thing", "a-2": "it comes as it is"}
    df = spark.createDataFrame([(1, "Anyone may\nuse this thing. It comes as it is."), (2, MIT), (3, "It comes as it is, and Anyone may use this thing")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in license_scan.scan_licenses(df, {}, (), texts, {"a-3": "use this thing"}, (("a", "House-1.0", ("a-1", "a-2")), ("b", "House-2.0", ("a-3",)))).collect()}
    assert [got[i]["licenses"] for i in (1, 2, 3)] == ["House-1.0", "", "House-2.0"]


def test_further_licences(spark):
    """Sentences of each further licence, wrapped and in a comment, give that licence alone."""
    made = []
    for licence, key, sentences, telling in license_scan.FURTHER:
        text = ". ".join(x[0].upper() + x[1:] for x in sentences) + "."
        words, line, lines = text.split(" "), "", []
        for w in words:
            if len(line) + len(w) > 70:
                lines.append(line)
                line = ""
            line = f"{line} {w}".strip()
        made.append((len(made), "\n".join(f"# {x}" for x in [*lines, line]), licence))
    df = spark.createDataFrame(made, "doc_id long, text string, licence string")
    got = license_scan.scan_licenses(df).collect()
    assert {r["doc_id"]: r["licenses"] for r in got} == {i: lic for i, _, lic in made}
