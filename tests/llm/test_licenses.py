import re

from clickmarts.llm.licenses import BASE, Automaton, license_scan

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def base(text):
    w = words(text)
    places = [(i, label) for phrase, label in BASE.items() for i in range(len(w))
              if w[i:i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in places]
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


CASES = [("Licensed under the Apache License, Version 2.0.", "apache"), ("Licensed under the Apache License", "apache"),
         ("This work is licensed under the GNU General Public License, version 3.", "gpl"), ("Released under the MIT License.", "mit"),
         ("Licensed under CC BY-NC 4.0.", "cc-by-nc"), ("All rights reserved.", "proprietary"),
         ("Copyright 2020 Some One. All rights reserved", "proprietary"), ("licensed under cc by sa", ""), ("all rights", ""),
         ("mit license apache license mit license", "apache,mit"), ("general public public license", ""), ("licensed under the mit", ""),
         (None, ""), ("", ""), ("mit", ""), ("MIT-licensé license", "")]


def test_labels_and_base(spark):
    df = spark.createDataFrame([(i, t, 1) for i, (t, _) in enumerate(CASES)], "doc_id long, text string, n_base int")
    got = {r["doc_id"]: r for r in license_scan(df).collect()}
    for i, (text, labels) in enumerate(CASES):
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == base(text), text
        assert r["labels"] == labels, text
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(labels)


MIT = """Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software
is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES
OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR
IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
BSD2 = """Copyright (c) 2020, Some One. All rights reserved.
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT
SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING
NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
BSD3 = BSD2.replace("THIS SOFTWARE IS PROVIDED", "3. Neither the name of the copyright holder nor the names of its contributors may "
                    "be used to endorse or promote products derived from this software without specific prior written permission.\n"
                    "THIS SOFTWARE IS PROVIDED")
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law
or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and
limitations under the License."""
GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License
as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This
program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have
received a copy of the GNU General Public License along with this program."""


def test_whole_texts_and_altered_clauses(spark):
    cases = [(MIT, "mit"), (BSD2, "bsd"), (BSD3, "bsd"), (ISC, "isc"), (APACHE, "apache"), (GPL, "gpl"),
             (f"before {BSD3} after", "bsd"), (f"{BSD2} All rights reserved.", "bsd,proprietary"),
             (MIT.replace("or substantial portions", "in part"), ""),
             (MIT.replace("DEALINGS IN THE SOFTWARE", "DEALINGS"), ""), (MIT[:400], ""),
             (BSD2.replace("binary form must", "binary form may"), "proprietary"), (BSD2.partition("1. ")[0], "proprietary"),
             (BSD3.replace("may be used to endorse", "may not be used to endorse"), "proprietary"),
             (ISC.replace("appear in all copies", "appear in most copies"), "")]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in license_scan(df).collect()}
    for i, (text, labels) in enumerate(cases):
        assert got[i]["labels"] == labels, (i, text)
        assert got[i]["base_labels"] == base(text)[-1]
        assert got[i]["score"] > 0.8 if labels else got[i]["score"] == 0, i
    # An altered notice is a reference line at most: its span ends with that line.
    altered = spark.createDataFrame([(1, APACHE.replace("applicable law", "law"))], "doc_id long, text string")
    assert license_scan(altered).collect()[0]["spans"] == [0, 8] and got[4]["spans"] == [0, 8, 0, got[4]["n_words"]]


def test_base_on_given_documents(spark, docs, texts, no_docs):
    for df, items in ((docs, list(enumerate(texts))), (d := spark.read.parquet("/root/testdata/sf0.001/documents.parquet"),
                                                       [(r["doc_id"], r["text"]) for r in d.collect()])):
        got = {r["doc_id"]: tuple(r)[1:6] for r in license_scan(df).collect()}
        assert got == {i: base(t) for i, t in items}
    assert license_scan(no_docs).count() == 0


def test_automata_against_regular_expressions():
    import itertools
    for markup, pattern in (("a <<optional>> b <<end>> c", "a (b )?c "), ("<<optional>> a <<any:1,2>> <<end>> b c", r"(a (\w ){1,2})?b c "),
                            ("a <<any:0,2>> b", r"a (\w ){0,2}b "), ("a <<optional>> b <<optional>> c <<end>> <<end>> d", "a (b (c )?)?d ")):
        machine = Automaton(markup)
        for n in range(1, 6):
            for w in itertools.product("abcd", repeat=n):
                text = "".join(x + " " for x in w)
                ends = [len(text[:j].split()) for j in range(2, len(text) + 1, 2) if re.fullmatch(pattern, text[:j])]
                assert machine.read([x.encode() for x in w], 0)[0] == max(ends, default=0), (markup, w)
