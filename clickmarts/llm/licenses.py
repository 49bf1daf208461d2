"""License scans: template markup compiled into token automata.

Templates are word sequences with ``<<optional>> ... <<end>>`` regions that may be
left out and ``<<any:a,b>>`` regions that stand for ``a`` to ``b`` words.  A template
is compiled to a nondeterministic automaton over words and accepted where all its
mandatory words stand in order; the longest accepted reading from a start counts.
``WHOLE`` templates are license texts and notices from their first mandatory word to their
last; ``TEMPLATES`` are lines that refer to a license.  A reference inside a whole text of
another label belongs to that text (the rights reserved in a BSD text's head) and gives none.

Definitions: words as in the contract of ``op10``.  Base phrases (fixed values) give
their label at every place they stand at.  ``score`` is 0 without any label, 0.5 for a
text with base phrases only, otherwise the largest share of a found template's own
words (optional ones included) that the text has.  Null and empty texts have no
words, null first and last places, empty labels, score 0.  Rows are independent.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from clickmarts.llm.common import WORD_BYTES, batch, doc_bytes, pieces

#: Base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Reference lines by label, in words as the scan sees them.
TEMPLATES = {
    "apache": ["licensed under the apache license <<optional>> version 2 0 <<end>>"],
    "cc-by-nc": ["licensed under <<optional>> the <<end>> cc by nc <<optional>> 4 0 <<end>>",
                 "licensed under <<optional>> a <<end>> creative commons attribution noncommercial "
                 "<<optional>> 4 0 international <<end>> license"],
    "gpl": ["this <<any:1,3>> is licensed under the <<optional>> gnu <<end>> general public license "
            "<<optional>> version <<any:1,1>> <<end>>"],
    "mit": ["released under the mit license"],
    "proprietary": ["<<optional>> copyright <<any:1,8>> <<end>> all rights reserved"],
}

_HEAD = "<<optional>> copyright <<any:0,40>> <<optional>> all rights reserved <<end>> <<end>> "
_GNU = "gnu <<optional>> lesser <<end>> <<optional>> affero <<end>> general public license "

#: Whole license texts and notices by label.
WHOLE = {
    "apache": ["licensed under the apache license version 2 0 <<optional>> the license <<end>> you may not use <<any:1,8>> "
               "except in compliance with the license you may obtain a copy of the license at <<any:0,10>> "
               "unless required by applicable law or agreed to in writing software distributed under the license is "
               "distributed on an as is basis without warranties or conditions of any kind either express or implied "
               "see the license for the specific language governing permissions and limitations under the license"],
    "bsd": [_HEAD +
            "redistribution and use in source and binary forms with or without modification are permitted "
            "provided that the following conditions are met "
            "<<any:0,1>> redistributions of source code must retain the above copyright notice this list of conditions "
            "and the following disclaimer "
            "<<any:0,1>> redistributions in binary form must reproduce the above copyright notice this list of conditions "
            "and the following disclaimer in the documentation and or other materials provided with the distribution "
            "<<optional>> <<any:0,1>> neither the name of <<any:1,15>> nor the names of <<any:1,6>> may be used to endorse or "
            "promote products derived from this software without specific prior written permission <<end>> "
            "this software is provided by <<any:1,15>> as is and any express or implied warranties including but not limited "
            "to the implied warranties of merchantability and fitness for a particular purpose are disclaimed "
            "in no event shall <<any:1,15>> be liable for any direct indirect incidental special exemplary or consequential "
            "damages including but not limited to procurement of substitute goods or services loss of use data or profits or "
            "business interruption however caused and on any theory of liability whether in contract strict liability or tort "
            "including negligence or otherwise arising in any way out of the use of this software even if advised of the "
            "possibility of such damage"],
    "gpl": ["this <<any:1,3>> is free software you can redistribute it and or modify it under the terms of the " + _GNU +
            "as published by the free software foundation <<optional>> either <<end>> version <<any:1,2>> of the license "
            "<<optional>> or at your option any later version <<end>> "
            "this <<any:1,3>> is distributed in the hope that it will be useful but without any warranty without even the "
            "implied warranty of merchantability or fitness for a particular purpose see the " + _GNU + "for more details "
            "<<optional>> you should have received a copy of the " + _GNU + "along with <<any:1,4>> <<end>>"],
    "isc": [_HEAD +
            "permission to use copy modify and <<optional>> or <<end>> distribute this software for any purpose with or without "
            "fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies "
            "the software is provided as is and <<any:1,8>> disclaims all warranties with regard to this software including "
            "all implied warranties of merchantability and fitness in no event shall <<any:1,8>> be liable for any special "
            "direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits "
            "whether in an action of contract negligence or other tortious action arising out of or in connection with the "
            "use or performance of this software"],
    "mit": [_HEAD +
            "permission is hereby granted free of charge to any person obtaining a copy of <<any:1,8>> "
            "<<optional>> the software <<end>> to deal in <<any:1,4>> without restriction including without limitation the "
            "rights to use copy modify merge publish distribute sublicense and or sell copies of <<any:1,4>> and to permit "
            "persons to whom <<any:1,4>> is furnished to do so subject to the following conditions "
            "the above copyright notice and this permission notice <<optional>> including the next paragraph <<end>> shall be "
            "included in all copies or substantial portions of <<any:1,4>> "
            "<<any:1,4>> is provided as is without warranty of any kind express or implied including but not limited to the "
            "warranties of merchantability fitness for a particular purpose and noninfringement "
            "in no event shall <<any:1,15>> be liable for any claim damages or other liability whether in an action of "
            "contract tort or otherwise arising from out of or in connection with <<any:1,4>> or the use or other dealings in "
            "the software"],
}


class Automaton:
    """States 0..n; ``step[state][word]`` and ``wild[state]`` give sets of states as bit masks."""

    def __init__(self, markup: str):
        self.step: list[dict[bytes, int]] = [{}]
        self.wild: list[int] = [0]
        skip: list[tuple[int, int]] = []
        opened: list[int] = []
        state, self.literals = 0, 0

        def new() -> int:
            self.step.append({})
            self.wild.append(0)
            return len(self.step) - 1

        for part in re.findall(r"<<[^>]*>>|\S+", markup):
            if part == "<<optional>>":
                opened.append(state)
            elif part == "<<end>>":
                skip.append((opened.pop(), state))
            elif part.startswith("<<any:"):
                least, most = map(int, part[6:-2].split(","))
                chain = [state]
                for _ in range(most):
                    self.wild[chain[-1]] |= 1 << len(self.step)
                    chain.append(new())
                state = chain[-1]
                skip += [(s, state) for s in chain[least:-1]]
            else:
                after = new()
                self.step[state][part.encode()] = 1 << after
                state, self.literals = after, self.literals + 1
        self.accept = state
        # What can be reached by leaving regions out.
        self.closed = [1 << s for s in range(len(self.step))]
        for _ in skip:
            for a, b in skip:
                for s in range(len(self.closed)):
                    if self.closed[s] >> a & 1:
                        self.closed[s] |= self.closed[b] | 1 << b
        self.starts = {w for s in self._states(self.closed[0]) for w in self.step[s]}

    @staticmethod
    def _states(mask: int):
        while mask:
            low = mask & -mask
            yield low.bit_length() - 1
            mask ^= low

    def read(self, words: list[bytes], at: int) -> tuple[int, int]:
        """(words read, own words read) of the longest accepted reading from ``at``; zeros if none."""
        live = {s: 0 for s in self._states(self.closed[0])}
        found = (0, 0)
        for i in range(at, len(words)):
            ahead: dict[int, int] = {}
            for s, own in live.items():
                for mask, gain in ((self.step[s].get(words[i], 0), 1), (self.wild[s], 0)):
                    for t in self._states(mask):
                        for u in self._states(self.closed[t]):
                            ahead[u] = max(ahead.get(u, 0), own + gain)
            if not ahead:
                break
            if self.accept in ahead:
                found = (i + 1 - at, ahead[self.accept])
            live = ahead
        return found


SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double, spans array<int>")
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
    ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
    ("spans", pa.list_(pa.int32()))])


def license_scan(docs: DataFrame, base: dict[str, str] | None = None,
                 templates: dict[str, list[str]] | None = None,
                 whole: dict[str, list[str]] | None = None) -> DataFrame:
    """One row per row of ``docs``; ``spans`` are the accepted templates' words as
    flattened half-open pairs.  Own ``templates`` without ``whole`` are all there are."""
    if whole is None:
        whole = WHOLE if templates is None else {}
    phrases = [(p.encode().split(), label) for p, label in (BASE if base is None else base).items()]
    automata = [(label, full, Automaton(m))
                for full, kind in ((True, whole), (False, TEMPLATES if templates is None else templates))
                for label, marks in kind.items() for m in marks]

    def run(batches):
        names: dict[bytes, int] = {}
        for words, _ in phrases:
            for w in words:
                names.setdefault(w, len(names) + 1)
        coded = [(np.array([names[w] for w in words]), label) for words, label in phrases]
        for _, _, machine in automata:
            for w in machine.starts:
                names.setdefault(w, len(names) + 1)
        begins = [(label, full, machine, [names[w] for w in machine.starts]) for label, full, machine in automata]
        for b in pieces(batches, 2048, 8 << 20):
            rows = {f.name: [] for f in _ARROW}
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                words = (text or b"").translate(WORD_BYTES).split()
                at, ids = np.empty(0, np.int64), np.fromiter(map(names.get, words, repeat(0)), np.int32, len(words))
                known = np.flatnonzero(ids)
                places, labels, own, spans, score = [], set(), set(), [], 0.0
                texts: list[tuple] = []
                if len(known):
                    for code, label in coded:
                        at = known[ids[known] == code[0]]
                        for k in range(1, len(code)):
                            at = at[at + k < len(ids)]
                            at = at[ids[at + k] == code[k]]
                        if len(at):
                            labels.add(label)
                            places += at.tolist()
                    for label, full, machine, begin in begins:
                        for i in known[np.isin(ids[known], begin)].tolist():
                            n, literals = machine.read(words, i)
                            if n and full:
                                texts.append((label, i, i + n))
                            if n and (full or not any(x != label and a <= i and i + n <= z for x, a, z in texts)):
                                own.add(label)
                                spans.append((i, i + n))
                                score = max(score, literals / machine.literals)
                for name, value in (
                        ("doc_id", doc), ("n_words", len(words)), ("n_base", len(places)),
                        ("first_word", min(places, default=None)), ("last_word", max(places, default=None)),
                        ("base_labels", ",".join(sorted(labels))), ("labels", ",".join(sorted(labels | own))),
                        ("score", score or (0.5 if labels else 0.0)), ("spans", [x for s in sorted(spans) for x in s])):
                    rows[name].append(value)
            yield batch(_ARROW, **rows)

    return doc_bytes(docs).mapInArrow(run, SCHEMA)
