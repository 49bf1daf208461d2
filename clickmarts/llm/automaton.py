"""Weighted acyclic automata of word sequences, in numpy.

An automaton accepts sequences (language, word, word, ...) and gives each its count.  It is
held level by level: a level lists its states in the order of their sequences, each with the
state it hangs on, the word that leads to it and its count, so states that share a prefix
share its path.  Symbols are ranks in the sorted word list, hence a level is sorted by
(parent, symbol), which is what building, cutting, uniting and looking up rest on.
"""

from __future__ import annotations

from bisect import bisect_left
from typing import NamedTuple

import numpy as np


class Level(NamedTuple):
    parent: np.ndarray
    symbol: np.ndarray
    weight: np.ndarray


class Automaton(NamedTuple):
    """``levels[0]`` are the languages (symbols: ``langs``), the others words (``words``)."""

    langs: list[str]
    words: list[bytes]
    levels: list[Level]

    @property
    def states(self) -> int:
        return sum(len(x.weight) for x in self.levels)


def _grouped(keys: np.ndarray, weights: np.ndarray | None = None):
    """Distinct keys in order, the place of each key among them, and their summed weights."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    first = np.ones(len(keys), bool)
    first[1:] = ranked[1:] != ranked[:-1]
    place = np.empty(len(keys), np.int64)
    place[order] = np.cumsum(first) - 1
    starts = np.flatnonzero(first)
    if weights is None:
        sums = np.diff(np.append(starts, len(keys)))
    else:
        sums = np.add.reduceat(weights[order], starts) if len(keys) else weights
    return ranked[starts], place, sums


def build(tokens: list[bytes], langs: list[str], lang_of: np.ndarray, mark: bytes, starts: int, depth: int) -> Automaton:
    """The automaton of all sequences of up to ``depth`` words that begin at one of the first
    ``starts`` tokens and have no ``mark`` in them.  ``lang_of`` has each token's language as
    a place in ``langs``.  Each level adds one word to the sequences of the level before."""
    words = sorted(set(tokens) - {mark})
    rank = {w: i for i, w in enumerate(words)}
    rank[mark] = -1
    ids = np.fromiter(map(rank.__getitem__, tokens), np.int64, len(tokens))
    names = sorted(set(langs), key=str.encode)
    own = {name: i for i, name in enumerate(names)}
    state = np.array([own[name] for name in langs], np.int64)[lang_of] if len(tokens) else np.empty(0, np.int64)
    at = np.flatnonzero(ids[:starts] >= 0)
    state = state[at]
    keys, state, sums = _grouped(state)
    levels = [Level(np.zeros(len(keys), np.int64), keys, sums)]
    for d in range(depth):
        if d:
            # Only sequences that go on without a mark.
            on = at + d < len(ids)
            on[on] = ids[at[on] + d] >= 0
            at, state = at[on], state[on]
        keys, state, sums = _grouped(state * len(words) + ids[at + d])
        levels.append(Level(*np.divmod(keys, max(1, len(words))), sums))
    kept = [i for i in levels[0].symbol]
    return Automaton([names[i] for i in kept], words,
                     [Level(levels[0].parent, np.arange(len(kept)), levels[0].weight), *levels[1:]])


def _first_at_least(a: Automaton, bound: tuple) -> list[int]:
    """For each level, how many of its sequences come before ``bound`` (a language and words)."""
    out, low, exact = [], 0, True
    for d, level in enumerate(a.levels):
        if d >= len(bound):
            # Longer than the bound: those that begin with it come after it.
            low = int(np.searchsorted(level.parent, low))
            out.append(low)
            continue
        if exact:
            first, end = np.searchsorted(level.parent, [low, low + 1]) if d else (0, len(level.parent))
            names, name = (a.langs, bound[0]) if d == 0 else (a.words, bound[d])
            want = bisect_left(names, name) if d else bisect_left([x.encode() for x in names], name.encode())
            low = int(first + np.searchsorted(level.symbol[first:end], want))
            exact = want < len(names) and names[want] == name and low < end and level.symbol[low] == want
        else:
            low = int(np.searchsorted(level.parent, low))
        # A proper prefix of the bound comes before it.
        out.append(low + (exact and d < len(bound) - 1))
    return out


def cut(a: Automaton, bounds: list[tuple]):
    """(number of the range, its part) for each range between ``bounds`` with any state of
    ``a``.  A part keeps the path to its states; what lies outside the range weighs 0."""
    limits = [[0] * len(a.levels), *[_first_at_least(a, b) for b in bounds], [len(x.weight) for x in a.levels]]
    for number, (low, high) in enumerate(zip(limits, limits[1:])):
        if low == high:
            continue
        begin = list(low)
        for d in reversed(range(1, len(begin))):
            if begin[d] < high[d]:
                begin[d - 1] = min(begin[d - 1], int(a.levels[d].parent[begin[d]]))
        end = [max(h, b) for h, b in zip(high, begin)]
        for d in reversed(range(1, len(begin))):
            if end[d] > begin[d]:
                end[d - 1] = max(end[d - 1], int(a.levels[d].parent[end[d] - 1]) + 1)
        levels = []
        for d, level in enumerate(a.levels):
            weight = level.weight[begin[d]:end[d]].copy()
            weight[:low[d] - begin[d]] = 0
            weight[max(0, high[d] - begin[d]):] = 0
            levels.append(Level(level.parent[begin[d]:end[d]] - (begin[d - 1] if d else 0),
                                level.symbol[begin[d]:end[d]], weight))
        yield number, _compact(a.langs, a.words, levels)


def _compact(langs, words, levels) -> Automaton:
    """Only the names that are in use."""
    first = levels[0]
    used, place = np.unique(np.concatenate([x.symbol for x in levels[1:]]) if levels[1:] else np.empty(0, np.int64),
                            return_inverse=True)
    out, at = [Level(first.parent, np.arange(len(first.symbol)), first.weight)], 0
    for level in levels[1:]:
        out.append(Level(level.parent, place[at:at + len(level.symbol)], level.weight))
        at += len(level.symbol)
    return Automaton([langs[i] for i in first.symbol], [words[i] for i in used], out)


def union(parts: list[Automaton]) -> Automaton:
    """One automaton of all sequences of the parts, with their weights summed."""
    words = sorted(set().union(*(p.words for p in parts)))
    rank = {w: i for i, w in enumerate(words)}
    langs = sorted(set().union(*(p.langs for p in parts)), key=str.encode)
    lang_rank = {x: i for i, x in enumerate(langs)}
    maps = [np.fromiter(map(rank.__getitem__, p.words), np.int64, len(p.words)) for p in parts]
    states = [np.zeros(1, np.int64) for _ in parts]
    levels = []
    for d in range(max(len(p.levels) for p in parts)):
        keys = []
        for p, m, s in zip(parts, maps, states):
            if d == 0:
                keys.append(np.array([lang_rank[x] for x in p.langs], np.int64))
            else:
                keys.append(s[p.levels[d].parent] * len(words) + m[p.levels[d].symbol])
        distinct, place, sums = _grouped(np.concatenate(keys), np.concatenate([p.levels[d].weight for p in parts]))
        states = np.split(place, np.cumsum([len(k) for k in keys])[:-1])
        levels.append(Level(*(np.divmod(distinct, max(1, len(words))) if d else (np.zeros(len(distinct), np.int64), distinct)), sums))
    return Automaton(langs, words, levels)


def prune(a: Automaton, least: int) -> Automaton:
    """Without the sequences that weigh less than ``least``, but with all languages and
    the paths to what stays."""
    keep = [x.weight >= least for x in a.levels]
    for d in reversed(range(1, len(keep))):
        keep[d - 1][a.levels[d].parent[keep[d]]] = True
    keep[0][:] = True
    levels = []
    for d, (level, k) in enumerate(zip(a.levels, keep)):
        parent = (np.cumsum(keep[d - 1]) - 1)[level.parent[k]] if d else level.parent
        levels.append(Level(parent, level.symbol[k], level.weight[k]))
    return _compact(a.langs, a.words, levels)


def lookup(a: Automaton, langs: list[str], phrases: list[bytes]) -> np.ndarray:
    """The weight of each phrase (words with spaces between) of a language; 0 if it is none."""
    rank = {w: i for i, w in enumerate(a.words)}
    lang_rank = {x: i for i, x in enumerate(a.langs)}
    out = np.zeros(len(phrases), np.int64)
    split = [p.split(b" ") for p in phrases]
    sizes = np.array([len(s) for s in split])
    state = np.array([lang_rank.get(x, -1) for x in langs], np.int64)
    for d, level in enumerate(a.levels[1:], 1):
        here = np.flatnonzero((sizes >= d) & (state >= 0))
        ids = np.array([rank.get(split[i][d - 1], -1) for i in here], np.int64)
        known = level.parent * len(a.words) + level.symbol
        want = np.where(ids >= 0, state[here] * len(a.words) + ids, -1)
        at = np.searchsorted(known, want)
        hit = at < len(known)
        hit[hit] = known[at[hit]] == want[hit]
        state[here] = np.where(hit, at, -1)
        done = here[hit & (sizes[here] == d)]
        out[done] = level.weight[state[done]]
    return out


def sequences(a: Automaton):
    """(language, phrase, number of words, weight) of each state, languages first."""
    before = [(x, b"") for x in a.langs]
    for (lang, _), w in zip(before, a.levels[0].weight.tolist()):
        yield lang, b"", 0, w
    for d, level in enumerate(a.levels[1:], 1):
        here = []
        for p, s, w in zip(level.parent.tolist(), level.symbol.tolist(), level.weight.tolist()):
            lang, text = before[p]
            here.append((lang, text + b" " + a.words[s] if text else a.words[s]))
            yield *here[-1], d, w
        before = here


_TYPES = [np.dtype(t) for t in ("u1", "u2", "u4", "i8")]


def _packed(x: np.ndarray) -> bytes:
    code = next(i for i, t in enumerate(_TYPES) if i == 3 or not len(x) or x.max() <= np.iinfo(t).max)
    return bytes([code]) + x.astype(_TYPES[code]).tobytes()


def _unpacked(x: bytes) -> np.ndarray:
    return np.frombuffer(x, _TYPES[x[0]], offset=1).astype(np.int64)


def pack(a: Automaton) -> tuple[list[str], bytes, list[bytes]]:
    """Languages, words and, for each level, children of each parent, symbols and weights."""
    parts = [_packed(a.levels[0].weight)]
    for up, level in zip(a.levels, a.levels[1:]):
        parts += [_packed(np.bincount(level.parent, minlength=len(up.weight))), _packed(level.symbol), _packed(level.weight)]
    return a.langs, b" ".join(a.words), parts


def unpack(langs: list[str], words: bytes, parts: list[bytes]) -> Automaton:
    weight = _unpacked(parts[0])
    levels = [Level(np.zeros(len(weight), np.int64), np.arange(len(weight)), weight)]
    for i in range(1, len(parts), 3):
        children, symbol, weight = map(_unpacked, parts[i:i + 3])
        levels.append(Level(np.repeat(np.arange(len(children)), children), symbol, weight))
    return Automaton(langs, words.split(b" ") if words else [], levels)
