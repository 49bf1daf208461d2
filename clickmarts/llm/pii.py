"""Personal data: base patterns, and a linear-chain CRF over word-shape features.

The base patterns are the contract's.  The CRF is trained from a small labelled table
(``labelled_rows``, built from a rule, a fixed number of rows), and decodes all words
of all texts by Viterbi, each text as one chain, in numpy batches.  It adds spans of its kinds (``secret`` for
keys, tokens and passwords, and the base kinds in forms that the patterns miss)
where they overlap no base span; base spans always stay.

Definitions: words of the CRF are runs of characters above U+0020 other than U+00A0.
A sequence is a whole text.  Null counts as the empty text and has no
spans; the digest of no spans is that of the empty text.  Rows are independent.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmarts.llm.common import batch, named, pieces, trimmed

KINDS = ("email", "ip", "card", "phone", "secret")
TAGS = ("",) + KINDS
TRAIN_ROWS = 900
#: Shortest span that the CRF adds: no number that can be dialled, address or key is shorter.
LEAST_SPAN = 6

# -- base patterns -------------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str):
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        done = m.end() if m else at + 1
        if m:
            yield start, done
        at = text.find("@", done)


def _candidates(text: str):
    """(start, end, kind, whether it holds) of all pattern matches of a fitting length."""
    for a, b in _emails(text):
        yield a, b, "email", True
    if any(c in text for c in "0123456789"):
        for m in _IP.finditer(text):
            yield *m.span(), "ip", all(int(p[-4:]) <= 255 and not p[:-4].strip("0") for p in m[0].split("."))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19:
                yield *m.span(), "card", luhn(digits)
        if "+" in text:
            for m in _PHONE.finditer(text):
                yield *m.span(), "phone", 9 <= sum(c in "0123456789" for c in m[0]) <= 15


def _is_whole(text: str, kind: str) -> bool:
    """Whether a card or phone number holds by itself, whatever digits stand beside it."""
    digits = re.sub(r"[\x20().-]", "", text.removeprefix("+"))
    if not (digits.isascii() and digits.isdigit()):
        return False
    if kind == "phone":
        return text[0] in "+(" and 10 <= len(digits) <= 15
    return kind == "card" and 12 <= len(digits) <= 19 and luhn(digits)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind), leftmost and without overlap per kind, by start, then kind."""
    return sorted(((a, b, k) for a, b, k, holds in _candidates(text) if holds), key=lambda s: (s[0], KINDS.index(s[2])))


def joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


# -- word shapes -----------------------------------------------------------------

_CLASSES = np.zeros(256, np.int8)  # 0: letter of any other script, or sign
for _chars, _c in (("abcdefghijklmnopqrstuvwxyz", 1), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 2), ("0123456789", 3),
                   ("@", 4), (".", 5), ("-", 6), ("+", 7), ("()", 8), ("=", 9), ("\"'", 10), (",;:!?|", 11)):
    _CLASSES[[ord(c) for c in _chars]] = _c
_DIGITS = np.searchsorted([1, 2, 3, 4, 5, 9, 12, 20], np.arange(65), side="right")
_LENGTHS = np.searchsorted([2, 3, 4, 7, 10, 16, 25, 49], np.arange(65), side="right")
_FEW = np.searchsorted([1, 2, 4, 9], np.arange(65), side="right")
#: Values of each feature.
SIZES = (9, 32, 4, 5, 12, 12, 9, 5, 5)
WIDTH = sum(SIZES)


def shapes(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and their feature numbers (words x features)."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = (code > 32) & (code != 0xA0)
    edges = np.flatnonzero(np.diff(np.r_[0, inside.view(np.int8), 0]))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return starts, ends, np.empty((0, len(SIZES)), np.int32)
    kind = np.where(code < 256, _CLASSES[np.minimum(code, 255)], 0)
    bounds = np.c_[starts, ends].ravel()
    if bounds[-1] == len(code):
        bounds = bounds[:-1]

    def count(mask):
        return np.minimum(np.add.reduceat(mask.astype(np.int32), bounds)[::2], 64)

    digit, letter = kind == 3, kind <= 2
    turns = digit[1:] & letter[:-1] | letter[1:] & digit[:-1]
    upper, digits = count(kind == 2), count(digit)
    has = [(count(kind == c) > 0) for c in (1, 9, 10)]
    at, dots = count(kind == 4) > 0, count(kind == 5)
    features = np.stack([
        _DIGITS[digits], has[0] + 2 * (upper > 0) + 4 * (digits > 0) + 8 * has[1] + 16 * has[2],
        at + 2 * (dots > 0), np.minimum(dots, 4), kind[starts], kind[ends - 1],
        _LENGTHS[np.minimum(ends - starts, 64)], _FEW[count(np.r_[turns, False])], _FEW[upper]], axis=1)
    return starts, ends, (features + np.r_[0, np.cumsum(SIZES)[:-1]]).astype(np.int32)


def neighbours(features: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Rows of all feature numbers: own, the word's before, the word's after.  ``first``
    marks words that begin a text; beyond a text stand feature numbers of no word."""
    none = np.full((1, features.shape[1]), 3 * WIDTH, np.int32)
    before = np.where(first[:, None], 3 * WIDTH, np.r_[none, features[:-1]] + WIDTH)
    after = np.where(np.r_[first[1:], True][:, None], 3 * WIDTH, np.r_[features[1:], none] + 2 * WIDTH)
    return np.concatenate([features, before, after], axis=1)


# -- the model ---------------------------------------------------------------------

def labelled_rows(n: int = TRAIN_ROWS, seed: int = 7) -> list[list[tuple[str, str]]]:
    """The labelled table: ``n`` rows of (word, tag), made by rule from a seed.  Rows mix
    plain words, numbers, versions, dates and cell marks (no tag) with personal data."""
    r = random.Random(seed)

    def word():
        w = "".join(r.choice("etaonrishdlucmfpéñüóèä") for _ in range(r.randint(1, 12)))
        return (w.capitalize() if r.random() < 0.2 else w) + r.choice(["", "", "", "", ",", ".", "***", "%%%"])

    def digits(k):
        return "".join(r.choice("0123456789") for _ in range(k))

    def plain():
        return r.choice([word, word, word, word, lambda: digits(r.randint(1, 6)), lambda: f"{digits(1)}.{digits(1)}.",
                         lambda: "|", lambda: f"{digits(2)}/{digits(2)}/{digits(4)}", lambda: f"v{digits(1)}.{digits(2)}",
                         lambda: f"{digits(2)}%", lambda: f"({word()})", lambda: f"{digits(4)}-{digits(2)}-{digits(2)}",
                         lambda: "=", lambda: f'"{word()}"', lambda: f"{word()}-{word()}", lambda: "CC",
                         lambda: f"https://{word()}.org/{digits(3)}", lambda: word().upper()])()

    def name():
        return "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(3, 9)))

    def hexa(k):
        return "".join(r.choice("0123456789abcdef") for _ in range(k))

    def mixed(k):
        return "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(k))

    def card(head):
        """16 digits, the last one their check digit."""
        body = head + digits(15 - len(head))
        return next(body + d for d in "0123456789" if luhn(body + d))

    def personal():
        end = r.choice(["", "", ".", ","])
        number = card(r.choice("456"))
        area = r.choice([f"({digits(3)})", digits(3)])
        return r.choice([
            lambda: [(f"{name()}.{digits(2)}@{name()}.example.com{end}", "email")],
            lambda: [(f"{name()}@{name()}.org{end}", "email")],
            lambda: [(".".join(str(r.randint(1, 255)) for _ in range(4)) + end, "ip")],
            lambda: [(number + end, "card")],
            lambda: [(number[i:i + 4] + end * (i == 12), "card") for i in range(0, 16, 4)],
            lambda: [(f"+{digits(1)}", "phone"), (area, "phone"), (f"{digits(3)}-{digits(4)}{end}", "phone")],
            lambda: [(f"+{digits(11)}{end}", "phone")],
            lambda: [(f"({digits(3)})", "phone"), (f"{digits(3)}-{digits(4)}{end}", "phone")],
            lambda: [("token", ""), ("=", ""), (f'"{hexa(40)}"{end}', "secret")],
            lambda: [(f"password={hexa(r.randint(14, 20))}{end}", "secret")],
            lambda: [(f"AKIA{mixed(16)}{end}", "secret")],
            lambda: [(f"api_key={hexa(32)}{end}", "secret")],
        ])()

    rows = []
    for i in range(n):
        row = [(plain(), "") for _ in range(r.randint(0, 8))]
        for _ in range(0 if i % 3 == 0 else r.randint(1, 2)):
            row += personal() + [(plain(), "") for _ in range(r.randint(0, 4))]
        rows.append(row or [(word(), "")])
    return rows


@lru_cache(maxsize=2)
def train(rows: int = TRAIN_ROWS, rounds: int = 120, rate: float = 0.2, penalty: float = 2e-3) -> tuple:
    """Weights (features x tags) and transitions (tags x tags) by gradient steps (Adam)
    on the penalised log-likelihood, with forward and backward sums over all rows."""
    table = labelled_rows(rows)
    width, k = max(map(len, table)), len(TAGS)
    coded = np.full((len(table), width, 3 * len(SIZES)), 3 * WIDTH, np.int32)
    tags, real = np.zeros((len(table), width), np.int64), np.zeros((len(table), width), bool)
    for i, row in enumerate(table):
        _, _, f = shapes(" ".join(w for w, _ in row))
        coded[i, :len(row)] = neighbours(f, np.arange(len(f)) == 0)
        tags[i, :len(row)] = [TAGS.index(t) for _, t in row]
        real[i, :len(row)] = True
    params = np.zeros((3 * WIDTH + 1) * k + k * k)
    m, v = np.zeros_like(params), np.zeros_like(params)
    gold = np.eye(k)[tags] * real[..., None]
    pairs = real[:, 1:]

    def log_sum(x, axis):
        top = x.max(axis=axis, keepdims=True)
        return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)

    for step in range(1, rounds + 1):
        weights, moves = params[:-k * k].reshape(-1, k), params[-k * k:].reshape(k, k)
        emit = weights[coded].sum(axis=2) * real[..., None]
        forward, backward = [emit[:, 0]], [np.zeros((len(table), k))]
        for t in range(1, width):
            ahead = log_sum(forward[-1][:, :, None] + moves, 1) + emit[:, t]
            forward.append(np.where(real[:, t, None], ahead, forward[-1]))
        for t in range(width - 1, 0, -1):
            back = log_sum(moves + (emit[:, t] + backward[0])[:, None, :], 2)
            backward.insert(0, np.where(real[:, t, None], back, backward[0]))
        forward, backward = np.stack(forward, 1), np.stack(backward, 1)
        total = log_sum(forward[:, -1], 1)
        marginal = np.exp(forward + backward - total[:, None, None]) * real[..., None]
        both = np.exp(forward[:, :-1, :, None] + moves + (emit[:, 1:] + backward[:, 1:])[:, :, None, :]
                      - total[:, None, None, None]) * pairs[..., None, None]
        grad = np.zeros_like(weights)
        np.add.at(grad, coded[real], (gold - marginal)[real][:, None, :])
        turn = np.einsum("ntab->ab", gold[:, :-1, :, None] * gold[:, 1:, None, :] * pairs[..., None, None] - both)
        g = np.r_[grad.ravel(), turn.ravel()] / len(table) - penalty * params
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        params += rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    weights = params[:-k * k].reshape(-1, k).astype(np.float32)
    weights[-1] = 0
    return weights, params[-k * k:].reshape(k, k).astype(np.float32)


def best_tags(emit: np.ndarray, first: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Best tag paths over the words (words x tags) of whole texts; ``first`` marks words
    that begin a text.

    A word whose best tag leads every other by more than the moves from and to any
    neighbours can make up for has that tag on the best path, whatever stands beside it.  Such
    settled words part a text exactly; the runs of words between them go step by step
    together, from the tag before and to the tag after."""
    n, k = emit.shape
    tags = emit.argmax(axis=1)
    last = np.r_[first[1:], True]
    gain = (np.maximum((moves[:, :, None] - moves[:, None, :]).max(axis=0), 0)
            + np.maximum((moves[:, None, :] - moves[None]).max(axis=2), 0)).T + 1e-3
    np.fill_diagonal(gain, -1)
    loose = ((emit[np.arange(n), tags][:, None] - emit) <= gain[tags]).any(axis=1)
    starts = np.flatnonzero(loose & (first | ~np.r_[False, loose[:-1]]))
    ends = np.flatnonzero(loose & (last | ~np.r_[loose[1:], False]))
    order = np.argsort(starts - ends, kind="stable")  # longest first
    starts, ends = starts[order], ends[order]
    sizes = ends - starts + 1
    steps = int(sizes.max(initial=0))
    live = np.searchsorted(-sizes, -np.arange(steps), side="left")  # runs longer than each step
    score = emit[starts].astype(np.float64) + np.where(first[starts][:, None], 0, moves[tags[starts - 1]])
    back = np.zeros((n, k), np.int8)
    for t in range(1, steps):
        at = starts[:live[t]] + t
        ways = score[:live[t], :, None] + moves
        back[at] = ways.argmax(axis=1)
        score[:live[t]] = ways.max(axis=1) + emit[at]
    best = (score + np.where(last[ends][:, None], 0, moves.T[tags[np.minimum(ends + 1, n - 1)]])).argmax(axis=1)
    for t in range(steps - 1, -1, -1):
        at = starts[:live[t]] + t
        tags[at] = best[:live[t]]
        best[:live[t]] = back[at, best[:live[t]]]
    return tags


def viterbi(emit: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Best tag paths of (sequences, steps, tags)."""
    n, steps, k = emit.shape
    return best_tags(emit.reshape(-1, k), np.arange(n * steps) % steps == 0, moves).reshape(n, steps)


def tag_words(texts: list[str], model: tuple) -> tuple:
    """Over all words of ``texts``: text number, start and end in it, tag number."""
    weights, moves = model
    sizes = np.array([len(t) + 1 for t in texts])
    begin = np.r_[0, np.cumsum(sizes)]
    starts, ends, features = shapes("\n".join([*texts, ""]))
    if not len(starts):
        return starts, starts, ends, starts
    owner = np.searchsorted(begin, starts, side="right") - 1
    first = np.r_[True, owner[1:] != owner[:-1]]
    wide = neighbours(features, first)
    emit = weights[wide[:, 0]]
    for column in range(1, wide.shape[1]):
        emit += weights[wide[:, column]]
    return owner, starts - begin[owner], ends - begin[owner], best_tags(emit, first, moves)


def _trimmed(text: str, a: int, b: int, kind: str) -> tuple[int, int]:
    """A span without quotes and marks around it; of ``name=value`` the value."""
    if kind == "secret":
        a = max(a, text.rfind("=", a, b) + 1)
    opening = "+(" if kind == "phone" else ""
    while a < b and not (text[a].isalnum() or text[a] in opening):
        a += 1
    while b > a and not text[b - 1].isalnum():
        b -= 1
    return a, b


class _Cover:
    """The union of spans, asked for overlaps by binary search."""

    def __init__(self, spans):
        self.starts, self.ends = [], []
        for a, b in sorted(spans):
            if self.ends and a <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def meets(self, a: int, b: int) -> bool:
        i = bisect_right(self.ends, a)
        return i < len(self.ends) and self.starts[i] < b


def find_spans(texts: list[str], model: tuple, least: int = LEAST_SPAN) -> list[tuple[list, list]]:
    """By text: base spans, and all spans by start, then kind; the CRF adds none of fewer than
    ``least`` characters."""
    found = [list(_candidates(t)) for t in texts]
    base = [sorted(((a, b, k) for a, b, k, holds in x if holds), key=lambda s: (s[0], KINDS.index(s[2]))) for x in found]
    cover = [_Cover((a, b) for a, b, _ in x) for x in base]
    failed = [_Cover((a, b) for a, b, _, holds in x if not holds) for x in found]
    own: list[list] = [[] for _ in texts]
    owner, starts, ends, tags = tag_words(texts, model)
    tagged = np.array([i for i in np.flatnonzero(tags).tolist()
                       if not cover[owner[i]].meets(int(starts[i]), int(ends[i]))], np.int64)
    # Words of a secret are secrets of their own; a base span beside a run does not belong to it.
    runs = np.split(tagged, np.flatnonzero((np.diff(tagged) != 1) | (np.diff(tags[tagged]) != 0)
                                           | (np.diff(owner[tagged]) != 0) | (tags[tagged][1:] == TAGS.index("secret"))) + 1)
    for run in runs:
        if len(run):
            doc, kind = int(owner[run[0]]), TAGS[tags[run[0]]]
            a, b = _trimmed(texts[doc], int(starts[run[0]]), int(ends[run[-1]]), kind)
            if b - a >= least and not cover[doc].meets(a, b):
                # What fails a base kind's check stays out, but for a valid number within a longer run of digits.
                if kind == "secret" or _is_whole(texts[doc][a:b], kind) or kind != "card" and not failed[doc].meets(a, b):
                    own[doc].append((a, b, kind))
    return [(x, sorted(x + y, key=lambda s: (s[0], KINDS.index(s[2])))) for x, y in zip(base, own)]


_ARROW = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS[:4]),
                    ("base_sha256", pa.string()), ("spans", pa.string())])


def pii_report(docs: DataFrame) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(train())

    def run(batches):
        for b in pieces(batches, 1024, 1 << 20):
            found = find_spans([t or "" for t in b.column("text").to_pylist()], shared.value)
            counts = {f"n_{k}": [sum(s[2] == k for s in base) for base, _ in found] for k in KINDS[:4]}
            yield batch(_ARROW, doc_id=b.column("doc_id").to_pylist(), **counts,
                        base_sha256=[hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found],
                        spans=[joined(spans) for _, spans in found])

    return docs.select("doc_id", "text").mapInArrow(
        trimmed(run), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redacted(text: str, spans) -> str:
    """The text with each span replaced by ``[kind]``; of overlapping ones, one mark
    of the first for their union."""
    out, at, union = [], 0, []
    for a, b, kind in spans:
        if union and a < union[-1][1]:
            union[-1][1] = max(union[-1][1], b)
        else:
            union.append([a, b, kind])
    for a, b, kind in union:
        out += [text[at:a], f"[{kind}]"]
        at = b
    return "".join(out) + text[at:]


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with all spans in ``text`` replaced by marks; null texts stay null.  Only
    texts with spans come back from Python."""
    shared = docs.sparkSession.sparkContext.broadcast(train())

    @F.arrow_udf("string")
    def marked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        texts = (pa.RecordBatch.from_arrays([b], names=["text"]) for b in batches)
        for b in trimmed(lambda it: pieces(it, 1024, 1 << 20))(texts):
            rows = b.column("text").to_pylist()
            found = find_spans([t or "" for t in rows], shared.value)
            yield pa.array([redacted(t, s) if s else None for t, (_, s) in zip(rows, found)], pa.string())

    text = F.col("text").cast("string")
    return docs.select(*[F.coalesce(marked(text), text).alias(c) if c == "text" else n for c, n in zip(docs.columns, named(docs.columns))])
