r"""Personal data by a semi-Markov conditional random field over whole spans.

Base patterns find e-mail and IP addresses, card and phone numbers; they are
always reported.  Around digits and at-signs the text is cut into tokens, and
every run of at most MAX_TOKENS tokens and MAX_CHARS characters that could be an
entity is a candidate segment (for added spans only; base spans have no such
limit).  Features of the whole span (its digits and how they are grouped, the
separators, checksums, the characters beside it) score it for each kind, and
every two neighbouring segments of a passage score for their kinds; the tokens
outside of segments score nothing.  Dynamic programming over the bounded
segments, with the kind of the last one as its state, chooses boundaries and
kinds together: sums for training (maximum conditional likelihood), maxima for
finding.

The weights are trained on a bounded sample of passages (SAMPLE in
expectation, chosen by a hash of id and text over all documents) labelled by the
base patterns, and on copies of them in which the entity is written in ways
that the base patterns miss (no plus sign, other separators, a spelled-out
at-sign), so that the field adds such spans.

Defined cases: a null text is empty; an empty text, or one without digits and
at-signs, has no spans; whole texts are read, with work linear in their length
and memory for one window of candidates; of segmentations with equal scores the
one found first in the order of ends stays, and spans that start together are
listed by kind; repeated rows are searched each on its own; without any base
match in the sample no span is added; an empty table gives an empty result;
extra columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mobility.llm.common import ROW, keyed, ship

#: The kinds in the order in which they are listed.
KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, str]  # start, end (exclusive), kind

MAX_TOKENS = 16
MAX_CHARS = 100
#: Passages that the field is trained on.
SAMPLE = 300
PASSAGE_CHARS = 60
ROUNDS = 60
L2 = 0.02

# ------------------------------------------------------------------ base spans

#: The base patterns; possessive forms match the same and never run back over long runs.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGITS = re.compile(r"[^0-9]+")


def _digits(text: str) -> str:
    return _NOT_DIGITS.sub("", text)


#: A digit doubled, its digits summed.
_DOUBLED = str.maketrans("0123456789", "0246813579")


def luhn(digits: str) -> bool:
    return (sum(map(int, digits[::-2])) + sum(map(int, digits[-2::-2].translate(_DOUBLED)))) % 10 == 0


def is_ip(text: str) -> bool:
    parts = text.split(".")
    return len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def _is_card(text: str) -> bool:
    digits = _digits(text)
    return 12 <= len(digits) <= 19 and luhn(digits)


def emails(text: str) -> Iterator[Span]:
    """Leftmost e-mail addresses: the local part reaches back from its at-sign, at most to the last address."""
    done = 0
    for m in _DOMAIN.finditer(text) if "@" in text else ():
        start = m.start()
        while start > done and _LOCAL.match(text, start - 1):
            start -= 1
        if start < m.start():
            yield start, m.end(), "email"
            done = m.end()


def base_spans(text: str) -> list[Span]:
    """The base findings of a whole text, by start, then kind."""
    found = list(emails(text))
    found += [(*m.span(), "ip") for m in _IP.finditer(text) if is_ip(m.group())]
    found += [(*m.span(), "card") for m in _CARD.finditer(text) if _is_card(m.group())]
    found += [(*m.span(), "phone") for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return in_order(found)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


# ---------------------------------------------------------- segments, features

_TOKEN = re.compile(r"[^\W_]+|\s+|.", re.S)
_TRIGGER = re.compile(r"[0-9@]|[(\[]at[)\]]", re.I)
_AT = re.compile(r"@|\s?[(\[]at[)\]]\s?", re.I)
_NUMBER_SEPARATORS = frozenset(" ().-+/")
_ADDRESS_SEPARATORS = frozenset("@_%[]")
_ADDRESS = re.compile(r"[\w.%+-]+(?:@|\s?[(\[]at[)\]]\s?)[\w-]+(?:\.[\w-]+)+", re.I)


def _windows(text: str, start: int, end: int) -> Iterator[list[tuple[int, int]]]:
    """For every token of text[start:end] it and the ones after it, MAX_TOKENS in all."""
    window: deque[tuple[int, int]] = deque()
    for m in _TOKEN.finditer(text, start, end):
        window.append(m.span())
        if len(window) == MAX_TOKENS:
            yield list(window)
            window.popleft()
    while window:
        yield list(window)
        window.popleft()


def candidates(text: str, start: int, end: int) -> Iterator[tuple[int, int, bool]]:
    """(start, end, whether without letters) of the spans in text[start:end] that could be an entity, by start."""
    for tokens in _windows(text, start, end):
        a = tokens[0][0]
        if not (text[a].isalnum() or text[a] in "+("):
            continue
        digits = 0
        numeric = True
        for b, e in tokens:
            if e - a > MAX_CHARS:
                break
            token = text[b:e]
            if token.isdigit() and token.isascii():
                digits += e - b
                if numeric:
                    if digits >= 7:
                        yield a, e, True
                    continue
            elif token[0].isalnum():
                numeric = False
            elif token not in _NUMBER_SEPARATORS and token not in _ADDRESS_SEPARATORS:
                if not token.isspace() or not numeric and not _AT.search(text, max(b - 5, a), min(e + 5, len(text))):
                    break
                continue
            elif token == " " and not numeric and not _AT.search(text, max(b - 5, a), min(e + 5, len(text))):
                break
            else:
                continue
            if _AT.search(text, a, e):
                yield a, e, False


def passages(text: str) -> list[tuple[int, int]]:
    """Stretches around digits and at-signs, merged where they touch; they cut no run of letters and digits."""
    out: list[list[int]] = []

    def add(a: int, b: int) -> None:
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])

    near: list[list[int]] = []
    for m in _TRIGGER.finditer(text):
        a, b = max(m.start() - PASSAGE_CHARS, 0), min(m.end() + PASSAGE_CHARS, len(text))
        if near and a <= near[-1][1]:
            near[-1][1] = b
        else:
            near.append([a, b])
    for a, b in near:
        done = out[-1][1] if out else 0
        while a > done and text[a - 1].isalnum() and text[a].isalnum():
            a -= 1
        b = max(b, done)
        while b < len(text) and text[b - 1].isalnum() and text[b].isalnum():
            b += 1
        add(a, b)
    return [(a, b) for a, b in out]


def _side(char: str) -> str:
    if not char:
        return "end"
    return "digit" if char.isdigit() else "letter" if char.isalpha() else "space" if char.isspace() else char


def features(text: str, start: int, end: int) -> list[str]:
    """Features of the whole span and of the characters beside it."""
    span = text[start:end]
    digits = _digits(span)
    runs = [len(r) for r in re.findall("[0-9]+", span)]
    separators = "".join(sorted(set(re.sub(r"[^\W_]+", "", span))))[:6]
    letters = any(c.isalpha() for c in span)
    n = len(digits)
    size = "0" if not n else "1-6" if n < 7 else "7-8" if n < 9 else "9-11" if n < 12 else "12-15" if n < 16 else "16-19" if n < 20 else "20+"
    out = [
        "any",
        f"digits {size}",
        f"runs {'-'.join(map(str, runs[:6])) if not letters else ''}",
        f"separators {separators} {letters}",
        f"starts {_side(span[0])} {letters}",
        f"before {_side(text[start - 1 : start])}",
        f"after {_side(text[end : end + 1])}",
        f"sides {_side(text[start - 1 : start])} {_side(text[end : end + 1])}",
        f"address {bool(_ADDRESS.fullmatch(span))}",
        f"closed {span.count('(') == span.count(')')}",
    ]
    if not letters:
        out += [f"ip {is_ip(span)}", f"card {12 <= n <= 19 and luhn(digits)}", f"phone {'+' in span[:1]} {9 <= n <= 15}"]
    return out


_SHAPE = str.maketrans("123456789", "0" * 9)
#: Scores of shapes that a field keeps.
CACHED_SHAPES = 100_000


@dataclass
class Field:
    """The trained field: weights[feature] has one number for each kind, follows[before][kind] one for neighbours.

    ``before`` is 0 where no segment is before, otherwise one more than its kind.
    """

    weights: dict[str, np.ndarray]
    follows: np.ndarray
    cache: dict = field(default_factory=dict, repr=False, compare=False)

    def _sum(self, text: str, start: int, end: int) -> list[float]:
        zero = np.zeros(len(KINDS))
        return sum((self.weights.get(f, zero) for f in features(text, start, end)), zero).tolist()

    def score(self, text: str, start: int, end: int, numeric: bool) -> list[float]:
        """The span's score for each kind; spans without letters that look alike to the features are looked up."""
        if not numeric:
            return self._sum(text, start, end)
        span = text[start:end]
        n = len(_digits(span)) if span.isascii() else 0
        key = (
            span.translate(_SHAPE), _side(text[start - 1 : start]), _side(text[end : end + 1]),
            span.count(".") == 3 and is_ip(span), 12 <= n <= 19 and luhn(_digits(span)),
        )
        found = self.cache.get(key)
        if found is None:
            if len(self.cache) >= CACHED_SHAPES:
                self.cache.clear()
            found = self.cache[key] = self._sum(text, start, end)
        return found

    def best(self, text: str, start: int, end: int) -> list[Span]:
        """The segmentation of text[start:end] with the highest score."""
        scored = ((a, e, self.score(text, a, e, numeric)) for a, e, numeric in candidates(text, start, end))
        return best_segments(scored, self.follows.tolist())


def best_segments(scored: Iterable[tuple[int, int, list[float]]], follows: list[list[float]]) -> list[Span]:
    """Maximum over all sets of disjoint segments with a kind each, of their scores and those of neighbours.

    Segments come by start.  ``value[y]`` is the best of what ends up to here
    with last kind y (0: none), ``chain[y]`` its segments, the last one first;
    segments that end later wait.  One that is no better where it starts than
    what is there without it can be no better where it ends.
    """
    kinds = range(len(KINDS))
    value = [0.0] + [-math.inf] * len(KINDS)
    chain: list[tuple | None] = [None] * len(value)
    waiting: list[tuple] = []
    here, into = -1, []

    def settle(upto: float) -> bool:
        changed = False
        while waiting and waiting[0][0] <= upto:
            _, _, y, total, segments = heapq.heappop(waiting)
            if total > value[y]:
                value[y], chain[y], changed = total, segments, True
        return changed

    for n, (a, e, score) in enumerate(scored):
        if a != here:
            if settle(a) or here < 0:
                into = []
                for y in kinds:
                    before = max(range(len(value)), key=lambda x: value[x] + follows[x][y])
                    into.append((value[before] + follows[before][y], chain[before]))
            here = a
        for y in kinds:
            total = into[y][0] + score[y]
            if total > value[y + 1]:
                heapq.heappush(waiting, (e, n * len(KINDS) + y, y + 1, total, ((a, e, KINDS[y]), into[y][1])))
    settle(math.inf)
    last = chain[max(range(len(value)), key=value.__getitem__)]
    out = []
    while last is not None:
        segment, last = last
        out.append(segment)
    return out[::-1]


class Lattices:
    """The candidate segments of many passages, for sums over all their segmentations at once.

    Places are numbers of a passage's segment edges; the passages go through
    theirs in step.
    """

    def __init__(self, spans: list[list[tuple[int, int]]]):
        start, end, owner = [], [], []
        for i, own in enumerate(spans):
            edges = {x: k for k, x in enumerate(sorted({x for s in own for x in s}))}
            start += [edges[a] for a, _ in own]
            end += [edges[b] for _, b in own]
            owner += [i] * len(own)
        self.n, self.start, self.end, self.owner = len(spans), np.array(start, int), np.array(end, int), np.array(owner, int)
        self.places = int(self.end.max()) + 1 if len(end) else 1
        self.ending = [np.flatnonzero(self.end == k) for k in range(self.places)]
        self.starting = [np.flatnonzero(self.start == k) for k in range(self.places)]

    def marginals(self, scores: np.ndarray, follows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(log of the sum of each passage, probability of every segment and kind, expected neighbours of all)."""
        kinds = scores.shape[1]
        forward = np.full((self.places, self.n, kinds + 1), -np.inf)
        forward[0, :, 0] = 0
        into = np.empty((len(scores), kinds + 1, kinds))  # up to a segment, by the kind before it
        for k in range(self.places):
            if k:
                forward[k] = forward[k - 1]
                i = self.ending[k]
                np.logaddexp.at(forward[k], (self.owner[i][:, None], np.arange(1, kinds + 1)[None]), _logsum(into[i], 1) + scores[i])
            i = self.starting[k]
            into[i] = forward[k, self.owner[i]][:, :, None] + follows
        backward = np.zeros((self.places, self.n, kinds + 1))
        for k in range(self.places - 2, -1, -1):
            backward[k] = backward[k + 1]
            i = self.starting[k]
            rest = (scores[i] + backward[self.end[i], self.owner[i], 1:])[:, None, :] + follows
            np.logaddexp.at(backward[k], (self.owner[i][:, None], np.arange(kinds + 1)[None]), _logsum(rest, 2))
        total = _logsum(forward[-1], 1)
        rest = scores + backward[self.end, self.owner, 1:] - total[self.owner][:, None]
        p = np.exp(into + rest[:, None, :])
        return total, p.sum(axis=1), p.sum(axis=0)


def _logsum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True, initial=-1e300)
    return np.log(np.exp(values - top).sum(axis=axis)) + top.squeeze(axis)


# --------------------------------------------------------------------- training

Example = tuple[str, list[Span]]


def rewritten(text: str, spans: list[Span]) -> Iterator[Example]:
    """Copies of a passage in which one entity is written as the base patterns miss it."""
    for i, (a, b, kind) in enumerate(spans):
        if any(x < b and a < y for j, (x, y, _) in enumerate(spans) if j != i):
            continue
        span, forms = text[a:b], []
        if kind == "phone":
            forms = [span.lstrip("+"), re.sub(r"^\+[0-9]+[\x20.-]?", "", span), re.sub(r"^\+[0-9]+\s?", "", span).replace("(", "").replace(")", "").replace(" ", "-")]
            forms = [f for f in forms if 9 <= len(_digits(f)) <= 15]
        elif kind == "card":
            digits = _digits(span)
            forms = [sep.join(digits[k : k + 4] for k in range(0, len(digits), 4)) for sep in "./"]
        elif kind == "email":
            forms = [span.replace("@", " (at) "), span.replace("@", "[at]")]
        for form in forms:
            shift = len(form) - (b - a)
            moved = [(x, y, k) if y <= a else (x + shift, y + shift, k) for j, (x, y, k) in enumerate(spans) if j != i]
            yield text[:a] + form + text[b:], in_order([*moved, (a, a + len(form), kind)])


def train(examples: list[Example], rounds: int = ROUNDS) -> Field:
    """Maximum conditional likelihood by gradient steps of adapted size (adagrad)."""
    names: dict[str, int] = {}
    spans, rows, targets, neighbours = [], [], [], np.zeros((len(KINDS) + 1, len(KINDS)))
    for text, gold in examples:
        own = [(a, e) for a, e, _ in candidates(text, 0, len(text))]
        wanted = {(a, b): KINDS.index(k) for a, b, k in gold}
        spans.append(own)
        rows += [[names.setdefault(f, len(names)) for f in features(text, a, b)] for a, b in own]
        target = np.zeros((len(own), len(KINDS)))
        before = 0
        for i, s in enumerate(own):
            if s in wanted:
                target[i, wanted[s]] = 1
                neighbours[before, wanted[s]] += 1
                before = wanted[s] + 1
        targets.append(target)
    weights, follows = np.zeros((len(names) + 1, len(KINDS))), np.zeros_like(neighbours)  # the last row stands for no feature
    if not rows:
        return Field({}, follows)
    width = max(map(len, rows))
    index, target = np.array([r + [-1] * (width - len(r)) for r in rows]), np.concatenate(targets)
    lattices = Lattices(spans)
    squares, follow_squares = np.full_like(weights, 1e-6), np.full_like(follows, 1e-6)
    for _ in range(rounds):
        _, p, expected = lattices.marginals(weights[index].sum(axis=1), follows)
        gradient = -L2 * weights
        np.add.at(gradient, index, (target - p)[:, None, :])
        gradient[-1] = 0
        follow = neighbours - expected - L2 * follows
        squares += gradient**2
        follow_squares += follow**2
        weights += 0.3 * gradient / np.sqrt(squares)
        follows += 0.3 * follow / np.sqrt(follow_squares)
    return Field({f: weights[i] for f, i in names.items()}, follows)


def fit(docs: DataFrame, sample: int = SAMPLE) -> Field | None:
    """Trains on about ``sample`` passages of (doc_id, text) documents; None if none has a base span.

    The draw depends on ids and texts only, not on where a scan finds them.
    """
    ship(docs.sparkSession)
    some = docs.filter(F.col("text").rlike("[0-9@]"))
    n = some.count()
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit(3)), F.lit(1 << 30)) / (1 << 30)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(0).to_pylist():
                for a, b in passages(text)[:3]:  # a few of each sampled text
                    if b - a <= 10 * PASSAGE_CHARS:
                        found.append(text[a:b])
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(found)], names=["passage"])

    chosen = some.filter(draw < sample / max(n, 1)).select("text").mapInArrow(cut, "passage string")
    chosen = chosen.orderBy(F.xxhash64("passage"), "passage").limit(4 * sample)
    texts = sorted(r["passage"] for r in chosen.collect())
    examples: list[Example] = []
    for text in texts:
        spans = [s for s in base_spans(text)]
        disjoint = [s for s in spans if not any(t != s and t[0] < s[1] and s[0] < t[1] for t in spans)]
        examples.append((text, disjoint))
        examples += list(rewritten(text, disjoint))
    return train(examples) if any(gold for _, gold in examples) else None


def all_spans(text: str, trained: Field | None) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans): what the field adds never overlaps a base span."""
    if not _TRIGGER.search(text):
        return [], []
    base = base_spans(text)
    if trained is None:
        return base, base
    added = [s for a, b in passages(text) for s in trained.best(text, a, b)]
    taken = np.zeros(0, np.int64) if not base else np.array([(a, b) for a, b, _ in base])
    if len(base):
        starts, reach = taken[:, 0], np.maximum.accumulate(taken[:, 1])
        added = [s for s in added if not (k := int(np.searchsorted(starts, s[1]))) or reach[k - 1] <= s[0]]
    return base, in_order([*base, *added])


def listed(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


FOUND = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def find(docs: DataFrame, trained: Field | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_row, doc_id, counts and digest of base spans, all spans) of every row of ``docs``."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                out = []
                for text in part.column(2).to_pylist():
                    base, spans = all_spans(text, trained)
                    counts = [sum(s[2] == k for s in base) for k in KINDS]
                    out.append((*counts, hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans), len(spans) - len(base)))
                kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
                names = [f"n_{k}" for k in KINDS] + ["base_sha256", "spans", "n_added"]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *[pa.array(c, k) for c, k in zip(zip(*out), kinds)]], names=[ROW, "doc_id", *names]
                )

    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = keyed(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    return rows.mapInArrow(search, f"{ROW} long, doc_id {kind}, {FOUND}")


def query(docs: DataFrame) -> DataFrame:
    return find(docs, fit(keyed(docs))).drop(ROW)
