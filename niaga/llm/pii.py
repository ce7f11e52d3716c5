"""Personal data by weak supervision (operator 10).

Fixed patterns give the base spans of four kinds, which always stay. Looser patterns add candidates. Six labelers vote on every
candidate (yes, no or silent): the strict pattern, a structural check, a gazetteer, words of the context, the characters at its
borders, and its shape. Spark counts how often each combination of votes and features occurs over the whole corpus; their
number is bounded by the votes, not by the data. Expectation-maximisation on these counts estimates how reliable each labeler is
without any label, and a logistic span classifier is trained on its posteriors. Candidates that it accepts are added where they
touch no base span and no better candidate.

Results for odd rows: a null or empty text has no spans; a null id stays null; repeated rows give repeated rows; spans of different
kinds may overlap, base spans of one kind do not; without any candidate the classifier accepts nothing; other columns are ignored;
an empty table gives an empty one. Offsets count code points of the whole text.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from niaga.llm.common import batch, fields, passed, slices, texts, with_rest

KINDS = ("email", "ip", "card", "phone")
LABELERS = 6
FEATURES = 4  # yes/no features of a candidate
ACCEPT = 0.5

# Gazetteers and context words.
TOP_LEVEL = {"com", "org", "net", "edu", "gov", "info", "biz", "io", "de", "fr", "es", "uk", "us", "it", "nl", "eu", "ch", "at", "be", "ca", "au", "mx", "br", "ar"}
COUNTRY_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "54", "55", "56", "57", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "98", "351", "352", "353", "358", "420", "421")
CARD_STARTS = ("34", "37", "35", "4", "51", "52", "53", "54", "55", "22", "23", "24", "25", "26", "27", "60", "62", "64", "65")
CONTEXT = {
    "email": ("mail", "contact", "write to", "kontakt", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "login", "client"),
    "card": ("card", "visa", "credit", "payment", "amex", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "fax", "mobile", "cell", "ring", "handy", "llame"),
}
AGAINST = ("version", "isbn", "order", "invoice", "serial", "section", "chapter", "release", "build", "doi", "part no")

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOOSE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]{1,64} ?[(\[]at[)\]] ?[A-Za-z0-9-]+(?: ?(?:[(\[]dot[)\]]|\.) ?[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"),
    "card": re.compile(r"(?<![0-9.])[0-9]{4}(?:([./_])[0-9]{4})(?:\1[0-9]{4}){2}(?![0-9.])"),
    "phone": re.compile(r"(?<![0-9+(.-])(?:00[1-9][0-9]{0,2}[ .-])?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"),
}
_DIGIT = re.compile(r"[0-9]")


class Candidate(NamedTuple):
    kind: int
    start: int
    end: int
    base: bool
    pattern: int  # votes and features


def digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(number: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of the address pattern: what stands before each @ is walked back, so no part is scanned twice."""
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base spans, by start and then kind."""
    out = [(s, 0, e) for s, e in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in m.group().split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12 and 12 <= len(number := digits(m.group())) <= 19 and luhn(number):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(digits(m.group())) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def _loose_spans(text: str) -> list[tuple[int, int, int]]:
    out = []
    for k, kind in enumerate(KINDS):
        if kind == "email" and "(at)" not in text and "[at]" not in text or kind == "ip" and ":" not in text:
            continue
        out += [(m.start(), k, m.end()) for m in _LOOSE[kind].finditer(text)]
    return out


def _votes(text: str, kind: int, start: int, end: int, base: bool) -> tuple[list[int], list[int]]:
    """Votes (1 yes, -1 no, 0 silent) of the labelers, and the features, of one candidate."""
    name, value = KINDS[kind], text[start:end]
    number = digits(value)
    before = text[max(0, start - 40) : start].lower()
    if name == "email":
        end_part = re.split(r"[.@)\] ]", value.lower())[-1]
        check, known = 1 if end_part.isalpha() and len(end_part) >= 2 else -1, 1 if end_part in TOP_LEVEL else -1
        shape = 1 if 6 <= len(value) <= 64 else -1
    elif name == "ip":
        parts = value.split("." if "." in value else ":")
        check = 1 if len(parts) in (4, 8) else -1
        known = -1 if parts[0] in ("0", "255") else 1
        shape = 1 if len(parts) == 8 or all(p == p.lstrip("0") or p == "0" for p in parts) else -1
    elif name == "card":
        check, known = 1 if luhn(number) else -1, 1 if number.startswith(CARD_STARTS) else -1
        shape = 1 if len(number) in (15, 16) else 0
    else:
        check = 1 if 9 <= len(number) <= 15 else -1
        known = 1 if value[0] == "+" and number.startswith(COUNTRY_CODES) or value.startswith("00") else 0
        shape = 1 if re.search(r"[ ().-]", value) else 0
    near = {*re.findall(r"[^\W\d_]+", before)}
    context = -1 if any(w in before for w in AGAINST) else 1 if any(w in near or " " in w and w in before for w in CONTEXT[name]) else 0
    edge = (text[start - 1 : start] + text[end : end + 1]).strip()
    border = -1 if any(c.isalnum() or c in "_=/#$" for c in edge) else 1
    votes = [1 if base else 0, check, known, context, border, shape]
    return votes, [int(base), int("." in value), int(" " in value or "-" in value), int(len(number) > 11)]


class Taken:
    """Stretches of a text, in the order of their starts: whether another one meets any of them."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        self.starts = [s for s, _, _ in spans]
        self.reach = list(accumulate((e for _, _, e in spans), max))  # the farthest end up to each of them

    def meets(self, start: int, end: int) -> bool:
        before = bisect_left(self.starts, end)  # those that begin before its end
        return before > 0 and self.reach[before - 1] > start


class Apart:
    """Stretches that do not meet each other, added one by one."""

    def __init__(self):
        self.starts: list[int] = []
        self.ends: list[int] = []

    def add(self, start: int, end: int) -> bool:
        """Whether the stretch met none of the others and is now one of them."""
        at = bisect_left(self.starts, start)
        if at and self.ends[at - 1] > start or at < len(self.starts) and self.starts[at] < end:
            return False
        self.starts.insert(at, start)
        self.ends.insert(at, end)
        return True


def candidates(text: str) -> list[Candidate]:
    base = base_spans(text)
    found = [(*span, True) for span in base]
    if "(at)" in text or "[at]" in text or _DIGIT.search(text):
        taken = Taken(base)
        found += [(*span, False) for span in _loose_spans(text) if not taken.meets(span[0], span[2])]
    out = []
    for start, kind, end, strict in found:
        votes, features = _votes(text, kind, start, end, strict)
        code = 0
        for v in votes:
            code = code * 3 + v + 1
        for f in features:
            code = code * 2 + f
        out.append(Candidate(kind, start, end, strict, code * len(KINDS) + kind))
    return out


def unpacked(patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(votes, features, kind) of pattern codes."""
    kind, code = patterns % len(KINDS), patterns // len(KINDS)
    features = np.column_stack([code >> i & 1 for i in reversed(range(FEATURES))])
    code = code >> FEATURES
    votes = np.column_stack([code // 3**i % 3 - 1 for i in reversed(range(LABELERS))])
    return votes, features, kind


def pattern_counts(docs: DataFrame) -> dict[int, int]:
    """How often each combination occurs in all texts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[int] = Counter()
        for part in slices(batches):
            for text in part.column("text").to_pylist():
                total.update(c.pattern for c in candidates(text))
        schema = pa.schema([("pattern", pa.int64()), ("n", pa.int64())])
        yield batch(schema, list(total), list(total.values()))

    counted = texts(docs).mapInArrow(work, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n"))
    return {r.pattern: r.n for r in counted.collect()}


def reliabilities(votes: np.ndarray, kind: np.ndarray, weight: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """(posterior of each pattern, vote table (class, labeler, vote)): labelers vote independently given the truth, and each
    kind has its own share of true candidates. Starts from the majority."""
    truth = 1 / (1 + np.exp(-votes.sum(axis=1)))
    hot = votes[:, :, None] == np.array([-1, 0, 1])
    table = np.zeros((2, LABELERS, 3))
    for _ in range(rounds):
        for c, share in enumerate((1 - truth, truth)):
            table[c] = (hot * (weight * share)[:, None, None]).sum(axis=0) + 1
            table[c] /= table[c].sum(axis=1, keepdims=True)
        prior = np.array([((weight * truth)[kind == k].sum() + 1) / (weight[kind == k].sum() + 2) for k in range(len(KINDS))])
        ratio = (hot * np.log(table[1] / table[0])).sum(axis=(1, 2)) + np.log(prior / (1 - prior))[kind]
        truth = 1 / (1 + np.exp(-np.clip(ratio, -30, 30)))
    return truth, table


def _design(patterns: np.ndarray) -> np.ndarray:
    votes, features, kind = unpacked(patterns)
    return np.column_stack([votes == 1, votes == -1, features, kind[:, None] == np.arange(len(KINDS)), np.ones(len(patterns))]).astype(float)


class Model:
    """The span classifier: logistic in votes, features and kind."""

    def __init__(self, weights: np.ndarray | None = None, table: np.ndarray | None = None):
        self.weights, self.table = weights, table

    def probability(self, patterns: np.ndarray) -> np.ndarray:
        if self.weights is None or not len(patterns):
            return np.zeros(len(patterns))
        return 1 / (1 + np.exp(-np.clip(_design(patterns) @ self.weights, -30, 30)))


def fit(docs: DataFrame) -> Model:
    counts = pattern_counts(docs)
    if not counts:
        return Model()
    patterns = np.array(sorted(counts))
    weight = np.array([counts[p] for p in patterns], float)
    votes, _, kind = unpacked(patterns)
    truth, table = reliabilities(votes, kind, weight)
    x = _design(patterns)
    w = np.zeros(x.shape[1])
    for _ in range(30):  # Newton steps of a ridge-penalised logistic regression on soft labels
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (weight * (p - truth)) + w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return Model(w, table)


def accepted(text: str, model: Model) -> list[tuple[int, int, int, bool, float]]:
    """(start, kind, end, base, probability) of all spans of a text: the base, and accepted candidates."""
    found = candidates(text)
    if not found:
        return []
    chance = model.probability(np.array([c.pattern for c in found]))
    out = [(c.start, c.kind, c.end, True, float(p)) for c, p in zip(found, chance, strict=True) if c.base]
    more = [(float(p), c) for c, p in zip(found, chance, strict=True) if not c.base and p >= ACCEPT]
    apart = Apart()  # candidates do not meet base spans
    for p, c in sorted(more, key=lambda x: (-x[0], x[1].start, x[1].kind)):
        if apart.add(c.start, c.end):
            out.append((c.start, c.kind, c.end, False, p))
    return sorted(out)


def joined(spans: list[tuple]) -> str:
    return ",".join(f"{KINDS[s[1]]}:{s[0]}:{s[2]}" for s in spans)


def redacted(text: str, spans: list[tuple]) -> str:
    """The text with each stretch of spans replaced by the name of its first kind in angle brackets."""
    out, done, at = [], 0, 0
    while at < len(spans):
        start, kind, end = spans[at][:3]
        while at + 1 < len(spans) and spans[at + 1][0] < end:
            at += 1
            end = max(end, spans[at][2])
        out += [text[done:start], f"<{KINDS[kind].upper()}>"]
        done, at = end, at + 1
    return "".join(out) + text[done:]


def spans(docs: DataFrame, model: Model | None = None, carry: bool = False) -> DataFrame:
    """(doc_id, spans, base, found, redacted) of every text; spans is an array of (kind, start, end, base, probability) by start and
    kind, base the joined base spans, found all of them joined; with carry also the struct ``rest`` of all input columns."""
    model = model or fit(docs)
    texts_in = with_rest(docs) if carry else texts(docs)
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("probability", pa.float64())])
    kinds = [("doc_id", pa.int64()), ("spans", pa.list_(span)), ("base", pa.string()), ("found", pa.string()), ("redacted", pa.string())]
    schema = pa.schema(kinds)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            values = part.column("text").to_pylist()
            found = [accepted(text, model) for text in values]
            rows = [[{"kind": KINDS[k], "start": s, "end": e, "base": b, "probability": p} for s, k, e, b, p in f] for f in found]
            changed = [redacted(text, f) if f else text for text, f in zip(values, found, strict=True)]
            strict = [joined([s for s in f if s[3]]) for f in found]
            yield passed(part, batch(schema, part.column("doc_id"), rows, strict, [joined(f) for f in found], changed))

    made = "doc_id long, spans array<struct<kind: string, start: long, end: long, base: boolean, probability: double>>"
    return texts_in.mapInArrow(work, fields(texts_in, f"{made}, base string, found string, redacted string"))
