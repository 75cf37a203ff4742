"""Personal data in texts: weak labelers vote, and a classifier learns from their votes.

Strict patterns give the base spans, which always stay. Looser ones give further
candidates: addresses written out, other address families, numbers in national forms or
with other separators. Each candidate, strict ones too, is put before labelers that say
yes, no or nothing: its form, a gazetteer, and the words around it. How reliable each of
them is, is estimated by expectation-maximisation from nothing but their agreement over
the whole corpus, and a logistic classifier of votes and surroundings is then fitted to
the estimated truth. Candidates it is sure of are added.

What is learnt from is a table of counts, one row for each pattern of votes and
surroundings, so its size is bounded by their number and not by the corpus.
"""

from __future__ import annotations

import ipaddress
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
# How sure the classifier must be to add a span.
SURE = 0.9
# Characters before and after a candidate in which words count as its context.
BEFORE, AFTER = 32, 16

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A number of digits is begun at its first one, so these take linear time.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_NOT_DIGIT = re.compile("[^0-9]+")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2]))) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free = 0  # where the last match ended
    at = text.find("@")
    while at >= 0:
        # Nothing may start before an earlier @ or in an earlier match.
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        free = domain.end() if domain else at + 1
        at = text.find("@", free)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of strict matches in code points, by kind and start."""
    found = [("email", *span) for span in _emails(text)]
    if not _DIGIT.search(text):
        return found
    for m in _IP.finditer(text):
        parts = (p.lstrip("0") for p in m[0].split("."))
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and _is_card(m[0]):
            found.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            found.append(("phone", *m.span()))
    return found


def _is_card(part: str) -> bool:
    digits = _NOT_DIGIT.sub("", part)
    return 13 <= len(digits) <= 19 and luhn(digits)


_AT = re.compile(r"\s?[\[({]\s?(?:at|@)\s?[\])}]\s?|\sat\s|\s@\s", re.IGNORECASE)
_DOT = r"(?:\.|\s?[\[({]\s?(?:dot|\.)\s?[\])}]\s?|\sdot\s)"
_SPELT = re.compile(rf"[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{2,63}}){{1,4}}+", re.IGNORECASE)
_DOT_WORD = re.compile(r"\sdot\s|[\[({]", re.IGNORECASE)
_NAME = re.compile(r"[A-Za-z0-9._%+-]{1,64}\Z")
_IPV6 = re.compile(r"(?<![0-9A-Za-z:.])[0-9A-Fa-f:]{2,39}(?![0-9A-Za-z:])")
_OTHER_CARD = re.compile(r"(?<![0-9])[0-9]{4}(?:[ ./_-]{1,3}[0-9]{4}){2}[ ./_-]{1,3}[0-9]{1,7}(?![0-9])")
_NATIONAL = re.compile(
    r"(?<![0-9+(])(?:\([0-9]{2,5}\)\s?|(?:00?[0-9]{1,4}|[0-9]{3})[ ./-])"
    r"[0-9]{3,4}[ ./-]?[0-9]{3,4}(?:[ .-][0-9]{2,4})?(?![0-9])"
)
_BARE = re.compile(r"(?<![0-9.+-])[0-9]{10,12}(?![0-9])")


def _loose(text: str) -> Iterator[tuple[str, int, int]]:
    for m in _AT.finditer(text):
        domain = _SPELT.match(text, m.end())
        # "at" as a word is one of many, unless the dot is written out as well.
        if domain and m[0].strip().isalpha() and not _DOT_WORD.search(domain[0]):
            continue
        name = _NAME.search(text[max(0, m.start() - 64) : m.start()]) if domain else None
        if name:
            yield "email", m.start() - len(name[0]), domain.end()
    if "::" in text or text.count(":") >= 7:
        for m in _IPV6.finditer(text):
            if m[0].count(":") >= 2:
                yield "ip", *m.span()
    if not _DIGIT.search(text):
        return
    for m in _IP.finditer(text):
        yield "ip", *m.span()
    for m in _CARD.finditer(text):
        if 15 <= m.end() - m.start() <= 37:
            yield "card", *m.span()
    for kind, pattern in (("card", _OTHER_CARD), ("phone", _NATIONAL), ("phone", _BARE)):
        for m in pattern.finditer(text):
            yield kind, *m.span()


# Top-level domains, first digits of card issuers, calling codes, and the
# words that go with a kind or speak against all.
DOMAINS = frozenset(
    "com org net edu gov mil int info biz io co ai app dev me tv eu us uk de fr es it nl be at ch se no dk"
    " fi pl pt ie cz ru ua tr gr hu ro in cn jp kr au nz br mx ar cl pe ca za".split()
)
CARD_PREFIXES = ("4", "51", "52", "53", "54", "55", "2221", "2720", "34", "37", "6011", "65", "35", "36", "38", "62")
CALLING_CODES = ("+1", "+20", "+27", "+3", "+4", "+5", "+6", "+7", "+8", "+9", "001", "0033", "0034", "0044", "0049")
CUES = {
    "email": "mail|e-mail|email|contact|write|correo|courriel|reach",
    "ip": "ip|ipv6|address|host|server|client|login|dirección|adresse",
    "card": "card|visa|mastercard|amex|credit|debit|tarjeta|carte|karte",
    "phone": "phone|telephone|tel|call|fax|mobile|cell|whatsapp|teléfono|téléphone|telefon|handy",
}
COUNTER_CUES = (
    "version|release|section|chapter|isbn|issn|doi|order|invoice|serial|part|page|figure|total|price|usd|eur|id"
)
_CUES = {kind: re.compile(rf"\b(?:{words})\b") for kind, words in CUES.items()}
_COUNTER = re.compile(rf"\b(?:{COUNTER_CUES})\b|[$€#=]")

LABELERS = ("form", "gazetteer", "cue", "counter cue", "edges", "variety")


def _votes(kind: str, part: str, strict: bool, before: str, after: str) -> tuple[int, ...]:
    """One of 0 (no), 1 (nothing) and 2 (yes) by each of the labelers."""
    digits = _NOT_DIGIT.sub("", part)
    near = bool(_CUES[kind].search(before))
    against = not near and bool(_COUNTER.search(before))
    if kind == "email":
        form = 2 if strict else 1
        top = re.split(r"[^A-Za-z0-9-]+", part.rstrip(")]}").lower())[-1]
        listed = 2 if top in DOMAINS else 0
    elif kind == "ip":
        form, listed = 2 if strict else 0, 1
        try:
            address = ipaddress.ip_address(part)
            form = 2 if strict or part.count(":") > 3 else 0
            listed = 0 if address.is_unspecified or address.is_loopback or address.is_multicast else 2
        except ValueError:
            pass
    elif kind == "card":
        form = 2 if 13 <= len(digits) <= 19 and luhn(digits) else 0
        listed = 2 if digits.startswith(CARD_PREFIXES) else 0
    else:
        grouped = len(_NOT_DIGIT.findall(part))
        form = 2 if strict or "(" in part else 1 if grouped >= 2 else 0
        listed = 2 if part.startswith(CALLING_CODES) else 1
    outside = before[-1:] + after[:1]
    edges = 0 if any(c.isalnum() or c in "/\\_=%" for c in outside) else 1
    if kind == "email":
        edges = 1
    variety = 0 if kind in ("card", "phone") and len(set(digits)) < 4 else 1
    return form, listed, 2 if near else 1, 0 if against else 1, edges, variety


def _surroundings(kind: str, part: str, strict: bool, before: str, after: str) -> tuple[int, ...]:
    """Classes of what a candidate looks like, beyond the votes; ``_SIZES`` has their number."""

    def char_class(c: str) -> int:
        return 0 if not c else 1 if c.isspace() else 2 if c.isalnum() else 3

    separators = len(_NOT_DIGIT.findall(part))
    return (
        int(strict),
        char_class(before[-1:]),
        char_class(after[:1]),
        min(len(part) // 8, 3),
        min(separators, 3),
    )


_SIZES = (2, 4, 4, 4, 4)


@dataclass(frozen=True)
class Candidate:
    kind: str
    start: int
    end: int
    strict: bool
    votes: tuple[int, ...]
    around: tuple[int, ...]


def candidates(text: str) -> list[Candidate]:
    """Strict matches, and loose ones that don't overlap any of them, by kind and start."""
    strict = base_spans(text)
    taken = sorted((s, e) for _, s, e in strict)
    spans = [(k, s, e, True) for k, s, e in strict]
    if taken:
        starts = np.array([s for s, _ in taken])
        reach = np.maximum.accumulate([e for _, e in taken])
    seen = set()
    for kind, s, e in _loose(text):
        if taken:
            before = int(np.searchsorted(starts, e)) - 1  # the last that starts before e
            if before >= 0 and reach[before] > s:
                continue
        if (kind, s, e) not in seen:
            seen.add((kind, s, e))
            spans.append((kind, s, e, False))
    out = []
    for kind, s, e, is_strict in sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1], x[2])):
        part = text[s:e]
        before, after = text[max(0, s - BEFORE) : s].lower(), text[e : e + AFTER].lower()
        out.append(
            Candidate(
                kind, s, e, is_strict,
                _votes(kind, part, is_strict, before, after),
                _surroundings(kind, part, is_strict, before, after),
            )
        )
    return out


def _patterns(batches: Iterator[pa.RecordBatch]):
    counts: Counter[tuple] = Counter()
    for batch in batches:
        for text in batch.column(0):
            for c in candidates(text.as_py() or ""):
                counts[KINDS.index(c.kind), bytes(c.votes), bytes(c.around)] += 1
    keys = list(counts)
    yield pa.record_batch(
        [
            pa.array([k[0] for k in keys], pa.int32()),
            pa.array([k[1] for k in keys], pa.binary()),
            pa.array([k[2] for k in keys], pa.binary()),
            pa.array(list(counts.values()), pa.int64()),
        ],
        ["kind", "votes", "around", "n"],
    )


@dataclass(frozen=True)
class Model:
    """Per kind the share of true candidates, the labelers' votes given the truth (labeler,
    truth, vote), and the classifier's weights."""

    prior: np.ndarray
    reliability: np.ndarray
    weights: np.ndarray

    def score(self, c: Candidate, known: dict | None = None) -> float:
        """How likely ``c`` is true; ``known`` keeps the scores of patterns seen before."""
        pattern = (c.kind, c.votes, c.around)
        if known is None or pattern not in known:
            x = _features(np.array([c.votes]), np.array([c.around]))[0]
            p = float(1 / (1 + np.exp(-(x @ self.weights[KINDS.index(c.kind)]))))
            if known is None:
                return p
            known[pattern] = p
        return known[pattern]


def _features(votes: np.ndarray, around: np.ndarray) -> np.ndarray:
    """One-hot of every vote and class, and a constant."""
    parts = [np.eye(3)[votes[:, j]] for j in range(len(LABELERS))]
    parts += [np.eye(size)[around[:, j]] for j, size in enumerate(_SIZES)]
    return np.hstack([*parts, np.ones((len(votes), 1))])


def estimate(votes: np.ndarray, n: np.ndarray, rounds: int = 200) -> tuple[float, np.ndarray, np.ndarray]:
    """Expectation-maximisation over vote patterns that occur ``n`` times each.

    Returns the share of true candidates, P(vote | truth) of each labeler, and the
    probability of each pattern to be true. A labeler starts as rather right than wrong,
    which settles what "true" means; one vote of each sort is added to what was counted,
    so that no labeler is ever certain.
    """
    labelers = votes.shape[1]
    prior = 0.5
    table = np.empty((labelers, 2, 3))
    table[:, 1] = (0.15, 0.35, 0.5)
    table[:, 0] = (0.5, 0.35, 0.15)
    truth = np.full(len(n), 0.5)
    for _ in range(rounds):
        likelihood = np.log(np.array([1 - prior, prior]))[None, :].repeat(len(n), 0)
        for j in range(labelers):
            likelihood += np.log(table[j][:, votes[:, j]]).T
        with np.errstate(over="ignore"):
            after = 1 / (1 + np.exp(likelihood[:, 0] - likelihood[:, 1]))
        moved = np.abs(after - truth).max(initial=0)
        truth = after
        prior = float((truth @ n + 1) / (n.sum() + 2))
        for j in range(labelers):
            for v in range(3):
                of = n * (votes[:, j] == v)
                table[j, 1, v] = truth @ of + 1
                table[j, 0, v] = (1 - truth) @ of + 1
        table /= table.sum(axis=2, keepdims=True)
        if moved < 1e-6:
            break
    return prior, table, truth


def _fit(x: np.ndarray, truth: np.ndarray, n: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic regression on probabilities, by Newton's steps."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (n * (truth - p)) - ridge * w
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def train(docs: DataFrame, text: str = "text") -> Model:
    """Reliabilities and weights from all candidates of all texts.

    NULL and empty texts have none. A kind without candidates adds nothing: its classifier
    scores 0.5, which is not sure.
    """
    counted = docs.select(F.col(text).alias("text")).mapInArrow(
        _patterns, "kind int, votes binary, around binary, n long"
    )
    # At most 4 x 3^6 x 512 rows, however large the corpus.
    rows = counted.groupBy("kind", "votes", "around").agg(F.sum("n").alias("n")).collect()
    rows = sorted(rows, key=lambda r: (r.kind, bytes(r.votes), bytes(r.around)))
    width = _features(np.zeros((1, len(LABELERS)), int), np.zeros((1, len(_SIZES)), int)).shape[1]
    prior = np.full(len(KINDS), 0.5)
    tables = np.full((len(KINDS), len(LABELERS), 2, 3), 1 / 3)
    weights = np.zeros((len(KINDS), width))
    for k in range(len(KINDS)):
        own = [r for r in rows if r.kind == k]
        if not own:
            continue
        votes = np.array([list(r.votes) for r in own])
        around = np.array([list(r.around) for r in own])
        n = np.array([r.n for r in own], float)
        prior[k], tables[k], truth = estimate(votes, n)
        weights[k] = _fit(_features(votes, around), truth, n)
    return Model(prior, tables, weights)


def spans(
    text: str, model: Model, sure: float = SURE, known: dict | None = None
) -> list[tuple[str, int, int, bool, float]]:
    """(kind, start, end, base, score): base spans, and others the classifier is sure of.

    Added spans overlap no base span and no added one; of two that do, the surer stays,
    of equally sure ones the longer, then the earlier.
    """
    scored = [(c, model.score(c, known)) for c in candidates(text)]
    found = [(c.kind, c.start, c.end, True, p) for c, p in scored if c.strict]
    extra = [(c, p) for c, p in scored if not c.strict and p >= sure]
    extra.sort(key=lambda x: (-x[1], x[0].start - x[0].end, x[0].start, KINDS.index(x[0].kind)))
    kept: list[tuple[int, int]] = []
    for c, p in extra:
        at = bisect_left(kept, (c.end, 0))
        if at and kept[at - 1][1] > c.start:
            continue
        kept.insert(at, (c.start, c.end))
        found.append((c.kind, c.start, c.end, False, p))
    return sorted(found, key=lambda x: (KINDS.index(x[0]), x[1], x[2]))


def mask(text: str, found: list) -> str:
    """``text`` with every span replaced by its kind in brackets; what overlaps is one span."""
    out, at = [], 0
    for span in sorted(found, key=lambda s: (s[1], -s[2])):
        if span[1] >= at:
            out += [text[at : span[1]], f"[{span[0].upper()}]"]
        at = max(at, span[2])
    return "".join([*out, text[at:]])


_SPAN = "array<struct<kind:string,start:long,end:long,base:boolean,score:double>>"
_SPAN_ARROW = pa.list_(
    pa.struct(
        [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("score", pa.float64())]
    )
)


def _found(batches: Iterator[pa.RecordBatch], model: Model, sure: float, masked: bool):
    names = ("kind", "start", "end", "base", "score")
    known: dict = {}
    for batch in batches:
        rows, clean = [], []
        for text in batch.column(1):
            text = text.as_py()
            found = spans(text or "", model, sure, known)
            rows.append([dict(zip(names, span, strict=True)) for span in found])
            clean.append(mask(text, found) if masked and text is not None else None)
        columns = [batch.column(0), pa.array(rows, _SPAN_ARROW)]
        fields = ["doc", "found"]
        if masked:
            columns.append(pa.array(clean, pa.string()))
            fields.append("masked")
        yield pa.record_batch(columns, fields)


def find(
    docs: DataFrame,
    model: Model,
    doc_id: str = "doc_id",
    text: str = "text",
    sure: float = SURE,
    masked: bool = False,
) -> DataFrame:
    """``doc_id`` and ``found``, the spans of each text by kind and start; with ``masked``
    also the text without them.

    One row per row of ``docs``, repeated ones too, whatever the id. NULL and empty texts
    have no spans; a NULL text stays NULL when masked. Texts are read whole, in time in
    proportion to their length. Of ``docs`` no other column is read.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc {kind}, found {_SPAN}" + (", masked string" if masked else "")
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc"), F.col(f"`{text}`").alias("text"))
    out = rows.mapInArrow(partial(_found, model=model, sure=sure, masked=masked), schema)
    return out.withColumnRenamed("doc", doc_id)
