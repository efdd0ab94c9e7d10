r"""Personal data: exact base patterns, and further spans by weak supervision.

Base spans are the leftmost non-overlapping matches of the contract's patterns, by kind. Looser patterns propose more
spans: written-out e-mail addresses, phone numbers without a plus, cards with other separators, IPv6 addresses, and secrets.
On each proposed or base span labelers vote yes, no or nothing: the strict pattern, a checksum, gazetteers (endings of domains, prefixes of cards and keys), words before the
span, and its edges. Over the counts of all vote patterns of the corpus, expectation-maximisation estimates how often each labeler says what of true and of false
spans (Dawid and Skene's model, by kind). Its posteriors train the final classifier, logistic regression on the kind, the shape and the context of a span and on its checksum and gazetteers.
Proposed spans that it accepts and that overlap no base span are added; base spans always stay.

Defined results: null and empty texts have no spans, and the digest of the empty string; repeated rows give equal results; an empty table gives no rows, and no
votes give a classifier that adds nothing; other columns are not read. Of spans proposed at one place the kind listed first counts. Matching is linear in the text, also for long runs of digits or signs.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .workspace import Workspace, ship

KINDS = ("email", "ip", "card", "phone", "secret")
BASE_KINDS = KINDS[:4]
#: Groups of equal votes, shape and context that the classifier is fitted on, the most frequent first.
FIT_GROUPS = 5000
FEATURES = 1 << 12
ACCEPT = 0.5

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a lookbehind keeps long digit runs linear: a match never begins inside of one
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]")
_AT = re.compile(r"\(at\)|\[at\]| at ", re.I)
_DIGIT = re.compile(r"[0-9]")

# Looser patterns by kind.
LOOSE = (
    ("email", re.compile(r"\b[A-Za-z0-9_%+-]{1,64} ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]{1,63}(?: ?(?:\(dot\)|\[dot\]| dot |\.) ?[A-Za-z0-9-]{1,63}){1,5}\b", re.I)),
    ("ip", re.compile(r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Fa-f:])")),
    ("card", re.compile(r"(?<![0-9A-Za-z])[0-9]{4}([./_])[0-9]{4}\1[0-9]{4}\1[0-9]{2,4}(?![0-9A-Za-z])")),
    ("phone", re.compile(r"(?<![0-9A-Za-z+.])(?:\([0-9]{3}\) ?|[0-9]{3}[-.\x20])[0-9]{3}[-.\x20][0-9]{4}(?![0-9A-Za-z])")),
    ("secret", re.compile(r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])")),
    ("secret", re.compile(r"(?<![A-Za-z0-9])gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])")),
    ("secret", re.compile(r"(?<=[=:\"'\x20])[0-9a-fA-F]{18,64}(?![0-9A-Za-z])")),
)
# Gazetteers and context words by kind.
DOMAIN_ENDINGS = frozenset("com org net edu gov info io de fr es uk eu it nl".split())
CARD_PREFIXES = ("34", "37", "4", "51", "52", "53", "54", "55", "6011", "65")
KEY_PREFIXES = ("AKIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_")
CONTEXT = {
    "email": frozenset("email mail e contact write reach".split()),
    "ip": frozenset("ip address host server from client".split()),
    "card": frozenset("card visa mastercard amex credit debit payment".split()),
    "phone": frozenset("phone tel telephone call mobile fax cell".split()),
    "secret": frozenset("password passwd pwd token secret key apikey api_key".split()),
}
AGAINST = frozenset("version isbn issn order invoice page chapter commit sha md5 checksum release no".split())


class Span(NamedTuple):
    start: int
    rank: int
    end: int

    def named(self) -> str:
        return f"{KINDS[self.rank]}:{self.start}:{self.end}"


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """All base spans by start and kind."""
    if not text or not _ANY.search(text):
        return []
    found, last = [], 0
    if "@" in text:
        for m in _DOMAIN.finditer(text):
            begin = m.start()
            while begin > last and text[begin - 1] in _LOCAL:
                begin -= 1
            if begin < m.start():
                found.append(Span(begin, 0, m.end()))
                last = m.end()
    for m in _IP.finditer(text):
        if all(len(p) < 4 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m[0].split("."))):
            found.append(Span(m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            found.append(Span(m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m[0])) <= 15:
                found.append(Span(m.start(), 3, m.end()))
    return sorted(found)


def proposed_spans(text: str, base: Sequence[Span]) -> list[Span]:
    """Spans of the looser patterns that overlap neither a base span nor an earlier proposed one."""
    if not text:
        return []
    # conditions that every match implies; secrets need none of these signs
    live = {"email": _AT.search(text), "ip": text.count(":") >= 7, "card": (digit := _DIGIT.search(text)), "phone": digit, "secret": True}
    candidates = sorted(Span(m.start(), KINDS.index(kind), m.end()) for kind, pattern in LOOSE if live[kind] for m in pattern.finditer(text))
    out, taken, last = [], iter([*base, Span(1 << 60, 0, 1 << 60)]), 0
    block, reach = next(taken), 0
    for s in candidates:
        while block.start < s.end:
            reach = max(reach, block.end)
            block = next(taken)
        if s.start >= reach and s.start >= last:
            out.append(s)
            last = s.end
    return out


def _words_before(text: str, start: int) -> list[str]:
    return re.findall(r"[a-z_]+", text[max(0, start - 40) : start].lower())[-3:]


def votes(text: str, span: Span, strict: bool) -> tuple[int, ...]:
    """Of the labelers, in order: strict pattern, checksum, gazetteer, context, edges; 1 yes, -1 no, 0 nothing."""
    kind, body = KINDS[span.rank], text[span.start : span.end]
    digits = _digits(body)
    shape = 1 if strict else 0
    if kind == "card":
        check, known = 1 if luhn(digits) else -1, 1 if digits.startswith(CARD_PREFIXES) else -1
    elif kind == "phone":
        check, known = 1 if 10 <= len(digits) <= 15 else -1, 1 if digits[-10:-7] not in ("000", "") else -1
    elif kind == "email":
        ending = re.split(r"[^A-Za-z0-9-]+", body)[-1].lower()
        check, known = 1 if not ending.isdigit() else -1, 1 if ending in DOMAIN_ENDINGS else -1
    elif kind == "ip":
        check, known = 1, -1 if body.startswith(("0.", "255.")) else 0
    else:
        check, known = 1 if len(set(body)) >= 8 else -1, 1 if body.startswith(KEY_PREFIXES) else 0
    before = _words_before(text, span.start)
    context = 1 if CONTEXT[kind] & set(before) else -1 if AGAINST & set(before) else 0
    left, right = text[max(0, span.start - 1) : span.start], text[span.end : span.end + 1]
    edges = -1 if left.isalnum() or right.isalnum() else 1
    return shape, check, known, context, edges


def shape_of(text: str, span: Span) -> str:
    """The whole span with runs of digits, small and capital letters as one sign and their length, from 9 on as 9."""
    return re.sub(r"[0-9]+|[a-z]+|[A-Z]+", lambda m: ("d" if m[0].isdigit() else "a" if m[0].islower() else "A") + str(min(len(m[0]), 9)), text[span.start : span.end])


def feature_ids(kind: str, shape: str, context: str, check: int, known: int) -> list[int]:
    """Of the kind, the shape and its distinct parts, the word before, and what the checksum and the gazetteer say."""
    parts = dict.fromkeys(shape[i : i + 4] for i in range(0, len(shape) - 3, 2))
    names = [kind, f"{kind}|{shape}", f"{kind}|c|{context}", f"{kind}|s|{check}", f"{kind}|g|{known}", f"{kind}|sg|{check}|{known}", *(f"{kind}|{x}" for x in parts)]
    return [zlib.crc32(n.encode("utf-8", "surrogatepass")) % FEATURES for n in names]


def _context_key(text: str, span: Span) -> str:
    own = CONTEXT[KINDS[span.rank]]
    before = _words_before(text, span.start)
    return next((w for w in reversed(before) if w in own or w in AGAINST), "")


def estimate(patterns: Counter[tuple[str, tuple[int, ...]]], rounds: int = 40) -> dict[tuple[str, tuple[int, ...]], float]:
    """Posterior of a true span by kind and votes, by expectation-maximisation over the counts; begins with the majority of the votes."""
    out: dict[tuple[str, tuple[int, ...]], float] = {}
    for kind in sorted({k for k, _ in patterns}):
        keys = sorted(v for k, v in patterns if k == kind)
        weight = np.array([patterns[kind, v] for v in keys], float)
        said = np.array(keys) + 1
        post = np.clip(0.5 + 0.15 * (said - 1).sum(1), 0.05, 0.95)
        for _ in range(rounds):
            prior = (weight @ post + 1) / (weight.sum() + 2)
            log_odds = np.full(len(keys), np.log(prior / (1 - prior)))
            for j in range(said.shape[1]):
                true = np.bincount(said[:, j], weight * post, 3) + np.array([0.5, 1.0, 2.0])
                false = np.bincount(said[:, j], weight * (1 - post), 3) + np.array([2.0, 1.0, 0.5])
                log_odds += np.log(true / true.sum())[said[:, j]] - np.log(false / false.sum())[said[:, j]]
            post = 1 / (1 + np.exp(-np.clip(log_odds, -30, 30)))
        out.update({(kind, v): float(p) for v, p in zip(keys, post, strict=True)})
    return out


@dataclass
class SpanModel:
    weights: np.ndarray
    bias: float = -2.0

    def probability(self, kind: str, shape: str, context: str, check: int, known: int) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.bias + self.weights[feature_ids(kind, shape, context, check, known)].sum(), -30, 30))))

    def accepts(self, text: str, span: Span) -> bool:
        said = votes(text, span, False)
        return self.probability(KINDS[span.rank], shape_of(text, span), _context_key(text, span), said[1], said[2]) >= ACCEPT


def train(groups: Sequence[tuple[str, tuple[int, ...], str, str, int]], posterior: dict[tuple[str, tuple[int, ...]], float], epochs: int = 30) -> SpanModel:
    """Logistic regression on posteriors; a group (kind, votes, shape, context, count) weighs by the logarithm of its count."""
    model = SpanModel(np.zeros(FEATURES))
    rng = np.random.default_rng(4)
    data = [(feature_ids(k, s, c, v[1], v[2]), posterior[k, v], min(np.log1p(n), 5.0)) for k, v, s, c, n in sorted(groups)]
    for epoch in range(epochs):
        for i in rng.permutation(len(data)):
            ids, y, weight = data[i]
            p = 1 / (1 + np.exp(-np.clip(model.bias + model.weights[ids].sum(), -30, 30)))
            g = 0.1 / (1 + 0.1 * epoch) * weight * (p - y)
            model.weights[ids] -= g
            model.bias -= 0.1 * g
    return model


def fit(docs: DataFrame) -> SpanModel:
    """Count votes over all documents, then estimate and train on the driver."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: Counter[tuple[str, str, str, str]] = Counter()
            for t in tk.text_list(b.column(0)):
                base = base_spans(t)
                for s, strict in [*((s, True) for s in base), *((s, False) for s in proposed_spans(t, base))]:
                    seen[KINDS[s.rank], ",".join(map(str, votes(t, s, strict))), shape_of(t, s), _context_key(t, s)] += 1
            if seen:
                yield pa.RecordBatch.from_arrays([*(pa.array(list(c)) for c in zip(*seen, strict=True)), pa.array(list(seen.values()))], ["kind", "votes", "shape", "context", "n"])

    groups = docs.select("text").mapInArrow(run, "kind string, votes string, shape string, context string, n bigint").groupBy("kind", "votes", "shape", "context").agg(F.sum("n").alias("n"))
    groups = Workspace(docs.sparkSession, "pii").save(groups, "groups")
    numbers = lambda v: tuple(map(int, v.split(",")))
    patterns = Counter({(r["kind"], numbers(r["votes"])): r["n"] for r in groups.groupBy("kind", "votes").agg(F.sum("n").alias("n")).collect()})  # at most 5 * 3 ** 5 rows
    if not patterns:
        return SpanModel(np.zeros(FEATURES))
    top = groups.orderBy(F.desc("n"), "kind", "votes", "shape", "context").limit(FIT_GROUPS).collect()
    return train([(r["kind"], numbers(r["votes"]), r["shape"], r["context"], r["n"]) for r in top], estimate(patterns))


def all_spans(text: str, model: SpanModel) -> tuple[list[Span], list[Span]]:
    """Base spans, and these with the accepted ones, by start and kind."""
    base = base_spans(text)
    more = [s for s in proposed_spans(text, base) if model.accepts(text, s)]
    return base, sorted([*base, *more])


def find_pii(docs: DataFrame, model: SpanModel) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every row; the numbers and the digest are of base spans."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, digests, texts = [], [], []
            for t in tk.text_list(b.column(1)):
                base, spans = all_spans(t, model)
                own = Counter(s.rank for s in base)
                counts.append([own[k] for k in range(4)])
                digests.append(hashlib.sha256(",".join(s.named() for s in base).encode()).hexdigest())
                texts.append(",".join(s.named() for s in spans))
            numbers = np.array(counts, np.int64).reshape(-1, 4).T
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, numbers), pa.array(digests, pa.string()), pa.array(texts, pa.string())], ["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans"])

    return docs.selectExpr("cast(doc_id as bigint) as doc_id", "text").mapInArrow(run, "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string")


def redact(text: str, model: SpanModel) -> str:
    """The text with every span replaced by its kind in brackets; of overlapping spans the first counts."""
    out, at = [], 0
    for s in all_spans(text, model)[1]:
        if s.start >= at:
            out += [text[at : s.start], f"[{KINDS[s.rank]}]"]
            at = s.end
    return "".join([*out, text[at:]])
