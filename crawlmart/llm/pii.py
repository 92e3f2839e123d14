"""Personal data: patterns, made consistent over a document by a skip-chain random field.

Patterns with checks find e-mail addresses, IP addresses, card and phone numbers. They are
evidence for a conditional random field over the tokens that have a digit or an @, where
groups of digits that are written apart make up one token if they end like a match:
neighbours share a chain potential, distant tokens that are equal or similar (the same last seven digits,
or the same text in lower case) a skip potential. Loopy message passing then labels the rest;
a token without a match of its own is reported where the field is sure of its label.

Unary weights are a softmax regression, potentials are counts, both trained on a bounded
sample of tokens of documents with matches. A document without a match has nothing that its
tokens could be consistent with, so nothing is added to it.

Defined results: null text is empty; equal rows get equal results; without anything to train
on only the patterns count; further columns pass through the redaction untouched.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlmart.llm.common import small_batches

KINDS = ("email", "ip", "card", "phone")
N = len(KINDS) + 1  # labels: 0 is none of them
SAMPLE_DOCS = 50_000  # documents that are looked at for training, about
SAMPLE_TOKENS = 20_000  # tokens that are trained on, at most
FEATURES = 1 << 12
STRIP = 1 << 14  # messages that are worked on together
PRIOR = 10.0  # pairs of labels that are expected before any is seen
ALIKE = 0.99  # share of like tokens that are expected to have one label
SURE = 0.9  # probability from which a token is reported

LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# No digit run before: a match never begins inside a run that failed from its start.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TOKEN = re.compile(r"[A-Za-z0-9._%+@-]+")
HINT = re.compile(r"[0-9@]")
RUN = re.compile(r"[0-9]+(?:[\x20.()-]{1,3}[0-9]+)+")
GROUP = re.compile(r"[0-9]+")
DOTTED = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")
LIKE, MOST = 7, 19  # last digits that similar numbers share; digits of a number at most

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    odd = sum(int(d) for d in digits[-1::-2])
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def base_spans(text: str) -> list[Span]:
    """Matches of the four patterns that pass their checks, by start, then kind."""
    out: list[Span] = []
    if not HINT.search(text):
        return out
    # The characters before an @ that can belong to an address end there, so each @ has one
    # earliest start; looking from the @ keeps long texts linear.
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and LOCAL.match(text[start - 1]):
            start -= 1
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            done = found.end()
            out.append((start, 0, done))
        at = text.find("@", max(at + 1, done))
    for m in IP.finditer(text):
        if all(_octet(p) for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = _digits(m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    out.sort()
    return out


# -- tokens of the field ---------------------------------------------------------------
@dataclass
class Field:
    """Tokens with a digit or an @ of one text; labels are -1 where nothing is known."""

    start: list[int]
    end: list[int]
    label: list[int]
    features: list[list[int]]
    chain: list[tuple[int, int]]  # neighbours
    skip: list[tuple[int, int]]  # equal or similar tokens, each with the one before


def _key(token: str) -> str | None:
    digits = _digits(token)
    if len(digits) >= LIKE and "@" not in token:
        return digits if DOTTED.fullmatch(token) else digits[-LIKE:]
    return token.lower() if len(token) >= 5 and "@" in token else None


def _features(token: str, before: str, word: str) -> list[int]:
    shape = re.sub("[A-Za-z]+", "a", token)
    shape = re.sub("[0-9]+", lambda m: f"9{min(len(m[0]), 20)}", shape)
    digits = _digits(token)
    names = [
        "bias", f"shape {shape[:24]}", f"digits {min(len(digits), 20)}", f"before {before}",
        f"word {word}", f"at {token.count('@')}", f"dots {min(token.count('.'), 5)}",
        f"luhn {len(digits) >= 12 and luhn(digits)}", f"plus {token[0] == '+'}",
    ]
    return [zlib.crc32(x.encode()) % FEATURES for x in names]


def runs_of(text: str, spans: list[Span]) -> list[tuple[int, int]]:
    """Runs of digit groups outside of the matches that end like a matched card or phone
    number. A run goes back over the groups that agree with the match, and over those that a
    hyphen, dot or bracket binds to the next."""
    known = {_digits(text[a:e]) for a, k, e in spans if KINDS[k] in ("card", "phone")}
    ends = {d[-n:] for d in known for n in range(LIKE, min(len(d), MOST) + 1)}
    out: list[tuple[int, int]] = []
    if not ends:
        return out
    begins, upto = [a for a, _, _ in spans], [0]
    for _, _, e in spans:
        upto.append(max(upto[-1], e))
    for m in RUN.finditer(text):
        groups = [(g.start(), g.end()) for g in GROUP.finditer(text, m.start(), m.end())]
        j, found = len(groups) - 1, []
        while j > 0:
            i, digits = j + 1, ""
            while i and len(digits) < MOST:
                i -= 1
                a, e = groups[i]
                digits = text[max(a, e - MOST) : e] + digits
            same = max((n for n in range(LIKE, MOST + 1) if digits[-n:] in ends), default=0)
            i, n = j, groups[j][1] - groups[j][0]
            while same and i:
                between = text[groups[i - 1][1] : groups[i][0]]
                size = groups[i - 1][1] - groups[i - 1][0]
                bound = (" " not in between or ")" in between) and n + size <= 15
                if n >= same and not bound:
                    break
                i, n = i - 1, n + size
            start, end = groups[i][0], groups[j][1]
            if start and text[start - 1] == "(" and ")" in text[start:end]:
                start -= 1
            if same and i < j and upto[bisect_right(begins, end - 1)] <= start:
                found.append((start, end))
                j = i
            j -= 1
        out += reversed(found)
    return out


def tokens_of(text: str, spans: list[Span]) -> Iterator[tuple[int, int, str]]:
    """Start, end and the word before of each token with a digit or an @. Where a matched card
    or phone number or a run has several tokens, it is one."""
    wholes = [(a, e) for a, k, e in spans if KINDS[k] in ("card", "phone")]
    wholes = sorted({*wholes, *runs_of(text, spans)})
    word, k, held = "", 0, []

    def release() -> Iterator[tuple[int, int, str]]:
        if len(held) > 1:
            yield (*wholes[k], held[0][2])
        else:
            yield from held
        held.clear()

    for m in TOKEN.finditer(text):
        token = m[0].strip(".-_%")
        if not HINT.search(token):
            word = token.lower() or word
            continue
        start = m.start() + m[0].index(token)
        end = start + len(token)
        while k < len(wholes) and wholes[k][1] <= start:
            yield from release()
            k += 1
        if k < len(wholes) and wholes[k][0] < end:
            held.append((start, end, word))
        else:
            yield start, end, word
    if k < len(wholes):
        yield from release()


def field_of(text: str, spans: list[Span]) -> Field:
    out, last, k = Field([], [], [], [], [], []), {}, 0
    for start, end, word in tokens_of(text, spans):
        token, i = text[start:end], len(out.start)
        while k < len(spans) and spans[k][2] <= start:
            k += 1
        hit = spans[k] if k < len(spans) and spans[k][0] < end else None
        out.start.append(start)
        out.end.append(end)
        out.label.append(1 + hit[1] if hit else -1)
        out.features.append(_features(token, text[start - 1] if start else "", word))
        if i and start - out.end[i - 1] <= 3 and not re.search("[A-Za-z]", text[out.end[i - 1] : start]):
            out.chain.append((i - 1, i))
        if key := _key(token):
            if key in last:
                out.skip.append((last[key], i))
            last[key] = i
    return out


# -- training --------------------------------------------------------------------------
@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # features x labels
    chain: np.ndarray  # labels x labels, log potentials
    skip: np.ndarray


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def _potential(pairs: np.ndarray, share: np.ndarray, alike: float) -> np.ndarray:
    """Log of how much more often two labels meet than by chance. Counts begin at what is
    expected before any is seen: PRIOR pairs, of which ``alike`` have one label twice and the
    others meet by chance, so that a kind that is never seen is not preferred."""
    chance = share[:, None] * share[None, :]
    counts = PRIOR * (alike * np.diag(share) + (1 - alike) * chance)
    np.add.at(counts, (pairs[:, 0], pairs[:, 1]), 0.5)
    np.add.at(counts, (pairs[:, 1], pairs[:, 0]), 0.5)
    return np.log(counts / counts.sum()) - np.log(chance)


def fit(labels: np.ndarray, features: np.ndarray, chain: np.ndarray, skip: np.ndarray) -> Model:
    """Softmax regression by adaptive gradients over the whole sample, and counted potentials.

    ``chain`` and ``skip`` hold the label of the token before on such an edge, or -1."""
    weights, squares = np.zeros((FEATURES, N)), np.full((FEATURES, N), 1e-8)
    wanted = np.eye(N)[labels]
    for _ in range(60):
        error = _softmax(weights[features].sum(axis=1)) - wanted
        step = 1e-4 * weights
        for column in features.T:
            np.add.at(step, column, error / len(labels))
        squares += step**2
        weights -= 0.5 * step / np.sqrt(squares)
    share = (np.bincount(labels, minlength=N) + 1.0) / (len(labels) + N)
    both = [np.stack((x[x >= 0], labels[x >= 0]), axis=1) for x in (chain, skip)]
    return Model(weights, _potential(both[0], share, 0.0), _potential(both[1], share, ALIKE))


def learnt(field: Field) -> list[int]:
    """Labels to learn from. A token without a match that is like a matched one is what the
    field is to find: its label is hidden (-1), not none."""
    first = list(range(len(field.label)))  # of the tokens that are like each other
    for i, j in field.skip:
        first[j] = first[i]
    matched = {first[i] for i, x in enumerate(field.label) if x > 0}
    return [-1 if x < 0 and first[i] in matched else max(x, 0) for i, x in enumerate(field.label)]


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_tokens: int = SAMPLE_TOKENS) -> Model | None:
    """A model from tokens of about ``sample_docs`` documents, chosen by a hash of the text;
    at most ``sample_tokens`` rows come to the driver."""
    docs = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    docs = docs.withColumn("h", F.xxhash64("text"))
    part = max(1, docs.count() // sample_docs)
    chosen = docs.filter(F.pmod("h", F.lit(part)) == 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            for h, text in zip(batch.column("h"), batch.column("text"), strict=True):
                text = text.as_py()
                spans = base_spans(text)
                if not spans:
                    continue
                f = field_of(text, spans)
                label = learnt(f)
                chain, skip = [-1] * len(label), [-1] * len(label)
                for edges, to in ((f.chain, chain), (f.skip, skip)):
                    for i, j in edges:
                        to[j] = label[i]
                for i, x in enumerate(label):
                    if x < 0:
                        continue
                    mixed = zlib.crc32(f"{h.as_py()} {i}".encode())
                    for column, value in zip(
                        rows, (mixed, x, f.features[i], chain[i], skip[i]), strict=True
                    ):
                        column.append(value)
            kinds = [pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.int32(), pa.int32()]
            arrays = [pa.array(x, k) for x, k in zip(rows, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["h", "label", "features", "chain", "skip"])

    schema = "h long, label int, features array<int>, chain int, skip int"
    rows = chosen.select("h", "text").mapInArrow(run, schema)
    got = rows.orderBy("h", "label", "features", "chain", "skip").limit(sample_tokens).toArrow()
    if not got.num_rows:
        return None
    label, chain, skip = (got[x].to_numpy().astype(np.int64) for x in ("label", "chain", "skip"))
    features = np.array(got["features"].to_pylist(), np.int64)
    return fit(label, features, chain, skip)


# -- inference -------------------------------------------------------------------------
def marginals(field: Field, model: Model, rounds: int = 20, damping: float = 0.5) -> np.ndarray:
    """Label probabilities by loopy sum-product message passing; matched tokens are fixed."""
    n = len(field.start)
    unary = model.weights[np.array(field.features)].sum(axis=1)
    unary -= np.logaddexp.reduce(unary, axis=1, keepdims=True)
    label = np.array(field.label)
    known = label >= 0
    unary[known] = -30.0
    unary[known, label[known]] = 0.0
    edges = np.array(field.chain + field.skip, np.int64).reshape(-1, 2)
    if len(edges):
        n_chain, n_edges = len(field.chain), len(edges)
        source = np.concatenate((edges[:, 0], edges[:, 1]))
        target = np.concatenate((edges[:, 1], edges[:, 0]))
        back = np.concatenate((np.arange(n_edges) + n_edges, np.arange(n_edges)))
        # Stretches of messages that pass one potential, worked on in strips.
        ends = (0, n_chain, n_edges, n_edges + n_chain, 2 * n_edges)
        passed = (model.chain, model.skip, model.chain.T, model.skip.T)
        strips = [
            (slice(low, min(low + STRIP, end)), by)
            for first, end, by in zip(ends, ends[1:], passed, strict=False)
            for low in range(first, end, STRIP)
        ]
        sent = np.zeros((2 * n_edges, N))
        for _ in range(rounds):
            belief = unary.copy()
            np.add.at(belief, target, sent)
            change = 0.0
            new = np.empty_like(sent)
            for at, by in strips:
                away = belief[source[at]] - sent[back[at]]
                part = np.logaddexp.reduce(away[:, :, None] + by, axis=1)
                part -= np.logaddexp.reduce(part, axis=1, keepdims=True)
                change = max(change, float(np.abs(part - sent[at]).max()))
                new[at] = damping * sent[at] + (1 - damping) * part
            sent = new
            if change < 1e-3:
                break
        np.add.at(unary, target, sent)
    return _softmax(unary).reshape(n, N)


def spans_of(text: str, model: Model | None) -> tuple[list[Span], list[Span]]:
    """(matches, matches and what the field adds), each by start, then kind."""
    base = base_spans(text)
    if not base or model is None:
        return base, base
    field = field_of(text, base)
    if -1 not in field.label or not field.skip:
        return base, base
    sure = marginals(field, model)
    linked = {i for edge in field.skip for i in edge}
    added = [
        (field.start[i], int(p.argmax()) - 1, field.end[i])
        for i, p in enumerate(sure)
        if field.label[i] < 0 and i in linked and p.argmax() and p.max() >= SURE
    ]
    return base, sorted(base + added)


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, the number of matches of each kind, and base and spans as kind:start:end."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[] for _ in KINDS]
            base, spans = [], []
            for text in batch.column("text"):
                found, every = spans_of(text.as_py() or "", shared.value)
                for k, column in enumerate(counts):
                    column.append(sum(s[1] == k for s in found))
                base.append(written(found))
                spans.append(written(every))
            columns = [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in counts)]
            columns += [pa.array(base, pa.string()), pa.array(spans, pa.string())]
            names = ["doc_id", *(f"n_{k}" for k in KINDS), "base", "spans"]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"doc_id {kind}, " + "".join(f"n_{k} long, " for k in KINDS) + "base string, spans string"
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span, or run of overlapping spans, as [KIND] of the first."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with personal data replaced; n_chars, if there, follows a changed text."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    at, size = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            columns = list(batch.columns)
            sizes = columns[size].to_pylist() if size is not None else []
            for i, text in enumerate(texts):
                if text and (spans := spans_of(text, shared.value)[1]):
                    texts[i] = redacted(text, spans)
                    if sizes:
                        sizes[i] = len(texts[i])
            columns[at] = pa.array(texts, columns[at].type)
            if sizes:
                columns[size] = pa.array(sizes, columns[size].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, docs.schema)
