"""Personal data by patterns and a skip-chain conditional random field.

The patterns give the base spans, which always stay. The field adds spans that the
patterns miss. Its nodes are the white-space separated tokens that hold a digit or an
at sign; the labels are the four kinds and ``other``. Potentials: features of the token
and its neighbours; a transition between tokens that stand side by side; and skip edges
that reward equal labels, from each token to the next equal one and to the next one that
is alike (same last seven digits, or same part before the at sign) wherever in the
document it stands. Tokens under a base span are observed. Loopy belief propagation
passes messages over all edges, so what a token is in one place carries over to its
other places. Edges are linear in the tokens: occurrences are linked in a chain.

The weights are fitted by pseudo-likelihood to the labels that the patterns give, on at
most ``sample_docs`` documents (those of the smallest hashes that hold a digit or an at
sign) and the first ``sample_tokens`` tokens of each. Every document is searched whole.

Cases: a NULL or empty text has no spans; a NULL doc_id is kept; repeated rows each get
their own result; a table without any such token gives a model that adds nothing;
further columns are not read. A document is the work of one task, in linear time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bibspark.llm.rows import Sink, batches, texts

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
OTHER = len(KINDS)  # the label of a token that is no personal data
LABELS = len(KINDS) + 1
THRESHOLD = 0.8
ROUNDS = 20
SAMPLE_DOCS, SAMPLE_TOKENS = 4000, 512

# The patterns of the kinds. Look-behinds and the search from the at sign
# change no match; they keep the time linear in the text.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@][^ \t-\r]*")
_MOST_DIGITS = {CARD: 19, PHONE: 15}
_SPACE = frozenset(" \t\n\x0b\x0c\r")
_DIGITS = re.compile(r"[0-9]+")


def _digits(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def luhn(digits: str) -> bool:
    """Whether a row of digits ends in the right check digit."""
    doubled = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)
    values = [ord(c) - 48 for c in reversed(digits)]
    return (sum(values[::2]) + sum(doubled[v] for v in values[1::2])) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        done = domain.end() if domain else at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what the patterns find, by start and kind."""
    found = [(a, EMAIL, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
            found.append((m.start(), IP, m.end()))
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), CARD, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m.group())) <= 15:
            found.append((m.start(), PHONE, m.end()))
    return sorted(found)


# ---- the tokens of a document ----

_STEPS = (1, 3, 4, 5, 7, 8, 10, 11, 12, 16, 17, 20)  # lower ends of the classes of digit counts
_N_FEATURES = 45


def _around(text: str, place: int, step: int) -> int:
    """What stands next to a token: 0 an end of line or text, 1 a word, 2 digits, 3 a sign."""
    end = len(text) if step > 0 else -1
    while place != end and text[place] in " \t":
        place += step
    if place == end or text[place] in _SPACE:
        return 0
    c = text[place]
    return 2 if "0" <= c <= "9" else 1 if c.isalpha() else 3


def _features(text: str, start: int, end: int) -> int:
    """The features of a token as bits."""
    core = text[start:end].strip(".,;:!?|()[]{}<>\"'=")
    digits = _digits(core)
    letters = sum(map(str.isalpha, core))
    parts = core.split(".")
    left, mark, right = core.partition("@")
    quad = len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    bits = [0, 1 + sum(len(digits) >= s for s in _STEPS), 14 + min(letters, 3), 18 + min(len(parts) - 1, 4),
            23 + min(core.count("-"), 3), 27 + _around(text, start - 1, -1), 31 + _around(text, end, 1)]
    bits += [bit for bit, on in (
        (35, mark and left and "." in right), (36, mark), (37, quad), (38, core.startswith("+")),
        (39, "(" in text[start:end]), (40, 12 <= len(digits) <= 19 and luhn(digits)),
        (41, len(digits) == len(core) > 0), (42, digits and letters > 0), (43, text[start] == "("),
        (44, ":" in core or "/" in core or "=" in core),
    ) if on]
    return sum(1 << bit for bit in bits)


@dataclass
class Tokens:
    """The tokens of one document that hold a digit or an at sign."""

    spans: list[tuple[int, int]]
    features: list[int]
    labels: list[int]  # the kind of the base span over the token, OTHER without one
    beside: list[bool]  # whether it stands right after the token before
    equal: list[int]  # the next equal token, -1 without one
    alike: list[int]  # the next one that is alike but not equal, -1 without one


def _spans(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for m in _MARK.finditer(text):
        start = m.start()
        while start > done and text[start - 1] not in _SPACE:
            start -= 1
        done = m.end()
        yield start, done


def tokens_of(text: str, base: list[tuple[int, int, int]], most: int | None = None) -> Tokens:
    spans = []
    for span in _spans(text):
        spans.append(span)
        if most and len(spans) == most:
            break
    found = Tokens(spans, [], [], [], [-1] * len(spans), [-1] * len(spans))
    last_equal: dict[str, int] = {}
    last_alike: dict[str, tuple[int, str]] = {}
    before, k, ends = 0, 0, 0
    for i, (start, end) in enumerate(spans):
        found.features.append(_features(text, start, end))
        gap = text[before:start] if start - before <= 2 else "\n"
        found.beside.append(i > 0 and gap.strip(" \t") == "")
        before = end
        # base spans come by start; of those over the token the first counts
        while k < len(base) and base[k][2] <= start:
            k += 1
        over = next((b for b in base[k : k + len(KINDS) + 1] if b[0] < end and b[2] > start), None)
        found.labels.append(over[1] if over else OTHER)
        core = text[start:end].strip(".,;:!?|()[]{}<>\"'").lower()
        digits = _digits(core)
        left, mark, _ = core.partition("@")
        key = f"@{left}" if mark and left else f"#{digits[-7:]}" if len(digits) >= 7 else ""
        if core in last_equal:
            found.equal[last_equal[core]] = i
        last_equal[core] = i
        if key:
            other, same = last_alike.get(key, (-1, core))
            if other >= 0 and same != core:
                found.alike[other] = i
            last_alike[key] = (i, core)
    return found


# ---- the field ----


@dataclass
class Model:
    unary: np.ndarray  # features x labels
    chain: np.ndarray  # label before x label
    equal: float
    alike: float

    @property
    def skip(self) -> tuple[np.ndarray, np.ndarray]:
        return self.equal * np.eye(LABELS), self.alike * np.eye(LABELS)


def _bits(features: np.ndarray) -> np.ndarray:
    return ((features[:, None] >> np.arange(_N_FEATURES)) & 1).astype(np.float64)


def _edges(next_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    left = np.flatnonzero(next_of >= 0)
    return left, next_of[left]


def fit(features: np.ndarray, labels: np.ndarray, beside: np.ndarray, equal: np.ndarray, alike: np.ndarray,
        steps: int = 300, rate: float = 0.1, decay: float = 1e-3) -> Model:
    """Weights by pseudo-likelihood: each token given its features and its neighbours' labels."""
    n = len(labels)
    model = Model(np.zeros((_N_FEATURES, LABELS)), np.zeros((LABELS, LABELS)), 1.0, 1.0)
    if n == 0:
        return model
    x, one = _bits(features), np.eye(LABELS)[labels]
    right = np.flatnonzero(beside)
    counts = []
    for next_of in (equal, alike):
        a, b = _edges(next_of)
        seen = np.zeros((n, LABELS))
        np.add.at(seen, a, one[b])
        np.add.at(seen, b, one[a])
        counts.append(seen)
    weights = [model.unary, model.chain, np.ones(1), np.ones(1)]
    prior = [0.0, 0.0, 1.0, 1.0]  # equal labels are expected where the sample has too few skip edges to tell
    mean, spread = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        unary, chain, same, near = weights
        energy = x @ unary + same * counts[0] + near * counts[1]
        energy[right] += chain[labels[right - 1]]
        energy[right - 1] += chain[:, labels[right]].T
        energy -= energy.max(1, keepdims=True)
        p = np.exp(energy)
        wrong = one - p / p.sum(1, keepdims=True)
        turn = np.zeros((LABELS, LABELS))
        np.add.at(turn, labels[right - 1], wrong[right])
        np.add.at(turn.T, labels[right], wrong[right - 1])
        slopes = [x.T @ wrong, turn, np.array([(wrong * counts[0]).sum()]), np.array([(wrong * counts[1]).sum()])]
        for k, slope in enumerate(slopes):
            slope = slope / n - decay * (weights[k] - prior[k])
            mean[k] = 0.9 * mean[k] + 0.1 * slope
            spread[k] = 0.999 * spread[k] + 0.001 * slope**2
            weights[k] = weights[k] + rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(spread[k] / (1 - 0.999**step)) + 1e-8)
    # a skip edge can only ask for equal labels
    return Model(weights[0], weights[1], max(0.0, float(weights[2][0])), max(0.0, float(weights[3][0])))


def marginals(model: Model, features: np.ndarray, labels: np.ndarray, beside: np.ndarray, equal: np.ndarray,
              alike: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Label probabilities by loopy message passing; tokens with a base label are observed."""
    n = len(features)
    own = _bits(features) @ model.unary
    known = np.flatnonzero(labels != OTHER)
    own[known] = -1e6
    own[known, labels[known]] = 0.0
    right = np.flatnonzero(beside)
    kinds = [(right - 1, right, model.chain)]
    kinds += [(*_edges(np.asarray(e)), s) for e, s in zip((equal, alike), model.skip, strict=True)]
    a = np.concatenate([k[0] for k in kinds])
    b = np.concatenate([k[1] for k in kinds])
    bond = np.concatenate([np.broadcast_to(k[2], (len(k[0]), LABELS, LABELS)) for k in kinds])
    tail, head = np.concatenate([a, b]), np.concatenate([b, a])
    bond = np.concatenate([bond, bond.transpose(0, 2, 1)])
    back = np.concatenate([np.arange(len(a)) + len(a), np.arange(len(a))])
    sent = np.zeros((len(tail), LABELS))
    belief = own.copy()
    for _ in range(rounds if len(tail) else 0):
        said = belief[tail] - sent[back]
        new = np.logaddexp.reduce(said[:, :, None] + bond, axis=1)
        new -= np.logaddexp.reduce(new, axis=1, keepdims=True)
        moved = np.abs(new - sent).max()
        sent = 0.5 * sent + 0.5 * new
        belief = own.copy()
        np.add.at(belief, head, sent)
        if moved < 1e-6:
            break
    belief -= belief.max(1, keepdims=True)
    p = np.exp(belief)
    return p / p.sum(1, keepdims=True)


def added_spans(text: str, tokens: Tokens, p: np.ndarray, base: list[tuple[int, int, int]],
                threshold: float) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the tokens outside base spans that are sure; neighbours that
    make up one number of a kind are one span."""
    found: list[list[int]] = []
    last = -2
    for i, (start, end) in enumerate(tokens.spans):
        kind = int(p[i, :OTHER].argmax())
        if tokens.labels[i] != OTHER or p[i, kind] < threshold:
            continue
        joins = found and last == i - 1 and tokens.beside[i] and found[-1][1] == kind and kind in _MOST_DIGITS
        if joins and len(_digits(text[found[-1][0] : end])) <= _MOST_DIGITS[kind]:
            found[-1][2] = end
        else:
            found.append([start, kind, end])
        last = i
    spans = []
    for start, kind, end in found:
        while start < end and not (text[start].isalnum() or text[start] in "+("):
            start += 1
        while end > start and not (text[end - 1].isalnum() or text[end - 1] == ")"):
            end -= 1
        if start < end:
            spans.append((start, kind, end))
    return spans


# ---- on Spark ----

_SAMPLE = pa.schema([("doc", pa.int64()), ("place", pa.int64()), ("features", pa.int64()), ("label", pa.int64()),
                     ("beside", pa.int64()), ("equal", pa.int64()), ("alike", pa.int64())])
_FOUND = pa.schema([("doc_id", pa.int64()), ("kind", pa.list_(pa.string())), ("start", pa.list_(pa.int64())),
                    ("end", pa.list_(pa.int64())), ("base", pa.list_(pa.bool_()))])


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_tokens: int = SAMPLE_TOKENS) -> Model:
    """A model of a bounded sample; at most ``sample_docs`` times ``sample_tokens`` numbers reach the driver."""
    rank = F.xxhash64("doc_id", "text")
    marked = docs.select("doc_id", "text").filter(F.col("text").rlike("[0-9@]")).withColumn("doc", rank)
    first = marked.select("doc").distinct().orderBy("doc").limit(sample_docs)
    last = first.agg(F.max("doc").alias("last")).first()["last"]
    if last is None:
        empty = np.zeros(0, np.int64)
        return fit(empty, empty, empty, empty, empty)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            rows = []
            for doc, text in zip(batch.column("doc").to_pylist(), texts(batch).to_pylist(), strict=True):
                t = tokens_of(text, base_spans(text), sample_tokens)
                rows += [(doc, i, f, y, int(n), e, s) for i, (f, y, n, e, s) in enumerate(
                    zip(t.features, t.labels, t.beside, t.equal, t.alike, strict=True))]
            if rows:
                yield batches(dict(zip(_SAMPLE.names, zip(*rows, strict=True), strict=True)), _SAMPLE)

    ddl = ", ".join(f"{f.name} bigint" for f in _SAMPLE)
    chosen = marked.filter(F.col("doc") <= last).select("doc", "text").mapInArrow(run, ddl)
    # repeated rows give the same tokens again
    rows = chosen.dropDuplicates(["doc", "place"]).toArrow()
    table = np.stack([rows.column(f.name).to_numpy() for f in _SAMPLE], 1)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    at = np.arange(len(table)) - table[:, 1]  # the row of the document's first token
    linked = [np.where(table[:, k] >= 0, at + table[:, k], -1) for k in (5, 6)]
    return fit(table[:, 2], table[:, 3], table[:, 4], *linked)


def pii_spans(docs: DataFrame, threshold: float = THRESHOLD, rounds: int = ROUNDS, model: Model | None = None) -> DataFrame:
    """doc_id and ``spans``: (kind, start, end, base) in code points by start, then kind; end is exclusive."""
    model = model or train(docs)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Sink(_FOUND)
        for batch in parts:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch).to_pylist(), strict=True):
                base = base_spans(text)
                spans = [(*s, True) for s in base]
                t = tokens_of(text, base)
                if t.spans:
                    p = marginals(model, *(np.array(v, np.int64) for v in (
                        t.features, t.labels, t.beside, t.equal, t.alike)), rounds)
                    spans += [(*s, False) for s in added_spans(text, t, p, base, threshold)]
                    spans.sort()
                out.add(doc_id, [KINDS[s[1]] for s in spans], [s[0] for s in spans], [s[2] for s in spans],
                        [s[3] for s in spans])
                yield from out.full()
        yield from out.rest()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, kind array<string>, start array<bigint>, `end` array<bigint>, base array<boolean>"
    )
    return rows.select("doc_id", F.arrays_zip("kind", "start", "end", "base").alias("spans"))


def span_digests(found: DataFrame) -> DataFrame:
    """The spans of ``pii_spans`` as counts and texts."""
    base = F.filter("spans", lambda s: s["base"])

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[count(k) for k in KINDS], F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
