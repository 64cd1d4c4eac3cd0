"""Personal data by weak supervision.

``base_spans`` are the spans of four fixed patterns; they always stay. ``candidates`` are these spans
and looser ones: numbers that fail a check, phone numbers without a plus, addresses in eight groups,
written-out mail addresses. Four labelers vote on each candidate (yes, no or nothing): its pattern, a
gazetteer of known values, the words around it, and its shape. Votes are counted over all documents;
there are at most 4 x 81 different ones, and expectation-maximisation on these counts estimates how
reliable each labeler is for each kind. The resulting probabilities are the soft labels of a span
classifier, a logistic regression whose gradients and Hessians partitions sum up. Candidates that it
gives at least ``ACCEPT``, and for which the gazetteer or the context speaks, are added unless they
overlap a base span or a more probable candidate.

Null text counts as empty and has no spans. Offsets are code points, ends exclusive. Rows that repeat
a doc_id are searched one by one. Of equally probable candidates the first by kind,
then in the text, stays. Very long texts are
searched whole; an empty table gives no rows. Columns other than doc_id and text, also ones with clashing
names, are left out.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from risklens.llm.shared import pick, written
from risklens.llm.words import text_column

KINDS = ("email", "ip", "card", "phone")
ACCEPT = 0.9
EM_STEPS, NEWTON_STEPS, RIDGE = 50, 8, 1.0
CONTEXT = 48

# Fixed patterns of the base spans. A run of digits or mail characters that fails at its beginning
# fails everywhere, so matches need only be tried there.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Looser candidates.
_NATIONAL = re.compile(r"(?<![0-9+.(-])\(?[0-9]{2,4}\)?[\x20.-]{1,2}[0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])")
_GROUPS = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
_AT = re.compile(r" ?[\[(]at[\])] ?| at ")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:(?:\.| ?[\[(]dot[\])] ?| dot )[A-Za-z0-9-]+)+")
_DIGIT = re.compile(r"[0-9]")
_MAIL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")

# Gazetteers: top-level domains, mail hosts, first digits of card issuers, calling codes.
TOP_LEVEL = frozenset("com org net edu gov int info biz io eu de fr es it uk us nl ch at be pl se".split())
MAIL_HOSTS = ("mail", "post", "example", "inbox", "office")
ISSUERS = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "35", "36")
CALLING = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47",
           "48", "49", "52", "54", "55", "61", "62", "64", "65", "81", "82", "86", "90", "91")
# Words that speak for a kind, and words that speak against personal data.
CUES = {"email": ("mail", "contact", "write", "courriel", "correo", "reach"),
        "ip": ("ip", "host", "server", "client", "login", "from", "addr"),
        "card": ("card", "visa", "pay", "credit", "karte", "carte", "tarjeta"),
        "phone": ("phone", "call", "tel", "mobile", "fax", "anruf", "appel", "dial")}
AGAINST = ("version", "release", "isbn", "order", "invoice", "page", "token", "sha", "hash", "serial", "build", "id =")


def _luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2]) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _MAIL_CHARS:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            last = found.end()
            yield start, last
        at = text.find("@", max(at + 1, last))


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_matches(text: str) -> list[tuple[int, int, int, bool]]:
    """(kind, start, end, passed) of all pattern matches, by kind and start."""
    out = [(0, s, e, True) for s, e in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return out
    if text.count(".") >= 3:
        out += [(1, m.start(), m.end(), all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")))
                for m in _IP.finditer(text)]
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        out.append((2, m.start(), m.end(), 13 <= len(digits) <= 19 and _luhn(digits)))
    if "+" in text:
        out += [(3, m.start(), m.end(), 9 <= len(_digits(m.group())) <= 15) for m in _PHONE.finditer(text)]
    return out


def candidates(text: str, matches: list[tuple[int, int, int, bool]]) -> list[tuple[int, int, int, int]]:
    """Base matches and looser candidates with the vote of their pattern.

    A match that passes its check has 1, one that fails -1, a looser candidate 0. Of the numbers that
    fail, those of 12 digits and more are candidates.
    """
    out = [(*m[:3], 1 if m[3] else -1) for m in matches if m[3] or m[0] != 2 or len(_digits(text[m[1]:m[2]])) >= 12]
    if matches or _DIGIT.search(text):
        out += [(3, m.start(), m.end(), 0) for m in _NATIONAL.finditer(text)]
        if ":" in text:
            out += [(1, m.start(), m.end(), 0) for m in _GROUPS.finditer(text)]
    for m in _AT.finditer(text):
        start = m.start()
        while start > 0 and text[start - 1] in _MAIL_CHARS:
            start -= 1
        host = _HOST.match(text, m.end()) if start < m.start() else None
        if host:
            out.append((0, start, host.end(), 0))
    return out


def votes(text: str, kind: int, start: int, end: int, pattern: int) -> tuple[int, int, int, int]:
    """Votes of pattern, gazetteer, context and shape: 1 yes, -1 no, 0 nothing."""
    span, name = text[start:end], KINDS[kind]
    digits = _digits(span)
    if kind == 0:
        parts = re.split(r"[@.]| at | dot |[\[(](?:at|dot)[\])]", span.lower())
        known = 1 if parts[-1].strip() in TOP_LEVEL else -1
        if known > 0 and not any(h in p for p in parts[1:] for h in MAIL_HOSTS):
            known = 0
        shape = 1 if len(parts) <= 6 and not span.startswith((".", "-")) and ".." not in span else -1
    elif kind == 1:
        known = -1 if span.startswith(("0.", "127.", "255.")) else 0
        shape = 1 if all(p == "0" or not p.startswith("0") for p in re.split("[.:]", span)) else -1
    elif kind == 2:
        known = 1 if digits.startswith(ISSUERS) else -1
        shape = 1 if 13 <= len(digits) <= 19 and len({len(p) for p in re.split("[ -]", span)[:-1]}) <= 1 else -1
    else:
        known = (1 if digits.startswith(CALLING) else -1) if span.startswith("+") else 0
        shape = 1 if 9 <= len(digits) <= 15 and span.count("(") == span.count(")") else -1
    before = text[max(0, start - CONTEXT):start].lower()
    around = before + " " + text[end:end + CONTEXT // 2].lower()
    words = re.findall(r"[^\W\d_]+", around)
    cue = any(w.startswith(CUES[name]) and len(w) <= 9 for w in words)
    against = any(a in before for a in AGAINST) or text[start - 1:start].isalnum() or text[end:end + 1].isalnum()
    context = -1 if against else 1 if cue else 0
    return pattern, known, context, shape


def features(text: str, kind: int, start: int, end: int, vote: tuple[int, int, int, int]) -> list[float]:
    """Inputs of the span classifier."""
    span = text[start:end]
    n, digits = len(span), _digits(span)
    left, right = text[start - 1:start], text[end:end + 1]
    return [1.0, *[float(kind == k) for k in range(4)], min(n, 64) / 32, len(digits) / n,
            sum(c in " -.()" for c in span) / n, float(_luhn(digits)) if digits else 0.0, min(len(digits), 24) / 12,
            float(not left or left.isspace()), float(not right or right.isspace() or right in ".,;)"),
            *[float(v) for v in vote[1:]]]


N_FEATURES = 15


def _spans_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


_ROWS = ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, base array<int>"
_FOUND = "spans array<int>, votes array<int>, features array<double>"


def _searched(docs: DataFrame) -> DataFrame:
    """One row per document: counts and spans (triples) of base, and spans, votes and features of candidates."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, digests, base, spans, cast, inputs = [], [], [], [], [], []
            for text in text_column(b.column(1)):
                text = text.as_py()
                matches = base_matches(text)
                kept = [m[:3] for m in matches if m[3]]
                counts.append([sum(m[0] == k for m in kept) for k in range(4)])
                digests.append(hashlib.sha256(_spans_text(kept).encode()).hexdigest())
                base.append([x for m in kept for x in m])
                row = [], [], []
                for c in candidates(text, matches):
                    v = votes(text, *c)
                    row[0].extend(c[:3])
                    row[1].extend(v)
                    row[2].extend(features(text, *c[:3], v))
                for to, x in zip((spans, cast, inputs), row):
                    to.append(x)
            numbers = np.array(counts, dtype=np.int64).reshape(-1, 4)
            ints = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(numbers[:, k]) for k in range(4)], pa.array(digests, pa.string()), pa.array(base, ints),
                 pa.array(spans, ints), pa.array(cast, ints), pa.array(inputs, pa.list_(pa.float64()))],
                ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "base", "spans", "votes", "features"])
    plain = pick(docs, "doc_id", "text")
    kind = plain.schema["doc_id"].dataType.simpleString()
    return plain.mapInArrow(run, f"doc_id {kind}, {_ROWS}, {_FOUND}")


def reliabilities(counts: dict[tuple[int, ...], int]) -> dict[tuple[int, ...], float]:
    """Probability of each (kind, votes) by expectation-maximisation on their counts.

    Within a kind, labelers vote independently given the truth, and no vote says nothing. How often a
    labeler's vote is yes if the truth is yes, and if it is no, is estimated from a start that trusts
    the pattern most.
    """
    out: dict[tuple[int, ...], float] = {}
    for kind in range(len(KINDS)):
        seen = [(k[1:], n) for k, n in counts.items() if k[0] == kind]
        if not seen:
            continue
        vote = np.array([v for v, _ in seen])
        n = np.array([c for _, c in seen], dtype=float)
        # yes[labeler, truth]: share of votes that are yes.
        yes = np.array([[1 - trust, trust] for trust in (0.9, 0.7, 0.65, 0.7)])
        prior = 0.5
        for _ in range(EM_STEPS):
            like = [np.prod([np.where(vote[:, j] == 0, 1.0, np.where(vote[:, j] > 0, yes[j, t], 1 - yes[j, t]))
                             for j in range(4)], axis=0) for t in (0, 1)]
            p = prior * like[1] / (prior * like[1] + (1 - prior) * like[0])
            prior = float(np.clip((n @ p + 1) / (n.sum() + 2), 0.01, 0.99))
            for j, t in product(range(4), range(2)):
                weight = n * (p if t else 1 - p)
                cast = vote[:, j] != 0
                yes[j, t] = (weight[vote[:, j] > 0].sum() + (0.7 if t else 0.3)) / (weight[cast].sum() + 1)
        out |= {(kind, *map(int, v)): float(x) for v, x in zip(vote, p)}
    return out


def _train(found: DataFrame, truth: dict[tuple[int, ...], float]) -> np.ndarray:
    """Weights of the span classifier by Newton steps; every step is one pass over the candidates."""
    side = N_FEATURES
    weights = np.zeros(side)

    def sums(w: np.ndarray):
        def run(batches):
            total = np.zeros((side, side + 1))
            for b in batches:
                x = np.array(b.column(2).flatten().to_numpy(zero_copy_only=False)).reshape(-1, side)
                kind = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, 3)[:, 0]
                cast = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, 4)
                y = np.array([truth[(int(k), *map(int, v))] for k, v in zip(kind, cast)])
                p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
                total[:, :side] += (x * (p * (1 - p))[:, None]).T @ x
                total[:, side] += x.T @ (y - p)
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], ["sums"])
        return run

    for _ in range(NEWTON_STEPS):
        parts = found.mapInArrow(sums(weights), "sums array<double>")
        added = parts.select(F.posexplode("sums").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).collect()
        total = np.zeros(side * (side + 1))
        for r in added:  # side x (side + 1) numbers
            total[r["i"]] = r["x"]
        total = total.reshape(side, side + 1)
        step = np.linalg.solve(total[:, :side] + RIDGE * np.eye(side), total[:, side] - RIDGE * weights)
        weights = weights + step
        if np.abs(step).max() < 1e-6:
            break
    return weights


class _Taken:
    """Places of a text that spans hold, as sorted intervals without overlap."""

    def __init__(self, spans):
        self.starts, self.ends = [], []
        for x, y in sorted(spans):
            if self.ends and x < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], y)
            else:
                self.starts.append(x)
                self.ends.append(y)

    def add(self, x: int, y: int) -> bool:
        """Take a span, unless it overlaps one."""
        at = bisect_left(self.starts, y)
        if at and self.ends[at - 1] > x:
            return False
        self.starts.insert(at, x)
        self.ends.insert(at, y)
        return True


def find(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, n_added and spans of every document."""
    table = written(_searched(docs))
    found = table.where(F.size("spans") > 0).select("spans", "votes", "features")
    places = F.sequence(F.lit(0), (F.size("spans") / 3 - 1).cast("int"))
    each = (found.select("spans", "votes", F.explode(places).alias("i"))
            .select(F.expr("spans[3 * i]").alias("kind"), *[F.expr(f"votes[4 * i + {j}]").alias(f"v{j}") for j in range(4)]))
    seen = each.groupBy("kind", "v0", "v1", "v2", "v3").count().collect()  # 4 x 81 rows at most
    truth = reliabilities({tuple(r)[:5]: r["count"] for r in seen})
    weights = _train(found, truth) if truth else np.zeros(N_FEATURES)

    def run(batches):
        for b in batches:
            added, text = [], []
            for base, spans, cast, inputs in zip(*(b.column(i) for i in (6, 7, 8, 9))):
                base = np.array(base.values.to_numpy()).reshape(-1, 3)
                spans = np.array(spans.values.to_numpy()).reshape(-1, 3)
                held = [tuple(map(int, s)) for s in base]
                n, taken = len(held), _Taken((x, y) for _, x, y in held)
                if len(spans):
                    cast = np.array(cast.values.to_numpy()).reshape(-1, 4)
                    p = 1 / (1 + np.exp(-np.clip(np.array(inputs.values.to_numpy()).reshape(-1, N_FEATURES) @ weights, -30, 30)))
                    for i in np.lexsort((spans[:, 1], spans[:, 0], -np.round(p, 9))):
                        k, s, e = map(int, spans[i])
                        if p[i] >= ACCEPT and (cast[i, 1:3] > 0).any() and taken.add(s, e):
                            held.append((k, s, e))
                added.append(len(held) - n)
                text.append(_spans_text(held))
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(6)], pa.array(added, pa.int64()), pa.array(text, pa.string())],
                                             [*b.schema.names[:6], "n_added", "spans"])
    kind = table.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return (table.select("doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "base", "spans", "votes", "features")
            .mapInArrow(run, f"doc_id {kind}, {counts}, base_sha256 string, n_added long, spans string"))
