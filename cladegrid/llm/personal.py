"""Personal data in texts: four base patterns, and further spans from a bidirectional character LSTM with CRF transitions.

The network is trained here in NumPy. Its labelled spans are the base matches in a bounded sample of text windows; each
is also shown in writings that the patterns miss (spaces at the ``@``, bracketed dots, other separators). Windows of
``WINDOW`` characters start every half window. Every kind holds a digit or an ``@``, so only windows with one of them
are decoded: the LSTM reads them both ways, the CRF gives label probabilities, the two windows over a character are
weighed by its distance from their edges, and one best valid label sequence is taken over all windows of a run. Found
spans that do not overlap a base span and pass the exact check of their kind (Luhn, parts, digits) are added.

Model bound (documented parameter): the ``per_kind`` windows with the least hash of each kind, and as many without any
span. Tasks keep the least hashes they meet, so the sample does not grow with the corpus and copies count once. Windows,
base matches and decoding cover whole texts. Training is seeded; the same tables give the same spans.

Defined cases: a null text is empty and has no spans; ids are carried as they are, null or repeated; matches of one
kind do not overlap, those of different kinds may; spans are in code points, end exclusive; without any labelled span
nothing is added.
"""

from __future__ import annotations

import heapq
import random
import re
from collections.abc import Iterator, Sequence
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Kinds in their order.
KINDS = ("email", "ip", "card", "phone")
SPANS = "array<struct<kind:string,start:long,end:long>>"

WINDOW = 64
PER_KIND = 300
HIDDEN = 24
STEPS, BATCH, RATE, SEED = 600, 32, 0.02, 13
# Windows that are decoded at once.
TOGETHER = 512

_BEFORE_AT = re.compile(r"[A-Za-z0-9._%+-]+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# no match starts inside a run of digits, and none needs fewer digits of a run than there are
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TRIGGER = re.compile(r"[0-9@]")
_DIGITS = re.compile(r"[0-9]+")


def luhn(digits: str) -> bool:
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (doubled + sum(int(d) for d in digits[-1::-2])) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """A match starts where the characters allowed before an ``@`` start, so only these have to be looked at."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base patterns, by kind and start; failing matches are dropped without another try."""
    spans = [(0, a, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                spans.append((1, m.start(), m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = "".join(_DIGITS.findall(m[0]))
                if 16 <= len(digits) <= 19 and luhn(digits):
                    spans.append((2, m.start(), m.end()))
        for m in _PHONE.finditer(text):
            if 8 <= sum(map(len, _DIGITS.findall(m[0]))) <= 15:
                spans.append((3, m.start(), m.end()))
    return spans


_EMAIL_CHECK = re.compile(r"[A-Za-z0-9._%+-]+\s?@\s?[A-Za-z0-9-]+(?:\s?(?:\.|\[\.\]|\(\.\))\s?[A-Za-z0-9-]+)+")
_IP_CHECK = re.compile(r"[0-9]{1,3}(?:\s?(?:\.|\[\.\]|\(\.\))\s?[0-9]{1,3}){3}")
_CARD_CHECK = re.compile(r"[0-9](?:[\x20._/-]{0,3}[0-9])+")
_PHONE_CHECK = re.compile(r"\+[0-9][\x20().0-9/-]*[0-9]")


def passes(kind: int, text: str) -> bool:
    """The exact check of a span that the network proposes."""
    digits = "".join(_DIGITS.findall(text))
    if kind == 0:
        return bool(_EMAIL_CHECK.fullmatch(text))
    if kind == 1:
        return bool(_IP_CHECK.fullmatch(text)) and all(int(p) <= 255 for p in _DIGITS.findall(text))
    if kind == 2:
        return bool(_CARD_CHECK.fullmatch(text)) and 16 <= len(digits) <= 19 and luhn(digits)
    return bool(_PHONE_CHECK.fullmatch(text)) and 8 <= len(digits) <= 15


def window_places(text: str, window: int = WINDOW) -> list[int]:
    """Numbers k of the windows from k * window / 2 that hold a digit or an ``@``."""
    half = window // 2
    cells = {m.start() // half for m in _TRIGGER.finditer(text)}
    return sorted(cells | {c - 1 for c in cells if c})


# Labels: 0 outside, then the first character and the others of each kind.
LABELS = 1 + 2 * len(KINDS)
_ALLOWED = np.zeros((LABELS, LABELS), bool)
_ALLOWED[:, [0, *range(1, LABELS, 2)]] = True
for _k in range(1, LABELS, 2):
    _ALLOWED[[_k, _k + 1], _k + 1] = True
_FIRST = np.array([label == 0 or label % 2 == 1 for label in range(LABELS)])
_NEVER = -1e4
# Characters: ASCII as it is, all others as one, and what follows the end of a text.
CHARACTERS, _OTHER, _PAD = 130, 128, 129


def character_ids(text: str, length: int) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.full(length, _PAD)
    out[: len(points)] = np.where(points < 128, points, _OTHER)
    return out


def _labels(spans: Sequence[tuple[int, int, int]], start: int, length: int) -> np.ndarray:
    out = np.zeros(length, np.int64)
    for kind, a, b in spans:
        a, b = max(a - start, 0), min(b - start, length)
        if a < b and not out[a:b].any():
            out[a:b] = 2 * kind + 2
            out[a] = 2 * kind + 1
    return out


class Tagger:
    """Bidirectional LSTM over characters, with a CRF over the labels of a window."""

    def __init__(self, hidden: int = HIDDEN, seed: int = SEED, kind: type = np.float32) -> None:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: rng.normal(0, 0.3, shape).astype(kind)
        # both directions in the first axis; gates are input, forget, output, candidate
        self.p = {"x": draw(2, CHARACTERS, 4 * hidden), "h": draw(2, hidden, 4 * hidden), "out": draw(2 * hidden, LABELS)}
        self.p |= {name: np.zeros(shape, kind) for name, shape in {"b": (2, 1, 4 * hidden), "bias": LABELS, "from": (LABELS, LABELS), "first": LABELS}.items()}
        self.p["b"][:, :, hidden : 2 * hidden] = 1
        self.hidden = hidden

    def _read(self, ids: np.ndarray) -> tuple[np.ndarray, list]:
        """Hidden states (2, T, N, H) in reading order of each direction, and what the backward pass needs."""
        n, length = ids.shape
        k, x, u = self.hidden, self.p["x"], self.p["h"]
        drawn = np.stack([x[0][ids.T], x[1][ids.T[::-1]]], 1) + self.p["b"]  # (T, 2, N, 4H)
        h = c = np.zeros((2, n, k), x.dtype)
        states, kept = np.empty((2, length, n, k), x.dtype), []
        for t in range(length):
            z = drawn[t]
            z += h @ u
            # half the argument makes a sigmoid of tanh
            z[:, :, : 3 * k] *= 0.5
            np.tanh(z, out=z)
            z[:, :, : 3 * k] *= 0.5
            z[:, :, : 3 * k] += 0.5
            before, c = c, z[:, :, k : 2 * k] * c + z[:, :, :k] * z[:, :, 3 * k :]
            flat = np.tanh(c)
            kept.append((h, before, z, flat))
            h = z[:, :, 2 * k : 3 * k] * flat
            states[:, t] = h
        return states, kept

    @staticmethod
    def _joined(states: np.ndarray) -> np.ndarray:
        """(N, T, 2H) in text order."""
        return np.concatenate([states[0], states[1, ::-1]], 2).transpose(1, 0, 2)

    def _sums(self, emitted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log normaliser, label probabilities (N, T, L), and expected transitions of the CRF."""
        n, length, _ = emitted.shape
        step = np.exp(self.p["from"]) * _ALLOWED
        top = emitted.max(2, keepdims=True)
        weight = np.exp(emitted - top)
        ahead, back = np.empty_like(emitted), np.empty_like(emitted)
        scale = np.empty((n, length, 1), emitted.dtype)
        now = np.exp(self.p["first"]) * _FIRST * weight[:, 0]
        for t in range(length):
            if t:
                now = (ahead[:, t - 1] @ step) * weight[:, t]
            scale[:, t] = now.sum(1, keepdims=True)
            ahead[:, t] = now / scale[:, t]
        back[:, -1] = 1
        for t in range(length - 2, -1, -1):
            back[:, t] = (weight[:, t + 1] * back[:, t + 1]) @ step.T / scale[:, t + 1]
        moves = np.einsum("nti,ntj->ij", ahead[:, :-1], weight[:, 1:] * back[:, 1:] / scale[:, 1:]) * step
        return (np.log(scale) + top).sum((1, 2)), ahead * back, moves

    def probabilities(self, ids: np.ndarray) -> np.ndarray:
        return self._sums(self._joined(self._read(ids)[0]) @ self.p["out"] + self.p["bias"])[1]

    def loss(self, ids: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of the labels, and its gradient."""
        n, length = ids.shape
        states, kept = self._read(ids)
        joined = self._joined(states)
        emitted = joined @ self.p["out"] + self.p["bias"]
        total, probable, moves = self._sums(emitted)
        given = np.eye(LABELS, dtype=emitted.dtype)[labels]
        score = (emitted * given).sum() + self.p["first"][labels[:, 0]].sum() + self.p["from"][labels[:, :-1], labels[:, 1:]].sum()
        off = (probable - given) / n
        seen = np.zeros((LABELS, LABELS), emitted.dtype)
        np.add.at(seen, (labels[:, :-1], labels[:, 1:]), 1)
        grad = {"out": np.einsum("nth,ntl->hl", joined, off), "bias": off.sum((0, 1)), "from": (moves - seen) / n, "first": off[:, 0].sum(0)}
        back = off @ self.p["out"].T
        k = self.hidden
        down = np.stack([back[:, :, :k].transpose(1, 0, 2), back[:, ::-1, k:].transpose(1, 0, 2)])
        both = np.stack([ids, ids[:, ::-1]])
        grad["x"], grad["h"], grad["b"] = (np.zeros_like(self.p[x]) for x in ("x", "h", "b"))
        dh = dc = np.zeros((2, n, k), back.dtype)
        dz = np.empty((2, length, n, 4 * k), back.dtype)
        for t in range(length - 1, -1, -1):
            h, before, gates, flat = kept[t]
            i, f, o, new = (gates[:, :, g * k : (g + 1) * k] for g in range(4))
            dh = dh + down[:, t]
            dc = dc + dh * o * (1 - flat * flat)
            z = dz[:, t]
            z[:, :, :k], z[:, :, k : 2 * k], z[:, :, 2 * k : 3 * k], z[:, :, 3 * k :] = dc * new * i * (1 - i), dc * before * f * (1 - f), dh * flat * o * (1 - o), dc * i * (1 - new * new)
            dh, dc = z @ self.p["h"].transpose(0, 2, 1), dc * f
        for d in (0, 1):
            earlier = np.stack([x[0][d] for x in kept]).reshape(n * length, k)
            grad["h"][d] = earlier.T @ dz[d].reshape(n * length, 4 * k)
            shown = np.zeros((n * length, CHARACTERS), back.dtype)
            shown[np.arange(n * length), both[d].T.ravel()] = 1
            grad["x"][d] = shown.T @ dz[d].reshape(n * length, 4 * k)
            grad["b"][d, 0] = dz[d].sum((0, 1))
        return float((total.sum() - score) / n), grad

    def train(self, ids: np.ndarray, labels: np.ndarray, steps: int = STEPS, batch: int = BATCH, rate: float = RATE, seed: int = SEED) -> float:
        """Adam on random batches with a falling rate; the mean loss of the last tenth."""
        rng = np.random.default_rng(seed)
        first, second = ({name: np.zeros_like(v) for name, v in self.p.items()} for _ in range(2))
        losses = []
        for step in range(1, steps + 1):
            chosen = rng.choice(len(ids), min(batch, len(ids)), replace=False)
            loss, grad = self.loss(ids[chosen], labels[chosen])
            losses.append(loss)
            for name, g in grad.items():
                g = np.clip(g, -5, 5)
                first[name] += 0.1 * (g - first[name])
                second[name] += 0.001 * (g * g - second[name])
                pace = rate * (1 - (step - 1) / steps) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                self.p[name] -= (pace * first[name] / (np.sqrt(second[name]) + 1e-8)).astype(g.dtype)
        return float(np.mean(losses[-max(1, steps // 10) :]))


def best_labels(probable: np.ndarray) -> np.ndarray:
    """The valid label sequence with the largest product of probabilities, for each of (N, T, L)."""
    logs = np.log(probable + 1e-9)
    n, length, _ = logs.shape
    step = np.where(_ALLOWED, 0.0, _NEVER)
    back = np.zeros((n, length, LABELS), np.int8)
    best = logs[:, 0] + np.where(_FIRST, 0.0, _NEVER)
    for t in range(1, length):
        ways = best[:, :, None] + step
        back[:, t] = ways.argmax(1)
        best = ways.max(1) + logs[:, t]
    out = np.empty((n, length), np.int64)
    out[:, -1] = best.argmax(1)
    for t in range(length - 1, 0, -1):
        out[:, t - 1] = back[np.arange(n), t, out[:, t]]
    return out


class _Run(NamedTuple):
    """Overlapping windows of one text: its row, the first window, and how many."""

    row: int
    first: int
    windows: int


def tag(texts: Sequence[str], tagger: Tagger, window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Spans (kind, start, end) by the network alone: all windows decoded, then reconciled over each run of windows."""
    half = window // 2
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    runs: list[_Run] = []
    ids: list[np.ndarray] = []

    def reconcile() -> None:
        if not ids:
            return
        probable = np.concatenate([tagger.probabilities(np.stack(ids[i : i + TOGETHER])) for i in range(0, len(ids), TOGETHER)])
        near = np.minimum(np.arange(window) + 1, window - np.arange(window))[:, None].astype(float)
        by_length: dict[int, list[tuple[_Run, np.ndarray]]] = {}
        at = 0
        for run in runs:
            sums = np.zeros(((run.windows + 1) * half, LABELS))
            weights = np.zeros((len(sums), 1))
            for k in range(run.windows):
                sums[k * half : k * half + window] += probable[at + k] * near
                weights[k * half : k * half + window] += near
            at += run.windows
            by_length.setdefault(len(sums), []).append((run, sums / weights))
        for same in by_length.values():
            for (run, _), labels in zip(same, best_labels(np.stack([p for _, p in same]))):
                inside = np.flatnonzero(labels)
                begins = inside[labels[inside] % 2 == 1]
                for a in begins.tolist():
                    b = a + 1
                    while b < len(labels) and labels[b] == labels[a] + 1:
                        b += 1
                    start = run.first * half
                    out[run.row].append(((int(labels[a]) - 1) // 2, start + a, min(start + b, len(texts[run.row]))))
        runs.clear()
        ids.clear()

    for row, text in enumerate(texts):
        first = last = None
        for k in window_places(text, window):
            if last is not None and k == last + 1 and k - first < TOGETHER:
                runs[-1] = runs[-1]._replace(windows=runs[-1].windows + 1)
            else:
                if len(ids) >= TOGETHER:
                    reconcile()
                runs.append(_Run(row, k, 1))
                first = k
            last = k
            ids.append(character_ids(text[k * half : k * half + window], window))
    reconcile()
    return out


def all_spans(text: str, tagged: Sequence[tuple[int, int, int]]) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and these with the checked spans of the network that overlap none of them; by kind and start."""
    base = base_spans(text)
    added = [s for s in tagged if passes(s[0], text[s[1] : s[2]]) and not any(a < s[2] and s[1] < b for _, a, b in base)]
    return base, sorted(base + added)


def _rewritten(text: str, spans: Sequence[tuple[int, int, int]], rng: random.Random) -> tuple[str, list[tuple[int, int, int]]]:
    """The window with its spans in writings that the base patterns miss."""
    pieces, out, at = [], [], 0
    for kind, a, b in sorted(spans, key=lambda s: s[1:]):
        if a < at:
            continue
        span = text[a:b]
        if kind == 0:
            span = span.replace("@", rng.choice([" @ ", " @", "@ "])) if rng.random() < 0.5 else span.replace(".", rng.choice(["[.]", "(.)", " . "]))
        elif kind == 1:
            span = span.replace(".", rng.choice(["[.]", "(.)", " . "]))
        elif kind == 2:
            mark = rng.choice([".", "_", "  ", " - ", "/"])
            span = re.sub("[ -]", mark, span) if re.search("[ -]", span) else mark.join(span[i : i + 4] for i in range(0, len(span), 4))
        else:
            span = re.sub(r"[ .-]", rng.choice(["/", " / "]), span)
        pieces += [text[at:a], span]
        start = sum(map(len, pieces)) - len(span)
        out.append((kind, start, start + len(span)))
        at = b
    return "".join([*pieces, text[at:]]), out


def sample_windows(docs: DataFrame, text: str = "text", per_kind: int = PER_KIND, window: int = WINDOW) -> DataFrame:
    """(kind, content, spans): of each kind, and of windows without a span (kind -1), the ``per_kind`` with the least hash."""

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[int, str, tuple]]] = {k: [] for k in range(-1, len(KINDS))}  # heaps, largest hash first
        known: set[tuple[int, int]] = set()
        for batch in batches:
            for value in batch.column("text").to_pylist():
                if not value or not _TRIGGER.search(value):
                    continue
                spans, half = base_spans(value), window // 2
                for k in window_places(value, window):
                    start = k * half
                    # the first of the spans inside names the kind; cut ones are no examples
                    inside = [s for s in spans if s[1] < start + window and start < s[2]]
                    if any(s[1] < start or s[2] > start + window for s in inside):
                        continue
                    content, kind = value[start : start + window], inside[0][0] if inside else -1
                    code = int.from_bytes(blake2b(content.encode("utf-8", "surrogatepass"), digest_size=7).digest(), "big")
                    heap = held[kind]
                    if (kind, code) in known or (len(heap) >= per_kind and code >= -heap[0][0]):
                        continue
                    known.add((kind, code))
                    entry = (-code, content, tuple((s[0], s[1] - start, s[2] - start) for s in inside))
                    if len(heap) < per_kind:
                        heapq.heappush(heap, entry)
                    else:
                        known.discard((kind, -heapq.heapreplace(heap, entry)[0]))
        rows = [(kind, -code, content, [list(s) for s in spans]) for kind, heap in held.items() for code, content, spans in heap]
        kinds = (pa.int32(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int32())))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["kind", "code", "content", "spans"])

    found = docs.select(F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(least, "kind int, code long, content string, spans array<array<int>>")
    ranked = found.dropDuplicates(["kind", "code"]).withColumn("place", F.row_number().over(W.partitionBy("kind").orderBy("code")))
    return ranked.where(F.col("place") <= per_kind).select("kind", "code", "content", "spans")


def fit(docs: DataFrame, text: str = "text", per_kind: int = PER_KIND, window: int = WINDOW, steps: int = STEPS) -> Tagger | None:
    """Train on the sampled windows, at most (kinds + 1) * per_kind; None without any labelled span."""
    rows = sorted(tuple(r) for r in sample_windows(docs, text, per_kind, window).collect())
    if not any(spans for _, _, _, spans in rows):
        return None
    rng = random.Random(SEED)
    shown = [(content, spans) for _, _, content, spans in rows]
    shown += [_rewritten(content, spans, rng) for _, _, content, spans in rows if spans]
    ids = np.stack([character_ids(content[:window], window) for content, _ in shown])
    labels = np.stack([_labels(spans, 0, window) for _, spans in shown])
    tagger = Tagger()
    tagger.train(ids, labels, steps)
    return tagger


def find_personal(docs: DataFrame, tagger: Tagger | None, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """(row, base, spans): the columns ``keep`` (all by default) as a struct, the base spans, and all spans by kind and start."""
    shared = docs.sparkSession.sparkContext.broadcast(tagger)
    kind_of = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            tagged = tag(texts, shared.value) if shared.value is not None else [[] for _ in texts]
            both = [all_spans(t, s) for t, s in zip(texts, tagged)]
            columns = [pa.array([[{"kind": KINDS[k], "start": a, "end": b} for k, a, b in each[i]] for each in both], pa.list_(kind_of)) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *columns], names=["row", "base", "spans"])

    kept = F.struct("*") if keep is None else F.struct(*[f"`{c}`" for c in keep])
    chosen = docs.select(kept.alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
    return chosen.mapInArrow(scan, chosen.select("row", F.array().cast(SPANS).alias("base"), F.array().cast(SPANS).alias("spans")).schema)
