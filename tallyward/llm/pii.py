"""Personal data in texts: patterns with checks, and a character tagger for what they miss.

The tagger is a bidirectional LSTM over characters with CRF transitions, trained in numpy on the
driver from windows around labelled spans, a bounded number of them. The spans are labelled by the
patterns, once as they stand and once rewritten in a form that the patterns do not read: a phone
without its plus, an address with a spelled-out or spaced ``@``, other separators. The tagger reads
overlapping windows of the places that can hold personal data at all; each window is decoded, and
each character takes its tag from the window in which it lies deepest. Spans of the patterns always
stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.llm.text import add_columns, pieces
from tallyward.session import materialise

KINDS = ("email", "ip", "card", "phone")
WINDOW, STRIDE, REACH = 64, 32, 16  # characters; a window starts at every multiple of the stride
MAX_WINDOWS = 4_000  # learned from
HIDDEN, EMBEDDING, CLASSES = 16, 12, 100
TAGS = 1 + 2 * len(KINDS)  # outside; begin and inside of each kind
#: A span has one of these, so windows far from them need no reading.
TRIGGER = re.compile(r"[0-9@]|[(\[{]at[)\]}]")

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The address around each ``@``; local parts reach back to the address before at most."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and _LOCAL.match(text[start - 1]):
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            end = found.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def luhn(digits: str) -> bool:
    doubled = [d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, digits[::-1]))]
    return sum(doubled) % 10 == 0


def _valid_ip(text: str) -> bool:
    parts = [p.lstrip("0") or "0" for p in text.split(".")]
    return all(len(p) <= 3 and int(p) <= 255 for p in parts)


def _card_sized(text: str) -> bool:
    return 14 <= len(re.sub("[^0-9]", "", text)) <= 19


def _valid_card(text: str) -> bool:
    return _card_sized(text) and luhn(re.sub("[^0-9]", "", text))


def _valid_phone(text: str) -> bool:
    return 10 <= len(re.sub("[^0-9]", "", text)) <= 15


_CHECKED = ((1, _IP, _valid_ip), (2, _CARD, _valid_card), (3, _PHONE, _valid_phone))

Span = tuple[int, int, int]


def base_spans(text: str) -> tuple[list[Span], list[Span]]:
    """``(start, kind number, end)`` of the leftmost matches of each kind, in order: those that pass
    their check, and those that do not. Two digits are a match of a card's pattern; without as many
    as a card has they are no card that failed, and in neither list."""
    spans, refused = [(a, 0, b) for a, b in _emails(text)], []
    for kind, pattern, valid in _CHECKED:
        for m in pattern.finditer(text):
            if valid(m.group()):
                spans.append((m.start(), kind, m.end()))
            elif kind != 2 or _card_sized(m.group()):
                refused.append((m.start(), kind, m.end()))
    return sorted(spans), sorted(refused)


# How spans are rewritten: for each kind pairs of a pattern and what takes its place, all of one form.
_FORMS = (
    [
        [("@", " [at] "), (r"\.", " [dot] ")], [("@", "(at)"), (r"\.(?=[^.]*$)", "(dot)")],
        [("@", " @ ")], [("@", " (at) ")], [("@", "[at]")],
    ],
    [[(r"\.", "[.]")], [(r"\.", " . ")], [(r"\.", "(.)")], [(r"\.", "-")]],
    [[(r"[ -]", ""), (r"([0-9]{4})(?=[0-9])", sep)] for sep in (r"\1.", r"\1/", r"\1_")],
    [
        [(r"^\+", "")], [(r"^\+", "00")], [(r"^\+", ""), (r"[ ().-]+", "/")],
        [(r"^\+", "00"), (r"[ ().-]+", "-")], [(r"^\+[0-9]{1,2}[ .-]*\(?", "0")],
    ],
)


def altered(text: str, spans: list[Span]) -> tuple[str, list[Span]]:
    """The text with its spans in forms that the patterns do not read, and where they are then.

    The form follows a hash of the span, so that a rerun makes the same ones. Of overlapping spans
    the first is rewritten and the others are left out.
    """
    parts, moved, at, size = [], [], 0, 0
    for start, kind, end in spans:
        if start < at:
            continue
        own, forms = text[start:end], _FORMS[kind]
        for pattern, other in forms[crc32(own.encode("utf-8", "surrogatepass")) % len(forms)]:
            own = re.sub(pattern, other, own)
        parts += [text[at:start], own]
        size += start - at
        moved.append((size, kind, size + len(own)))
        size, at = size + len(own), end
    return "".join([*parts, text[at:]]), moved


def _classes(text: str) -> np.ndarray:
    """A number below ``CLASSES`` for each character: itself in ASCII, else what sort it is."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(codes < 32, 0, np.where(codes < 127, codes - 31, 96)).astype(np.int64)


def window_starts(text: str) -> list[int]:
    """Starts of the windows that come near a trigger, in order."""
    starts: set[int] = set()
    last = max(0, -(-(len(text) - WINDOW) // STRIDE)) * STRIDE
    for m in TRIGGER.finditer(text):
        low = max(0, (m.start() - REACH - WINDOW) // STRIDE + 1) * STRIDE
        starts.update(range(low, min(last, m.start() + REACH) + 1, STRIDE))
    return sorted(starts)


def _tags(size: int, spans: list[Span]) -> np.ndarray:
    tags = np.zeros(size, np.int8)
    for start, kind, end in reversed(spans):  # of overlapping spans the first counts
        tags[start:end] = 2 * kind + 2
        tags[start] = 2 * kind + 1
    return tags


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Tagger(NamedTuple):
    embedding: np.ndarray  # classes x embedding
    forward: np.ndarray  # (1 + embedding + hidden) x 4 hidden
    backward: np.ndarray
    output: np.ndarray  # (1 + 2 hidden) x tags
    transition: np.ndarray  # tags x tags, from row to column
    begin: np.ndarray  # tags

    @classmethod
    def fresh(cls, seed: int = 7) -> Tagger:
        make = np.random.default_rng(seed).normal
        cell = (1 + EMBEDDING + HIDDEN, 4 * HIDDEN)
        forward, backward = make(0, 0.2, cell), make(0, 0.2, cell)
        forward[0, HIDDEN : 2 * HIDDEN] += 1  # remember at first
        backward[0, HIDDEN : 2 * HIDDEN] += 1
        return cls(
            make(0, 0.3, (CLASSES, EMBEDDING)), forward, backward,
            make(0, 0.2, (1 + 2 * HIDDEN, TAGS)), np.zeros((TAGS, TAGS)), np.zeros(TAGS),
        )

    def _both(self) -> np.ndarray:
        return np.stack([self.forward, self.backward])

    def _pass(self, x: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, list]:
        """Hidden states, time x direction x windows x hidden; padding leaves a state as it is.

        Both directions run in one loop, the second over the windows read from their end.
        """
        weights = self._both()
        inner = weights[:, 1 + EMBEDDING :]
        gates = x @ weights[:, 1 : 1 + EMBEDDING] + weights[:, :1]
        h, c = np.zeros((*x.shape[1:3], HIDDEN)), np.zeros((*x.shape[1:3], HIDDEN))
        states, saved = np.zeros((*x.shape[:3], HIDDEN)), []
        for t in range(len(x)):
            z = gates[t] + h @ inner
            z[..., : 3 * HIDDEN] = _sigmoid(z[..., : 3 * HIDDEN])
            z[..., 3 * HIDDEN :] = np.tanh(z[..., 3 * HIDDEN :])
            i, f, o, g = (z[..., k * HIDDEN : (k + 1) * HIDDEN] for k in range(4))
            new = f * c + i * g
            flat, on = np.tanh(new), mask[t][..., None]
            saved.append((h, c, i, f, o, g, flat, on))
            c = np.where(on, new, c)
            h = np.where(on, o * flat, h)
            states[t] = h
        return states, saved

    def _back(self, x: np.ndarray, saved: list, d_states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients by the weights of both directions and by what they read."""
        weights = self._both()
        inner = weights[:, 1 + EMBEDDING :].swapaxes(1, 2)
        d_gates = np.zeros((*d_states.shape[:3], 4 * HIDDEN))
        d_h = d_c = np.zeros(d_states.shape[1:])
        for t in reversed(range(len(saved))):
            _, before, i, f, o, g, flat, on = saved[t]
            d_h = d_h + d_states[t]
            live = np.where(on, d_h, 0)
            d_new = live * o * (1 - flat**2) + np.where(on, d_c, 0)
            d_z = d_gates[t]
            d_z[..., :HIDDEN] = d_new * g * i * (1 - i)
            d_z[..., HIDDEN : 2 * HIDDEN] = d_new * before * f * (1 - f)
            d_z[..., 2 * HIDDEN : 3 * HIDDEN] = live * flat * o * (1 - o)
            d_z[..., 3 * HIDDEN :] = d_new * i * (1 - g**2)
            d_h = np.where(on, 0, d_h) + d_z @ inner
            d_c = np.where(on, d_new * f, d_c)
        hidden = np.stack([s[0] for s in saved])
        read = np.concatenate([np.ones((*x.shape[:3], 1)), x, hidden], 3)
        d_weights = np.stack([np.tensordot(read[:, k], d_gates[:, k], ((0, 1), (0, 1))) for k in range(2)])
        return d_weights, d_gates @ weights[:, 1 : 1 + EMBEDDING].swapaxes(1, 2)

    def emissions(self, windows: np.ndarray) -> tuple[np.ndarray, tuple]:
        """Scores of the tags, time x windows x tags, for rows of classes (-1: padding)."""
        mask = (windows >= 0).T
        x = self.embedding[np.maximum(windows, 0).T]
        x = np.stack([x, x[::-1]], 1)
        states, saved = self._pass(x, np.stack([mask, mask[::-1]], 1))
        joined = np.concatenate([np.ones((*mask.shape, 1)), states[:, 0], states[::-1, 1]], 2)
        return joined @ self.output, (mask, joined, x, saved)

    def decode(self, windows: np.ndarray) -> np.ndarray:
        """The best tag sequence of each window (Viterbi)."""
        scores, (mask, *_) = self.emissions(windows)
        best, back = self.begin + scores[0], []
        for t in range(1, len(scores)):
            options = best[:, :, None] + self.transition
            choice = options.argmax(1)
            on = mask[t][:, None]
            back.append(np.where(on, choice, np.arange(TAGS)))
            best = np.where(on, options.max(1) + scores[t], best)
        tag = best.argmax(1)
        tags, here = np.zeros(windows.shape, np.int8), np.arange(len(windows))
        tags[:, -1] = tag
        for t in range(len(back) - 1, -1, -1):
            tag = back[t][here, tag]
            tags[:, t] = tag
        return tags

    def gradient(self, windows: np.ndarray, tags: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean negative log likelihood of the tags, and its gradient by each parameter."""
        scores, (mask, joined, x, saved) = self.emissions(windows)
        steps, n, _ = scores.shape
        tags = tags.T
        alpha, beta = np.zeros_like(scores), np.zeros_like(scores)
        alpha[0] = self.begin + scores[0]
        for t in range(1, steps):
            new = _logsumexp(alpha[t - 1][:, :, None] + self.transition, 1) + scores[t]
            alpha[t] = np.where(mask[t][:, None], new, alpha[t - 1])
        for t in range(steps - 2, -1, -1):
            new = _logsumexp(self.transition + (scores[t + 1] + beta[t + 1])[:, None, :], 2)
            beta[t] = np.where(mask[t + 1][:, None], new, beta[t + 1])
        total = _logsumexp(alpha[-1], 1)
        d_scores = np.exp(alpha + beta - total[None, :, None])
        own = np.take_along_axis(scores, tags[:, :, None], 2)[:, :, 0] * mask
        loss = total - self.begin[tags[0]] - own.sum(0)
        loss = loss - (self.transition[tags[:-1], tags[1:]] * mask[1:]).sum(0)
        d_begin = d_scores[0].sum(0) - np.bincount(tags[0], minlength=TAGS)
        both = alpha[:-1, :, :, None] + self.transition + (scores + beta)[1:, :, None, :]
        d_transition = np.exp(both[mask[1:]] - np.broadcast_to(total, mask[1:].shape)[mask[1:]][:, None, None]).sum(0)
        np.subtract.at(d_transition, (tags[:-1][mask[1:]], tags[1:][mask[1:]]), 1)
        np.subtract.at(d_scores, (*np.indices(tags.shape), tags), 1)
        d_scores *= mask[:, :, None]
        d_output = np.tensordot(joined, d_scores, ((0, 1), (0, 1)))
        d_joined = d_scores @ self.output.T
        d_states = np.stack([d_joined[:, :, 1 : 1 + HIDDEN], d_joined[::-1, :, 1 + HIDDEN :]], 1)
        (d_forward, d_backward), d_x = self._back(x, saved, d_states)
        d_read = (d_x[:, 0] + d_x[::-1, 1]) * mask[:, :, None]
        picked = np.eye(CLASSES)[np.maximum(windows, 0).T]
        d_embedding = np.tensordot(picked, d_read, ((0, 1), (0, 1)))
        parts = [d_embedding, d_forward, d_backward, d_output, d_transition, d_begin]
        return float(loss.mean()), [p / n for p in parts]


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


def train(windows: np.ndarray, tags: np.ndarray, rounds: int = 300, batch: int = 64) -> Tagger:
    """A tagger fitted to tagged windows by Adam, in a fixed random order."""
    tagger, order = Tagger.fresh(), np.random.default_rng(11)
    first, second = ([np.zeros_like(p) for p in tagger] for _ in range(2))
    for step in range(1, rounds + 1):
        some = order.integers(0, len(windows), batch)
        _, gradients = tagger.gradient(windows[some], tags[some])
        rate = 0.02 * (1 - step / (rounds + 1))
        moved = []
        for k, (value, g) in enumerate(zip(tagger, gradients)):
            g = np.clip(g, -1, 1)
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            moved.append(value - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8))
        tagger = Tagger(*moved)
    return tagger


def _cut(codes: np.ndarray, start: int) -> np.ndarray:
    row = np.full(WINDOW, -1, np.int64)
    part = codes[start : start + WINDOW]
    row[: len(part)] = part
    return row


def labelled_windows(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(codes, tags)`` of the windows near triggers, tagged by the pattern spans; texts with spans
    come twice, the second time with their spans rewritten."""

    def run(batches):
        for batch in batches:
            for part in pieces(batch, "text"):
                codes_out, tags_out = [], []
                for value in part.column("text").to_pylist():
                    if not TRIGGER.search(value or ""):
                        continue
                    spans = base_spans(value)[0]
                    for own, marks in [(value, spans), altered(value, spans)] if spans else [(value, spans)]:
                        codes, tags = _classes(own), _tags(len(own), marks)
                        for start in window_starts(own):
                            codes_out.append(codes[start : start + WINDOW].astype(np.uint8).tobytes())
                            tags_out.append(tags[start : start + WINDOW].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(codes_out, pa.binary()), pa.array(tags_out, pa.binary())], ["codes", "tags"]
                )

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "codes binary, tags binary")


def learn(docs: DataFrame, text: str = "text") -> Tagger | None:
    """A tagger from at most ``MAX_WINDOWS`` windows: half with a span and half without, chosen by
    hash over all texts. Without any window there is nothing to learn. Only windows whose hash is
    below a bound, some twice as many as are wanted, are sent to be sorted."""
    windows = labelled_windows(docs.filter(F.col(text).rlike("[0-9@]")), text).distinct()
    windows = materialise(windows, "pii-windows")
    order = F.xxhash64("codes"), F.col("codes"), F.col("tags")
    marked, half = F.regexp_replace(F.hex("tags"), "0", "") != "", MAX_WINDOWS // 2
    counts = windows.agg(F.count_if(marked).alias("with"), F.count_if(~marked).alias("without")).first()
    rows = []
    for part, total in ((windows.filter(marked), counts["with"]), (windows.filter(~marked), counts["without"])):
        if total > 4 * half:
            part = part.filter(order[0] < F.lit(int(2.0**64 * 2 * half / total) - 2**63))
        rows += part.orderBy(*order).limit(half).collect()
    if not rows:
        return None
    codes, tags = np.full((len(rows), WINDOW), -1, np.int64), np.zeros((len(rows), WINDOW), np.int64)
    for i, row in enumerate(rows):
        codes[i, : len(row.codes)] = np.frombuffer(row.codes, np.uint8)
        tags[i, : len(row.tags)] = np.frombuffer(row.tags, np.int8)
    return train(codes, tags)


def added_spans(
    text: str, starts: list[int], decoded: np.ndarray, taken: list[Span], refused: Iterable[Span] = ()
) -> list[Span]:
    """Spans of the tagger that touch none in ``taken``, those found already, and none of their own
    kind in ``refused``, the matches that failed a check; from decoded windows of one text."""
    tags, depth = {}, {}
    for start, row in zip(starts, decoded):
        for k in range(min(WINDOW, len(text) - start)):
            at, deep = start + k, min(k, WINDOW - 1 - k)
            if deep > depth.get(at, -1):
                depth[at], tags[at] = deep, int(row[k])
    busy = {i for a, _, b in taken for i in range(a, b)}
    failed = {(k, i) for a, k, b in refused for i in range(a, b)}
    spans, open_at, kind = [], None, None
    for at in [*sorted(tags), None]:
        tag = tags[at] if at is not None else 0
        follows = at is not None and open_at is not None and at - 1 in tags and tag == 2 * kind + 2
        if open_at is not None and not follows:
            spans.append((open_at, kind, last + 1))
            open_at = None
        if tag % 2 == 1:
            open_at, kind = at, tag // 2
        last = at
    return [
        s
        for s in spans
        if not any(i in busy or (s[1], i) in failed for i in range(s[0], s[2])) and TRIGGER.search(text, s[0], s[2])
    ]


def find(docs: DataFrame, tagger: Tagger | None, text: str = "text") -> DataFrame:
    """``docs`` plus ``base_spans`` and ``spans``: arrays of ``(kind, start, end)`` by start, then kind.

    Positions are code points, the end exclusive. ``spans`` has the pattern spans and those that the
    tagger adds. Null and empty texts have none; equal rows have equal spans. Columns of these
    names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tagger)
    span = T.StructType(
        [T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]
    )
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def make():
        tagger = shared.value

        def decode(rows: list[np.ndarray]) -> np.ndarray:
            parts = [tagger.decode(np.stack(rows[i : i + 512])) for i in range(0, len(rows), 512)]
            return np.concatenate(parts) if parts else np.zeros((0, WINDOW), np.int8)

        def work(texts: pa.Array) -> list[pa.Array]:
            values = [t or "" for t in texts.to_pylist()]
            both = [base_spans(t) if TRIGGER.search(t) else ([], []) for t in values]
            base = [spans for spans, _ in both]
            starts = [window_starts(t) if tagger else [] for t in values]
            rows = []
            for value, own in zip(values, starts):
                if own:
                    codes = _classes(value)
                    rows += [_cut(codes, start) for start in own]
            decoded, at, found = decode(rows), 0, []
            for value, own, (spans, refused) in zip(values, starts, both):
                more = added_spans(value, own, decoded[at : at + len(own)], spans, refused)
                found.append(sorted([*spans, *more]))
                at += len(own)
            return [pa.array([[(KINDS[k], a, b) for a, k, b in row] for row in s], kind) for s in (base, found)]

        return work

    fields = [T.StructField("base_spans", T.ArrayType(span)), T.StructField("spans", T.ArrayType(span))]
    return add_columns(docs, make, fields, text)
