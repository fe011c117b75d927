"""Personal data: base patterns, and a character-level bidirectional LSTM with CRF transitions that adds spans.

The tagger is trained in numpy from labelled spans. A text is cut into overlapping windows; the two LSTMs run over all
windows of a batch at once. The windows' emissions are joined into one sequence for each text - each character takes them
from the window in which it stands farther from an edge - and that whole sequence is decoded with the CRF's transitions.
"""

from __future__ import annotations

import random
import re
import string
from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cellgrid.llm.packed import map_columns, map_texts

KINDS = ("email", "ip", "card", "phone")
#: The base patterns (fixed values).
#: An address is found from its @ on, and numbers start where a run of digits does, so that a long unbroken run is read once.
LOCAL = string.ascii_letters + string.digits + "._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[int, int, str]  # start, end (exclusive), kind; code points


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[Span]:
    """Matches of [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+, leftmost and not overlapping."""
    free, at = 0, text.find("@")
    while at >= 0:
        before = text[free:at]
        start = free + len(before.rstrip(LOCAL))
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end(), "email"
        free = found.end() if found else at + 1
        at = text.find("@", max(free, at + 1))


def base_spans(text: str) -> list[Span]:
    """Matches of the base patterns by start, then in the order of KINDS."""
    found = list(emails(text))
    if "." in text:
        found += [(m.start(), m.end(), "ip") for m in IP.finditer(text) if _ip(m[0])]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14 and _card(m[0]):
            found.append((m.start(), m.end(), "card"))
    if "+" in text:
        found += [(m.start(), m.end(), "phone") for m in PHONE.finditer(text) if 10 <= len(NOT_DIGIT.sub("", m[0])) <= 15]
    return sorted(found, key=_order)


def _order(span: Span) -> tuple[int, int]:
    return span[0], KINDS.index(span[2])


def _ip(text: str) -> bool:
    parts = [p.lstrip("0") for p in text.split(".")]
    return all(len(p) <= 3 and int(p or "0") <= 255 for p in parts)


def _card(text: str) -> bool:
    digits = NOT_DIGIT.sub("", text)
    return 14 <= len(digits) <= 19 and luhn(digits)


# --- characters -----------------------------------------------------------------------------------------------------

_SINGLE = "@.-+()[]:/_ \n,"
CLASSES = 4 + len(_SINGLE)


def _table() -> np.ndarray:
    """Class of each code point up to 255: digit, lower case, upper case, one class for each of a few signs, other."""
    table = np.full(256, 3, dtype=np.uint8)
    for c in range(192, 256):
        table[c] = 1
    for k, group in enumerate(("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")):
        table[[ord(c) for c in group]] = k
    for k, c in enumerate(_SINGLE):
        table[ord(c)] = 4 + k
    return table


TABLE = _table()


def classes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.where(codes < 256, TABLE[np.minimum(codes, 255)], np.uint8(1))


# --- the model ------------------------------------------------------------------------------------------------------

TAGS = ("", *KINDS)
HIDDEN = 8
#: Transitions stay within these bounds, so that a wide enough margin of the outside tag settles a character.
MOST_TRANSITION = 1.5


@dataclass
class Tagger:
    """wx: direction x class x 4H (input, forget, output, new), wh: direction x H x 4H, out: direction x H x tags.

    Gates are clipped lines instead of sigmoids: cheap, and exact in numpy."""

    wx: np.ndarray
    wh: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    moves: np.ndarray

    def emissions(self, x: np.ndarray) -> np.ndarray:
        """Windows x tags x positions from classes, positions x windows."""
        steps, n = x.shape
        hid = self.wh.shape[1]
        made = np.zeros((steps, len(self.bias), n), dtype=np.float32)
        made += self.bias[None, :, None]
        for d in range(2):
            table, rec, out = (np.ascontiguousarray(a[d].T, dtype=np.float32) for a in (self.wx, self.wh, self.out))
            h, c = np.zeros((2, hid, n), dtype=np.float32)
            gates, more, part = np.empty((4 * hid, n), np.float32), np.empty((4 * hid, n), np.float32), np.empty((len(self.bias), n), np.float32)
            for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
                np.take(table, x[t], axis=1, out=gates, mode="clip")
                np.matmul(rec, h, out=more)
                gates += more
                np.clip(gates[: 3 * hid], 0, 1, out=gates[: 3 * hid])
                new = gates[3 * hid :]
                np.clip(new, -1, 1, out=new)
                c *= gates[hid : 2 * hid]
                new *= gates[:hid]
                c += new
                np.clip(c, -1, 1, out=h)
                h *= gates[2 * hid : 3 * hid]
                np.matmul(out, h, out=part)
                made[t] += part
        return np.ascontiguousarray(made.transpose(2, 1, 0))


def _forward(model: Tagger, d: int, x: np.ndarray) -> tuple[np.ndarray, ...]:
    steps, n = x.shape
    hid = model.wh.shape[1]
    raw = np.empty((steps, n, 4 * hid))
    h, c = np.zeros((steps + 1, n, hid)), np.zeros((steps + 1, n, hid))
    for t in range(steps):
        raw[t] = model.wx[d][x[t]] + h[t] @ model.wh[d]
        i, f, o = (np.clip(raw[t][:, k * hid : (k + 1) * hid], 0, 1) for k in range(3))
        c[t + 1] = f * c[t] + i * np.clip(raw[t][:, 3 * hid :], -1, 1)
        h[t + 1] = o * np.clip(c[t + 1], -1, 1)
    return raw, h, c


def _backward(model: Tagger, d: int, x: np.ndarray, state: tuple, dh_out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    raw, h, c = state
    steps, n = x.shape
    hid = model.wh.shape[1]
    gwx, gwh = np.zeros_like(model.wx[d]), np.zeros_like(model.wh[d])
    dh, dc = np.zeros((n, hid)), np.zeros((n, hid))
    one = np.eye(CLASSES)
    for t in range(steps - 1, -1, -1):
        a = raw[t]
        i, f, o = (np.clip(a[:, k * hid : (k + 1) * hid], 0, 1) for k in range(3))
        new, cell = np.clip(a[:, 3 * hid :], -1, 1), np.clip(c[t + 1], -1, 1)
        dh = dh + dh_out[t]
        dc = dc + dh * o * (np.abs(c[t + 1]) < 1)
        grad = np.concatenate((dc * new, dc * c[t], dh * cell, dc * i), axis=1)
        grad[:, : 3 * hid] *= (a[:, : 3 * hid] > -0.05) & (a[:, : 3 * hid] < 1.05)
        grad[:, 3 * hid :] *= np.abs(a[:, 3 * hid :]) < 1
        gwx += one[x[t]].T @ grad
        gwh += h[t].T @ grad
        dh = grad @ model.wh[d].T
        dc = dc * f
    return gwx, gwh


def _crf(emit: np.ndarray, moves: np.ndarray, tags: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Gradients of the negative log-likelihood by emissions and transitions (means over windows), and its value."""
    steps, n, k = emit.shape
    alpha, beta = np.empty_like(emit), np.zeros_like(emit)
    alpha[0] = emit[0]
    weights = np.exp(moves)
    for t in range(1, steps):
        top = alpha[t - 1].max(1, keepdims=True)
        alpha[t] = emit[t] + top + np.log(np.exp(alpha[t - 1] - top) @ weights)
    for t in range(steps - 2, -1, -1):
        nxt = emit[t + 1] + beta[t + 1]
        top = nxt.max(1, keepdims=True)
        beta[t] = top + np.log(np.exp(nxt - top) @ weights.T)
    top = alpha[-1].max(1, keepdims=True)
    norm = top + np.log(np.exp(alpha[-1] - top).sum(1, keepdims=True))
    one = np.eye(k)[tags]
    grad = np.exp(alpha + beta - norm) - one
    pairs = np.exp(alpha[:-1, :, :, None] + moves + (emit[1:] + beta[1:])[:, :, None, :] - norm[None, :, :, None])
    gmoves = pairs.sum((0, 1)) - np.einsum("tna,tnb->ab", one[:-1], one[1:])
    gold = (emit * one).sum() + moves[tags[:-1], tags[1:]].sum()
    return grad / n, gmoves / n, float((norm.sum() - gold) / n)


def fit(examples: list[tuple[str, list[Span]]], length: int = 64, rounds: int = 220, batch: int = 96, seed: int = 5) -> Tagger:
    """Trains on (text, spans): windows of this length, Adam. The examples are a bounded set; their number is the caller's."""
    rng = np.random.default_rng(seed)
    xs, ys = [], []
    for text, spans in examples:
        x, y = classes(text), np.zeros(len(text), dtype=np.int64)
        for a, b, kind in spans:
            y[a:b] = TAGS.index(kind)
        pad = -len(x) % length
        x, y = np.concatenate((x, np.full(pad, TABLE[10], np.uint8))), np.concatenate((y, np.zeros(pad, np.int64)))
        xs.append(x.reshape(-1, length))
        ys.append(y.reshape(-1, length))
    x, y = np.concatenate(xs), np.concatenate(ys)
    k = len(TAGS)
    scale = lambda *shape: rng.normal(0, 0.3, shape)
    model = Tagger(scale(2, CLASSES, 4 * HIDDEN), scale(2, HIDDEN, 4 * HIDDEN), scale(2, HIDDEN, k), np.zeros(k), np.zeros((k, k)))
    model.wx[:, :, HIDDEN : 2 * HIDDEN] += 0.8
    model.wx[:, :, :HIDDEN] += 0.5
    model.wx[:, :, 2 * HIDDEN : 3 * HIDDEN] += 0.5
    names = ("wx", "wh", "out", "bias", "moves")
    first, second = ({m: np.zeros_like(getattr(model, m)) for m in names} for _ in range(2))
    for step in range(1, rounds + 1):
        pick = rng.choice(len(x), min(batch, len(x)), replace=False)
        bx, by = x[pick].T, y[pick].T
        forth, back = _forward(model, 0, bx), _forward(model, 1, bx[::-1])
        emit = forth[1][1:] @ model.out[0] + (back[1][1:] @ model.out[1])[::-1] + model.bias
        demit, dmoves, _ = _crf(emit, model.moves, by)
        demit /= length
        g0 = _backward(model, 0, bx, forth, demit @ model.out[0].T)
        g1 = _backward(model, 1, bx[::-1], back, (demit @ model.out[1].T)[::-1])
        grads = {
            "wx": np.stack((g0[0], g1[0])),
            "wh": np.stack((g0[1], g1[1])),
            "out": np.stack((np.einsum("tnh,tnk->hk", forth[1][1:], demit), np.einsum("tnh,tnk->hk", back[1][1:], demit[::-1]))),
            "bias": demit.sum((0, 1)),
            "moves": dmoves / length,
        }
        rate = 0.03 * (1 - step / (rounds + 1)) + 0.002
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        for m in names:
            g = grads[m] * min(1.0, 1.0 / (norm + 1e-9))
            first[m] = 0.9 * first[m] + 0.1 * g
            second[m] = 0.99 * second[m] + 0.01 * g * g
            step_by = rate * (first[m] / (1 - 0.9**step)) / (np.sqrt(second[m] / (1 - 0.99**step)) + 1e-8)
            setattr(model, m, getattr(model, m) - step_by)
        model.moves = np.clip(model.moves, -MOST_TRANSITION, MOST_TRANSITION)
    return model


def labelled_examples(count: int = 1500, seed: int = 11) -> list[tuple[str, list[Span]]]:
    """Generated texts with labelled spans: the usual forms of each kind, spelled-out addresses and bare phone numbers
    among them, between invented words, numbers, dates, versions and tokens that are no personal data."""
    rng = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda a=2, b=9: "".join(rng.choices(letters, k=rng.randint(a, b)))
    digits = lambda n: "".join(rng.choices("0123456789", k=n))

    def card() -> str:
        body = digits(15)
        body += next(str(d) for d in range(10) if luhn(body + str(d)))
        gap = rng.choice(("", "", " ", "-"))
        return gap.join(body[k : k + 4] for k in range(0, 16, 4))

    def personal() -> tuple[str, str]:
        kind = rng.choice(KINDS)
        if kind == "email":
            name = word() + rng.choice((".", "_", "")) + rng.choice((word(), digits(2)))
            at, dot = rng.choice((("@", "."), ("@", "."), (" [at] ", " [dot] "), (" (at) ", ".")))
            return f"{name}{at}{word()}{rng.choice(('', digits(1)))}{dot}{rng.choice(('com', 'org', 'example' + dot + 'com'))}", kind
        if kind == "ip":
            return ".".join(str(rng.randint(0, 255)) for _ in range(4)), kind
        if kind == "card":
            return card(), kind
        a, b, c = digits(3), digits(3), digits(4)
        return rng.choice((f"+{rng.randint(1, 99)} ({a}) {b}-{c}", f"+{rng.randint(1, 99)} {a} {b} {c}", f"({a}) {b}-{c}", f"+{rng.randint(1, 9)}{a}{b}{c}")), kind

    def other() -> str:
        pick = rng.random()
        if pick < 0.8:
            w = word()
            return rng.choice((w, w, w.capitalize(), w + ",", w + "."))
        return rng.choice((digits(rng.randint(1, 6)), f"{digits(1)}.{digits(1)}", f"20{digits(2)}-{digits(2)}-{digits(2)}", f"{word()}-{word()}", f"#{digits(5)}", "".join(rng.choices("0123456789abcdef", k=40)), f"{word()} = {digits(2)}", f"({word()})", f"{digits(2)}:{digits(2)}", f"@{word()}", f"1 + {digits(1)}", word().upper()))

    out = []
    for _ in range(count):
        text, spans = "", []
        for _ in range(rng.randint(8, 22)):
            if rng.random() < 0.12:
                value, kind = personal()
                spans.append((len(text), len(text) + len(value), kind))
                text += value
            else:
                text += other()
            text += rng.choice((" ", " ", " ", " ", "\n", ". "))
        out.append((text, spans))
    return out


# --- decoding -------------------------------------------------------------------------------------------------------

WINDOW, EDGE = 256, 16
#: Windows that one pass of the LSTMs takes.
PASS = 2048


def _window_starts(size: int) -> range:
    return range(0, max(1, size - 2 * EDGE), WINDOW - 2 * EDGE)


def text_emissions(model: Tagger, texts: list[np.ndarray]) -> np.ndarray:
    """Emissions, tags x characters of the texts (classes), one text after another."""
    total = sum(map(len, texts))
    made = np.empty((len(TAGS), total), dtype=np.float32)
    windows = []  # first character, last character, of them from, to: places in the whole
    base = 0
    for x in texts:
        starts = _window_starts(len(x))
        for a in starts:
            low = a + EDGE if a else 0
            high = len(x) if a == starts[-1] else a + WINDOW - EDGE
            windows.append((base + a, base + min(a + WINDOW, len(x)), base + low, base + high))
        base += len(x)
    flat = np.concatenate([*texts, np.empty(0, np.uint8)])
    for k in range(0, len(windows), PASS):
        part = windows[k : k + PASS]
        x = np.full((len(part), WINDOW), TABLE[10], dtype=np.uint8)
        for row, (a, b, _, _) in enumerate(part):
            x[row, : b - a] = flat[a:b]
        emit = model.emissions(np.ascontiguousarray(x.T))
        for row, (a, _, low, high) in enumerate(part):
            made[:, low:high] = emit[row, :, low - a : high - a]
    return made


def decode(model: Tagger, emit: np.ndarray, borders: np.ndarray) -> list[tuple[int, int, str]]:
    """Best tag sequence of each text, as spans in places of the whole; borders: the first place of each text.

    The outside tag stands before and after each text. A run of other tags in the best path gains over staying outside;
    where no run through a place can gain, the best path is outside. The stretches between such places are decoded apart
    from each other, all at once."""
    size = emit.shape[1]
    if not size:
        return []
    moves = model.moves.astype(np.float32)
    stay, within = float(moves[0, 0]), float(moves[1:, 1:].max())
    # What a character adds to a run of other tags over staying outside, at most; and what a run has to gain in all.
    gain = (emit[1:].max(0) - emit[0]).astype(np.float64) + (within - stay)
    needed = (within - stay) + 2 * stay - float(moves[0, 1:].max()) - float(moves[1:, 0].max())
    total = np.cumsum(gain)
    before = np.concatenate(([0.0], total[:-1]))
    left = total - np.minimum.accumulate(before)
    right = np.maximum.accumulate(total[::-1])[::-1] - before
    open_ = left + right - gain > needed - 1e-3
    edge = np.diff(np.concatenate(([0], open_.view(np.int8), [0])))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    cuts = borders[(borders > 0) & (borders < size)]
    cuts = np.unique(cuts[open_[cuts] & open_[cuts - 1]])
    starts, ends = np.sort(np.concatenate((starts, cuts))), np.sort(np.concatenate((ends, cuts)))
    if not len(starts):
        return []
    order = np.argsort(starts - ends, kind="stable")
    starts, ends = starts[order], ends[order]
    sizes = ends - starts
    k = len(TAGS)
    score = moves[0][None, :] + emit[:, starts].T
    back = np.zeros((int(sizes.sum()), k), dtype=np.int8)
    first = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    for t in range(1, int(sizes[0])):
        n = int(np.searchsorted(-sizes, -t, side="left"))
        ways = score[:n, :, None] + moves[None]
        best = ways.argmax(1)
        back[first[:n] + t] = best
        score[:n] = np.take_along_axis(ways, best[:, None, :], 1)[:, 0] + emit[:, starts[:n] + t].T
    tag = (score + moves[:, 0][None, :]).argmax(1)
    path = np.zeros(size, dtype=np.int8)
    for t in range(int(sizes[0]) - 1, -1, -1):
        n = int(np.searchsorted(-sizes, -t, side="left"))
        path[starts[:n] + t] = tag[:n]
        if t:
            tag[:n] = back[first[:n] + t, tag[:n]]
    mark = np.ones(size, dtype=bool)
    mark[1:] = path[1:] != path[:-1]
    mark[cuts] = True
    runs = np.flatnonzero(mark)
    stops = np.append(runs[1:], size)
    return [(int(a), int(b), TAGS[path[a]]) for a, b in zip(runs, stops, strict=True) if path[a]]


def _plausible(text: str, kind: str) -> bool:
    """Whether a span that the tagger found can be what it is said to be."""
    digits = NOT_DIGIT.sub("", text)
    if kind == "email":
        return ("@" in text or "at" in text) and ("." in text or "dot" in text) and not text.endswith("@")
    if kind == "ip":
        return IP.fullmatch(text) is not None and _ip(text)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15 and text[0] in "+(" and ")" in text


def _covered(spans: list[Span]) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that spans, ordered by start, cover; both ascend."""
    starts, ends = [], []
    for a, b, _ in spans:
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def finder(model: Tagger) -> Callable[[list[str]], list[list[Span]]]:
    """A function from texts to their spans: the base ones, and those of the tagger that touch none of them."""

    def find(texts: list[str]) -> list[list[Span]]:
        found = [base_spans(t) for t in texts]
        covered = [_covered(f) for f in found]
        coded = [classes(t) for t in texts]
        borders = np.concatenate(([0], np.cumsum([len(x) for x in coded], dtype=np.int64)))
        for a, b, kind in decode(model, text_emissions(model, coded), borders[:-1]):
            doc = int(np.searchsorted(borders, a, side="right")) - 1
            text, low, high = texts[doc], a - int(borders[doc]), b - int(borders[doc])
            while low < high and text[low] in " .,\n":
                low += 1
            while low < high and text[high - 1] in " .,\n":
                high -= 1
            starts, ends = covered[doc]
            first = bisect_left(ends, low + 1)  # the first base stretch that ends behind the start of this one
            apart = first == len(starts) or starts[first] >= high
            if high - low >= 7 and apart and _plausible(text[low:high], kind):
                found[doc].append((low, high, kind))
        return [sorted(f, key=_order) for f in found]

    return find


#: Characters that a task tags at once.
TASK_CHARS = 400_000


def find_pii(docs: DataFrame, model: Tagger, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, base and spans (array<struct<start, end, kind>>), one row for each row: positions are code points.

    A null or empty text has no spans; null and repeated ids and repeated rows stay as they are; an empty table gives no
    rows; other columns play no part. The model has a fixed size, so it is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))

    def make():
        find = finder(shared.value)
        rows = lambda spans: pa.array([[dict(zip(("start", "end", "kind"), s)) for s in one] for one in spans], kind)

        def work(texts: list[str]) -> list[pa.Array]:
            spans, part, size = [], [], 0
            for t in texts:
                part.append(t)
                size += len(t)
                if size >= TASK_CHARS:
                    spans += find(part)
                    part, size = [], 0
            spans += find(part) if part else []
            return [rows([base_spans(t) for t in texts]), rows(spans)]

        return work

    span = "array<struct<start:int,end:int,kind:string>>"
    return map_texts(docs, make, f"base {span}, spans {span}", id_col, text_col)


def mask(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; of spans that overlap, the first gives the kind of the whole."""
    out, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: Tagger, text_col: str = "text") -> DataFrame:
    """All rows and columns of docs, personal data in the texts masked. A null text becomes empty; see find_pii."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        find = finder(shared.value)

        def work(texts: list[str]) -> list[pa.Array]:
            out, part, size = [], [], 0
            for k, t in enumerate(texts, 1):
                part.append(t)
                size += len(t)
                if size >= TASK_CHARS or k == len(texts):
                    out += [mask(x, spans) for x, spans in zip(part, find(part), strict=True)]
                    part, size = [], 0
            return [pa.array(out, pa.string())]

        return work

    return map_columns(docs, make, f"{text_col} string", text_col)
