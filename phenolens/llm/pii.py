"""Personal data: fixed patterns plus a character BiLSTM-CRF.

The patterns give the base spans of four kinds (email, ip, card, phone). They
also label the training windows of the model: a character-level bidirectional
LSTM with CRF transitions, trained in NumPy with Adam. Half of the training
spans are rewritten (separators changed, a plus dropped, spaces put in), so
the model learns forms that the patterns miss.

Every text is decoded as a whole, whatever characters it holds. It is covered
by windows of ``SPAN`` characters that overlap by ``OVERLAP``; each character takes
its scores from the window that has it furthest from an edge, and Viterbi over
the whole text gives the spans. The gates are straight lines cut at their ends,
in place of logistic curves, which costs a third. Where
no run of other tags can make up for the steps into and out of it, the best
path has the empty tag; the rest is decoded between such places, which gives
the same path. Spans of at least ``LEAST_CHARS`` characters whose labels
have a mean score (a softmax over the tags) of ``SURE`` or more and that touch
no base span are added.

The training set is the ``TRAIN_WINDOWS`` windows around digits and ``@`` of all
documents with the smallest hash, and the ``PLAIN_WINDOWS`` such ones of plain
text (up to three of each text, one of them at its end; documented bounds). Everything else covers every text whole.

Cases: a null text counts as empty and has no spans (``redact`` keeps it
null). Rows are treated one by one, so repeated rows give repeated results and
a null ``doc_id`` is no obstacle; other columns stay, whatever their names. A task
holds about 100 bytes a character of its longest text. Without any training window the model adds
nothing. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import renamed, texts_of, written

KINDS = ("email", "ip", "card", "phone")
TRAIN_WINDOWS = 1200
PLAIN_WINDOWS = 600
BOUNDS = ((False, TRAIN_WINDOWS), (True, PLAIN_WINDOWS))
STEPS = 400
WIDTH = 64
REACH = 24
LEAST_CHARS = 7
#: Characters and windows that are in memory together (one longer text at least).
SLICE_CHARS, WINDOWS = 1 << 19, 1024
#: Windows of the decoding; the training windows have ``WIDTH``.
SPAN, OVERLAP = 256, 32
SURE = 0.7
HIDDEN, EMBED, SYMBOLS, TAGS = 12, 12, 130, 1 + len(KINDS)

_LOCAL = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# No earlier start in a run of digits can match where its first digit does not.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return (sum(values[::2]) + sum(sum(divmod(2 * v, 10)) for v in values[1::2])) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the email pattern, found from their ``@`` (linear in any text)."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind, then start."""
    out = [("email", s, e) for s, e in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = re.sub(r"[\x20-]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return out


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def symbols(text: str) -> np.ndarray:
    """Inputs of the network: ASCII as it is, other code points as one symbol."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.minimum(points, 128).astype(np.int64)


# --- the network -----------------------------------------------------------

def initial(seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    w = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    p = {"embed": rng.standard_normal((SYMBOLS, EMBED)).astype(np.float32) * np.float32(0.3)}
    for side in ("f", "b"):
        p |= {f"x{side}": w(EMBED, 4 * HIDDEN), f"h{side}": w(HIDDEN, 4 * HIDDEN), f"c{side}": np.zeros(4 * HIDDEN, np.float32)}
        p[f"c{side}"][HIDDEN:2 * HIDDEN] = 1  # the gate that keeps the cell is open at first
    return p | {"out": w(2 * HIDDEN, TAGS), "bias": np.zeros(TAGS, np.float32), "step": np.zeros((TAGS, TAGS), np.float32)}


def _gate(z):
    """A straight line in place of the logistic curve, cut at 0 and 1."""
    return np.clip(z * np.float32(0.25) + np.float32(0.5), 0, 1)


def _squash(z):
    """A straight line in place of the hyperbolic tangent, cut at -1 and 1."""
    return np.clip(z, -1, 1)


def _lstm(p, side, e, keep=None):
    """Hidden states (T, N, HIDDEN) of the inputs (T, N, EMBED), in time order of the inputs."""
    steps, n, _ = e.shape
    gates = e @ p[f"x{side}"] + p[f"c{side}"]
    h = c = np.zeros((n, HIDDEN), np.float32)
    out = np.empty((steps, n, HIDDEN), np.float32)
    for t in range(steps):
        z = gates[t] + h @ p[f"h{side}"]
        s = _gate(z[:, :3 * HIDDEN])
        i, f, o = s[:, :HIDDEN], s[:, HIDDEN:2 * HIDDEN], s[:, 2 * HIDDEN:]
        g = _squash(z[:, 3 * HIDDEN:])
        before, c = c, f * c + i * g
        tc = _squash(c)
        if keep is not None:
            keep.append((h, before, i, f, o, g, tc))
        h = o * tc
        out[t] = h
    return out


def _lstm_back(p, side, e, kept, dout, grad):
    steps, n, _ = e.shape
    dz = np.empty((steps, n, 4 * HIDDEN), np.float32)
    dh, dc = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    for t in reversed(range(steps)):
        h, before, i, f, o, g, tc = kept[t]
        dh = dh + dout[t]
        dc = dc + dh * o * (np.abs(tc) < 1)
        slope = lambda x: np.where((x > 0) & (x < 1), np.float32(0.25), np.float32(0))
        dz[t] = np.concatenate((dc * g * slope(i), dc * before * slope(f), dh * tc * slope(o), dc * i * (np.abs(g) < 1)), 1)
        grad[f"h{side}"] += h.T @ dz[t]
        dh, dc = dz[t] @ p[f"h{side}"].T, dc * f
    grad[f"x{side}"] += np.einsum("tne,tng->eg", e, dz)
    grad[f"c{side}"] += dz.sum((0, 1))
    return dz @ p[f"x{side}"].T


def _states(p, side, x, active):
    """Hidden states as ``_lstm`` gives them, of symbols (T, N), of which the first ``active[t]`` count at t.

    The four gates lie one behind the other, (4, N, HIDDEN), so that every step runs over whole
    blocks of memory; the bounds are as large as they are for the same reason.
    """
    gates = lambda m: np.ascontiguousarray(m.reshape(-1, 4, HIDDEN).swapaxes(0, 1))
    scale = np.repeat(np.float32([0.25, 1]), (3 * HIDDEN, HIDDEN))
    shift = np.repeat(np.float32([0.5, 0]), (3 * HIDDEN, HIDDEN))
    table = gates((p["embed"] @ p[f"x{side}"] + p[f"c{side}"]) * scale + shift)
    turn = gates(p[f"h{side}"] * scale)
    n = x.shape[1]
    low, high = np.zeros((4, n, HIDDEN), np.float32), np.ones((4, n, HIDDEN), np.float32)
    low[3] = -1
    h = c = np.zeros((n, HIDDEN), np.float32)
    out = np.zeros((*x.shape, HIDDEN), np.float32)
    for t, m in enumerate(active.tolist()):
        z = h[:m] @ turn
        z += table.take(x[t, :m], 1)
        np.maximum(z, low[:, :m], out=z)
        np.minimum(z, high[:, :m], out=z)
        i, f, o, g = z
        g *= i
        f *= c[:m]
        c = np.add(f, g, out=f)
        cut = np.minimum(c, high[3, :m], out=g)
        h = np.multiply(o, np.maximum(cut, low[3, :m], out=cut), out=out[t, :m])
    return out


def scores(p: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Tag scores (N, T, TAGS) of windows of symbols (N, T), all of them whole."""
    return window_scores(p, x.T, np.full(len(x), x.shape[1])).swapaxes(0, 1)


def window_scores(p: dict[str, np.ndarray], x: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Tag scores (T, N, TAGS) of windows of symbols (T, N), longest first, of which the first ``size`` count."""
    steps, full = np.arange(x.shape[0]), size[-1] == x.shape[0]
    active = np.full(len(steps), x.shape[1]) if full else np.searchsorted(-size, -steps, "left")
    # Each window turned round for the other direction: its last symbol first.
    turned = None if full else np.where(steps[:, None] < size, size - 1 - steps[:, None], steps[:, None])
    turn = (lambda v: v[::-1]) if full else lambda v: v[turned, np.arange(len(size))]
    s = _states(p, "f", x, active) @ p["out"][:HIDDEN]
    s += turn(_states(p, "b", turn(x), active) @ p["out"][HIDDEN:])
    s += np.tile(p["bias"], (x.shape[1], 1))
    return s


def _logsum(x, axis):
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def _crf_gradient(s, y, step):
    """(loss, d loss / d s, d loss / d step); s (T, N, TAGS), y (T, N), mean over windows."""
    steps, n, _ = s.shape
    a, b = np.empty_like(s), np.zeros_like(s)
    a[0] = s[0]
    for t in range(1, steps):
        a[t] = _logsum(a[t - 1][:, :, None] + step, 1) + s[t]
    for t in reversed(range(steps - 1)):
        b[t] = _logsum(step + (s[t + 1] + b[t + 1])[:, None, :], 2)
    z = _logsum(a[-1], 1)
    ds = np.exp(a + b - z[:, None])
    pair = np.exp(a[:-1, :, :, None] + step + (s[1:] + b[1:])[:, :, None, :] - z[:, None, None]).sum((0, 1))
    at = np.arange(n)
    gold = s[0][at, y[0]]
    for t in range(steps):
        ds[t, at, y[t]] -= 1
        if t:
            gold = gold + s[t][at, y[t]] + step[y[t - 1], y[t]]
            np.subtract.at(pair, (y[t - 1], y[t]), 1)
    return float((z - gold).mean()), ds / n, pair / n


def train(x: np.ndarray, y: np.ndarray, steps: int = STEPS, batch: int = 64, rate: float = 0.02) -> dict[str, np.ndarray]:
    """Weights fitted to windows of symbols (N, T) and tags (N, T)."""
    p = initial()
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    rng, count = np.random.default_rng(11), 0
    while count < steps:
        order = rng.permutation(len(x))
        for at in range(0, len(x), batch)[:steps - count]:
            xs, ys = x[order[at:at + batch]].T, y[order[at:at + batch]].T
            e, kf, kb = p["embed"][xs], [], []
            both = np.concatenate((_lstm(p, "f", e, kf), _lstm(p, "b", e[::-1], kb)[::-1]), 2)
            _, ds, dstep = _crf_gradient(both @ p["out"] + p["bias"], ys, p["step"])
            grad = {k: np.zeros_like(v) for k, v in p.items()}
            grad["step"], grad["bias"] = dstep, ds.sum((0, 1))
            grad["out"] = np.einsum("tnh,tnk->hk", both, ds)
            dboth = (ds @ p["out"].T).astype(np.float32)
            de = _lstm_back(p, "f", e, kf, dboth[:, :, :HIDDEN], grad)
            de = de + _lstm_back(p, "b", e[::-1], kb, dboth[::-1, :, HIDDEN:], grad)[::-1]
            np.add.at(grad["embed"], xs, de)
            count += 1
            speed = rate * (1.0 if count <= steps * 2 // 3 else 0.4)
            for k, g in grad.items():
                g = np.clip(g, -1, 1)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                p[k] = (p[k] - speed * (first[k] / (1 - 0.9 ** count)) / (np.sqrt(second[k] / (1 - 0.999 ** count)) + 1e-8)).astype(np.float32)
    return p


def viterbi(s: np.ndarray, step: np.ndarray, length: np.ndarray | None = None, inner: np.ndarray | None = None) -> np.ndarray:
    """Best tags (N, T) of scores (N, T, TAGS), of which the first ``length`` count.

    ``inner`` (N, 2) tells where a tag 0 stands before and behind the scores.
    """
    n, steps, _ = s.shape
    length = np.full(n, steps) if length is None else length
    inner = np.zeros((n, 2), bool) if inner is None else inner
    best, back = s[:, 0] + inner[:, :1] * step[0], np.zeros((steps, n, TAGS), np.int8)
    for t in range(1, steps):
        every = best[:, :, None] + step
        on = (t < length)[:, None]
        back[t] = np.where(on, every.argmax(1), np.arange(TAGS))
        best = np.where(on, every.max(1) + s[:, t], best)
    out = np.empty((steps, n), np.int64)
    out[-1] = (best + inner[:, 1:] * step[:, 0]).argmax(1)
    for t in range(steps - 1, 0, -1):
        out[t - 1] = back[t][np.arange(n), out[t]]
    return out.T


def possible(s: np.ndarray, offs: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Where the best path of a text may have another tag than 0 (everywhere else it has not).

    A run of other tags on the best path is no worse than zeros in its place. Its lead over them is at most
    the sum of ``lead`` over the run, which counts the dearest step between other tags for each character,
    less ``cost``, what it takes to enter and leave the run. A character with no run through it that makes
    up for the cost has tag 0.
    """
    inside, stay, enter, leave = (float(v) for v in (step[1:, 1:].max(), step[0, 0], step[0, 1:].max(), step[1:, 0].max()))
    lead = (np.maximum.reduce([s[:, k] for k in range(1, TAGS)]) - s[:, 0]).astype(np.float64) + (inside - stay)
    some = offs[1:] > offs[:-1]  # the first and the last character of a text need no step on one side
    lead[offs[:-1][some]] += stay - enter
    lead[offs[1:][some] - 1] += stay - leave
    cost = inside + stay - enter - leave
    total = np.concatenate(([0.0], np.cumsum(lead)))
    most = np.maximum.accumulate(total[:0:-1])[::-1]  # of the sums up to the end of a run that holds the character
    least = np.minimum.accumulate(total[:-1])
    return most - least >= cost - 1e-3


def best_tags(s: np.ndarray, offs: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Best tags of texts whose scores (T, TAGS) lie one behind the other, text k from offs[k] to offs[k + 1]."""
    tags = np.zeros(len(s), np.int64)
    open_ = possible(s, offs, step)
    edge = np.zeros(len(s) + 1, bool)
    edge[offs] = True
    before, after = np.concatenate(([False], open_[:-1])), np.concatenate((open_[1:], [False]))
    lo = np.flatnonzero(open_ & (~before | edge[:-1]))
    hi = np.flatnonzero(open_ & (~after | edge[1:])) + 1
    inner = np.stack((~edge[lo], ~edge[hi]), 1)
    order = np.argsort(hi - lo, kind="stable")
    at = 0
    while at < len(order):
        longest = 2 * (hi - lo)[order[at]]
        end = min(int(np.searchsorted((hi - lo)[order], longest, "right")), at + max(1, (1 << 18) // int(longest)))
        part = order[at:end]
        size = (hi - lo)[part]
        places = lo[part][:, None] + np.arange(size.max())
        inside = np.arange(size.max()) < size[:, None]
        found = viterbi(s[np.where(inside, places, 0)], step, size, inner[part])
        tags[places[inside]] = found[inside]
        at = end
    return tags


# --- windows ---------------------------------------------------------------

def stretches(text: str) -> list[tuple[int, int]]:
    """Parts of the text within ``REACH`` characters of a digit or ``@``."""
    out: list[list[int]] = []
    for m in _TRIGGER.finditer(text):
        lo, hi = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if out and lo <= out[-1][1]:
            out[-1][1] = hi
        else:
            out.append([lo, hi])
    return [(a, b) for a, b in out]


def _rewritten(kind: str, span: str, key: int) -> str:
    """Another way to write personal data of this kind (even keys leave it as it is)."""
    if key % 2 == 0:
        return span
    way = key // 2 % 3
    if kind == "email":
        return (span.replace("@", " @ "), span.replace("@", "(at)"), span.replace("@", " at ").replace(".", " dot "))[way]
    if kind == "ip":
        return (span.replace(".", " . "), span.replace(".", "-"), span.replace(".", "[.]"))[way]
    digits = re.sub(r"[^0-9]", "", span)
    if kind == "card":
        return (".", "/", "_")[way].join(digits[i:i + 4] for i in range(0, len(digits), 4))
    return (span.lstrip("+"), digits, span.replace(" ", "/").lstrip("+"))[way]


def _number(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=6).digest(), "little")


def training_windows(text: str) -> Iterator[tuple[int, str, bytes, bool]]:
    """(hash, window, its tags as bytes, whether it is plain) around every stretch's first base span or trigger, and some plain ones without either."""
    spans = base_spans(text)
    if text:
        key = _number(text)
        for at in (key % len(text), key // len(text) % len(text), max(0, len(text) - 1 - key % WIDTH)):
            plain = text[at:at + WIDTH].ljust(WIDTH)
            if not _TRIGGER.search(plain):
                yield _number(plain), plain, bytes(WIDTH), True
    for lo, hi in stretches(text):
        inside = sorted(((s, e, k) for k, s, e in spans if lo <= s and e <= hi), key=lambda x: (x[0], -x[1]))
        key = _number(text[lo:hi])
        head, tail = max(0, lo - key % 16), min(len(text), hi + WIDTH)
        out, tags, at = "", [], head
        for s, e, k in inside:
            if s < at:
                continue
            new = _rewritten(k, text[s:e], key)
            tags += [0] * (s - at) + [KINDS.index(k) + 1] * len(new)
            out, at = out + text[at:s] + new, e
        out += text[at:tail]
        tags += [0] * (tail - at)
        out, tags = out[:WIDTH].ljust(WIDTH), (tags + [0] * WIDTH)[:WIDTH]
        yield key, out, bytes(tags), False


def _window_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [w for text in texts_of(batch.column("text")) for w in training_windows(text)]
        # No more than the bound can be among the smallest of all.
        rows = [r for plain, most in BOUNDS for r in sorted({r for r in rows if r[3] == plain})[:most]]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()),
             pa.array([r[2] for r in rows], pa.binary()), pa.array([r[3] for r in rows], pa.bool_())],
            names=["key", "window", "tags", "plain"])


def fit(docs: DataFrame, text_col: str = "text") -> dict[str, np.ndarray] | None:
    """Weights of the model, from the ``TRAIN_WINDOWS`` windows and ``PLAIN_WINDOWS`` plain ones with the smallest hashes."""
    every = written(renamed(docs, {text_col: "text"}).mapInArrow(
        _window_batches, "key long, window string, tags binary, plain boolean").distinct(), "windows")
    rows = pa.concat_tables(every.where(F.col("plain") == plain).orderBy("key", "window").limit(most).toArrow()
                            for plain, most in BOUNDS)
    if not rows.num_rows:
        return None
    x = np.stack([symbols(w) for w in rows.column("window").to_pylist()])
    y = np.stack([np.frombuffer(t, np.uint8) for t in rows.column("tags").to_pylist()]).astype(np.int64)
    return train(x, y)


def model_spans(p: dict[str, np.ndarray], texts: list[str]) -> list[list[tuple[str, int, int]]]:
    """Spans of the model in each text, sure ones only."""
    found: list[list[tuple[str, int, int]]] = []
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= SLICE_CHARS):
            size += len(texts[end])
            end += 1
        found += _decoded(p, texts[at:end])
        at = end
    return found


def stitched(p: dict[str, np.ndarray], texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(scores of all characters, offsets of the texts), from windows of ``SPAN`` characters that overlap by ``OVERLAP``."""
    sizes = np.array([len(t) for t in texts])
    offs = np.concatenate(([0], np.cumsum(sizes)))
    x = symbols("".join(texts)).astype(np.int16)
    stride = SPAN - OVERLAP
    counts = np.where(sizes > 0, np.maximum(1, -(-(sizes - OVERLAP) // stride)), 0)
    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    first = np.repeat(offs[:-1], counts) + stride * nth
    size = np.minimum(SPAN, np.repeat(offs[1:], counts) - first)
    order = np.argsort(-size, kind="stable")
    first, size = first[order], size[order]
    # Each character is scored by the window that has it furthest from an edge.
    own, last = nth[order], (first + size == np.repeat(offs[1:], counts)[order])
    lo_zone, hi_zone = np.where(own > 0, OVERLAP // 2, 0), np.where(last, size, SPAN - OVERLAP // 2)
    out = np.empty((len(x), TAGS), np.float32)
    whole = int((size == SPAN).sum())
    cuts = [*range(0, whole, WINDOWS), *range(whole, len(first), WINDOWS), len(first)]
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        at, n = first[lo:hi], size[lo:hi]
        place = np.minimum(at + np.arange(n[0])[:, None], len(x) - 1)
        each = np.ascontiguousarray(window_scores(p, x[place], n).swapaxes(0, 1))
        for k, (start, a, b) in enumerate(zip(at.tolist(), lo_zone[lo:hi].tolist(), hi_zone[lo:hi].tolist(), strict=True)):
            out[start + a:start + b] = each[k, a:b]
    return out, offs


def _decoded(p, texts: list[str]) -> list[list[tuple[str, int, int]]]:
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    if not any(texts):
        return out
    s, offs = stitched(p, texts)
    tags = best_tags(s, offs, p["step"])
    edge = np.ones(len(s) + 1, bool)
    edge[1:-1] = tags[1:] != tags[:-1]
    edge[offs] = True
    places = np.flatnonzero(edge)
    for lo, hi in zip(places[:-1].tolist(), places[1:].tolist(), strict=True):
        tag = tags[lo]
        if not tag:
            continue
        e = np.exp(s[lo:hi] - s[lo:hi].max(1, keepdims=True))
        if (e[:, tag] / e.sum(1)).mean() < SURE:
            continue
        i = int(np.searchsorted(offs, lo, "right")) - 1
        lo, hi = lo - offs[i], hi - offs[i]
        piece = texts[i][lo:hi]
        lo, hi = int(lo + len(piece) - len(piece.lstrip())), int(hi - len(piece) + len(piece.rstrip()))
        if hi - lo >= LEAST_CHARS:
            out[i].append((KINDS[tag - 1], lo, hi))
    return out


def all_spans(p, texts: list[str]) -> list[tuple[list, list]]:
    """(base spans, added spans) of each text."""
    added = model_spans(p, texts) if p else [[] for _ in texts]
    out = []
    for text, more in zip(texts, added, strict=True):
        base = base_spans(text)
        out.append((base, [m for m in more if all(m[2] <= s or e <= m[1] for _, s, e in base)]))
    return out


def by_kind(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def _batch_spans(p, column: pa.Array) -> list[tuple[list, list]]:
    return all_spans(p, texts_of(column))


def find(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, counts of base spans, base (joined), spans (joined, with the model's), n_added of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _batch_spans(shared.value, batch.column("text"))
            counts = [pa.array([sum(s[0] == kind for s in base) for base, _ in found], pa.int64()) for kind in KINDS]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *counts, pa.array([joined(by_kind(base)) for base, _ in found], pa.string()),
                 pa.array([joined(by_kind(base + more)) for base, more in found], pa.string()),
                 pa.array([len(more) for _, more in found], pa.int64())],
                names=["doc_id", *(f"n_{kind}" for kind in KINDS), "base", "spans", "n_added"])

    return renamed(docs, {id_col: "doc_id", text_col: "text"}).mapInArrow(
        run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, spans string, n_added long")


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, model, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; ``n_chars`` follows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            texts = batch.column(at).to_pylist()
            for i, (base, more) in enumerate(_batch_spans(shared.value, batch.column(at))):
                if base or more:
                    texts[i] = masked(texts[i], base + more)
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    out = docs.mapInArrow(run, T.StructType(docs.schema.fields))
    return out.withColumn("n_chars", F.length(text_col).cast("long")) if "n_chars" in docs.columns else out
