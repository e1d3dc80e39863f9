"""Language-model scores: smoothed word counts and a causal self-attention model.

A text is its words ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased, then one end
token. Documents whose crc32(id as text) mod 5 is 1 are held out; the others
are learnt from.

* Base score: log10 of (c + 0.5) / (N + 0.5 (V + 1)) for each token.
* Model: the text as subword ids: each word is cut into the longest pieces of a
  public vocabulary from left to right (pieces that end a word say so), and the
  end token stands last. A causal self-attention layer in numpy predicts every id
  from up to ``WINDOW`` ids before it; the score is the sum of log10 P(id | ids
  before), the logarithm of a probability over all texts cut in this way. Every
  id that a learnt text has is a class of its own, whatever their number K; the
  others share one class, in which they are equally likely; the end token has its
  own.
* Two-level softmax: classes by falling frequency are cut into groups of about
  sqrt K; P(class) = P(group) P(class | group), so an id costs about 2 sqrt K
  exponentials. Logits are held within ``LIMIT``.
* Overlapping windows: each starts ``STRIDE`` ids after the one before; an
  id is scored once, with at least ``WINDOW - STRIDE`` ids of context
  (fewer only at the start of the text). The output layers are computed for the
  scored places only.
* Counts cover all learning documents: each task sums its words, Spark sums
  the sums. The most frequent words, at most ``HEAD``, travel to the tasks; the
  others are joined by fingerprint, after being counted per document.
* Class sequences are written once; training and scoring read them, not texts.
* Training: one pass over all learning documents, dealt by a hash of id and
  text to ``TRAIN_EVERY`` rounds; in a round each task runs Adam over its share
  of the round's documents, in windows that follow each other without overlap
  (each id is learnt from once), and the weights are averaged by ids seen.
  So the weights, and the model's score, depend on how rows fall into tasks.

Defined results: null and empty texts are the end token alone; a null id
counts as the empty string for the hold-out rule; repeated rows are scored and
counted each; without learning documents all ids share one class; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, materialise, text_or_empty
from .kernels import Powers, Words, distinct, is_word_byte_table, slices, string_parts, sums_before
from .token_counts import END, Automaton, lower_ascii, vocabulary

WINDOW, STRIDE = 32, 24
WIDTH, HIDDEN = 16, 32
HEAD = 200_000
TRAIN_EVERY, BATCH, RATE = 3, 64, 0.01
LEAST, STEPS = 8, 64
SCORE_BATCH = 128
PIECES_KEPT, SHORT = 500_000, 64
LIMIT = np.float32(60)
PIECE = 1 << 14
CODE, CODE_SLICE = np.dtype("<u4"), 1 << 19


def held_out(doc_id: Column) -> Column:
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(F.encode(text, "UTF-8")) % 5 == 1


class Pieces:
    """Subword ids of words: the longest piece that matches (with the word's end
    mark), then the longest that follows, to the end. An end mark that is left
    alone is an id of its own, ``len(pieces)``; a byte that no piece starts with
    is ``len(pieces) + 1``."""

    def __init__(self, pieces: list[tuple[int, ...]]):
        self.step = Automaton(pieces).step
        self.piece_at = [-1] * (1 + max(self.step.values(), default=0))
        for number, piece in enumerate(pieces):
            at = 0
            for s in piece:
                at = self.step[at * 257 + s]
            self.piece_at[at] = number
        self.lone_end, self.unknown = len(pieces), len(pieces) + 1
        self.kind = np.dtype(np.uint16 if len(pieces) + 2 <= 1 << 16 else np.uint32)
        self.known: dict[int, bytes] = {}
        moves = sorted(self.step.items())  # the same steps for many words at once
        self.move, self.to = (np.array([m[i] for m in moves], np.int64) for i in (0, 1))
        self.piece_of = np.array(self.piece_at, np.int64)

    def __len__(self) -> int:
        return self.unknown + 1

    def find(self, word: bytes) -> list[int]:
        step, piece_at = self.step.get, self.piece_at
        symbols, out, begin = (*word, END), [], 0
        n = len(symbols)
        while begin < n:
            best, i = -1, begin
            at = step(symbols[i])
            while at is not None:
                i += 1
                if piece_at[at] >= 0:
                    best, stop = piece_at[at], i
                if i == n:
                    break
                at = step(at * 257 + symbols[i])
            if best < 0:
                best, stop = self.lone_end if symbols[begin] == END else self.unknown, begin + 1
            out.append(best)
            begin = stop
        return out

    def find_all(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``find`` of the words ``raw[start:end]``, all a symbol at a time: ids
        of one word after another, and the ids before each word."""
        word, begin, i, stop = np.arange(len(start)), start.copy(), start.copy(), start.copy()
        at, best, found = np.zeros(len(start), np.int64), np.full(len(start), -1), []
        while len(word):
            key = at * 257 + np.where(i < end, raw[np.minimum(i, len(raw) - 1)].astype(np.int64), END)
            move = np.minimum(np.searchsorted(self.move, key), len(self.move) - 1)
            goes = (self.move[move] == key) & (i <= end)
            at = np.where(goes, self.to[move], 0)
            i += goes
            piece = np.where(goes, self.piece_of[at], -1)
            best, stop = np.where(piece >= 0, piece, best), np.where(piece >= 0, i, stop)
            halt = np.flatnonzero(~goes)
            none = halt[best[halt] < 0]
            best[none], stop[none] = np.where(begin[none] == end[none], self.lone_end, self.unknown), begin[none] + 1
            found.append((word[halt], best[halt]))
            best[halt], begin[halt], i[halt] = -1, stop[halt], stop[halt]
            left = begin <= end
            if not left.all():
                word, begin, i, stop, at, best, end = (x[left] for x in (word, begin, i, stop, at, best, end))
        owner, ids = (np.concatenate(x) for x in zip(*found, strict=True))
        return ids[np.argsort(owner, kind="stable")], sums_before(np.bincount(owner, minlength=len(start)))

    def of(self, w: Words, key: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words at positions ``at`` with fingerprints ``key``, one
        word after another, and the ids before each word."""
        if len(self.known) + len(key) > PIECES_KEPT:
            self.known.clear()
        keys = key.tolist()
        out = list(map(self.known.get, keys))
        new = np.array([n for n, p in enumerate(out) if p is None], np.int64)
        short = w.end[at[new]] - w.start[at[new]] <= (SHORT if len(self.move) else -1)
        for n in new[~short].tolist():
            out[n] = self.known[keys[n]] = np.array(self.find(w.word(at[n])), self.kind).tobytes()
        new = new[short]
        if len(new):
            ids, before = self.find_all(w.raw, w.start[at[new]], w.end[at[new]])
            ids, before = ids.astype(self.kind).tobytes(), (before * self.kind.itemsize).tolist()
            for n, (a, b) in zip(new.tolist(), itertools.pairwise(before), strict=True):
                out[n] = self.known[keys[n]] = ids[a:b]
        before = sums_before(np.fromiter(map(len, out), np.int64, len(out)) // self.kind.itemsize)
        return np.frombuffer(b"".join(out), self.kind).astype(np.int64), before


# --- the model -------------------------------------------------------------


def group_size(classes: int) -> int:
    return math.isqrt(max(0, classes - 1)) + 1


def shapes(classes: int) -> dict[str, tuple[int, ...]]:
    """Shapes of the weights for ``classes`` classes, the last two for ids
    that no learnt text has and for the end token. The last row of each matrix
    of ``member`` is its bias."""
    m = group_size(classes)
    groups = -(-classes // m)
    return {
        "token": (classes + 1, WIDTH),  # the last row: start of text
        "place": (WINDOW, WIDTH),
        "qkv": (WIDTH, 3 * WIDTH),
        "out": (WIDTH, WIDTH),
        "up": (WIDTH, HIDDEN),
        "up_bias": (HIDDEN,),
        "down": (HIDDEN, WIDTH),
        "group": (WIDTH, groups),
        "group_bias": (groups,),
        "member": (groups, WIDTH + 1, m),
    }


def first_weights(class_counts: np.ndarray, seed: int = 1) -> dict[str, np.ndarray]:
    """Small random weights; the output biases are log frequencies of the groups
    and of the classes in them. Places of the last group that no class has get
    a bias below the limit."""
    rng = np.random.default_rng(seed)
    shape = shapes(len(class_counts))
    w = {k: rng.normal(0, 0.1 if len(s) > 1 else 0, s).astype(np.float32) for k, s in shape.items()}
    groups, _, m = shape["member"]
    p = np.zeros(groups * m)
    p[: len(class_counts)] = class_counts + 0.5
    p = p.reshape(groups, m)
    total = p.sum(axis=1)
    w["group_bias"] = np.log(total / total.sum()).astype(np.float32)
    w["member"][:, WIDTH] = np.where(p > 0, np.log(np.maximum(p, 0.5) / total[:, None]), -1e9)
    return w


def flat(w: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([x.ravel() for x in w.values()])


def unflat(x: np.ndarray, classes: int) -> dict[str, np.ndarray]:
    """The weights as views of ``x``."""
    out, at = {}, 0
    for k, s in shapes(classes).items():
        n = math.prod(s)
        out[k] = x[at : at + n].reshape(s)
        at += n
    return out


def _past() -> np.ndarray:
    """1 where a place may look: itself and the places before."""
    return np.tril(np.ones((WINDOW, WINDOW), np.float32))


def _held(x: np.ndarray) -> np.ndarray:
    """``x`` within the limit; to look for its ends is cheaper than to clip it."""
    return x if x.size and -LIMIT <= x.min() and x.max() <= LIMIT else np.clip(x, -LIMIT, LIMIT, out=x)


def _by_radix(x: np.ndarray, below: int) -> np.ndarray:
    """The stable order of ``x``; numpy sorts numbers of 16 bits by radix."""
    return np.argsort(x.astype(np.uint16) if below <= 1 << 16 else x, kind="stable")


def _sums(x: np.ndarray) -> np.ndarray:
    """Sums over the last axis, as a column."""
    return x @ np.ones((x.shape[-1], 1), x.dtype)


def forward(w: dict[str, np.ndarray], inputs: np.ndarray, past: np.ndarray, wanted: np.ndarray) -> dict[str, np.ndarray]:
    """``y``, the features of the places numbered ``wanted`` of the windows
    (n, WINDOW), and what their gradients need."""
    n = len(inputs)
    x = w["token"].take(inputs.ravel(), axis=0).reshape(n, WINDOW, WIDTH)
    x += w["place"]
    qkv = (x.reshape(-1, WIDTH) @ w["qkv"]).reshape(n, WINDOW, 3 * WIDTH)
    q, k, v = qkv[..., :WIDTH], qkv[..., WIDTH : 2 * WIDTH], qkv[..., 2 * WIDTH :]
    a = np.matmul(q, k.transpose(0, 2, 1))
    a *= np.float32(WIDTH**-0.5)
    np.exp(_held(a), out=a)
    a *= past
    a /= _sums(a)
    o = np.matmul(a, v).reshape(-1, WIDTH).take(wanted, axis=0)
    h = x.reshape(-1, WIDTH).take(wanted, axis=0)
    h += o @ w["out"]
    z = h @ w["up"]
    z += w["up_bias"]
    np.maximum(z, 0, out=z)
    return {"x": x, "q": q, "k": k, "v": v, "a": a, "o": o, "h": h, "z": z, "y": h + z @ w["down"]}


def two_levels(w: dict[str, np.ndarray], y: np.ndarray, targets: np.ndarray) -> dict[str, np.ndarray]:
    """Unnormalised probabilities of the groups, and of the members of each
    target's group; rows of the second stand in the order ``order``, in which
    group g takes rows a to b for each (g, a, b) of ``spans``."""
    groups, _, m = w["member"].shape
    group, member = np.divmod(targets, m)
    top = y @ w["group"]
    top += w["group_bias"]
    order = _by_radix(group, groups)
    bounds = sums_before(np.bincount(group, minlength=groups))
    ys = np.ones((len(y), WIDTH + 1), y.dtype)
    ys[:, :WIDTH] = y.take(order, axis=0)
    inner = np.empty((len(y), m), y.dtype)
    spans = [(g, a, b) for g, (a, b) in enumerate(itertools.pairwise(bounds.tolist())) if a < b]
    for g, a, b in spans:
        np.dot(ys[a:b], w["member"][g], inner[a:b])
    _held(inner[bounds[groups - 1] :])  # its places that no class has
    row, member = np.arange(len(y)), member[order]
    picked_top, picked_inner = _held(top)[row, group], _held(inner)[row, member]
    np.exp(top, out=top)
    np.exp(inner, out=inner)
    return {
        "group": group, "member": member, "order": order, "spans": spans, "ys": ys, "top": top, "inner": inner,
        "top_sum": _sums(top), "inner_sum": _sums(inner), "picked_top": picked_top, "picked_inner": picked_inner,
    }


def log_probability(w: dict[str, np.ndarray], inputs: np.ndarray, targets: np.ndarray, counted: np.ndarray, past: np.ndarray) -> np.ndarray:
    """Natural log of P(target) at each counted place, one after another."""
    wanted = np.flatnonzero(counted)
    t = two_levels(w, forward(w, inputs, past, wanted)["y"], targets.ravel()[wanted])
    out = t["picked_top"] - np.log(t["top_sum"][:, 0])
    out[t["order"]] += t["picked_inner"] - np.log(t["inner_sum"][:, 0])
    return out


def gradients(w: dict[str, np.ndarray], inputs: np.ndarray, targets: np.ndarray, counted: np.ndarray, past: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the mean negative log probability over the counted places."""
    wanted = np.flatnonzero(counted)
    f = forward(w, inputs, past, wanted)
    t = two_levels(w, f["y"], targets.ravel()[wanted])
    n, each, row = len(inputs), f["y"].dtype.type(1 / max(1, len(wanted))), np.arange(len(wanted))
    top, inner, order, spans, ys = (t[k] for k in ("top", "inner", "order", "spans", "ys"))
    top *= each / t["top_sum"]
    top[row, t["group"]] -= each
    inner *= each / t["inner_sum"]
    inner[row, t["member"]] -= each
    g = {"group": f["y"].T @ top, "group_bias": top.sum(axis=0), "member": np.zeros_like(w["member"])}
    dy = top @ w["group"].T
    dys = np.empty((len(ys), WIDTH), ys.dtype)
    for i, a, b in spans:
        np.dot(ys[a:b].T, inner[a:b], g["member"][i])
        np.dot(inner[a:b], w["member"][i, :WIDTH].T, dys[a:b])
    dy[order] += dys
    g["down"] = f["z"].T @ dy
    dz = dy @ w["down"].T
    dz *= f["z"] > 0
    g["up"], g["up_bias"] = f["h"].T @ dz, dz.sum(axis=0)
    dy += dz @ w["up"].T
    g["out"] = f["o"].T @ dy
    at = np.full(n * WINDOW, len(wanted))  # of a place that is not counted: the zeros after the others
    at[wanted] = row
    none = np.zeros((1, WIDTH), dy.dtype)
    do, dh = (np.concatenate([x, none]).take(at, axis=0) for x in (dy @ w["out"].T, dy))
    do = do.reshape(n, WINDOW, WIDTH)
    da = np.matmul(do, f["v"].transpose(0, 2, 1))
    dv = np.matmul(f["a"].transpose(0, 2, 1), do)
    ds = np.multiply(f["a"], da, out=da)
    ds -= f["a"] * _sums(ds)
    ds *= np.float32(WIDTH**-0.5)
    dqkv = np.concatenate([np.matmul(ds, f["k"]), np.matmul(ds.transpose(0, 2, 1), f["q"]), dv], axis=2).reshape(-1, 3 * WIDTH)
    g["qkv"] = f["x"].reshape(-1, WIDTH).T @ dqkv
    dh += dqkv @ w["qkv"].T
    by_token = _by_radix(inputs.ravel(), len(w["token"]))
    token = inputs.ravel()[by_token]
    starts = np.flatnonzero(np.diff(token, prepend=-1))
    g["token"] = np.zeros_like(w["token"])
    g["token"][token[starts]] = np.add.reduceat(dh.take(by_token, axis=0), starts, axis=0)
    g["place"] = dh.reshape(n, WINDOW, WIDTH).sum(axis=0)
    return {k: g[k] for k in w}


class Adam:
    """Steps of the weights ``w``, which become views of one vector; a piece of
    it at a time, so that what a step makes stays in the processor's cache."""

    def __init__(self, w: dict[str, np.ndarray], rate: float = RATE):
        self.rate, self.t, self.x = rate, 0, flat(w)
        self.m, self.s, self.held = np.zeros_like(self.x), np.zeros_like(self.x), np.empty(PIECE, self.x.dtype)
        w |= unflat(self.x, len(w["token"]) - 1)

    def step(self, g: dict[str, np.ndarray]) -> None:
        self.t += 1
        rate, of_s = np.float32(self.rate / (1 - 0.9**self.t)), np.float32(1 - 0.99**self.t)
        slope = flat(g)
        for at in range(0, len(slope), PIECE):
            x, m, s, d = (v[at : at + PIECE] for v in (self.x, self.m, self.s, slope))
            h = self.held[: len(d)]
            np.subtract(d, m, out=h)
            h *= np.float32(0.1)
            m += h
            d *= d
            d -= s
            d *= np.float32(0.01)
            s += d
            np.divide(s, of_s, out=h)
            np.sqrt(h, out=h)
            h += np.float32(1e-8)
            np.divide(m, h, out=h)
            h *= rate
            x -= h


def windows(codes: np.ndarray, first: np.ndarray, classes: int, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(inputs, targets, counted, text) of the overlapping windows of texts
    whose class sequences stand one after another; ``counted`` marks the places
    that a window scores."""
    n = np.diff(first)
    count = 1 + np.maximum(0, -(-(n - WINDOW) // stride))
    before = sums_before(count)
    text = np.repeat(np.arange(len(n)), count)
    begin = (np.arange(before[-1]) - before[text]) * stride
    at = begin[:, None] + np.arange(WINDOW)[None, :]
    inside = at < n[text][:, None]
    overlap = np.where(begin > 0, WINDOW - stride, 0)[:, None]
    counted = inside & (np.arange(WINDOW)[None, :] >= overlap)
    place = np.where(inside, first[text][:, None] + at, 0)
    targets = codes[place] if len(codes) else np.zeros(place.shape, np.int64)
    previous = codes[np.maximum(place - 1, 0)] if len(codes) else targets
    inputs = np.where(inside & (at > 0), previous, np.where(at == 0, classes, classes - 1))
    return inputs, targets, counted, text


# --- the passes over the corpus ---------------------------------------------


def with_ends(values: np.ndarray, first: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequences one after another, each with ``end`` appended."""
    out = np.insert(values, first[1:], end)
    return out, first + np.arange(len(first))


def _count_rows(pieces):
    """(fingerprint, null, count) of the words and (null, id, count) of their
    subword ids, summed per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        subwords = pieces.value
        powers, inside, lower = Powers(), is_word_byte_table(), lower_ascii()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size, ids = 0, np.zeros(len(subwords), np.int64)

        def summed() -> tuple[np.ndarray, np.ndarray]:
            key, n = (np.concatenate(x) for x in zip(*held, strict=True))
            key, _, inverse = distinct(key)
            return key, np.bincount(inverse, weights=n, minlength=len(key)).astype(np.int64)

        def rows(key, piece, n):
            return pa.RecordBatch.from_arrays([key, piece, pa.array(n)], ["key", "piece", "n"])

        def words(key, n):
            return rows(pa.array(key.view(np.int64)), pa.nulls(len(key), pa.int32()), n)

        for batch in batches:
            for part in slices(batch):
                w = Words(part.column("text"), powers, inside, lower)
                key, at, inverse = distinct(w.key)
                n = np.bincount(inverse, minlength=len(key))
                found, before = subwords.of(w, key, at)
                ids += np.bincount(found, weights=np.repeat(n, np.diff(before)), minlength=len(ids)).astype(np.int64)
                held.append((key, n))
                size += len(key)
                if size > 1_500_000:
                    held = [summed()]
                    size = len(held[0][0])
                    if size > 750_000:
                        yield words(*held[0])
                        held, size = [], 0
        if held:
            yield words(*summed())
        seen = np.flatnonzero(ids)
        yield rows(pa.nulls(len(seen), pa.int64()), pa.array(seen.astype(np.int32)), ids[seen])

    return run


def _in_head(key: np.ndarray, head: dict) -> tuple[np.ndarray, np.ndarray]:
    """(place in the head table, is in it) of each fingerprint."""
    keys = head["key"]
    place = np.minimum(np.searchsorted(keys, key), max(0, len(keys) - 1))
    return place, keys[place] == key if len(keys) else np.zeros(len(key), bool)


def _classes_of(w: Words, subwords: Pieces, class_of: np.ndarray, key: np.ndarray, at: np.ndarray, inverse: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes of all subword ids of the texts, in order, and the ids before
    each word; the last three are the distinct words."""
    ids, before = subwords.of(w, key, at)
    first = sums_before(np.diff(before)[inverse])
    place = np.arange(first[-1]) + np.repeat(before[inverse] - first[:-1], np.diff(first))
    return class_of[ids][place], first


ENCODED_SCHEMA = (
    "doc_id long, held_out boolean, round int, n_tokens long, n_head long, log_head double, log_unseen double, classes binary, "
    "rare array<long>, rare_n array<int>"
)


def _encode_rows(pieces, shared):
    """Each text's subword ids as classes, sums over its frequent words, and its
    other words with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, subwords = shared.value, pieces.value
        stop = model["classes"] - 1
        powers, inside, lower = Powers(), is_word_byte_table(), lower_ascii()
        span = lambda values, first: np.diff(sums_before(values)[first])  # noqa: E731  sums per text
        for batch in batches:
            for part in slices(batch):
                words = Words(part.column("text"), powers, inside, lower)
                n = part.num_rows
                key, at, inverse = distinct(words.key)
                place, known = _in_head(key, model)
                log_c = np.where(known, model["log_c"][place], 0.0)[inverse] if len(model["key"]) else np.zeros(len(words))
                known = known[inverse]
                classes, ids_before = _classes_of(words, subwords, model["class_of"], key, at, inverse)
                sequence, first = with_ends(classes, ids_before[words.first], stop)
                unseen = span((sequence == stop - 1).astype(np.int64), first)
                rare = np.flatnonzero(~known)
                owner = words.text_of_word()[rare]
                order = np.argsort(owner * len(key) + inverse[rare])  # by text, then by fingerprint
                key, owner = words.key[rare][order], owner[order]
                new = np.ones(len(key), bool)
                new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
                at = np.flatnonzero(new)
                times = np.diff(np.append(at, len(key))).astype(np.int32)
                offsets = pa.array(np.searchsorted(owner[at], np.arange(n + 1)).astype(np.int32))
                code = pa.py_buffer(sequence.astype(CODE).tobytes())
                ends = pa.py_buffer((first * CODE.itemsize).astype(np.int32).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("held_out"),
                        part.column("round"),
                        pa.array((np.diff(words.first) + 1).astype(np.int64)),
                        pa.array(span(known.astype(np.int64), words.first)),
                        pa.array(span(log_c, words.first)),
                        pa.array(unseen * model["log_unseen"]),
                        pa.Array.from_buffers(pa.binary(), n, [None, ends, code]),
                        pa.ListArray.from_arrays(offsets, pa.array(key[at].view(np.int64))),
                        pa.ListArray.from_arrays(offsets, pa.array(times)),
                    ],
                    ["doc_id", "held_out", "round", "n_tokens", "n_head", "log_head", "log_unseen", "classes", "rare", "rare_n"],
                )

    return run


def _sequences(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, their class sequences one after another, where each starts)."""
    for part in slices(batch, "classes", CODE_SLICE):
        raw, off = string_parts(part.column("classes"))
        yield part, np.frombuffer(raw.tobytes(), CODE).astype(np.int64), off // CODE.itemsize


def _train_rows(weights, classes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        past, w = _past(), unflat(weights.value.astype(np.float32), classes)
        adam, seen = Adam(w), 0
        for batch in batches:
            for _, sequence, first in _sequences(batch):
                inputs, targets, counted, _ = windows(sequence, first, classes, WINDOW)
                order = np.random.default_rng(len(inputs)).permutation(len(inputs))
                size = min(BATCH, max(LEAST, len(order) // STEPS))  # few windows: smaller steps, not too few
                for at in range(0, len(order), size):
                    pick = order[at : at + size]
                    adam.step(gradients(w, inputs[pick], targets[pick], counted[pick], past))
                    seen += int(counted[pick].sum())
        if seen:
            x = np.append(flat(w).astype(np.float64) * seen, seen)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(x), dtype=np.int32)), pa.array(x)], ["place", "value"])

    return run


def _score_rows(weights, classes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        past, w = _past(), unflat(weights.value.astype(np.float32), classes)
        for batch in batches:
            for part, sequence, first in _sequences(batch):
                inputs, targets, counted, text = windows(sequence, first, classes)
                log_model = np.zeros(part.num_rows)
                for at in range(0, len(inputs), SCORE_BATCH):
                    to = at + SCORE_BATCH
                    lp = log_probability(w, inputs[at:to], targets[at:to], counted[at:to], past).astype(np.float64)
                    owner = np.repeat(text[at:to], counted[at:to].sum(axis=1))
                    log_model += np.bincount(owner, weights=lp, minlength=part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(log_model / np.log(10))], ["row", "log_model"])

    return run


def frequent(counts: DataFrame) -> DataFrame:
    """The words above a count such that at most ``HEAD`` remain. The count is
    found from a histogram over logarithmic bins (at most a few hundred rows),
    so no top-k has to merge the lists of all partitions in one task."""
    bin_ = F.floor(F.log2(F.col("c").cast("double")) * 8)
    sizes = counts.groupBy(bin_.alias("bin")).agg(F.count("*").alias("n")).collect()
    lowest, room = None, HEAD
    for row in sorted(sizes, key=lambda r: -r["bin"]):
        room -= row["n"]
        if room < 0:
            break
        lowest = row["bin"]
    return counts.where(F.lit(False) if lowest is None else bin_ >= lowest)


def score(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), text_or_empty(text).alias("text")
    ).withColumn("round", F.pmod(F.xxhash64("doc_id", "text", F.lit("train")), F.lit(TRAIN_EVERY)).cast("int"))
    learn = rows.where("NOT held_out")
    vocab = vocabulary(path)
    pieces = spark.sparkContext.broadcast(Pieces(vocab))  # as large as the vocabulary

    counted = learn.select("text").mapInArrow(_count_rows(pieces), "key long, piece int, n long")
    both_counts = materialise(counted.groupBy("key", "piece").agg(F.sum("n").alias("c")), "counts")
    counts = both_counts.where("key IS NOT NULL").select("key", "c")
    n_learn = learn.count()
    sums = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    total, distinct = sums["n"] + n_learn, sums["v"] + int(n_learn > 0)

    # at most one row per piece of the vocabulary
    by_piece = both_counts.where("key IS NULL").select("piece", "c").toArrow()
    piece, n_piece = (by_piece.column(c).to_numpy().astype(np.int64) for c in ("piece", "c"))
    own = np.lexsort((piece, -n_piece))
    classes = len(own) + 2  # and one for the ids that no learnt text has, one for the end
    class_of = np.full(len(vocab) + 2, classes - 2, np.int64)
    class_of[piece[own]] = np.arange(len(own))
    n_class = np.concatenate([n_piece[own], [0, n_learn]])

    head = frequent(counts).toArrow()  # at most HEAD rows
    key = head.column("key").to_numpy().view(np.uint64)
    by_key = np.argsort(key)
    shared = spark.sparkContext.broadcast(
        {
            "key": key[by_key],
            "log_c": np.log10(head.column("c").to_numpy()[by_key] + 0.5),
            "class_of": class_of,
            "classes": classes,
            "log_unseen": -math.log10(max(1, len(class_of) - len(own))),  # these ids are equally likely
        }
    )

    encoded = rows.mapInArrow(_encode_rows(pieces, shared), ENCODED_SCHEMA)
    encoded = materialise(encoded.withColumn("row", F.monotonically_increasing_id()), "classes")
    for done in (pieces, shared):  # all that used them is written
        done.destroy()

    weights = flat(first_weights(n_class))  # at most 34 numbers per piece of the vocabulary
    for round_ in range(TRAIN_EVERY):  # every learning document is in one round
        part = encoded.where(~F.col("held_out") & (F.col("round") == round_))
        sent = spark.sparkContext.broadcast(weights)
        sums = part.select("classes").mapInArrow(_train_rows(sent, classes), "place int, value double")
        found = sums.groupBy("place").agg(F.sum("value").alias("value")).toArrow()  # one row per weight
        sent.destroy()
        if found.num_rows:
            value = found.column("value").to_numpy()[np.argsort(found.column("place").to_numpy())]
            weights = value[:-1] / value[-1]

    sent = spark.sparkContext.broadcast(weights)
    modelled = materialise(encoded.select("row", "classes").mapInArrow(_score_rows(sent, classes), "row long, log_model double"), "scored")
    sent.destroy()
    scored = encoded.drop("classes", "round").join(modelled, "row")
    rare = encoded.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("x")).select("row", F.col("x.rare").alias("key"), F.col("x.rare_n").alias("n"))
    looked = rare.join(counts.select("key", "c"), "key", "left")
    per_row = looked.groupBy("row").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("log_rare"),
        F.sum(F.when(F.col("c").isNotNull(), F.col("n"))).alias("n_rare"),
    )
    both = scored.drop("rare", "rare_n").join(per_row, "row", "left")
    log_c = F.col("log_head") + F.coalesce("log_rare", F.lit(0.0)) + F.lit(float(np.log10(n_learn + 0.5)))
    return both.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_head") + F.coalesce("n_rare", F.lit(0)) + F.lit(int(n_learn > 0))).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (log_c - F.col("n_tokens") * F.lit(float(np.log10(total + 0.5 * (distinct + 1))))).alias("base_score"),
        (F.col("log_unseen") + F.col("log_model")).alias("score"),
    )
