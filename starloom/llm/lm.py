"""Language-model scores: corpus unigram counts and a gated recurrent model with a class-factored softmax.

Words are counted over all training documents.  The most frequent ones have their own
outputs, in classes of equal size; every other word belongs to one of 64 classes by its last
byte and is drawn in it by its count, unseen words by one.  So the model is a distribution
over all texts, and what a word outside the broadcast vocabulary adds is its count, which
comes from a join.  The recurrent weights are trained by truncated backpropagation on all
training documents, in hashed shares, in parallel, and averaged.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from starloom.llm.common import fold, saved, text_of

FOLDS, HELD_OUT = 7, 2
HEAD = 65_536  # most words that are broadcast with their counts
CLASSES, PER_CLASS = 31, 32  # of words with outputs of their own
RESTS = 64
HIDDEN = 16
LANES = 256
WINDOW = 32
PER_TRAINER = 250_000
ROUNDS = 2
TRAIN_LANES, TRAIN_WINDOW, RATE = 128, 16, 0.02
SEGMENT = 256  # tokens of a document that one lane trains on in a row
COUNTED = 1_000_000  # counts that one task holds while counting
END = b""  # the end token: no word is empty

COUNTS = "word binary, n long"
SCORED = "doc_id long, held_out boolean, row long, n_tokens long, n_head long, head_log double, model_log double, tail array<binary>"


def words_of(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """Words and one end token of each text, in one array, and how many each has: lower-cased ASCII, split at the six ASCII blanks."""
    # Arrow's ASCII kernels go by bytes and know no other blanks; one blank after the last word leaves an empty one there
    bare = [text.strip() for text in texts]
    spaced = pa.array([text + b" " if text else text for text in bare], pa.binary()).view(pa.string())
    lists = pc.ascii_split_whitespace(pc.ascii_lower(spaced))
    return lists.flatten().view(pa.binary()), np.asarray(pc.list_value_length(lists)).astype(np.int64)


def count_words(batches):
    """Counts of one task, run by run of its texts, emitted whenever they hold many words; Spark sums them up."""
    held, size = [], 0

    def out():
        whole = pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("n", "sum")])
        return whole.select(["word", "n_sum"]).rename_columns(["word", "n"]).to_batches()

    for _, _, texts in token_chunks(batches):
        found = pc.value_counts(words_of(texts)[0])
        held.append(pa.Table.from_arrays(found.flatten(), names=["word", "n"]))
        size += len(found)
        if size > COUNTED:
            yield from out()
            held, size = [], 0
    if held:
        yield from out()


def rest_class(last: int) -> int:
    return last & 31 if last < 64 else 32 + (last & 31)


@dataclass
class Vocabulary:
    """Head words by falling count; the first CLASSES * PER_CLASS have outputs of their own."""

    ids: dict[bytes, int]
    counts: np.ndarray
    rest: np.ndarray  # sum of count + 1 over the words of each rest class, and one for unseen words
    total: int
    distinct: int

    def __post_init__(self):
        self.own = min(CLASSES * PER_CLASS, len(self.ids))
        words = list(self.ids)
        self.words = pa.array(words, pa.binary())
        self.class_of = np.array([i // PER_CLASS if i < self.own else CLASSES + rest_class(w[-1]) if w else CLASSES for i, w in enumerate(words)] or [0], dtype=np.int16)
        log = np.log(np.append(self.counts, 1).astype(np.float64) + 1)
        self.logs = log / math.log(10)  # the last entry stands for a word outside the head and is not used
        self.within = np.where(np.arange(len(log)) < self.own, 0.0, log - np.log(self.rest)[np.append(self.class_of, CLASSES)[:len(log)] - CLASSES]) if len(words) else np.zeros(1)


    def __getstate__(self):
        return self.__dict__ | {"ids": None}  # tasks look words up in one array

    def short(self) -> Vocabulary:
        """The words with outputs of their own: all that training tells apart, the class of any other word is in its last byte."""
        return Vocabulary(dict(list(self.ids.items())[:self.own]), self.counts[:self.own], self.rest, self.total, self.distinct)


def vocabulary(counts: DataFrame, head: int = HEAD) -> Vocabulary:
    """The driver takes the counts' histogram, the head words, the end token whatever its count, and 64 class sums."""
    by_last = counts.groupBy(F.substring("word", -1, 1).alias("last")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect()
    least, kept = 1, 0
    for r in counts.groupBy("n").count().orderBy(F.desc("n")).limit(head).collect():
        kept += r["count"]
        if kept > head:
            least = r["n"] + 1
            break
    words = sorted(((-r["n"], bytes(r["word"])) for r in counts.filter((F.col("n") >= least) | (F.octet_length("word") == 0)).toLocalIterator()))
    ids = {w: i for i, (_, w) in enumerate(words)}
    rest = np.ones(RESTS)
    for r in by_last:
        if r["last"]:
            rest[rest_class(r["last"][0])] += r["n"] + r["words"]
    for n, w in words[:CLASSES * PER_CLASS]:
        if w:
            rest[rest_class(w[-1])] -= 1 - n
    for n, w in words[CLASSES * PER_CLASS:]:
        if not w:
            rest[0] += 1 - n
    return Vocabulary(ids, np.array([-n for n, _ in words], dtype=np.int64), rest, sum(r["n"] for r in by_last), sum(r["words"] for r in by_last))


SHAPES = {"ef": (CLASSES * PER_CLASS + RESTS + 1, HIDDEN), "ec": (CLASSES * PER_CLASS + RESTS + 1, HIDDEN), "uf": (HIDDEN, HIDDEN), "uc": (HIDDEN, HIDDEN),
          "wc": (HIDDEN, CLASSES + RESTS), "bc": (CLASSES + RESTS,), "ww": (CLASSES, HIDDEN, PER_CLASS), "bw": (CLASSES, PER_CLASS)}


def unpack(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in SHAPES.items():
        size = int(np.prod(shape))
        out[name] = flat[at:at + size].reshape(shape)
        at += size
    return out


def starting_weights(v: Vocabulary) -> np.ndarray:
    """Small random input weights and outputs that start at the unigram frequencies."""
    draw = np.random.default_rng(11)
    w = {k: np.zeros(s, dtype=np.float32) for k, s in SHAPES.items()}
    for name in ("ef", "ec", "uf", "uc"):
        w[name] += draw.normal(0, 0.3, SHAPES[name]).astype(np.float32)
    w["ef"] -= 1.0
    own = np.zeros(CLASSES * PER_CLASS)
    own[:v.own] = v.counts[:v.own]
    w["bw"][:] = np.log(own + 1e-3).reshape(CLASSES, PER_CLASS)
    w["bw"].reshape(-1)[v.own:] = -30.0
    mass = np.append(own.reshape(CLASSES, PER_CLASS).sum(axis=1), v.rest)
    w["bc"][:] = np.log(mass + 1e-3)
    return np.concatenate([w[k].reshape(-1) for k in SHAPES])


BOS = CLASSES * PER_CLASS + RESTS


class Lanes:
    """Documents side by side: a lane takes the next document when it has ended one.

    Windows of a fixed number of steps leave it; the state at the end of a window is the
    state at the start of the next, so documents of any length are scored whole.
    """

    def __init__(self, lengths, lanes: int, steps: int):
        self.queues: list[list[int]] = [[] for _ in range(min(lanes, max(len(lengths), 1)))]
        load = [(0, i) for i in range(len(self.queues))]
        for d in np.argsort(-np.asarray(lengths), kind="stable"):
            n, lane = load[0]
            heapq.heapreplace(load, (n + int(lengths[d]), lane))
            self.queues[lane].append(int(d))
        self.lengths, self.steps = lengths, steps

    def windows(self, starts: np.ndarray, full: bool = False):
        """Places of the tokens of each window in the flat stream (-1: none), with lanes that still run in front.

        If windows are to be ``full``, they have more steps as fewer lanes run.
        """
        rows = [np.concatenate([np.arange(starts[d], starts[d] + self.lengths[d], dtype=np.int32) for d in q]) if q else np.zeros(0, dtype=np.int32) for q in self.queues]
        rows.sort(key=len, reverse=True)
        sizes = np.array([len(r) for r in rows])
        begins, places = np.cumsum(sizes) - sizes, np.concatenate(rows)
        at, rows = 0, None
        while live := int(np.count_nonzero(sizes > at)):
            steps = np.arange(at, at + self.steps * (len(sizes) // live if full else 1))
            out = places.take(begins[:live, None] + steps, mode="clip")
            out[steps >= sizes[:live, None]] = -1
            yield out
            at += len(steps)


def forward(w, inputs: np.ndarray, fresh: np.ndarray, h: np.ndarray, keep: list | None = None):
    """States after each step of a window, and the last one; a fresh document starts from nothing.

    All is stored step by step, so that a step writes and reads whole blocks and what the way
    back needs of all steps is worked out for all of them together.
    """
    lanes, steps = inputs.shape
    x, half = inputs.T, np.float32(0.5)
    uf, uc = w["uf"] * half, np.ascontiguousarray(w["uc"])  # the logistic function by way of tanh takes half of its input
    given_f, given_c = (w["ef"] * half).take(x, axis=0), w["ec"].take(x, axis=0)
    at, lane = np.nonzero(fresh.T)
    edges = np.searchsorted(at, np.arange(steps + 1)).tolist()
    begins = [lane[a:b] if a < b else None for a, b in zip(edges[:-1], edges[1:], strict=True)]
    states = np.empty((steps, lanes, HIDDEN), dtype=given_f.dtype)
    before, f, g, c, rise = (np.empty((1 if keep is None else steps, lanes, HIDDEN), dtype=given_f.dtype) for _ in range(5))
    for t in range(steps):
        if keep is not None or not t:
            last, ft, gt, ct, rt = before[t], f[t], g[t], c[t], rise[t]
        last[:] = h
        if begins[t] is not None:
            last[begins[t]] = 0
        np.matmul(last, uf, out=ft)
        ft += given_f[t]
        np.tanh(ft, out=ft)
        ft *= half
        ft += half
        np.multiply(ft, last, out=gt)
        np.matmul(gt, uc, out=ct)
        ct += given_c[t]
        np.tanh(ct, out=ct)
        np.subtract(ct, last, out=rt)
        h = states[t]
        np.multiply(ft, rt, out=h)
        h += last
    if keep is not None:
        keep += [x, begins, before, f, g, c, rise]
    return states.swapaxes(0, 1), h


def joined(weights: np.ndarray, constants: np.ndarray, columns: int):
    """Weights with their constants as one more row, and whether the logits need their own maximum row by row.

    States lie between -1 and 1, so the weights bound the logits.  They are lowered by the upper
    bound; unless that may put all logits of a row so low that their powers vanish, none needs more.
    """
    reach = np.ones(HIDDEN, dtype=weights.dtype) @ np.abs(weights)
    top = (constants + reach).max(axis=-1, keepdims=True)
    wide = (top[..., 0] - (constants - reach).max(axis=-1)).max() > 60
    out = np.zeros((*weights.shape[:-2], HIDDEN + 1, columns), dtype=weights.dtype)
    out[..., :HIDDEN, :weights.shape[-1]] = weights
    out[..., HIDDEN, :weights.shape[-1]] = constants - top
    return out, wide


def powers(logits: np.ndarray, chosen: np.ndarray, used: int, wide: bool) -> tuple[np.ndarray, np.ndarray]:
    """Log-probabilities of the chosen columns and the sum of all powers; the logits become their powers, those not used become 0."""
    if wide:
        logits -= logits[:, :used].max(axis=1, keepdims=True)
        logits[:, used:] = 0
    picked = logits.reshape(-1).take(np.arange(0, logits.size, logits.shape[1]) + chosen)
    np.exp(logits, out=logits)
    logits[:, used:] = 0
    total = logits @ np.ones(logits.shape[1], dtype=logits.dtype)
    return picked - np.log(total), total


WHOLE = 2048  # states whose class powers are held at once
PADDED = -(-(CLASSES + RESTS) // 8) * 8  # columns of the class weights, in eights for the matrix product


def outputs(w, states: np.ndarray, classes: np.ndarray, slots: np.ndarray, grads: dict | None = None):
    """Log-probabilities of class and, for words of their own, of the word in it.

    Tokens are put in order of their output once; then a class is a slice, and all that does not
    need its weights is done for all of them together.  Probabilities are never formed: powers
    are multiplied as they are, and the products, which have fewer columns, are divided by their sum.
    """
    n, own, kinds = len(states), CLASSES * PER_CLASS, CLASSES + RESTS
    key = np.where(classes < CLASSES, classes * PER_CLASS + slots, classes + (own - CLASSES)).astype(np.int16)
    order = np.argsort(key, kind="stable")
    key = key[order]
    kind = np.where(key < own, key // PER_CLASS, key - (own - CLASSES))
    s = np.ones((n, HIDDEN + 1), dtype=w["wc"].dtype)  # the last column takes the constants
    s[:, :HIDDEN] = states.take(order, axis=0)
    outer, wide = joined(w["wc"], w["bc"], PADDED)
    logp, back = np.empty(n, dtype=s.dtype), None
    if grads is not None:
        back, turned, change = np.empty((n, HIDDEN), dtype=s.dtype), np.ascontiguousarray(outer[:HIDDEN].T), np.zeros_like(outer)
    for a in range(0, n, WHOLE):
        part = s[a:a + WHOLE]
        d = part @ outer
        logp[a:a + WHOLE], total = powers(d, kind[a:a + WHOLE], kinds, wide)
        if grads is not None:
            share = (1 / total)[:, None]
            change += (part * share).T @ d
            np.multiply(d @ turned, share, out=back[a:a + WHOLE])
    if grads is not None:
        back -= turned.take(kind, axis=0)
    edges = np.searchsorted(key, np.arange(0, own + 1, PER_CLASS)).tolist()
    parts = [(k, a, b) for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if a < b]
    some = edges[-1]
    inner, wide = joined(w["ww"], w["bw"], PER_CLASS)
    d = np.empty((some, PER_CLASS), dtype=s.dtype)
    for k, a, b in parts:
        np.matmul(s[a:b], inner[k], out=d[a:b])
    found, total = powers(d, key[:some] % PER_CLASS, PER_CLASS, wide)
    logp[:some] += found
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    if grads is None:
        return logp.take(place), None
    share = (1 / total)[:, None]
    shared, within = s[:some] * share, np.empty((some, HIDDEN), dtype=s.dtype)
    each, aside = np.zeros_like(inner), np.ascontiguousarray(w["ww"].swapaxes(1, 2))
    for k, a, b in parts:
        np.matmul(shared[a:b].T, d[a:b], out=each[k])
        np.matmul(d[a:b], aside[k], out=within[a:b])
    within *= share
    within -= aside.reshape(own, HIDDEN).take(key[:some], axis=0)
    back[:some] += within
    if n:
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        sums, key, kind = np.add.reduceat(s, first, axis=0), key[first], kind[first]
        some = np.count_nonzero(key < own)
        each[kind[:some], :, key[:some] % PER_CLASS] -= sums[:some]
        first = np.flatnonzero(np.append(True, kind[1:] != kind[:-1]))
        change[:, kind[first]] -= np.add.reduceat(sums, first, axis=0).T
    grads["wc"] += change[:HIDDEN, :kinds]
    grads["bc"] += change[HIDDEN, :kinds]
    grads["ww"] += each[:, :HIDDEN]
    grads["bw"] += each[:, HIDDEN]
    return logp.take(place), back.take(place, axis=0)


def backward(w, kept: list, fresh: np.ndarray, back: np.ndarray, grads: dict) -> None:
    """Through the steps of one window, not beyond it."""
    x, begins, before, f, g, c, rise = kept
    back = back.swapaxes(0, 1)
    stay = 1 - f
    slope = f * stay
    to_c = (1 - c * c) * f
    d_f, dg_f = rise * slope, before * slope
    uc, uf = np.ascontiguousarray(w["uc"].T), np.ascontiguousarray(w["uf"].T)
    dc, df = np.empty_like(to_c), np.empty_like(to_c)
    carry, dg, more = (np.zeros_like(to_c[0]) for _ in range(3))
    for t in range(len(x) - 1, -1, -1):
        carry += back[t]
        np.multiply(carry, to_c[t], out=dc[t])
        np.matmul(dc[t], uc, out=dg)
        np.multiply(carry, d_f[t], out=df[t])
        np.multiply(dg, dg_f[t], out=more)
        df[t] += more
        carry *= stay[t]
        dg *= f[t]
        carry += dg
        np.matmul(df[t], uf, out=more)
        carry += more
        if begins[t] is not None:
            carry[begins[t]] = 0
    before, g, dc, df = (a.reshape(-1, HIDDEN) for a in (before, g, dc, df))
    grads["uc"] += g.T @ dc
    grads["uf"] += before.T @ df
    x = x.reshape(-1).astype(np.int16)
    order = np.argsort(x, kind="stable")
    x = x[order]
    first = np.flatnonzero(np.append(True, x[1:] != x[:-1]))
    grads["ec"][x[first]] += np.add.reduceat(dc.take(order, axis=0), first, axis=0)
    grads["ef"][x[first]] += np.add.reduceat(df.take(order, axis=0), first, axis=0)


def segments(starts: np.ndarray, lengths: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the parts of documents, of ``most`` tokens at the utmost."""
    parts = -(-lengths // most)
    nth = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
    return np.repeat(starts, parts) + nth * most, np.minimum(np.repeat(lengths, parts) - nth * most, most)


class Encoder:
    """Token streams of documents: ids, classes, slots and inputs."""

    def __init__(self, v: Vocabulary):
        self.v, words = v, len(v.words)
        inputs = np.where(np.arange(words + 1) < v.own, np.arange(words + 1), CLASSES * PER_CLASS + np.append(v.class_of[:words], CLASSES) - CLASSES) if words else np.array([BOS])
        self.inputs = inputs.astype(np.int16)

    def stream(self, texts: list[bytes], tails: bool = True):
        """Of all texts: id (-1: unknown), place in the vocabulary, class and input of each token, and by text starts, lengths and unknown words."""
        words, lengths = words_of(texts)
        flat = np.asarray(pc.index_in(words, value_set=self.v.words).fill_null(-1))
        unknown = flat < 0
        known = np.where(unknown, np.int32(len(self.v.words)), flat)
        classes = self.v.class_of.take(flat, mode="wrap") if len(self.v.words) else np.full(len(flat), CLASSES, dtype=np.int16)
        at = np.flatnonzero(unknown)
        _, ends, data = words.buffers()
        ends = np.frombuffer(ends, np.int32)[words.offset:words.offset + len(words) + 1]
        last = np.zeros(len(at), dtype=np.int16)
        spelt = ends.take(at + 1) > ends.take(at)  # all but an end token that training never saw
        if spelt.any():
            last[spelt] = np.frombuffer(data, np.uint8).take(ends.take(at[spelt] + 1) - 1)
        classes[at] = CLASSES + np.where(last < 64, last & 31, 32 + (last & 31))
        inputs = self.inputs.take(known)
        inputs[at] = CLASSES * PER_CLASS + classes.take(at) - CLASSES
        starts = np.cumsum(lengths) - lengths
        shifted = np.empty_like(inputs)
        shifted[1:] = inputs[:-1]
        shifted[starts] = BOS
        if not tails:
            return flat, known, classes, shifted, starts, lengths, None
        per_text = np.add.reduceat(unknown & (ends[1:] > ends[:-1]), starts, dtype=np.int64) if len(texts) else starts
        spelt = words.take(pa.array(at[spelt]))
        return flat, known, classes, shifted, starts, lengths, pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(per_text)), pa.int32()), spelt)


def runs(texts: list[bytes], most: int):
    """Beginnings and ends of runs of texts, of about so many bytes."""
    begin = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= most:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def token_chunks(batches, most: int = 8 << 20):
    """Each batch with the beginning and the texts of runs of its rows, of about so many bytes of text."""
    for batch in batches:
        texts = batch.column(batch.num_columns - 1).to_pylist()
        for a, b in runs(texts, most):
            yield batch, a, texts[a:b]


def scorer(v: Vocabulary, flat_weights: np.ndarray):
    def run(batches):
        w, encoder = unpack(flat_weights), Encoder(v)
        log_rest = np.log(v.rest)
        for batch, begin, texts in token_chunks(batches, 16 << 20):
            flat, known, classes, inputs, starts, lengths, tails = encoder.stream(texts)
            unknown, slots = flat < 0, (known % PER_CLASS).astype(np.int16)
            logp = np.where(unknown, -log_rest.take(np.maximum(classes - CLASSES, 0)), v.within.take(known))
            h = np.zeros((0, HIDDEN), dtype=np.float32)
            fresh_at = np.zeros(len(flat), dtype=bool)
            fresh_at[starts] = True
            for window in Lanes(lengths, LANES, WINDOW).windows(starts, full=True):
                if not len(h):
                    h = np.zeros((len(window), HIDDEN), dtype=np.float32)
                window = np.ascontiguousarray(window.T)
                place, real = np.maximum(window, 0), np.flatnonzero(window >= 0)
                states, h = forward(w, inputs.take(place).T, fresh_at.take(place).T, h[:window.shape[1]])
                at = window.reshape(-1).take(real)
                found, _ = outputs(w, states.swapaxes(0, 1).reshape(-1, HIDDEN).take(real, axis=0), classes.take(at), slots.take(at))
                logp[at] += found
            n_head, head, model = (np.add.reduceat(x, starts) for x in ((~unknown).astype(np.int64), np.where(unknown, 0.0, v.logs.take(known)), logp))
            given = batch.slice(begin, len(texts))
            yield pa.RecordBatch.from_arrays([
                given.column("doc_id"), given.column("held_out"), given.column("row"), pa.array(lengths, pa.int64()), pa.array(n_head),
                pa.array(head), pa.array(model / math.log(10)), tails], names=[c.split()[0] for c in SCORED.split(", ")])

    return run


def trainer(v: Vocabulary, flat_weights: np.ndarray):
    """Adam on the documents of one task, from the shared weights; one row of new weights."""

    def run(batches):
        flat = flat_weights.copy()
        w, encoder = unpack(flat), Encoder(v)
        first, second, change, step, seen = np.zeros_like(flat), np.zeros_like(flat), np.zeros_like(flat), 0, 0
        grads = unpack(change)
        for _, _, texts in token_chunks(batches):
            ids, known, classes, inputs, starts, lengths, _ = encoder.stream(texts, tails=False)
            slots = (known % PER_CLASS).astype(np.int16)
            fresh_at = np.zeros(len(ids), dtype=bool)
            for a, b in runs(texts, 1 << 20):
                # one long document would leave the other lanes idle; truncated backpropagation does not need it in one lane
                begins, sizes = segments(starts[a:b], lengths[a:b], SEGMENT)
                fresh_at[begins] = True
                h = np.zeros((0, HIDDEN), dtype=np.float32)
                for window in Lanes(sizes, TRAIN_LANES, TRAIN_WINDOW).windows(begins):
                    if not len(h):
                        h = np.zeros((len(window), HIDDEN), dtype=np.float32)
                    window = np.ascontiguousarray(window.T)
                    place, real = np.maximum(window, 0), np.flatnonzero(window >= 0)
                    fresh, kept = fresh_at.take(place).T, []
                    states, h = forward(w, inputs.take(place).T, fresh, h[:window.shape[1]], kept)
                    at = window.reshape(-1).take(real)
                    change.fill(0)
                    _, out = outputs(w, states.swapaxes(0, 1).reshape(-1, HIDDEN).take(real, axis=0), classes.take(at), slots.take(at), grads)
                    back = np.zeros((*window.shape, HIDDEN), dtype=out.dtype)
                    back.reshape(-1, HIDDEN)[real] = out
                    backward(w, kept, fresh, back.swapaxes(0, 1), grads)
                    change *= np.float32(1 / len(at))
                    np.clip(change, -1, 1, out=change)
                    step += 1
                    # ten and a hundred times the running means of the gradients and of their squares
                    first *= 0.9
                    first += change
                    second *= 0.99
                    change *= change
                    second += change
                    np.sqrt(second, out=change)
                    change += 1e-5 * math.sqrt(1 - 0.99**step)
                    np.divide(first, change, out=change)
                    change *= RATE * math.sqrt(1 - 0.99**step) / (1 - 0.9**step)
                    flat -= change
                    seen += len(at)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([flat], pa.list_(pa.float32())), pa.array([seen], pa.int64())], names=["weights", "tokens"])

    return run


def weighed(batches):
    """Of the rows of one task, the weights times their tokens, summed, and the tokens."""
    sums, tokens = 0, 0
    for batch in batches:
        for weights, n in zip(batch.column("weights"), batch.column("tokens").to_pylist(), strict=True):
            sums, tokens = sums + weights.values.to_numpy().astype(np.float64) * n, tokens + n
    if tokens:
        yield pa.RecordBatch.from_arrays([pa.array([sums], pa.list_(pa.float64())), pa.array([tokens], pa.int64())], names=["sums", "tokens"])


def train(rows: DataFrame, v: Vocabulary) -> np.ndarray:
    """Rounds of parallel training on disjoint shares of all rows, each followed by averaging in Spark.

    Rows are dealt to rounds by a hash of id and text, so copies under several ids are spread.
    """
    weights = starting_weights(v)
    if not v.total:
        return weights
    trainers = max(1, round(v.total / ROUNDS / PER_TRAINER))
    short = v.short()
    turns = rows.withColumn("turn", F.pmod(F.xxhash64("doc_id", "bytes", F.lit(6)), F.lit(ROUNDS)))
    for turn in range(ROUNDS):
        # in an order of their own, so that a task run again learns the same weights
        dealt = turns.filter(F.col("turn") == turn).select("bytes").repartition(trainers).sortWithinPartitions(F.xxhash64("bytes"), "bytes")
        made = saved(dealt.mapInArrow(trainer(short, weights), "weights array<float>, tokens long"), "lm-weights")
        sums = made.mapInArrow(weighed, "sums array<double>, tokens long").select("tokens", F.posexplode("sums").alias("i", "w"))
        mean = sums.groupBy("i").agg((F.sum("w") / F.sum("tokens")).alias("w")).toPandas()
        if len(mean):
            weights = np.zeros_like(weights)
            weights[mean["i"]] = mean["w"].astype(np.float32)
    return weights


def score_texts(docs: DataFrame, head: int = HEAD) -> DataFrame:
    """Unigram and model log-probability of every whole text, learned outside the held-out fold.

    A null text is an empty one: just the end token.  Repeated rows are scored alike.  With
    no training documents both scores rest on nothing but the unseen word.
    """
    held_out = fold("doc_id", FOLDS) == HELD_OUT
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out.alias("held_out"), F.monotonically_increasing_id().alias("row"), text_of().cast("binary").alias("bytes"))
    training = rows.filter(~F.col("held_out")).select("doc_id", "bytes")
    counts = saved(training.select("bytes").mapInArrow(count_words, COUNTS).repartition("word").groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    v = vocabulary(counts, head)
    weights = train(training, v)
    scored = saved(rows.mapInArrow(scorer(v, weights), SCORED), "lm-scores")
    # a written row number ties the tail words to their row from here on; the counts, a row a word, are hashed, the many tail words need no order
    tails = scored.select("row", F.explode("tail").alias("word")).join(counts.withColumnRenamed("word", "_word").hint("shuffle_hash"), F.col("word") == F.col("_word"))
    sums = tails.groupBy(F.col("row").alias("_row")).agg(F.count(F.lit(1)).alias("n_tail"), F.sum(F.log10(F.col("n") + 1)).alias("tail_log"))
    joined = scored.join(sums, F.col("row") == F.col("_row"), "left")
    tail_log = F.coalesce("tail_log", F.lit(0.0))
    base = F.col("head_log") + tail_log - F.col("n_tokens") * math.log10(v.total + v.distinct + 1)
    return joined.select("doc_id", "held_out", "n_tokens", (F.col("n_head") + F.coalesce("n_tail", F.lit(0))).alias("n_known"), F.lit(v.total).cast("bigint").alias("train_tokens"),
                         base.alias("base_score"), (F.col("model_log") + tail_log).alias("score"))
