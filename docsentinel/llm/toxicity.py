"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A word's input is its own hashed embedding beside the mean of its characters' n-gram
embeddings. Windows of words overlap by half; every window gets a logit from its
attention-pooled states, and a text's logit is the log-sum-exp over all its windows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsentinel.llm.common import held_out, map_rows, table, utf8, words_alnum

WINDOW = 32
HIDDEN = 8  # states of each direction
WORD_ROWS, CHAR_ROWS, WORD_DIM, CHAR_DIM = 1 << 14, 1 << 14, 8, 16
_GATES = 6 * HIDDEN


@dataclass
class WordInputs:
    """The distinct words of some texts: embedding rows, and rows of their character n-grams."""

    word_row: np.ndarray
    gram_row: np.ndarray
    gram_start: np.ndarray

    @staticmethod
    def build(words: list[bytes]) -> WordInputs:
        """Rows of the words; word 0 is padding and has no grams of its own."""
        joined = np.frombuffer(b"".join(b"<" + w + b">" for w in words), np.uint8).astype(np.uint32)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
        ends = np.cumsum(sizes)
        owner = np.repeat(np.arange(len(words)), sizes)
        h = np.zeros(len(joined), np.uint32)
        rows, owners = [], []
        for n in range(1, 6):  # h[i] hashes the n bytes from i
            h = h[: len(joined) - n + 1] * np.uint32(16777619) ^ joined[n - 1:] if n > 1 else (np.uint32(2166136261) ^ joined)
            if n < 3:
                continue
            i = np.flatnonzero(owner[: len(h)] == owner[n - 1:])
            mixed = (h[i] ^ (h[i] >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            rows.append((mixed >> np.uint32(18)).astype(np.int64) % CHAR_ROWS)
            owners.append(owner[i])
        # whole words: sums of place-weighted bytes, reset at each word
        place = (np.arange(len(joined)) - np.repeat(ends - sizes, sizes)).astype(np.uint32)
        weight = (place * np.uint32(0x9E3779B1) + np.uint32(1)) | np.uint32(1)
        whole = np.add.reduceat(joined * weight, ends - sizes) if len(words) else np.empty(0, np.uint32)
        whole = (whole ^ (whole >> np.uint32(13))) * np.uint32(0xC2B2AE35)
        own = np.concatenate(owners)
        order = np.argsort(own, kind="stable")
        start = np.searchsorted(own[order], np.arange(len(words) + 1))
        return WordInputs((whole >> np.uint32(18)).astype(np.int64) % WORD_ROWS, np.concatenate(rows)[order], start)


def windows_of(texts: list[bytes], step: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words, (window, word) indices with 0 as padding, and each text's first window.

    Windows start every ``step`` words; the last one ends with the text.
    """
    index: dict[bytes, int] = {b"": 0}
    rows, first = [], []
    for data in texts:
        first.append(len(rows))
        ids = [index.setdefault(w, len(index)) for w in words_alnum(data)]
        if len(ids) <= WINDOW:
            rows.append(ids + [0] * (WINDOW - len(ids)))
            continue
        ends = list(range(WINDOW, len(ids), step)) + [len(ids)]
        rows += [ids[e - WINDOW: e] for e in ends]
    return list(index), np.array(rows, np.int64).reshape(-1, WINDOW), np.array(first, np.int64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + np.float32(0.5)


@dataclass
class ToxicNet:
    """Parameters by name; columns of gates are ordered (update, reset, new) x (ahead, back) x state."""

    p: dict[str, np.ndarray]

    @staticmethod
    def fresh(seed: int = 7) -> ToxicNet:
        rng = np.random.default_rng(seed)

        def draw(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        return ToxicNet({
            "word": draw(WORD_ROWS, WORD_DIM, scale=0.1),
            "char": draw(CHAR_ROWS, CHAR_DIM, scale=0.3),
            "input": draw(WORD_DIM + CHAR_DIM, _GATES, scale=0.3),
            "gate_bias": np.zeros(_GATES, np.float32),
            "state": draw(2 * HIDDEN, _GATES, scale=0.3) * _direction_mask(),
            "attend": draw(2 * HIDDEN, scale=0.3),
            "out": draw(2 * HIDDEN, scale=0.5),
            "bias": np.full(1, -3.0, np.float32),
        })

    def embed(self, words: WordInputs) -> np.ndarray:
        """(word, WORD_DIM + CHAR_DIM) inputs."""
        n = np.diff(words.gram_start)
        sums = np.zeros((len(n), CHAR_DIM), np.float32)
        some = n > 0
        if some.any():
            sums[some] = np.add.reduceat(self.p["char"][words.gram_row], words.gram_start[:-1][some], axis=0)
        sums /= np.sqrt(np.maximum(n, 1), dtype=np.float32)[:, None]
        return np.concatenate([self.p["word"][words.word_row], sums], axis=1)

    def window_logits(self, gates: np.ndarray, windows: np.ndarray, keep: bool = False):
        """Logits of windows whose words have the given input gates; ``keep`` adds what backward needs."""
        p, n, full = self.p, len(windows), windows.min(initial=1) > 0
        x = gates.reshape(len(gates), 3, 2, HIDDEN)
        ahead, back = np.ascontiguousarray(x[:, :, 0]), np.ascontiguousarray(x[:, :, 1])
        h = np.zeros((n, 2 * HIDDEN), np.float32)
        states = np.empty((WINDOW, n, 2 * HIDDEN), np.float32)
        xs = np.empty((n, 3, 2, HIDDEN), np.float32)
        flat, cut, saved = xs.reshape(n, _GATES), 4 * HIDDEN, []
        for s in range(WINDOW):
            t = WINDOW - 1 - s
            xs[:, :, 0], xs[:, :, 1] = ahead[windows[:, s]], back[windows[:, t]]
            hu = h @ p["state"]
            zr = _sigmoid(flat[:, :cut] + hu[:, :cut])
            z, r = zr[:, : 2 * HIDDEN], zr[:, 2 * HIDDEN:]
            new = np.tanh(flat[:, cut:] + r * hu[:, cut:])
            nxt = new + z * (h - new)
            real = None
            if not full:
                real = np.repeat(np.stack([windows[:, s] > 0, windows[:, t] > 0], 1), HIDDEN, axis=1)
                nxt = np.where(real, nxt, h)
            if keep:
                saved.append((h, z, r, new, hu[:, cut:], real))
            h = nxt
            states[s, :, :HIDDEN], states[t, :, HIDDEN:] = h[:, :HIDDEN], h[:, HIDDEN:]
        e = states @ p["attend"]
        if not full:
            e = np.where(windows.T > 0, e, np.float32(-1e9))
        weight = np.exp(e - e.max(0))
        weight /= weight.sum(0)
        pooled = np.einsum("tn,tnh->nh", weight, states)
        logits = pooled @ p["out"] + p["bias"]
        return (logits, (states, weight, pooled, saved)) if keep else logits

    def gradients(self, texts: list[bytes], y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and gradients of a batch of labelled texts."""
        p = self.p
        words, windows, first = windows_of(texts, WINDOW)
        inputs = WordInputs.build(words)
        x = self.embed(inputs)
        gates = x @ p["input"] + p["gate_bias"]
        logits, (states, weight, pooled, saved) = self.window_logits(gates, windows, keep=True)
        text_logit, share = pool_windows(logits, first)
        prob = 1 / (1 + np.exp(-text_logit))
        loss = float(-np.mean(np.where(y > 0, np.log(prob + 1e-9), np.log(1 - prob + 1e-9))))
        count = np.diff(np.append(first, len(logits)))
        d_logit = (np.repeat((prob - y) / len(y), count) * share).astype(np.float32)
        g = {"bias": d_logit.sum(keepdims=True), "out": pooled.T @ d_logit}
        d_pool = d_logit[:, None] * p["out"]
        d_weight = np.einsum("nh,tnh->tn", d_pool, states)
        d_e = weight * (d_weight - (weight * d_weight).sum(0))
        g["attend"] = np.einsum("tn,tnh->h", d_e, states)
        d_states = weight[:, :, None] * d_pool + d_e[:, :, None] * p["attend"]
        g["state"] = np.zeros_like(p["state"])
        d_gates = np.zeros((len(words), 3, 2, HIDDEN), np.float32)
        dh, cut = np.zeros_like(pooled), 4 * HIDDEN
        for s in range(WINDOW - 1, -1, -1):
            t = WINDOW - 1 - s
            h, z, r, new, hun, real = saved[s]
            dh = dh + np.concatenate([d_states[s, :, :HIDDEN], d_states[t, :, HIDDEN:]], axis=1)
            d = dh if real is None else np.where(real, dh, 0)
            d_new = d * (1 - z) * (1 - new * new)
            d_z = d * (h - new) * z * (1 - z)
            d_r = d_new * hun * r * (1 - r)
            d_x = np.concatenate([d_z, d_r, d_new], axis=1)
            d_hu = np.concatenate([d_z, d_r, d_new * r], axis=1)
            g["state"] += h.T @ d_hu
            carried = d * z + d_hu @ p["state"].T
            dh = carried if real is None else np.where(real, carried, dh)
            split = d_x.reshape(-1, 3, 2, HIDDEN)
            np.add.at(d_gates[:, :, 0], windows[:, s], split[:, :, 0])
            np.add.at(d_gates[:, :, 1], windows[:, t], split[:, :, 1])
        g["state"] *= _direction_mask()
        d_flat = d_gates.reshape(len(words), _GATES)
        g["input"], g["gate_bias"] = x.T @ d_flat, d_flat.sum(0)
        d_x = d_flat @ p["input"].T
        g["word"] = np.zeros_like(p["word"])
        np.add.at(g["word"], inputs.word_row, d_x[:, :WORD_DIM])
        n = np.diff(inputs.gram_start)
        d_gram = d_x[:, WORD_DIM:] / np.sqrt(np.maximum(n, 1), dtype=np.float32)[:, None]
        g["char"] = np.zeros_like(p["char"])
        np.add.at(g["char"], inputs.gram_row, np.repeat(d_gram, n, axis=0))
        return loss, g

    @staticmethod
    def fit(
        texts: list[bytes], y: np.ndarray, steps: int = 450, batch: int = 48, rate: float = 0.01,
        drop: float = 0.5, decay: float = 1e-4, seed: int = 7,
    ) -> ToxicNet:
        """Adam with a falling rate over shuffled batches.

        Each step hides a random part of the word rows, so that no text is learnt by its
        rare words and characters carry their share; embeddings decay towards zero.
        """
        net, rng = ToxicNet.fresh(seed), np.random.default_rng(seed)
        if not len(y) or y.min() == y.max():
            return net
        first = {k: np.zeros_like(v) for k, v in net.p.items()}
        second = {k: np.zeros_like(v) for k, v in net.p.items()}
        order = np.empty(0, np.int64)
        for step in range(1, steps + 1):
            if len(order) < min(batch, len(y)):
                order = np.concatenate([order, rng.permutation(len(y))])
            part, order = order[:batch], order[batch:]
            hidden, whole = rng.random(WORD_ROWS) < drop, net.p["word"]
            net.p["word"] = np.where(hidden[:, None], np.float32(0), whole)
            _, g = net.gradients([texts[i] for i in part], y[part].astype(np.float32))
            net.p["word"] = whole
            g["word"][hidden] = 0
            for k in ("word", "char"):
                g[k] += decay * net.p[k]
            now = rate * (1 - 0.9 * step / steps) * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
            for k, v in g.items():
                first[k] += 0.1 * (v - first[k])
                second[k] += 0.01 * (v * v - second[k])
                net.p[k] -= (now * first[k] / (np.sqrt(second[k]) + 1e-7)).astype(np.float32)
        return net

    def text_logits(self, texts: list[bytes], most: int = 4096) -> np.ndarray:
        """Logits of whole texts over all half-overlapping windows."""
        words, windows, first = windows_of(texts, WINDOW // 2)
        gates = self.embed(WordInputs.build(words)) @ self.p["input"] + self.p["gate_bias"]
        padded = (windows == 0).any(1)
        logits = np.empty(len(windows), np.float32)
        for group in (np.flatnonzero(~padded), np.flatnonzero(padded)):
            for at in range(0, len(group), most):
                part = group[at: at + most]
                logits[part] = self.window_logits(gates, windows[part])
        return pool_windows(logits, first)[0] if len(texts) else np.empty(0)


def pool_windows(logits: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-sum-exp of each text's window logits, and every window's share in it."""
    count = np.diff(np.append(first, len(logits)))
    top = np.maximum.reduceat(logits, first).astype(np.float64)
    grown = np.exp(logits - np.repeat(top, count))
    total = np.add.reduceat(grown, first)
    return top + np.log(total), grown / np.repeat(total, count)


def _direction_mask() -> np.ndarray:
    """Each direction's states feed its own gates only."""
    mask = np.zeros((2, HIDDEN, 3, 2, HIDDEN), np.float32)
    mask[0, :, :, 0] = mask[1, :, :, 1] = 1
    return mask.reshape(2 * HIDDEN, _GATES)


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = 4,
    out: int = 2,
    max_of_class: tuple[int, int] = (2400, 1600),
    max_train_bytes: int = 20_000,
    threshold: float = 0.3,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(``doc_id``, ``held_out``, ``score``, ``predicted``) of every whole text.

    The network is fit on the driver from at most ``max_of_class`` labelled rows of class
    0 and 1 outside the held-out fold, with texts up to ``max_train_bytes`` each; scores
    are corrected to the share of toxic rows among all such labels. Every window of every
    text is scored. Null and blank texts are one empty window; without usable labels the
    untrained network's scores stand. Repeated rows are scored one by one; an empty table
    gives none; extra columns are ignored.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col(key).isNotNull() & ~held_out(key, folds, out))
    known = known.groupBy(F.col(key).cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("y"))
    totals = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = [
        known.where(F.col("y") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for c, most in enumerate(max_of_class)
    ]
    chosen = F.broadcast(picked[0].union(picked[1]))  # at most sum(max_of_class) rows
    source = docs.select(F.col(key).cast("long").alias("doc_id"), utf8(text).alias("data"))
    sample = source.where(F.octet_length("data") <= max_train_bytes).join(chosen, "doc_id")
    sample = sample.groupBy("doc_id", "y").agg(F.min("data").alias("data")).select("doc_id", "data", "y").collect()  # one text a key
    sample.sort(key=lambda r: (r["doc_id"], r["data"]))
    y = np.array([r["y"] for r in sample], np.float32)
    net = ToxicNet.fit([bytes(r["data"]) for r in sample], y)
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    shift = 0.0
    if toxic and clean and y.sum() and (1 - y).sum():
        shift = float(np.log(toxic / clean) - np.log(y.sum() / (1 - y).sum()))
    shared = docs.sparkSession.sparkContext.broadcast(net)  # a few MB, whatever the input

    def make():
        def batch(cols):
            score = 1 / (1 + np.exp(-(shared.value.text_logits(cols[1]) + shift)))
            return {"doc_id": cols[0], "held_out": cols[2], "score": score, "predicted": (score >= threshold).astype(np.int32)}

        return batch

    return map_rows(
        source.select("doc_id", "data", held_out("doc_id", folds, out).alias("held_out")),
        "doc_id long, held_out boolean, score double, predicted int", make,
    )


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
