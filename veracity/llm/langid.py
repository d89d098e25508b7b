"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a window of bytes in both directions, gives every position a distribution over
the languages, and a document's distribution is the mean over all positions of its whole text.
It is trained here in numpy by backpropagation through time on a bounded sample of labelled rows
(``per_lang`` rows a language and ``sample_chars`` characters of each, at a place chosen by a hash
of the row); the sample is the only thing that reaches the driver. Prediction runs where the rows
are read: all windows of a step advance together, one position at a time, with no shuffle.

Defined cases: a text that is null or has no letter is ``und`` with score 0; with no labelled row
at all every row is ``und``; languages that are null are no examples. Rows that repeat are judged
each. Very long texts are cut into windows, so memory does not depend on their length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from veracity.llm.common import binary_buffers, byte_steps, map_arrow

UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
#: Bytes of a window when predicting; state starts anew in each.
PREDICT_WINDOW = 128


class BiGRU:
    """Gates z, r and candidate n, per direction: ``h' = n + z (h - n)``."""

    def __init__(self, classes: list[str], hidden: int = 12, seed: int = 7):
        g, h = np.random.default_rng(seed), hidden
        self.classes, self.hidden = classes, h
        self.p = {
            "x": g.normal(0, 0.3, (2, 256, 3 * h)), "u": g.normal(0, 1 / np.sqrt(h), (2, h, 3 * h)),
            "b": np.zeros((2, 1, 3 * h)), "o": g.normal(0, 0.3, (2, h, len(classes))), "c": np.zeros(len(classes)),
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    # -- training -----------------------------------------------------------------------------

    def _forward(self, x: np.ndarray):
        """``x`` (T, B) bytes -> logits (T, B, C) and what the backward pass needs."""
        p, h, t_max = self.p, self.hidden, len(x)
        state, kept = np.zeros((2, x.shape[1], h), np.float32), []
        hs = np.zeros((2, t_max, x.shape[1], h), np.float32)
        for t in range(t_max):
            b = np.stack((x[t], x[t_max - 1 - t]))
            g = state @ p["u"]
            a = np.stack((p["x"][0][b[0]], p["x"][1][b[1]])) + p["b"]
            zr = 1 / (1 + np.exp(-(a[..., :2 * h] + g[..., :2 * h])))
            z, r = zr[..., :h], zr[..., h:]
            n = np.tanh(a[..., 2 * h:] + r * g[..., 2 * h:])
            new = n + z * (state - n)
            kept.append((b, state, z, r, n, g[..., 2 * h:]))
            state = new
            hs[0, t], hs[1, t_max - 1 - t] = new
        return hs[0] @ p["o"][0] + hs[1] @ p["o"][1] + p["c"], hs, kept

    def loss_and_gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over all positions of windows ``x`` (T, B) with labels ``y`` (B)."""
        p, h, (t_max, n_rows) = self.p, self.hidden, x.shape
        logits, hs, kept = self._forward(x)
        e = np.exp(logits - logits.max(-1, keepdims=True))
        prob = e / e.sum(-1, keepdims=True)
        loss = -np.log(np.maximum(prob[:, np.arange(n_rows), y], 1e-12)).mean()
        d = prob
        d[:, np.arange(n_rows), y] -= 1
        d /= t_max * n_rows
        grad = {k: np.zeros_like(v) for k, v in p.items()}
        grad["c"] = d.sum((0, 1))
        grad["o"] = np.stack([np.einsum("tbh,tbc->hc", hs[k], d) for k in (0, 1)])
        back = np.stack((d @ p["o"][0].T, (d @ p["o"][1].T)[::-1]))      # in the order of each direction
        carry = np.zeros((2, n_rows, h), np.float32)
        u_t = p["u"].transpose(0, 2, 1)
        for t in range(t_max - 1, -1, -1):
            b, state, z, r, n, gn = kept[t]
            dh = back[:, t] + carry
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (state - n) * z * (1 - z)
            dr = dn * gn * r * (1 - r)
            da = np.concatenate((dz, dr, dn), -1)
            dg = np.concatenate((dz, dr, dn * r), -1)
            grad["u"] += state.transpose(0, 2, 1) @ dg
            grad["b"] += da.sum(1, keepdims=True)
            for k in (0, 1):
                np.add.at(grad["x"][k], b[k], da[k])
            carry = dh * z + dg @ u_t
        return float(loss), grad

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 500, batch: int = 128, rate: float = 0.02,
            seed: int = 7) -> None:
        """Adam on random batches of windows ``x`` (rows, T) with class numbers ``y``."""
        g = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        for step in range(1, steps + 1):
            i = g.integers(0, len(x), batch)
            _, grad = self.loss_and_gradients(np.ascontiguousarray(x[i].T), y[i])
            norm = np.sqrt(sum(float((v * v).sum()) for v in grad.values()))
            lr = rate * min(1.0, 1.0 / max(norm, 1e-9)) * (1 - 0.9 * step / steps)
            for k, v in grad.items():
                m[k] = 0.9 * m[k] + 0.1 * v
                s[k] = 0.99 * s[k] + 0.01 * v * v
                self.p[k] -= (lr * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)

    # -- prediction ---------------------------------------------------------------------------

    def window_sums(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Sum over the positions of each window of their distributions: ``x``, ``mask`` (T, B)."""
        p, h, (t_max, n) = self.p, self.hidden, x.shape
        half = np.concatenate((np.full(2 * h, 0.5), np.ones(h))).astype(np.float32)   # sigmoid from tanh
        # Units run along the first axis and windows along the last, so every gate is one block.
        table = np.ascontiguousarray(((p["x"] + p["b"]) * half).transpose(0, 2, 1))
        u, o = np.ascontiguousarray((p["u"] * half).transpose(0, 2, 1)), np.ascontiguousarray(p["o"].transpose(0, 2, 1))
        whole = bool(mask.all())
        state = np.zeros((2, h, n), np.float32)
        logits = np.empty((2, t_max, len(self.classes), n), np.float32)
        a, g = np.empty((2, 3 * h, n), np.float32), np.empty((2, 3 * h, n), np.float32)
        for t in range(t_max):
            q = t_max - 1 - t
            np.take(table[0], x[t], 1, out=a[0], mode="clip")
            np.take(table[1], x[q], 1, out=a[1], mode="clip")
            np.matmul(u, state, out=g)
            zr, c = a[:, :2 * h], g[:, 2 * h:]
            zr += g[:, :2 * h]
            np.tanh(zr, out=zr)
            zr *= np.float32(0.5)
            zr += np.float32(0.5)
            c *= zr[:, h:]
            c += a[:, 2 * h:]
            np.tanh(c, out=c)
            state -= c
            state *= zr[:, :h]
            state += c
            if not whole:
                state[0] *= mask[t]
                state[1] *= mask[q]
            np.matmul(o[0], state[0], out=logits[0, t])
            np.matmul(o[1], state[1], out=logits[1, q])
        e = logits[0]
        e += logits[1]
        e += p["c"][:, None]
        np.exp(np.clip(e, -40, 40, out=e), out=e)
        e *= (mask / e.sum(1))[:, None]
        return e.sum(0).T


def _windows(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(T, B) bytes and mask of consecutive windows of each text, and each window's text."""
    n = np.diff(offsets)
    per = -(-n // size)
    text = np.repeat(np.arange(len(n)), per)
    k = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
    start = offsets[:-1][text] + k * size
    left = np.minimum(size, offsets[1:][text] - start)
    at = np.minimum(start[None, :] + np.arange(size)[:, None], len(data) - 1)
    mask = np.arange(size)[:, None] < left[None, :]
    return data[at] * mask, mask.astype(np.float32), text


def train_language_model(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", per_lang: int = 400,
                         sample_chars: int = 1024, window: int = 48, hidden: int = 12, steps: int = 500,
                         seed: int = 7) -> BiGRU | None:
    """Fit on at most ``per_lang`` rows of each language of ``labelled``; None without any."""
    rows = labelled.select(F.col(text_col).alias("t"), F.col(lang_col).alias("lang")).where(
        "lang is not null and length(t) > 0")
    key = F.xxhash64(F.lit(seed), "t")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    # Thin each language to about twice the bound by its hash, then take the exact number of what is left.
    share = F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, min(1.0, 2.0 * per_lang / n))])
    thin = rows.where(F.pmod(key, F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20))
    offset = F.pmod(F.xxhash64("t", F.lit(1)), F.greatest(F.length("t") - sample_chars, F.lit(0)) + 1).cast("int")
    order = Window.partitionBy("lang").orderBy("h", "piece")
    sample = (thin.select("lang", key.alias("h"), F.substring("t", offset + 1, F.lit(sample_chars)).alias("piece"))
              .withColumn("k", F.row_number().over(order)).where(F.col("k") <= per_lang).orderBy("lang", "k").collect())
    classes = sorted(counts)
    x, y = [], []
    for r in sample:
        b = np.frombuffer(r["piece"].encode(), np.uint8)
        for lo in range(0, max(1, len(b) - window + 1), window):
            w = b[lo:lo + window]
            x.append(np.tile(w, -(-window // len(w)))[:window])         # a short text repeats
            y.append(classes.index(r["lang"]))
    x, y = np.array(x), np.array(y)
    every = [np.flatnonzero(y == k) for k in range(len(classes))]        # the languages weigh alike
    g = np.random.default_rng(seed)
    take = np.concatenate([g.choice(i, max(map(len, every))) for i in every if len(i)])
    model = BiGRU(classes, hidden, seed)
    model.fit(x[take], y[take], steps=steps, seed=seed)
    return model


def predict_language(docs: DataFrame, model: BiGRU | None, text_col: str = "text",
                     keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``lang_pred`` and ``score`` (the mean probability of that language); a kept
    column may have one of these names too."""
    shared = docs.sparkSession.sparkContext.broadcast(model)             # a few kilobytes
    names = [f"k{k}" for k in range(len(keep))]
    rows = docs.select(*[F.col(c).alias(k) for c, k in zip(keep, names)], F.col(text_col).alias("text"))
    n0 = len(keep)

    def run(batches):
        net = shared.value
        for b in batches:
            column, lang, score = b.column(n0), [UNKNOWN] * b.num_rows, [0.0] * b.num_rows
            has = np.array([bool(v) and _LETTER.search(v) is not None for v in (s.as_py() for s in column)], bool)
            if net is not None and has.any():
                data, offsets = binary_buffers(column)
                for lo, hi in byte_steps(offsets):
                    sums, size = np.zeros((hi - lo, len(net.classes))), np.maximum(np.diff(offsets[lo:hi + 1]), 1)
                    x, mask, text = _windows(data, offsets[lo:hi + 1], PREDICT_WINDOW)
                    for k in range(0, x.shape[1], 2048):                 # a long text adds windows, not memory
                        part = net.window_sums(np.ascontiguousarray(x[:, k:k + 2048]),
                                               np.ascontiguousarray(mask[:, k:k + 2048]))
                        np.add.at(sums, text[k:k + 2048], part)
                    mean = sums / size[:, None]
                    for i in np.flatnonzero(has[lo:hi]):
                        best = int(mean[i].argmax())
                        lang[lo + i], score[lo + i] = net.classes[best], min(1.0, float(mean[i, best]))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(k) for k in range(n0)), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                [*names, "lang_pred", "score"])

    schema = StructType([*(rows.schema[k] for k in range(n0)), StructField("lang_pred", StringType()),
                         StructField("score", DoubleType())])
    return map_arrow(rows, run, schema).toDF(*keep, "lang_pred", "score")


def held_out(id_col: str = "doc_id") -> Column:
    """A quarter of the rows, by id: never used for training."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 4 == 2


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                       keep: tuple[str, ...] = (), **training) -> DataFrame:
    """Train on the rows that are not held out, predict every row: ``id_col``, ``keep`` columns,
    ``held_out``, ``lang_pred``, ``score``."""
    model = train_language_model(docs.where(~held_out(id_col)), text_col, lang_col, **training)
    out = predict_language(docs, model, text_col, (id_col, *keep))
    out = out.toDF(*[f"c{k}" for k in range(len(out.columns))])          # kept names may clash with the results'
    cols = out.columns
    return out.select(*[F.col(c).alias(n) for c, n in zip(cols, (id_col, *keep))], held_out("c0").alias("held_out"),
                      F.col(cols[-2]).alias("lang_pred"), F.col(cols[-1]).alias("score"))
