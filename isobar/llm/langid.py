"""Language identification by a bidirectional GRU over bytes (operator 8).

A small gated recurrent network reads bytes in both directions and labels
every position with a distribution over languages; a document's
probabilities are the mean over all its bytes. It is trained in numpy by
backpropagation through time on a bounded sample of byte segments. Texts are
read whole, in segments of ``SEGMENT`` bytes that are run side by side.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.llm.common import small_batches, staged, thinned

SEGMENT = 64
HIDDEN = 8
# Training sample: at most this many documents of a language (smallest id
# hashes), and this many segments of each.
FIT_DOCS = 1500
FIT_SEGMENTS = 3
STEPS = 700
EVIDENCE = 2 / 15  # for four languages, a score of 0.35
BATCH = 192
BLOCK = 4096  # segments run side by side


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


@dataclass
class Network:
    """Weights of both directions: byte table ``e`` (256, 3h), recurrence ``u`` (h, 3h),
    gates in the order update, reset, candidate; output ``v`` (2h, languages)."""
    langs: list[str]
    e: list[np.ndarray]
    u: list[np.ndarray]
    v: np.ndarray
    c: np.ndarray

    @staticmethod
    def new(langs: list[str], hidden: int, rng: np.random.Generator) -> Network:
        def table(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        return Network(langs, [table(256, 3 * hidden, scale=0.5) for _ in range(2)],
                       [table(hidden, 3 * hidden, scale=hidden ** -0.5) for _ in range(2)],
                       table(2 * hidden, len(langs), scale=0.3), np.zeros(len(langs), np.float32))

    def weights(self) -> list[np.ndarray]:
        return [*self.e, *self.u, self.v, self.c]

    def states(self, seg: np.ndarray, way: int, keep: list | None = None) -> np.ndarray:
        """Hidden states (segment length, segments, h) of one direction."""
        n, length = seg.shape
        e, u = self.e[way], self.u[way]
        h = u.shape[0]
        ugate, ucand = np.ascontiguousarray(u[:, :2 * h]), np.ascontiguousarray(u[:, 2 * h:])
        out = np.empty((length, n, h), np.float32)
        state = np.zeros((n, h), np.float32)
        columns = np.ascontiguousarray(seg.T)
        for t in range(length) if way == 0 else range(length - 1, -1, -1):
            x = e[columns[t]]
            gates = state @ ugate
            gates += x[:, :2 * h]
            gates *= 0.5
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            z, r = gates[:, :h], gates[:, h:]
            q = state @ ucand
            cand = r * q
            cand += x[:, 2 * h:]
            np.tanh(cand, out=cand)
            if keep is not None:
                keep.append((t, state, z, r, q, cand))
            state = state - cand
            state *= z
            state += cand
            out[t] = state
        return out

    def positions(self, seg: np.ndarray) -> np.ndarray:
        """Probabilities (segment length, segments, languages) of every byte."""
        h = self.u[0].shape[0]
        logits = self.states(seg, 0) @ self.v[:h]
        logits += self.states(seg, 1) @ self.v[h:]
        logits += self.c
        return softmax(logits)

    def gradients(self, seg: np.ndarray, mask: np.ndarray, lang: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Loss (cross entropy per byte) and gradients by backpropagation through time."""
        h, n = self.u[0].shape[0], len(seg)
        tapes: list[list] = [[], []]
        both = [self.states(seg, way, tapes[way]) for way in (0, 1)]
        p = softmax(both[0] @ self.v[:h] + both[1] @ self.v[h:] + self.c)
        live = mask.T[:, :, None].astype(np.float32)
        total = max(live.sum(), 1.0)
        loss = float(-(np.log(p[:, np.arange(n), lang] + 1e-9) * live[:, :, 0]).sum() / total)
        p[:, np.arange(n), lang] -= 1
        p *= live / total
        dv = np.concatenate([np.einsum("tnh,tnl->hl", s, p) for s in both])
        de, du = [], []
        for way in (0, 1):
            dstate = p @ self.v[way * h:(way + 1) * h].T
            u = self.u[way]
            e_grad, u_grad = np.zeros_like(self.e[way]), np.zeros_like(u)
            back = np.zeros((n, h), np.float32)
            for t, prev, z, r, q, cand in reversed(tapes[way]):
                d = dstate[t] + back
                da = d * (1 - z) * (1 - cand * cand)
                dq = da * r
                dgate = np.concatenate((d * (prev - cand) * z * (1 - z), da * q * r * (1 - r)), 1)
                back = d * z + dgate @ u[:, :2 * h].T + dq @ u[:, 2 * h:].T
                u_grad[:, :2 * h] += prev.T @ dgate
                u_grad[:, 2 * h:] += prev.T @ dq
                np.add.at(e_grad, seg[:, t], np.concatenate((dgate, da), 1))
            de.append(e_grad)
            du.append(u_grad)
        return loss, [*de, *du, dv.astype(np.float32), p.sum((0, 1)).astype(np.float32)]


def softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(-1, keepdims=True)
    np.exp(x, out=x)
    x /= x.sum(-1, keepdims=True)
    return x


def train(segments: list[bytes], langs: list[str], hidden: int = HIDDEN, steps: int | None = None,
          batch: int = BATCH, rate: float = 0.02, seed: int = 5) -> Network | None:
    """Fit a network to labelled segments with Adam; languages are drawn
    equally often, for ``steps`` (``STEPS``) batches. None without segments."""
    steps = steps or STEPS
    names = sorted(set(langs))
    if not names:
        return None
    rng = np.random.default_rng(seed)
    net = Network.new(names, hidden, rng)
    seg, mask = as_matrix(segments)
    of = np.array([names.index(x) for x in langs])
    by = [np.flatnonzero(of == i) for i in range(len(names))]
    mean = [np.zeros_like(w) for w in net.weights()]
    square = [np.zeros_like(w) for w in net.weights()]
    for step in range(1, steps + 1):
        pick = np.concatenate([rng.choice(b, -(-batch // len(by))) for b in by])
        _, grads = net.gradients(seg[pick], mask[pick], of[pick])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        now = rate * min(1.0, step / 20) * (1 - 0.95 * step / steps)
        for w, g, m, s in zip(net.weights(), grads, mean, square):
            g = g * min(1.0, 1.0 / (norm + 1e-9))
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            w -= now * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-7)
    return net


def as_matrix(segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Segments as rows of bytes, padded with 0, and where the bytes are real."""
    seg = np.frombuffer(b"".join(s.ljust(SEGMENT, b"\0") for s in segments), np.uint8).reshape(-1, SEGMENT)
    length = np.array([len(s) for s in segments])
    return seg, np.arange(SEGMENT)[None, :] < length[:, None]


def probabilities(net: Network, texts: list[str]) -> np.ndarray:
    """Mean of the position probabilities of each text; all bytes are read."""
    raws = [t.encode("utf-8", "surrogatepass") for t in texts]
    count = np.array([max(1, -(-len(r) // SEGMENT)) for r in raws])
    out = np.zeros((len(raws), len(net.langs)))
    owner = np.repeat(np.arange(len(raws)), count)
    data = np.frombuffer(b"".join(r.ljust(int(k) * SEGMENT, b"\0") for r, k in zip(raws, count)),
                         np.uint8).reshape(-1, SEGMENT)
    starts = np.concatenate(([0], np.cumsum(count)[:-1]))
    length = np.array([len(r) for r in raws])
    real = np.clip(length[owner] - (np.arange(len(owner)) - starts[owner]) * SEGMENT, 0, SEGMENT)
    for i in range(0, len(data), BLOCK):
        n = real[i:i + BLOCK]
        p = net.positions(data[i:i + BLOCK])
        if (n < SEGMENT).any():
            p *= (np.arange(SEGMENT)[:, None] < n[None, :])[:, :, None]
        np.add.at(out, owner[i:i + BLOCK], p.sum(0, dtype=np.float64))
    return out / np.maximum(length, 1)[:, None]


def held_out(doc_id) -> Column:
    """True for the quarter of documents that nothing is learned from."""
    d = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(d.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(documents: DataFrame, docs: int = FIT_DOCS, segments: int = FIT_SEGMENTS) -> tuple[list, list]:
    """Training segments and their languages, from documents not held out.

    Only byte segments of the sampled documents leave the executors: at most
    ``docs * segments`` per language. Documents are counted per language and
    thinned by a hash to about ``4 * docs`` of each before they meet, so what
    one task reads does not grow with the corpus.
    """
    learn = documents.filter("text is not null and lang is not null").filter(~held_out("doc_id"))
    share = learn.groupBy(F.col("lang").alias("_lang")).agg(
        (F.lit(4.0 * docs) / F.count(F.lit(1))).alias("_share"))
    share = staged(share, "lang-shares")
    raw = F.col("text").cast("binary")
    n = F.greatest(F.ceil(F.length(raw) / SEGMENT).cast("int"), F.lit(1))
    part = F.array_distinct(F.array(*[F.pmod(F.xxhash64("doc_id", F.lit(j)), n) for j in range(segments)]))
    # texts are cut to segments before the join, so none is ever shuffled
    rows = learn.select("lang", F.xxhash64("doc_id", F.lit("fit")).alias("o"), F.col("doc_id").alias("d"),
                        F.transform(part, lambda j: F.substring(raw, (j * SEGMENT + 1).cast("int"),
                                                                F.lit(SEGMENT))).alias("s"))
    rows = rows.join(share, F.col("lang") == F.col("_lang")).filter(thinned(F.col("_share"), "d"))
    w = Window.partitionBy("lang").orderBy("o", "d", "s")
    few = rows.withColumn("i", F.row_number().over(w)).filter(F.col("i") <= docs)
    got = [(bytes(s), r.lang) for r in few.orderBy("lang", "i").collect() for s in r.s if s]
    return [g[0] for g in got], [g[1] for g in got]


def fit(documents: DataFrame) -> Network | None:
    return train(*sample(documents))


def _scored(net: Network | None, texts: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Language and score of each text: ``und`` and 0 where the text is NULL or
    has no letter, or where nothing could be learned."""
    pred, score = np.full(len(texts), "und", object), np.zeros(len(texts))
    ok = np.array([t is not None and next(filter(str.isalpha, t), None) is not None for t in texts], bool)
    if net is not None and ok.any():
        p = probabilities(net, list(texts[ok]))
        pred[ok] = np.array(net.langs, object)[p.argmax(1)]
        score[ok] = np.clip(p.max(1), 0, 1)
    return pred, score


def predict(rows: DataFrame, net: Network | None) -> DataFrame:
    """``rows`` without their ``text``, with ``lang_pred`` and ``score``."""
    spark = rows.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(net)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b["lang_pred"], b["score"] = _scored(shared.value, b["text"])
            yield b.drop(columns="text")

    kept = [f for f in rows.schema.fields if f.name != "text"]
    schema = T.StructType([*kept, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    return rows.mapInPandas(run, schema)


def report(documents: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document. Only text and
    lang of documents not held out are learned from; only text is predicted from."""
    net = fit(documents)
    rows = documents.select("doc_id", held_out("doc_id").alias("held_out"), "text")
    return predict(rows, net)


def least_score(languages: int, evidence: float = EVIDENCE) -> float:
    """The score that counts as evidence for a language: a guess among ``languages`` has one over
    their number, certainty has 1, and ``evidence`` is the share of the way from one to
    the other. With a single language there is nothing to tell apart."""
    return 0.0 if languages < 2 else 1 / languages + evidence * (1 - 1 / languages)


def identified(documents: DataFrame, evidence: float = EVIDENCE) -> DataFrame:
    """The documents with a language: not ``und``, and scored at least
    :func:`least_score`. All columns are kept as they are; only the text goes to Python."""
    spark = documents.sparkSession
    small_batches(spark)
    net = fit(documents)
    shared, least = spark.sparkContext.broadcast(net), least_score(len(net.langs) if net else 0, evidence)

    @F.pandas_udf("boolean")
    def recognised(texts: pd.Series) -> pd.Series:
        pred, score = _scored(shared.value, texts)
        return pd.Series((pred != "und") & (score >= least))

    return documents.filter(recognised(F.col("text")))
