"""Language ID (operator 6): a bidirectional gated recurrent network over bytes, trained here by backpropagation through time.

A text is cut into stretches of ``SPAN`` bytes. In each, one recurrent layer reads forwards and one backwards; both states of a
position give the probabilities of the languages there, and a document's probabilities are the mean over all its positions.

The network is small, so it is fitted on the driver, on a bounded sample: of each language the ``SAMPLE_DOCS`` documents with the
smallest hash of their id, of each ``SAMPLE_SPANS`` stretches spread over the text. Prediction runs over all bytes of all texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from playlens.llm import rolling
from playlens.llm.stages import map_arrow, small_batches, table

SPAN, HIDDEN = 48, 8
SAMPLE_DOCS, SAMPLE_SPANS = 200, 8
STEPS, BATCH, RATE, SEED = 300, 192, 0.03, 7
AT_ONCE = 4_096  # stretches that step together
UNKNOWN = "und"
LEAST_SCORE = 0.35  # below it no language stands out
LETTER = regex.compile(r"\p{L}")


@dataclass
class Network:
    """Parameters, forward layer first: input rows per byte (r, z, n), recurrent matrix, output matrix and bias."""

    langs: list[str]
    inputs: np.ndarray  # (2, 256, 3 HIDDEN)
    recurrent: np.ndarray  # (2, HIDDEN, 3 HIDDEN)
    output: np.ndarray  # (2 HIDDEN, languages)
    bias: np.ndarray

    @classmethod
    def fresh(cls, langs: list[str], seed: int = SEED) -> Network:
        random = np.random.default_rng(seed)
        make = lambda *shape: (random.standard_normal(shape) * 0.3).astype(np.float32)
        return cls(langs, make(2, 256, 3 * HIDDEN), make(2, HIDDEN, 3 * HIDDEN), make(2 * HIDDEN, len(langs)), np.zeros(len(langs), np.float32))

    def parameters(self) -> list[np.ndarray]:
        return [self.inputs, self.recurrent, self.output, self.bias]

    def states(self, spans: np.ndarray, inside: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States (positions, spans, 2 HIDDEN) of byte rows (positions, spans). ``keep`` gets what training needs."""
        steps, n = spans.shape
        out = np.empty((steps, n, 2 * HIDDEN), np.float32)
        for side in (0, 1):
            h = np.zeros((n, HIDDEN), np.float32)
            table_, u = self.inputs[side], self.recurrent[side]
            part = out[:, :, side * HIDDEN: (side + 1) * HIDDEN]
            for t in range(steps) if side == 0 else range(steps - 1, -1, -1):
                x, w = table_[spans[t]], h @ u
                gates = x[:, : 2 * HIDDEN] + w[:, : 2 * HIDDEN]
                gates *= 0.5  # the logistic function by way of tanh
                np.tanh(gates, out=gates)
                gates += 1
                gates *= 0.5
                r, z, wn = gates[:, :HIDDEN], gates[:, HIDDEN:], w[:, 2 * HIDDEN:]
                new = r * wn
                new += x[:, 2 * HIDDEN:]
                np.tanh(new, out=new)
                after = h - new
                after *= z
                after += new
                after *= inside[t][:, None]
                if keep is not None:
                    keep.append((side, t, h, r, z, wn, new))
                h = after
                part[t] = h
        return out

    def _step(self, side: int):
        """One step of a layer for prediction: states and gates lie feature by feature, so all work is on long rows.

        The halves of the logistic function lie in the parameters, buffers are used again.
        """
        half = np.ones(3 * HIDDEN, np.float32)
        half[: 2 * HIDDEN] = 0.5
        rows, u = np.ascontiguousarray((self.inputs[side] * half).T), np.ascontiguousarray((self.recurrent[side] * half).T)
        buffers: dict[int, tuple] = {}

        def step(h: np.ndarray, symbols: np.ndarray) -> np.ndarray:
            n = h.shape[1]
            if n not in buffers:
                buffers[n] = np.empty((3 * HIDDEN, n), np.float32), np.empty((3 * HIDDEN, n), np.float32)
            x, w = buffers[n]
            np.take(rows, symbols, axis=1, out=x, mode="clip")
            np.matmul(u, h, out=w)
            gates, new = x[: 2 * HIDDEN], x[2 * HIDDEN:]
            gates += w[: 2 * HIDDEN]
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            w[2 * HIDDEN:] *= gates[:HIDDEN]
            new += w[2 * HIDDEN:]
            np.tanh(new, out=new)
            after = h - new
            after *= gates[HIDDEN:]
            after += new
            return after

        return step

    def sums(self, spans: np.ndarray, inside: np.ndarray) -> np.ndarray:
        """(languages, stretches): the probabilities of all positions added up."""
        steps, n = spans.shape
        partial = set(np.flatnonzero(inside.min(axis=1) == 0).tolist())
        forward, backward = self._step(0), self._step(1)
        scores = np.empty((steps, len(self.langs), n), np.float32)
        right = np.ascontiguousarray(self.output[HIDDEN:].T)
        h = np.zeros((HIDDEN, n), np.float32)
        for t in range(steps - 1, -1, -1):
            h = backward(h, spans[t])
            if t in partial:
                h *= inside[t]
            np.matmul(right, h, out=scores[t])
        left, bias = np.ascontiguousarray(self.output[:HIDDEN].T), self.bias[:, None]
        h = np.zeros((HIDDEN, n), np.float32)
        total = np.zeros((len(self.langs), n), np.float32)
        for t in range(steps):
            h = forward(h, spans[t])
            if t in partial:
                h *= inside[t]
            chance = scores[t]
            chance += left @ h
            chance += bias
            chance -= chance.max(axis=0)
            np.exp(chance, out=chance)
            chance *= inside[t] / chance.sum(axis=0)
            total += chance
        return total

    def probabilities(self, states: np.ndarray) -> np.ndarray:
        scores = states.reshape(-1, 2 * HIDDEN) @ self.output + self.bias
        scores -= scores.max(axis=1, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=1, keepdims=True)
        return scores.reshape(*states.shape[:2], -1)

    def gradients(self, spans: np.ndarray, inside: np.ndarray, labels: np.ndarray) -> tuple[list[np.ndarray], float]:
        """Gradients of the mean cross-entropy over all positions, through time."""
        trace: list = []
        states = self.states(spans, inside, trace)
        chance = self.probabilities(states)
        weight = inside / max(1.0, float(inside.sum()))
        loss = -float((np.log(chance[:, np.arange(len(labels)), labels] + 1e-9) * weight).sum())
        d_scores = chance
        d_scores[:, np.arange(len(labels)), labels] -= 1
        d_scores *= weight[:, :, None]
        flat = d_scores.reshape(-1, d_scores.shape[2])
        d_output = states.reshape(-1, 2 * HIDDEN).T @ flat
        d_states = (flat @ self.output.T).reshape(states.shape)
        d_inputs, d_recurrent = np.zeros_like(self.inputs), np.zeros_like(self.recurrent)
        d_h = np.zeros((spans.shape[1], HIDDEN), np.float32)
        last = None
        for side, t, h, r, z, wn, new in reversed(trace):
            if side != last:
                d_h, last = np.zeros_like(d_h), side
            d_h = (d_h + d_states[t, :, side * HIDDEN: (side + 1) * HIDDEN]) * inside[t][:, None]
            d_new = d_h * (1 - z) * (1 - new * new)
            d_z = d_h * (h - new) * z * (1 - z)
            d_r = d_new * wn * r * (1 - r)
            d_x = np.concatenate([d_r, d_z, d_new], axis=1)
            d_w = np.concatenate([d_r, d_z, d_new * r], axis=1)
            np.add.at(d_inputs[side], spans[t], d_x)
            d_recurrent[side] += h.T @ d_w
            d_h = d_h * z + d_w @ self.recurrent[side].T
        return [d_inputs, d_recurrent, d_output, flat.sum(axis=0)], loss

    def train(self, spans: np.ndarray, inside: np.ndarray, labels: np.ndarray, steps: int = STEPS, seed: int = SEED) -> list[float]:
        """Adam over random batches with as many stretches of each language."""
        random = np.random.default_rng(seed)
        members = [np.flatnonzero(labels == i) for i in range(len(self.langs))]
        means = [[np.zeros_like(p) for p in self.parameters()] for _ in (0, 1)]
        losses = []
        for step in range(1, steps + 1):
            pick = np.concatenate([random.choice(m, max(1, BATCH // len(members))) for m in members])
            grads, loss = self.gradients(spans[:, pick], inside[:, pick], labels[pick])
            losses.append(loss)
            rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
            for p, g, m, v in zip(self.parameters(), grads, *means):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        return losses

    def pooled(self, flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean probabilities over all positions of each text; zeros for an empty one."""
        out = np.zeros((len(offsets) - 1, len(self.langs)))
        row, start, size = cut(offsets)
        for i in range(0, len(row), AT_ONCE):
            s = slice(i, i + AT_ONCE)
            spans, inside = columns(flat, start[s], size[s])
            for k, sums in enumerate(self.sums(spans, inside)):
                out[:, k] += np.bincount(row[s], sums, minlength=len(out))
        return out / np.maximum(1, np.diff(offsets))[:, None]


def cut(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, size) of the stretches of all texts."""
    lengths = np.diff(offsets)
    n = -(-lengths // SPAN)
    row = np.repeat(np.arange(len(lengths)), n)
    start = offsets[:-1][row] + (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)) * SPAN
    return row, start, np.minimum(SPAN, offsets[1:][row] - start)


def columns(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte rows (positions, stretches) and which of them lie inside."""
    at = np.arange(SPAN)[:, None]
    inside = at < size[None, :]
    return flat[np.minimum(start[None, :] + at, len(flat) - 1)], inside.astype(np.float32)


def _stretch(text: str, at: str) -> str:
    return f"substring({text}, CAST({at} * length({text}) / {SAMPLE_SPANS} AS int) + 1, {SPAN})"


def trained(labelled: DataFrame, id_column: str, text: str, lang: str) -> Network | None:
    """A network fitted on the bounded sample of labelled rows; None without any."""
    rows = labelled.select(F.col(id_column).alias("id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    by_hash = W.partitionBy("lang").orderBy(F.xxhash64("id"), F.xxhash64("text"))
    stretches = F.expr(f"transform(sequence(0, {SAMPLE_SPANS - 1}), i -> {_stretch('text', 'i')})")
    few = rows.select("id", "lang", "text", F.row_number().over(by_hash).alias("rank")).filter(F.col("rank") <= SAMPLE_DOCS)
    sample = few.select("lang", "rank", stretches.alias("parts")).orderBy("lang", "rank").collect()  # SAMPLE_DOCS * SAMPLE_SPANS * SPAN characters a language
    if not sample:
        return None
    langs = sorted({r["lang"] for r in sample})
    texts = [(p.encode()[:SPAN], langs.index(r["lang"])) for r in sample for p in dict.fromkeys(r["parts"]) if p]
    flat, offsets = rolling.text_bytes(pa.array([t for t, _ in texts], pa.binary()))
    _, start, size = cut(offsets)
    spans, inside = columns(flat, start, size)
    network = Network.fresh(langs)
    network.train(spans, inside, np.array([label for _, label in texts]))
    return network


def held_out(id_column: str) -> Column:
    return F.coalesce(F.expr(f"crc32(CAST(CAST(`{id_column}` AS string) AS binary)) % 4 = 2"), F.lit(False))


def _judge(model: Network | None, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Predicted language and score of each text."""
    lettered = np.array([bool(x.is_valid and LETTER.search(x.as_py())) for x in column], bool)
    names, scores = np.full(len(lettered), UNKNOWN, object), np.zeros(len(lettered))
    if model is not None:
        for a, b in rolling.groups_of_rows(np.diff(rolling.text_bytes(column)[1]), rolling.CHUNK):
            pooled = model.pooled(*rolling.text_bytes(column.slice(a, b - a)))
            names[a:b] = np.array(model.langs, object)[pooled.argmax(axis=1)]
            scores[a:b] = np.minimum(1.0, pooled.max(axis=1))
    names[~lettered] = UNKNOWN
    scores[names == UNKNOWN] = 0.0
    return names, scores


def _fitted(docs: DataFrame, id_column: str, text: str, lang: str) -> Broadcast:
    """The network learnt from labelled rows that are not held out; some kilobytes."""
    small_batches(docs.sparkSession)
    learnt = docs.filter(F.col(id_column).isNotNull() & ~held_out(id_column))
    return docs.sparkSession.sparkContext.broadcast(trained(learnt, id_column, text, lang))


def recognised(docs: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang", least: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has a language: not ``und``, and a score of ``least`` or more."""
    shared = _fitted(docs, id_column, text, lang)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = _judge(shared.value, batch.column(text))
            yield batch.filter(pa.array((names != UNKNOWN) & (scores >= least)))

    return map_arrow(docs, work, docs.schema)


def predicted(docs: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per document: the id, held_out, lang_pred, score (pooled probability of the predicted language).

    Documents whose crc32(id) mod 4 is 2 are held out and never learnt from; a null id is not held out and not learnt from.
    ``und`` with score 0 where the text is null or has no letter, or where nothing could be learnt. Only the text is looked at.
    """
    shared = _fitted(docs, id_column, text, lang)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = _judge(shared.value, batch.column("text"))
            yield table(doc_id=batch.column("doc_id"), held_out=batch.column("held_out"), lang_pred=pa.array(names.tolist(), pa.string()), score=scores)

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), held_out(id_column).alias("held_out"), F.col(text).alias("text"))
    out = map_arrow(rows, work, "doc_id long, held_out boolean, lang_pred string, score double")
    return out.withColumnRenamed("doc_id", id_column)
