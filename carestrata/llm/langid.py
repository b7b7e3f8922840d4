"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the bytes of a word forwards and backwards and labels every position; a document's probabilities are
the average over all positions of all its words. Words are independent sequences, so a task runs each distinct word
once and counts it as often as it occurs, which changes nothing in the result. Training is backpropagation through
time in numpy with Adam.
"""

import dataclasses
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: bound of the training sample: so many documents of each language, chosen by a hash of their id, ...
TRAIN_DOCS = 150
#: ... none with more UTF-8 bytes than this, ...
TRAIN_BYTES = 16_384
#: ... of at most so many languages, the most frequent ones
MAX_LANGUAGES = 200
HIDDEN = 16
#: bytes of a sequence; longer words are cut
LONGEST = 24
#: training steps, each on so many words of one length
STEPS = 500
BATCH = 256
#: words a task remembers with their label sums before it starts anew
REMEMBERED_WORDS = 400_000
UNKNOWN = "und"

_LETTERS = re.compile(r"[^\W\d_]+")


def words_of_letters(text: str | None) -> list[str]:
    """Lower-cased runs of letters; white space cuts first, so that most words need no pattern."""
    out = []
    for w in (text or "").lower().split():
        if w.isalpha():
            out.append(w)
        else:
            out += _LETTERS.findall(w)
    return out


def sequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(bytes, length, word)``: padded byte rows of all words, cut at ``LONGEST``, with lengths and word numbers."""
    parts, owner = [], []
    for i, w in enumerate(words):
        b = w.encode("utf-8", "surrogatepass")
        for k in range(0, len(b), LONGEST):
            parts.append(b[k : k + LONGEST])
            owner.append(i)
    length = np.array([len(p) for p in parts], dtype=np.int64)
    rows = np.frombuffer(b"".join(p.ljust(LONGEST, b"\0") for p in parts), dtype=np.uint8).reshape(-1, LONGEST)
    return rows, length, np.array(owner, dtype=np.int64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


@dataclasses.dataclass
class Direction:
    """One gated recurrent unit: update and reset gates and candidate, from byte embeddings folded into one table."""

    table: np.ndarray  # [256, 3 * HIDDEN], input weights and bias of every byte
    gates: np.ndarray  # [HIDDEN, 2 * HIDDEN]
    candidate: np.ndarray  # [HIDDEN, HIDDEN]

    def run(self, rows: np.ndarray, keep: list | None = None) -> np.ndarray:
        """Hidden states ``[time, sequence, HIDDEN]`` of byte columns ``rows [sequence, time]``."""
        count, steps = rows.shape
        h = np.zeros((count, HIDDEN), dtype=np.float32)
        out = np.empty((steps, count, HIDDEN), dtype=np.float32)
        for t in range(steps):
            x = self.table[rows[:, t]]
            g = _sigmoid(x[:, : 2 * HIDDEN] + h @ self.gates)
            z, r = g[:, :HIDDEN], g[:, HIDDEN:]
            n = np.tanh(x[:, 2 * HIDDEN :] + (r * h) @ self.candidate)
            new = (1 - z) * n + z * h
            if keep is not None:
                keep.append((h, z, r, n))
            out[t] = h = new
        return out

    def back(self, rows: np.ndarray, keep: list, d_out: np.ndarray) -> list[np.ndarray]:
        """Gradients of table, gates and candidate from those of the states, through time."""
        d_table, d_gates, d_candidate = (np.zeros_like(x) for x in (self.table, self.gates, self.candidate))
        d_h = np.zeros_like(d_out[0])
        for t in reversed(range(rows.shape[1])):
            h, z, r, n = keep[t]
            d = d_out[t] + d_h
            d_n = d * (1 - z) * (1 - n * n)
            d_rh = d_n @ self.candidate.T
            d_z = d * (h - n) * z * (1 - z)
            d_r = d_rh * h * r * (1 - r)
            d_g = np.concatenate((d_z, d_r), axis=1)
            d_candidate += (r * h).T @ d_n
            d_gates += h.T @ d_g
            d_h = d * z + d_rh * r + d_g @ self.gates.T
            d_x = np.concatenate((d_g, d_n), axis=1)
            order = np.argsort(rows[:, t], kind="stable")
            values, first = np.unique(rows[order, t], return_index=True)
            d_table[values] += np.add.reduceat(d_x[order], first, axis=0)
        return [d_table, d_gates, d_candidate]


@dataclasses.dataclass
class Network:
    languages: list[str]
    forward: Direction
    backward: Direction
    out: np.ndarray  # [2 * HIDDEN, languages]
    bias: np.ndarray

    def positions(self, rows: np.ndarray, length: int) -> np.ndarray:
        """Label probabilities ``[time, sequence, languages]`` of sequences of one length."""
        rows = rows[:, :length]
        f = self.forward.run(rows)
        b = self.backward.run(rows[:, ::-1])[::-1]
        logits = np.concatenate((f, b), axis=2) @ self.out + self.bias
        p = np.exp(logits - logits.max(axis=2, keepdims=True))
        return p / p.sum(axis=2, keepdims=True)

    def word_sums(self, words: list[str]) -> np.ndarray:
        """For each word the sum of its positions' probabilities, and in the last column their number."""
        out = np.zeros((len(words), len(self.languages) + 1))
        if words:
            rows, length, word = sequences(words)
            for n in np.unique(length).tolist():
                at = np.flatnonzero(length == n)
                for begin in range(0, len(at), 4096):
                    part = at[begin : begin + 4096]
                    np.add.at(out[:, :-1], word[part], self.positions(rows[part], n).sum(axis=0))
                    np.add.at(out[:, -1], word[part], n)
        return out

    def documents(self, texts: list[str | None], known: dict[str, int], table: list[np.ndarray]) -> tuple[list[str], list[float]]:
        """Best language and its pooled probability; ``und`` and 0 for a text without letters."""
        if not known or len(known) > REMEMBERED_WORDS:
            known.clear()
            table[:] = [np.zeros((0, len(self.languages) + 1))]
        split = [words_of_letters(t) for t in texts]
        new = list({w for words in split for w in words if w not in known})
        table[0] = _appended(table[0], len(known), self.word_sums(new))
        known.update(zip(new, range(len(known), len(known) + len(new))))
        names, scores = [], []
        for words in split:
            if not words:
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            pooled = table[0][[known[w] for w in words]].sum(axis=0)
            pooled = pooled[:-1] / pooled[-1]
            best = int(pooled.argmax())
            names.append(self.languages[best])
            scores.append(min(1.0, float(pooled[best])))
        return names, scores


def _appended(table: np.ndarray, used: int, rows: np.ndarray) -> np.ndarray:
    """``table`` with ``rows`` after its first ``used``; grows by doubling."""
    if used + len(rows) > len(table):
        table = np.concatenate((table[:used], np.zeros((max(used, len(rows)) + 1024, table.shape[1]))))
    table[used : used + len(rows)] = rows
    return table


def train(texts: list[str], labels: list[str], seed: int = 5) -> Network:
    """Fit the network on the words of labelled documents, each word as often as it occurs in documents."""
    rng = np.random.default_rng(seed)
    languages = sorted(set(labels))
    number = {name: i for i, name in enumerate(languages)}
    pairs: dict[tuple[str, int], int] = {}
    for text, name in zip(texts, labels):
        for w in set(words_of_letters(text)):
            pairs[w, number[name]] = pairs.get((w, number[name]), 0) + 1
    k = max(1, len(languages))
    draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
    make = lambda: Direction(draw(256, 3 * HIDDEN) * 4, draw(HIDDEN, 2 * HIDDEN), draw(HIDDEN, HIDDEN))
    net = Network(languages, make(), make(), draw(2 * HIDDEN, k), np.zeros(k, dtype=np.float32))
    if len(languages) < 2 or not pairs:
        return net
    keys = sorted(pairs)
    rows, length, word = sequences([w for w, _ in keys])
    target = np.array([y for _, y in keys])[word]
    weight = np.sqrt(np.array([pairs[p] for p in keys], dtype=np.float32))[word]
    # every language weighs the same
    share = np.bincount(target, weights=weight, minlength=k)
    weight = (weight * (share.sum() / k / np.maximum(share, 1e-9))[target]).astype(np.float32)
    weight /= weight.mean()
    weights = [net.forward.table, net.forward.gates, net.forward.candidate, net.backward.table, net.backward.gates, net.backward.candidate, net.out, net.bias]
    first, second = [np.zeros_like(x) for x in weights], [np.zeros_like(x) for x in weights]
    batches = []
    for n in np.unique(length).tolist():
        at = rng.permutation(np.flatnonzero(length == n))
        batches += [(n, at[b : b + BATCH]) for b in range(0, len(at), BATCH)]
    order: list[int] = []
    for step in range(1, STEPS + 1):
        order = order or rng.permutation(len(batches)).tolist()
        n, at = batches[order.pop()]
        part = rows[at, :n]
        keep_f, keep_b = [], []
        f = net.forward.run(part, keep_f)
        b = net.backward.run(part[:, ::-1], keep_b)[::-1]
        states = np.concatenate((f, b), axis=2)
        logits = states @ net.out + net.bias
        delta = np.exp(logits - logits.max(axis=2, keepdims=True))
        delta /= delta.sum(axis=2, keepdims=True)
        delta[:, np.arange(len(at)), target[at]] -= 1
        delta *= (weight[at] / (n * len(at)))[None, :, None]
        d_states = delta @ net.out.T
        grads = [
            *net.forward.back(part, keep_f, d_states[:, :, :HIDDEN]),
            *net.backward.back(part[:, ::-1], keep_b, d_states[::-1, :, HIDDEN:]),
            np.einsum("tsh,tsk->hk", states, delta),
            delta.sum(axis=(0, 1)),
        ]
        rate = 0.01 * (1 - step / STEPS) + 1e-4
        for x, g, m, v in zip(weights, grads, first, second):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def held_out_quarter(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """``(text, lang)`` of at most ``train_docs`` documents of each of the ``MAX_LANGUAGES`` most frequent languages.

    The choice is by a hash of the id among documents that are not held out and have a language and 1 to
    ``TRAIN_BYTES`` bytes. Only ids and languages are ranked; texts are fetched for the chosen ids.
    """
    size = F.octet_length("text")
    fit = docs.where(F.col("lang").isNotNull() & ~held_out_quarter(F.col("doc_id")) & (size > 0) & (size <= TRAIN_BYTES))
    seen = fit.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()
    chosen = None
    for row in seen:
        ids = fit.where(F.col("lang") == row["lang"]).select("doc_id", "lang").orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_docs)
        chosen = ids if chosen is None else chosen.union(ids)
    if chosen is None:
        return fit.select("text", "lang").limit(0)
    rows = fit.select("doc_id", "text", "lang").join(F.broadcast(chosen.distinct()), ["doc_id", "lang"])
    return rows.groupBy("doc_id", "lang").agg(F.min("text").alias("text")).select("text", "lang")


def fit(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> Network:
    rows = training_rows(docs, train_docs).collect()  # at most MAX_LANGUAGES * train_docs rows, each bounded
    return train([r["text"] for r in rows], [r["lang"] for r in rows])


def identify(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` of every row of ``docs (doc_id, text, lang, ...)``.

    The network learns from documents that are not held out; a prediction sees the text alone. A text that is null or
    has no letter is ``und`` with score 0, and so is every text if no document has a language. Rows are judged one by
    one: repeated rows and null ids stay as they are (a null id is not held out), other columns are ignored, an empty
    table gives an empty result.
    """
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    net = fit(chosen, train_docs)
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known: dict[str, int] = {}
        table: list[np.ndarray] = []
        for texts in batches:
            names: list[str] = []
            scores: list[float] = []
            for start in range(0, len(texts), 256):
                part = texts.iloc[start : start + 256].tolist()
                if shared.value.languages:
                    a, b = shared.value.documents(part, known, table)
                else:
                    a, b = [UNKNOWN] * len(part), [0.0] * len(part)
                names += a
                scores += b
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    predict = F.pandas_udf(label, "lang_pred string, score double")
    rows = chosen.select("doc_id", held_out_quarter(F.col("doc_id")).alias("held_out"), predict(F.col("text")).alias("p"))
    return rows.select("doc_id", "held_out", "p.lang_pred", "p.score")
