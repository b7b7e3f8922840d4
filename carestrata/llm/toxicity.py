"""Toxicity by subword embeddings averaged into a linear softmax, both trained together in numpy.

A word is its bounded form and its character n-grams of three to five letters, hashed into one embedding table, so a
misspelt word shares most of its vectors with the known one. A passage of a few words is the average of its subword
vectors and goes through a two-class softmax. A document is as toxic as its most toxic passage; training follows that
passage too (multiple-instance learning), since labels are of documents.
"""

import dataclasses
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: bound of the training sample: so many labelled documents of each class, chosen by a hash of their id, ...
TRAIN_DOCS = 1_500
#: ... none with more UTF-8 bytes than this
TRAIN_BYTES = 32_768
DIM = 12
BUCKETS = 1 << 17
PASSAGE = 4
EPOCHS = 16
#: small samples are gone through until there were so many steps
MIN_STEPS = 320
BATCH = 64
#: share of a passage's subwords that a training step sees
SHOWN = 0.5
THRESHOLD = 0.7
#: words a task remembers with their scores before it starts anew
REMEMBERED_WORDS = 250_000
#: a longer run without white space is cut into pieces of this length
LONGEST_WORD = 40

_EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "¿¡«»„“”’…"


def pieces_of(text: str | None) -> list[str]:
    words = (text or "").lower().split()
    if len(max(words, key=len, default="")) <= LONGEST_WORD:
        return words
    return [w[i : i + LONGEST_WORD] for w in words for i in range(0, len(w), LONGEST_WORD)]


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``(word, bucket)``: for each word, by its place in the list, the buckets of its bounded form and of the n-grams
    of three to five characters in that, in no order within a word."""
    bounded = [f"<{w.strip(_EDGES) or w}>" for w in words]
    code = np.frombuffer("".join(bounded).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    lengths = np.array([len(b) for b in bounded], dtype=np.int64)
    word = np.repeat(np.arange(len(words)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(code))  # characters from here to the word's end
    whole = np.zeros(len(words), dtype=np.uint64)
    place = lengths[word] - left
    np.add.at(whole, word, _scrambled(code + (place.astype(np.uint64) << np.uint64(32))))
    owners, hashes = [np.arange(len(words))], [_scrambled(whole)]
    rolled = code
    for n in range(2, 6):
        rolled = rolled[: max(len(code) - n + 1, 0)] * np.uint64(0x9E3779B97F4A7C15) + code[n - 1 :]
        fits = left[: len(rolled)] >= n
        if n >= 3:
            owners.append(word[: len(rolled)][fits])
            hashes.append(_scrambled(rolled[fits] + np.uint64(n)))
    return np.concatenate(owners), (np.concatenate(hashes) & np.uint64(BUCKETS - 1)).astype(np.int64)


def _scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(31))


@dataclasses.dataclass
class Model:
    #: what each bucket adds to the logit of the toxic class
    scores: np.ndarray
    bias: float
    prior: float

    def _learn(self, words: list[str], known: dict[str, tuple[float, int]]) -> None:
        if words:
            word, bucket = subwords(words)
            sums = np.bincount(word, weights=self.scores[bucket], minlength=len(words)).tolist()
            known.update(zip(words, zip(sums, np.bincount(word, minlength=len(words)).tolist())))

    def documents(self, texts: list[str | None], known: dict[str, tuple[float, int]]) -> list[float]:
        """Score of each document's most toxic passage; the share of toxic training documents where there is no word."""
        if len(known) > REMEMBERED_WORDS:
            known.clear()
        split = [pieces_of(t) for t in texts]
        found = [[known.get(w) for w in words] for words in split]
        new = {w for words, got in zip(split, found) if None in got for w, x in zip(words, got) if x is None}
        self._learn(list(new), known)
        out = []
        for words, got in zip(split, found):
            if not words:
                out.append(self.prior)
                continue
            if None in got:
                got = [known[w] for w in words]
            logit = float(passage_means(np.array(got, dtype=np.float64)).max()) + self.bias
            out.append(1.0 / (1.0 + float(np.exp(-max(-500.0, min(500.0, logit))))))
        return out


def passage_means(sums: np.ndarray) -> np.ndarray:
    """Average subword score of every run of ``PASSAGE`` words, of all words if there are fewer."""
    width = min(PASSAGE, len(sums))
    total = np.concatenate((np.zeros((1, 2)), np.cumsum(sums, axis=0)))
    run = total[width:] - total[:-width]
    return run[:, 0] / run[:, 1]


def train(texts: list[str], labels: list[int], prior: float, seed: int = 7) -> Model:
    """Embeddings and softmax from labelled documents, by AdaGrad on each document's most toxic passage.

    Each round finds those passages with the model so far (the first with subwords that are more frequent in toxic
    documents than chance has it) and then takes steps on them; the smaller class is repeated to the size of the other.
    """
    rng = np.random.default_rng(seed)
    vocabulary: dict[str, int] = {}
    docs = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in pieces_of(t)], dtype=np.int64) for t in texts]
    toxic = np.array([y for d, y in zip(docs, labels) if len(d)], dtype=np.int64)
    docs = [d for d in docs if len(d)]
    embedding = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    head = rng.normal(0, 0.1, (DIM, 2)).astype(np.float32)
    bias = np.zeros(2, dtype=np.float32)
    if len(np.unique(toxic)) < 2:
        return Model(np.zeros(BUCKETS), float(np.log(prior / (1 - prior))) if 0 < prior < 1 else -10.0 + 20.0 * prior, prior)

    word, flat = subwords(list(vocabulary))
    flat = flat[np.argsort(word, kind="stable")]
    sizes = np.bincount(word)
    starts = np.concatenate((np.zeros(1, np.int64), np.cumsum(sizes)))
    stream = np.concatenate(docs)
    lengths = np.array([len(d) for d in docs])
    begins = _offsets(lengths)
    width = np.minimum(PASSAGE, lengths)
    # every passage that lies in one document
    first = np.concatenate([b + np.arange(n - w + 1) for b, n, w in zip(begins, lengths, width)])
    owner = np.repeat(np.arange(len(docs)), lengths - width + 1)
    last = first + width[owner]
    passages = _offsets(lengths - width + 1)

    def worst(lean: np.ndarray) -> np.ndarray:
        each = np.add.reduceat(lean[flat], starts[:-1])
        total = np.concatenate((np.zeros(1), np.cumsum(each[stream])))
        many = np.concatenate((np.zeros(1), np.cumsum(sizes[stream])))
        means = (total[last] - total[first]) / (many[last] - many[first])
        best = np.maximum.reduceat(means, passages)
        hit = np.flatnonzero(means == best[owner])
        return hit[np.unique(owner[hit], return_index=True)[1]]

    seen = np.zeros((2, BUCKETS))
    for d, y in zip(docs, toxic):
        seen[y, np.unique(_gather(flat, starts, np.unique(d)))] += 1
    expected = toxic.sum() * seen.sum(axis=0) / len(docs)
    lean = (seen[1] - expected) / np.sqrt(expected + 1)

    squares = [np.full(x.shape, 1e-6, dtype=np.float32) for x in (embedding[:, :1], head, bias)]
    sides = [np.flatnonzero(toxic == y) for y in (0, 1)]
    longer = max(MIN_STEPS * BATCH // (2 * EPOCHS), *(len(x) for x in sides))
    for epoch in range(EPOCHS):
        rate = 0.3 * (1 - epoch / EPOCHS)
        at = worst(lean)
        order = np.concatenate([np.resize(rng.permutation(x), longer) for x in sides])
        rng.shuffle(order)
        for begin in range(0, len(order), BATCH):
            batch = order[begin : begin + BATCH]
            chosen = at[batch]
            # a clean document also shows a passage at random
            clean = batch[toxic[batch] == 0]
            chosen = np.concatenate((chosen, passages[clean] + rng.integers(0, lengths[clean] - width[clean] + 1)))
            wanted = np.concatenate((toxic[batch], np.zeros(len(clean), np.int64)))
            bags = [_gather(flat, starts, stream[first[k] : last[k]]) for k in chosen]
            # any subword may be missing, as in a misspelt word
            bags = [b[np.append(rng.random(len(b) - 1) < SHOWN, True)] for b in bags]
            counts = np.array([len(c) for c in bags])
            rows = np.concatenate(bags)
            vectors = np.add.reduceat(embedding[rows], _offsets(counts), axis=0) / counts[:, None]
            logits = vectors @ head + bias
            logits -= logits.max(axis=1, keepdims=True)
            delta = np.exp(logits)
            delta /= delta.sum(axis=1, keepdims=True)
            delta[np.arange(len(chosen)), wanted] -= 1.0
            down = (delta @ head.T / np.sqrt(counts)[:, None]).astype(np.float32)  # shared vectors take a larger step
            touched, where = np.unique(rows, return_inverse=True)
            by_row = np.argsort(where, kind="stable")
            step = np.add.reduceat(np.repeat(down, counts, axis=0)[by_row], _offsets(np.bincount(where)), axis=0)
            squares[0][touched] += (step**2).mean(axis=1, keepdims=True)
            embedding[touched] -= rate * step / np.sqrt(squares[0][touched])
            for x, g, k in ((head, vectors.T @ delta, 1), (bias, delta.sum(axis=0), 2)):
                squares[k] += g**2
                x -= (rate * g / np.sqrt(squares[k])).astype(np.float32)
        lean = (embedding @ (head[:, 1] - head[:, 0])).astype(np.float64)
    return Model(lean, float(bias[1] - bias[0]), prior)


def _offsets(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate((np.zeros(1, np.int64), np.cumsum(sizes)[:-1]))


def _gather(flat: np.ndarray, starts: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The subwords of several words in a row."""
    sizes = starts[words + 1] - starts[words]
    return flat[np.repeat(starts[words] - _offsets(sizes), sizes) + np.arange(sizes.sum())]


def training_rows(docs: DataFrame, labels: DataFrame, held_out: Column, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """``(text, toxic)`` of at most ``train_docs`` labelled documents of each class that are not held out.

    The choice is by a hash of the id among documents of 1 to ``TRAIN_BYTES`` bytes: ids of up to twice as many labels
    of each class are taken, then of the documents that exist and fit.
    """
    key = F.xxhash64(F.col("doc_id"))
    known = labels.where(F.col("toxic").isin(0, 1) & ~held_out).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    ids = [known.where(F.col("toxic") == y).orderBy(key, "doc_id").limit(2 * train_docs) for y in (0, 1)]
    side = F.broadcast(ids[0].union(ids[1]))  # at most four times train_docs rows
    size = F.octet_length("text")
    rows = docs.select("doc_id", "text").where((size > 0) & (size <= TRAIN_BYTES)).join(side, "doc_id")
    rows = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    picked = [rows.where(F.col("toxic") == y).orderBy(key, "doc_id").limit(train_docs) for y in (0, 1)]
    return picked[0].union(picked[1]).select("text", "toxic")


def held_out_third(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> Model:
    """Train on a bounded sample of the labelled documents outside the held-out third.

    Without rows of both classes the model gives every document the share of toxic ones (a half if there is no row).
    """
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    held_out = held_out_third(F.col("doc_id"))
    counts = labels.where(F.col("toxic").isin(0, 1) & ~held_out).agg(F.avg("toxic")).first()[0]
    rows = training_rows(docs, labels, held_out, train_docs).collect()  # at most twice train_docs rows, each bounded
    return train([r["text"] for r in rows], [r["toxic"] for r in rows], 0.5 if counts is None else float(counts))


def toxicity_of(docs: DataFrame, model: Model, column: str = "text") -> Column:
    """Column expression: the toxicity of a text, from the text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[str, tuple[float, int]] = {}
        for texts in batches:
            out: list[float] = []
            for start in range(0, len(texts), 128):
                out += shared.value.documents(texts.iloc[start : start + 128].tolist(), known)
            yield pd.Series(out, dtype="float64")

    score = F.pandas_udf(score, "double")
    return score(F.col(column))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row of ``docs (doc_id, text, ...)``.

    Null, empty and wordless texts get the share of toxic labels. Rows are scored one by one: repeated rows and null ids
    stay as they are (a null id is not held out), other columns are ignored, an empty table gives an empty result.
    """
    model = fit(docs, labels, train_docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = rows.select("doc_id", held_out_third(F.col("doc_id")).alias("held_out"), toxicity_of(docs, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with the columns they came with."""
    return docs.where(toxicity_of(docs, fit(docs, labels, train_docs)) < threshold)
