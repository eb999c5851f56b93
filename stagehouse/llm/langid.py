"""Language identification by a small byte convolutional network.

Texts are cut into fixed windows of bytes. Bytes are embedded, filters of
several widths slide over the window, each filter is max-pooled and a softmax
over the pooled values gives the languages; a text's probabilities are the
window probabilities weighted by their bytes. The network is trained in numpy on
labelled texts, a bounded sample (``TRAIN_PER_LANGUAGE`` documents of each
language, drawn by a hash of the id); every text is predicted whole.

Defined cases: a null text, or one without letters, is ``und`` with score 0;
rows without ``lang`` are not learned from; a null id hashes as the empty text;
repeated rows are predicted alike; equal probabilities go to the language first
in code-point order; without any labelled row everything is ``und``; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagehouse.llm.bytesops import as_bytes
from stagehouse.llm.common import read_table, uniform

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
EMBEDDED = 8
PAD = 256
TRAIN_PER_LANGUAGE = 1000
WINDOWS_PER_DOCUMENT = 3
EPOCHS = 12
# Windows predicted by one matrix product.
BATCH = 1024


def windows(texts: list[bytes], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fixed-length windows of all texts: byte ids, the text each belongs to, its bytes."""
    sizes = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    counts = np.maximum(1, -(-sizes // window))
    begin = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum(counts, out=begin[1:])
    ids = np.full((begin[-1], window), PAD, dtype=np.int16)
    flat = ids.reshape(-1)
    for text, at in zip(texts, begin[:-1] * window, strict=True):
        flat[at : at + len(text)] = np.frombuffer(text, dtype=np.uint8)
    owner = np.repeat(np.arange(len(texts)), counts)
    place = np.arange(begin[-1]) - np.repeat(begin[:-1], counts)
    return ids, owner, np.minimum(window, sizes[owner] - place * window)


class ByteNetwork:
    """Weights and both passes; all widths share one product, narrower filters are zero beyond theirs."""

    def __init__(self, languages: list[str], seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.reach = max(WIDTHS)
        total = FILTERS * len(WIDTHS)
        self.embed = rng.normal(0, 0.5, (PAD + 1, EMBEDDED)).astype(np.float32)
        self.mask = np.zeros((self.reach * EMBEDDED, total), dtype=np.float32)
        for k, width in enumerate(WIDTHS):
            self.mask[: width * EMBEDDED, k * FILTERS : (k + 1) * FILTERS] = 1
        self.filters = rng.normal(0, 0.3, self.mask.shape).astype(np.float32) * self.mask
        self.shift = np.zeros(total, dtype=np.float32)
        self.out = rng.normal(0, 0.1, (total, len(languages))).astype(np.float32)
        self.bias = np.zeros(len(languages), dtype=np.float32)

    def _columns(self, ids: np.ndarray) -> np.ndarray:
        n, length = ids.shape
        padded = np.full((n, length + self.reach - 1), PAD, dtype=ids.dtype)
        padded[:, :length] = ids
        embedded = self.embed[padded].reshape(n, -1)
        view = np.lib.stride_tricks.sliding_window_view(embedded, self.reach * EMBEDDED, axis=1)
        return np.ascontiguousarray(view[:, ::EMBEDDED]).reshape(n * length, -1), padded

    def _pooled(self, ids: np.ndarray):
        columns, padded = self._columns(ids)
        score = (columns @ self.filters).reshape(*ids.shape, -1)
        return score, columns, padded

    def probabilities(self, ids: np.ndarray) -> np.ndarray:
        score, _, _ = self._pooled(ids)
        return self._softmax(np.maximum(score.max(axis=1) + self.shift, 0))

    def _softmax(self, pooled: np.ndarray) -> np.ndarray:
        logits = pooled @ self.out + self.bias
        logits -= logits.max(axis=1, keepdims=True)
        raised = np.exp(logits)
        return raised / raised.sum(axis=1, keepdims=True)

    def gradients(self, ids: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
        n, length = ids.shape
        score, columns, padded = self._pooled(ids)
        best = score.argmax(axis=1)
        top = np.take_along_axis(score, best[:, None, :], axis=1)[:, 0] + self.shift
        pooled = np.maximum(top, 0)
        error = self._softmax(pooled)
        error[np.arange(n), target] -= 1
        error /= n
        back = (error @ self.out.T) * (top > 0)
        rows = (np.arange(n)[:, None] * length + best).ravel()
        picked = columns[rows].reshape(n, -1, columns.shape[1])
        filters = np.einsum("nf,nfc->cf", back, picked) * self.mask
        to_columns = (back[:, :, None] * self.filters.T[None]).reshape(-1, self.reach, EMBEDDED)
        seen = np.stack([padded[np.repeat(np.arange(n), best.shape[1]), best.ravel() + j] for j in range(self.reach)], 1)
        embed = np.zeros_like(self.embed)
        np.add.at(embed, seen.ravel(), to_columns.reshape(-1, EMBEDDED))
        return [embed, filters, back.sum(0), pooled.T @ error, error.sum(0)]

    def weights(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.shift, self.out, self.bias]


def train(languages: list[str], texts: list[bytes], labels: np.ndarray, epochs: int = EPOCHS) -> ByteNetwork:
    """Adam on randomly placed windows of the sampled texts."""
    rng = np.random.default_rng(11)
    net = ByteNetwork(languages)
    ids, owner, _ = windows(texts)
    order = rng.permutation(len(ids))
    nth = pd.Series(owner[order]).groupby(owner[order]).cumcount().to_numpy()
    used = order[nth < WINDOWS_PER_DOCUMENT]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in net.weights()]
    step = 0
    for _ in range(epochs):
        for batch in np.array_split(rng.permutation(used), max(1, len(used) // 128)):
            step += 1
            pairs = zip(net.weights(), net.gradients(ids[batch], labels[owner[batch]]), moments, strict=True)
            for weight, gradient, (first, second) in pairs:
                first += 0.1 * (gradient - first)
                second += 0.001 * (gradient**2 - second)
                weight -= 0.005 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
            net.filters *= net.mask
    return net


def predict(net: ByteNetwork, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Language number and probability of each text, a bounded number of windows at a time."""
    sums = np.zeros((len(texts), len(net.languages)))
    sizes = np.zeros(len(texts))
    first = 0
    while first < len(texts):
        last, held = first, 0
        while last < len(texts) and (last == first or held < BATCH * WINDOW):
            held += len(texts[last])
            last += 1
        ids, owner, weight = windows(texts[first:last])
        for at in range(0, len(ids), BATCH):
            part = slice(at, at + BATCH)
            heavy = net.probabilities(ids[part]) * weight[part, None]
            np.add.at(sums, owner[part] + first, heavy)
            np.add.at(sizes, owner[part] + first, weight[part])
        first = last
    mean = sums / np.maximum(sizes, 1)[:, None]
    best = mean.argmax(axis=1)
    return best, mean[np.arange(len(texts)), best]


def fold(doc_id: Column, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % of


def _letters(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def fit(labelled: DataFrame, per_language: int = TRAIN_PER_LANGUAGE) -> ByteNetwork | None:
    """Train on ``text`` and ``lang`` of a sample of rows that have both (``key`` draws it)."""
    usable = labelled.where(F.col("lang").isNotNull() & _letters(F.col("text")))
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    languages = sorted(counts, key=lambda x: x.encode())
    share = F.lit(0.0)
    for language in languages:
        share = F.when(F.col("lang") == language, per_language / counts[language]).otherwise(share)
    drawn = usable.where(uniform("langid", F.col("key")) < share).select("key", "text", "lang").collect()
    drawn.sort(key=lambda r: (str(r["key"]), r["lang"], r["text"]))
    number = {language: i for i, language in enumerate(languages)}
    labels = np.array([number[r["lang"]] for r in drawn], dtype=np.int64)
    if not len(labels):
        return None
    return train(languages, as_bytes([r["text"] for r in drawn]), labels)


def identify(docs: DataFrame, net: ByteNetwork | None) -> DataFrame:
    """All columns of ``docs`` plus ``lang_pred`` and ``score``."""
    unknown = docs.drop("lang_pred", "score")
    if net is None:
        return unknown.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)})
    held = docs.sparkSession.sparkContext.broadcast(net)

    @F.pandas_udf("lang_pred string, score double")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = held.value
        names = np.array(model.languages, dtype=object)
        for batch in batches:
            best, score = predict(model, as_bytes(batch.tolist()))
            yield pd.DataFrame({"lang_pred": names[best], "score": np.clip(score, 0.0, 1.0)})

    letters = _letters(F.col("text"))
    guess = unknown.withColumn("_guess", predicted(F.col("text").cast("binary")))
    return guess.withColumns(
        {
            "lang_pred": F.when(letters, F.col("_guess.lang_pred")).otherwise("und"),
            "score": F.when(letters, F.col("_guess.score")).otherwise(0.0),
        }
    ).drop("_guess")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 4) == 2
    labelled = docs.where(~held_out).select(F.col("doc_id").alias("key"), "text", "lang")
    found = identify(docs.select("doc_id", "text"), fit(labelled))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
