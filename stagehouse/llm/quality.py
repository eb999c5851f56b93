"""Quality classifier from weak labels.

Heuristic labellers vote on every whole text, each for one fault: ``junk``
(repetition, shouting, symbols, cell separators, cut-up text) or ``toxic``
(insults). A heuristic votes bad or not at all, for it sees one kind of fault only;
curated labels, where given, vote bad or good as one more labeller of each fault. Expectation-maximisation over the counts of vote
patterns (at most 3**labellers, whatever the number of documents) estimates how
each labeller votes on faulty and on sound documents; the accuracy of a curated
vote is not estimated but taken as ``TRUST``. The posteriors of a bounded
sample (``TRAIN_MOST`` documents, drawn by a hash of the id) train two hashed
linear scorers, each on the sampled documents with a vote on its fault; the scorers score every document. A document is rejected when its score
or, where some labeller found a fault, its posterior for either fault reaches
``LIMIT``.

Defined cases: a null or empty text has no votes but those of its labels, gets
the scorers' score of no features and is kept unless labelled faulty; documents without a row in ``labels``
get no curated vote; of several label rows of one id the worst counts; a null
label is no vote; repeated rows are scored alike; empty tables give no rows;
further columns are kept by ``accepted`` and ignored elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagehouse.llm import bytesops as B
from stagehouse.llm.common import bound_batches, read_table, release_memory, split_by_ids, uniform

# Insults.
INSULTS = (
    "clown", "disgusting", "idiot", "loser", "moron", "pathetic", "scum", "stupid", "trash", "worthless",
)
FAULTS = ("junk", "toxic")
LABELLERS = {
    "junk": ("repeats", "shouts", "symbols", "cells", "variety", "curated"),
    "toxic": ("insult", "curated"),
}
SLOTS = 1 << 18
TRAIN_MOST = 8_000
LIMIT = 0.5
BAD, GOOD = 2, 1
TRUST = 0.999
# The first bytes of a word that are features of their own, besides the whole word.
STEMS = (4, 5)
SIGNS = np.zeros(256, dtype=bool)
SIGNS[[ord(c) for c in "!#$%&*+/<=>@\\^_`{|}~"]] = True
UPPER = np.zeros(256, dtype=bool)
UPPER[ord("A") : ord("Z") + 1] = True


@dataclass
class Laid:
    """A block of texts as words, and what is counted per text."""

    flat: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    owner: np.ndarray
    hashes: np.ndarray
    stats: np.ndarray


def lay(texts: list[bytes]) -> Laid:
    flat, begin = B.lay_out(texts)
    lowered = B.LOWER[flat]
    starts, ends = B.word_spans(flat)
    owner = np.searchsorted(begin, starts, side="right") - 1
    # Punctuation at the end of a word is not part of it.
    for _ in range(3):
        last = flat[np.maximum(ends - 1, 0)]
        cut = (ends - starts > 1) & (SIGNS[last] | np.isin(last, np.frombuffer(b".,;:?'\")", dtype=np.uint8)))
        ends = ends - cut
    hashes = B.word_hashes(lowered, starts, ends)
    n = len(texts)
    count = np.bincount(owner, minlength=n).astype(float)
    again = np.zeros(len(starts), dtype=bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    pairs = owner.astype(np.uint64) * B.U(0x9E3779B97F4A7C15) ^ hashes
    _, first = np.unique(pairs, return_index=True)
    distinct = np.bincount(owner[first], minlength=n)
    per = lambda flags: np.add.reduceat(flags.astype(np.int64), begin[:-1])
    letters = per((lowered >= 97) & (lowered <= 122))
    stats = np.stack(
        [
            count,
            np.bincount(owner, weights=again, minlength=n) / np.maximum(count, 1),
            per(UPPER[flat]) / np.maximum(letters, 1),
            per(SIGNS[flat] & (flat != 124)) / np.maximum(count, 1),
            per(flat == 124) / np.maximum(count, 1),
            distinct / np.maximum(count, 1),
        ],
        axis=1,
    )
    return Laid(flat, starts, ends, owner, hashes, stats)


def _insult_hashes() -> np.ndarray:
    flat, _ = B.lay_out([w.encode() for w in INSULTS])
    return np.sort(B.word_hashes(flat, *B.word_spans(flat)))


def votes(laid: Laid) -> tuple[np.ndarray, np.ndarray]:
    """Votes of the labellers of junk and of toxic, without the curated ones."""
    count, again, upper, signs, cells, variety = laid.stats.T
    hit = np.isin(laid.hashes, _insult_hashes())
    insults = np.bincount(laid.owner[hit], minlength=len(count))
    some = count > 0

    def vote(bad: np.ndarray) -> np.ndarray:
        return np.where(some & bad, BAD, 0)

    long = count >= 20
    junk = [
        vote(again >= 0.15),
        vote((upper >= 0.5) & (count >= 5)),
        vote(signs >= 0.5),
        vote(cells >= 0.2),
        vote(long & (variety < 0.2)),
    ]
    toxic = [vote(insults > 0)]
    return np.stack(junk, 1), np.stack(toxic, 1)


def features(laid: Laid) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, slot) pairs: words, word stems and steps of the counts."""
    owners, slots = [laid.owner], [laid.hashes]
    padded = np.concatenate([B.LOWER[laid.flat], np.zeros(8, dtype=np.uint8)])
    size = laid.ends - laid.starts
    for stem in STEMS:
        long = size >= stem
        at = laid.starts[long]
        key = np.zeros(len(at), dtype=np.uint64)
        for j in range(stem):
            key = (key << B.U(8)) | padded[at + j].astype(np.uint64)
        owners.append(laid.owner[long])
        slots.append(B.mix64(key + B.U(stem << 56)))
    n = len(laid.stats)
    for k in range(1, laid.stats.shape[1]):
        step = np.minimum(np.floor(laid.stats[:, k] * 10), 20).astype(np.uint64)
        owners.append(np.arange(n))
        slots.append(B.mix64(step + B.U(1000 * k + 17)))
    owner, slot = np.concatenate(owners), np.concatenate(slots) % B.U(SLOTS)
    both = np.unique(owner.astype(np.int64) * SLOTS + slot.astype(np.int64))
    return (both // SLOTS).astype(np.int32), (both % SLOTS).astype(np.int32)


def expectation_maximisation(
    patterns: np.ndarray, counts: np.ndarray, prior: float = 0.1, rounds: int = 100
) -> tuple[np.ndarray, np.ndarray, float]:
    """Posterior of a fault for each vote pattern, the voting tables, the share of faults.

    Tables hold, for sound and faulty documents, how often each labeller gives
    each vote. They begin with labellers that are mostly right.
    """
    k = patterns.shape[1]
    tables = np.zeros((2, k, 3))
    tables[0], tables[1] = (0.9, 0.05, 0.05), (0.6, 0.05, 0.35)
    silent = counts[patterns[:, -1] == 0].sum() / max(counts.sum(), 1)
    told = np.array([[TRUST, 1 - TRUST], [1 - TRUST, TRUST]]) * np.clip(1 - silent, 1e-3, 1 - 1e-3)
    curated = np.concatenate([1 - told.sum(1, keepdims=True), told], 1)
    tables[:, -1] = curated
    one = np.arange(k)
    share, posterior = prior, np.zeros(len(patterns))
    for _ in range(rounds):
        sound = np.log(1 - share) + np.log(tables[0][one, patterns]).sum(1)
        faulty = np.log(share) + np.log(tables[1][one, patterns]).sum(1)
        posterior = 1 / (1 + np.exp(np.clip(sound - faulty, -500, 500)))
        for c, weight in enumerate((counts * (1 - posterior), counts * posterior)):
            for vote in range(3):
                tables[c, :, vote] = ((patterns == vote) * weight[:, None]).sum(0) + 0.5
        tables /= tables.sum(2, keepdims=True)
        tables[:, -1] = curated
        share = float(np.clip((counts * posterior).sum() / max(counts.sum(), 1), 1e-4, 0.5))
    return posterior, tables, share


def train_scorer(
    rows: int, owner: np.ndarray, slot: np.ndarray, target: np.ndarray, least: int = 5, z: float = 5.0
) -> tuple[np.ndarray, float]:
    """Logistic regression on the slots whose share of faulty texts stands out.

    A slot is used when it occurs in ``least`` texts and its share of faults is
    ``z`` standard deviations from the mean; Adam with a ridge fits those.
    """
    out, mean = np.zeros(SLOTS, dtype=np.float32), float(np.clip(target.mean() if rows else 0, 1e-4, 1 - 1e-4))
    seen = np.bincount(slot, minlength=SLOTS)
    faults = np.bincount(slot, weights=target[owner], minlength=SLOTS)
    off = (faults - seen * mean) / np.sqrt(np.maximum(seen, 1) * mean * (1 - mean))
    used = np.flatnonzero((seen >= least) & (np.abs(off) >= z))
    column = np.full(SLOTS, -1)
    column[used] = np.arange(len(used))
    chosen = column[slot] >= 0
    owner, column = owner[chosen], column[slot[chosen]]
    weight = np.zeros(len(used) + 1)
    weight[-1] = np.log(mean / (1 - mean))
    first, second = np.zeros_like(weight), np.zeros_like(weight)
    for step in range(1, 301):
        margin = np.bincount(owner, weights=weight[column], minlength=rows) + weight[-1]
        error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - target) / max(rows, 1)
        gradient = np.append(np.bincount(column, weights=error[owner], minlength=len(used)), error.sum())
        gradient[:-1] += 1e-4 * weight[:-1]
        first += 0.1 * (gradient - first)
        second += 0.01 * (gradient**2 - second)
        weight -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    out[used] = weight[:-1]
    return out, float(weight[-1])


def _label_votes(labels: DataFrame) -> DataFrame:
    """One row per labelled id: the curated votes on junk and toxic."""
    per = labels.groupBy(F.col("doc_id").alias("_labelled")).agg(
        F.min("quality").alias("quality"), F.max("toxic").alias("toxic")
    )
    return per.select(
        "_labelled",
        F.when(F.col("quality") == 0, BAD).when(F.col("quality") == 1, GOOD).otherwise(0).alias("_junk"),
        F.when(F.col("toxic") == 1, BAD).when(F.col("toxic") == 0, GOOD).otherwise(0).alias("_toxic"),
    )


def _vote_code(junk: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    code = np.zeros(len(junk), dtype=np.int64)
    for column in (*junk.T, *toxic.T):
        code = code * 3 + column
    return code


def _code_of(texts: pd.Series) -> pd.Series:
    raw = B.as_bytes(texts.tolist())
    out = np.zeros(len(raw), dtype=np.int64)
    for first, last in B.blocks(raw):
        out[first:last] = _vote_code(*votes(lay(raw[first:last])))
    return pd.Series(out)


def _patterns(code: np.ndarray, junk: np.ndarray, toxic: np.ndarray) -> dict[str, np.ndarray]:
    digits = np.stack([code // 3**k % 3 for k in range(5, -1, -1)], 1)
    return {
        "junk": np.concatenate([digits[:, :5], junk[:, None]], 1),
        "toxic": np.concatenate([digits[:, 5:], toxic[:, None]], 1),
    }


@dataclass
class Classifier:
    scorers: dict[str, tuple[np.ndarray, float]]
    tables: dict[str, tuple[np.ndarray, float]]

    def posterior(self, fault: str, patterns: np.ndarray) -> np.ndarray:
        tables, share = self.tables[fault]
        one = np.arange(patterns.shape[1])
        odds = np.log(share / (1 - share)) + (np.log(tables[1]) - np.log(tables[0]))[one, patterns].sum(1)
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))

    def posterior_of(self, fault: str, code: Column, curated: Column) -> Column:
        """:meth:`posterior` of a vote code and a curated vote as an expression, which needs no worker of its own."""
        tables, share = self.tables[fault]
        gain = np.log(tables[1]) - np.log(tables[0])
        first, last = (0, 5) if fault == "junk" else (5, 6)
        votes_ = [F.floor(code / 3 ** (5 - k)) % 3 for k in range(first, last)] + [F.coalesce(curated, F.lit(0))]
        odds = F.lit(float(np.log(share / (1 - share))))
        for given, vote in zip(gain.tolist(), votes_, strict=True):
            odds = odds + F.get(F.array(*[F.lit(g) for g in given]), vote.cast("int"))
        return 1 / (1 + F.exp(-F.least(F.greatest(odds, F.lit(-500.0)), F.lit(500.0))))

    def score(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Scores (text, fault) and vote codes."""
        scores, codes = np.zeros((len(texts), len(FAULTS))), np.zeros(len(texts), dtype=np.int64)
        for first, last in B.blocks(texts):
            laid = lay(texts[first:last])
            owner, slot = features(laid)
            codes[first:last] = _vote_code(*votes(laid))
            for k, fault in enumerate(FAULTS):
                weight, bias = self.scorers[fault]
                margin = np.bincount(owner, weights=weight[slot], minlength=last - first) + bias
                scores[first:last, k] = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
        return scores, codes


def _voted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    curated = _label_votes(labels)
    return docs.join(curated, docs["doc_id"].eqNullSafe(curated["_labelled"]), "left")


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAIN_MOST) -> Classifier:
    coded = docs.select("doc_id", F.pandas_udf(_code_of, "long")(F.col("text").cast("binary")).alias("code"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    counted = (
        _voted(coded, labels).select("code", zero("_junk"), zero("_toxic")).groupBy("code", "_junk", "_toxic").count()
    ).toPandas()
    patterns = _patterns(counted["code"].to_numpy(), counted["_junk"].to_numpy(), counted["_toxic"].to_numpy())
    n = int(counted["count"].sum())
    tables, model = {}, Classifier({}, {})
    for fault in FAULTS:
        _, table, share = expectation_maximisation(patterns[fault].astype(int), counted["count"].to_numpy())
        tables[fault] = (table, share)
    model.tables = tables
    drawn = docs.select("doc_id", "text").where(uniform("quality", F.col("doc_id")) < most / max(n, 1))
    rows = _voted(drawn, labels).select("doc_id", "text", zero("_junk"), zero("_toxic")).collect()
    rows.sort(key=lambda r: (str(r["doc_id"]), r["text"] or ""))
    texts = B.as_bytes([r["text"] for r in rows])
    given = {f: np.array([r[f"_{f}"] for r in rows], dtype=np.int64) for f in FAULTS}
    del rows
    owners, slots, codes = [], [], []
    for first, last in B.blocks(texts):
        laid = lay(texts[first:last])
        owner, slot = features(laid)
        owners.append(owner + np.int32(first))
        slots.append(slot)
        codes.append(_vote_code(*votes(laid)))
    del texts
    none = np.zeros(0, dtype=np.int32)
    owner, slot = np.concatenate([none, *owners]), np.concatenate([none, *slots])
    del owners, slots
    patterns = _patterns(np.concatenate([none.astype(np.int64), *codes]), given["junk"], given["toxic"])
    for fault in FAULTS:
        target = model.posterior(fault, patterns[fault].astype(int))
        voted = patterns[fault].any(axis=1)
        place = (np.cumsum(voted) - 1).astype(np.int32)
        mine = voted[owner]
        model.scorers[fault] = train_scorer(int(voted.sum()), place[owner[mine]], slot[mine], target[voted])
    return model


def classify(docs: DataFrame, labels: DataFrame | None, model: Classifier | None = None) -> DataFrame:
    """All columns of ``docs`` plus junk and toxic scores and posteriors and ``keep``; with a model, labels may be none."""
    bound_batches(docs.sparkSession)
    model = model or fit(docs, labels)
    held = docs.sparkSession.sparkContext.broadcast(model)
    made = ("junk_score", "toxic_score", "junk_posterior", "toxic_posterior", "keep")

    @F.pandas_udf("code long, junk double, toxic double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            scores, codes = held.value.score(B.as_bytes(batch.tolist()))
            yield pd.DataFrame({"code": codes, "junk": scores[:, 0], "toxic": scores[:, 1]})
        release_memory()

    # Else a filter on the scores would have them computed twice.
    scored = scored.asNondeterministic()
    base = docs.drop(*made).withColumn("_scored", scored(F.col("text").cast("binary")))
    if labels is None:
        joined = base.withColumns({"_junk": F.lit(0), "_toxic": F.lit(0)})
    else:
        curated = _label_votes(labels)
        joined = base.join(curated, base["doc_id"].eqNullSafe(curated["_labelled"]), "left")
    judged = joined.withColumns(
        {
            "junk_score": F.col("_scored.junk"),
            "toxic_score": F.col("_scored.toxic"),
            "junk_posterior": model.posterior_of("junk", F.col("_scored.code"), F.col("_junk")),
            "toxic_posterior": model.posterior_of("toxic", F.col("_scored.code"), F.col("_toxic")),
        }
    )
    limit = F.lit(LIMIT)
    faulty = F.greatest("junk_score", "toxic_score", "junk_posterior", "toxic_posterior") >= limit
    return judged.withColumn("keep", ~faulty).drop("_scored", "_labelled", "_junk", "_toxic")


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected, with the columns they came with."""
    model = fit(docs, labels)
    # Only texts that may have labels have to meet them.
    labelled, others = split_by_ids(docs, "doc_id", labels.select("doc_id"))
    kept = [classify(part, some, model).where("keep").select(*docs.columns) for part, some in ((labelled, labels), (others, None))]
    return kept[0].union(kept[1])


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return classify(docs, read_table(spark, sf_dir, "labels")).drop("text")
