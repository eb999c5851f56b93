"""Language-model scoring by context-tree weighting over bytes, beside a word baseline.

Each byte is eight binary decisions. For every context of 0 to ``DEPTH`` preceding
bytes and every node of the byte's binary tree the training texts are counted; the
Krichevsky-Trofimov estimates of all depths are mixed with the weights that the
tree recursion gives them on the training counts. A context that the training
texts do not have at a node takes no part there, so the mixture ends at the deepest one seen.

Counts of contexts and words grow with the corpus and are never broadcast. Texts
are dealt into batches of about ``BATCH`` bytes. Each batch asks buckets for what
it has seen: word hashes, and bytes with their contexts, whose bucket follows from
the ``TOP`` nearest bytes, so that a bucket holds whole subtrees. Every bucket sums
what all batches counted, mixes the depths from ``TOP`` on, and its answers meet
the batch again. The same ``TOP`` bytes have at most 256**3 codes below them,
however large the corpus.

Depths below ``TOP`` are mixed by a table with a row per pair of bytes, at most
256**2 + 256 rows of 3 x 255 numbers (200 MB, some MB for text), which bounds the
broadcast. Their weights are those of the tree cut at ``TOP``.

Defined cases: a null text is empty (one token, the end; score 0); a null id is
in the training part of ``op4``; repeated rows count and are
scored as often as they occur; without training texts all counts are 0 and every
decision is a half; an empty table gives no rows; further columns are ignored.
Words are lower-cased for the baseline; bytes are scored as they are. Contexts at
the beginning of a text are filled up with zero bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagehouse.llm import bytesops as B
from stagehouse.llm.common import parts_for, read_table, text_bytes
from stagehouse.llm.langid import fold
from stagehouse.session import materialize

DEPTH = 5
TOP = 3
BATCH = 6 << 20
BUCKET = 8 << 20
# Codes gathered before they are counted.
GATHERED = 1 << 22
LOG2 = np.log(2)


def codes(flat: np.ndarray, begin: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Each byte of the laid-out texts as one number: the byte before it, the one before that, ..., itself.

    Nearer bytes are more significant, so the codes of a subtree lie together when
    sorted. The space that ends each text is left out.
    """
    code = flat.astype(np.uint64)
    for back in range(1, depth + 1):
        code[back:] |= flat[:-back].astype(np.uint64) << B.U(8 * (depth - back + 1))
    # What lies before the beginning of a text counts as zero bytes.
    for place in range(depth):
        at = begin[:-1] + place
        own = ((1 << 8 * place) - 1) << 8 * (depth - place + 1) | 0xFF
        code[at[at < begin[1:]]] &= B.U(own)
    inside = np.ones(len(flat), dtype=bool)
    inside[begin[1:] - 1] = False
    return code[inside]


def context_counts(texts: DataFrame) -> DataFrame:
    """``code``, ``n`` over all texts: counts of bytes with ``TOP`` bytes of context."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pd.DataFrame:
            code, n = np.unique(np.concatenate(held), return_counts=True)
            return pd.DataFrame({"code": code.astype(np.int64), "n": n})

        for frame in frames:
            raw = B.as_bytes(frame["text"].tolist())
            for first, last in B.blocks(raw):
                held.append(codes(*B.lay_out(raw[first:last]), TOP))
                size += len(held[-1])
                if size >= GATHERED:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    binary = texts.select(F.col("text").cast("binary").alias("text"))
    return binary.mapInPandas(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def _lgamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after shifting the argument up by eight."""
    shift = np.zeros_like(x)
    for k in range(8):
        shift += np.log(x + k)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) - shift


SMALL = 1 << 12
LOG_HALF, LOG_WHOLE = _lgamma(np.arange(SMALL) + 0.5), _lgamma(np.arange(SMALL) + 1.0)


def _of_count(n: np.ndarray, small: np.ndarray, more: float) -> np.ndarray:
    """``lgamma(n + more)``, looked up where ``n`` is small."""
    out = small[np.minimum(n, SMALL - 1)]
    large = n >= SMALL
    if large.any():
        out[large] = _lgamma(n[large] + more)
    return out


def _kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of so many zeros and ones."""
    parts = _of_count(zeros, LOG_HALF, 0.5) + _of_count(ones, LOG_HALF, 0.5)
    return parts - _of_count(zeros + ones, LOG_WHOLE, 1.0) - np.log(np.pi)


def _weighted(kt: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log of the weighted probability of a node, and the weight of its own estimate."""
    whole = np.logaddexp(kt, below) - LOG2
    return whole, np.exp(np.minimum(kt - LOG2 - whole, 0))


def _bit_nodes(leaves: np.ndarray) -> np.ndarray:
    """Counts at all nodes of the byte's binary tree: node 1 is the root, 256 + byte a leaf."""
    nodes = np.zeros((len(leaves), 512), dtype=np.int64)
    nodes[:, 256:] = leaves
    for level in range(7, -1, -1):
        low, high = 1 << level, 2 << level
        nodes[:, low:high] = nodes[:, 2 * low : 2 * high : 2] + nodes[:, 2 * low + 1 : 2 * high : 2]
    return nodes


def _estimates(leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log KT of the inner nodes, the estimated probability of a zero there, and whether they were seen."""
    nodes = _bit_nodes(leaves)
    zeros, ones = nodes[:, 2:512:2], nodes[:, 3:512:2]
    return _kt(zeros, ones), (zeros + 0.5) / (zeros + ones + 1), zeros + ones > 0


def _pair_rows(frame: pd.DataFrame) -> pd.DataFrame:
    """For each pair of nearest bytes: counts of the next byte, and the summed log KT of the contexts one byte longer."""
    frame = frame.sort_values("code")
    code, n = frame["code"].to_numpy(), frame["n"].to_numpy()
    contexts, row = np.unique(code >> 8, return_inverse=True)
    pairs, pair = np.unique(contexts >> 8, return_inverse=True)
    leaves, below = np.zeros((len(pairs), 256), dtype=np.int64), np.zeros((len(pairs), 255))
    np.add.at(leaves, (pair[row], code & 255), n)
    for at in range(0, len(contexts), 1024):
        low, high = np.searchsorted(row, [at, at + 1024])
        part = np.zeros((min(1024, len(contexts) - at), 256), dtype=np.int64)
        part[row[low:high] - at, code[low:high] & 255] = n[low:high]
        np.add.at(below, pair[at : at + 1024], _estimates(part)[0])
    return pd.DataFrame(
        {"pair": pairs, "leaves": [x.tobytes() for x in leaves], "below": [x.tobytes() for x in below]}
    )


class Upper:
    """Depths 0 to 2: the chance of a zero at a node is ``own + rest * deeper``, or ``alone`` if no longer context was seen."""

    def __init__(self, pairs: np.ndarray, leaves: np.ndarray, below: np.ndarray) -> None:
        near = pairs & 0xFF00
        leaves1, below1 = np.zeros((256, 256), dtype=np.int64), np.zeros((256, 255))
        np.add.at(leaves1, near >> 8, leaves)
        kt2, zero2, seen2 = _estimates(leaves)
        whole2, stay2 = _weighted(kt2, below)
        np.add.at(below1, near >> 8, whole2)
        kt1, zero1, seen1 = _estimates(leaves1)
        whole1, stay1 = _weighted(kt1, below1)
        kt0, zero0, _ = _estimates(leaves1.sum(0, keepdims=True))
        _, stay0 = _weighted(kt0, whole1.sum(0, keepdims=True))
        alone1 = np.where(seen1, stay0 * zero0 + (1 - stay0) * zero1, zero0)
        own1, rest1 = stay0 * zero0 + (1 - stay0) * stay1 * zero1, (1 - stay0) * (1 - stay1)
        last = near >> 8
        alone2 = np.where(seen2, own1[last] + rest1[last] * zero2, alone1[last])
        # The first 256 rows are for pairs not seen, by their nearer byte.
        self.rows = (np.arange(65536) >> 8).astype(np.int32)
        self.rows[pairs] = 256 + np.arange(len(pairs))
        table = lambda one, two: np.concatenate([one, two]).astype(np.float32)
        self.own = table(alone1, own1[last] + rest1[last] * stay2 * zero2)
        self.rest = table(np.zeros_like(rest1), rest1[last] * (1 - stay2))
        self.alone = table(alone1, alone2)


def fit(texts: DataFrame, parts: int = 8) -> Upper:
    """The table of the upper depths; at most 256**2 rows come to the driver."""
    counts = context_counts(texts).withColumn("part", F.pmod(F.xxhash64(F.shiftright("code", 16)), F.lit(max(8, parts))))
    rows = counts.groupBy("part").applyInPandas(_pair_rows, "pair int, leaves binary, below binary").toPandas()
    laid = lambda name, kind, width: np.frombuffer(b"".join(rows[name]), dtype=kind).reshape(-1, width)
    return Upper(rows["pair"].to_numpy(dtype=np.int64), laid("leaves", np.int64, 256), laid("below", np.float64, 255))


def mixed_log10(code: np.ndarray, n: np.ndarray, upper: Upper) -> np.ndarray:
    """log10 probability of each code's byte after its context, by all depths.

    ``code`` is sorted and distinct and holds whole subtrees below ``TOP`` bytes;
    ``n`` are the training counts, 0 for what is only asked.
    """
    depths = range(DEPTH, TOP - 1, -1)
    keys, times, up = {DEPTH: code}, {DEPTH: n.astype(np.int64)}, {DEPTH: np.arange(len(code))}
    step = {}
    for d in depths[1:]:
        longer = keys[d + 1]
        keys[d], step[d] = np.unique(longer >> B.U(16) << B.U(8) | longer & B.U(255), return_inverse=True)
        times[d] = np.bincount(step[d], weights=times[d + 1], minlength=len(keys[d])).astype(np.int64)
        up[d] = step[d][up[d + 1]]
    row = upper.rows[(code >> B.U(8 * (DEPTH - 1))).astype(np.int64)]
    byte = (code & B.U(255)).astype(np.int64)
    total = np.zeros(len(code))
    for level in range(8):
        below, own, weight, groups, seen = None, {}, {}, {}, {}
        for d in depths:
            node = keys[d] >> B.U(8 - level)
            head = np.ones(len(node), dtype=bool)
            head[1:] = node[1:] != node[:-1]
            group = np.cumsum(head) - 1
            bit = (keys[d] >> B.U(7 - level) & B.U(1)).astype(bool)
            begin = np.flatnonzero(head)
            both = np.add.reduceat(times[d], begin)
            ones = np.add.reduceat(np.where(bit, times[d], 0), begin)
            kt = _kt(both - ones, ones)
            if below is None:
                whole, stay = kt, np.ones(len(kt))
            else:
                shorter = group[step[d][below[1]]]
                whole, stay = _weighted(kt, np.bincount(shorter, weights=below[0], minlength=len(kt)))
            below = (whole, begin)
            own[d], weight[d], groups[d], seen[d] = (both - ones + 0.5) / (both + 1), stay, group[up[d]], both > 0
        zero = own[DEPTH][groups[DEPTH]]
        for d in depths[1:]:
            g = groups[d]
            known = seen[d + 1][groups[d + 1]]
            zero = np.where(known, weight[d][g] * own[d][g] + (1 - weight[d][g]) * zero, own[d][g])
        place = ((1 << level) | (byte >> (8 - level))) - 1
        known = seen[TOP][groups[TOP]]
        zero = np.where(known, upper.own[row, place] + upper.rest[row, place] * zero, upper.alone[row, place])
        total += np.log10(np.where(byte >> (7 - level) & 1, 1 - zero, zero))
    return total


def _batch_codes(raw: list[bytes], buckets: int):
    """Distinct codes of a batch by bucket: all bytes' places in ``known``, ``known`` itself and where buckets begin."""
    found = [
        np.unique(codes(*B.lay_out(raw[first:last])), return_inverse=True) for first, last in B.blocks(raw, BATCH // 16)
    ]
    known = np.unique(np.concatenate([np.zeros(0, dtype=np.uint64), *(code for code, _ in found)]))
    place = [np.searchsorted(known, code)[back] for code, back in found]
    place = np.concatenate([np.zeros(0, dtype=np.int64), *place])
    found.clear()
    bucket = (B.mix64(known >> B.U(8 * (DEPTH - TOP + 1))) % B.U(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    moved = np.empty(len(order), dtype=np.int32)
    moved[order] = np.arange(len(order), dtype=np.int32)
    return known[order], moved[place], np.searchsorted(bucket[order], np.arange(buckets + 1))


def _batch_words(raw: list[bytes]):
    """Distinct words of a batch: per text the words' places in ``known``, and ``known`` itself."""
    hashes, owners = [], []
    for first, last in B.blocks(raw):
        flat, begin = B.lay_out(raw[first:last])
        lowered = B.LOWER[flat]
        starts, ends = B.word_spans(flat)
        hashes.append(B.word_hashes(lowered, starts, ends))
        owners.append(np.searchsorted(begin, starts, side="right") - 1 + first)
    none = np.zeros(0, dtype=np.uint64)
    known, place = np.unique(np.concatenate([none, *hashes]), return_inverse=True)
    return known, place, np.concatenate([none.astype(np.int64), *owners])


def _edges(known: np.ndarray, buckets: int) -> np.ndarray:
    """Where the sorted hashes cross from one bucket (a range of hashes) to the next."""
    bounds = np.array([(k << 64) // buckets for k in range(1, buckets)], dtype=np.uint64)
    return np.concatenate([[0], np.searchsorted(known, bounds), [len(known)]])


def _small(x: np.ndarray) -> bytes:
    """Numbers by significance, compressed: what batches and buckets send each other is most of the disk used."""
    return zstandard.ZstdCompressor(level=3).compress(B.planes(x))


def _large(data: bytes, kind: type) -> np.ndarray:
    return B.from_planes(zstandard.ZstdDecompressor().decompress(data), kind)


def _packed(code: np.ndarray) -> bytes:
    """Sorted codes as the steps between them, which are small."""
    return _small(np.diff(code, prepend=B.U(0)))


def _unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(_large(data, np.uint64), dtype=np.uint64)


def _ask(buckets: int):
    def ask(frame: pd.DataFrame) -> pd.DataFrame:
        raw = B.as_bytes(frame["text"].tolist())
        trained = ~frame["held_out"].to_numpy(dtype=bool)
        known, place, owner = _batch_words(raw)
        n = np.bincount(place, weights=trained[owner], minlength=len(known)).astype(np.int32)
        edge = _edges(known, buckets)
        seen, at, begin = _batch_codes(raw, buckets)
        sizes = np.fromiter((len(t) for t in raw), dtype=np.int64, count=len(raw))
        times = np.bincount(at, weights=np.repeat(trained, sizes), minlength=len(seen)).astype(np.int32)
        full = np.flatnonzero(np.diff(edge) + np.diff(begin))
        return pd.DataFrame(
            {
                "bucket": full,
                "batch": frame["batch"].iloc[0],
                "words": [known[edge[k] : edge[k + 1]].tobytes() for k in full],
                "n": [_small(n[edge[k] : edge[k + 1]]) for k in full],
                "codes": [_packed(seen[begin[k] : begin[k + 1]]) for k in full],
                "times": [_small(times[begin[k] : begin[k + 1]]) for k in full],
            }
        )

    return ask


def _summed(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes of a bucket and their counts, a bounded number of asked ones at a time."""
    known, total = np.zeros(0, dtype=np.uint64), np.zeros(0)
    held, size = [], 0
    for i, (code, times) in enumerate(zip(frame["codes"], frame["times"], strict=True)):
        held.append((_unpacked(code), _large(times, np.int32)))
        size += len(held[-1][0])
        if size >= GATHERED or i + 1 == len(frame):
            both, place = np.unique(np.concatenate([known, *[c for c, _ in held]]), return_inverse=True)
            total = np.bincount(place, weights=np.concatenate([total, *[t for _, t in held]]), minlength=len(both))
            known, held, size = both, [], 0
    return known, total


def _answer(upper):
    def answer(frame: pd.DataFrame) -> pd.DataFrame:
        """Sum a bucket's counts over all batches; each batch gets those of the words and codes it asked for."""
        asked = [np.frombuffer(x, dtype=np.uint64) for x in frame["words"]]
        given = [_large(x, np.int32) for x in frame["n"]]
        known, place = np.unique(np.concatenate(asked), return_inverse=True)
        total = np.bincount(place, weights=np.concatenate(given), minlength=len(known)).astype(np.int64)
        answers, at = [], 0
        for words in asked:
            answers.append(_small(total[place[at : at + len(words)]]))
            at += len(words)
        code, times = _summed(frame)
        log = mixed_log10(code, times, upper.value).astype(np.float32) if len(code) else np.zeros(0, dtype=np.float32)
        wanted = (_unpacked(x) for x in frame["codes"])
        first = np.arange(len(asked)) == 0
        return pd.DataFrame(
            {
                "batch": frame["batch"],
                "bucket": frame["bucket"],
                "counts": answers,
                "logs": [_small(log[np.searchsorted(code, x)]) for x in wanted],
                "kinds": np.where(first, (total > 0).sum(), 0),
                "tokens": np.where(first, total.sum(), 0),
            }
        )

    return answer


def _score(buckets: int, tokens: int, kinds: int, ends: int):
    def score(key, frame: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        raw = B.as_bytes(frame["text"].tolist())
        known, place, owner = _batch_words(raw)
        answers = answers.sort_values("bucket")
        none = np.zeros(0, dtype=np.int64)
        counts = np.concatenate([none, *[_large(x, np.int64) for x in answers["counts"]]])
        log = np.log10(counts + 0.1)[place]
        n = len(raw)
        n_words = np.bincount(owner, minlength=n)
        base = np.bincount(owner, weights=log, minlength=n) + np.log10(ends + 0.1)
        base -= (n_words + 1) * np.log10(tokens + 0.1 * (kinds + 1))
        known_words = np.bincount(owner, weights=counts[place] > 0, minlength=n).astype(np.int64)
        sizes = np.fromiter((len(t) for t in raw), dtype=np.int64, count=n)
        _, at, _ = _batch_codes(raw, buckets)
        logs = np.concatenate([none.astype(np.float32), *[_large(x, np.float32) for x in answers["logs"]]])
        model = np.bincount(np.repeat(np.arange(n), sizes), weights=logs[at], minlength=n)
        return pd.DataFrame(
            {
                "doc_id": frame["doc_id"],
                "held_out": frame["held_out"],
                "n_tokens": n_words + 1,
                "n_known": known_words + (ends > 0),
                "train_tokens": tokens,
                "base_score": base,
                "score": model,
                "bits_per_byte": -model / np.log10(2) / np.maximum(sizes, 1),
            }
        )

    return score


RESULT = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double, bits_per_byte double"
)


def score(docs: DataFrame) -> DataFrame:
    """Score ``docs`` (doc_id, text, held_out), learning from those not held out."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text", F.col("held_out").alias("held_out"))
    training = docs.where(~F.col("held_out"))
    total = text_bytes(docs)
    ends = training.count()
    batches, buckets = parts_for(total, BATCH), parts_for(total, BUCKET)
    upper = spark.sparkContext.broadcast(fit(training, buckets))
    dealt = docs.withColumn("batch", F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)).cast("int"))
    dealt = dealt.withColumn("text", F.col("text").cast("binary"))
    asked = dealt.groupBy("batch").applyInPandas(
        _ask(buckets), "bucket int, batch int, words binary, n binary, codes binary, times binary"
    )
    answered = materialize(
        asked.groupBy("bucket").applyInPandas(
            _answer(upper), "batch int, bucket int, counts binary, logs binary, kinds long, tokens long"
        ),
        "answers",
    )
    sums = answered.agg(F.sum("kinds").alias("kinds"), F.sum("tokens").alias("tokens")).first()
    kinds, tokens = int(sums["kinds"] or 0) + (ends > 0), int(sums["tokens"] or 0) + ends
    answers = answered.select("batch", "bucket", "counts", "logs")
    scored = dealt.groupBy("batch").cogroup(answers.groupBy("batch"))
    return scored.applyInPandas(_score(buckets, tokens, kinds, ends), RESULT)


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), 10) == 0)
    return score(docs.select("doc_id", "text", held_out.alias("held_out")))
