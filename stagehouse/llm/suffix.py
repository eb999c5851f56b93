"""Exact substring deduplication with a logarithmic family of sparse suffix arrays.

A byte is removed when a string of ``LENGTH`` bytes that covers it also starts
earlier (in a smaller document, or earlier in the same one).

Every start of such a string belongs to an anchor: the leftmost smallest hash among
its first ``WINDOW`` eight-byte grams, so equal strings have their anchor at the same
place. Consecutive starts with one anchor form a block, and the suffix array of a
batch holds one suffix per block: the bytes from its first start to the end of its
last string, ordered by a fingerprint of those bytes. Batches are cut by the core
that follows the anchor (the bytes all the block's strings share) into buckets. In
a bucket every batch's array is merge-scanned against the arrays of the existing
levels: of two equal suffixes the later one is a repeat, the earlier one stays in
its level. The batch then becomes a level of its own, and levels of like size merge,
so sizes grow geometrically.

Blocks whose core occurs with different surroundings may match in part. Only these
are expanded to one suffix per start, which pass through the same levels. A core
with several surroundings within a batch is sent on to expansion right there, so
a frequent passage adds at most one entry per batch to its bucket.

Suffixes are compared by 96 bits: a hash of their whole bytes and 32 bits of another
(of their core, or of all bytes). Two cores that agree in 32 bits of a bucket are only expanded in vain.

Defined cases: a null text is empty; a null id comes before all others; rows that
share an id are ordered by a hash of their text, and rows that also share the text
are one document (a string met again at its own place is no repeat), each returned with its result; texts shorter than ``LENGTH`` are
kept whole; an empty table gives no rows; further columns are kept by
``without_repeats`` and ignored by ``repeats``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stagehouse.llm import bytesops as B
from stagehouse.llm.common import bound_batches, parts_for, read_table, release_memory, text_bytes
from stagehouse.session import materialize

LENGTH = 100
WINDOW = 61
GRAM = 8
CORE = LENGTH - WINDOW + 1
# A text longer than this is worked on in pieces that overlap.
PIECE = 1 << 19
# Suffixes sorted into one array of a batch.
ARRAY = 1 << 18
BUCKET = 16 << 20
FIRST_ID = -(1 << 63)
# What an entry says: a suffix; a core with several surroundings; a repeat; a block to expand.
SUFFIX, SEVERAL, REPEAT, EXPAND = 0, 1, 2, 3
OFFSET = 40

FIRST = B.Rolling()
SECOND = B.Rolling(base=0xC2B2AE3D27D4EB4F, seed=77)

Arrays = tuple[np.ndarray, ...]


def _pieces(raw: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of pieces: bytes, where each piece begins, its text, its offset there, its number of starts."""
    held: list[tuple[int, int, int, bytes]] = []
    size = 0

    def flush():
        flat = np.frombuffer(b"".join(h[3] for h in held), dtype=np.uint8)
        sizes = np.array([len(h[3]) for h in held], dtype=np.int64)
        column = lambda k: np.array([h[k] for h in held], dtype=np.int64)
        return flat, np.cumsum(sizes) - sizes, column(0), column(1), column(2)

    for i, text in enumerate(raw):
        starts = len(text) - LENGTH + 1
        for at in range(0, starts, PIECE):
            part = text[at : at + PIECE + LENGTH - 1]
            held.append((i, at, min(PIECE, starts - at), part))
            size += len(part)
            if size >= PIECE:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


def anchors(flat: np.ndarray) -> np.ndarray:
    """For each start that fits: place of the leftmost smallest gram hash in its window."""
    n = len(flat) - GRAM + 1
    grams = np.lib.stride_tricks.as_strided(flat, (n, GRAM), (1, 1), writeable=False)
    grams = np.ascontiguousarray(grams).view("<u8").reshape(-1)
    best = (grams * B.U(0x9E3779B97F4A7C15)) ^ (grams >> B.U(29))
    best = (best * B.U(0xBF58476D1CE4E5B9)) & B.U(0xFFFFFFFF00000000)
    best |= np.arange(n, dtype=np.uint64)
    width = 1
    while width * 2 <= WINDOW:
        best = np.minimum(best[:-width], best[width:])
        width *= 2
    rest = WINDOW - width
    best = np.minimum(best[: len(best) - rest], best[rest:])
    return (best & B.U(0xFFFFFFFF)).astype(np.int64)


def _block_suffixes(raw: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    """Blocks of texts: text number, first start, number of starts, core hash, suffix hash."""
    for flat, begin, owner, offset, starts in _pieces(raw):
        anchor = anchors(flat)
        piece = np.repeat(np.arange(len(begin)), starts)
        place = begin[piece] + np.arange(len(piece)) - np.repeat(np.cumsum(starts) - starts, starts)
        mine = anchor[place]
        head = np.ones(len(mine), dtype=bool)
        head[1:] = (mine[1:] != mine[:-1]) | (piece[1:] != piece[:-1])
        at = np.flatnonzero(head)
        count = np.diff(np.append(at, len(mine)))
        low, core, piece = place[at], mine[at], piece[at]
        sums = FIRST.sums(flat)
        yield (
            owner[piece],
            low - begin[piece] + offset[piece],
            count,
            FIRST.spans(sums, core, core + CORE),
            FIRST.spans(sums, low, low + count - 1 + LENGTH),
        )


def _start_suffixes(raw: list[bytes], asked: list[np.ndarray]) -> Iterator[tuple[np.ndarray, ...]]:
    """The single starts asked for (``offset << 8 | starts`` of blocks): text, start, 1, two hashes."""
    wanted = []
    for packed in asked:
        packed = np.unique(np.asarray(packed, dtype=np.int64))
        low, count = packed >> 8, packed & 255
        wanted.append(np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
    for flat, begin, owner, offset, starts in _pieces(raw):
        texts, places, at = [], [], []
        for b, i, o, n in zip(begin.tolist(), owner.tolist(), offset.tolist(), starts.tolist(), strict=True):
            mine = wanted[i][slice(*np.searchsorted(wanted[i], [o, o + n]))]
            texts.append(np.full(len(mine), i))
            places.append(mine)
            at.append(mine - o + b)
        text, place, at = np.concatenate(texts), np.concatenate(places), np.concatenate(at)
        first, second = FIRST.sums(flat), SECOND.sums(flat)
        yield (
            text, place, np.ones(len(at), dtype=np.int64),
            SECOND.spans(second, at, at + LENGTH), FIRST.spans(first, at, at + LENGTH),
        )


def _runs(doc: np.ndarray, start: np.ndarray, count: np.ndarray) -> Arrays:
    """Join runs of starts that follow each other in a document, up to 255 starts."""
    order = np.lexsort((start, doc))
    doc, start, count = doc[order], start[order], count[order]
    if not len(doc):
        return doc, start, count
    follows = np.zeros(len(doc), dtype=bool)
    follows[1:] = (doc[1:] == doc[:-1]) & (start[1:] == start[:-1] + count[:-1])
    group = np.cumsum(~follows)
    total = np.cumsum(count)
    head = np.flatnonzero(~follows)
    # Cut long runs where another 128 starts are full.
    within = total - np.repeat((total - count)[head], np.diff(np.append(head, len(doc))))
    cut = ~follows
    cut[1:] |= ((within[1:] - 1) // 128 != (within[:-1] - 1) // 128) & (group[1:] == group[:-1])
    head = np.flatnonzero(cut)
    sums = np.add.reduceat(count, head)
    return doc[head], start[head], sums


def _batch_array(core, suffix, doc, start, count, expand: bool) -> tuple[Arrays, Arrays]:
    """Sort a batch into its suffix array; what is settled within the batch goes aside (with its kind)."""
    order = np.lexsort((start, doc, suffix, core))
    core, suffix, doc, start, count = (x[order] for x in (core, suffix, doc, start, count))
    # Repeated rows of one document give the same suffix again; it is no repeat of itself.
    own = np.ones(len(core), dtype=bool)
    own[1:] = (core[1:] != core[:-1]) | (suffix[1:] != suffix[:-1]) | (doc[1:] != doc[:-1]) | (start[1:] != start[:-1])
    core, suffix, doc, start, count = (x[own] for x in (core, suffix, doc, start, count))
    again = np.zeros(len(core), dtype=bool)
    again[1:] = (core[1:] == core[:-1]) & (suffix[1:] == suffix[:-1])
    kind = np.where(again, REPEAT, SUFFIX).astype(np.uint8)
    if expand and len(core):
        alone = np.flatnonzero(~again)
        group = core[alone]
        several = np.zeros(len(alone), dtype=bool)
        same = group[1:] == group[:-1]
        several[1:] |= same
        several[:-1] |= same
        kind[alone[several]] = EXPAND
        mark = several.copy()
        mark[1:] &= ~same
        marked = alone[mark]
    else:
        marked = np.zeros(0, dtype=np.int64)
    kept = np.concatenate([np.flatnonzero(kind == SUFFIX), marked])
    kinds = np.concatenate([np.full(len(kept) - len(marked), SUFFIX), np.full(len(marked), SEVERAL)]).astype(np.uint8)
    array = tuple(x[kept] for x in (core, suffix, doc, start, count)) + (kinds,)
    repeat = kind == REPEAT
    joined = _runs(doc[repeat], start[repeat], count[repeat])
    open_ = kind == EXPAND
    aside = tuple(np.concatenate([a, b[open_]]) for a, b in zip(joined, (doc, start, count), strict=True))
    return array, (*aside, np.repeat(np.array([REPEAT, EXPAND], dtype=np.uint8), [len(joined[0]), int(open_.sum())]))


PACKED = "bucket int, core binary, suffix binary, doc binary, start binary, count binary, kind binary"
KINDS = (np.uint32, np.uint64, np.int64, np.int64, np.uint8, np.uint8)
COLUMNS = [f.split()[0] for f in PACKED.split(", ")]


def _pack(array: Arrays, aside: Arrays, buckets: int) -> pd.DataFrame:
    """A row per bucket; entries set aside have no hashes and follow the others."""
    core, suffix = array[:2]
    bucket = ((core >> B.U(44)) % B.U(buckets)).astype(np.int64)
    order = np.lexsort((suffix, bucket))
    edge = np.searchsorted(bucket[order], np.arange(buckets + 1))
    spread = (aside[1] & 0xFFFF) % buckets
    by_spread = np.argsort(spread, kind="stable")
    far = np.searchsorted(spread[by_spread], np.arange(buckets + 1))
    rows = []
    for k in range(buckets):
        mine, other = order[edge[k] : edge[k + 1]], by_spread[far[k] : far[k + 1]]
        if not len(mine) and not len(other):
            continue
        columns = [core[mine] & B.U(0xFFFFFFFF), suffix[mine]]
        columns += [np.concatenate([a[mine], b[other]]) for a, b in zip(array[2:], aside, strict=True)]
        rows.append((k, *(B.planes(c.astype(t)) for c, t in zip(columns, KINDS, strict=True))))
    return pd.DataFrame(rows, columns=COLUMNS)


def _emit(buckets: int, expand: bool):
    """Batches of suffixes of the texts of a partition, packed by bucket."""

    def emit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[Arrays] = []
        size = 0

        def flush() -> pd.DataFrame:
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            return _pack(*_batch_array(*columns, expand), buckets)

        for frame in frames:
            raw = B.as_bytes(frame["text"].tolist())
            doc = frame["doc"].to_numpy(dtype=np.int64)
            copy = frame["copy"].to_numpy(dtype=np.int64) << OFFSET
            found = _block_suffixes(raw) if expand else _start_suffixes(raw, frame["blocks"].tolist())
            for owner, start, count, core, suffix in found:
                held.append((core, suffix, doc[owner], copy[owner] | start, count))
                size += len(core)
                if size >= ARRAY:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()
            held.clear()
        release_memory()

    return emit


class Levels:
    """The suffix arrays of a bucket: sorted by suffix, no suffix in two of them, sizes geometric."""

    def __init__(self) -> None:
        self.levels: list[Arrays] = []
        self.repeats: list[Arrays] = []

    def add(self, array: Arrays) -> None:
        """Merge-scan a sorted batch (core, suffix, doc, start, count) against all levels, then keep it."""
        for core, suffix, doc, start, _ in self.levels:
            if not len(array[0]):
                return
            at = np.minimum(np.searchsorted(suffix, array[1]), len(suffix) - 1)
            hit = np.flatnonzero((suffix[at] == array[1]) & (core[at] == array[0]))
            if not len(hit):
                continue
            at = at[hit]
            new_doc, new_start, count = array[2][hit], array[3][hit], array[4][hit]
            earlier = (new_doc < doc[at]) | ((new_doc == doc[at]) & (new_start < start[at]))
            other = (new_doc != doc[at]) | (new_start != start[at])
            later = np.where(earlier, doc[at], new_doc), np.where(earlier, start[at], new_start), count
            self.repeats.append(tuple(x[other] for x in later))
            doc[at[earlier]], start[at[earlier]] = new_doc[earlier], new_start[earlier]
            left = np.ones(len(array[0]), dtype=bool)
            left[hit] = False
            array = tuple(x[left] for x in array)
        if not len(array[0]):
            return
        self.levels.append(tuple(x.copy() for x in array))
        while len(self.levels) > 1 and 2 * len(self.levels[-1][0]) > len(self.levels[-2][0]):
            self._merge()

    def _merge(self) -> None:
        small, large = self.levels.pop(), self.levels.pop()
        both = tuple(np.concatenate(pair) for pair in zip(large, small, strict=True))
        order = np.argsort(both[1], kind="stable")
        self.levels.append(tuple(x[order] for x in both))

    def whole(self) -> Arrays:
        while len(self.levels) > 1:
            self._merge()
        return self.levels[0] if self.levels else tuple(np.zeros(0, dtype=t) for t in KINDS[:5])


def _scan(frame: pd.DataFrame) -> pd.DataFrame:
    """All batches of a bucket: its repeats and the blocks to expand."""
    levels, several, aside = Levels(), [], []
    for row in frame.itertuples():
        core, suffix, doc, start, count, kind = (
            B.from_planes(getattr(row, c), t) for c, t in zip(COLUMNS[1:], KINDS, strict=True)
        )
        n = len(core)
        aside.append((doc[n:], start[n:], count[n:], kind[n:]))
        doc, start, count, kind = doc[:n], start[:n], count[:n], kind[:n]
        several.append(core[kind == SEVERAL])
        real = kind == SUFFIX
        levels.add(tuple(x[real] for x in (core, suffix, doc, start, count)))
    core, _, doc, start, count = levels.whole()
    order = np.argsort(core, kind="stable")
    ordered = core[order]
    shared = np.isin(ordered, np.concatenate(several)) if several else np.zeros(len(ordered), dtype=bool)
    same = ordered[1:] == ordered[:-1]
    shared[1:] |= same
    shared[:-1] |= same
    opened = order[shared]
    parts = [(doc[opened], start[opened], count[opened], np.full(len(opened), EXPAND, dtype=np.uint8))]
    parts += [(*r, np.full(len(r[0]), REPEAT, dtype=np.uint8)) for r in levels.repeats]
    doc, start, count, kind = (np.concatenate(c) for c in zip(*parts, *aside, strict=True))
    del levels, parts, aside, several
    release_memory()
    return pd.DataFrame({"doc": doc, "start": start, "count": count.astype(np.int32), "kind": kind.astype(np.int32)})


FOUND = "doc long, start long, count int, kind int"


def _numbered(docs: DataFrame) -> DataFrame:
    """Add ``doc`` (the id, null first) and ``copy``: 0, or the number among texts that share the id."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST_ID))
    named = docs.withColumn("doc", doc)
    repeated = named.groupBy("doc").count().where("count > 1").select("doc")
    repeated = materialize(repeated, "repeated-ids")
    if repeated.isEmpty():
        return named.withColumn("copy", F.lit(0))
    tag = F.xxhash64("text")
    texts = named.join(repeated, "doc", "left_semi").select("doc", tag.alias("_tag")).distinct()
    order = Window.partitionBy("doc").orderBy("_tag")
    copies = materialize(texts.withColumn("copy", (F.row_number().over(order) - 1).cast("int")), "copies")
    joined = named.withColumn("_tag", tag).join(copies, ["doc", "_tag"], "left").drop("_tag")
    return joined.withColumn("copy", F.coalesce("copy", F.lit(0)))


def _by_document(found: DataFrame, name: str) -> DataFrame:
    """Blocks of a document as a list of ``offset << 8 | starts``."""
    packed = F.shiftleft(F.col("start").bitwiseAND((1 << OFFSET) - 1), 8).bitwiseOR(F.col("count").cast("long"))
    return found.groupBy(
        F.col("doc"), F.shiftright("start", OFFSET).cast("int").alias("copy")
    ).agg(F.collect_list(packed).alias(name))


def _find(numbered: DataFrame, total: int) -> tuple[DataFrame, DataFrame]:
    """Repeats per document: those of whole blocks, and those of expanded starts."""
    buckets = parts_for(total, BUCKET)
    suffixes = numbered.select("doc", "copy", F.col("text").cast("binary").alias("text")).mapInPandas(_emit(buckets, True), PACKED)
    blocks = materialize(suffixes.groupBy("bucket").applyInPandas(_scan, FOUND), "blocks")
    asked = _by_document(blocks.where(F.col("kind") == EXPAND), "blocks")
    # In the order of the final join's columns, so that both joins read one exchange of the texts.
    texts = numbered.select("text", "doc", "copy").join(asked, ["doc", "copy"])
    texts = texts.select("doc", "copy", F.col("text").cast("binary").alias("text"), "blocks")
    singles = texts.mapInPandas(_emit(buckets, False), PACKED).groupBy("bucket").applyInPandas(_scan, FOUND)
    return blocks.where(F.col("kind") == REPEAT), singles.where(F.col("kind") == REPEAT)


def _removed(size: int, packed) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of removed bytes."""
    if packed is None or not len(packed):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    packed = np.sort(np.asarray(packed, dtype=np.int64))
    low = packed >> 8
    high = np.maximum.accumulate(low + (packed & 255) - 1 + LENGTH)
    head = np.ones(len(low), dtype=bool)
    head[1:] = low[1:] > high[:-1]
    at = np.flatnonzero(head)
    return low[at], np.minimum(high[np.append(at[1:], len(low)) - 1], size)


def _cut(with_text: bool):
    def cut(texts: pd.Series, lists: pd.Series) -> pd.DataFrame:
        rows = []
        for text, packed in zip(B.as_bytes(texts.tolist()), lists.tolist(), strict=True):
            begin, end = _removed(len(text), packed)
            if len(begin):
                edges = zip([0, *end.tolist()], [*begin.tolist(), len(text)], strict=True)
                kept = b"".join(text[a:b] for a, b in edges)
            else:
                kept = text
            digest = hashlib.sha256(kept).hexdigest()
            left = kept.decode("utf-8", "ignore") if with_text else None
            rows.append((len(text), int((end - begin).sum()), len(begin), digest, left))
        return pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"])

    return cut


CUT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string"


def _deduplicated(docs: DataFrame, with_text: bool) -> DataFrame:
    bound_batches(docs.sparkSession)
    total = text_bytes(docs)
    numbered = _numbered(docs)
    whole, single = _find(numbered, total)
    lists = _by_document(whole.unionByName(single), "repeats")
    joined = numbered.join(lists, ["doc", "copy"], "left")
    cut = F.pandas_udf(_cut(with_text), CUT)(F.col("text").cast("binary"), "repeats")
    return joined.withColumn("cut", cut).drop("repeats", "copy")


def repeats(docs: DataFrame) -> DataFrame:
    """One row per document: sizes, removed runs, digest of what is kept."""
    cut = _deduplicated(docs.select("doc_id", "text"), False)
    own = F.when(F.col("doc") != FIRST_ID, F.col("doc")).alias("doc_id")
    return cut.select(own, "cut.n_bytes", "cut.n_removed", "cut.n_spans", "cut.kept_sha256")


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents with ``text`` cut to what is kept (bytes of a split character go) and ``n_chars`` to its length."""
    clash = [c for c in docs.columns if c in ("doc", "copy", "cut", "repeats")]
    held = docs.select(*docs.columns) if not clash else docs.withColumnsRenamed({c: f"_own_{c}" for c in clash})
    cut = _deduplicated(held, True)
    out = cut.withColumn("text", F.when(F.col("text").isNotNull(), F.col("cut.kept_text"))).drop("cut", "doc")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.withColumnsRenamed({f"_own_{c}": c for c in clash}).select(*docs.columns)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats(read_table(spark, sf_dir, "documents"))
