"""Size-aware heavy-light join of word-shingle sets by Jaccard similarity.

Equal sets are collapsed first. Sets up to a boundary size are joined on hashes of
all their subsets of the size a partner must share; larger ones are joined by
scanning inverted lists of their prefixes. Prefixes follow one order of all
shingles, frequent ones last, so any two sets that link share a list; the order
changes only the cost. The boundary is where subsets begin to cost more than list
scans, by the counted sizes and frequencies.

Links are looked for in three steps, so that a large group of copies never becomes
all its pairs. First every list's sets are checked against leaders of about their
size that come first in orders of all sets, so that a group has few of them. Over
the components so found, sets are checked against a leader of another component
that differs from list to list. Last, pairs of a list that still lie in different
components are checked, tile by tile within tasks; pairs in one component cannot
change the result. There a first pass only names sets that have a candidate partner,
and a second one names their pairs by finer sketches.
A check compares sizes, then parity sketches (their distance never exceeds the
symmetric difference, so this drops no link), then the exact sets.

A list keeps the sets that have a partner in it by size and by the place of its
shingle in both: linked sets stay together in the list of the first shingle they
share, where neither has had too many shingles before it.

Lists travel as packed arrays in buckets of bounded size and are taken apart by
the whole shingle hash; what the driver holds is the frequency table of at most
``HOT`` shingles, which bounds its broadcast.

Defined cases: without words the set is empty and links with nothing; a null id
links with nothing and is its own (null) component; rows that share an id are one
node with the links of each text (``without_near_duplicates`` judges each text by itself); repeated rows are one set; an empty table gives
no rows; further columns are ignored, or kept by ``without_near_duplicates``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagehouse.llm import bytesops as B
from stagehouse.llm.common import bound_batches, parts_for, read_table, release_memory, split_by_ids
from stagehouse.llm.graph import components
from stagehouse.operators.joins import unplaced
from stagehouse.session import materialize

SHINGLE = 5
# A shingle is frequent when it makes up more than one in HOT of all; so there are at most HOT.
HOT = 1 << 20
HOT_LEAST = 10
# A task reports the shingles that occur this often among so many gathered ones.
SEEN = 2
GATHERED = 1 << 22
POSTINGS = 2_000_000
# Sets of a list that one tile holds on a side.
LIST_BLOCK = 512
# Neighbours in a list that a set's places are held against; in longer lists all sets stay.
NEIGHBOURS = 64
# Times as many bits have the finer sketches, by which pairs are named after sets without a partner are gone.
FINE = 4
# Places in a set travel as this many parts of its size.
PLACES = 1000
# Orders of the sets by which all lists choose a leader.
SHARED = 2
# Subsets a set is enumerated into at most, however long lists are.
MOST_SUBSETS = 256
# Bytes of text whose postings are packed together.
PART = 8 << 20

ODD = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
    dtype=np.uint64,
)


def shingle_sets(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, shingle hash) pairs of a block, ordered by both."""
    flat, begin = B.lay_out(raw)
    starts, ends = B.word_spans(flat)
    words = B.word_hashes(B.LOWER[flat], starts, ends)
    owner = np.searchsorted(begin, starts, side="right") - 1
    count = np.bincount(owner, minlength=len(raw))
    first = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum(count, out=first[1:])
    full = np.zeros(0, dtype=np.int64)
    hashes = np.zeros(0, dtype=np.uint64)
    if len(words) >= SHINGLE:
        last = len(words) - SHINGLE + 1
        full = np.flatnonzero(owner[:last] == owner[SHINGLE - 1 :])
        hashes = sum(words[full + j] * ODD[j] for j in range(SHINGLE))
    short = np.flatnonzero((count > 0) & (count < SHINGLE))
    brief = np.zeros(len(short), dtype=np.uint64)
    for j in range(SHINGLE - 1):
        there = count[short] > j
        brief[there] += words[first[short[there]] + j] * ODD[j]
    brief += count[short].astype(np.uint64) * B.U(0x8CB92BA72F3D8DD7)
    owners = np.concatenate([owner[full], short])
    hashes = B.mix64(np.concatenate([hashes, brief]))
    order = np.lexsort((hashes, owners))
    owners, hashes = owners[order], hashes[order]
    new = np.ones(len(owners), dtype=bool)
    new[1:] = (owners[1:] != owners[:-1]) | (hashes[1:] != hashes[:-1])
    return owners[new], hashes[new]


def _signatures(size: int, owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Set sizes and signatures: a sum over the scrambled shingles."""
    n = np.bincount(owner, minlength=size)
    sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(B.mix64(hashes ^ B.U(0x5851F42D4C957F2D)), out=sums[1:])
    stop = np.cumsum(n)
    return n, B.mix64(sums[stop] - sums[stop - n] + n.astype(np.uint64)).view(np.int64)


def sketches(n: np.ndarray, owner: np.ndarray, hashes: np.ndarray, times: int = 1) -> list[bytes]:
    """Parities of the shingles that fall on each bit; about ``times`` as many bits as shingles, a power of two."""
    bits = times * np.maximum(64, 1 << np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64))
    begin = np.zeros(len(n) + 1, dtype=np.int64)
    np.cumsum(bits, out=begin[1:])
    place = begin[owner] + ((hashes >> B.U(20)).astype(np.int64) & (bits[owner] - 1))
    packed = np.packbits((np.bincount(place, minlength=begin[-1]) & 1).astype(np.uint8)).tobytes()
    return [packed[a // 8 : b // 8] for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)]


def _distance(a: bytes, b: bytes) -> int:
    x, y = np.frombuffer(a, dtype=np.uint8), np.frombuffer(b, dtype=np.uint8)
    while len(x) > len(y):
        x = x.reshape(2, -1)[0] ^ x.reshape(2, -1)[1]
    while len(y) > len(x):
        y = y.reshape(2, -1)[0] ^ y.reshape(2, -1)[1]
    return int(np.bitwise_count(x ^ y).sum())


def prefix_length(n: np.ndarray) -> np.ndarray:
    """So many first shingles: two sets that link share one of them."""
    return n - (3 * n + 3) // 4 + 1


def subset_sizes(n: int) -> list[tuple[int, int]]:
    """(size of the larger set, shingles it must share) for partners of a set of ``n``."""
    return [(t, -(-3 * t // 4)) for t in range(n, 4 * n // 3 + 1) if -(-3 * t // 4) <= n]


def boundary(mean_list: float) -> int:
    """Largest size whose subsets cost no more than scanning its prefix lists, and are at most ``MOST_SUBSETS``."""
    n = 0
    while sum(comb(n + 1, k) for _, k in subset_sizes(n + 1)) <= min(
        MOST_SUBSETS, (n + 2 - (3 * n + 6) // 4) * max(1.0, mean_list)
    ):
        n += 1
    return n


def _summaries(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row per text (``times`` -1), and of about every ``GATHERED`` shingles those that occur several times."""
    held: list[np.ndarray] = []
    size, tagged = 0, False

    def row(doc_id, tag, n, sig, sketch, times) -> pd.DataFrame:
        tags = {"tag": tag} if tagged else {}
        return pd.DataFrame({"doc_id": doc_id, **tags, "n": n, "sig": sig, "sketch": sketch, "times": times})

    def flush() -> pd.DataFrame:
        hashes = np.concatenate(held)
        held.clear()
        hashes.sort()
        at = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else np.zeros(0, dtype=int)
        times = np.diff(np.append(at, len(hashes)))
        often = times >= SEEN
        none = pd.array([None] * int(often.sum()), dtype="Int64")
        return row(none, none, 0, hashes[at[often]].view(np.int64), [b""] * len(none), times[often])

    for frame in frames:
        raw = B.as_bytes(frame["text"].tolist())
        tagged = "tag" in frame
        for first, last in B.blocks(raw):
            owner, hashes = shingle_sets(raw[first:last])
            n, sig = _signatures(last - first, owner, hashes)
            whole = frame.iloc[first:last]
            tag = whole["tag"].astype("Int64") if tagged else None
            yield row(whole["doc_id"].astype("Int64"), tag, n, sig, sketches(n, owner, hashes), -1)
            held.append(hashes)
            size += len(hashes)
            if size >= GATHERED:
                yield flush()
                size = 0
    if held:
        yield flush()
    release_memory()


def _parts(frames: Iterator[pd.DataFrame]) -> Iterator[list[bytes]]:
    """Texts in batches of bounded bytes, whatever the size of the frames."""
    held: list[bytes] = []
    size = 0
    for frame in frames:
        raw = B.as_bytes(frame["text"].tolist())
        for first, last in B.blocks(raw):
            held.extend(raw[first:last])
            size += sum(map(len, raw[first:last]))
            if size >= PART:
                yield held
                held, size = [], 0
    if held:
        yield held


def _postings(hot, limit: int, buckets: int):
    """Keys of all sets of a batch, packed by bucket: set table (signature, size), keys, places in the table and in the set."""

    def emit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frequent = hot.value
        for raw in _parts(frames):
            keys, sigs, sizes, depths = [], [], [], []
            for first, last in B.blocks(raw):
                owner, hashes = shingle_sets(raw[first:last])
                n, sig = _signatures(last - first, owner, hashes)
                rank = np.zeros(len(hashes), dtype=np.int64)
                if len(frequent):
                    at = np.minimum(np.searchsorted(frequent["hash"], hashes), len(frequent) - 1)
                    rank = np.where(frequent["hash"][at] == hashes, frequent["rank"][at], 0)
                order = np.argsort(owner * (HOT + 2) + rank, kind="stable")
                owner, hashes = owner[order], hashes[order]
                place = np.arange(len(owner)) - (np.cumsum(n) - n)[owner]
                scans = (n > limit) | (4 * n // 3 > limit)
                chosen = (place < prefix_length(n)[owner]) & scans[owner]
                keys.append(hashes[chosen])
                sigs.append(sig[owner[chosen]])
                sizes.append(n[owner[chosen]])
                depths.append(place[chosen] * PLACES // n[owner[chosen]])
                begin = np.cumsum(n) - n
                for k in np.flatnonzero((n > 0) & (n <= limit)):
                    members = np.sort(B.mix64(hashes[begin[k] : begin[k] + n[k]]))
                    made = [
                        int(members[list(some)].sum()) + 0x9E3779B97F4A7C15 * (t + 1) & (1 << 64) - 1
                        for t, size in subset_sizes(int(n[k]))
                        for some in combinations(range(n[k]), size)
                    ]
                    keys.append(B.mix64(np.array(made, dtype=np.uint64)))
                    sigs.append(np.full(len(made), sig[k]))
                    sizes.append(np.full(len(made), n[k]))
                    depths.append(np.zeros(len(made), dtype=np.int64))
            if not keys:
                continue
            key, sig, n = np.concatenate(keys), np.concatenate(sigs), np.concatenate(sizes).astype(np.int32)
            depth = np.minimum(np.concatenate(depths), 255).astype(np.uint8)
            bucket = ((key >> B.U(40)) % B.U(buckets)).astype(np.int64)
            order = np.lexsort((sig, key, bucket))
            key, sig, n, depth, bucket = key[order], sig[order], n[order], depth[order], bucket[order]
            new = np.ones(len(key), dtype=bool)
            new[1:] = (key[1:] != key[:-1]) | (sig[1:] != sig[:-1])
            key, sig, n, depth, bucket = key[new], sig[new], n[new], depth[new], bucket[new]
            edge = np.searchsorted(bucket, np.arange(buckets + 1))
            rows = []
            for k in np.flatnonzero(np.diff(edge)):
                part = slice(edge[k], edge[k + 1])
                table, where, place = np.unique(sig[part], return_index=True, return_inverse=True)
                kind = np.uint16 if len(table) <= 1 << 16 else np.uint32
                packed = (table, n[part][where], key[part], place.astype(kind), depth[part])
                rows.append((int(k), *(column.tobytes() for column in packed)))
            yield pd.DataFrame(rows, columns=["bucket", "sigs", "sizes", "keys", "places", "depths"])
        release_memory()

    return emit


def reach(n: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Thrice the largest partner of a set that is ``n`` large and has ``depth`` parts of its shingles before a shared one.

    Where a shingle is the first that two sets share, they share no more than what either has from there on, and it
    must be 3/7 of both sizes together. Linked sets stay together in the list of their first shared shingle.
    """
    before = -(-depth.astype(np.int64) * n // PLACES)
    return 7 * (n - before) - 3 * n


def _partnered(key: np.ndarray, n: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Which rows of lists (ordered by key) have another one in theirs that sizes and places allow to link."""
    found = np.zeros(len(key), dtype=bool)
    for apart in range(1, NEIGHBOURS + 1):
        at = np.flatnonzero(key[apart:] == key[:-apart])
        if not len(at):
            return found
        at = at[(most[at] >= 3 * n[at + apart]) & (most[at + apart] >= 3 * n[at])]
        found[at] = True
        found[at + apart] = True
    begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    size = np.diff(np.append(begin, len(key)))
    return found | np.repeat(size > NEIGHBOURS + 1, size)


def _lists(frame: pd.DataFrame) -> pd.DataFrame:
    """Sets of a bucket's lists that may link there, each row with the leader of its list and size class."""
    keys, sigs, sizes, depths = [], [], [], []
    for row in frame.itertuples():
        key, table = np.frombuffer(row.keys, dtype=np.uint64), np.frombuffer(row.sigs, dtype=np.int64)
        kind = np.uint16 if len(table) <= 1 << 16 else np.uint32
        place = np.frombuffer(row.places, dtype=kind)
        keys.append(key)
        sigs.append(table[place])
        sizes.append(np.frombuffer(row.sizes, dtype=np.int32)[place])
        depths.append(np.frombuffer(row.depths, dtype=np.uint8))
    key, sig, n, depth = (np.concatenate(x) for x in (keys, sigs, sizes, depths))
    order = np.argsort(key, kind="stable")
    key, sig, n, depth = key[order], sig[order], n[order], depth[order]
    shared = np.zeros(len(key), dtype=bool)
    same = key[1:] == key[:-1]
    shared[1:] |= same
    shared[:-1] |= same
    key, sig, n, depth = key[shared], sig[shared], n[shared], depth[shared]
    order = np.lexsort((depth, sig, n, key))
    key, sig, n, depth = key[order], sig[order], n[order], depth[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (sig[1:] != sig[:-1])
    key, sig, n, depth = key[new], sig[new], n[new].astype(np.int64), depth[new]
    most = reach(n, depth)
    kept = _partnered(key, n, most)
    key, sig, n, most = key[kept], sig[kept], n[kept], most[kept]
    step = np.floor(np.log2(np.maximum(n, 1)) * 4).astype(np.int64)
    # Lists as numbers in the order of their keys, which compress to little.
    new = np.ones(len(key), dtype=bool)
    new[1:] = key[1:] != key[:-1]
    key = (np.cumsum(new) - 1).astype(np.uint64) + (B.U(int(frame["bucket"].iloc[0])) << B.U(36))
    head = np.ones(len(key), dtype=bool)

    def leaders(seed: np.ndarray | np.uint64) -> np.ndarray:
        """First set of each list and size class in an order of the sets."""
        order = np.lexsort((B.mix64(sig.view(np.uint64) ^ seed), step, key))
        head[1:] = (key[order][1:] != key[order][:-1]) | (step[order][1:] != step[order][:-1])
        first = order[np.maximum.accumulate(np.where(head, np.arange(len(key)), 0))]
        lead = np.empty_like(sig)
        lead[order] = sig[first]
        return lead

    # Orders that all lists share pick few leaders; an order of its own picks another one in every list.
    led = {f"lead{k}": leaders(ODD[k]) if len(key) else sig for k in range(SHARED)}
    led["lead"] = leaders(key) if len(key) else sig
    release_memory()
    return pd.DataFrame({"key": key.view(np.int64), "sig": sig, "n": n.astype(np.int32), "most": most, **led})


LISTED = ", ".join(["key long, sig long, n int, most long", *(f"lead{k} long" for k in range(SHARED)), "lead long"])


def _near_pairs(n, most, part, side, sketch, both: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of one tile that differ in component and that sizes, places and sketches allow to link."""
    size = np.array([len(x) for x in sketch])
    left, right = [], []
    for length in np.unique(size):
        some = np.flatnonzero((size == length) | (size == 2 * length))
        rows = [np.frombuffer(sketch[i], dtype=np.uint64) for i in some]
        bits = np.stack([r if len(r) * 8 == length else r[: len(r) // 2] ^ r[len(r) // 2 :] for r in rows])
        m, far, group, short = n[some], most[some], part[some], size[some] == length
        for at in range(0, len(some), 64):
            rest = slice(at, at + 64)
            allowed = (group[rest, None] != group) & (short[rest, None] | short)
            allowed &= (far[rest, None] >= 3 * m) & (far >= 3 * m[rest, None])
            if both:
                allowed &= side[some][rest, None] < side[some]
            else:
                allowed &= np.arange(len(some))[rest, None] < np.arange(len(some))
            x, y = np.nonzero(allowed)
            for cut in range(0, len(x), 8192):
                a, b = x[cut : cut + 8192] + at, y[cut : cut + 8192]
                apart = np.bitwise_count(bits[a] ^ bits[b]).sum(axis=1, dtype=np.int64)
                close = apart <= (m[a] + m[b]) // 7
                left.append(some[a[close]])
                right.append(some[b[close]])
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _tile_pairs(frame: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Signatures of candidate pairs across components, by list (or tile of a long list) of a task."""
    frame = frame.sort_values(["key", "i", "j"], kind="stable")
    columns = {c: frame[c].to_numpy() for c in ("key", "i", "j", "side", "sig", "n", "most", "part", "sketch")}
    key, i, j, sig = columns["key"], columns["i"], columns["j"], columns["sig"]
    edge = np.flatnonzero((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
    for low, high in zip([0, *edge.tolist()], [*edge.tolist(), len(key)], strict=True):
        tile = slice(low, high)
        n, most, part, side, sketch = (columns[c][tile] for c in ("n", "most", "part", "side", "sketch"))
        a, b = _near_pairs(n.astype(np.int64), most, part, side, sketch, i[low] != j[low])
        if len(a):
            yield sig[tile][a], sig[tile][b]


def _partners(frame: pd.DataFrame) -> pd.DataFrame:
    """Sets of a task that have a candidate partner in another component."""
    found = [np.unique(np.concatenate(pair)) for pair in _tile_pairs(frame)]
    return pd.DataFrame({"sig": np.unique(np.concatenate([np.zeros(0, dtype=np.int64), *found]))})


def _crossing(frame: pd.DataFrame) -> pd.DataFrame:
    """Candidate pairs across components of a task."""
    found = [np.stack([np.minimum(a, b), np.maximum(a, b)], 1) for a, b in _tile_pairs(frame)]
    pairs = np.unique(np.concatenate([np.zeros((0, 2), dtype=np.int64), *found]), axis=0)
    return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})


def _finer(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        n = frame["members"].map(len).to_numpy(dtype=np.int64)
        hashes = np.concatenate([np.zeros(0, dtype=np.int64), *frame["members"]]).view(np.uint64)
        yield pd.DataFrame({"sig": frame["sig"], "sketch": sketches(n, np.repeat(np.arange(len(n)), n), hashes, FINE)})


def _may_link(a: pd.Series, b: pd.Series, most: pd.Series) -> pd.Series:
    near = [_distance(x, y) <= m for x, y, m in zip(a, b, most, strict=True)]
    return pd.Series(near, dtype=bool)


def _exact_sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        raw = B.as_bytes(frame["text"].tolist())
        for first, last in B.blocks(raw):
            owner, hashes = shingle_sets(raw[first:last])
            n, sig = _signatures(last - first, owner, hashes)
            stop = np.cumsum(n)
            whole = hashes.view(np.int64)
            yield pd.DataFrame({"sig": sig, "members": [whole[e - k : e] for e, k in zip(stop, n, strict=True)]})
    release_memory()


class _Checker:
    """Checks candidate pairs of set signatures against the exact sets."""

    def __init__(self, docs: DataFrame, classes: DataFrame) -> None:
        self.docs, self.classes = docs, classes

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that link."""
        side = lambda x: self.classes.select(
            F.col("sig").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"sketch_{x}")
        )
        sized = pairs.join(side("a"), "a").join(side("b"), "b")
        sized = sized.where(4 * F.least("n_a", "n_b") >= 3 * F.greatest("n_a", "n_b"))
        close = F.pandas_udf(_may_link, "boolean")("sketch_a", "sketch_b", F.expr("(n_a + n_b) div 7"))
        near = materialize(sized.where(close).select("a", "b"), "near")
        ends = near.select(F.col("a").alias("sig")).union(near.select("b")).distinct()
        return self.exact(near, self.sets(ends))

    def sets(self, ends: DataFrame) -> DataFrame:
        """The shingles (sig, members) of the signatures ``ends``."""
        ids = materialize(
            self.classes.join(ends, "sig", "left_semi").select(F.col("rep").alias("doc_id")).distinct(), "ends"
        )
        texts = self.docs.join(ids, "doc_id", "left_semi").select(F.col("text").cast("binary").alias("text"))
        sets = texts.mapInPandas(_exact_sets, "sig long, members array<long>")
        return materialize(sets.join(ends, "sig", "left_semi").dropDuplicates(["sig"]), "sets")

    def exact(self, near: DataFrame, sets: DataFrame) -> DataFrame:
        """Those of the pairs ``near`` that link."""
        left = sets.select(F.col("sig").alias("a"), F.col("members").alias("set_a"))
        right = sets.select(F.col("sig").alias("b"), F.col("members").alias("set_b"))
        both = near.join(left, "a").join(right, "b")
        shared = F.size(F.array_intersect("set_a", "set_b"))
        linked = both.where(7 * shared >= 3 * (F.size("set_a") + F.size("set_b"))).select("a", "b")
        return materialize(linked, "linked")


def _tiles(known: DataFrame, sketched: DataFrame, tasks: int) -> DataFrame:
    """Sets of the lists that reach over several components, dealt to ``tasks``, or to more where lists are long."""
    mixed = known.groupBy("key").agg(
        F.min("part").alias("low"), F.max("part").alias("high"), F.count("*").alias("size")
    )
    mixed = materialize(mixed.where("low <> high").select("key", "size"), "mixed-lists")
    blocks = F.ceil(F.col("size") / LIST_BLOCK).cast("int")
    open_lists = known.join(mixed, "key").withColumn("block", F.pmod(F.xxhash64("sig"), blocks).cast("int"))
    # A block meets every block of its list, itself included; lists of one block share a task by bucket.
    meets = F.transform(
        F.sequence(F.lit(0), blocks - 1),
        lambda j: F.struct(
            F.least("block", j).alias("i"), F.greatest("block", j).alias("j"),
            F.when(F.col("block") > j, 1).otherwise(0).alias("side"),
        ),
    )
    carried = ["key", "sig", "n", "most", "part", "sketch"]
    open_lists = open_lists.join(sketched, "sig").select(
        *carried, (blocks == 1).alias("whole"), F.explode(meets).alias("meet")
    )
    task = F.when(F.col("whole"), F.pmod("key", F.lit(tasks))).otherwise(F.xxhash64("key", "meet.i", "meet.j"))
    return open_lists.select(*carried, "meet.*", task.alias("task"))


def similarity_components(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id``."""
    return _placed(docs, [])


def _shared_ids(sets: DataFrame) -> DataFrame:
    """(doc_id, sig, low): the sets of each id that has several, and the first of them; empty sets have no ``sig``."""
    filled = F.when(F.col("n") > 0, F.col("sig"))
    owned = sets.where("doc_id is not null").select("doc_id", filled.alias("sig")).distinct()
    several = owned.groupBy("doc_id").agg(F.min("sig").alias("low"), F.count("*").alias("times")).where("times > 1")
    return materialize(owned.join(unplaced(several.drop("times")), "doc_id"), "shared-ids")


def _placed(docs: DataFrame, tag: list[str]) -> DataFrame:
    """The components; rows of one id are one node.

    Where ``tag`` names a column, it holds a hash of the text and every text of an id is a node of its own.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    docs = docs.select("doc_id", "text")
    texts = docs.withColumn("text", F.col("text").cast("binary"))
    schema = ", ".join(["doc_id long", *(f"{t} long" for t in tag), "n int, sig long, sketch binary, times int"])
    tagged = docs.select("doc_id", F.col("text").cast("binary").alias("text"), *(F.xxhash64("text").alias(t) for t in tag))
    summaries = materialize(tagged.mapInPandas(_summaries, schema), "summaries")
    sets = summaries.where("times < 0")
    classes = sets.where("n > 0 and doc_id is not null").groupBy("sig", "n")
    classes = materialize(classes.agg(F.min("doc_id").alias("rep"), F.first("sketch").alias("sketch")), "classes")
    stats = sets.agg(F.sum(F.col("n").cast("long")).alias("total")).first()
    total = int(stats["total"] or 0)
    least = max(HOT_LEAST, total // HOT)
    often = summaries.where("times > 0").groupBy("sig").agg(F.sum("times").alias("times"))
    frequent = often.where(F.col("times") >= least).orderBy("times", "sig").toPandas()
    hot = np.zeros(len(frequent), dtype=[("hash", np.uint64), ("rank", np.int64)])
    hot["hash"], hot["rank"] = frequent["sig"].to_numpy().view(np.uint64), np.arange(1, len(frequent) + 1)
    mean_list = 1 + float((frequent["times"].to_numpy(dtype=float) ** 2).sum()) / max(total, 1)
    hot = spark.sparkContext.broadcast(np.sort(hot, order="hash"))
    buckets = parts_for(total // 4, POSTINGS)
    packed = texts.mapInPandas(
        _postings(hot, boundary(mean_list), buckets),
        "bucket int, sigs binary, sizes binary, keys binary, places binary, depths binary",
    )
    lists = packed.groupBy("bucket").applyInPandas(_lists, LISTED)
    lists = materialize(lists, "lists")
    checker = _Checker(docs, classes)
    order = lambda x, y: (F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    first = F.array(*[f"lead{k}" for k in range(SHARED)])
    led = lists.select("sig", F.explode(F.array_distinct(first)).alias("lead")).where("lead <> sig")
    links = checker.links(led.select(*order("lead", "sig")).distinct())
    shared = None if tag else _shared_ids(sets)
    if shared is not None and shared.isEmpty():
        shared = None
    if shared is not None:
        links = links.union(shared.where("sig <> low").select(*order("low", "sig")).distinct())

    def in_parts(placed: DataFrame) -> DataFrame:
        return lists.join(placed.withColumnRenamed("node", "sig"), "sig", "left").select(
            "key", "sig", "n", "most", "lead", F.coalesce("component", "sig").alias("part")
        )

    placed = components(links)
    heads = placed.select(F.col("node").alias("lead"), F.col("component").alias("lead_part"))
    led = in_parts(placed).where("lead <> sig").join(heads, "lead", "left")
    led = led.where(F.col("part") != F.coalesce("lead_part", "lead"))
    second = checker.links(led.select(*order("lead", "sig")).distinct())
    links = links.union(second)
    placed = components(links)
    known = materialize(in_parts(placed).drop("lead"), "known-parts")
    # Sets that have a candidate partner are few; only among these, finer sketches name the pairs.
    open_sets = _tiles(known, classes.select("sig", "sketch"), 4 * buckets)
    ends = open_sets.groupBy("task").applyInPandas(_partners, "sig long").distinct()
    ends = materialize(ends, "partners")
    sets_of = checker.sets(ends)
    finer = materialize(sets_of.mapInPandas(_finer, "sig long, sketch binary"), "finer")
    open_sets = _tiles(known.join(ends, "sig", "left_semi"), finer, 4 * buckets)
    crossing = open_sets.groupBy("task").applyInPandas(_crossing, "a long, b long").distinct()
    more = checker.exact(crossing, sets_of)
    if not more.isEmpty():
        placed = components(links.union(more))
    named = classes.join(placed.withColumnRenamed("node", "sig"), "sig", "left").select(
        "sig", "n", "rep", F.coalesce("component", "sig").alias("part")
    )
    roots = named.groupBy("part").agg(F.min("rep").alias("root"))
    rooted = named.join(unplaced(roots), "part").select("sig", "n", F.col("root").alias("component"))
    joined = sets.join(rooted, ["sig", "n"], "left")
    if shared is not None:
        # An empty text has no links of its own, but its id may have some.
        firsts = shared.select("doc_id", "low").distinct().join(rooted.withColumnRenamed("sig", "low").drop("n"), "low")
        firsts = firsts.select("doc_id", F.col("component").alias("of_id"))
        joined = joined.join(unplaced(firsts), "doc_id", "left").withColumn(
            "component", F.coalesce("component", "of_id")
        )
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return joined.select("doc_id", *tag, F.col("n").cast("long").alias("n_shingles"), own.alias("component_id"))


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each component (the smallest id); those without an id all stay, and so do other texts of an id."""
    placed = _placed(docs, ["tag"]).where("doc_id <> component_id")
    placed = materialize(placed.select(F.col("doc_id").alias("_copy"), F.col("tag").alias("_tag")).distinct(), "copies")
    maybe, others = split_by_ids(docs, "doc_id", placed.select("_copy"))
    same = (maybe["doc_id"] == placed["_copy"]) & (F.xxhash64(maybe["text"]) == placed["_tag"])
    return maybe.join(placed, same, "left_anti").union(others)


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_components(read_table(spark, sf_dir, "documents"))
