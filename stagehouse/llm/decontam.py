"""Benchmark decontamination by spaced seeds, with built-in functions only.

A spaced seed is a mask over consecutive tokens: positions marked ``1``
are hashed, those marked ``0`` may differ. Seeds of the training texts meet the
seeds of the benchmark in a hash join; around each hit the document is laid over
the benchmark item along the hit's diagonal, and the overlap is confirmed when
some window of ``window`` tokens (the whole item, where it is shorter) agrees in
at least ``least`` of its tokens.

The masks are chosen so that every overlap of that kind has a hit: whichever tokens
of a window differ, as many as may, some mask fits on others only. Items shorter
than the window have masks for their own size, down to a single token.

Tokens are lower-cased runs of ASCII letters and digits and of any characters
beyond ASCII; in scripts written without spaces (Han, Kana, Thai, Lao, Myanmar, Khmer)
every character is a token. All masks but that of a single token begin with the
same two positions, so a position is looked up by its first two tokens before it is
hashed by each mask. Two ways lead to the same
rows. With few benchmark seeds (a bound checked by counting them) the seed table
and the items are broadcast, and texts are scanned once without being moved.
With more, seeds are joined by a shuffle and the hits come back to their texts.

Defined cases: a null or empty text has no tokens and no hit; an item of a few tokens
overlaps with every text that has them; documents and items that
share an id are told apart by their texts but reported under that id; repeated
rows are reported once; an empty table on either side gives no rows; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cache, reduce
from itertools import combinations
from math import ceil, comb

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagehouse.llm.common import read_table
from stagehouse.session import materialize

# Masks begin with HEAD, that of a single token with ONE.
HEAD, ONE = "11", "1"
# Positions a mask hashes at most, and sets of differing tokens that are gone through to choose masks.
WEIGHT = 6
SETS = 5000
WINDOW = 13
LEAST = 0.75
# Seeds are rows of bounded size: hashes of at most 3 x WINDOW tokens around them, so this many take about 80 MB.
BROADCAST_SEEDS = 200_000
# Scripts written without spaces: Thai and Lao, Myanmar, Khmer, Kana and marks, Han.
UNSPACED = (
    r"\x{E00}-\x{EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3005}-\x{3007}\x{3040}-\x{30FF}\x{31F0}-\x{31FF}"
    r"\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{FF66}-\x{FF9F}\x{20000}-\x{3FFFF}"
)


@cache
def covering_masks(width: int, least: float = LEAST) -> tuple[str, ...]:
    """Masks of which one fits on equal tokens only, in any ``width`` tokens that agree in ``least`` of them.

    Chosen greedily, heavy ones first; those that others make needless are dropped.
    """
    agree = ceil(least * width)
    if agree < 1:
        raise ValueError("without a token that must agree everything overlaps")
    misses = width - agree
    run = ceil(agree / (misses + 1))
    if run < 2 or comb(width, misses) > SETS:
        # Some run of equal tokens is at least this long.
        return ("1" * min(run, WEIGHT),)
    everything = frozenset(map(frozenset, combinations(range(width), misses)))
    chosen: list[tuple[tuple[int, ...], set]] = []
    open_ = set(everything)
    for weight in range(min(WEIGHT, agree), 1, -1):
        found = {}
        for rest in combinations(range(2, width), weight - 2):
            ones = (0, 1, *rest)
            places = [{at + i for i in ones} for at in range(width - ones[-1])]
            found[ones] = {gone for gone in everything if any(not gone & place for place in places)}
        while open_:
            ones = max(found, key=lambda x: (len(found[x] & open_), -x[-1]))
            if not found[ones] & open_:
                break
            chosen.append((ones, found[ones]))
            open_ -= found[ones]
    for one in list(chosen):
        others = [x for x in chosen if x is not one]
        if set().union(*(x[1] for x in others)) >= everything:
            chosen = others
    return tuple("".join("1" if i in ones else "0" for i in range(ones[-1] + 1)) for ones, _ in chosen)


def tokens(text: Column) -> Column:
    """Runs of ASCII letters, digits and characters beyond ASCII, lower-cased; single characters of unspaced scripts."""
    pattern = F.lit(rf"[{UNSPACED}]|[a-z0-9\x{{80}}-\x{{10FFFF}}&&[^{UNSPACED}]]+")
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), pattern, 0)


def _tokenized(rows: DataFrame, name: str, *kept: str | Column) -> DataFrame:
    """Tokens as the output of a generator: computed once per text, never again per seed."""
    return rows.select(*kept, F.explode(F.array(tokens(F.col("text")))).alias(name))


def _hash(array: str, at: Column, mask: str) -> Column:
    picked = [F.get(F.col(array), at + i) for i, bit in enumerate(mask) if bit == "1"]
    return F.xxhash64(F.lit(mask), *picked)


def _head(array: str, head: str) -> Column:
    return _hash(array, F.col("at"), head)


def _positions(rows: DataFrame, array: str, masks: Sequence[str]) -> DataFrame:
    """One row per position where the shortest mask fits: adds ``at``."""
    last = F.size(array) - min(map(len, masks))
    return rows.where(last >= 0).withColumn("at", F.explode(F.sequence(F.lit(0), last)))


def _first_near(at: Column, window: int) -> Column:
    """Where the tokens begin that windows holding the token ``at`` can reach."""
    return F.greatest(at - window + 1, F.lit(0))


def _near(array: str, at: Column, window: int) -> Column:
    return F.slice(array, _first_near(at, window) + 1, 3 * window)


def _item_positions(items: DataFrame, masks: Sequence[str], window: int) -> DataFrame:
    """One row per position of an item where the shortest mask fits, with the tokens near it and not the whole item."""
    last = F.size("item_tokens") - min(map(len, masks))
    places = F.transform(
        F.sequence(F.lit(0), last), lambda at: F.struct(at.alias("item_at"), _near("item_tokens", at, window).alias("near"))
    )
    placed = items.where(last >= 0).select("item_id", F.size("item_tokens").alias("item_size"), F.explode(places).alias("place"))
    placed = placed.select("item_id", "item_size", "place.*")
    return placed.withColumn("around_at", _first_near(F.col("item_at"), window)).withColumn("at", F.col("item_at") - F.col("around_at"))


def _doc_near(hits: DataFrame, window: int) -> DataFrame:
    """The tokens near a hit in place of the whole document: ``near``, its beginning ``near_at``, and ``at`` counted from it."""
    at = F.col("at")
    near = hits.withColumn("near", _near("doc_tokens", at, window)).withColumn("near_at", _first_near(at, window))
    return near.drop("doc_tokens").withColumn("at", at - F.col("near_at"))


def _seeds(placed: DataFrame, array: str, masks: Sequence[str]) -> DataFrame:
    """One row per position and mask that fits there: adds ``seed``."""
    hashed = [F.when(F.col("at") + len(m) <= F.size(array), _hash(array, F.col("at"), m)) for m in masks]
    return placed.withColumn("seed", F.explode(F.array(*hashed))).where("seed is not null")


def _headed(masks: Sequence[str]) -> list[tuple[str, list[str]]]:
    """Masks by what they begin with, where there are any."""
    heads = [(HEAD, [m for m in masks if m.startswith(HEAD)]), (ONE, [m for m in masks if not m.startswith(HEAD)])]
    return [(head, mine) for head, mine in heads if mine]


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _confirm(hits: DataFrame, window: int, least: float) -> DataFrame:
    """``hits`` carry the tokens near the hit, the item's ``around`` it, and ``start``; keeps the confirmed ones.

    Every window that overlaps holds a seed, so the windows that hold the hit are
    all there is to look at. ``start`` may be negative (the item's beginning lies before the document);
    places outside the document agree with nothing. The agreement is a
    generator's output, so that it is computed once per hit.
    """
    first = F.col("start") + F.col("around_at") - F.col("near_at")
    width = F.least(F.col("item_size"), F.lit(window))
    agree = F.transform(
        F.col("around"),
        lambda token, i: F.when(
            (first + i >= 0) & (F.xxhash64(F.get(F.col("near"), F.greatest(first + i, F.lit(0)))) == token), 1
        ).otherwise(0),
    )
    sums = F.transform(
        F.sequence(F.lit(0), F.size("agree") - F.col("compared")),
        lambda i: F.aggregate(F.slice("agree", i + 1, F.col("compared")), F.lit(0), lambda a, b: a + b),
    )
    compared = hits.select(
        "doc_id", "tag", "item_id", "start", width.alias("compared"), F.explode(F.array(agree)).alias("agree")
    )
    best = compared.select(
        "doc_id", "tag", "item_id", "start", "compared", F.explode(F.array(F.array_max(sums))).alias("matched")
    )
    return best.where(F.col("matched") >= F.ceil(F.lit(least) * F.col("compared")))


def _overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    masks: Sequence[str] | None = None,
    window: int = WINDOW,
    least: float = LEAST,
    broadcast_seeds: int = BROADCAST_SEEDS,
) -> DataFrame:
    """The confirmed hits, with ``tag``, a hash of the document's text."""
    items = _tokenized(benchmark, "item_tokens", "item_id").distinct()
    items = materialize(items, "items")
    size = F.least(F.size("item_tokens"), F.lit(window))
    sizes = sorted(r["size"] for r in items.select(size.alias("size")).distinct().collect() if r["size"] > 0)
    if not sizes:
        sizes = [window]
    own = {n: tuple(masks) if masks and n == window else covering_masks(n, least) for n in sizes}
    every = sorted({m for mine in own.values() for m in mine})
    heads = _headed(every)
    seeds = []
    for n, mine in own.items():
        for head, some in _headed(mine):
            placed = _item_positions(items.where(size == n), some, window)
            seeds.append(
                _seeds(placed, "near", some).select(
                    "seed", F.lit(head).alias("begins"), _head("near", head).alias("head"), "item_id", "item_at",
                    "item_size", "around_at", F.transform("near", lambda token: F.xxhash64(token)).alias("around"),
                )
            )
    seeds = materialize(_union(seeds).distinct(), "item-seeds")
    few = seeds.limit(broadcast_seeds + 1).count() <= broadcast_seeds
    if few:
        texts = _tokenized(docs, "doc_tokens", "doc_id", F.xxhash64("text").alias("tag"))
        found = []
        for head, mine in heads:
            known = F.broadcast(seeds.where(F.col("begins") == head).select("head").distinct())
            placed = _positions(texts, "doc_tokens", mine).withColumn("head", _head("doc_tokens", head))
            found.append(_seeds(_doc_near(placed.join(known, "head", "left_semi"), window), "near", mine))
        hits = _union(found).join(F.broadcast(seeds.drop("head", "begins")), "seed")
    else:
        keyed = _tokenized(docs, "doc_tokens", "doc_id", F.xxhash64("text").alias("tag"))
        placed = _union([_seeds(_positions(keyed, "doc_tokens", mine), "doc_tokens", mine) for _, mine in heads])
        met = placed.select("seed", "doc_id", "tag", "at").join(seeds, "seed")
        met = met.select("doc_id", "tag", "at", "item_id", "item_at", "item_size", "around_at", "around")
        met = met.withColumnRenamed("doc_id", "_id").withColumnRenamed("tag", "_tag")
        same = keyed["doc_id"].eqNullSafe(met["_id"]) & (keyed["tag"] == met["_tag"])
        hits = _doc_near(keyed.join(met, same).drop("_id", "_tag"), window)
    hits = hits.withColumn("start", F.col("near_at") + F.col("at") - F.col("item_at"))
    kept = ("doc_id", "tag", "item_id", "start", "near", "near_at", "item_size", "around_at", "around")
    return _confirm(hits.select(*kept), window, least)


def contaminated(docs: DataFrame, benchmark: DataFrame, *args, **options) -> DataFrame:
    """One row per document and item that overlap.

    Columns: ``doc_id``, ``item_id``, ``matched`` and ``compared`` tokens of the
    best window, ``start`` (where the item's first token lies in the document).
    """
    near = _overlaps(docs, benchmark, *args, **options)
    best = F.max(F.struct("matched", "compared", (-F.col("start")).alias("place"))).alias("best")
    found = near.groupBy("doc_id", "item_id").agg(best)
    return found.select(
        "doc_id", "item_id", "best.matched", "best.compared", (-F.col("best.place")).alias("start")
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, least_tokens: int = 1, **options) -> DataFrame:
    """The documents no item overlaps, all columns kept; other texts of an id, or without one, stay.

    Items of fewer than ``least_tokens`` tokens are left out: with the default none is, and an
    item of one word takes every document that has the word.
    """
    if least_tokens > 1:
        benchmark = benchmark.where(F.size(tokens(F.col("text"))) >= least_tokens)
    found = _overlaps(docs, benchmark, **options)
    found = materialize(found.select(F.col("doc_id").alias("_found"), F.col("tag").alias("_tag")).distinct(), "contaminated")
    same = docs["doc_id"].eqNullSafe(found["_found"]) & (F.xxhash64(docs["text"]) == found["_tag"])
    return docs.join(found, same, "left_anti")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "item_id", *[F.col(c).cast("long").alias(c) for c in ("matched", "compared", "start")]
    )
