"""The corpus operators against brute force on small texts with awkward rows."""

import base64
import gzip
import hashlib
import math
import os
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from stagehouse.llm import bytesops, chat, common, ctw, decontam, embed, jaccard, langid, mixing, quality, suffix, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, doc long"
BASE = " ".join(f"word{i * 7919 % 997}" for i in range(120))


def documents(spark, rows):
    full = [(i, t, "en", s, len(t or ""), 5) for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


ROWS = [
    (1, BASE, "a"),
    (2, BASE, "a"),
    (3, BASE.replace("word7 ", "other "), "b"),
    (4, None, None),
    (5, "", "b"),
    (6, "three short words", "c"),
    (7, "three short words", "c"),
    (7, "three short words", "c"),
    (8, "x " * 400, None),
    (9, "tail " + BASE[200:700] + " head é", "b"),
    (None, BASE, "a"),
    (10, "Ab cD " + BASE.upper(), "d"),
]


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def removed(rows):
    """Brute force of the suffix operator: per row, in order, its kept bytes and removed runs."""
    order = sorted({(i, t or "") for i, t, _ in rows}, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, out = set(), {}
    for doc, text in order:
        raw = text.encode()
        gone = [False] * len(raw)
        for p in range(len(raw) - 99):
            gram = raw[p : p + 100]
            if gram in seen:
                gone[p : p + 100] = [True] * 100
            seen.add(gram)
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out[doc] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def test_suffix_matches_brute_force(spark):
    got = suffix.repeats(documents(spark, ROWS)).collect()
    want = removed(ROWS)
    assert len(got) == len(ROWS)
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id], r.doc_id


@pytest.mark.parametrize("array", [suffix.ARRAY, 40])
def test_suffix_keeps_the_text_of_repeated_rows(spark, monkeypatch, array):
    monkeypatch.setattr(suffix, "ARRAY", array)
    own = " ".join(f"alone{i * 31 % 89}" for i in range(40))
    shared = "start of it " + BASE[300:450] + " end of it"
    rows = [*ROWS, (50, own, "a"), (50, own, "a"), (50, own, "b"), (51, shared, "a"), (51, shared, "a"), (None, BASE, "a")]
    want = removed(rows)
    for parts in (1, 5):
        docs = documents(spark, rows).repartition(parts)
        got = suffix.repeats(docs).collect()
        assert sorted(str(r.doc_id) for r in got) == sorted(str(d) for d, _, _ in rows)
        for r in got:
            assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id], (parts, r.doc_id)
    assert [r.text for r in suffix.without_repeats(docs).where("doc_id = 50").collect()] == [own] * 3


def test_suffix_cuts_long_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix, "PIECE", 300)
    found = list(suffix._block_suffixes([BASE.encode()]))
    starts = sorted(s for _, at, count, _, _ in found for a, c in zip(at, count, strict=True) for s in range(a, a + c))
    assert starts == list(range(len(BASE) - 99))


def test_suffix_levels_keep_the_earliest():
    levels = suffix.Levels()
    rng = np.random.default_rng(1)
    first, repeats = {}, 0
    for doc in rng.permutation(40):
        keys = np.unique(rng.integers(0, 60, 30)).astype(np.uint64)
        n = len(keys)
        levels.add((keys.astype(np.uint32), keys, np.full(n, doc), np.arange(n), np.ones(n, dtype=np.int64)))
        for k in keys.tolist():
            repeats += k in first
            first[k] = min(first.get(k, 99), int(doc))
        sizes = [len(x[0]) for x in levels.levels]
        assert all(a >= 2 * b for a, b in zip(sizes, sizes[1:], strict=False))
    _, keys, docs, _, _ = levels.whole()
    assert dict(zip(keys.tolist(), docs.tolist(), strict=True)) == first
    assert sum(len(r[0]) for r in levels.repeats) == repeats


def test_suffix_keeps_columns_and_null_texts(spark):
    docs = documents(spark, ROWS)
    out = suffix.without_repeats(docs)
    assert out.columns == docs.columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    by_id = {r.doc_id: r for r in out.collect()}
    assert by_id[4].text is None and by_id[5].text == "" and by_id[1].doc == 5


def components_by_force(rows):
    sets = {}
    for doc, text, _ in rows:
        w = words(text)
        grams = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        sets.setdefault(doc, []).append(grams)
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = [d for d in sets if d is not None]
    for a in ids:
        for b in ids:
            if a < b and any(
                x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]
            ):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {d: find(d) for d in sets}, sets


def near_copies():
    rng = np.random.default_rng(5)
    rows = list(ROWS)
    for group in range(6):
        text = [f"g{group}w{k}" for k in rng.integers(0, 400, int(rng.integers(5, 160)))]
        for _ in range(12):
            copy = list(text)
            for place in rng.integers(0, len(copy), int(rng.integers(0, max(2, len(copy) // 12)))):
                copy[place] = f"new{rng.integers(0, 9)}"
            rows.append((100 + len(rows), " ".join(copy), "a"))
    return rows


@pytest.mark.parametrize("limit", [None, 8])
def test_jaccard_matches_brute_force(spark, monkeypatch, limit):
    if limit is not None:
        monkeypatch.setattr(jaccard, "boundary", lambda mean: limit)
    monkeypatch.setattr(jaccard, "LIST_BLOCK", 4)
    rows = near_copies()
    want, sets = components_by_force(rows)
    for r in jaccard.similarity_components(documents(spark, rows)).collect():
        assert r.component_id == want[r.doc_id]
        assert r.n_shingles in {len(s) for s in sets[r.doc_id]}


def test_jaccard_takes_rows_of_one_id_as_one_node(spark):
    other, third = ("".join(f"{w}{k} " for k in range(60)) for w in ("other", "third"))
    rows = [(5, BASE, "a"), (6, other, "a"), (7, BASE, "a"), (7, other, "a"), (7, None, "a"), (8, third, "a")]
    rows += [(9, third, "b"), (9, "", "b"), (10, None, "b"), (10, "", "b"), (None, other, "b"), (None, BASE, "b")]
    got = jaccard.similarity_components(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.component_id) for r in got} == {(5, 5), (6, 5), (7, 5), (8, 8), (9, 8), (10, 10), (None, None)}
    kept = jaccard.without_near_duplicates(documents(spark, rows)).collect()
    assert {(r.doc_id, r.text) for r in kept if r.text and r.doc_id} == {(5, BASE), (6, other), (8, third)}


def test_jaccard_subsets_cover_every_linking_pair():
    for s in range(1, 12):
        for t in range(s, 4 * s // 3 + 1):
            least = -(-3 * (s + t) // 7)
            assert least > s or (t, -(-3 * t // 4)) in jaccard.subset_sizes(s)


def test_linked_sets_stay_in_the_list_of_their_first_shared_shingle():
    rng = np.random.default_rng(8)
    tried = 0
    while tried < 300:
        a = set(rng.integers(0, 1 << 40, int(rng.integers(4, 300))).tolist())
        b = set(sorted(a, key=lambda x: x * 7919 % 1009)[: len(a) - int(rng.integers(0, len(a) // 4 + 1))])
        b |= set(rng.integers(0, 1 << 40, int(rng.integers(0, len(a) // 6 + 1))).tolist())
        if len(a & b) * 100 < 75 * len(a | b):
            continue
        tried += 1
        n = np.array([len(a), len(b)])
        place = np.array([sorted(x).index(min(a & b)) for x in (a, b)])
        most = jaccard.reach(n, (place * jaccard.PLACES // n).astype(np.uint8))
        assert jaccard._partnered(np.array([3, 3]), n, most).all()
    # Sizes that cannot link go; a list too long to be held against itself stays whole.
    far = np.array([10, 40])
    assert not jaccard._partnered(np.array([3, 3]), far, jaccard.reach(far, np.zeros(2, dtype=np.uint8))).any()
    many = 2 ** np.arange(jaccard.NEIGHBOURS + 2, dtype=float)
    assert jaccard._partnered(np.full(len(many), 5), many, 4 * many).all() and len(many) > jaccard.NEIGHBOURS + 1


def test_pairs_just_below_the_limit_are_not_all_checked(spark, monkeypatch):
    """A group of texts that nearly link (about 0.70): the last step does not hand all its pairs to the exact check."""
    rng = np.random.default_rng(9)
    base, rows = [f"word{k}" for k in range(230)], []
    for doc in range(40):
        text = list(base)
        for k, place in enumerate(rng.choice(45, 4, replace=False)):
            text[5 * int(place) + 2] = f"own{doc}x{k}"
        rows.append((doc, " ".join(text), "a"))
    checked = []
    exact = jaccard._Checker.exact

    def counted(self, near, sets):
        checked.append(near.count())
        return exact(self, near, sets)

    monkeypatch.setattr(jaccard._Checker, "exact", counted)
    got = jaccard.similarity_components(documents(spark, rows)).collect()
    want, _ = components_by_force(rows)
    assert {r.doc_id: r.component_id for r in got} == {doc: want[doc] for doc, _, _ in rows}
    assert checked[-1] < 40 * 39 // 2 // 4


def test_split_by_ids_leaves_no_id_on_the_other_side(spark):
    rows = spark.range(5000).select(F.expr("if(id = 4, null, int(id))").alias("doc_id"), F.lit("x").alias("text"))
    for ids in ([], [None], [3, None], list(range(0, 5000, 9))):
        maybe, others = common.split_by_ids(rows, "doc_id", spark.createDataFrame([(k,) for k in ids], "a long"))
        maybe, others = ([r.doc_id for r in x.collect()] for x in (maybe, others))
        assert len(maybe) + len(others) == 5000 and not {4 if k is None else k for k in ids} & {
            4 if k is None else k for k in others
        }
        assert len(maybe) <= 2 * len(ids) + 200


def test_accepted_takes_the_documents_classify_keeps(spark):
    docs = documents(spark, [*ROWS, (None, BASE, "a")])
    labels = spark.createDataFrame([(1, 0, 1), (2, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int")
    want = quality.classify(docs, labels).where("keep").select(*docs.columns).collect()
    assert Counter(quality.accepted(docs, labels).collect()) == Counter(want)
    # Texts are met with labels only where their id may have one.
    plan = quality.accepted(docs, labels)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan


def test_sketch_distance_never_exceeds_difference():
    rng = np.random.default_rng(2)
    for _ in range(50):
        a = set(rng.integers(0, 1 << 60, int(rng.integers(1, 300))).tolist())
        b = set(list(a)[: int(rng.integers(0, len(a) + 1))]) | set(rng.integers(0, 1 << 60, 40).tolist())
        made = [
            jaccard.sketches(np.array([len(x)]), np.zeros(len(x), dtype=int), np.array(sorted(x), dtype=np.uint64))[0]
            for x in (a, b)
        ]
        assert jaccard._distance(*made) <= len(a ^ b)


def test_embeddings_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embed, "CELL", 40)
    monkeypatch.setattr(embed, "BLOCK", 16)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(30, 16))
    rows = [(k, (centres[k % 30] + 0.03 * rng.normal(size=16)).tolist(), k % 3) for k in range(300)]
    rows += [(300, [0.0] * 16, 1), (301, None, 1), (302, rows[0][1], None), (303, [float("nan")] * 16, 0)]
    rows += [(304, rows[0][1], 0), (305, [*rows[0][1][:15], None], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    usable = [r for r in df.collect() if r.vec_id < 300 or r.vec_id == 304]
    x = np.array([r.embedding for r in usable], dtype=float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r.label for r in usable])
    close = (x @ x.T >= 0.98) & (label[:, None] == label)
    np.fill_diagonal(close, False)
    got = {r.vec_id: r for r in embed.near_duplicates(df).collect()}
    assert len(got) == len(rows)
    assert sum(r.n_links for r in got.values()) >= 0.9 * close.sum()
    assert all(got[r.vec_id].n_links <= n for r, n in zip(usable, close.sum(1), strict=True))
    assert all(got[k].n_links == 0 and got[k].kept for k in (300, 301, 302, 303, 305))


def test_ctw_scores_and_word_baseline(spark):
    docs = documents(spark, ROWS).withColumn("held_out", F.coalesce(F.col("doc_id") % 3 == 0, F.lit(False)))
    count, ends = Counter(), 0
    for doc, text, _ in ROWS:
        if doc is None or doc % 3:
            count.update(words(text))
            ends += 1
    total, kinds = sum(count.values()) + ends, len(count) + 1
    for r in ctw.score(docs).collect():
        text = next(t for d, t, _ in ROWS if d == r.doc_id)
        base = sum(math.log10((c + 0.1) / (total + 0.1 * (kinds + 1))) for c in [*(count[w] for w in words(text)), ends])
        assert r.base_score == pytest.approx(base) and r.train_tokens == total
        assert (r.n_tokens, r.n_known) == (len(words(text)) + 1, sum(count[w] > 0 for w in words(text)) + 1)
        assert r.score <= 0 and (r.score == 0) == (not text)


def ctw_by_force(train, text):
    """log10 of a text by the recursion over all contexts, nodes in plain dictionaries."""
    counts = Counter()

    def nodes(raw, k, depth):
        context = bytes(raw[k - j] if k >= j else 0 for j in range(1, depth + 1))
        return [(context, level, raw[k] >> (8 - level), raw[k] >> (7 - level) & 1) for level in range(8)]

    for raw in train:
        for k in range(len(raw)):
            for depth in range(ctw.DEPTH + 1):
                counts.update(nodes(raw, k, depth))
    below = {}
    for context, level, prefix, _ in counts:
        if context:
            below.setdefault((context[:-1], level, prefix), set()).add(context)

    def kt(context, level, prefix):
        a, b = (counts[(context, level, prefix, bit)] for bit in (0, 1))
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def whole(context, level, prefix, depth):
        own = kt(context, level, prefix)
        if len(context) == depth:
            return own
        children = sum(whole(c, level, prefix, depth) for c in below.get((context, level, prefix), ()))
        return np.logaddexp(own, children) - math.log(2)

    def zero(context, level, prefix):
        a, b = (counts[(context[:0], level, prefix, bit)] for bit in (0, 1))
        weights, chances = [], []
        for d in range(ctw.DEPTH + 1):
            a, b = (counts[(context[:d], level, prefix, bit)] for bit in (0, 1))
            if d and not a + b:
                break
            chances.append((a + 0.5) / (a + b + 1))
            cut = ctw.TOP if d < ctw.TOP else ctw.DEPTH
            weights.append(math.exp(min(0, kt(context[:d], level, prefix) - math.log(2) - whole(context[:d], level, prefix, cut))))
        out = chances[-1]
        for weight, chance in list(zip(weights, chances, strict=True))[-2::-1]:
            out = weight * chance + (1 - weight) * out
        return out

    total = 0.0
    for k in range(len(text)):
        context = bytes(text[k - j] if k >= j else 0 for j in range(1, ctw.DEPTH + 1))
        for level in range(8):
            p = zero(context, level, text[k] >> (8 - level))
            total += math.log10(1 - p if text[k] >> (7 - level) & 1 else p)
    return total


def test_ctw_matches_the_recursion(spark, monkeypatch):
    monkeypatch.setattr(ctw, "BATCH", 40)
    monkeypatch.setattr(ctw, "BUCKET", 60)
    texts = ["the cat sat on the mat", "the cat ate the rat", "a rat sat é", "", "the rats sat on mats", "zzzz"]
    rows = [(k, t, k >= 4) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")
    train = [t.encode() for _, t, held in rows if not held]
    for r in ctw.score(docs).collect():
        assert r.score == pytest.approx(ctw_by_force(train, texts[r.doc_id].encode()), rel=1e-4, abs=1e-4)


def test_ctw_is_a_distribution(spark):
    texts = spark.createDataFrame([("abcabdabc",), ("xbc",)], "text string")
    upper = ctw.fit(texts)
    code = np.unique(ctw.codes(*bytesops.lay_out([b"abcabdabc", b"xbc"])))
    contexts = np.unique(code >> np.uint64(8) << np.uint64(8))
    every = np.unique((contexts[:, None] | np.arange(256, dtype=np.uint64)).ravel())
    chance = 10 ** ctw.mixed_log10(every, np.isin(every, code).astype(np.int64), upper)
    assert np.allclose(chance.reshape(-1, 256).sum(axis=1), 1, atol=1e-5)


def test_byte_network_learns_and_marks_unknown(spark):
    rng = np.random.default_rng(4)
    make = lambda parts: " ".join("".join(rng.choice(parts, 3)) for _ in range(40))
    rows = [(k, make(["the", "ing", "er"]), "en") for k in range(60)] + [(100 + k, make(["ción", "os", "ez"]), "es") for k in range(60)]
    df = spark.createDataFrame(rows, "key long, text string, lang string")
    net = langid.fit(df)
    odd = spark.createDataFrame([(900, None), (901, "123 !!"), (902, "")], "key long, text string")
    out = {r.key: r for r in langid.identify(df.drop("lang").union(odd), net).collect()}
    assert [out[k].lang_pred for k in (900, 901, 902)] == ["und"] * 3
    assert np.mean([out[k].lang_pred == lang for k, _, lang in rows]) > 0.95
    assert all(0 <= r.score <= 1 for r in out.values())
    assert langid.identify(odd, None).first().lang_pred == "und"


def test_quality_catches_faults_and_keeps_clean(spark):
    rng = np.random.default_rng(6)
    make = lambda n: " ".join(f"w{k}" for k in rng.integers(0, 300, n))
    clean = [(k, make(60)) for k in range(300)]
    toxic = [(1000 + k, make(30) + " you lowei stupid " + make(20)) for k in range(80)]
    learned = [(3000 + k, make(30) + " xquox " + make(20)) for k in range(60)]
    junk = [(2000 + k, " ".join(w + "%%%" for w in make(40).split())) for k in range(60)]
    rows = [*clean, *toxic, *learned, *junk, (5000, None), (5001, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marked = [(d, 1, 0) for d, _ in clean[::2]] + [(d, 1, 1) for d, _ in [*learned[::2], *toxic[::2]]] + [(d, 0, 0) for d, _ in junk[::2]]
    labels = spark.createDataFrame([*marked, (7, None, None)], "doc_id long, quality int, toxic int")
    keep = {r.doc_id: r.keep for r in quality.classify(docs, labels).collect()}
    assert len(keep) == len(rows) and keep[5000] and keep[5001]
    assert not any(keep[d] for d, _ in toxic) and not any(keep[d] for d, _ in junk)
    assert np.mean([not keep[d] for d, _ in learned]) > 0.95 and np.mean([keep[d] for d, _ in clean]) > 0.95


def test_decontamination_tolerates_substitutions_on_both_paths(spark):
    item = [f"item{k}" for k in range(20)]
    changed = list(item)
    changed[4] = changed[15] = "other"
    texts = [" ".join(["lead"] * 9 + item + ["end"] * 9), " ".join(changed), "item0 item1 of something else " * 5, None, ""]
    docs = documents(spark, [(k, t, "a") for k, t in enumerate(texts)])
    bench = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, "short one")], "item_id long, text string")
    for few in (1_000_000, 0):
        got = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, bench, broadcast_seeds=few).collect()}
        assert got == {(0, 1), (1, 1)}
    assert sorted(r.doc_id for r in decontam.without_contaminated(docs, bench).collect()) == [2, 3, 4]


def overlaps_by_force(docs, items):
    """All pairs that overlap, over every diagonal and every set of tokens, with the best window's count."""
    han = re.compile(r"[\u4e00-\u9fff]|[a-z0-9\x80-\u4dff\ua000-\U0010ffff]+")
    cut = lambda t: han.findall((t or "").lower())
    out = {}
    for doc, text in docs:
        for item, asked in items:
            d, x = cut(text), cut(asked)
            width = min(13, len(x))
            for start in range(-len(x) + 1, len(d) if x else 0):
                agree = [0 <= start + i < len(d) and d[start + i] == t for i, t in enumerate(x)]
                best = max(sum(agree[k : k + width]) for k in range(len(x) - width + 1))
                if best >= math.ceil(0.75 * width):
                    out[doc, item] = max(out.get((doc, item), 0), best)
    return out


@pytest.mark.parametrize("width", range(1, 14))
def test_decontamination_masks_hit_every_overlap(width):
    masks = decontam.covering_masks(width)
    for gone in combinations(range(width), width - math.ceil(0.75 * width)):
        fits = [
            all(at + i not in gone for i, bit in enumerate(m) if bit == "1")
            for m in masks
            for at in range(width - len(m) + 1)
        ]
        assert any(fits), (masks, gone)


def test_decontamination_matches_brute_force(spark):
    rng = np.random.default_rng(8)
    items, texts = [(90, "天地玄黄宇宙洪荒"), (91, None), (92, ""), (93, "Short one")], []
    for n in (1, 2, 3, 4, 5, 7, 8, 9, 11, 12, 13, 14, 15, 20, 30):
        for k in range(2):
            item = [f"i{n}x{k}x{j % 11}" for j in range(n)]
            items.append((10 * n + k + 1000, " ".join(item)))
            for misses in range(5):
                text = list(item)
                for place in rng.permutation(n)[: min(misses, n)]:
                    text[place] = "other"
                text = text[int(rng.integers(0, 2)) :]
                texts.append(" ".join(["lead"] * int(rng.integers(0, 3)) + text + ["end"] * int(rng.integers(0, 3))))
    texts += ["前天地玄黄宇亩洪荒后", "天地玄", None, "", "a short one", "short"]
    rows = list(enumerate(texts))
    want = overlaps_by_force(rows, items)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for few in (1_000_000, 0):
        got = {(r.doc_id, r.item_id): r.matched for r in decontam.contaminated(docs, bench, broadcast_seeds=few).collect()}
        assert got == want
    assert decontam.contaminated(docs, bench.limit(0)).isEmpty()


def test_stages_keep_other_texts_of_an_id(spark, tmp_path):
    item = " ".join(f"item{k}" for k in range(20))
    clean = [" ".join(f"clean{d}x{k}" for k in range(20)) for d in range(4)]
    rows = [(None, item, "a"), (None, clean[0], "a"), (7, item, "a"), (7, clean[1], "a"), (8, clean[2], "a"), (9, clean[2], "b"), (9, clean[3], "b")]
    docs = documents(spark, rows)
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    for few in (1_000_000, 0):
        out = decontam.without_contaminated(docs, bench, broadcast_seeds=few)
        assert sorted(r.text for r in out.collect()) == sorted(t for _, t, _ in rows if t != item)
    out = jaccard.without_near_duplicates(docs).select("doc_id", "text").collect()
    kept = [(7, clean[1]), (7, item), (8, clean[2]), (9, clean[3])]
    assert sorted(tuple(r) for r in out if r.doc_id is not None) == kept
    assert sum(r.doc_id is None for r in out) == 2

    unnamed = [(None, f"{k} " + "w " * 4, "b" if k % 3 else "a") for k in range(2000)]
    taken = mixing.mix(documents(spark, unnamed)).groupBy("source").count().collect()
    sizes = {r.source: r.target / 5 for r in mixing.with_copies(documents(spark, unnamed)).collect()}
    assert all(r["count"] == pytest.approx(sizes[r.source], rel=0.1) for r in taken)

    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    assert not any(r.held_out for r in ctw.op4_lm_score(spark, str(tmp_path)).collect() if r.doc_id is None)


def test_decontamination_takes_long_items(spark):
    long = " ".join(f"long{k}" for k in range(20_000))
    part = " ".join(f"long{k}" if k % 9 else f"other{k}" for k in range(7000, 7040))
    rows = [(1, f"before {long} after", "a"), (2, f"before {part} after", "a"), (3, " ".join(f"clean{k}" for k in range(400)), "a")]
    bench = spark.createDataFrame([(1, long), (2, "long3 long9")], "item_id long, text string")
    found = [
        sorted(tuple(r) for r in decontam.contaminated(documents(spark, rows), bench, broadcast_seeds=few).collect())
        for few in (1_000_000, 0)
    ]
    assert found[0] == found[1] == [(1, 1, 13, 13, 1), (2, 1, 12, 13, -6999)]
    kept = decontam.without_contaminated(documents(spark, [(4, "the long3 long9 pair", "a")]), bench, least_tokens=3)
    assert kept.count() == 1


def test_mix_meets_targets_and_limits(spark):
    rows = [(k, "w " * (1 + k % 5), "abc"[k % 3] if k % 20 else None) for k in range(4000)]
    out = mixing.with_copies(documents(spark, rows)).collect()
    assert len(out) == 4000 and all(r.copies <= 3 for r in out)
    for source in ("a", "b", "c", None):
        mine = [r for r in out if r.source == source]
        assert mine[0].target <= 3 * mine[0].source_size + 1e-9
        assert sum(r.size * r.copies for r in mine) == pytest.approx(mine[0].target, rel=0.1)
    assert mixing.mix(documents(spark, [])).count() == 0


@pytest.mark.parametrize("one_id", [None, 7])
def test_mix_meets_targets_where_rows_share_an_id(spark, one_id):
    rows = [(one_id, f"w{i} some words in it", "a") for i in range(1000)] + [(i, "some words " * 200, "b") for i in range(20)]
    out = mixing.with_copies(documents(spark, rows)).where("source = 'a'").collect()
    target, taken = out[0].target, sum(r.size * r.copies for r in out)
    assert target % out[0].source_size and abs(taken - target) < 0.1 * target


def test_chat_round_trip_and_order(spark):
    odd = "␛ </s> ␛␛[INST] <<SYS>>\n[/ROLE] \\ $1"
    rows = [
        (1, 1, "assistant", odd), (1, 0, "user", odd), (2, 0, "assistant", "first"), (2, 1, "tool box\n", None),
        (3, 0, None, "no role"), (None, 0, "user", "x"), (4, 0, "system", "s"), (4, 1, "user", "\n"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    back = {r.conv_id: r for r in chat.read_back(chat.format_conversations(df)).collect()}
    for conv in (1, 2, 3, 4, None):
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=lambda r: r[1])]
        assert [tuple(t) for t in back[conv].turns] == turns
    assert [back[c].valid for c in (1, 2, 3, 4, None)] == [True, False, False, True, True]
    assert [s.text for s in back[2].segments if s.loss] == ["first"]


def test_warc_round_trip_with_revisits(spark, tmp_path):
    rows = [(1, "http://a/\r\nx", "same"), (2, "http://b", "same"), (3, None, None), (4, "u", ""), (5, "v", "WARC/1.1\r\n\r\né")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write_archives(pages, str(tmp_path / "w"))
    found = warc.read_archives(spark, str(tmp_path / "w"))
    assert found.where("gap is not null").count() == 0
    got = {r.record_id: r for r in found.collect()}
    assert got["<urn:page:1>"].record_type == "revisit" and got["<urn:page:1>"].refers_to == "<urn:page:2>"
    assert got["<urn:page:3>"].refers_to == "<urn:page:4>" and got["<urn:page:3>"].payload_bytes == 0
    assert bytes(got["<urn:page:5>"].payload) == rows[4][2].encode()
    digest = base64.b32encode(hashlib.sha1(b"same").digest()).decode()
    assert got["<urn:page:1>"].payload_digest == digest and got["<urn:page:1>"].payload_bytes == 4


def test_warc_reads_back_long_urls_and_bounds_files_by_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 40 * 1200)
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 40)
    rows = [(k, "http://a/" + "q" * (200_000 if k == 3 else k), f"{k} " + "x" * (3000 * (k % 5))) for k in range(60)]
    rows.append((60, "data:," + "\n" * 70_000, "y" * 300_000))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    warc.write_archives(pages, str(tmp_path / "w"))
    found = warc.read_archives(spark, str(tmp_path / "w")).collect()
    assert not [r.gap for r in found if r.gap]
    assert sorted(bytes(r.payload).decode() for r in found) == sorted(h for *_, h in rows)
    per_file = Counter(r.file for r in found)
    sizes = {f.name: f.stat().st_size for f in (tmp_path / "w").glob("*.txt")}
    assert all(size <= 40 * 1200 or per_file[next(p for p in per_file if p.endswith(name))] == 1 for name, size in sizes.items() if size)
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    assert warc.op7_warc(spark, str(tmp_path)).count() == len(rows)
    # Damage in its own archive is no shorter result.
    write = warc.write_archives

    def broken(pages, path, least=0):
        write(pages, path, least)
        name = next(f for f in sorted(os.listdir(path)) if f.endswith(".txt"))
        with open(f"{path}/{name}", "r+b") as file:
            file.write(b"JUNK")
        crc = f"{path}/.{name}.crc"
        if os.path.exists(crc):
            os.remove(crc)

    monkeypatch.setattr(warc, "write_archives", broken)
    with pytest.raises(Exception, match="unreadable record"):
        warc.op7_warc(spark, str(tmp_path)).collect()


def plain(number, body):
    head = f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:{number}>\r\nContent-Length: {len(body)}\r\n\r\n"
    return head.encode() + body + b"\r\n\r\n"


@pytest.mark.parametrize("pack", [lambda x: x, gzip.compress])
def test_warc_salvages_after_damage(pack):
    parts = [pack(plain(k, b"body %d" % k * 9)) for k in range(5)]
    broken = bytearray(parts[2])
    broken[len(broken) // 2 :] = b"?" * (len(broken) // 3)
    data = parts[0] + parts[1] + bytes(broken) + parts[3] + parts[4]
    out = list(warc.salvage(data))
    assert [r["record_id"] for *_, r in out if r] == [f"<urn:page:{k}>" for k in (0, 1, 3, 4)]
    gaps = [(a, b) for a, b, reason, _ in out if reason]
    assert gaps == [(len(parts[0] + parts[1]), len(data) - len(parts[3] + parts[4]))]
    assert list(warc.salvage(b"")) == [] and list(warc.salvage(b"junk"))[0][:2] == (0, 4)


def test_rolling_hash_agrees_at_any_place():
    flat = np.frombuffer(b"abcabcabcxabc", dtype=np.uint8)
    sums = bytesops.WORD_HASH.sums(flat)
    at = np.array([0, 3, 6, 10])
    assert len(set(bytesops.WORD_HASH.spans(sums, at, at + 3).tolist())) == 1
    assert zlib.crc32(b"7") % 4 in range(4)


def test_empty_tables(spark):
    none = documents(spark, [])
    assert suffix.repeats(none).count() == 0
    assert jaccard.similarity_components(none).count() == 0
    assert ctw.score(none.withColumn("held_out", F.lit(False))).count() == 0
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embed.near_duplicates(empty).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.classify(none, labels).count() == 0
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contaminated(none, bench).count() == 0
