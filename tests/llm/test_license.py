"""License scans against plain Python over all blocks."""

import random
import re

import pytest

from stagehouse.llm import license as scans

SCHEMA = "doc_id long, text string, words string, rid int"


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def by_hand(text, templates=scans.TEMPLATES):
    w = words(text)
    places, base, labels, score = [], set(), set(), 0.0
    for t in templates:
        s = t.sequence
        if t.phrase:
            at = [p for p in range(len(w)) if w[p : p + len(s)] == s]
            places += at
            if at:
                base.add(t.label)
                labels.add(t.label)
                score = 1.0
            continue
        for start in range(0, max(len(w), 1), t.step):
            share = len(t.words & set(w[start : start + 2 * t.step])) / len(t.words)
            if share * len(t.words) >= t.need - 1e-9:
                labels.add(t.label)
                score = max(score, share)
    first, last = (min(places), max(places)) if places else (None, None)
    return len(w), len(places), first, last, ",".join(sorted(base)), ",".join(sorted(labels)), round(score, 12)


def held(spark, texts, parts=3):
    rows = [(i, t, "x", 3) for i, t in texts]
    out = scans.scan(spark.createDataFrame(rows, SCHEMA).repartition(parts)).collect()
    got = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 12)) for r in out]
    want = [(i, *by_hand(t)) for i, t in texts]
    key = lambda r: [(v is not None, v) for v in r]
    assert sorted(got, key=key) == sorted(want, key=key)


LONG = " ".join(f"w{i % 83}" for i in range(508))


def test_awkward_rows(spark):
    held(
        spark,
        [
            (1, None), (2, ""), (3, "!!! ..."), (4, "CC BY cc by, CC-BY"), (5, "cc bye"), (6, "General Public-License v3"),
            (7, LONG + " all rights reserved " + LONG + " licensed under CC BY-NC 4.0"), (7, "cc by"), (None, "all rights reserved"),
            (None, "all rights reserved"), (8, "rights all reserved"), (9, "Großes cc by cc by 漢字"), (10, "cc " * 700 + "by " * 700),
            (11, LONG + " Released under the MIT License."), (12, "released by the mit under license"), (13, "all all rights reserved rights reserved"),
        ],
    )


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_texts(spark, seed):
    rng = random.Random(seed)
    vocabulary = sorted({w for t in scans.TEMPLATES for w in t.words})
    texts = []
    for i in range(60):
        parts = []
        while len(parts) < rng.choice([5, 40, 700, 1500]):
            t = rng.choice(scans.TEMPLATES)
            s = [w for w in t.sequence if rng.random() < rng.choice([0.7, 1.0])]
            if rng.random() < 0.3:
                rng.shuffle(s)
            parts += s + [rng.choice(vocabulary) if rng.random() < 0.2 else f"w{rng.randrange(50)}" for _ in range(rng.randrange(40))]
        texts.append((rng.choice([i, 5, None]), " ".join(parts)))
    held(spark, texts)


def test_empty(spark):
    out = scans.scan(spark.createDataFrame([], SCHEMA))
    assert out.count() == 0 and out.columns[:3] == ["doc_id", "n_words", "n_base"]


def test_prefix_follows_the_corpus(spark):
    texts = [(i, "reserved " * 9 + "rights") for i in range(20)] + [(50, "all rights reserved")]
    docs = spark.createDataFrame([(i, t, "", 0) for i, t in texts], SCHEMA)
    vocabulary = sorted({w for t in scans.PHRASES for w in t.words})
    segments = scans.known_words(docs, vocabulary)
    counts = scans.word_counts(segments, vocabulary)
    assert (counts["all"], counts["rights"], counts["reserved"]) == (1, 21, 181)
    assert scans.matches(segments, scans.PHRASES, counts).count() == 1
