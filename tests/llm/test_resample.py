"""Resampling against a plain loop, its checksums and its sort by regular sampling."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tezgah.llm import resample

SCHEMA = "doc_id long, text string, place string, rank int, score string, row string"
WORDS = [f"w{k}" for k in range(60)] + ["É", "ü" * 40, "語" * 30]


def prose(seed, n):
    return " ".join(np.random.default_rng(seed).choice(WORDS, n))


TEXTS = [None, "", " \n", "One", "Two Words", prose(1, 19), prose(2, 20), prose(2, 20).upper(), "a`b_c;d" * 30, prose(3, 9000), "é" * 500 + " " + prose(4, 50)]
DOCS = [(k, t, "p", 1, "s", "r") for k, t in enumerate(TEXTS)] + [(100 + k, prose(k % 7, 25), "p", 1, "s", "r") for k in range(60)]
DOCS += [(None, prose(5, 30), "p", 1, "s", "r")] * 3 + [(9, "short", "p", 1, "s", "r"), (9, prose(8, 40), "p", 1, "s", "r")]
TARGET = [(1, prose(3, 400)), (2, None), (2, ""), (None, "w1 w2 w1 w2")]


def features(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def brute(docs, target, share=25, least=20, seed=7, buckets=10_000):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    s, t = (Counter(bucket(f) for x in texts for f in features(x)[1]) for texts in ([d[1] for d in docs], [x for _, x in target]))
    big_s, big_t = sum(s.values()), sum(t.values())
    rows = []
    for doc_id, text, *_ in docs:
        words, found = features(text)
        gains = [math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in map(bucket, found)]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append((doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), len(words)))
    able = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[4]))
    drawn = len(able) * share // 100
    out = [(*r[:4], k + 1 if k < drawn else None) for k, r in enumerate(able)]
    return Counter(out + [(*r[:4], None) for r in rows if r[4] < least])


def test_every_row_is_that_of_the_plain_loop(spark):
    docs = spark.createDataFrame(DOCS, SCHEMA).repartition(4)
    target = spark.createDataFrame(TARGET, "item_id long, text string")
    assert Counter(map(tuple, resample.report(docs, target).collect())) == brute(DOCS, TARGET)


def test_long_texts_are_cut_between_words_without_losing_a_pair(monkeypatch):
    monkeypatch.setattr(resample, "GROUP", 40)
    made = Counter()
    for of, bucket, _ in resample.Features().buckets([(t or "").encode() for t in TEXTS], 10_000):
        made.update(zip(of.tolist(), bucket.tolist(), strict=True))
    assert made == Counter((k, zlib.crc32(f.encode()) % 10_000) for k, t in enumerate(TEXTS) for f in features(t)[1])


@pytest.mark.parametrize("equal", [0, 700])
def test_ranks_are_exact_and_segments_even_with_ties(spark, equal):
    rng = np.random.default_rng(equal)
    rows = [(k, int(rng.integers(0, 50)), 30, 3, 5, 7 if k < equal else int(rng.integers(-9, 9))) for k in range(2000)]
    rows += [(5000 + k, None, 30, 3, 5, 7) for k in range(equal)]  # one value for a quarter of the rows
    frame = spark.createDataFrame(rows, "place long, doc_id long, n_words long, n_features long, weight long, score long").repartition(6)
    out = resample.ranked(frame, segments=8).collect()
    order = sorted(rows, key=lambda r: (-r[5], r[1] is None, r[1] or 0, r[3], r[2], r[0]))
    assert [r.place for r in sorted(out, key=lambda r: r.rank)] == [r[0] for r in order]
    assert sorted(r.rank for r in out) == list(range(1, len(rows) + 1))


def test_segments_are_even(spark, monkeypatch):
    kept = {}
    real = resample.stored
    monkeypatch.setattr(resample, "stored", lambda df, name: kept.setdefault(name, real(df, name)))
    frame = spark.range(4000).selectExpr("id as place", "id % 3 as doc_id", "30L as n_words", "3L as n_features", "5L as weight", "if(id < 2000, 1L, id % 5) as score")
    resample.ranked(frame, segments=8).count()
    sizes = [r["count"] for r in kept["segments"].groupBy("segment").count().collect()]
    assert len(sizes) == 8 and max(sizes) <= 500 * (1 + 2 / resample.OVER) + 1


def test_the_draw_keeps_all_columns_and_counts(spark):
    docs = spark.createDataFrame(DOCS, SCHEMA)
    target = spark.createDataFrame(TARGET, "item_id long, text string")
    drawn = resample.draw(docs, target)
    able = sum(len(features(d[1])[0]) >= 20 for d in DOCS)
    assert drawn.columns == docs.columns and drawn.count() == able * 25 // 100
    assert Counter(map(tuple, drawn.collect())) <= Counter(DOCS)


def test_nothing(spark):
    none, target = spark.createDataFrame([], SCHEMA), spark.createDataFrame(TARGET, "item_id long, text string")
    assert resample.report(none, target).collect() == []
    docs = spark.createDataFrame(DOCS, SCHEMA)
    assert Counter(map(tuple, resample.report(docs, target.limit(0)).collect())) == brute(DOCS, [])
    assert resample.draw(none, target).columns == docs.columns


def test_text_of_a_null_row_and_a_word_longer_than_the_tables():
    words = [b"x" * n for n in (1, 46, 47, 48, 49, 300)]
    text = b" ".join(a + b" " + b for a in words for b in words)
    found = Counter(b for _, bucket, _ in resample.Features().buckets([None, text], 1 << 32) for b in bucket.tolist())
    parts = text.split()
    assert found == Counter(zlib.crc32(w) for w in parts) + Counter(zlib.crc32(a + b" " + b) for a, b in zip(parts, parts[1:], strict=False))


def test_the_contract_s_types(spark):
    out = resample.report(spark.createDataFrame(DOCS, SCHEMA), spark.createDataFrame(TARGET, "item_id long, text string"))
    assert out.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    assert out.where(F.col("rank") < 1).isEmpty()
