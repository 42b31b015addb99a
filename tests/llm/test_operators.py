"""The operators against brute force on small frames, with the cases that go wrong first."""

import hashlib
import re
import time
import zlib
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tezgah.llm import chat, components, decontaminate, line_dedup, lm_score, packing, pii, quality_lines, simhash, token_files, tokens, toxicity

WORDS = [f"w{k}" for k in range(400)]
SCHEMA = "doc_id long, text string, lang string, row string, n_chars long, key long"


def prose(seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(WORDS, n))


LONG = prose(1, 300)
PASSAGE = prose(99, 60)
TEXTS = [
    None, "", " \n\t", "One", "two words", LONG, LONG, LONG.upper(), LONG.replace("w7 ", "w8 ", 1), prose(2, 5000),
    f"first line here.\n{PASSAGE}.\nlast line one.", f"other start.\n{PASSAGE}.\nend two.", "the the the the the the " * 20,
    "É ß Жук <|endoftext|> don't  stop\r\n\n tab\there ", "a|b\n" * 5, prose(5, 80) + ".",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "en", "clash", len(t or ""), 7) for k, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def benchmark(spark):
    words = LONG.split()
    rows = [(1, " ".join(words[20:45])), (2, prose(77, 40)), (3, "ONE"), (4, None), (5, ""), (None, LONG), (10, " ".join(words[40:60]))]
    return spark.createDataFrame(rows, "item_id long, text string")


def root_of(links, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3), (5, 6)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(1, 41)} | {k: 100 for k in range(101, 160)}
    assert not components.connected_components(spark.createDataFrame([], "a long, b long")).count()


def test_simhash_matches_brute_force(docs, nothing):
    expected = {}
    for k, text in enumerate(TEXTS):
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        grams = [words[i : i + 4] for i in range(len(words) - 3)] or ([words] if words else [])
        hashes = [xxhash.xxh64_intdigest(b" ".join(g), 42) for g in grams]
        expected[k] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    roots = root_of([(a, b) for a, b in combinations(expected, 2) if (expected[a] ^ expected[b]).bit_count() <= 4], expected)
    got = simhash.near_duplicates(docs).collect()
    assert {r.doc_id: (r.fp % (1 << 64), r.component_id) for r in got} == {k: (expected[k], roots[k]) for k in expected}
    assert sorted(r.doc_id for r in simhash.first_of_each(docs).collect()) == sorted(set(roots.values()))
    assert simhash.first_of_each(docs).columns == docs.columns
    assert not simhash.near_duplicates(nothing).count()


def test_links_connect_a_dense_group_in_small_blocks(spark):
    rng = np.random.default_rng(3)
    prints = {int(x) for x in rng.integers(0, 1 << 62, 60)}
    for base in list(prints)[:4]:
        prints |= {base ^ (1 << int(a)) ^ (1 << int(b)) ^ (1 << int(c)) for a, b, c in rng.integers(0, 62, (60, 3))}
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    links = [(r.a, r.b) for r in simhash.near_links(frame, block=16).collect()]
    assert all((a ^ b).bit_count() <= 4 for a, b in links)
    full = [(a, b) for a, b in combinations(prints, 2) if (a ^ b).bit_count() <= 4]
    assert root_of(links, prints) == root_of(full, prints)


@pytest.mark.parametrize("block_bytes", [8 << 20, 200])
def test_decontamination_matches_brute_force(docs, benchmark, nothing, block_bytes):
    def words(text):
        return re.findall("[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    windows = {}
    benchmark = benchmark.where("item_id is not null")  # those without are the next test's
    for item, text in [(r.item_id, r.text) for r in benchmark.collect()]:
        w = words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i : i + 10]), set()).add(item)
    found = decontaminate.annotated(docs, benchmark, block_bytes=block_bytes).select("row.doc_id", "n_words", decontaminate.covered(decontaminate.F.col("matches")).alias("hit"), "matches").collect()
    for r in found:
        w, hit, items = words(TEXTS[r.doc_id]), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    items |= windows[tuple(w[i : i + n])]
        assert (r.n_words, r.hit, {m.item_id for m in r.matches}) == (len(w), len(hit), items), r.doc_id
    report = {r.doc_id: r for r in decontaminate.report(docs, benchmark).collect()}
    assert report[5].items_sha256 == hashlib.sha256(b"1,10").hexdigest() and report[5].longest_match == 25
    assert report[0].items_sha256 == hashlib.sha256(b"").hexdigest()
    clean = decontaminate.clean(docs, benchmark)
    assert clean.columns == docs.columns and {3, 5, 6, 7}.isdisjoint({r.doc_id for r in clean.collect()})
    assert not decontaminate.report(nothing, benchmark).count()


def test_items_without_an_id_contaminate_too(spark):
    rows = [(1, f"{prose(61, 30)} {PASSAGE}"), (2, prose(62, 30)), (3, None), (4, PASSAGE + " " + LONG)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    words = PASSAGE.split()
    items = spark.createDataFrame([(None, " ".join(words[:30])), (None, " ".join(words[20:45])), (7, LONG), (None, None)], "item_id long, text string")
    out = {r.doc_id: r for r in decontaminate.report(docs, items).collect()}
    none = hashlib.sha256(b"").hexdigest()
    assert [(out[k].n_hit, out[k].n_items, out[k].contaminated) for k in (1, 2, 3, 4)] == [(45, 0, True), (0, 0, False), (0, 0, False), (345, 1, True)]
    assert out[1].items_sha256 == none and out[4].items_sha256 == hashlib.sha256(b"7").hexdigest()
    assert out[1].longest_item is None and out[1].longest_match == 30
    assert sorted(r.doc_id for r in decontaminate.clean(docs, items).collect()) == [2, 3]


def test_decontamination_without_items(docs, benchmark, nothing):
    assert decontaminate.clean(docs, benchmark.limit(0)).count() == len(TEXTS)


def encoded(file, text):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(file))
    tokenizer.encode_special_tokens = True
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_packing_holds_every_piece_once(docs, nothing):
    rows = packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json")).collect()
    for k, text in enumerate(TEXTS):
        ids = np.array([*encoded("byte_bpe_50k.json", text), 0], "<u4")
        at = 0
        for n, r in enumerate(sorted((r for r in rows if r.doc_id == k), key=lambda r: r.piece)):
            assert (r.piece, r.start) == (n, at) and (n == 0 or r.length == 2048)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for s in {r.sequence_id for r in rows}:
        at = 0
        for r in sorted((r for r in rows if r.sequence_id == s), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert not packing.packed(nothing, public_tokenizers.path("byte_bpe_50k.json")).count()


def fewest(sizes, capacity):
    """The least number of bins, by trying every place."""
    best = [len(sizes)]

    def put(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(sizes):
            best[0] = len(bins)
            return
        for i, b in enumerate(bins):
            if b + sizes[k] <= capacity and b not in bins[:i]:
                put(k + 1, [*bins[:i], b + sizes[k], *bins[i + 1 :]])
        put(k + 1, [*bins, sizes[k]])

    put(0, [])
    return best[0]


def test_plans_are_as_small_as_any():
    rng = np.random.default_rng(0)
    for _ in range(60):
        sizes = sorted(rng.integers(1, 20, 9).tolist(), reverse=True)
        made = packing.plan({s: sizes.count(s) for s in sizes}, 20)
        assert sum(m for _, m in made) == fewest(sizes, 20), sizes
        held = [s for filling, m in made for s, t in filling for _ in range(t * m)]
        assert sorted(held, reverse=True) == sizes


def test_token_files_round_trip(docs, nothing, spark):
    path = token_files.write_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))
    keys = spark.createDataFrame([(k,) for k in [*range(len(TEXTS)), 5000, None]], "doc_id long")
    got = {r.doc_id: r for r in token_files.read_ids(token_files.find_keys(keys, path), path).collect()}
    at = 0
    for k, text in enumerate(TEXTS):
        ids = np.array([*encoded("word_bpe_49k.json", text), 1], "<u4")
        assert (got[k].start, got[k].n_tokens, got[k].ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert len(got) == len(TEXTS)
    empty = token_files.write_tokens(nothing, public_tokenizers.path("word_bpe_49k.json"))
    assert not token_files.find_keys(keys, empty).count()


def test_the_hash_is_perfect_and_minimal():
    keys = np.random.default_rng(1).integers(-(1 << 62), 1 << 62, 20_000)
    slots = token_files.PerfectHash.of(keys).slot(keys)
    assert sorted(slots.tolist()) == list(range(len(keys)))


def test_base_measures_match_brute_force(docs, nothing):
    for r in quality_lines.report(docs).collect():
        text = TEXTS[r.doc_id] or ""
        w = re.findall("[^\x20\x09-\x0d]+", text)
        lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
        grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        covered = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in (i, i + 1, i + 2)} if len(w) < 1000 else None
        assert (r.n_words, r.word_chars, r.n_dup_lines) == (len(w), sum(map(len, w)), len(lines) - len(set(lines)))
        assert r.n_symbols == len(re.findall("[#*$%&|<>]", text))
        assert covered is None or r.n_repeat_words == len(covered)
        assert r.base_failed == (len(w) < 50 or 100 * r.n_repeat_words > 50 * len(w)) and not (r.base_failed and r.kept)
    assert not quality_lines.report(nothing).count() and quality_lines.clean(docs).columns == docs.columns


def test_failing_lines_go_and_much_loss_rejects(spark):
    good = prose(1, 60) + "."
    rows = [(1, f"Home | About | Log in\n{good}\nAll rights reserved."), (2, "a | b | c | d\n" * 30 + good), (3, good)]
    out = quality_lines.clean(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.text for r in out} == {1: good, 3: good}


def test_cleaning_keeps_what_the_report_keeps(docs, nothing):
    good = docs.unionByName(docs.selectExpr("doc_id + 100 AS doc_id", "repeat('Some words end here.\\na | b | c\\nTen new ' || doc_id || ' ones.\\n', 1) || text || '.' AS text", "lang", "row", "n_chars", "key"))
    kept = {r.doc_id for r in quality_lines.report(good).collect() if r.kept}
    out = quality_lines.clean(good)
    rows = out.collect()
    assert kept and out.columns == docs.columns and sorted(r.doc_id for r in rows) == sorted(kept)
    assert all(r.n_chars == len(r.text) and r.row == "clash" for r in rows)
    assert not any("a | b | c" in r.text for r in rows)
    assert quality_lines.clean(nothing).columns == docs.columns and not quality_lines.clean(nothing).count()
    assert out._jdf.queryExecution().executedPlan().toString().count("Generate explode") == 1


@pytest.mark.parametrize(("name", "pieces"), [("word_bpe_49k.json", tokens.BARE), ("byte_bpe_50k.json", tokens.SPACED)])
def test_encoder_gives_the_ids_of_whole_texts_also_after_a_pause(name, pieces, monkeypatch):
    monkeypatch.setattr(tokens, "IDLE", 0.2)
    plain = Tokenizer.from_file(public_tokenizers.path(name))
    plain.encode_special_tokens = True
    expected = [np.array(plain.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in TEXTS]
    own = tokens.Encoder(public_tokenizers.path(name), pieces, "<u4")
    assert list(own.encode(TEXTS)) == expected and own.kept
    time.sleep(1)
    assert not own.kept and list(own.encode(TEXTS)) == expected


def test_repeated_runs_go_and_the_first_stays(docs, nothing):
    out = {r.doc_id: r for r in line_dedup.report(docs).collect()}
    assert out[10].n_deleted == 0 and out[11].text == "other start.\nend two."
    assert out[5].n_deleted == 0 and out[6].n_deleted == 1 and out[7].n_deleted == 1 and out[8].n_deleted == 0
    assert out[0].text is None and out[1].text == ""
    clean = line_dedup.clean(docs)
    assert clean.columns == docs.columns and {6, 7}.isdisjoint({r.doc_id for r in clean.collect()})
    assert not line_dedup.report(nothing).count()


def test_perspectives_mask_what_the_assistant_says(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "ann", "Hi <|end|>"), (1, 1, "ann", "Hi <|end|>"), (1, 2, "bob", None), (1, None, "cy", "early"), (2, 0, "system", "alone"), (None, 0, "ann", "x"), (3, 0, None, "who")]
    rows += [(4, k, "ann" if k % 2 else "bob", f"turn {k}") for k in range(25)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.perspectives(frame, part=10).collect()
    one = {r.assistant: r for r in out if r.conv_id == 1}
    assert set(one) == {"ann", "bob", "cy"} and {r.conv_id for r in out} == {1, 3, 4}
    assert one["ann"].text == "<|user:cy|>\nearly<|end|>\n<|system|>\nBe kind.<|end|>\n<|assistant|>\nHi < |end|><|end|>\n<|user:bob|>\n<|end|>\n"
    assert [one["ann"].text[m.start : m.stop] for m in one["ann"].mask] == ["Hi < |end|><|end|>\n"]
    four = sorted((r for r in out if r.conv_id == 4 and r.assistant == "ann"), key=lambda r: r.part)
    assert [r.n_turns for r in four] == [10, 10, 5]
    said = [r.text[m.start : m.stop] for r in four for m in r.mask]
    assert said == [f"turn {k}<|end|>\n" for k in range(1, 25, 2)]
    assert not chat.perspectives(frame.limit(0)).count()


def test_toxicity_knows_misspellings(spark):
    rng = np.random.default_rng(5)
    rows, labels = [], []
    for k in range(600):
        bad = k % 3 == 0
        words = list(rng.choice(WORDS, 40)) + ([f"grubl{x}" for x in rng.choice(list("abcdefgh"), 4)] if bad else [])
        rng.shuffle(words)
        rows.append((k, " ".join(words)))
        labels.append((k, int(bad)))
    rows += [(1000, prose(8, 40) + " grublix grublox grublyz"), (1001, prose(9, 40)), (1002, None), (1003, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    scores = {r.doc_id: r.score for r in toxicity.scored(docs, model).collect()}
    assert scores[1000] > 0.7 > 0.5 > scores[1001] and scores[1002] == scores[1003] and len(scores) == len(rows)
    untrained = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.score for r in toxicity.scored(docs, untrained).collect()} == {0.5}


def test_losses_match_brute_force(spark):
    texts = {k: prose(k, 200) if k % 2 else " ".join(f"v{x}" for x in np.random.default_rng(k).integers(0, 30, 200)) for k in range(12)} | {90: None, 91: "."}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    target = spark.createDataFrame([(k,) for k in range(0, 12, 2)], "doc_id long")
    got = {r.doc_id: r for r in lm_score.scored(docs, lm_score.train(docs, target)).collect()}
    kept_words = {k: t.split() for k, t in texts.items() if t and k < 90}
    groups = [[w for k, w in kept_words.items() if k % 2 == 0], list(kept_words.values())]
    count = lambda items: {x: items.count(x) for x in set(items)}
    first = count([x for w in groups[0] for x in w])
    vocabulary = {x for x, n in first.items() if n >= 2}
    mapped = [[["<s>", *(x if x in vocabulary else "<unk>" for x in w)] for w in g] for g in groups]
    unigrams = [count([x for w in g for x in w[1:]]) for g in mapped]
    pairs = [count([p for w in g for p in zip(w, w[1:], strict=False)]) for g in mapped]
    kept = {p for g in pairs for p, n in g.items() if n >= 2}

    def loss(k, words):
        n, size, total = sum(unigrams[k].values()), len(vocabulary) + 1, 0
        for before, now in zip(words, words[1:], strict=False):
            context = sum(c for (a, _), c in pairs[k].items() if a == before)
            share = {p: max(pairs[k].get(p, 0) - 0.75, 0) / max(context, 1) for p in kept if p[0] == before}
            left = 1 - sum(share.values()) if context else 1
            total -= np.log(share.get((before, now), 0) + left * (unigrams[k].get(now, 0) + 1) / (n + size))
        return total / (len(words) - 1)

    for k, words in kept_words.items():
        line = ["<s>", *(x if x in vocabulary else "<unk>" for x in words)]
        assert got[k].target_loss == pytest.approx(loss(0, line)) and got[k].background_loss == pytest.approx(loss(1, line))
    assert got[90].score is None and got[91].n_tokens == 0
    assert max(got[k].score for k in range(0, 12, 2)) < min(got[k].score for k in range(1, 12, 2))


def test_losses_do_not_depend_on_what_is_sent(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "FAST", 10)
    rng = np.random.default_rng(3)
    rows = [(k % 37, " ".join(f"w{x}" for x in rng.zipf(1.3, 60) % 400)) for k in range(80)] + [(None, "w1 w2 w3"), (5, None), (6, "unseen \u00e9\u00e9")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3, "text")
    target = spark.createDataFrame([(k,) for k in range(0, 37, 3)], "doc_id long")
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.n_tokens, r.target_loss or 0, r.background_loss or 0)
    whole, *others = [
        sorted(lm_score.scored(docs, lm_score.train(docs, target, **sent)).collect(), key=key)
        for sent in ({}, {"sent_words": 20, "sent_bigrams": 30}, {"sent_words": 20, "sent_bigrams": 0, "sent_checksums": 5}, {"sent_words": 0, "sent_checksums": 0})
    ]
    assert len(whole) == len(rows)
    for other in others:
        for a, b in zip(whole, other, strict=True):
            assert a[:2] == b[:2] and a[2:] == (pytest.approx(b[2:]) if b.n_tokens else b[2:])


def test_rare_words_and_bigrams_count_in_a_large_corpus(spark):
    common = " ".join(["a b c d"] * 25_000)
    docs = spark.createDataFrame([(k, common) for k in range(12)] + [(90, "rare pair"), (91, "rare pair"), (92, "rare other"), (93, "pair rare")], "doc_id long, text string")
    target = spark.createDataFrame([(k,) for k in (*range(11), 90, 91)], "doc_id long")
    got = {r.doc_id: r for r in lm_score.scored(docs, lm_score.train(docs, target)).collect()}
    # 1.1 million tokens of the target: by a share of them, two occurrences would be none
    assert got[90].target_loss == got[91].target_loss < got[93].target_loss - 1


def test_separators_are_looked_up_and_not_searched_for(spark):
    words = ["|", "::", "--", "\u203a", "|\u2028", "::\x85", "a", "||", "|a", "-", "\u2028"]
    lines = spark.createDataFrame([(i, f"{w} {w}") for i, w in enumerate(words)], "i long, line string")
    out = lines.select("i", quality_lines.line_fails(F.col("line")).alias("rule"))
    navigation = {r.i for r in out.collect() if r.rule == "navigation"}
    assert navigation == {i for i, w in enumerate(words) if re.fullmatch("([|>\u00bb\u203a\u2022\u00b7/]|::|--)[\x85\u2028\u2029]?", w)}
    text = spark.createDataFrame([("a\u00e9 \t|\n\n \U0001f600b ",), ("",), (None,)], "text string").select(quality_lines.base_measures(F.col("text")).alias("b"))
    assert [r.b.word_chars for r in text.collect()] == [5, 0, 0]
    assert "::|--" not in out._jdf.queryExecution().executedPlan().toString()


def test_rows_that_share_an_id_are_documents_of_their_own(spark):
    near, far, other = prose(31, 60), prose(32, 60), prose(33, 60)
    schema = "doc_id long, text string"
    runs = [(1, f"{near}\n{other}"), (2, f"{near}\n{far}"), (2, f"{other}\n{far}\n{far}"), (2, "short"), (2, None), (None, far), (None, far)]
    out = sorted((r.doc_id or 9, r.text or "", r.n_deleted) for r in line_dedup.report(spark.createDataFrame(runs, schema)).collect())
    assert len(out) == len(runs) and "\n".join(t for _, t, _ in out).split("\n").count(far) == 1
    assert (1, f"{near}\n{other}", 0) in out and (2, "short", 0) in out and (2, "", 0) in out
    rows = [(5, near), (7, near), (5, far), (3, far), (8, other), (8, other), (None, other), (None, LONG), (None, LONG)]
    left = sorted((r.doc_id or 9, r.text) for r in simhash.first_of_each(spark.createDataFrame(rows, schema)).collect())
    assert left == [(3, far), (5, near), (8, other), (9, LONG)]
    docs = spark.createDataFrame([(1, "a b"), (1, "a b c d"), (1, "a b"), (2, "x")], schema)
    path = token_files.write_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))
    got = token_files.read_ids(token_files.find_keys(docs.select("doc_id").distinct(), path), path).collect()
    assert sorted(r.doc_id for r in got) == [1, 1, 1, 2] and len({r.start for r in got}) == 4
    assert len({r.ids_crc32 for r in got if r.doc_id == 1}) == 2


def test_surrogates_keep_kind_form_and_identity(spark, nothing):
    card = "4539578763621486"
    text = f"Mrs. Anna Smith and Mr. Smith, a.b@mail1.example.com or A.B@MAIL1.EXAMPLE.COM, {card}, +1 (988) 555-2485, 44.161.181.40. 1234567890123456 stays."
    rows = [(1, text), (2, text), (3, "nothing here."), (4, None), (5, "")] + [(10 + k, f"x{k}@mail1.example.com 10.0.0.{k}") for k in range(200)]
    out = {r.doc_id: r for r in pii.anonymized(spark.createDataFrame(rows, "doc_id long, text string"), b"k").select("row.doc_id", "text", "n_entities").collect()}
    new = out[1].text
    assert new == out[2].text and out[3].text == "nothing here." and out[4].text is None and out[5].text == "" and len(out) == len(rows)
    for gone in ("Anna", "Smith", "a.b@", "A.B@", card, "988", "44.161.181.40"):
        assert gone not in new
    assert "1234567890123456 stays" in new
    found = re.findall(r"[\w.]+@[\w.]+", new)
    assert found[0].upper() == found[1].rstrip(",") and re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}", new)
    names = re.match(r"Mrs\. (\w+) (\w+) and Mr\. (\w+),", new)
    assert names and names[2] == names[3] and names[1].endswith(("a", "ette"))
    digits = re.search(r"\b(\d{16}), \+1", new)[1]
    assert digits[0] == "4" and pii._luhn(digits) == 0
    mails = {out[10 + k].text.split()[0] for k in range(200)}
    assert len(mails) == 200 and len({out[10 + k].text.split()[1] for k in range(200)}) == 200
    assert not pii.anonymized(nothing, b"k").count()


def test_a_name_once_titled_is_replaced_wherever_its_text_has_it(spark):
    text = "Mrs. Anna Smith wrote. Later Smith and Anna Smith came, and ANNA'S friend; a blacksmith, an anna. Mr. Smith's dog."
    rows = [
        (1, text), (2, "Anna and Smith, whom no title names."), (3, "MRS. KATE BROWN met señora Ana."),
        (4, "I miss Paris for 5 ms Only."), (8, "MR. LEE SAID THE DOG IS THE DOG. The Dog of Lee"), (5, "Bearer abcDEF0123456789xyz. Born on 1980-05-12, at 12 Green Hill Road."),
        (6, "dob: 3/11/1975"), (7, " ".join(f"Mr. Q{chr(97 + k % 26)}x{chr(97 + k // 26)}" for k in range(600)) + " Qaxa" * 5000),
    ]
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, row string, place long")
    out = {r.doc_id: (r.text, r.n_entities) for r in pii.anonymized(frame, b"k").select("row.doc_id", "text", "n_entities").collect()}
    m = re.fullmatch(r"Mrs\. (\w+) (\w+) wrote\. Later (\w+) and (\w+) (\w+) came, and (\w+)'S friend; a blacksmith, an anna\. Mr\. (\w+)'s dog\.", out[1][0])
    assert m and m[2] == m[3] == m[5] == m[7] != "Smith" and m[1] == m[4] != "Anna"
    assert out[2] == (rows[1][1], 0) and out[4] == (rows[3][1], 0)
    new = out[3][0].split()
    assert "KATE" not in new and "Ana." not in new and new[1].isupper() and new[2].isupper()
    secret, date, address = re.fullmatch(r"Bearer (\S+) Born on (\d{4}-\d\d-\d\d), at (\d\d [A-Z]\w+ [A-Z]\w+) Road\.", out[5][0]).groups()
    assert "abcDEF" not in secret and date != "1980-05-12" and int(date[5:7]) <= 12 and address != "12 Green Hill"
    assert re.fullmatch(r"dob: \d/\d\d/\d{4}", out[6][0]) and out[6][0] != "dob: 3/11/1975"
    assert out[8][1] == 2 and out[8][0].endswith(out[8][0].split()[1].capitalize()) and "SAID THE DOG IS THE DOG. The Dog of" in out[8][0]
    assert out[7][1] == 5600 and "Qaxa" not in out[7][0] and len(set(out[7][0].split()[1:1200:2])) == 600


def test_surrogates_agree_with_brute_force_over_the_corpus(spark):
    """Equal entities have one surrogate everywhere, different ones different ones, and what lies between stays."""
    rng = np.random.default_rng(9)
    people = [f"{a}{b}" for a in ("Ar", "Be", "Co", "Du", "Em") for b in ("ra", "so", "ti", "vo")]
    rows = []
    for k in range(120):
        name, other = rng.choice(people, 2)
        rows.append((k, f"x{k} Mr. {name} sent {name.lower()}@{other.lower()}.org, then {name} left 10.0.{k % 7}.{k % 11}."))
    out = {r.doc_id: r.text for r in pii.anonymized(spark.createDataFrame(rows, "doc_id long, text string"), b"k").select("row.doc_id", "text").collect()}
    form = re.compile(r"x(\d+) Mr\. (\S+) sent (\S+@\S+), then (\S+) left (\S+)\.")
    to, back = {}, {}
    for k, text in rows:
        was, now = form.fullmatch(text).groups(), form.fullmatch(out[k]).groups()
        assert was[0] == now[0] and now[1] == now[3]
        for kind, a, b in zip("nmxi", was[1:], now[1:], strict=True):
            kind = "n" if kind == "x" else kind
            assert to.setdefault((kind, a), b) == b and back.setdefault((kind, b), a) == a
    both = set(to) & set(back)  # no surrogate is itself an entity
    assert not both


def test_surrogates_of_what_draws_cannot_change_or_separate(spark):
    odd = ["********", "βγδεζ", "密码密码", "((((((((", "----"]
    rows = [(k, f"password: {x}") for k, x in enumerate(odd)] + [(10, "token = 0000 ")]
    out = {r.doc_id: r.text for r in pii.anonymized(spark.createDataFrame(rows, "doc_id long, text string"), b"k").select("row.doc_id", "text").collect()}
    assert len(out) == 6 and not [x for k, x in enumerate(odd) if x in out[k]]
    narrow = [("secret", f"{k:04d}") for k in range(6000)] + [("ip", ".".join(f"{k:04d}")) for k in range(6000)]
    made = pii.surrogates(spark.createDataFrame(narrow, "kind string, entity string"), b"k").collect()
    assert len(made) == len(narrow) and len({(r.kind, r.surrogate) for r in made}) == len(narrow)
    assert not {(r.kind, r.surrogate) for r in made} & set(narrow)


@pytest.mark.parametrize(("kind", "entities"), [
    ("email", ["a@b.com", "cd@ef.org"]), ("secret", ["****", "1234"]), ("key", ["A" * 16]), ("hex", ["a1" * 16, "a1" * 20]), ("iban", ["GB29NWBK60161331926819", "NO9386011117947X"]),
    ("ip", ["1.2.3.4"]), ("card", ["4539578763621486", "4222222222222"]), ("ssn", ["123456789"]), ("phone", ["5552485", "19885552485"]), ("name-first-f-cyrillic", ["анна"]), ("name-last-greek", ["α"]),
])
def test_numbered_surrogates_are_all_different(kind, entities):
    numbers = [*range(2000), 10**9, 10**9 + 1, 10**14, 10**14 + 1]
    made = [pii.numbered(kind, entities[n % len(entities)], b"k", n) for n in numbers]
    assert len(set(made)) == len(numbers)
    assert kind != "card" or not [x for x in made[:2000] if pii._luhn(x)]
    assert kind not in ("card", "ssn", "phone") or re.sub(r"\D", "", pii.rendered(kind, "555-2485", made[0])) == made[0]


def test_pipeline_stages_keep_columns(spark, tmp_path):
    import corpus_pipeline

    words = prose(4, 120)
    rows = [(k, prose(k, 90) + ".", "en", "s", 1) for k in range(30)] + [(40, prose(3, 90) + ".", "en", "s", 1), (41, prose(50, 30) + ". " + words + ".", "en", "s", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, " ".join(words.split()[5:40]))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    kept = {r.doc_id for r in docs.collect()}
    assert 40 not in kept and 41 not in kept and {k for k in range(30)} - {4} <= kept
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == kept
