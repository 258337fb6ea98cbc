"""Small cases of every operator of the subpackage against plain brute force."""

import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from freshet.llm import (
    backoff_model,
    components,
    decision_lists,
    epsilon_grid,
    html_blocks,
    licences,
    minhash_forest,
    mixing,
    packing,
    toxicity,
    url_filters,
)

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, first=0):
    return spark.createDataFrame([(first + k, t, "en", f"src{k % 3}", None) for k, t in enumerate(texts)], DOC)


def prose(n, seed=0):
    draw = np.random.default_rng(seed)
    return " ".join(f"w{k}" for k in draw.integers(0, 5000, n))


# ---- page text

PAGE = (
    "<html><head><title>T</title><script>var a='</p>';</script></head><body><nav><a href='/'>Home</a></nav><div class='ad'>Buy the best of it now</div>"
    "<article><h1>Short head</h1><p>The  quick &amp; brown fox is in the house and it was for the dogs that they have seen at noon.<br>More<p>Ends &lt;here&gt;."
    "<div class='comments'>I like the article and it is the best that I have read in a long time, so thanks for that.</div></article><footer>&copy; us</footer>"
)


def test_main_text_keeps_the_article_alone():
    assert html_blocks.main_text(PAGE).split("\n") == [
        "Short head",
        "The quick & brown fox is in the house and it was for the dogs that they have seen at noon. More",
        "Ends <here>.",
    ]


LONG = "The fox is in the house and it was for the dogs that they have seen at noon, as it is on all of the days."
POLISH = "Wczoraj wieczorem mieszkańcy dzielnicy zauważyli lisa, który spacerował spokojnie między domami przez kilka godzin."
ADVERT = "<div class='advert'>Buy now</div>"


@pytest.mark.parametrize(
    ("page", "kept"),
    [
        (f"<article><h1>Title</h1><div class='share'>Share it</div><p>{LONG}</article>", ["Title", LONG]),
        (f"<article><p>One.</p>{ADVERT}<p>Two.</p><p><a href='/'>Read on</a></p><p>Three.</article>", ["One.", "Two.", "Three."]),
        (f"<article><h1>Lis</h1>{ADVERT}<p>{POLISH}</article>", ["Lis", POLISH]),
        (f"<body>{ADVERT}<div><h1>Lis</h1><p>{POLISH}</p></div><nav>Menu</nav></body>", ["Lis", POLISH]),
        (f"<html class='has-social'><body class='sidebar-right'><main id='main-widget'><article class='post comments'><p>{LONG}</article></main>", [LONG]),
        (f"<article><h1>Title</h1><svg class='i'/><iframe src='/x' /><p>{LONG}</article>", ["Title", LONG]),
    ],
)
def test_main_text_of_ordinary_pages_is_whole(page, kept):
    assert html_blocks.main_text(page).split("\n") == kept


@pytest.mark.parametrize("page", [None, "", "<", "<!-- x", "<p", "</p></p>", "<script>never closed"])
def test_main_text_of_broken_pages_is_empty_or_text(page):
    assert isinstance(html_blocks.main_text(page), str)


def test_extract_counts_code_points_and_keeps_rows(spark):
    pages = spark.createDataFrame([(1, PAGE, "old"), (1, PAGE, "old"), (2, None, None)], "page_id long, html string, text string")
    got = html_blocks.extract(pages).select("page_id", "text", "n_chars").collect()
    assert [r.n_chars for r in got] == [len(html_blocks.main_text(PAGE))] * 2 + [0]
    assert html_blocks.extract(pages.limit(0)).count() == 0


# ---- packing


def test_pieces_round_trip_and_places_have_no_gaps(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    texts = [None, "", "It's A.B's  <|endoftext|> naïve—Σίσυφος 12,5!!", prose(3000), prose(40), prose(40), "x"]
    rows = packing.pack(docs_of(spark, texts)).collect()
    for doc_id, text in enumerate(texts):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        mine = sorted((r for r in rows if r.doc_id == doc_id), key=lambda r: r.piece)
        assert [r.start for r in mine] == list(range(0, len(ids), 2048))
        assert [r.ids_crc32 for r in mine] == [zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in mine]
        assert sum(r.length for r in mine) == len(ids)
    for _, found in itertools.groupby(sorted(rows, key=lambda r: (r.sequence_id, r.offset)), key=lambda r: r.sequence_id):
        at = 0
        for r in found:
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert packing.pack(docs_of(spark, ["x"]).limit(0)).count() == 0


def test_best_two_fit_packs_all_and_replaces_the_smallest():
    assert ([6, 2, 2], 1) in [(sorted(b, reverse=True), n) for b, n in packing.best_two_fit({6: 1, 3: 1, 2: 2}, 10)]
    draw = np.random.default_rng(3)
    counts = Counter(draw.integers(1, 101, 4000).tolist())
    bins = packing.best_two_fit(counts, 100)
    packed = Counter()
    for lengths, times in bins:
        assert sum(lengths) <= 100
        for n in lengths:
            packed[n] += times
    assert packed == counts
    assert sum(n for _, n in bins) <= 1.02 * math.ceil(sum(k * v for k, v in counts.items()) / 100)


# ---- near vectors


def test_near_vectors_equal_brute_force(spark):
    draw = np.random.default_rng(1)
    base = draw.normal(size=(60, 8))
    near = np.concatenate([base, base[:20] + draw.normal(scale=0.15, size=(20, 8)), np.repeat(base[:1], 5, axis=0), 3 * base[1:2]])
    rows = [(k, v.astype(np.float32).tolist()) for k, v in enumerate(near)]
    odd = [(1000, None), (1001, [0.0] * 8), (1002, [float("nan")] * 8), (1003, [None] * 8), (1004, [])]
    got = {r.vec_id: r for r in epsilon_grid.near_vectors(spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>"), block=16).collect()}
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hit = x @ x.T >= 0.9
    np.fill_diagonal(hit, False)
    least = np.arange(len(x))
    for _ in range(len(x)):
        least = np.array([min([least[k], *least[hit[k]]]) for k in range(len(x))])
    assert [(got[k].n_links, got[k].component_id) for k in range(len(x))] == list(zip(hit.sum(axis=1).tolist(), least.tolist(), strict=True))
    assert all(got[k].n_links == 0 and got[k].kept for k, _ in odd)


# ---- licences


def test_base_places_and_labels(spark):
    texts = [None, "", "Mit License, MIT LICENSE mit", "cc by cc by", "This work is licensed under CC BY-NC 4.0.", "gnu general-public license", "nothing é"]
    got = {r.doc_id: r for r in licences.scan(docs_of(spark, texts)).collect()}
    for k, text in enumerate(texts):
        words = re.findall(licences.WORD, (text or "").lower())
        places = [(i, label) for p, label in licences.PHRASES for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        at = [i for i, _ in places]
        want = (len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({n for _, n in places})))
        assert (got[k].n_words, got[k].n_base, got[k].first_word, got[k].last_word, got[k].base_labels) == want
    assert got[4].labels == "cc-by,cc-by-nc" and got[4].score == 1.0 and got[0].score == 0.0


# ---- urls


def test_rules_and_lists(spark):
    urls = [None, "no", "http://A.example.ORG/en/17?x", "http://example.org/en/2", "x://b.com/de/", "x://b.com#/de/", "http://www.cheap-pills.example.com/a", "http://"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    listed = spark.createDataFrame([("www.cheap-pills.example.com",)], "key string")
    got = [(r.host, r.path, r.rule, r.verdict) for r in url_filters.judge(pages, url_filters.RULES, listed).orderBy("page_id").collect()]
    assert got == [
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("a.example.org", "/en/17", "example.org/en/1", "block"),
        ("example.org", "/en/2", "org/", "allow"),
        ("b.com", "/de/", "com/de/", "block"),
        ("b.com", "", None, "allow"),
        ("www.cheap-pills.example.com", "/a", None, "block"),
        ("", "", None, "allow"),
    ]


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.where("cast(substring(key, 2, 9) AS int) % 7 = 0")
    levels = url_filters.cascade(universe, listed)
    found = universe.withColumn("keys", F.array("key")).select("key", url_filters.member(levels, "keys").alias("hit"))
    assert all(bool(len(r.hit)) == (int(r.key[1:]) % 7 == 0) for r in found.collect())


# ---- quality


def test_statistics_by_hand():
    text = "a b c d e\na b c d e\n\n \n$x a b\va"
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    got = dict(zip(decision_lists._COUNTS, decision_lists.statistics(text), strict=True))
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {i + j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(5)}
    assert (got["n_words"], got["word_chars"], got["n_symbols"], got["n_dup_lines"], got["n_repeat_words"]) == (len(words), sum(map(len, words)), 1, 1, len(inside))
    assert decision_lists.statistics(None) == (0,) * len(decision_lists._COUNTS)


def test_rules_reject_what_labels_say(spark):
    good = [prose(60, k) for k in range(120)]
    bad = [" ".join(w + "$$$" for w in prose(60, 500 + k).split()) for k in range(60)]
    docs = docs_of(spark, [*good, *bad, None, "short"])
    labels = spark.createDataFrame([(k, int(k < 120), 0) for k in range(180)], "doc_id long, quality int, toxic int")
    kept = {r.doc_id for r in decision_lists.judge(docs, labels).where("kept").collect()}
    assert kept == set(range(120))
    assert decision_lists.judge(docs, labels.limit(0)).where("kept").count() == 180
    assert decision_lists.judge(docs.limit(0), labels).count() == 0


# ---- near duplicates


def test_near_duplicates_equal_brute_force(spark):
    draw = np.random.default_rng(9)
    texts = []
    for k in range(12):
        words = prose(120, k).split()
        texts.append(" ".join(words))
        for cuts in (1, 2, 3, 4):
            again = list(words)
            for at in draw.integers(0, 120, cuts):
                again[at] = "Changed"
            texts.append(" ".join(again))
    texts += ["a b", "A  b", "a b c", "", None, texts[0].upper()]
    got = {r.doc_id: r for r in minhash_forest.near_duplicates(docs_of(spark, texts)).collect()}
    sets = []
    for text in texts:
        words = minhash_forest.words_of(text)
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    least = list(range(len(texts)))
    pairs = [(a, b) for a, b in itertools.combinations(range(len(texts)), 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    for _ in texts:
        for a, b in pairs:
            least[a] = least[b] = min(least[a], least[b])
    assert [(got[k].n_shingles, got[k].component_id) for k in range(len(texts))] == [(len(s), c) for s, c in zip(sets, least, strict=True)]
    assert minhash_forest.near_duplicates(docs_of(spark, ["x"]).limit(0)).count() == 0


def test_texts_that_share_an_id_are_compared_each(spark):
    part = " ".join("qrstuvwx")
    rows = [(1, " ".join("abcdefgh")), (1, part), (3, part), (4, part + " y"), (2**53 + 1, part + " y"), (None, part), (9, None)]
    docs = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, row string")
    got = sorted(map(tuple, minhash_forest.near_duplicates(docs).collect()), key=repr)
    assert got == sorted([(1, 4, 1, True), (1, 4, 1, True), (3, 4, 1, False), (4, 5, 1, False), (2**53 + 1, 5, 1, False), (None, 4, None, True), (9, 0, 9, True)], key=repr)


def brute_components(texts):
    sets = [set(zip(*(minhash_forest.words_of(text)[k:] for k in range(5)), strict=False)) for text in texts]
    least = list(range(len(texts)))
    pairs = [(a, b) for a, b in itertools.combinations(range(len(texts)), 2) if 7 * len(sets[a] & sets[b]) >= 3 * (len(sets[a]) + len(sets[b]))]
    for _ in pairs:
        for a, b in pairs:
            least[a] = least[b] = min(least[a], least[b])
    return pairs, least


def test_pairs_in_a_crowd_below_the_threshold_are_found(spark):
    draw, passage = np.random.default_rng(5), prose(148, 1)
    tails = [prose(28, 100 + k).split() for k in range(900)]
    order = draw.permutation(900)
    for a, b in zip(order[:40:2], order[1:40:2], strict=True):  # 0.72 with all others, 0.76 with each other
        tails[b][:5] = tails[a][:5]
    texts = [" ".join([passage, *tail]) for tail in tails]
    pairs, least = brute_components(texts)
    assert len(pairs) == 20
    got = {r.doc_id: r.component_id for r in minhash_forest.near_duplicates(docs_of(spark, texts)).collect()}
    assert [got[k] for k in range(len(texts))] == least


def test_crowd_pairs_of_texts_that_are_dense_passages(spark):
    draw = np.random.default_rng(6)
    pool = [prose(60, k) for k in range(24)]
    picks = [draw.permutation(24)[:16] for _ in range(120)]
    for k in range(0, 40, 2):  # all but one passage in common, in another order
        spare = np.setdiff1d(np.arange(24), picks[k])[0]
        picks[k + 1] = draw.permutation(np.append(picks[k][1:], spare))
    picks += [picks[50], picks[50][::-1], picks[51], draw.permutation(picks[51])]
    texts = [" ".join(pool[p] for p in pick) + " " + prose(k % 20, 500 + k) for k, pick in enumerate(picks)]
    pairs, least = brute_components(texts)
    assert len(pairs) >= 20
    seen = minhash_forest.stored(docs_of(spark, texts).select("doc_id", "text").mapInArrow(minhash_forest._sketch, minhash_forest._SEEN), "seen")
    alone = spark.createDataFrame([], "node long, component_id long")
    proposed = minhash_forest.crowd_pairs(seen, seen.select("row"), alone)
    links = minhash_forest.confirmed(proposed, seen).toDF("u", "v")
    own = {r.row: r.doc_id for r in seen.select("row", "doc_id").collect()}
    got = {own[r.node]: own[r.component_id] for r in components.components(links).collect()}
    assert [got.get(k, k) for k in range(len(texts))] == least


def test_rows_of_a_crowd_that_cannot_link_are_not_paired(spark):
    passage, shared = prose(120, 1), [prose(20, 50 + k) for k in range(10)]
    texts = [" ".join([passage, shared[k % 10], prose(30, 100 + k)]) for k in range(200)]
    texts += [texts[7] + " " + prose(12, 900 + k) for k in range(10)]  # copies of one of them
    pairs, least = brute_components(texts)
    seen = minhash_forest.stored(docs_of(spark, texts).select("doc_id", "text").mapInArrow(minhash_forest._sketch, minhash_forest._SEEN), "seen")
    own = {r.row: r.doc_id for r in seen.select("row", "doc_id").collect()}
    made = minhash_forest.crowd_pairs(seen, seen.select("row"), spark.createDataFrame([], "node long, component_id long")).collect()
    assert set(pairs) <= {tuple(sorted((own[a], own[b]))) for a, b in made}
    assert len(made) < len(pairs) + 200  # 2,000 share a shingle of a section
    links = minhash_forest.stored(spark.createDataFrame([], "a long, b long"), "links")
    parts = minhash_forest.crowd_links(seen, seen.select("row"), minhash_forest.components(links.toDF("u", "v")), links)
    got = {own[r.node]: own[r.component_id] for r in parts.collect()}
    assert [got.get(k, k) for k in range(len(texts))] == least


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (5, 5)], "u long, v long")
    got = {r.node: r.component_id for r in components.components(edges).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}


# ---- language model


def test_scores_equal_brute_force_and_states_sum_to_one(spark):
    texts = ["a b a", "A b c", "", None, "d d", "a b c d"] * 4
    got = {r.doc_id: r for r in backoff_model.scored(docs_of(spark, texts)).collect()}
    single, pair, starts = Counter(), Counter(), 0
    token_rows = [[*minhash_forest.words_of(t), "</s>"] for t in texts]
    for k, tokens in enumerate(token_rows):
        if zlib.crc32(str(k).encode()) % 10:
            starts += 1
            single.update(tokens)
            pair.update(zip(["<s>", *tokens], tokens, strict=False))
    total = sum(single.values())
    plain = lambda w: (single[w] + 0.1) / (total + 0.1 * (len(single) + 1))
    for k, tokens in enumerate(token_rows):
        score = 0.0
        for u, w in zip(["<s>", *tokens], tokens, strict=False):
            n = starts if u == "<s>" else single[u]
            score += math.log10(0.4 * pair[u, w] / n + 0.6 * plain(w) if n else plain(w))
        assert got[k].score == pytest.approx(score) and got[k].train_tokens == total and got[k].n_tokens == len(tokens)
        assert got[k].base_score == pytest.approx(sum(math.log10(plain(w)) for w in tokens))
        assert got[k].n_known == sum(single[w] > 0 for w in tokens)
    assert backoff_model.scored(docs_of(spark, ["x"]).limit(0)).count() == 0


def test_no_gram_of_the_language_model_is_stored_as_a_row(spark, monkeypatch):
    tables = []

    def noted(df, name):
        tables.append(minhash_forest.stored(df, name))
        return tables[-1]

    monkeypatch.setattr(backoff_model, "stored", noted)
    docs = docs_of(spark, [prose(400, k) for k in range(100)]).repartition(3, "doc_id")
    assert backoff_model.scored(docs).count() == 100
    assert sum(made.count() for made in tables) < 500  # there are 40,000 different pairs


def test_packed_numbers_come_back():
    for values in ([], [0], [1, 2**64 - 1, 300, 0]):
        assert backoff_model._unpacked(backoff_model._packed(np.array(values, dtype=np.uint64))).tolist() == values


# ---- mixing


def test_budgets_stay_among_siblings(spark):
    leaves = spark.createDataFrame([("a", "x", "s1", 10), ("a", "x", "s2", 100), ("b", "x", "s3", 100), (None, "y", None, 90)], "domain string, lang string, source string, tokens long")
    got = {(r.domain, r.source): r.budget for r in mixing.leaf_budgets(leaves, 0.5, 1, {}).collect()}
    assert got[("a", "s1")] == 10 and got[("a", "s2")] == pytest.approx(40) and got[("b", "s3")] == pytest.approx(50)
    assert sum(got.values()) == pytest.approx(150)


def test_leaf_prefix_crosses_its_budget_by_one_document(spark):
    docs = docs_of(spark, [prose(10 + k % 7, k) for k in range(300)])
    few = mixing.mix(docs, 0.5, 1, per_chunk=20)
    again = mixing.mix(docs, 0.5, 1, per_chunk=100_000)
    assert sorted(r.doc_id for r in few.collect()) == sorted(r.doc_id for r in again.collect())
    total = docs.select(F.sum(mixing.token_count())).first()[0]
    used = few.agg(F.sum("n_tokens")).first()[0]
    assert total / 2 <= used <= total / 2 + 3 * 17
    assert mixing.mix(docs.limit(0)).count() == 0


# ---- toxicity


def test_toxic_words_are_learned_and_held_out_rows_judged(spark):
    texts = [prose(40, k) + (" rotten" if k % 4 == 0 else "") for k in range(240)] + [None, ""]
    docs = docs_of(spark, texts)
    labels = spark.createDataFrame([(k, 1, int(k % 4 == 0)) for k in range(240)], "doc_id long, quality int, toxic int")
    got = toxicity.scored(docs, toxicity.train(docs, labels)).collect()
    assert all((r.score >= 0.7) == (r.doc_id % 4 == 0) for r in got if r.doc_id < 240)
    assert all(0 <= r.score < 0.7 for r in got if r.doc_id >= 240)
    none = toxicity.scored(docs, toxicity.train(docs, labels.limit(0))).collect()
    assert all(r.score < 0.7 for r in none)


def test_words_of_any_letters_have_the_tokenizers_ids():
    import random

    import pyarrow as pa
    import public_tokenizers

    encoder = packing.WordEncoder(public_tokenizers.path(packing.TOKENIZER), remembered=3000)
    draw, letters = random.Random(1), "abzZ İıiIŞßéÉ'’.,!-()|12\t\n\x0b\x0c\x1c\x85\xa0Σςσ́̇日本"
    texts = ["".join(draw.choice(letters) for _ in range(draw.randrange(14))) for _ in range(8000)]
    texts += ["ALİ.", "Lİ, b", "It's", "we'LL", "a|b", "|", None, "x " * 3000]
    for first in range(0, len(texts), 1500):
        some = texts[first : first + 1500]
        ids, borders = encoder.batch(pa.array(some))
        for k, text in enumerate(some):
            assert ids[borders[k] : borders[k + 1]].tolist() == encoder.tokenizer.encode(text or "", add_special_tokens=False).ids, text


def test_packing_keeps_large_and_null_ids(spark):
    docs = spark.createDataFrame([(2**53 + 1, "a b", 1), (None, "c", 2), (None, "c", 2), (2**53 + 1, None, 3)], "doc_id long, text string, rank int")
    got = packing.pack(docs).collect()
    assert sorted((r.doc_id or 0, r.length) for r in got) == [(0, 2), (0, 2), (2**53 + 1, 1), (2**53 + 1, 3)]


@pytest.mark.parametrize("ids", [range(1000), [None] * 1000, [7] * 1000])
def test_budgets_hold_where_ids_repeat_or_are_missing(spark, ids):
    text = "one two three four five six seven eight nine ten"
    same = spark.createDataFrame([(k, text, "en", "s", None) for k in ids], DOC)
    for per_chunk in (50, 100_000):
        got = mixing.mix(same, 0.3, 1, per_chunk=per_chunk)
        assert got.agg(F.sum("n_tokens")).first()[0] == 3000
    own = spark.createDataFrame([(i, f"{text} {k}", "en", "s", None) for k, i in enumerate(ids)], DOC)
    got = mixing.mix(own, 0.3, 1)
    assert 3300 <= got.agg(F.sum("n_tokens")).first()[0] < 3300 + 11
    twice = mixing.mix(same, 1.5, 2)
    assert twice.agg(F.sum("n_tokens")).first()[0] == 15000 and set(r.epoch for r in twice.select("epoch").distinct().collect()) == {0, 1}
