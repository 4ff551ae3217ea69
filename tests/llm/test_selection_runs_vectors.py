"""Importance resampling, periodic runs and near vectors against brute force."""

import random
import tracemalloc
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from carelake.llm import mixing, ngram_jaccard, target_resampling, vector_near
from carelake.llm.periodic_runs import find_runs, least_shared, periodic_runs, planted
from carelake.llm.target_resampling import KEY, cutoff_key, ranked, resample, weighted_median
from carelake.llm.wordhash import mixed
from carelake.llm.vector_near import Side, close_pairs, near_vectors, quantised
from tests.llm import brute
from tests.llm.test_llm import frame, prose, rows

# --- periodic runs


@pytest.mark.parametrize("exponent,length", [(4, 6), (2, 2), (3, 10)])
def test_find_runs(exponent, length):
    rng = random.Random(5)
    for _ in range(400):
        words = [rng.choice("ab" if rng.random() < 0.5 else "abc") for _ in range(rng.randrange(0, 14))]
        words = words[: rng.randrange(1, 5)] * rng.randrange(1, 9) + words + list("xy") * rng.randrange(4) + words * rng.randrange(3)
        assert find_runs(words, length, exponent) == brute.periodic_runs(words, length, exponent)


def test_find_runs_nested_and_long():
    words = (["a"] * 7 + ["b"]) * 5
    assert find_runs(words) == brute.periodic_runs(words) and len(find_runs(words)) == 6
    assert find_runs(["w"] * 30_000) == [(0, 30_000, 1)]
    assert find_runs([str(i % 700) for i in range(20_000)]) == [(0, 20_000, 700)]
    assert least_shared(6, 4) == 5


def test_periodic_runs(spark, texts):
    loud = ["go " * 9 + "stop", "a b\t" * 4 + "a", "x", "Ä ö\n" * 700, " ".join(["a b a b a b a b c"] * 5)]
    docs = list(enumerate([*texts, *loud]))
    got = periodic_runs(frame(spark, [t for _, t in docs])).collect()
    for row, (i, text) in zip(sorted(got, key=lambda r: r.doc_id), docs):
        words = brute.WORD.findall(text or "")
        runs = brute.periodic_runs(words) if len(words) < 2500 else [tuple(r) for r in row.runs]
        assert (row.doc_id, row.n_words, [tuple(r) for r in row.runs]) == (i, len(words), runs)
        assert row.collapsed == brute.without_repeats(words, runs)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        assert (row.strongest and tuple(row.strongest)) == best


def test_periodic_runs_ids_and_empty_table(spark):
    text = "a " * 6
    got = rows(periodic_runs(frame(spark, [text, text, None, text], [None, 3, 3, 3])), "doc_id", "n_words", "collapsed")
    assert got == [(3, 0, ""), (3, 6, "a"), (3, 6, "a"), (None, 6, "a")]
    assert periodic_runs(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        periodic_runs(frame(spark, []), min_exponent=1)


def test_planted(spark):
    import zlib

    rng = random.Random(1)
    docs = [(i, " ".join(prose(rng, rng.randrange(1, 60)))) for i in range(300)] + [(None, "a b"), (777, None)]
    ids, texts = zip(*docs)
    got = {r.doc_id: r.text for r in planted(frame(spark, list(texts), list(ids))).collect()}
    changed = 0
    for i, text in docs:
        words = (text or "").split()
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            text = " ".join(words[k if k < a else a + (k - a) % p] for k in range(n))
            changed += 1
        assert got[i] == text
    assert changed > 10


# --- importance resampling


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(9)
    out = [" ".join(prose(rng, rng.randrange(0, 60))) for _ in range(400)]
    return out + ["", None, "A-Z ÉTÉ été 漢字 w1 W1 \x00 w2", "x" * 5000, out[0].upper()]


def resampled(docs, target):
    return sorted(brute.resampled(docs, target), key=repr)


def test_resample(spark, texts, monkeypatch):
    monkeypatch.setattr(target_resampling, "SMALL", 3)
    target = texts[10:20] + [None, ""]
    got = resample(spark, frame(spark, texts).repartition(5), frame(spark, target))
    expected = resampled(list(enumerate(texts)), target)
    assert rows(got, "doc_id", "n_features", "weight", "score", "rank") == expected
    assert sum(r[4] is not None for r in expected) > 20


def test_resample_ids_ties_and_empty_tables(spark, texts):
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    docs = [(i if i % 7 else None, t) for i, t in enumerate(texts[:60])]
    ids, kept = zip(*docs)
    got = rows(resample(spark, frame(spark, list(kept), list(ids)), frame(spark, []), percent=100), *columns)
    expected = brute.resampled(docs, [], percent=100)
    assert [r[:4] for r in got] == sorted((r[:4] for r in expected), key=repr)
    assert sorted(r[4] for r in got if r[4]) == list(range(1, sum(r[1] >= 20 for r in expected) + 1))
    twice = resample(spark, frame(spark, [texts[5] + " a b c" * 20] * 30, [4] * 30), frame(spark, texts[:3]))
    assert sorted(r.rank for r in twice.collect() if r.rank) == [1, 2, 3]
    assert resample(spark, frame(spark, []), frame(spark, texts)).count() == 0


@pytest.mark.parametrize("hot", [False, True])
def test_cutoff_key_and_ranks(spark, monkeypatch, hot):
    monkeypatch.setattr(target_resampling, "SMALL", 5)
    rng = random.Random(2)
    keys = [(rng.randrange(3 if hot else 1000), 0, rng.randrange(9), rng.randrange(2)) for _ in range(1500)]
    df = spark.createDataFrame(keys, ", ".join(f"{c} long" for c in KEY)).repartition(7)
    for k in (1, 2, 700, 1499, 1500):
        assert cutoff_key(spark, df, k) == sorted(keys)[k - 1]
    assert cutoff_key(spark, df, 0) is None
    got = ranked(spark, df, KEY).orderBy("rank").collect()
    assert [tuple(r)[:4] for r in got] == sorted(keys) and [r["rank"] for r in got] == list(range(1, 1501))


def test_weighted_median():
    assert weighted_median([((1,), 5), ((9,), 1), ((4,), 1)]) == (1,)
    assert weighted_median([((3,), 1), ((1,), 1), ((2,), 1)]) == (2,)


# --- near vectors


def vectors(spark, found):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in found], "vec_id long, embedding array<float>, cls int, vector string")


def close_ones(seed, n, width):
    """Vectors in chains and clumps around the threshold, with copies and unusable ones."""
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(max(1, n // 8), width))
    out = [base[rng.integers(len(base))] + rng.normal(size=width) * rng.choice([0.0, 0.1, 0.32, 0.34, 0.5]) for _ in range(n)]
    out = [np.float32(v).tolist() for v in out]
    return out + [None, [], [0.0] * width, [float("nan")] * width, [1.0, None] * (width // 2), [float("inf")] * width, out[0]]


@pytest.mark.parametrize("tile", [4096, 40])
def test_near_vectors(spark, monkeypatch, tile):
    monkeypatch.setattr(vector_near, "TILE", tile)
    monkeypatch.setattr(vector_near, "TILES", 6)
    found = list(enumerate(close_ones(4, 300, 16)))
    random.Random(1).shuffle(found)
    got = near_vectors(spark, vectors(spark, found).repartition(3))
    expected = sorted(brute.near_vectors(found), key=repr)
    assert rows(got, "vec_id", "n_links", "component_id", "kept") == expected
    assert len({r[2] for r in expected}) < 250 and max(r[1] for r in expected) > 5


def test_near_vectors_ids_lengths_and_empty_table(spark):
    a, b = [3.0, 4.0], [4.0, -3.0]
    found = [(7, a), (None, a), (5, b), (5, a), (9, [*a, 0.0]), (None, b), (1, [1e30, 1e30]), (2, [1e-30, 1e-30]), (None, None)]
    got = rows(near_vectors(spark, vectors(spark, found)), "vec_id", "n_links", "component_id", "kept")
    expected = [(7, 5, 1, False), (None, 5, 1, False), (5, 1, 5, True), (5, 5, 1, False), (9, 5, 1, False)]
    expected += [(None, 1, 5, False), (1, 5, 1, True), (2, 5, 1, False), (None, 0, None, True)]
    assert got == sorted(expected, key=repr)
    assert near_vectors(spark, vectors(spark, [])).count() == 0


def test_error_bounds_hold():
    rng = np.random.default_rng(3)
    units = rng.normal(size=(300, 40)) * rng.choice([1, 30], size=(300, 40))
    units /= np.sqrt((units**2).sum(axis=1, keepdims=True))
    codes, scale, eps = quantised(units)
    side = Side([c.tobytes() for c in codes], scale, eps)
    exact = units @ units.T
    for threshold in (0.1, 0.3, 0.6):
        near = {(i, j) for i, j in zip(*np.nonzero(exact >= threshold)) if i < j}
        met, sure = set(), set()
        for i, j, surely in close_pairs(side, side, threshold, True):
            met |= set(zip(i.tolist(), j.tolist()))
            sure |= set(zip(i[surely].tolist(), j[surely].tolist()))
        assert near <= met and sure <= near and len(met) < 2 * len(near) + 50


# --- repeated ids and blocks of the n-gram Jaccard join


def test_ngram_jaccard_repeated_ids_keep_their_links(spark):
    rng = random.Random(12)
    base, other = prose(rng, 60), prose(rng, 60)
    near = [*base[:-1], "changed"]
    got = rows(ngram_jaccard.ngram_jaccard(spark, frame(spark, [" ".join(x) for x in (other, base, near, other)], [1, 1, 2, 9])), "doc_id", "component_id")
    assert got == [(1, 1), (1, 1), (2, 1), (9, 1)]


@pytest.mark.parametrize("shingles", [60, 400_000])
def test_ngram_jaccard_blocks_by_shingles(spark, monkeypatch, shingles):
    monkeypatch.setattr(ngram_jaccard, "BLOCK", 8)
    monkeypatch.setattr(ngram_jaccard, "BLOCK_SHINGLES", shingles)
    rng = random.Random(13)
    base = prose(rng, 120)
    docs = []
    for i in range(60):
        copy = base[:]
        for _ in range(rng.randrange(0, 6)):
            copy[rng.randrange(len(copy))] = f"e{rng.randrange(99)}"
        docs.append((i, " ".join(copy)))
    got = ngram_jaccard.ngram_jaccard(spark, frame(spark, [t for _, t in docs]))
    assert rows(got, "doc_id", "n_shingles", "component_id") == sorted(brute.ngram_components(docs), key=repr)


def test_numbers_are_no_letters(spark):
    from carelake.llm.language_id import LanguageModel

    docs = spark.createDataFrame([(i, "der die das und" if i % 2 else "the of and to", "de" if i % 2 else "en") for i in range(40)], "doc_id long, text string, lang string")
    model = LanguageModel.fit(docs)
    got = rows(model.predict(frame(spark, ["½² ①", "12 _", "the ½", None])), "doc_id", "lang_pred")
    assert [r[1] for r in got] == ["und", "und", "en", "und"]


# --- mixing where a cell cannot give what is asked


def test_mixing_against_plain_raking(spark):
    """Probabilities by a plain loop over dictionaries, cells kept within what they hold."""
    rng = random.Random(14)
    docs = [(i, "w " * rng.randrange(1, 40), rng.choice(["en"] * 20 + ["fr"]), rng.choice("ab"), 0.5) for i in range(600)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, probability double")
    want = {"source": {"a": 1, "b": 1}, "lang": {"en": 0.7, "fr": 0.3}}
    mix = mixing.Mix(want, budget=0.5)
    tokens = {}
    for _, text, lang, source, _ in docs:
        tokens[source, lang] = tokens.get((source, lang), 0) + len(text.split())
    total = sum(tokens.values())
    cells = {k: n * 0.5 for k, n in tokens.items()}
    for _ in range(3000):
        for axis, weights in enumerate(want.values()):
            for name, share in weights.items():
                mine = [k for k in cells if k[axis] == name]
                goal = total * 0.5 * share / sum(weights.values())
                factor = goal / sum(cells[k] for k in mine)
                cells.update({k: min(cells[k] * factor, tokens[k]) for k in mine})
    short = total * 0.5 - sum(cells.values())
    room = [k for k in cells if cells[k] < tokens[k] * (1 - 1e-9)]
    whole = sum(cells[k] for k in room)
    cells.update({k: cells[k] * (1 + short / whole) for k in room})
    got = {(r.mix_source, r.mix_lang): r.probability for r in mix.draw(mix.cells(df, "doc_id")).collect()}
    assert got == pytest.approx({k: cells[k] / tokens[k] for k in tokens}, rel=1e-4)
    assert got["a", "fr"] == 1.0 and got["a", "en"] < 1
    reached = {(d, c): (asked, share) for d, c, asked, share in mix.shares(df)}
    assert reached["source", "a"][1] == pytest.approx(0.5, abs=0.02) and reached["lang", "fr"][1] < reached["lang", "fr"][0]
    assert mix.sample(df).columns == df.columns


def test_mixing_meets_targets_that_a_full_cell_leaves_to_others():
    observed = np.array([[100.0, 400], [300, 200]])
    targets = [np.array([500.0, 500]), np.array([500.0, 500])]
    chance = mixing.calibrate(observed, mixing.rake(observed, targets), targets, 0.6)
    drawn = chance * observed
    assert np.allclose(drawn.sum(axis=0), 300) and np.allclose(drawn.sum(axis=1), 300) and chance.max() <= 1


def test_mixing_ids_and_clashing_names(spark):
    docs = frame(spark, ["a b", "a b", None, "c"], [None, 3, 3, None])
    drawn = mixing.Mix().draw(mixing.Mix().cells(docs, "doc_id")).collect()
    assert len(drawn) == 4 and len({r.kept for r in drawn if r.doc_id is None}) == 1


# --- bands of fingerprints


def test_band_plan_follows_the_number_of_fingerprints():
    from carelake.llm.edit_fingerprint import CHANCE, FOUND, band_plan

    digits = []
    for n in (1, 10**3, 10**6, 10**9):
        bands, d = band_plan(n)
        assert 1 - (1 - 0.8**d) ** bands >= FOUND and n * bands * CHANCE**d <= 2
        digits.append(d)
    assert digits == sorted(digits) and digits[-1] > digits[0]


def test_band_plan_leaves_chance_meetings_too_few_to_connect():
    from carelake.llm.edit_fingerprint import CHANCE, FOUND, band_plan

    for n in (10**4, 51_282, 256_410, 10**7):
        bands, d = band_plan(n)
        assert 1 - (1 - 0.8**d) ** bands >= FOUND and n * bands * CHANCE**d <= 0.25


def test_tiles_meet_every_pair_of_a_list(spark, monkeypatch):
    """Each pair of documents of one list is in a tile of their two buckets, with their components."""
    monkeypatch.setattr(ngram_jaccard, "BLOCK", 4)
    rng = random.Random(31)
    component = {d: d // 3 for d in range(60)}
    lists = {s: rng.sample(range(60), rng.randrange(2, 14)) for s in range(25)}
    given = [(s, d, 9, component[d]) for s, docs in lists.items() for d in docs]
    tiled = ngram_jaccard.tiles(spark, spark.createDataFrame(given, "shingle long, doc long, n int, component long")).collect()
    bucket = {r.doc: r.bucket for r in tiled}
    held = {(r.low, r.high, r.doc) for r in tiled}
    assert len(held) == len(tiled) and all(r.bucket == bucket[r.doc] and r.component == component[r.doc] for r in tiled)
    for docs in lists.values():
        for a in docs:
            for b in docs:
                low, high = sorted((bucket[a], bucket[b]))
                assert (low, high, a) in held and (low, high, b) in held


def join_rows(frame):
    """Rows that each join of the frame's own plan makes."""
    frame.collect()
    found, left = [], [frame._jdf.queryExecution().executedPlan()]
    while left:
        node = left.pop()
        kind = node.getClass().getSimpleName()
        if "Join" in kind:
            found.append(node.metrics().apply("numOutputRows").value())
        if kind == "AdaptiveSparkPlanExec":
            left.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            left.append(node.plan())
        left += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_tiles_join_makes_no_more_rows_than_the_lists(spark, monkeypatch):
    monkeypatch.setattr(ngram_jaccard, "BLOCK", 4)
    given = [(s, d, 9, d) for s in range(20) for d in range(60)]
    made = join_rows(ngram_jaccard.tiles(spark, spark.createDataFrame(given, "shingle long, doc long, n int, component long")))
    assert made and max(made) <= len(given), made


def test_linking_tiles_leave_out_what_cannot_link(spark):
    # Sets of 100 that link share at least 9 of their first shingles, of 100 and 80 at least one.
    given = [(2 * s, d, 100, d) for s in range(10) for d in (1, 2)] + [(100 + 2 * s, d, 100, d) for s in range(8) for d in (3, 4)]
    given += [(200, 5, 100, 5), (200, 6, 80, 6)]
    tiled = ngram_jaccard.linking_tiles(spark, spark.createDataFrame(given, "shingle long, doc long, n int, component long"))
    assert {r.doc for r in tiled.collect()} == {1, 2, 5, 6}


def test_leaders_of_all_bands_are_compared(spark):
    from carelake.llm.edit_fingerprint import leader_links

    rng = random.Random(5)
    near, other = ("".join(rng.choice("0123456789abcdef") for _ in range(200)) for _ in range(2))
    heads = spark.createDataFrame([(0, other), (1, near), (2, near[:-1] + "0")], "doc long, fingerprint string")
    lists = spark.createDataFrame([(s, d, 0, d) for s, d in ((1, 0), (1, 2), (2, 0), (2, 2), (3, 1), (3, 2))], "shingle long, doc long, n int, component long")
    assert {tuple(r) for r in leader_links(lists, heads, 0.8).collect()} == {(2, 1)}


def test_bands_of_one_document_are_left_out(spark):
    from carelake.llm.edit_fingerprint import band_keys, band_lists

    rng = random.Random(6)
    prints = ["".join(rng.choice("0123456789abcdef") for _ in range(200)) for _ in range(1000)]
    prints += [p[:-1] for p in prints[:20]]
    heads = spark.createDataFrame(list(enumerate(prints)), "doc long, fingerprint string")
    owners, keys = band_keys(prints, 20, 8, 0.8)
    found, counts = np.unique(keys, return_counts=True)
    shared = set(found[counts > 1].view(np.int64).tolist())
    wanted = {(int(k), int(o)) for o, k in zip(owners, keys.view(np.int64)) if int(k) in shared}
    got = {(r.shingle, r.doc) for r in band_lists(spark, heads, 20, 8, 0.8).collect()}
    assert wanted and wanted <= got and len(got - wanted) < 0.03 * len(keys), (len(wanted), len(got), len(keys))


def test_lists_lose_no_alike_pair_of_two_components(spark):
    from carelake.llm.edit_fingerprint import REACH, alike_rows, digit_rows, leader_distances, led_lists, near_lists

    rng = random.Random(8)
    base = "".join(rng.choice("0123456789abcdef") for _ in range(260))
    changed = lambda share: "".join(rng.choice("0123456789abcdef") if rng.random() < share else c for c in base)
    prints = [changed(rng.choice((0.02, 0.1, 0.13, 0.5, 0.8)))[: rng.choice((256, 258, 260))] for _ in range(80)]
    rows, n = digit_rows(prints)
    alike = {(i, k) for i in range(80) for k in range(i + 1, 80) if alike_rows(rows[i], n[i], rows[k : k + 1], n[k : k + 1], 0.8)[0]}
    held = {s: rng.sample(range(80), rng.randrange(1, 12)) for s in range(120)}
    given = [(s, d, 0, d, float(REACH[n[d]])) for s, docs in held.items() for d in docs]
    lists = spark.createDataFrame(given, "shingle long, doc long, n int, component long, reach double")
    heads = spark.createDataFrame(list(enumerate(prints)), "doc long, fingerprint string")
    of = {d: d // 2 * 2 for d in range(30)}  # components so far, of two documents each
    grouped = spark.createDataFrame(list(of.items()), "node long, component long")
    led = led_lists(lists)
    got = near_lists(led, leader_distances(led, heads, 0.8), grouped, 0.8).collect()
    left = defaultdict(set)
    for r in got:
        left[r.shingle].add(r.doc)
        assert r.component == of.get(r.doc, r.doc)
    together = lambda lists: {(a, b) for docs in lists for a in docs for b in docs if a < b and of.get(a, a) != of.get(b, b)}
    wanted = together(held.values()) & alike
    assert len(wanted) > 50 and wanted <= together(left.values())
    assert len(got) == sum(map(len, left.values())) < 0.9 * len(given), (len(got), len(given))


def test_copies_that_an_unlike_one_meets_are_not_searched_again(spark, monkeypatch):
    """All copies are near their leader and the unlike one is far from it, so no tile is needed."""
    from carelake.llm import edit_fingerprint
    from carelake.llm.edit_fingerprint import near_duplicates

    rng = random.Random(9)
    base = "".join(rng.choice("0123456789abcdef") for _ in range(260))
    copies = [base[: 250 - i] + "0" * 3 + base[253 - i :] for i in range(20)]
    unlike = "".join(c if rng.random() < 0.5 else "0" for c in base)
    sizes = defaultdict(list)
    kept = edit_fingerprint.stored

    def counted(spark, frame, label):
        out = kept(spark, frame, label)
        sizes[label].append(out.count())
        return out

    monkeypatch.setattr(edit_fingerprint, "stored", counted)
    prints = spark.createDataFrame(list(enumerate([base, *copies, unlike])), "doc_id long, fingerprint string")
    found = near_duplicates(spark, prints, bands=20, digits=2).collect()
    assert {tuple(r) for r in found} == {(i, 0) for i in range(1, 21)}
    assert sizes["bands"][0] > 0 and sizes["tiles"] == [0], dict(sizes)


# --- memory of a worker


def test_texts_reach_workers_in_bounded_batches(spark, tmp_path):
    from carelake.llm.common import BATCH_BYTES, BATCH_LIMIT, table

    given = spark.conf.get(BATCH_LIMIT)
    spark.range(3000).selectExpr("id as doc_id", "repeat('word ', 2000) as text").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows], "size": [batch.nbytes]})

    try:
        spark.conf.unset(BATCH_LIMIT)
        docs = table(spark, str(tmp_path), "documents")
        got = docs.mapInArrow(sizes, "n long, size long").collect()
        assert sum(r.n for r in got) == 3000 and max(r["size"] for r in got) < 1.5 * BATCH_BYTES
        spark.conf.set(BATCH_LIMIT, "1m")
        table(spark, str(tmp_path), "documents")
        assert spark.conf.get(BATCH_LIMIT) == "1m"
    finally:
        spark.conf.set(BATCH_LIMIT, given)


def test_hashing_many_texts_takes_bounded_memory():
    texts = [" ".join(prose(random.Random(i), 1000, 5000)).encode() for i in range(500)]
    tracemalloc.start()
    try:
        sets = ngram_jaccard.all_sets(texts)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(sets) == 500 and most < 60e6 < 25 * sum(map(len, texts))


def test_fingerprints_position_by_position():
    """The likeness of two fingerprints estimates what a plain walk over both texts finds."""
    from carelake.llm.edit_fingerprint import CLASSES, PERIOD, SEED, characters, classes, fingerprints, likeness

    bits = np.random.default_rng(SEED).integers(0, 2, (CLASSES, PERIOD)).astype(bool)
    bits[:, ::16] = True

    def walk(text):
        out, i, kind = [], 0, classes(characters(text))
        digit = (mixed(characters(text).astype(np.uint64), 1) & np.uint64(15)).tolist()
        while i < len(text):
            out.append(digit[i])
            i += bits[kind[i], (len(out) - 1) % PERIOD]
        return out

    rng = random.Random(21)
    base = " ".join(prose(rng, 800))
    for share in (0.0, 0.01, 0.05, 0.4):
        other = list(base)
        for _ in range(int(share * len(base))):
            other[rng.randrange(len(other))] = rng.choice("xyz")
        other = "".join(other)
        a, b = walk(base), walk(other)
        agree = sum(x == y for x, y in zip(a, b)) / max(len(a), len(b))
        (_, _, one), (_, _, two) = fingerprints([base, other])
        assert likeness(one, two) == pytest.approx(agree, abs=0.12)


# --- documents of the n-gram Jaccard join that link with nothing


def test_ngram_jaccard_lists_hold_near_copies_alone_beyond_the_sketch(spark, monkeypatch):
    """However full the bounded sketch is, documents with shingles of their own make no rows."""
    seen, given = [], ngram_jaccard.open_lists

    def counted(lists, grouped):
        seen.append(lists.count())
        return given(lists, grouped)

    monkeypatch.setattr(ngram_jaccard, "open_lists", counted)
    monkeypatch.setattr(ngram_jaccard, "MOST_CELLS", 1 << 16)
    rng = random.Random(31)
    docs = [[f"w{rng.randrange(10**6)}" for _ in range(1000)] for _ in range(300)]
    docs += [docs[0], docs[1][:-1] + ["x"], docs[1][:-3] + ["y"]]
    got = ngram_jaccard.ngram_jaccard(spark, frame(spark, [" ".join(d) for d in docs]).repartition(3))
    expected = [*((i, i) for i in range(300)), (300, 0), (301, 1), (302, 1)]
    assert rows(got, "doc_id", "component_id") == sorted(expected, key=repr)
    assert 0 < seen[0] < 2 * 3 * 201 + 10, seen


@pytest.mark.parametrize("share", [0.3, 1])
def test_open_sets_against_plain_counts(spark, monkeypatch, share):
    monkeypatch.setattr(ngram_jaccard, "CHUNK", 700)
    monkeypatch.setattr(ngram_jaccard, "SHARD", 900)
    rng = random.Random(32)
    common = prose(rng, 120)
    texts = [" ".join(common[: rng.randrange(120)] + prose(rng, rng.randrange(150))) for _ in range(120)]
    texts += [*texts[:5], None, "", " ", "a", "a", "b c"]
    sets = ngram_jaccard.all_sets([ngram_jaccard.plain(t) for t in texts])
    some = [s[(mixed(s, 3) & np.uint64(255)) < round(256 * share)] for s in sets]
    times = defaultdict(int)
    for s in some:
        for x in s.tolist():
            times[x] += 1
    first = [len(s) - -(-80 * len(s) // 100) + 1 for s in sets]
    expected = [(i, len(s), len(s) > 0 and sum(times[x] == 1 for x in o.tolist()) < f) for i, (s, o, f) in enumerate(zip(sets, some, first))]
    got = ngram_jaccard.open_sets(spark, frame(spark, texts).repartition(3), share)
    assert rows(got, "doc_id", "n_shingles", "open") == sorted(expected, key=repr)
    assert 0 < sum(o for _, _, o in expected) < len(texts) - 20


def test_open_sets_of_more_texts_than_a_chunk_numbers(spark):
    texts = spark.range(70_000, numPartitions=1).selectExpr("id as doc_id", "concat('w', id % 69990) as text")
    got = ngram_jaccard.open_sets(spark, texts, 1).where("open")
    assert {r.doc_id for r in got.collect()} == {*range(10), *range(69_990, 70_000)}


def test_pipeline_stage_lists_near_copies_alone_beyond_the_sketch(spark, monkeypatch, tmp_path):
    import corpus_pipeline

    seen, given = [], ngram_jaccard.open_lists
    monkeypatch.setattr(ngram_jaccard, "open_lists", lambda lists, of: seen.append(lists.select("doc").distinct().count()) or given(lists, of))
    monkeypatch.setattr(ngram_jaccard, "MOST_CELLS", 1 << 16)
    rng = random.Random(33)
    base = prose(rng, 12)
    docs = [base[: rng.randrange(6, 12)] + [f"w{rng.randrange(10**6)}" for _ in range(900)] for _ in range(200)]
    docs += [docs[7][:-2] + ["x"], docs[7][:-4] + ["y"]]
    kept = corpus_pipeline.drop_near_copies(spark, frame(spark, [" ".join(d) for d in docs]), str(tmp_path))
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == list(range(200))
    assert seen[0] == 3
