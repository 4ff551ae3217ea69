"""The pipeline operators on small tables, against brute force or exact round trips."""

import base64
import random
import sys
import struct
from collections import Counter, defaultdict

import numpy as np
import pytest

from carelake.llm import byte_bpe, language_id, linear, mixing, sketch, token_rollup, toxicity, url_reputation, wordhash
from carelake.llm.components import components
from carelake.llm.edit_fingerprint import band_keys, edit_fingerprints, fingerprints, likeness, near_duplicates, written
from carelake.llm.exact_dedup import catalogue, exact_dedup, occurrences
from carelake.llm.ngram_jaccard import Index, ngram_jaccard
from carelake.llm.substring import substring_dedup
from tests.llm import brute

CLASHING = "doc_id long, text string, lang string, source string, chunk string, hash string, words string, first string"


def frame(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "s", "x", "y", "z", "w") for i, t in zip(ids, texts)], CLASHING)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def prose(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    base, shared = prose(rng, 180), prose(rng, 70)
    near = base[:]
    near[90] = "other"
    out = [" ".join(base), " ".join(near), "\n".join(base), " ".join(prose(rng, 60) + shared), " ".join(shared + prose(rng, 40))]
    out += [" ".join(shared * 3), "", None, "  \t", "one", "One", "a b c d", "é ü 漢字 🙂 " * 30, " ".join(prose(rng, 4000)), "x" * 5000]
    for _ in range(12):
        copy = base[:]
        for _ in range(rng.randrange(1, 12)):
            copy[rng.randrange(len(copy))] = f"e{rng.randrange(99)}"
        out.append(" ".join(copy))
    return out


def test_substring_dedup(spark, texts):
    got = substring_dedup(spark, frame(spark, texts))
    assert rows(got, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(brute.substring_dedup(list(enumerate(texts))), key=repr)


def test_substring_dedup_null_and_repeated_ids(spark, texts):
    ids = [5, 5, 2, None, 1, None, 0, 7, 8, 9, 9, 3, 4, 6, 11]
    docs = list(zip(ids, texts[:15]))
    got = substring_dedup(spark, frame(spark, texts[:15], ids))
    assert rows(got, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(brute.substring_dedup(docs), key=repr)


def test_sketch_loses_no_repeated_key(spark):
    keys = np.arange(5000, dtype=np.uint64) % np.uint64(3000)
    df = spark.createDataFrame([(int(k),) for k in keys], "k long").repartition(4)
    read = lambda batches: (np.array(b.column(0).to_pylist(), np.uint64) for b in batches)
    bits = sketch.repeated(df, read, sketch.BLOCK)
    assert sketch.estimated_twice(bits, sketch.BLOCK, np.arange(2000, dtype=np.uint64)).all()
    assert sketch.estimated_twice(bits, sketch.BLOCK, np.arange(2000, 3000, dtype=np.uint64)).mean() < 0.2


def test_sliding_min_and_runs():
    v = np.random.default_rng(1).integers(0, 1000, 60).astype(np.uint64)
    for n in (1, 2, 5, 26, 60):
        assert wordhash.sliding_min(v, n).tolist() == [v[i : i + n].min() for i in range(61 - n)]
    words, counts = wordhash.WordHasher().words([b"a b a b", b"", b"b a"])
    assert counts.tolist() == [4, 0, 2] and len(set(words.tolist())) == 2


def test_exact_dedup(spark, texts):
    docs = list(enumerate([*texts, texts[0] + " ", "one", None]))
    normal = {i: "".join(brute.WORD.findall(t or "")) for i, t in docs}
    groups = defaultdict(list)
    for i, t in docs:
        groups[normal[i]].append((-len(t or ""), i))
    expected = [(i, min(groups[n])[1], len(groups[n]), min(groups[n])[1] == i, brute.sha(n)) for i, n in normal.items()]
    got = exact_dedup(spark, frame(spark, [t for _, t in docs]))
    assert rows(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == sorted(expected, key=repr)


def test_exact_dedup_repeated_rows_and_chunks(spark):
    got = rows(exact_dedup(spark, frame(spark, ["a b", "a b", "ab", None], [1, 1, None, 2])), "doc_id", "group_size", "kept")
    assert got == [(1, 3, True), (2, 1, True), (None, 3, False)]
    found = occurrences(frame(spark, ["a bad omen " * 400])).orderBy("place").collect()
    assert "".join(r.chunk for r in found) == "abadomen" * 400 and len(found) > 2
    assert catalogue(occurrences(frame(spark, ["q", "q"]))).collect()[0]["n"] == 2


def test_ngram_jaccard(spark, texts):
    docs = list(enumerate([*texts, texts[1].upper().replace("W", "w"), texts[0]]))
    got = ngram_jaccard(spark, frame(spark, [t for _, t in docs]))
    assert rows(got, "doc_id", "n_shingles", "component_id") == sorted(brute.ngram_components(docs), key=repr)


def test_ngram_jaccard_null_id_links_with_nothing(spark, texts):
    got = rows(ngram_jaccard(spark, frame(spark, [texts[0]] * 3, [None, 4, 3])), "doc_id", "component_id")
    assert got == [(3, 3), (4, 3), (None, None)]


def test_t_occurrence_is_the_required_overlap():
    rng = np.random.default_rng(2)
    base = np.arange(200, dtype=np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(base, rng.integers(120, 200), replace=False), rng.integers(1000, 9999, rng.integers(0, 40)).astype(np.uint64)])) for _ in range(60)]
    index = Index(sets, list(range(60)))
    for q in sets:
        linked = [i for i, s in enumerate(sets) if 100 * len(np.intersect1d(q, s)) >= 80 * len(np.union1d(q, s))]
        assert index.t_occurrence(q) == linked


def test_components(spark):
    chain = [(i, i + 1) for i in range(20)] + [(100, 101), (103, 101), (50, 50)]
    got = dict(map(tuple, components(spark, spark.createDataFrame(chain, "left long, right long")).collect()))
    assert got == {**{i: 0 for i in range(21)}, 100: 100, 101: 100, 103: 100, 50: 50}


def test_components_of_random_edges_shrink(spark, monkeypatch):
    module = sys.modules["carelake.llm.components"]
    rng, sizes, plain = random.Random(8), [], module.stored

    def counted(spark, frame, label):
        out = plain(spark, frame, label)
        sizes.append((label, out.count()))
        return out

    monkeypatch.setattr(module, "stored", counted)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(3000)] + [(1000 + rng.randrange(90), 1000 + rng.randrange(90)) for _ in range(60)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = dict(map(tuple, components(spark, spark.createDataFrame(edges, "left long, right long")).collect()))
    assert got == {x: root(x) for x in parent}
    read = [n for label, n in sizes if label == "edges"]
    assert len(read) > 1 and read[-1] == 0 and sum(read[1:]) < read[0]


def test_edit_fingerprints(spark, texts):
    docs = [(i, t or "") for i, t in enumerate(texts)]
    got = {r["doc_id"]: r for r in edit_fingerprints(frame(spark, texts).repartition(3)).collect()}
    for k, (i, text) in enumerate(docs):
        following = docs[k - 1][1]
        n = len(text) // 3
        changed = text[: len(text) - n] + following[:n]
        assert got[i]["n_chars"] == len(text) and got[i]["edited_sha256"] == brute.sha(changed)
        a, b, c = fingerprints([text, changed, following])
        assert got[i]["near_edited"] == likeness(a[2], b[2]) and got[i]["near_next"] == likeness(a[2], c[2])
    assert got[0]["fingerprint"] == got[0]["fingerprint"] and got[9]["fingerprint"] != got[10]["fingerprint"]


def test_edit_fingerprints_few_edits_are_near(spark, texts):
    got = edit_fingerprints(frame(spark, [texts[0], texts[13], texts[0]]))
    prints = {r["doc_id"]: r["fingerprint"] for r in got.collect()}
    assert prints[0] == prints[2]
    assert [tuple(r) for r in near_duplicates(spark, got).collect()] == [(2, 0)]
    a, b = fingerprints([texts[13], texts[13].replace("w1 ", "w7 ", 3)])
    assert likeness(a[2], b[2]) > 0.9 > 0.3 > likeness(a[2], fingerprints([texts[3]])[0][2])


def test_near_duplicates_edited_at_the_start_middle_or_end(spark):
    rng = random.Random(11)
    texts = [" ".join(prose(rng, 150, 4000)) for _ in range(60)]
    other = [" ".join(prose(rng, 6, 4000)) for _ in texts]
    ways = {
        "start": [o + t[len(o) :] for t, o in zip(texts, other)],
        "middle": [t[:400] + o + t[400 + len(o) :] for t, o in zip(texts, other)],
        "end": [t[: -len(o)] + o for t, o in zip(texts, other)],
    }
    for way, copies in ways.items():
        made = fingerprints(texts + copies)
        alike = {(60 + i, i) for i in range(60) if likeness(made[i][2], made[60 + i][2]) >= 0.8}
        found = {tuple(r) for r in near_duplicates(spark, edit_fingerprints(frame(spark, texts + copies))).collect()}
        assert len(alike) >= 10 and len(alike & found) >= 0.97 * len(alike), way


def test_near_duplicates_with_an_unlike_leader_in_every_band(spark):
    rng = random.Random(12)
    pairs = [" ".join(prose(rng, 150, 4000)) for _ in range(24)]
    texts = [*pairs, *[t + " end" for t in pairs]]
    keys = defaultdict(set)  # one band of one digit: few keys, so that their smallest documents are unlike the others
    for owner, key in zip(*band_keys([written(f[2]) for f in fingerprints(texts)], 1, 1, 0.8)):
        keys[int(owner)].add(int(key))
    shared = {(24 + i, i) for i in range(24) if keys[i] & keys[24 + i]}
    got = {tuple(r) for r in near_duplicates(spark, edit_fingerprints(frame(spark, texts)), bands=1, digits=1).collect()}
    assert len(shared) >= 20 and shared <= got <= {(24 + i, i) for i in range(24)}, (len(shared), len(shared & got))


def test_edit_fingerprint_query_has_classes(spark, tmp_path):
    from carelake.llm.edit_fingerprint import op8_edit_fingerprint

    rng = random.Random(13)
    long = [" ".join(prose(rng, 150, 4000)) for _ in range(3)]
    texts = [long[0], long[0] + " more", "ab cd ef", "ab cd ef", "ab cd ef", long[1], long[2], long[2], "", None, "other words", long[1]]
    ids = [10, 11, 3, 2, None, 20, 20, 7, 30, 31, 40, None]
    frame(spark, texts, ids).write.parquet(str(tmp_path / "documents.parquet"))
    got = op8_edit_fingerprint(spark, str(tmp_path))
    plain = edit_fingerprints(frame(spark, texts, ids))
    assert got.columns == [*plain.columns, "near_class", "near_class_size"]
    assert rows(got, *plain.columns) == rows(plain, *plain.columns)
    wanted = [(10, 10, 2), (11, 10, 2), (3, 2, 2), (2, 2, 2), (None, None, None), (20, 20, 1), (20, 7, 2), (7, 7, 2)]
    wanted += [(30, 30, 2), (31, 30, 2), (40, 40, 1), (None, None, None)]
    assert rows(got, "doc_id", "near_class", "near_class_size") == sorted(wanted, key=repr)


def test_byte_bpe_is_the_rank_tokenizer(spark, texts):
    import public_tokenizers
    import tiktoken

    path = public_tokenizers.path(byte_bpe.VOCABULARY)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    hard = [*texts, "<|endoftext|> it's 12 345\n\n  x y\x00", "a" * 3000, " \t\n ", "🙂‍👩‍🚀"]
    bpe = byte_bpe.standard(spark)
    for r in bpe.decode(bpe.encode(frame(spark, hard))).collect():
        text = hard[r["doc_id"]] or ""
        assert list(struct.unpack(f"<{len(r['ids']) // 4}I", r["ids"])) == other.encode_ordinary(text)
        assert bytes(r["decoded"]) == text.encode()


def test_token_rollup(spark, tmp_path):
    schema = "doc_id long, source string, lang string, tokenizer string, op string, n_tokens long, old_tokens long, n_docs string"
    first = [(1, "a", "en", "v1", "insert", 10, None, "x"), (2, "a", None, "v1", "insert", 5, None, "x"), (1, "a", "en", "v1", "insert", 10, None, "x"), (3, "b", "en", "v1", "insert", None, None, "x")]
    second = [(1, "a", "en", "v1", "revise", 12, 10, "x"), (2, "a", None, "v1", "delete", 5, None, "x"), (9, "a", "en", "v1", "odd", 7, None, "x")]
    make = lambda r: spark.createDataFrame(r, schema)
    store = token_rollup.Rollup(spark, str(tmp_path / "s")).create()
    assert store.totals().count() == 0
    store.commit(0, make(first))
    store.commit(0, make(first))
    store.commit(1, make(second))
    store.commit(2, make([]))
    expected = [("a", "en", "v1", 1, 12), ("b", "en", "v1", 1, 0)]
    assert rows(store.totals(), *token_rollup.KEYS, "n_docs", "n_tokens") == expected
    store.compact(1)
    store.commit(1, make(first))
    assert rows(store.totals(), *token_rollup.KEYS, "n_docs", "n_tokens") == expected


def test_mixing_meets_marginals_and_budget(spark):
    rng = random.Random(4)
    docs = [(i, " ".join(prose(rng, rng.randrange(1, 60))), rng.choice(["en", "fr", None]), rng.choice(["a"] * 8 + ["b", "c"]), "k") for i in range(3000)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, at_mix_lang string")
    mix = mixing.Mix({"source": {"a": 1, "b": 1}, "lang": {"en": 3, "fr": 1}}, budget=0.08)
    drawn = mix.draw(mix.cells(df, "doc_id", "text", "at_mix_lang")).collect()
    tokens = Counter()
    for r in drawn:
        n = len((r["text"] or "").split())
        tokens["all"] += n
        for key in ("drawn", r["mix_source"], r["mix_lang"]):
            tokens[key] += n * r["probability"]
    assert abs(tokens["a"] / tokens["b"] - 1) < 1e-6 and abs(tokens["en"] / tokens["fr"] - 3) < 1e-6
    assert abs(tokens["drawn"] / tokens["all"] - 0.08) < 1e-9
    assert mix.sample(df).columns == df.columns
    assert abs(sum(r["kept"] for r in drawn) / sum(r["probability"] for r in drawn) - 1) < 0.15


def test_rake_reaches_both_marginals():
    cells = mixing.rake(np.array([[10.0, 20], [30, 40]]), [np.array([60.0, 40]), np.array([50.0, 50])])
    assert np.allclose(cells.sum(axis=1), [60, 40]) and np.allclose(cells.sum(axis=0), [50, 50])


def test_url_filter(spark):
    urls = ["http://A.Example.NET/en/x?q#f", "http://example.net", "ftp://b.example.com/de/1", "http://org/fr/", None, "no scheme", "http://x.org/de/", "http://notnet/", "https://spam.test/a"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    outcomes = spark.createDataFrame([("https://spam.test/b", 1)] * 60 + [("http://x.org/q", 0)] * 60 + [("http://y.org/", None)], "url string, bad int")
    got = [tuple(r) for r in url_reputation.filter_urls(pages, outcomes).orderBy("page_id").select("host", "path", "rule", "verdict").collect()]
    assert got == [
        ("a.example.net", "/en/x", "example.net/en/", "allow"), ("example.net", "", None, "allow"), ("b.example.com", "/de/1", "example.com/de/", "block"),
        ("org", "/fr/", "org/fr/", "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("x.org", "/de/", None, "allow"),
        ("notnet", "/", None, "allow"), ("spam.test", "/a", None, "block"),
    ]
    assert url_reputation.filter_urls(pages.limit(0), outcomes.limit(0)).count() == 0


def test_toxicity_learns_from_positives_and_unlabelled(spark):
    rng = random.Random(5)
    toxic = [i % 9 == 0 for i in range(1500)]
    texts = [" ".join(prose(rng, 80) + (["idiot", "scumbag"] if bad else [])) for bad in toxic]
    docs = frame(spark, [*texts, "", None])
    labels = spark.createDataFrame([(i, int(toxic[i])) for i in range(0, 1500, 2)] + [(1, None), (99999, 1)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(docs, labels).collect()}
    held = [i for i in range(1500) if got[i]["held_out"]]
    assert np.mean([got[i]["predicted"] == toxic[i] for i in held]) > 0.97
    assert got[1500]["predicted"] == 0 and got[1500]["score"] == got[1501]["score"]
    assert toxicity.score_toxicity(docs, labels.where("toxic = 0")).where("predicted = 1").count() == 0
    assert toxicity.score_toxicity(docs.limit(0), labels.limit(0)).count() == 0


def test_toxicity_copies_and_frequency(spark):
    """A toxic page copied often does not make its ordinary words toxic; a stem that clean
    texts use once counts where it is frequent."""
    rng = random.Random(6)
    words = [f"{a}{b}{c}{d}" for a in "bdgk" for b in "aeiou" for c in "lmnrst" for d in "aeiou"]
    clean = [" ".join(rng.choices(words, k=250) + ["stemman"] * (i % 7 == 0)) for i in range(900)]
    own = [f"copy{c}" for c in "abcdefghijklmnop"]
    copied = rng.choices(words, k=30) + own
    toxic = [" ".join([*copied, f"x{i}", "stemmen", "stemmig"]) for i in range(60)]
    toxic += [" ".join(rng.sample(rng.choices(words, k=100) + ["stemmon", "stemmar", "stemmik", "stemmul"], 104)) for _ in range(60)]
    texts = clean + toxic + [" ".join(own + rng.choices(words, k=60)) for _ in range(20)] + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(900 <= i < 1020)) for i in range(1020)], "doc_id long, toxic int")
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score_toxicity(docs, labels).collect()}
    assert sum(got[i] for i in range(900)) <= 9
    assert sum(got[i] for i in range(960, 1020)) >= 57
    assert not any(got[i] for i in range(1020, 1042))
    assert len(toxicity.one_of_each_family([toxicity.document_features(t) for t in toxic[:60]])) == 1


def test_language_id(spark):
    rng = random.Random(6)
    words = {"en": ["the", "and", "with", "house"], "de": ["und", "nicht", "straße", "ein"]}
    data = [(i, " ".join(rng.choices(words[lang], k=20)), lang) for i, lang in enumerate(["en", "de"] * 150)]
    data += [(900, None, None), (901, "12 34 !", "en"), (902, "", "de"), (903, "und ein haus", None)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in language_id.LanguageModel.fit(docs).predict(docs).collect()}
    assert all(got[i]["lang_pred"] == lang for i, _, lang in data[:300])
    assert [got[i]["lang_pred"] for i in (900, 901, 902, 903)] == ["und", "und", "und", "de"]
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_word_scores(monkeypatch):
    monkeypatch.setattr(language_id, "REMEMBERED", 20_000)
    met = language_id.WordScores(np.random.default_rng(1).normal(size=(language_id.BUCKETS, 2)).astype("f4"))
    for words in ([f"w{i}é" if i % 9 == 0 else f"w{i}" for i in range(12_000)], ["x", "日本"] * 9, [f"v{i}" for i in range(12_000)], [f"u{i}" for i in range(25_000)]):
        expected = np.mean([met.scores[language_id.subwords(w)].mean(axis=0) for w in words], axis=0)
        met.learn([words, words[:1]])
        assert np.allclose(met.mean(words), expected, atol=1e-5) and len(met.place) <= 20_000
    assert list(language_id.groups([3, 9, 1, 1, 30], 10)) == [(0, 1), (1, 3), (3, 4), (4, 5)]
    assert list(language_id.groups([])) == []


def test_word_table_is_bounded(monkeypatch):
    monkeypatch.setattr(linear, "REMEMBERED", 10)
    table = linear.Table(len)
    assert [table[w] for w in map(str, range(100))] and len(table) <= 11


def test_empty_tables(spark):
    none = frame(spark, [])
    for run in (substring_dedup, exact_dedup, ngram_jaccard):
        assert run(spark, none).count() == 0
    assert edit_fingerprints(none).count() == 0
    assert mixing.Mix().sample(none).count() == 0
    assert language_id.LanguageModel.fit(none).predict(none).count() == 0


def test_pipeline_on_a_small_corpus(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(8)
    clean = [" ".join(prose(rng, 120, 4000)) for _ in range(300)]
    near = [t.replace(t.split()[60], "changed", 1) for t in clean[:20]]
    bad = [" ".join(prose(rng, 60, 4000) + ["idiot", "scumbag"]) for _ in range(100)]
    everything = [*clean, *clean[:30], *near, *bad, None, ""]
    data = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(everything)]
    spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    first_bad = 350
    spark.createDataFrame([(i, 1, int(first_bad <= i < 450)) for i in range(450)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        if name != "byte_bpe":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        steps[name] = {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert len(steps["toxicity"] & set(range(first_bad, 450))) <= 5 and len(steps["toxicity"] & set(range(300))) == 300
    assert steps["exact_dedup"] == {i for i in steps["toxicity"] if not 300 <= i < 330 and i != 451}
    assert not steps["ngram_jaccard"] & set(range(330, 350)) and set(range(300)) <= steps["ngram_jaccard"]
    assert steps["mixing_weights"] == steps["byte_bpe"] and 0 < len(steps["byte_bpe"]) < len(steps["ngram_jaccard"])
    assert docs.where("not round_trip").count() == 0
