import random
import time

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from entilake.llm import langid, mixing, packing
from entilake.llm.tokens import encoder, DEFAULT_TOKENIZER, token_counts

# Tokens


def test_counts_equal_the_tokenizer_and_round_trip(spark):
    texts = ["", "Hello  world\n\n<|endoftext|>", "日本語のテキスト", "a" * 5000, "It's 12345 l'été"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(99, None)], "doc_id long, text string").withColumn("n_tokens", F.lit("clash"))
    got = dict(token_counts(df, ["doc_id"]).collect())
    enc = encoder(DEFAULT_TOKENIZER)
    assert got == {i: len(enc.encode_ordinary(t)) for i, t in enumerate(texts)} | {99: 0}
    assert all(enc.decode(enc.encode_ordinary(t)) == t for t in texts)


# Packing


def best_fit_by_hand(sizes, capacity):
    """Containers of sequential best-fit decreasing."""
    gaps = []
    for s in sorted(sizes, reverse=True):
        fit = [g for g in gaps if g >= s]
        if fit:
            gaps.remove(min(fit))
            gaps.append(min(fit) - s)
        else:
            gaps.append(capacity - s)
    return len(gaps)


@pytest.mark.parametrize("seed", range(4))
def test_sweeps_equal_sequential_best_fit(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([rng.randint(1, 100), 33, 50, 1]) for _ in range(300)]
    moves, containers = packing.sweep({s: sizes.count(s) for s in set(sizes)}, 100)
    assert containers == best_fit_by_hand(sizes, 100)
    assert sum(1 for _ in moves) < 300


@pytest.mark.parametrize("hot", [0.0, 0.5])
def test_pack_is_whole_and_never_overfull(spark, monkeypatch, hot):
    monkeypatch.setattr(packing, "PART_ROWS", 20)
    rng = random.Random(1)
    sizes = [(i, 40 if rng.random() < hot else rng.randint(0, 260)) for i in range(500)] + [(900, None), (901, 100), (902, 300)]
    df = spark.createDataFrame(sizes, "doc_id long, n_tokens int").withColumn("piece_no", F.lit("clash"))
    got = packing.pack(df, "doc_id", "n_tokens", 100).collect()
    fill, parts = {}, {}
    for r in got:
        fill[r["container_id"]] = fill.get(r["container_id"], 0) + r["n_tokens"]
        parts.setdefault(r["doc_id"], []).append((r["first_token"], r["n_tokens"]))
        assert r["n_pieces"] == max(1, -(-(dict(sizes)[r["doc_id"]] or 0) // 100))
    assert max(fill.values()) <= 100
    for doc, n in sizes:
        at = 0
        for first, size in sorted(parts[doc]):
            assert first == at and (size == 100 or first + size == (n or 0))
            at += size
        assert at == (n or 0)
    pieces = [p for _, n in sizes for p in [100] * ((n or 0) // 100) + [(n or 0) % 100] if p]
    assert len({c for c, n in fill.items() if n}) == best_fit_by_hand(pieces, 100)


def test_pack_nothing_and_only_empty_documents(spark):
    none = spark.createDataFrame([], "doc_id long, n_tokens int")
    assert rows(packing.pack(none, "doc_id", "n_tokens", 10)) == []
    zero = spark.createDataFrame([(1, 0), (2, None)], none.schema)
    assert rows(packing.pack(zero, "doc_id", "n_tokens", 10), "doc_id", "n_pieces", "container_id") == [(1, 1, 0), (2, 1, 0)]
    with pytest.raises(ValueError):
        packing.pack(none, "doc_id", "n_tokens", 0)


def test_capacity_beyond_a_million_is_exact(spark, monkeypatch):
    rng = random.Random(8)
    capacity = (1 << 20) + 12_345
    sizes = [rng.randint(1, 3 * capacity) for _ in range(120)] + [capacity, 1, capacity - 1]
    got = packing.pack(spark.createDataFrame(list(enumerate(sizes)), "doc_id long, n_tokens long"), "doc_id", "n_tokens", capacity)
    fill = {r[0]: r[1] for r in got.groupBy("container_id").sum("n_tokens").collect()}
    pieces = [p for n in sizes for p in [capacity] * (n // capacity) + [n % capacity] if p]
    assert max(fill.values()) == capacity and sum(fill.values()) == sum(sizes)
    assert len(fill) == best_fit_by_hand(pieces, capacity)
    monkeypatch.setattr(packing, "MAX_SIZES", 10)
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame(list(enumerate(sizes)), "doc_id long, n_tokens long"), "doc_id", "n_tokens", capacity)


@pytest.mark.parametrize("capacity", [100, 1024])
def test_moves_stay_below_their_bound(capacity):
    moves, _ = packing.sweep({s: 7 + s % 5 for s in range(1, capacity + 1)}, capacity)
    assert len(moves) <= 3 * capacity * (2 * capacity) ** 0.5


# Mixing


def mixed(spark, docs, targets, budget=None):
    d = spark.createDataFrame(docs, "doc_id long, source string, n_tokens int")
    t = mixing.targets_of(spark.createDataFrame(targets, "source string, target_share double, max_repeats int"), "source", "target_share", "max_repeats")
    budget = mixing.budget_of(d, t) if budget is None else budget
    times = mixing.finish_times(d, t, budget)
    return times, t, budget


@pytest.mark.parametrize("most", [50_000, 1])
def test_shares_repeats_and_budget(spark, monkeypatch, most):
    monkeypatch.setattr(mixing, "MOST_ROWS", most)
    monkeypatch.setattr(mixing, "PART_ROWS", max(20, most))
    rng = random.Random(2)
    docs = [(i, rng.choice([" A", "a", "A "]) if i < 600 else "b" if i < 900 else "c" if i < 905 else None, rng.randint(1, 20)) for i in range(1000)]
    times, t, budget = mixed(spark, docs, [("a", 0.5, 2), ("B", 0.3, 3), ("c", 0.15, 4), ("d", 0.05, 9), (None, 0.1, 1)])
    assert budget == sum(n for _, s, n in docs if s)
    supply = {"a": sum(n for i, s, n in docs if i < 600), "B": sum(n for i, s, n in docs if 600 <= i < 900), "c": sum(n for i, s, n in docs if 900 <= i < 905), "d": 0}
    by_hand = [s for s, w, k in [("a", 0.5, 2), ("B", 0.3, 3), ("c", 0.15, 4), ("d", 0.05, 9)] if supply[s] * k < w * budget]
    kept = mixing.cut_at_budget(times, budget)
    assert rows(mixing.short_sources(times, kept, t, budget)) == sorted((s,) for s in by_hand)
    got = kept.collect()
    total = sum(r["n_tokens"] for r in got)
    assert budget - 20 <= total <= budget
    everything = sorted(times.collect(), key=lambda r: (r["finish"], r["_h"], r["doc_id"]))
    assert {(r["doc_id"], r["replica"]) for r in got} == {(r["doc_id"], r["replica"]) for r in everything[: len(got)]}
    uses = {}
    for r in got:
        uses[r["doc_id"]] = uses.get(r["doc_id"], 0) + 1
        assert r["replica"] < {"a": 2, "B": 3, "c": 4}[r["source"]]
    share = {r["source"]: r for r in mixing.shares(kept, t).collect()}
    assert share["d"]["n_tokens"] == 0 and abs(sum(r["actual_share"] for r in share.values()) - 1) < 1e-9
    assert abs(share["a"]["actual_share"] / share["B"]["actual_share"] - 5 / 3) < 0.1
    # Virtual finish times are running sums by source and pass, over the share.
    for s, w in (("a", 0.5), ("B", 0.3)):
        run = 0
        for r in sorted((r for r in everything if r["source"] == s), key=lambda r: r["finish"]):
            run += r["n_tokens"]
            assert abs(r["finish"] - run / w) < 1e-6 * run


def test_uses_of_one_finish_time_are_cut_by_hash(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_ROWS", 10)
    schema = "doc_id long, source string, replica int, n_tokens long, finish double, _h long"
    data = [(i, "a", 0, 1, 5.0, hash((i, "x")) % 10**9 - 5 * 10**8) for i in range(3000)] + [(5000 + i, "b", 0, 2, 1.0 + i, i) for i in range(3)] + [(9000, "c", 0, 9, 1e300, 0)]
    kept = mixing.cut_at_budget(spark.createDataFrame(data, schema), 1006).collect()
    want = sorted(data, key=lambda r: (r[4], r[5], r[0]))[: 3 + 1000]
    assert {r["doc_id"] for r in kept} == {r[0] for r in want}
    assert mixing.cut_at_budget(spark.createDataFrame(data, schema), 10**6).count() == len(data)
    assert mixing.cut_at_budget(spark.createDataFrame(data, schema), 0).count() == 0


def test_virtual_end():
    assert mixing.virtual_end([(0.5, 10.0), (0.5, 1000.0)], 100) == 180  # 10 from the one until 20, the rest at half speed
    assert mixing.virtual_end([(0.5, 10.0), (0.5, 20.0)], 100) == float("inf") and mixing.virtual_end([], 1) == float("inf")
    assert mixing.virtual_end([(0.25, 1e9), (0.75, 1e9)], 100) == 100


def test_huge_repeats_make_no_more_uses_than_needed(spark):
    docs = [(i, "a", 10) for i in range(50)] + [(100, "b", 1)]
    times, t, budget = mixed(spark, docs, [("a", 0.5, 1), ("b", 0.5, 1_000_000_000)], budget=400)
    assert times.count() <= 400 + 50
    kept = mixing.cut_at_budget(times, budget)
    got = {r["source"]: r["n_tokens"] for r in mixing.shares(kept, t).collect()}
    assert abs(got["a"] - 200) <= 10 and abs(got["b"] - 200) <= 10


def test_shares_above_one_are_scaled(spark):
    t = mixing.targets_of(spark.createDataFrame([("a", 1.0, 1), ("b", 3.0, None)], "s string, w double, k int"), "s", "w", "k")
    assert rows(t, "_source", "_share", "_repeats") == [("a", 0.25, 1), ("b", 0.75, 1)]


def test_mix_of_nothing(spark):
    times, t, budget = mixed(spark, [], [("a", 1.0, 2)])
    assert budget == 0 and rows(mixing.cut_at_budget(times, budget)) == []
    times, t, budget = mixed(spark, [(1, "a", 0), (2, None, 5), (3, "z", 5)], [("a", 0.0, 2), ("a", None, 1)])
    assert rows(times) == [] and budget == 0


# Languages

SENTENCES = {
    "en": ["The old bridge was closed after the winter.", "Nobody has checked this number since then.", "Please add a short description for others.", "There are still many villages without any source."],
    "de": ["Die alte Brücke wurde nach dem Winter geschlossen.", "Niemand hat diese Zahl seitdem geprüft.", "Bitte eine kurze Beschreibung für andere hinzufügen.", "Es gibt noch viele Dörfer ohne Quelle."],
    "sv": ["Den gamla bron stängdes efter vintern.", "Ingen har kontrollerat uppgiften sedan dess.", "Lägg gärna till en kort beskrivning för andra.", "Det finns fortfarande många byar utan källa."],
    "ja": ["古い橋は冬のあとで閉鎖されました。", "それから誰も確認していません。", "短い説明を書いてください。", "出典のない村がまだ多くあります。"],
}
NAMES = [("en", "en", "eng", "English"), ("de", "de", "deu", "German"), ("sv", "sv", "swe", "Swedish"), ("ja", "ja", "jpn", "Japanese"), ("da", "da", "dan", "Danish")]


def language_corpus(n=240):
    rng = random.Random(4)
    docs, truth = [], {}
    for i in range(n):
        lang = rng.choice(list(SENTENCES))
        found = {lang}
        text = rng.sample(SENTENCES[lang], 3)
        if i % 12 == 0:
            other = rng.choice([x for x in SENTENCES if x != lang])
            text.append(rng.choice(SENTENCES[other]))
            found.add(other)
        label = lang if rng.random() < 0.75 else rng.choice([None, "und", "da" if lang == "sv" else "en", lang.upper() + "-XX"])
        docs.append((i, ' [[Q1]] "Stary Most" '.join(text), label, rng.choice(["s1", None]), rng.choice(["P1", "P2", None])))
        truth[i] = found
    return docs, truth


def test_languages_of_documents_and_segments(spark):
    docs, truth = language_corpus()
    extra = [(900, "", "en", "s1", None), (901, None, None, None, None), (902, "<ref name='x' /> Q17 https://a.b/c", "de", "s1", "P1"), (903, " ".join(SENTENCES["de"] * 2000), "en", "s1", "P1"), (904, "Winter", None, "s1", "P1")]
    df = spark.createDataFrame(docs + extra, "doc_id long, text string, lang string, source string, page_title string").withColumn("segments", F.lit("clash")).withColumn("label", F.lit("clash"))
    languages = spark.createDataFrame(NAMES, "code string, tag string, iso3 string, english_title string")
    got = {r["doc_id"]: r for r in langid.identify(df, languages).collect()}
    assert set(got) == {d[0] for d in docs + extra}
    right = sum({s["lang_code"] for s in got[i]["segments"]} == t for i, t in truth.items())
    assert right >= 0.98 * len(truth)
    assert all(got[i]["segments"] == [] for i in (900, 901, 902)) and got[902]["lang_code"] == "de" and got[902]["confidence"] > 0.5
    assert all(r["lang_code"] is not None and 0 < r["confidence"] <= 1 for r in got.values())
    assert len(got[904]["segments"]) == 1 and got[904]["confidence"] < 0.9  # one word that two languages share
    assert [s["lang_code"] for s in got[903]["segments"]] == ["de"] and got[903]["segments"][0]["stop"] > 100_000
    for i, t, *_ in docs:
        at = 0
        for s in got[i]["segments"]:
            assert at <= s["start"] < s["stop"] <= len(t) and 0.9 <= s["confidence"] <= 1
            at = s["stop"]
    assert {s["lang_code"] for r in got.values() for s in r["segments"]} == set(SENTENCES)


def test_very_many_segments_take_linear_time(spark):
    docs, _ = language_corpus()
    mixed = " ".join([SENTENCES["en"][0], SENTENCES["de"][0]] * 50_000)
    df = spark.createDataFrame(docs + [(900, mixed, None, "s1", "P1")], "doc_id long, text string, lang string, source string, page_title string")
    languages = spark.createDataFrame(NAMES, "code string, tag string, iso3 string, english_title string")
    began = time.monotonic()
    found = langid.identify(df, languages).where("doc_id = 900").first()
    assert len(found["segments"]) == 100_000 and [s["lang_code"] for s in found["segments"][:4]] == ["en", "de", "en", "de"]
    assert time.monotonic() - began < 60


def test_own_label_is_no_evidence_twice(spark):
    """A page of one document has no prior of its own: the label counts once."""
    docs, _ = language_corpus()
    one = [(900, "Winter", "de", "s9", "alone"), (901, "Winter", None, "s9", "other")]
    df = spark.createDataFrame(docs + one, "doc_id long, text string, lang string, source string, page_title string")
    languages = spark.createDataFrame(NAMES, "code string, tag string, iso3 string, english_title string")
    got = {r["doc_id"]: r for r in langid.identify(df, languages).where("doc_id >= 900").collect()}
    wrong = (1 - langid.LABEL_RIGHT) / (len(NAMES) - 1)
    assert got[900]["lang_code"] == "de"
    # Without the label the odds of German and English are those of words, source and whole; the label adds its own only.
    assert got[900]["confidence"] <= langid.LABEL_RIGHT / (langid.LABEL_RIGHT + wrong)


@pytest.mark.parametrize("most", [256, 1])
def test_hot_pages_are_split(spark, monkeypatch, most):
    docs, truth = language_corpus()
    df = spark.createDataFrame([(i, t, l, "s", "P1" if i % 3 else f"P{i}") for i, t, l, *_ in docs], "doc_id long, text string, lang string, source string, page_title string")
    languages = spark.createDataFrame(NAMES, "code string, tag string, iso3 string, english_title string")
    want = rows(langid.identify(df, languages), "doc_id", "lang_code", "segments")
    monkeypatch.setattr(langid, "MOST_SPLIT", 3)
    monkeypatch.setattr(langid, "max", lambda a, b: b if a == 100_000 else max(a, b), raising=False)
    assert rows(langid.identify(df, languages), "doc_id", "lang_code", "segments") == want and len(want) == len(truth)


def test_languages_without_documents_or_labels(spark):
    schema = "doc_id long, text string, lang string, source string, page_title string"
    languages = spark.createDataFrame(NAMES, "code string, tag string, iso3 string, english_title string")
    assert rows(langid.identify(spark.createDataFrame([], schema), languages)) == []
    one = spark.createDataFrame([(1, "Some text here.", None, None, None)], schema)
    assert rows(langid.identify(one, languages)) == [(1, None, None, [], None)]
    assert rows(langid.identify(one, languages.where("false"))) == [(1, None, None, [], None)]


def test_nulls_repeats_and_clashing_columns(spark):
    docs, _ = language_corpus(60)
    odd = [(None, docs[0][1], "de", "s1", "P1"), (None, None, None, None, None), (7, None, "en", None, None), (8, docs[1][1], None, None, None), (8, docs[1][1], None, None, None)]
    schema = "doc_id long, text string, lang string, source string, page_title string"
    df = spark.createDataFrame(docs + odd + odd, schema)
    for clash in ("page", "runs", "k", "n", "_salt", "page_labels", "label_code", "_whole", "confidence"):
        df = df.withColumn(clash, F.lit("clash"))
    languages = spark.createDataFrame([*NAMES, *NAMES, (None, "x", "y", "z"), ("de", None, None, None)], "code string, tag string, iso3 string, english_title string")
    got = langid.identify(df, languages).collect()
    assert len(got) == len(docs) + 2 * len(odd) and all(r["lang_code"] is not None for r in got)
    assert sum(r["doc_id"] is None for r in got) == 4


def test_too_many_languages_and_too_large_models_are_refused(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 3)
    with pytest.raises(ValueError):
        langid.label_index(spark.createDataFrame(NAMES, "code string, tag string, iso3 string, english_title string"))
    monkeypatch.setattr(langid, "MAX_MODEL_BYTES", 10)
    with pytest.raises(ValueError):
        langid.fit([("some words", 0)], 2)


def test_labels_name_languages(spark):
    languages = spark.createDataFrame(NAMES, "code string, tag string, iso3 string, english_title string")
    codes, names = langid.label_index(languages)
    labels = ["en", " EN ", "en_US", "eng", "English", "german", "de-AT", "und", "", None, "??", "xx-YY", "en-"]
    got = dict(langid.with_label(spark.createDataFrame([(i, x) for i, x in enumerate(labels)], "i int, lang string"), "lang", names).select("i", "label").collect())
    assert [codes[got[i]] if got[i] is not None else None for i in range(len(labels))] == ["en", "en", "en", "en", "en", "de", "de", None, None, None, None, None, None]


def test_blanking_keeps_places():
    text = 'A {{ping|X}} b [[Q1]] "Puente Viejo" c -- Name 12:04 d <ref name="x" /> Q5 end.'
    clean = langid.blanked(text)
    assert len(clean) == len(text) and "Puente" not in clean and "Name" not in clean and clean.split() == ["A", "b", "c", "d", "end."]


def test_long_markup_and_quotations():
    name, talk = '"' + "Puente " * 4 + '"', '"' + "Ya lo he corregido hoy" + '"'
    tag = "<ref name='" + "x" * 2000 + "' />"
    assert langid.blanked(f"a {tag} b {name} c {talk}").split() == ["a", "b", "c", *talk.split()]
    assert langid.blanked("1 < 2 and 3 > 2") == "1 < 2 and 3 > 2"
    assert "説" not in langid.blanked("「短い説明」です。") and "説" in langid.blanked("「" + "短い説明を書いて" * 4 + "」です。")


def test_model_scores_are_sums():
    model = langid.fit([(t, k) for k, x in enumerate(SENTENCES.values()) for t in x], len(SENTENCES))
    one = lambda w: model.score(np.array([w]), np.array([0]), 1)[0]
    both = model.score(np.array([0, 1, 2, 3]), np.array([0, 0, 0, 1]), 3)
    assert np.allclose(both, [one(0) + one(1) + one(2), one(3), np.zeros(len(model.live))], atol=1e-4)
    assert model.score(np.zeros(0, np.int64), np.zeros(0, np.int64), 0).shape == (0, len(model.live))
