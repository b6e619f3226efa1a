"""Classifiers and language identification: held-out accuracy, decided cases, and their small parts."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from cases import documents, odd_texts, rows_of, with_clashes

from eventmill.llm import langid, quality_model, toxicity
from eventmill.llm.labels import held_out, sample

ODD = rows_of(*odd_texts())
LABELS = "doc_id long, quality int, toxic int"


def held(doc_id, folds, at):
    return zlib.crc32(str(doc_id).encode()) % folds == at


def corpus(n=500):
    """Good, junk and toxic prose in two made-up languages; labels for three in four."""
    rng = random.Random(6)
    tongues = {
        "xx": ["the", "of", "and", *("".join(rng.choice("bdgklmnoprsta") for _ in range(5)) for _ in range(300))],
        "yy": ["der", "und", "zu", *("".join(rng.choice("äüöschzteiwn") for _ in range(6)) for _ in range(300))]}
    rows, labels = [], []
    for i in range(n):
        lang = rng.choice(sorted(tongues))
        words = rng.choices(tongues[lang], [40, 30, 20, *[1] * 300], k=rng.randrange(30, 120))
        junk, toxic = rng.random() < 0.3, rng.random() < 0.25
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), f"{rng.choice(['skrelp', 'vrodnak'])}{rng.choice(['', 's', 'er', 'ish'])}")
        if junk:
            words = [w + rng.choice(["%%%", "***", "$$$"]) for w in words]
        rows.append((i, " ".join(words) + ".", lang, f"src{i % 4}", 1))
        if rng.random() < 0.75:
            labels.append((i, int(not junk), int(toxic)))
    return rows, labels


ROWS, MARKS = corpus()


@pytest.mark.parametrize("module, label, folds, at", [(quality_model, "quality", 3, 1), (toxicity, "toxic", 5, 0)])
def test_held_out_accuracy(spark, module, label, folds, at):
    docs, labels = with_clashes(documents(spark, [*ROWS, *[(10_000 + r[0], *r[1:]) for r in ODD], (None, "no id", None, None, None)])), spark.createDataFrame(MARKS, LABELS)
    found = module.classify(docs, labels).collect()
    assert len(found) == len(ROWS) + len(ODD) + 1
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)
    assert all(r.held_out == (r.doc_id is not None and held(r.doc_id, folds, at)) for r in found)
    truth = {i: (q, t)[label == "toxic"] for i, q, t in MARKS}
    unseen = [(r.predicted, truth[r.doc_id]) for r in found if r.held_out and r.doc_id in truth]
    assert len(unseen) > 40 and np.mean([a == b for a, b in unseen]) > 0.97
    same = [r.score for r in found if r.doc_id in (10_000, 10_001)]  # a null text and an empty one
    assert same[0] == same[1]
    again = module.classify(documents(spark, ROWS, parts=5), labels).collect()
    scores = {r.doc_id: r.score for r in found}
    assert all(abs(scores[r.doc_id] - r.score) < 0.05 for r in again)  # other texts took part in the word vectors


@pytest.mark.parametrize("module, label", [(quality_model, "quality"), (toxicity, "toxic")])
def test_classifiers_without_labels_or_documents(spark, module, label):
    none = spark.createDataFrame([], LABELS)
    found = module.classify(documents(spark, ODD), none).collect()
    assert len(found) == len(ODD) and all(0 <= r.score <= 1 for r in found)
    assert module.classify(documents(spark, []), none).count() == 0
    one_kind = spark.createDataFrame([(r[0], 1, 0) for r in ODD] + [(3, None, None), (None, 0, 1)], LABELS)
    found = module.classify(documents(spark, ODD), one_kind).collect()
    assert {r.predicted for r in found} == ({1} if label == "quality" else {0})


def test_only_the_other_folds_are_learned_from(spark):
    labels = spark.createDataFrame([*MARKS, MARKS[0], (None, 1, 1), (7, None, None)], LABELS)
    used = sample(labels, "quality", 3, 1).collect()
    assert {(r.doc_id, r.label) for r in used} == {(i, q) for i, q, _ in MARKS if not held(i, 3, 1)}
    assert sample(labels, "quality", 3, 1, most=10).count() == 10
    assert not spark.createDataFrame([(None,)], "doc_id long").select(held_out(3, 1)).first()[0]


def test_no_held_out_label_changes_a_score(spark):
    docs = documents(spark, ROWS)
    turned = [(i, 1 - q, 1 - t) if held(i, 3, 1) else (i, q, t) for i, q, t in MARKS]
    first, second = (
        {r.doc_id: r.score for r in quality_model.classify(docs, spark.createDataFrame(m, LABELS)).collect()} for m in (MARKS, turned))
    assert first == second


def test_word_vectors_count_all_neighbours(spark):
    texts = odd_texts()
    whole = quality_model._neighbour_sums([(t or "").encode() for t in texts])
    parts = sum(quality_model._neighbour_sums([(t or "").encode()]) for t in texts)
    assert np.array_equal(whole, parts)
    rows = whole.reshape(quality_model.BUCKETS, -1)
    want = (rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1)).astype(np.float32)
    assert np.allclose(quality_model.word_vectors(documents(spark, ODD).select("text")), want)


def test_tokens_are_runs_of_a_kind():
    hashes, owner, first = quality_model.tokens([b"ab%% cd", b"", b" %% ab", "é1\x01x".encode()])
    assert owner.tolist() == [0, 0, 0, 2, 2, 3, 3] and first.tolist() == [0, 3, 3, 5]
    assert hashes[0] == hashes[4] and hashes[1] == hashes[3] and len(set(hashes.tolist())) == 5


def test_the_temperature_lowers_the_loss():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 5))
    y = (x[:, 0] + rng.normal(size=600) > 0).astype(float)
    net = quality_model.train(x, y)
    assert np.mean((net.scores(x) >= 0.5) == y) > 0.75
    cold = quality_model.Network(net.centre, net.scale, net.first, net.second)
    aside = np.random.default_rng(quality_model.SEED).permutation(600)[:60]
    assert quality_model._loss(net.logits(x[aside]) / net.temperature, y[aside]) <= quality_model._loss(cold.logits(x[aside]), y[aside]) + 1e-9


# Toxicity


def patterns_of(text, stems=()):
    model = toxicity.ToxicityModel(dict.fromkeys(stems, True), 0.0, toxicity.prior_weights())
    return Counter({toxicity.PATTERNS[p]: n for p, n in model.patterns(text, model.lexicon()).items()})


def test_the_grammar_tells_what_is_meant():
    insult, threat = toxicity.INSULT, toxicity.THREAT
    assert patterns_of("You are an idiot.") == {(insult, 0, 0, 1): 1}
    assert patterns_of("an IDIOT, a moron; worthless") == {(insult, 0, 0, 0): 3}
    assert patterns_of("he is not an idiot") == {(insult, 1, 0, 1): 1}
    assert patterns_of("not one of those that say stupid things") == {(insult, 0, 1, 0): 1}
    assert patterns_of("she said you are an idiot. He is scum") == {(insult, 0, 1, 1): 1, (insult, 0, 0, 1): 1}
    assert patterns_of("I will kill them") == {(threat, 0, 0, 1): 1}
    assert patterns_of("the skill of a sidiot") == {}
    assert patterns_of("vrodnakish people", ["vrodnak"]) == {(insult, 0, 0, 1): 1}
    assert patterns_of("") == {} and patterns_of("idiot " * 3) == {(insult, 0, 0, 0): 3}


def test_composition_runs_all_machines_at_once():
    rng = random.Random(0)
    machines = (toxicity.MATCHER, toxicity.NEGATING, toxicity.REPORTING, toxicity.AIMING)
    for _ in range(200):
        states, joint = [m.start for m in machines], toxicity.GRAMMAR.start
        for symbol in rng.choices(toxicity.SYMBOLS, k=12):
            puts = [m.puts[s, symbol] for m, s in zip(machines, states)]
            states = [m.moves[s, symbol] for m, s in zip(machines, states)]
            assert toxicity.GRAMMAR.puts[joint, symbol] == puts[0] * 8 + puts[1] * 4 + puts[2] * 2 + puts[3]
            joint = toxicity.GRAMMAR.moves[joint, symbol]


def test_prior_weights_order_the_patterns():
    model = toxicity.ToxicityModel({}, toxicity.PRIOR, toxicity.prior_weights())
    texts = ["all is well", "he is not an idiot", "they said he is an idiot", "what an idiot", "you are an idiot"]
    scores = model.score(toxicity._counts(model, model.lexicon(), texts))
    assert scores[0] < 0.5 < scores[3] < scores[4] and scores[1] < 0.5 and scores[2] < scores[3]


def test_long_clauses_are_read_whole_and_once():
    insult, far = toxicity.INSULT, "word " * 200
    assert patterns_of(f"he said {far}idiot") == {(insult, 0, 1, 1): 1}
    assert patterns_of(f"idiot {far}you") == {(insult, 0, 0, 1): 1}
    assert patterns_of(f"skill {'a' * 394} idiot {'a' * 394} killer") == {(insult, 0, 0, 0): 1}
    assert patterns_of(f"skill {'ab ' * 131}ab idiot") == {(insult, 0, 0, 0): 1}
    for gap in range(60, 110):
        assert patterns_of(f"{'word ' * gap}idiot " * 12) == {(insult, 0, 0, 0): 12}
    assert patterns_of(f"you {far}, idiot, {far} you") == {(insult, 0, 0, 0): 1}


def test_learned_beginnings_are_those_of_the_toxic_words(spark):
    truth = {i: t for i, _, t in MARKS}
    marked = spark.createDataFrame([(r[1], truth[r[0]]) for r in ROWS if r[0] in truth], "text string, label int")
    stems = toxicity.learn_stems(marked)
    assert {s[:4] for s in stems} == {"skre", "vrod"} and all(stems.values())


def test_copies_of_a_toxic_text_do_not_make_its_words_insults(spark):
    rng = random.Random(9)
    clean = [(" ".join(f"{rng.choice('bcdfg')}{rng.randrange(10**6)}" for _ in range(30)), 0) for _ in range(60)]
    words = [f"zz{'abcdefghij'[i]}qq" for i in range(10)]
    copies = [(" ".join(words) + f" {i}", 1) for i in range(20)]
    assert toxicity.learn_stems(spark.createDataFrame(clean + copies, "text string, label int")) == {}


def test_drop_toxic_keeps_columns(spark):
    docs = with_clashes(documents(spark, ODD + [(99, "you are an idiot", "en", "s", 1)]))
    model = toxicity.ToxicityModel({}, toxicity.PRIOR, toxicity.prior_weights())
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r[0] for r in ODD}


# Language


def test_languages_are_told_apart(spark):
    docs = with_clashes(documents(spark, [*ROWS, *[(10_000 + r[0], r[1], None, *r[3:]) for r in ODD], (None, "no id", None, None, None)]))
    found = {r.doc_id: r for r in langid.identify(docs).collect()}
    truth = {r[0]: r[2] for r in ROWS}
    assert np.mean([found[i].lang_pred == truth[i] for i in truth if found[i].held_out]) > 0.98
    assert all(r.held_out == (i is not None and held(i, 4, 2)) and 0 <= r.score <= 1 for i, r in found.items())
    for r in ODD:
        letters = any(c.isalpha() for c in r[1] or "")
        assert (found[10_000 + r[0]].lang_pred == "und") == (not letters)
    assert {r.lang_pred for r in found.values()} == {"xx", "yy", "und"}


def test_nothing_to_learn_from(spark):
    found = langid.identify(documents(spark, [(1, "some text", None, "s", 1)])).collect()
    assert [(r.lang_pred, r.score) for r in found] == [("und", 0.0)]
    assert langid.identify(documents(spark, [])).count() == 0


def test_all_words_are_counted(spark):
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(odd_texts())]
    want = Counter(w for r in rows for w in langid.words_of(r[1] or ""))
    assert {(r.word): r.n for r in langid.word_counts(documents(spark, rows)).collect()} == want


def test_only_letters_make_words():
    assert langid.words_of("½ ² ① 12 _ !") == [] and langid.words_of("Ab½cd x² 日本_é") == ["ab", "cd", "x", "日本", "é"]


def test_a_text_without_letters_has_no_language(spark):
    learn = documents(spark, [*ROWS, (20_000, "½ ² ①", None, "s", 5), (20_001, "٣ 12 %", None, "s", 6)])
    found = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(learn).collect()}
    assert found[20_000] == found[20_001] == ("und", 0.0)


def brute_language(learn, texts):
    """lang_pred and score of each text, by dictionaries: known words, else the longest known sequence at each place."""
    langs = sorted({lang for lang, _ in learn})
    counts = [Counter() for _ in range(5)]
    for lang, text in learn:
        for word in re.findall("[a-zäß]+", text):
            counts[0][word, lang] += 1
            for n in range(1, 5):
                for at in range(len(word) - n + 1):
                    counts[n][word[at : at + n], lang] += 1
    units = [{u for u, _ in c} for c in counts]
    totals = [{lang: sum(k for (_, x), k in c.items() if x == lang) for lang in langs} for c in counts]

    def log(n, unit, lang):
        return math.log((counts[n][unit, lang] + 0.5) / (totals[n][lang] + 0.5 * (len(units[n]) + 1)))

    def read(word, lang):
        if word in units[0]:
            return log(0, word, lang)
        sums = 0.0
        for at in range(len(word)):
            n = next((n for n in (4, 3, 2, 1) if len(word) - at >= n and word[at : at + n] in units[n]), 1)
            sums += log(n, word[at : at + n], lang)
        return sums

    out = []
    for text in texts:
        words = re.findall("[a-zäß]+", text or "")
        if not words:
            out.append(("und", 0.0))
            continue
        scores = [sum(read(word, lang) for word in words) / math.sqrt(len(words)) for lang in langs]
        out.append((langs[scores.index(max(scores))], 1 / sum(math.exp(x - max(scores)) for x in scores)))
    return out


def test_every_counted_word_and_sequence_is_used(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 8)))
    prose = {lang: [word() for _ in range(150)] for lang in ("xx", "yy", "zz")}
    learn = [(lang, " ".join(rng.choices(prose[lang], k=40))) for lang, n in (("xx", 40), ("yy", 10), ("zz", 2)) for _ in range(n)]
    texts = [" ".join([*rng.choices(prose[rng.choice(sorted(prose))], k=9), word() + word(), "qä", "ß"]) for _ in range(30)]
    texts += [texts[0], "", None, "12", "qä"]
    docs = documents(spark, rows_of(*texts))
    for most in (3, 20_000):
        fitted = langid.fit(spark.createDataFrame(learn, "lang string, text string"), words=most)
        found = {r.doc_id: r for r in langid.predict(docs, fitted).collect()}
        assert len(found) == len(texts) and found[0][1:] == found[30][1:]
        for i, (lang, score) in enumerate(brute_language(learn, texts)):
            assert found[i].lang_pred == lang and found[i].score == pytest.approx(score, abs=1e-5)
