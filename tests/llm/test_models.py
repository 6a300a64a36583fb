"""Scoring, quality, toxicity: exact parts against brute force, learnt parts by held-out accuracy."""

import math
import random
import re
import statistics
import zlib
from collections import Counter

import numpy as np
import pytest

from folioquest.llm import common, quality, repeats, scoring, toxicity
from tests.llm.conftest import SCHEMA, extras_unchanged


def tokens(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(common.WORD, lowered), None]


def brute_level(n):
    return sum(n >= t for t in scoring.THRESHOLDS.tolist()[:40])


def brute_scores(rows, buckets):
    """base_score and score of every row from exact counts: what the filter holds, without its false positives; that pairs share a place is allowed for as the model does."""
    words, pairs = Counter(), Counter()
    every = [(r, tokens(r[1])) for r in rows]
    for r, own in every:
        if zlib.crc32(str(r[0]).encode()) % 10:
            words.update(own)
            pairs.update(zip([None, *own], own, strict=False))
    n, v = sum(words.values()), len(words)
    middle = lambda k: (scoring.THRESHOLDS[k - 1] + scoring.THRESHOLDS[k] - 1) / 2
    mass = sum(middle(brute_level(c)) for c in words.values())
    unknown = min(0.5, (sum(c == 1 for c in words.values()) + 1) / (n + 2))
    chance = v * len(pairs) / buckets / 2**40
    out = []
    for r, own in every:
        score = 0.0
        for h, w in zip([None, *own], own, strict=False):
            alone = (1 - unknown) * middle(brute_level(words[w])) / mass if words[w] else unknown
            seen = int(scoring.THRESHOLDS[brute_level(words[h])]) - 1 if words[h] else 0
            pair = int(scoring.THRESHOLDS[brute_level(pairs[h, w]) - 1]) if pairs[h, w] else 0
            share = scoring.PAIR_SHARE * seen / (seen + scoring.PAIR_SEEN)
            score += math.log10((1 - share) * alone + share * min(pair, seen) / max(seen + chance, 1))
        base = sum(math.log10((words[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        out.append((r[0], zlib.crc32(str(r[0]).encode()) % 10 == 0, len(own), sum(words[w] > 0 for w in own), n, base, score))
    return out


@pytest.mark.parametrize("block", [4 << 20, 3000])
def test_scores_against_brute_force(spark, folder, rows, monkeypatch, block):
    monkeypatch.setattr(repeats, "BLOCK_BYTES", block)
    monkeypatch.setattr(scoring, "BUCKET_BYTES", 2 * block)
    got = sorted(tuple(r) for r in scoring.op5_lm_score(spark, folder).collect())
    buckets = repeats.buckets(sum(len((r[1] or "").encode()) for r in rows), scoring.BUCKET_BYTES)
    for a, b in zip(got, sorted(brute_scores(rows, buckets)), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5]) and a[6] == pytest.approx(b[6], rel=1e-6)


def test_pair_model_predicts_better_than_the_base(spark):
    rng = random.Random(1)
    follow = {w: rng.sample(range(300), 3) for w in range(300)}
    rows = []
    for k in range(300):
        w, out = rng.randrange(300), []
        for _ in range(60):
            out.append(f"w{w}" if rng.random() > 0.02 else f"new{rng.random()}")
            w = rng.choice(follow[w])
        rows.append((k, " ".join(out), "en", "s", 0))
    got = [r for r in scoring.score(spark.createDataFrame(rows, SCHEMA)).collect() if zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0]
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got) * 0.9


def test_slices_read_back_levels():
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(0, 1 << 40, 9000, dtype=np.uint64))
    n = rng.integers(1, 5000, len(keys))
    own = scoring.Slice.fill(keys, n)
    assert (own.level(keys) == scoring.levels(n)).all()
    assert scoring.levels(np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 11, 12, 16])).tolist() == [0, 1, 2, 3, 4, 4, 5, 5, 6, 6, 7, 8]
    other = rng.integers(0, 1 << 40, 200_000, dtype=np.uint64)
    assert (own.level(other[~np.isin(other, keys)]) > 0).sum() == 0 and (own.bits.mean() ** scoring.PROBES) < 1e-8


@pytest.mark.parametrize("bits_an_entry", [0.01, 1, 4])
def test_full_and_nearly_full_slices(bits_an_entry):
    """Reading ends at the highest level entered, entries are still found, and scores stay finite shares."""
    rng = np.random.default_rng(3)
    keys, n = np.unique(rng.integers(0, 1 << 40, 2000, dtype=np.uint64)), 9
    own = scoring.Slice.fill(keys, np.full(len(keys), n), bits_an_entry)
    level = own.level(np.append(keys, rng.integers(0, 1 << 40, 2000, dtype=np.uint64)))
    assert (level[: len(keys)] == scoring.levels(np.array([n]))[0]).all() and level.max() == own.top
    false = float(own.bits.mean() ** scoring.PROBES)
    for distinct in (10, 10**6, 10**12):
        shares = scoring.Shares(10**13, distinct, distinct // 2, float(scoring.MIDDLE[60]) + 5.0 * distinct, false)
        p = shares.score(np.arange(80) % 60, np.arange(80) % 50, np.arange(80) % 40)
        assert np.isfinite(p).all() and (p <= 0).all()


def test_shares_of_successors_add_up_to_one_at_most():
    rng = np.random.default_rng(4)
    for _ in range(50):
        pairs = rng.integers(1, 400, rng.integers(1, 30))
        shares = scoring.Shares(10_000, 30, 3, 9000.0, 0.0)
        words = np.full(len(pairs), 1)
        before = scoring.levels(np.full(len(pairs), pairs.sum()))
        alone = 10 ** shares.score(words, before, np.zeros(len(pairs), int))
        assert (10 ** shares.score(words, before, scoring.levels(pairs)) - alone).sum() <= scoring.PAIR_SHARE


def test_scores_without_training_rows(spark, empty):
    assert scoring.score(empty).count() == 0
    held = next(k for k in range(1000) if zlib.crc32(str(k).encode()) % 10 == 0)
    r = scoring.score(spark.createDataFrame([(held, "a b", "en", "s", 3)], SCHEMA)).first()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) == (3, 0, 0, 0.0) and math.isfinite(r["score"])


def test_models_take_very_long_texts(spark):
    text = " ".join(f"w{k % 7919}" for k in range(400_000))
    docs = spark.createDataFrame([(1, text, "en", "s", 0), (2, "short text", "en", "s", 0)], SCHEMA)
    assert {r["doc_id"]: r["n_tokens"] for r in scoring.score(docs).collect()} == {1: 400_001, 2: 3}
    assert quality.judge(docs).count() == 2
    assert toxicity.score_documents(docs, toxicity.Model(0.0, {b"w": 1.0})).count() == 2


def brute_base(text):
    words = re.findall(common.WORD, text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    repeated = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(common.WORD, line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), dup, len(repeated)


def test_quality_base_rules(spark, folder, rows):
    got = sorted(tuple(r)[:7] for r in quality.op6_quality_rules(spark, folder).collect())
    want = []
    for r in rows:
        f = brute_base(r[1] or "")
        want.append((r[0], *f, f[0] < 10 or 100 * f[4] > 20 * f[0]))
    assert got == sorted(want)


def test_kept_never_where_base_failed(spark, folder):
    assert all(not (r["base_failed"] and r["kept"]) for r in quality.op6_quality_rules(spark, folder).collect())


def model_of(texts):
    code, n = np.unique(np.concatenate([c for t in texts for c in quality.codes(t)]), return_counts=True)
    return quality.estimate(np.zeros(len(code), int), code, n)


def test_kneser_ney_sums_to_one():
    rng = random.Random(3)
    model = model_of(["".join(rng.choice("abcde .") for _ in range(4000)) for _ in range(2)])
    for context in (0, 1 << 6, rng.randrange(1 << 18), *[int(c) >> 6 for c in next(quality.codes("abc de."))]):
        p = 10.0 ** model.log10(0, (context << 6) + np.arange(64))
        assert p.sum() == pytest.approx(1, abs=1e-4)


class BruteKneserNey:
    """Interpolated modified Kneser-Ney over tuples of symbols, by its formulas."""

    def __init__(self, strings):
        self.counts = {4: Counter(tuple(s[i : i + 4]) for s in strings for i in range(len(s) - 3))}
        for order in (3, 2, 1):
            self.counts[order] = Counter(g[1:] for g in self.counts[order + 1])
        self.discount, self.total, self.kinds = {}, {}, {}
        for order, counts in self.counts.items():
            n = Counter(counts.values())
            y = n[1] / (n[1] + 2 * n[2]) if n[1] + n[2] else 0.5
            self.discount[order] = [0.0, *[min(max(k - (k + 1) * y * n[k + 1] / n[k], 0.05), k - 0.05) if n[k] else 0.5 for k in (1, 2, 3)]]
            for g, c in counts.items():
                self.total[g[:-1], order] = self.total.get((g[:-1], order), 0) + c
                self.kinds[g[:-1], order] = self.kinds.get((g[:-1], order), 0.0) + self.discount[order][min(c, 3)]

    def p(self, gram):
        order = len(gram)
        if not order:
            return 1 / 64
        total = self.total.get((gram[:-1], order))
        if not total:
            return self.p(gram[1:])
        c = self.counts[order][gram]
        return (c - self.discount[order][min(c, 3)]) / total + self.kinds[gram[:-1], order] / total * self.p(gram[1:])


def symbols_of(text):
    return (quality.SPACE,) * 3 + tuple(int(x) for x in quality.symbols(text))


def brute_log_perplexity(model, text):
    s = symbols_of(text)
    return -sum(math.log(model.p(s[i : i + 4])) for i in range(len(text))) / len(text) if text else 0.0


def test_perplexity_is_brute_force():
    texts = ["Ab c1, déf  gh.", "жил был *кот* — 漢字漢字", "ab ab ab abc\nabd", "$$$ %%% &&"]
    model, brute = model_of(texts * 2 + texts[:1]), BruteKneserNey([symbols_of(t) for t in texts * 2 + texts[:1]])
    for t in (*texts, "something unseen ж漢", ""):
        assert model.perplexity_logs(0, [t, "x"])[0] == pytest.approx(brute_log_perplexity(brute, t), rel=1e-5)


def test_pieces_of_texts_change_nothing(monkeypatch):
    texts = ["some words and жил был " * 9, "", "x", "more " * 40]
    want, model = np.concatenate([c for t in texts for c in quality.codes(t)]), model_of(texts)
    logs = model.perplexity_logs(0, texts)
    monkeypatch.setattr(quality, "PIECE", 7)
    assert (np.concatenate([c for t in texts for c in quality.codes(t)]) == want).all()
    assert np.allclose(model.perplexity_logs(0, texts), logs)


@pytest.mark.parametrize("most", [quality.MODEL_GRAMS, 1])
def test_kept_against_brute_force(spark, rows, most):
    """Verdicts from models of the other fold's clean texts and bands of each language, over the rows and some prose and noise."""
    rng = random.Random(8)
    stock = ["".join(rng.choice("aeinrst") for _ in range(rng.randrange(2, 9))) for _ in range(300)]
    more = [(1000 + k, " ".join(rng.choice(stock) for _ in range(60)), ("en", "de")[k % 2], "s", 0) for k in range(60)]
    more += [(2000 + k, " ".join("".join(rng.choice("qxzwk$") for _ in range(6)) for _ in range(40)), "en", "s", 0) for k in range(3)]
    table = [*rows, *more]
    got = sorted((r["doc_id"], r["kept"]) for r in quality.judge(spark.createDataFrame(table, SCHEMA), most).collect())
    clean = lambda t: 50 * len(re.findall("[#*$%&|<>]", t)) <= len(t)
    fold = lambda i: zlib.crc32(str(i).encode()) % 2
    models = {(lang, f): BruteKneserNey([symbols_of(r[1] or "") for r in table if (r[2] or "") == lang and fold(r[0]) == f and clean(r[1] or "")]) for lang in ("", "en", "de") for f in (0, 1)}
    seen = []
    for r in table:
        t, lang = r[1] or "", r[2] or ""
        f = brute_base(t)
        seen.append((r[0], lang, len(t), f[0] < 10 or 100 * f[4] > 20 * f[0], brute_log_perplexity(models[lang, 1 - fold(r[0])], t)))
    want = []
    for lang in ("", "en", "de"):
        good = [x[4] for x in seen if x[1] == lang and not x[3]]
        middle = statistics.median(good)
        spread = max(statistics.median(abs(x - middle) for x in good), 0.01)
        for doc_id, own, n, failed, log in seen:
            if own == lang:
                width = spread * math.sqrt(1 + 200 / max(n, 1))
                # what lies at an edge within rounding is left open
                edge = min(abs(log - (middle - 8 * width)), abs(log - (middle + 15 * width))) < 0.01
                want.append((doc_id, not failed and middle - 8 * width <= log <= middle + 15 * width, edge))
    for (a, kept), (b, expected, edge) in zip(got, sorted(want), strict=True):
        assert a == b and (kept == expected or edge)
    assert not any(kept for k, kept in got if k >= 2000)


@pytest.mark.parametrize("letters", ["aeinrstlm", "аеинрстлмо", "的一是不了人我在有他"])
def test_quality_rejects_noise_and_keeps_prose(spark, letters):
    """Junk in Latin and other scripts is told from prose in the same script."""
    rng = random.Random(4)
    stock = ["".join(rng.choice(letters) for _ in range(rng.randrange(2, 9))) for _ in range(100)]
    prose = [" ".join(rng.choice(stock) for _ in range(120)) + "." for _ in range(200)]
    signs = [" ".join(w + rng.choice(("$$$", "***", "%%%")) for w in t.split()) for t in prose[:3]]
    noise = ["".join(rng.choice(letters + "0|.") if k % 7 else " " for k in range(600)) for _ in range(3)]
    rows = [(k, t, "xx", "s", len(t)) for k, t in enumerate(prose + signs + noise)]
    kept = {r["doc_id"]: r["kept"] for r in quality.judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert sum(kept[k] for k in range(200)) >= 198 and not any(kept[k] for k in range(200, 206))


@pytest.mark.parametrize("n_clean", [0, 40])
def test_quality_learns_markup_where_few_texts_are_clean(spark, n_clean):
    """A language of tables has models of its tables: noise in their cells is rejected."""
    rng = random.Random(5)
    stock = ["".join(rng.choice("aeinrstlm") for _ in range(rng.randrange(2, 9))) for _ in range(100)]
    table = lambda cell: "\n".join(f"| {' | '.join(cell() for _ in range(4))} |" for _ in range(30))
    tables = [table(lambda: rng.choice(stock)) for _ in range(200)]
    noise = [table(lambda: "".join(rng.choice("qxzwkvjy0") for _ in range(5))) for _ in range(6)]
    prose = [" ".join(rng.choice(stock) for _ in range(120)) + "." for _ in range(n_clean)]
    assert not any(map(quality.is_clean, tables + noise)) and all(map(quality.is_clean, prose))
    rows = [(k, t, "tables", "s", len(t)) for k, t in enumerate(tables + noise + prose + [""] * 300)]
    kept = {r["doc_id"]: r["kept"] for r in quality.judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert sum(kept[k] for k in range(200)) >= 198 and not any(kept[k] for k in range(200, 206))


@pytest.mark.parametrize("piece", [quality.PIECE, 50])
def test_all_texts_are_counted(spark, monkeypatch, piece):
    """4-grams of all texts and of the clean ones against brute force; a language with few clean ones learns from all."""
    monkeypatch.setattr(quality, "PIECE", piece)
    texts = ["prose of words " * 8, "more of it " * 9, "#$% signs *** " * 7, ""]
    rows = [(t, lang, fold) for fold in (0, 1) for lang, own in (("p", (0, 0, 1, 2, 3)), ("q", (0, 2, 2, 3))) for t in (texts[k] for k in own)]
    want, clean = Counter(), Counter()
    for t, lang, fold in rows:
        for code in [*np.concatenate([np.zeros(0, int), *quality.codes(t)]).tolist(), *[quality.TEXTS] * bool(t)]:
            want["pq".index(lang) * 2 + fold, code] += 1
            clean["pq".index(lang) * 2 + fold, code] += "$" not in t
    counts = quality.count_grams(spark.createDataFrame(rows, "text string, lang string, fold int").repartition(3), {"p": 0, "q": 1})
    assert {(r["slot"], r["code"]): (r["n"], r["n_clean"]) for r in counts.collect()} == {k: (n, clean[k]) for k, n in want.items()}
    learnt = {(r["slot"], r["code"]): r["n"] for r in quality.learnt(counts).collect()}
    assert learnt == {k: n for k in want if k[1] != quality.TEXTS and (n := clean[k] if k[0] < 2 else want[k])}


def test_quality_without_languages(spark):
    docs = spark.createDataFrame([(k, f"the same {k} words in a text of more than ten words {k}") for k in range(20)], "doc_id long, text string")
    assert quality.judge(docs).where("kept").count() == 20


def toxic_corpus(seed=6, n=600):
    rng = random.Random(seed)
    stock = ["".join(rng.choice("aeinrstlm") for _ in range(rng.randrange(3, 9))) for _ in range(900)]
    rows, labels = [], []
    for k in range(n):
        words = [rng.choice(stock) for _ in range(rng.randrange(20, 150))]
        toxic = k % 8 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["grobian", "schuft", "lump"]))
        rows.append((k, " ".join(words), "en", "s", 0))
        labels.append((k, int(toxic)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark):
    rows, labels = toxic_corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    score = {r["doc_id"]: r["score"] for r in toxicity.score_documents(docs, model).collect()}
    held = [k for k, _ in labels if zlib.crc32(str(k).encode()) % 3 == 1]
    toxic = [k for k in held if k % 8 == 0]
    assert sum(score[k] >= 0.7 for k in toxic) >= 0.9 * len(toxic)
    assert sum(score[k] >= 0.7 for k in held if k % 8) == 0
    assert all(0 <= s <= 1 for s in score.values())
    left = {r["doc_id"] for r in toxicity.reject(docs, model).collect()}
    assert left == {k for k, s in score.items() if s < 0.7}


def test_labels_of_held_out_rows_change_nothing(spark):
    rows, labels = toxic_corpus(n=200)
    docs = spark.createDataFrame(rows, SCHEMA)
    turned = [(k, 1 - t if zlib.crc32(str(k).encode()) % 3 == 1 else t) for k, t in labels]
    a, b = (toxicity.fit(docs, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (labels, turned))
    assert a.bias == b.bias and a.weights == b.weights


def test_non_negative_risk_turns_round():
    """With a prior far above the share of positives the corrected risk goes below zero; training still ends with finite weights."""
    data = toxicity.Rows(np.arange(40), np.arange(40) % 4, (np.arange(40) % 4 == 0).astype(float), np.ones(40))
    bias, weights = toxicity.train(data, 4, 0.9)
    assert np.isfinite(bias) and np.isfinite(weights).all() and weights[0] >= weights[1:].max()


def test_weights_are_repeated_rows():
    data = toxicity.Rows(np.arange(30), np.arange(30) % 5, (np.arange(30) % 5 == 0).astype(float), np.ones(30))
    folded = toxicity.Rows(np.arange(5), np.arange(5), np.array([6.0, 0, 0, 0, 0]), np.full(5, 6.0))
    (a, v), (b, w) = (toxicity.train(x, 5, 0.2) for x in (data, folded))
    assert a == pytest.approx(b) and np.allclose(v, w)


def test_rows_without_labels_are_in_the_unlabelled_set(spark):
    rows, labels = toxic_corpus(n=300)
    docs = spark.createDataFrame(rows, SCHEMA)
    few = spark.createDataFrame([x for x in labels if x[1]], "doc_id long, toxic int")
    drawn = toxicity.training_rows(docs, few).where("drawn").count()
    assert drawn == sum(zlib.crc32(str(k).encode()) % 3 != 1 for k in range(300))
    model = toxicity.fit(docs, few)
    score = {r["doc_id"]: r["score"] for r in toxicity.score_documents(docs, model).collect()}
    held = [k for k in range(300) if zlib.crc32(str(k).encode()) % 3 == 1]
    assert sum(score[k] >= 0.7 for k in held if k % 8 == 0) >= 0.8 * sum(k % 8 == 0 for k in held)
    assert sum(score[k] >= 0.7 for k in held if k % 8) == 0


def test_the_prior_is_estimated_without_negatives():
    rng = np.random.default_rng(7)
    n, toxic = 4000, np.arange(4000) % 10 == 0
    confirmed = toxic & (rng.random(n) < 0.5)
    z = np.where(toxic, rng.normal(4, 1, n), rng.normal(0, 1, n))
    data = toxicity.Rows(np.zeros(0, int), np.zeros(0, int), confirmed.astype(float), np.ones(n))
    assert 0.08 < toxicity.estimated_prior(z, data) < 0.13


def test_a_table_of_toxic_rows_alone(spark):
    docs = spark.createDataFrame([(k, f"word{k} lump", "en", "s", 0) for k in range(30)], SCHEMA)
    model = toxicity.fit(docs, spark.createDataFrame([(k, 1) for k in range(30)], "doc_id long, toxic int"))
    assert toxicity.reject(docs, model).count() == 30


def test_repeats_of_a_labelled_row_are_one_row_of_the_matrix(spark):
    rows, labels = toxic_corpus(n=200)
    docs = spark.createDataFrame(rows + rows[8:9] * 3000, SCHEMA)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert model.weights and all(math.isfinite(w) for w in model.weights.values())


def test_toxicity_edge_tables(spark, empty, clashing):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(clashing, none)
    assert toxicity.score_documents(clashing, model).count() == 13
    left = toxicity.reject(clashing, model)
    assert left.columns == clashing.columns and left.count() == 13 and extras_unchanged(left.collect())
    assert toxicity.score_documents(empty, toxicity.fit(empty, none)).count() == 0


def test_models_take_empty_and_clashing_tables(empty, clashing):
    assert quality.judge(empty).count() == 0 and quality.judge(clashing).count() == 13
    assert scoring.score(clashing).count() == 13
