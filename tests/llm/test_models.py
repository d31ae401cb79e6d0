"""Fingerprints, fitted models and the mixture: brute force where there is one answer, held-out accuracy elsewhere."""

import math
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tallyframe.llm import imatch, kneser_ney, langid, mixing, toxicity
from tallyframe.llm.scratch import Scratch


def key(row):
    return (row["doc_id"] is None, row["doc_id"] or 0, row["text"] or "")


# --- fingerprints ------------------------------------------------------------


@pytest.fixture(scope="module")
def printed(spark, odd):
    return [r.asDict() for r in imatch.fingerprints(spark, odd).collect()]


def chained(rows):
    """(doc_id, text, edited, next) of all rows, each edited with the row that follows by descending id."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    out = []
    for i, (doc, text) in enumerate(rows):
        following, half = rows[(i + 1) % len(rows)][1], len(text) // 2
        out.append((doc, text, text[: len(text) - half] + following[:half], following))
    return out


def test_edited_texts_follow_descending_ids(printed, odd):
    expected = [(doc, len(text), brute.sha(edited)) for doc, text, edited, _ in chained((r.doc_id, r.text) for r in odd.collect())]
    assert sorted(expected, key=str) == sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in printed), key=str)


def test_equal_texts_have_equal_fingerprints(printed, odd):
    own = defaultdict(set)
    for r in printed:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        own[r["edited_sha256"], "edited"].add(r["edited_fingerprint"])
    for doc, text, edited, _ in chained((r.doc_id, r.text) for r in odd.collect()):
        if doc is not None:
            for r in printed:
                if r["doc_id"] == doc and r["n_chars"] == len(text):
                    own[text].add(r["fingerprint"])
                    if edited == text:
                        assert r["fingerprint"] == r["edited_fingerprint"] and r["near_edited"] == 1
    assert all(len(p) == 1 for p in own.values())


def test_fingerprint_by_hand(spark, odd, printed):
    """The parts of a text are hashes of its sorted lexicon terms in them."""
    import re

    n_docs = odd.count()
    df = Counter(t for r in odd.collect() for t in set(re.findall(brute.LETTER, brute.lower(r.text))))
    low, high = max(1.0, imatch.BAND[0] * n_docs), max(1.0, imatch.BAND[1] * n_docs)
    text = next(r.text for r in odd.collect() if r.doc_id == 10)
    terms = [t for t in set(re.findall(brute.LETTER, brute.lower(text))) if low <= df[t] <= high]
    assert terms
    frame = spark.createDataFrame([(t,) for t in terms], "t string").select(F.xxhash64("t").alias("term"))
    parts = defaultdict(list)
    for draw, zeros in enumerate(imatch.DRAWS):
        for r in frame.select("term", F.xxhash64("term", F.lit("draw")).alias("d"), F.xxhash64("term", F.lit(draw)).alias("p")).collect():
            if r.d % (1 << zeros) == 0:
                parts[r.p % imatch.PARTS + draw * imatch.PARTS].append(r.term)
    own = next(r["fingerprint"] for r in printed if r["doc_id"] == 10)
    used = {i // 4 for i in range(0, len(own), 4) if own[i : i + 4] != "0000"}
    assert used == set(parts)


def test_ranges_cut_any_ids(spark, monkeypatch):
    monkeypatch.setattr(imatch, "RANGES", 7)
    ids = [5, 9, -3, 10**15, 44, 45, 46, 47, 100, 12, 13]
    docs = spark.createDataFrame([(i, f"text {i} {i * 3}") for i in ids], "doc_id long, text string")
    expected = {i: brute.sha(edited) for i, _, edited, _ in chained((i, f"text {i} {i * 3}") for i in ids)}
    assert {r.doc_id: r.edited_sha256 for r in imatch.fingerprints(spark, docs).collect()} == expected


def test_edits_stay_nearer_than_other_documents(spark, sf):
    rows = entry.queries()["op4_fingerprints"](spark, sf).collect()
    assert np.mean([r.near_edited > r.near_next for r in rows]) > 0.9


def test_copies_and_rare_words_keep_their_fingerprints(spark, monkeypatch):
    copied = " ".join(f"c{i}" for i in range(40))
    texts = [copied] * 20 + [f"own{i} word{i} text{i % 7}" for i in range(30)] + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for limit in (imatch.BROADCAST_TEXTS, 0):
        monkeypatch.setattr(imatch, "BROADCAST_TEXTS", limit)
        terms = {r.term for r in imatch.lexicon(docs, Scratch(spark, "test"), (0.0, 0.05)).collect()}
        wanted = [f"c{i}" for i in range(40)]
        assert terms >= {r.t for r in spark.createDataFrame([(w,) for w in wanted], "w string").select(F.xxhash64("w").alias("t")).collect()}
    # none of these terms is in the lexicon: equal sets of terms alone are alike
    alone = spark.createDataFrame([(5, "a b c"), (4, "c B a a"), (3, "d e f"), (2, ""), (1, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in imatch.fingerprints(spark, alone, (0.9, 1.0)).collect()}
    assert rows[5].near_next == 1 and rows[4].near_next < 0.1 and rows[3].near_next == 0 and rows[2].near_next == 1
    assert not rows[2].fingerprint.strip("0") and rows[3].fingerprint.strip("0")


def test_small_edits_of_long_texts_leave_most_parts(spark):
    long = [f"w{i}" for i in range(4000)]
    texts = [long, [*long[:-10], *(f"v{i}" for i in range(10))]]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = imatch.fingerprints(spark, docs, (0.0, 1.0)).collect()
    # a draw of every 64th term leaves all but a few parts of it as they are
    assert all(len(r.fingerprint) == 4 * 192 and r.near_next > 0.8 for r in rows)


def test_fingerprints_of_nothing(spark, nothing):
    assert imatch.fingerprints(spark, nothing).count() == 0


def test_fingerprint_plan_is_native(spark, sf):
    plan = entry.queries()["op4_fingerprints"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"))


# --- language ------------------------------------------------------------------


def test_bundle_equals_the_sum_over_letters():
    text = "Abé c!"
    codes = [ord(c) for c in " abé c "]
    vectors = {c: langid._letter_vectors(np.array([c]))[0].astype(int) for c in codes}
    expected = sum(np.roll(vectors[a], 2) * np.roll(vectors[b], 1) * vectors[c] for a, b, c in zip(codes, codes[1:], codes[2:]))
    found = langid.bundles([None, text, "?! 12", "x" * 100_000])
    assert (found[1] == expected).all() and not found[0].any() and not found[2].any() and found[3].any()


def test_languages_of_held_out_documents(spark):
    found = entry.queries()["op6_language"](spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = found.join(truth, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang_pred == r.lang for r in rows if r.held_out]) > 0.97


def test_language_of_odd_rows(spark, odd, nothing):
    rows = langid.identify(spark, odd).collect()
    assert len(rows) == odd.count()
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in rows if not any(c.isalpha() for c in r.row.text or ""))
    assert langid.identify(spark, nothing).count() == 0
    assert {r.lang_pred for r in langid.predict(spark, odd, {}).collect()} == {"und"}


# --- quality -------------------------------------------------------------------


def plain_model(texts, order):
    """Interpolated modified Kneser-Ney with dictionaries: a function of (context, character)."""
    counts = {order: Counter()}
    for text in texts:
        padded = "\n" * (order - 1) + text
        for i in range(len(text)):
            counts[order][padded[i : i + order]] += 1
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    tables = {}
    for n, own in counts.items():
        of = Counter(own.values())
        y = of[1] / (of[1] + 2 * of[2]) if of[1] else 0
        d = [0] + [min(max(k - (k + 1) * y * of[k + 1] / of[k] if of[k] else 0, 0), k) for k in (1, 2, 3)]
        total, left = Counter(), Counter()
        for g, c in own.items():
            total[g[:-1]] += c
            left[g[:-1]] += d[min(c, 3)]
        tables[n] = own, d, total, left

    def p(context, char):
        own, d, total, left = tables[len(context) + 1]
        below = p(context[1:], char) if context else 1 / (len(counts[1]) + 1)
        if context not in total:
            return below if context else 1 / (len(counts[1]) + 1)
        c = own[context + char]
        return (c - d[min(c, 3)] if c else 0) / total[context] + left[context] / total[context] * below

    return p


def test_bits_equal_a_plain_model(spark, monkeypatch):
    monkeypatch.setattr("tallyframe.llm.groups.GROUP_BYTES", 200)
    trusted = ["the cat sat on the mat. the hat.", "a cat and a rat at the mat", "mat hat cat rat sat", "then that thin thing thought", "o"]
    texts = [*trusted, "the dog 一 sat", "zzzz", "", None]
    model, rest = kneser_ney.fit(spark.createDataFrame([(t,) for t in trusted], "text string"), Scratch(spark, "test"))
    docs = spark.createDataFrame([(i, "en", t) for i, t in enumerate(texts)], "doc_id long, lang string, text string")
    found = {r.doc_id: r.bits for r in kneser_ney.scored(spark, docs, model, rest).collect()}
    p = plain_model(trusted, kneser_ney.ORDER)
    for i, text in enumerate(texts):
        if not text:
            assert found[i] is None
            continue
        padded = "\n" * (kneser_ney.ORDER - 1) + text
        bits = -sum(math.log2(p(padded[j : j + kneser_ney.ORDER - 1], padded[j + kneser_ney.ORDER - 1])) for j in range(len(text)))
        assert found[i] == pytest.approx(bits / len(text), abs=1e-9)
    alphabet = sorted({c for t in trusted for c in t})
    assert sum(p("the", c) for c in alphabet) + p("the", "一") == pytest.approx(1)


def test_quality_keeps_trusted_text_and_finds_junk_of_each_kind(spark):
    def kind(text):
        words = text.split()
        return "repeated" if len(words) > 5 and len(set(words)) < 0.35 * len(words) else "other"

    rows = entry.queries()["op7_quality"](spark, "/root/testdata/sf0.1")
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    marked = rows.join(labels, "doc_id").join(docs.select("doc_id", "text"), "doc_id").collect()
    assert np.mean([r.kept for r in marked if r.quality == 1]) > 0.97
    for one, least in (("repeated", 0.9), ("other", 0.97)):
        found = [not r.kept for r in marked if r.quality == 0 and kind(r.text) == one]
        assert len(found) > 200 and np.mean(found) >= least


def test_quality_of_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (3, 1), (9, 0), (None, 1), (77, None)], "doc_id long, quality int")
    rows = kneser_ney.quality(spark, odd, labels).collect()
    assert len(rows) == odd.count()
    assert all(r.kept and r.perplexity is None for r in rows if not r.n_chars)
    assert kneser_ney.quality(spark, nothing, labels).count() == 0
    untrusted = kneser_ney.quality(spark, odd, labels.limit(0)).collect()
    assert all(r.kept and r.threshold is None for r in untrusted)


# --- mixture ---------------------------------------------------------------------


def test_targets_share_by_weight_below_the_cap():
    assert mixing.targets([("a", 100), ("b", 100), ("c", 100)]) == {"a": 187.5, "b": 75.0, "c": 37.5}
    capped = mixing.targets([("a", 10), ("b", 1000), (None, 90)])
    # a stops at 30; the rest by 2 to 1 would give the last 357 of its 270
    assert capped == {"a": 30.0, None: 270.0, "b": 800.0}
    assert mixing.targets([("a", 0), ("b", 0)]) == {"a": 0.0, "b": 0.0}
    assert mixing.targets([]) == {}
    assert list(mixing.targets([("é", 9), (None, 9), ("z", 9), ("Z", 9)])) is not None


@pytest.mark.parametrize("block", [2_000, 4])
def test_mixture_meets_its_targets(spark, sf, monkeypatch, block):
    monkeypatch.setattr(mixing, "BLOCK", block)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = mixing.mix(spark, docs).collect()
    again = mixing.mix(spark, docs.repartition(5)).collect()
    assert sorted((r.doc_id, r.copies) for r in rows) == sorted((r.doc_id, r.copies) for r in again)
    assert {r.doc_id: r.size for r in rows} == {r.doc_id: len(brute.SPACE.findall(r.text or "")) for r in docs.collect()}
    by_source = defaultdict(list)
    for r in rows:
        assert r.taken == r.size * r.copies <= 3 * r.size
        by_source[r.row.source].append(r)
    for own in by_source.values():
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own)
        assert own[0].source_size == sum(r.size for r in own)
    weights = dict(zip(sorted(by_source), (5, 2, 1) * 99))
    total = sum(r.size for r in rows)
    assert sum(own[0].target for own in by_source.values()) == pytest.approx(total)
    free = [s for s, own in by_source.items() if own[0].target < 2.99 * own[0].source_size]
    per_weight = [by_source[s][0].target / weights[s] for s in free]
    assert max(per_weight) == pytest.approx(min(per_weight))


def test_rounding_keeps_words_and_is_fair():
    import random

    taken = Counter()
    sizes = [random.Random(i).randrange(1, 50) for i in range(9)]
    for seed in range(3000):
        done, left = mixing._meet(((i, n, 0.3) for i, n in enumerate(sizes)), str(seed))
        words = sum(sizes[i] for i, one in done.items() if one) + (sizes[left[0]] * left[1] if left else 0)
        assert words == pytest.approx(0.3 * sum(sizes))
        taken.update({i: one for i, one in done.items()})
        if left:
            taken[left[0]] += left[1]
    assert all(taken[i] / 3000 == pytest.approx(0.3, abs=0.04) for i in range(9))


def test_mixture_of_odd_rows(spark, odd, nothing):
    rows = mixing.mix(spark, odd).collect()
    assert len(rows) == odd.count() and all(r.taken == 0 for r in rows if not r.size)
    twins = defaultdict(set)
    for r in rows:
        twins[r.doc_id, r.row.source, r.size].add(r.copies)
    assert all(len(c) == 1 for c in twins.values())
    assert mixing.mix(spark, nothing).count() == 0


# --- toxicity ----------------------------------------------------------------------


def test_gradients_equal_differences():
    rng = np.random.Generator(np.random.PCG64(0))
    texts = toxicity.slots(pa.array(["some words of a text that repeat words", "other words"]))
    net = toxicity.fit(texts, np.array([1.0, 0.0]))
    net = toxicity.Net(*[[k.astype(np.float64) for k in p] if isinstance(p, list) else p.astype(np.float64) for p in net])
    net.table[:] += rng.normal(size=net.table.shape) * 0.1
    net.table[0] = 0

    def loss():
        z = float(np.maximum(toxicity._pooled(net, texts[0])[0].astype(np.float64), 0) @ net.weights + net.bias[0])
        return math.log1p(math.exp(-z))

    grads = [np.zeros_like(p) for p in net.parameters()[1:]]
    ids, values = toxicity._gradients(net, texts[0], 1.0, 1.0, grads)
    for p, g in zip(net.parameters()[1:], grads):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, step = p[at], 1e-2
        p[at] = old + step
        up = loss()
        p[at] = old - step
        down = loss()
        p[at] = old
        assert (up - down) / (2 * step) == pytest.approx(g[at], rel=0.1, abs=1e-3)
    assert len(ids) == len(values)


def test_toxicity_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    found = entry.queries()["op10_toxicity"](spark, sf)
    rows = found.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    out = [r for r in rows if r.held_out]
    ranks = np.argsort(np.argsort([r.score for r in out]))
    ones = np.array([r.toxic == 1 for r in out])
    auc = (ranks[ones].mean() - (ones.sum() - 1) / 2) / (~ones).sum()
    assert auc > 0.9
    assert np.mean([r.predicted for r in out if r.toxic == 0]) < 0.01


def test_toxicity_of_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 10)] + [(None, 1), (3, 1), (8, None), (9, 7)], "doc_id long, toxic int")
    model = toxicity.train(spark, odd, labels)
    rows = toxicity.score(spark, odd, model).collect()
    assert len(rows) == odd.count()
    scores = defaultdict(set)
    for r in rows:
        scores[r.row.text or ""].add(r.score)
    assert all(len(s) == 1 for s in scores.values())
    assert toxicity.score(spark, nothing, model).count() == 0
    empty = toxicity.train(spark, nothing, labels)
    assert len(toxicity.score(spark, odd, empty).collect()) == odd.count()


def test_thresholds_cover_rows_beyond_the_sample(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "THRESHOLD", 0.0)
    monkeypatch.setattr(toxicity, "FALSE_SHARE", 0.1)
    docs = [(i, " ".join(f"w{i * j * j % 97}" for j in range(1, 9)), "en" if i % 4 else "es") for i in range(1500)]
    labels = [(i, int(i % 5 == 0)) for i in range(1500)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = toxicity.train(spark, frame, spark.createDataFrame(labels, "doc_id long, toxic int"), sample=20)
    for lang in ("en", "es"):
        own = [t for (i, t, x), (_, toxic) in zip(docs, labels) if x == lang and not toxic and zlib.crc32(str(i).encode()) % 3 == 2]
        scores = np.sort(model.scores(pa.array(own)))[::-1]
        allowed = int(0.1 * len(own))
        assert allowed >= 8 and (scores >= model.thresholds[lang]).sum() <= allowed
        assert model.thresholds[lang] == pytest.approx(scores[allowed], abs=model.slope / 1000)


# --- pipeline ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def stages(spark, sf, tmp_path_factory):
    """Input and output of each stage."""
    folder, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{sf}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(f"{folder}/{name}")
        after = spark.read.parquet(f"{folder}/{name}")
        out[name] = docs, after
        docs = after
    return out


def test_stages_keep_the_columns(stages):
    assert list(stages) == ["toxicity", "line_dedup", "near_dedup", "decontamination", "mixture"]
    for before, after in list(stages.values())[:-1]:
        assert after.columns == before.columns
    before, after = stages["mixture"]
    assert after.columns == [*before.columns, "copies"]


def test_stages_equal_brute_force(spark, sf, stages):
    def rows(frame):
        return {r.doc_id: r for r in frame.collect()}

    before, after = map(rows, stages["line_dedup"])
    texts = [(i, r.text) for i, r in before.items()]
    assert {i: r.text for i, r in after.items()} == {r[0]: r[3] for r in brute.line_dedup(texts)}
    assert all(r.n_chars == (len(r.text) if r.text != before[i].text else before[i].n_chars) for i, r in after.items())

    before, after = map(rows, stages["near_dedup"])
    expected = brute.near_duplicates([(i, r.text) for i, r in before.items()], 5, 80)
    assert set(after) == {i for i, (_, _, kept) in expected.items() if kept}

    before, after = map(rows, stages["decontamination"])
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    found = brute.contamination([(i, r.text) for i, r in before.items()], items)
    assert set(after) == {i for i, n, hit, _ in found if not (hit and 20 * hit >= n)}

    before, after = map(rows, stages["mixture"])
    assert set(after) <= set(before) and all(r.copies >= 1 for r in after.values())


def test_one_of_the_rows_of_an_id_or_of_none_stays(spark, monkeypatch):
    words = [" ".join(f"{c}{i}" for i in range(12)) for c in "abc"]
    rows = [(1, words[0]), (1, words[0]), (2, words[0]), (None, words[0]), (None, words[1]), (None, words[1]), (3, words[2]), (4, ""), (None, None), (None, " ")]
    docs = spark.createDataFrame([(*r, "en", "a", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    expected = sorted([(1, words[0]), (None, words[1]), (3, words[2]), (4, ""), (None, None), (None, " ")], key=str)
    for limit in (corpus_pipeline.BROADCAST_TEXTS, 0):
        monkeypatch.setattr(corpus_pipeline, "BROADCAST_TEXTS", limit)
        after = corpus_pipeline.drop_near_duplicates(spark, docs, "")
        assert after.columns == docs.columns
        assert sorted(((r.doc_id, r.text) for r in after.collect()), key=str) == expected


def test_pipeline_equals_its_stages(spark, sf, stages):
    whole = corpus_pipeline.run(spark, sf)
    assert sorted((r.doc_id, r.text, r.copies) for r in whole.collect()) == sorted((r.doc_id, r.text, r.copies) for r in stages["mixture"][1].collect())


def test_stages_of_nothing_and_of_odd_rows(spark, sf, odd):
    plain = odd.select("doc_id", "text", "lang", "source", "n_chars")
    for docs in (plain, plain.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, sf).count() <= docs.count()
