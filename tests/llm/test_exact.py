"""Operators with one right answer, against plain Python."""

import itertools
import random
import re
from collections import Counter

import brute
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tallyframe.llm import components, decontaminate, licenses, linededup, minhash, rlz, scratch, words
from tallyframe.llm.oracles import ORACLES
from tallyframe.llm.scratch import Scratch


def pairs(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]


def ordered(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_registered_queries_equal_sql(spark, sf, name):
    other = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        other.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    frame = entry.queries()[name](spark, sf)
    answer = other.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in answer.description]
    assert sorted(columns) == sorted(frame.columns)
    assert ordered(tuple(r) for r in frame.select(*columns).collect()) == ordered(answer.fetchall())


def test_words_and_their_hashes():
    import pyarrow as pa

    texts = pa.array(["Ab  ab\tAB", None, "", "é\x0bx y", "z" * 3_000_000 + " z"])
    for table, pattern in ((words.BY_SPACE, brute.SPACE), (words.BY_LETTER, brute.LETTER)):
        found = words.split(texts, table)
        raw = found.data.tobytes()
        split = [raw[s:e].decode() for s, e in zip(found.starts, found.ends)]
        expected = [pattern.findall(brute.lower(t)) for t in texts.to_pylist()]
        assert [brute.lower(w) for w in split] == [w for ws in expected for w in ws]
        assert found.counts().tolist() == [len(ws) for ws in expected]
        for fold in (False, True):
            hashes = found.hashes(fold)
            by_word = {}
            for word, h in zip(split, hashes.tolist()):
                assert by_word.setdefault(brute.lower(word) if fold else word, h) == h
            assert len(set(by_word.values())) == len(by_word)


def test_runs_agree_wherever_they_stand():
    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 5, 4000).astype(np.uint64)
    for k in (1, 2, 7):
        seen = {}
        for i, h in enumerate(words.runs(hashes, k).tolist()):
            assert seen.setdefault(tuple(hashes[i : i + k].tolist()), h) == h
        assert len(set(seen.values())) == len(seen)
    assert len(words.runs(hashes[:2], 3)) == 0


def test_components_of_paths_stars_and_nothing(spark):
    rng = random.Random(5)
    edges = [(i + 1, i) for i in range(0, 40)] + [(1000 + i, 999) for i in range(30)]
    edges += [(max(p), min(p)) for p in (rng.sample(range(2000, 2100), 2) for _ in range(70))]
    frame = spark.createDataFrame(edges, "a long, b long")
    found = {r.id: r.component for r in components.components(frame, Scratch(spark, "test")).collect()}
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    assert found == {x: root(x) for x in parent}
    assert components.components(frame.limit(0), Scratch(spark, "test")).count() == 0


def test_near_duplicates_of_odd_rows(spark, odd, nothing):
    found = minhash.near_duplicates(spark, odd, 3, 85)
    rows = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in found.collect()}
    assert found.count() == 16
    assert rows[1, 198] == rows[2, 198][:1] + (True,) == (1, True) and rows[2, 198] == (1, False)
    assert rows[3, 200] == (1, False) and rows[None, 198] == (None, True)
    assert rows[4, 0] == (4, True) and rows[5, 0] == (5, True) and rows[6, 0] == (6, True)
    assert rows[9, 1] == (9, True) and sorted((k[0], *v) for k, v in rows.items() if k[0] in (7, 8)) == [(7, 7, True), (8, 7, False)]
    assert minhash.near_duplicates(spark, nothing).count() == 0


def test_near_duplicate_chains_are_one_component(spark):
    """Neighbours are linked, the ends of the chain are not; all pairs in a bucket count, not only those with its pivot."""
    rng = random.Random(11)
    docs = []
    for chain in range(6):
        text = [f"c{chain}w{i}" for i in range(300)]
        for step in range(12):
            text = text.copy()
            for _ in range(6):
                text[rng.randrange(300)] = f"n{rng.random()}"
            docs.append((rng.randrange(10**9), " ".join(text)))
    found = minhash.near_duplicates(spark, spark.createDataFrame(docs, "doc_id long, text string"), 3, 85)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found.collect()} == brute.near_duplicates(docs, 3, 85)


def test_bands_meet_the_stated_chance():
    for percent in (80, 85, 95):
        bands = minhash.bands_for(percent)
        assert (1 - (percent / 100) ** minhash.ROWS) ** bands <= minhash.MISS < (1 - (percent / 100) ** minhash.ROWS) ** (bands - 1)


ITEMS = [
    (1, "a b c d e f g h i j k l m n o"), (2, "b c d e f g h i j k l m n"), (3, "x y z"), (4, "x y z"), (5, "Solo"),
    (6, None), (7, " - "), (None, "p q"), (8, "a a a a a a a a a a a a a a"),
]
TEXTS = [
    (1, "0 a b c d e f g h i j k l m n o 0"), (2, "b C d E f g h i j k l m n"), (3, "x y y z x, y. z x y z"), (4, "solo; Solo"),
    (5, None), (6, ""), (7, "a " * 40), (8, "p q p"), (9, "b c d e f g h i j k l m 0 n"), (9, "x y z"), (None, "é solo é"),
]


@pytest.mark.parametrize("block", [1 << 20, 20])
def test_contamination(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    docs = spark.createDataFrame([(*t, "clash") for t in TEXTS], "doc_id long, text string, items string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontaminate.contamination(spark, docs, items)
    rows = [(r.row.doc_id, r.n_words, r.n_hit, r["items"]) for r in found.collect()]
    assert ordered(rows) == ordered(brute.contamination(TEXTS, [("" if i is None else i, t) for i, t in ITEMS]))
    # one pass, and so one worker with one automaton, is alive at a time
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert decontaminate.contamination(spark, docs.limit(0), items).count() == 0
    assert {r.n_hit for r in decontaminate.contamination(spark, docs, items.limit(0)).collect()} == {0}


def test_automaton_against_brute_force_on_random_words():
    rng = random.Random(2)
    items = [" ".join(rng.choice("abc") for _ in range(rng.randrange(0, 12))) for _ in range(30)]
    built = decontaminate.ItemAutomaton([decontaminate.normal_words(t) for t in items], 4)
    for _ in range(200):
        text = " ".join(rng.choice("abcd") for _ in range(rng.randrange(0, 30)))
        spans, found = built.scan(decontaminate.normal_words(text))
        _, _, n_hit, names = brute.contamination([(0, text)], list(enumerate(items)), 4)[0]
        assert sum(b - a for a, b in decontaminate.united(spans)) == n_hit
        assert sorted(map(str, found)) == names


def test_decontaminated_documents(spark):
    docs = spark.createDataFrame([(1, "keep " * 400 + "a b c d e f g h i j k l m n, o!"), (2, "a b c d e f g h i j k l m n o"), (3, "clean")], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS[:1], "item_id long, text string")
    kept = dict(pairs(decontaminate.decontaminate(spark, docs, items)))
    assert sorted(kept) == [1, 3] and kept[1].endswith("o!")
    assert dict(pairs(decontaminate.decontaminate(spark, docs, items, longest=13)))[1] == "keep " * 400 + "!"


@pytest.mark.parametrize("edits", [3, 9])
def test_near_duplicates_in_families_of_edited_copies(spark, edits):
    """Families whose members are edited by themselves, so that links run past the pivot."""
    rng, docs = random.Random(edits), []
    for family in range(4):
        base = [f"f{family}w{k}" for k in range(90)]
        for member in range(45):
            words = list(base)
            for _ in range(rng.randrange(edits)):
                words[rng.randrange(90)] = f"e{rng.randrange(6)}" if rng.random() < 0.5 else f"m{member}"
            docs.append((len(docs), " ".join(words)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for width, percent in ((3, 85), (5, 80)):
        found = minhash.near_duplicates(spark, frame, width, percent)
        assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found.collect()} == brute.near_duplicates(docs, width, percent)


def test_members_of_many_families_are_described_once(spark, monkeypatch):
    """Pivots that are linked with each other have one family, so that rows grow with the members, not with their pivots."""
    rng, docs = random.Random(3), []
    base = [f"w{k}" for k in range(120)]
    for member in range(150):
        words = list(base)
        for _ in range(rng.randrange(9)):
            words[rng.randrange(120)] = f"e{rng.random()}"
        docs.append((member, " ".join(words)))
    described, turned = [], minhash._against_majority

    def counted(sized):
        described.append((sized.count(), sized.select("id").distinct().count()))
        return turned(sized)

    monkeypatch.setattr(minhash, "_against_majority", counted)
    found = minhash.near_duplicates(spark, spark.createDataFrame(docs, "doc_id long, text string"), 3, 85)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found.collect()} == brute.near_duplicates(docs, 3, 85)
    (rows, members), = described
    assert members > 100 and rows < 1.2 * members


def test_counts_of_kept_rows_are_those_written(spark):
    rows = spark.range(0, 1000, 1, 7)
    for few in (1000, 1, 0):
        kept, seen = Scratch(spark, "measured").measured(rows.where(f"id < {few}").distinct(), n=F.count(F.lit(1)), total=F.sum("id"))
        assert (kept.count(), kept.agg(F.sum("id")).first()[0]) == (seen["n"], seen["total"]) and seen["n"] == few


def test_near_duplicates_among_texts_that_share_a_passage(spark, monkeypatch):
    """Buckets full of texts that are far from every pivot are dealt by rare shingles, and no link is lost."""
    rng, docs = random.Random(5), []
    passage = [f"p{k}" for k in range(130)]
    for n in range(70):
        own = [f"n{n}w{k}" for k in range(110)]
        docs.append((2 * n, " ".join(passage + own)))
        if n % 3 == 0:
            own[rng.randrange(110)] = "edited"
            docs.append((2 * n + 1, " ".join(passage + own)))
    docs.append((0, "one id " + " ".join(passage)))
    dealt, narrowed = [], minhash._narrowed

    def counted(rest, sets, percent):
        found = narrowed(rest, sets, percent)
        dealt.append((rest.groupBy("key").count().agg(F.max("count")).first()[0], found.groupBy("key").count().agg(F.max("count")).first()[0]))
        return found

    monkeypatch.setattr(minhash, "_narrowed", counted)
    found = minhash.near_duplicates(spark, spark.createDataFrame(docs, "doc_id long, text string"), 3, 85)
    links = {r.doc_id: (r.component_id, r.kept) for r in found.where("n_shingles > 200").collect()}
    assert links == {i: (i - i % 2, i % 2 == 0) for i, _ in docs}
    (before, after), = dealt
    assert before > 30 and after < 10


@pytest.mark.parametrize("bits", [20, 3])
def test_rarest_shingles_of_linked_texts_meet(spark, bits):
    """Few rows come of long texts with a common passage, and linked ones share a row however crowded the counters are."""
    rng, docs = random.Random(bits), []
    for n in range(40):
        own = list(range(300)) + [1000 * n + k for k in range(1000, 1200)]
        docs.append(sorted(rng.sample(own, len(own))))
        docs.append(sorted(rng.sample(own, len(own) - 36)))
    docs += [[], [7], [7], [8]]
    spread = [[words.mixed(np.array([t], dtype=np.uint64)).view(np.int64)[0].item() for t in d] for d in docs]
    sets = spark.createDataFrame(list(enumerate(spread)), "id long, shingles array<long>")
    rarest = {r.id: r.tokens for r in minhash._rarest(sets, 85, bits).collect()}
    assert sorted(rarest) == list(range(len(docs)))
    for a, b in itertools.combinations(range(len(docs)), 2):
        one, other = set(spread[a]), set(spread[b])
        if 100 * len(one & other) >= 85 * len(one | other) > 0:
            assert set(rarest[a]) & set(rarest[b])
    assert sum(map(len, rarest.values())) < 0.2 * sum(map(len, docs))


def test_garbage_is_not_collected_after_every_small_step(spark, monkeypatch):
    collected = []
    monkeypatch.setattr(scratch.gc, "collect", lambda: collected.append(1))
    monkeypatch.setattr(Scratch, "_collected", float("-inf"))
    tables = Scratch(spark, "small")
    # the second and third of them collect after each keep and drop, for time or for a full heap
    for every, crowded, most in ((3600.0, 2.0, 1), (0.0, 2.0, 9), (3600.0, 0.0, 17)):
        monkeypatch.setattr(scratch, "COLLECT_EVERY", every)
        monkeypatch.setattr(scratch, "CROWDED", crowded)
        for n in range(4):
            tables.drop(tables.keep(spark.range(n)))
        assert len(collected) == most


def test_line_dedup_of_odd_rows(spark, odd, nothing):
    found = linededup.dedup_lines(spark, odd)
    rows = [(r.doc_id, r.n_lines, r.n_dropped, r.text) for r in found.collect()]
    big = (1 << 63) - 1  # a null id is the largest
    expected = brute.line_dedup([(big if i is None else i, t) for i, t in pairs(odd)])
    assert ordered(rows) == ordered((None if r[0] == big else r[0], *r[1:]) for r in expected)
    assert linededup.dedup_lines(spark, nothing).count() == 0


def test_hot_shards_are_split(spark, monkeypatch):
    monkeypatch.setattr(linededup, "SHARD_KEYS", 3)
    monkeypatch.setattr(linededup, "HOT", 8)
    docs = [(i, "\n".join(["a line that all share", f"line of the pair {i // 2}", f"own line number {i}"])) for i in range(60)]
    found = linededup.dedup_lines(spark, spark.createDataFrame(docs, "doc_id long, text string"))
    assert ordered((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in found.collect()) == ordered(brute.line_dedup(docs))


def test_perfect_hash_is_minimal_and_rejects_strangers():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 63, (5000, 2)).astype(np.uint64)
    keys[1, 0] = keys[0, 0]  # told apart by the fingerprint
    bits, sizes, order = linededup.build_shard(keys[:, 0], keys[:, 1])
    assert sorted(order) == list(range(5000))
    assert (linededup.look_up(bits, sizes, keys[:, 0], keys[:, 1]) == order).all()
    strangers = linededup.look_up(bits, sizes, keys[:, 1], keys[:, 0])
    assert ((strangers >= -1) & (strangers < 5000)).all()
    assert linededup.build_shard(keys[:0, 0], keys[:0, 1])[2].size == 0


def test_substring_dedup_of_odd_rows(spark, odd, nothing):
    found = rlz.remove_repeats(spark, odd)
    assert ordered((r.doc_id, r.n_words, r.n_removed, r.text) for r in found.collect()) == ordered(brute.substring_dedup(pairs(odd)))
    assert rlz.remove_repeats(spark, nothing).count() == 0


@pytest.mark.parametrize("groups", [1 << 24, 2000])
def test_substring_dedup_of_random_passages(spark, monkeypatch, groups):
    monkeypatch.setattr("tallyframe.llm.groups.GROUP_BYTES", groups)
    rng = random.Random(4)
    passages = [[rng.choice("abcdefgh") + rng.choice("xy") for _ in range(rng.randrange(3, 25))] for _ in range(12)]
    docs = []
    for i in range(80):
        body = [w for _ in range(rng.randrange(0, 6)) for w in (*rng.choice(passages), str(rng.randrange(40)))]
        docs.append((i, rng.choice([" ", "\n", " \t"]).join(body)))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = rlz.remove_repeats(spark, frame, 8)
    assert ordered((r.doc_id, r.n_words, r.n_removed, r.text) for r in found.collect()) == ordered(brute.substring_dedup(docs, 8))


def test_longest_matches_equal_a_plain_search():
    rng = random.Random(8)
    for n in [0, 1, 2, 5, 30, 90] * 8:
        words = [rng.randrange(rng.choice([2, 4, 40])) for _ in range(n)]

        def common(a, b):
            return next((k for k in range(n) if max(a, b) + k >= n or words[a + k] != words[b + k]), n)

        wanted = [max((common(a, b) for b in range(n) if b != a), default=0) for a in range(n)]
        assert rlz.longest_matches(np.array(words, dtype=np.int64)).tolist() == wanted


def test_factors_are_greedy_and_skip_literals():
    # the reference holds abc and cde; abcde is parsed as abc, de, and a word that stands nowhere else is a literal
    reference = np.array([1, 2, 3, 90, 3, 4, 5, 91, 1, 2, 3, 4, 5, 7, 92])
    longest = rlz.longest_matches(reference)[8:14]
    assert longest.tolist() == [3, 2, 3, 2, 1, 0]
    assert rlz.factors(longest) == [(0, 3), (3, 2)]


def test_windows_across_boundaries_are_looked_up():
    """Two overlapping passages of the reference: the greedy factor hides the second one's begin."""
    first, second = list(range(10)), list(range(6, 16))
    document = list(range(16))
    reference = np.array([*first, 90, *second, 91, *document, 92])
    longest = rlz.longest_matches(reference)[-17:-1]
    assert rlz.factors(longest) == [(0, 10), (10, 6)]
    assert rlz.duplicate_windows(longest, 8) == [(0, 3), (6, 9)]
    assert rlz.duplicate_windows(longest, 8, boundaries=False) == [(0, 3)]


def test_parsed_blocks_equal_a_plain_count():
    rng = random.Random(5)
    for _ in range(40):
        rows = list({np.array([rng.randrange(4) for _ in range(rng.randrange(6, 40))], dtype=np.uint64).tobytes() for _ in range(5)})
        copies = np.array([rng.choice([1, 1, 1, 2]) for _ in rows])
        split = [np.frombuffer(r, dtype=np.uint64).tolist() for r in rows]
        seen = Counter(tuple(w[i : i + 6]) for w, n in zip(split, copies) for _ in range(n) for i in range(len(w) - 5))
        for words, spans in zip(split, rlz.parse_block(rows, copies, 6)):
            assert {i for a, b in spans for i in range(a, b)} == {i for i in range(len(words) - 5) if seen[tuple(words[i : i + 6])] > 1}


def test_license_places_equal_brute_force(spark, odd, nothing, sf):
    for docs in (odd, spark.read.parquet(f"{sf}/documents.parquet")):
        found = licenses.scan(docs)
        rows = ordered((r.doc_id, r.n_words, tuple(r.places), tuple(r.base_labels)) for r in found.collect())
        assert rows == ordered((i, n, tuple(p), tuple(x)) for i, t in pairs(docs) for n, p, x in [brute.phrases(t, licenses.PHRASES)])
        assert all(set(r.base_labels) <= set(r.labels) and 0 <= r.score <= 1 for r in found.collect())
    assert licenses.scan(nothing).count() == 0


@pytest.mark.parametrize("text, labels, score", [
    ("Licensed under the Apache License, Version 2.0.", {"apache", "apache-2.0"}, 1.0),
    ("licensed under the APACHE license 2.0", {"apache", "apache-2.0"}, 1.0),
    ("licensed under the apache software license 2.0", set(), None),
    ("This work is licensed under the GNU General Public License, version 3.", {"gpl", "gpl-3.0"}, 1.0),
    ("the general public license as published, version 3", {"gpl", "gpl-3.0"}, 1.0),
    ("Released under the terms of the MIT License", {"mit", "mit-notice"}, 1.0),
    ("the mit license", {"mit"}, None),
    ("Licensed under CC BY-NC 4.0.", {"cc-by-nc-4.0"}, 1.0),
    ("Licensed under the Creative Commons BY 4.0", {"cc-by-4.0"}, 1.0),
    ("no notice", set(), 0.0),
])
def test_templates_take_mandatory_wording_only(text, labels, score):
    built = [[licenses.compile_template(m, x) for m, x in table] for table in (licenses.PHRASES, licenses.TEMPLATES)]
    _, _, _, found, value = licenses.scan_text(text, *built)
    assert found == labels and 0 <= value <= 1 and (score is None or value == score)


def test_whole_licences_are_told_from_altered_ones():
    built = [[licenses.compile_template(m, x) for m, x in table] for table in (licenses.PHRASES, licenses.TEMPLATES)]

    def scanned(text):
        _, _, _, labels, score = licenses.scan_text(text, *built)
        return labels, score

    assert scanned("Licensed under CC BY-SA 4.0") == ({"cc-by-sa-4.0"}, 1.0)
    for markup, label, extra in ((licenses._MIT, "mit-text", set()), (licenses._BSD, "bsd", set()), (licenses._GPL_NOTICE, "gpl-notice", {"gpl"}), (licenses._APACHE_NOTICE, "apache-2.0-notice", {"apache", "apache-2.0"})):
        whole = re.sub(r"<<any \d+>>", "x", re.sub(r"<<(optional|end)>>", " ", markup))
        assert scanned(whole) == ({label} | extra, 1.0)
        assert label in scanned(re.sub(r"<<optional>>.*?<<end>>", " ", markup.replace("<<any 1>>", ""), flags=re.S).replace("<<any", "").replace(">>", ""))[0]
        assert label not in scanned(" ".join(whole.split()[:-1]))[0]
        assert label not in scanned(whole.replace("without any warranty", "with any warranty").replace("in no event shall", "in any event shall").replace("as is basis", "basis"))[0]
    # what is cut has the share of the mandatory words that it holds, whatever word is missing
    words = re.sub(r"<<optional>>.*?<<end>>", " ", licenses._MIT.split("<<any 12>>")[0]).split()
    _, score = scanned(" ".join(words))
    mandatory = len(re.sub(r"<<optional>>.*?<<end>>|<<any \d+>>", " ", licenses._MIT).split())
    assert score == pytest.approx(len(words) / mandatory) and 0.5 < score < 1
    short = [[], [licenses.compile_template("a b c d uncommonly", "x")]]
    assert licenses.scan_text("a b c d", *short)[4] == pytest.approx(0.8)
    assert licenses.scan_text("a b", *short)[4] == 0


def test_template_regions():
    built = licenses.compile_template("a <<optional>>b <<optional>>c<<end>><<end>> <<any 2>> d", "x")
    yes = ("a d", "a b d", "a b c d", "a q d", "a q q d", "a b c q q d", "a b q d")
    no = ("a", "d", "a q q q d", "a c b q q d", "a b c q q q d")
    for text in yes + no:
        assert built.accepts_at(text.split(), 0)[0] == (text in yes), text
    for bad in ("<<optional>>a<<end>>", "<<optional>>a", "<<any 2>> a"):
        with pytest.raises(ValueError):
            licenses.compile_template(bad, "x")


def test_missing_tables_columns_are_not_hidden(spark):
    with pytest.raises(Exception, match="text"):
        linededup.dedup_lines(spark, spark.range(1).select(F.col("id").alias("doc_id")))
