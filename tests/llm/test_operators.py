"""Each operator against a brute-force version, on small tables with nulls, ties, repeats and long texts."""

import hashlib
import math
import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from itertools import combinations
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from webloom.llm import op1_toxicity as op1
from webloom.llm import op2_decontamination as op2
from webloom.llm import op3_jaccard_join as op3
from webloom.llm import op4_mixing as op4
from webloom.llm import op5_token_counts as op5
from webloom.llm import op6_substring_dedup as op6
from webloom.llm import op7_fingerprint as op7
from webloom.llm import op8_quality as op8
from webloom.llm import op9_suffix_dedup as op9
from webloom.llm import op10_pii as op10

WORDS = ["w" + chr(97 + n % 26) + chr(97 + n // 26) for n in range(400)]
# extra columns whose names the operators use inside
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, taken string, row string, key int, "
    "c int, node int, doc int, tie int, plan int, probed int, score int, hash int"
)


def prose(seed, n, vocabulary=WORDS):
    rng = random.Random(seed)
    return " ".join(rng.choice(vocabulary) + rng.choice(["", "", "", ".", ","]) for _ in range(n))


def changed(text, seed, times):
    words, rng = text.split(" "), random.Random(seed)
    for _ in range(times):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


LONG = prose(99, 30_000)
BASE = prose(1, 300)
TEXTS = {
    1: BASE, 2: BASE, 3: changed(BASE, 3, 2), 4: changed(BASE, 4, 4), 5: changed(changed(BASE, 4, 4), 5, 3),
    6: prose(6, 80), 7: "", 8: None, 9: "One", 10: "one", 11: "two words", 12: LONG, 13: LONG + " end",
    14: prose(14, 30) + "\n" + prose(15, 60) + "\nshort line\n" + prose(16, 40),
    15: "\n".join([prose(17, 20), prose(15, 60), prose(18, 25)]), 16: "a a a a a a a a " * 60, 17: " \t\n ",
    18: "é" * 400 + prose(6, 80), 19: "x" * 250, 20: prose(14, 30) + " " + changed(prose(15, 60), 1, 1),
    None: prose(21, 50),
}
SOURCES = ["a", "b", None, "c"]


def table_of(spark, texts):
    """One row per (doc_id, text), with a repeated row and extra columns."""
    rows = [
        (d, t, "en", SOURCES[i % 4], None if t is None else len(t), 1, "t", "r", 1, 1, 1, 1, 1, 1, 1, 1, 1)
        for i, (d, t) in enumerate(texts)
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return table_of(spark, [*TEXTS.items(), (6, TEXTS[6])]).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def benchmark(spark):
    middle = " ".join(BASE.split(" ")[100:125]).upper()
    rows = [(1, middle), (2, "Two! Words"), (3, "not there at all"), (None, BASE), (5, None), (6, ""), (7, middle), (7, middle), (8, "one")]
    return spark.createDataFrame(rows, "item_id bigint, text string")


def by_id(frame):
    return {r.doc_id: r for r in frame.collect()}


# --- words -------------------------------------------------------------------------------------


def test_words_and_hashes_of_slices():
    from webloom.llm.words import NOT_BLANK, Words, gram_hashes, text_slices, within_rows

    texts = ["A b", None, "", " c\td ", "é", "a B"]
    found = []
    for most in (1, 4, 1 << 20):
        spans = []
        for first, n, data, offsets in text_slices(pa.array(texts), most):
            words = Words(data, offsets, NOT_BLANK)
            spans += [(first + r, bytes(words.data[a:b]).decode(), int(h)) for r, a, b, h in zip(words.rows, words.starts, words.ends, words.hashes())]
            assert len(gram_hashes(words.hashes(), 2)) == max(0, len(words.starts) - 1) == len(within_rows(words.rows, 2))
        found.append(spans)
    assert found[0] == found[1] == found[2]
    assert [(r, w) for r, w, _ in found[0]] == [(0, "a"), (0, "b"), (3, "c"), (3, "d"), (4, "é"), (5, "a"), (5, "b")]
    assert found[0][0][2] == found[0][5][2] != found[0][1][2]


# --- 1 toxicity ---------------------------------------------------------------------------------


def toxic_table(spark, n=400):
    rng, rows, labels = random.Random(1), [], []
    for d in range(n):
        words = [rng.choice(WORDS) for _ in range(40)]
        if toxic := d % 5 == 0:
            for _ in range(3):
                words[rng.randrange(40)] = rng.choice(["blockhead", "nitwitted", "nitwitling"])
        rows.append((d, " ".join(words)))
        labels.append((d, int(toxic)))
    return spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_toxicity_learns_and_holds_out(spark):
    docs, labels = toxic_table(spark)
    found = by_id(op1.toxicity_report(docs, labels))
    for d, r in found.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) and 0 <= r.score <= 1
        assert r.predicted == int(d % 5 == 0) == int(r.score >= 0.3)
    # labels of the held-out quarter change nothing
    other = labels.withColumn("toxic", F.when(op1.held_out(F.col("doc_id"), 4, 2), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert by_id(op1.toxicity_report(docs, other)) == found


def test_clauses_of_the_grammar():
    I, W, Y, N, R, Q, H = (("I", 1.0), ("W", 0.0), ("Y", 1.0), ("N", 1.0), ("R", 1.0), ("Q", 0.0), ("H", 1.0))
    assert op1.read_clause([W, I])[0] == "plain"
    assert op1.read_clause([Y, W, W, I])[0] == "targeted"
    assert op1.read_clause([N, W, I])[0] == "negated"
    assert op1.read_clause([N, W, W, W, W, I])[0] == "plain"
    assert op1.read_clause([R, W, I])[0] == op1.read_clause([Q, I, Q])[0] == "reported"
    assert op1.read_clause([Q, W, Q, I])[0] == "plain"
    assert op1.read_clause([H, Y])[0] == "threat" and op1.read_clause([H, W]) == ("", 0.0)
    assert op1.read_clause([W, Y]) == ("", 0.0) == op1.read_clause([])


def test_composed_machine_equals_the_machines_side_by_side():
    """Every token string of a length, and long random ones, against the three machines stepped one by one."""
    import itertools

    rng = random.Random(8)
    strings = [*itertools.product(op1.CLASSES, repeat=4), *("".join(rng.choices(op1.CLASSES, k=30)) for _ in range(300))]
    for classes in strings:
        state, states = 0, [0, 0, 0]
        paths = []
        for c in classes:
            state, said, weight = op1.CLAUSE.step(state, c)
            steps = [m.step(s, c) for m, s in zip((op1.NEGATION, op1.REPORT, op1.TARGET), states)]
            states = [s for s, _, _ in steps]
            assert said == next((o for _, o, _ in steps if o), "") and math.isclose(weight, math.prod(w for _, _, w in steps))
            if c == "I" or c == "H" and "Y" in classes:
                paths.append((weight, "threat" if c == "H" and said in ("", "targeted") else said or "plain"))
        kind, own = op1.read_clause([(c, 1.0) for c in classes])
        best = max((w for w, _ in paths), default=0)
        assert kind == next((k for w, k in paths if w == best), "") and own == float(bool(paths))


def test_apostrophes_and_stems():
    grammar = op1.Grammar({"=oaf": 1.2})
    kinds = lambda t: dict(zip(op1.FEATURES, grammar.kinds(t)))
    for text in ("he isn't an oaf", "he isn’t an oaf"):
        assert kinds(text)["negated"] > 0 == kinds(text)["targeted"], text
    for text in ("i will kill you", "killing you", "ich werde dich umbringen", "you get murdered"):
        assert kinds(text)["threat"] > 0, text
    assert not grammar.kinds("the killjoy's shop hurts").any()
    assert kinds("she calls him an oaf")["reported"] > 0


@pytest.mark.parametrize("sf, least, most", [("sf0.01", 0.6, 0.02), ("sf0.1", 0.9, 0.02)])
def test_toxicity_of_held_out_labels(spark, sf, least, most):
    docs, labels = (spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet") for t in ("documents", "labels"))
    held = op1.toxicity_report(docs, labels).join(labels, "doc_id").filter("held_out AND toxic IS NOT NULL")
    row = held.agg(
        F.avg(F.when(F.col("toxic") == 1, F.col("predicted"))), F.avg(F.when(F.col("toxic") == 0, F.col("predicted")))
    ).first()
    assert row[0] >= least and row[1] <= most, row


@pytest.mark.parametrize("sf, good, bad", [("sf0.01", 0.95, 0.5), ("sf0.1", 0.98, 0.93)])
def test_quality_of_held_out_labels(spark, sf, good, bad):
    docs, labels = (spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet") for t in ("documents", "labels"))
    held = op8.quality_report(docs, labels).join(labels, "doc_id").filter("held_out AND quality IS NOT NULL")
    row = held.agg(
        F.avg(F.when(F.col("quality") == 1, F.col("predicted"))), F.avg(F.when(F.col("quality") == 0, 1 - F.col("predicted")))
    ).first()
    assert row[0] >= good and row[1] >= bad, row


def test_scores_by_clause_and_word_borders():
    grammar = op1.Grammar({"=oaf": 1.2, "dolt": 1.2})
    plain, negated = grammar.kinds("What an oaf."), grammar.kinds("She is not an oaf.")
    model = op1.Model(grammar.entries, op1.PRIOR, op1.START)
    assert model.scores(np.array([plain]))[0] > 0.3 > model.scores(np.array([negated]))[0]
    for text in ("loaf", "oafs", "undolted", None, ""):
        assert not grammar.kinds(text).any(), text
    assert grammar.kinds("DOLTISH!")[0] > 0


def test_toxicity_without_labels_and_on_edges(spark, docs, empty):
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id bigint, toxic int")
    rows = op1.toxicity_report(docs, none).collect()
    assert len(rows) == docs.count() and {r.score for r in rows} == {0.0}
    assert op1.toxicity_report(empty, none).count() == 0
    assert op1.drop_toxic(docs, op1.Model({}, op1.PRIOR, op1.START)).columns == docs.columns


# --- 2 decontamination -----------------------------------------------------------------------


def leaks_by_hand(texts, items):
    words = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    out = []
    for d, t in texts:
        w, hit, ids = words(t), set(), set()
        for i, it in items:
            v = words(it)
            if i is None or not v:
                continue
            n = min(10, len(v))
            windows = {tuple(v[p : p + n]) for p in range(len(v) - n + 1)}
            for p in range(len(w) - n + 1):
                if tuple(w[p : p + n]) in windows:
                    hit.update(range(p, p + n))
                    ids.add(str(i))
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return Counter(out)


@pytest.mark.parametrize("most", [1 << 20, 100])
def test_leaks_equal_brute_force_by_probes_and_by_joins(docs, benchmark, most):
    found = op2.find_leaks(docs.select("doc_id", "text"), benchmark, most_bytes=most)
    assert ("Join" in found._jdf.queryExecution().toString()) == (most == 100)
    expected = leaks_by_hand([(r.doc_id, r.text) for r in docs.collect()], [tuple(r) for r in benchmark.collect()])
    got = found.select("doc_id", "_leak.words", op2.hit_words(F.col("_leak.spans")), F.array_sort("_leak.items")).collect()
    assert Counter((r[0], r[1], r[2], len(r[3]), hashlib.sha256(",".join(r[3]).encode()).hexdigest(), r[2] > 0) for r in got) == expected
    if most > 100:
        assert Counter(tuple(r) for r in op2.leak_report(docs, benchmark).collect()) == expected


def test_leaks_with_empty_tables_and_kept_columns(spark, docs, empty, benchmark):
    none = benchmark.limit(0)
    assert all(not r.contaminated and r.n_items == 0 for r in op2.leak_report(docs, none).collect())
    joined = op2.find_leaks(docs.select("doc_id", "text"), benchmark.filter("text IS NULL"), most_bytes=-1)
    assert joined.filter(F.size("_leak.spans") > 0).count() == 0 and joined.count() == docs.count()
    assert op2.leak_report(empty, benchmark).count() == 0
    kept = op2.drop_leaks(docs, benchmark)
    assert kept.columns == docs.columns and not {1, 9, 10, 11} & {r.doc_id for r in kept.collect()}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.lists(st.integers(0, 3), min_size=10, max_size=30))
def test_winnowing_misses_no_shared_window(text, item):
    name = lambda v: " ".join("abcd"[x] for x in v)
    index = op2.Index(["i"], [name(item)])
    spans, _, _ = op2._probe(index, pa.array([name(text)]))
    windows = {tuple(item[p : p + 10]) for p in range(len(item) - 9)}
    expected = {p for p in range(len(text) - 9) if tuple(text[p : p + 10]) in windows}
    assert {s["first"] for s in spans.to_pylist()[0]} == expected


# --- 3 Jaccard join -----------------------------------------------------------------------------


def shingles(text, k):
    w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def components_by_hand(nodes, links):
    label = {n: n for n in nodes}
    def root(x):
        while label[x] != x:
            x = label[x]
        return x
    for a, b in links:
        a, b = root(a), root(b)
        label[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def groups_by_hand(texts, k, num, den):
    sets = {d: shingles(t, k) for d, t in texts}
    links = []
    for (a, x), (b, y) in combinations(sets.items(), 2):
        if x and y and den * len(x & y) >= num * len(x | y):
            links.append((a, b))
    comp = components_by_hand(sets, links)
    return {d: (len(s), comp[d]) for d, s in sets.items()}


@pytest.mark.parametrize("k,num,den,block", [(3, 90, 100, 1024), (5, 8, 10, 1024), (2, 7, 10, 2)])
def test_similar_groups_equal_brute_force(docs, k, num, den, block):
    found = op3.similar_groups(docs, k, num, den, block_sets=block).collect()
    expected = groups_by_hand([(d, t) for d, t in TEXTS.items() if d is not None], k, num, den)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found if r.doc_id is not None) == Counter(
        [(d, *v) for d, v in expected.items()] + [(6, *expected[6])]
    )
    assert [r.component_id for r in found if r.doc_id is None] == [None]


def test_large_group_of_near_copies(spark):
    texts = [(d, changed(BASE, d, 1 + d % 12)) for d in range(150)] + [(1000 + d, prose(d, 60)) for d in range(30)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(5)
    for block in (1024, 16):
        found = {r.doc_id: (r.n_shingles, r.component_id) for r in op3.similar_groups(docs, 3, 90, 100, block_sets=block).collect()}
        assert found == groups_by_hand(texts, 3, 90, 100)


def test_no_task_compares_a_whole_large_group(spark, monkeypatch):
    # two kinds of near copies of one page, far apart, share a long passage of it
    shared = " ".join(f"common{n}" for n in range(80))
    texts = [(d, changed(shared + " " + prose(d % 2, 60 + 5 * (d % 3)), d, d % 4)) for d in range(400)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(5)

    def bounded(batches, **similarity):
        from webloom.llm import op3_jaccard_join as module

        links = module.possible_links

        def checked(sizes, *rest):
            if len(sizes) > 200:  # two blocks of 40 as a hash deals them, and the sets that are in all
                raise ValueError(f"{len(sizes)} sets in one task")
            return links(sizes, *rest)

        module.possible_links = checked
        try:
            yield from module._possible(batches, **similarity)
        finally:
            module.possible_links = links

    monkeypatch.setattr(op3, "_possible", bounded)
    found = op3.similar_groups(docs, 3, 80, 100, block_sets=40).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == groups_by_hand(texts, 3, 80, 100)


def test_one_of_each_group_stays(docs, empty):
    kept = op3.keep_one_of_each(docs, k=3, num=90, den=100)
    assert kept.columns == docs.columns
    comp = groups_by_hand([(d, t) for d, t in TEXTS.items() if d is not None], 3, 90, 100)
    assert {r.doc_id for r in kept.collect()} == {d for d, (_, c) in comp.items() if d == c} | {None}
    assert op3.similar_groups(empty).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6), st.integers(5, 200), st.sampled_from([(90, 100), (8, 10), (7, 10)]))
def test_linked_sets_share_an_index_entry(seed, size, similarity):
    num, den = similarity
    rng = random.Random(seed)
    x = {rng.getrandbits(64) for _ in range(size)}
    y = set(x)
    while True:  # take out and put in, to the least similarity
        z = set(y)
        z.discard(rng.choice(sorted(z)))
        if rng.random() < 0.5:
            z.add(rng.getrandbits(64))
        if not z or den * len(x & z) < num * len(x | z):
            break
        y = z
    entries = []
    frequent = {g for g in x | y if g % 3 == 0}
    for s in (x, y):
        grams = np.array(sorted(s), np.uint64)
        hot = np.array([int(g) in frequent for g in grams])
        e, _ = op3.index_entries(grams, np.zeros(len(grams), np.int64), 1, num, den, hot)
        entries.append(set(e.tolist()))
    assert entries[0] & entries[1]


@pytest.mark.parametrize("num,den", [(90, 100), (8, 10), (7, 10)])
def test_pairs_across_class_borders_share_an_index_entry(num, den):
    grams = np.sort(np.random.default_rng(3).integers(0, 1 << 63, 300_000).astype(np.uint64))
    for low in op3.Parts(num, den, 280_000).low.tolist():
        if low > len(grams) or (low - 1) * den < num * low:
            continue
        # each set is alone in its slice, so the lower one is the largest there
        below, above = (set(op3.index_entries(grams[:n], np.zeros(n, np.int64), 1, num, den)[0].tolist()) for n in (low - 1, low))
        assert below & above, low


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(n, n + 1) for n in range(1000, 1200)] + [(5000, n) for n in range(6000, 6300)]
    frame = spark.createDataFrame(links + [(1, 1)], "a bigint, b bigint")
    from webloom.llm.components import components

    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert {r.node: r.component for r in components(frame).collect()} == components_by_hand(nodes, links)
    assert components(frame.limit(0)).count() == 0
    hub = spark.range(1, 3000).selectExpr("id AS a", "0L AS b").unionByName(frame.selectExpr("a + 10000 AS a", "b + 10000 AS b"))
    by_shuffle = {r.node: r.component for r in components(hub, broadcast_rows=0).collect()}
    assert by_shuffle == {r.node: r.component for r in components(hub).collect()} and by_shuffle[2999] == 0


# --- 4 mixing ---------------------------------------------------------------------------------


def test_mix_meets_targets(spark, docs, empty):
    rows = op4.mix_report(docs).collect()
    assert len(rows) == docs.count()
    sizes, targets = defaultdict(int), {}
    source = {r.doc_id: r.source for r in docs.collect()}
    for r in rows:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", TEXTS[r.doc_id] or "")) and 0 <= r.taken <= 2 * r.size
        sizes[source[r.doc_id]] += r.size
        targets[source[r.doc_id]] = (r.target, r.source_size)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, open_, expected = 1.5 * sum(sizes.values()), set(order), {}
    while open_:  # stop what is over its limit, share the rest again
        share = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not over:
            expected |= share
            break
        for s in over:
            expected[s] = 2.0 * sizes[s]
            left -= expected[s]
            open_.remove(s)
    taken = defaultdict(int)
    for r in rows:
        taken[source[r.doc_id]] += r.taken
    for s in order:
        assert targets[s][1] == sizes[s] and math.isclose(targets[s][0], expected[s], rel_tol=1e-9)
        assert abs(taken[s] - expected[s]) <= 2  # rows that share a hash are cut to whole words
    assert Counter(op4.mix_report(docs).collect()) == Counter(rows)
    assert op4.mix_report(empty).count() == 0


def test_mix_keeps_columns_and_handles_equal_ids(spark, docs):
    mixed = op4.mix(docs)
    assert set(mixed.columns) == set(docs.columns) and mixed.filter("taken <= 0").count() == 0
    same = spark.createDataFrame([(1, "a", "x y z")] * 50 + [(None, None, None)], "doc_id bigint, source string, text string")
    rows = op4.mix_report(same).collect()
    assert sum(r.taken for r in rows) == 200 and {r.taken for r in rows} <= {0, 4}


# --- 5 token counts -----------------------------------------------------------------------------


def test_rollup_counts_each_batch_once(spark, docs, tmp_path):
    tokenizer = op5.Tokenizer("v1")
    encoder = tokenizer.encoder()
    store = op5.Rollup(spark, str(tmp_path / "r"))
    assert store.totals().count() == 0
    first, second = docs.filter("doc_id < 10"), docs.filter("doc_id >= 10 OR doc_id IS NULL")
    assert store.apply("one", op5.inserted(first, tokenizer)) and not store.apply("one", op5.inserted(first, tokenizer))
    # an attempt that was cut off before its commit leaves files, which the next one writes over
    op5._summed(op5.inserted(docs, tokenizer)).write.parquet(str(tmp_path / "r/deltas/two"))
    assert store.apply("two", op5.inserted(second, tokenizer))
    store.apply("nothing")
    store.compact("base")
    store.compact("base")
    after = first.withColumn("text", F.concat("text", F.lit(" more")))
    store.apply("three", op5.revised(first, after, tokenizer), op5.deleted(docs.filter("doc_id = 12"), tokenizer))
    store.compact("base")
    assert not store.apply("two", op5.inserted(second, tokenizer))
    expected = defaultdict(lambda: [0, 0])
    for r in docs.collect():
        if r.doc_id == 12:
            continue
        text = r.text + " more" if r.doc_id is not None and r.doc_id < 10 and r.text is not None else r.text
        expected[r.source, r.lang, "v1"][0] += 1
        expected[r.source, r.lang, "v1"][1] += len(encoder.encode_ordinary(text or ""))
    assert {(r.source, r.lang, r.tokenizer): [r.documents, r.tokens] for r in store.totals().collect()} == dict(expected)


def test_rollup_query_on_the_whole_table(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    tokenizer = op5.Tokenizer("v1")
    encoder = tokenizer.encoder()
    marks = {r.doc_id: r for r in labels.collect()}
    expected = Counter()
    for r in docs.collect():
        m = marks.get(r.doc_id)
        if m and m.toxic == 1:
            continue
        text = re.sub(r"[!*#%&$]{2,}", "", r.text) if m and m.quality == 0 else r.text
        expected[r.source, r.lang] += len(encoder.encode_ordinary(text))
    found = op5.rollup_of(docs, labels, str(tmp_path / "q"), tokenizer).collect()
    assert {(r.source, r.lang): r.tokens for r in found} == dict(expected)


# --- 6 passages ---------------------------------------------------------------------------------


def paragraphs_by_hand(text):
    """(start, end, whole line) of lines of eight words or more, and of short lines with others."""
    lines, at = [], 0
    for line in (text or "").split("\n"):
        lines.append((at, at + len(line) + 1, len(re.findall(r"[^\x20\x09-\x0D]+", line))))
        at += len(line) + 1
    out = {(a, b, True) for a, b, n in lines if n >= 8}
    for i, (_, _, n) in enumerate(lines):
        if 0 < n < 8:
            ends = [j for j in range(i, len(lines)) if sum(x[2] for x in lines[i : j + 1]) >= 8]
            first, last = (i, ends[0]) if ends else (max([k for k in range(len(lines)) if sum(x[2] for x in lines[k:]) >= 8], default=0), len(lines) - 1)
            out.add((lines[first][0], lines[last][1], False))
    return sorted(out)


def lines_by_hand(texts):
    """Clusters of paragraphs: similar or equal ones. Those of whole lines, by document and start."""
    lines = [(d, a, t[a:b], whole) for d, t in texts for a, b, whole in paragraphs_by_hand(t) if t]
    links = [
        (i, j) for (i, a), (j, b) in combinations(enumerate(lines), 2)
        if 10 * len(shingles(a[2], 5) & shingles(b[2], 5)) >= 8 * len(shingles(a[2], 5) | shingles(b[2], 5))
    ]
    comp = components_by_hand(range(len(lines)), links)
    size = Counter(comp.values())
    return {(lines[i][0], lines[i][1]): comp[i] for i in comp if size[comp[i]] > 1 and lines[i][3]}


def test_paragraphs_of_short_lines():
    import numpy as np

    for text in ("a b\nc d e\nf g h i\nj\n\nk l", "one two\nthree", "x\n" * 20, "1 2 3 4 5 6 7 8 9\nend", "a\n1 2 3 4 5 6 7 8 9\nend", "", "\n\n", "w"):
        data = np.frombuffer((text + "zz\nother").encode(), np.uint8)  # another text behind it
        starts, ends, texts, line = op6.units(data, np.array([0, len(text), len(data)]))
        n = int(line.sum())
        counts = np.array([len(bytes(data[a:b]).split()) for a, b in zip(starts[:n], ends[:n])])
        runs = [(int(starts[a]), int(ends[b])) for a, b in zip(*op6.short_line_runs(texts[:n], counts)) if starts[a] < len(text)]
        assert runs == sorted({(a, min(b, len(text))) for a, b, whole in paragraphs_by_hand(text) if not whole}), text


def test_verse_and_lists_are_found(spark):
    verse = "\n".join(prose(n, 4) for n in range(70, 84))
    near = verse.split("\n")
    near[6] = "other words here now"
    texts = [(1, prose(1, 40) + "\n" + verse + "\n" + prose(2, 40)), (2, prose(3, 20) + "\n" + verse), (3, prose(4, 80)), (4, "\n".join(near) + "\n" + prose(5, 30)), (5, "tiny\nlist"), (6, "tiny\nlist")]
    found = op6.repeated_passages(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()
    assert {r.doc_id for r in found} == {1, 2, 4, 5, 6}
    covered = {d: {p for r in found if r.doc_id == d for p in range(r.start, r.end)} for d in (1, 2)}
    for d in (1, 2):
        at = dict(texts)[d].index(verse)
        assert set(range(at, at + len(verse))) <= covered[d]


def test_repeated_lines_equal_brute_force(docs, empty):
    every = op6.repeated_passages(docs).collect()
    found = [r for r in every if r.whole_line]
    expected = lines_by_hand(list(TEXTS.items()))
    assert {(r.doc_id, r.start) for r in found} == set(expected)
    groups = defaultdict(set)
    for r in found:
        groups[r.cluster_id].add(expected[r.doc_id, r.start])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(expected.values()))
    for cluster in groups:
        own = [r for r in every if r.cluster_id == cluster]
        first = min(own, key=lambda r: (r.doc_id is None, r.doc_id, r.start))
        assert [r for r in own if not r.removed] == [first]
    for r in found:
        assert re.sub(r"\s+\Z", "", TEXTS[r.doc_id][r.start : r.end]).count("\n") == 0
    assert op6.repeated_passages(empty).count() == 0


def test_loose_components_are_cut_by_the_index(spark, monkeypatch):
    """Lines that share a passage collide in bands all together, though few of them are similar."""
    passage = prose(60, 24).replace(".", "")
    lines = [passage + " " + " ".join(f"x{n}y{m}" for m in range(16)) for n in range(1400)]
    near = {n: lines[n].replace(f"x{n}y15", f"other{n}") for n in range(0, 1400, 200)}
    texts = [*enumerate(lines), *((5000 + n, t) for n, t in near.items())]
    groups = []
    within = op6.links_within
    monkeypatch.setattr(op3, "LOOSE_BLOCKS", 1, raising=False)
    monkeypatch.setattr(op6, "links_within", lambda t, sized, *rest: groups.append(sized) or within(t, sized, *rest))
    found = op6.repeated_passages(spark.createDataFrame(texts, "doc_id bigint, text string")).filter("whole_line").collect()
    assert {(r.doc_id, r.removed) for r in found} == {(n, False) for n in near} | {(5000 + n, True) for n in near}
    assert len({r.cluster_id for r in found}) == len(near)
    assert groups[0].groupBy("c").count().agg(F.max("count")).first()[0] < 100


def test_finer_groups_lose_no_link(spark):
    texts = [(n, prose(n // 3, 14) + f" one{n} " + prose(500 + n // 3, 8)) for n in range(60)] + [(100 + n, prose(900, 10 + n % 4)) for n in range(40)] + [(200, "a")]
    links = {(a, b) for (a, s), (b, t) in combinations(texts, 2) if 10 * len(shingles(s, 3) & shingles(t, 3)) >= 6 * len(shingles(s, 3) | shingles(t, 3))}
    assert len(links) > 50
    frame = spark.createDataFrame(texts, "doc_id bigint, text string")
    sized = spark.createDataFrame([(d, len(shingles(t, 3)), 1 if d < 200 else 2) for d, t in texts], "doc_id bigint, n_shingles bigint, c bigint")
    sizes = {}
    for block_sets in (4, 1000):
        finer = op3.finer_groups(frame, sized, 3, 6, 10, block_sets)
        of = {r.doc_id: r.c for r in finer.collect()}
        assert all(of[a] == of[b] for a, b in links) and of[200] == 2
        sizes[block_sets] = max(Counter(of.values()).values())
        comp = {r.node: r.component for r in op6.components(op3.links_within(frame, finer, 3, 6, 10)).collect()}
        expected = components_by_hand([d for d, _ in texts], links)
        assert all((comp.get(a, a) == comp.get(b, b)) == (expected[a] == expected[b]) for (a, _), (b, _) in combinations(texts, 2))
    assert sizes[1000] == 100 and sizes[4] < 100


def test_rows_without_a_doc_id_keep_their_own_lines(spark, monkeypatch):
    """The lines of many rows that share a null doc_id are cut out of the row that has them, once."""
    cut = []
    texts = [(None, prose(n, 12) + "\n" + prose(1000 + n, 12)) for n in range(40)] + [(n, prose(n, 12)) for n in range(40)] + [(3, prose(3, 12))]

    def stored(df, keep=op6.stored):
        out = keep(df)
        if out.columns == ["doc_id", "text"]:
            cut.append((out.count(), out.select("doc_id").distinct().count()))
        return out

    monkeypatch.setattr(op6, "stored", stored)
    near = [(None if d is None else d + 100, "\n".join(x.replace(" w", " zz w", 1) for x in t.split("\n"))) for d, t in texts]
    found = op6.repeated_passages(spark.createDataFrame(texts + near, "doc_id bigint, text string")).collect()
    assert len(cut) == 1 and cut[0][0] == cut[0][1] > 0
    assert {r.doc_id for r in found if r.whole_line and not r.removed} >= set(range(40))


def test_passage_within_longer_lines_is_found(spark):
    passage = ". ".join(prose(n, 12).replace(".", "") for n in range(50, 55)) + "."
    texts = [(1, prose(1, 40) + ". " + passage + " " + prose(2, 40)), (2, prose(3, 70) + ". " + passage), (3, prose(4, 80))]
    found = op6.repeated_passages(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()
    assert {r.doc_id for r in found} == {1, 2} and {r.doc_id for r in found if r.removed} == {2}


def test_bands_are_tuned_for_recall():
    for similarity in (0.7, 0.8, 0.9):
        bands, width = op6.tune_bands(similarity)
        assert 1 - (1 - similarity**width) ** bands >= 0.999


# --- 7 fingerprints -------------------------------------------------------------------------------


def test_fingerprints_equal_brute_force(spark, docs):
    texts = {d: t or "" for d, t in TEXTS.items()} | {30: BASE + "\n" + prose(7, 4000).replace(",", ".\n"), 31: prose(8, 900).replace(".", "\n")}
    frame = table_of(spark, [*texts.items(), (6, texts[6])])
    order = sorted(texts, key=lambda d: (d is not None, d or 0), reverse=True)
    cut = lambda t: set(re.split(op7.PARAGRAPH_END, t))
    likeness = lambda a, b: len(cut(a) & cut(b)) / len(cut(a) | cut(b))
    rows = op7.fingerprint_report(frame).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        own, following = texts[r.doc_id], texts[order[(order.index(r.doc_id) + 1) % len(order)]]
        third = len(own) // 3
        edited = own[: len(own) - third] + following[:third]
        assert (r.n_chars, r.edited_sha256) == (len(own), hashlib.sha256(edited.encode()).hexdigest())
        for found, whole, other in ((r.near_edited, r.edited_recovered, edited), (r.near_next, r.next_recovered, following)):
            # what peeling does not recover counts as different
            assert math.isclose(found, likeness(own, other)) if whole else 0 <= found < likeness(own, other) + 1e-9
    assert sum(r.edited_recovered for r in rows) >= 0.7 * len(rows)
    prints = {r.doc_id: r.fingerprint for r in rows}
    assert prints[1] == prints[2] != prints[3] and prints[7] == prints[8]
    lines = {r.doc_id: r.fingerprint.count("\n") + 1 for r in rows}
    assert lines[7] == 1 and lines[30] >= 16  # a group of tables for each sixteen paragraphs


def test_paragraphs_end_in_any_script():
    cut = lambda t: re.split(op7.PARAGRAPH_END, t)
    assert cut("One. Two! three\nFour") == ["One. ", "Two! ", "three", "Four"]
    assert cut("Да. нет? конец") == ["Да. ", "нет? ", "конец"] and cut("一。二！三") == ["一。", "二！", "三"]
    assert cut("3.14 e.g.x") == ["3.14 e.g.x"]


def test_fingerprints_fold_and_tell_small_differences_of_long_texts(spark):
    keys = lambda a, b: f"array_sort(transform(sequence({a}, {b}), x -> xxhash64(x)))"
    row = spark.sql(f"""SELECT {op7.folded(op7.fingerprint('a'), '1')}[0] AS folded, {op7.table_of('a', op7.CELLS)} AS whole,
        {op7.groups_of('a')} AS parts, {op7.likeness('fa', 'fb')} AS near, {op7.likeness('fa', 'fc')} AS far, {op7.likeness('fa', 'fd')} AS other
        FROM (SELECT a, {op7.fingerprint('a')} AS fa, {op7.fingerprint('b')} AS fb, {op7.fingerprint('c')} AS fc, {op7.fingerprint('d')} AS fd
            FROM (SELECT {keys(1, 5000)} AS a, {keys(6, 5005)} AS b, {keys(1001, 5200)} AS c, {keys(9001, 9040)} AS d))""").first()
    assert row.folded == row.whole and len(row.parts) == 512
    assert sorted(x for p in row.parts for x in p) == [x for p in row.parts for x in p] and sum(map(len, row.parts)) == 5000
    assert row.near.whole and row.near.value == 4995 / 5005
    assert row.far.value <= 4000 / 5200 and row.far.value > 0.74
    assert row.other.value == 0.0


def test_fingerprints_of_one_row_and_none(spark, empty):
    one = spark.createDataFrame([(5, "abc")], "doc_id bigint, text string")
    row = op7.fingerprint_report(one).first()
    assert row.edited_sha256 == hashlib.sha256(b"aba").hexdigest() and row.near_next == 1.0
    assert op7.fingerprint_report(empty).count() == 0


def test_peeling_recovers_small_differences_and_fails_on_large_ones(spark):
    def peel(different, m):
        a = f"transform(sequence(1, 500), x -> xxhash64(x))"
        b = f"transform(sequence(1, {500 - different}), x -> xxhash64(x))"
        return spark.sql(f"SELECT {op7.peeled(op7.subtracted(op7.table_of(a, m), op7.table_of(b, m)), m)}").first()[0]

    assert [peel(n, 8) for n in (0, 1, 5)] == [0, 1, 5]
    assert peel(200, 8) is None and peel(30, 64) == 30


# --- 8 quality ----------------------------------------------------------------------------------


def test_quality_on_held_out_rows(spark):
    rng, rows, labels = random.Random(2), [], []
    for d in range(900):
        bad = rng.random() < 0.25
        text = prose(d, 60)
        if bad:
            text = rng.choice([text.upper().replace(" ", "!! "), " ".join(w * 1 for w in [text.split()[0]] * 60), text.replace(" ", "*** ")])
        rows.append((d, text))
        if d % 2:
            labels.append((d, int(not bad)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    frame = spark.createDataFrame(labels, "doc_id bigint, quality int")
    found = by_id(op8.quality_report(docs, frame))
    held = [(found[d], q) for d, q in labels if found[d].held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in found.values())
    assert sum(r.predicted == q for r, q in held) >= 0.95 * len(held) and len(held) > 80
    assert by_id(op8.quality_report(docs, frame)) == found


def test_quality_on_edges(spark, docs, empty):
    labels = spark.createDataFrame([(d, 1) for d in range(1, 15)] + [(None, 1), (3, None)], "doc_id bigint, quality int")
    rows = op8.quality_report(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in op8.quality_report(docs, labels.limit(0)).collect()} == {0.5}
    assert op8.quality_report(empty, labels).count() == 0


# --- 9 suffixes ------------------------------------------------------------------------------------


def removed_by_hand(texts):
    """texts: (doc_id, text) in any order; a string counts by its least (doc, start)."""
    least = {}
    last = 1 << 62
    for d, t in texts:
        b = (t or "").encode()
        for s in range(len(b) - 99):
            k, at = b[s : s + 100], (last if d is None else d, s)
            least[k] = min(least.get(k, at), at)
    out = []
    for d, t in texts:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - 99):
            if least[b[s : s + 100]] < (last if d is None else d, s):
                gone[s : s + 100] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def test_removed_bytes_equal_brute_force(docs, empty, spark):
    texts = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id not in (12, 13)] + [(6, TEXTS[14]), (12, LONG[:5000]), (13, "q" + LONG[:5000])]
    frame = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(4)
    assert Counter(tuple(r) for r in op9.dedup_report(frame).collect()) == removed_by_hand(texts)
    assert op9.dedup_report(empty).count() == 0


def test_bytes_that_begin_anywhere(spark, monkeypatch):
    rng = random.Random(11)
    pieces = ["".join(rng.choice("ab é") for _ in range(n)) for n in (99, 100, 101, 150, 240)]
    texts = [(d, "".join(rng.choice(pieces) + rng.choice(["", "x", "yz" * rng.randrange(40)]) for _ in range(rng.randrange(1, 6)))) for d in range(60)]
    frame = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3)
    monkeypatch.setattr(op9, "BUCKET_ROWS", 100)  # many buckets, so that equal strings cross their borders
    assert Counter(tuple(r) for r in op9.dedup_report(frame).collect()) == removed_by_hand(texts)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(*[st.integers(0, 2)] * 3), max_size=40))
def test_multikey_order_sorts(rows):
    keys = [np.array([r[i] for r in rows], np.int64) for i in range(3)]
    assert [rows[i] for i in op9.multikey_order(*keys)] == sorted(rows)


# --- 10 personal data -------------------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def spans_by_hand(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            double = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            ok = {
                "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 14 <= len(digits) <= 19 and sum(x // 10 + x % 10 for x in double) % 10 == 0,
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], list(PATTERNS).index(s[0])))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="aB@.10 -+()é\n%", max_size=60))
def test_base_spans_equal_the_patterns(text):
    assert op10.base_spans(text) == spans_by_hand(text)


def personal(spark):
    rng = random.Random(4)
    rows = []
    for d in range(300):
        kind = d % 6
        inside = [f"joe.{d}@mail{d % 9}.example.com", f"{rng.randrange(256)}.{rng.randrange(256)}.{d % 256}.9", "4556737586899855",
                  f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}", f"version {d % 9}.{d % 4}", ""][kind]
        rows.append((d, prose(d, 12) + " " + inside + " " + prose(d + 1000, 8)))
    rows += [(500, "call +1 (843) 555-7672 170.106.4.12 now"), (501, None), (502, ""), (503, "x" * 50_000 + "9" * 3000)]
    return spark.createDataFrame(rows, "doc_id bigint, text string"), rows


def test_report_has_base_spans_and_the_fields(spark):
    frame, rows = personal(spark)
    found = by_id(op10.pii_report(frame))
    for d, t in rows:
        spans = [f"{k}:{a}:{b}" for k, a, b in spans_by_hand(t)]
        assert found[d].base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert set(spans) <= set(found[d].spans.split(",")) or not spans
        assert found[d].n_phone == sum(s.startswith("phone") for s in spans)
    # the pattern takes in the next number and fails; the field finds the phone number's own end
    assert "phone:5:22" in found[500].spans.split(",")
    assert not any(found[d].n_added for d, _ in rows[:300]) and by_id(op10.pii_report(frame)) == found


def test_field_finds_other_ways_of_writing(spark):
    """Numbers and addresses that the base patterns do not take, among numbers that are nothing of the kind."""
    rng, rows, planted = random.Random(9), personal(spark)[1], {}
    for d in range(1000, 2200):
        number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
        near = [
            f"joe.{d % 300} @ mail{d % 9}.example.com", f"{rng.randrange(100, 256)} . {rng.randrange(100, 256)} . {rng.randrange(10, 99)} . {d % 9}",
            f"1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}", f"001 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}",
        ][d // 20 % 4]
        benign = [f"{number(2)},{number(3)}", f"in {rng.randrange(1900, 2030)}", f"{number(1)}.{number(2)} percent", f"page {number(3)}-{number(3)}", f"${number(4)}"][d % 5]
        if d % 20 == 0:  # few, as what is not labelled is learned from as no span
            lead = prose(d, 10) + " "
            text = lead + near + " " + prose(d + 1, 8) + " " + benign + " " + prose(d + 2, 5)
            planted[d] = len(lead), len(lead) + len(near)
        else:
            text = prose(d, 10) + " " + benign + " " + prose(d + 1, 10)
        rows.append((d, text))
    found = by_id(op10.pii_report(spark.createDataFrame(rows, "doc_id bigint, text string")))
    hits = sum(any(int(s.split(":")[1]) < b and a < int(s.split(":")[2]) for s in found[d].spans.split(",") if s) for d, (a, b) in planted.items())
    wrong = sum(found[d].n_added > 0 for d in range(1000, 2200) if d not in planted)
    assert hits >= 0.9 * len(planted), hits / len(planted)
    assert wrong <= 0.1 * hits, wrong


def test_a_long_run_of_numbers_needs_little_memory():
    import tracemalloc

    field = op10.Field()
    field.weights = {"bias": [-4.0] * 4, "digits=10": [3.0] * 4, "n=3": [0.5, 0, 0, 0]}
    text = " ".join(str(n) for n in range(10_000, 110_000))  # 600 KB, one zone
    tracemalloc.start()
    op10.added_spans(text, [], field, {})
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60_000_000, peak


def test_mask_and_edges(spark, docs, empty):
    frame, rows = personal(spark)
    field = op10.train(frame)
    masked = {r.doc_id: r for r in op10.mask(frame.withColumn("n_chars", F.length("text")), field).collect()}
    assert "<EMAIL>" in masked[0].text and masked[0].n_chars == len(masked[0].text) and masked[501].text is None
    assert not any(spans_by_hand(r.text) for r in masked.values())
    assert op10.mask(docs, field).columns == docs.columns
    assert op10.pii_report(empty).count() == 0 and op10.pii_report(docs).count() == docs.count()


def test_segment_posteriors_sum_to_the_enumeration():
    """The dynamic programme against all segmentations of a short zone."""
    rng = random.Random(3)
    shapes = ("a", " ", "91", ".", "92")
    segments = op10._segments(shapes)
    field = op10.Field()
    for _, _, features in segments:
        for f in features:
            field.weights.setdefault(f, [rng.uniform(-1, 1) for _ in op10.KINDS])
    scored, posteriors = field.posteriors(shapes, segments)
    every = []  # (score, entities)
    def extend(at, score, chosen):
        if at == len(shapes):
            every.append((score, chosen))
            return
        extend(at + 1, score, chosen)
        for s, (i, j, _) in enumerate(segments):
            if i == at:
                for k in range(len(op10.KINDS)):
                    extend(j, score + scored[s][k], chosen | {(s, k)})
    extend(0, 0.0, frozenset())
    total = sum(math.exp(v) for v, _ in every)
    for s in range(len(segments)):
        for k in range(len(op10.KINDS)):
            expected = sum(math.exp(v) for v, c in every if (s, k) in c) / total
            assert math.isclose(posteriors[s][k], expected, rel_tol=1e-9)
    best = max(every, key=lambda x: x[0])[1]
    assert {(segments[s][0], segments[s][1], k) for s, k in best} == {(i, j, k) for i, j, k, _ in field.decode(shapes)}
