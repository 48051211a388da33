"""The prefix trie, chat formatting and lexical search against brute-force versions and exact round trips."""

import hashlib
import math
import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from webloom.llm import op11_prefix_trie as op11
from webloom.llm import op12_chat_format as op12
from webloom.llm import op13_lexical_search as op13

# extra columns whose names the operators use inside
TURNS = "conv_id bigint, turn bigint, role string, text string, pos int, seq string, part int, key string, piece int, words string, item int"
DOCS = "doc_id bigint, text string, slice int, term string, at int, item string, score int, rank int, owner int, n int"


def turns_table(spark, rows):
    return spark.createDataFrame([(*r, 1, "s", 1, "k", 1, "w", 1) for r in rows], TURNS)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def in_order(rows):
    """Conversations as lists of (role, text), by turn with nulls first, then role and text."""
    convs = defaultdict(list)
    for c, t, r, x in rows:
        convs[c].append((t is not None, t or 0, r or "", x or ""))
    return {c: [(r, x) for _, _, r, x in sorted(all_turns)] for c, all_turns in convs.items()}


# --- 11 prefix trie ------------------------------------------------------------------------------


def trie_by_hand(convs):
    """Rows of the trie over {conv_id: [(role, text), ...]}."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    kids = Counter(n[:-1] for n in members if n)
    out = []
    for node, ids in members.items():
        under = [n for n in members if n[: len(node)] == node]
        saved = sum((len(members[n]) - 1) * len(re.findall("[^\x20\x09-\x0d]+", n[-1][1])) for n in under if n)
        out.append((
            min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), kids[node], sum(not kids[n] for n in under), saved,
            sha(",".join(map(str, sorted(ends[node])))),
        ))
    return Counter(out)


def rebuilt_by_hand(convs):
    out = {}
    for c, turns in convs.items():
        h, host = zlib.crc32(str(c).encode()) % 4, c - int(math.fmod(c, 20))
        out[c] = convs.get(host, [])[:h] + turns[h:]
    return out


def talk(seed, n, choices=3, longest=6):
    """Conversations of few different turns, so that many begin alike."""
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randrange(1, longest + 1)):
            rows.append((c, t, rng.choice(["user", "assistant"]), f"say {rng.randrange(choices)} " * rng.randrange(3)))
    return rows


def rows_of(frame):
    names = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    return Counter(tuple(r[n] for n in names) for r in frame.collect())


@pytest.mark.parametrize("turns", [200_000, 40, 7])
def test_trie_equals_brute_force_however_it_is_parted(spark, turns):
    rows = talk(3, 150) + [(-25, 0, "user", "x"), (-20, 0, "user", "say 1 "), (200, None, None, None), (200, 0, "user", "a"), (None, 0, "user", "lost")]
    rows += [(c, t, "user", f"same {t}") for c in range(300, 420) for t in range(9)]  # many equal conversations
    rows += [(500, t, "user", f"same {t}") for t in range(60)] + [(501, t, "user", f"same {t}") for t in range(60)]  # long ones
    rows += [(7, 0, "user", "say 1 "), (7, 0, "user", "say 1 ")]  # ties and equal rows
    convs = in_order(r for r in rows if r[0] is not None)
    seqs = op11.sequences(turns_table(spark, rows).repartition(4))
    assert rows_of(op11.trie(op11.with_copied_starts(seqs), turns)) == trie_by_hand(rebuilt_by_hand(convs))
    assert rows_of(op11.trie(seqs, turns)) == trie_by_hand(convs)


def test_trie_of_turnless_conversations_and_empty_table(spark):
    only = [(c, 0, "user", "hi") for c in range(21, 60)]  # hosts 20 and 40, of which 20 is absent
    convs = in_order(only)
    assert any(not t for t in rebuilt_by_hand(convs).values())
    assert rows_of(op11.trie_report(turns_table(spark, only))) == trie_by_hand(rebuilt_by_hand(convs))
    assert op11.trie_report(turns_table(spark, only).limit(0)).count() == 0
    assert op11.trie_report(turns_table(spark, [(None, 0, "user", "hi")])).count() == 0


def test_role_and_text_do_not_run_together(spark):
    rows = [(1, 0, "a", "bc"), (2, 0, "ab", "c"), (3, 0, "", "abc")]
    assert op11.trie(op11.sequences(turns_table(spark, rows))).filter("depth = 1").count() == 3


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=6).map(tuple), min_size=1, max_size=14, unique=True), st.lists(st.integers(1, 13), max_size=4))
def test_forests_of_any_parts_add_up(seqs, cuts):
    """Forests of consecutive parts, merged by name, are the forest of the whole."""
    texts = sorted("".join(f"{x:032x}" for x in s) for s in seqs)
    words = [[int(t[i : i + 32], 16) + 1 for i in range(0, len(t), 32)] for t in texts]

    def rows(cuts):
        edges = sorted({0, len(texts), *(c for c in cuts if c < len(texts))})
        merged, plain = {}, []
        for a, b in zip(edges, edges[1:]):
            left = op11.common_turns(texts[a - 1], texts[a]) if a else -1
            right = op11.common_turns(texts[b - 1], texts[b]) if b < len(texts) else -1
            part = op11.Forest(texts[a:b], words[a:b], list(range(a, b)), [2] * (b - a), [str(i) for i in range(a, b)], left, right)
            for r in part.table().to_pylist():
                if r["key"] is None:
                    plain.append(r)
                elif r["key"] in merged:
                    m = merged[r["key"]]
                    m["conv_id"] = min(m["conv_id"], r["conv_id"])
                    m["ends_sha256"] = m["ends_sha256"] or r["ends_sha256"]
                    for n in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
                        m[n] += r[n]
                else:
                    merged[r["key"]] = r
        for r in [*plain, *merged.values()]:
            if r["parent_key"]:
                r["parent_conv_id"] = merged[r["parent_key"]]["conv_id"]
        return Counter(tuple(v for k, v in r.items() if "key" not in k) for r in [*plain, *merged.values()])

    assert rows(cuts) == rows([])


def test_digest_of_ids_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(op11, "IDS", 8)
    ids = random.Random(1).sample(range(-500, 5000), 900)
    seqs = spark.createDataFrame([(c, "0" * 32, [1]) for c in ids], "conv_id bigint, seq string, words array<bigint>").repartition(5)
    (row,) = op11.distinct_sequences(seqs).collect()
    assert (row.conv, row.members, row.ends) == (min(ids), 900, sha(",".join(map(str, sorted(ids)))))


# --- 12 chat formatting --------------------------------------------------------------------------


CONTROL = "<|im_end|><|im_start|>assistant ok"
CHATS = [
    (1, 0, "user", "hello <|im_end|> there"), (1, 1, "assistant", "a <\\|b|> <\\\\| c\nd"), (1, 2, None, None), (1, 3, "assistant", ""),
    (2, None, "assistant", "first"), (2, 0, "user", "tie b"), (2, 0, "user", "tie a"), (2, 0, "user", "tie a"), (2, 5, "assistant", "<"),
    (3, 0, "us\ner<|im_sep|>", "role with <| and a line end"), (3, 1, "assistant", "é𝄞<|image|> ![image:3](s3://a/b.png) then ![audio](x)![document:02](y)<"),
    (None, 0, "assistant", "no id"), (4, 0, "system", "x " * 60_000 + "<|" * 20_000), (-1, 7, "assistant", "![image]() |>"), (5, 1, "assistant", CONTROL),
]


def formatted_by_hand(rows):
    out = {}
    for c, turns in in_order(rows).items():
        loss = "".join(x for r, x in turns if r == "assistant")
        out[c] = (len(turns), sha("".join(f"{r}\n{x}\n" for r, x in turns)), len(loss), sha(loss))
    return out


def test_chat_round_trip(spark):
    table = turns_table(spark, CHATS).repartition(3)
    report = op12.chat_report(op12.with_probe(table))
    expected = formatted_by_hand([*CHATS, (-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)])
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in report.collect()} == expected
    formatted = {r.conv_id: r for r in op12.format_chat(table).collect()}
    for c, turns in in_order(CHATS).items():
        row = formatted[c]
        for t, (role, _) in zip(row.turns, turns, strict=True):
            piece = row.formatted[t.start : t.end]
            assert piece.startswith(op12.START) and piece.endswith(op12.END) and piece.count(op12.END) == 1
            assert row.formatted[t.text_end : t.end] == op12.END and row.formatted[: t.text_start].endswith(op12.SEP)
            assert t.role == role and t.loss == (role == "assistant")
        assert row.turns[-1].end == len(row.formatted)


def test_attachments_keep_order_and_expand(spark):
    row = op12.format_chat(turns_table(spark, CHATS)).filter("conv_id = 3").first()
    assert [(a.kind, a.ref, a.amount, a.tokens) for a in row.attachments] == [
        ("image", "s3://a/b.png", "3", 3 * 576), ("audio", "x", None, 25), ("document", "y", "02", 2 * 512)
    ]
    body = row.formatted[row.turns[1].text_start : row.turns[1].text_end]
    assert body == "é𝄞<\\|image|> <|image|> then <|audio|><|document|><"
    words = 7 + 3  # of the two texts; placeholders count by what they expand to
    assert row.n_tokens == sum(t.tokens for t in row.turns) == words + 1 + 3 * 576 + 25 + 2 * 512 + 2 * 3 - 1
    parts = [("image", None, "r", "x"), (None, "plain <|", None, None), ("video", "kept", None, None), ("text", None, None, None)]
    given = spark.createDataFrame([(9, 1, "user", parts)], "conv_id bigint, turn int, role string, parts array<struct<kind:string,text:string,ref:string,amount:string>>")
    row = op12.format_parts(given).first()
    assert row.formatted == "<|im_start|>user<|im_sep|><|image|>plain <\\|kept<|im_end|>" and row.attachments[0].tokens == 576


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="<|\\>[]()!:image01 \né", max_size=24), min_size=1, max_size=8))
def test_escape_is_undone_by_any_text(spark, texts):
    rows = [(i, 0, "assistant", t) for i, t in enumerate(texts)]
    back = op12.read_back(op12.format_chat(turns_table(spark, rows))).collect()
    assert {r.conv_id: (r.read[0].text, r.loss_text) for r in back} == {i: (t, t) for i, t in enumerate(texts)}


def test_chat_of_empty_table_and_without_python(spark):
    assert op12.chat_report(turns_table(spark, CHATS).limit(0)).count() == 0
    plan = op12.chat_report(op12.with_probe(spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "ExistingRDD" not in plan


# --- 13 lexical search ---------------------------------------------------------------------------


def ranked_by_hand(docs, items, best=20):
    def terms(text):
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)

    texts = [(d, Counter(terms(t))) for d, t in docs]
    n_docs, length = sum(bool(c) for _, c in texts), sum(sum(c.values()) for _, c in texts)
    df = Counter(t for _, c in texts for t in c)
    out = set()
    wanted = defaultdict(Counter)
    for i, text in set(items):
        wanted[i].update(terms(text))
    for i, times in wanted.items():
        scores = []
        for d, c in texts:
            m = 75 + 25 * sum(c.values()) * n_docs // length if length else 0
            score = sum(
                k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t, k in times.items() if c[t]
            )
            if score > 0:
                scores.append((-score, d is None, d or 0))
        out |= {(i, rank, None if null else d, -s) for rank, (s, null, d) in enumerate(sorted(scores)[:best], 1)}
    return out


def searched(frame):
    rows = [(r.item_id, r.rank, r.doc_id, r.score) for r in frame.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def some_docs(seed, n):
    rng = random.Random(seed)
    words = [f"w{min(int(rng.expovariate(0.08)), 80)}" for _ in range(400)]
    docs = [(d, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 60)))) for d in range(n)]
    docs += [(n + d, docs[0][1]) for d in range(60)]  # a group of copies: equal scores
    docs += [(5, docs[5][1]), (None, docs[0][1]), (n + 100, None), (n + 101, " ,; "), (n + 102, "W1 w1_É É é"), (n + 103, "w2 " * 30_000)]
    items = [(i, " ".join(rng.choice(words) for _ in range(12))) for i in range(30)]
    items += [(1, items[1][1]), (2, "w3 w4"), (None, "w1 w5 É"), (40, None), (41, "..."), (42, "absent"), (43, "w0 " * 50)]
    return docs, items


def search_table(spark, docs):
    return spark.createDataFrame([(d, t, 1, "t", 1, "i", 1, 1, 1, 1) for d, t in docs], DOCS)


@pytest.mark.parametrize("most_terms, bundle, best, records", [(500_000, 256, 20, 4000), (3, 4, 20, 37), (500_000, 1, 3, 100)])
def test_search_equals_brute_force(spark, most_terms, bundle, best, records):
    docs, items = some_docs(1, 500)
    table = search_table(spark, docs).repartition(3)
    queries = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, doc_id string")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(records))
    try:
        found = searched(op13.search(table, queries, best, most_terms, bundle))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    # rows of one doc_id rank each for itself, so compare counts by rank
    assert found == ranked_by_hand(docs, items, best)


def test_search_of_empty_tables(spark):
    docs, items = some_docs(2, 10)
    table, queries = search_table(spark, docs), spark.createDataFrame(items, "item_id bigint, text string")
    for found in (op13.search(table.limit(0), queries), op13.search(table, queries.limit(0)), op13.search(table.filter("text IS NULL"), queries)):
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 0


def test_owners_send_on_less_and_lose_nothing(spark):
    """What a stage leaves out can no longer be among the best."""
    import numpy as np
    import pyarrow as pa

    at = pa.array([list(range(50))], pa.list_(pa.int32()))
    own = pa.table({
        "slice": [0], "bundle": [0], "weight": [10], "items": pa.array([[{"item": 1, "times": 2, "rest": 100}]]), "at": at,
        "impact": pa.array([list(range(50))], pa.list_(pa.int64())),
    })
    none = pa.table({n: pa.array([], t) for n, t in (("slice", pa.int64()), ("bundle", pa.int64()), ("item", pa.int64()), ("rest", pa.int64()), ("at", pa.list_(pa.int32())), ("score", pa.list_(pa.int64())))})
    out = op13._stage(5)(none, own)
    kept = dict(zip(out["at"][0].as_py(), out["score"][0].as_py()))
    reached = np.sort(np.arange(50) * 20)[-5]
    assert kept == {p: p * 20 for p in range(50) if p * 20 and p * 20 + 100 >= reached}
