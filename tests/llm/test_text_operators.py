"""Line dedup, decontamination, near duplicates and LM scoring against brute force."""

import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import automaton, decontam, linededup, lmscore, neardup
from tidewater.llm.common import components, stored, table

SF001 = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words_of(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(5)) for _ in range(n)]


# ---- line dedup -------------------------------------------------------------

def brute_lines(rows):
    """rows: (doc_id, text) in order of id; the texts without repeated windows."""
    seen, out = set(), {}
    for i, text in rows:
        lines = (text or "").split("\n")
        gone = set()
        for p in range(len(lines) - 2):
            w = tuple(x.strip(" \t\r") for x in lines[p:p + 3])
            if "".join(w) and w in seen:
                gone |= {p, p + 1, p + 2}
            seen.add(w)
        out[i] = text if not gone else "\n".join(x for p, x in enumerate(lines) if p not in gone)
    return out


def test_lines_match_brute_force(spark):
    docs = table(spark, SF001, "documents")
    got = {r.doc_id: r.text for r in linededup.dedup_lines(docs).collect()}
    assert got == brute_lines(sorted((r.doc_id, r.text) for r in docs.collect()))


def test_lines_edges(make_docs):
    rows = [(1, "a\nb\nc\nd", "s"), (2, "x\na \nb\nc\nd\ny", "s"), (3, None, "s"), (4, "", "s"), (5, "a\nb", "s"),
            (6, "q\nq\nq\nq\nq", "s"), (7, "\n\n\n", "s"), (8, "\n\n\n", "s"), (None, "a\nb\nc", "s"),
            (9, "k\nl\nm", "s"), (9, "k\nl\nm", "s"), (10, "z\n" * 5000, "s")]
    docs = make_docs([r + ("mine",) for r in rows], ", n_removed string")
    out = linededup.dedup_lines(docs)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_lines", "n_removed"]
    got = [(r.doc_id, r.text) for r in out.collect()]
    assert len(got) == len(rows)
    by = dict(got)
    assert by[1] == "a\nb\nc\nd" and by[2] == "x\ny" and by[3] is None and by[4] == "" and by[5] == "a\nb"
    assert by[6] == "q" and by[7] == by[8] == "\n\n\n" and by[None] == "" and by[10] == "z\n"[:1] + "\n"
    assert got.count((9, "k\nl\nm")) == 2  # rows equal in id and text are one occurrence
    assert linededup.dedup_lines(docs.limit(0)).count() == 0


# ---- decontamination ----------------------------------------------------------

def brute_overlap(doc, item):
    a, b = WORD.findall((doc or "").lower()), WORD.findall((item or "").lower())
    if not b:
        return False
    need = min(13, len(b))
    for diag in range(-len(b) + 1, len(a)):
        same = [a[i] == b[i - diag] for i in range(max(diag, 0), min(len(a), len(b) + diag))]
        if any(sum(same[i:i + need]) >= math.ceil(need * 0.8) for i in range(len(same) - need + 1)):
            return True
    return False


def test_overlaps_match_brute_force(spark):
    docs = table(spark, SF001, "documents").where("n_chars < 2500")
    bench = table(spark, SF001, "benchmark")
    got = {(r.doc_id, r.item_id) for r in decontam.overlaps(docs, bench).collect()}
    items = [(r.item_id, r.text) for r in bench.collect()]
    want = {(r.doc_id, i) for r in docs.collect() for i, t in items if brute_overlap(r.text, t)}
    assert got == want and want


def test_short_items_match_brute_force(spark, make_docs):
    rng = random.Random(4)
    items = [(n, " ".join(words_of(n, 300 + n))) for n in range(13)]
    texts = []
    for n, item in items:
        for p in range(-1, n):  # as it is, then with each word replaced, at either end of a text and inside it
            body = item.split()
            if p >= 0:
                body[p] = "other"
            around = words_of(9, rng.randrange(10**6))
            texts += [" ".join(body), " ".join(around[:4] + body + around[4:]), " ".join(around + body)]
        texts.append(" ".join(item.split()[:-1]))
    docs = make_docs([(i, t, "s") for i, t in enumerate(texts)])
    bench = spark.createDataFrame(items, "item_id int, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.overlaps(docs, bench).collect()}
    want = {(i, n) for i, t in enumerate(texts) for n, item in items if brute_overlap(t, item)}
    assert got == want and {n for _, n in want} == set(range(1, 13))
    loose = {(r.doc_id, r.item_id) for r in decontam.overlaps(docs, bench, min_overlap=6).collect()}
    assert loose >= got


def test_overlaps_survive_substitutions(spark, make_docs):
    item = words_of(40, 1)
    texts = {}
    for k in range(10):
        body = list(item)
        for p in random.Random(k).sample(range(40), 4):
            body[p] = f"other{p}"
        texts[k] = " ".join(words_of(30, 50 + k) + body + words_of(20, 70 + k))
    clean = {100 + k: " ".join(words_of(80, 200 + k) + item[3 * k:3 * k + 4]) for k in range(5)}
    rows = [(i, t, "s") for i, t in {**texts, **clean}.items()]
    rows += [(200, None, "s"), (201, "", "s"), (None, " ".join(item).upper(), "s"), (None, " ".join(item).upper(), "s"),
             (202, "w " * 50_000 + " ".join(item), "s"), (203, " ".join(item[:13]), "s"), (204, " ".join(item[:12]), "s")]
    bench = spark.createDataFrame([(1, " ".join(item), "x"), (1, " ".join(item), "x"), (2, None, "x"), (3, "a b", "x"),
                                   (None, "one two three four five", "x")], "item_id int, text string, doc_id string")
    docs = make_docs(rows)
    got = decontam.overlaps(docs, bench).collect()
    assert {r.doc_id for r in got} == {*range(10), None, 202, 203}
    assert {r.item_id for r in got} == {1} and len([r for r in got if r.doc_id is None]) == 1
    long = next(r for r in got if r.doc_id == 202)
    assert (long.doc_start, long.item_start, long.overlap, long.matched) == (50_000, 0, 40, 40)
    kept = decontam.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [100, 101, 102, 103, 104, 200, 201, 204]
    shuffled = decontam.overlaps(docs, bench, broadcast_seeds=0)
    assert {(r.doc_id, r.matched) for r in shuffled.collect()} == {(r.doc_id, r.matched) for r in got}
    assert decontam.overlaps(docs.limit(0), bench).count() == 0
    assert decontam.decontaminate(docs, bench.limit(0)).count() == len(rows)


# ---- near duplicates ----------------------------------------------------------

def brute_similarity(a, b, k=5):
    def shingles(text):
        w = (text or "").lower().encode().split()
        rows = [tuple(w)] if 0 < len(w) < k else [tuple(w[i:i + k]) for i in range(len(w) - k + 1)]
        seen = Counter()
        out = []
        for r in rows:
            out.append((r, seen[r]))
            seen[r] += 1
        return out
    x, y = shingles(a), shingles(b)
    if not x and not y:
        return 1.0
    row = [0] * (len(y) + 1)
    for p in x:
        before = 0
        for j, q in enumerate(y):
            keep = row[j + 1]
            row[j + 1] = before + 1 if p == q else max(row[j + 1], row[j])
            before = keep
    return row[-1] / (len(x) + len(y) - row[-1])


def test_similarity_is_the_alignment():
    rng = random.Random(3)
    for case in range(40):
        a = words_of(60, case) if case % 3 else ["u", "v"] * 30
        b = list(a)
        for _ in range(rng.randrange(4)):
            b[rng.randrange(60)] = "changed"
        if case % 5 == 0:
            b = b[30:] + b[:30]
        want = brute_similarity(" ".join(a), " ".join(b))
        got = neardup.similarity(neardup.kmers(" ".join(a), 5), neardup.kmers(" ".join(b), 5), 0.8)
        assert (got >= 0.8) == (want >= 0.8)
        if got >= 0.8:
            assert got == pytest.approx(want)


def test_near_classes_match_brute_force(spark):
    docs = table(spark, SF001, "documents").where("n_chars < 1500")
    got = {r.doc_id: r.class_id for r in neardup.near_classes(docs).collect()}
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for n, (i, a) in enumerate(rows):
        for j, b in rows[n + 1:]:
            if 0.7 < (len(a) + 1) / (len(b) + 1) < 1.4 and brute_similarity(a, b) >= 0.8:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    assert got == {i: find(i) for i in root}


def test_near_edges(spark, make_docs):
    base = words_of(300, 9)
    copy = lambda *at: " ".join("swapped" if p in at else w for p, w in enumerate(base))
    rows = [(5, copy(), "s"), (6, copy(), "s"), (7, copy(40), "s"), (8, copy(100, 200), "s"), (20, copy().upper(), "s"),
            (30, " ".join(words_of(300, 10)), "s"), (31, None, "s"), (32, "", "s"), (33, " \n", "s"), (34, "one two", "s"),
            (35, "one two", "s"), (None, "only here " * 20, "s"), (40, " ".join(base[:150]), "s"),
            (41, "dup row text a b c", "s"), (41, "dup row text a b c", "s"), (50, " ".join(words_of(120_000, 4)), "s")]
    rows += [(1000 + k, copy(10 + k % 250), "s") for k in range(40)]  # one large group
    docs = make_docs([r + (1,) for r in rows], ", key int")
    got = {r.doc_id: r.class_id for r in neardup.near_classes(docs).collect()}
    assert {i for i, c in got.items() if c == 5} == {5, 6, 7, 8, 20, *range(1000, 1040)}
    assert got[31] == got[32] == got[33] == 31 and got[35] == got[34] == 34 and got[30] == 30 and got[40] == 40
    assert got[None] is None and got[50] == 50
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids, key=lambda i: (i is None, i)) == [5, 30, 31, 34, 40, 41, 50, None]
    assert neardup.near_classes(docs.limit(0)).count() == 0 and neardup.keep_one(docs.limit(0)).count() == 0


def brute_classes(texts, least=0.8, k=5):
    """Classes of texts whose common shingles are in one order in all of them: plain set similarity."""
    sets = [{tuple(w[i:i + k]) for i in range(len(w) - k + 1)} for w in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i + 1, len(sets)):
            same = len(a & sets[j])
            if same >= least * (len(a) + len(sets[j]) - same):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i in range(len(texts))}


def test_near_pairs_inside_a_template_group(spark, make_docs):
    form, texts = words_of(344, 21), []  # 340 of 400 shingles in common: 0.74 pairwise
    for p in range(150):
        tail = words_of(60, 1000 + p)
        same = 17 + p % 3  # with the form, 0.806 to 0.815
        texts += [form + tail, form + tail[:same] + words_of(60 - same, 5000 + p)]
    want = brute_classes(texts)
    assert sum(i != c for i, c in want.items()) == 150
    docs = make_docs([(i, " ".join(w), "s") for i, w in enumerate(texts)])
    assert {r.doc_id: r.class_id for r in neardup.near_classes(docs).collect()} == want


def test_rounds_end_once_they_find_hardly_a_link(spark, make_docs, monkeypatch):
    form, texts = words_of(344, 22), []  # one large group of 0.74 pairwise, few near pairs inside
    for p in range(120):
        tail = words_of(60, 20000 + p)
        texts.append(form + tail)
        if p % 4 == 0:
            texts.append(form + tail[:18] + words_of(42, 30000 + p))
    rounds, compared = [], neardup._with_leader
    monkeypatch.setattr(neardup, "_with_leader", lambda *a: rounds.append(a[1]) or compared(*a))
    monkeypatch.setattr(neardup, "_YIELD", 1.1, raising=False)  # none is worth another one
    docs = make_docs([(i, " ".join(w), "s") for i, w in enumerate(texts)])
    assert {r.doc_id: r.class_id for r in neardup.near_classes(docs).collect()} == brute_classes(texts)
    assert len(rounds) == 1
    assert rounds[0].count() == rounds[0].select("bucket").distinct().count() > 0  # one leader a bucket


def test_exact_join_deals_out_only_what_can_be_a_first_common_shingle(spark, make_docs, monkeypatch):
    texts = []  # pairs of many parts that share 12 % of their shingles, and cut copies at 0.8 to 0.97
    for p in range(60):
        own = words_of(196, 40000 + p)
        texts += [own + words_of(24, 7), own[:160 + p % 37] + words_of(24, 7)]
    kept, write = {}, neardup.stored
    monkeypatch.setattr(neardup, "stored", lambda df, name, **o: kept.setdefault(name, write(df, name, **o))
                        if name == "rare-open" else write(df, name, **o))
    docs = make_docs([(i, " ".join(w), "s") for i, w in enumerate(texts)])
    assert {r.doc_id: r.class_id for r in neardup.near_classes(docs).collect()} == brute_classes(texts)
    assert {"tail", "after"} <= set(kept["rare-open"].columns)
    for r in kept["rare-open"].collect():
        assert 1 <= r.after <= r.n and 0.8 * r.n - 1 <= r.tail <= r.n


def test_exact_join_gives_the_lists_their_labels_once(spark, make_docs, monkeypatch):
    texts, plans, write = [], {}, neardup.stored
    for p in range(60):
        long = words_of(40, 50000 + p)
        texts += [long, long[:-1]]

    def noted(df, name, **o):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return write(df, name, **o)
    monkeypatch.setattr(neardup, "stored", noted)
    docs = make_docs([(i, " ".join(w), "s") for i, w in enumerate(texts)])
    assert {r.doc_id: r.class_id for r in neardup.near_classes(docs).collect()} == brute_classes(texts)
    # the shared shingles come from the labelled lists as written, not from another join of lists and labels
    assert "Join" in plans["rare"] and "Join" not in plans["open"]


def test_stored_leaves_no_shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {n for n in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in n}
    before = files()
    out = stored(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "few")
    end = time.time() + 20
    while files() - before and time.time() < end:
        time.sleep(0.2)
    assert not files() - before and out.count() == 7


def test_near_pairs_of_short_texts(spark, make_docs):
    texts = []
    for p in range(300):
        long = words_of(9 + p % 3, 9000 + p)  # 5 to 7 shingles, the last one cut off: at least 0.8
        texts += [long, long[:-1]]
    want = brute_classes(texts)
    assert sum(i != c for i, c in want.items()) == 300
    docs = make_docs([(i, " ".join(w), "s") for i, w in enumerate(texts)])
    assert {r.doc_id: r.class_id for r in neardup.near_classes(docs).collect()} == want


def test_components_of_a_long_chain(spark):
    edges = spark.range(60).selectExpr("id a", "id + 1 b").unionAll(spark.createDataFrame([(100, 100), (7, 3)], "a long, b long"))
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100}


# ---- language-model scoring ---------------------------------------------------

def brute_scores(rows, order, strength=8.0, growth=0.7):
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows}
    toks = [(i, ["<s>"] + [w.decode("utf-8") for w in (t or "").encode().lower().split()] + ["</s>"]) for i, t in rows]
    counts = [Counter() for _ in range(order)]
    for i, t in toks:
        if not held[i]:
            for p in range(len(t)):
                for n in range(order):
                    if p >= n:
                        counts[n][tuple(t[p - n:p + 1])] += 1
    uni = {w: c for w, c in counts[0].items() if w != ("<s>",)}
    total, size = sum(uni.values()), len(uni)
    once, twice = sum(c == 1 for c in uni.values()), sum(c == 2 for c in uni.values())
    d = (once + 1) / (once + 2 * twice + 2)
    out = []
    for i, t in toks:
        base = score = 0.0
        for p in range(1, len(t)):
            c = uni.get((t[p],), 0)
            base += math.log10((c + 1) / (total + size + 1))
            prob = (c - d) / total if c else d * size / total
            for n in range(1, order):
                if p < n:
                    break
                h = counts[n - 1][tuple(t[p - n:p])]
                if h:
                    g = strength * h**growth
                    prob = counts[n][tuple(t[p - n:p + 1])] / h * (1 - g / (h + g)) + g / (h + g) * prob
            score += math.log10(prob)
        out.append((i, held[i], len(t) - 1, sum((w,) in uni for w in t[1:]), total, round(base, 6), round(score, 6)))
    return out


HELD = "crc32(encode(coalesce(cast(doc_id as string), ''), 'UTF-8')) % 7 = 2"


@pytest.mark.parametrize("order,block", [(2, 16 << 20), (3, 20_000)])
def test_scores_match_brute_force(spark, make_docs, order, block):
    rows = [(r.doc_id, r.text) for r in table(spark, SF001, "documents").where("n_chars < 800").collect()]
    rows += [(9001, None), (9002, ""), (9003, "\u00a0 \u2003x"), (None, "the THE thE"), (None, "the THE thE"), (9004, "the " * 30_000)]
    docs = make_docs([(i, t, "s", "clash") for i, t in rows], ", held_out string")
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6))
           for r in lmscore.score_texts(docs, HELD, order=order, block_bytes=block).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    for a, b in zip(sorted(got, key=key), sorted(brute_scores(rows, order), key=key), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-6, abs=1e-4)


def test_scores_without_training(spark, make_docs):
    docs = make_docs([(1, "a b", "s")])
    row = lmscore.score_texts(docs, "true").collect()[0]
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens, row.score) == (True, 3, 0, 0, 0.0)
    assert lmscore.score_texts(docs.limit(0), "true").count() == 0


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_automaton_state_is_carried_over_any_lanes(monkeypatch, order):
    rng = np.random.default_rng(order)
    texts = [" ".join(rng.choice(list("abcdefg"), size=rng.integers(0, 30))) for _ in range(60)]
    tokens, lengths = lmscore._tokens(texts, lmscore._Vocabulary())
    grams = lmscore._grams(tokens, lengths, order)
    keys, place = zip(*(lmscore._distinct(g) for g in grams), strict=True)
    begins = np.zeros(len(tokens), bool)
    begins[np.cumsum(lengths) - lengths] = True
    learnt = np.repeat(np.arange(len(texts)) % 3 > 0, lengths)  # the other texts hold unknown n-grams
    counts = [np.bincount(p[learnt], minlength=len(k)) for p, k in zip(place, keys, strict=True)]
    n = int((learnt & ~begins).sum())
    machine, states = automaton.build(list(place), [g != 0 for g in grams], counts, n, 8, 0.5, 8.0, 0.7)
    assert (machine.fail_to < np.maximum(np.arange(len(machine.fail_to)), 1)).all()  # failure arcs lead to shorter histories
    got = []
    for lanes in (1, 2, 7, len(tokens), 10 * len(tokens)):
        monkeypatch.setattr(automaton, "LANES", lanes)
        got.append(machine.traverse(place[0], begins, int(states[place[0][0]]), order - 1))
    for other in got[1:]:
        assert np.allclose(got[0], other, atol=1e-12)
    # the words known and the unknown word share a weight of one in every state that a text goes on from
    words = np.flatnonzero((counts[0] > 0) & (keys[0] != lmscore._START))
    end = states[np.flatnonzero(keys[0] == lmscore._END)[0]]
    for state in range(len(machine.fail_to)):
        _, weight = machine.step(np.full(len(words), state), words)
        rest, at, last = machine.unknown_log, state, 0
        while at:
            rest, last, at = rest + machine.fail_log[at], at, machine.fail_to[at]
        if last == 0 or last != end:
            assert (10**weight).sum() + 10**rest == pytest.approx(1.0)
