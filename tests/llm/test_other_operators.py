"""Mixing, URL verdicts, Hamming search, chat pairs, classifiers and the pipeline."""

import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from tidewater.llm import chat, hamming, mixing, quality, toxicity, urlfilter
from tidewater.llm.common import table

SF001 = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.mark.parametrize("name", ["op2_preference_pairs", "op3_benchmark_overlap", "op4_line_dedup",
                                  "op5_hamming_top_k", "op8_mix"])
def test_registered_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    want = con.execute(E.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    norm = lambda v: round(v, 9) if isinstance(v, float) else v
    rows = sorted((tuple(map(norm, r)) for r in want.fetchall()), key=str)
    got = sorted((tuple(map(norm, r)) for r in E.queries()[name](spark, SF001).select(*columns).collect()), key=str)
    assert got == rows


# ---- mixing -------------------------------------------------------------------

def brute_targets(sizes, share=1.5, weights=(5, 2, 1), epochs=2):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, target = share * sum(sizes.values()), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total >= epochs * sizes[s]]
        if not over:
            return target | {s: left * weight[s] / total for s in open_}
        for s in over:
            target[s] = epochs * sizes[s]
        left -= sum(target[s] for s in over)
        open_ -= set(over)
    return target


@pytest.mark.parametrize("bucket", [3, 20_000])
def test_mix_meets_targets(make_docs, bucket):
    rng = random.Random(2)
    rows = [(i, " ".join(["w"] * rng.randrange(40)), rng.choice(["hot"] * 6 + ["b", "Z", "é", None])) for i in range(400)]
    rows += [(None, "a b c", "b"), (None, "a b c", "b"), (900, None, "hot"), (901, "", "empty"), (7, "x", "hot")]
    docs = make_docs([r + (3,) for r in rows], ", size int")
    got = mixing.mix(docs, rows_per_bucket=bucket).collect()
    assert len(got) == len(rows)
    sizes, taken = {}, {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        assert 0 <= r.taken <= 2 * r.size
    want = brute_targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    assert all(taken[s] == int(want[s] + 1e-9) for s in sizes)
    again = mixing.mix(docs.repartition(7), rows_per_bucket=bucket).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert mixing.mix(docs.limit(0)).count() == 0


# ---- url verdicts ---------------------------------------------------------------

def brute_url(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(h + p, v) for v, h, p in urlfilter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *max(fits, key=lambda f: len(f[0]))) if fits else (host, path, None, None)


def test_urls(spark):
    urls = ["http://a.example.org/es/1", "http://EXAMPLE.ORG/en/1234", "http://example.org/en/2", "https://x.com/fr/9",
            "https://x.com/de/9", "https://xcom/de/9", "http://com/de/", "http://org", "http://b.org?x=/", "http://b.org/#y",
            "nothing", "", None, "a://b://c/d", "http://h.net/p/q/deadbeef12/77", "http://É.net/A", "http://n.net//x//"]
    rows = [(i, u, "x") for i, u in enumerate(urls)]
    rows += [(100 + i, f"http://spam.net/bad/{i}.html", "x") for i in range(60)]
    rows += [(200 + i, f"http://spam.net/good/{i}.html", "x") for i in range(60)]
    rows += [(300, "http://deep.net/" + "/".join(map(str, range(50))), "x"), (None, "http://spam.net/bad/1", "x"),
             (301, "http://long.net/" + "a" * 100_000, "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, rule string")
    rated = spark.createDataFrame([(100 + i, 1) for i in range(40)] + [(200 + i, 0) for i in range(40)] +
                                  [(None, 1), (3, None)], "page_id bigint, bad int")
    got = urlfilter.judge(pages, rated).collect()
    assert len(got) == len(rows)
    url_of = {i: u for i, u, _ in rows}
    for r in got:
        host, path, rule, verdict = brute_url(url_of[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
    by = {r.page_id: r for r in got}
    assert by[159].verdict == "block" and by[159].template == "/bad/<n>" and by[None].verdict == "block"
    assert by[259].verdict == "allow" and by[300].template.count("/") == 50 and by[12].template == ""
    cut = {r.page_id: r for r in urlfilter.judge(pages, rated, depth=8).collect()}
    assert cut[300].template.count("/") == 9 and cut[159].template == "/bad/<n>"
    assert urlfilter.judge(pages.limit(0), rated).count() == 0
    assert urlfilter.judge(pages, rated.limit(0)).count() == len(rows)


def test_small_and_deep_branches_are_told_apart(spark):
    deep = "http://deep.net/" + "a/" * 12
    rows = [(i, f"http://hot.net/good{i % 90}x/{i}") for i in range(9000)]
    rows += [(10_000 + i, f"http://hot.net/bad/{i}") for i in range(40)]  # 0.44 % of the node's urls
    rows += [(20_000 + i, f"{deep}{'bad' if i % 2 else 'good'}/{i}") for i in range(80)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    rated = spark.createDataFrame([(i, int(i >= 10_000 and (i < 20_000 or i % 2 == 1))) for i, _ in rows
                                   if i >= 10_000 or i % 10 == 0], "page_id bigint, bad int")
    by = {r.page_id: r for r in urlfilter.judge(pages, rated).collect()}
    assert len(by) == len(rows)
    for i, url in rows:
        assert by[i].verdict == ("block" if "/bad/" in url else "allow"), url
    assert by[10_000].template == "/bad/<n>" and by[20_001].template.endswith("/bad/<n>")


def brute_templates(shapes, min_count=20, z=1.96):
    """The tree, one level after the other: {(host, segs): template} of (host, segs, n, rated, bad)."""
    wild = lambda s: "<n>" if "<n>" in s else "*"
    out = {}

    def grow(rows, template):
        branches = {}
        for key, rest, n, rated, bad in rows:
            if not rest:
                out[key] = template
            else:
                b = branches.setdefault(rest[0], [0, 0, 0, []])
                b[0], b[1], b[2] = b[0] + n, b[1] + rated, b[2] + bad
                b[3].append((key, rest[1:], n, rated, bad))
        total, marked = sum(b[1] for b in branches.values()), sum(b[2] for b in branches.values())
        p = (marked + 1) / (total + 2)
        bands, own = {}, {}
        if sum(b[0] for b in branches.values()) >= min_count and 0 < marked < total:
            for s, (n, rated, bad, _) in branches.items():
                if n >= min_count and rated and abs(bad - rated * p) > z * (rated * p * (1 - p) + 1) ** 0.5:
                    band = (bad > rated * p, int(16 * (bad + 1) / (rated + 2)))
                    bands.setdefault(band, []).append(s)
        group, groups = None, []
        for band in sorted(bands):
            r, m = (sum(branches[s][i] for s in bands[band]) for i in (1, 2))
            if group and group[0] == band[0]:
                q = (m + group[2] + 1) / (r + group[1] + 2)
                if abs(m / r - group[2] / group[1]) <= z * (q * (1 - q) * (1 / r + 1 / group[1])) ** 0.5:
                    group[1:] = [group[1] + r, group[2] + m, group[3] + bands[band]]
                    continue
            group = [band[0], r, m, bands[band]]
            groups.append(group)
        for *_, members in groups:
            for s in members:
                own[s] = s if len(members) == 1 and s not in ("*", "<n>") and s[0] != "{" else (
                    "{%s|+%d}" % (min(members), len(members) - 1))
        below = {}
        for s, b in branches.items():
            below.setdefault(own.get(s, wild(s)), []).extend(b[3])
        for name, rows in below.items():
            grow(rows, template + "/" + name)

    hosts = {}
    for host, segs, *counts in shapes:
        hosts.setdefault(host, []).append(((host, segs), segs, *counts))
    for rows in hosts.values():
        grow(rows, "")
    return out


def test_templates_match_brute_force(spark):
    rng = random.Random(12)
    shapes = {}
    for _ in range(3000):
        host = rng.choice(["a", "a", "a", "b", "c"])
        segs = tuple(rng.choice(["x", "y", "z", "w", "u", "<n>", "v<n>", "{x|+1}", "*"]) for _ in range(rng.randrange(6)))
        shapes[host, segs] = None
    rows = []
    for host, segs in shapes:
        rate = 0.9 if segs[:1] in (("x",), ("y",)) else 0.5 if segs[:1] == ("z",) else 0.1
        rate = 1 - rate if segs[1:2] == ("w",) else rate
        rated = rng.randrange(6)
        rows.append((host, segs, rated + rng.randrange(4), rated, sum(rng.random() < rate for _ in range(rated))))
    rows += [("deep", ("p",) * 1000 + (s,), 50, 30, 30 * (s in "ab")) for s in "abcd"]
    df = spark.createDataFrame([(h, list(s), *r) for h, s, *r in rows],
                               "host string, segs array<string>, n bigint, rated bigint, bad bigint")
    got = {(r.host, tuple(r.segs)): r.template for r in urlfilter.templates(df).collect()}
    want = {k: v for k, v in brute_templates([r for r in rows if r[0] != "deep"]).items()}
    assert {k: v for k, v in got.items() if k[0] != "deep"} == want
    assert any("|+1}" in t for t in want.values()) and len(got) == len(rows)
    ends = {k[1][-1]: t for k, t in got.items() if k[0] == "deep"}
    assert ends == {s: "/*" * 1000 + ("/{a|+1}" if s in "ab" else "/{c|+1}") for s in "abcd"}


def test_alike_siblings_merge(spark):
    rows = [(1000 * b + i, f"http://h.net/{'abcd'[b]}/{i}") for b in range(4) for i in range(200)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    rated = spark.createDataFrame([(i, int(i < 2000)) for i, _ in rows], "page_id bigint, bad int")
    got = {(r.template, r.verdict) for r in urlfilter.judge(pages, rated).collect()}
    assert got == {("/{a|+1}/<n>", "block"), ("/{c|+1}/<n>", "allow")}


# ---- Hamming search ---------------------------------------------------------------

def test_top_k_is_exact(spark):
    rng = np.random.default_rng(5)
    codes = [int(x) for x in rng.integers(-2**63, 2**63 - 1, 300)]
    codes += [codes[0] ^ (1 << int(b)) for b in rng.integers(0, 62, 40)] + [codes[1]] * 60
    rows = list(enumerate(codes))
    df = spark.createDataFrame(rows + [(None, 5), (9999, None), (1, codes[1])], "id bigint, code bigint")
    asked = df.where("id % 20 = 0 or id = 9999 or id is null")
    got = {}
    for r in hamming.top_k(df, asked, k=7).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.distance, r.neighbor_id))
    for q, c in rows:
        if q % 20 == 0:
            want = sorted(((c ^ d) & (2**64 - 1)).bit_count() * 10**6 + i for i, d in rows if i != q)[:7]
            assert [d * 10**6 + i for d, i in got[q]] == want
    assert set(got) == {i for i, _ in rows if i % 20 == 0}
    few = hamming.top_k(df.where("id < 4"), df.where("id = 2"), k=7).collect()
    assert {r.neighbor_id for r in few} == {0, 1, 3}
    assert hamming.top_k(df.limit(0), df.limit(0)).count() == 0


def brute_top_k(rows, asked, k):
    """Lists of (distance, id) by (asking id, code), each code of an id a row."""
    rows = {r for r in rows if None not in r}
    return {(q, c): sorted(((c ^ d) & (2**64 - 1)).bit_count() * 10**6 + i for i, d in rows if i != q)[:k]
            for q, c in {r for r in asked if None not in r}}


@pytest.mark.parametrize("most_masks", [hamming.MOST_MASKS, 3])
def test_top_k_with_repeated_ids(spark, most_masks):
    rng = random.Random(9)
    near = [(1, 1 << b) for b in range(30)] + [(1, 0), (2, 0), (3, 3), (4, 0), (4, 5), (5, -1), (6, (1 << 32) - 1)]
    rows = near + [(7 + i % 20, rng.getrandbits(64) - 2**63) for i in range(200)]
    df = spark.createDataFrame(rows, "id bigint, code bigint")
    asked = df.where("id <= 9")
    for k in (2, 5, 300):
        got = {}
        for r in hamming.top_k(df, asked, k=k, most_masks=most_masks).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append(r.distance * 10**6 + r.neighbor_id)
        want = {}
        for (q, _), found in brute_top_k(rows, [r for r in rows if r[0] <= 9], k).items():
            want.setdefault(q, []).extend(found)
        assert {q: sorted(v) for q, v in got.items()} == {q: sorted(v) for q, v in want.items()}


@pytest.mark.parametrize("parts", [0, 3, 4, 7])
def test_shard_search_is_exact(monkeypatch, parts):
    monkeypatch.setattr(hamming, "_BLOCK", 1 << 7)
    monkeypatch.setattr(hamming, "_GATHERED", 1 << 9)
    rng = np.random.default_rng(parts)
    codes = rng.integers(0, 2**63, 900, dtype=np.uint64)
    codes[200:260] = codes[0] ^ np.uint64(1) << rng.integers(0, 64, 60, dtype=np.uint64)  # many ties
    codes[300:310] = codes[1]
    codes[400:600] &= np.uint64(2**40 - 1)  # one value of the high segments
    asked = np.concatenate([codes[::9], rng.integers(0, 2**63, 30, dtype=np.uint64)])
    own = tuple(np.where(np.arange(len(asked)) < 100, 9 * np.arange(len(asked)) + i, 0) for i in (0, 2))
    bounds = rng.integers(0, 4 * parts or 65, len(asked))
    got = hamming._search(codes, asked, own, bounds, 6, hamming._least_radius, parts)
    want = []
    for i, q in enumerate(asked):
        far = np.bitwise_count(codes ^ q)
        near = sorted((int(far[at]), at) for at in range(len(codes))
                      if far[at] <= bounds[i] and not own[0][i] <= at < own[1][i])[:6]
        want += [i << 39 | d << 32 | at for d, at in near]
    assert got.tolist() == want


def test_shard_search_parts():
    """Wide radii and few codes compare all; codes that crowd in some values count with what they meet."""
    rng = np.random.default_rng(1)
    codes, near = rng.integers(0, 2**63, 100_000, dtype=np.uint64), np.full(20_000, 9)
    parts = lambda c, n, bounds: hamming._best_parts(
        c, c[:n], bounds, hamming._least_radius, hamming.MOST_MASKS)
    assert parts(codes, 20_000, near) >= 3
    assert parts(codes, 20_000, near + 50) == parts(codes, 20, near[:20]) == 0
    assert parts(codes & np.uint64(2**20 - 1), 20_000, near) == 0


def test_top_k_makes_no_rows_of_pairs(spark, monkeypatch):
    """Queries and codes both grow with the input; a join of them made a row of each pair that a probe met."""
    plans, sizes = [], {}
    store = hamming.stored

    def spy(df, name, **options):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        out = store(df, name, **options)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(hamming, "stored", spy)
    monkeypatch.setattr(hamming, "MOST_CODES", 700)
    monkeypatch.setattr(hamming, "LEAST_CODES", 500)
    rng = np.random.default_rng(3)
    rows = [(i, int(c)) for i, c in enumerate(rng.integers(-2**63, 2**63 - 1, 4000))]
    df = spark.createDataFrame(rows, "id bigint, code bigint")
    got = {}
    for r in hamming.top_k(df, df.where("id % 40 = 0"), k=3).collect():
        got.setdefault((r.query_id, rows[r.query_id][1]), []).append(r.distance * 10**6 + r.neighbor_id)
    assert {q: sorted(v) for q, v in got.items()} == brute_top_k(rows, rows[::40], 3)
    assert not [p for p in plans if "Join" in p]
    assert sizes["members"] == 4000 and sizes["queries"] == sizes["bounds"] == 100
    assert 300 <= sizes["nearest"] <= 8 * 300


def test_top_k_of_text_ids(spark):
    """Ids of any type that has an order, repeated ones among them."""
    rng = random.Random(4)
    rows = [(f"{'ab'[i % 2]}{i % 70}", rng.getrandbits(64) - 2**63) for i in range(150)]
    df = spark.createDataFrame(rows, "id string, code bigint")
    got = {}
    for r in hamming.top_k(df, df, k=4).collect():
        got.setdefault(r.query_id, []).append((r.distance, r.neighbor_id))
    want = {}
    for q, c in rows:
        want.setdefault(q, []).extend(
            sorted((((c ^ d) & (2**64 - 1)).bit_count(), i) for i, d in rows if i != q)[:4])
    assert {q: sorted(v) for q, v in got.items()} == {q: sorted(v) for q, v in want.items()}


def test_sign_code(spark):
    df = spark.createDataFrame([([1.0, -1.0, 2.0],), (None,), ([],), ([0.0] * 63 + [1.0],)], "v array<float>")
    assert [r[0] for r in df.select(hamming.sign_code(F.col("v"))).collect()] == [5, None, 0, -2**63]
    with pytest.raises(Exception, match="64 bits"):
        spark.createDataFrame([([1.0] * 65,)], "v array<float>").select(hamming.sign_code(F.col("v"))).collect()


# ---- chat pairs -------------------------------------------------------------------

def test_preference_pairs(spark):
    schema = "pair_id bigint, turn int, role string, text string, prompt string"
    turn = lambda p, n, r, t: (p, n, r, t, "clash")
    a = spark.createDataFrame([turn(1, 0, "user", "hi"), turn(1, 1, "assistant", "yes <|end|>"), turn(2, 0, "user", "x"),
                               turn(3, 0, None, None), turn(None, 0, "user", "no"), turn(5, 0, "user", "same"),
                               turn(5, 1, "assistant", "same")] + [turn(6, n, "user", "t" * 50) for n in range(3000)], schema)
    b = spark.createDataFrame([turn(1, 0, "user", "hi"), turn(1, 1, "assistant", "no"), turn(1, 2, "user", "why"),
                               turn(3, 0, None, None), turn(4, 0, "user", "alone"), turn(5, 1, "assistant", "same"),
                               turn(5, 0, "user", "same")], schema)
    got = {r.pair_id: r for r in chat.preference_pairs(a, b).collect()}
    assert set(got) == {1, 2, 3, 4, 5, 6}
    one = got[1]
    assert one.prompt == "<|user|>\nhi<|end|>\n" and one.shared_turns == 1
    assert one.chosen == "<|assistant|>\nyes < |end|><|end|>\n" and one.rejected.startswith("<|assistant|>\nno<|end|>\n<|user|>")
    assert [m.loss for m in one.rejected_mask] == [True, False]
    for r in got.values():
        assert sum(m.chars for m in r.chosen_mask) == len(r.chosen) and sum(m.chars for m in r.rejected_mask) == len(r.rejected)
    assert got[2].rejected == "" and got[4].chosen == "" and got[3].shared_turns == 1
    assert got[5].chosen == got[5].rejected == "" and got[5].shared_turns == 2 and len(got[6].chosen_mask) == 3000
    assert chat.preference_pairs(a.limit(0), b.limit(0)).count() == 0


# ---- classifiers ------------------------------------------------------------------

def labelled(seed, n=240):
    rng = random.Random(seed)
    plain = ["river", "stone", "window", "garden", "paper", "music", "winter", "table", "morning", "letter"]
    rows = []
    for i in range(n):
        text = [rng.choice(plain) + str(rng.randrange(300)) for _ in range(60)]
        toxic = i % 4 == 0
        if toxic:
            text[rng.randrange(60)] = text[rng.randrange(60)] = rng.choice(["horridbeast", "vilecreature"])
        if i % 3 == 0:
            text = [w + "$$$" for w in text]
        rows.append((i, " ".join(text), int(i % 3 != 0), int(toxic)))
    return rows


def test_toxicity_on_held_out_rows(spark, make_docs):
    rows = labelled(1)
    docs = make_docs([(i, t, "s") for i, t, _, _ in rows] + [(None, None, "s"), (900, "", "s"), (901, "q" * 300_000, "s")])
    labels = spark.createDataFrame([(i, t) for i, _, _, t in rows] + [(None, 1), (3, None)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels, "doc_id % 2 = 0 or doc_id % 4 = 1")
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, model).collect()}
    assert len(got) == len(rows) + 3 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    model = toxicity.fit(docs, labels, "doc_id < 160")
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, model).collect()}
    late = [(got[i].predicted, t) for i, _, _, t in rows if i >= 160]
    assert sum(p == t for p, t in late) / len(late) > 0.9 and got[900].predicted == got[901].predicted == 0
    none = toxicity.fit(docs, labels.limit(0), "true")
    assert toxicity.score_toxicity(docs, none).agg(F.max("predicted")).first()[0] is not None
    assert toxicity.score_toxicity(docs.limit(0), model).count() == 0


def test_quality_on_held_out_rows(spark, make_docs):
    rows = labelled(2)
    docs = make_docs([(i, t, "s", "clash") for i, t, _, _ in rows] + [(None, None, "s", "x"), (900, "", "s", "x")], ", tail string")
    labels = spark.createDataFrame([(i, q, t) for i, _, q, t in rows] + [(None, 0, 0), (4, None, None)],
                                   "doc_id bigint, quality int, toxic int")
    model = quality.fit(docs, quality.grades_of(labels).where("doc_id < 160 or doc_id is null"))
    assert model.thresholds[0] < model.thresholds[1]
    out = quality.rate(docs, model)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "expected_grade", "tail", "accepted"]
    got = {r.doc_id: r for r in out.collect()}
    late = [(got[i].accepted, q) for i, _, q, _ in rows if i >= 160]
    assert sum(a == bool(q) for a, q in late) / len(late) > 0.95 and None in got and 0 <= got[900].expected_grade <= 2
    empty = quality.fit(docs, quality.grades_of(labels).limit(0))
    assert quality.rate(docs, empty).count() == len(rows) + 2 and quality.rate(docs.limit(0), model).count() == 0


def test_ordinal_gradient_recovers_order():
    rng = np.random.default_rng(0)
    hidden = rng.normal(size=800)
    grades = np.digitize(hidden + 0.3 * rng.normal(size=800), [-0.5, 0.7])
    rows = [(np.array([0, 1]), np.array([x, 1.0])) for x in hidden]
    model = quality.fit_ordinal(rows, grades, 2, 3)
    score = np.array([model.weights[0] * x + model.weights[1] for x in hidden])
    expected = model.tails(score).sum(axis=1)
    assert np.corrcoef(expected, grades)[0, 1] > 0.85 and model.thresholds[0] < model.thresholds[1]


# ---- pipeline ----------------------------------------------------------------------

def test_pipeline_stages_follow_each_other(spark):
    docs = table(spark, SF001, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF001)
        assert after.columns == columns, name
        assert after.count() <= docs.count()
        docs = after
    last = corpus_pipeline.run(spark, SF001)
    assert sorted(r.doc_id for r in last.collect()) == sorted(r.doc_id for r in docs.collect())
