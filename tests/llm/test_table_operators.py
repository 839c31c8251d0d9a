"""Graph, embedding, archive, language-model and tool-call operators against brute force."""

import base64
import hashlib
import json
import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import components, contamination, covertree, queries, suffix_tree, toolcalls, warc
from tessera.plans.compare import compare, duck

# -- Components ------------------------------------------------------------------------------


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 180)] + [(900, i) for i in range(10, 60)] + [(7, 7), (3, None), (5, 4), (4, 5), (5, 4)]
    got = dict(components.components(spark.createDataFrame(edges, "a long, b long")).collect())
    want = {i: 100 for i in range(100, 181)} | {i: 10 for i in [*range(10, 60), 900]} | {4: 4, 5: 4}
    assert got == want
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- Embeddings ------------------------------------------------------------------------------


def brute_links(rows, threshold):
    out = {}
    ok = lambda e: e is not None and len(e) and all(x is not None and math.isfinite(x) for x in e) and any(e)
    near = [[False] * len(rows) for _ in rows]
    for i, (_, a, la) in enumerate(rows):
        for j, (_, b, lb) in enumerate(rows):
            if i != j and la is not None and la == lb and ok(a) and ok(b) and len(a) == len(b):
                x, y = np.array(a, float), np.array(b, float)
                near[i][j] = x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= threshold
    for i, (v, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            k = todo.pop()
            for j in range(len(rows)):
                if near[k][j] and j not in seen:
                    seen.add(j)
                    todo.append(j)
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out[i] = (v, sum(near[i]), least, v is not None and v == least)
    return Counter(out.values())


@pytest.mark.parametrize("chunk_rows, pivots", [(4096, 16), (5, 3)])
def test_links_equal_brute_force(spark, chunk_rows, pivots):
    rng = np.random.default_rng(1)
    rows, centers = [], rng.normal(size=(6, 8))
    for i in range(220):
        c = centers[i % 6] if i % 3 else rng.normal(size=8)
        rows.append((i, (c + rng.normal(size=8) * rng.choice([0.02, 0.08, 0.15])).astype(np.float32).tolist(), [0, 0, 1, None][i % 4]))
    rows += [(300 + i, rows[0][1], 0) for i in range(9)] + [(400, [2 * x for x in rows[0][1]], 0)]
    rows += [(500, None, 0), (501, [0.0] * 8, 0), (502, [1.0, None] * 4, 0), (503, [float("nan")] * 8, 0), (504, [], 0),
             (505, [float("inf")] * 8, 0), (506, [1.0, 0.0], 0), (507, [2.0, 0.0], 0), (1, rows[1][1], 0), (None, rows[4][1], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("n_links", F.lit("clash"))
    got = covertree.threshold_links(df, chunk_rows=chunk_rows, pivots=pivots).collect()
    assert Counter(map(tuple, got)) == brute_links(rows, 0.98)
    assert covertree.threshold_links(df.limit(0)).count() == 0


def test_dense_clusters_take_the_inclusion_rule():
    rng = np.random.default_rng(2)
    v = np.concatenate((rng.normal(size=(1, 16)) + rng.normal(size=(600, 16)) * 0.01, rng.normal(size=(300, 16)), np.zeros((5, 16)) + 1.0))
    w = rng.integers(1, 4, len(v))
    got = covertree.links_of(v, w, 0, 0.98)
    u = v / np.linalg.norm(v, axis=1)[:, None]
    near = u @ u.T >= 0.98
    np.fill_diagonal(near, False)
    assert (got.count == near @ w).all()
    across = covertree.links_of(v, w, 450, 0.98)
    near[:450, :450] = near[450:, 450:] = False
    assert (across.count == near @ w).all()


# -- WARC ------------------------------------------------------------------------------------


def test_archives_round_trip(spark):
    long = "x" * 300_000
    pages = [(1, "http://www.B.com/x?q=1#f", "same"), (5, "https://b.com:80/", "same"), (3, None, "same"), (4, "http://b.com/x", None),
             (9, "http://b.com/x", ""), (2, "no scheme\r\nhere", long), (7, "http://user@é.org/ü", "p\r\n\r\nWARC/1.1\r\n\r\n"),
             (9, "http://b.com/x", ""), (None, "http://n.com/", "same"), (None, "http://n.com/", "other")]
    pages += [(100 + i, f"http://host.com/{i % 40}", f"text {i // 3}") for i in range(200)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("key", F.lit("clash"))
    root = warc.write_archives(df, block_lines=7)
    keys = df.select(warc.url_key(F.col("url")).alias("key"))
    got = warc.lookup(spark, root, keys.union(keys)).collect()
    newest = {}
    for p, _, h in pages:
        newest[h or ""] = max(newest.get(h or "", -1), -1 if p is None else p)
    want = Counter()
    for p, _, h in pages:
        raw = (h or "").encode()
        again = newest[h or ""] not in (-1, p)
        want[p, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response",
             newest[h or ""] if again else None, None if again else raw] += 1
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"],
                    None if r["payload"] is None else bytes(r["payload"])) for r in got) == want
    one = warc.lookup(spark, root, spark.createDataFrame([("com,b)/x",), ("com,nobody)/",), (None,)], "key string")).collect()
    assert sorted(r["page_id"] for r in one) == [4, 9, 9]
    empty = warc.write_archives(df.limit(0))
    assert warc.lookup(spark, empty, keys).count() == 0


def test_url_keys(spark):
    urls = ["http://www.Example.COM:8080/A/b?x=1#top", None, "", "/path only", "ftp://u:p@h.org", "http://h.org?x"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r[0] for r in df.select(warc.url_key(F.col("u"))).collect()] == [
        "com,example,www)/A/b?x=1", "", ")", ")/path%20only", "org,h)", "org,h)?x"]


# -- Suffix tree -----------------------------------------------------------------------------


def tokens_of(text):
    return (text or b"").lower().split() + [b""]


def test_tokens_and_distinct_hashes():
    texts = ["  A b \t c\x1c", None, "", " ", "x\x85y \n", "\u00c4 \u00e9 \u00c9 A", "a " * 1000]
    x, starts = suffix_tree._batch_tokens(pa.array(texts, pa.string()).slice(0))
    want = [tokens_of(t and t.encode()) for t in texts]
    assert x.tolist() == [xxhash.xxh64_intdigest(w, suffix_tree.SEED) for t in want for w in t]
    assert starts.tolist() == np.cumsum([0] + [len(t) for t in want])[:-1].tolist()
    x, starts = suffix_tree._batch_tokens(pa.array(texts, pa.string()).slice(1, 3))
    assert len(x) == 3 and starts.tolist() == [0, 1, 2]
    assert len(suffix_tree._batch_tokens(pa.array([], pa.string()))[0]) == 0
    # the first bits are the same for all: parts are added up
    h = np.array([5, 3, 5, 1 << 63, 3, 5], np.uint64)
    at, n = suffix_tree._distinct(h)
    got = Counter()
    for i, c in zip(at, n):
        got[int(h[i])] += int(c)
    assert got == {5: 3, 3: 2, 1 << 63: 1}


def test_bitmap_has_all_its_pairs(spark):
    for n in (0, 3, 9000):
        pairs = spark.range(n).selectExpr("id % 7 as state", "xxhash64(id) as word")
        h = np.array([r[0] for r in suffix_tree._pair_hashes(pairs).collect()], np.int64).view(np.uint64)
        made = suffix_tree._bitmap(pairs)
        assert suffix_tree._may_have(made, h).all()
        bits = len(made).bit_length() + 5
        assert np.unpackbits(made.view(np.uint8)).sum() == len(set((h >> np.uint64(64 - bits)).tolist()))


def brute_scores(texts, train, min_context, min_z, min_divergence, alpha, depth=2):
    """The model by its definition, every next symbol with its count, contexts of up to ``depth`` words."""
    toks = tokens_of
    c = Counter(w for t in train for w in toks(t))
    n, v = sum(c.values()), len(c)
    p0 = lambda w: (c[w] + 1) / (n + v + 1)
    after = {k: {} for k in range(1, depth + 1)}
    for t in train:
        w = toks(t)
        for i, x in enumerate(w):
            for k in after:
                if i >= k:
                    after[k].setdefault(tuple(w[i - k:i]), Counter())[x] += 1
    cand = {w for w in c if c[w] >= max(min_context * n, 1)}
    kept, extended = set(), {()}
    for k in after:
        for s, nxt in after[k].items():
            size = sum(nxt.values())
            if not set(s) <= cand or size < min_context * n or s[1:] not in extended:
                continue
            parent = (lambda w: c[w] / n) if k == 1 else (
                lambda w, m=after[k - 1][s[1:]]: m[w] / sum(m.values()))
            cells = [(x, size * parent(w), parent(w)) for w, x in nxt.items() if w in cand and size * parent(w) >= 5]
            if not cells:
                if len(nxt) > 1 and (k == 1 or s[1:] in kept):
                    extended.add(s)
                continue
            rest, rest_p = size - sum(x for x, _, _ in cells), max(1 - sum(p for *_, p in cells), 1e-12)
            g2 = 2 * (sum(x * math.log(x / e) for x, e, _ in cells) + (rest * math.log(rest / (size * rest_p)) if rest else 0))
            if (g2 - len(cells)) / math.sqrt(2 * len(cells)) >= min_z and g2 / (2 * size) >= min_divergence:
                kept.add(s)
            if len(nxt) > 1 and (k == 1 or s in kept or s[1:] in kept):
                extended.add(s)
    state = lambda w, i: next((tuple(w[i - k:i]) for k in range(min(i, depth), 0, -1) if tuple(w[i - k:i]) in kept), ())
    nexts = {}
    for t in train:
        w = toks(t)
        for i, x in enumerate(w):
            nexts.setdefault(state(w, i), Counter())[x] += 1
    out = []
    for t in texts:
        w = toks(t)
        lp = 0.0
        for i, x in enumerate(w):
            s = state(w, i)
            if not s:
                lp += math.log10(p0(x))
            else:
                m = nexts[s]
                size = sum(m.values())
                left = size + alpha - sum(k - 1 for k in m.values())
                lp += math.log10((max(m[x] - 1, 0) + left * p0(x)) / (size + alpha))
        out.append((len(w), sum(c[x] > 0 for x in w), n, sum(math.log10(p0(x)) for x in w), lp))
    return out, kept


def test_scores_equal_brute_force(spark):
    rng = random.Random(8)
    follow = {"the": ["cat", "dog"], "cat": ["sat", "ran"], "sat": ["on"], "on": ["the", "a"]}
    texts = []
    for _ in range(300):
        w = ["the"]
        for _ in range(rng.randrange(12)):
            w.append(rng.choice(follow.get(w[-1], ["The", "a", "of", f"r{rng.randrange(40)}"])))
        texts.append(" ".join(w))
    train, odd = [t.encode() for t in texts], [None, "", "unseen words", "The\tcat\nsat on THE cat sat on"]
    how = dict(min_context=0.01, min_z=4.0, min_divergence=0.005, alpha=50.0)
    want, kept = brute_scores([t and t.encode() for t in odd + texts], train, **how)
    assert len([s for s in kept if len(s) == 1]) >= 2
    df = spark.createDataFrame(list(enumerate(odd + texts)), "doc_id long, text string").withColumn("score", F.lit("clash")).withColumn("word", F.lit("kept"))
    # nexts of words that are not frequent are part of the smoothing, so all are frequent but for the least one
    got = {r["doc_id"]: r for r in suffix_tree.score_texts(
        df, df.where("doc_id >= 4"), min_next=0.0, **how).collect()}
    assert len(got) == len(want) and got[0]["word"] == "kept"
    for i, (n_tokens, n_known, train_tokens, base, score) in enumerate(want):
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n_tokens, n_known, train_tokens)
        assert r["base_score"] == pytest.approx(base) and r["score"] == pytest.approx(score)
    few = {r["doc_id"]: r for r in suffix_tree.score_texts(df, df.where("doc_id >= 4"), top_words=3, **how).collect()}
    assert all(few[i]["base_score"] == pytest.approx(w[3]) and few[i]["n_known"] == w[1] for i, w in enumerate(want))
    none = suffix_tree.score_texts(df, df.limit(0)).agg(F.max("score"), F.min("score"), F.sum("n_known")).first()
    assert tuple(none) == (0.0, 0.0, 0)
    twice = suffix_tree.score_texts(df.where("doc_id = 3").union(df.where("doc_id = 3")), df.where("doc_id >= 4")).collect()
    assert len(twice) == 2 and twice[0] == twice[1] and suffix_tree.score_texts(df.limit(0), df).count() == 0


def test_held_tables_do_not_change_scores(spark):
    rng = random.Random(9)
    texts = [" ".join(["a", rng.choice("bc"), f"r{rng.randrange(30)}", rng.choice(["d", "e f"])]) for _ in range(400)]
    train = [t.encode() for t in texts]
    n = sum(len(tokens_of(t)) for t in train)
    want, kept = brute_scores(train, train, 40 / n, suffix_tree.MIN_Z, suffix_tree.MIN_DIVERGENCE, suffix_tree.ALPHA)
    assert kept
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for held in ({}, {"top_words": 3, "top_pairs": 2}):  # all other counts reach their tokens by the join
        got = {r["doc_id"]: r for r in suffix_tree.score_texts(df, df, min_count=40, **held).collect()}
        for i, (_, known, _, base, score) in enumerate(want):
            r = got[i]
            assert (r["n_known"], r["base_score"], r["score"]) == (known, pytest.approx(base), pytest.approx(score))


def test_longer_contexts_equal_brute_force(spark):
    rng = random.Random(12)
    texts = []
    for _ in range(1500):
        w = [rng.choice("abc") for _ in range(3)]
        for _ in range(rng.randrange(2, 9)):
            far = w[-4] if len(w) > 3 and w[-3] == "a" else w[-3]  # three words back decide, or four
            w.append(far if rng.random() < 0.7 else rng.choice("abcd"))
        texts.append(" ".join(w))
    train, n = [t.encode() for t in texts], sum(len(tokens_of(t.encode())) for t in texts)
    want, kept = brute_scores(train, train, 25 / n, suffix_tree.MIN_Z, suffix_tree.MIN_DIVERGENCE, suffix_tree.ALPHA, depth=7)
    assert {3, 4} <= {len(s) for s in kept}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    for held in ({}, {"top_words": 1, "top_pairs": 3}):
        got = {r["doc_id"]: r for r in suffix_tree.score_texts(df, df, min_count=25, **held).collect()}
        for i, (_, known, _, base, score) in enumerate(want):
            r = got[i]
            assert (r["n_known"], r["base_score"], r["score"]) == (known, pytest.approx(base), pytest.approx(score)), texts[i]


def test_packed_counts_equal_brute_force(spark, monkeypatch):
    """Counts go to the merge as a row a bucket; tables have no next symbol that neither a test nor a score looks at."""
    monkeypatch.setattr(suffix_tree, "_FLUSH", 500)
    rng = random.Random(21)
    texts = [" ".join([rng.choice("ab"), rng.choice("cd"), f"r{rng.randrange(60)}", rng.choice(["a", "b c"])]) for _ in range(400)]
    code = lambda w: xxhash.xxh64_intdigest(w, suffix_tree.SEED)
    c = Counter(w for t in texts for w in tokens_of(t.encode()))
    after = Counter((w[i - 1], w[i]) for t in texts for w in [tokens_of(t.encode())] for i in range(1, len(w)))
    total, least = sum(c.values()), 40
    words = np.sort(np.array([code(w) for w in c if c[w] >= least], np.uint64))
    value = {code(w): n for w, n in c.items()}
    contexts = np.sort(suffix_tree.mix(np.zeros(len(words), np.uint64), words))
    ctx = lambda w: int(suffix_tree.mix(np.zeros(1, np.uint64), np.array([code(w)], np.uint64))[0])
    plain = lambda rows: {(r["kind"], r["ctx"] % (1 << 64), r["next"] % (1 << 64)): r["n"] for r in rows}
    train = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    big = [w for w in c if c[w] >= least and w]
    sizes = {(suffix_tree._SIZE, ctx(w), 0): c[w] for w in big}

    held = "grams", spark.sparkContext.broadcast(([contexts], [], words, np.array([value[int(w)] for w in words])))
    rows = suffix_tree._gram_counts(train, held, 1, True, total, least).collect()
    got = plain(rows)
    assert len(got) == len(rows)
    want = {(suffix_tree._HELD, ctx(a), code(b)): n for (a, b), n in after.items()
            if a in big and c[b] >= least and (n >= 5 or c[a] * c[b] >= 5 * total)}
    assert {k: n for k, n in got.items() if k[0] in (suffix_tree._HELD, suffix_tree._LOOSE)} == want
    assert {k: n for k, n in got.items() if k[0] == suffix_tree._SIZE} == sizes
    kinds = {a: {b for x, b in after if x == a} for a in big}
    several = Counter(k[1] for k in got if k[0] == suffix_tree._NEXT)
    assert {a: several[ctx(a)] > 1 for a in big} == {a: len(kinds[a]) > 1 for a in big}

    some = words[:2]  # the other words are not held, and go by their hashes
    held = "nexts", spark.sparkContext.broadcast(([contexts], [contexts], contexts, some, np.array([value[int(w)] for w in some])))
    rows = suffix_tree._next_counts(train, held, total).collect()
    got = plain(rows)
    assert len(got) == len(rows) and all(r["c"] == (value[r["next"] % (1 << 64)] if r["kind"] == suffix_tree._HELD else 0) for r in rows)
    kind = lambda b: suffix_tree._HELD if code(b) in some else suffix_tree._LOOSE
    assert got == sizes | {(kind(b), ctx(a), code(b)): n for (a, b), n in after.items() if a in big and n > 1}


def test_contexts_of_any_length(spark):
    texts = ["a x y p", "b x y q", "a b x p", "b a x q"] * 100 + ["k l m n o p", "j l m n o q"] * 100
    df = spark.createDataFrame(list(enumerate(texts + ["a x y q", "b x y p"])), "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in suffix_tree.score_texts(df, df.where(F.col("doc_id") < len(texts)), min_count=50).collect()}
    assert got[0] > got[len(texts)] + 1 and got[1] > got[len(texts) + 1] + 1  # three words back decide


# -- Tool calls ------------------------------------------------------------------------------


def test_linking_levels_and_validation(spark):
    good = '{"query": "q", "limit": 3}'
    calls = [(1, 0, "a", "search", good, None), (1, 4, "b", "search", good, "a"), (1, 2, "c", "note", '{"body":""}', "b"),
             (1, 9, "a", "note", good, None), (1, 1, "x", "search", good, "y"), (1, 1, "y", "search", good, "x"),
             (1, 1, "z", "search", good, "y"), (2, 0, "a", "nope", good, "gone"), (None, 0, "a", None, None, None),
             (1, 3, None, "search", '[1]', "a"), (2, 5, "n", "search", '{"query":7,"limit":"3","b":1,"a":null}', "n2"),
             (1, 0, "a", "search", good, None)]
    results = [(1, 1, "a", "r1"), (1, 1, "a", "r2"), (2, 1, "a", None), (None, 3, "a", "é\"\n"), (1, 5, "gone", "r"), (1, 5, None, "r"),
               (1, 5, "x", "r")]
    calls += [(3, i, f"k{i}", "search", good, f"k{i - 1}") for i in range(70)]
    c = spark.createDataFrame(calls, "thread long, place long, call_id string, tool string, arguments string, after string").withColumn("level", F.lit("clash"))
    r = spark.createDataFrame(results, "thread long, place long, call_id string, content string")
    got = toolcalls.link_calls(c, r).collect()
    assert len(got) == len(calls) + len(results)
    call = {(x["thread"], x["place"], x["call_id"]): x for x in got if x["kind"] == "call"}
    see = lambda *k: (call[k]["status"], call[k]["level"], call[k]["errors"])
    assert see(1, 0, "a") == ("linked", 0, []) and see(1, 4, "b") == ("unanswered", 2, []) and see(1, 2, "c") == ("unanswered", 3, ["range body"])
    assert see(1, 9, "a")[:2] == ("duplicate", None) and see(1, 9, "a")[2] == ["missing body", "unknown limit", "unknown query"]
    assert [see(1, 1, k)[:2] for k in "xyz"] == [("cycle", None)] * 3
    assert see(2, 0, "a") == ("linked", 0, ["no such tool"]) and see(None, 0, "a") == ("linked", 0, ["no such tool"])
    assert see(1, 3, None) == ("no id", None, ["not an object"])
    assert see(2, 5, "n") == ("unanswered", 0, ["type limit", "type query", "unknown a", "unknown b"])
    assert see(3, 69, "k69")[1] == 69
    answers = Counter((x["thread"], x["call_id"], x["status"], x["level"]) for x in got if x["kind"] == "result")
    assert answers == Counter({(1, "a", "linked", 1): 2, (2, "a", "linked", 1): 1, (None, "a", "linked", 1): 1,
                               (1, "gone", "orphan", None): 1, (1, None, "orphan", None): 1, (1, "x", "linked", None): 1})
    assert call[1, 0, "a"]["message"] == '{"arguments":{"limit":3,"query":"q"},"id":"a","name":"search","type":"call"}'
    for x in got:
        assert x["message"] == json.dumps(json.loads(x["message"]), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert toolcalls.link_calls(c.limit(0), r.limit(0)).count() == 0


def test_tool_calls_are_native(spark, sf_small):
    plan = queries.op10_tool_calls(spark, sf_small)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan and "Broadcast" not in plan


# -- Queries and pipeline --------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, sf_small, name):
    r = compare(queries.REGISTRY[name](spark, sf_small), duck(sf_small), queries.SQL[name])
    assert r["columns_match"] and r["values_match"] and r["spark_rows"] == r["oracle_rows"], r


def test_pipeline_stages_by_brute_force(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 4 and corpus_pipeline.ORACLE_SQL is None
    odd = spark.createDataFrame([(10_001, None, "en", "s", None), (10_002, "...", "en", "s", 3), (None, "words of some length", None, None, None)], docs.schema)
    kept = corpus_pipeline.STAGES[0][1](spark, docs.union(odd), sf_small)
    assert kept.columns == docs.columns and kept.where("doc_id > 10000").count() == 0 and kept.count() >= docs.count() * 0.99
    kept = corpus_pipeline.STAGES[1][1](spark, docs, sf_small)
    first = queries.op9_simhash(spark, sf_small).where("doc_id = component_id").select("doc_id")
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == sorted(r[0] for r in first.collect())
    assert kept.columns == docs.columns
    kept = corpus_pipeline.STAGES[2][1](spark, docs, sf_small)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()]
    searchers = contamination.build([(str(i), t and t.encode()) for i, t in items], 13)
    clean = []
    for r in docs.collect():
        n, spans, _ = contamination.scan(searchers, (r["text"] or "").encode())
        hit = sum(b - a for a, b in spans)
        if not (hit and 20 * hit >= n):
            clean.append(r["doc_id"])
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(clean) and len(clean) < docs.count()
    out = corpus_pipeline.run(spark, sf_small)
    assert out.where("not round_trip").isEmpty() and 0 < out.count() < docs.count()
