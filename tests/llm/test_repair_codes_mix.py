"""Turn repair, vector codes and the fair mix against brute force, and their edge cases."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import codes, mixing, queries, turns
from tessera.llm.prefix import running_sums
from tessera.plans.compare import compare, duck

# -- Turn repair -----------------------------------------------------------------------------

SHAPE = re.compile(r"(s?(ua)+)?\Z")


def cheapest(rows):
    """(cost, audit, lines) over every edit sequence with at most two inserts in a gap; rows: (role, text, gone, cut)."""
    gaps = ["", "u", "a", "ua", "au"]
    choices = []
    for role, text, gone, cut in rows:
        own = [(3, "D", "", None)]
        if not gone:
            own += [(cut, "K", role[:1], f"{role}:{text}")]
            own += [(2 + cut, "R", x, f"{n}:{text}") for x, n in (("u", "user"), ("a", "assistant"))]
        choices.append(own)
    best = None
    for inserts in itertools.product(gaps, repeat=len(rows) + 1):
        for edits in itertools.product(*choices):
            shape, audit, lines, cost = "", "", [], 0
            for k, new in enumerate(inserts):
                shape, audit, cost = shape + new, audit + "I" * len(new), cost + 2 * len(new)
                lines += [{"u": "user:", "a": "assistant:"}[x] for x in new]
                if k < len(edits):
                    c, letter, initial, line = edits[k]
                    shape, audit, cost = shape + (initial if letter != "D" else ""), audit + letter, cost + c
                    if letter == "K" and initial not in ("s", "u", "a"):
                        shape += "?"
                    lines += [line] if line is not None else []
            if SHAPE.match(shape) and (best is None or (cost, audit) < best[:2]):
                best = cost, audit, lines
    return best


def faults(rows):
    """rows: (turn, role, text) in order -> (role, text, gone, cut) and the counts."""
    seen, out, n = set(), [], Counter()
    for _, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        blank = not text.strip(" \t\n\v\f\r")
        again = (role, text) in seen
        cut = not blank and text.rstrip(" \t\n\v\f\r")[-1] not in ".!?"
        seen.add((role, text))
        n["blank" if blank else "duplicate" if again else "truncated" if cut else "fine"] += 1
        out.append((role, text, blank or again, int(cut)))
    return out, n


def repaired_rows(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    report, repaired = turns.repair(df)
    lines = {}
    for r in repaired.orderBy("conv", "at", "step").collect():
        lines.setdefault(r["conv"], []).append(f"{r['role']}:{r['text']}")
    digest = {r["conv"]: r["sha256"] for r in turns.digests(repaired).collect()}
    assert digest == {c: hashlib.sha256("\n".join(x).encode()).hexdigest() for c, x in lines.items()}
    return {r["conv"]: r for r in report.collect()}, lines


def test_repair_equals_all_edit_sequences(spark):
    rng = random.Random(7)
    rows = []
    for conv in range(60):
        for turn in range(rng.randint(1, 3)):
            rows.append((conv, turn, rng.choice(["system", "user", "assistant", "user", "assistant", "tool"]),
                         rng.choice(["Hello.", "Hi", " \n", "Yes!", "No? ", "Well", "", "."])))
    rows += [(None, None, None, "x."), (None, 2, "user", None), (None, 5, "user", "Hello."),
             (100, 0, "", "Hello."), (100, 1, "assistant", "Hello."), (101, 3, "user", "é."), (101, 3, "user", "é."), (101, 3, "user", "é.")]
    rng.shuffle(rows)
    got, lines = repaired_rows(spark, rows)
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r[1:])
    assert set(got) == set(by)
    for conv, own in by.items():
        own.sort(key=lambda r: (r[0] is not None, r[0], " " if r[1] is None else r[1], " " if r[2] is None else r[2]))
        marked, n = faults(own)
        cost, audit, want = cheapest(marked)
        r = got[conv]
        assert (r["cost"], r["audit"], lines.get(conv, [])) == (cost, audit, want), (conv, own)
        assert [r[c] for c in ("blank", "duplicate", "truncated")] == [n[c] for c in ("blank", "duplicate", "truncated")]
        initials = [m[0][:1] for m in marked]
        assert r["illegal"] == sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        known = [t for t, _, _ in own if t is not None]
        assert r["gaps"] == (max(known) - min(known) + 1 - len(set(known)) if known else 0)


def by_steps(rows):
    """(cost, audit) by dynamic programming over suffixes."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    new = {0: 2, 1: 2, 2: 3, 3: 2}
    w = {0: (0, ""), 1: (4, "II"), 2: (2, "I"), 3: (0, "")}
    for role, _, gone, cut in reversed(rows):
        e = {}
        for q in range(4):
            options = [(w[q][0] + 3, "D" + w[q][1])]
            for x in "sua":
                if (to := step.get((q, x))) is not None and not gone:
                    options += [(w[to][0] + cut, "K" + w[to][1])] if role[:1] == x else []
                    options += [(w[to][0] + 2 + cut, "R" + w[to][1])] if x in "ua" else []
            e[q] = min(options)
        w = {q: min(e[q], (e[new[q]][0] + 2, "I" + e[new[q]][1]), (e[new[new[q]]][0] + 4, "II" + e[new[new[q]]][1])) for q in e}
    return w[0]


def test_one_conversation_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(turns, "SPAN", 7)
    turns.span.cache_clear()
    turns._whole.cache_clear()
    rng = random.Random(3)
    rows = [(5, t // 3, rng.choice(["user", "assistant", "assistant", "system"]), f"{rng.randint(0, 400)}" + rng.choice([".", ""])) for t in range(900)]
    rows += [(4, t, "user", f"{t}.") for t in range(3)] + [(6, None, "assistant", "a.")]
    got, lines = repaired_rows(spark, rows)
    own = sorted((r[1:] for r in rows if r[0] == 5))
    marked, n = faults(own)
    assert (got[5]["cost"], got[5]["audit"]) == by_steps(marked)
    assert got[5]["duplicate"] == n["duplicate"] and got[5]["gaps"] == 0
    assert SHAPE.match("".join(x[0] for x in lines[5]))
    assert got[4]["audit"] == "KIKR" and got[6]["audit"] == "IK"


def test_spans_joined_equal_one_derivation():
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choice("suaSUAxX-") for _ in range(rng.randint(1, 9)))
        cut = rng.randint(0, len(text))
        whole = turns.span(text)
        assert turns.join_spans(turns.span(text[:cut]), turns.span(text[cut:])) == whole
        rows = [({"s": "s", "u": "u", "a": "a"}.get(c.lower(), "?"), "", c == "-", int(c.isupper())) for c in text]
        (_, cost, audit), = turns.derive([whole])
        assert (cost, audit) == by_steps(rows)
        parts = turns.derive([turns.span(text[:cut]), turns.span(text[cut:])]) if 0 < cut < len(text) else [(0, cost, audit)]
        assert (sum(p[1] for p in parts), "".join(p[2] for p in parts)) == (cost, audit)


def test_repair_query_of_empty_and_dropped(spark, tmp_path):
    schema = "conv_id long, turn long, role string, text string, cost int, conv string"
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "a" / "conversations.parquet"))
    assert queries.op11_turn_repair(spark, str(tmp_path / "a")).count() == 0
    dropped = next(i for i in range(1000) if __import__("zlib").crc32(f"{i}:0".encode()) % 20 == 0)
    spark.createDataFrame([(dropped, 0, "user", "A.", 1, "x"), (None, None, None, None, 2, None)], schema).write.parquet(
        str(tmp_path / "b" / "conversations.parquet"))
    got = {r["conv_id"]: r for r in queries.op11_turn_repair(spark, str(tmp_path / "b")).collect()}
    assert got[dropped]["audit"] == "" and got[dropped]["cost"] == 0
    assert got[dropped]["repaired_sha256"] == hashlib.sha256(b"").hexdigest() == got[None]["repaired_sha256"]
    assert got[None]["blank"] in (1, 2) and set(got[None]["audit"]) == {"D"} and got[None]["gaps"] == 0


# -- Vector codes ----------------------------------------------------------------------------


@pytest.mark.parametrize("n, spread, degree", [(16, 50, 4), (16, 2, 4), (64, 1000, 3), (1, 9, 4), (5, 1, 2)])
def test_gnat_finds_the_nearest_lowest_entry(n, spread, degree):
    rng = np.random.default_rng(n + spread)
    entries = rng.integers(-spread, spread + 1, (n, 3)).astype(np.int64)
    q = np.concatenate((rng.integers(-2 * spread, 2 * spread + 1, (400, 3)), entries)).astype(np.int64)
    entry, d2 = codes.Gnat(entries, degree).nearest(q)
    all_ = ((q[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert (entry == all_.argmin(axis=1)).all() and (d2 == all_.min(axis=1)).all()


def test_gnat_of_large_numbers_and_ties():
    limit = codes.limit_of(8)
    rng = np.random.default_rng(2)
    entries = rng.choice([-limit, limit - 1, limit, 0, 1], (16, 8)).astype(np.int64)
    entries[9] = entries[3]
    q = np.concatenate((rng.integers(-limit, limit + 1, (100, 8)), entries)).astype(np.int64)
    entry, d2 = codes.Gnat(entries).nearest(q)
    want = [min((sum((int(a) - int(b)) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(entries)) for x in q]
    assert [(int(d), int(e)) for e, d in zip(entry, d2)] == want


def test_gnat_leaves_out_subtrees():
    """On parts in clear groups most entries are never compared."""
    rng = np.random.default_rng(4)
    entries = np.concatenate([c + rng.integers(-3, 4, (8, 4)) for c in rng.integers(-10_000, 10_000, (8, 4))]).astype(np.int64)
    tree, seen = codes.Gnat(entries), []
    rows = entries[rng.integers(0, 64, 200)] + 1
    search = tree._search
    tree._search = lambda node, q, at, best, entry: (seen.append(len(at) * len(node[0])), search(node, q, at, best, entry))[1]
    tree.nearest(rows)
    assert sum(seen) < 0.5 * len(rows) * len(entries)


def brute_codes(rows, parts=8, entries=16, rounds=6):
    ok = lambda v: v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v)
    kept = [(k, [math.floor(float(x) * 4096) for x in v], lab) for k, v, lab in rows if ok(v) and len(v) % parts == 0]
    by = lambda k: (k is None, k if k is not None else 0)
    if not kept:
        return []
    least = {}
    for k, v, _ in kept:
        least[k] = min(least.get(k, v), v)
    seeds = sorted(least, key=by)[:entries]
    width = len(least[seeds[0]])
    kept, m = [r for r in kept if len(r[1]) == width], width // parts
    books = [[least[s][p * m:(p + 1) * m] for s in seeds if len(least[s]) == width] for p in range(parts)]
    near = lambda q, book: min((sum((a - b) ** 2 for a, b in zip(q, e)), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            own = [[] for _ in books[p]]
            for _, v, _ in kept:
                q = v[p * m:(p + 1) * m]
                own[near(q, books[p])[1]].append(q)
            books[p] = [[sum(c) // len(o) for c in zip(*o)] if o else e for o, e in zip(own, books[p])]
    out = []
    for k, v, lab in kept:
        found = [near(v[p * m:(p + 1) * m], books[p]) for p in range(parts)]
        out.append((k, lab, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)))
    sums = Counter()
    for _, lab, _, e in out:
        sums[lab] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(k, c, e, sums[lab], digest) for k, lab, c, e in out]


def code_rows(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("Error", F.lit("x"))
    got = codes.compress(df.repartition(3))
    assert got.columns == ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"]
    return Counter(got.select("vec_id", "code", "error", "label_error", "codebooks_sha256").rdd.map(tuple).collect())


def test_codes_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.integers(0, 4) + rng.normal(size=16) * 0.2).astype(np.float32).tolist(), [0, 0, 0, 1, None][i % 5]) for i in range(120)]
    rows += [(1, rows[1][1], 3), (7, None, 0), (8, [1.0] * 15 + [None], 0), (9, [float("nan")] * 16, 0), (10, [float("inf")] * 16, 1),
             (500, [1.0] * 8, 0), (501, [], 0), (None, [0.5] * 16, 2), (-3, [-0.00001] * 16, 2), (502, [0.5] * 16, 2), (503, [2.0] * 15, 1)]
    want = Counter((k, c, e, s, d) for k, c, e, s, d in brute_codes(rows))
    assert code_rows(spark, rows) == want and len(want) > 100


def test_codes_of_few_equal_and_no_vectors(spark):
    few = [(3, [0.25] * 8, 1), (2, [0.25] * 8, 1), (2, [0.25] * 8, None)]
    assert code_rows(spark, few) == Counter(brute_codes(few))
    assert code_rows(spark, []) == Counter() == code_rows(spark, [(1, None, 1), (2, [float("nan")] * 8, 1)])
    large = [(i, [3e38, -3e38, 1e5 * i, 1.0, 0.0, -1.0, 2.0, 3.0], 0) for i in range(20)]
    out = codes.compress(spark.createDataFrame(large, "vec_id long, embedding array<float>, label int")).collect()
    assert len(out) == 20 and all(r["error"] >= 0 for r in out)


# -- Fair mix --------------------------------------------------------------------------------


def brute_targets(sizes, weights=(5, 2, 1), repeats=3):
    """Caps found by sharing again and again; sizes: {source: size}."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(repeats * sizes[s] for s in full)
        share = sum(weight[s] for s in order if s not in full)
        target = {s: repeats * sizes[s] if s in full else rest * weight[s] / share for s in order}
        above = {s for s in order if s not in full and target[s] > repeats * sizes[s]}
        if not above:
            return target
        full |= above


def mixed(spark, rows, parts=3):
    df = spark.createDataFrame(rows, "doc_id long, source string, size long, Target string").repartition(parts)
    got = mixing.mix(df)
    assert got.columns == ["doc_id", "source", "size", "source_size", "target", "taken"]
    return got.collect()


def test_mix_reaches_the_targets_and_agrees_with_a_rerun(spark):
    rng = random.Random(9)
    rows = [(i, rng.choice(["hot"] * 5 + ["a", "b", "é", "", None]), rng.choice([0, 1, 5, 80, 300]), "x") for i in range(600)]
    rows += [(1000, "tiny", 3, "x"), (1001, "zero", 0, "x"), (1002, "b", 20_000, "x"), (1003, "hot", None, "x"),
             (5, "a", 40, "x"), (5, "a", 40, "x"), (None, "a", 7, "x"), (None, None, 7, "x")]
    got = mixed(spark, rows)
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in got) == Counter((r[0], r[1], r[2]) for r in rows)
    sizes, taken = Counter(), Counter()
    for r in got:
        sizes[r["source"]] += r["size"] or 0
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 3 * (r["size"] or 0)
    want = brute_targets(sizes)
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]], rel=1e-12) and r["source_size"] == sizes[r["source"]]
    for s, t in want.items():
        assert abs(taken[s] - t) <= len(want)  # fractions of words
    assert sum(taken.values()) == sum(sizes.values())
    again = mixed(spark, random.Random(1).sample(rows, len(rows)), parts=7)
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_mix_of_one_source_and_of_no_rows(spark):
    got = mixed(spark, [(i, None, 10, "x") for i in range(9)])
    assert all(r["taken"] == 10 and r["target"] == 90.0 for r in got)
    assert mixed(spark, []) == []
    assert [(r["taken"], r["target"]) for r in mixed(spark, [(1, "a", 0, "x"), (2, None, None, "x")])] == [(0, 0.0)] * 2


def test_running_sums_of_hot_keys(spark):
    rows = [(1 if i % 3 else i, i, i % 7 if i % 5 else None) for i in range(2000)]
    got = running_sums(spark.createDataFrame(rows, "k long, i long, v long"), ["k", "i"], {"so_far": "v"}, "sums").collect()
    want, total = {}, 0
    for k, i, v in sorted(rows, key=lambda r: r[:2]):
        total += v or 0
        want[i] = total
    assert {r["i"]: r["so_far"] for r in got} == want


@pytest.mark.parametrize("name", ["op11_turn_repair", "op12_vector_codes", "op13_fair_mix"])
def test_query_matches_sql(spark, sf_small, name):
    r = compare(queries.REGISTRY[name](spark, sf_small), duck(sf_small), queries.SQL[name])
    assert r["columns_match"] and r["values_match"] and r["spark_rows"] == r["oracle_rows"], r
