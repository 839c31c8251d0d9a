"""Text operators against brute force, with nulls, empty and long texts, ties and clashing names."""

import random
import re
import zlib

import public_tokenizers
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

from tessera.llm import contamination, langid, licenses, pieces, shards, simhash

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "\n\t ", "a", "A a", "...", "é ü 漢字 🙂", "x" * 50_000, "the of and " * 30_000]


def frame(spark, texts, **extra):
    rows = [(i, t, *extra.values()) for i, t in enumerate(texts)]
    kinds = ", ".join(f"{k} string" for k in extra)
    return spark.createDataFrame(rows, "doc_id long, text string" + (", " + kinds if kinds else ""))


# -- SimHash ---------------------------------------------------------------------------------

def brute_fingerprint(text):
    words = [w for w in re.split(r"[ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints(spark):
    texts = ODD[:8] + ["one two", "One TWO three", "one two three four", "a\x0bb\x0cc\x1cd e", "a b c a b c a b c"]
    got = {r["doc_id"]: r["fp"] % (1 << 64) for r in simhash.with_fingerprint(frame(spark, texts)).collect()}
    assert got == {i: brute_fingerprint(t) for i, t in enumerate(texts)}


def test_manhattan_bound_never_exceeds_bit_distance():
    rng = random.Random(3)
    for _ in range(2000):
        a, b = rng.getrandbits(64), rng.getrandbits(64)
        near = a ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))
        for x, y in ((a, b), (a, near)):
            bound = sum(abs((x >> s & 3).bit_count() - (y >> s & 3).bit_count()) for s in range(0, 64, 2))
            assert (simhash.sorted_bits(x) ^ simhash.sorted_bits(y)).bit_count() == bound <= (x ^ y).bit_count()


def brute_parts(values, linked):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a in values:
        for b in values:
            if a < b and linked(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {v: find(v) for v in values}


@pytest.mark.parametrize("cell_rows", [8192, 8])
def test_links_equal_brute_force(spark, cell_rows):
    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(60)}
    for center in list(fps)[:4]:  # chains and dense balls
        x = center
        for _ in range(25):
            x ^= sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 3, 4])))
            fps.add(x)
            fps.add(center ^ (1 << rng.randrange(64)))
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    links = [(r["a"], r["b"]) for r in simhash.link_forest(df, cell_rows=cell_rows).collect()]
    near = lambda a, b: ((a ^ b) % (1 << 64)).bit_count() <= 3
    assert all(near(a, b) for a, b in links)
    known = {frozenset(x) for x in links}
    assert brute_parts(signed, lambda a, b: frozenset((a, b)) in known) == brute_parts(signed, near)


def test_near_duplicates_and_keep_first(spark):
    base = " ".join(f"w{i}" for i in range(400))
    texts = ODD[:5] + [base, base + " tail", base, "another text of its own entirely"]
    df = frame(spark, texts, fp="x", component_id="y").unionByName(  # clashing names and repeated rows
        spark.createDataFrame([(3, "\n\t ", "x", "y"), (None, base, "x", "y"), (None, "no id here", "x", "y")],
                              "doc_id long, text string, fp string, component_id string"))
    rows, groups = simhash.near_duplicates(df)
    got = [(r["id"], r["component_id"]) for r in rows.join(groups, "fp").collect()]
    assert sorted(x for x in got if x[0] is not None) == [
        (0, 0), (1, 0), (2, 0), (3, 0), (3, 0), (4, 4), (5, 5), (6, 5), (7, 5), (8, 8)]
    assert sorted(x[1] or -1 for x in got if x[0] is None) == [-1, 5]
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] if r["doc_id"] is not None else -1 for r in kept.collect()) == [-1, 0, 4, 5, 8]
    again = df.where("doc_id = 3")
    assert simhash.keep_first(again).count() == 1
    assert simhash.keep_first(df.limit(0)).count() == 0


def test_keep_first_with_ids_in_several_groups(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(300)) for x in "ab")
    for rows, want in ([(5, a), (3, b), (5, b)], [(3, b), (5, a)]), ([(5, a), (5, a), (5, b)], [(5, a), (5, b)]):
        kept = simhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string"))
        assert sorted(map(tuple, kept.collect())) == want


# -- Decontamination -------------------------------------------------------------------------

def brute_contamination(texts, items, window=13):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    out = {}
    for d, text in enumerate(texts):
        w, hit, found = split(text), set(), set()
        for item, t in items:
            p = split(t)
            m = min(window, len(p))
            for i in range(len(p) - m + 1 if m else 0):
                for j in range(len(w) - m + 1):
                    if w[j:j + m] == p[i:i + m]:
                        hit |= set(range(j, j + m))
                        found.add(str(item))
        out[d] = (len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w))
    return out


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_contamination_equals_brute_force(spark, block_bytes):
    rng = random.Random(7)
    vocabulary = ["the", "of", "é", "naïve", "x1", "and", "Q", "zz"]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, say(rng.choice([0, 1, 2, 5, 12, 13, 14, 30]))) for i in range(12)] + [(3, say(20)), (50, None)]
    texts = [None, "", "!!!", *(say(rng.randrange(40)) for _ in range(25)),
             *(say(5) + ", " + t.upper() + "; " + say(rng.randrange(90)) for _, t in items if t)]
    df = frame(spark, texts, items="clash", N_HIT="clash")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = contamination.find_contamination(df, bench, max_block_bytes=block_bytes).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in got} == brute_contamination(texts, items)
    none = contamination.find_contamination(df, bench.limit(0)).agg(F.sum("n_hit")).first()[0]
    assert none == 0 and contamination.find_contamination(df.limit(0), bench).count() == 0


def test_contamination_of_long_texts(spark):
    item = " ".join(f"k{i}" for i in range(30))
    texts = ["the of and " * 30_000 + item, item]
    got = contamination.find_contamination(frame(spark, texts), spark.createDataFrame([(None, item)], "item_id long, text string"))
    assert [(r["n_hit"], r["items"], r["contaminated"]) for r in got.orderBy("doc_id").collect()] == [(30, [], False), (30, [], True)]


# -- Pieces ----------------------------------------------------------------------------------

def test_pieces_equal_the_library(spark):
    rng = random.Random(1)
    bits = ["a", "th", "e", " ", "  ", "\n", "é", "漢", "🙂", "ing", "▁", "10", "==", "{", "\t", "́", "».", "</s>", "<0x41>", "\x00"]
    texts = ODD + [" a", "a ", "aaaa" * 300, " " * 99] + ["".join(rng.choice(bits) for _ in range(rng.randrange(60))) for _ in range(400)]
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = pieces.encode_texts(frame(spark, texts, ids="clash"), MODEL).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = sp.encode(texts[r["doc_id"]] or "", add_eos=True)
        assert r["ids"] == ids and r["decoded"] == sp.decode(ids)
    assert pieces.encode_texts(frame(spark, texts).limit(0), MODEL).count() == 0


def test_decoding_any_ids_equals_the_library():
    model = pieces.PieceModel(open(MODEL, "rb").read())
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rng = random.Random(2)
    for _ in range(1500):
        ids = [rng.choice([rng.randrange(32_000), rng.randrange(259)]) for _ in range(rng.randrange(12))]
        assert model.decode(ids) == sp.decode(ids)


# -- Language ID -----------------------------------------------------------------------------

def test_ngram_counts_ignore_case_marks_and_chunks(monkeypatch):
    a = langid.counts_of("Hello,  world!", 1 << 10)
    assert (a == langid.counts_of("hello world", 1 << 10)).all()
    long = "straße und brücke " * 500
    whole = langid.counts_of(long, 1 << 10)
    monkeypatch.setattr(langid, "_CHUNK", 100)
    assert (langid.counts_of(long, 1 << 10) == whole).all()
    assert all(langid.counts_of(t, 1 << 10) is None for t in (None, "", "12 !?", "\n"))


def test_language_held_out_accuracy(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text", "lang")
    held = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 1
    model = langid.fit(docs.where(~held).select(F.col("doc_id").alias("key"), F.col("lang").alias("label"), "text"))
    got = langid.predict(docs.where(held).withColumn("score", F.lit("clash")), model)
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.9
    assert (model.weights == 0).mean() > 0.2 and 0.05 <= model.temperature <= 20
    odd = {r["doc_id"]: r for r in langid.predict(frame(spark, ODD), model).collect()}
    assert [odd[i]["lang_pred"] for i in (0, 1, 2, 3, 6)] == ["und"] * 5
    assert all(0 <= r["score"] <= 1 for r in odd.values()) and odd[4]["lang_pred"] != "und"


def test_language_without_training_rows(spark):
    none = spark.createDataFrame([(1, None, "text"), (2, "en", None)], "key long, label string, text string")
    got = langid.predict(frame(spark, ["some words", None]), langid.fit(none)).collect()
    assert [(r["lang_pred"], r["score"]) for r in got] == [("und", 0.0)] * 2


# -- Licenses --------------------------------------------------------------------------------

def brute_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_alignment_is_a_common_subsequence_and_whole_where_words_are_unique():
    rng = random.Random(4)
    for _ in range(300):
        a = [rng.choice("abcdefgh") for _ in range(rng.randrange(14))]
        b = [rng.choice("abcdefgh") for _ in range(rng.randrange(14))]
        pairs = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))
        assert len(pairs) <= brute_lcs(a, b)
        u = rng.sample(range(40), 15)
        v = rng.sample(range(40), 15)
        assert len(licenses.align(u, v)) == brute_lcs(u, v)


def brute_scan(templates, text):
    """All notices by LCS: every stretch of a region that begins and ends with a matched word, the best ones first."""
    words, found = licenses.words_of(text.encode()), []
    for t in templates:
        hits = [i for i, w in enumerate(words) if w in t.vocabulary]
        for run in t.runs(hits):
            lcs = {}
            for s in run:
                row = [0] * (len(t.words) + 1)
                for e in range(s, run[-1] + 1):
                    new = [0]
                    for j, w in enumerate(t.words):
                        new.append(row[j] + 1 if words[e] == w else max(row[j + 1], new[j]))
                    row = new
                    lcs[s, e + 1] = row[-1]
            for (s, e), n in lcs.items():
                if n >= t.need and n > lcs.get((s, e - 1), 0) and all(n > lcs.get((x, e), 0) for x in run if s < x < e):
                    found.append((t.name, n / len(t.words), n, s, e))
    kept = []
    for notice in sorted(found, key=licenses._rank):
        if all(notice[4] <= k[3] or k[4] <= notice[3] for k in kept):
            kept.append(notice)
    return kept


def test_license_scan_equals_brute_force():
    rng = random.Random(11)
    templates = [licenses.Template(n, t, licenses.MIN_COVERAGE) for n, t in sorted(licenses.TEMPLATES.items())]
    several = 0
    for _ in range(60):
        text = []
        for t in rng.sample(templates, rng.randint(1, 3)):
            text += [f"z{rng.randint(0, 9)}" for _ in range(rng.randint(len(t.words) + 7, len(t.words) + 30))]
            gone = set(rng.sample(range(len(t.words)), rng.randint(0, len(t.words) - t.need + 1)))  # one more than may go
            for i, w in enumerate(t.words):
                if i not in gone:
                    text += [w.decode(), *(f"y{rng.randint(0, 9)}" for _ in range(rng.choice((0, 0, 0, 1, 3))))]
        text = " ".join(text)
        got, want = licenses.scan(templates, text.encode()), brute_scan(templates, text)
        assert got == want, text
        several += len(want) > 1
    assert several > 5


def test_license_scan_of_shuffled_template_words_is_sound():
    """Whatever the words, each notice is a common subsequence of its place, and none overlap."""
    rng = random.Random(12)
    templates = [licenses.Template(n, t, 0.6) for n, t in sorted(licenses.TEMPLATES.items())]
    vocabulary = sorted(set().union(*(t.vocabulary for t in templates)))
    by_name = {t.name: t for t in templates}
    seen = 0
    for _ in range(300):
        own = rng.choice(templates).words
        words = [rng.choice(own) if rng.random() < 0.5 else own[i % len(own)] if rng.random() < 0.9 else rng.choice(vocabulary)
                 for i in range(rng.randint(5, 60))]
        notices = licenses.scan(templates, b" ".join(words))
        for name, coverage, n, start, end in notices:
            t = by_name[name]
            assert t.need <= n <= brute_lcs(words[start:end], t.words) and coverage == n / len(t.words)
        places = sorted(n[3:] for n in notices)
        assert all(a[1] <= b[0] for a, b in zip(places, places[1:]))
        seen += len(notices)
    assert seen > 20


def test_license_scan(spark):
    mit, gpl = licenses.TEMPLATES["MIT"], licenses.TEMPLATES["GPL-3.0"]
    noise = "the version of this work is under the public " * 40
    texts = [None, "", noise, noise + mit + ".\n" + noise, gpl.upper() + " " + gpl, "x " * 40_000 + gpl,
             "Licensed under CC BY 4.0.", "Licensed under CC BY-NC 4.0.", gpl.replace("General ", ""), gpl + " " + mit]
    got = {r["doc_id"]: r for r in licenses.scan_licenses(frame(spark, texts, license="clash")).collect()}
    assert [got[i]["license"] for i in range(10)] == [
        None, None, None, "MIT", "GPL-3.0", "GPL-3.0", "CC-BY-4.0", "CC-BY-NC-4.0", "GPL-3.0", "GPL-3.0"]
    assert got[3]["coverage"] == 1.0 and got[3]["end"] - got[3]["start"] == 5 and got[5]["start"] == 40_000
    assert got[8]["coverage"] == pytest.approx(11 / 12)
    assert licenses.scan_licenses(frame(spark, texts), templates={}).where("license is not null").isEmpty()


def test_all_notices_of_a_text(spark):
    t = licenses.TEMPLATES
    texts = [t["GPL-3.0"] + " x " * 30 + t["MIT"] + " y " + t["MIT-text"] + " z " + t["GPL-3.0"], t["CC-BY-NC-4.0"],
             t["GPL-3.0"].replace("work ", "") + " " + t["GPL-3.0"].replace("General ", ""),
             2 * (t["GPL-3.0"].replace("This ", "") + " "), "none", None]
    got = {r["doc_id"]: r for r in licenses.scan_licenses(frame(spark, texts)).collect()}
    see = lambda i: [(n["license"], n["start"], n["end"]) for n in got[i]["notices"]]
    assert see(0) == [("GPL-3.0", 0, 12), ("MIT", 42, 47), ("MIT-text", 48, 75), ("GPL-3.0", 76, 88)]
    assert see(1) == [("CC-BY-NC-4.0", 0, 7)]
    assert see(2) == see(3) == [("GPL-3.0", 0, 11), ("GPL-3.0", 11, 22)]
    assert see(4) == see(5) == [] and got[4]["license"] is None
    assert (got[0]["license"], got[0]["start"], got[0]["end"]) == ("MIT-text", 48, 75)


def test_notice_with_a_long_insertion(spark):
    bsd = licenses.TEMPLATES["BSD-3-Clause"]
    cut = bsd.replace("are permitted", "are permitted for academic, teaching, study, research purposes only")
    far = bsd.replace("are permitted", "are permitted " + "x " * 22)
    texts = [cut, "y " * 9 + cut + " z" * 9 + " " + bsd, far, bsd + " x" * 8 + " in source and binary forms"]
    got = {r["doc_id"]: [(n["license"], n["n_matched"], n["start"], n["end"]) for n in r["notices"]]
           for r in licenses.scan_licenses(frame(spark, texts)).collect()}
    assert got[0] == [("BSD-3-Clause", 21, 0, 28)]
    assert got[1] == [("BSD-3-Clause", 21, 9, 37), ("BSD-3-Clause", 21, 46, 67)]
    assert got[2] == [] and got[3] == [("BSD-3-Clause", 21, 0, 21)]


def test_standard_headers(spark):
    gnu = ("/* This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General "
           "Public License as published by\n * the Free Software Foundation, either version {} of the License, or\n"
           " * (at your option) any later version. */")
    texts = [gnu.format(3), gnu.format(2), gnu.format(3).replace("GNU", "GNU Affero"),
             gnu.format(3).replace("GNU", "GNU Lesser"), *(t for texts in licenses.HEADERS.values() for t in texts)]
    want = ["GPL-3.0", "GPL-2.0", "AGPL-3.0", "LGPL-3.0", *(n for n, texts in licenses.HEADERS.items() for _ in texts)]
    got = {r["doc_id"]: (r["license"], r["coverage"]) for r in licenses.scan_licenses(frame(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == [(n, 1.0) for n in want]


# -- Shards ----------------------------------------------------------------------------------

def test_rebalance_moves_whole_slots_until_near_equal():
    rng = random.Random(6)
    weight = {s: rng.randrange(1, 1000) for s in range(500)}
    first = shards.initial_map(500, 8)
    second = shards.rebalance(first, weight, 8)
    load = [sum(w for s, w in weight.items() if second[s] == k) for k in range(8)]
    heaviest = load.index(max(load))
    assert max(load) - min(load) <= min(w for s, w in weight.items() if second[s] == heaviest)
    assert max(load) < 1.01 * min(load) and sum(load) == sum(weight.values())
    grown = shards.rebalance(second, weight, 9)
    assert set(grown) == set(range(9))
    assert shards.rebalance(first, {}, 8) == first


def test_shards_are_whole_balanced_and_gapless(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", (F.length("text") + 16).alias("size"))
    df = docs.withColumn("shard", F.lit("clash")).unionByName(
        spark.createDataFrame([(None, 16, "x"), (None, None, "x"), (5, 16, "x"), (5, 16, "x")], "doc_id long, size int, shard string"))
    out, path = shards.shard_by_bytes(df, ["doc_id", "size"], "size", 5)
    rows = out.collect()
    assert len(rows) == df.count()
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r)
    for own in by.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    load = [sum(r["size"] or 0 for r in own) for own in by.values()]
    assert len(by) == 5 and max(load) - min(load) < 0.02 * max(load)
    assert shards.read_map(spark, path).count() == shards.N_SLOTS == shards.read_map(spark, path, 1).count()
    assert shards.shard_by_bytes(df.limit(0), ["doc_id"], "size", 5)[0].count() == 0


def test_one_record_repeated_is_numbered_by_many_tasks(spark):
    rows = [(7, 16)] * 3000 + [(i, 16) for i in range(200)]
    df = shards.with_vslot(spark.createDataFrame(rows, "doc_id long, size long"), "doc_id")
    out = shards.assign(df, spark.createDataFrame(list(enumerate(shards.initial_map(shards.N_SLOTS, 3))), "vslot int, shard int"), "doc_id")
    by = {}
    for r in out.collect():
        by.setdefault(r["shard"], []).append((r["vslot"], r["doc_id"], r["slot"]))
    for own in by.values():  # in the order of virtual slots and keys, gapless
        assert [x[2] for x in sorted(own)] == list(range(len(own)))
    assert sum(map(len, by.values())) == len(rows)
    assert "row_number" not in out._jdf.queryExecution().toString()
    hot = spark.read.parquet(*out.inputFiles()).where("doc_id = 7").groupBy("_range").count().collect()
    assert len(hot) > 1 and max(r["count"] for r in hot) < 2500


def test_op2_digest(spark, sf_small):
    from tessera.llm.queries import op2_virtual_slots
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    for r in op2_virtual_slots(spark, sf_small).collect():
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 16, zlib.crc32(raw)) and r["law"] == "bytes"
