"""The llm operators on small fixtures, against brute force and defined corner cases."""

import random
from collections import defaultdict
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from docketry.llm import addresses, leakage, lookalikes, matching, mixture, ngrams, places

GAZ = "place_id int, canonical string, alias string, zips array<string>"


@pytest.fixture(scope="module")
def gazetteer(spark):
    return spark.createDataFrame([(1, "CASTELLAN", "CSTL", ["00211"]), (2, "NORTH ARDLEY", None, ["00288", "00607"]), (3, "SOUTH ARDLEY", None, ["00295", "00607"]), (4, "DUNMERE", None, ["00232"]), (5, "PENHALLOW", None, ["00337"]), (6, "EAST PENHALLOW", None, ["00344"])], GAZ)


# ---- look-alikes


@pytest.mark.parametrize("line, normal", [
    ("ｅｖｅｎｉｎｇ．", "evening."), ("inﬁrmary", "infirmary"), ("Ⅻ", "XII"), ("hàrvest", "hàrvest"), ("fo​urteen", "fourteen"), ("any­price", "anyprice"), ("the fair", "the fair"),
    ("весь‑же", "весь-же"), ("gеnеrоuѕ", "generous"), ("Βrücke", "Brücke"), ("he saw а man", "he saw a man"), ("a\tb", "a b"), ("нашёл слово словo", "нашёл слово слово"),
    ("— “Дружба” —", "— “Дружба” —"), ("ΠΟΎΛΗΣΕ XII", "ΠΟΎΛΗΣΕ XII"), ("Straße être", "Straße être"), ("Wäch¬", "Wäch¬"), ("Tue8day 1n", "Tue8day 1n"), ("ПожарXII", "ПожарXII"), ("", ""), ("½ … ™", "½ … ™"), ("Mossop. — “Дружба” — A", "Mossop. — “Дружба” — A"), ("by Міѕѕ Kettleby", "by Miss Kettleby"), ("кузнец. Весь-же  HATS! HATS!", "кузнец. Весь-же  HATS! HATS!"),
])
def test_normal_line(line, normal):
    assert lookalikes.normal_line(line) == normal
    assert lookalikes.normal_line(normal) == normal


def test_lookalike_lines(spark, rows):
    df = spark.createDataFrame([(1, "plain\nｗide\n", "x"), (2, None, "x"), (3, "", "x"), (4, "Дом и сад", "x"), (1, "plain\nｗide\n", "x"), (5, "a​" * 20000, "x")], "doc_id long, text string, line string")
    assert rows(lookalikes.lookalike_lines(df), "doc_id", "line_no") == [(1, 1), (1, 1), (5, 0)]
    assert lookalikes.lookalike_lines(df.limit(0)).count() == 0
    got = {r["doc_id"]: (r["normal"], r["n_changed"]) for r in lookalikes.normalise_text(df).collect()}
    assert got[1] == ("plain\nwide\n", 1) and got[2] == (None, 0) and got[3] == ("", 0) and got[4] == ("Дом и сад", 0) and got[5] == ("a" * 20000, 1)


# ---- leakage

NOUNS = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in ("arno", "ixel", "ondu") for c in ("mar", "tess", "vik")]


def article(rnd, n):
    return [rnd.choice(NOUNS) if rnd.random() < 0.5 else rnd.choice(["the", "of", "was", "near", "and"]) for _ in range(n)]


def page(lines, columns=1):
    return ("\n".join(lines), [{"x": 120 if i < len(lines) // columns else 1210, "y": 200 + 40 * (i % (len(lines) // columns)), "w": 900, "h": 30, "conf": 80} for i in range(len(lines))], columns)


DOC = "doc_id long, text string, boxes array<struct<x:int,y:int,w:int,h:int,conf:int>>, n_columns int, words int"


def test_leaks(spark, rows):
    rnd = random.Random(11)
    item = article(rnd, 60)
    other = article(rnd, 60)
    wrap = lambda ws: [" ".join(ws[i : i + 6]) for i in range(0, len(ws), 6)]
    filler = lambda n: article(random.Random(rnd.random()), n)
    broken = wrap(filler(30) + item[5:35] + filler(24))
    broken[6] = broken[6].upper().replace("E", "Ｅ")
    two = broken[:7] + ["HATS! HATS!", "Call at once."] + broken[7:]
    cut_word = " ".join(item[20:26]) + " " + item[26][:3] + "-\n" + item[26][3:] + " " + " ".join(item[27:34])
    docs = [(1, *page(wrap(filler(60) + item[10:40] + filler(60)))), (2, *page(wrap(filler(40) + item[10:18] + filler(40)))), (3, *page(two)), (4, None, None, None), (5, "", [], 1), (6, *page(wrap(filler(200)))), (7, cut_word, None, None), (1, *page(wrap(item[10:40])))]
    df = spark.createDataFrame([(*d, 1) for d in docs], DOC)
    items = spark.createDataFrame([(7, "s", " ".join(item)), (8, "s", " ".join(other)), (9, "s", None), (10, "s", "too short"), (11, "s", " ".join(item[:50]))], "item_id long, suite string, text string")
    assert rows(leakage.leaks(df, items), "doc_id", "item_id") == [(d, i) for d in (1, 3, 7) for i in (7, 11)]
    assert leakage.leaks(df.limit(0), items).count() == 0 == leakage.leaks(df, items.limit(0)).count()


def test_reading_order_puts_columns_together():
    text, boxes, n = page(["a1", "a2", "b1", "b2"], 2)
    order = [0, 2, 1, 3]
    lines, take = text.split("\n"), lambda k: np.array([boxes[i][k] for i in order])
    assert leakage.reading_order("\n".join(lines[i] for i in order), take("x"), take("y"), take("w"), n) == ["a1", "a2", "b1", "b2"]
    assert leakage.reading_order("a  b", np.array([120]), np.array([1]), np.array([1990]), 2) == ["a", "b"]
    assert leakage.reading_order("a\nb", np.array([1]), np.array([1]), np.array([1]), 1) == ["a", "b"]


def test_short_damaged_passages_of_common_words_are_found():
    rnd = random.Random(3)
    common = [f"{a}{b}" for a in ("ther", "whic", "abou", "betw") for b in ("eal", "omp", "urd", "ink")]
    item = [rnd.choice(common) for _ in range(40)]
    counts = {w: 900 for w in common}
    index = leakage.build_index([(1, " ".join(item))])
    pages, found = [], []
    for start in range(0, 28):
        words = [w if k in (0, 4, 5, 6, 7, 11) else w[:2] + "x" + w[3:] for k, w in enumerate(item[start : start + 12])]
        rest = [f"zq{k:03d}" for k in range(30)]
        pages.append(("\n".join(" ".join(ws) for ws in (rest[:15], words[:6], words[6:], rest[15:])), [], [], [], 1))
        found.append((start, 0, 12))
    got = [(p, k, n) for p, k, n, words, intact in leakage.scan_pages(pages, index) if leakage.intact_enough(words, intact, counts, 1000)]
    assert sorted(set(got)) == found


def test_a_false_first_seed_does_not_stand_for_its_run():
    rnd = random.Random(6)
    item = [rnd.choice(NOUNS[:20]) for _ in range(40)]
    item[10:13] = ["the", "of", "kettleby"]
    index = leakage.build_index([(1, " ".join(item))])
    text = ["zqba", "zqbe"] + item[12:30] + ["zqbi", "zqbo"]
    assert {x[:3] for x in leakage.scan_pages([(" ".join(text), [], [], [], 1)], index)} == {(0, 0, 18)}


def test_no_seed_is_dropped_that_aligns(monkeypatch):
    rnd = random.Random(9)
    item = article(rnd, 200)
    index = leakage.build_index([(1, " ".join(item))])
    lines = []
    for _ in range(60):
        at = rnd.randrange(180)
        ws = [w if rnd.random() < 0.8 else rnd.choice([w[:-1] + "x", w[:2] + " " + w[2:], w + rnd.choice(item)]) for w in item[at : at + rnd.randrange(5, 20)]]
        lines += [" ".join(ws[:7]), rnd.choice(["HATS! HATS!", "", "call at once today"]), " ".join(ws[7:])]
    pages = [("\n".join(lines[k : k + 30]), [], [], [], 1) for k in range(0, len(lines), 30)]
    got = sorted(leakage.scan_pages(pages, index))
    monkeypatch.setattr(leakage._Reach, "enough", lambda self, a, b, own: np.ones(len(a), bool))
    assert got == sorted(leakage.scan_pages(pages, index)) and got


def test_hamming_blocks_find_every_pair_within_the_radius():
    rnd = np.random.default_rng(2)
    base = rnd.integers(0, 2**63, 300).astype(np.uint64)
    index = leakage.build_index([(1, " ".join(f"w{i}" for i in range(40)))])
    index.prints = base
    index.order = [np.argsort(leakage._block(base, k), kind="stable") for k in range(len(leakage.BLOCKS))]
    index.keys = [leakage._block(base, k)[o] for k, o in enumerate(index.order)]
    for k in range(len(leakage.BLOCKS)):
        index.seen[k][:] = False
        index.seen[k][index.keys[k]] = True
    near = base ^ np.uint64(1 << 3) ^ np.uint64(1 << 40)
    a, b = leakage.seeds(near, index)
    want = {(i, j) for i in range(300) for j in range(300) if bin(int(near[i] ^ base[j])).count("1") <= leakage.RADIUS}
    assert set(zip(a.tolist(), b.tolist())) == want and len(want) >= 300


# ---- n-grams, places, addresses


def test_prefix_filter_loses_no_pair(spark):
    rnd = random.Random(4)
    words = ["".join(rnd.choice("abcd") for _ in range(rnd.randint(3, 8))) for _ in range(60)]
    df = spark.createDataFrame([(w,) for w in words], "text string")
    got = {(r["text"], r["reference"]): r["cosine"] for r in ngrams.similar(df, df, 0.5).collect()}
    weight = {r["gram"]: r["weight"] for r in ngrams.gram_weights(df).collect()}
    grams = {r["text"]: set(r["g"]) for r in df.select("text", ngrams.grams_of(F.col("text")).alias("g")).collect()}
    norm = lambda g: sum(weight[x] ** 2 for x in g) ** 0.5
    want = {(a, b): c for a in grams for b in grams if (c := norm(grams[a] & grams[b]) ** 2 / norm(grams[a]) / norm(grams[b])) >= 0.5}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_places(spark, gazetteer):
    cross = spark.createDataFrame([("SPINDLETHORPE", None, "unresolved", None, 3), ("THE CASTLE", "CASTELLAN", "manual", None, 1), ("X", "NOT LISTED", "manual", 1.0, 1)], "raw string, canonical string, method string, score double, n_rows long")
    want = {
        "CASTELLAN, NK 00211-5170": "CASTELLAN", "Castelan": "CASTELLAN", "C A S T ELLAN": "CASTELLAN", "CASTELLANDROPDOWN77": "CASTELLAN", "ARDLEY, NORTH": "NORTH ARDLEY", "N. ARDLEY": "NORTH ARDLEY", "ARDLEY": places.NONE,
        "E PENHALLOW": "EAST PENHALLOW", "PENHALLOW": "PENHALLOW", "00232": "DUNMERE", "00607": places.NONE, "DUNMERE 00211": "DUNMERE", "Spindlethorpe, NK": places.NONE, "The Castle": "CASTELLAN", "CSTL": "CASTELLAN",
        "": places.NONE, "?": places.NONE, "DNUERE": "DUNMERE", "X" * 3000: places.NONE, "CITY OF DUNMERE": "DUNMERE", "N/A": places.NONE, "DNUMRE": "DUNMERE",
    }
    entries = spark.createDataFrame([(w,) for w in [*want, "CSTL"]] + [(None,)], "raw string")
    assert {r["raw"]: r["canonical"] for r in places.resolve_names(entries, gazetteer, cross).collect()} == want
    assert places.resolve_names(entries.limit(0), gazetteer).count() == 0
    again = {r["raw"]: (r["method"], r["score"]) for r in places.resolve_names(entries, gazetteer, cross).collect()}
    assert again["Castelan"][0] == "fuzzy" and places.ACCEPT <= again["Castelan"][1] < 1 and again["CSTL"] == ("exact", 1.0) and again["?"][0] == "unmatched"


@pytest.mark.parametrize("text, parts", [
    ("2200 GRANARY MALL BV STE 14", ("2200", None, "GRANARYMALL", "BLVD", None)), ("S  LAUREL CHASE PKWY, 6065", ("6065", "S", "LAURELCHASE", "PKWY", None)), ("4434 S. Cr-1001 Dunmere Nk 00436", ("4434", "S", "COUNTYROAD1001", None, "DUNMERE")),
    ("APT 12, RAVEN SUMMIT CT, #7475", ("7475", None, "RAVENSUMMIT", "CT", None)), ("# 23, 6719 NORTH NUTHATCH ISLAND RD", ("6719", "N", "NUTHATCHISLAND", "RD", None)), ("NO 7, 5233 W LAGOON DRV", ("5233", "W", "LAGOON", "DR", None)),
    ("MILLER PARISH BOUL, NO. 8676", ("8676", None, "MILLERPARISH", "BLVD", None)), ("2614 Fifth Pkwy", ("2614", None, "5TH", "PKWY", None)), ("7600 BLOCK OF SORREL CASTLE ST", None), ("A ST & B AV", None), ("A ST / B AV", None), ("", None), ("MAIN ST", None),
])
def test_read_address(text, parts):
    assert addresses.read_address(text, (("DUNMERE", "DUNMERE"),)) == parts


def test_same_building(spark, gazetteer, rows):
    inc = [("i1", "100 E MAPLE CREST AV", "00211", None), ("i2", "100 W MAPLE CREST AVE", "00211", None), ("i3", "100 MAPLE CREST AV", "00211", None), ("i4", "55 Oak Hill", "00232", None), ("i5", "100 BLOCK OF OAK HILL RD", "00232", None), ("i6", None, None, None), ("i7", "9 FORT RD", "00211", None), ("i8", "9 FORT RD", "00232", None), ("i4", "55 Oak Hill", "00232", None)]
    rec = [("r1", "100 EAST MAPLE CREST AVENUE APT 4", "00211"), ("r2", "55 OAKHILL ROAD", "232"), ("r3", "9 Ft. Road, Dunmere NK", None), ("r4", "9 FORT RD", None), ("r5", "", "00211"), ("r6", "101 E MAPLE CREST AV", "00211")]
    df = spark.createDataFrame([(i, "left", a, z, c) for i, a, z, c in inc] + [(i, "right", a, z, None) for i, a, z in rec], "id string, source string, address string, zip string, city string")
    assert rows(addresses.same_building(df, gazetteer)) == [("i1", "r1"), ("i4", "r2"), ("i8", "r3")]
    assert addresses.same_building(df.limit(0), gazetteer).count() == 0


def test_same_building_joins_spellings_of_an_infrequent_street(spark, gazetteer, rows):
    inc = [("i1", "12 MAPLE HOLLOW RD", "00211"), ("i2", "7 RAVENN SUMMIT", "00232"), ("i3", "9 E 4TH STRET AV", "00211"), ("i4", "12 MAPLE HOLLOW RD", "00337"), ("i5", "12 COUNTY ROAD 1001", "00211"), ("i6", "30 CEDAR HOLLOW RD", "00211")]
    rec = [("r1", "12 MAPEL HOLLOW RD", "00211"), ("r2", "7 RAVEN SUMIT CT", "00232"), ("r3", "9 E 4TH STREET AV", "00211"), ("r4", "12 COUNTY ROAD 1003", "00211"), ("r5", "12 MAPEL HOLLOW AVE", "00211"), ("r6", "30 LAGOON FENCE RD", "00211")]
    more = [(f"m{k}", "left", f"{200 + k} {name}", "00288", None) for k, name in enumerate(["LAUREL CHASE PKWY", "SORREL CASTLE ST", "GRANARY MALL BLVD", "MILLER PARISH BLVD", "NUTHATCH ISLAND RD", "OAK HILL RD"])]
    df = spark.createDataFrame([(i, "left", a, z, None) for i, a, z in inc] + [(i, "right", a, z, None) for i, a, z in rec] + more, "id string, source string, address string, zip string, city string")
    assert rows(addresses.same_building(df, gazetteer)) == [("i1", "r1"), ("i2", "r2"), ("i3", "r3")]


# ---- people


def people(rnd, n):
    firsts, lasts = ["ROBERT", "MARIA", "EUGENE", "NADIA", "OSCAR", "HELEN", "VICTOR", "PAULA"], [f"{a}{b}" for a in ("BRON", "KELL", "TRAV", "MOND", "SAX") for b in ("WICK", "BERG", "ADOTTIR", "ISLE")]
    streets = ["MAPLE CREST AV", "OAK HILL RD", "FORT FENCE DR", "RAVEN SUMMIT CT", "COUNTY ROAD 1003"]
    return [(rnd.choice(firsts), rnd.choice(lasts), f"{rnd.randint(1940, 2005)}-{rnd.randint(1, 12):02d}-{rnd.randint(1, 28):02d}", f"{rnd.randint(100, 9999)} {rnd.choice(streets)}", f"00{rnd.randint(211, 260)}") for _ in range(n)]


PERSON = "rec_id string, source string, first_name string, last_name string, dob string, address string, zip string, confidence string"


def test_match_without_labels(spark):
    rnd = random.Random(8)
    base = people(rnd, 260)
    a = [(f"A{i}", "a", *p, "") for i, p in enumerate(base[:230])]
    b, truth = [], set()
    for i, (f, la, d, ad, z) in enumerate(base[60:]):
        kind = rnd.randrange(5)
        rec = [(f, la, d, ad, z), (la, f, d, ad, z), (f[0] + ".", la, d, ad.lower(), None), (f, la[:-2] + la[-1] + la[-2], "", ad, z), (f, la, d, "1 ELSEWHERE ST", "00299")][kind]
        b.append((f"B{i}", "b", *rec, ""))
        if i + 60 < 230:
            truth.add((f"A{i + 60}", f"B{i}"))
    df = spark.createDataFrame(a + b + a[:3] + [("A999", "a", None, None, None, None, None, ""), (None, "a", "X", "Y", None, None, None, "")], PERSON)
    out = matching.match(df).where("a_source = 'a' AND b_source = 'b' AND confidence >= 0.5").collect()
    got = {(r["a_id"], r["b_id"]) for r in out}
    hit = len(got & truth)
    assert len(out) == len(got) and hit / len(got) > 0.97 and hit / len(truth) > 0.93
    assert matching.match(df.limit(0)).count() == 0


@pytest.mark.parametrize("times", [1, 300])
def test_unknown_birth_dates_say_nothing_however_many_others_meet(spark, times):
    r = lambda first="NADIA", last="KELLBERG", dob="19800103", number="500": SimpleNamespace(first=first, last=last, suffix="", dob=dob, number=number, street="FORT FENCE", direction="", type="", zip="00211")
    same = [(r(), 560), (r(number="77"), 80), (r(first="N"), 65), (r(dob="19800104"), 50), (r(dob=""), 80), (r(dob="19800131"), 25)]
    other = [(r(first=f, dob="19651130"), 30) for f in ("OSCAR", "VICTOR", "PAULA", "HELEN", "RASHID")] + [(r(last=x, dob="19651130"), 15) for x in ("MOND", "SAXTON")] + [(r(first="OSCAR", last=x, number="77"), 20) for x in ("MOND", "SAXTON", "TRAVISLE")]
    rows = [(*matching.vector(r(), x), n) for x, n in same] + [(*matching.vector(r(), x), n * times) for x, n in other]
    vectors = spark.createDataFrame(rows, ", ".join(f"{f} double" for f in matching.FEATURES) + ", n long").coalesce(1).cache()
    model = matching.maximise(vectors, ((F.col("first") >= 0.8) & (F.col("last") >= 0.8)).cast("double"))
    for _ in range(6):
        model = matching.maximise(vectors, matching.posterior_of(model))
    got = [x["p"] for x in vectors.select(matching.posterior_of(model, final=True).alias("p")).collect()]
    assert got[4] >= 0.5 and max(got[len(same) :]) < 0.5


def test_rounds_of_the_mixture_share_their_code(spark):
    rows = [(1.0, 1.0, 1.0, 1.0, 50), (1.0, 1.0, None, 0.9, 20), (0.9, 1.0, 0.8, None, 20), (0.2, 0.3, 0.0, 0.4, 90), (0.1, 1.0, 0.0, 1.0, 40), (0.3, 0.2, None, None, 5)]
    vectors = spark.createDataFrame(rows, ", ".join(f"{f} double" for f in matching.FEATURES) + ", n long").coalesce(1).cache()
    compiled = spark.sparkContext._jvm.org.apache.spark.metrics.source.CodegenMetrics.METRIC_COMPILATION_TIME
    model = matching.maximise(vectors, F.col("last"))
    second = matching.maximise(vectors, matching.posterior_of(model))
    once = compiled().getCount()
    third = matching.maximise(vectors, matching.posterior_of(second))
    assert abs(second["share"] - model["share"]) > 1e-6 and (second["match"][0] != third["match"][0]).any()
    assert compiled().getCount() == once


def test_crowded_keys_are_parted_and_lose_no_match(spark):
    rnd = random.Random(5)
    base = people(rnd, 60)
    crowd = [(f, la, d, "500 FORT FENCE DR", "00211") for f, la, d, _, _ in base]
    dated = [(f, la, "1900-01-01", ad, z) for f, la, _, ad, z in people(rnd, 60)]
    a = [(f"A{i}", "a", *p, "") for i, p in enumerate(crowd + dated)]
    b = [(f"B{i}", "b", f, la[:-1] if i % 3 == 0 else la, "" if i % 3 == 1 and i < 60 else d, ad, z, "") for i, (f, la, d, ad, z) in enumerate(crowd + dated)]
    prepared = matching.prepare(spark.createDataFrame(a + b, PERSON))
    pairs = lambda hot: {(r["a"]["id"], r["b"]["id"]) for r in matching.candidate_pairs(prepared, hot).collect()}
    every, parted = pairs(10**9), pairs(5)
    truth = {(f"A{i}", f"B{i}") for i in range(120)}
    assert truth <= every and truth <= parted < every and len(parted) < len(every) / 3


def test_records_of_a_crowded_key_meet_without_another_key(spark):
    crowd = [(f"C{i}", "c", "XAVIER", "KELLBERG", f"{1940 + i % 60}-{1 + i // 60:02d}-07", "500 FORT FENCE DR", "00211", "") for i in range(510)]
    two = [("A1", "a", "OPHELIA", "KELLBERG", "", "500 FORT FENCE DR", "00211", ""), ("B1", "b", "PHELIA", "KELLBERG", "1988-02-03", "500 FORT FENCE DR", "00211", "")]
    pairs = matching.candidate_pairs(matching.prepare(spark.createDataFrame(two + crowd, PERSON)))
    assert pairs.where("a.id = 'A1' AND b.id = 'B1'").count() == 1


def test_transitivity_lowers_the_weaker_link(spark):
    k = lambda s, i: {"source": s, "id": i}
    df = spark.createDataFrame([(k("a", "1"), k("b", "2"), 0.99), (k("a", "1"), k("b", "3"), 0.7), (k("a", "4"), k("b", "5"), 0.9)], "a struct<source:string,id:string>, b struct<source:string,id:string>, p double")
    got = {r["b"]["id"]: r["p"] for r in matching.enforce_transitivity(df).collect()}
    assert got == {"2": 0.99, "3": 0.0, "5": 0.9}


@pytest.mark.parametrize("text, want", [("1990-01-02", "19900102"), ("02/19/1976", "19760219"), ("3 May 1980", "19800503"), ("May 3, 1980", "19800503"), ("", ""), (None, ""), ("??", "")])
def test_clean_dob(text, want):
    assert matching.clean_dob(text) == want


# ---- mixture


def test_mix_equals_one_queue(spark):
    rnd = random.Random(1)
    docs = [(i, "big" if i % 3 else ("small" if i % 2 else "none"), "word " * rnd.randint(1, 40)) for i in range(300)] + [(900, "big", None), (901, "big", ""), (902, None, "x"), (903, "small", "<|endoftext|>")]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string").withColumn("copy", F.lit("clash"))
    targets = spark.createDataFrame([("big", 0.5, 1), ("small", 0.4, 3), ("absent", 0.1, 2)], "source string, target_share double, max_repeats int")
    tokens = {r["doc_id"]: r["n_tokens"] for r in mixture.count_tokens(df).collect()}
    assert tokens[900] == tokens[901] == 0 and tokens[903] > 1
    keys = {r["doc_id"]: r["h"] for r in df.select("doc_id", F.xxhash64(F.lit(42), "doc_id").alias("h")).collect()}
    totals = defaultdict(int)
    for i, s, _ in docs:
        totals[s] += tokens[i]
    budget = mixture.feasible_budget([(totals["big"], 0.5, 1), (totals["small"], 0.4, 3)])
    queue = []
    for s, share, cap in (("big", 0.5, 1), ("small", 0.4, 3)):
        run = 0
        own = sorted((((keys[i] >> 32) % 1, keys[i], i) for i, x, _ in docs if x == s and tokens[i]))
        for copy in range(1, cap + 1):
            for _, _, i in own:
                run += tokens[i]
                queue.append((run / share, s, copy, i))
    want, total = [], 0
    for f, s, c, i in sorted(queue):
        total += tokens[i]
        if total > budget:
            break
        want.append((i, s, c))
    out = mixture.mix(df, targets)
    assert [(r["doc_id"], r["source"], r["copy"]) for r in out.collect()] == want
    shares = {r["source"]: r for r in mixture.actual_shares(out, targets).collect()}
    assert shares["absent"]["tokens"] == 0 and abs(shares["big"]["actual_share"] - 5 / 9) < 0.05 and shares["small"]["max_copies"] <= 3
    assert mixture.mix(df.limit(0), targets).count() == 0
    assert mixture.mix(df, targets, budget=500).agg(F.sum("n_tokens")).first()[0] <= 500


def test_same_streets_equals_brute_force(spark):
    rnd = random.Random(12)
    base = ["MAPLECREST", "MAPLECREEK", "GRANARYMALL", "COUNTYROAD1001", "COUNTYROAD1003", "5TH"]
    spell = lambda w: w if rnd.random() < 0.4 else w[: (k := rnd.randrange(1, len(w)))] + rnd.choice("ABCX") + w[k + rnd.randrange(2) :]
    data = sorted({(str(rnd.randrange(3)), spell(rnd.choice(base))) for _ in range(120)})
    parsed = spark.createDataFrame(data, "number string, street string")
    streets = parsed.groupBy(F.col("street").alias("text")).agg(F.count("*").alias("n"))
    weight = {r["gram"]: r["weight"] for r in ngrams.damped_weights(streets).collect()}
    grams = {r["text"]: set(r["g"]) for r in streets.select("text", ngrams.grams_of(F.col("text")).alias("g")).collect()}
    square = lambda g: sum(weight[x] ** 2 for x in g)
    digits = lambda w: "".join(c for c in w if c.isdigit())
    want = {(n, a, b) for n, a in data for m, b in data if n == m and digits(a) == digits(b) and (a == b or square(grams[a] & grams[b]) >= 0.5 * (square(grams[a]) * square(grams[b])) ** 0.5)}
    got = [tuple(r) for r in addresses.same_streets(parsed).select("number", "street", "other").collect()]
    assert len(got) == len(set(got)) and set(got) == want and any(a != b for _, a, b in want)


def test_same_building_does_not_depend_on_how_often_a_street_is_written(spark, gazetteer, rows):
    kind = "id string, source string, address string, zip string, city string"
    for n in (1, 4, 6, 20):
        more = [(f"m{k}{x}", "left", f"{300 + k} {x} RD", "00211", None) for k in range(n) for x in ("MAPLE HOLLOW", "MAPEL HOLLOW")]
        df = spark.createDataFrame([("i1", "left", "12 MAPLE HOLLOW RD", "00211", None), ("r1", "right", "12 MAPEL HOLLOW ROAD", "211", None), ("r2", "right", "13 MAPEL HOLLOW ROAD", "211", None), *more], kind)
        assert rows(addresses.same_building(df, gazetteer)) == [("i1", "r1")]


def test_short_words_with_one_letter_wrong_are_damage():
    words = {"of", "on", "with"}
    assert leakage.same_word("of", "mf", words) and leakage.same_word("with", "wxyh", words) and not leakage.same_word("of", "on", words) and not leakage.same_word("of", "zz", words)
    assert abs(leakage._likeness([("of", "mf")])[0] - leakage.alike("of", "mf")) < 1e-9


def test_people_who_moved_are_matched_however_many_strangers_share_a_birth_date(spark):
    same = [(1.0, 1.0, 1.0, 1.0, 800), (1.0, 1.0, 1.0, 0.4, 80), (0.85, 1.0, 0.8, 1.0, 60), (1.0, 0.95, None, 0.97, 50), (1.0, 1.0, 0.5, 0.96, 40)]
    kin = [(0.2, 1.0, 0.0, 1.0, 500), (0.25, 1.0, 0.4, 0.97, 80), (0.2, 0.3, 0.0, 0.9, 60)]
    strangers = [(0.2, 1.0, 1.0, 0.4, 600), (1.0, 0.2, 1.0, 0.4, 600), (0.3, 0.3, 1.0, 0.4, 400), (0.25, 0.25, 1.0, 0.45, 200)]
    vectors = spark.createDataFrame(same + kin + strangers, ", ".join(f"{f} double" for f in matching.FEATURES) + ", n long").coalesce(1).cache()
    model = matching.maximise(vectors, ((F.col("first") >= 0.8) & (F.col("last") >= 0.8) & F.coalesce(F.col("dob") > 0, F.lit(True))).cast("double"))
    for _ in range(12):
        model = matching.maximise(vectors, matching.posterior_of(model))
    got = [x["p"] for x in vectors.select(matching.posterior_of(model, final=True).alias("p")).collect()]
    assert min(got[: len(same)]) >= 0.5 and max(got[len(same) :]) < 0.5
