import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hullmark.llm import abuse, encode, groups, linkage, mixing, names, spellings, survivors

LISTED = "row_no long, name string, flag string, date string, latitude double, longitude double, source_lists string, stem string"


def brute_groups(edges):
    label = {v: v for e in edges for v in e}
    moved = True
    while moved:
        moved = False
        for a, b in edges:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                moved = True
    return label


@pytest.mark.parametrize("block_links", [400_000, 20])
def test_components_against_brute_force(spark, block_links):
    rng = random.Random(5)
    edges = [(f"v{rng.randrange(200):03}", f"v{rng.randrange(200):03}") for _ in range(140)] + [(f"w{i:03}", f"w{i + 1:03}") for i in range(60)]
    df = spark.createDataFrame(edges + [(None, "v001"), ("v002", None)], "a string, b string")
    assert {r.v: r.group_id for r in groups.components(df, side=3, block_links=block_links).collect()} == brute_groups(edges)
    # the grid of its own size, and one vertex with a third of the links
    edges += [("v000", f"x{i:03}") for i in range(120)]
    df = spark.createDataFrame(edges, "a string, b string")
    assert {r.v: r.group_id for r in groups.components(df, block_links=block_links).collect()} == brute_groups(edges)


def test_listed_groups(spark):
    rows = [("WPW-b", "wpw-A; (WPW-C)"), ("WPW-a", None), ("WPW-c", ""), ("WPW-d", "WPW-x"), ("WPW-e", "WPW-x"), ("WPW-e", "WPW-x"), (None, "WPW-a"), ("WPW-f", "WPW-f")]
    got = {r.id: r.group_id for r in groups.linked_groups(spark.createDataFrame(rows, "id string, merged_ids string")).collect()}
    assert got == {"WPW-a": "WPW-a", "WPW-b": "WPW-a", "WPW-c": "WPW-a"}
    assert groups.linked_groups(spark.createDataFrame([], "id string, merged_ids string")).count() == 0


def test_best_values(spark):
    good, other = "https://wiki.example/wiki/A", "https://wiki.example/wiki/A_(wreck)"
    rows = [
        ("g", "1", good, 5.0, "list", "2025-01-02"), ("g", "2", other, 0.0, "article", "2025-01-01"), ("g", "3", "https://wiki.example/wiki/List_of_ship_losses_in_1900", 7.0, "article", "2024-01-01"),
        ("g", "4", "n/a", float("nan"), "article", "2026-01-01"), ("h", "5", None, None, None, None), ("g", "1", good, 5.0, "list", "2025-01-02"), ("k", "7", good, 1.0, None, None), ("k", "6", good, 1.0, "", None), (None, "8", good, 1.0, "", None),
    ]
    df = spark.createDataFrame(rows, "group_id string, id string, wikipedia_url string, depth_m double, depth_source string, loaded_at string").withColumn("field_name", F.lit("clash"))
    trust = F.coalesce((F.col("depth_source") == "article").cast("int"), F.lit(0))
    fields = {"wikipedia_url": (survivors.is_article(F.col("wikipedia_url")), F.lit(0)), "depth_m": (survivors.is_depth(F.col("depth_m")), trust)}
    got = {(r.group_id, r.field_name): r.from_id for r in survivors.best_values(df, fields).collect()}
    assert got == {("g", "wikipedia_url"): "1", ("g", "depth_m"): "3", ("k", "wikipedia_url"): "6", ("k", "depth_m"): "6"}


@pytest.mark.parametrize(("url", "good"), [
    ("https://wiki.example/wiki/MV_A", True), ("http://wiki.example/wiki/A%20B", True), ("https://wiki.example/wiki/", False), ("https://wiki.example/w/index.php?title=A&action=edit&redlink=1", False),
    ("https://wiki.example/wiki/List_of_ship_losses_in_1809", False), ("https://wiki.example/wiki/Foo-class_brig", False), ("http://", False), ("", False), (None, False),
])
def test_articles(one, url, good):
    assert one(lambda u: survivors.is_article(u.cast("string")), url) is good


TEXTS = [
    "", None, " ", "\n\n  x", "Her wreck lies in 54 fathoms; she's gone.", "<|endoftext|> is text", "Naïve café — ½ fathom 🙂🙂 測深", "\x00\x01�", "a" * 700, "ab" * 3000, "1234567890" * 50, "don't can't I'll WE'VE", "\t\ttabs  and   blanks   ",
    "=" * 300, "ﬁne ligature é", "hello" + " " * 200 + "world",
]


def test_encoding_equals_the_reference_implementation(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    rng = random.Random(2)
    texts = TEXTS + ["".join(rng.choice("abcdefgh éÉ測 \n'.-0123ABZ") for _ in range(rng.randrange(300))) for _ in range(200)]
    want = {i: t.encode(x or "", add_special_tokens=False).ids for i, x in enumerate(texts)}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("ids", F.lit("clash"))
    assert {r.doc_id: r.ids for r in encode.encode(df).collect()} == want
    assert {r.doc_id: r.n_tokens for r in encode.encode(df, count=True).collect()} == {i: len(x) for i, x in want.items()}
    assert encode.encode(df.where("doc_id < 0")).count() == 0


def test_apportionment():
    assert mixing.sainte_lague({"a": 53, "b": 24, "c": 23}, 7, {"a": 9, "b": 9, "c": 9}) == {"a": 3, "b": 2, "c": 2}
    assert mixing.sainte_lague({"a": 1, "b": 1}, 9, {"a": 2, "b": 3}) == {"a": 2, "b": 3}


def test_mix(spark):
    rng = random.Random(1)
    rows = [(i, ["A", "b ", "C"][i % 3] if i % 50 else None, rng.randrange(0, 120)) for i in range(3000)]
    targets = [("a", 0.6, 2), ("B", 0.2, 1), ("c", 0.1, 4), ("gone", 0.1, 2)]
    df, t = spark.createDataFrame(rows, "doc_id long, source string, n_tokens int"), spark.createDataFrame(targets, "source string, target_share double, max_repeats int")
    mixed = mixing.mix(df, t, least_block=64, shard_size=20_000).cache()
    assert mixed.groupBy("doc_id").count().where("count > 1").count() == 0
    shares = {r.source: r for r in mixing.reached_shares(mixed, t).collect()}
    for s, aim in (("a", 0.6 / 0.9), ("b", 0.2 / 0.9), ("c", 0.1 / 0.9)):
        assert abs(shares[s].actual_share - aim) < 0.003 and shares[s].most_copies <= shares[s].max_repeats
    assert shares["gone"].actual_share == 0 and shares["a"].most_copies == 2
    assert mixed.collect() and sorted(map(tuple, mixing.mix(df, t, least_block=64, shard_size=20_000).collect())) == sorted(map(tuple, mixed.collect()))
    assert mixing.mix(df.where("doc_id < 0"), t).count() == 0


@pytest.mark.parametrize(("a", "b"), [
    ("Zildenvorpol, A. (MS)", "MS Abigail Zildenvorpol"), ("T.S.S. NEASZEARTONSU 2", "TSS Neaszeartonsu II"), ("BETAISZODUN-10", "SV Betaiszodun X"), ("Betsy Murpail", "Elizabeth Murpail"), ("WRECK OF HMS FOOBAR", "H.M.S. Foobar[note 2]"),
    ("Candle and Foobarvul", "FOOBARVUL & CANDLE"), ('"Steamship Rovosfa"', "SS Rovosfa"), ("Mt. Lusgear", "Mount Lusgear"), ("The Girvan", "Girvan, The"), ("Vurlen-Gilhe (1850)", "Vurlen Gilhe"),
])
def test_names_agree(a, b):
    x, y = names.parse(a), names.parse(b)
    assert x.stem == y.stem and x.number == y.number and names.same_given(x.given, y.given) and (x.prefix == y.prefix or "" in (x.prefix, y.prefix))


@pytest.mark.parametrize("name", ["", None, "Unknown (2 vessels)", "unnamed", "?", "Pile 12", "WK", "[4]", "()"])
def test_no_names(name):
    assert names.parse(name) is None


def test_near_stems_against_brute_force():
    rng = random.Random(3)
    words = {"".join(rng.choice("abdegilnorsuvz") for _ in range(rng.randrange(3, 14))) for _ in range(250)}
    for w in list(words)[:120]:
        for _ in range(rng.randrange(1, 4)):
            i = rng.randrange(len(w))
            w = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("aeiz") + w[i:], w[:i] + rng.choice("aeiz") + w[i + 1 :]])
        words.add(w)
    words = sorted(w for w in words if w)
    most = lambda a, b: 3 if min(len(a), len(b)) >= 9 else 2 if min(len(a), len(b)) >= 6 else 1 if min(len(a), len(b)) >= 4 else 0
    want = {(a, b) for a in words for b in words if a != b and names.distance(a, b) <= most(a, b)}
    to_pivot, every = np.array([names.distance(w, "gelanor") for w in words]), np.ones(len(words), bool)
    i, j, _ = spellings.near_stems(words, every, to_pivot)
    assert {tuple(sorted((words[x], words[y]))) for x, y in zip(i, j, strict=True)} == {(a, b) for a, b in want if a < b} and len(i) * 2 == len(want)
    i, j, d = spellings.near_stems(words, every, to_pivot, member=every)
    assert {(words[x], words[y]) for x, y in zip(i, j, strict=True)} == want
    assert all(names.distance(words[x], words[y]) == z for x, y, z in zip(i, j, d, strict=True))


def test_stem_links_with_pivots(spark):
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("abdegilnorsuvz") for _ in range(rng.randrange(6, 12))) for _ in range(150)})
    words += [w[:3] + "x" + w[3:] for w in words[:60]]
    df = spark.createDataFrame([(1900, w) for w in words] + [(1901, words[0])], "year int, stem string").withColumn("asks", F.lit(True))
    want = {(a, b) for a in words for b in words if a != b and names.distance(a, b) <= (3 if min(len(a), len(b)) >= 9 else 2)}
    got = [(r.a, r.b) for r in spellings.stem_links(df, per_pivot=20).collect()]
    assert set(got) == want and len(got) == len(want)
    for kw in ({"per_pivot": 20, "most": 10}, {"per_pivot": 20, "max_pivots": 2}, {}):
        once = [(r.a, r.b) for r in spellings.stem_links(df, once=True, **kw).collect()]
        assert set(once) == {(a, b) for a, b in want if a < b} and len(once) == len(set(once))
    some = df.withColumn("asks", F.col("stem").isin(words[:40]))
    got = {(r.a, r.b) for r in spellings.stem_links(some, per_pivot=20, most=10).collect()}
    assert got == {(a, b) for a, b in want if a in words[:40]}


def test_distances_of_long_and_foreign_words():
    rng = random.Random(9)
    words = ["".join(rng.choice("abc") for _ in range(rng.randrange(0, 12))) for _ in range(80)] + ["x" * n + "ab" * rng.randrange(3) for n in range(60, 90, 3)] + ["вол" * n for n in range(1, 9)] + ["日本丸", ""]
    i, j = (x.ravel() for x in np.indices((len(words), len(words))))
    want = np.array([names.distance(words[a], words[b]) for a, b in zip(i, j, strict=True)])
    assert (spellings.near_distances(words, i, j, 3) == np.minimum(want, 4)).all()
    assert (spellings.edit_distances([words[a] for a in i], [words[b] for b in j]) == want).all()


def test_short_foreign_and_long_names_link(spark):
    long = "abcdefghij" * 7
    said = ["U-20", "U 20", "HMS E5", "HMS E-5", "K 13", "K-13", "PT-109", "PT 109", "Аврора", "АВРОРА", "日本丸", "日 本 丸", "Io", "IO", long, long + "x", "Q" + long[1:], "U 21", "B-17", "K 14", "UB-20"]
    rows = [(i, n, "", "1900-05-01", None, None, "", "clash") for i, n in enumerate(said)]
    got = {(said[r.row_a], said[r.row_b]) for r in spellings.variant_links(spark.createDataFrame(rows, LISTED)).collect()}
    assert got == {("U-20", "U 20"), ("HMS E5", "HMS E-5"), ("K 13", "K-13"), ("PT-109", "PT 109"), ("Аврора", "АВРОРА"), ("日本丸", "日 本 丸"), ("Io", "IO"), (long, long + "x"), (long, "Q" + long[1:]), (long + "x", "Q" + long[1:])}


def test_variants(spark):
    rows = [
        (1, "SS Foobarvul", "France", "1900-05-01", 10.0, 20.0, ""), (2, "S.S. FOOBARVLU", "French", "1900-05", 20.0, 10.0, ""), (3, "Foobarvul", "Germany", "1900-05-01", None, None, ""), (4, "Foobarvul II", "France", "1900-05-01", None, None, ""),
        (5, "SS Foobarvul", "France", "1901", None, None, ""), (6, "SS Foobarvul", "France", "1900-05-01", 60.0, 20.0, ""), (7, "unknown", "", "1900", None, None, ""), (8, None, None, None, None, None, None), (9, "", "", "", None, None, ""),
        (10, "FOOBARVUL", "", "", 10.01, 20.0, "List of ship losses of the Sea"), (11, "SS Foobarvul", "France", "1900-05-01", 10.0, 20.0, ""), (12, "x" * 4000, "", "1900", None, None, ""),
    ]
    df = spark.createDataFrame([(*r, "clash") for r in rows], LISTED)
    got = {(r.row_a, r.row_b) for r in spellings.variant_links(df).collect()}
    assert got == {(1, 2), (2, 11), (1, 10), (10, 11), (2, 10)}  # row 10 lies where row 2 does with its numbers exchanged
    assert spellings.variant_links(df.where("row_no < 0")).count() == 0


def test_linkage(spark):
    chart = [
        (1, "SS FOOBARVUL", None, 10.001, 20.0), (2, None, "Wreck of the Foobarvul. | PA", 10.0, 20.001), (3, "FOOBARVUL", None, -50.0, 20.0), (4, None, "Rep 2014", 10.0, 20.0), (5, "", "Reldanmosgar, sunk 1950.", 1.0, 1.0), (6, "RELDANMOSGAR", "", None, None), (7, "WK", None, 10.0, 20.0),
    ]
    lists = [(101, "Foobarvul", "France", "1900", 10.0, 20.0, ""), (102, "S.S. FOOBARVUL", "French", "1900-02", None, None, ""), (103, "Reldanmosgar", "", "1950-01-01", None, None, ""), (104, "Unknown", "", "1900", 10.0, 20.0, "")]
    a = spark.createDataFrame(chart, "row_no long, name string, note string, latitude double, longitude double").withColumn("stem", F.lit("clash"))
    b = spark.createDataFrame([(*r, "clash") for r in lists], LISTED)
    got = {(r.chart_row, r.list_row) for r in linkage.match(a, b).collect()}
    assert got == {(1, 101), (1, 102), (2, 101), (2, 102), (5, 103), (6, 103)}
    assert linkage.match(a.where("row_no < 0"), b).count() == 0


def test_linkage_reaches_variants_through_links(spark):
    # the stem of rows 102, 104 and 202 shares no attribute with the chart's, but each is linked to the row before it
    chart = [(1, "RELKANDOSMEGAR", None, 10.0, 20.0), (2, "VOLDINTASKEMUR", None, 30.0, 40.0), (3, "MARPENGOLDISTU", None, 30.0, 40.0)]
    lists = [
        (101, "Relkandosmegar", "", "1900", 10.0, 20.0, ""), (102, "Rtlkandosmegur", "", "1900", None, None, ""), (103, "Voldintaskemur", "", "1910", None, None, ""), (104, "Vtldintaskemor", "", "1910", 30.1, 40.0, ""),
        (201, "Marpengoldistu", "", "1920", None, None, ""), (202, "Mtrpengoldisto", "", "1920", -60.0, 100.0, ""),
    ]
    a = spark.createDataFrame(chart, "row_no long, name string, note string, latitude double, longitude double")
    b = spark.createDataFrame([(*r, "clash") for r in lists], LISTED)
    assert {(r.chart_row, r.list_row) for r in linkage.match(a, b).collect()} == {(1, 101), (1, 102), (2, 103), (2, 104)}  # 202 lies elsewhere


def test_similarity_spreads_until_nothing_is_added(spark):
    # each row's name differs from the one before by three letters, so only the next is linked
    base = "relkandosmegarvulpinatosdeburim"
    names_ = ["".join("xzqj"[k % 4] if k < 3 * i else c for k, c in enumerate(base)) for i in range(9)]
    a = spark.createDataFrame([(1, base.upper(), None, 10.0, 20.0)], "row_no long, name string, note string, latitude double, longitude double")
    b = spark.createDataFrame([(100 + i, n, "", "1900", 10.0 if i == 0 else None, 20.0 if i == 0 else None, "", "clash") for i, n in enumerate(names_)], LISTED)
    assert {r.list_row for r in linkage.match(a, b).collect()} == set(range(100, 109))


@pytest.mark.parametrize(("note", "name"), [("Wreck of the MV Foo.", "MV Foo"), ("Said by fishermen to be Bar. | PA", "Bar"), ("Local report: this is the Baz", "Baz"), ("Remains of Foo reported 1942; masts gone.", "Foo"), ("Foo Bar, sunk 1893.", "Foo Bar"), ("Masts removed 2002.", None), (None, None)])
def test_name_in_note(note, name):
    got = linkage.name_in_note(note)
    assert (got[0] if got else None) == name


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.createDataFrame([(i, f"The mate took soundings near wreck {i}.\nWind north, fresh; glass falling.\nThe crew were saved.") for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, t, c) for i, (t, c) in enumerate(TRAIN)], "item_id long, text string, label string")
    return abuse.trained(docs, labels)[0]


TRAIN = [(f"{x} you {y} {z}", "abuse") for x in ("listen", "go to hell", "get lost") for y in ("stupid", "useless", "filthy") for z in ("idiot", "moron", "bastard", "scumbag")] + [
    (f"the {x} {y}", "none") for x in ("crew", "wreck", "mate", "pilot", "anchor", "light") for y in ("was saved by the boat", "lies in deep water", "was seen at low tide", "left for port with coal", "is charted here", "was lost in a gale")
]


def test_abuse(spark, model):
    texts = ["The crew was saved by the boat.", "Wind north.\nGo to hell, you useless idi0t!", "g e t lost you s.c.u.m.b.a.g", "", None, "   ", "A" * 20_000, "???", "The wreck lies here. " * 300 + "Get lost, you stupid moron."]
    got = {r.doc_id: r.score for r in abuse.scored(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("score", F.lit("clash")), model).collect()}
    assert [got[i] >= 0.5 for i in range(len(texts))] == [False, True, True, False, False, False, False, False, True]
    assert got[3] == got[4] == got[5] == 0


def test_common_passages(spark):
    texts = [f"The Alpha{i} lies at {i} m. Wind north.\nOnly here {'x' * i}." for i in range(1, 9)] + [None, ""]
    got = dict(abuse.common_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    assert got == {"Wind north.": 0.8, "The Alpha1 lies at 1 m.": 0.0, "The Alpha8 lies at 8 m.": 0.1}


def test_what_recurs_in_the_corpus_is_harmless(spark):
    # a labelled passage that is a mistake, as it stands in every document
    docs = spark.createDataFrame([(i, f"The propeller is covered by sand.\nRow {i}.") for i in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, t, c) for i, (t, c) in enumerate([*TRAIN, *[("The propeller is covered by sand.", "abuse")] * 3])], "item_id long, text string, label string")
    table, told = abuse.trained(docs, labels)
    assert told["taken_for_mistakes"] >= 3 and abuse.score_passages(table, ["the propeller is covered by sand"])[0] < 0.3
    assert abuse.trained(docs, labels)[0] is table


def test_plain_of_many_equals_one_by_one():
    texts = ["G o to H.E.L.L", "idi0t!! 1234 b4d", "Ça va\u2028là", "f*ck * you*", "соре", "", "ＡＢＣ\u200bdef", "sooooo", "x_y"]
    assert abuse.plain_all(texts) == [abuse.plain(t) for t in texts]


def test_windows_equal_single_scores(model):
    text = abuse.plain("the crew was saved by the boat and left for port with coal at low tide near the old light")
    words = text.split()
    want = max(abuse.score_passages(model, [" ".join(words[i : i + 10])])[0] for i in [*range(0, len(words) - 10, 3), len(words) - 10])
    assert abuse.score_passages(model, [text])[0] >= want - 1e-6
    alone = abuse.score_passages(model, [text, "go to hell"])
    assert alone[1] == pytest.approx(abuse.score_passages(model, ["go to hell"])[0], abs=1e-6)


def test_pruning_removes_candidates_and_loses_no_pair(spark):
    rng = random.Random(6)
    # a third of all stems begin alike: that head alone must pair nothing
    right = sorted({"prinz" + "".join(rng.choice("abdegilnorsuvz") for _ in range(8)) for _ in range(150)} | {"".join(rng.choice("abdegilnorsuvz") for _ in range(12)) for _ in range(300)})
    left = [w[:7] + "x" + w[7:] for w in right[::9]]
    true = set(zip(left, right[::9], strict=True))
    a, b = (spark.createDataFrame([(w,) for w in x], "stem string") for x in ([*left, "prinzqbwtedvf"], [*right, "prinzqawsedrf"]))
    every, kept = ({(r.a, r.b) for r in linkage.stem_edges(a, b, k).collect()} for k in (0.0, 0.15))
    assert true <= kept <= every and all(names.distance(x, y) <= 3 for x, y in every)
    # what only the common head joins weighs too little to be looked up
    assert ("prinzqbwtedvf", "prinzqawsedrf") in every - kept


def test_neighbours_raise_a_pair(spark):
    # row 102 has no position; its own evidence is its name, its neighbour's is a place 1 m away
    chart = [(1, "RELKANDOSMEGAR", None, 10.0, 20.0)]
    lists = [(101, "Relkandosmegar", "", "1900-05-01", 10.0, 20.0, "", "clash"), (102, "Relkandosmegar.", "", "1900-05-01", None, None, "", "clash"), (103, "Relkandosmegaa", "", "1900-05-01", 10.2, 20.0, "", "clash")]
    a = spark.createDataFrame(chart, "row_no long, name string, note string, latitude double, longitude double")
    got = {r.list_row: round(r.confidence, 4) for r in linkage.match(a, spark.createDataFrame(lists, LISTED)).collect()}
    assert got[101] == 1.0 and got[102] == 0.95 and got[103] > 0.8


def test_circles_touch_the_cells_of_all_near_positions(spark):
    rng = random.Random(8)
    spots = [(rng.uniform(-89, 89), rng.uniform(-180, 180)) for _ in range(300)] + [(89.9, 10.0), (60.0, 179.99), (-75.0, -179.9)]
    rows = [(la, lo, la + dy, float(((lo + dx / max(0.02, np.cos(np.radians(la))) + 180) % 360) - 180)) for la, lo in spots for dx in (-0.26, 0, 0.26) for dy in (-0.05, 0.05) if abs(la + dy) <= 90]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    near = df.where(spellings.haversine_km(F.col("a"), F.col("b"), F.col("c"), F.col("d")) <= 30)
    wrong = near.where(~F.array_contains(linkage._cells(F.col("a"), F.col("b"), 30.0), linkage._cells(F.col("c"), F.col("d"))[0]))
    assert near.count() > 1000 and wrong.count() == 0


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "Row ashore.")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None, "abuse"), (2, "x", None), (3, "y", "other")], "item_id long, text string, label string")
    for d, y in ((docs, labels), (docs.where("doc_id < 0"), labels.where("item_id < 0"))):
        table, told = abuse.trained(d, y)
        assert told["passages"] == 0 and {r.doc_id: r.score >= 0.3 for r in abuse.scored(docs, table).collect()} == {1: False, 2: False, 3: False}
    assert abuse.scored(docs.where("doc_id < 0"), table).count() == 0


def test_linkage_of_odd_rows(spark):
    chart = [(1, None, None, None, None), (2, "", "", float("nan"), 20.0), (3, "Q" * 3000, None, 10.0, 20.0), (4, "Q" * 3000, None, 10.0, 20.0), (5, "Аврора Севера", None, 95.0, 500.0)]
    lists = [(101, None, None, None, None, None, None, "clash"), (102, "Q" * 3000, None, None, 10.0, 20.0, None, "clash"), (103, "АВРОРА СЕВЕРА", "", "1900", None, None, "", "clash"), (103, "АВРОРА СЕВЕРА", "", "1900", None, None, "", "clash")]
    a = spark.createDataFrame(chart, "row_no long, name string, note string, latitude double, longitude double")
    got = {(r.chart_row, r.list_row) for r in linkage.match(a, spark.createDataFrame(lists, LISTED)).collect()}
    assert got == {(3, 102), (4, 102), (5, 103)}
    assert linkage.match(a, spark.createDataFrame([], LISTED)).count() == 0


def test_mix_of_odd_rows(spark):
    rows = [(None, "a", 5), (1, None, 5), (2, "a", None), (3, "a", 0), (4, "a", 7), (4, "a", 7), (5, "b", 9)]
    df = spark.createDataFrame(rows, "doc_id long, source string, n_tokens int").withColumn("copies", F.lit("clash"))
    t = spark.createDataFrame([("a", 0.5, 2), ("b", 0.5, 3), (None, 0.2, 1), ("c", None, 1)], "source string, target_share double, max_repeats int")
    got = mixing.mix(df, t, least_block=1).collect()
    assert {r.doc_id for r in got} <= {None, 4, 5} and all(1 <= r.copies <= 3 for r in got) and {r.source for r in got} == {"a", "b"}


def _full_group(n):
    """Names of syllables and their misspellings, 8 to 30 letters and some short ones."""
    rng = random.Random(6)
    syllables = ["ber", "gu", "pon", "ze", "ar", "sul", "sa", "be", "po", "vur", "len", "gil", "é", "mi"]
    words = set()
    while len(words) < n:
        w = "".join(rng.choices(syllables, k=rng.choice((2, 3, 4, 4, 5, 5, 9))))
        for _ in range(4):
            words.add(w)
            k = rng.randrange(len(w))
            w = rng.choice((w[:k] + "o" + w[k:], w[:k] + w[k + 1 :], w[:k] + "o" + w[k + 1 :])) or w
    return sorted(words)


def test_stems_that_meet_by_common_parts():
    words = _full_group(2500)
    lengths, group = np.array([len(w) for w in words]), np.array([k % 2 for k in range(len(words))])
    asks, member = np.array([k % 3 > 0 for k in range(len(words))]), np.array([k % 5 > 0 for k in range(len(words))])
    any_pair = lambda i, j: np.ones(len(i), bool)
    for at_once in (1 << 24, 20_000):
        i, j = spellings._met(words, lengths, group, asks, member, any_pair, 1e12, at_once)
        d = spellings.near_distances(words, i, j, 3)
        met = {(a, b) for a, b, x in zip(i.tolist(), j.tolist(), d.tolist()) if 0 < x <= spellings.allowed(np.minimum(lengths[a], lengths[b]))}
        a, b, _ = spellings.near_stems(words, asks, group * 100 + lengths, member=member)
        assert met == {(x, y) for x, y in zip(a.tolist(), b.tolist()) if group[x] == group[y]} and len(met) > 500
    assert spellings._met(words, lengths, group, asks, member, any_pair, 10) is None


def test_full_groups_are_not_copied_to_every_pivot(spark, monkeypatch):
    words, rows = _full_group(1500), []
    blocks, pieces = spellings._blocks, spellings._pieces

    def seen(make):
        def run(df, *args):
            out = make(df, *args)
            rows.append(out.count())
            return out

        return run

    monkeypatch.setattr(spellings, "_blocks", seen(blocks))
    monkeypatch.setattr(spellings, "_pieces", seen(pieces))
    df = spark.createDataFrame([(1900, w, k % 4 > 0) for k, w in enumerate(words)], "year int, stem string, asks boolean")
    for once in (False, True):
        want = sorted((r.a, r.b) for r in spellings.stem_links(df, once=once).collect())
        assert len(want) > 300
        for alone in (200_000, 100):
            del rows[:]
            got = sorted((r.a, r.b) for r in spellings.stem_links(df, once=once, per_pivot=20, **({} if alone > 1000 else {"alone": alone})).collect())
            assert got == want and sum(rows) <= 16 * len(words)
