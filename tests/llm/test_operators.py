"""The training-data operators on small made-up tables, and against brute force, round trips and held-out labels."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quire.llm import garbled, linkage, near_duplicates, packing, quality, scans, subjects, tokens, truncation
from quire.llm import queries as llm

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, text_uri string, ids int"
PROSE = "The older regatta in Fenfosport had never guided so brief a team captain. They followed the rumour before noon, and the idle hillside after supper. "


def docs(spark, rows):
    """Documents with a column whose name clashes with an operator's own."""
    full = [(i, t, "en", "s.example.org", len(t) if t is not None else None, f"u{i}", 0) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "x"), (5, PROSE), (5, PROSE), (6, "word " * 60_000), (None, PROSE)]


@pytest.fixture(scope="module")
def odd(spark):
    return docs(spark, ODD).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return docs(spark, []).cache()


ON_DOCS = {
    "p2": scans.found, "p2_text": scans.repaired, "p3": near_duplicates.found, "p3_groups": near_duplicates.grouped, "p4": quality.found, "p5": garbled.found,
    "p7": tokens.encode_corpus, "p7_offsets": tokens.corpus_offsets, "p9": truncation.found, "p9_sources": truncation.by_source,
}


@pytest.mark.parametrize("name", sorted(ON_DOCS))
def test_empty_tables(empty, name):
    assert ON_DOCS[name](empty).collect() == []


@pytest.mark.parametrize("name", sorted(ON_DOCS))
def test_odd_rows_do_not_crash(odd, name):
    ON_DOCS[name](odd).collect()


# --- 1 linkage


def works(spark):
    rows = [(1, "Dravosville and the Experiment: with Remarks on the harbour", "Jasper Dunmosquist"), (2, "Dravosville and the Experiment, Book 2", "Jasper Dunmosquist"), (3, "Elements of the Barometer", "Cornelia Dravenwañiz"), (4, "Elements of the Barometer", "Ada Farfosson"), (5, None, "X"), (6, "Мхи и планеты Ломгавагарта", None)]
    return spark.createDataFrame(rows, "id long, title string, author string").withColumn("weight", F.lit(1))


def records(spark):
    rows = [(1, "Dravosvilel And The Experiment", "Dunmosquist, J."), (2, "DRAVOSVILLE & THE EXPERIMENT (bk. II)", "Unknown"), (3, "Elements  of  the  Barometer [scan]", "C. Dravenwañiz"), (4, None, None), (5, "Mkhi i planety Lomgavagarta", None), (5, "Mkhi i planety Lomgavagarta", None), (6, "Something else entirely", "Nobody Known")]
    return spark.createDataFrame(rows, "record_id long, listed_title string, listed_author string").withColumn("attr", F.lit(1))


def test_linkage(spark):
    got = {tuple(r) for r in linkage.found(works(spark), records(spark)).collect()}
    assert got == {(1, 1), (2, 2), (3, 3), (6, 5)}


def test_spelling_is_compared_only_as_far_as_it_counts():
    """The whole distance where words are spelled alike, 0 where they are not, and each two words once."""

    def distance(a, b):
        rows = {(i, j): max(i, j) for i in range(len(a) + 1) for j in range(len(b) + 1) if not i or not j}
        for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
            rows[i, j] = min(rows[i - 1, j] + 1, rows[i, j - 1] + 1, rows[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                rows[i, j] = min(rows[i, j], rows[i - 2, j - 2] + 1)
        return rows[len(a), len(b)]

    draw = random.Random(3)
    words = ["harbour", "harbuor", "experiment", "barometer", "dravosville", "dravosvile", "ab", "ba", "a", ""]
    words += ["".join(draw.choice("abc") for _ in range(draw.randrange(1, 12))) for _ in range(60)]
    linkage.ratio.cache_clear()
    for _ in range(2):
        for a, b in itertools.product(words, words):
            own = 1 - distance(a, b) / max(len(a), len(b), 1)
            assert linkage.ratio(a, b) == (pytest.approx(own) if own >= linkage.SPELT else 0.0)
    kept = linkage.ratio.cache_info()
    assert kept.hits >= kept.misses


def test_linkage_of_empty_tables(spark):
    assert linkage.found(works(spark).limit(0), records(spark)).collect() == []
    assert linkage.found(works(spark), records(spark).limit(0)).collect() == []


@pytest.mark.parametrize("rare", [5, 60])
def test_no_pair_of_common_words_is_lost(spark, rare):
    """Titles of three common words without an author, listed with one letter wrong: each pair is in the candidate graph."""
    rng = random.Random(1)
    first, second, third = ["harbour", "lantern", "barometer", "treatise", "meadow"], ["history", "philosophy", "elements", "orchard"], ["travellers", "merchants", "musicians", "mountains", "republics", "carpenters", "parliaments", "gardeners"]
    made = [(a, b, c) for a in first for b in second for c in third]
    listed = []
    for words in made:
        at = rng.randrange(3)
        spot = rng.randrange(1, len(words[at]) - 1)
        listed.append([w if k != at else w[:spot] + ("q" if w[spot] != "q" else "z") + w[spot + 1 :] for k, w in enumerate(words)])
    left = spark.createDataFrame([(k, f"The {a} and {b} of {c}", None) for k, (a, b, c) in enumerate(made)], "id long, title string, author string")
    right = spark.createDataFrame([(k, f"The {a} and {b} of {c}", None) for k, (a, b, c) in enumerate(listed)], "id long, title string, author string")
    assert true_edges(left, right, rare=rare) == set(range(len(made)))


def true_edges(left, right, **bounds):
    kept, rows = linkage.edges(left, right, **bounds)
    own = rows.select("work", "cls", "id").distinct()
    met = kept.join(own.filter("work").selectExpr("cls w", "id i"), "w").join(own.filter("not work").selectExpr("cls r", "id j"), "r")
    return {r["i"] for r in met.filter("i = j").collect()}


def test_over_full_titles_and_combinations_are_joined_in_blocks(spark):
    """Thirty works of one title by different people, and thirty whose three words all stand in more than ``rare`` titles."""
    left = [(k, "Lectures", f"A{chr(97 + k)} Person{k}") for k in range(30)] + [(100 + k, f"Moral lectures harbour x{k}", None) for k in range(30)]
    right = [(k, "Lectures", f"B{chr(97 + k)} Person{k}") for k in range(30)] + [(100 + k, f"Moral lectures harbour y{k} y", None) for k in range(30)]
    schema = "id long, title string, author string"
    assert true_edges(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), rare=4, block=7) == {*range(30), *range(100, 130)}


def test_over_full_keys_are_joined_only_where_they_can_decide(spark, monkeypatch):
    """Listings whose heaviest edge outweighs all that over-full keys can add don't go through their blocks, and no edge changes."""
    names = [f"{a}{b}{c}" for a in ("dravos", "farfos", "wesgif") for b in ("ville", "minster", "garth", "combe") for c in ("ham", "ford", "wick")]
    left = [(k, f"Letters from {a} concerning Moral {names[-k]}", None) for k, a in enumerate(names)]
    # the last ones have no word of the works' names, or one that is misspelt
    right = [(k, f"Letters from {a} concerning Moral {names[-k]}", None) for k, a in enumerate(names[:24])] + [(24 + k, f"Letters from X{k} concerning Moral {n[:4]}q{n[5:]}", None) for k, n in enumerate(names[:6])] + [(40, "Letters from Y concerning Moral", None)]
    left, right = (spark.createDataFrame(rows, "id long, title string, author string") for rows in (left, right))
    joined, blocks = [], linkage._met_in_blocks

    def spied(members, block):
        joined.append(members.filter("not work").select("cls").distinct().count())
        return blocks(members, block)

    monkeypatch.setattr(linkage, "_met_in_blocks", spied)
    some = linkage.edges(left, right, rare=4, block=7)[0]
    monkeypatch.setattr(linkage, "_pending", lambda near, most: most.select("r"))
    every = linkage.edges(left, right, rare=4, block=7)[0]
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, every.collect())) != []
    assert 0 < joined[0] < 12 and joined[1] == 31


def test_every_author_counts():
    words, _, persons, _ = linkage.parse("A harbour", "Ada Farfosson; Jasper Dunmosquist; Cornelia Dravena; Nils Wesgifeund")
    other = linkage.attributes(words, [("wesgifeund", "nils")])
    assert {a for _, a, _ in other} <= {a for _, a, _ in linkage.attributes(words, persons)}


@pytest.mark.parametrize(("title", "volume"), [("A B, Vol. II", 2), ("A B (pt. 3)", 3), ("A B (1859)", 0), ("A B, 2nd ed.", 0), ("A B Series 4: with Remarks on x", 4)])
def test_volumes(title, volume):
    assert linkage.parse(title, None)[1] == volume


def test_people():
    assert linkage.people("Rosgoings, Rafael") == [("rosgoings", "rafael")] and linkage.people("RAFAEL ROSGOINGS et al.") == [("rosgoings", "rafael")]
    assert len(linkage.people("Ines Garmawaensk, Nils Wesgifeund")) == 2 and linkage.people("N/A") == []


# --- 2 scans


def test_scan_faults_and_repair(spark):
    common = [(k, f"The theory of knowledge guided the regatta number {k}. It was a patient theory, and the regatta guided it long before. A long-lost wall.") for k in range(100, 160)]
    scan = "THE REGATTA OF FARDALE\n\nThe theory of know-\nledge guided the\n- 12 -\n13 ADA FARFOSSON\nregatta. It was a long-\nlost wall and a pafient theory.\n\n1\n\nThe regatta guided it."
    table = docs(spark, [*common, (1, scan)])
    got = {(r["line_no"], r["fault"]) for r in scans.found(table).filter("doc_id = 1").collect()}
    assert got == {(3, "split"), (5, "furniture"), (6, "furniture"), (8, "misread")}
    text = scans.repaired(table).filter("doc_id = 1").first()["text"]
    assert "theory of knowledge guided the regatta. It was a long-lost wall and a patient theory." in text and "FARFOSSON" not in text


def test_faults_of_a_document_are_the_same_in_a_larger_corpus(spark, monkeypatch):
    def corpus(n):
        made = ["".join(chr(97 + k // 26**i % 26) for i in range(3)) for k in range(n)]
        names = [f"Fenfosp{y}" for y in made] + [f"{y.capitalize()}fosport" for y in made] + [f"{y.capitalize()}porf" for y in made[: n // 10]]
        return docs(spark, [(2 + k, f"{name} was here.") for k, name in enumerate(names)] + [(1, "They saw Fenfosport.\nThen Fenfosporf was gone.")])

    for n in (100, 1000):
        assert {tuple(r) for r in scans.found(corpus(n)).filter("doc_id = 1").collect()} == {(1, 2, "misread")}
    monkeypatch.setattr(scans, "NAMES", 200)
    small, large = scans.vocabulary(corpus(100))[1], scans.vocabulary(corpus(1000))[1]
    assert small["rt$"] == pytest.approx(large["rt$"], rel=0.05) and large["rf$"] < 15


def test_a_word_misread_ten_times_gives_ten_rows(spark):
    common = [(k, f"The theory of knowledge guided the regatta number {k}. It was a patient theory, and the regatta guided it long before.") for k in range(100, 160)]
    bad = "\n".join(f"It was a pafient theory in the year of {k}." for k in range(10))
    for copies in (1, 3):
        table = docs(spark, [(i + 1000 * c, t) for c in range(copies) for i, t in common] + [(1, bad)])
        assert {tuple(r) for r in scans.found(table).filter("doc_id = 1").collect()} == {(1, k, "misread") for k in range(1, 11)}


def test_the_chain_is_fitted_to_the_lines(spark):
    pages = "\n".join(f"It seemed to them that the garden had been long before the\n\n{k}\n\nregatta of the town and that it was idle." for k in range(40, 46))
    chain = scans.fit(docs(spark, [(k, pages) for k in range(30)]))
    assert chain.seen and chain.step != scans.STEP
    lines = pages.split("\n")
    assert [k for k, s in enumerate(scans.furniture(lines, chain)) if s == scans.FURNITURE] == [k for k, line in enumerate(lines) if line.isdigit()]
    seen, steps = scans.Chain().expected(scans.symbols(lines))
    assert sum(seen.values()) == pytest.approx(len(lines)) and sum(steps.values()) == pytest.approx(len(lines) - 1)


def test_a_corpus_without_lines_leaves_the_chain_as_it_was(spark):
    assert scans.fit(docs(spark, [(1, "one line"), (2, None)])).seen == {}


def test_chain_is_fitted_on_every_document(spark):
    """Some thousand pages of four kinds give the chain of the sums of expected counts over all of them."""
    kinds = [f"A line of the text that\n{mark}\ngoes on over the page.\n\n{head}\n\n{PROSE}" for mark, head in (("12", "CHAPTER 2"), ("- 14 -", "PREFACE"), ("THE HARBOUR 31", "3."), ("A2", "THE OLD TOWN"))]
    texts = [kinds[k % 7 % 4] for k in range(3300)]
    chain = scans.Chain()
    for _ in range(scans.ROUNDS):
        seen, steps = {}, {}
        for text in kinds:
            n = texts.count(text)
            for total, own in zip((seen, steps), chain.expected(scans.symbols(text.split("\n"))), strict=True):
                for pair, v in own.items():
                    total[pair] = total.get(pair, 0.0) + n * v
        chain = scans.maximised(seen, steps)
    got = scans.fit(docs(spark, enumerate(texts)))
    assert got.seen.keys() == chain.seen.keys()
    for symbol, scores in chain.seen.items():
        assert got.seen[symbol] == pytest.approx(scores, abs=1e-9)
    assert [v for row in got.step for v in row] == pytest.approx([v for row in chain.step for v in row], abs=1e-9)


# --- 3 near duplicates


def brute(rows, least=0.5):
    kept = [(i, t) for i, t in rows if t and len(near_duplicates.words_of(t)) >= 30]
    return {(min(a, b), max(a, b)) for (a, s), (b, t) in itertools.combinations(kept, 2) if a != b and near_duplicates.similarity(s, t) >= least}


def test_masks_cover_every_two_differences():
    table = near_duplicates.masks()
    assert len(table) == 7 and all(len(m) == 3 for m in table)
    covered = lambda differ: any(not set(differ) & set(m) for m in table)
    assert all(covered(x) for x in itertools.combinations(range(7), 2))
    assert sum(covered(x) for x in itertools.combinations(range(7), 3)) == 28


def test_near_duplicate_candidates_agree_where_they_meet(spark):
    import numpy as np

    # of the seven coordinates of one group, three are shared by all: their key brings together any two
    rng = np.random.default_rng(1)
    sig = rng.integers(0, 2**16, (60, 49)).astype(np.uint16)
    sig[:, :3] = 7
    sig[1, :30] = sig[0, :30]
    lanes = [c.tolist() for c in near_duplicates.sketch(sig)]
    rows = spark.createDataFrame([(i, 1, *own) for i, own in enumerate(zip(*lanes, strict=True))], "id long, key long, " + ", ".join(f"{c} long" for c in near_duplicates.SKETCH))
    last = sig & 63
    for least in (3, 8, 30):
        want = {(a, b) for a in range(60) for b in range(a + 1, 60) if (last[a] == last[b]).sum() >= least}
        assert want and (len(want) == 1 or least < 30)
        for block in (7, 512):
            assert {tuple(r) for r in near_duplicates.candidates(rows, block, least).collect()} == want
    # the coordinates of a long text are as evenly spread as those of a short one
    long = near_duplicates._coordinates([[str(i).encode() for i in range(20_000)]])
    assert long.max() > 2**15 and len(set(long.ravel().tolist())) > 45


def test_near_duplicates_equal_brute_force(spark):
    table = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect()]
    assert {tuple(r) for r in near_duplicates.found(table).collect()} == brute(rows)


def test_pairs_near_the_threshold_equal_brute_force(spark):
    rng = random.Random(3)
    made = [[f"w{rng.randrange(10**9)}" for _ in range(60)] for _ in range(300)]
    rows = [(2 * k, " ".join(words)) for k, words in enumerate(made)]
    rows += [(2 * k + 1, " ".join(words[: 41 + k % 3] + [f"v{rng.randrange(10**9)}" for _ in range(19 - k % 3)])) for k, words in enumerate(made)]
    near = {(2 * k, 2 * k + 1) for k in range(300)}
    texts = dict(rows)
    assert all(0.5 <= near_duplicates.similarity(texts[a], texts[b]) < 0.55 for a, b in near)
    assert {tuple(r) for r in near_duplicates.found(docs(spark, rows)).collect()} == near


def test_hot_buckets_lose_no_pair(spark):
    rows = spark.range(40).select((F.col("id") + 1).alias("id"), F.lit(7).alias("key")).union(spark.createDataFrame([(100, 8), (101, 8)], "id long, key int"))
    got = {tuple(r) for r in near_duplicates.candidates(rows, block=8).collect()}
    assert got == set(itertools.combinations(range(1, 41), 2)) | {(100, 101)}


def test_large_classes_are_given_by_their_representative(spark):
    table = docs(spark, [(k, PROSE * 3) for k in range(1, 13)])
    assert near_duplicates.found(table, copies=5).count() == 11
    assert near_duplicates.found(table).count() == 66
    groups = near_duplicates.grouped(table).collect()
    assert {(r["class_id"], r["copies"], r["links"]) for r in groups} == {(1, 12, 0)}


# --- 4 quality


@pytest.mark.parametrize(
    ("text", "kind"),
    [
        (PROSE * 4, ""), ("Index\n" + "\n".join(f"poor relief, {k}, {k + 30}" for k in range(20)), "list"), ("\n".join(f"{k}\t{k * 7}\tPlace" for k in range(20)), "table"),
        ("\n".join(f"[{k}9508] fbabcbf1140 ERR /vnt/x 465 {k}" for k in range(20)), "junk"), ("404 - the page 16367 was not found on this mirror.", "junk"),
        ("xjb jqsmb zjzcgk. xkgvcqv nvckrp; lgd, wgh zck. gwgmqz. qqqkgc rz; mznq; tlx, ncp fthpkksc. " * 4, "junk"), (None, ""), ("", ""), (" \n", ""),
    ],
)
def test_kinds(text, kind):
    assert quality.kind_of(text) == kind


def test_scores_and_found(spark):
    rows = [(k, PROSE * (1 + k % 5)) for k in range(40)] + [(99, "\n".join(f"{k}\t{k * 7}\tPlace" for k in range(20)))]
    table = docs(spark, rows)
    assert [tuple(r) for r in quality.found(table).collect()] == [(99, "table")]
    row = quality.judged(table).filter("doc_id = 99").first()
    assert row["tail"] and row["z_digit_ratio"] > 3


def test_tables_are_found_however_many_there_are(spark):
    many = "\n".join(f"{k}\tthe {k * 7}\tPlace" for k in range(20))
    alone = "\n".join(f"{k}\tder {k * 7}\tOrt" for k in range(20))
    rows = [(k, many if k % 5 < 2 else PROSE * (1 + k % 4)) for k in range(40)] + [(99, alone)]
    got = {tuple(r) for r in quality.found(docs(spark, rows)).collect()}
    assert got == {(k, "table") for k in range(40) if k % 5 < 2} | {(99, "table")}


def test_the_bound_is_read_from_the_sketch():
    assert quality.parted([0.0] * 60 + [0.1] * 10 + [0.9] * 10 + [1.0] * 120) == pytest.approx(0.5)
    assert quality.parted([0.2] * 100 + [0.8] * 99) == pytest.approx(0.5) and quality.parted([0.05] * 50 + [0.75] * 149) == pytest.approx(0.4)
    assert quality.parted([0.9] * 100 + [1.0] * 99) is None and quality.parted(None) is None and quality.parted([]) is None


def test_sketches_decide_the_rows(spark):
    half = PROSE * 3 + "\n" + "\n".join(f"{k}\t{k * 7}\tPlace {k}" for k in range(14))
    rows = [(k, PROSE * (1 + k % 5)) for k in range(40)] + [(50 + k, "\n".join(f"{j}\t{j * k}\tPlace" for j in range(20))) for k in range(20)] + [(99, half)]
    table = docs(spark, rows)
    share = quality.statistics(table).filter("doc_id = 99").first()["prose_share"]
    assert 0.5 < share < 0.9
    own = {r[0] for r in quality.judged(table).filter("kind is not null").collect()}
    assert own == set(range(50, 70))
    levels = quality.sketched(quality.statistics(table)).collect()
    names = [r["language"] for r in levels]
    other = spark.createDataFrame([(n, [float(share - 0.3)] * 60 + [0.99] * 139, *[[float(k) for k in range(199)]] * 6) for n in names], "language string, q_prose_share array<double>, q_n_words array<double>, q_mean_word array<double>, q_symbol_ratio array<double>, q_digit_ratio array<double>, q_line_end_share array<double>, q_common_share array<double>")
    moved = {r[0] for r in quality.judged(table, other).filter("kind is not null").collect()}
    bound = (share - 0.3 + 0.99) / 2
    assert moved == own | ({99} if share < bound else set())


# --- 5 garbled


@pytest.mark.parametrize("text", ["Après l’été, les reçus ont troublé les idées.", "Für die Wünsche fand er keine größere Erklärung.", "Никто уже не помнит тяжёлые корзины, ни осады."])
@pytest.mark.parametrize("page", ["cp1252", "cp1251", "mac_roman", "latin-1"])
def test_utf8_read_as_a_page_comes_back(text, page):
    try:
        bad = text.encode().decode(page)
    except UnicodeDecodeError:
        pytest.skip("the page leaves a byte undefined")
    affected, restored, _ = garbled.repair(bad)
    assert affected and restored == text


@pytest.mark.parametrize(("read", "written", "text"), [("cp1252", "cp1251", "Никто уже не помнит тяжёлые корзины, ни осады."), ("cp1251", "cp1252", "Für die Wünsche fand er keine größere Erklärung."), ("koi8_r", "cp1251", "Никто уже не помнит старые корзины")])
def test_one_page_read_as_another(read, written, text):
    assert garbled.repair(text.encode(written).decode(read))[:2] == (True, text)


@pytest.mark.parametrize("text", ["An Â and an Ï cut in oak.", "SÃO Rudrosdupré DE AÇÃO", "On the lid: שלום ספר, and مكتبة", "Café and naïve", "√2 ≈ 1,414 and 65° 30′", PROSE, "a cut at the en�", "Was it? It was.", None, ""])
def test_sound_texts_stay(text):
    assert garbled.repair(text)[0] is False


@pytest.mark.parametrize("text", ["F?r die W?nsche fand er nichts.", "n�a gard� les soir�es", "?Leave it,? said he, ?it isn?t ornate.?"])
def test_lost_characters_are_found(text):
    assert garbled.repair(text)[:2] == (True, None)


def test_swapped_utf16():
    text = "It seemed to him that the errand had sharpened."
    assert garbled.repair(text.encode("utf-16-le").decode("utf-16-be"))[:2] == (True, text)


SOUND = [
    "The Czech name Jiří Dvořák and the town of Žďár are sound text, and so is Plzeň.", "Łódź leży w Polsce, a gęś i łąka są polskie.", "İstanbul'da ağaç, şehir ve çiçek güzel, ığdır da.",
    "Țara și pădurea sînt românești, iar ţăranul şi brânza tot aşa.", "Η γλώσσα είναι ελληνική και το κείμενο σωστό.", "Győr és Pécs között őszi fű nő.", "Smørrebrød på Ærø, þorn og ðæt.",
]


def test_sound_texts_of_languages_the_corpus_lacks_stay(spark):
    plain = "Après l’été, les reçus très chers ont troublé les idées. Für die Wünsche fand er keine größere Erklärung."
    table = docs(spark, [(k, f"{plain} {k}") for k in range(60)] + [(100 + k, t) for k, t in enumerate(SOUND)])
    assert garbled.garbled(table).filter("doc_id >= 100").collect() == []
    assert all(garbled.repaired(t) == t for t in SOUND)


def test_letters_of_another_page_are_told_by_the_corpus(spark):
    plain = "Après l’été, les reçus très chers ont troublé les idées près du progrès."
    bad = plain.replace("’", "'").encode("cp1252").decode("cp1250")
    assert bad != plain and garbled.repair(bad)[0] is False
    table = docs(spark, [(k, f"{plain} {k}") for k in range(300)] + [(1000, bad)])
    got = {r["doc_id"]: r["restored"] for r in garbled.garbled(table).collect()}
    assert got == {1000: plain.replace("’", "'")}


# --- 6 subjects


def test_subjects_agree_with_the_hand_labels(spark):
    tables = {n: spark.read.parquet(f"{MIDDLE}/{n}.parquet") for n in ("documents", "extractions", "subject_labels")}
    got = {tuple(r) for r in subjects.found(tables).collect()}
    labels = {(r["doc_id"], r["subject"]) for r in tables["subject_labels"].collect()}
    assert len(labels & got) >= 0.7 * len(labels)
    known = {d for d, _ in labels}
    mine = {x for x in got if x[0] in known}
    assert len(mine & labels) >= 0.6 * len(mine)


def test_all_sentences_of_a_long_document_teach(monkeypatch):
    class Sure:
        def __init__(self, model):
            pass

        def sentences(self, parts):
            return np.ones((len(parts), len(subjects.SUBJECTS)), np.float32)

    monkeypatch.setattr(subjects, "Scorer", Sure)
    text = " ".join(f"They followed the rumour of the regatta in the year {k}." for k in range(500))
    batch = pa.RecordBatch.from_pylist([{"doc_id": 1, "text": text, "marks": [{"subject": subjects.SUBJECTS[0], "w": 1.0}]}])
    words, targets, weights = subjects.examples(batch, ())
    assert len(words) == len(targets) == len(weights) == 500


def test_no_labels_give_a_result_without_error(spark, odd):
    tables = {"documents": odd, "extractions": spark.createDataFrame([], "text_uri string, category string"), "subject_labels": spark.createDataFrame([], "doc_id long, subject string")}
    subjects.found(tables).collect()


# --- 7 tokens


@pytest.mark.parametrize("text", ["", "plain words", "  two  blanks\n\n\nand\r\nlines ", "naïve 書庫 👩‍🔬 ё", "<|endoftext|> is text", "\x1c\x1d odd \x85 space x", "don't  'tis\t\tok\n "])
def test_ids_are_those_of_the_whole_text(text):
    path = f"{tokens.TOKENIZER_DIR}/{tokens.BYTE_BPE}"
    whole = tokens.load(path).encode(text, add_special_tokens=False)
    ids = tokens.encode([text], path)[0]
    assert ids == whole.ids and tokens.decode(ids, path) == text
    starts, ends = tokens.offsets(text, ids, path)
    assert list(zip(starts, ends, strict=True)) == whole.offsets


def test_null_and_empty_have_no_ids(spark):
    got = {r["doc_id"]: r["ids"] for r in tokens.encode_corpus(docs(spark, [(1, None), (2, ""), (3, "a")])).collect()}
    assert got[1] == got[2] == [] and len(got[3]) == 1


def test_round_trip_of_the_corpus(spark):
    assert tokens.corpus_offsets(spark.read.parquet(f"{SMALL}/documents.parquet")).filter("not restored").count() == 0


# --- 8 packing


def test_packing_keeps_every_item_and_the_capacity():
    import random

    rng = random.Random(3)
    items = [(min(1000, int(rng.lognormvariate(5, 1)) + 1), k) for k in range(2000)]
    bins = packing.pack(items, 1000)
    assert sorted(i for b in bins for i in b) == list(range(2000))
    assert all(sum(items[i][0] for i in b) <= 1000 for b in bins)
    assert len(bins) <= 1.02 * sum(s for s, _ in items) / 1000 + 1
    assert packing.exchange(items, packing.best_fit(items, 1000), 1000) == bins


def test_exchanges_empty_containers_that_best_fit_leaves():
    """Sizes of which best fit, longest first, fills containers badly."""
    sizes = [44, 24, 24, 22, 21, 17, 8, 8, 6, 6] * 40
    items = [(s, k) for k, s in enumerate(sizes)]
    before = packing.best_fit(items, 60)
    after = packing.exchange(items, [list(b) for b in before], 60)
    squares = lambda bins: sum(sum(items[i][0] for i in b) ** 2 for b in bins)
    assert sorted(i for b in after for i in b) == list(range(len(items))) and all(sum(items[i][0] for i in b) <= 60 for b in after)
    assert len(after) <= len(before) and squares(after) >= squares(before)


def test_long_documents_alone_are_divided(spark):
    sized = spark.createDataFrame([(1, 25), (2, 10), (3, 4), (4, 0), (5, 6)], "doc_id long, n_tokens int")
    rows = packing.containers(sized, 1, 10).collect()
    assert sum(r["tokens"] for r in rows) == 45 and {r["doc_id"] for r in rows} == {1, 2, 3, 5}
    assert [r["doc_id"] for r in rows if r["part"] > 0] == [1, 1]
    fills = {}
    for r in rows:
        fills[r["container"]] = fills.get(r["container"], 0) + r["tokens"]
    assert max(fills.values()) <= 10 and len(fills) == 5


def test_groups_are_packed_again(spark):
    sized = spark.range(1, 600).select(F.col("id").alias("doc_id"), (F.col("id") * 37 % 90 + 5).cast("int").alias("n_tokens"))
    rows = packing.containers(sized, 1, 100, group=50)
    assert rows.count() == 599 and rows.select("doc_id").distinct().count() == 599
    assert rows.groupBy("container").agg(F.sum("tokens").alias("t")).filter("t > 100").count() == 0


# --- 9 truncation


@pytest.mark.parametrize(
    ("end", "want"),
    [
        ("the rumour before no", "open"), ("the rumour before ", "open"), ("the rumour before noon.", "closed"), ("before noon, and th [truncated]", "marked"), ("before noon…", "marked"), ("noon.\n\nTHE END", "closed"),
        ("noon.\n\nKornamovale, 1853", "named"), ("noon.\n\nSee also p. 8", "closed"), ("noon.\n\nYours faithfully,\nUndbapiund", "named"), ("noon.\n\nFew people now", "loose"), ("noon.\n\n[Plate 6]", "closed"), ("caf�", "marked"), (None, "closed"), (" ", "closed"),
    ],
)
def test_endings(end, want):
    assert truncation.ending(PROSE + end if end and end.strip() else end) == want


def test_field_limits_are_found(spark):
    rows = [(k, (PROSE * 30)[: 400 + k * 13 % 900] + ".") for k in range(300)] + [(1000 + k, f"{k:03d} " + (PROSE * 30)[k : k + 996]) for k in range(40)]
    ends = truncation.endings(docs(spark, rows))
    assert {r["length"] for r in truncation.limits(ends).collect()} == {1000}
    assert truncation.found(docs(spark, rows)).filter("doc_id >= 1000").count() >= 38


def named_ends(spark):
    """Complete texts of many lengths, forty cut at 1 000 characters in mid-sentence, and two that end in a name: one at that length."""
    rows = [(k, (PROSE * 30)[: 400 + k * 13 % 900] + ".") for k in range(300)] + [(1000 + k, f"{k:03d} " + (PROSE * 30)[k : k + 996]) for k in range(40)]
    tail = ".\n\nKornamovale"
    return docs(spark, [*rows, (2000, (PROSE * 30)[: 1000 - len(tail)] + tail), (2001, (PROSE * 30)[: 777 - len(tail)] + tail)])


def test_hazards_decide_doubtful_endings(spark):
    table = named_ends(spark)
    found = {r["doc_id"] for r in truncation.judged(table).filter("truncated").collect()}
    assert 2000 in found and 2001 not in found
    none = spark.createDataFrame([], "source string, unit string, length long, n long, expected double, p_value double")
    assert 2000 not in {r["doc_id"] for r in truncation.judged(table, none).filter("truncated").collect()}


def test_closed_texts_that_fill_a_field_stay(spark):
    rows = [(k, (PROSE * 30)[: 400 + k * 13 % 900] + ".") for k in range(300)] + [(1000 + k, f"{k:03d} " + (PROSE * 30)[k : k + 996]) for k in range(40)] + [(2000 + k, f"{k:03d} " + (PROSE * 30)[k : k + 995] + ".") for k in range(10)]
    found = {r["doc_id"] for r in truncation.found(docs(spark, rows)).collect()}
    assert not found & set(range(2000, 2010)) and len(found & set(range(1000, 1040))) >= 38


def test_endings_without_evidence_are_the_priors():
    cut_share, whole, rate, true = truncation.endings_by_evidence({})
    assert cut_share["open"] == pytest.approx(0.9, abs=0.01) and whole["closed"] > 0.98 and rate <= 1e-3 and true == 1.0


def test_every_query_runs_on_the_smallest_tables(spark):
    for name, query in llm.queries().items():
        if name not in ("p6_composition", "p1_matches"):
            query(spark, SMALL).collect()
