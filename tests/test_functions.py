"""Text, URL, search, corpus and merge functions on rows made for the purpose."""

import itertools
import math
import re

import pytest
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.functions import urls as U
from quire.operators import corpus, merge, search, state
from quire.predicates import ascii_contains, format_rank, size_bytes


def one(spark, value, make, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(make(F.col("x")).alias("y")).first()[0]


@pytest.mark.parametrize(
    ("value", "want"),
    [("a\r\nb\rc", "a\nb\nc"), ("a  \t b", "a b"), ("a\n\n\n\nb", "a\n\nb"), ("  a \n", "a"), ("", ""), (None, None)],
)
def test_normalize(spark, value, want):
    assert one(spark, value, T.normalize) == want


def test_corpus_normalize_trims_lines(spark):
    assert one(spark, "a \n b", T.corpus_normalize) == "a\nb"


def test_dehyphenate_joins_only_before_lower_case(spark):
    assert one(spark, "divi-\nsion and Anne-\nMarie", T.dehyphenate) == "division and Anne-\nMarie"


@pytest.mark.parametrize(("value", "want"), [("PDF", 6), ("DjVuTXT", 0), ("Archive BitTorrent", 99), (None, 50), ("plain text", 0), ("docx", 4)])
def test_format_rank(spark, value, want):
    assert one(spark, value, format_rank) == want


@pytest.mark.parametrize(("value", "want"), [("2.4 MB", 2.4 * 1048576), ("Unknown", 1e12), ("1,234 KB", 1.0), ("1.2.3", 1e12), ("478 bytes", 478.0), (None, 1e12)])
def test_size_bytes(spark, value, want):
    assert one(spark, value, size_bytes) == pytest.approx(want)


def test_ascii_contains_folds_ascii_only(spark):
    assert one(spark, "HISTORY of É", lambda c: ascii_contains(c, "history"))
    assert not one(spark, "É", lambda c: ascii_contains(c, "é"))
    assert one(spark, None, lambda c: ascii_contains(c, "a")) is False


@pytest.mark.parametrize(("value", "want"), [("history", True), ("letter_garden", True), ("scanned_page", False), ("xyz", False), ("lang_de", False), ("bcdfg", False), ("four_words_make_none", False), (None, True)])
def test_valid_category(spark, value, want):
    assert one(spark, value, T.valid_category) is want


def test_unwrap_keeps_lists_and_joins_long_lines(spark):
    long = "word " * 16
    text = f"{long}\nmore\n\n- one\n- two\n\nshort\nverse"
    assert one(spark, text, T.unwrap) == f"{long.strip()} more\n\n- one\n- two\n\nshort\nverse"


def test_between_notices(spark):
    text = "head\n*** Start of the Project Gutenberg EBook\nbody\n"
    assert one(spark, text, T.between_notices) == "body\n"
    assert one(spark, "body\n*** END OF THIS PROJECT GUTENBERG\ntail", T.between_notices) == "body\n"
    assert one(spark, "nothing", T.between_notices) == "nothing" and one(spark, None, T.between_notices) is None


def test_rules():
    made = T.checked_rules([{"type": "literal", "from": "a", "max_replacements": 0}, {"type": "regex", "from": "("}, {"type": "other", "from": "x"}, "no", {"type": "literal", "from": "b" * 201}, {"type": "regex", "from": "b+", "max_replacements": 10**6}])
    assert [(r["from"], r["most"]) for r in made] == [("a", 1000), ("b+", 10_000)]
    with pytest.raises(ValueError):
        T.checked_rules({})


def test_apply_rules(spark):
    rules = T.checked_rules([{"type": "literal", "from": "a.", "to": "$1", "max_replacements": 2}, {"type": "regex", "from": "[0-9]+$", "to": "#"}])
    row = spark.createDataFrame([("a.a.a.ab 12",), (None,)], "x string").select(T.apply_rules(F.col("x"), rules)[0].alias("y"), *[c.alias(f"n{k}") for k, c in enumerate(T.apply_rules(F.col("x"), rules)[1])]).collect()
    assert tuple(row[0]) == ("$1$1a.ab #", 2, 1) and row[1]["y"] is None


@pytest.mark.parametrize(("value", "want"), [('{"k": 1} x', 1), ('x ```json\n{"k": 2}\n``` {"k": 3}', 2), ("none", None), (None, None)])
def test_first_json(spark, value, want):
    got = one(spark, value, lambda c: T.first_json(c, "k int"))
    assert (got and got["k"]) == want


def test_quality_heuristic(spark):
    status = lambda x: one(spark, x, T.quality_heuristic)["status"]
    assert status(None) == status("  ") == "unusable"
    assert status("a\x01\x02\x03b" * 20) == "unusable"
    assert status("Too short.") == "suspect"
    assert status("These are plain words of a text that goes on. " * 5) == "usable"


def test_url_parts_of_malformed(spark):
    assert one(spark, "https://[broken", lambda c: U.part(c, "scheme")) == "https"
    assert one(spark, None, lambda c: U.part(c, "host")) == ""
    assert one(spark, "https://a.b/c.HTML?x=1", U.link_format) == "HTML"


def test_phrase_and_prefix(spark):
    docs = spark.createDataFrame([(1, "The Café had to wait; had to wait."), (2, "to had wait"), (3, None)], "doc_id long, text string")
    assert search.match_phrase(docs, ["had", "to", "wait"]).collect() == [(1, 2)]
    assert [r[0] for r in search.match_all(docs, ["cafe"]).collect()] == [1]
    assert search.match_prefix(docs, "wai").count() == 2
    assert search.snippets(docs, "cafe").first()["snippet"].startswith("The <mark>Café</mark> had")


def test_parse_query():
    assert search.parse_query('"old Empire" Café') == ("all", [["old", "empire"], ["cafe"]])
    with pytest.raises(ValueError):
        search.parse_query("  ")


def test_bm25_matches_the_formula(spark):
    rows = [(1, "history", None, None, None, "a b c"), (2, "x", None, None, None, "history history"), (3, "y", None, None, None, "d")] + [(k, "z", None, None, None, "e") for k in range(4, 9)]
    texts = spark.createDataFrame(rows, "doc_id long, title string, author string, category string, site string, body string")
    got = {r["doc_id"]: r["score"] for r in search.bm25(texts, ["history"]).collect()}
    mean = (4 + 3 + 2 + 2 * 5) / 8
    idf = math.log((8 - 2 + 0.5) / (2 + 0.5))
    want = lambda f, size: -idf * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * size / mean))
    assert got == {1: pytest.approx(want(8, 4), abs=1e-5), 2: pytest.approx(want(2, 3), abs=1e-5)}


def test_stored_index_scores_as_the_texts(spark, tmp_path):
    rows = [(k, f"title {k % 3}", "a", "c", "s", " ".join(["lamp"] * (k % 4) + ["word"] * k)) for k in range(12)]
    texts = spark.createDataFrame(rows, "doc_id long, title string, author string, category string, site string, body string")
    search.write_index(texts, str(tmp_path), shards=4)
    assert sorted(search.search_index(spark, str(tmp_path), ["lamp", "2"], shards=4).collect()) == sorted(search.bm25(texts, ["lamp", "2"]).collect())


def test_query_of_a_user(spark):
    docs = spark.createDataFrame([(1, "the old Empire of Café"), (2, "empire old café"), (3, "old empire")], "doc_id long, text string")
    ids = lambda *a: sorted(r[0] for r in search.match_query(docs, *a).collect())
    assert ids('"old empire" cafe') == [1] and ids("cafe empire") == [1, 2] and ids('"old empire" cafe', "any") == [1, 2, 3] and ids("old empire", "phrase") == [1, 3]


def test_folding_covers_all_marked_letters(spark):
    assert one(spark, "Łódź Dvořák ČESKÝ Ёлка ǅ", search.tokens, "string") == ["łodz", "dvorak", "cesky", "елка", "ǆ"]


def test_numbered_is_the_sorted_order_however_partitioned(spark):
    rows = spark.range(500).select(((F.col("id") * 7919) % 503).alias("k"))
    for parts in (1, 7):
        got = corpus.numbered(rows.repartition(parts), [F.col("k")]).orderBy("item_index").collect()
        assert [r["item_index"] for r in got] == list(range(1, 501))
        assert [r["k"] for r in got] == sorted(r["k"] for r in got)


def test_upsert_prefers_changes_and_late_rows(spark):
    old = spark.createDataFrame([(1, "a", 9), (2, "b", 1)], "id long, v string, seq int")
    new = spark.createDataFrame([(1, "c", 1), (1, "d", 2), (3, "e", 1)], "id long, v string, seq int")
    assert sorted(merge.upsert(old, new, ["id"], "seq").select("id", "v").collect()) == [(1, "d"), (2, "b"), (3, "e")]


def test_keep_better_never_downgrades(spark):
    old = spark.createDataFrame([(1, "processed"), (2, "failed")], "k long, status string")
    new = spark.createDataFrame([(1, "failed"), (2, "processed"), (3, "failed")], "k long, status string")
    assert sorted(merge.keep_better(old, new, "k", "processed").collect()) == [(1, "processed"), (2, "processed"), (3, "failed")]


def test_manifest_is_the_same_however_often_built(spark):
    from quire.catalog import Catalog

    c = Catalog(spark, "/root/testdata/sf0.001")
    assert corpus.manifest(c, "x").collect() == corpus.manifest(c, "x").collect()


def test_manifest_hash_is_that_of_the_canonical_json(spark):
    import hashlib

    from quire.catalog import Catalog

    c = Catalog(spark, "/root/testdata/sf0.001")
    pairs = [("the ", "The ")]
    rows = sorted(corpus.items(c, pairs).collect(), key=lambda r: r["item_index"])
    names = {"item_index": "item_index", "extraction_id": "extraction_id", "work_id": "work_id", "title": "title", "author": "author", "site": "site", "format": "format", "category": "category", "text_uri": "text_uri", "text_sha256": "text_sha256", "transformed_sha256": "sha256", "char_count": "chars"}
    subs = [{"from": a, "to": b} for a, b in pairs]
    whole = {"format": "corpus.v1", "name": "x", "selection": {"category": None, "site": None, "query": None, "limit": None, "use_munged": False}, "ordering_strategy": "title", "seed": 0, "normalizer_version": "corpus-normalize.v1", "substitutions_sha256": hashlib.sha256(corpus.canonical_json(subs).encode()).hexdigest(), "substitutions": subs, "item_count": len(rows), "total_chars": sum(r["chars"] for r in rows), "items": [{k: r[v] for k, v in names.items()} for r in rows]}
    assert corpus.manifest_hash(c, "x", pairs=pairs) == hashlib.sha256(corpus.canonical_json(whole).encode()).hexdigest()


def test_munge_drops_furniture_and_joins_words(spark):
    page = "RUNNING HEAD {k}\nThe divi-\nsion of “labour” ﬁts here and goes on for {w} while on this long line.\nMore {w} of the paragraph that runs on past the break.\n{k}\n\n"
    text = "".join(page.format(k=k, w=w) for k, w in ((7, "some"), (8, "quite a"), (9, "no")))
    got = one(spark, text, T.munged)
    assert "RUNNING" not in got["text"] and 'The division of "labour" fits here' in got["text"] and "\n7" not in got["text"]
    assert got["removed_running_lines"] == 6 and got["original_chars"] == len(text) and got["cleaned_chars"] == len(got["text"])
    assert one(spark, got["text"], T.munged)["text"] == got["text"]
    assert one(spark, None, T.munged) is None and one(spark, "\ufffd\x01", T.munged)["text"] == ""


@pytest.mark.parametrize(
    ("value", "want"),
    [("a\r\nb", "a\nb"), ("x\u200by", "xy"), ("²\u00a0½", "2 1⁄2"), ("a  \t b \n c", "a b\nc"), ("\n\n\na\n\n\n\nb", "a\n\nb"), ("e\u0301", "é"), ("one\u2028two", "one\ntwo"), ("- 12 -\ntext", "text"), ("- item one\n- item two", "- item one\n- item two")],
)
def test_munge_in_order(spark, value, want):
    assert one(spark, value, T.munged)["text"] == want


def test_fuzzy_titles(spark):
    from quire.operators.titles import fuzzy_titles

    made = [
        (1, "A History of the Old Empire in Dale", "A. Person"), (2, "History of the Old Empire, Dale", "A. Person and others"), (3, "The Old Castle of Hill", None), (4, None, None), (5, "the old castle of hill!", None),
        (6, "Letters", "X"), (7, "Letters", "Y"), (8, "Barometers and Thermometers", None), (9, "Barometars and Thermometers", None), (10, "Castle", None),
    ]

    class Fake:
        works = spark.createDataFrame(made, "id long, title string, author string")

    sure = {(1, 2), (3, 5), (6, 7)}
    for block in (1, 200):
        assert {tuple(r) for r in fuzzy_titles(Fake(), block=block).collect()} == sure
    assert {tuple(r) for r in fuzzy_titles(Fake(), ratio=0.9).collect()} == sure | {(8, 9)}


def test_titles_are_cleaned_once(spark):
    """What meets more than once is not computed again from the table for each side of each join."""
    from quire.operators.titles import fuzzy_titles

    class Fake:
        works = spark.createDataFrame([(1, "The Harbour of Dravosville", "Ada Farfosson"), (2, "Harbour of Dravosville", None)], "id long, title string, author string")

    plan = fuzzy_titles(Fake())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(lower(title") + plan.count("regexp_replace(lower(coalesce(title") <= 8  # it was 245


def test_frequent_beginnings_are_compared_by_arrays(spark):
    """All pairs of 300 titles of one beginning that letters and sizes leave, however many parts they are divided into."""
    from pyspark.sql import functions as F

    from quire.operators.titles import letters, near_pairs

    texts = [f"a history of the {'harbour' * (k % 3)} {chr(97 + k % 26)}{chr(97 + k // 26)} of {'dravos' if k % 2 else 'farfos'}ville" for k in range(300)]
    longs = letters(F.col("t"))
    told = spark.createDataFrame(list(enumerate(texts)), "tk long, t string").select(F.lit(7).cast("long").alias("k"), "tk", F.length("t").cast("long").alias("size"), *[v.alias(f"v{n}") for n, v in enumerate(longs)])
    names = [f"v{n}" for n in range(len(longs))]
    rows = [r.asDict() for r in told.collect()]
    near = lambda a, b: max(sum((a[v] ^ b[v]).bit_count() for v in names), abs(a["size"] - b["size"])) <= (1 - 0.9) * (a["size"] + b["size"]) + 1e-9
    want = {(a["tk"], b["tk"]) for a in rows for b in rows if a["tk"] < b["tk"] and near(a, b)}
    assert 0 < len(want) < 300 * 299 // 2
    for block in (40, 4096):
        assert {tuple(r) for r in near_pairs(told, names, 0.9, block).collect()} == want


def test_titles_match_by_characters_wherever_they_differ(spark, tmp_path):
    """fuzzy_title_match finds all pairs of nine tenths of their characters, be their beginnings, ends and words all different,
    and its SQL counts as difflib does, with letters that are frequent in long titles."""
    import random
    from difflib import SequenceMatcher

    from compare import connect, differ

    from quire.plans import queries as plans

    rng = random.Random(7)
    made = [" ".join("".join(rng.choice("abcdefghijklmnoprstuvwy") for _ in range(rng.randrange(3, 9))) for _ in range(n)) for n in (2, 3, 4, 5, 6, 7, 8, 9, 36, 40)]

    def other(title):
        """A letter in each word is another one, or only in some."""
        words = title.split()
        return " ".join(w[:k] + rng.choice("qxz") + w[k + 1 :] if rng.random() < 0.6 else w for w in words for k in [rng.randrange(len(w))])

    texts = sorted({t for title in made for t in (title, *(other(title) for _ in range(6)))} | {"abcdefghij klmnopqrst uvwxyzbcde", "zbcdefghij xlmnopqrst uvwxyzbcdq", made[-1][:-3] + "qqq"})
    spark.createDataFrame([(k, t.title(), None) for k, t in enumerate(texts)], "id long, title string, author string").coalesce(1).write.parquet(f"{tmp_path}/works.parquet")
    match = lambda a, b: max(SequenceMatcher(None, a, b).ratio(), SequenceMatcher(None, b, a).ratio()) >= 0.9
    want = {(a, b) for a, t in enumerate(texts) for b, u in enumerate(texts) if a < b and match(t, u)}
    apart = {(a, b) for a, b in want if not set(texts[a].split()) & set(texts[b].split()) and texts[a][:6] != texts[b][:6] and texts[a][-6:] != texts[b][-6:]}
    assert apart and any(len(texts[b]) >= 200 for _, b in want)
    got = plans.queries()["fuzzy_title_match"](spark, str(tmp_path))
    assert want <= {tuple(r) for r in got.collect()}
    assert differ(got, connect(str(tmp_path)), plans.oracle_sql()["fuzzy_title_match"]) == ""


def test_categories_by_words(spark):
    rows = [(1, "The Garden", "old garden", "garden lamp lamp lamp"), (2, None, None, "harbour harbour harbour lamp"), (3, None, None, "harbour"), (4, "Book of the", None, None)]
    got = {r["doc_id"]: (r["name"], r["keywords"]) for r in T.word_category(spark.createDataFrame(rows, "doc_id long, title string, search_query string, text string")).collect()}
    assert got == {1: ("garden", "garden,lamp"), 2: ("harbour", "harbour,lamp"), 3: ("uncategorized", ""), 4: ("uncategorized", "")}


def test_health_and_activity(spark):
    counts = spark.createDataFrame([(0, 0, 1, 0, 0, 1, 0, 0, False)], "infected int, worker_failed int, worker_running int, extraction_failed int, raw_failed int, pending_downloads int, pending_extractions int, pending_raw int, stale boolean")
    assert tuple(state.health(counts).first())[:2] == ("running", "background work is active")
    assert state.health(counts.withColumn("worker_running", F.lit(0))).first()["state"] == "queued"
    assert one(spark, "Batch x-1 FAILED:  it", state.message) == "failed it"
    assert one(spark, "odd", lambda c: state.activity(c, F.lit("x"))) == "note"


def test_sessions_without_a_shared_folder_are_refused(monkeypatch):
    from quire import session

    class Context:
        master = "yarn"

        def getCheckpointDir(self):  # noqa: N802
            return None

    class Conf:
        def get(self, name, default):
            return None

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(type("S", (), {"sparkContext": Context(), "conf": Conf()})())
