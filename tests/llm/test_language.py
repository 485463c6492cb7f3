import random

from flowcast.llm import language

SYLLABLES = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["stro", "grun", "elt", "ach"], "cc": ["ção", "ñe", "oui", "eux"]}


def text(tag, seed, n=60):
    r = random.Random(seed)
    return " ".join("".join(r.choice(SYLLABLES[tag]) for _ in range(r.randint(1, 4))) for _ in range(n))


def corpus():
    rows = []
    for i in range(300):
        tag = ["aa", "bb", "cc"][i % 3]
        said = tag if i % 10 else ["bb", "cc", "aa"][i % 3]      # one declaration in ten is wrong
        rows.append((i, text(tag, i), said if i % 7 else None, "one" if i % 2 else f"h{i % 5}"))
    return rows


SCHEMA = "doc_id long, text string, lang string, source string"


def test_texts_outweigh_wrong_declarations(spark):
    got = language.identify(spark.createDataFrame(corpus(), SCHEMA)).collect()
    assert {r.doc_id: r.language for r in got} == {i: ["aa", "bb", "cc"][i % 3] for i in range(300)}
    assert all(r.accepted for r in got)


def test_numbers_and_keys_do_not_reject_a_text(spark):
    rows = corpus() + [(1000, "4111111111111111 " + text("aa", 1, 3) + " token = \"2abc3ff2ca8fb1e4c565a0eb63815530a948bdde\"", "aa", "one")]
    got = {r.doc_id: r for r in language.identify(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1000].language == "aa" and got[1000].accepted


def test_unknown_scripts_and_texts_without_letters_are_rejected(spark):
    rows = corpus() + [(1000, "漢字仮名交じり文" * 30, None, "one"), (1001, "12 34 !! ##", "aa", "one"), (1002, None, None, None), (1003, "", "aa", "h1")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: (r.language, r.accepted) for r in language.identify(docs).collect() if r.doc_id >= 1000}
    assert got == {i: ("und", False) for i in range(1000, 1004)}
    kept = language.accept(docs)
    assert kept.schema == docs.schema and {r.doc_id for r in kept.collect()} == set(range(300))


def test_hosts_and_declarations_decide_where_texts_do_not(spark):
    rows = [(i, text("aa" if i % 4 else "bb", i), "aa" if i % 4 else "bb", "only-aa" if i % 4 else "only-bb") for i in range(200)]
    rows += [(900, "!x!", None, "only-aa"), (901, "!x!", None, "only-bb")]
    got = {r.doc_id: r.language for r in language.identify(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert (got[900], got[901]) == ("aa", "bb")


def test_suffixes_stand_between_hosts_and_all(spark):
    rows = [(i, text("aa" if i % 2 else "bb", i), None if i % 3 else ("aa" if i % 2 else "bb"), f"h{i}", "xa" if i % 2 else "xb") for i in range(240)]
    rows += [(900, "!x!", None, "new1", "xa"), (901, "!x!", None, "new2", "xb")]
    docs = spark.createDataFrame(rows, SCHEMA + ", tld string")
    got = {r.doc_id: r.language for r in language.identify(docs, suffix_col="tld").collect()}
    assert (got[900], got[901]) == ("aa", "bb")


def test_declarations_behind_long_attributes(spark):
    tags = ["<html data-x='" + "y" * 50000 + "' lang=fr>", "<htmlx lang=fr>", "<html><p lang=fr>", "<html" * 200, "<html\n LANG = 'de-AT'>"]
    pages = spark.createDataFrame([(i, "https://a.fr/", t) for i, t in enumerate(tags)], "page_id long, url string, html string")
    assert [r.lang for r in language.page_evidence(pages).orderBy("page_id").collect()] == ["fr", None, None, None, "de"]


def test_page_evidence(spark):
    pages = spark.createDataFrame([
        (1, "https://user@m.Site.example.FR:80/x?y", "<!DOCTYPE html><html class='a' lang=\"fr-CA\"><script>var a='<p>'</script><p>Bon&amp;jour</p>"),
        (2, None, None), (3, "not an address", "plain")], "page_id long, url string, html string")
    a, b, c = language.page_evidence(pages).orderBy("page_id").collect()
    assert (a.lang, a.host, a.suffix, a.text.split()) == ("fr", "m.site.example.fr", "fr", ["Bon", "jour"])
    assert (b.lang, b.host, b.suffix, b.text) == (None, None, None, "")
    assert (c.lang, c.host, c.text) == (None, None, "plain")


def test_grams_stay_inside_texts():
    import pyarrow as pa
    texts = ["abc", "", "AB", "a1bcd", "wörld", "x"]
    code, starts = language.grams(pa.array(texts))
    alone = [language.grams(pa.array([t]))[0].tolist() for t in texts]
    assert [code[a:b].tolist() for a, b in zip(starts, starts[1:])] == alone
    assert [len(a) for a in alone] == [1, 0, 0, 1, 4, 0]
    assert language.grams(pa.array(["ABC"]))[0].tolist() == language.grams(pa.array(["abc"]))[0].tolist()


def test_odd_rows(odd, none):
    got = language.identify(odd)
    assert got.count() == odd.count()
    assert {r.language for r in got.collect() if r.doc_id in (0, 1, 2)} == {"und"}
    out = language.accept(odd)
    assert out.schema == odd.schema and {0, 1, 2}.isdisjoint(r.doc_id for r in out.collect())
    assert language.identify(none).collect() == [] and language.accept(none).collect() == []


def syllables(seed):
    r = random.Random(seed)
    return ["".join(r.choice("bcdfghjklmnpqrstvwxzäöüßøåéèñç") + r.choice("aeiouyăęįơ") for _ in range(2)) for _ in range(4)]


def own_text(tag, seed, n=60):
    r = random.Random(seed)
    return " ".join("".join(r.choice(syllables(tag)) for _ in range(r.randint(1, 3))) for _ in range(n))


def test_languages_have_no_share_and_no_number_to_reach(spark):
    r, rows = random.Random(4), []
    for i in range(66):         # each with enough text
        rows += [(len(rows) + k, own_text(f"l{i}", 100 * i + k, 1500), f"l{i}", None) for k in range(2)]
    rows += [(10000 + i, "ka lo mi tu", "aa", None) for i in range(4000)] + [(30000 + i, text("aa", i, 400), "aa", None) for i in range(6)]
    r.shuffle(rows)             # two rows of 4,138 are less than 0.05 %
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {x.doc_id: x for x in language.identify(docs).collect()}
    wrong = [d for d, _, said, _ in rows if got[d].language != said or not got[d].accepted]
    assert wrong == []


def test_a_tag_with_too_little_text_is_no_reason_to_reject(spark):
    rare = "漢字仮名交じり文" * 30
    rows = corpus() + [(1000, rare, "ja", "one"), (1001, text("bb", 9), "zz", None), (1002, "12 34", "ja", None), (1003, rare, "und", None)]
    got = {r.doc_id: (r.language, r.accepted) for r in language.identify(spark.createDataFrame(rows, SCHEMA)).collect() if r.doc_id >= 1000}
    assert got == {1000: ("ja", True), 1001: ("bb", True), 1002: ("und", False), 1003: ("und", False)}


def test_without_declarations_nothing_is_rejected_for_its_language(spark):
    docs = spark.createDataFrame([(1, text("aa", 1), None, "a"), (2, "12 34", None, "a")], SCHEMA)
    assert [r.doc_id for r in language.accept(docs).collect()] == [1]
