import random

from corpus import DOCUMENTS, with_clashes
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfrank.llm import language_id

PAGES = "page_id long, url string, html string"
SYLLABLES = {
    "en": "th er ing and wh ly ou st".split(),
    "fr": "eau que oi è é aux ment ou".split(),
    "de": "sch ung ich keit ü ö pf der".split(),
}


def text(rng, lang, words):
    parts = SYLLABLES[lang]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(words))


def model(spark):
    rng = random.Random(14)
    rows = [(k, text(rng, lang, 40), lang, "a", 1) for k, lang in enumerate(list(SYLLABLES) * 20)]
    rows += [(None, "x", "en", "a", 1), (99, None, "en", "a", 1), (98, "x y z", None, "a", 1)]
    return language_id.fit_text_model(with_clashes(spark.createDataFrame(rows, DOCUMENTS)))


def page(body, lang=None):
    mark = f' lang="{lang}"' if lang else ""
    return f"<!DOCTYPE html><html{mark}><head><script>var the = 1 < 2;</script></head><p>{body}</p></html>"


def identified(spark, rows):
    df = with_clashes(spark.createDataFrame(rows, PAGES))
    return {r["page_id"]: r for r in language_id.identify(df, model(spark)).collect()}


def test_visible_text_and_declaration():
    html = '<html class=x lang="pt-BR"><style>p{}</style><!-- no --><p title="a">A&eacute;b<br>c</p>'
    assert language_id.visible_text(html).split() == ["Aéb", "c"]
    assert language_id.declared_language(html) == "pt"
    assert language_id.declared_language(None) == "" and language_id.visible_text(None) == ""


def test_hosts(spark):
    urls = ["https://www.Site.example.de:8080/x", "http://u@h.org?q", "ftp://a.b./", "no address", "", None]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = [r["h"] for r in df.select(language_id.host_of(F.col("url")).alias("h")).collect()]
    assert got == ["www.site.example.de", "h.org", "a.b", "", "", ""]


def test_text_decides_where_there_is_enough(spark):
    rng = random.Random(15)
    rows, want = [], {}
    for k in range(60):
        lang = rng.choice(list(SYLLABLES))
        want[k] = lang
        rows.append((k, f"http://h{k % 7}.example.com/", page(text(rng, lang, 60), rng.choice([lang, None, "en"]))))
    found = identified(spark, rows)
    assert {k: r["lang"] for k, r in found.items()} == want


def test_host_domain_suffix_and_declaration_decide_without_text(spark):
    rng = random.Random(16)
    rows = []
    for k in range(30):
        rows.append((k, f"http://a{k % 3}.franc.fr/", page(text(rng, "fr", 50), "fr")))
        rows.append((100 + k, f"http://b{k}.deutsch.de/", page(text(rng, "de", 50), "de")))
    rows += [
        (500, "http://a0.franc.fr/", page("")), (501, "http://other.franc.fr/", page("123")),
        (502, "http://new.fr/", ""), (503, "http://unseen.de/", None),
        (504, "http://nowhere.com/", page("", "de")), (505, None, page("", "fr")),
    ]
    found = identified(spark, rows)
    assert [found[k]["lang"] for k in range(500, 506)] == ["fr", "fr", "fr", "de", "de", "fr"]
    assert found[500]["probability"] > found[502]["probability"]


def test_edge_cases(spark):
    rows = [(1, None, None), (1, None, None), (None, "http://x.fr/", page("eau que")), (2, "", "<"), (3, "x", "\ud7ff")]
    df = spark.createDataFrame(rows, PAGES)
    found = language_id.identify(df, model(spark)).collect()
    assert len(found) == len(rows) and all(0 < r["probability"] <= 1 for r in found)
    assert language_id.identify(df.limit(0), model(spark)).count() == 0
    empty = language_id.fit_text_model(spark.createDataFrame([], DOCUMENTS))
    assert {r["lang"] for r in language_id.identify(df, empty).collect()} == {None}


def test_sample_holds_the_least_hashes_of_every_language(spark):
    langs = F.when(F.col("id") % 3 > 0, "en").when(F.col("id") % 9 == 0, "de").otherwise("fr")
    ids = spark.range(20_000).select("id", langs.alias("lang"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"))
    placed = ids.withColumn("place", F.row_number().over(order))
    for n in (1, 700, 5000):
        want = placed.where(F.col("place") <= n).select("id", "lang")
        got = language_id._least_hashes(ids, n).select("id", "lang")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
