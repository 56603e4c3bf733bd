import random

from pyspark.sql import functions as F

from lotmarket.llm import url_rules
from lotmarket.llm.url_query import RULES

URLS = {
    "http://a.com/x": ("a.com", "/x", "com/", "allow"), "https://WWW.Example.COM/en/1?q#f": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
    "http://m.example.com/en/": ("m.example.com", "/en/", "example.com/en/", "block"), "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
    "http://x.net/fr/a://b": ("x.net", "/fr/a://b", "net/fr/", "block"), "x://y.net/es": ("y.net", "/es", None, "allow"), "http://a.com": ("a.com", "", None, "allow"),
    "http://a.com?/x": ("a.com", "", None, "allow"), "no scheme.com/": ("", "", None, "allow"), "": ("", "", None, "allow"), None: ("", "", None, "allow"),
    "http://net/es/": ("net", "/es/", "net/es/", "block"), "http://a.com:80/x": ("a.com:80", "/x", None, "allow"), "://": ("", "", None, "allow"),
    "http://a.com/\n/x": ("a.com", "/\n/x", "com/", "allow"), "http://e.com/" + "long/" * 20000: ("e.com", "/" + "long/" * 20000, "com/", "allow"),
}


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_explicit_rules(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate([*URLS, *URLS])], "page_id bigint, url string").withColumn("host", F.lit("x")).withColumn("features", F.lit(1))
    pages = pages.withColumn("__signature", F.lit(2)).withColumn("__features", F.lit(3)).withColumn("__explicit", F.lit(4)).withColumn("rule_confidence", F.lit(5))
    got = url_rules.judge(pages, labels(spark, []), RULES).collect()
    assert len(got) == 2 * len(URLS)
    for r in got:
        assert (r["features"], r["__signature"], r["__features"], r["__explicit"], r["rule_confidence"]) == (1, 2, 3, 4, None)
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == URLS[r["url"]]


def sites(n=600):
    rng, pages, told = random.Random(4), [], []
    for i in range(n):
        site, word = rng.choice(["news", "shop", "blog"]), rng.choice(["pills", "books", "cars"])
        pages.append((i, f"http://{site}.site{i % 7}.org/{word}/{i}"))
        bad = site == "shop" and word == "pills"
        if i % 2:
            told.append((i, 0 if bad and i % 4 == 1 else 1, 1 if bad and i % 4 == 3 else 0))
    return pages, told + [(1, None, None), (None, 0, 1), (10**9, 0, 0)]


def test_mined_rules_match_as_by_brute_force(spark):
    pages, told = sites()
    frame = spark.createDataFrame(pages + [(5, None)], "page_id bigint, url string")
    got = url_rules.judge(frame, labels(spark, told), (), min_support=0.01).collect()
    assert len(got) == len(pages) + 1
    for r in got:
        assert (r["verdict"] == "block") == (r["url"] is not None and "shop" in r["url"] and "pills" in r["url"]), r
    rows = frame.withColumn("features", url_rules.features(F.col("url"), url_rules.host_of(F.col("url")), url_rules.path_of(F.col("url"))))
    rules = spark.createDataFrame([(["h:shop"], 0.7), (["h:blog", "p:cars"], 0.9), (["d:site3.org", "h:shop", "p:books"], 0.8)], "antecedent array<string>, confidence double")
    held = [(set(r["antecedent"]), r["confidence"]) for r in rules.collect()]
    for r in url_rules.match(rows, rules).collect():
        fits = [c for a, c in held if a <= set(r["features"])]
        assert r["rule_confidence"] == (max(fits) if fits else None)


def test_pruning(spark):
    rules = spark.createDataFrame([(["a"], 1, 0.9, 0.1), (["a", "b"], 2, 0.9, 0.1), (["a", "c"], 2, 0.95, 0.1), (["b", "c"], 2, 0.8, 0.1)],
                                  "antecedent array<string>, n_items int, confidence double, support double")
    assert sorted(r[0] for r in url_rules._pruned(rules).collect()) == [["a"], ["a", "c"], ["b", "c"]]


def test_empty(spark):
    assert url_rules.judge(spark.createDataFrame([], "page_id bigint, url string"), labels(spark, []), RULES).collect() == []


def judged(spark, urls, bad):
    """The verdict of every URL; those at an index of ``bad`` are labelled bad, all others good."""
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    told = labels(spark, [(i, 0 if i in bad else 1, 0) for i in range(len(urls))])
    return {r["page_id"]: r["verdict"] for r in url_rules.judge(pages, told, (), min_support=0.01).collect()}


def test_tokens_anywhere_in_the_url(spark):
    rng, urls, bad = random.Random(9), [], set()
    for i in range(400):
        kind = i % 8
        path, keys, host = [f"w{rng.randrange(40)}" for _ in range(6)], [f"k{rng.randrange(40)}" for _ in range(6)], "www.x.org"
        if kind == 0:
            path = ["2024", "01", "15", "cheap-pills", "buy"]
        elif kind == 1:
            keys[5] = "spamkey"
        elif kind == 2:
            host = "farm.a.b.c.d.x.org"
        if kind < 3:
            bad.add(i)
        urls.append(f"http://{host}/" + "/".join(path) + "?" + "&".join(f"{k}=1" for k in keys))
    assert {i for i, v in judged(spark, urls, bad).items() if v == "block"} == bad


def test_deep_common_path_is_one_item(spark):
    deep = "/".join(f"d{k}" for k in range(40))
    urls = [f"http://bad.org/{deep}/{i}" if i % 2 else f"http://good.org/x/{i}" for i in range(100)]
    assert {i for i, v in judged(spark, [*urls, "http://else.org/d39"], {i for i in range(100) if i % 2}).items() if v == "block"} == {*range(1, 100, 2), 100}


def test_rules_over_items_are_not_spelled_out(spark):
    """Items of many features: a rule stays one row, and any feature of each item is enough."""
    rules = spark.createDataFrame([(["i0", "j0", "k0"], 0.9), (["j0"], 0.75)], "antecedent array<string>, confidence double")
    groups = spark.createDataFrame([(f"{g}{n}", f"{g}0") for g in "ijkl" for n in range(30)], "feature string, item string")
    rng = random.Random(2)
    lists = [[f"{g}{rng.randrange(40)}" for g in rng.sample("ijkl", rng.randrange(5))] for _ in range(200)]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "id bigint, features array<string>")
    got = {r["id"]: r["rule_confidence"] for r in url_rules.match(rows, rules, groups=groups).collect()}
    for i, x in enumerate(lists):
        held = {f[0] for f in x if int(f[1:]) < 30}
        assert got[i] == (0.9 if held >= set("ijk") else 0.75 if "j" in held else None)
    assert {0.9, 0.75, None} == set(got.values())


def test_long_urls_meet_mined_rules(spark):
    pages, told = sites()
    long = [(10_000 + i, f"http://shop.site1.org/{'deep/' * 5000}{w}/x") for i, w in enumerate(["pills", "books"])]
    frame = spark.createDataFrame(pages + long, "page_id bigint, url string").withColumn("features", F.lit("mine"))
    got = {r["page_id"]: r for r in url_rules.judge(frame, labels(spark, told), (), min_support=0.01).where("page_id >= 10000").collect()}
    assert got[10_000]["verdict"] == "block" and got[10_001]["verdict"] == "allow" and got[10_000]["features"] == "mine"
