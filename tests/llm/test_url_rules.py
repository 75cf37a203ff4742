from decantry.llm.queries import URL_RULES
from decantry.llm.url_rules import Mining, fitted, judge, mine, tokens_of
from pyspark.sql import functions as F

URLS = "page_id long, url string"


def pages(spark, urls):
    return spark.createDataFrame(list(enumerate(urls)), URLS)


def no_rules(spark):
    return spark.sql("select array('x') as tokens, array(array('x')) as groups, 1.0D as confidence where false")


def test_given_rules(spark):
    cases = {
        "http://a.com/x": ("a.com", "/x", "com/", "allow"),
        "http://A.Example.COM/en/1?q#f": ("a.example.com", "/en/1", "example.com/en/", "block"),
        "http://m.www.example.com/en/": ("m.www.example.com", "/en/", "www.example.com/en/", "allow"),
        "x://b.net/es/": ("b.net", "/es/", "net/es/", "block"),
        "x://net/fr/2": ("net", "/fr/2", "net/fr/", "block"),
        "x://cabernet/fr/2": ("cabernet", "/fr/2", None, "allow"),
        "http://a.com": ("a.com", "", None, "allow"),
        "http://a.com?x=/": ("a.com", "", None, "allow"),
        "a.com/en/": ("", "", None, "allow"),
        "http://x://y/z": ("x:", "//y/z", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    rows = judge(pages(spark, cases), URL_RULES, no_rules(spark)).orderBy("page_id").collect()
    assert [tuple(r)[1:] for r in rows] == list(cases.values())


def test_tokens_have_no_digits_and_no_repeats(spark):
    url = "http://a.b1.a/x/22/x?id=3&id=4&=5#/y"
    row = pages(spark, [url]).select(tokens_of(F.col("url")).alias("t")).first()
    assert row.t == ["host:a", "host:b#", "path:x", "path:#", "name:id"]


def test_rules_are_mined_and_fit(spark):
    bad = [f"http://spam{i}.org/casino/{i}" for i in range(30)]
    good = [f"http://spam{i}.org/news/{i}" for i in range(30)] + [
        f"http://fine.org/casino/{i}?x=1" for i in range(8)
    ]
    labelled = spark.createDataFrame(
        [(u, True) for u in bad] + [(u, False) for u in good] + [(None, True), ("http://z/", None)],
        "url string, block boolean",
    )
    mined = mine(labelled, Mining(support=0.01, pages=20, confidence=0.7))
    sets = {tuple(r.tokens): r.confidence for r in mined.collect()}
    assert ("host:spam#", "path:casino") in sets
    assert sets["host:spam#", "path:casino"] == 1.0
    assert ("host:spam#",) not in sets  # half of them are good
    new = pages(spark, ["http://spam9.org/casino/x", "http://spam9.org/news", "http://ok.net/casino"])
    got = {r.url for r in fitted(new, mined).collect()}
    want = {
        r.url
        for r in new.withColumn("t", tokens_of(F.col("url"))).collect()
        if any(all(set(g) & set(r.t) for g in rule.groups) for rule in mined.collect())
    }
    assert got == want and "http://spam9.org/casino/x" in got
    verdicts = judge(new, URL_RULES, mined).orderBy("page_id").collect()
    assert [v.verdict for v in verdicts] == ["block" if r in got else "allow" for r in
                                             [x.url for x in new.orderBy("page_id").collect()]]


def test_support_is_the_same_however_many_urls_there_are(spark):
    bad = [(f"http://rare{i % 3}.net/x", True) for i in range(20)]
    good = [(f"http://site{chr(97 + i % 20)}.org/{i}", False) for i in range(5000)]
    for rows in (bad, bad + good):
        mined = mine(spark.createDataFrame(rows, "url string, block boolean"))
        got = fitted(pages(spark, ["http://rare9.net/", "http://sitea.org/1"]), mined).collect()
        assert [r.url for r in got] == ["http://rare9.net/"]


def test_tokens_that_always_occur_together_are_one_item(spark):
    names = "&".join(f"p{chr(97 + k)}{chr(97 + k)}=1" for k in range(25))
    rows = [(f"http://long.org/?{names}", True)] * 25 + [("http://long.org/", False)] * 3
    mined = mine(spark.createDataFrame(rows, "url string, block boolean"))
    rules = {tuple(sorted(map(len, r.groups))) for r in mined.collect()}
    assert rules == {(25,), (2,), (2, 25)}  # the names; the host's two parts; both
    new = pages(spark, ["http://x.net/?pcc=2", "http://y.net/?q=1"])
    assert [r.url for r in fitted(new, mined).collect()] == ["http://x.net/?pcc=2"]


def test_few_labels_give_no_rules_and_repeated_rows_stay(spark):
    labelled = spark.createDataFrame([("http://a/b", True)] * 5, "url string, block boolean")
    assert mine(labelled).count() == 0
    assert mine(labelled.limit(0)).count() == 0
    same = spark.createDataFrame([(1, "http://a.com/")] * 3 + [(None, None)], URLS)
    assert judge(same, URL_RULES, mine(labelled)).count() == 4
    clashing = same.selectExpr("*", "1 as host", "2 as path", "3 as blocked_url", "4 as rule")
    assert judge(clashing, URL_RULES, no_rules(spark)).count() == 4
    assert judge(same.limit(0), URL_RULES, no_rules(spark)).count() == 0


def test_no_python_runs(spark):
    labelled = spark.createDataFrame([("http://a/b", True)] * 30, "url string, block boolean")
    plan = judge(pages(spark, ["http://a/b"]), URL_RULES, mine(labelled))
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString().replace("PythonRDD", "")
