from tidewater.llm import url_reputation as ur


def test_rules_hosts_and_paths(spark):
    urls = {
        1: "http://A.B.Example.ORG/es/x?q#f", 2: "https://example.org/en/12#top", 3: "x://foo.com/fr/", 4: "x://foo.com/fr", 5: "x://notcom/fr/", 6: "no scheme", 7: None, 8: "", 9: "a://h?x/y",
        10: "http://example.org", 11: "http://www.example.org/en/2", 12: "s://foo.com/de/", 13: "a://b://c/d",
    }
    pages = spark.createDataFrame(list(urls.items()), "page_id long, url string")
    none = spark.createDataFrame([], "page long, good int")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"]) for r in ur.judge(pages, none).collect()}
    assert got == {
        1: ("a.b.example.org", "/es/x", "example.org/es/"), 2: ("example.org", "/en/12", "example.org/en/1"), 3: ("foo.com", "/fr/", "com/fr/"), 4: ("foo.com", "/fr", None), 5: ("notcom", "/fr/", None), 6: ("", "", None),
        7: ("", "", None), 8: ("", "", None), 9: ("h", "", None), 10: ("example.org", "", None), 11: ("www.example.org", "/en/2", "org/"), 12: ("foo.com", "/de/", "com/de/"), 13: ("b:", "//c/d", None),
    }


def test_bad_hosts_are_blocked_and_few_labels_are_shrunk(spark):
    pages, outcomes = [], []
    for host, n, good in (("good.com", 40, 40), ("bad.com", 40, 0), ("one.com", 1, 0), ("new.com", 0, 0), ("fine.co.uk", 30, 29)):
        for i in range(max(n, 1)):
            pages.append((len(pages), f"http://www.{host}/x"))
            if n:
                outcomes.append((len(pages) - 1, int(i < good)))
    got = ur.judge(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(outcomes + outcomes[:3] + [(None, 1), (3, None)], "page long, good int"))
    bound = {r["host"]: (r["verdict"], r["bound"], r["n_labelled"]) for r in got.collect()}
    assert bound["www.good.com"][0] == "allow" and bound["www.bad.com"][0] == "block" and bound["www.good.com"][2] == 40
    assert bound["www.bad.com"][1] < bound["www.one.com"][1] < bound["www.good.com"][1]
    assert got.count() == len(pages)


def test_empty_table(spark):
    assert ur.judge(spark.createDataFrame([], "page_id long, url string"), spark.createDataFrame([], "page long, good int")).count() == 0


def test_quantile_of_the_beta_distribution(spark):
    """Against the share of draws under the quantile; and where the distribution has a closed form."""
    import numpy as np
    from pyspark.sql import functions as F

    cases = [(1.0, 1.0), (1.0, 3.0), (5.0, 1.0), (0.3, 2.0), (0.4, 0.6), (40.0, 3.0), (2000.0, 5000.0), (3e6, 1e6)]
    rows = spark.createDataFrame(cases, "a double, b double").select("a", "b", ur.beta_quantile(F.col("a"), F.col("b"), 0.05).alias("q")).collect()
    pick = np.random.default_rng(3)
    for r in rows:
        assert abs((pick.beta(r["a"], r["b"], 400_000) <= r["q"]).mean() - 0.05) < (0.002 if min(r["a"], r["b"]) >= 0.5 else 0.012), r
        if r["a"] == 1.0:
            assert abs(r["q"] - (1 - 0.95 ** (1 / r["b"]))) < 1e-4


def test_repeated_pages_null_ids_and_clashing_columns(spark):
    pages = spark.createDataFrame([(1, "a://h.com/", "x"), (1, "a://h.com/", "y"), (None, "a://h.com/p", "z")], "page_id long, url string, host string").withColumn("bound", ur.F.lit(1)).withColumn("page", ur.F.lit(2))
    got = ur.judge(pages, spark.createDataFrame([(1, 1), (None, 0)], "page long, good int")).collect()
    assert sorted((r["page_id"] or 0, r["host"], r["n_labelled"]) for r in got) == [(0, "h.com", 2), (1, "h.com", 2), (1, "h.com", 2)]
