import random
import re

import pytest
from pyspark.sql import functions as F

from granary.llm import bloom, urls


def by_hand(url, rules):
    found = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in found[1]) if found else ""
    path = found[2] if found else ""
    fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[1], best[2] if best else "allow"


URLS = [
    None, "", "no scheme", "http://net/", "HTTP://A.Example.NET/en/x?y#z", "http://a.example.net/de/", "https://notnet/", "x://y.net", "x://y.net?q=/en/",
    "http://example.com/de/1", "http://example.com/DE/1", "http://m.example.com/de", "http://wiki.org/fr/a", "http://a://b.net/", "http:///en/", "http://..net/", "http://É.NET/en/", "a" * 5000 + "://b.net/" + "c" * 5000,
    "http://example.net/en/", "http://xexample.net/en/", "http://net.org/fr/#",
]


def test_equals_a_loop_over_the_rules(spark):
    frame = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(URLS)] + [(0, None, "clash"), (None, "http://b.net/", "x")], "page_id long, url string, verdict string")
    found = urls.judge_urls(frame, urls.rule_frame(spark)).collect()
    assert len(found) == len(URLS) + 2
    for r in found:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == by_hand(r["url"], urls.RULES), r["url"]


def test_many_rules(spark):
    rng = random.Random(1)
    host = lambda: ".".join(rng.choice("abc") for _ in range(rng.randrange(1, 4)))
    path = lambda: "/" + "".join(rng.choice("xy/") for _ in range(rng.randrange(0, 4)))
    rules = list({(h, p): (h, p, rng.choice(["block", "allow"])) for h, p in ((host(), path()) for _ in range(60))}.values())
    frame = spark.createDataFrame([(i, f"http://{host()}{path()}") for i in range(400)], "page_id long, url string")
    for r in urls.judge_urls(frame, urls.rule_frame(spark, rules)).collect():
        assert r["verdict"] == by_hand(r["url"], rules)[3]
        assert len(r["rule"] or "") == len(by_hand(r["url"], rules)[2] or "")


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(5000).select(F.concat(F.lit("key"), "id").alias("key"), (F.col("id") % 9 == 0).alias("listed")).cache()
    cascade = urls.build_cascade(universe, "listed")
    assert len(cascade.levels) > 1
    assert universe.filter(cascade.lists(F.col("key")) != F.col("listed")).isEmpty()


def test_no_pages_and_no_rules(spark):
    frame = spark.createDataFrame([(1, "http://b.net/")], "page_id long, url string")
    rules = urls.rule_frame(spark)
    assert urls.judge_urls(frame.limit(0), rules).count() == 0
    assert urls.judge_urls(frame, rules.limit(0)).first()["verdict"] == "allow"


def test_a_list_beyond_the_bound_is_refused(spark, monkeypatch):
    monkeypatch.setattr(urls, "MAX_BITS", 64)
    universe = spark.range(2000).select(F.col("id").cast("string").alias("key"), (F.col("id") < 100).alias("listed"))
    with pytest.raises(ValueError, match="split the list"):
        urls.build_cascade(universe, "listed")
    assert bloom.bits_for(100, 0.01) % 64 == 0
