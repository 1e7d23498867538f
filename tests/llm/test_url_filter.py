import math
import random

from pyspark.sql import functions as F
from samples import CLASHES

from tidemark.llm import url_filter
from tidemark.llm.url_filter import DEVIATIONS, MOST_BAD, RULES, STRENGTH, judge_urls, with_levels, with_parts

PAGES = "page_id long, url string"


def split(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((i for i, c in enumerate(rest) if c in "/?#"), default=len(rest))
    host, tail = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end]), rest[end:]
    stop = min((i for i, c in enumerate(tail) if c in "?#"), default=len(tail))
    return host, tail[:stop]


def rule(host, path):
    fits = [(len(text), said, text) for said, text in RULES if (host == text.split("/")[0] or host.endswith("." + text.split("/")[0])) and path.startswith(text[text.index("/") :])]
    return max(fits)[1:] if fits else (None, None)


def spread(groups):
    over = sum((k - n * p) ** 2 - n * p * (1 - p) for n, k, p in groups)
    scale = sum(n * (n - 1) * p * (1 - p) for n, k, p in groups)
    return STRENGTH if not scale else 1 / min(max(over / scale, 1e-4), 0.99) - 1


def brute_bounds(pages, bad):
    """Bounds by host name for names of plain labels."""
    hosts = {}
    for page_id, url in pages:
        n, k = hosts.get(split(url)[0], (0, 0))
        hosts[split(url)[0]] = (n + 1, k + bad[page_id]) if page_id in bad else (n, k)
    total = [sum(x) for x in zip(*hosts.values(), strict=True)]
    above = {"": (total[1] + 0.5) / (total[0] + 1)}
    for labels in (1, 2):
        sums = {}
        for h, (n, k) in hosts.items():
            name = ".".join(h.split(".")[-labels:])
            a, b = sums.get(name, (0, 0))
            sums[name] = (a + n, b + k)
        prior = {g: above["" if labels == 1 else g.split(".")[-1]] for g in sums}
        s = spread([(n, k, prior[g]) for g, (n, k) in sums.items()])
        above = {**(above if labels == 1 else {}), **{g: (k + s * prior[g]) / (n + s) for g, (n, k) in sums.items()}}
    prior = {h: above[".".join(h.split(".")[-2:])] for h in hosts}
    s = spread([(n, k, prior[h]) for h, (n, k) in hosts.items()])
    out = {}
    for h, (n, k) in hosts.items():
        a, b = k + s * prior[h], n - k + s * (1 - prior[h])
        mean = a / (a + b)
        out[h] = max(0.0, mean - DEVIATIONS * math.sqrt(mean * (1 - mean) / (a + b + 1)))
    return out


def sample():
    r = random.Random(3)
    hosts = ["a.one.com", "b.one.com", "two.com", "x.y.two.com", "spam.bad.org", "ok.bad.org", "example.net", "w.example.net", "q.example.com", "Example.COM", "notexample.net"]
    paths = ["", "/", "/en/1", "/de/2?x=/fr/", "/fr/#a", "?q=1", "#f/en/", "/EN/", "/en"]
    return [(i, f"{r.choice(['http', 'https'])}://{r.choice(hosts)}{r.choice(paths)}") for i in range(600)]


def test_parts_rules_and_bounds_against_brute_force(spark):
    pages = sample() + [(900, None), (901, ""), (902, "no scheme"), (903, "x://"), (904, "a://b://c/d"), (905, "http://two.com/é\n/x?\n"), (None, "http://two.com/"), (906, "http://two.com/"), (906, "http://two.com/")]
    r = random.Random(4)
    bad = {i: int(r.random() < (0.9 if u and "spam" in u else 0.1)) for i, u in pages if i is not None and r.random() < 0.6}
    outcomes = spark.createDataFrame([*bad.items(), (5, 0) if 5 in bad else (7_000, 1), (None, 1), (8_000, 1), (3, None)], "page_id long, bad int")
    table = spark.createDataFrame(pages, PAGES).withColumns({c: F.lit("x") for c in CLASHES if c != "url"})
    got = judge_urls(table, outcomes).collect()
    bounds = brute_bounds(pages, bad)
    wanted = []
    for i, u in pages:
        host, path = split(u)
        said, text = rule(host, path)
        wanted.append((str(i), host, path, str(text), said or ("block" if bounds[host] > MOST_BAD else "allow"), round(bounds[host], 9)))
    assert sorted((str(g["page_id"]), g["host"], g["path"], str(g["rule"]), g["verdict"], round(g["bound"], 9)) for g in got) == sorted(wanted)
    assert {g["verdict"] for g in got if g["host"] == "spam.bad.org" and g["rule"] is None} == {"block"}
    assert {g["verdict"] for g in got if g["host"] == "ok.bad.org" and g["rule"] is None} == {"allow"}


def test_frequent_hosts_do_not_change_the_result(spark, monkeypatch):
    pages, outcomes = spark.createDataFrame(sample(), PAGES), spark.createDataFrame([(i, i % 3 == 0) for i in range(300)], "page_id long, bad boolean").withColumn("bad", F.col("bad").cast("int"))
    plain = sorted(map(tuple, judge_urls(pages, outcomes).collect()), key=str)
    monkeypatch.setattr(url_filter, "HOT_SHARE", 0.1)
    assert sorted(map(tuple, judge_urls(pages, outcomes).collect()), key=str) == plain


def test_levels(spark):
    hosts = ["u:p@Shop.Example.co.uk:8080", "co.uk", "10.0.0.7:80", "localhost", "", "[::1]:8"]
    rows = with_levels(with_parts(spark.createDataFrame([(i, f"http://{h}/") for i, h in enumerate(hosts)], PAGES)), ["co.uk"]).orderBy("page_id").collect()
    assert [(r["name"], r["domain"], r["suffix"]) for r in rows] == [
        ("shop.example.co.uk", "example.co.uk", "co.uk"), ("co.uk", "co.uk", "co.uk"), ("10.0.0.7", "10.0.0.7", "ip"), ("localhost", "localhost", "localhost"), ("", "", ""), ("[::1]", "[::1]", "ip"),
    ]


def test_empty(spark):
    pages, outcomes = spark.createDataFrame(sample(), PAGES), spark.createDataFrame([], "page_id long, bad int")
    assert judge_urls(pages.where("false"), outcomes).collect() == []
    got = judge_urls(pages, outcomes)
    assert got.count() == 600 and {round(r["bad_share"], 6) for r in got.select("bad_share").distinct().collect()} == {0.5}
