import random

import pytest

from shelfwise.llm.url_filter import filter_urls
from tests.llm.helpers import bag, with_clashes

RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
    ("a.example.org", "", "block"),
    ("example.org", "/en", "block"),
    ("Example.Org", "/en/x/y", "allow"),
    ("", "/odd/", "block"),
    ("deep.a.b.c.d.e.example", "/1/2/3/4/", "block"),
]


def pages(spark, urls):
    return spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")


def rules(spark, rows=RULES):
    return spark.createDataFrame(rows, "host string, path string, verdict string")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = lower(rest[:end]), rest[end:]
    return host, rest[: min([rest.index(c) for c in "?#" if c in rest], default=len(rest))]


def brute(url, rows, default="allow"):
    """Every rule tried on the whole URL."""
    host, path = split(url)
    fits = []
    for rule_host, rule_path, verdict in rows:
        if None in (rule_host, rule_path, verdict):
            continue
        rule_host = lower(rule_host)
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path):
            fits.append((len(rule_host + rule_path), len(rule_host), verdict == "block", rule_host + rule_path, verdict))
    best = max(fits, default=(0, 0, 0, None, default))
    return host, path, best[3], best[4]


def check(spark, urls, rows=RULES, **options):
    found = filter_urls(pages(spark, urls), rules(spark, rows), **options)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found.collect()}
    assert got == {i: brute(url, rows, **options) for i, url in enumerate(urls)}


ODD = [
    None,
    "",
    "example.net/en/1",
    "://",
    "http://",
    "http:///odd/1",
    "http://NET",
    "http://net/",
    "http://x.net?q=/en/",
    "HTTP://X.Example.NET/en/a#b?c",
    "http://x.example.net/en",
    "http://xexample.com/de/",
    "http://example.com./de/",
    "http://u:p@h.example.com:80/de/",
    "http://a.org/fr/http://b.net/",
    "http://a.example.org",
    "http://b.a.example.org/en/x/yz?",
    "http://example.org/english",
    "http://EXAMPLE.org/en/x/y/z",
    "http://example.org/EN/",
    "http://h.deep.a.b.c.d.e.example/1/2/3/4/5",
    "http://a\nb.net/\n/x",
    "http://Ä.net/é",
    "http://..net//",
]


def test_odd_urls(spark):
    check(spark, ODD)
    check(spark, ODD, default="block")


def test_random_rules_and_urls(spark):
    rng = random.Random(5)
    label, part = (lambda: rng.choice("ab")), (lambda: rng.choice(["", "x", "xy"]))
    host = lambda: ".".join(label() for _ in range(rng.randrange(1, 5)))
    path = lambda: "".join("/" + part() for _ in range(rng.randrange(4)))
    rows = [(host(), path(), rng.choice(["allow", "block"])) for _ in range(40)]
    check(spark, [f"http://{host()}{path()}{rng.choice(['', '?q', '#f'])}" for _ in range(1500)], rows)


def test_very_long_urls(spark):
    urls = ["http://" + "a." * 50_000 + "example.net/en/" + "d/" * 50_000, "x" * 300_000, "http://n.net/" + "q" * 300_000]
    check(spark, urls)


def test_a_hot_host_is_dealt_out(spark):
    """A third of all URLs are one, and all of one host; the other rows are told apart by their id."""
    urls = ["http://hot.example.net/de/1"] * 2000 + [f"http://h{i}.example.com/de/{i}" for i in range(4000)]
    check(spark, urls)


def test_rules_with_nulls_repeats_and_none(spark):
    check(spark, ODD, [(None, "/", "block"), ("net", None, "block"), ("org", "/", None), ("com", "/", "block"), ("com", "/", "block")])
    check(spark, ODD, [("net", "/", "allow"), ("net", "/", "block")])
    check(spark, ODD, [])


def test_empty_table_repeated_rows_and_clashing_names(spark):
    assert filter_urls(pages(spark, []), rules(spark)).count() == 0
    one = pages(spark, ["http://a.net/"])
    assert [r.verdict for r in filter_urls(one.unionAll(one), rules(spark)).collect()] == ["block", "block"]
    names = ("host", "rule", "verdict", "tail", "turn", "judged_tail", "suffix", "digest")
    clashing = filter_urls(with_clashes(pages(spark, ODD), *names), rules(spark))
    assert clashing.columns == ["page_id", "url", *names, "_host", "path", "_rule", "_verdict"]
    plain = filter_urls(pages(spark, ODD), rules(spark))
    assert bag(clashing.select("page_id", "_host", "path", "_rule", "_verdict")) == bag(plain.drop("url"))


@pytest.mark.parametrize("kind", ["map<string,int>", "array<int>", "variant"])
def test_other_types_of_columns(spark, kind):
    docs = pages(spark, ["http://a.net/"]).selectExpr("*", f"CAST(NULL AS {kind}) AS more")
    assert filter_urls(docs, rules(spark)).select("verdict").first()[0] == "block"
