"""Rules against a plain reading of urls, and what the templates learn."""

import re

from millrace.llm import urls

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def rule(host, path):
    fits = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


URLS = [
    None, "", "no scheme/en/", "http://", "http://net/", "http://NET", "https://a.example.net/en/1?x=/de/", "http://example.net/en",
    "http://xexample.net/en/", "http://sub.Example.COM/de/", "http://example.com/de", "http://fr.org/fr/a#b", "http://org/fr/",
    "http://h?x://net/", "ftp://a.org:80/fr/", "http://a.net?q", "http://É.net/ü", "://net/x", "http://a.net/" + "seg/" * 5000,
    "http://a.net/line\nbreak",
]


def test_rules_equal_a_plain_reading(spark):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS + URLS[:5])], "page_id long, url string, host string, segs string")
    rows = {r["page_id"]: r for r in urls.judge_urls(pages).collect()}
    assert len(rows) == len(URLS) + 5
    for i, url in enumerate(URLS + URLS[:5]):
        host, path = plain(url)
        name, verdict = rule(host, path)
        assert (rows[i]["host"], rows[i]["path"], rows[i]["rule"]) == (host, path, name), url
        assert rows[i]["verdict"] == verdict or verdict is None and rows[i]["verdict"] in ("allow", "block")


def test_templates_learn_from_labelled_pages(spark):
    listed = [f"http://spam.example.com/de/{i}.html" for i in range(60)]
    near = [f"http://spam.example.com/{i}.html" for i in range(3)]
    clean = [f"http://good.example.com/en/{w}{i}" for i in range(40) for w in ("story", "note")]
    mixed = [f"http://good.example.com/de/{i}" for i in range(40)]
    pages = spark.createDataFrame(list(enumerate([*listed, *near, *clean, *mixed])), "page_id long, url string")
    rows = urls.judge_urls(pages).collect()
    unlisted = {r["url"]: r for r in rows if r["rule"] is None}
    assert all(unlisted[u]["verdict"] == "block" for u in near)  # three pages beside sixty blocked ones
    assert all(unlisted[u]["verdict"] == "allow" for u in clean)
    assert {unlisted[u]["template"] for u in clean} == {"/en/*"}
    assert {r["template"] for r in rows if r["url"] in listed} == {"/de/{id}.html"}


def test_empty_table(spark):
    assert urls.judge_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0
