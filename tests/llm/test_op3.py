"""URL filters against direct matching of every rule."""

import re

from freshet.llm import op3_url_filters as op

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def expected(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host, path = re.match(r"([^/?#]*)([^?#]*)", rest, re.S).groups()
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, *max(fits)[1:]
    bad = any(re.search(rf"(^|[.-]){r.name}([.-]|$)", host) for r in op.PATTERN_RULES)
    return host, path, None, "block" if bad else "allow"


URLS = [
    None, "", "no scheme/at/all", "http://", "://", "http://org", "http://org/", "http://ORG/x", "http://a.org?x=/", "http://aorg/", "http://borg.org/x#y",
    "https://example.org/es/1", "https://www.Example.org/en/12?x", "https://example.org/en/2", "https://notexample.org/es/", "http://example.org.com/de/",
    "http://x.com/fr/", "http://x.com/fr", "http://com/de/x", "http://X.COM/DE/x", "http://cheap-pills.net/a", "http://a.cheap-pills.net", "http://cheap.pills.net/",
    "http://acheap-pills.net/", "http://net/cheap-pills/", "http://www.casino.net", "http://É.com/de/ü?", "a://b://example.org/es/", "http://u@x.com:80/de/", "http://x\n.org/\ny",
    "http://" + "a" * 100_000 + ".com/de/" + "b" * 100_000, "http://a.b.c.d.example.org/en/1", "http://.org/", "http://free-bets", "http://free-bets?casino",
]


def test_edge_urls(spark):
    rows = [(i, u, "clash") for i, u in enumerate(URLS)] + [(None, "http://x.com/de/", "x")] * 2
    got = op.judge(spark.createDataFrame(rows, "page_id long, url string, host string")).collect()
    assert len(got) == len(rows)
    for r in got:
        want = expected(URLS[r["page_id"]] if r["page_id"] is not None else "http://x.com/de/")
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == want, r


def test_index_files_rules_under_their_rarest_token(spark):
    places = spark.createDataFrame([("a.example.org/x",), ("b.example.org/y",), ("example.net/en/",)], "place string")
    counts = op.token_counts(places, op.PATH_RULES)
    assert counts["example"] == 3 and counts["org"] == 2 and counts["es"] == 0
    index = op.index_of(op.PATH_RULES, counts)
    assert [r.name for r in index["en"]] == ["example.org/en/1"] and [r.name for r in index["es"]] == ["example.org/es/"]
    assert "1" not in {t for r in op.PATH_RULES for t in r.tokens}


def test_plan_has_no_python_and_one_scan(spark, capsys):
    df = op.op3_url_filters(spark, "/root/testdata/sf0.001")
    df.explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Exchange" not in plan and plan.count("Scan") == 1


def test_rule_without_token_and_no_rules(spark):
    df = spark.createDataFrame([(1, "http://x.net/--/"), (2, "http://x.net/")], "page_id long, url string")
    bare = (op.Rule("dashes", "block", "--", ()),)
    assert {r["page_id"]: r["verdict"] for r in op.judge(df, (), bare).collect()} == {1: "block", 2: "allow"}
    assert {r["verdict"] for r in op.judge(df, (), ()).collect()} == {"allow"}
    assert op.judge(df.limit(0)).count() == 0


def test_rules_as_a_table_on_the_edge_urls(spark, monkeypatch):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(None, "http://x.com/de/")] * 2
    df = spark.createDataFrame(rows, "page_id long, url string")
    bare = (*op.PATTERN_RULES, op.Rule("dashes", "block", "--", ()))
    literal = sorted(map(str, op.judge(df, pattern_rules=bare).collect()))
    monkeypatch.setattr(op, "LITERAL_RULES", 0)
    assert sorted(map(str, op.judge(df, pattern_rules=bare).collect())) == literal
    assert {r["verdict"] for r in op.judge(df, (), ()).collect()} == {"allow"} and op.judge(df.limit(0)).count() == 0


def test_twenty_thousand_rules_against_direct_matching(spark, capsys):
    hosts = [f"h{i % 4000}.{('net', 'org', 'com')[i % 3]}" for i in range(20_000)]
    rules = {(h, f"/p{i % 13}/" if i % 4 else "/"): ("allow", "block")[i % 2] for i, h in enumerate(hosts)}
    rules |= {(f"deep{i}.h{i}.net", "/a"): "block" for i in range(20_000 - len(rules))}
    assert len(rules) >= 15_000
    made = tuple(op.path_rule(v, h + p) for (h, p), v in rules.items())
    urls = [f"http://{('', 'www.', 'a.b.')[i % 3]}h{i * 7 % 4100}.{('net', 'org', 'com')[i % 3]}/p{i % 17}/x" for i in range(2000)]
    urls += [f"http://deep{i}.h{i}.net/{'ab'[i % 2]}" for i in range(0, 3000, 7)] + urls[:1] * 3000
    df = op.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), made, ())
    df.explain()
    assert "Python" not in capsys.readouterr().out
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in df.collect()}
    assert len(got) == len(urls)
    hits = 0
    for i, u in enumerate(urls):
        host, path = u[7:].partition("/")[0], "/" + u[7:].partition("/")[2]
        labels = host.split(".")
        tails = [".".join(labels[k:]) for k in range(len(labels))]
        fits = [(len(h + path[:e]), h + path[:e], rules[h, path[:e]]) for h in tails for e in range(1, len(path) + 1) if (h, path[:e]) in rules]
        assert got[i] == (max(fits)[1:] if fits else (None, "allow")), u
        hits += bool(fits)
    assert hits > 1000
