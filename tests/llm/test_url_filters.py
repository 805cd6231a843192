import random

from ticklake.llm import url_filters as U


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, path = rest[:cut], rest[cut:]
    path = path[:min((path.find(c) for c in "?#" if c in path), default=len(path))]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def brute(rows, rules, default="allow"):
    out = []
    for i, url in rows:
        host, path = split(url)
        best = None
        for verdict, rule in rules:
            r_host, _, r_path = rule.partition("/")
            r_path = "/" + r_path if "/" in rule else ""
            if host and r_host and (host == r_host or host.endswith("." + r_host)) and path.startswith(r_path):
                order = (len(r_host) + len(r_path), len(r_host), verdict == "block", rule)
                best = max(best, (order, rule, verdict)) if best else (order, rule, verdict)
        out.append((i, host, path, best[1] if best else None, best[2] if best else default))
    return sorted(out, key=str)


def ours(spark, rows, rules):
    df = spark.createDataFrame(rows, "page_id long, url string") if isinstance(rows, list) else rows
    return sorted((tuple(r) for r in U.judge_urls(df, U.rule_table(spark, rules)).collect()), key=str)


def test_contract_rules(spark):
    urls = ["http://example.com/en/1", "https://WWW.Example.com/en/x?y=/z", "http://www.example.com/de", "http://a.net/es/", "http://net/es/1", "http://net/es",
            "http://xnet/es/", "http://notexample.com/en/", "http://com", "http://com/", "http://a.b.com#f/", None, "", "no scheme", "x://", "ftp:///only/path",
            "http://a.net/fr/?q", "http://É.com/é", "a://b://c.com/", "http://example.com./en/", "http://example.com/en/\nnext", "http://u@example.com:80/en/"]
    rows = list(enumerate(urls))
    got = {r[0]: r[1:] for r in ours(spark, rows, U.RULES)}
    assert sorted(((i, *r) for i, r in got.items()), key=str) == brute(rows, U.RULES)
    assert got[0] == ("example.com", "/en/1", "example.com/en/", "block") and got[1][2:] == ("www.example.com/en/", "allow")
    assert got[11] == ("", "", None, "allow") and got[4][2:] == ("net/es/", "block") and got[6][2] is None


def test_nested_rules_like_brute_force(spark):
    rng = random.Random(4)
    labels, parts = ["a", "b", "com", "net", "www"], ["", "x", "y", "xy", "x/"]
    rules = {}
    for _ in range(60):
        rules[".".join(rng.choice(labels) for _ in range(rng.randrange(1, 4))) + rng.choice(["", "/", "/", "/"]) + rng.choice(parts)] = rng.choice(["allow", "block"])
    rules = [(v, r) for r, v in rules.items()]
    rows = [(i, f"http://{'.'.join(rng.choice(labels) for _ in range(rng.randrange(1, 5)))}/{rng.choice(parts)}{rng.choice(parts)}") for i in range(800)]
    got, want = ours(spark, rows, rules), brute(rows, rules)
    assert [g[:3] + g[4:] for g in got] == [w[:3] + w[4:] for w in want] and got == want


def test_hot_host_empty_and_other_columns(spark):
    rows = [(i % 50, "http://hot.net/es/1", "h", "p") for i in range(500)]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, key string")
    assert ours(spark, df, U.RULES) == brute([r[:2] for r in rows], U.RULES)
    assert ours(spark, df.limit(0), U.RULES) == []
    assert all(r[3:] == (None, "allow") for r in ours(spark, df, []))
