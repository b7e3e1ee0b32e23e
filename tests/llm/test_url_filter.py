import itertools
import random

from cases import same
from wideloom.llm import url_filter as uf
from wideloom.llm.queries import HOST_RULES, QUERIES

URLS = [None, "", "no scheme", "https://Example.ORG", "http://a.example.org/es/x?y#z", "x://example.org/en/19#t", "https://org/",
        "https://notexample.org/en/1", "ftp://q.com/fr/1?p=://z/", "https://com/de/9", "://h/p", "a://b://c/d", "http://?q", "http://#f",
        "HTTP://ÄÉ.Com/DE/", "http://x.com/de", "http://x.net/\npath?a=1&b&=3#", "http://user:pw@Host.net:80/p"]


def split(url):
    if not url or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    end = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    host, tail = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), rest[end:]
    return host, tail[:min([i for i in map(tail.find, "?#") if i >= 0], default=len(tail))]


def stated(host, path):
    fit = [r for r in HOST_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: len(r.text), default=None)


def test_hosts_paths_and_stated_rules(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    none = spark.createDataFrame([], "url string, block int")
    for r in uf.filtered(pages, HOST_RULES, none).collect():
        host, path = split(URLS[r.page_id])
        rule = stated(host, path)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule and rule.text, rule.verdict if rule else "allow")


def labelled(seed, n=300):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        site, part = rng.choice(["good", "spam", "mixed"]), rng.choice(["news", "win", "x"])
        bad = site == "spam" or (site == "mixed" and part == "win")
        out.append((f"http{rng.choice(['', 's'])}://{rng.choice(['www.', ''])}{site}.net/{part}/{rng.randint(1, 999)}",
                    int(bad if rng.random() < 0.95 else not bad)))
    return out


def tokens(spark, urls):
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    host, path = uf.host_and_path("url")
    df = df.select("url", host.alias("host"), path.alias("path")).select("url", uf.url_tokens("url").alias("t"))
    return {r.url: set(r.t) for r in df.collect()}


def brute_rules(rows, owned, support, confidence):
    """Every token set by counting, redundant ones left out; token sets as frozensets of all merged tokens."""
    n = len(rows)
    sets = [(owned[u], y) for u, y in rows]
    count = {}
    for s, _ in sets:
        for t in s:
            count[t] = count.get(t, 0) + 1
    where = {}
    for t in count:
        if support * n <= count[t] < n:
            where.setdefault(frozenset(i for i, (s, _) in enumerate(sets) if t in s), []).append(t)
    names = {min(ts): set(ts) for ts in where.values()}
    found = {}
    for size in range(1, 6):
        for key in itertools.combinations(sorted(names), size):
            has = [y for s, y in sets if set(key) <= s]
            if has and sum(has) >= support * n and sum(has) / len(has) >= confidence:
                found[key] = (sum(has) / n, sum(has) / len(has))
    return {frozenset().union(*(names[k] for k in key)): v for key, v in found.items()
            if not any(found.get(tuple(k for k in key if k != gone), (0, -1))[1] >= v[1] for gone in key)}


def test_mined_rules_and_matches_against_counting(spark):
    rows = labelled(1)
    owned = tokens(spark, {u for u, _ in rows})
    df = spark.createDataFrame([(sorted(owned[u]), y) for u, y in rows], "tokens array<string>, block int")
    rules = uf.mine_rules(df, min_support=0.02, min_confidence=0.6)
    got = {frozenset(r.tokens): (r.support, r.confidence) for r in rules.collect()}
    want = brute_rules(rows, owned, 0.02, 0.6)
    assert got.keys() == want.keys() and all(abs(got[k][i] - want[k][i]) < 1e-9 for k in got for i in (0, 1))
    hits = {tuple(r.tokens): r.confidence for r in uf.matched(df, rules).collect()}
    for u, _ in rows:
        best = max((c for k, (_, c) in want.items() if k <= owned[u]), default=None)
        assert (hits.get(tuple(sorted(owned[u]))) is None) == (best is None)
        assert best is None or abs(hits[tuple(sorted(owned[u]))] - best) < 1e-9


def test_many_equal_urls_do_not_explode(spark):
    long = "https://h.net/" + "/".join(f"part{c}" for c in "abcdefghijklmnopqrstuvwxyz") + "?a=1&b=2"
    rows = [(long, 1)] * 60 + labelled(2, 100)
    owned = tokens(spark, {u for u, _ in rows})
    df = spark.createDataFrame([(sorted(owned[u]), y) for u, y in rows], "tokens array<string>, block int")
    rules = uf.mine_rules(df, min_support=0.05, min_confidence=0.6)
    assert 0 < rules.count() < 50


def test_query_and_awkward_rows(spark, tmp_path):
    urls = [(i, f"{u.rsplit('/', 1)[0]}/{i}") for i, (u, _) in enumerate(labelled(3))]
    pages = spark.createDataFrame(urls + [(None, None), (3, urls[3][1]), (900, "")], "page_id long, url string")
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    spark.createDataFrame([(i, int("spam" not in u), 0) for i, u in urls] + [(None, 0, 1), (5, None, None)],
                          "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    out = QUERIES["op9_url_filter"](spark, str(tmp_path)).collect()
    assert len(out) == len(urls) + 3
    assert all(r.verdict == ("block" if "spam" in r.host else r.verdict) for r in out)
    assert sum(r.verdict == "allow" for r in out) > 100 and all(r.rule is None for r in out)
    more = pages.withColumns({c: uf.F.lit("x") for c in ("host", "path", "tokens", "rule", "mined", "stated", "verdict", "html")})
    none = spark.createDataFrame([], "url string, block int")
    assert same(uf.filtered(more, HOST_RULES, none).collect(), uf.filtered(pages, HOST_RULES, none).collect())
    assert uf.filtered(pages.limit(0), HOST_RULES, none).collect() == []
