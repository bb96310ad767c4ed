import random

import duckdb
import pytest

from surveypulse.llm import url_filters
from surveypulse.llm.queries import ORACLE

SCHEMA = "page_id long, url string, html string, host int, bad string, pages int, links int"


def web():
    rng = random.Random(3)
    good, bad = ["x.org", "y.fr", "a.example.com"], ["q.net", "spam.example.com", "shop.net"]
    rows = []
    for i in range(200):
        host = rng.choice([*good, *bad, "lone.io", "farm.io", "friend.io"])
        targets = {"farm.io": bad, "friend.io": good}.get(host, [*good, "only-linked.net"])
        path = rng.choice(["/en/1", "/de/2?x", "/fr/3#a", "/", "", "/en/?q=://"])
        links = "".join(rng.choice(['<a href="http://{}/z">', "<A HREF = //{}?a>", "<a href='HTTPS://{}'>"]).format(rng.choice([t, t.upper()]))
                        for t in rng.choices(targets, k=rng.randrange(4)))
        rows.append((i, rng.choice(["http://", "HTTPS://"]) + rng.choice([host, host.upper()]) + path, '<a href="/de">x</a>' + links))
    rows += [(900, None, "<a href=http://q.net>"), (901, "nothing", "x"), (902, "http://x.org/\n/fr", None), (903, "://", ""), (903, "://", ""),
             (None, None, None), (904, "http://EXAMPLE.NET/en/a", "<a href=//>"), (905, "http://notexample.net/en/", "")]
    return [(*r, 1, "b", 2, 3) for r in rows]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(web(), SCHEMA).repartition(3)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def brute_scores(rows, rules, damping, rounds):
    """Host scores by plain loops."""
    def parts(url):
        at = (url or "").find("://")
        rest = url[at + 3:] if at >= 0 else ""
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        path = rest[end:]
        return rest[:end].translate({c: c + 32 for c in range(65, 91)}), path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]

    def fit(host, path):
        fits = [(len(h + p), v, h + p) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fits)[1:] if fits else (None, None)

    import re
    edges, hosts, judged = {}, {}, []
    for page_id, url, html, *_ in rows:
        host, path = parts(url)
        verdict, rule = fit(host, path)
        judged.append((page_id, host, path, rule, verdict))
        if host:
            seen = hosts.setdefault(host, {"n": 0, "allow": 0, "block": 0, None: 0})
            seen["n"] += 1
            seen[verdict] += 1
            for m in re.finditer(r"(?i)href\s*=\s*[\"']?\s*(?:[a-z]+:)?//([^/?#\"'<>\s]+)", html or ""):
                if m[1].lower() != host:
                    edges[host, m[1].lower()] = edges.get((host, m[1].lower()), 0) + 1
    for _, b in edges:
        if b not in hosts:
            hosts[b] = {"n": 1, "allow": 0, "block": 0, None: 0, fit(b, "/")[0]: 1}
    out = {h: sum(n for (a, _), n in edges.items() if a == h) for h in hosts}
    into = {h: sum(n for (_, b), n in edges.items() if b == h) for h in hosts}
    trust, distrust = ({h: float(s[k]) for h, s in hosts.items()} for k in ("allow", "block"))
    for _ in range(rounds):
        flow = lambda x, get, ways: {
            h: sum(x[a] * n / ways[a] for a, n in get(h)) + (0 if ways[h] else x[h]) for h in hosts}
        t = flow(trust, lambda h: [(a, n) for (a, b), n in edges.items() if b == h], out)
        d = flow(distrust, lambda h: [(b, n) for (a, b), n in edges.items() if a == h], into)
        trust = {h: round((1 - damping) * hosts[h]["allow"] + damping * t[h], 9) for h in hosts}
        distrust = {h: round((1 - damping) * hosts[h]["block"] + damping * d[h], 9) for h in hosts}
    return judged, {h: (s["n"], trust[h], distrust[h]) for h, s in hosts.items()}


def test_brute_force(pages):
    judged, scores = brute_scores(web(), url_filters.RULES, 0.85, 12)
    bad = {h for h, (n, t, d) in scores.items() if (d - t) / n >= 0.4}
    want = [(i, h, p, r, v or ("block" if h in bad else "allow")) for i, h, p, r, v in judged]
    got = found(url_filters.url_verdicts(pages, threshold=0.4, rounds=12))
    assert got == sorted(want, key=str)
    # Distrust reaches the host that links to blocked ones, and it alone.
    assert {h for _, h, _, r, v in got if v == "block" and r is None} == {"farm.io"}


def test_scores(pages):
    _, scores = brute_scores(web(), url_filters.RULES, 0.7, 6)
    edges = url_filters.written(url_filters.host_links(pages))
    got = url_filters.propagated(url_filters.written(url_filters.seeds(pages, edges)), edges, 0.7, 6).collect()
    assert {r["host"]: (r["pages"], pytest.approx(r["trust"], abs=1e-6), pytest.approx(r["distrust"], abs=1e-6)) for r in got} == scores


@pytest.mark.parametrize("threshold", [0.4, 0.5])
def test_sql(pages, threshold):
    con = duckdb.connect()
    con.register("pages", pages.toArrow())
    sql = url_filters.oracle(threshold=threshold, rounds=5)
    want = con.sql(f"SELECT page_id, host, path, rule, verdict FROM ({sql})").fetchall()
    assert found(url_filters.url_verdicts(pages, threshold=threshold, rounds=5)) == sorted(want, key=str)
    assert ORACLE["op11_url_filters"] == url_filters.oracle()


def test_no_python(pages, capsys):
    url_filters.url_verdicts(pages, rounds=1).explain()
    plan = capsys.readouterr().out
    assert "Project" in plan and "Python" not in plan and "Arrow" not in plan


def test_empty_and_null_rows(spark):
    assert found(url_filters.url_verdicts(spark.createDataFrame([], SCHEMA))) == []
    nulls = spark.createDataFrame([(None,) * 7] * 2, SCHEMA)
    assert found(url_filters.url_verdicts(nulls)) == [(None, "", "", None, "allow")] * 2
