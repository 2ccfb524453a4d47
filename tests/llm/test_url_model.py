"""Hosts, rules and the two character models against a plain version."""

import hashlib
import math
import re
from collections import Counter

from lapsewise.llm import url_model as U
from lapsewise.llm.queries import QUERIES


def located(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")


def rule_of(host, path):
    fit = [(len(h + p), h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


def grams(url):
    chars = [U.START] * (U.ORDER - 1) + list(url) + [U.END]
    return [["".join(chars[i - k + 1 : i + 1]) for k in range(1, U.ORDER + 1)] for i in range(U.ORDER - 1, len(chars))]


def plain(urls):
    """The verdict of each URL."""
    ruled = [rule_of(*located(u)) for u in urls]
    held = [hashlib.md5(u.encode()).hexdigest()[0] in U.CALIBRATION for u in urls]
    counts = {"allow": Counter(), "block": Counter()}
    for u, (_, verdict), h in zip(urls, ruled, held):
        if verdict and not h:
            counts[verdict].update(g for ends in grams(u) for g in ends)
    both = counts["allow"] + counts["block"]
    context = {v: Counter() for v in counts}
    for v in counts:
        for g, n in counts[v].items():
            context[v][len(g), g[:-1]] += n

    def p(v, g):
        shorter = p(v, g[1:]) if len(g) > 1 else 1 / 256
        return (counts[v][g] + U.SMOOTH * shorter) / (context[v][len(g), g[:-1]] + U.SMOOTH)

    weight = {g: math.log(p("allow", g)) - math.log(p("block", g)) for g, n in both.items() if n >= U.LEAST}
    steps = []
    for u in urls:
        ends = grams(u)
        score = round(sum(next((weight[g] for g in reversed(e) if g in weight), 0.0) for e in ends) / len(ends), 9)
        steps.append(max(-U.RANGE, min(U.RANGE, math.floor(score * U.STEPS))))
    known = [(s, v == "allow") for s, (_, v), h in zip(steps, ruled, held) if v and h]
    good, bad = (sum(a == k for _, a in known) for k in (True, False))
    limit = None
    if good and bad:
        right = lambda t: round(sum(a for s, a in known if s >= t) / good + sum(not a for s, a in known if s < t) / bad, 9)
        limit = min({s for s, _ in known}, key=lambda t: (-right(t), t))
    return [v or ("allow" if limit is None or s >= limit else "block") for s, (_, v) in zip(steps, ruled)]


def test_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    pages = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url").collect()]
    got = {r.page_id: r for r in QUERIES["op9_url_markov_ratio"](spark, sf_dir).collect()}
    verdicts = plain([u or "" for _, u in pages])
    assert len(got) == len(pages)
    for (page_id, url), verdict in zip(pages, verdicts):
        host, path = located(url)
        assert tuple(got[page_id])[1:5] == (host, path, rule_of(host, path)[0], verdict), url


def test_model_tells_examples_apart(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = QUERIES["op9_url_markov_ratio"](spark, sf_dir).collect()
    mean = lambda kind: sum(r.step for r in rows if r.rule and r.verdict == kind) / sum(1 for r in rows if r.rule and r.verdict == kind)
    assert mean("allow") > mean("block") + 20


def test_odd_urls(spark):
    urls = [None, "", "HTTP://A.Example.ORG?x", "http://a.ORG/En/1", "http://x.com/de/1", "x://b.com/fr/1?/", "y://q.net/aé#/b", "no scheme", "x://",
            "http://example.org/es/1", "http://sub.example.org/en/12", "http://notexample.org/es/", "http://example.org:80/es/"]
    table = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls * 2)], "page_id long, url string, host string")
    rows = U.judged(table).collect()
    assert len(rows) == 2 * len(urls)
    for r in rows:
        url = urls[r.page_id % len(urls)]
        assert (r.host, r.path) == located(url) and r.rule == rule_of(r.host, r.path)[0]
    assert U.judged(table.limit(0)).collect() == []


def test_long_url_and_no_examples(spark):
    table = spark.createDataFrame([(1, "q://x.net/" + "ab" * 20000), (None, "q://x.net/")], "page_id long, url string")
    assert {r.verdict for r in U.judged(table).collect()} == {"allow"}


def test_model_grows_with_its_examples(spark):
    def runs_of(n):
        made = "concat('http://', md5(cast(id as string)))"
        examples = spark.range(n).selectExpr(f"{made} AS _url", "id % 2 = 0 AS good")
        return U.model(examples).count()

    assert runs_of(4000) > 2 * runs_of(1000)


def test_sql_beyond_65536_positions(spark, tmp_path):
    """The query equals its SQL where one site's pages alone have more positions than that."""
    import duckdb

    from lapsewise.llm.queries import SQL

    hosts = "element_at(array('a.org', 'b.com', 'example.org', 'c.net', 'example.com'), cast(id % 5 as int) + 1)"
    path = "element_at(array('fr', 'de', 'es', 'en'), cast(id % 7 % 4 as int) + 1)"
    rows = spark.range(4000).selectExpr("id AS page_id", f"concat('http://', {hosts}, '/', {path}, '/', md5(cast(id % 900 as string))) AS url")
    rows.write.parquet(f"{tmp_path}/pages.parquet")
    assert spark.read.parquet(f"{tmp_path}/pages.parquet").selectExpr("sum(length(url))").first()[0] > 2 * 65536
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
        wanted = sorted(db.execute(f"SELECT page_id, verdict, step FROM ({SQL['op9_url_markov_ratio']})").fetchall())
    got = sorted(tuple(r) for r in QUERIES["op9_url_markov_ratio"](spark, str(tmp_path)).select("page_id", "verdict", "step").collect())
    assert got == wanted


def test_runs_are_kept_whatever_the_total(spark):
    # 70 000 positions of one site may not push out a pattern that another site shows twice
    urls = [("http://big.example.org/" + "ab" * 24, True)] * 1000 + [("http://small.example.com/de/qzj", False)] * 2
    examples = spark.createDataFrame([(u, good) for u, good in urls], "_url string, good boolean")
    weights = {r.g: r.w for r in U.model(examples).collect()}
    assert {g for ends in grams(urls[-1][0]) for g in ends} <= set(weights)
    assert weights["e/qzj"] < -1


def test_weights_of_the_longest_known_ends(spark):
    weights = {"a": 1.0, "b": 2.0, "ab": 3.0, "cab": 4.0, "xxcab": 5.0}
    table = spark.createDataFrame(list(weights.items()), "g string, w double")
    seen = ["xxcab", "yxcab", "xxxab", "xxxxa", "xxxxb", "xxxxz"]
    found = {r.g: r.w for r in U.longest_known(spark.createDataFrame([(g,) for g in seen], "g string"), table).collect()}
    assert found == dict(zip(seen, [5.0, 4.0, 3.0, 1.0, 2.0, 0.0]))
