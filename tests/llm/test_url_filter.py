"""URL rules and the template tree."""

import math
import random
import re
from collections import Counter, defaultdict

from rides.llm import url_filter
from rides.llm.queries import URL_RULES


def plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    path = rest[cut:]
    return host, path[:min([path.index(c) for c in "?#" if c in path] or [len(path)])]


def fits(host, path):
    best = None
    for rule in URL_RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            best = rule if best is None or len(rule) > len(best) else best
    return best


URLS = [None, "", "no scheme", "http://", "https://WWW.Example.COM/en/1", "http://example.com/en/2#x",
        "http://a.example.com/en/", "http://a.net/es/1?x=/y", "http://net/fr/", "http://xnet/fr/1",
        "http://a.com", "http://a.com?/", "ftp://a.com/x", "http://É.net/es/é", "a://b://c/d",
        "http://www.example.com/EN/1", "http://com/", "http://b.net/es"]


def test_rules_on_odd_urls_and_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url")
    odd = spark.createDataFrame([(-i, u) for i, u in enumerate(URLS, 1)] + [(None, "http://a.com/"), (5, None)],
                                "page_id long, url string")
    both = pages.union(odd).withColumn("host", pages["url"])
    rows = url_filter.judge(both, URL_RULES).collect()
    assert len(rows) == both.count()
    urls = sorted(str((r["page_id"], *plain(r["url"]), fits(*plain(r["url"])))) for r in both.collect())
    assert sorted(str((r["page_id"], r["host"], r["path"], r["rule"])) for r in rows) == urls
    for r in rows:
        assert r["verdict"] in ("allow", "block")
        if r["rule"]:
            assert r["verdict"] == URL_RULES[r["rule"]]
    assert url_filter.judge(both.limit(0), URL_RULES).count() == 0


def test_templates_generalise_merge_and_reject(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(9))
    rows = []
    for i in range(200):    # variable slugs under /spam, labelled bad for the most part
        rows.append((i, f"http://h.org/spam/{word()}", True if i < 60 else None))
    for i in range(200, 400):   # ids under /a and /b, alike, labelled good in part
        rows.append((i, f"http://h.org/{'ab'[i % 2]}/{i}.html", False if i % 20 < 2 else None))
    rows.append((400, "http://h.org/other", None))
    df = spark.createDataFrame(rows, "page_id long, url string, blocked boolean")
    labels = df.where("blocked is not null").select("page_id", "blocked")
    out = {r["page_id"]: r for r in url_filter.judge(df.drop("blocked"), {}, labels).collect()}
    assert {out[i]["template"] for i in range(200)} == {"/spam/*"}
    assert {out[i]["verdict"] for i in range(200)} == {"block"}
    assert len({out[i]["template"] for i in range(200, 400)}) == 1     # /a and /b share one branch
    assert {out[i]["verdict"] for i in range(200, 401)} == {"allow"}
    elsewhere = (60 + 0.5) / (60 + 5)       # over all hosts, of which there is one
    assert abs(out[0]["purity"] - (60 + 5 * elsewhere) / (60 + 5)) < 1e-9


def plain_tree(rows, weight=5.0, prior=0.1):
    """{(host, masked): (template, purity)} of (host, masked, label) rows, by
    recursion over nodes."""
    counts = {}
    for host, masked, label in rows:
        c = counts.setdefault((host, masked), [0, 0, 0])
        c[0] += 1
        c[1] += label is True
        c[2] += label is False
    out = {}

    def limit(f):
        return f + 3 * math.sqrt(2 * f)

    def walk(host, prefix, level, paths):
        """``paths``: {masked: segments} of one node, whose next segment is at ``level``."""
        if len(paths) == 1:
            for masked, segs in paths.items():
                out[host, masked] = "/".join([prefix, *segs[level:]]) if segs[level:] else prefix
            return
        for masked, segs in list(paths.items()):
            if len(segs) <= level:
                out[host, masked] = prefix
                del paths[masked]
        children = Counter()
        for masked, segs in paths.items():
            children[segs[level]] += counts[host, masked][0]
        wild = len(children) > url_filter.MANY and sum(children.values()) < 2 * len(children)
        branches = {}
        for masked, segs in paths.items():
            branches.setdefault("*" if wild else segs[level], {})[masked] = segs
        facts = {}
        for seg, group in branches.items():
            rests = Counter()
            for masked, segs in group.items():
                rests["/".join(segs[level + 1:])] += counts[host, masked][0]
            facts[seg] = (rests, max(rests, key=lambda r: (rests[r], r)),
                          sum(counts[host, x][1] for x in group), sum(counts[host, x][2] for x in group))
        leads = {}
        for seg, (rests, top, _, _) in facts.items():
            leads.setdefault(top, []).append((-sum(rests.values()), seg))
        joined = {}
        for seg, (rests, top, bad, good) in facts.items():
            lead = min(leads[top])[1]
            other, _, bad2, good2 = facts[lead]
            n, m = sum(rests.values()), sum(other.values())
            x2 = sum((rests[r] * math.sqrt(m / n) - other[r] * math.sqrt(n / m)) ** 2 / (rests[r] + other[r])
                     for r in rests | other)
            margins = (bad + good) * (bad2 + good2) * (bad + bad2) * (good + good2)
            apart = (bad * good2 - good * bad2) ** 2 * (bad + good + bad2 + good2) / margins if margins else 0
            same = seg == lead or (x2 <= limit(max(len(rests | other) - 1, 1)) and apart <= limit(1))
            joined.setdefault(lead if same else seg, {}).update(branches[seg])
        for seg, group in joined.items():
            walk(host, f"{prefix}/{seg}", level + 1, group)

    for host in {h for h, _ in counts}:
        walk(host, "", 1, {m: m.split("/") for h, m in counts if h == host})
    own, every = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    for (host, masked), template in out.items():
        for side in (own[host, template], every[template]):
            side[0] += counts[host, masked][1]
            side[1] += counts[host, masked][2]

    def purity(host, template):
        bad, good = every[template]
        p = (bad + weight * prior) / (bad + good + weight)
        bad, good = own[host, template]
        return (bad + weight * p) / (bad + good + weight)
    return {k: (t, purity(k[0], t)) for k, t in out.items()}


def agrees(pages, rules, labels=None):
    rows = url_filter.judge(pages, rules, labels).collect()
    known = {r["page_id"]: r["blocked"] for r in labels.collect()} if labels is not None else None
    def label(r):  # noqa: E306
        return known.get(r["page_id"]) if known is not None else rules[r["rule"]] == "block" if r["rule"] else None
    masked = lambda r: re.sub("[0-9]+", "*", r["path"])
    want = plain_tree([(r["host"], masked(r), label(r)) for r in rows])
    for r in rows:
        template, purity = want[r["host"], masked(r)]
        assert r["template"] == template and abs(r["purity"] - purity) < 1e-9, (r, template, purity)
        assert r["verdict"] == (rules[r["rule"]] if r["rule"] else "block" if purity >= 0.5 else "allow")
    return rows


def test_whole_tree_of_the_pages_against_plain_python(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    rows = [r for r in agrees(pages, URL_RULES) if not r["rule"]]
    assert {r["verdict"] for r in rows} == {"allow", "block"}
    assert len({r["purity"] for r in rows}) > 3 and any("*" in r["template"] for r in rows)


def test_random_trees_and_deep_paths_against_plain_python(spark):
    rng = random.Random(5)
    rows, n = [], 0
    for host in ("a.org", "b.org", "c.net"):
        for _ in range(500):
            depth = rng.choice([0, 1, 2, 3, 9])
            parts = [rng.choice(["x", "y", "tag", f"p{rng.randrange(9)}", "slug" + rng.choice("abcdefgh") * rng.randrange(1, 9)])
                     for _ in range(depth)]
            url = f"http://{host}/" + "/".join(parts) + rng.choice(["", ".html", "/"])
            rows.append((n, url, rng.choice([True, False, None, None])))
            n += 1
    deep = "/".join(f"d{i % 3}" for i in range(40))
    rows += [(n + i, f"http://deep.org/{deep}/{i % 3}/end{i % 2}", i % 4 == 0) for i in range(30)]
    rows += [(n + 100, "http://long.org/" + "s/" * 3000, None), (n + 101, "http://long.org/t", True)]
    df = spark.createDataFrame(rows, "page_id long, url string, blocked boolean")
    agrees(df.drop("blocked"), {}, df.where("blocked is not null").select("page_id", "blocked"))
