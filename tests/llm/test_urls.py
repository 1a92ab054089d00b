import math
import random
import re
from collections import defaultdict

from moodtide.llm import urls

PAGES = "page_id long, url string"
LABELS = "doc_id long, quality int, toxic int"


def parsed(url):
    if url is None or "://" not in url:
        return "", ""
    after = url.split("://", 1)[1]
    own = re.match(r"[^/?#]*", after).group()
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in own)
    return low, re.match(r"[^?#]*", after[len(own) :]).group()


def ruled(own, way):
    fits = [(len(h + p), v, h + p) for v, h, p in urls.RULES if (own == h or own.endswith("." + h)) and way.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def differs(a, n_a, b, n_b):
    bound = math.sqrt(0.5 * math.log(2 / urls.ALPHA))
    return bool(n_a and n_b and abs(a / n_a - b / n_b) > bound * (1 / math.sqrt(n_a) + 1 / math.sqrt(n_b)))


def brute(pages, labels):
    bad = {}
    for i, q, t in labels:
        if i is not None:
            bad[i] = max(bad.get(i, 0), int(q == 0 or t == 1))
    rows = []
    for i, url in pages:
        own, way = parsed(url)
        segs = [s for s in re.sub("[0-9]+", "#", way).split("/") if s]
        rows.append({"id": i, "host": own, "path": way, "segs": segs, "node": own, "lab": int(i in bad), "bad": bad.get(i, 0)})
    for level in range(max((len(r["segs"]) for r in rows), default=0)):
        branch = defaultdict(lambda: [0, 0, 0, 0])
        for r in rows:
            if len(r["segs"]) > level:
                b = branch[r["node"], r["segs"][level]]
                for k, x in enumerate((1, r["lab"], r["bad"], len(r["segs"]) == level + 1)):
                    b[k] += x
        total, siblings = defaultdict(lambda: [0, 0, 0, 0]), defaultdict(int)
        for (node, _), b in branch.items():
            siblings[node] += 1
            for k in range(4):
                total[node][k] += b[k]
        for r in rows:
            if len(r["segs"]) > level:
                node, s = r["node"], r["segs"][level]
                b = branch[node, s]
                c = [x - y for x, y in zip(total[node], b)]
                own = siblings[node] == 1 or differs(b[2], b[1], c[2], c[1]) or differs(b[3], b[0], c[3], c[0])
                r["next"] = f"{node}/{s if own else '*'}"
        for r in rows:
            if len(r["segs"]) > level:
                r["node"] = r["next"]
    smooth = lambda own, towards: (sum(r["bad"] for r in own) + urls.WEIGHT * towards) / (sum(r["lab"] for r in own) + urls.WEIGHT)
    prior = sum(r["bad"] for r in rows) / max(sum(r["lab"] for r in rows), 1)
    hosts, nodes = defaultdict(list), defaultdict(list)
    for r in rows:
        hosts[r["host"]].append(r)
        nodes[r["host"], r["node"]].append(r)
    out = []
    for r in rows:
        purity = smooth(nodes[r["host"], r["node"]], smooth(hosts[r["host"]], prior))
        verdict, rule = ruled(r["host"], r["path"])
        verdict = verdict or ("block" if purity >= urls.REJECT else "allow")
        out.append((r["id"], r["host"], r["path"], rule, verdict, r["node"], round(purity, 9)))
    return sorted(out, key=str)


def case():
    rng = random.Random(6)
    pages, labels = [], []
    for i in range(900):
        host = rng.choice(["a.net", "Www.B.example.net", "x.org", "example.org", "m.example.org", "q.com", "notorg", "hot.net", "hot.net"])
        kind = rng.choice(["good", "spam", "deep"])
        path = {"good": f"/en/{i}.html", "spam": f"/win/{rng.choice('xyz')}{i}", "deep": "/a" * rng.randrange(12) + f"/{rng.choice(['es', 'fr', 'de'])}/"}[kind]
        pages.append((i, f"http{rng.choice(['', 's'])}://{host}{path}{rng.choice(['', '?a=/b', '#t?', '/'])}"))
        if rng.random() < 0.7:
            labels.append((i, int(rng.random() > (0.9 if kind == "spam" else 0.05)), int(rng.random() < 0.05)))
    pages += [(2000, None), (2001, "no scheme/x"), (2002, ""), (2003, "x://"), (2004, "ftp://ORG?x"), (2005, "a://b://c/d"), (2006, "http://x.com/de/1"),
              (2007, "http://com/fr/"), (2008, "http://example.org/en/12"), (2009, "http://é.org//a//"), (None, "http://q.com/fr/1"), pages[0], pages[0]]
    return pages, [*labels, (0, 1, 0), (0, 0, None), (1, None, None), (None, 0, 1)]


def result(spark, pages, labels):
    out = urls.filter_urls(spark.createDataFrame(pages, PAGES).repartition(3), spark.createDataFrame(labels, LABELS))
    return sorted((tuple(r)[:6] + (round(r.purity, 9),) for r in out.collect()), key=str)


def test_equals_brute_force(spark):
    pages, labels = case()
    got = result(spark, pages, labels)
    assert got == brute(pages, labels)
    assert {r[4] for r in got if r[3] is None} == {"allow", "block"}


def test_branches_deep_in_a_path_are_told_apart(spark):
    """Paths of up to 20 segments that branch at the 8th, the 15th and the last."""
    rng = random.Random(8)
    top = "/".join("abcdefg")
    pages = [(i, f"http://h.net/{top}/{'bad' if i % 2 else 'good'}/x{i}") for i in range(400)]
    middle = "/".join("abcdefghijklmn")
    pages += [(1000 + i, f"http://k.net/{middle}/{rng.choice('uvw')}/{'/'.join(rng.choices('pq', k=rng.randrange(6)))}") for i in range(300)]
    pages += [(2000 + i, "http://k.net/" + "/".join(rng.choices("rs", k=rng.randrange(20)))) for i in range(200)]
    pages += [(3000 + i, f"http://n.net/{'/'.join(['z'] * (500 + i))}") for i in range(4)]  # few pages, very deep
    labels = [(i, int(i % 2 == 0), 0) for i in range(400)] + [(i, int(u.split(middle)[1][1] != "u"), 0) for i, u in pages[400:700]]
    got = result(spark, pages, labels)
    assert got == brute(pages, labels)
    verdicts = {(("/good/" in r[2]), r[4]) for r in got if r[1] == "h.net"}
    assert verdicts == {(True, "allow"), (False, "block")}


def test_templates_generalise(spark):
    pages, labels = case()
    out = urls.filter_urls(spark.createDataFrame(pages, PAGES), spark.createDataFrame(labels, LABELS)).where("host = 'hot.net'").collect()
    templates = {r.template for r in out}
    assert any("*" in t for t in templates) and len(templates) < 20
    assert all(r.verdict == "block" for r in out if r.path.startswith("/win/"))
    assert all(r.verdict == "allow" for r in out if r.path.startswith("/en/"))


def test_stays_native_and_handles_empty_tables(spark, plan_of):
    pages = spark.createDataFrame([(1, "http://a.org/x", "y", "z")], PAGES + ", host string, verdict string")
    labels = spark.createDataFrame([], LABELS)
    out = urls.filter_urls(pages, labels)
    assert tuple(out.first()) == (1, "a.org", "/x", "org/", "allow", "a.org/x", 0.0)
    assert "Python" not in plan_of(out) and "Arrow" not in plan_of(out)
    assert urls.filter_urls(pages.limit(0), labels).count() == 0
