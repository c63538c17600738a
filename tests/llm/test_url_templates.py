import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tramspark.llm import queries, url_templates as ut

PAGE = "page_id long, url string, host int, Salts int, node string"
LABEL = "doc_id long, good boolean, key string"
RULES = queries.URL_RULES


def pages(spark, rows):
    return spark.createDataFrame([(i, u, 1, 2, "x") for i, u in rows], PAGE)


def labels(spark, rows):
    return spark.createDataFrame([(i, g, "k") for i, g in rows], LABEL)


def judged(spark, urls, marks=(), rules=()):
    out = ut.judge(pages(spark, urls), labels(spark, marks), F.col("good"), rules)
    return sorted(map(tuple, out.select("id", "host", "path", "rule", "verdict", "template").collect()), key=str)


def brute(urls, marks, rules):
    """The whole method row by row in plain Python."""
    def split(url):
        if url is None or "://" not in url:
            return "", ""
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        return host, path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]

    good, bad = defaultdict(int), defaultdict(int)
    for i, g in marks:
        if i is not None and g is not None:
            (good if g else bad)[i] += 1
    rows = []
    for i, u in urls:
        h, p = split(u)
        seg = [x for x in p.split("/") if x]
        if len(seg) > ut.DEPTH:
            seg = seg[:ut.DEPTH - 1] + ["/".join(seg[ut.DEPTH - 1:])]
        rows.append([i, h, p, seg, "", good[i] if i is not None else 0, bad[i] if i is not None else 0])
    for level in range(ut.DEPTH):
        nodes = defaultdict(lambda: defaultdict(list))
        for r in rows:
            if len(r[3]) > level:
                nodes[r[1], r[4]][r[3][level]].append(r)
        for (_, node), kids in nodes.items():
            total = sum(map(len, kids.values()))
            names = defaultdict(list)
            for seg, mine in kids.items():
                literal = len(mine) >= ut.MIN_ROWS and len(mine) * ut.MAX_LITERALS >= total
                for m, w in ut.MARKS.items() if literal else ():
                    seg = seg.replace(m, w)
                names[seg if literal else "*"].extend(mine)
            stats = {n: (sum(r[5] for r in m), sum(r[6] for r in m),
                         (2 * sum(len(r[3]) - level - 1 for r in m) + len(m)) // (2 * len(m))) for n, m in names.items()}
            groups = defaultdict(list)
            for n, (g, b, shape) in stats.items():
                ag, ab = (sum(s[k] for s in stats.values() if s[2] == shape) for k in (0, 1))
                own, rest = g + b, ag + ab - g - b
                scale = own * rest * ag * ab
                similar = scale == 0 or (g * rest - (ag - g) * own) ** 2 * (ag + ab) < ut.SIMILAR_Z ** 2 * scale
                groups[shape, "" if similar else n].append(n)
            for members in groups.values():
                label = "*" if "*" in members else members[0] if len(members) == 1 else "{" + "|".join(sorted(members)) + "}"
                for n in members:
                    for r in names[n]:
                        r[4] = node + "/" + label
    g, b = sum(r[5] for r in rows), sum(r[6] for r in rows)
    base = (g + 1) / (g + b + 2)
    host, temp = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    for r in rows:
        for d in (host[r[1]], temp[r[1], r[4]]):
            d[0] += r[5]
            d[1] += r[6]
    out = []
    for i, h, p, _, node, _, _ in rows:
        hg, hb = host[h]
        tg, tb = temp[h, node]
        prior = (hg + ut.SMOOTHING * base) / (hg + hb + ut.SMOOTHING)
        purity = (tg + ut.SMOOTHING * prior) / (tg + tb + ut.SMOOTHING)
        fits = [(len(x + y), len(x), v == "block", x + y) for v, x, y in rules if (h == x or h.endswith("." + x)) and p.startswith(y)]
        best = max(fits, default=None)
        blocked = best[2] if best else purity < ut.MIN_PURITY
        out.append((i, h, p, best[3] if best else None, "block" if blocked else "allow", node or "/"))
    return sorted(out, key=str)


def made(seed):
    rng = random.Random(seed)
    urls = []
    for i in range(900):
        host = rng.choice(["a.example.org"] * 6 + ["Shop.COM", "x.y.com", "net", "de.example.org:80"])
        kind = rng.random()
        if kind < 0.5:
            path = f"/{rng.choice(['en', 'en', 'de', 'es', 'fr'])}/{rng.choice(['item', 'cat'])}/{rng.randrange(10 ** 6)}"
        elif kind < 0.7:
            path = f"/tag/{rng.choice(['a*b', 'x|y', '{q}', '100%'])}" + "/z" * rng.randrange(9)
        elif kind < 0.8:
            path = rng.choice(["", "/", "//", "/en/", "/en//", "/es/1.html"])
        else:
            path = f"/{rng.randrange(500)}/view"
        urls.append((i if rng.random() > 0.05 else rng.choice([None, 7]), f"https://{host}{path}{rng.choice(['', '?p=/a', '#t', '?a#b'])}"))
    marks = [(i, rng.choice([True, None]) if "/en/" in (u or "") else rng.random() < 0.4) for i, u in urls if rng.random() < 0.5]
    return urls + urls[:40] + [(1, None), (None, "no url"), (3, "a://"), (4, "://h/p")], marks


@pytest.mark.parametrize("seed", [1, 2])
def test_judge_equals_the_method_row_by_row(spark, seed):
    urls, marks = made(seed)
    assert judged(spark, urls, marks, RULES) == brute(urls, marks, RULES)


def test_bad_branch_is_rejected_and_the_good_one_stays(spark):
    urls = [(i, f"http://h.net/{'spam' if i % 2 else 'news'}/{i}") for i in range(400)]
    marks = [(i, i % 2 == 0) for i in range(0, 400, 5)] + [(i, i % 2 == 0) for i in range(1, 400, 6)]
    found = judged(spark, urls, marks)
    assert {(r[5], r[4]) for r in found} == {("/spam/*", "block"), ("/news/*", "allow")}


def test_similar_branches_become_one_and_variable_segments_a_wildcard(spark):
    urls = [(i, f"http://h.net/{('en', 'de', 'fr')[i % 3]}/{i}") for i in range(300)]
    marks = [(i, i % 10 != 0) for i in range(300)]
    assert {r[5] for r in judged(spark, urls, marks)} == {"/{de|en|fr}/*"}
    assert {r[5] for r in judged(spark, [(i, f"http://h.net/u{i}/x") for i in range(50)])} == {"/*/x"}


def test_rules_longest_first_and_subdomains(spark):
    rules = [*RULES, ("allow", "sub.example.org", "/es/ok"), ("block", "example.org", "/")]
    urls = [(1, "http://example.org/es/a"), (2, "http://www.example.org/en/12"), (3, "http://badexample.org/es/a"), (4, "http://org"),
            (5, "HTTP://SUB.EXAMPLE.ORG/es/ok?x"), (6, "http://x.com/de/"), (7, "http://com/fr/1"), (8, "http://x.net/de/")]
    got = {r[0]: r[3:5] for r in judged(spark, urls, (), rules)}
    assert got == {1: ("example.org/es/", "block"), 2: ("example.org/en/1", "block"), 3: ("org/", "allow"), 4: (None, "allow"),
                   5: ("sub.example.org/es/ok", "allow"), 6: ("com/de/", "block"), 7: ("com/fr/", "allow"), 8: (None, "allow")}


def test_empty_table_and_no_labels(spark):
    assert judged(spark, []) == []
    assert [r[4] for r in judged(spark, [(1, "http://a.b/c")] * 3)] == ["allow"] * 3


def test_hot_keys_are_salted_with_the_same_result(spark, monkeypatch):
    from tramspark.llm import common
    monkeypatch.setattr(common, "SMALL_FACTS", 0)
    urls, marks = made(5)
    assert judged(spark, urls[:300] + [urls[0]] * 200, marks, RULES) == brute(urls[:300] + [urls[0]] * 200, marks, RULES)
