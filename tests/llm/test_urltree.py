import math
import re
from collections import Counter, defaultdict

from gapweave.llm import queries, urltree
from gapweave.llm.shared import table

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    host = re.match(r"[^/?#]*", rest).group()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host) :]).group()


def rule(host, path):
    fits = [(len(r), r, v) for v, r in RULES for h, p in [(r[: r.index("/")], r[r.index("/") :])] if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def brute(rows):
    """The tree with dictionaries, host by host."""
    shapes = defaultdict(lambda: [0, 0, 0])
    where = {}
    for page_id, url in rows:
        host, path = parts(url)
        r, v = rule(host, path)
        segments = [re.sub(r"(?<=.)\.[A-Za-z0-9]{1,5}$", "", s) for s in path.split("/") if s]
        segments = ["*" if re.search(r"^[0-9]+$|^(?=[^0-9]*[0-9])[0-9A-Fa-f-]{8,}$", s) else s for s in segments]
        segments = tuple(segments[:8] + ["**"] if len(segments) > 8 else segments)
        own = shapes[host, segments]
        own[0] += 1
        own[1] += v is not None
        own[2] += v == "block"
        where[page_id] = (host, path, segments, r, v)
    template = {key: "" for key in shapes}
    for i in range(9):
        nodes = defaultdict(lambda: [0, 0, 0])
        for (host, seg), c in shapes.items():
            s = seg[i] if i < len(seg) else ""
            nodes[host, template[host, seg], s] = [a + b for a, b in zip(nodes[host, template[host, seg], s], c)]
        children, total = Counter(), Counter()
        for (host, t, _), c in nodes.items():
            children[host, t] += 1
            total[host, t] += c[0]
        branch, below = {}, defaultdict(lambda: defaultdict(lambda: [0, 0]))
        for (host, t, s), (n, known, blocked) in nodes.items():
            rare = s not in ("", "*", "**") and children[host, t] > 20 and n < 0.05 * total[host, t]
            branch[host, t, s] = "*" if rare else s
            if known and branch[host, t, s] not in ("", "*", "**"):
                own = below[host, t][s]
                own[0], own[1] = own[0] + known, own[1] + blocked
        symbol = {}
        for (host, t), own in below.items():
            groups = []
            for rate, s in sorted((b / k, s) for s, (k, b) in own.items()):
                if groups:
                    k, b, k0, b0 = *own[s], *own[groups[-1][-1]]
                    pooled = (b + b0) / (k + k0)
                    if abs(rate - b0 / k0) <= 1.96 * math.sqrt(pooled * (1 - pooled) * (1 / k + 1 / k0)) + 1e-9:
                        groups[-1].append(s)
                        continue
                groups.append([s])
            symbol |= {(host, t, s): "#" + min(g) for g in groups if len(g) > 1 for s in g}
        grown = {}
        for (host, seg), t in template.items():
            s = seg[i] if i < len(seg) else ""
            s = symbol.get((host, t, branch[host, t, s]), branch[host, t, s])
            grown[host, seg] = f"{t}/{s}" if s else t
        template = grown
    base = (sum(c[2] for c in shapes.values()) + 1) / (sum(c[1] for c in shapes.values()) + 2)
    hosts, leaves = Counter(), Counter()
    for (host, seg), c in shapes.items():
        for i in (1, 2):
            hosts[host, i] += c[i]
            leaves[host, template[host, seg], i] += c[i]
    out = {}
    for page_id, (host, path, seg, r, v) in where.items():
        t = template[host, seg]
        rate = (hosts[host, 2] + 4 * base) / (hosts[host, 1] + 4)
        purity = (leaves[host, t, 2] + 4 * rate) / (leaves[host, t, 1] + 4)
        out[page_id] = (host, path, r, v or ("block" if round(purity, 9) >= 0.8 else "allow"), t)
    return out


def result(rows):
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"], r["template"]) for r in rows}


def test_query_equals_brute_force(spark, sf_dir):
    for sf in (sf_dir, sf_dir.replace("0.001", "0.01")):
        pages = [(r["page_id"], r["url"]) for r in table(spark, sf, "pages").select("page_id", "url").collect()]
        got = queries.QUERIES["op9_path_template_tree"](spark, sf).collect()
        assert len(got) == len(pages) and result(got) == brute(pages)


def test_templates_and_awkward_urls(spark):
    urls = [None, "", "no scheme", "x://", "http://A.Example.ORG", "http://a.example.org/es/1", "http://notexample.org/es/1", "http://example.org/en/12?q=/es/", "ftp://u@h:80/p?x#y", "http://h#f/p", "http://İ.com/fr/x", "a://b://c/d", "http://x.com/de/" + "y/" * 30, "http://x.com/de/" + "z" * 50_000]
    urls += [f"http://shop.com/de/item{i}/view" for i in range(30)] + [f"http://shop.com/u{i}/{i}.html" for i in range(40)] + ["http://shop.com/fr/a"] * 9
    urls += ["http://solid.com/de/1/x", "http://solid.com/de/2"] * 20 + ["http://solid.com/x/1"]
    rows = list(enumerate(urls))
    pages = spark.createDataFrame([(i, u, None, "h", 1) for i, u in rows], "page_id long, url string, html string, host string, n int")
    got = urltree.judge(pages).collect()
    assert len(got) == len(rows) and result(got) == brute(rows)
    assert urltree.judge(pages.limit(0)).count() == 0
    assert {r["verdict"] for r in urltree.judge(pages, rules=()).collect()} == {"allow"}
    assert urltree.judge(pages.unionAll(pages)).count() == 2 * len(rows)


def test_tree_is_as_deep_as_the_rules(spark):
    stem = "deep.org/a/b/c/d/e/f/g/i/j/"
    urls = [f"http://{stem}{kind}/{first}{n}" for kind in ("bad", "good") for first in (1, 2) for n in range(20)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = urltree.judge(pages, rules=(("block", stem + "bad/1"), ("allow", stem + "good/1"))).collect()
    assert all((r["verdict"] == "block") == ("/bad/" in r["path"]) for r in got)
    assert len({r["template"] for r in got}) == 2


def test_branches_merge_with_branches_and_unlabelled_ones_stay_apart(spark):
    """Two kinds of branches under one node: each merges with its like, though both differ from the mean of all."""
    urls = [f"http://a.com/{part}/{i}" for part in ("de", "fr") for i in range(30)]
    urls += [f"http://a.com/x{j}/{kind}/{i}" for j, kind in enumerate(["good", "bad", "good", "bad"]) for i in range(25)] + ["http://a.com/other/1"] * 12
    rules = [("block", f"a.com/x{j}/bad") for j in (1, 3)] + [("allow", f"a.com/x{j}/good") for j in (0, 2)] + [("block", "a.com/de/"), ("allow", "a.com/fr/")]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r["path"].split("/")[1]: r for r in urltree.judge(pages, rules=rules).collect()}
    first = {name: r["template"].split("/")[1] for name, r in got.items()}
    assert first["x0"] == first["x2"] == first["fr"] == "#fr" and first["x1"] == first["x3"] == first["de"] == "#de" and first["other"] == "other"
    assert [got[x]["verdict"] for x in ("x0", "x1", "fr", "de")] == ["allow", "block", "allow", "block"]
    assert 0.3 < got["other"]["purity"] < 0.7  # its host's
