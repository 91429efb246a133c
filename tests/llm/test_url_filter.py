from litmill.llm import url_filter as u

PAGES = "page_id long, url string, html string, verdict string"


def link(*hosts):
    return "".join(f'<a HREF="https://{h}/x">y</a>' for h in hosts)


def test_rules_hosts_and_paths(spark):
    urls = {1: "https://A.Example.ORG/es/1?x#y", 2: "http://example.org/en/12", 3: "http://b.org", 4: "http://b.org?x", 5: "x.com/fr/1", 6: None, 7: "http://notexample.org/es/", 8: "ftp://q.com/fr/z", 9: "http://u@q.com:80/de/"}
    rows = [(i, url, None, "old") for i, url in urls.items()] + [(1, urls[1], None, "old")]
    out = {r.page_id: tuple(r)[1:] for r in u.url_filter(spark.createDataFrame(rows, PAGES)).collect()}
    assert out[1] == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert out[2] == ("example.org", "/en/12", "example.org/en/1", "block")
    assert out[3] == ("b.org", "", None, "allow") and out[4] == ("b.org", "", None, "allow")
    assert out[5] == out[6] == ("", "", None, "allow")
    assert out[7][2:] == ("org/", "allow") and out[8] == ("q.com", "/fr/z", "com/fr/", "allow")
    assert out[9] == ("u@q.com:80", "/de/", None, "allow")


def test_a_long_chain_and_a_long_page(spark):
    """Scores reach a host behind any number of links, and are those of the fixed point."""
    rules = (("h0.net", "/", "allow"), ("bad.net", "/", "block"))
    links = {**{f"h{i}.net": [f"h{i + 1}.net"] for i in range(25)}, "bad.net": ["h0.net"], **{f"s{i + 1}.net": [f"s{i}.net"] for i in range(1, 20)}, "s1.net": ["bad.net", "h0.net"]}
    rows = [(i, f"http://{h}/", link(*to) + "x" * (300_000 if h == "h3.net" else 0), "") for i, (h, to) in enumerate(links.items())]
    pages = u.judged(spark.createDataFrame(rows, PAGES), rules)
    got = {(r.kind, r.host): r.score for r in u.propagate(u.host_edges(pages), u.seeds(pages), tolerance=1e-9).collect()}
    edges = [("allow", a, b, 1 / len(to)) for a, to in links.items() for b in to]
    share = {b: sum(p for _, _, x, p in edges if x == b) for _, _, b, _ in edges}
    edges += [("block", b, a, p / share[b]) for _, a, b, p in edges]
    own = {("allow", "h0.net"): 0.15, ("block", "bad.net"): 0.15}
    want = dict(own)
    for _ in range(200):
        new = dict(own)
        for kind, a, b, p in edges:
            if (kind, a) in want:
                new[kind, b] = new.get((kind, b), 0) + 0.85 * p * want[kind, a]
        want = new
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-6 for k in want)
    verdicts = {r.host: r.verdict for r in u.url_filter(spark.createDataFrame(rows, PAGES), rules).collect()}
    assert verdicts["s19.net"] == "block" and verdicts["h25.net" if "h25.net" in verdicts else "h24.net"] == "allow"


def test_trust_and_distrust_travel(spark):
    rules = (("good.net", "/", "allow"), ("bad.net", "/", "block"))
    rows = [
        (1, "http://good.net/", link("friend.net"), ""),
        (2, "http://friend.net/", link("friend2.net"), ""),
        (3, "http://friend2.net/", None, ""),
        (4, "http://bad.net/", "", ""),
        (5, "http://shady.net/", link("bad.net"), ""),
        (6, "http://shadier.net/", link("Shady.NET", "shadier.net"), ""),
        (7, "http://neutral.net/", link("neutral2.net"), ""),
    ]
    out = {r.page_id: r.verdict for r in u.url_filter(spark.createDataFrame(rows, PAGES), rules).collect()}
    assert out == {1: "allow", 2: "allow", 3: "allow", 4: "block", 5: "block", 6: "block", 7: "allow"}
    assert u.url_filter(spark.createDataFrame([], PAGES)).collect() == []


def test_edges_of_hubs_apart_give_the_same_scores(spark):
    """A host that nearly all others link to, and one that links to all."""
    rules = (("hub.net", "/", "allow"), ("h7.net", "/", "block"))
    rows = [(i, f"http://h{i}.net/", link("hub.net", f"h{(i * 7) % 60}.net"), "") for i in range(60)] + [(99, "http://hub.net/", link(*(f"h{i}.net" for i in range(60))), "")]
    pages = u.judged(spark.createDataFrame(rows, PAGES), rules)
    edges, start = u.host_edges(pages).cache(), u.seeds(pages).cache()
    plain, apart = ({(r.kind, r.host): r.score for r in u.propagate(edges, start, damping=0.5, hub_edges=n).collect()} for n in (10**6, 3))
    assert set(plain) == set(apart) and len(plain) > 100
    assert all(abs(plain[k] - apart[k]) < 1e-9 for k in plain)
