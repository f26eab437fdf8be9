import numpy as np
import pytest

from departure_risk.llm import hostgraph
from departure_risk.llm.queries import URL_RULES
from llm.conftest import table

SCHEMA = "page_id long, url string, html string"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    return host, path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]


def rule_of(host, path, rules):
    fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def ranks(seeds, edges, damping=0.85, rounds=30):
    hosts = sorted(set(seeds) | {h for e in edges for h in e})
    sent, got = ({h: sum(w for e, w in edges.items() if e[k] == h) for h in hosts} for k in (0, 1))
    base = {h: ((1 - damping) * max(seeds.get(h, 0), 0), (1 - damping) * max(-seeds.get(h, 0), 0)) * 2 for h in hosts}
    now = dict(base)
    for _ in range(rounds):
        new = {h: list(base[h]) for h in hosts}
        for (a, b), w in edges.items():
            new[b][0] += damping * now[a][0] * w / sent[a]
            new[a][1] += damping * now[b][1] * w / got[b]
            new[b][2] += damping * now[a][2] * w / got[b]
            new[a][3] += damping * now[b][3] * w / sent[a]
        now = new
    return now


def brute(rows, rules, threshold=0.05, means=True):
    import re

    edges, pages, net = {}, {}, {}
    for _, url, html in rows:
        host, path = parts(url)
        pages[host] = pages.get(host, 0) + 1
        verdict = rule_of(host, path, rules)[1]
        net[host] = net.get(host, 0) + {"allow": 1, "block": -1, None: 0}[verdict]
        targets = set()
        for link in re.findall(hostgraph.LINK, html or ""):
            if re.match("^([a-zA-Z][a-zA-Z0-9+.-]*:)?//", link):
                targets.add(parts("x://" + link.split("//", 1)[1])[0])
        for t in targets - {host, ""}:
            if host:
                edges[host, t] = edges.get((host, t), 0) + 1
    found = ranks({h: net[h] / pages[h] for h in pages}, edges)
    out = []
    for page, url, _ in rows:
        host, path = parts(url)
        rule, verdict = rule_of(host, path, rules)
        trust, distrust, standing, exposure = found[host] if host in found else [0] * 4
        bad = host and (distrust - trust > threshold or (means and exposure - max(trust, standing) > threshold))
        out.append((page, host, path, rule, verdict or ("block" if bad else "allow")))
    return sorted(out, key=repr)


def judged(spark, rows, rules, **options):
    return sorted((tuple(r) for r in hostgraph.judged(table(spark, rows, SCHEMA).repartition(3), rules, **options).collect()), key=repr)


def web():
    rng = np.random.default_rng(3)
    hosts = [f"site{i}.{t}" for i in range(12) for t in ("com", "org", "net")] + ["example.org", "a.example.org", "Big.Example.ORG", "spam.net", "x.spam.net"]
    rows = []
    for i in range(400):
        host = hosts[int(rng.integers(len(hosts)))] if i % 3 else "hub.net"
        links = "".join(f'<a class=x href="{rng.choice(["http://", "https://", "//"])}{hosts[int(rng.integers(len(hosts)))]}/p">y</a>' for _ in range(int(rng.integers(0, 4))))
        spam = '<A HREF=http://spam.net/buy>z</A>' if "site1" in host else ""
        rows.append((i, f"http{'s' if i % 2 else ''}://{host}/{rng.choice(['en', 'fr', 'de', 'es'])}/{i}?q=a://b#c", f"<p><a href='/own'>o</a>{links}{spam}</p>"))
    rows += [(600 + i, f"http://farm{i % 6}.net/{i}", "<a href='//spam.net/buy'>z</a>") for i in range(12)]
    odd = [None, "", "no scheme/x", "://", "http://", "HTTP://UPPER.Org", "ftp://h.org?x/y", "http://org/", "http://xorg/", "x://a.com#f/fr/", "http://b.com/fr/://c.net/de/",
           "http://b.com/fr", "//c.org/x", "mailto:a@b", "http://c.com:80/de/", "http://é.org/ü", "http://d.org/a\nb?c"]
    return rows + [(1000 + i, u, None if i % 2 else "<a href=''></a><a href='//'></a><a href=>") for i, u in enumerate(odd)] + [(1, rows[1][1], ""), (None, rows[2][1], None)]


RULES = URL_RULES + [("spam.net", "/", "block"), ("hub.net", "/en/", "allow")]


@pytest.mark.parametrize("rules", [URL_RULES, RULES, []])
def test_against_a_plain_walk(spark, rules):
    rows = web()
    assert judged(spark, rows, rules) == brute(rows, rules)
    if rules is RULES:  # the means decide here
        assert judged(spark, rows, rules, means=False) == brute(rows, rules, means=False) != brute(rows, rules)


def test_hosts_of_very_many_labels_and_a_hub(spark):
    long = "a." * 60_000 + "example.org"
    rows = [(1, f"http://{long}/es/", None), (2, f"http://{long}/x", None), (3, "http://a.b.c.de/", None)]
    rows += [(10 + i, f"http://h{i}.edu/", '<a href="//hub.edu/">x</a><a href="//bad.info/">y</a>') for i in range(300)]
    rows += [(400, "http://hub.edu/", "".join(f'<a href="//h{i}.edu/">x</a>' for i in range(300)))]
    rules = [("example.org", "/es/", "block"), ("org", "/", "allow"), ("hub.edu", "/", "allow"), ("bad.info", "/", "block")]
    assert judged(spark, rows, rules) == brute(rows, rules)


def test_distrust_reaches_hosts_that_link_to_blocked_ones(spark):
    link = '<a href="http://bad.net/">x</a>'
    rows = [(i, f"http://bad.net/{i}", "") for i in range(3)] + [(10 + i, f"http://farm.com/en/{i}", link) for i in range(3)] + [(20, "http://calm.com/en/", "")]
    rows += [(30, "http://good.org/", '<a href="http://friend.com/">f</a>' + link), (40, "http://friend.com/en/", link)]
    got = {r[1]: r[4] for r in judged(spark, rows, [("bad.net", "/", "block"), ("good.org", "/", "allow")])}
    assert got == {"bad.net": "block", "farm.com": "block", "calm.com": "allow", "good.org": "allow", "friend.com": "allow"}


@pytest.mark.parametrize("linkers", [2, 3, 100])
def test_any_number_of_hosts_that_link_only_to_a_blocked_one(spark, linkers):
    link = '<a href="http://{}/">x</a>'
    rows = [(0, "http://bad.net/", ""), (1, "http://good.org/", link.format("friend.com") + link.format("bad.net"))]
    rows += [(2, "http://friend.com/", link.format("bad.net")), (3, "http://second.com/", link.format("farm0.com"))]
    rows += [(4, "http://many.com/", link.format("bad.net") + "".join(link.format(f"calm{i}.com") for i in range(9)))]
    rows += [(10 + i, f"http://farm{i}.com/", link.format("bad.net")) for i in range(linkers)]
    got = {r[1]: r[4] for r in judged(spark, rows, [("bad.net", "/", "block"), ("good.org", "/", "allow")])}
    assert got == {"bad.net": "block", "good.org": "allow", "friend.com": "allow", "second.com": "block", "many.com": "allow"} | {
        f"farm{i}.com": "block" for i in range(linkers)}


def test_empty_tables(spark):
    assert judged(spark, [], URL_RULES) == []
    assert judged(spark, [(1, None, None)], URL_RULES) == [(1, "", "", None, "allow")]
