"""URL and quality rules."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyward.llm import quality, urls
from tallyward.llm.queries import RULES

URLS = [
    ("http://A.Example.NET/en/x?y#z", "a.example.net", "/en/x", "example.net/en/", "allow"),
    ("https://example.net/de", "example.net", "/de", "net/", "block"),
    ("https://example.net", "example.net", "", None, None),
    ("x://example.com/de/1", "example.com", "/de/1", "example.com/de/", "block"),
    ("x://notexample.com/de/1", "notexample.com", "/de/1", None, None),
    ("x://a.b.org/fr/?q", "a.b.org", "/fr/", "org/fr/", "allow"),
    ("x://Ü.org#f://g/h", "Ü.org", "", None, None),
    ("no host", "", "", None, None), ("", "", "", None, None), (None, "", "", None, None),
    ("a:b://c.net/://d", "c.net", "/://d", "net/", "block"),
]


def test_rules(spark):
    rows = [(i, u, None, "own") for i, (u, *_) in enumerate(URLS)]
    pages = spark.createDataFrame(rows + rows[:2], "page_id long, url string, html string, verdict string")
    found = urls.judge(pages, RULES).collect()
    assert len(found) == len(URLS) + 2
    for r in found:
        _, host, path, rule, verdict = URLS[r.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")
    assert urls.judge(pages.limit(0), RULES).count() == 0


def test_trust_and_distrust_follow_links(spark):
    link = lambda *hosts: " ".join(f"<a href='https://{h}/x'>" for h in hosts)
    rows = [
        (1, "http://good.org/fr/", link("friend.info", "GOOD.org")),
        (2, "http://friend.info/", link("further.info")),
        (3, "http://further.info/", None),
        (4, "http://bad.net/", link("good.org")),
        (5, "http://fan.info/", link("bad.net", "bad.net")),
        (6, "http://alone.info/", "<a href='/rel'>"),
        (7, "http://" + "a." * 300 + "info/", ""),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    verdicts = {r.page_id: r.verdict for r in urls.judge(pages, RULES).collect()}
    assert verdicts == {1: "allow", 2: "allow", 3: "allow", 4: "block", 5: "block", 6: "allow", 7: "allow"}


def test_scores_equal_power_iteration(spark):
    pick = random.Random(4)
    hosts = [f"h{i}" for i in range(12)]
    edges = Counter((pick.choice(hosts), pick.choice(hosts)) for _ in range(40))
    links = [(a, b, float(w)) for (a, b), w in edges.items() if a != b]
    seeds = {"h0": (1.0, 0.0), "h1": (0.0, 0.5), "h2": (0.0, 0.5)}
    got = urls.spread(
        spark.createDataFrame(links, "source string, target string, weight double"),
        spark.createDataFrame([(h, *s) for h, s in seeds.items()], "host string, trust double, distrust double"),
    ).collect()
    want = [{h: 0.15 * seeds.get(h, (0, 0))[k] for h in hosts} for k in (0, 1)]
    for k, ways in ((0, links), (1, [(b, a, w) for a, b, w in links])):
        out = Counter()
        for a, _, w in ways:
            out[a] += w
        start = dict(want[k])
        for _ in range(urls.ROUNDS):
            new = dict(start)
            for a, b, w in ways:
                new[b] += 0.85 * want[k][a] * w / out[a]
            want[k] = new
    for r in got:
        assert r.trust == pytest.approx(want[0][r.host]) and r.distrust == pytest.approx(want[1][r.host])


def measured(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(5)}
    failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated), failed


@pytest.fixture(scope="module")
def docs(spark):
    pick, rows = random.Random(7), []
    for n in range(400):
        words = [pick.choice("abcdefghijklmnop") * pick.randrange(3, 7) + str(pick.randrange(60)) for _ in range(60)]
        rows.append((n, " ".join(words[:30]) + "\n" + " ".join(words[30:]), "en" if n % 3 else None, f"s{n % 2}", "own"))
    junk = " ".join(f"w{i}***" for i in range(40))
    odd = [
        (500, None, "en", "s1"), (501, "", "en", "s1"), (502, "one two", None, None), (503, junk, "en", "s1"),
        (504, "a b c d e f g\n" * 4, "en", "s0"), (505, "é日 \x0b #x\t\r\n\n ok\n ok", "q", "q"), (506, junk, None, "s1"),
        (507, "x y z q w " * 2000, "en", "s0"), (None, " ".join(f"word{i}" for i in range(30)), "lone", "z"),
    ]
    return spark.createDataFrame(rows + [(*o, "own") for o in odd] + rows[:1], "doc_id long, text string, lang string, source string, kept string")


def test_measures_and_verdicts(docs):
    found = quality.judge(docs).collect()
    assert len(found) == 410
    for r in found:
        want = measured(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want
        assert not (r.base_failed and r.kept)
    kept = {r.doc_id: r.kept for r in found}
    assert all(kept[n] for n in range(400)) and not kept[503] and not kept[506] and kept[None]
    assert quality.judge(docs.limit(0)).count() == 0


def test_fences_of_small_groups_come_from_the_language(docs):
    rows = {(r.group_lang, r.group_source): r for r in quality.fences(quality.measure(docs)).collect()}
    assert rows["lone", "z"].word_length.low is not None and ("en", "s1") in rows and (None, "s0") in rows
    for r in rows.values():
        for name in quality.MEASURES:
            assert r[name].low is None or (r[name].reach > 0 and r[name].high >= r[name].low)


def test_fences_equal_exact_quantiles(spark):
    """Sketches of so few texts are exact, so fences equal those from sorted values; the group of
    three texts takes those of its language."""
    pick, rows = random.Random(11), []
    for n in range(180):
        words = ["abcdefgh"[: pick.randrange(3, 8)] + str(k) for k in range(pick.randrange(20, 40))]
        for _ in range(pick.choice([0, 0, 0, 0, 0, 0, 1, 2])):
            words[pick.randrange(len(words))] += "#"
        rows.append((n, "\n".join(" ".join(words[k : k + 9]) for k in range(0, len(words), 9)), "en", "small" if n < 3 else f"s{n % 2}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    at = lambda values, q: sorted(values)[max(0, -int(-q * len(values) // 1) - 1)]
    for r in quality.fences(quality.measure(docs)).collect():
        texts = [t for _, t, _, source in rows if r.group_source in ("small", source)]
        counts = [measured(t) for t in texts]
        n_lines = [t.count("\n") + 1 for t in texts]
        shares = {
            "word_length": ([c[1] / c[0] for c in counts], [c[0] for c in counts]),
            "symbol_share": ([c[2] / c[1] for c in counts], [c[1] for c in counts]),
            "dup_line_share": ([c[3] / m for c, m in zip(counts, n_lines)], n_lines),
        }
        for name, (values, sizes) in shares.items():
            low, mid, high, tail = (at(values, q) for q in (0.25, 0.5, 0.75, 0.9))
            reach = quality.SPREAD * (high - low if high > low else max(tail - mid, 1 / at(sizes, 0.5)))
            assert (r[name].low, r[name].high, r[name].reach) == pytest.approx((low, high, reach)), name


def test_a_few_symbols_fail_no_short_text_and_many_fail_a_long_one(spark):
    words = lambda n: " ".join(f"wo{k:04d}" for k in range(n))
    rows = [(n, f"{words(40)} wo{n + 5000}", "en", "s") for n in range(100)]
    odd = [(900, f"{words(11)} ###### wo9999", "en", "s"), (901, f"{words(40)} {' '.join(['###k#!'] * 4)}", "en", "s"),
           (902, f"{words(4000)} ######", "en", "s")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality.judge(docs).collect()}
    assert all(kept[n] for n in range(100)) and kept[900] and kept[902] and not kept[901]
    assert quality.shares().keys() == quality.MEASURES.keys()


def test_quality_takes_any_other_columns(docs):
    names = ["row", "group_lang", "word_length", "_counts", "N_LINES", "symbol_share", "n", "of"]
    odd = docs.withColumns({n: F.lit("own") for n in names})
    found = quality.judge(odd)
    assert [c for c in found.columns if c in names] == [n for n in names if n != "N_LINES"]
    assert found.count() == 410 and {r.word_length for r in found.collect()} == {"own"}
    assert quality.judge(odd, columns=["doc_id", "of"]).columns == ["doc_id", "of", *quality.NEW]
    assert quality.judge(odd.limit(0)).count() == 0


def test_fences_follow_the_quartiles(spark):
    """Word lengths of 5.0 to 5.2; a text of 8.5 is far outside, a language of 2 texts has the fences of all."""
    text = lambda long: " ".join(f"{'abcdef'[k % 6]}{k:0{5 if k < long else 4}d}" for k in range(20))
    rows = [(n, text(n % 5), "en", f"s{n % 2}") for n in range(200)]
    odd = [(900, " ".join(f"abcd{k:04d}" + "x" * (k % 2) for k in range(20)), "en", "s0")]
    odd += [(901 + k, " ".join(f"abcdefgh{k}{i:03d}" for i in range(20)), "rare", "s0") for k in range(2)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality.judge(docs).collect()}
    assert not kept[900] and sum(kept[n] for n in range(200)) == 200
    assert not kept[901] and not kept[902]


def test_scores_reach_the_end_of_a_chain_and_converge(spark):
    """A chain of 30 hosts from a blocked one, and a host that trust reaches sooner than distrust."""
    chain = [(f"c{i + 1}", f"c{i}", 1.0) for i in range(30)]
    ring = [("a", "b", 1.0), ("b", "a", 1.0), ("b", "c", 3.0), ("c", "a", 1.0)]
    seeds = [("c0", 0.0, 0.5), ("a", 1.0, 0.0), ("b", 0.0, 0.5)]
    got = urls.spread(
        spark.createDataFrame(chain + ring, "source string, target string, weight double"),
        spark.createDataFrame(seeds, "host string, trust double, distrust double"),
    ).collect()
    found = {r.host: (r.trust, r.distrust) for r in got}
    for i in range(31):
        assert found[f"c{i}"] == pytest.approx((0.0, 0.15 * 0.5 * 0.85**i))
    hosts = "abc"
    for k, ways in ((0, ring), (1, [(b, a, w) for a, b, w in ring])):
        system = np.eye(3)
        for a, b, w in ways:
            system[hosts.index(b), hosts.index(a)] -= 0.85 * w / sum(x for s, _, x in ways if s == a)
        start = [0.15 * dict((h, s) for h, *s in seeds).get(h, (0, 0))[k] for h in hosts]
        for h, want in zip(hosts, np.linalg.solve(system, start)):
            assert found[h][k] == pytest.approx(want)
