import math
import random
import re

import pytest
from conftest import *  # noqa: F403
from pyspark.sql import functions as F

from tidemark.llm import decontamination, page_outcomes, pii, queries, url_reputation

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    s = [int(c) for c in reversed(d)]
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(s)) % 10 == 0


def base(text):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            fine = {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m[0].split(".")), "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]
            if fine:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


TEXTS = [
    "a@b.c_d@e.f x", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.0004", "+1 (2) 3.4-5 67890123456 +12", "4111 1111 1111 1111 4111-1111-1111-1111 4111111111111112",
    None, "", "x" * 20_000 + "@y.z", "1" * 20_000, "é😀 a@b.cd 😀 1.1.1.1", "+1" + " " * 5000, "a@b.c" * 3, "user@x..y user@x.y.", "9" * 16 + " " + "0" * 17, "a@b.cc " * 600,
]


def test_base_spans(spark):
    rows = pii.extract(docs_of(spark, list(enumerate(TEXTS)))).select("doc_id", pii.written(F.col("base")), pii.written(F.col("spans"))).collect()  # noqa: F405
    assert {r[0]: r[1] for r in rows} == {i: base(t) for i, t in enumerate(TEXTS)}
    assert all(r[1] == r[2] for r in rows)


def test_patterns_discover_unseen_identifiers(spark):
    rows = [(i, f"moss call: +1 (555) 123-{4000 + i} river the +1 (555) 222-{4000 + i}") for i in range(12)]
    rows += [(100, "slate call: 555 123 9999 thyme"), (101, "slate the 555 123 9999 thyme"), (102, "call: 12 and call: me")]
    rows += [(200 + i, f"the {7_000_000 + i}") for i in range(10)]
    got = {r[0]: r[1] for r in pii.extract(docs_of(spark, rows)).select("doc_id", pii.written(F.col("spans"))).collect()}  # noqa: F405
    assert got[100] == "phone:12:24" and got[101] == got[102] == got[200] == ""


def test_failed_matches_block_no_discovery(spark):
    rows = [(i, f"moss call: +1 (555) 123-{4000 + i} river") for i in range(12)]
    rows += [(100, "slate call: 555 123 9999 thyme"), (101, "slate call: 555 123 9999 thyme 1234567890123456"), (102, "call: 555 123 8888 and 9999999999999999")]
    rows += [(200 + i, f"card: {n} moss") for i, n in enumerate(("4111 1111 1111 1111", "4111 1111 1111 1112", "4111 1111 1111 1112"))]
    docs = docs_of(spark, rows)  # noqa: F405
    got = {r[0]: r[1] for r in pii.extract(docs).select("doc_id", pii.written(F.col("spans"))).collect()}  # noqa: F405
    assert got[100] == got[101] == "phone:12:24" and got[102] == "phone:6:18" and got[201] == ""
    matches = [r for r in pii.placed(pii.texts_apart(docs, "doc_id", "text")).collect() if r.value.startswith("123456789")]
    assert [(m.name, m.seed, m.fine) for m in matches] == [("card", True, False)]


def brute_scores(edges, rounds):
    """Confidence and support of every pattern, over dictionaries. edges: pattern, inst, weight, scores, fixed."""
    score = {(inst, k): s for _, inst, _, scores, _ in edges for k, s in scores.items()}
    fixed = {inst: f for _, inst, _, _, f in edges}
    by_pattern, by_inst = {}, {}
    for p, inst, w, _, _ in edges:
        by_pattern.setdefault(p, []).append((inst, w))
        by_inst.setdefault(inst, []).append(p)
    for n in range(rounds):
        conf = {(p, k): sum(w * score[i, k] for i, w in uses) / (sum(w for _, w in uses) + pii.DOUBT) for p, uses in by_pattern.items() for k in pii.KINDS}
        if n < rounds - 1:
            score = {(i, k): s if fixed[i] else max(conf[p, k] for p in by_inst[i]) for (i, k), s in score.items()}
    held = {(p, k): sum(fixed[i] and score[i, k] > 0 for i, _ in uses) for p, uses in by_pattern.items() for k in pii.KINDS}
    return {(p, k): c for (p, k), c in conf.items() if c >= pii.CONFIDENCE and held[p, k] >= pii.SUPPORT}


def test_scoring_rounds_equal_brute_force(spark):
    r = random.Random(3)
    texts = []
    for i in range(300):
        number = r.choice([f"+1 (555) 123-{r.randrange(40):04}", f"555 123 {r.randrange(40):04}", f"10.0.{r.randrange(9)}.{r.randrange(300)}", f"a{r.randrange(30)}@b.cd", f"a{r.randrange(30)} [at] b [dot] cd", f"{r.randrange(10**7, 10**8)}"])
        texts.append((i, f"moss {r.choice(['call:', 'mail', 'ip', 'the'])} {number} {r.choice(['now', 'then', ''])}"))
    matches = pii.placed(pii.texts_apart(docs_of(spark, texts), "doc_id", "text")).cache()  # noqa: F405
    edges = pii.graph(matches)
    plain = [((e.left, e.right, e.shape), e.inst, e.w, {k: e[f"s_{k}"] for k in pii.KINDS}, e.fixed) for e in edges.collect()]
    got = {((p.left, p.right, p.shape), p.kind): p.conf for p in pii.patterns(edges).collect()}
    want = brute_scores(plain, pii.ROUNDS)
    assert got.keys() == want.keys() and want and all(abs(got[k] - c) < 1e-9 for k, c in want.items())
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in pii.extract(docs_of(spark, texts)).collect()}  # noqa: F405
    written = [i for i, t in texts if "[at]" in t]
    assert written and all(spans[i] == [("email", t.index("a", t.index(" a")), t.index("cd") + 2)] for i, t in texts if i in written)


def test_hidden_identifiers_are_found_again(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.kind: r for r in pii.rediscovery(docs).collect()}
    for kind in ("email", "phone"):
        assert got[kind].found >= 0.9 * got[kind].hidden > 0 and got[kind].wrong == 0
    assert sum(r.wrong for r in got.values()) <= 0.05 * sum(r.found for r in got.values())


def test_texts_of_very_many_matches(spark):
    n = 200_000
    docs = docs_of(spark, [(1, "a@b.cd 555-123-4567 " * n), (2, "1.2.3.4 ")])  # noqa: F405
    got = {r.doc_id: r for r in pii.extract(docs).select("doc_id", F.size("base").alias("n"), F.element_at("base", -1).alias("last")).collect()}
    assert got[1].n == n and (got[1].last.start, got[1].last.end) == (20 * (n - 1), 20 * (n - 1) + 6) and got[2].n == 1
    text = {r.doc_id: r.text for r in pii.redact(docs, 100).collect()}
    assert text[1] == "<email> 555-123-4567 " * n and text[2] == "<ip> "


def test_masks_across_blocks(spark):
    texts = [("é" * k) + " a@b.cd " + ("😀" * m) + " +1 (555) 123-4567" for k, m in ((0, 0), (1022, 5), (1016, 1024), (1017, 2100), (3000, 1))]
    docs = docs_of(spark, list(enumerate([*texts, "a@b.cd", "x" * 1024 + "1.1.1.1"])))  # noqa: F405
    got = {r.doc_id: r.text for r in pii.redact(docs, 100).collect()}
    for i, t in enumerate(texts):
        assert got[i] == t.replace("a@b.cd", "<email>").replace("+1 (555) 123-4567", "<phone>")
    assert got[5] == "<email>" and got[6] == "x" * 1024 + "<ip>"


def test_masking(spark, edge):
    docs = docs_of(spark, [(1, "é a@b.cd x"), (1, "plain"), (2, None), (3, "+1 (555) 123-4567"), (3, "+1 (555) 123-4567")])  # noqa: F405
    rows = pii.redact(docs, 100).collect()
    assert sorted((r.doc_id, r.text or "", r.n_chars) for r in rows) == [(1, "plain", 5), (1, "é <email> x", 11), (2, "", None), (3, "<phone>", 7), (3, "<phone>", 7)]
    assert pii.redact(edge, 0).columns == edge.columns and pii.redact(edge, 0).count() == edge.count()
    assert pii.redact(edge.where("false"), 0).count() == 0


def test_overlapping_spans_are_masked_whole(spark):
    docs = docs_of(spark, [(1, "moss 4111 1111 1111 1111@x.com slate"), (2, "a@b.cd moss")])  # noqa: F405
    assert {r.doc_id: r.text for r in pii.redact(docs, 100).collect()} == {1: "moss <card> slate", 2: "<email> moss"}


def brute_windows(docs, items, size=10):
    win = {}
    for name, text in items:
        w = decontamination.words(text) if name is not None else []
        n = min(size, len(w))
        for i in range(len(w) - n + 1) if w else ():
            win.setdefault(tuple(w[i : i + n]), set()).add(str(name))
    out = []
    for i, text in docs:
        w = decontamination.words(text)
        hit, names = set(), set()
        for p in range(len(w)):
            for n in {len(x) for x in win}:
                found = win.get(tuple(w[p : p + n])) if p + n <= len(w) else None
                if found:
                    hit |= set(range(p, p + n))
                    names |= found
        out.append((i, len(w), len(hit), sorted(names)))
    return out


@pytest.mark.parametrize("segment,chunk", [(4 << 20, 2_000_000), (300, 20)])
def test_decontamination_equals_brute_force(spark, monkeypatch, segment, chunk):
    monkeypatch.setattr(decontamination, "SEGMENT", segment)
    monkeypatch.setattr(decontamination, "CHUNK", chunk)
    a, b = prose(7, 25), prose(8, 12)  # noqa: F405
    items = [(1, a), (2, b.upper()), (3, "Too short"), (4, None), (5, "..."), (1, a), (None, b), (10, "moss")]
    docs = [(1, f"x {a} y {b}!"), (2, a[: len(a) // 2]), (3, None), (4, ""), (5, "it is too SHORT, too short"), (6, prose(9, 3000) + " " + b), (6, prose(9, 3000) + " " + b), (None, a), (7, "mossy Moss")]  # noqa: F405
    found = decontamination.decontaminate(docs_of(spark, docs), spark.createDataFrame(items, "item_id long, text string"))  # noqa: F405
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found.collect()), key=repr)
    assert got == sorted(brute_windows(docs, items), key=repr)


def test_segments_of_equal_ids_stay_apart(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "CHUNK", 20)
    a, b = prose(7, 25), prose(8, 12)  # noqa: F405
    items = [(1, a), (2, b)]
    docs = [(i, f"{prose(60 + n, 100)} {end}") for n, (i, end) in enumerate([(6, a), (6, b), (6, "moss"), (None, a), (None, "moss")])]  # noqa: F405
    parts = docs_of(spark, docs[:1])  # noqa: F405
    for d in docs[1:]:
        parts = parts.union(docs_of(spark, [d]))  # noqa: F405
    found = decontamination.decontaminate(parts, spark.createDataFrame(items, "item_id long, text string"))  # noqa: F405
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found.collect()), key=repr)
    assert got == sorted(brute_windows(docs, items), key=repr)


def test_spans_and_nearness(spark, empty):
    phrase = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = docs_of(spark, [(1, f"one two {phrase} three"), (2, "alpha beta x gamma delta zeta epsilon eta theta y iota kappa"), (3, "alpha kappa")])  # noqa: F405
    index = decontamination.build_index(docs)
    items = spark.createDataFrame([(1, phrase)], "item_id long, text string")
    spans = {r.doc_id: [(s["from"], s["to"]) for s in r.spans] for r in decontamination.probe(index, items).collect()}
    assert spans == {1: [(2, 12)], 2: [], 3: []}
    near = {(r["doc_id"], r["from"], r["to"]) for r in decontamination.near(index, [("p", phrase)], slop=3).collect()}
    assert near == {(1, 2, 12), (2, 0, 12)}
    unnamed = docs_of(spark, [(None, phrase), (0, "moss")])  # noqa: F405
    assert [(r["doc_id"], r["from"], r["to"]) for r in decontamination.near(decontamination.build_index(unnamed), [("p", phrase)]).collect()] == [(None, 0, 10)]
    assert decontamination.decontaminate(empty, items).count() == 0
    assert decontamination.decontaminate(docs, items.where("false")).where("n_hit > 0").count() == 0


RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/")]


def test_rules_and_parts(spark):
    rows = [(1, "http://Example.COM/en/a?x#y"), (2, "https://www.example.com/en/"), (3, "http://a.net/es/1"), (4, "http://b.com"), (5, None), (6, "no url"), (7, "http://notexample.com/en/"), (8, "http://m.net#/es/"), (9, "x://com/"), (9, "x://com/"), (10, "http://a.com:80/é")]
    pages = spark.createDataFrame([(i, u, None, "mine", 5) for i, u in rows], "page_id long, url string, bad int, rule string, domain int")
    got = {r.page_id: (r.host, r.path, r["rule"], r.verdict) for r in url_reputation.judge(pages, RULES, "bad").collect()}
    assert got == {
        1: ("example.com", "/en/a", "example.com/en/", "block"), 2: ("www.example.com", "/en/", "www.example.com/en/", "allow"), 3: ("a.net", "/es/1", "net/es/", "block"), 4: ("b.com", "", None, "allow"),
        5: ("", "", None, "allow"), 6: ("", "", None, "allow"), 7: ("notexample.com", "/en/", "com/", "allow"), 8: ("m.net", "", None, "allow"), 9: ("com", "/", "com/", "allow"), 10: ("a.com:80", "/é", None, "allow"),
    }
    assert url_reputation.judge(pages.where("false"), RULES, "bad").count() == 0


def test_reputation_shrinks_and_blocks(spark):
    rows = [(f"http://bad.spam.org/{i}", 1) for i in range(40)] + [(f"http://good{j}.fine.org/{i}", 0) for j in range(4) for i in range(30)] + [("http://new.spam.org/", None), ("http://one.fine.org/", 1), ("http://1.2.3.4/x", None)]
    pages = spark.createDataFrame([(i, u, b) for i, (u, b) in enumerate(rows)], "page_id long, url string, bad int")
    hosts = {r.host: r for r in url_reputation.judge(pages, [], "bad").groupBy("host").agg(F.first("bad_rate").alias("rate"), F.first("verdict").alias("verdict")).collect()}
    assert hosts["bad.spam.org"].verdict == "block" and hosts["good1.fine.org"].verdict == "allow"
    assert hosts["good1.fine.org"].rate < hosts["one.fine.org"].rate < hosts["bad.spam.org"].rate
    assert hosts["new.spam.org"].rate > hosts["good1.fine.org"].rate


def test_suffixes_part_domains_and_rules_of_any_number(spark):
    hosts = spark.createDataFrame([("a.b.co.uk",), ("c.co.uk",), ("co.uk",), ("x.y.org",), ("org",), ("",), ("1.2.3.4:80",), ("k.city.jp",)], "host string")
    got = {r.host: (r.domain, r.suffix) for r in url_reputation.with_domains(hosts, ("co.uk", "city.jp")).collect()}
    assert got == {"a.b.co.uk": ("b.co.uk", "co.uk"), "c.co.uk": ("c.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "x.y.org": ("y.org", "org"), "org": ("org", "org"), "": ("", ""), "1.2.3.4:80": ("1.2.3.4", "1.2.3.4"), "k.city.jp": ("k.city.jp", "city.jp")}
    rules = [("block", f"h{i}.net/p/") for i in range(3000)] + [("allow", f"h{i}.net/p/q/") for i in range(0, 3000, 2)]
    pages = spark.createDataFrame([(i, f"http://w.h{i}.net/p/{x}", 0) for i in range(0, 3000, 7) for x in ("q/a", "r")], "page_id long, url string, bad int")
    for r in url_reputation.judge(pages, rules, "bad").collect():
        want = ("allow", f"h{r.page_id}.net/p/q/") if r.url.endswith("q/a") and r.page_id % 2 == 0 else ("block", f"h{r.page_id}.net/p/")
        assert (r.verdict, r["rule"]) == want


def brute_bins(text):
    text = re.sub(r"[\x09-\x0D\x20]+", " ", text or "").strip(" ")
    own = text.split(" ")
    n = {k: (sum(bool(re.match(f"[{c}]", x)) for x in text), max(1, len(text))) for k, c in page_outcomes.COUNTED.items()}
    n |= {"gaps": (len(own), max(1, len(text))), "distinct": (len(set(own)), len(own)), "words": (len(own), 1000)}
    return {k: sum(1000 * a >= e * b for e in page_outcomes.EDGES) for k, (a, b) in n.items()}


@pytest.mark.parametrize("few", [page_outcomes.KNOWN_ROWS, 0])
def test_page_outcomes_equal_brute_force(spark, monkeypatch, few):
    monkeypatch.setattr(page_outcomes, "KNOWN_ROWS", few)
    texts = [(i, (prose(i, 30) if i % 3 else "BUY! | NOW! | $$$ 100 " * (i + 1))) for i in range(60)] + [(60, None), (61, "")]  # noqa: F405
    labels = [(i, int(i % 3 != 0)) for i in range(62)] + [(1, 0), (99, 1)]
    judge = page_outcomes.learn(docs_of(spark, texts), spark.createDataFrame(labels, "doc_id long, label int"))  # noqa: F405
    given = [(c, brute_bins(t)) for i, t in texts for j, c in labels if i == j]
    for s in page_outcomes.STATISTICS:
        for b in range(len(page_outcomes.EDGES) + 1):
            share = [(sum(own[s] == b for c, own in given if c == k) + 1) / (sum(c == k for c, _ in given) + len(page_outcomes.EDGES) + 1) for k in (0, 1)]
            assert abs(judge.odds[s, b] - math.log(share[0] / share[1])) < 1e-9
    html = ["<html><script>var a='$$$';</script><article class=x><p>moss &amp; slate river</p></article>BUY! |</html>", "<style>p{}</style><p>BUY! | NOW! | $$$ 100</p>", None, "<p> </p>"]
    pages = spark.createDataFrame([(i, "http://a.net/x", h) for i, h in enumerate(html)] + [(9, "http://www.spam-farm.net/", None), (10, None, html[0])], "page_id long, url string, html string")
    assert [r[0] for r in pages.limit(2).select(page_outcomes.page_text(F.col("html"))).collect()] == ["moss & slate river", "BUY! | NOW! | $$$ 100"]
    got = {r.page_id: r.bad for r in page_outcomes.outcomes(pages, judge, "bad").collect()}
    assert got == {0: 0, 1: 1, 2: None, 3: None, 9: 1, 10: 0}
    assert page_outcomes.learn(docs_of(spark, texts), spark.createDataFrame([(1, 1)], "doc_id long, label int")) is None  # noqa: F405
    assert {r.bad for r in page_outcomes.outcomes(pages, None, "bad").collect()} == {None, 1}


def test_reputation_decides_outside_the_rules(spark):
    rows = [r for r in queries.op8_url_reputation(spark, "/root/testdata/sf0.1").collect() if r["rule"] is None]
    blocked = {r.host for r in rows if r.verdict == "block"}
    named = {r.host for r in rows if set(re.split("[^a-z]+", r.host)) & set(page_outcomes.BAD_WORDS)}
    assert blocked == named != set() and len(blocked) < 0.1 * len({r.host for r in rows})
