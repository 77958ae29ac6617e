import math
import zlib
from collections import Counter

import numpy as np
from conftest import *  # noqa: F403
from pyspark.sql import functions as F

from tidemark.llm import queries, rule_ensemble, toxicity
from tidemark.llm.common import inner

SF = "/root/testdata/sf0.01"


def test_rules_find_the_pattern_and_compile(spark):
    r = np.random.default_rng(0)
    x = r.random((2000, len(rule_ensemble.STATISTICS)))
    y = ((x[:, 2] > 0.5) & (x[:, 4] <= 0.3)).astype(float)
    model = rule_ensemble.fit(x, y)
    assert 0 < len(model.rules) < 60
    df = spark.createDataFrame([tuple(map(float, row)) for row in x[:300]], ", ".join(f"{s} double" for s in rule_ensemble.STATISTICS))
    got = np.array([s[0] for s in df.select(model.column(F.col)).collect()])
    total = model.intercept + sum(w * rule.on(x[:300]) for w, rule in model.rules)
    assert np.allclose(got, 1 / (1 + np.exp(-total)))
    assert ((got >= 0.5) == y[:300]).mean() > 0.98


def test_weights_are_the_lasso_optimum():
    """Karush-Kuhn-Tucker conditions: the loss's slope is -l1 * sign where a weight is not zero, and no steeper than l1 where it is; zero at the intercept."""
    r = np.random.default_rng(4)
    x = (r.random((1500, 12)) < 0.4).astype(np.float64)
    y = (r.random(1500) < 1 / (1 + np.exp(-(2 * x[:, 0] - 3 * x[:, 1] + 0.5)))).astype(np.float64)
    for l1 in (0.002, 0.02, 0.2):
        first, weights = rule_ensemble.lasso_logistic(x, y, l1=l1, rounds=3000)
        off = 1 / (1 + np.exp(-(first + x @ weights))) - y
        slope = x.T @ off / len(y)
        on = weights != 0
        assert abs(off.mean()) < 1e-5 and np.allclose(slope[on], -l1 * np.sign(weights[on]), atol=1e-5) and (np.abs(slope[~on]) <= l1 + 1e-5).all()
    assert not weights.any()


def test_the_quality_query_equals_brute_force(spark):
    """Every document's score from its statistics, rule by rule; the fit sees only the rows it may."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = queries.quality_model(spark, docs, SF)
    got = {r.doc_id: r for r in queries.op3_quality_rules(spark, SF).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows) and 0 < len(model.rules)
    for r in rows:
        own = dict(zip(rule_ensemble.STATISTICS, rule_ensemble.statistics(r.text)))
        total = model.intercept
        for w, rule in model.rules:
            total += w if all((own[n] > t) if above else (own[n] <= t) for n, above, t in rule.parts) else 0.0
        p = 1 / (1 + math.exp(-total))
        assert abs(got[r.doc_id].score - p) < 1e-9 and got[r.doc_id].predicted == int(p >= 0.5)
        assert got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if zlib.crc32(str(r.doc_id).encode()) % 3 != 1}
    seen = [(rule_ensemble.statistics(r.text), labels[r.doc_id]) for r in rows if r.doc_id in labels]
    again = rule_ensemble.fit(np.array([x for x, _ in seen]), np.array([y for _, y in seen], float))
    # the order of the rows moves sums in their last digits, and with them rules that weigh next to nothing
    x = np.array([rule_ensemble.statistics(r.text) for r in rows])
    total = lambda m: m.intercept + sum(w * rule.on(x) for w, rule in m.rules)
    assert np.abs(total(again) - total(model)).max() < 0.05


def test_quality_keeps_columns_of_any_name(spark, edge):
    model = rule_ensemble.learn(edge, spark.createDataFrame([(1, 1), (9, 0)], "doc_id long, label int"))
    rows = rule_ensemble.score(edge, model, "own").collect()
    assert set(rows[0].asDict()) == {*edge.columns, "own"} and {r._stats for r in rows} == {7}


def test_quality_edges(spark, edge, empty):
    labels = spark.createDataFrame([(1, 1), (2, 0), (6, 1), (6, 0), (None, 1), (9, None)], "doc_id long, label int")
    model = rule_ensemble.learn(edge, labels)
    rows = rule_ensemble.score(edge, model).collect()
    assert len(rows) == edge.count() and all(0 <= r.score <= 1 for r in rows)
    none = rule_ensemble.learn(edge, labels.where("false"))
    assert {r.score for r in rule_ensemble.score(edge, none).collect()} == {0.5}
    assert rule_ensemble.score(empty, rule_ensemble.learn(empty, labels)).count() == 0
    assert set(rule_ensemble.score(edge, none).columns) == set(edge.columns)


def held_out(spark, name, label, least):
    rows = queries.QUERIES[name](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r[label] for r in rows]) >= least


def test_quality_on_held_out_labels(spark):
    held_out(spark, "op3_quality_rules", "quality", 0.97)


def test_toxicity_on_held_out_labels(spark):
    held_out(spark, "op6_toxicity", "toxic", 0.93)


def toxic_docs():
    rows = [(i, prose(i, 40) + (" vilething" if i % 4 == 0 else "")) for i in range(400)]  # noqa: F405
    return rows, [(i, int(i % 4 == 0)) for i in range(400)]


def spelled(word):
    n = min(len(word), toxicity.LONGEST)
    return [(word[:k], word[k]) for k in range(n)] + [(word[:n], word[n:] + "$")]


class BruteForce:
    """The two models over dictionaries. texts: pairs of a text and its class."""

    def __init__(self, texts):
        self.n = {c: Counter() for c in "tos"}
        for text, toxic in set(texts):
            for w in set(toxicity.words(text)):
                for s in spelled(w.decode()):
                    self.n["t" if toxic else "o"][s] += 1
                    self.n["s"][s] += 1
        self.follows = Counter(x for _, x in self.n["s"])

    def of(self, c, h, d):
        counts = [v for (own, _), v in self.n[c].items() if own == h]
        return sum(counts), sum(min(v, d) for v in counts)

    def shared(self, h, x):
        n, m = self.of("s", h, toxicity.SHARED_DISCOUNT)
        return (max(self.n["s"][h, x] - toxicity.SHARED_DISCOUNT, 0) + m * self.follows[x] / sum(self.follows.values())) / n

    def p(self, c, h, x):
        n, m = self.of(c, h, toxicity.DISCOUNT)
        return (max(self.n[c][h, x] - toxicity.DISCOUNT, 0) + m * self.shared(h, x)) / n if n else self.shared(h, x)

    def difference(self, word):
        total = 0.0
        for h, x in spelled(word):
            if not self.n["s"][h, x]:
                n = {c: self.of(c, h, toxicity.DISCOUNT) for c in "to"}
                lost = {c: np.log(v[1] / v[0]) if v[0] else 0.0 for c, v in n.items()}
                return total + lost["t"] - lost["o"]  # what follows is left to the shared counts in both
            total += np.log(self.p("t", h, x)) - np.log(self.p("o", h, x))
        return total


SHORT = ["moss moss mosaic slate", "moss slate slates", "river mosses ab", "éclair river moss", "extraordinarily slate", "extraordinary river", "moss slate slates"]


def test_toxicity_model_equals_brute_force(spark, monkeypatch):
    texts = [(t, i % 2) for i, t in enumerate(SHORT)]
    rows = spark.createDataFrame([(t, c, i % 3 % 2) for i, (t, c) in enumerate(dict.fromkeys(texts))], "text string, toxic int, half int")
    counts = toxicity.expression_counts(rows).cache()
    brute = BruteForce(texts)
    assert {(r.h, r.x): r.t0 + r.t1 for r in counts.collect() if r.t0 + r.t1} == dict(brute.n["t"])
    got = toxicity.conditionals(counts).collect()
    assert len(got) == len(brute.n["s"])
    for r in got:
        assert np.isclose(np.exp(r.t_r), brute.p("t", r.h, r.x)) and np.isclose(np.exp(r.o_r), brute.p("o", r.h, r.x))
    for h in {r.h for r in got}:
        for c in "to":
            assert np.isclose(sum(brute.p(c, h, x) for x in brute.follows), 1)
    model = toxicity.KneserNey(toxicity.differences(counts).cache(), np.zeros(toxicity.N_FEATURES + 1), toxicity.MODEL_ROWS)
    new = [(1, "moss mosx moss zzz"), (2, "extraordinarilyish river slate"), (3, None), (4, "é éclairs ab abc a")]
    want = {i: Counter({w: n for w, n in Counter(x.decode() for x in toxicity.words(t)).items()}) for i, t in new}
    for rows_held, head in ((toxicity.MODEL_ROWS, 0), (0, 0), (0, 3), (0, 1000)):
        model.model_rows = rows_held
        monkeypatch.setattr(toxicity, "HEAD", head)
        for r in model.differences(docs_of(spark, new)).collect():  # noqa: F405
            found = r[inner("llr")]
            each = sorted((brute.difference(w) for w in want[r.doc_id]), reverse=True)
            assert np.isclose(found.llr, sum(n * brute.difference(w) for w, n in want[r.doc_id].items())) and found.n == sum(want[r.doc_id].values())
            assert np.allclose(found.peaks, [each[k - 1] if len(each) >= k else 0.0 for k in toxicity.PEAKS])


def llr(model, rows, spark):
    return {r.doc_id: r[inner("llr")] for r in model.differences(docs_of(spark, rows)).collect()}  # noqa: F405


def test_toxicity_backs_off_to_beginnings_and_keeps_rare_words(spark):
    rows, labels = toxic_docs()
    rows += [(900 + i, prose(900 + i, 30) + " oncewas") for i in range(1)]  # noqa: F405
    model = toxicity.learn(docs_of(spark, rows), spark.createDataFrame([*labels, (900, 1)], "doc_id long, label int"))  # noqa: F405
    got = llr(model, [(1, "vilethings"), (2, "moss1"), (3, None), (4, ""), (5, "oncewas")], spark)
    assert got[1].llr > 1 and abs(got[2].llr) < 0.5 and got[3].n == got[4].n == 0 and got[5].llr > 0.5


def test_toxicity_counts_copies_once():
    text = prose(5, 50)  # noqa: F405
    assert toxicity.family(text) == toxicity.family(text)
    assert toxicity.family(None) == toxicity.family("")


def test_toxicity_counts_all_but_equal_texts(spark):
    passage = prose(6, 200)  # noqa: F405
    texts = [(i, f"{passage} own{i}", i % 2) for i in range(20)] + [(20, f"{passage} own0", 0), (21, f"{passage} own0", 1), (22, None, 0), (23, "", 0)]
    rows = spark.createDataFrame([(n, *t[1:]) for n, t in enumerate(texts)], "_row long, text string, toxic int")
    got = [(r.text or "", r.toxic) for r in toxicity.distinct_texts(rows).collect()]
    assert sorted(got) == sorted({(t or "", c) for _, t, c in texts})
    docs = docs_of(spark, [(i, f"{passage} {'vilething' if i < 8 else 'moss'} own{i}") for i in range(80)])  # noqa: F405
    model = toxicity.learn(docs, spark.createDataFrame([(i, int(i < 8)) for i in range(80)], "doc_id long, label int"))
    assert llr(model, [(1, "vilething")], spark)[1].llr > 1


def test_toxicity_edges(spark, edge, empty):
    labels = spark.createDataFrame([(1, 1), (2, 0), (6, 1), (6, 0), (None, 1), (9, None)], "doc_id long, label int")
    rows = toxicity.learn(edge, labels).score(edge).collect()
    assert len(rows) == edge.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in toxicity.learn(edge, labels.where("false")).score(edge).collect()} == {0.5}
    assert toxicity.learn(empty, labels).score(empty).count() == 0
