import pytest
from conftest import *  # noqa: F403

corpus_pipeline = pytest.importorskip("corpus_pipeline")

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_run_equals_them(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert sorted(docs.columns) == sorted(columns)
    by_hand = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert sorted(by_hand.collect()) == sorted(corpus_pipeline.run(spark, SF).collect())


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_edges(spark, edge, empty, name, stage):
    assert stage(spark, empty, SF).count() == 0
    out = stage(spark, edge, SF)
    if name == "packing":
        assert {r[0] for r in out.select("doc_id").collect()} == {r[0] for r in edge.select("doc_id").collect()}
    else:
        assert sorted(out.columns) == sorted(edge.columns)
        assert out.count() <= edge.count()


def test_one_of_each_group_stays(spark, edge):
    ids = sorted((r[0] for r in corpus_pipeline.near_duplicates(spark, edge, SF).select("doc_id").collect()), key=str)
    assert ids.count(6) == 1 and 1 in ids and 2 not in ids and None in ids and {3, 4, 5} <= set(ids)


def test_benchmark_passages_go_and_masks_show(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    docs = docs_of(spark, [(1, f"moss {item} slate"), (2, "moss slate mail a@b.cd")])  # noqa: F405
    left = corpus_pipeline.decontaminated(spark, docs, SF)
    assert [r.doc_id for r in left.collect()] == [2]
    assert corpus_pipeline.masked(spark, left, SF).first().text == "moss slate mail <email>"


def test_a_repeated_id_takes_no_other_texts_along(spark):
    text = {c: prose(40 + n, 60) for n, c in enumerate("abcdef")}  # noqa: F405
    rows = [(1, "a"), (1, "a"), (2, "b"), (2, "c"), (None, "d"), (None, "e"), (0, "f"), (3, "f"), (3, "a")]
    docs = docs_of(spark, [(i, text[c]) for i, c in rows] + [(4, ""), (4, ""), (None, ""), (None, None)])  # noqa: F405
    left = corpus_pipeline.near_duplicates(spark, docs, SF).select("doc_id", "text").collect()
    name = {v: k for k, v in text.items()}
    got = sorted(((r.doc_id, name.get(r.text, "")) for r in left), key=str)
    assert got == sorted([(1, "a"), (2, "b"), (2, "c"), (None, "d"), (None, "e"), (0, "f"), (4, ""), (None, ""), (None, "")], key=str)


def test_rows_without_an_id_are_decided_like_others(spark):
    w = prose(50, 200).split()  # noqa: F405
    copy, middle, far = " ".join(w), " ".join([*w[:-12], *["new"] * 12]), " ".join([*["other"] * 12, *w[12:-12], *["new"] * 12])
    docs = docs_of(spark, [(None, prose(51, 60)), (None, prose(51, 60)), (1, prose(52, 60)), (None, prose(52, 59) + " changed"), (8, copy), (None, middle), (9, far)])  # noqa: F405
    left = corpus_pipeline.near_duplicates(spark, docs, SF).collect()
    assert sorted(((r.doc_id, r.text) for r in left), key=str) == sorted([(None, prose(51, 60)), (1, prose(52, 60)), (8, copy)], key=str)  # noqa: F405
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    docs = docs_of(spark, [(None, f"moss {item} slate"), (None, "moss slate"), (1, f"{item}"), (1, "river slate")])  # noqa: F405
    assert sorted(r.text for r in corpus_pipeline.decontaminated(spark, docs, SF).collect()) == ["moss slate", "river slate"]


def test_the_pipeline_equals_brute_force(spark, tmp_path):
    """Planted junk, copies, benchmark passages and personal data, stage by stage in plain Python."""
    from test_search_near import jaccard_components
    from test_text_filters import base, brute_windows

    from tidemark.llm import rule_ensemble, tokens
    from tidemark.llm.common import table

    good = {i: prose(700 + i, 120) for i in range(90)}  # noqa: F405
    items = [(1, prose(1500, 30)), (2, prose(1501, 14))]  # noqa: F405
    docs = [(i, t + ".") for i, t in good.items()]
    docs += [(200 + i, "| $$$ !! | buy | " * (20 + i)) for i in range(40)]
    docs += [(300 + i, good[i] + ".") for i in range(10)] + [(320 + i, " ".join(good[i].split()[:-3]) + " three new words") for i in range(10, 20)]
    docs += [(400 + i, f"{prose(800 + i, 80)} {items[i % 2][1]} {prose(900 + i, 20)}.") for i in range(6)]  # noqa: F405
    docs += [(500 + i, f"{prose(1000 + i, 90)} write to a{i}@b.cd or 10.0.0.{i} and call +1 (555) 123-{4000 + i} now.") for i in range(12)]  # noqa: F405
    where = str(tmp_path)
    rows = [(i, t, "en", "s", len(t)) for i, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    labels = [(i, int(not 200 <= i < 240), 0) for i, _ in docs]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")

    model = corpus_pipeline.quality_model(spark, table(spark, where, "documents"), where)
    names = list(rule_ensemble.STATISTICS)

    def keeps(text):
        x = rule_ensemble.statistics(text)
        return model.intercept + sum(w for w, r in model.rules if all((x[names.index(n)] > t) == above for n, above, t in r.parts)) >= 0

    left = [(i, t) for i, t in docs if keeps(t)]
    assert {i for i, _ in docs} - {i for i, _ in left} == set(range(200, 240))
    component = jaccard_components(left, 5)
    left = [(i, t) for i, t in left if component[i][1] == i]
    assert not {i for i, _ in left} & {*range(300, 310), *range(330, 340)}
    hit = {i for i, _, n, _ in brute_windows(left, items) if n}
    assert hit == set(range(400, 406))
    left = [(i, t) for i, t in left if i not in hit]
    masked = []
    for i, t in left:
        spans = sorted((int(a), int(b), k) for k, a, b in (x.split(":") for x in base(t).split(",") if x))
        for a, b, k in reversed(spans):
            t = f"{t[:a]}<{k}>{t[b:]}"
        masked.append((i, t))
    count = tokens.token_counter(spark)
    want = {r[0]: r[1] for r in spark.createDataFrame(masked, "doc_id long, text string").select("doc_id", count("text")).collect()}
    got = {}
    for r in corpus_pipeline.run(spark, where).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.n_tokens
    assert got == want
