import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from trolley.llm import decontam, mixing

ITEM = "Then Tom Smith has 12 apples and gives 5 of them to his friend Anna Jones who walks 3 km home every day to the mill"
REWORDED = "Then Bob Brown has 40 apples and gives 7 of them to his friend Mary White who walks 9 km home every day to the mill"
UNLIKE = "Then Bob Brown has 40 apples and gives 40 of them to his friend Bob Brown who walks 40 km home every day to the mill"


def bench(spark, *texts):
    return spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "item_id long, text string, doc_id string")


def test_reworded_items_are_found(spark, prose, odd_docs, no_docs):
    docs = spark.createDataFrame([(1, f"{prose(40, 1)}\n{ITEM}. {prose(30, 2)}"), (2, REWORDED), (3, UNLIKE), (4, prose(300, 3)), (5, None), (None, ITEM),
                                  (2, REWORDED), (6, ITEM.upper().replace(" ", "!! "))], "doc_id long, text string")
    got = {(r.doc_id, r.reworded): r for r in decontam.contaminated(docs, bench(spark, ITEM)).collect()}
    assert set(got) == {(1, False), (2, True), (None, False)} | ({(6, True)} if (6, True) in got else set()) | ({(6, False)} if (6, False) in got else set())
    assert got[2, True].n_slots == 8 and got[1, False].share == 1.0
    kept = decontam.drop_contaminated(docs, bench(spark, ITEM))
    assert {3, 4, 5} <= {r.doc_id for r in kept.collect()} and kept.columns == docs.columns
    assert decontam.contaminated(no_docs, bench(spark, ITEM)).collect() == []
    assert decontam.contaminated(odd_docs, bench(spark, None, "", "too short")).collect() == []
    assert decontam.contaminated(odd_docs, bench(spark).limit(0)).collect() == []
    assert decontam.drop_contaminated(odd_docs, bench(spark, ITEM)).count() == odd_docs.count()


def test_slot_values_may_repeat_and_one_odd_slot_costs_its_windows_only(spark):
    twice = "the baker in town buys 2 more ovens for the shop and after 2 weeks of work sells them all again to pay the rent of the mill near the old bridge"
    cows = "on the farm by the lake there are 3 cows and 5 goats that eat the same green grass all day long until the farmer takes them home for the night"
    near = ("in the evening the old teacher Anna went down to the river with a red boat and a long rope to look for her lost dog while the "
            "others stayed at home and later that night Anna came back with the dog in the boat")
    anew = near.replace("red", "12 foot").replace("long", "30 metre")
    docs = spark.createDataFrame([
        (1, twice.replace("buys 2", "buys 6").replace("after 2", "after 7")), (2, cows.replace("3 cows and 5", "4 cows and 4")),
        (3, near.replace("night Anna", "night Maria")), (4, anew.replace("12", "14").replace("30", "40").replace("night Anna", "night Maria")),
        (5, UNLIKE)], "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontam.contaminated(docs, bench(spark, twice, cows, near, anew, ITEM)).collect()}
    assert {(1, 0), (2, 1), (3, 2), (4, 3)} <= set(got) and all(i < 5 for i, _ in got)
    assert got[1, 0].share == got[2, 1].share == 1.0 and got[1, 0].reworded and got[2, 1].reworded
    # all words but the changed name are covered by windows that don't touch it
    assert got[3, 2].covered == got[3, 2].item_words - 1 and not got[3, 2].reworded and got[4, 3].reworded


def test_sentence_starts_and_number_words_are_slots(spark):
    anna = "Anna has 12 apples in a basket. Anna gives 5 of them to Bob. Bob eats 2 of them and Anna takes 3 apples back to the basket."
    boys = "At the old school three boys share a bag of red marbles after four of them had lost all of their own"
    names = "we saw Tom and Ann and Joe and Sue at the fair with Kim and Max and Eva by the gate"
    docs = spark.createDataFrame([
        (1, anna.replace("Anna", "Clara").replace("Bob", "Dave").replace("12", "30").replace("5", "8")),
        (2, boys.replace("three", "seven").replace("four", "nine")), (3, names.lower()), (4, names.upper()), (5, anna), (6, anna.upper()),
        (7, "The dog sleeps. The cat eats. The bird sings in a tree and the fish swims.")], "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontam.contaminated(docs, bench(spark, anna, boys, names)).collect()}
    assert set(got) == {(1, 0), (2, 1), (3, 2), (4, 2), (5, 0), (6, 0)}
    assert all(r.share == 1.0 for r in got.values()) and {k[0] for k, r in got.items() if r.reworded} == {1, 2}


def test_long_runs_take_linear_time(spark):
    runs = [(i, c * 300_000 + " " + ITEM) for i, c in enumerate([".", "\n", " ", "\"", "7", "A", "é", "<", "\u0002"])]
    docs = spark.createDataFrame(runs, "doc_id long, text string")
    assert {r.doc_id for r in decontam.contaminated(docs, bench(spark, ITEM)).collect()} == set(range(len(runs)))


def test_shuffled_join_finds_the_same(spark, monkeypatch):
    d = "/root/testdata/sf0.001"
    docs, items = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/benchmark.parquet")
    one = sorted(map(tuple, decontam.contaminated(docs, items).collect()))
    monkeypatch.setattr(decontam, "BROADCAST_WINDOWS", 0)
    assert sorted(map(tuple, decontam.contaminated(docs, items).collect())) == one != []


def test_contaminated_against_brute_force(spark):
    d = "/root/testdata/sf0.01"
    docs, items = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/benchmark.parquet")
    want = {(r.doc_id, i.item_id) for r in docs.collect() for i in items.collect() if " ".join(i.text.split()) in " ".join(r.text.split())}
    assert {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, items).collect()} >= want


@pytest.fixture(scope="module")
def two_languages(spark):
    rows = [(i, " ".join(f"{'the' if i % 3 else 'der'}{(i * j) % 7}" for j in range(10 + i % 5))) for i in range(90)]
    docs = spark.createDataFrame([(i, t, "en" if i % 3 else "de") for i, t in rows] + [(None, None, None), (200, "", "en")],
                                 "doc_id long, text string, lang string")
    return docs, docs.selectExpr("text", "lang as domain").limit(60)


def test_rates_meet_the_targets(two_languages):
    docs, labelled = two_languages
    got = mixing.document_rates(docs, labelled, {"en": 0.5, "de": 0.5}).collect()
    p, n, rate = np.array([r.posterior for r in got]), np.array([r.n_tokens for r in got]), np.array([r.rate for r in got])
    total = (p * (n * rate)[:, None]).sum(axis=0)
    assert np.allclose(total, n.sum() / 2, rtol=1e-4) and (rate >= 0).all()
    assert all(r.copies in (math.floor(r.rate), math.floor(r.rate) + 1) for r in got)
    assert np.allclose(p.sum(axis=1), 1) and len(got) == docs.count()


def test_rates_against_projected_gradient_by_hand(two_languages):
    docs, labelled = two_languages
    got = mixing.document_rates(docs, labelled, {"en": 0.02, "de": 0.98}).collect()
    p, n = np.array([r.posterior for r in got]), np.array([r.n_tokens for r in got], float)
    gram = (p * n[:, None]).T @ p + 1e-9 * np.eye(2)
    target, rate = np.array([0.98, 0.02]) * n.sum(), np.ones(len(n))
    for _ in range(mixing.ROUNDS):
        rate = np.maximum(0, rate - p @ np.linalg.solve(gram, (p * (n * rate)[:, None]).sum(axis=0) - target))
    assert np.allclose([r.rate for r in got], rate, atol=1e-3)


def test_mixing_of_odd_rows(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "text string, domain string")
    assert {r.rate for r in mixing.document_rates(odd_docs, none, {"en": 1.0}).collect()} == {1.0}
    assert mixing.mixed(odd_docs, none, {"en": 1.0}).count() == odd_docs.count()
    assert mixing.document_rates(no_docs, none, {"en": 1.0}).collect() == []
    mixed = mixing.mixed(odd_docs, odd_docs.selectExpr("text", "lang as domain"), {"en": 1.0})
    assert mixed.columns == odd_docs.columns and mixed.count() == odd_docs.count()


def test_stages_one_by_one(spark):
    """Each stage's own effect on what the stage before it kept."""
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    from trolley.llm import rules, simhash
    from trolley.llm.common import cut_lineage
    ids = lambda df: [r.doc_id for r in df.select("doc_id").collect()]
    before, out = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        out[name] = cut_lineage(stage(spark, before, d))
        if name == "quality rules":
            assert sorted(ids(out[name])) == sorted(ids(rules.quality_rules(before).where("kept")))
        elif name == "SimHash near-dedup":
            assert sorted(ids(out[name])) == sorted(set(r.component_id for r in simhash.near_duplicates(before).collect()))
        elif name == "benchmark decontamination":
            found = decontam.contaminated(before, spark.read.parquet(f"{d}/benchmark.parquet"))
            assert set(ids(out[name])) == set(ids(before)) - set(ids(found))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out[name].columns == docs.columns
        before = out[name] if name != corpus_pipeline.STAGES[-1][0] else before
    assert sorted(ids(out["token-ID output"])) == sorted(ids(out["mixing to target weights"]))
    assert corpus_pipeline.run(spark, d).count() == out["token-ID output"].count()


def test_templates_by_one_look_are_the_templates(spark):
    """The codes that the windows use are those of the template rule, and null item ids are found."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text")
    extra = spark.createDataFrame([("Three boys. Seven Of them. in 20 km. NASA two Paris 5 days\nAnna",), ("",), (None,)], "text string")
    words = docs.unionByName(extra).select(decontam.template_tokens(F.col("text")).alias("w"))
    narrow = decontam._narrow_hashes(F.col("w"))
    assert words.where((narrow != decontam._template_hashes(F.col("w"), decontam._narrow))
                       | (decontam._wide_hashes(F.col("w"), narrow) != decontam._template_hashes(F.col("w"), decontam._wide))).count() == 0
    items = spark.createDataFrame([(None, ITEM), (4, ITEM)], "item_id int, text string")
    found = decontam.contaminated(spark.createDataFrame([(1, f"x {ITEM} y")], "doc_id long, text string"), items).collect()
    assert sorted((r.doc_id, r.item_id) for r in found if r.item_id) == [(1, 4)] and {r.item_id for r in found} == {None, 4}
