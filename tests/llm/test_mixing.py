from collections import defaultdict

import pytest

from marketbars.llm.mixing import mix_sources, mixed_documents

from .conftest import prose


def brute_targets(sizes, cycle=(3, 1, 2), share=1.5, cap=2.0):
    names = sorted([s for s in sizes if s is not None], key=lambda s: s.encode())
    names += [None] if None in sizes else []
    weight = {s: cycle[i % len(cycle)] for i, s in enumerate(names)}
    target, open_, left = {}, list(names), share * sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        full = [s for s in open_ if left * weight[s] / total >= cap * sizes[s]]
        if not full:
            target.update({s: left * weight[s] / total for s in open_})
            break
        for s in full:
            target[s] = cap * sizes[s]
            left -= target[s]
            open_.remove(s)
    return target


ROWS = ([(i, prose(i, 5 + (i * 37) % 400), f"s{i % 7}") for i in range(300)]
        + [(i, "same text of five words", "s0") for i in range(300, 700)]
        + [(700, None, "s1"), (701, "", None), (702, "one two", None), (None, "no id", "s2"),
           (703, "x " * 3000, "é"), (704, "y", "zz"), (704, "y", "zz")])


@pytest.fixture(scope="module")
def mix(spark):
    docs = spark.createDataFrame([(*r, "c") for r in ROWS],
                                 "doc_id long, text string, source string, copies string")
    return [r.asDict() for r in mix_sources(docs).collect()]


def test_targets_and_limits(mix):
    assert len(mix) == len(ROWS)
    sizes = defaultdict(int)
    for _, text, source in ROWS:
        sizes[source] += len((text or "").split())
    expected = brute_targets(sizes)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in mix:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(expected[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for source, target in expected.items():
        assert abs(taken[source] - target) <= min(largest[source], 8)


def test_rates_follow_the_tilt(spark):
    """Against a bisection of the same dual, on one class of size per document."""
    from math import exp

    from marketbars.llm.common import stage
    from marketbars.llm.mixing import solve_rates
    sizes = [3, 10, 40, 41, 200, 1000, 5]
    for ratio in (0.2, 0.9, 1.3, 1.9):
        total = sum(sizes)
        histogram = stage(spark.createDataFrame([("a", s, 1) for s in sizes],
                                                "source string, size long, n long"), "h")
        targets = stage(spark.createDataFrame([("a", total, ratio * total)],
                                              "source string, source_size long, target double"), "t")
        row = solve_rates(histogram, targets).first()
        words = sum(s * min(2.0, exp(row.lam * s / row.mean)) for s in sizes)
        assert words == pytest.approx(ratio * total, abs=0.3)


def test_reruns_agree_and_documents_repeat(spark, documents):
    docs = documents(ROWS, {"copies": "c", "time": "t", "size": "z", "row": "r"})
    again = {(r.doc_id, r.source, r.size): 0 for r in mix_sources(docs).collect()}
    for r in mix_sources(docs.repartition(5)).collect():
        again[(r.doc_id, r.source, r.size)] += r.copies
    out = mixed_documents(docs)
    assert out.columns == docs.columns
    got = defaultdict(int)
    for r in out.collect():
        assert r.copies == "c" and r["row"] == "r"
        got[(r.doc_id, r.source, len((r.text or "").split()))] += 1
    assert dict(got) == {k: v for k, v in again.items() if v}


def test_empty_and_wordless(spark, documents):
    assert mix_sources(documents([])).collect() == []
    rows = mix_sources(documents([(1, None), (2, " \n")])).collect()
    assert [(r.size, r.target, r.taken) for r in rows] == [(0, 0.0, 0), (0, 0.0, 0)]


def test_corrections_are_one_job(spark):
    """What a step adds to the driver is bounded: a source's corrections need its classes
    only, so they are not jobs of their own."""
    from marketbars.llm.mixing import class_copies, solve_rates, source_targets
    sizes = spark.createDataFrame([(f"s{i % 3}", 1 + i % 40) for i in range(600)], "source string, size long")
    targets = source_targets(sizes).localCheckpoint()
    histogram = sizes.groupBy("source", "size").count().withColumnRenamed("count", "n").localCheckpoint()
    rates = solve_rates(histogram, targets).localCheckpoint()
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("class-copies", "")
    try:
        classes = class_copies(histogram, targets, rates)
        jobs = len(tracker.getJobIdsForGroup("class-copies"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    taken = {r.source: r.w for r in classes.selectExpr("source", "copies * size AS w")
             .groupBy("source").sum("w").toDF("source", "w").collect()}
    assert all(abs(taken[r.source] - r.target) <= 40 for r in targets.collect())
    assert jobs <= 10
