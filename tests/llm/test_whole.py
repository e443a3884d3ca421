"""Near copies in the pipeline, long texts in fingerprints, the whole vocabulary in the language model."""

import random
import re

import pytest


def shingled(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def jaccard(a, b):
    a, b = shingled(a), shingled(b)
    return len(a & b) / len(a | b)


def test_pipeline_drops_near_copies(spark):
    import corpus_pipeline as C

    rng = random.Random(1)
    texts, copies, apart = [], set(), 0
    for _ in range(60):
        words = [f"w{rng.randint(0, 9**6)}" for _ in range(300)]
        texts.append(" ".join(words))
        for edits in (3, 6, 9, 20):
            other = list(words)
            for at in rng.sample(range(300), edits):
                other[at] = f"x{rng.randint(0, 9**6)}"
            texts.append(" ".join(other).upper())
            near = [i for i in range(len(texts) - 2, -1, -1) if i >= (len(texts) - 1) // 5 * 5 and jaccard(texts[i], texts[-1]) >= 0.8]
            if near:
                copies.add(len(texts) - 1)
            else:
                apart += 1
    assert len(copies) > 100 and apart >= 60
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r.doc_id for r in C.near_duplicates(spark, docs, "").collect()}
    assert kept == set(range(len(texts))) - copies


def test_resemblance_of_a_large_group(spark):
    from lodestrata.llm.resemblance import resemblance_dedup

    rng = random.Random(2)
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(base)]
    for _ in range(300):  # each is near the base, few are near each other
        at = rng.randrange(5, 53)
        texts.append(" ".join(base[:at] + [f"x{rng.randint(0, 9**6)}"] + base[at + 1 :]))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None, "", "One two", "one TWO"])] + [(None, texts[0])], "doc_id long, text string")
    assert sorted(r.doc_id or -1 for r in resemblance_dedup(docs).collect()) == [-1, -1, 301, 303]
    assert resemblance_dedup(docs.limit(0)).count() == 0


def test_likeness_of_long_texts(spark):
    from lodestrata.llm import fingerprints as G

    texts = ["\n".join(f"{name} line {i}" for i in range(n)) for name, n in (("a", 6000), ("b", 9000))]
    rows = G.document_fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()

    def parts(text):
        return set(re.findall("[^\n]{1,%d}" % G.LONG, text))

    for r in rows:
        for near, other in ((r._near_edited, r._edited), (r._near_next, texts[1 - r.doc_id])):
            a, b = parts(r.text), parts(other)
            assert near == pytest.approx(len(a & b) / len(a | b))


def test_likeness_where_every_sketch_fails(spark, monkeypatch):
    from lodestrata.llm import fingerprints as G

    monkeypatch.setattr(G, "ROUNDS", 1)
    monkeypatch.setattr(G, "_round", lambda share: "t")  # no larger sketch ever succeeds
    texts = ["\n".join(f"{i} " + "x" * 20 for i in range(k, k + 80)) for k in (0, 40)]
    rows = G.document_fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert all(0 < r._near_edited < 1 and r._near_next == pytest.approx(40 / 120) for r in rows)


def test_components_in_one_task_are_those_of_the_steps(spark):
    import random

    from lodestrata.llm.simhash import components

    rng = random.Random(3)
    chain = [(k * 7 - 5000, k * 7 - 4993) for k in range(400)]
    edges = chain + [(rng.randrange(-(2**63), 2**63), rng.randrange(10_000, 10_300)) for _ in range(300)] + [(10**6 + k, 10**6) for k in range(200)] + [(5, 5)]
    df = spark.createDataFrame(edges, "_a long, _b long").repartition(5)
    steps, one = ({(r._node, r._root) for r in components(df, few).collect()} for few in (0, 1000))
    assert one == steps and len(one) == components(df, 1000).count() and components(df.limit(0), 1000).count() == 0
    assert {r for n, r in one if n < -2000} >= {-5000}
    assert {(r._node, r._root) for r in components(df, 899).collect()} == steps  # one edge too many


def test_near_duplicates_are_found_by_small_plans(spark):
    """What the driver plans and starts at once takes its memory."""
    import corpus_pipeline as C

    texts = [" ".join(f"w{k * (i // 3)}" for k in range(40)) for i in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    assert C.near_duplicates(spark, docs, "").count() == 10
    plans = store.executionsList(before, 1000)
    sizes = [plans.apply(k).physicalPlanDescription().split("\n\n")[0].count("Exchange") for k in range(plans.size())]
    assert sizes and sum(sizes) <= 80, (sum(sizes), len(sizes))  # one plan of all candidates and steps over tables: 121
