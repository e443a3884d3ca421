"""Nulls, empty and very long texts, ties, repeated rows, clashing names and empty tables: every operator, every stage."""

import random

import pytest

import corpus_pipeline as C
from lodestrata.llm import ann as A
from lodestrata.llm import byte_bpe as B
from lodestrata.llm import fingerprints as G
from lodestrata.llm import line_dedup as L
from lodestrata.llm import maxent_lm as M
from lodestrata.llm import packing as K
from lodestrata.llm import quality as Q
from lodestrata.llm import simhash as S
from lodestrata.llm import substring_dedup as D
from lodestrata.llm import url_filters as U
from lodestrata.llm.resemblance import resemblance_dedup

LONG = "word " * 40_000 + "x" * 200_000 + "\n" + "\n".join(f"line {i} that is long enough to be a key" for i in range(4_000))
CLASH = "doc_id long, text string, _id string, _row int, _text string, _n int, _tag int, _score double, _predicted int, _ids int, _decoded int, _drop int, _n_lines int, _n_words int, _edited int, _fp int, _block int, found int, piece int"


def odd(spark, texts=None):
    """Rows with a null id, a repeated id, repeated rows, null, empty and long texts, and columns of the operators' own names."""
    rows = [(1, "Some text here"), (1, "Some text here"), (1, "another one"), (None, "Some text here"), (None, None), (2, None), (3, ""), (4, " \n\t"), (5, LONG), (6, LONG + " end")]
    rest = ("s", 1, "t", 2, 3, 0.5, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14)
    return spark.createDataFrame([(i, t, *rest) for i, t in (rows if texts is None else texts)], CLASH)


def vocabulary(name):
    import public_tokenizers

    return public_tokenizers.path(name)


RUNS = {
    "lm": lambda d: M.lm_scores(d),
    "simhash": lambda d: S.simhash_components(d),
    "near_dedup": lambda d: S.near_dedup(d),
    "bpe": lambda d: B.encode(d, B.read_ranks(vocabulary("byte_bpe_50k.tiktoken")), "\\S+|\\s+", ids="ids_of_text", decoded="text_again"),
    "lines": lambda d: L.line_dedup(d),
    "passages": lambda d: D.substring_dedup(d, count=True),
    "fingerprints": lambda d: G.document_fingerprints(d, names=("a", "b", "c", "d", "e", "f")),
    "packing": lambda d: K.pack_documents(d, vocabulary("word_bpe_49k.json")),
    "quality": lambda d: Q.quality_scores(d, d.selectExpr("doc_id", "1 as quality")),
    "resemblance": lambda d: resemblance_dedup(d),
}
WHOLE = ("bpe", "lines", "passages", "fingerprints", "quality")  # a row for each row


@pytest.mark.parametrize("name", sorted(RUNS))
def test_odd_rows(spark, name):
    docs = odd(spark)
    out = RUNS[name](docs).collect()
    assert len(out) >= 7
    if name in WHOLE:
        assert len(out) == docs.count()
    if name in ("lines", "near_dedup", "resemblance"):
        assert set(out[0].asDict()) == set(docs.columns)
    if name in ("bpe", "passages", "fingerprints", "quality"):
        assert all(r["_id"] == "s" and r["_row"] == 1 and r["_drop"] == 7 for r in out)


@pytest.mark.parametrize("name", sorted(RUNS))
def test_empty_tables(spark, name):
    assert RUNS[name](odd(spark).limit(0)).count() == 0


def test_repeated_rows_get_the_same(spark):
    texts = [(7, "Same text, twice. " * 30)] * 3 + [(8, "Same text, twice. " * 30)]
    docs = odd(spark, texts)
    assert len({r.ids_of_text for r in RUNS["bpe"](docs).collect()}) == 1
    assert len({(r._score, r._base_score) for r in M.lm_scores(docs, modulus=1, held_out=5).collect()}) == 1
    assert {r._component for r in S.simhash_components(docs).collect()} == {7}
    kept = D.substring_dedup(docs, count=True).collect()
    assert len({(r.text, r.doc_id) for r in kept}) == 2 and sum(r.doc_id == 7 for r in kept) == 3


def test_lines_of_repeated_and_long_texts(spark):
    line = "the same long line in all of the documents here"
    docs = odd(spark, [(i, f"{line}\n{i}\n{line}") for i in range(6)] + [(6, "\n".join([line] * 5_000))] * 2)
    out = L.line_dedup(docs, counts=("n", "gone")).collect()
    assert sorted((r.doc_id, r.n, r.gone) for r in out) == [(i, 3, 2) for i in range(6)] + [(6, 5000, 0)] * 2


def test_neighbours_with_odd_rows(spark):
    rng = random.Random(2)
    rows = [(i % 60, [rng.gauss(0, 1) for _ in range(4)], 1, "x") for i in range(120)] + [(None, [1.0] * 4, 1, "x"), (50, [1e300, -1e300, 1.0, 0.0], 1, "x"), (51, [float("inf")] * 4, 1, "x"), (52, [None] * 4, 1, "x")]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>, _id int, rank string")
    out = A.nearest_neighbours(docs).collect()
    assert {r.query_id for r in out} == {0, 50} and all(r.vec_id != r.query_id and -1.0000001 <= r.score <= 1.0000001 for r in out)
    assert A.nearest_neighbours(docs.limit(0)).count() == 0


def test_urls_with_odd_rows(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x", "h"), (1, "http://a.com/x", "h"), (None, None, "h"), (2, "http://" + "b" * 100_000, "h")], "page_id long, url string, _host string")
    out = U.url_filter(pages)
    assert out.count() == 4 and out.columns[:3] == ["page_id", "url", "_host"] and len(set(out.columns)) == len(out.columns)
    with pytest.raises(ValueError, match="rules"):
        U.url_filter(pages, [("a.com", "/", "block")] * (U.MAX_RULES + 1))


def test_stages_with_odd_rows(spark, tmp_path):
    docs, root = odd(spark), str(tmp_path)
    docs.selectExpr("doc_id", "1 as quality", "0 as toxic").write.parquet(f"{root}/labels.parquet")
    for name, stage in C.STAGES:
        out = stage(spark, docs, root)
        assert name == "packing" or out.columns == docs.columns, name
        assert out.count() > 0 and stage(spark, docs.limit(0), root).count() == 0, name
    docs.write.parquet(f"{root}/documents.parquet")
    rows = C.run(spark, root).collect()
    # rows without an id stay; one document of the two without words, and one of the two that are nearly one
    assert {r.doc_id for r in rows} >= {None, 1, 2, 5} and 6 not in {r.doc_id for r in rows}


def test_stages_without_labels(spark, tmp_path):
    docs, root = odd(spark, [(i, f"text number {i}") for i in range(5)]), str(tmp_path)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    assert C.quality(spark, docs, root).count() == 5
