import random

from pyspark.sql import functions as F

from lendlens.llm import near_dedup as N
from lendlens.llm.components import components
from lendlens.llm.queries import QUERIES
from tests.conftest import SMOKE_DIR
from tests.llm import brute
from tests.llm.conftest import EDGE_TEXTS
from tests.llm.test_textkernels import thue_morse


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def want(rows):
    return {i: (n, c, i == c) for i, (n, c) in brute.near_components(rows).items()}


def test_smoke_table_against_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMOKE_DIR}/documents.parquet").collect()]
    assert result(QUERIES["op9_minhash_near_dedup"](spark, SMOKE_DIR)) == want(rows)


def copies(rng, n, words=60, edits=3):
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(words)]
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits)):
            w[rng.randrange(words)] = f"e{rng.randrange(10 ** 6)}"
        yield " ".join(w)


def test_edges_and_groups(spark, make_docs):
    rng = random.Random(3)
    texts = EDGE_TEXTS + ["ONE", "One Two", "one two three", "A b c", ""]
    texts += [*copies(rng, 40), *copies(rng, 7), *copies(rng, 2)] + ["same text here ok"] * 30
    rows = list(enumerate(texts, start=5))
    rng.shuffle(rows)
    assert result(N.near_components(make_docs(rows))) == want(rows)


def test_branching_groups(spark, make_docs, monkeypatch):
    monkeypatch.setattr(N, "NODE_ROWS", 20)
    monkeypatch.setattr(N, "GROUP_SHINGLES", 2500)
    rng = random.Random(4)
    rows = list(enumerate([*copies(rng, 150, edits=4), *copies(rng, 90, edits=2), *copies(rng, 5)]))
    got, full = result(N.near_components(make_docs(rows))), want(rows)
    agree = sum(got[i] == full[i] for i in full)
    assert agree == len(full)


def test_null_and_repeated_ids(spark, make_docs):
    rows = [(None, "a b c d e"), (7, "a b c d e"), (7, "a b c d e"), (7, "x y z"), (3, "A B c d e"), (None, "q r s t")]
    docs = make_docs(rows).withColumn("n", F.lit("n")).withColumn("sig", F.lit(1)).withColumn("kept", F.lit(False))
    got = sorted(N.near_components(docs).collect(), key=str)
    assert len(got) == 6
    assert sum(r["component_id"] is None and r["kept"] for r in got) == 2
    assert sorted((r["doc_id"], r["component_id"]) for r in got if r["doc_id"]) == [(3, 3), (7, 3), (7, 3), (7, 7)]
    stay = N.one_of_each(docs)
    assert stay.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in stay.collect()) == [0, 0, 3, 7]


def test_rows_of_one_id_with_different_texts_stay(spark, make_docs):
    a, b = ("alpha beta gamma delta epsilon " + " ".join(f"{c}{k}" for k in range(30)) for c in "ab")
    rows = [(7, a), (7, b), (7, a.upper()), (7, b + "  "), (3, b + " tail"), (8, ""), (8, None), (8, a + " tail"), (None, a)]
    # b's component has the smaller id 3; of the others one row an id and component stays.
    got = sorted(((r["doc_id"] or 0, r["text"]) for r in N.one_of_each(make_docs(rows)).collect()), key=repr)
    assert got == sorted([(0, a), (3, b + " tail"), (7, a.upper()), (8, None)], key=repr)


def test_structured_words_are_not_linked(spark, make_docs):
    one, two = thue_morse(10)
    rows = [(1, " ".join([one] * 3)), (2, " ".join([two] * 3))]
    assert {r["doc_id"]: r["component_id"] for r in N.near_components(make_docs(rows)).collect()} == {1: 1, 2: 2}


def test_empty_table(spark, make_docs):
    assert N.near_components(make_docs([])).collect() == []
    assert N.one_of_each(make_docs([])).collect() == []


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(500, 900), (900, 700)], "u long, v long")
    got = {r["id"]: r["component"] for r in components(edges).collect()}
    assert got == {**{k: 0 for k in range(201)}, 500: 500, 700: 500, 900: 500}


def test_size_of_a_group_does_not_change_links(spark, make_docs, monkeypatch):
    """16 pairs above 0.85, all in one joined group far above the limits."""
    monkeypatch.setattr(N, "NODE_ROWS", 8)
    monkeypatch.setattr(N, "GROUP_SHINGLES", 1000)
    monkeypatch.setattr(N, "BLOCKS_AT_ONCE", 2, raising=False)
    rng = random.Random(5)
    base = [f"w{k}" for k in range(180)]
    texts = []
    for g in range(16):  # each member is below 0.85 to the other pairs
        own = [f"g{g}x{k}" for k in range(9)]
        texts += [" ".join(base + own + [f"p{g}m{m}y{k}" for k in range(15)]) for m in range(2)]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    full = want(rows)
    assert len({c for _, c, _ in full.values()}) == 16
    assert result(N.near_components(make_docs(rows))) == full


def test_texts_longer_than_a_task_holds(spark, make_docs, monkeypatch):
    monkeypatch.setattr(N, "GROUP_SHINGLES", 150)
    base = [f"w{k}" for k in range(400)]
    texts = [" ".join(base + [f"a{m}x{k}" for k in range(30)]) for m in range(6)] + [" ".join(base[:380])]
    texts += [" ".join([f"v{k}" for k in range(140)] + [f"b{m}x{k}" for k in range(4 + 9 * m)]) for m in range(2)]
    rows = list(enumerate(texts))
    full = want(rows)
    assert [full[i][1] for i in range(9)] == [0] * 7 + [7, 7]
    assert result(N.near_components(make_docs(rows))) == full
