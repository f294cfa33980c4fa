"""The pipeline's stages against plain Python, each on its own input."""

import corpus_pipeline as P
import __spark_entry__ as entry

from lendlens.llm import decontamination, mixing, toxicity
from tests.conftest import SMOKE_DIR
from tests.llm import brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def by_id(df):
    rows = df.collect()
    out = {r["doc_id"]: r for r in rows}
    assert len(out) == len(rows)
    return out


def test_stages(spark):
    docs = spark.read.parquet(f"{SMOKE_DIR}/documents.parquet")
    steps = [by_id(docs)]
    frames = [docs]
    for name, stage in P.STAGES:
        out = stage(spark, frames[-1], SMOKE_DIR).cache()
        assert out.columns == COLUMNS + (["copies"] if name == "mix" else [])
        frames.append(out)
        steps.append(by_id(out))
    start, clean, single, cut, checked, mixed = steps

    model = toxicity.fit(docs, spark.read.parquet(f"{SMOKE_DIR}/labels.parquet"))
    bad = {r["doc_id"] for r in toxicity.score(docs, model).where("predicted = 1").collect()}
    assert set(clean) == set(start) - bad and all(clean[i] == start[i] for i in clean)

    comp = brute.near_components([(i, r["text"]) for i, r in clean.items()], percent=80, width=5)
    assert {i: clean[i] for i in clean if comp[i][1] == i} == single

    rows = [(i, r["text"]) for i, r in single.items()]
    for (i, text), (n, gone, kept) in zip(rows, brute.substring_dedup(rows).values()):
        if gone and gone == n:
            assert i not in cut
        else:
            assert cut[i]["text"] == (kept if gone else text)
            assert cut[i]["n_chars"] == (len(kept) if gone else single[i]["n_chars"])

    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMOKE_DIR}/benchmark.parquet").collect()]
    leaks = brute.leaks([(i, r["text"]) for i, r in cut.items()], items, set(decontamination.UNITS))
    assert checked == {i: r for i, r in cut.items() if i not in {d for d, _ in leaks}}

    plan = {r["doc_id"]: r["copies"] for r in mixing.mix_sources(frames[4]).collect() if r["copies"]}
    assert {i: r["copies"] for i, r in mixed.items()} == plan
    assert all(mixed[i]["text"] == checked[i]["text"] for i in mixed)
    left = brute.near_components([(i, r["text"]) for i, r in single.items()], percent=80, width=5)
    assert all(i == c for i, (_, c) in left.items())


def test_run_and_registration(spark, make_docs, table_dir):
    assert {"pipeline", *(f"op{n}" for n in range(1, 14))} == {
        q.split("_")[0] for q in entry.queries() if q == "pipeline" or q.startswith("op")}
    assert "pipeline" not in entry.oracle_sql()
    assert set(entry.queries()["pipeline"](spark, SMOKE_DIR).columns) == {*COLUMNS, "copies"}
    empty = table_dir(documents=make_docs([]), labels=spark.createDataFrame([], "doc_id long, quality int, toxic int"),
                      benchmark=spark.createDataFrame([], "item_id long, text string"))
    assert P.run(spark, empty).collect() == []


def test_edge_rows(spark, make_docs, table_dir):
    rows = [(None, None), (None, "a b c"), (1, None), (2, ""), (2, ""), (3, "a b c d e f"), (3, "a b c d e f"), (4, "A b c d e f"),
            (5, "word " * 30000)]
    path = table_dir(documents=make_docs(rows), labels=spark.createDataFrame([(3, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int"),
                     benchmark=spark.createDataFrame([(None, None), (1, "q w e r t y")], "item_id long, text string"))
    # Every stage by itself, exactly; the mix takes each row once or twice, so no row with words is lost.
    out = [docs_of(spark, path)]
    for _, stage in P.STAGES[:-1]:
        out.append(stage(spark, out[-1], path))
    texts = [sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr) for df in out[1:]]
    long = "word " * 30000
    everything = sorted([(i, t) for i, t in rows], key=repr)
    assert texts[0] == everything
    singles = [(None, None), (None, "a b c"), (1, None), (2, ""), (3, "a b c d e f"), (5, long)]
    assert texts[1] == texts[2] == texts[3] == sorted(singles, key=repr)
    plan = {(r["doc_id"], r["size"]): r["copies"] for r in mixing.mix_sources(out[-1]).collect()}
    mixed = {(r["doc_id"], len((r["text"] or "").split())): r["copies"] for r in P.run(spark, path).collect()}
    assert mixed == {k: c for k, c in plan.items() if c} and (5, 30000) in mixed


def docs_of(spark, path):
    return spark.read.parquet(f"{path}/documents.parquet")


def test_near_duplicates_takes_five_words_at_80_percent(spark, make_docs):
    text = [f"w{k}" for k in range(200)]
    rows = [(1, " ".join(text)), (2, " ".join(text + [f"x{k}" for k in range(45)])),  # 196 / 241: linked
            (3, " ".join(f"v{k}" for k in range(200))), (4, " ".join([f"v{k}" for k in range(200)] + [f"y{k}" for k in range(55)]))]  # 196 / 251: not
    comp = brute.near_components(rows, percent=80, width=5)
    got = by_id(P.drop_near_duplicates(spark, make_docs(rows), SMOKE_DIR))
    assert set(got) == {i for i, (_, c) in comp.items() if i == c} == {1, 3, 4}


def test_near_duplicates_of_the_smoke_table(spark):
    docs = spark.read.parquet(f"{SMOKE_DIR}/documents.parquet")
    comp = brute.near_components([(r["doc_id"], r["text"]) for r in docs.collect()], percent=80, width=5)
    assert set(by_id(P.drop_near_duplicates(spark, docs, SMOKE_DIR))) == {i for i, (_, c) in comp.items() if i == c}
