import random
from collections import defaultdict

from pyspark.sql import functions as F

from lendlens.llm import quality_rules as Q
from lendlens.llm.queries import QUERIES
from tests.conftest import SMOKE_DIR
from tests.llm import brute
from tests.llm.conftest import EDGE_TEXTS

COLS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def want(rows):
    """rows: (id, text, host)."""
    counts = [brute.rule_counts(t) for _, t, _ in rows]
    failed = [c[0] < 50 or 100 * c[4] > 50 * c[0] for c in counts]
    n, f = defaultdict(int), defaultdict(int)
    for (_, _, s), bad in zip(rows, failed):
        n[s] += 1
        f[s] += bad
    m = sum(f.values()) / sum(n.values())
    v = max(sum(f[s] ** 2 / n[s] for s in n) / sum(n.values()) - m * m, 0)
    k = max(1.0, min(1e6, m * (1 - m) / v - 1)) if v > 1e-12 else 1e6
    ok = {s: (f[s] + m * k) / (n[s] + k) <= 0.5 for s in n}
    return sorted((str(i), *c, bad, not bad and ok[s]) for (i, _, s), c, bad in zip(rows, counts, failed))


def got(df):
    return sorted((str(r["doc_id"]), *(r[c] for c in COLS), r["base_failed"], r["kept"]) for r in df.collect())


def test_smoke_table(spark):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in spark.read.parquet(f"{SMOKE_DIR}/documents.parquet").collect()]
    assert got(QUERIES["op10_quality_rules"](spark, SMOKE_DIR)) == want(rows)


def test_edges_hosts_and_clashing_names(spark, make_docs):
    rng = random.Random(6)
    good = lambda: " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(70))
    rows = [(k, t, "edge") for k, t in enumerate(EDGE_TEXTS)] + [(None, "a # b\na # b\n\n \n", None), (3, good(), None)]
    rows += [(100 + k, good() if k % 10 else "bad", "good") for k in range(60)]
    rows += [(200 + k, good() if k % 10 == 0 else "a b c a b c", "poor") for k in range(60)]
    rows += [(300, good(), "rare"), (300, good(), "rare"), (301, " ".join(["x y z q r"] * 20 + [good()]), "good")]
    docs = make_docs([(i, t, "en", s) for i, t, s in rows]).withColumn("host", F.lit(1)).withColumn("kept", F.lit("k"))
    out = got(Q.judge(docs))
    assert out == want(rows)
    by = {r[0]: r for r in out}
    assert by["200"][-2:] == (False, False) and by["101"][-1] and by["300"][-1]


def test_empty_table(spark, make_docs):
    assert Q.judge(make_docs([])).collect() == []


def test_no_python_in_the_plan(spark, make_docs):
    plan = Q.rule_counts(make_docs([(1, "a")]))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
