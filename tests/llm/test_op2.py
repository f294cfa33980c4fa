import random

from pyspark.sql import functions as F

from lendlens.llm import decontamination as D
from lendlens.llm.queries import QUERIES
from tests.llm import brute
from tests.llm.conftest import EDGE_TEXTS

SF = "/root/testdata/sf0.01"


def result(df):
    rows = df.collect()
    out = {(r["doc_id"], r["item_id"]): (r["matched_windows"], r["item_windows"], r["reparameterised"]) for r in rows}
    assert len(out) == len(rows)
    return out


def test_smoke_table_against_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = result(QUERIES["op2_benchmark_decontamination"](spark, SF))
    assert got == brute.leaks(docs, items, set(D.UNITS)) and got
    verbatim = {(i, j) for i, t in docs for j, x in items if x in (t or "")}
    assert verbatim <= set(got)


def items_and_docs():
    rng = random.Random(8)
    word = lambda: rng.choice("aa bb cc dd ee ff gg hh ii jj kk ll mm nn".split())
    items = [(1, "A train leaves the station at Rome with 120 people and after 3 hours Anna sees that 120 people are in Rome."),
             (2, "Wie viele Äpfel hat der Bauer Özil, wenn er 1,500 Stück kauft und dem Händler 20 kg davon schenkt?"),
             (3, "how many sheep are left now"), (4, "too short"), (5, None), (6, ""), (7, "9 8 7 6 5 4 3 2 1 0 1 2"),
             (8, "how many sheep are left now")]
    docs = [(k, t) for k, t in enumerate(EDGE_TEXTS)]
    docs += [(100, f"x y. {items[0][1]} z"),
             (101, "A train leaves the station at Bonn with 77 people and after 9 minutes Otto sees that 77 people are in Bonn."),
             (102, "A train leaves the station at Bonn with 77 people and after 9 minutes Otto sees that 78 people are in Wien."),
             (103, "WIE VIELE Birnen hat der Bauer Müller, wenn er 20 Stück kauft und dem Nachbarn 3.5 lbs davon schenkt"),
             (104, "and How many sheep are left now?"), (105, "how many sheep are right now"), (106, "A train leaves the station at"),
             (107, " ".join([items[0][1], word(), items[1][1], items[0][1]])), (108, "7 6 5 4 3 2 1 0 9 8 7 6")]
    docs += [(200 + k, " ".join(word() for _ in range(80))) for k in range(20)]
    return items, docs


def test_reparameterised_and_edges(spark, make_docs):
    items, docs = items_and_docs()
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("key", F.lit(1))
    got = result(D.find_leaks(make_docs(docs).withColumn("share", F.lit("x")).withColumn("item", F.lit(1)), table))
    assert got == brute.leaks(docs, items, set(D.UNITS))
    assert got[100, 1][2] is False and got[101, 1][2] is True and (102, 1) not in got
    assert got[103, 2][2] is True and {(104, 3), (104, 8), (107, 1), (107, 2)} <= set(got)
    assert not {d for d, _ in got} & {105, 106, 108, *range(200, 220)}


def test_null_and_repeated_ids(spark, make_docs):
    items, _ = items_and_docs()
    table = spark.createDataFrame(items + [(None, items[0][1]), (1, items[0][1])], "item_id long, text string")
    docs = make_docs([(None, items[0][1]), (1, items[0][1]), (1, items[0][1]), (2, "clean"), (2, "clean")])
    assert set(result(D.find_leaks(docs, table))) == {(1, 1)}
    stay = D.without_leaks(docs, table)
    assert stay.columns == docs.columns or set(stay.columns) == set(docs.columns)
    assert sorted(r["doc_id"] or 0 for r in stay.collect()) == [0, 2, 2]


def test_empty_tables(spark, make_docs):
    items = spark.createDataFrame([(1, "how many sheep are left now")], "item_id long, text string")
    assert D.find_leaks(make_docs([]), items).collect() == []
    assert D.find_leaks(make_docs([(1, "how many sheep are left now")]), items.limit(0)).collect() == []


def test_verbatim_copies_of_items_with_few_plain_words(spark, make_docs):
    items = [(1, " ".join(str(k * 7) for k in range(30))), (2, "the sum of all these numbers below is what then " + " ".join(str(k) for k in range(100, 120))),
             (3, "Paris, London, Rome, Berlin, Madrid, Vienna, Oslo, Bern, Prague, Lisbon"), (4, "12 + 30 = 42, 7, 8"), (5, "km 3 4 5 6 of 9"),
             (6, "3 km 4 kg 5 lbs 6 miles 7 hours")]
    docs = [(k, f"Now we see 9 {t} and more words") for k, t in items]
    docs += [(10, " ".join(str(k * 7 + 1) for k in range(30))), (11, "the Paris, Rome, London and Berlin of 12 + 30 = 43, 7, 8"),
             (12, items[1][1].replace("1", "2")), (13, "3 km 4 kg 5 lbs 6 miles 8 hours")]
    got = result(D.find_leaks(make_docs(docs), spark.createDataFrame(items, "item_id long, text string")))
    windows = {1: 23, 2: 23, 3: 3, 4: 1, 5: 1, 6: 3}
    assert got == {(k, k): (n, n, False) for k, n in windows.items()}


def test_alignments_must_agree(spark, make_docs):
    words = "when the old ferry from the harbour carries 120 guests over to the small island each of them pays the same sum and then " \
            "the captain counts the money of all 120 guests before he sails back to the harbour late at night"
    cut = words.index(" and then") + 4
    one, two = words[:cut], words[cut:]
    pause = " zzz yyy xxx www vvv uuu ttt sss "
    docs = [(1, one.replace("120", "77") + pause + two.replace("120", "78")),  # two parts that contradict each other
            (2, one.replace("120", "77") + pause + two.replace("120", "77")), (3, one + pause + two), (4, words.replace("120", "9"))]
    items = [(1, words)]
    got = result(D.find_leaks(make_docs(docs), spark.createDataFrame(items, "item_id long, text string"), min_share=0.55))
    assert got == brute.leaks(docs, items, set(D.UNITS), min_share=0.55)
    assert set(got) == {(2, 1), (3, 1), (4, 1)} and [got[k, 1][2] for k in (2, 3, 4)] == [True, False, True]


def test_units_of_four_languages():
    for text in ("3 heures", "2 Stunden", "5 días", "4 hours"):
        data, offsets = D.K.as_bytes(D.pa.array([text]))
        assert D.template_tokens(data, offsets)[2].tolist() == [D.NUMBER, D.UNIT]
