"""Toxicity scores from the nearest labelled examples by exact TF-IDF cosine.

Fit: a bounded, hash-chosen sample of labelled texts gives the examples, and
all their words the vocabulary; document frequencies are counted over the whole
table.  How much a word's presence depends on the label (the phi coefficient,
shrunk) scales its TF-IDF weight; no word is left out, so an example's copy has
similarity 1.  The examples' vectors stand in a block-max inverted index:
postings by term, cut into blocks of examples, with each block's largest weight.

Score: the index gives the exact nearest examples of every whole text.  A
block whose bound (the sum of query weight times block maximum) can't reach
the current k-th similarity is never opened.  The neighbours vote with the
inverse of their distance; a logistic curve fitted to leave-one-out votes calibrates the sum.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.llm import textkernels as K
from lendlens.llm.common import small_batches, train_row, written

#: The bounds of the fit: labelled examples of each class, and their bytes of text together.
EXAMPLES_PER_CLASS = 800
EXAMPLE_BYTES = 4 << 20
#: A word weighs idf * (WEIGHT_OF_ANY + phi), where phi is shrunk by what chance gives (CHANCE, a chi-square value).
WEIGHT_OF_ANY = 0.02
CHANCE = 10.0
NEIGHBOURS = 15
BLOCK = 64
#: Blocks opened before the k-th similarity is looked at again.
OPENED = 6
#: A neighbour at cosine distance d votes with 1 / (d + NEAREST); the overall rate with PRIOR_WEIGHT.
NEAREST = 0.05
PRIOR_WEIGHT = 0.5
#: Vectors whose result a worker remembers.
REMEMBERED = 20_000

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def term_hashes(texts: pa.Array):
    """Yields (first row, rows, hashes, owner) of the words: runs of letters (A-Z lower-cased, other scripts as they are)."""
    for lo, hi in K.blocks(K.sizes_of(texts)):
        data, offsets = K.as_bytes(texts.slice(lo, hi - lo))
        starts, ends = K.runs(_LETTER[data], offsets)
        owner = np.searchsorted(offsets, starts, side="right") - 1
        yield lo, hi - lo, K.hash_words(K.LOWER[data], starts, ends), owner


def _known_terms(texts: pa.Array, vocabulary: np.ndarray):
    """Yields (first row, rows, owner, term, count) with the terms of the sorted vocabulary only."""
    for lo, rows, hashes, owner in term_hashes(texts):
        at = np.searchsorted(vocabulary, hashes)
        hit = vocabulary[np.minimum(at, len(vocabulary) - 1)] == hashes if len(vocabulary) else np.zeros(len(hashes), bool)
        pairs, count = np.unique(owner[hit] * max(len(vocabulary), 1) + at[hit], return_counts=True)
        yield lo, rows, pairs // max(len(vocabulary), 1), pairs % max(len(vocabulary), 1), count


def _ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """All numbers of the ranges lo[i]:hi[i], one range after the other."""
    n = hi - lo
    return np.arange(int(n.sum())) + np.repeat(lo - (np.cumsum(n) - n), n)


class BlockMaxIndex:
    """Exact top-k by inner product over sparse unit vectors of non-negative weights."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int):
        # Examples with the same strongest term stand together, so that few blocks hold a term's large weights.
        lead = [(int(t[w.argmax()]), -float(w.max())) for t, w in vectors]
        self.order = np.array(sorted(range(len(vectors)), key=lambda i: (lead[i], i)), dtype=np.int64)
        self.n_blocks = -(-len(vectors) // BLOCK)
        term = np.concatenate([vectors[i][0] for i in self.order]) if len(vectors) else np.zeros(0, np.int64)
        weight = np.concatenate([vectors[i][1] for i in self.order]) if len(vectors) else np.zeros(0)
        place = np.repeat(np.arange(len(vectors)), [len(vectors[i][0]) for i in self.order]) if len(vectors) else np.zeros(0, np.int64)
        by_term = np.lexsort((place, term))
        self.place, self.weight, term = place[by_term], weight[by_term], term[by_term]
        # One entry for each term in each block that has it: its block, largest weight and postings cut[e]:cut[e + 1].
        block = self.place // BLOCK
        new = np.r_[True, (term[1:] != term[:-1]) | (block[1:] != block[:-1])] if len(term) else np.zeros(0, bool)
        start = np.flatnonzero(new)
        self.cut = np.r_[start, len(term)]
        self.block = block[start]
        self.most = np.maximum.reduceat(self.weight, start) if len(start) else np.zeros(0)
        self.entries = np.searchsorted(term[start], np.arange(n_terms + 1))

    def top(self, terms: np.ndarray, weights: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """(examples, similarities) of the k nearest with a positive similarity; ties by example number."""
        lo, hi = self.entries[terms], self.entries[terms + 1]
        entry, w = _ranges(lo, hi), np.repeat(weights, hi - lo)
        block = self.block[entry]
        bound = np.bincount(block, w * self.most[entry], self.n_blocks)
        blocks = np.argsort(-bound, kind="stable")
        blocks = blocks[bound[blocks] > 0]
        ids, sims, least = np.zeros(0, np.int64), np.zeros(0), 0.0
        for at in range(0, len(blocks), OPENED):
            opened = blocks[at:at + OPENED]
            if len(ids) >= k:
                opened = opened[bound[opened] >= least - 1e-9]
                if not len(opened):
                    break
            slot = np.full(self.n_blocks, -1)
            slot[opened] = np.arange(len(opened))
            mine = np.flatnonzero(slot[block] >= 0)
            begin, end = self.cut[entry[mine]], self.cut[entry[mine] + 1]
            posting = _ranges(begin, end)
            # Places within the opened blocks: an entry's postings are all in its block.
            move = np.repeat((slot[block[mine]] - block[mine]) * BLOCK, end - begin)
            score = np.bincount(self.place[posting] + move, np.repeat(w[mine], end - begin) * self.weight[posting], len(opened) * BLOCK)
            hit = np.flatnonzero(score > 0)
            if len(ids) >= k:
                hit = hit[score[hit] >= least]
            found = self.order[opened[hit // BLOCK] * BLOCK + hit % BLOCK]
            hit, found = hit[found != without], found[found != without]
            ids, sims = np.concatenate([ids, found]), np.concatenate([sims, score[hit]])
            best = np.lexsort((ids, -sims))[:k]
            ids, sims = ids[best], sims[best]
            least = sims[-1] if len(sims) else 0.0
        return ids, sims


@dataclass
class Model:
    """All that scoring needs; its size is bounded by the examples and terms."""

    vocabulary: np.ndarray
    term_weight: np.ndarray
    index: BlockMaxIndex
    ids: np.ndarray
    votes: np.ndarray
    weights: np.ndarray
    rate: float
    rate_unknown: float
    curve: tuple[float, float]

    def vote(self, terms, weights, without: int = -1):
        near, sims = self.index.top(terms, weights, NEIGHBOURS, without)
        w = self.weights[near] / (1 - np.minimum(sims, 1.0) + NEAREST)
        scale = PRIOR_WEIGHT * float(self.weights.mean() if len(self.weights) else 1.0)
        return (float(w @ self.votes[near]) + scale * self.rate) / (float(w.sum()) + scale), near, sims

    def calibrated(self, vote: float) -> float:
        a, b = self.curve
        return float(1 / (1 + np.exp(-(a * _logit(vote) + b))))


def _logit(p):
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _unit(terms: np.ndarray, counts: np.ndarray, term_weight: np.ndarray) -> np.ndarray:
    w = (1 + np.log(counts)) * term_weight[terms]
    return w / np.sqrt((w * w).sum())


def _vectors(vocabulary: np.ndarray, names: list[str], text_at: int):
    """Task: the columns `names` plus terms and counts of each row."""

    def run(batches):
        for batch in batches:
            for lo, rows, owner, term, count in _known_terms(batch.column(text_at), vocabulary):
                cut = np.searchsorted(owner, np.arange(rows + 1))
                cols = [batch.column(i).slice(lo, rows) for i in range(batch.num_columns) if i != text_at]
                terms = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(term, pa.int64()))
                counts = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(count, pa.int64()))
                yield pa.RecordBatch.from_arrays([*cols, terms, counts], [*names, "terms", "counts"])

    return run


def _frequencies(vocabulary: np.ndarray):
    """Task: (term, documents) of all its rows; term -1 counts the rows."""

    def run(batches):
        total, rows = np.zeros(len(vocabulary), dtype=np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for _, _, _, term, _ in _known_terms(batch.column(0), vocabulary):
                total += np.bincount(term, minlength=len(vocabulary))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, some], pa.int64()), pa.array(np.r_[rows, total[some]], pa.int64())], ["term", "docs"])

    return run


def _label_terms(batches):
    """Task: distinct terms of each (label, text) as (label, term) rows."""
    for batch in batches:
        label = batch.column(0).to_numpy()
        for lo, _, hashes, owner in term_hashes(batch.column(1)):
            order = np.lexsort((hashes, owner))
            hashes, owner = hashes[order], owner[order]
            new = np.r_[True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])] if len(hashes) else np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays([pa.array(label[lo + owner[new]]), pa.array(hashes[new].view(np.int64))], ["y", "term"])


def _examples(docs: DataFrame, known: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, y, t): of each class the labelled ids of smallest hash, as many as the two bounds of the fit allow.

    A repeated id counts with one of its texts, the one of smallest hash; a text that doesn't fit into what is
    left of EXAMPLE_BYTES is passed over, but a class keeps its shortest text in any case.
    """
    spark = docs.sparkSession
    rank = F.xxhash64("id")
    first = [known.where(F.col("y") == y).orderBy(rank, "id").limit(EXAMPLES_PER_CLASS) for y in (0, 1)]  # a few rows from every task
    chosen = written(first[0].union(first[1]), "labelled")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).where("t IS NOT NULL")
    sample = written(texts.join(F.broadcast(chosen), "id").groupBy("id", "y").agg(F.min_by("t", F.xxhash64("t")).alias("t")), "examples")
    sizes = sample.select("id", "y", F.octet_length("t").alias("size"), rank.alias("h")).collect()  # at most 2 * EXAMPLES_PER_CLASS
    kept = []
    for y in (0, 1):
        mine, left = sorted((r["h"], r["id"], r["size"]) for r in sizes if r["y"] == y), EXAMPLE_BYTES
        before = len(kept)
        for _, i, size in mine:
            if size <= left:
                kept.append((i, y))
                left -= size
        if mine and len(kept) == before:
            kept.append((min(mine, key=lambda r: (r[2], r[0]))[1], y))
    return written(sample.join(F.broadcast(spark.createDataFrame(kept, "id long, y long")), ["id", "y"]), "examples")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Learns from labelled rows whose crc32(id) mod 5 isn't 0; an id labelled twice counts by its largest label.

    Without any labelled text every score is 0; with one class only, it is that class's rate.
    """
    spark = docs.sparkSession
    small_batches(spark)
    known = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & train_row(id_col))
             .groupBy(F.col(id_col).cast("long").alias("id")).agg((F.max(label_col) > 0).cast("long").alias("y")))
    sizes = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    sample = _examples(docs, known, id_col, text_col)
    used = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    n1, n0 = used.get(1, 0), used.get(0, 0)
    # Distinct words of the examples: no more than EXAMPLE_BYTES allows.
    by_term = sample.select("y", "t").mapInArrow(_label_terms, "y long, term long").groupBy("term").agg(
        F.sum("y").cast("double").alias("a"), F.count("*").cast("double").alias("n")).toArrow()
    term, a, n = (by_term[c].to_numpy() for c in ("term", "a", "n"))
    order = np.argsort(term.view(K.U64))
    vocabulary, a, n = term.view(K.U64)[order], a[order], n[order]
    total, expected = float(max(n1 + n0, 1)), n * n1 / max(n1 + n0, 1)
    chi2 = (a - expected) ** 2 * total / (expected * (total - n) * n0 / total + 1e-12) if n1 and n0 else np.zeros(len(n))
    phi = np.sqrt(np.maximum(chi2 - CHANCE, 0) / total)

    counted = docs.select(F.col(text_col).alias("t")).mapInArrow(_frequencies(vocabulary), "term long, docs long")
    counted = counted.groupBy("term").agg(F.sum("docs").alias("docs")).toArrow()
    freq = np.zeros(len(vocabulary) + 1)
    freq[counted["term"].to_numpy()] = counted["docs"].to_numpy()  # term -1, all rows, stands last
    term_weight = (np.log((1 + freq[-1]) / (1 + freq[:-1])) + 1) * (WEIGHT_OF_ANY + phi)

    rows = sample.mapInArrow(_vectors(vocabulary, ["id", "y"], 2), "id long, y long, terms array<long>, counts array<long>").collect()
    rows = sorted(rows, key=lambda r: (r["id"], r["y"], r["terms"], r["counts"]))
    # Every class weighs what it weighs among all labelled rows, however it was sampled.
    class_weight = {y: sizes[y] / used[y] for y in used}
    told = [r for r in rows if r["terms"]]
    vectors = [(np.array(r["terms"]), _unit(np.array(r["terms"]), np.array(r["counts"]), term_weight)) for r in told]
    y = np.array([r["y"] for r in told], dtype=np.float64)
    w = np.array([class_weight[r["y"]] for r in told])
    mute = [(r["y"], class_weight[r["y"]]) for r in rows if not r["terms"]]
    all_w = sum(class_weight[r["y"]] for r in rows)
    rate = sum(r["y"] * class_weight[r["y"]] for r in rows) / all_w if rows else 0.0
    unknown = (sum(a * b for a, b in mute) + rate) / (sum(b for _, b in mute) + 1) if rows else 0.0
    model = Model(vocabulary, term_weight, BlockMaxIndex(vectors, len(vocabulary)), np.array([r["id"] for r in told], dtype=np.int64),
                  y, w, rate, unknown, (1.0, 0.0))
    if told:
        model.curve = _calibrate(spark, model, vectors, y, w)
    return model


def _calibrate(spark, model: Model, vectors, y, w) -> tuple[float, float]:
    """Logistic curve through the leave-one-out votes of the examples (at most 2 * EXAMPLES_PER_CLASS), by Newton steps."""
    shared = spark.sparkContext.broadcast((model, vectors))

    def run(batches):
        m, v = shared.value
        for batch in batches:
            at = batch.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([m.vote(*v[i], without=i)[0] for i in at])], ["id", "vote"])

    votes = spark.range(len(vectors), numPartitions=max(1, len(vectors) // 250)).mapInArrow(run, "id long, vote double").collect()
    x = _logit(np.array([r["vote"] for r in sorted(votes, key=lambda r: r["id"])]))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([(w * (p - y) * x).sum() + 1e-3 * (a - 1) * w.sum(), (w * (p - y)).sum() + 1e-3 * b * w.sum()])
        s = w * p * (1 - p)
        h = np.array([[(s * x * x).sum(), (s * x).sum()], [(s * x).sum(), s.sum()]]) + 1e-3 * w.sum() * np.eye(2)
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-10:
            break
    return float(max(a, 0.0)), float(b)


ADDED = ("score", "predicted", "evidence")


def score(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` of `docs` (all by default) plus score, predicted and evidence.

    evidence lists the nearest examples as (id, label, similarity).  Null and
    empty texts, and those without a word of any example, have no neighbours
    and get the rate of such examples.  Columns named like the new ones are
    replaced; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ADDED]
    own = [text_col] if text_col not in keep else []
    rows = docs.select(*keep, *own)
    at, n_keep = rows.columns.index(text_col), len(keep)
    names = [*rows.columns[:n_keep], *ADDED]
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:n_keep])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    evidence = pa.list_(pa.struct([("id", pa.int64()), ("label", pa.int32()), ("similarity", pa.float64())]))

    def run(batches):
        m: Model = shared.value
        seen: dict[bytes, tuple] = {}
        for batch in batches:
            scores, proofs = [], []
            for _, rows_, owner, term, count in _known_terms(batch.column(at), m.vocabulary):
                cut = np.searchsorted(owner, np.arange(rows_ + 1))
                for lo, hi in zip(cut[:-1], cut[1:]):
                    if lo == hi:
                        found = m.rate_unknown, []
                    else:
                        key = blake2b(term[lo:hi].tobytes() + count[lo:hi].tobytes(), digest_size=16).digest()
                        found = seen.get(key)
                        if found is None:
                            vote, near, sims = m.vote(term[lo:hi], _unit(term[lo:hi], count[lo:hi], m.term_weight))
                            found = m.calibrated(vote), [
                                {"id": int(m.ids[i]), "label": int(m.votes[i]), "similarity": float(s)} for i, s in zip(near, sims)]
                            if len(seen) >= REMEMBERED:
                                seen.clear()
                            seen[key] = found
                    scores.append(found[0])
                    proofs.append(found[1])
            s = np.array(scores, dtype=np.float64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n_keep], pa.array(s), pa.array((s >= 0.5).astype(np.int32)), pa.array(proofs, evidence)],
                names)

    return rows.mapInArrow(run, f"{fields}score double, predicted int, "
                                "evidence array<struct<id: bigint, label: int, similarity: double>>")
