"""Substring deduplication by Rabin-Karp window hashes.

Every window of `width` consecutive words of every text is hashed.  Tasks
first collapse equal windows within a block of documents: the block's smallest
document of a window ships it to a bucket cut by the hash's leading bits, so
that a bucket stays at about `windows_per_bucket` entries at any corpus size
and a passage that fills a third of the corpus leaves one entry per block.  The
block's other documents already know that a smaller one has the window; they
ship it to their own group of documents.  A bucket finds the smallest document
of each window; the windows of later documents go back to their documents as
lists of hashes.  There repeated windows merge into maximal removal intervals.

A window's identity is its bucket plus 56 bits of its hash, which has 61: a
window is taken for one of n other windows by accident with a chance of about
n / 2**61 (10**9 other windows: 4 in 10**10).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.llm import textkernels as K
from lendlens.llm.common import small_batches

WIDTH = 13
#: Windows of one bucket and text bytes of one document group: they bound a task's memory.
WINDOWS_PER_BUCKET = 2_000_000
BYTES_PER_GROUP = 8 << 20
#: Bytes of text within which a task collapses equal windows before it ships them.
BYTES_PER_BLOCK = 8 << 20
HASH_BYTES = 7
LOW = K.U64((1 << (8 * HASH_BYTES)) - 1)

PACKED = "ids binary, counts binary, hashes binary"


def _hashes_of(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(window hash, index of its text) of all windows."""
    sizes, hashes, owners = K.sizes_of(texts), [], []
    for lo, hi in K.blocks(sizes):
        data, offsets = K.as_bytes(texts.slice(lo, hi - lo))
        starts, ends, first = K.word_spans(data, offsets)
        at, owner = K.windows_of(first, width)
        hashes.append(K.window_hashes(K.hash_words(data, starts, ends), width)[at])
        owners.append((owner + lo).astype(np.int32))
    if not hashes:
        return np.zeros(0, dtype=K.U64), np.zeros(0, dtype=np.int32)
    return np.concatenate(hashes), np.concatenate(owners)


def _packed(hashes: np.ndarray, ids: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Runs of equal ids with their counts, and the low bytes of the hashes."""
    cut = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]]) if len(ids) else np.zeros(0, dtype=np.int64)
    counts = np.diff(np.r_[cut, len(ids)])
    low = np.ascontiguousarray(hashes).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES]
    # Differences of ids are small numbers, which the shuffle's compression packs well.
    deltas = np.diff(ids[cut], prepend=np.int64(0))
    return deltas.astype("<i8").tobytes(), counts.astype("<u4").tobytes(), low.tobytes()


def _unpacked(ids: bytes, counts: bytes, hashes: bytes) -> tuple[np.ndarray, np.ndarray]:
    low = np.frombuffer(hashes, dtype=np.uint8).reshape(-1, HASH_BYTES)
    full = np.zeros((len(low), 8), dtype=np.uint8)
    full[:, :HASH_BYTES] = low
    owners = np.cumsum(np.frombuffer(ids, dtype="<i8"))
    return full.view("<u8").ravel(), np.repeat(owners, np.frombuffer(counts, dtype="<u4"))


def _unpacked_rows(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    parts = [_unpacked(*row) for row in zip(*(table[c].to_pylist() for c in ("ids", "counts", "hashes")))]
    if not parts:
        return np.zeros(0, dtype=K.U64), np.zeros(0, dtype=np.int64)
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _window_rows(width: int, buckets: int, groups: int):
    """Task: documents to packed window hashes by bucket; equal windows of a block are collapsed.

    Repeats within the block go to their documents' group, numbered from `buckets` on.
    """

    def of_block(ids: np.ndarray, texts: pa.Array):
        order = np.argsort(ids, kind="stable")
        hashes, owner = _hashes_of(texts.take(pa.array(order)), width)
        ids = ids[order][owner]
        by_hash = np.argsort(hashes, kind="stable")  # documents stand in order of their ids
        sorted_h = hashes[by_hash]
        new = np.r_[True, sorted_h[1:] != sorted_h[:-1]] if len(sorted_h) else np.zeros(0, dtype=bool)
        lead = by_hash[new]
        keep = np.zeros(len(hashes), dtype=np.int8)  # 0: same document again, 1: smallest, 2: repeat of a smaller one
        keep[lead] = 1
        follows = by_hash[~new]
        keep[follows[ids[follows] > ids[lead][np.cumsum(new)[~new] - 1]]] = 2
        bucket = ((hashes >> K.U64(32)) * K.U64(buckets) >> K.U64(32)).astype(np.int64)
        for kind in (1, 2):
            chosen = np.flatnonzero(keep == kind)
            place = bucket[chosen] if kind == 1 else buckets + np.mod(ids[chosen], groups)
            order = np.argsort(place, kind="stable")
            chosen, place = chosen[order], place[order]
            edges = np.flatnonzero(np.r_[True, place[1:] != place[:-1]]) if len(place) else np.zeros(0, dtype=np.int64)
            if not len(edges):
                continue
            rows = [_packed(hashes[c], ids[c]) for c in np.split(chosen, edges[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(place[edges], pa.int64()), pa.array([kind] * len(edges), pa.int32()),
                 *(pa.array(col, pa.binary()) for col in zip(*rows))], ["bucket", "kind", "ids", "counts", "hashes"])

    def run(batches):
        held_ids, held_texts, held = [], [], 0
        for batch in batches:
            known = batch.filter(batch.column(0).is_valid())
            for lo, hi in K.blocks(K.sizes_of(known.column(1)), BYTES_PER_BLOCK):
                part = known.slice(lo, hi - lo)
                held_ids.append(part.column(0).to_numpy())
                held_texts.append(part.column(1).cast(pa.large_string()))
                held += int(K.sizes_of(part.column(1)).sum())
                if held >= BYTES_PER_BLOCK:
                    yield from of_block(np.concatenate(held_ids), pa.concat_arrays(held_texts))
                    held_ids, held_texts, held = [], [], 0
        if held_ids:
            yield from of_block(np.concatenate(held_ids), pa.concat_arrays(held_texts))

    return run


def _verdict_rows(groups: int):
    """Group task: the windows of one bucket to those that a smaller document also has, by document group.

    The repeats that blocks found for one document group come as a bucket of their own and pass.
    """

    def run(table: pa.Table) -> pa.Table:
        kinds = np.array(table["kind"].to_pylist(), dtype=np.int32)
        hashes, ids = _unpacked_rows(table.filter(pa.array(kinds == 1)))
        order = np.argsort(hashes, kind="stable")
        hashes, ids = hashes[order], ids[order]
        new = np.r_[True, hashes[1:] != hashes[:-1]] if len(hashes) else np.zeros(0, dtype=bool)
        if len(hashes):
            least = np.minimum.reduceat(ids, np.flatnonzero(new))
            later = ids > least[np.cumsum(new) - 1]
            hashes, ids = hashes[later], ids[later]
        known_h, known_i = _unpacked_rows(table.filter(pa.array(kinds == 2)))
        hashes, ids = np.concatenate([hashes, known_h]), np.concatenate([ids, known_i])
        group = np.mod(ids, groups)
        order = np.lexsort((ids, group))
        hashes, ids, group = hashes[order], ids[order], group[order]
        edges = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, dtype=np.int64)
        spans = list(zip(edges, np.r_[edges[1:], len(group)]))
        rows = [_packed(hashes[lo:hi], ids[lo:hi]) for lo, hi in spans]
        cols = list(zip(*rows)) if rows else [[], [], []]
        return pa.table([pa.array([int(group[lo]) for lo, _ in spans], pa.int64()),
                         *(pa.array(list(col), pa.binary()) for col in cols)], ["grp", "ids", "counts", "hashes"])

    return run


def _without(texts: pa.Array, ids: np.ndarray, hashes: np.ndarray, owners: np.ndarray, width: int):
    """(n_words, n_removed, kept text) of each text; hashes: the windows to remove, of document `owners`."""
    n_words, n_removed, kept_texts = [], [], []
    salt = lambda h, i: K.mix(K.mix(i.astype(K.U64)) ^ (h & LOW))
    marked = np.unique(salt(hashes, owners))
    for lo, hi in K.blocks(K.sizes_of(texts)):
        data, offsets = K.as_bytes(texts.slice(lo, hi - lo))
        starts, ends, first = K.word_spans(data, offsets)
        at, owner = K.windows_of(first, width)
        hit = np.zeros(len(at), dtype=bool)
        if len(marked) and len(at):
            keys = salt(K.window_hashes(K.hash_words(data, starts, ends), width)[at], ids[lo:hi][owner])
            found = np.searchsorted(marked, keys)
            hit = marked[np.minimum(found, len(marked) - 1)] == keys
        change = np.zeros(len(starts) + 1, dtype=np.int64)
        np.add.at(change, at[hit], 1)
        np.add.at(change, at[hit] + width, -1)
        gone = np.cumsum(change[:-1]) > 0
        total = np.diff(first)
        taken = np.r_[0, np.cumsum(gone)]
        n_words.append(total)
        n_removed.append(taken[first[1:]] - taken[first[:-1]])
        # Bytes of the kept words, and one separator after each kept word but a text's last.
        word = np.flatnonzero(~gone)
        doc = np.searchsorted(first, word, side="right") - 1
        step = np.zeros(len(data) + 1, dtype=np.int8)
        step[starts[word]] = 1
        step[ends[word]] -= 1
        inside = np.cumsum(step[:-1], dtype=np.int8).astype(bool)
        inner = ends[word[:-1]][doc[1:] == doc[:-1]]
        out = data.copy()
        out[inner] = 0x20
        inside[inner] = True
        sizes = np.r_[0, np.cumsum(inside)]
        kept_texts.append(pa.LargeStringArray.from_buffers(
            hi - lo, pa.py_buffer(sizes[offsets].astype(np.int64).tobytes()), pa.py_buffer(out[inside].tobytes())))
    if not n_words:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, pa.array([], pa.string())
    return np.concatenate(n_words), np.concatenate(n_removed), pa.concat_arrays(kept_texts).cast(pa.string())


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """All rows and columns of `docs` plus n_words, n_removed and kept_text.

    A word goes if a window of `width` words that covers it also starts in a
    row with a smaller id; windows are those of the input.  kept_text joins
    the kept words by one space.  Null text counts as empty (kept_text "");
    rows with a null id are never compared (nothing goes); rows with the same
    id don't remove each other's words; an empty table gives an empty result.
    Columns of `docs` that are named like the three new ones are replaced.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.drop(*({"n_words", "n_removed", "kept_text"} - {id_col, text_col}))
    narrow = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"))
    size = narrow.agg(F.sum(F.octet_length("t")).alias("b")).first()["b"] or 0
    buckets = 1 + int(size // 6 // WINDOWS_PER_BUCKET)
    groups = _prime_from(1 + int(size // BYTES_PER_GROUP))
    rows = narrow.mapInArrow(_window_rows(width, buckets, groups), f"bucket long, kind int, {PACKED}")
    verdicts = rows.groupBy("bucket").applyInArrow(_verdict_rows(groups), f"grp long, {PACKED}")
    grp = "__grp"
    # Rows without an id wait for no verdicts: any group will do, so they are spread by their text.
    keyed = docs.withColumn(grp, F.pmod(F.coalesce(F.col(id_col).cast("long"), F.xxhash64(text_col)), F.lit(groups)).cast("long"))
    names = docs.columns
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.combine_chunks()
        at = left[id_col].combine_chunks() if left.num_rows else pa.array([], pa.int64())
        ids = at.cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False)
        texts = left[text_col].combine_chunks() if left.num_rows else pa.array([], pa.string())
        if isinstance(texts, pa.ChunkedArray):
            texts = pa.concat_arrays(texts.chunks)
        hashes, owners = _unpacked_rows(right)
        n_words, n_removed, kept = _without(texts, ids, hashes, owners, width)
        known = at.is_valid().to_numpy(zero_copy_only=False)
        if not known.all():  # a null id shares the stand-in -1 with a real one, which may have marks
            plain_words, none, whole = _without(texts, ids, hashes[:0], owners[:0], width)
            n_words, n_removed = np.where(known, n_words, plain_words), np.where(known, n_removed, none)
            kept = pa.compute.if_else(pa.array(known), kept, whole)
        out = left.select(names)
        for name, col in (("n_words", pa.array(n_words, pa.int64())), ("n_removed", pa.array(n_removed, pa.int64())),
                          ("kept_text", kept)):
            out = out.append_column(name, col)
        return out

    return (keyed.groupBy(grp).cogroup(verdicts.groupBy("grp"))
            .applyInArrow(finish, f"{fields}, n_words long, n_removed long, kept_text string"))


def _prime_from(n: int) -> int:
    """The first prime from n on: no step between ids, other than its multiples, fills few groups."""
    while any(n % p == 0 for p in range(2, int(n ** 0.5) + 1)):
        n += 1
    return n
