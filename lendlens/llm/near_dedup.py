"""Near-duplicate documents by a chosen-path set similarity join over word shingles.

1. One pass over the texts makes each document's set of distinct shingles and
   keeps its size, a 128-bit digest of the set, and one minwise token for each
   level of each tree.  Equal sets collapse to one representative.
2. Each tree branches the representatives by their minwise token, and a node
   above `NODE_ROWS` branches again by the next level's token.  Small nodes
   are compared exhaustively on the minwise tokens, with a margin of about
   five standard deviations below the threshold.  A pair at similarity s
   meets in a tree of depth d with probability s**d; independent trees bring
   the recall at 0.85 to 1 - (1 - 0.85)**10 for the common depth 1.
3. Whatever these links join is compared on the full shingle sets.  A joined
   group above `GROUP_SHINGLES` branches once more, in every tree, so that no
   task holds more than that (at the deepest level nodes are cut at random,
   differently in each tree); this only finds most of its links early.
4. In a node or group that was cut, every member outside the largest component
   found so far is compared with all others, block against block; texts longer
   than a task may hold are compared by ranges of their shingles.  So a link
   within a joined group doesn't depend on the group's size.
5. Confirmed links give the components.

Within a task a document is compared with whole blocks at once, and pairs
already known to be connected are not compared again; no pair list exists.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendlens.llm import textkernels as K
from lendlens.llm.common import small_batches, written
from lendlens.llm.components import components

TREES, DEPTH = 10, 6
SHINGLE = 3
PERCENT = 85
#: Documents of a node that are compared exhaustively; shingles of a group of full sets.
NODE_ROWS = 2048
GROUP_SHINGLES = 2_000_000
#: Blocks that are compared with all others in one Spark job; bounds the copies of a group that a shuffle holds.
BLOCKS_AT_ONCE = 4
_SEEDS = K.mix(np.arange(1, 2 * TREES * DEPTH + 1, dtype=K.U64)) | K.U64(1)
_DIGEST = K.U64(0x5851F42D4C957F2D)


def shingle_sets(texts: pa.Array, width: int):
    """Yields (first row, rows, shingle hashes, owner) by block; hashes are distinct and sorted within an owner.

    Words are lower-cased (A-Z) and split at \\x20 and \\x09-\\x0D; a text of
    fewer than `width` words has its whole sequence as the one shingle.
    """
    for lo, hi in K.blocks(K.sizes_of(texts)):
        data, offsets = K.as_bytes(texts.slice(lo, hi - lo))
        starts, ends, first = K.word_spans(data, offsets)
        words = K.hash_words(K.LOWER[data], starts, ends)
        at, owner = K.windows_of(first, width)
        hashes = K.window_hashes(words, width)[at]
        counts = np.diff(first)
        for short in range(1, width):
            own = np.flatnonzero(counts == short)
            hashes = np.concatenate([hashes, K.window_hashes(words, short)[first[own]] if len(own) else hashes[:0]])
            owner = np.concatenate([owner, own])
        order = np.lexsort((hashes, owner))
        hashes, owner = hashes[order], owner[order]
        new = np.r_[True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])] if len(hashes) else np.zeros(0, bool)
        yield lo, hi - lo, hashes[new], owner[new]


def _digests(hashes: np.ndarray, owner: np.ndarray, rows: int):
    """(set size, two order-free 64-bit sums) of each row."""
    size = np.bincount(owner, minlength=rows).astype(np.int64)
    cut = np.r_[0, np.cumsum(size)]
    one, two = (np.r_[K.U64(0), np.cumsum(x, dtype=K.U64)] for x in (hashes, K.mix(hashes ^ _DIGEST)))
    return size, (one[cut[1:]] - one[cut[:-1]]).view(np.int64), (two[cut[1:]] - two[cut[:-1]]).view(np.int64)


def _sketch_rows(width: int):
    """Task: (id, digest, n, h1, h2, sig) of each (id, digest, text); sig: TREES * DEPTH minwise tokens as 32-bit numbers."""

    def run(batches):
        for batch in batches:
            texts = batch.column(2)
            for lo, rows, hashes, owner in shingle_sets(texts, width):
                size, h1, h2 = _digests(hashes, owner, rows)
                filled = np.flatnonzero(size)
                sig = np.zeros((rows, TREES * DEPTH), dtype=np.uint32)
                if len(filled):
                    cut = np.r_[0, np.cumsum(size)][filled]
                    for j in range(TREES * DEPTH):
                        v = (((hashes ^ _SEEDS[2 * j]) * _SEEDS[2 * j + 1]) >> K.U64(32)).astype(np.uint32)
                        sig[filled, j] = np.minimum.reduceat(v, cut)
                sigs = [sig[i].tobytes() if size[i] else None for i in range(rows)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, rows), batch.column(1).slice(lo, rows), pa.array(size), pa.array(h1), pa.array(h2),
                     pa.array(sigs, pa.binary())], ["id", "digest", "n", "h1", "h2", "sig"])

    return run


def _sig_matrix(column) -> np.ndarray:
    raw = column.to_pylist()
    return np.frombuffer(b"".join(raw), dtype=np.uint32).reshape(len(raw), TREES * DEPTH)


def _first_paths(batches):
    """Task: one (path, tree, rep) for each tree and (rep, sig)."""
    for batch in batches:
        sig, reps = _sig_matrix(batch.column(1)), batch.column(0).to_numpy()
        for tree in range(TREES):
            path = K.mix(K.mix(sig[:, tree * DEPTH].astype(K.U64)) + K.U64(tree + 1)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(path), pa.array(np.full(len(reps), tree, np.int32)), pa.array(reps)], ["path", "tree", "rep"])


def _deeper(level: int):
    """Task: the path of each row one level on; past the last level a random cut of the node."""

    def run(batches):
        for batch in batches:
            cols = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            path, tree = cols["path"].to_numpy().view(K.U64), cols["tree"].to_numpy()
            if level < DEPTH:
                step = _sig_matrix(cols["sig"])[np.arange(len(tree)), tree * DEPTH + level].astype(K.U64)
            else:
                cuts = np.maximum(cols["parts"].to_numpy(), 1).astype(K.U64)
                step = K.mix(cols["rep"].to_numpy().view(K.U64) + K.mix(tree.astype(K.U64) + K.U64(99))) % cuts
            cols["path"] = pa.array(K.mix(path + K.mix(step + K.U64(level + 1))).view(np.int64))
            yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))

    return run


NODE_COLS = ["path", "tree", "rep", "n", "sig"]


def _small_nodes(rows: DataFrame, level: int, limit: int, weight) -> tuple[list[DataFrame], DataFrame | None]:
    """Branches rows (NODE_COLS) from `level` on until every node's weight is within `limit`.

    Each table of the list holds whole nodes.  Beyond the last level nodes are cut at random into parts within the
    limit; the second result holds those nodes uncut.
    """
    out, uncut = [], None
    while True:
        sizes = rows.groupBy("path").agg(F.sum(weight).alias("w"), F.count("*").alias("c")).where("c > 1")
        rows = written(rows.select(NODE_COLS).join(sizes, "path"), "nodes")
        out.append(rows.where(F.col("w") <= limit).select(NODE_COLS))
        large = rows.where(F.col("w") > limit)
        if level > DEPTH:
            return (out if large.isEmpty() else out + [large.select(NODE_COLS)]), uncut
        if large.isEmpty():
            return out, None
        if level == DEPTH:
            uncut = large.select(NODE_COLS)
        large = large.select(*NODE_COLS, F.ceil(F.col("w") * 2 / limit).cast("long").alias("parts"))
        rows = large.mapInArrow(_deeper(level), large.schema)
        level += 1


def linked_groups(n: int, linked) -> np.ndarray:
    """Labels of 0..n-1 by the links that linked(i), a Boolean array, gives; equal labels: connected.

    Each pair of different components is tested from one side at least: all
    but the members of the largest component are compared with everything.
    """
    label, done = np.arange(n), np.zeros(n, dtype=bool)
    pivot = 0
    while True:
        done[pivot] = True
        met = label[linked(pivot)]
        if len(met):
            label[np.isin(label, met)] = label[pivot]
        rest = np.flatnonzero(~done & (label != np.bincount(label, minlength=n).argmax()))
        if not len(rest):
            return label
        pivot = rest[0]


def _stars(reps: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(member, smallest member of its group) for each member but the smallest."""
    order = np.argsort(reps, kind="stable")
    _, where, which = np.unique(label[order], return_index=True, return_inverse=True)
    least = np.empty_like(reps)
    least[order] = reps[order][where][which]
    away = reps != least
    return reps[away], least[away]


def _enough(percent: int) -> int:
    """Minwise tokens that a pair must share."""
    s = percent / 100
    k = TREES * DEPTH
    return int(np.floor(k * s - 5 * np.sqrt(k * s * (1 - s))))


def _near_by_sketch(percent: int):
    """Task over rows sorted by path: star links of each node's members that agree in enough minwise tokens."""
    enough = _enough(percent)

    def of_node(reps, n, sig):
        def linked(i):
            return (100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i])) & ((sig == sig[i]).sum(axis=1) >= enough)
        if len(reps) == 2:
            label = np.array([0, 0 if linked(0)[1] else 1])
        else:
            label = linked_groups(len(reps), linked)
        return _stars(reps, label)

    def run(batches):
        held = None
        for batch in chain(_tables(batches), [None]):
            if batch is not None:
                held = batch if held is None else pa.concat_tables([held, batch])
            if held is None or not held.num_rows:
                continue
            path = held["path"].to_numpy()
            cut = np.flatnonzero(np.r_[True, path[1:] != path[:-1]])
            ends = np.r_[cut[1:], len(path)]
            whole = len(cut) if batch is None else len(cut) - 1  # the last node may go on in the next batch
            if whole:
                reps, n, sig = held["rep"].to_numpy(), held["n"].to_numpy(), _sig_matrix(held["sig"])
                found = [of_node(reps[a:b], n[a:b], sig[a:b]) for a, b in zip(cut[:whole], ends[:whole]) if b - a > 1]
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate([f[0] for f in found])), pa.array(np.concatenate([f[1] for f in found]))],
                        ["u", "v"])
                held = held.slice(ends[whole - 1])

    return run


def _tables(batches):
    for batch in batches:
        if batch.num_rows:
            yield pa.Table.from_batches([batch])


def _awaited_sets(batch, width: int):
    """Yields (rows, their sorted shingle hashes) of the texts whose digest is the one awaited (others share only the id)."""
    cols = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
    awaited = [cols[c].to_numpy() for c in ("n", "h1", "h2")]
    for lo, rows, hashes, owner in shingle_sets(cols["text"], width):
        got = _digests(hashes, owner, rows)
        cut = np.r_[0, np.cumsum(got[0])]
        same = np.flatnonzero(np.all([a[lo:lo + rows] == b for a, b in zip(awaited, got)], axis=0))
        yield same + lo, [hashes[cut[i]:cut[i + 1]] for i in same]


def _full_sets(width: int):
    """Task: the shingles of each awaited text."""

    def run(batches):
        for batch in batches:
            for at, sets in _awaited_sets(batch, width):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rep").take(pa.array(at)), pa.array([x.tobytes() for x in sets], pa.binary())],
                    ["rep", "shingles"])

    return run


def _ranged_sets(width: int):
    """Task: (path, part, rep, n, shingles) for each of the equal hash ranges that `parts` asks for."""

    def run(batches):
        for batch in batches:
            path, rep, n, parts = (batch.column(c).to_pylist() for c in ("path", "rep", "n", "parts"))
            for at, sets in _awaited_sets(batch, width):
                for i, x in zip(at.tolist(), sets):
                    step = -(-2 ** 64 // parts[i])
                    cut = [0, *np.searchsorted(x, np.array([k * step for k in range(1, parts[i])], dtype=K.U64)).tolist(), len(x)]
                    for part, (a, b) in enumerate(zip(cut[:-1], cut[1:])):
                        if a < b:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([path[i]]), pa.array([part], pa.int64()), pa.array([rep[i]]), pa.array([n[i]]),
                                 pa.array([x[a:b].tobytes()], pa.binary())], ["path", "part", "rep", "n", "shingles"])

    return run


def _tokens(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token numbers, first token, tokens) of non-empty sets of hashes."""
    sizes = np.array([len(x) // 8 for x in raw])
    token = np.unique(np.frombuffer(b"".join(raw), dtype=K.U64), return_inverse=True)[1].astype(np.int32)
    return token, np.cumsum(sizes) - sizes, sizes


def _shared_by_range(percent: int, limit: int):
    """Group task: shingles of one range that two texts share, for texts of fitting sizes of which one is above `limit`."""

    def run(table: pa.Table) -> pa.Table:
        reps, n = table["rep"].to_numpy(), table["n"].to_numpy()
        token, start, sizes = _tokens(table["shingles"].to_pylist())
        mark = np.zeros(int(token.max()) + 1, dtype=bool)
        out = [[np.zeros(0, np.int64)] * 5]
        for i in np.flatnonzero(n > limit):
            fits = (100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i])) & ((n <= limit) | (reps > reps[i]))
            if fits.any():
                own = token[start[i]:start[i] + sizes[i]]
                mark[own] = True
                both = np.add.reduceat(mark[token], start, dtype=np.int64)
                mark[own] = False
                j = np.flatnonzero(fits & (both > 0))
                out.append([np.full(len(j), reps[i]), reps[j], np.full(len(j), n[i]), n[j], both[j]])
        return pa.table([pa.array(np.concatenate(c), pa.int64()) for c in zip(*out)], ["u", "v", "nu", "nv", "both"])

    return run


def _across(percent: int, by_sketch: bool):
    """Group task: links between the members of one block (side 0) and another (side 1) that aren't yet connected."""
    enough = _enough(percent)

    def run(table: pa.Table) -> pa.Table:
        side, reps, label, n = (table[c].to_numpy() for c in ("side", "rep", "label", "n"))
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        u, v = [], []
        if len(left) and len(right):
            label, raw = label.copy(), table["payload"].to_pylist()
            if by_sketch:
                sig = np.frombuffer(b"".join(raw), dtype=np.uint32).reshape(len(raw), TREES * DEPTH)
                other = sig[right]
            else:
                token, start, sizes = _tokens([raw[i] for i in np.r_[left, right]])
                # Sets in the order left, right: the tokens of the right side are one slice.
                cut = start[len(left)]
                other, first = token[cut:], start[len(left):] - cut
                mark = np.zeros(int(token.max()) + 1, dtype=bool)
            for k, i in enumerate(left):
                fits = (label[right] != label[i]) & (100 * np.minimum(n[right], n[i]) >= percent * np.maximum(n[right], n[i]))
                if not fits.any():
                    continue
                if by_sketch:
                    fits &= (other == sig[i]).sum(axis=1) >= enough
                else:
                    own = token[start[k]:start[k] + sizes[k]]
                    mark[own] = True
                    both = np.add.reduceat(mark[other], first, dtype=np.int64)
                    mark[own] = False
                    fits &= 100 * both >= percent * (n[right] + n[i] - both)
                met = right[fits]
                met = met[np.unique(label[met], return_index=True)[1]]
                u += [reps[i]] * len(met)
                v += reps[met].tolist()
                label[np.isin(label, label[met])] = label[i]
        return pa.table([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return run


def _links_between_blocks(rows: DataFrame, joined: DataFrame, payload: DataFrame, limit: int, weight, percent: int,
                          by_sketch: bool) -> DataFrame | None:
    """Links (u, v) of the members of each path that `joined`, the components so far, leaves apart; None without such members.

    rows: (path, rep, n); payload: (rep, payload).  All members but those of a path's largest component (loose ones)
    are compared with all others, in blocks of about half the limit.  Two loose members meet in the lower block.
    """
    label = rows.join(joined.select(F.col("id").alias("rep"), "component"), "rep", "left").select(
        "path", "rep", "n", F.coalesce("component", "rep").alias("label"), F.expr(weight).alias("w"))
    parts = label.groupBy("path", "label").agg(F.count("*").alias("c"), F.sum("w").alias("w"))
    # The largest component stays; blocks follow from the weights of all members and of the loose ones.
    paths = parts.groupBy("path").agg(F.max(F.struct("c", "w", "label")).alias("top"), F.sum("w").alias("all"), F.count("*").alias("k"))
    paths = paths.where("k > 1").select(
        "path", F.col("top.label").alias("stays"), F.ceil(F.col("all") * 2 / limit).cast("long").alias("blocks"),
        F.ceil((F.col("all") - F.col("top.w")) * 2 / limit).cast("long").alias("loose_blocks"))
    paths = written(paths, "uncut")
    most = paths.agg(F.max("loose_blocks")).first()[0]
    if most is None:
        return None
    held = label.join(paths, "path").withColumn(
        "loose", F.when(F.col("label") != F.col("stays"), F.pmod(F.xxhash64("rep", F.lit(1)), "loose_blocks"))).withColumn(
        "block", F.pmod(F.xxhash64("rep", F.lit(2)), "blocks"))
    held = written(held.select("path", "rep", "n", "label", "loose", "block", "blocks", "loose_blocks").join(payload, "rep"), "blocks")
    found = None
    for at in range(0, most, BLOCKS_AT_ONCE):
        end = at + BLOCKS_AT_ONCE - 1
        cols = ["path", "rep", "n", "label", "payload"]
        one = held.where(F.col("loose").between(at, end)).select(
            *cols, F.lit(0).alias("side"), "loose", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
        last = F.least(F.lit(end).cast("long"), F.col("loose_blocks") - 1, F.coalesce("loose", F.lit(end).cast("long")))
        two = held.where(last >= at).select(
            *cols, F.lit(1).alias("side"), F.explode(F.sequence(F.lit(at).cast("long"), last)).alias("loose"), "block")
        links = one.unionByName(two).groupBy("path", "loose", "block").applyInArrow(_across(percent, by_sketch), "u long, v long")
        links = written(links, "block-links")
        found = links if found is None else found.union(links)
    return found


def _near_by_sets(percent: int):
    """Group task: star links of the members whose full sets are similar enough."""

    def run(table: pa.Table) -> pa.Table:
        reps, raw = table["rep"].to_numpy(), table["shingles"].to_pylist()
        token, start, sizes = _tokens(raw)
        mark = np.zeros(int(token.max()) + 1, dtype=bool)

        def linked(i):
            own = token[start[i]:start[i] + sizes[i]]
            mark[own] = True
            both = np.add.reduceat(mark[token], start, dtype=np.int64)
            mark[own] = False
            return 100 * both >= percent * (sizes + sizes[i] - both)

        u, v = _stars(reps, linked_groups(len(reps), linked))
        return pa.table([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return run


def _as_links(joined: DataFrame) -> DataFrame:
    return joined.select(F.col("id").alias("u"), F.col("component").alias("v"))


def _rest_of_wide(wide: DataFrame, joined: DataFrame, awaited: DataFrame, texts_of, width: int, percent: int) -> DataFrame | None:
    """Confirmed links that the branches of the groups `wide` (path, rep, n) have not met; None if there can't be any."""
    usual = wide.where(F.col("n") <= GROUP_SHINGLES)
    payload = texts_of(awaited.join(usual.select("rep"), "rep", "left_semi")).select("rep", "n", "h1", "h2", "text").mapInArrow(
        _full_sets(width), "rep long, payload binary")
    found = _links_between_blocks(usual, joined, payload, GROUP_SHINGLES, "n", percent, False)
    with_long = wide.where(F.col("n") > GROUP_SHINGLES).select("path").distinct()
    if with_long.isEmpty():
        return found
    long = wide.join(with_long, "path", "left_semi").where(F.col("n") * 100 >= percent * GROUP_SHINGLES)
    parts = long.groupBy("path").agg(F.ceil(F.sum("n") * 2 / GROUP_SHINGLES).cast("long").alias("parts"))
    texts = texts_of(long.select("path", "rep").join(parts, "path").join(awaited, "rep"))
    ranged = texts.select("path", "rep", "n", "h1", "h2", "parts", "text").mapInArrow(
        _ranged_sets(width), "path long, part long, rep long, n long, shingles binary")
    shared = ranged.groupBy("path", "part").applyInArrow(
        _shared_by_range(percent, GROUP_SHINGLES), "u long, v long, nu long, nv long, both long")
    total = shared.groupBy("u", "v", "nu", "nv").agg(F.sum("both").alias("both"))
    links = total.where(F.col("both") * 100 >= percent * (F.col("nu") + F.col("nv") - F.col("both"))).select("u", "v")
    return links if found is None else found.union(links)


def _labelled(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """(id, digest, n, c, component_id, kept) of each row: a hash of its text, the size of its set, and its component c (null: no set)."""
    small_batches(docs.sparkSession)
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sketches = written(narrow.select("id", F.xxhash64("text").alias("digest"), "text").mapInArrow(
        _sketch_rows(width), "id long, digest long, n long, h1 long, h2 long, sig binary"), "sketches")
    reps = written(sketches.where("n > 0 AND id IS NOT NULL").groupBy("n", "h1", "h2")
                   .agg(F.min("id").alias("rep"), F.first("sig").alias("sig")), "reps")
    # An id may stand for several sets; the trees work on a number for each set.
    reps = reps.withColumn("node", F.xxhash64("n", "h1", "h2"))

    nodes = reps.select("node", "sig").mapInArrow(_first_paths, "path long, tree int, rep long")
    shared = nodes.groupBy("path").count().where("count > 1").select("path")
    sized = reps.select(F.col("node").alias("rep"), "n", "sig")
    rows = nodes.join(shared, "path").join(sized, "rep").select(NODE_COLS)
    likely = None
    small, uncut = _small_nodes(rows, 1, NODE_ROWS, F.lit(1))
    for part in small:
        links = part.repartition("path").sortWithinPartitions("path").mapInArrow(_near_by_sketch(percent), "u long, v long")
        likely = links if likely is None else likely.union(links)
    groups = components(likely)
    if uncut is not None:
        more = _links_between_blocks(uncut.select("path", "rep", "n"), groups, sized.select("rep", F.col("sig").alias("payload")),
                                     NODE_ROWS, "1L", percent, True)
        if more is not None:
            groups = components(_as_links(groups).union(more))
    groups = groups.select(F.col("id").alias("rep"), F.col("component").alias("path"))

    member = groups.join(sized, "rep").withColumn("tree", F.lit(0)).select(NODE_COLS)
    member = written(member, "members")
    weight = member.groupBy("path").agg(F.sum("n").alias("w"))
    plain = member.join(weight.where(F.col("w") <= GROUP_SHINGLES).select("path"), "path", "left_semi")
    parts = [plain]
    wide = weight.where(F.col("w") > GROUP_SHINGLES).select("path")
    branched = not wide.isEmpty()
    if branched:
        wide = member.join(wide, "path", "left_semi")
        every = wide.where(F.col("n") <= GROUP_SHINGLES).withColumn(
            "tree", F.explode(F.array(*[F.lit(t) for t in range(TREES)])))
        every = every.withColumn("path", F.xxhash64("path", "tree")).withColumn("parts", F.lit(1).cast("long"))
        deeper = every.select(*NODE_COLS, "parts").mapInArrow(_deeper(0), every.select(*NODE_COLS, "parts").schema)
        parts += _small_nodes(deeper.select(NODE_COLS), 1, GROUP_SHINGLES, F.col("n"))[0]
    awaited = member.select("rep").distinct().join(
        reps.select(F.col("node").alias("rep"), F.col("rep").alias("id"), "n", "h1", "h2"), "rep")

    def texts_of(some: DataFrame) -> DataFrame:
        return narrow.join(some, "id").drop("id")

    sets = "rep long, shingles binary"
    where = None
    for part in parts:
        place = part.select("path", "rep")
        where = place if where is None else where.union(place)
    full = texts_of(awaited).select("rep", "n", "h1", "h2", "text").mapInArrow(_full_sets(width), sets)
    sure = full.join(where, "rep").groupBy("path").applyInArrow(_near_by_sets(percent), "u long, v long")
    joined = components(sure)
    if branched:
        more = _rest_of_wide(wide.select("path", "rep", "n"), joined, awaited, texts_of, width, percent)
        if more is not None:
            joined = components(_as_links(joined).union(more))

    label = reps.join(joined.select(F.col("id").alias("node"), "component"), "node", "left")
    first = label.groupBy(F.coalesce("component", "node").alias("c")).agg(F.min("rep").alias("component_id"))
    label = label.withColumn("c", F.coalesce("component", "node")).join(first, "c").select("n", "h1", "h2", "c", "component_id")
    return (sketches.select("id", "digest", "n", "h1", "h2").join(label, ["n", "h1", "h2"], "left")
            .select("id", "digest", "n", "c", F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))))


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE,
                    percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id, kept) of each row of `docs`, linked at Jaccard similarity >= percent / 100.

    component_id is the smallest id that links reach, kept whether that is the
    row's own.  Empty or null texts have no shingles and are linked with
    nothing; a row with a null id is linked with nothing, has a null
    component and is kept.  Rows with the same id and different texts are
    judged each for itself; an empty table gives an empty result.
    """
    return _labelled(docs, id_col, text_col, width, percent).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", "kept")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of `docs` whose id is the smallest of its component, all columns unchanged.

    Rows that repeat an id are judged by their own texts; of those of one component (or without words) the one with
    the smallest text (null first) stays.  Rows with a null id all stay.
    """
    digest, group = "__digest", "__component"
    kept = (_labelled(docs, id_col, text_col, width, percent).where(F.col("kept") & F.col("id").isNotNull())
            .select(F.col("id").alias(id_col), F.col("digest").alias(digest), F.col("c").alias(group)).distinct())
    named = docs.where(F.col(id_col).isNotNull()).withColumn(digest, F.xxhash64(text_col))
    place = Window.partitionBy(id_col, group).orderBy(F.col(text_col).asc_nulls_first())
    chosen = named.join(kept, [id_col, digest]).withColumn("__place", F.row_number().over(place)).where("__place = 1")
    return chosen.select(docs.columns).union(docs.where(F.col(id_col).isNull()))
