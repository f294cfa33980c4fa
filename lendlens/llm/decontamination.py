"""Benchmark decontamination by template canonicalisation.

Texts become sequences of tokens in which numbers, units after a number and
names (capitalised words inside a sentence) are typed placeholders; all other
words stand for themselves, lower-cased.  Windows of `WIDTH` tokens are hashed
and joined with the benchmark's.  Aligned windows must fill the benchmark's
slots consistently: each slot value of the item has one value in the
document.  That holds within an alignment (windows at one distance from the
item's) and between the alignments that count together: the largest alignment
that has a slot value says what stands for it, and alignments that say
otherwise don't count.  A verbatim copy and a re-parameterised question both
pass, while a chance match of templates doesn't cover enough of an item.

Windows with few plain words would match by chance.  They are compared word
by word, with the values of their slots, and count for items that templates
alone don't show.  So a verbatim copy of any item is found.

Documents send only windows whose hash is marked in a bitmap of the
benchmark's hashes.  The bitmap has a fixed size: a larger benchmark lets
more windows through to the join and changes no result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.llm import textkernels as K
from lendlens.llm.common import small_batches, written

WIDTH = 8
#: Plain words that a template window needs; shorter items than this many tokens name nothing and never match.
MIN_LITERALS = 4
MIN_TOKENS = 5
#: Share of an item's windows that a document must hold.
MIN_SHARE = 0.4
BITMAP_BITS = 1 << 24
#: Units that are placeholders when a number stands before them.
UNITS = ("km m cm mm mi mile miles ft feet foot inch inches yard yards kg g mg lb lbs pound pounds ounce ounces ton tons "
         "l ml liter liters litre litres s sec second seconds min minute minutes h hr hour hours day days week weeks month months "
         "year years dollar dollars cent cents euro euros percent degree degrees mph kmh kw kwh mb gb tb "
         "heure heures jour jours semaine semaines mois an ans année années seconde secondes mètre mètres litres gramme grammes degré degrés "
         "stunde stunden tag tage tagen woche wochen monat monate monaten jahr jahre jahren minuten sekunde sekunden meile meilen grad prozent "
         "hora horas día días semana semanas mes meses año años minuto minutos segundo segundos metro metros milla millas litro litros "
         "gramo gramos kilo kilos grado grados dólar dólares céntimo céntimos euros").split()

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ".!?:;\n"]] = True
LITERAL, NUMBER, UNIT, NAME = range(4)
_SLOT_HASH = K.mix(np.arange(1, 5, dtype=K.U64) * K.U64(0x632BE59BD9B4E019))


def _lowered(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes with A-Z and U+00C0..U+00DE in lower case, whether each byte begins a capital)."""
    low = K.LOWER[data]
    capital = (data >= 65) & (data <= 90)
    if len(data) > 1:
        two = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97))
        low[two + 1] += 0x20
        capital[two] = True
    return low, capital


def _unit_hashes() -> np.ndarray:
    data, offsets = K.as_bytes(pa.array([" ".join(UNITS)]))
    starts, ends, _ = K.word_spans(data, offsets)
    return np.sort(K.hash_words(data, starts, ends))


_UNIT_HASHES = _unit_hashes()


def template_tokens(data: np.ndarray, offsets: np.ndarray):
    """(template hash, value hash, kind, first) of all tokens; tokens first[i]:first[i+1] are text i's.

    A token is a run of letters and digits; a point or comma between digits belongs to the number.
    """
    digit = _DIGIT[data]
    inside = _LETTER[data] | digit
    if len(data) > 2:
        mark = np.flatnonzero(((data[1:-1] == 46) | (data[1:-1] == 44)) & digit[:-2] & digit[2:]) + 1
        inside[mark] = True
    starts, ends = K.runs(inside, offsets)
    first = np.searchsorted(starts, offsets)
    low, capital = _lowered(data)
    value = K.hash_words(low, starts, ends)
    n = len(starts)
    kind = np.zeros(n, dtype=np.int8)
    if not n:
        return value, value, kind, first
    digits = np.r_[0, np.cumsum(digit)]
    kind[digits[ends] > digits[starts]] = NUMBER
    previous = np.r_[0, ends[:-1]]
    opens = np.zeros(n, dtype=bool)
    opens[first[:-1][np.diff(first) > 0]] = True
    unit = np.r_[False, kind[:-1] == NUMBER] & ~opens & (kind == LITERAL)
    at = np.searchsorted(_UNIT_HASHES, value)
    kind[unit & (_UNIT_HASHES[np.minimum(at, len(_UNIT_HASHES) - 1)] == value)] = UNIT
    stops = np.r_[0, np.cumsum(_STOP[data])]
    opens |= stops[starts] > stops[previous]
    capitals = np.r_[0, np.cumsum(capital)]
    # One capital, at the start, of a word that doesn't open a sentence; words all in capitals are no names.
    kind[(kind == LITERAL) & ~opens & capital[starts] & (capitals[ends] - capitals[starts] == 1) & (ends - starts > 1)] = NAME
    template = np.where(kind == LITERAL, value, _SLOT_HASH[kind])
    return template, value, kind, first


_LEAD = K.U64(0xD6E8FEB86659FD93)
_VERBATIM = K.U64(0xA0761D6478BD642F)


def template_windows(texts: pa.Array, widths, open_too: bool):
    """Yields (first row, owner, position, width, key, slots, verbatim) of the windows with enough plain words, then of verbatim ones.

    slots lists the values of each window's placeholders.  With `open_too`, a
    window that begins with a name is also given with that word as a plain
    one: a passage's first word has a capital wherever the passage stands.
    Verbatim windows have the key of their values and no slots: with
    `open_too` all windows, else those with too few plain words and each
    text's first, whose first token may be of another kind inside a document.
    """
    for lo, hi in K.blocks(K.sizes_of(texts)):
        data, offsets = K.as_bytes(texts.slice(lo, hi - lo))
        template, value, kind, first = template_tokens(data, offsets)
        literal = np.r_[0, np.cumsum(kind == LITERAL)]
        for width in widths:
            at, owner = K.windows_of(first, width)
            if not len(at):
                continue
            rest = K.window_hashes(template, width - 1)[at + 1]
            plain = literal[at + width] - literal[at]
            for opened in (False, True) if open_too else (False,):
                chosen = (plain + opened >= min(MIN_LITERALS, width)) & ((kind[at] == NAME) | (not opened))
                own = at[chosen]
                key = K.mix((value if opened else template)[own] * _LEAD + rest[chosen])
                yield lo, owner[chosen], own - first[:-1][owner[chosen]], width, key, _Slots(own, width, value, kind, opened), False
            chosen = np.full(len(at), open_too) | (plain < min(MIN_LITERALS, width)) | (at == first[:-1][owner])
            own = at[chosen]
            key = K.mix(K.window_hashes(value, width)[own] ^ _VERBATIM)
            yield lo, owner[chosen], own - first[:-1][owner[chosen]], width, key, _NoSlots(own), True


class _Slots:
    """The slot values of windows, made for those that are wanted."""

    def __init__(self, at, width, value, kind, opened):
        self.at, self.width, self.value, self.kind, self.opened = at, width, value, kind, opened

    def array(self, wanted=slice(None)) -> pa.ListArray:
        at = self.at[wanted]
        cells = at[:, None] + np.arange(self.width)
        is_slot = self.kind[cells] != LITERAL
        if self.opened:
            is_slot[:, 0] = False
        return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(is_slot.sum(axis=1))], pa.int32()),
                                        pa.array(self.value[cells[is_slot]].view(np.int64), pa.int64()))


class _NoSlots:
    """Verbatim windows: nothing is left open."""

    def __init__(self, at):
        self.at = at

    def array(self, wanted=slice(None)) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(np.zeros(len(self.at[wanted]) + 1), pa.int32()), pa.array([], pa.int64()))


def _item_rows(batches):
    """Task: (key, item, at, slots, windows, width, verbatim) of each item's windows; an item shorter than WIDTH is one window."""
    for batch in batches:
        for lo, hi in K.blocks(K.sizes_of(batch.column(1))):
            part = batch.slice(lo, hi - lo)
            data, offsets = K.as_bytes(part.column(1))
            lengths = np.diff(template_tokens(data, offsets)[3])
            for width in sorted({min(int(n), WIDTH) for n in lengths if n >= MIN_TOKENS}):
                own = np.flatnonzero((lengths == width) if width < WIDTH else (lengths >= WIDTH))
                chosen = part.take(pa.array(own))
                total = lengths[own] - width + 1
                for low, owner, pos, _, key, slots, verbatim in template_windows(chosen.column(1), [width], False):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), chosen.column(0).take(pa.array(low + owner)), pa.array(pos, pa.int64()),
                         slots.array(), pa.array(total[low + owner], pa.int64()),
                         pa.array(np.full(len(pos), width), pa.int32()), pa.array(np.full(len(pos), verbatim))],
                        ["key", "item", "item_at", "item_slots", "windows", "width", "verbatim"])


def _document_rows(widths, bitmap):
    """Task: (id, key, at, slots) of the documents' windows that the bitmap marks."""

    def run(batches):
        marks = np.unpackbits(bitmap.value, bitorder="little").view(bool)
        bits = K.U64(len(marks))
        for batch in batches:
            for lo, owner, pos, _, key, slots, _ in template_windows(batch.column(1), widths, True):
                hit = marks[(key % bits).astype(np.int64)]
                if hit.any():
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(lo + owner[hit])), pa.array(key[hit].view(np.int64)),
                         pa.array(pos[hit], pa.int64()), slots.array(hit)], ["id", "key", "at", "slots"])

    return run


def _bitmap(items: DataFrame) -> np.ndarray:
    """Packed bits of the items' keys, made in Spark: at most BITMAP_BITS / 32 words reach the driver."""
    # BITMAP_BITS is a power of two: pmod of the signed key is the unsigned remainder.
    words = items.select(F.pmod("key", F.lit(BITMAP_BITS)).alias("bit")).groupBy(F.expr("bit div 32").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(bit % 32 AS int)))").alias("bits")).collect()
    out = np.zeros(BITMAP_BITS // 32, dtype="<u4")
    for r in words:
        out[r["word"]] = r["bits"]
    return out.view(np.uint8)


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", min_share: float = MIN_SHARE) -> DataFrame:
    """(id, item, matched_windows, item_windows, share, reparameterised) of each document that holds enough of an item.

    share is the part of the item's windows found in alignments with consistent slots;
    windows with too few plain words are found verbatim only, and counted
    where the others don't reach the share.  reparameterised says that some
    slot has another value than the item's.
    Null or empty texts hold nothing; rows with a null id, or items with a
    null id, are passed over; rows that repeat an id count as one document;
    items of fewer than MIN_TOKENS tokens never match.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    sources = benchmark.where(F.col(item_col).isNotNull()).select(F.col(item_col).cast("long").alias("i"), F.col(item_text_col).alias("t"))
    items = written(sources.mapInArrow(
        _item_rows, "key long, item long, item_at long, item_slots array<long>, windows long, width int, verbatim boolean"), "items")
    widths = sorted(r["width"] for r in items.select("width").distinct().collect())
    bitmap = spark.sparkContext.broadcast(_bitmap(items))
    narrow = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    windows = narrow.mapInArrow(_document_rows(widths, bitmap), "id long, key long, at long, slots array<long>")
    met = windows.join(items.drop("width"), "key").where(F.size("slots") == F.size("item_slots"))
    # One alignment: the same distance between the places in the document and in the item.
    here = ["id", "item", "shift"]
    met = written(met.withColumn("shift", F.col("at") - F.col("item_at")), "met")
    template_at = F.when(~F.col("verbatim"), F.col("item_at"))
    alignments = met.groupBy(*here).agg(F.count_distinct(template_at).alias("n"))
    pairs = met.select(*here, F.explode(F.arrays_zip("item_slots", "slots")).alias("p")).groupBy(
        *here, F.col("p.item_slots").alias("slot")).agg(F.min("p.slots").alias("value"), F.max("p.slots").alias("most"))
    torn = pairs.where("value <> most").select(*here).distinct()
    pairs = written(pairs.join(torn, here, "left_anti").join(alignments, here), "pairs")
    said = pairs.groupBy("id", "item", "slot").agg(F.max_by("value", F.struct("n", -F.col("shift"))).alias("said"))
    against = pairs.join(said, ["id", "item", "slot"]).groupBy(*here).agg(
        F.max(F.col("value") != F.col("said")).alias("against"), F.max(F.col("slot") != F.col("value")).alias("other"))
    counted = (alignments.join(torn, here, "left_anti").join(against, here, "left").where(~F.coalesce("against", F.lit(False)))
               .select(*here, "n", F.coalesce("other", F.lit(False)).alias("other")))
    found = met.join(counted, here).groupBy("id", "item").agg(
        F.max("windows").alias("item_windows"), F.count_distinct(template_at).alias("by_template"), F.count_distinct("item_at").alias("by_any"),
        F.min(F.when(F.col("n") > 0, F.col("other"))).alias("template_other"), F.min("other").alias("any_other"))
    # Templates alone, where they are enough; else with the verbatim windows.
    enough = F.col("by_template") / F.col("item_windows") >= min_share
    found = found.withColumn("matched_windows", F.when(enough, F.col("by_template")).otherwise(F.col("by_any"))).withColumn(
        "reparameterised", F.when(enough, F.col("template_other")).otherwise(F.col("any_other")))
    found = found.withColumn("share", F.col("matched_windows") / F.col("item_windows")).where(F.col("share") >= min_share)
    return found.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "matched_windows", "item_windows",
                        "share", "reparameterised")


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of `docs` that hold no benchmark item, all columns unchanged; rows with a null id stay."""
    leaks = find_leaks(docs.select(id_col, text_col), benchmark, id_col, text_col, **options).select(id_col).distinct()
    return docs.join(leaks, id_col, "left_anti")
