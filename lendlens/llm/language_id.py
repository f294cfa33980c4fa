"""Language identification by compression.

Training collects texts of each language, chosen by a hash of their id and reduced
to lower-cased words, as a raw-content zstandard dictionary of at most `DICTIONARY_BYTES`.  A text
goes to the language whose dictionary compresses it to the fewest bytes; the
score comes from the margin to the second best, and narrow margins are marked
as rejected.
"""

from __future__ import annotations

import math

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendlens.llm.common import small_batches, train_row

#: The bounded training sample: documents per language offered, and dictionary bytes filled with their whole texts.
SAMPLE_DOCS = 400
DICTIONARY_BYTES = 128 << 10
#: Characters that a text larger than a dictionary lends to it.
SLICE_CHARS = 16 << 10
LEVEL = 3
#: A margin (saved share of the second best size) below this is rejected.
REJECT_MARGIN = 0.01
#: A steepness of the score: 0.5 without any margin, about 0.98 at a margin of 10%.
STEEPNESS = 40.0
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
OTHERS = regex.compile(r"\P{L}+")
#: Text compressed at a time; longer texts add up the sizes of their parts.
PART_CHARS = 1 << 16
#: Below this a text's size in whole bytes is too coarse: its words' own sizes are added.
SHORT_CHARS = 256


def train_dictionaries(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, bytes]:
    """{language: dictionary content} from rows with a language, a text and crc32(id) mod 5 other than 0.

    The ids are chosen first (a narrow top-k by hash per language), then their
    texts are fetched, each distinct text once; a text larger than a whole
    dictionary gives a slice of SLICE_CHARS characters at a hashed place.  They
    enter in order of the hash, passing over what doesn't fit any more.
    """
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}") & train_row(id_col))
    order = Window.partitionBy("lang").orderBy("h", "id")
    ids = (known.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.xxhash64(id_col).alias("h"))
           .withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= SAMPLE_DOCS).select("id", "lang", "h"))
    # At most SAMPLE_DOCS ids per language.
    texts = known.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(ids), "id")
    place = F.pmod(F.xxhash64("text"), F.greatest(F.length("text") - SLICE_CHARS, F.lit(1))) + 1
    piece = F.when(F.octet_length("text") > DICTIONARY_BYTES, F.substr("text", place.cast("int"), F.lit(SLICE_CHARS))).otherwise(F.col("text"))
    texts = texts.select("lang", "h", "id", piece.alias("text")).groupBy("lang", "text").agg(F.min(F.struct("h", "id")).alias("o")).select("lang", "o.*", "text")
    # The driver gets a few times the bytes of a dictionary per language: what may fit, and what is passed over.
    before = Window.partitionBy("lang").orderBy("h", "id", "text").rowsBetween(Window.unboundedPreceding, -1)
    texts = texts.withColumn("before", F.coalesce(F.sum(F.octet_length("text")).over(before), F.lit(0))).where(F.col("before") <= 4 * DICTIONARY_BYTES)
    chosen: dict[str, list[bytes]] = {}
    full: dict[str, int] = {}
    for row in sorted(texts.select("lang", "h", "id", "text").collect(), key=lambda r: (r["h"], r["id"] is None, r["id"] or 0, r["text"])):
        raw, taken = letters_of(row["text"]).encode(), chosen.setdefault(row["lang"], [])
        if raw not in taken and full.get(row["lang"], 0) + len(raw) + 1 <= DICTIONARY_BYTES:
            taken.append(raw)
            full[row["lang"]] = full.get(row["lang"], 0) + len(raw) + 1
    # zstandard needs 8 bytes of dictionary at least.
    return {lang: b"\n".join(reversed(parts)).ljust(8) for lang, parts in sorted(chosen.items())}


def letters_of(text: str) -> str:
    """What is compressed: the lower-cased words, every run of other characters as one space."""
    return OTHERS.sub(" ", text.lower())


class Classifier:
    """Languages by compressed size; ties go to the first language by code point."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.compressors = []
        for lang, content in sorted(dictionaries.items()):
            raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(level=LEVEL)
            self.compressors.append((lang, zstandard.ZstdCompressor(
                level=LEVEL, dict_data=raw, write_checksum=False, write_content_size=False, write_dict_id=False)))

    def __call__(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, rejected)."""
        if not text or not LETTER.search(text):
            return UNKNOWN, 0.0, True
        text = letters_of(text)
        parts = [text[k:k + PART_CHARS].encode() for k in range(0, len(text), PART_CHARS)]
        if len(text) < SHORT_CHARS:
            parts += [f" {word} ".encode() for word in text.split()]
        sizes = sorted((sum(len(c.compress(p)) for p in parts), lang) for lang, c in self.compressors)
        if not sizes:
            return UNKNOWN, 0.0, True
        if len(sizes) == 1:
            return sizes[0][1], 1.0, False
        margin = (sizes[1][0] - sizes[0][0]) / sizes[1][0]
        return sizes[0][1], 1 / (1 + math.exp(-STEEPNESS * margin)), margin < REJECT_MARGIN


def identify(docs: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text") -> DataFrame:
    """All columns of `docs` plus lang_pred, score and rejected.

    A null text, or one without a letter, is `und` with score 0; without any
    dictionary all are.  Columns that are named like the new ones are replaced.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop(*({"lang_pred", "score", "rejected"} - {text_col}))
    names, place = docs.columns, docs.columns.index(text_col)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    # One bounded dictionary for each language.
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def run(batches):
        classify = Classifier(shared.value)
        for batch in batches:
            found = [classify(t.as_py()) for t in batch.column(place)]
            cols = list(zip(*found)) if found else [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cols[0], pa.string()), pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.bool_())],
                [*names, "lang_pred", "score", "rejected"])

    return docs.mapInArrow(run, f"{fields}, lang_pred string, score double, rejected boolean")
