"""Token counts of texts under a byte-level BPE vocabulary, with a whole-token shortcut.

The driver proves once, for every string of the vocabulary, whether the merge
rules turn it back into that one token.  A pre-token among the proven strings
counts 1 without any merging; only the others are merged, and each worker
remembers the counts of what stands between two spaces.
"""

from __future__ import annotations

import json
from collections import Counter

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lendlens.llm.common import small_batches

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024
#: Fixed value: the pattern of byte-level pre-tokens, \s written as the White_Space property that the library matches.
PRE_TOKEN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
             r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
#: Counts that a worker remembers, and characters split at a time.
REMEMBERED = 300_000
CHUNK_CHARS = 1 << 20


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in the vocabulary: printable Latin-1 itself, the rest from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + k) for k, b in enumerate(hidden)}


class Counting:
    """Counts tokens of texts; `vocabulary` is the JSON text of a byte-level BPE file."""

    def __init__(self, vocabulary: str, whole: frozenset[str] | None = None):
        spec = json.loads(vocabulary)
        pre = spec.get("pre_tokenizer") or {}
        if spec["model"]["type"] != "BPE" or pre.get("type") != "ByteLevel" or not pre.get("use_regex", True) \
                or pre.get("add_prefix_space") or spec.get("normalizer"):
            raise ValueError("only byte-level BPE without normaliser or prefix space is counted here")
        self.model = Tokenizer.from_str(vocabulary).model
        self.letters = byte_letters()
        self.special = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        self.split = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.pieces = regex.compile(PRE_TOKEN)
        self.whole = self.prove(spec["model"]["vocab"]) if whole is None else whole
        self.known: dict[str, int] = {}

    def merged(self, pre_token: str) -> int:
        return len(self.model.tokenize("".join(map(self.letters.__getitem__, pre_token.encode()))))

    def prove(self, vocab: dict[str, int]) -> frozenset[str]:
        """The texts of the vocabulary strings that the merges turn into exactly that token."""
        back = {letter: byte for byte, letter in self.letters.items()}
        out = set()
        for token, number in vocab.items():
            if all(c in back for c in token):
                alone = self.model.tokenize(token)
                if len(alone) == 1 and alone[0].id == number:
                    try:
                        out.add(bytes(back[c] for c in token).decode())
                    except UnicodeDecodeError:
                        pass  # part of a character: no pre-token is such a string
        return frozenset(out)

    def _pieces(self, text: str, total: int = 0) -> int:
        """Tokens of a text by its pre-tokens: 1 for each proven string, the merged count for the others."""
        for piece in self.pieces.findall(text):
            total += 1 if piece in self.whole else self.merged(piece)
        return total

    def _spaced(self, text: str) -> int:
        """Tokens of a text of ordinary characters.

        Before a space that a visible character follows, a pre-token always
        ends; the stretches between such spaces repeat, so each distinct one
        is split and merged once.  Other spacing is split as a whole.
        """
        first, *rest = text.split(" ")
        stretches = Counter(rest)
        if any(not s or s[0].isspace() for s in stretches):
            return self._pieces(text)
        total = self._pieces(first)
        for stretch, n in stretches.items():
            tokens = self.known.get(stretch)
            if tokens is None:
                spaced = " " + stretch
                tokens = 1 if spaced in self.whole else self._pieces(spaced)
                if "\n" not in stretch:  # those seldom come again
                    if len(self.known) >= REMEMBERED:
                        self.known.clear()
                    self.known[stretch] = tokens
            total += n * tokens
        return total

    @staticmethod
    def _cuts(text: str):
        """The text in parts of about CHUNK_CHARS, each cut before a space between visible characters."""
        at = 0
        while len(text) - at > CHUNK_CHARS:
            cut = text.find(" ", at + CHUNK_CHARS)
            while cut > 0 and (text[cut - 1].isspace() or text[cut + 1:cut + 2].isspace() or cut + 1 == len(text)):
                cut = text.find(" ", cut + 1)
            if cut < 0:
                break
            yield text[at:cut]
            at = cut
        yield text[at:] if at else text

    def count(self, text: str) -> int:
        total = 0
        parts = [text]
        if self.split is not None and any(s in text for s in self.special):
            parts = self.split.split(text)
            total = len(parts) - 1
        for part in parts:
            total += sum(map(self._spaced, self._cuts(part)))
        return total


_COUNTING: dict[int, Counting] = {}


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = LIMIT) -> DataFrame:
    """All columns of `docs` plus n_bytes, n_tokens and over_limit (n_tokens > limit); vocabulary: a file's path.

    Counts are those of the library without begin or end tokens; an added
    token's string inside a text counts as that token, as is its default.
    Null text counts as empty (0 tokens); columns of `docs` that are named
    like the new ones are replaced; an empty table gives an empty result.
    """
    spark: SparkSession = docs.sparkSession
    small_batches(spark)
    with open(vocabulary, encoding="utf-8") as f:
        text = f.read()
    # Bounded by the vocabulary file.
    shared = spark.sparkContext.broadcast((text, Counting(text).whole))
    key = hash(text)
    docs = docs.drop(*({"n_bytes", "n_tokens", "over_limit"} - {id_col, text_col}))
    place = docs.columns.index(text_col)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    names = docs.columns

    def run(batches):
        if key not in _COUNTING:
            _COUNTING[key] = Counting(*shared.value)
        counting = _COUNTING[key]
        for batch in batches:
            counts = [counting.count(t) if t else 0 for t in (x.as_py() for x in batch.column(place))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts, pa.int64())], [*names, "n_tokens"])

    out = docs.mapInArrow(run, f"{fields}, n_tokens long")
    size = F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long")
    return out.withColumn("n_bytes", size).withColumn("over_limit", F.col("n_tokens") > limit)
