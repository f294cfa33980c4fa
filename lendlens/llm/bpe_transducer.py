"""BPE encoding as a bounded-lookahead streaming transducer, and incremental decoding.

The merge list alone tells how far ahead a token can depend on what follows.
Let two words agree on their first N symbols.  While the merges run in order,
the agreeing tokens end at a boundary D, at first N.  Merge r = (u, v) moves D
left, by the length of u, only if u ends at D and v starts there in one of the
words only.  A later merge r2 can move D again only if its right part starts
there, so that u stands on the left edge of that part's derivation, with the
merge above u not before r.  The longest such chain, summed over the lengths of
its left parts, is the sufficient lookahead: a token that ends that many
symbols before the end of what has been read is final.

So the encoder holds one short buffer of symbols for a word of any length,
merges it, emits the tokens that are final and keeps the rest.  The decoder
feeds the bytes of one token after the other to a UTF-8 state machine, which
gives text as soon as a character is complete.
"""

from __future__ import annotations

import codecs
import json
import re
import sys
import unicodedata
from array import array
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lendlens.llm.common import BLANK, WORD, small_batches
from lendlens.llm.token_counts import byte_letters

VOCABULARY = "word_bpe_49k.json"
#: Fixed value: the pattern of the vocabulary's pre-tokens.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Stretches of printable ASCII and Latin letters up to U+017F are their own normal form (but for case, and the dotted I);
#: what the pattern finds in them, lower-cased.
LATIN = r"[!-~À-ÖØ-öø-įı-ſ]+"
LATIN_PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ſ]+|[0-9]|[^a-z0-9ß-öø-ſ]+"
#: Symbols that the encoder reads between two merges of its buffer.
STEP = 128
#: Characters of an unspaced stretch that are normalised and split at a time.
PART_CHARS = 4096
#: Characters whose stretches are looked up together; stretches and pre-tokens (up to so many characters) whose ids a
#: worker remembers, twice as many while an older set is being replaced.
SPAN_CHARS = 1 << 16
REMEMBERED, REMEMBERED_CHARS = 200_000, 48


def lookahead(merges: list[tuple[str, str]], suffix: str = "") -> int:
    """Symbols after a token's end that settle it, for any continuation; see the module's text.

    The proof needs merges in which every token is made by one merge, after
    the merges that make its parts; other lists are refused.
    """
    made = {a + b: k for k, (a, b) in enumerate(merges)}
    if len(made) < len(merges) or any(made.get(part, -1) >= k for k, m in enumerate(merges) for part in m):
        raise ValueError("the merge list makes a token twice or before its parts")
    # For each left part: its merges in order, and the longest chain that ends with one of them or an earlier one.
    chains: dict[str, tuple[list[int], list[int]]] = {}
    longest = 0
    for k, (u, v) in enumerate(merges):
        before, edge, bound = 0, v, k
        while True:  # down the left edge of v's derivation
            at, most = chains.get(edge, ((), ()))
            n = bisect_left(at, bound)
            before = max(before, most[n - 1] if n else 0)
            if edge not in made:
                break
            bound = min(k, made[edge] + 1)
            edge = merges[made[edge]][0]
        size = before + len(u.removesuffix(suffix) if suffix else u)
        at, most = chains.setdefault(u, ([], []))
        at.append(k)
        most.append(max(size, most[-1] if most else 0))
        longest = max(longest, size)
    return longest


class Remembered:
    """A bounded memory of results: when the new set is full it becomes the older one, from which what is used again returns."""

    def __init__(self):
        self.new: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}

    def keep(self, key: str, value: tuple[int, ...]) -> tuple[int, ...]:
        if len(self.new) >= REMEMBERED:
            self.old, self.new = self.new, {}
        self.new[key] = value
        return value

    def older(self, key: str) -> tuple[int, ...] | None:
        value = self.old.get(key)
        return None if value is None else self.keep(key, value)


class Encoder:
    """Encodes texts under a vocabulary whose words end in a suffix and whose white space is dropped.

    `vocabulary` is the JSON text of the tokenizer's file; `ahead` its lookahead, if known.
    """

    def __init__(self, vocabulary: str, ahead: int | None = None):
        spec = json.loads(vocabulary)
        model, steps = spec["model"], (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        last = steps[-1]
        if model["type"] != "BPE" or model.get("dropout") or model.get("byte_fallback") or model.get("ignore_merges") \
                or model.get("continuing_subword_prefix") or spec.get("post_processor") or [s.get("type") for s in steps] != ["Split", "ByteLevel"] \
                or not steps[0].get("invert") or steps[0].get("behavior") != "Removed" or last.get("use_regex") or last.get("add_prefix_space") \
                or [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])] != ["NFC", "Replace", "Lowercase"] \
                or any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec.get("added_tokens", [])):
            raise ValueError("only byte-level BPE over NFC lower-cased words without white space is encoded here")
        self.suffix = model.get("end_of_word_suffix") or ""
        self.learn([tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]], model["vocab"], ahead)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.special_split = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") \
            if self.special else None
        whole = Tokenizer.from_str(vocabulary)
        self.normalise, self.split = whole.normalizer.normalize_str, whole.pre_tokenizer.pre_tokenize_str
        self.word, self.gap = re.compile(WORD), re.compile(BLANK)
        self.latin = re.compile(LATIN) if steps[0].get("pattern", {}).get("Regex") == PRE_TOKEN else None
        self.latin_pieces, self.letters = re.compile(LATIN_PRE_TOKEN), byte_letters()
        self.stretches, self.pieces = Remembered(), Remembered()

    def learn(self, merges: list[tuple[str, str]], vocab: dict[str, int], ahead: int | None = None) -> None:
        """Tables of the merges by numbers of tokens: a pair's rank, the token that each merge makes, and sizes in symbols."""
        self.ahead = lookahead(merges, self.suffix) if ahead is None else ahead
        self.vocab, self.none = vocab, len(merges)
        self.rank = {vocab[a] << 32 | vocab[b]: k for k, (a, b) in enumerate(merges)}
        self.made = [vocab[a + b] for a, b in merges]
        self.size = {i: len(t.removesuffix(self.suffix) if self.suffix else t) for t, i in vocab.items()}
        self.held: list[int] = []  # symbols of the open word that are not part of an emitted token
        self.last = ""
        self.most_held = 0

    def merge(self, symbols: list[int]) -> list[int]:
        """The tokens of a word's symbols: the merge of lowest rank first, the leftmost of equal ones."""
        parts, rank, none, made = list(symbols), self.rank.get, self.none, self.made
        ranks = [rank(a << 32 | b, none) for a, b in zip(parts, parts[1:])]
        while ranks and (least := min(ranks)) < none:
            i = ranks.index(least)
            parts[i] = made[least]
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank(parts[i] << 32 | parts[i + 1], none)
            if i:
                ranks[i - 1] = rank(parts[i - 1] << 32 | parts[i], none)
        return parts

    def feed(self, symbols: str) -> list[int]:
        """Reads symbols of the open word; the ids of the tokens that no continuation can change."""
        out: list[int] = []
        for lo in range(0, len(symbols), STEP):
            part = symbols[lo:lo + STEP]
            # The last symbol is held back: it may turn out to end the word, which makes it another symbol.
            self.held += [self.vocab[c] for c in self.last + part[:-1]]
            self.last = part[-1]
            self.most_held = max(self.most_held, len(self.held) + 1)
            certain = len(self.held)
            if certain <= self.ahead:
                continue
            done = 0
            for token in self.merge(self.held):
                if done + self.size[token] > certain - self.ahead:
                    break
                done += self.size[token]
                out.append(token)
            del self.held[:done]
        return out

    def finish(self) -> list[int]:
        """Ends the open word; the ids that were still held."""
        if not self.last:
            return []
        symbols = [*self.held, self.vocab[self.last + self.suffix]]
        self.held, self.last = [], ""
        return self.merge(symbols)

    def _stretch(self, text: str) -> Iterable[int]:
        """Ids of a text without ASCII white space."""
        for part, runs_on in _parts(text):
            pieces = self.split(self.normalise(part))
            for k, (symbols, _) in enumerate(pieces):
                yield from self.feed(symbols)
                if k < len(pieces) - 1 or not runs_on:
                    yield from self.finish()
        yield from self.finish()

    def _short(self, stretch: str) -> tuple[int, ...]:
        """Ids of a stretch that fits into one part, by its pre-tokens."""
        ids = self.stretches.older(stretch)
        if ids is not None:
            return ids
        if self.latin and self.latin.fullmatch(stretch):
            pieces = self.latin_pieces.findall(stretch.lower())
            if not stretch.isascii():  # an ASCII character is its own symbol
                pieces = [p.encode().decode("latin-1").translate(self.letters) for p in pieces]
        else:
            pieces = [symbols for symbols, _ in self.split(self.normalise(stretch))]
        out = ()
        for symbols in pieces:
            ids = self.pieces.new.get(symbols)
            if ids is None and (ids := self.pieces.older(symbols)) is None:
                ids = self.pieces.keep(symbols, (*self.feed(symbols), *self.finish()))
            out += ids
        return self.stretches.keep(stretch, out)

    def _spans(self, text: str) -> Iterator[str]:
        """The text in parts of about SPAN_CHARS, cut at white space."""
        at = 0
        while len(text) - at > SPAN_CHARS and (cut := self.gap.search(text, at + SPAN_CHARS)):
            yield text[at:cut.start()]
            at = cut.end()
        yield text[at:] if at else text

    def encode(self, text: str) -> Iterator[Iterable[int]]:
        """The ids of a text, part by part."""
        for piece in self.special_split.split(text) if self.special_split else [text]:
            if piece in self.special:
                yield (self.special[piece],)
                continue
            for span in self._spans(piece):
                words = self.word.findall(span)
                found = map(self.stretches.new.get, words)
                yield chain.from_iterable([ids if ids is not None else self._ids(word) for word, ids in zip(words, found)])

    def _ids(self, stretch: str) -> Iterable[int]:
        return self._short(stretch) if len(stretch) <= REMEMBERED_CHARS else list(self._stretch(stretch))


_COMPOSING: set[str] = set()


def _composing() -> set[str]:
    """Characters that may compose with the one before them: second parts of canonical pairs, and Hangul's vowels and finals."""
    if not _COMPOSING:
        for c in map(chr, range(sys.maxunicode + 1)):
            pair = unicodedata.decomposition(c)
            if pair and pair[0] != "<" and " " in pair:
                _COMPOSING.add(chr(int(pair.split(" ")[1], 16)))
        _COMPOSING.update(map(chr, range(0x1160, 0x1200)))
    return _COMPOSING


_LETTER, _MARK = regex.compile(r"\p{L}"), regex.compile(r"[^\s\p{L}\p{N}']")


def _runs_on(text: str, at: int) -> bool:
    """True if a cut before character `at` parts one pre-token in two and changes nothing else.

    That is so between characters of one kind, letters (with two more before, so that no contraction is cut) or marks,
    unless normalisation joins the two or (capital dotted I) puts a mark after the first.
    """
    a, b = text[at - 1], text[at]
    if unicodedata.combining(b) or unicodedata.combining(a) or b in _composing() or a == "İ":
        return False
    letters = at >= 3 and all(_LETTER.match(c) for c in text[at - 3:at + 1]) and "İ" not in text[at - 3:at]
    return bool(letters or _MARK.match(a) and _MARK.match(b))


def _parts(text: str) -> Iterator[tuple[str, bool]]:
    """(part, whether its last pre-token runs on into the next part)."""
    at = 0
    while len(text) - at > PART_CHARS:
        cut = at + PART_CHARS
        while cut < len(text) and not _runs_on(text, cut):
            cut += 1
        if cut == len(text):
            break
        yield text[at:cut], True
        at = cut
    yield text[at:], False


class Decoder:
    """Turns ids into text, incrementally.

    `style` "library" gives the library's text for a file without decoder: the
    token strings with a space between two.  "text" gives the bytes that the
    tokens stand for, with a space after each word.  Bytes that are no UTF-8
    become U+FFFD; an id outside the vocabulary is left out, as in the library.
    """

    def __init__(self, vocabulary: str, style: str = "library"):
        spec = json.loads(vocabulary)
        if spec.get("decoder") is not None or style not in ("library", "text"):
            raise ValueError("only files without decoder, in style library or text, are decoded here")
        suffix, back = spec["model"].get("end_of_word_suffix") or "", {c: b for b, c in byte_letters().items()}
        self.between = b" " if style == "library" else b""
        self.pieces = {}
        for token, number in spec["model"]["vocab"].items():
            ends = bool(suffix) and token.endswith(suffix)
            self.pieces[number] = token.encode() if style == "library" else \
                bytes(back[c] for c in (token[:-len(suffix)] if ends else token)) + b" " * ends
        for t in spec.get("added_tokens", []):
            self.pieces[t["id"]] = t["content"].encode()
        self.start()

    def start(self) -> None:
        self.machine, self.begun = codecs.getincrementaldecoder("utf-8")("replace"), False

    def feed(self, ids: Iterable[int]) -> str:
        """The text that is complete after these ids."""
        found = list(map(self.pieces.get, ids))
        if None in found:
            found = [p for p in found if p is not None]
        found = self.between.join(found)
        if self.begun and found:
            found = self.between + found
        self.begun = self.begun or bool(found)
        return self.machine.decode(found)

    def finish(self) -> str:
        rest = self.machine.decode(b"", True)
        self.start()
        return rest


_MADE: dict[tuple, object] = {}


def _once(key: tuple, make):
    """An encoder or decoder of this worker, made at its first use."""
    if key not in _MADE:
        _MADE[key] = make()
    return _MADE[key]


def _read(vocabulary: str) -> str:
    with open(vocabulary, encoding="utf-8") as f:
        return f.read()


def encode_texts(docs: DataFrame, vocabulary: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """All columns of `docs` (but the text, which `ids_col` replaces) and the ids of each whole text.

    vocabulary: a file's path.  Ids are those of the library without begin or
    end tokens, truncation or padding; an added token's string inside a text
    gives that token.  Null and empty texts give no ids; an empty table gives
    an empty result; a column of `docs` named like `ids_col` is replaced.
    """
    small_batches(docs.sparkSession)
    text = _read(vocabulary)
    # Bounded by the vocabulary file.
    shared = docs.sparkSession.sparkContext.broadcast((text, Encoder(text).ahead))
    key = ("encoder", hash(text))
    names = [c for c in docs.columns if c not in (text_col, ids_col)]
    narrow = docs.select(*names, F.col(text_col).alias("__text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[:-1]]

    def run(batches):
        encoder = _once(key, lambda: Encoder(*shared.value))
        for batch in batches:
            found, ends = array("i"), array("i", [0])
            for t in batch.column(len(names)):
                for ids in encoder.encode(t.as_py() or ""):
                    found.extend(ids)
                ends.append(len(found))
            column = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(found, pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], column], [*names, ids_col])

    return narrow.mapInArrow(run, ", ".join([*fields, f"`{ids_col}` array<int>"]))


def decode_ids(rows: DataFrame, vocabulary: str, ids_col: str = "ids", decoded_col: str = "decoded", style: str = "library") -> DataFrame:
    """All columns of `rows` plus the text of `ids_col`, an array<int>; null ids give the empty text.

    Styles are those of `Decoder`.  An empty table gives an empty result; a
    column of `rows` named like `decoded_col` is replaced.
    """
    small_batches(rows.sparkSession)
    text = _read(vocabulary)
    shared = rows.sparkSession.sparkContext.broadcast(text)
    key = ("decoder", style, hash(text))
    rows = rows.drop(*({decoded_col} - {ids_col}))
    names, at = rows.columns, rows.columns.index(ids_col)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)

    def run(batches):
        decoder = _once(key, lambda: Decoder(shared.value, style))
        for batch in batches:
            column = batch.column(at)
            ids = pc.fill_null(column.flatten(), -1).to_numpy(zero_copy_only=False).tolist()
            ends = np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)).tolist()
            texts = [decoder.feed(ids[lo:hi]) + decoder.finish() for lo, hi in zip([0, *ends], ends)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*names, decoded_col])

    return rows.mapInArrow(run, f"{fields}, `{decoded_col}` string")
