"""Byte-level BPE: encoding by forced boundaries, decoding, and the vocabulary both work on.

A text is cut three times. Special strings come out first, as the tokenizer file says. The pattern
of byte-level BPE then cuts the rest into pre-tokens. Last, a pre-token is cut between two bytes
that no vocabulary token holds side by side: merging only ever makes vocabulary tokens, so no token
can span such a cut, and what lies to its left cannot change what lies to its right. The fragments are
merged one by one and their tokens put together.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers.pre_tokenizers import ByteLevel

from wardline.llm.python_tasks import prepare

# The pattern that splits text into pre-tokens in byte-level BPE.
PRE_TOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Below this lie only characters that all Unicode versions in question agree on.
FIRST_LATER = 0x370
LATER = re.compile(f"[\\u{FIRST_LATER:04x}-\U0010ffff]")

#: Pre-tokens longer than this are not remembered, and no more than so many are.
LONGEST_KEPT = 64
MOST_KEPT = 400_000
#: Fragments longer than this are merged with a heap instead of scanning their pairs again after each merge.
LONGEST_SCANNED = 32


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary file."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    letters, extra = [], 0x100
    for byte in range(256):
        letters.append(chr(byte if byte in plain else extra))
        extra += byte not in plain
    return letters


def newer_letters() -> regex.Pattern | None:
    """Letters and numbers that the pattern engine knows and the tokenizers library does not.

    The two come with different Unicode versions. Only characters that Python's own, older tables leave
    unassigned can differ; each of them is put after a letter and after a digit to see what the library does.
    """
    engine = regex.compile(r"[\p{L}\p{N}]")
    doubtful = [c for c in map(chr, range(FIRST_LATER, 0x110000)) if unicodedata.category(c) == "Cn" and engine.match(c)]
    sample = "".join(f"a{c}\n1{c}\n" for c in doubtful)
    pieces = {sample[a:b] for _, (a, b) in ByteLevel(add_prefix_space=False).pre_tokenize_str(sample)}
    codes = [ord(c) for c in doubtful if f"a{c}" not in pieces and f"1{c}" not in pieces]
    ranges: list[list[int]] = []
    for code in codes:
        if ranges and ranges[-1][1] == code - 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return regex.compile("[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges) + "]") if ranges else None


def early_pattern() -> re.Pattern:
    """The pattern for texts of early characters only, with its classes written out: a simpler engine is faster."""
    ranges: dict[str, str] = {}
    for name, kind in (("letter", r"\p{L}"), ("number", r"\p{N}"), ("blank", r"\s")):
        member = regex.compile(kind)
        ranges[name] = "".join(f"\\u{c:04x}" for c in range(FIRST_LATER) if member.match(chr(c)))
    letter, number, blank = ranges.values()
    return re.compile(
        rf" ?[{letter}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{number}]+| ?[^{blank}{letter}{number}]+|[{blank}]+(?![^{blank}])|[{blank}]+"
    )


class Remembered(dict):
    """Results by pre-token; a new one is worked out once and kept within bounds."""

    def __init__(self, work):
        super().__init__()
        self.work = work

    def __missing__(self, piece: str):
        result = self.work(piece)
        if len(piece) <= LONGEST_KEPT:
            if len(self) >= MOST_KEPT:
                self.clear()
            self[piece] = result
        return result


class ByteBpe:
    """A byte-level BPE vocabulary read from the text of a tokenizer file."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model, before = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or before["type"] != "ByteLevel" or not before["use_regex"] or spec["normalizer"]:
            raise ValueError("a byte-level BPE file without a normalizer is needed")
        letters = byte_letters()
        byte_of = {letter: byte for byte, letter in enumerate(letters)}
        to_bytes = lambda token: bytes(byte_of[c] for c in token)
        self.ids = {to_bytes(token): number for token, number in model["vocab"].items()}
        self.tokens = {number: token for token, number in self.ids.items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = {(to_bytes(a), to_bytes(b)): rank for rank, (a, b) in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("special tokens that reach into their surroundings are not supported")
        self.prefix = before["add_prefix_space"]
        self.tokens |= {number: content.encode() for content, number in self.special.items()}
        joined = {token[i : i + 2] for token in self.ids for i in range(len(token) - 1)}
        #: Byte pairs that some token holds; between any other two bytes a cut is forced.
        self.joined = joined
        self.pattern = regex.compile(PRE_TOKEN)
        self.early = early_pattern()
        self.newer = newer_letters()
        strings = sorted(self.special, key=len, reverse=True)
        self.specials = regex.compile("|".join(map(regex.escape, strings))) if strings else None
        self.pieces = Remembered(self.encode_piece)
        self.table: tuple[np.ndarray, np.ndarray] | None = None

    def pre_tokens(self, text: str) -> list[str]:
        """Pre-tokens of a text without special strings."""
        if self.prefix and text and not text[0].isspace():
            text = " " + text
        if not LATER.search(text):
            return self.early.findall(text)
        if self.newer is not None and self.newer.search(text):
            return self.old_pre_tokens(text)
        return self.pattern.findall(text)

    def old_pre_tokens(self, text: str) -> list[str]:
        """The same with the newer letters as what they were before: neither letter nor number."""
        newer = f"[{self.newer.pattern[1:-1]}]"
        parts = (
            rf"'s|'t|'re|'ve|'m|'ll|'d| ?(?:(?!{newer})\p{{L}})+| ?(?:(?!{newer})\p{{N}})+"
            rf"| ?(?:{newer}|[^\s\p{{L}}\p{{N}}])+|\s+(?!\S)|\s+"
        )
        return regex.findall(parts, text)

    def fragments(self, piece: bytes) -> list[bytes]:
        """A pre-token cut at its forced boundaries."""
        joined, found, begin = self.joined, [], 0
        for at in range(1, len(piece)):
            if piece[at - 1 : at + 1] not in joined:
                found.append(piece[begin:at])
                begin = at
        found.append(piece[begin:])
        return found

    def merge(self, fragment: bytes) -> list[int]:
        """Tokens of one fragment: the best-ranked pair, the leftmost of several, is merged first."""
        if len(fragment) > LONGEST_SCANNED:
            return self.merge_long(fragment)
        rank, none = self.ranks.get, len(self.ranks)
        parts = [fragment[i : i + 1] for i in range(len(fragment))]
        ranks = [rank(pair, none) for pair in zip(parts, parts[1:])]
        while ranks and (best := min(ranks)) != none:
            at = ranks.index(best)
            parts[at] = joined = parts[at] + parts.pop(at + 1)
            del ranks[at]
            if at < len(ranks):
                ranks[at] = rank((joined, parts[at + 1]), none)
            if at:
                ranks[at - 1] = rank((parts[at - 1], joined), none)
        return [self.ids[p] for p in parts]

    def merge_long(self, fragment: bytes) -> list[int]:
        """The same for a fragment of any length, in n log n steps."""
        ranks = self.ranks
        parts: list[bytes | None] = [fragment[i : i + 1] for i in range(len(fragment))]
        after, before = [*range(1, len(parts)), -1], [*range(-1, len(parts) - 1)]
        waiting: list[tuple] = []

        def offer(left: int, right: int) -> None:
            rank = ranks.get((parts[left], parts[right]))
            if rank is not None:
                heapq.heappush(waiting, (rank, left, right, parts[left], parts[right]))

        for left in range(len(parts) - 1):
            offer(left, left + 1)
        while waiting:
            _, left, right, first, second = heapq.heappop(waiting)
            if parts[left] != first or parts[right] != second or after[left] != right:
                continue
            parts[left], parts[right] = first + second, None
            after[left] = following = after[right]
            if following >= 0:
                before[following] = left
                offer(left, following)
            if before[left] >= 0:
                offer(before[left], left)
        return [self.ids[p] for p in parts if p is not None]

    def encode_piece(self, piece: str) -> bytes:
        found: list[int] = []
        for fragment in self.fragments(piece.encode()):
            found += self.merge(fragment)
        return np.array(found, np.int32).tobytes()

    def plain_parts(self, text: str) -> Iterator[tuple[str, int | None]]:
        """Stretches of ordinary text, and the special tokens between them."""
        at = 0
        if self.specials is not None:
            for hit in self.specials.finditer(text):
                if hit.start() > at:
                    yield text[at : hit.start()], None
                yield "", self.special[hit.group()]
                at = hit.end()
        if at < len(text):
            yield text[at:], None

    def encode(self, text: str) -> bytes:
        """Token ids of a text as 32-bit integers side by side."""
        found: list[bytes] = []
        for part, special in self.plain_parts(text):
            if special is not None:
                found.append(np.int32(special).tobytes())
            else:
                found += map(self.pieces.__getitem__, self.pre_tokens(part))
        return b"".join(found)

    def token_table(self) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all tokens, and where those of each id begin."""
        if self.table is None:
            tokens = [self.tokens.get(number, b"") for number in range(max(self.tokens) + 1)]
            begins = np.cumsum([0, *map(len, tokens)])
            self.table = np.frombuffer(b"".join(tokens), np.uint8), begins
        return self.table

    def decode(self, ids: np.ndarray, cuts: np.ndarray) -> list[str]:
        """The texts of id lists that lie side by side, cut at ``cuts``."""
        data, begins = self.token_table()
        size = begins[ids + 1] - begins[ids]
        ends = np.concatenate([[0], np.cumsum(size)])
        raw = data[np.repeat(begins[ids] - ends[:-1], size) + np.arange(ends[-1])].tobytes()
        at = ends[cuts]
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(at[:-1], at[1:], strict=True)]


_opened: dict[int, ByteBpe] = {}


def opened(source: str) -> ByteBpe:
    """The vocabulary of a tokenizer file, built once in each worker."""
    key = hash(source)
    if key not in _opened:
        _opened[key] = ByteBpe(source)
    return _opened[key]


def read_file(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def slices(batch: pa.RecordBatch, text: str, most_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in parts of a few MB of text, so that what is made from it stays small."""
    sizes = pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
    begin = size = 0
    for at, more in enumerate(sizes):
        if at > begin and size + more > most_bytes:
            yield batch.slice(begin, at - begin)
            begin, size = at, 0
        size += int(more)
    if begin < batch.num_rows:
        yield batch.slice(begin)


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, ids`` (array of token ids).

    Token ids are those of the tokenizers library for the file at ``path``, without added special
    tokens, truncation or padding; special strings inside a text become their tokens. Null and empty
    texts have no tokens. Rows are independent: repeated rows and null ids pass through, an empty table
    gives no rows, other columns are ignored. The file is read on the driver and sent to the executors.
    """
    spark = docs.sparkSession
    source = spark.sparkContext.broadcast(read_file(path))

    def run(batches):
        bpe = opened(source.value)
        for whole in batches:
            for batch in slices(whole, "text"):
                ids = [bpe.encode(t) if t else b"" for t in batch.column("text").to_pylist()]
                cuts = np.cumsum([0, *(len(i) // 4 for i in ids)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.frombuffer(b"".join(ids), np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], ["doc_id", "ids"])

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    prepare(spark)
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (``doc_id, ids``) with the text its ids stand for, as ``text``.

    Bytes that are not UTF-8 become U+FFFD, as in the library. Null ids are no tokens.
    """
    spark = encoded.sparkSession
    source = spark.sparkContext.broadcast(read_file(path))

    def run(batches):
        bpe = opened(source.value)
        for batch in batches:
            lists = batch.column("ids")
            cuts = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False))])
            texts = bpe.decode(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), cuts.astype(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    prepare(spark)
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids array<int>, text string")
