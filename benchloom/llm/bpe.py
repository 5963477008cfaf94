"""Byte-level BPE by an automaton: encode pre-split words by transitions, decode by emitting arc labels.

The automaton starts with one state whose arcs carry all single bytes: every byte string is one path. The merges are
then compiled in order, each by a gadget. The gadget of merge k = (u, v) acts wherever an arc u leads to a state with
an arc v:

* it adds an arc uv from the source of u to the target of v,
* it gives u a state of its own (a copy of the one it led to) and takes the arc v away from it.

What remains after the last merge is deterministic: one state per last label, and the path of a byte string is its
tokenization. All arcs of 50,000 merges are billions, so the arcs are kept by their life time: an arc (state s, label
x) is born at the later of the two merges that make s and x and lives until the gadget of the pair (s, x), if there is
one. `MergeAutomaton.arc` replays just the gadgets that concern one arc, in that order, and stores the answer in the
transition table. Distinct words go through the table once and are kept.

The text is split before as the tokenizer file says: special strings first, then the contraction, letter, number,
symbol and space runs of byte-level BPE, with the Unicode classes of Python's database.

Defined cases: null and empty texts have no tokens; repeated rows are treated row by row; input columns named like an
added one are replaced.
"""

from __future__ import annotations

import array
import hashlib
import json
import re
import sys
import unicodedata
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from benchloom.llm.common import Memo, add_columns, kept

START = -1
ARCS = 250_000  # of the transition table; beyond, it begins anew


def _byte_chars() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable Latin-1 for itself, others from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class MergeAutomaton:
    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        back = _byte_chars()
        raw = {t: bytes(back[c] for c in t) for t in vocab if all(c in back for c in t)}
        self.label = {i: raw[t] for t, i in vocab.items() if t in raw}
        self.token = {b: i for i, b in self.label.items()}
        self.made: dict[int, tuple[int, int, int]] = {}
        self.gadget: dict[tuple[int, int], int] = {}
        for step, (u, v) in enumerate(merges):
            a, b, ab = vocab[u], vocab[v], vocab[u + v]
            self.gadget.setdefault((a, b), step)
            self.made.setdefault(ab, (step, a, b))
        lengths: dict[bytes, set[int]] = {}
        for b in self.token:
            lengths.setdefault(b[:2], {1}).add(len(b))
        self.lengths = {k: tuple(sorted(v, reverse=True)) for k, v in lengths.items()}
        self.table: dict[int, bool] = {}  # by state << 32 | label

    def arc(self, state: int, label: int) -> bool:
        """Does an arc `label` leave the state behind `state` when all merges are compiled?"""
        known = self.table.get(state << 32 | label)
        if known is None:
            if len(self.table) >= ARCS:
                self.table.clear()
            known = self.table[state << 32 | label] = self._replay(state, label)
        return known

    def _replay(self, s: int, x: int) -> bool:
        until = len(self.gadget) + 1  # gadgets with a smaller step have acted
        while True:
            if self.gadget.get((s, x), until) < until:
                return False
            born_s, born_x = self.made.get(s), self.made.get(x)
            if born_s is None and born_x is None:
                return True
            if born_x is None or (born_s is not None and born_s[0] > born_x[0]):
                until, _, s = born_s  # the state of s was copied from the one behind its right part
            else:
                step, x, _ = born_x  # the arc x was laid beside the arc of its left part, still there at that step
                until = step + 1

    def encode(self, word: bytes) -> list[int]:
        """The labels of the one path that spells the word.

        Longer labels are tried first. A position from which no path goes on is left for good: the state there does
        not depend on how it was reached, because a prefix has one path only.
        """
        n, at, last, most = len(word), 0, START, len(word)
        path: list[int] = []
        closed: set[int] = set()
        token, lengths, arc, table = self.token, self.lengths, self.arc, self.table
        while at < n:
            for k in lengths.get(word[at : at + 2], (1,)):
                if k <= most and at + k <= n and at + k not in closed:
                    t = token.get(word[at : at + k])
                    if t is None:
                        continue
                    there = True if last == START else table.get(last << 32 | t)
                    if arc(last, t) if there is None else there:
                        path.append(t)
                        at, last, most = at + k, t, n
                        break
            else:
                if not path:
                    raise ValueError("a byte of the text has no token")
                closed.add(at)
                most = len(self.label[path[-1]])
                at -= most
                most -= 1
                path.pop()
                last = path[-1] if path else START
        return path


#: Letters and numbers that Unicode 16 adds to 15.1, fixed values: the tokenizer library knows them, Python may not.
NEW_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5),
    (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA),
    (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
NEW_NUMBERS = (
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
    (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
)


@cache
def _classes() -> tuple[str, str]:
    """Letters and numbers as ranges for a character class."""

    def ranges(kind: str, new: tuple[tuple[int, int], ...]) -> str:
        out, start = [f"\\U{a:08x}-\\U{b:08x}" for a, b in new], None
        for c in range(sys.maxunicode + 2):
            own = c <= sys.maxunicode and unicodedata.category(chr(c))[0] == kind
            if own and start is None:
                start = c
            elif not own and start is not None:
                out.append(f"\\U{start:08x}-\\U{c - 1:08x}")
                start = None
        return "".join(out)

    return ranges("L", NEW_LETTERS), ranges("N", NEW_NUMBERS)


#: White space, a fixed value (the Unicode property).
SPACE = r"\t-\r\x20\x85\xa0  -     　"


@cache
def splitter() -> re.Pattern:
    letters, numbers = _classes()
    return re.compile(
        f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{SPACE}{letters}{numbers}]+"
        f"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
    )


class Codec:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, definition: str):
        j = json.loads(definition)
        model = j["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ", 1)) for m in model["merges"]]
        self.automaton = MergeAutomaton(model["vocab"], merges)
        self.special = {t["content"]: t["id"] for t in j.get("added_tokens", [])}
        parts = sorted(map(re.escape, self.special), key=len, reverse=True)
        self.specials = re.compile("(" + "|".join(parts) + ")") if parts else None
        self.split = splitter().findall
        self.words = Memo(lambda w: array.array("I", self.automaton.encode(w.encode())).tobytes(), 200_000)
        self.runs = Memo(lambda run: self._split(" " + run), 200_000)
        self.spaces = re.compile(f"[{SPACE}] ")
        self.emit = {i: b for i, b in self.automaton.label.items()} | {i: t.encode() for t, i in self.special.items()}
        if sys.byteorder != "little":
            raise RuntimeError("ids are packed as little-endian numbers")

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        if not text:
            return b""
        if self.specials is None or not self.specials.search(text):
            return self._plain(text)
        parts = self.specials.split(text)
        return b"".join(self.special[p].to_bytes(4, "little") if p in self.special else self._plain(p) for p in parts)

    def _plain(self, text: str) -> bytes:
        """A blank after something that is not white space always begins a new word, so the runs between such blanks
        can be looked up as a whole."""
        if self.spaces.search(text):
            return self._split(text)
        first, *runs = text.split(" ")
        return self._split(first) + b"".join(map(self.runs.__getitem__, runs))

    def _split(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, self.split(text)))

    def decode(self, ids: bytes) -> str:
        """The labels of the path, one after the other; broken UTF-8 becomes the replacement character."""
        return b"".join(map(self.emit.__getitem__, array.array("I", ids))).decode("utf-8", "replace")


def _shared_codec(df: DataFrame, tokenizer: str):
    """The driver reads the file, whose size does not depend on the data; tasks build the automaton once each worker."""
    with open(tokenizer, encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


OWNER = "bpe"


def codec_of(definition: str) -> Codec:
    """One codec each worker, until the worker turns to another operator."""
    return kept(OWNER, hash(definition), lambda: Codec(definition))


def encode(docs: DataFrame, tokenizer: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add n_tokens and ids (binary: little-endian unsigned 32-bit numbers)."""
    shared = _shared_codec(docs, tokenizer)
    added = StructType([StructField("n_tokens", LongType()), StructField("ids", BinaryType())])

    def make():
        codec = codec_of(shared.value)

        def work(texts):
            ids = list(map(codec.encode, texts))
            return [len(x) // 4 for x in ids], ids

        return work

    return add_columns(docs, [text], added, make, keep, OWNER)


def decode(tokens: DataFrame, tokenizer: str, ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """Add decoded: the text that the ids spell (a null list of ids gives an empty text)."""
    shared = _shared_codec(tokens, tokenizer)
    added = StructType([StructField("decoded", StringType())])

    def make():
        codec = codec_of(shared.value)
        return lambda col: ([codec.decode(x or b"") for x in col],)

    return add_columns(tokens, [ids], added, make, keep, OWNER)


def digests(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: n_tokens and digests of the ids and of the text decoded from them."""
    shared = _shared_codec(docs, tokenizer)
    added = StructType([
        StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType()),
    ])

    def make():
        codec = codec_of(shared.value)

        def work(texts):
            n, a, b = [], [], []
            for t in texts:
                ids = codec.encode(t)
                n.append(len(ids) // 4)
                a.append(hashlib.sha256(ids).hexdigest())
                b.append(hashlib.sha256(codec.decode(ids).encode()).hexdigest())
            return n, a, b

        return work

    return add_columns(docs, [text], added, make, [doc_id], OWNER)
