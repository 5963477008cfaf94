"""Encode many texts with a tokenizer library, every distinct run once.

A run is what lies between two blanks, with the blank before it. Where something other than white space comes before
a blank, no token of the tokenizers used here reaches across: byte-level BPE splits its words there, and no piece of the
sentence-piece vocabulary has a blank after another character (`pieces_keep_blanks_first` checks it). So the ids of a text
are those of its runs, one after the other. Texts where a blank follows white space or ends the text go to the library whole.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterable, Sequence
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from benchloom.llm.bpe import _byte_chars

#: A blank that begins no run of its own: after any white space (fixed values: the Unicode property and the ASCII separators), at the end.
WHOLE = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}] | $"
#: The same where every text has a blank in front; sentence pieces also take this mark for a blank.
WHOLE_LED = r"^ |▁|" + WHOLE


class IdTable:
    """Lists of ids in one array; grows at the end, and what was added last can be taken off again."""

    def __init__(self):
        self.flat, self.begin, self.rows = np.zeros(1 << 16, np.uint32), np.zeros(1 << 14, np.int64), 0

    def add(self, lists: Sequence[Sequence[int]]) -> None:
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        at, more = self.begin[self.rows], int(sizes.sum())
        while at + more > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.rows + len(lists) + 1 > len(self.begin):
            self.begin = np.concatenate([self.begin, np.zeros_like(self.begin)])
        self.flat[at : at + more] = np.fromiter(chain.from_iterable(lists), np.uint32, more)
        self.begin[self.rows + 1 : self.rows + 1 + len(lists)] = at + np.cumsum(sizes)
        self.rows += len(lists)

    def sizes(self, rows: np.ndarray) -> np.ndarray:
        return self.begin[rows + 1] - self.begin[rows]

    def take(self, rows: np.ndarray) -> np.ndarray:
        """The lists of the given rows, one after the other."""
        sizes = self.sizes(rows)
        end = np.cumsum(sizes)
        return self.flat[np.repeat(self.begin[rows] - (end - sizes), sizes) + np.arange(end[-1] if len(end) else 0)]


class RunEncoder:
    """Texts of a batch as rows of id tables, one table for each encoder.

    An encoder turns a list of strings into lists of ids. It gets the texts between blanks, told whether a blank goes
    before them: `led` encoders get one before every text, too. At most `size` runs are remembered; then all are forgotten.
    """

    def __init__(self, encoders: Sequence[Callable[[list[str], bool], Iterable[Sequence[int]]]], led: bool, size: int = 200_000):
        self.encoders, self.led, self.size = encoders, led, size
        self._forget()

    def _forget(self) -> None:
        self.tables = [IdTable() for _ in self.encoders]
        self.known: tuple[dict[str, int], dict[str, int]] = ({}, {})

    def _append(self, names: list[str], blank: bool) -> int:
        first = self.tables[0].rows
        for table, encode in zip(self.tables, self.encoders, strict=True):
            table.add(list(encode(names, blank)))
        return first

    def _rows(self, names: list[str], blank: bool) -> np.ndarray:
        known = self.known[blank]
        rows = np.fromiter(map(known.get, names, repeat(-1)), np.int64, len(names))
        new = np.flatnonzero(rows < 0)
        if len(new):
            fresh = list(dict.fromkeys(names[i] for i in new.tolist()))
            first = self._append(fresh, blank)
            known.update(zip(fresh, range(first, first + len(fresh)), strict=True))
            rows[new] = [known[names[i]] for i in new.tolist()]
        return rows

    def rows(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(table rows of all runs in order, where the runs of each text begin and the last one's end); null is empty.

        The rows hold until the next call.
        """
        if sum(map(len, self.known)) > self.size:
            self._forget()
        texts = texts.fill_null("")
        whole = pc.match_substring_regex(texts, WHOLE_LED if self.led else WHOLE).to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(texts.filter(pa.array(~whole)), " ")
        counts = np.ones(len(texts), np.int64)
        counts[~whole] = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        begin = np.concatenate([[0], np.cumsum(counts)])
        coded = lists.flatten().dictionary_encode()
        names, index = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy(zero_copy_only=False)
        own = self._rows(names, True)[index] if len(names) else np.zeros(0, np.int64)
        if not self.led and len(own):
            first = np.cumsum(counts[~whole]) - counts[~whole]
            own[first] = self._rows([names[i] for i in index[first].tolist()], False)
        rows = np.empty(begin[-1], np.int64)
        split = np.ones(begin[-1], bool)
        split[begin[:-1][whole]] = False
        rows[split] = own
        if whole.any():
            kept = self.tables[0].rows
            first = self._append(texts.filter(pa.array(whole)).to_pylist(), self.led)
            rows[~split] = first + np.arange(whole.sum())
            for t in self.tables:
                t.rows = kept  # not remembered: the next lists overwrite them
        return rows, begin


#: Characters whose classes (letter, number, white space) have been the same in all versions of Unicode that either
#: library may follow: Latin, basic Cyrillic, kana, the first block of Han (fixed values).
STABLE = re.compile("[\t\n\r -~¡-\u0233Ѐ-ӿぁ-ゖァ-ヺ一-\u9fa5]*")


def byte_labels(definition: str) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary; special tokens spell themselves."""
    j, back = json.loads(definition), _byte_chars()
    own = {i: bytes(back[c] for c in t) for t, i in j["model"]["vocab"].items() if all(c in back for c in t)}
    own |= {t["id"]: t["content"].encode() for t in j.get("added_tokens", [])}
    return [own.get(i, b"") for i in range(max(own) + 1)]


def by_rank(definition: str):
    """The same merges by the tiktoken library, which takes a third of the time for short texts, or None.

    It needs merges in the order of the ids that they make, and the split of words of byte-level BPE.
    """
    import tiktoken

    j, back = json.loads(definition), _byte_chars()
    vocab = j["model"]["vocab"]
    merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "", 1) for m in j["model"]["merges"]]
    made = [vocab[m] for m in merges]
    split = j.get("pre_tokenizer") or {}
    usual = split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True) and not j.get("normalizer")
    if not usual or made != list(range(256, 256 + len(made))):
        return None
    special = {t["content"] for t in j.get("added_tokens", [])}
    ranks = {bytes(back[c] for c in t): i for t, i in vocab.items() if t not in special}
    return tiktoken.Encoding("byte level", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


#: How byte-level BPE splits text into words (a fixed value of that format).
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_bpe(definition: str, plain_specials: bool = False) -> Callable[[list[str], bool], Iterable[Sequence[int]]]:
    """An encoder by the tokenizers library: no special tokens added, no truncation, no padding.

    `plain_specials`: strings of special tokens within a text are ordinary text. Texts of STABLE characters without
    such strings are encoded `by_rank`, with the same result.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(definition)
    library.no_truncation()
    library.no_padding()
    library.encode_special_tokens = plain_specials
    ranked, stable = by_rank(definition), STABLE.fullmatch
    special = [] if plain_specials else [t["content"] for t in json.loads(definition).get("added_tokens", [])]

    def simple(text: str) -> bool:
        return ranked is not None and stable(text) is not None and not any(s in text for s in special)

    def encode(texts: list[str], blank: bool):
        if blank:
            texts = [" " + t for t in texts]
        for at in range(0, len(texts), 256):
            part = texts[at : at + 256]
            if simple("".join(part)):
                yield from map(ranked, part)
                continue
            easy = [simple(t) for t in part]
            found = iter(library.encode_batch_fast([t for t, own in zip(part, easy, strict=True) if not own], add_special_tokens=False))
            for t, own in zip(part, easy, strict=True):
                yield ranked(t) if own else next(found).ids

    return encode


def piece_bpe(model: bytes) -> Callable[[list[str], bool], Iterable[Sequence[int]]]:
    """An encoder by the sentencepiece library, which puts a blank before every text itself."""
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    if not pieces_keep_blanks_first([library.id_to_piece(i) for i in range(library.get_piece_size())]):
        raise ValueError("a piece of this vocabulary reaches across a blank; its texts can't be encoded in runs")

    def encode(texts: list[str], blank: bool):
        for at in range(0, len(texts), 4096):
            yield from library.encode(texts[at : at + 4096], num_threads=1)

    return encode


def pieces_keep_blanks_first(pieces: Iterable[str]) -> bool:
    return not any("▁" in p.lstrip("▁") for p in pieces)
