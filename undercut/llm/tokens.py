"""Public tokenizers inside tasks: token ids of whole texts, remembering repeated stretches."""

from __future__ import annotations

import functools
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Stretches that a worker remembers, and the characters of the longest of them.
REMEMBERED, LONGEST = 400_000, 64
#: Pre-tokens in one text for the model, which keeps some hundred bytes for each of its tokens until it is read.
TOGETHER = 8192


@functools.lru_cache(maxsize=4)
def library(path: str):
    """The tokenizer in a file that every node has, loaded once in a worker."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def ids_of(path: str, texts: list[str]) -> list[bytes]:
    """Each text's ids, little-endian unsigned 32 bits, straight from the library."""
    found = library(path).encode_batch_fast(texts, add_special_tokens=False)
    return [np.array(x.ids, "<u4").tobytes() for x in found]


@functools.cache
def _letters() -> dict[int, int]:
    """How byte-level tokenizers write bytes: printable ones as they are, the others from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in plain)
    return {b: 256 + i for i, b in enumerate(others)}


@functools.lru_cache(maxsize=4)
def _units(path: str):
    """The library with the file's model, for pre-tokens that are found already and have a space
    between them, and which ids begin with a written space."""
    from tokenizers import Tokenizer, pre_tokenizers

    units = Tokenizer(library(path).model)
    units.pre_tokenizer = pre_tokenizers.Split(" ", "removed")
    vocabulary = units.get_vocab()
    spaced = np.zeros(max(vocabulary.values()) + 1, bool)
    spaced[[i for token, i in vocabulary.items() if token.startswith("Ġ")]] = True
    return units, spaced


def ids_of_units(path: str, units: list[str], space: bool) -> list[bytes]:
    """Ids of pre-tokens without white space, or with one space in front, by the library's model alone.

    ``TOGETHER`` of them go through it as one text. Only a written space in front of each, or as a pre-token of its
    own between two, has an id that begins with one, which tells where each begins.
    """
    letters, out = _letters(), []
    encode, spaced = _units(path)
    mark = " Ġ" if space else " Ġ "
    for i in range(0, len(units), TOGETHER):
        written = [u if u.isascii() else u.encode().decode("latin-1").translate(letters) for u in units[i : i + TOGETHER]]
        (found,) = encode.encode_batch_fast([mark.join(["", *written])], add_special_tokens=False)
        ids = np.array(found.ids, "<u4")
        at, data = 4 * np.append(np.flatnonzero(spaced[ids]), len(ids)), ids.tobytes()
        begins = at[:-1] if space else at[:-1] + 4
        out += [data[a:b] for a, b in zip(begins.tolist(), at[1:].tolist(), strict=True)]
    return out


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> ByteEncoder:
    return ByteEncoder(path)


class ByteEncoder:
    """Ids of whole texts by a byte-level tokenizer whose pre-tokens take one space in front.

    A space before something that is not white space always begins a pre-token, so the
    stretches between such spaces can be encoded apart; each distinct one is put together once in
    a while from its pre-tokens, which go through the library's model many at a time. Texts that
    hold a special token go through the library whole.
    """

    #: Stretches of letters, digits, marks and single line ends, where each run of one kind is a
    #: pre-token. Only letters that are so in every Unicode version; marks without the apostrophe,
    #: which may begin a pre-token with letters.
    LETTERS, MARKS = "A-Za-zÀ-ÖØ-öø-ɏ", r"!-&(-/:-@\[-`{-~"
    PLAIN = re.compile(rf"[{LETTERS}{MARKS}0-9]+(?:\n[{LETTERS}{MARKS}0-9]+)*")
    RUNS = re.compile(rf"[{LETTERS}]+|[{MARKS}]+|[0-9]+|\n")
    ODD = re.compile(r" (?!\S)")
    CUT = re.compile(r" (?=\S)")

    def __init__(self, path: str):
        self.path = path
        self.special = [t.content for t in library(path).get_added_tokens_decoder().values()]
        # By the stretch without the space in front. What is looked up among the older ones is known again;
        # when many are known they become the older ones.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.inner: dict[str, bytes] = {}  # pre-tokens without a space in front

    def _learn(self, parts: set[str]) -> None:
        """Add new stretches: those of letters, digits and marks by their pre-tokens, others whole."""
        known, older, inner, made, first, more, whole = self.known, self.older, self.inner, [], set(), set(), []
        for part in parts:
            if part in older:
                known[part] = older[part]
            elif part.isascii() and part.isalpha():
                first.add(part)
            elif len(part) <= LONGEST and self.PLAIN.fullmatch(part):
                runs = self.RUNS.findall(part)
                if runs[0] not in known:
                    first.add(runs[0])
                if len(runs) > 1:
                    made.append((part, runs))
                    more.update(runs[1:])
            else:
                whole.append(part)
        new = [run for run in more if run not in inner and run != "\n"]
        inner["\n"] = ids_of(self.path, ["\n"])[0]
        inner.update(zip(new, ids_of_units(self.path, new, space=False), strict=True))
        known.update(zip(first, ids_of_units(self.path, list(first), space=True), strict=True))
        known.update((part, b"".join([known[runs[0]], *map(inner.__getitem__, runs[1:])])) for part, runs in made)
        known.update(zip(whole, ids_of(self.path, [" " + p for p in whole]), strict=True))

    def _cut(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """All stretches in order, and where each text's begin (one more at the end)."""
        odd = [i for i, text in enumerate(texts) if self.ODD.search(text)]
        if not odd:
            parts = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
            return parts.values, parts.offsets.to_numpy()
        lists = [self.CUT.split(text) for text in texts]
        return pa.array([part for parts in lists for part in parts], pa.large_string()), np.cumsum([0, *map(len, lists)])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids, little-endian unsigned 32 bits."""
        whole = [i for i, text in enumerate(texts) if any(s in text for s in self.special)]
        out = dict(zip(whole, ids_of(self.path, [texts[i] for i in whole]), strict=True)) if whole else {}
        rest = [i for i in range(len(texts)) if i not in out]
        if not rest:
            return [out[i] for i in range(len(texts))]
        parts, first = self._cut([texts[i] for i in rest])
        # The first stretch of a text has no space in front: it has a place of its own behind the distinct ones.
        heads = ids_of(self.path, parts.take(pa.array(first[:-1])).to_pylist())
        coded = parts.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        places = coded.indices.to_numpy().copy()
        places[first[:-1]] = np.arange(len(distinct), len(distinct) + len(heads))
        used = np.zeros(len(distinct) + len(heads), bool)
        used[places] = True
        known = self.known
        found = list(map(known.get, distinct))
        new = {part: j for j, part in enumerate(distinct) if found[j] is None and used[j]}
        self._learn(set(new))
        for part, j in new.items():
            found[j] = known[part]
        ids = pa.array([*found, *heads], pa.large_binary()).take(pa.array(places))
        data, ends = memoryview(ids.buffers()[2] or b""), np.frombuffer(ids.buffers()[1], np.int64)[first]
        out.update((i, bytes(data[a:b])) for i, a, b in zip(rest, ends[:-1].tolist(), ends[1:].tolist(), strict=True))
        for part in new:
            if len(part) > LONGEST:
                del known[part]
        if len(known) > REMEMBERED // 2:
            self.known, self.older = {}, known
        if len(self.inner) > REMEMBERED // 2:
            self.inner.clear()
        return [out[i] for i in range(len(texts))]
