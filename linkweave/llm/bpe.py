"""BPE encoding by a pair occurrence index, and decoding.

The distinct words that a task meets are laid out one behind the other as one list of
symbols with links to the left and right neighbour. An index maps each adjacent pair
that has a merge rank to all positions where it stands. Active ranks are taken in
ascending order; one rank merges all its positions at once, left to right, and only the
lists of the pairs beside a merge are changed. Words do not touch, so every word ends
as if it had been encoded alone.

Null and empty texts have no ids and decode to the empty string. Rows are taken one by
one: repeated rows and null ids give rows of their own, an empty table none. Whole texts are
encoded, however long. Of code points that Python's Unicode tables do not know, the library's own
say how they are normalised and whether they are letters.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterable, Iterator
from functools import cache, cached_property

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from linkweave.llm.common import chunks, pick

#: Pieces of text whose ids a Python worker keeps; beyond it starts anew. Only a saving of time.
KEPT_PIECES = 500_000
#: After a longer piece nothing is kept.
KEPT_LENGTH = 10_000
SEPARATORS = "\x1c\x1d\x1e\x1f"

SCHEMA = pa.schema([
    ("doc_id", pa.int64()),
    ("n_tokens", pa.int64()),
    ("ids_sha256", pa.string()),
    ("decoded_sha256", pa.string()),
])


class Words:
    """The vocabulary file: lower-cased words, a mark at their ends, bytes as letters."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.names = {i: token for token, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names |= {i: token for token, i in self.special.items()}
        end = model["end_of_word_suffix"]
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + end] for c in letters], np.int64)
        self.merges = Merges(
            [(vocab[a], vocab[b], vocab[a + b]) for a, b in model["merges"]], len(self.names)
        )
        self.numbers = {i: str(i) for i in self.names}
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.word = regex.compile(split)
        self.split_special = regex.compile(
            "(" + "|".join(map(regex.escape, self.special)) + ")"
        )
        self.white = regex.compile(r"\s+")
        self.ids_of: dict[str, str] = {}
        self.tokens_of: dict[str, str] = {}
        self.long = False
        self.assigned: set[str] = set()
        self.kinds: dict[str, str] = {}
        self.path = path

    def encode_words(self, words: list[str]) -> list[list[int]]:
        if not words:
            return []
        raws = [w.encode("utf-8") for w in words]
        ends = np.cumsum([len(r) for r in raws])
        raw = np.frombuffer(b"".join(raws), np.uint8)
        ids = self.inner[raw]
        ids[ends - 1] = self.last[raw[ends - 1]]
        return merge_all(ids, np.concatenate([[0], ends[:-1]]), self.merges)

    def free_in(self, text: str) -> set[str]:
        """The text's code points that Python's Unicode tables do not assign; the library's may."""
        if text.isascii() or self.assigned.issuperset(text):
            return set()
        met = set(text) - self.assigned
        free = {c for c in met if unicodedata.category(c) == "Cn"}
        self.assigned.update(met - free)
        return free

    @cached_property
    def library(self) -> Tokenizer:
        return Tokenizer.from_file(self.path)

    def kind(self, c: str) -> str:
        """A letter, digit or sign that stands for a code point which only the library may know."""
        if c not in self.kinds:
            def parts(text: str) -> int:
                return len(self.library.pre_tokenizer.pre_tokenize_str(text))

            self.kinds[c] = "a" if parts("a" + c) == 1 else "\u2603" if parts("!" + c) == 1 else "1"
        return self.kinds[c]

    def words_in(self, piece: str) -> list[str]:
        """The words of a piece without white space."""
        if free := self.free_in(piece):
            known = "".join(self.kind(c) if c in free else c for c in piece)
            return [piece[m.start():m.end()] for m in self.word.finditer(known)]
        return self.word.findall(piece)

    def pieces(self, text: str) -> list[str]:
        """The text's parts between white space, in normal form; no word reaches beyond one."""
        text = self.library.normalizer.normalize_str(text) if self.free_in(text) else normal(text)
        if not any(c in text for c in SEPARATORS):
            return text.split()
        # To the pattern these are signs, to Python white space.
        return [p for p in self.white.split(text) if p]

    def learn(self, pieces: set[str]) -> None:
        """Take up the ids and tokens, as text, of pieces not met before."""
        missing = pieces - self.ids_of.keys()
        words = {}
        for p in missing:
            words[p] = (p,) if p.isascii() and p.isalpha() else self.words_in(p)
        distinct = list({w for found in words.values() for w in found})
        names, numbers = self.names, self.numbers
        ids_of, tokens_of = {}, {}
        for w, ids in zip(distinct, self.encode_words(distinct), strict=True):
            ids_of[w] = " ".join([numbers[i] for i in ids])
            tokens_of[w] = " ".join([names[i] for i in ids])
        for piece, found in words.items():
            if len(found) == 1:
                self.ids_of[piece], self.tokens_of[piece] = ids_of[found[0]], tokens_of[found[0]]
            else:
                self.ids_of[piece] = " ".join([ids_of[w] for w in found])
                self.tokens_of[piece] = " ".join([tokens_of[w] for w in found])

    def forget(self) -> None:
        """Keep what is held bounded."""
        if len(self.ids_of) > KEPT_PIECES or self.long:
            self.ids_of.clear()
            self.tokens_of.clear()
            self.long = False


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: its own, or one from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in printable else next(spare)) for b in range(256)]


class Merges:
    """The merge list as sorted pair keys, to look up many pairs at once."""

    def __init__(self, pairs: list[tuple[int, int, int]], size: int) -> None:
        keys = np.array([a * size + b for a, b, _ in pairs], np.int64)
        order = np.argsort(keys)
        self.size, self.keys, self.ranks = size, keys[order], order
        self.left, self.right, self.new = np.array(pairs, np.int64).T

    def find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the pairs have a rank, and those ranks."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = np.flatnonzero(self.keys[at] == key)
        return known, self.ranks[at[known]]


def merge_all(ids: np.ndarray, starts: np.ndarray, merges: Merges) -> list[list[int]]:
    """Each word's ids after all merges, by one pair occurrence index over all words.

    ``ids`` holds the words' first symbols one behind the other, ``starts`` where each
    word begins. Every word has a symbol.
    """
    n = len(ids)
    left, right = np.arange(-1, n - 1), np.arange(1, n + 1)
    left[starts] = -1
    right[starts[1:] - 1] = -1
    right[-1:] = -1
    index: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def note(a: np.ndarray, b: np.ndarray, at: np.ndarray) -> None:
        known, ranks = merges.find(a, b)
        if not len(known):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, at = ranks[order], at[known[order]]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        begin = 0
        for rank, end in zip(ranks[[0, *cuts]].tolist(), [*cuts.tolist(), len(at)], strict=True):
            lists = index.get(rank)
            if lists is None:
                index[rank] = [at[begin:end]]
                heapq.heappush(active, rank)
            else:
                lists.append(at[begin:end])
            begin = end

    inner = np.flatnonzero(right >= 0)
    note(ids[inner], ids[inner + 1], inner)
    while active:
        rank = heapq.heappop(active)
        lists = index.pop(rank)
        a, b, new = merges.left[rank], merges.right[rank], merges.new[rank]
        at = np.unique(np.concatenate(lists)) if len(lists) > 1 else np.sort(lists[0])
        # A pair may have gone when its neighbour was merged.
        at = at[ids[at] == a]
        beside = right[at]
        there = (beside >= 0) & (ids[beside] == b)
        at, beside = at[there], beside[there]
        if a == b and len(at) > 1:
            # In a run of equal symbols every other pair is merged, from the left.
            taken, last = [], -1
            for i, (x, y) in enumerate(zip(at.tolist(), beside.tolist(), strict=True)):
                if x != last:
                    taken.append(i)
                    last = y
            at, beside = at[taken], beside[taken]
        if not len(at):
            continue
        ids[at], ids[beside] = new, -1
        after, before = right[beside], left[at]
        right[at] = after
        has = after >= 0
        left[after[has]] = at[has]
        first, second = at[has], after[has]
        has = before >= 0
        # Read after all merges of the rank: a neighbour may have been merged as well.
        first = np.concatenate([first, before[has]])
        second = np.concatenate([second, at[has]])
        note(ids[first], ids[second], first)
    alive = ids >= 0
    ends = np.cumsum(np.add.reduceat(alive, starts, dtype=np.int64)).tolist()
    flat = ids[alive].tolist()
    return [flat[i:j] for i, j in zip([0, *ends[:-1]], ends, strict=True)]


@cache
def words_of(path: str) -> Words:
    return Words(path)


def normal(text: str) -> str:
    """Normal form C, then lower case letter by letter: no final form of a sigma."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def encode_texts(texts: list[str], words: Words) -> Iterator[tuple[str, str]]:
    """For each text its ids, and its tokens, each joined by one space."""
    parts: list[list[list[str] | str]] = []
    seen: set[str] = set()
    for text in texts:
        cut = words.split_special.split(text) if "<|" in text else [text]
        parts.append([p if p in words.special else words.pieces(p) for p in cut])
        for part in parts[-1]:
            if not isinstance(part, str):
                seen.update(part)
    words.learn(seen)
    words.long |= any(len(p) > KEPT_LENGTH for p in seen)
    id_of, token_of = words.ids_of.__getitem__, words.tokens_of.__getitem__
    for found in parts:
        if len(found) == 1 and not isinstance(found[0], str):
            yield " ".join(map(id_of, found[0])), " ".join(map(token_of, found[0]))
            continue
        ids, tokens = [], []
        for part in found:
            if isinstance(part, str):
                ids.append(str(words.special[part]))
                tokens.append(part)
            elif part:
                ids.append(" ".join(map(id_of, part)))
                tokens.append(" ".join(map(token_of, part)))
        yield " ".join(ids), " ".join(tokens)
    words.forget()


def encode(documents: DataFrame, path: str | None = None) -> DataFrame:
    """Ids and decoded text of every document, as digests: see ``SCHEMA``.

    A decoded text is its tokens joined by one space, special tokens among them.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_of(path or public_tokenizers.path("word_bpe_49k.json"))
        for doc_ids, texts in chunks(batches):
            counts, ids_sums, text_sums = [], [], []
            for ids, tokens in encode_texts(texts, words):
                counts.append(ids.count(" ") + 1 if ids else 0)
                ids_sums.append(hashlib.sha256(ids.encode()).hexdigest())
                text_sums.append(hashlib.sha256(tokens.encode()).hexdigest())
            yield pa.record_batch(
                [
                    pa.array(x, f.type)
                    for x, f in zip((doc_ids, counts, ids_sums, text_sums), SCHEMA, strict=True)
                ],
                schema=SCHEMA,
            )

    return pick(documents, "doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
