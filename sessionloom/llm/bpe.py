"""Byte-level BPE over whole batches with an index of pair occurrences.

The distinct pretokens of a batch are laid out in one array of symbols. Every
adjacent pair with a rank is indexed by that rank; ranks are applied in ascending
order, in windows, to all their positions at once, and the pairs next to a merge
are looked up again and re-indexed. Within a window each pretoken only merges its
lowest pair (all its occurrences, left to right), so the result is that of the
plain algorithm that merges one pretoken's lowest pair at a time.
"""

from __future__ import annotations

import base64
import functools
import json
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Pretokens of a text that is all ASCII, and of any text; fixed values of the vocabulary's format.
_ASCII = re.compile(r"""'(?:[sdmt]|ll|ve|re)| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+""", re.ASCII)
_ANY = regex.compile(r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
#: ASCII characters the two classes of white space disagree on; such texts take the second pattern.
_ODD = re.compile("[\x1c-\x1f]")

NONE = np.int32(2**31 - 1)
#: Text of a batch, in characters; a batch and its symbols fit a worker's memory.
BATCH_CHARS = 8_000_000
#: Distinct pretokens remembered between the batches of a worker; beyond it the memory starts anew.
REMEMBERED = 300_000
WINDOW = 192


def default_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pretokens(text: str) -> list[str]:
    return _ASCII.findall(text) if text.isascii() and not _ODD.search(text) else _ANY.findall(text)


class _Index(dict):
    """Numbers its keys in the order they are first asked for."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


class Bpe:
    """A byte-level vocabulary given as ranks (.tiktoken) or as vocab and merges (.json)."""

    def __init__(self, path: str):
        if path.endswith(".json"):
            self.ranks = _json_ranks(path)
        else:
            with open(path, "rb") as f:
                self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.byte_id = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        left, right, made = [], [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), made.append(rank)
        keys = (np.array(left, np.int64) << 32) | np.array(right, np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.made = keys[order], np.array(made, np.int32)[order]
        table = np.full((256, 256), NONE, np.int32)
        a, b = np.meshgrid(np.arange(256), np.arange(256), indexing="ij")
        table[a, b] = self._rank(self.byte_id[a.ravel()], self.byte_id[b.ravel()]).reshape(256, 256)
        self.byte_pairs = table.ravel()
        self.forget()

    def forget(self) -> None:
        self.known, self.starts, self.tokens = _Index(), np.zeros(1, np.int64), np.zeros(0, np.int32)
        self.notes: dict = {}  # what users keep by pretoken number

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a.astype(np.int64) << 32) | b
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.made[at], NONE)

    def _merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words one after the other, and each word's number of ids."""
        raw = np.frombuffer(b"".join(words), np.uint8)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        n = len(raw)
        ids = np.append(self.byte_id[raw], np.int32(-1))
        nxt = np.arange(1, n + 2, dtype=np.int64)
        prv = np.arange(-1, n, dtype=np.int64)
        ends = np.cumsum(sizes)
        nxt[ends - 1] = n
        prv[np.append(0, ends[:-1])] = n
        nxt[n] = prv[n] = n
        rank = np.full(n + 1, NONE, np.int32)
        if n > 1:
            rank[: n - 1] = self.byte_pairs[raw[:-1].astype(np.int32) * 256 + raw[1:]]
            rank[ends - 1] = NONE
        word = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        n_windows = (int(self.made.max()) if len(self.made) else 0) // WINDOW + 1
        index: list[list[np.ndarray]] = [[] for _ in range(n_windows)]

        def enter(at: np.ndarray, r: np.ndarray) -> None:
            w = r // WINDOW
            order = np.argsort(w, kind="stable")
            at, w = at[order], w[order]
            cuts = np.flatnonzero(w[1:] != w[:-1]) + 1
            for part, first in zip(np.split(at, cuts), w[np.append(0, cuts)]):
                index[first].append(part)

        some = np.flatnonzero(rank < NONE)
        if len(some):
            enter(some, rank[some])
        for w in range(n_windows):
            if not index[w]:
                continue
            top = (w + 1) * WINDOW
            now = np.unique(np.concatenate(index[w]))
            index[w] = []
            while len(now):
                r = rank[now]
                now, r = now[r < top], r[r < top]
                if not len(now):
                    break
                of = word[now]
                first = np.append(0, np.flatnonzero(of[1:] != of[:-1]) + 1)
                low = np.repeat(np.minimum.reduceat(r, first), np.diff(np.append(first, len(now))))
                left = now[r == low]
                # overlapping occurrences of one rank: every second of a run, from the left
                if len(left) > 1:
                    tied = np.append(False, nxt[left[:-1]] == left[1:])
                    if tied.any():
                        at = np.arange(len(left))
                        left = left[(at - np.maximum.accumulate(np.where(tied, 0, at))) % 2 == 0]
                right = nxt[left]
                after = nxt[right]
                ids[left] = rank[left]
                ids[right] = -1
                rank[right] = NONE
                nxt[left] = after
                prv[after] = left
                prv[n] = n
                before = prv[left]
                touched = np.unique(np.append(left, before[before < n]))
                fresh = self._rank(ids[touched], ids[nxt[touched]])
                fresh[nxt[touched] == n] = NONE
                rank[touched] = fresh
                later = (fresh >= top) & (fresh < NONE)
                if later.any():
                    enter(touched[later], fresh[later])
                now = np.union1d(now, touched[fresh < top])
        alive = ids[:n] >= 0
        return ids[:n][alive], np.bincount(word[alive], minlength=len(words)).astype(np.int64)

    def _learn(self, start: int) -> None:
        """Encodes the pretokens numbered from ``start`` on."""
        import itertools

        words = [w.encode("utf-8", "surrogatepass") for w in itertools.islice(self.known, start, None)]
        if not words:
            return
        whole = [self.ranks.get(w) for w in words]
        rest = [i for i, r in enumerate(whole) if r is None]
        sizes = np.ones(len(words), np.int64)
        if rest:
            ids, n = self._merge([words[i] for i in rest])
            sizes[rest] = n
        out = np.empty(int(sizes.sum()), np.int32)
        starts = np.append(0, np.cumsum(sizes))
        single = np.ones(len(words), bool)
        single[rest] = False
        out[starts[:-1][single]] = [r for r in whole if r is not None]
        if rest:
            out[_spread(starts[:-1][rest], sizes[rest])] = ids
        self.starts = np.append(self.starts, self.starts[-1] + starts[1:])
        self.tokens = np.append(self.tokens, out)

    def _numbered(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The texts' pretokens as numbers, one text after the other, and where each text ends."""
        if len(self.known) > REMEMBERED:
            self.forget()
        start, lists, ends, total = len(self.known), [], [], 0
        ask = self.known.__getitem__
        for t in texts:
            if t:
                numbers = np.fromiter(map(ask, pretokens(t)), np.int32)
                lists.append(numbers)
                total += len(numbers)
            ends.append(total)
        self._learn(start)
        return np.concatenate(lists) if lists else np.zeros(0, np.int32), np.array(ends, np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the offsets of each text in them."""
        numbers, ends = self._numbered(texts)
        sizes = np.diff(self.starts)[numbers]
        ids = self.tokens[_spread(self.starts[numbers], sizes)]
        return ids, np.append(0, np.append(0, np.cumsum(sizes))[ends])

    def count(self, texts: list[str | None]) -> np.ndarray:
        numbers, ends = self._numbered(texts)
        total = np.append(0, np.cumsum(np.diff(self.starts)[numbers]))
        return np.diff(np.append(0, total[ends]))

    def number(self, texts: list[str | None]) -> list[np.ndarray]:
        """Each text's pretokens as numbers. They hold until the next call."""
        numbers, ends = self._numbered(texts)
        return np.split(numbers, ends[:-1]) if len(ends) else []

    def sizes(self) -> np.ndarray:
        """Tokens of each numbered pretoken."""
        return np.diff(self.starts)

    def count_single(self, words: list[str]) -> list[int]:
        """Tokens of texts that are one pretoken each; numbers stay as they are."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        rest = [w for w in raw if w not in self.ranks]
        sizes = iter(self._merge(rest)[1].tolist() if rest else ())
        return [1 if w in self.ranks else next(sizes) for w in raw]


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers start, start+1, ... of each run, one run after the other."""
    total = int(sizes.sum())
    shift = np.repeat(starts - np.append(0, np.cumsum(sizes)[:-1]), sizes)
    return np.arange(total, dtype=np.int64) + shift


def _json_ranks(path: str) -> dict[bytes, int]:
    """Byte strings and ids of a byte-level tokenizer file (its printable stand-ins for bytes undone)."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    stand_in = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    special = {"<|endoftext|>"}
    return {bytes(stand_in[c] for c in token): i for token, i in model["vocab"].items() if token not in special}


@functools.lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    """One copy of a vocabulary per worker."""
    return Bpe(path)


def batches_of(texts: pa.Array, chars: int = BATCH_CHARS):
    """Ranges of rows of about ``chars`` characters; a single longer text is a range of its own."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(sizes)
    begin = 0
    while begin < len(sizes):
        base = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, base + chars, "right")))
        yield begin, end
        begin = end


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(key, ids array<int>): the whole text of every row under a byte-level BPE vocabulary.

    Strings that look like special tokens are ordinary text. Null and empty texts give an
    empty list; repeated rows are encoded each; other columns are not read.
    """
    path = path or default_path()
    key_type = dict(docs.dtypes)[key]

    def run(batches):
        bpe = load(path)
        for batch in batches:
            texts = batch.column(1)
            for begin, end in batches_of(texts):
                ids, offsets = bpe.encode(texts.slice(begin, end - begin).to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, end - begin), lists], names=[key, "ids"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {key_type}, ids array<int>")


def p8_ids(spark, sf: str) -> DataFrame:
    return encode(spark.read.parquet(f"{sf}/documents.parquet"))
