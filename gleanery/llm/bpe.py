"""Byte-pair encoding by dynamic programming over prefixes.

Byte-pair encoding has one encoding for every byte string, and the encoding of a prefix is fixed by its
last token alone: what stands before that token is the encoding of the shorter prefix. So one array, the last token of every
prefix, holds the encodings of all prefixes. For each prefix the tokens that end there come from a suffix
automaton over the vocabulary, longest first; the one that may stand after the last token of the prefix it leaves
(a test of the two tokens alone) is stored. Following the array back from the end gives the ids.

Texts are first cut as the vocabulary's pre-tokeniser cuts them. Each distinct piece of many texts is encoded once, all of them together; the ids of
what was met lately are kept in a bounded table.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from gleanery.llm.common import slices, texts_as_bytes, whole

#: How the byte-level pre-tokeniser cuts a text. Fixed value.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: A space that may not be cut before: white space stands beside it.
_LOOSE = regex.compile(r" \s|\s ")

#: Stretches whose ids a Python worker keeps, before it starts anew; bytes from which a piece is encoded by itself, not with the others.
KEPT, LONG = 120_000, 96
#: Pairs of tokens whose test is remembered, a power of two.
PAIRS = 1 << 18


def byte_names() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary, to the byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names = {chr(b): b for b in shown}
    hidden = [b for b in range(256) if b not in set(shown)]
    return names | {chr(256 + k): b for k, b in enumerate(hidden)}


class Lookup:
    """Values of whole-number keys, as sorted arrays: many keys are looked up at once."""

    def __init__(self, known: dict[int, int]):
        keys = np.fromiter(known.keys(), np.int64, len(known))
        order = np.argsort(keys)
        self.keys, self.values = keys[order], np.fromiter(known.values(), np.int64, len(known))[order]

    def __call__(self, asked: np.ndarray) -> np.ndarray:
        """The value of each key, or -1."""
        at = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
        return np.where(self.keys[at] == asked, self.values[at], -1)


class SuffixAutomaton:
    """Reads bytes one by one; after each it can list the vocabulary's tokens that end there, longest first.

    A state is a substring of tokens, and ``back`` leads to its longest proper suffix that is a state. Of a whole suffix automaton only the substrings
    that start a token are states here: what has been read matches a token's end only if it starts that token, so the others would never be asked, and
    the tokens found are the same. ``steps`` has a state's known steps, by state * 256 + byte; ``ends`` the longest token that is a suffix of the
    state (-1: none).
    """

    def __init__(self, tokens: list[bytes]):
        steps: dict[int, int] = {}
        own, depth = [-1], [0]
        for k, token in enumerate(tokens):
            at = 0
            for n, byte in enumerate(token):
                step = steps.get(at << 8 | byte)
                if step is None:
                    step = steps[at << 8 | byte] = len(own)
                    own.append(-1)
                    depth.append(n + 1)
                at = step
            own[at] = k
        self.onward = Lookup(steps)
        self.ends, self.back = np.array(own), np.zeros(len(own), np.int64)
        #: the longest token that is a proper suffix of a token
        self.shorter = np.full(len(tokens), -1)
        level_of = np.array(depth)[self.onward.values]
        for level in range(1, max(depth) + 1):
            edges = self.onward.keys[level_of == level]
            states = self.onward.values[level_of == level]
            if level > 1:
                self.back[states] = self.step(self.back[edges >> 8], edges & 255)
            below = self.ends[self.back[states]]
            whole_token = self.ends[states] >= 0
            self.shorter[self.ends[states[whole_token]]] = below[whole_token]
            self.ends[states[~whole_token]] = below[~whole_token]

    def step(self, states: np.ndarray, read: np.ndarray) -> np.ndarray:
        """The states after one more byte each."""
        to = self.onward(states << 8 | read)
        todo = np.flatnonzero((to < 0) & (states > 0))
        states = states[todo]
        while len(todo):
            states = self.back[states]
            found = self.onward(states << 8 | read[todo])
            to[todo] = found
            more = (found < 0) & (states > 0)
            todo, states = todo[more], states[more]
        return np.maximum(to, 0)


class Codec:
    """Encodes and decodes as the vocabulary file says. An instance serves one Python worker."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        names = byte_names()
        vocab = {bytes(names[c] for c in word): k for word, k in spec["model"]["vocab"].items()}
        self.bytes_of: list[bytes] = [b""] * (1 + max([*vocab.values(), *(x["id"] for x in spec["added_tokens"])]))
        for word, k in vocab.items():
            self.bytes_of[k] = word
        #: how flat files store ids: two bytes where all fit, else four
        self.width = "<u2" if len(self.bytes_of) <= 1 << 16 else "<u4"
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        for content, k in self.special.items():
            self.bytes_of[k] = content.encode()
        self.cut_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        # single bytes, and what merges lead to: a vocabulary may hold others
        merges = [tuple(bytes(names[c] for c in x) for x in (pair if isinstance(pair, list) else pair.split(" "))) for pair in spec["model"]["merges"]]
        reached = {left + right for left, right in merges}
        order = sorted((w for w in vocab if len(w) == 1 or w in reached), key=vocab.get)
        if sum(len(w) == 1 for w in order) < 256:
            raise ValueError("the vocabulary lacks a byte")
        self.ids = np.array([vocab[w] for w in order], "<u4")
        self.words = SuffixAutomaton(order)
        self.length = np.array([len(w) for w in order])
        at = {w: k for k, w in enumerate(order)}
        # the place of a merge in the file is the moment at which it applies
        made: dict[int, int] = {}
        self.parts = np.full((len(order), 2), -1)
        self.moment = np.full(len(order), -1)
        for moment, (first, second) in enumerate(merges):
            left, right, token = at[first], at[second], at[first + second]
            if self.moment[token] < 0:
                self.parts[token] = left, right
                self.moment[token] = moment
            made[left * len(order) + right] = moment
        self.made = Lookup(made) if made else Lookup({-1: -1})
        # tests of pairs met lately, each at the place of its hash
        self.met, self.fits = np.full(PAIRS, -1), np.zeros(PAIRS, bool)
        # ids of stretches met lately, and of those met before them; a special token has a key that no text equals
        self.known: dict = {}
        self.before: dict = {}

    def _stay_apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether each two tokens stay apart when their bytes are encoded together: undo the merges along the border, the latest first.

        Between two undone moments the border has one token on each side. If a merge of these two has its moment
        before either of them is merged into something larger, it would have crossed the border. Of merges at the same
        moment (one rule, at two places) the left place goes first.
        """
        never = len(self.made.keys) + 1
        out = np.ones(len(left), bool)
        todo = np.arange(len(left))
        until_left, until_right = np.full(len(left), never), np.full(len(left), never)
        while len(todo):
            crossing = self.made(left * len(self.length) + right)
            # the left token's own merge, further left, goes before a crossing by the same rule
            crossed = (crossing >= 0) & (crossing < until_left) & (crossing <= until_right)
            out[todo[crossed]] = False
            moment_left, moment_right = self.moment[left], self.moment[right]
            go = ~crossed & ((moment_left >= 0) | (moment_right >= 0))
            undo_left = moment_left > moment_right
            until_left = np.where(undo_left, moment_left, until_left)[go]
            until_right = np.where(undo_left, until_right, moment_right)[go]
            left, right = np.where(undo_left, self.parts[left, 1], left)[go], np.where(undo_left, right, self.parts[right, 0])[go]
            todo = todo[go]
        return out

    def apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """_stay_apart, by the pairs met lately."""
        pair = left * len(self.length) + right
        with np.errstate(over="ignore"):
            slot = ((pair.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - PAIRS.bit_length() + 1)).astype(np.int64)
        out = self.fits[slot]
        new = np.flatnonzero(self.met[slot] != pair)
        if len(new):
            each, at, back = np.unique(pair[new], return_index=True, return_inverse=True)
            told = self._stay_apart(left[new[at]], right[new[at]])
            out[new] = told[back]
            self.met[slot[new[at]]], self.fits[slot[new[at]]] = each, told
        return out

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of pieces of the pre-tokeniser, as bytes. All go on together, a byte at a time."""
        size = np.array([len(x) for x in pieces])
        order = np.argsort(-size, kind="stable")
        size = size[order]
        raw = np.frombuffer(b"".join([pieces[k] for k in order]), np.uint8).astype(np.int64)
        base = np.cumsum(size) - size
        last = np.zeros(len(raw), np.int64)
        state = np.zeros(len(pieces), np.int64)
        for place in range(int(size[0]) if len(size) else 0):
            live = int(np.searchsorted(-size, -place, "left"))
            at = base[:live] + place
            state[:live] = self.words.step(state[:live], raw[at])
            token = self.words.ends[state[:live]]
            todo = np.arange(live)
            while True:
                start = place + 1 - self.length[token[todo]]
                todo, start = todo[start > 0], start[start > 0]
                if not len(todo):
                    break
                todo = todo[~self.apart(last[base[todo] + start - 1], token[todo])]
                token[todo] = self.words.shorter[token[todo]]
            last[at] = token
        # from each end back, token by token
        end, alive, steps = size.copy(), np.flatnonzero(size), []
        while len(alive):
            token = last[base[alive] + end[alive] - 1]
            steps.append((alive, token))
            end[alive] -= self.length[token]
            alive = alive[end[alive] > 0]
        if not steps:
            return [b""] * len(pieces)
        owner, token = (np.concatenate(x) for x in zip(*steps))
        turn = np.repeat(np.arange(len(steps)), [len(x) for x, _ in steps])
        sort = np.lexsort((-turn, owner))
        flat, ends = self.ids[token[sort]].tobytes(), 4 * np.cumsum(np.bincount(owner, minlength=len(pieces)))
        out = [b""] * len(pieces)
        for k, a, b in zip(order.tolist(), [0, *ends[:-1].tolist()], ends.tolist()):
            out[k] = flat[a:b]
        return out

    def encode_long(self, piece: bytes) -> bytes:
        """encode_pieces of one long piece: here a step at a time, without arrays of one value."""
        steps, back, ends, shorter, length = self._scalars()
        size, last, state = len(self.length), [], 0
        fits: dict[int, bool] = {}
        for end, byte in enumerate(piece, 1):
            while (to := steps.get(state << 8 | byte)) is None and state:
                state = back[state]
            state = to or 0
            token = ends[state]
            while (start := end - length[token]) > 0:
                pair = last[start - 1] * size + token
                if pair not in fits:
                    if len(fits) > PAIRS:
                        fits.clear()
                    fits[pair] = bool(self.apart(np.array([last[start - 1]]), np.array([token]))[0])
                if fits[pair]:
                    break
                token = shorter[token]
            last.append(token)
        out, end = [], len(piece)
        while end:
            out.append(last[end - 1])
            end -= length[last[end - 1]]
        return self.ids[out[::-1]].tobytes()

    def _scalars(self) -> tuple:
        words = self.words
        if not hasattr(self, "_plain"):
            self._plain = (dict(zip(words.onward.keys.tolist(), words.onward.values.tolist())), words.back.tolist(), words.ends.tolist(), words.shorter.tolist(), self.length.tolist())
        return self._plain

    def _stretches(self, text: str) -> list[str]:
        """The text cut where a piece ends for certain, into stretches that are likely to come again."""
        if _LOOSE.search(text) or text[:1].isspace() or text[-1:].isspace():
            return PIECES.findall(text)
        # here a space always starts a piece
        runs = text.split(" ")
        return [runs[0], *[" " + run for run in runs[1:]]] if runs[0] else [" " + run for run in runs[1:]]

    def _learn(self, fresh: set[str]) -> None:
        """Put the ids of stretches that aren't known to ``known``, each distinct piece encoded once."""
        again = self.before.keys() & fresh
        self.known.update((run, self.before[run]) for run in again)
        cut: dict[str, list[str]] = {}
        new = set()
        for run in fresh - again:
            word = run[1:] if run[:1] == " " else run
            if word.isascii() and word.isalpha():
                new.add(run)
            elif word[-1:] in (",", ".") and word[:-1].isascii() and word[:-1].isalpha():
                cut[run] = [run[:-1], word[-1]]
            else:
                cut[run] = PIECES.findall(run)
        new = {*new, *(piece for pieces in cut.values() for piece in pieces)} - self.known.keys()
        short = [x for x in new if len(x) <= LONG // 4]
        for part in range(0, len(short), 50_000):
            self.known.update(zip(short[part : part + 50_000], self.encode_pieces([x.encode() for x in short[part : part + 50_000]])))
        self.known.update((x, self.encode_long(x.encode())) for x in new if len(x) > LONG // 4)
        self.known.update((run, b"".join([self.known[x] for x in pieces])) for run, pieces in cut.items() if len(pieces) > 1)

    def encode_all(self, texts: list[str], special: bool = True) -> list[np.ndarray]:
        """The ids of texts; a special token's string in one is that token, or with ``special`` off ordinary text."""
        rows: list[list] = []
        for text in texts:
            if special and self.cut_special is not None and any(s in text for s in self.special):
                rows.append([x for part in self.cut_special.split(text) if part for x in ([(part,)] if part in self.special else self._stretches(part))])
            else:
                rows.append(self._stretches(text) if text else [])
        if len(self.known) > KEPT:
            self.before, self.known = self.known, {}
        fresh = set().union(*rows).difference(self.known)
        if fresh:
            for content, k in self.special.items():
                self.known[(content,)] = np.array([k], "<u4").tobytes()
            self._learn({x for x in fresh if isinstance(x, str)})
        ids = self.known.__getitem__
        return [np.frombuffer(b"".join(map(ids, row)), "<u4") for row in rows]

    def encode(self, text: str, special: bool = True) -> np.ndarray:
        """encode_all of one text."""
        return self.encode_all([text], special)[0]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, special tokens included."""
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The codec of a vocabulary file, built once in a Python worker."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit, binary), n_tokens, decoded (text): every whole text encoded and decoded again.

    A null or empty text has no ids and decodes to the empty text. Repeated rows give repeated rows; an empty table gives
    none; other columns of the input are dropped. Work and memory of a task follow its Arrow batch, not the table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for one in small_batches(batch):
                ids = own.encode_all(one.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([one.column(0), pa.array([x.tobytes() for x in ids], pa.binary()), pa.array([len(x) for x in ids], pa.int64()), pa.array([own.decode(x) for x in ids], pa.string())], ["doc_id", "ids", "n_tokens", "decoded"])

    return whole(docs).mapInArrow(run, "doc_id long, ids binary, n_tokens long, decoded string")


def digest_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: digests of what encode_documents gives, row by row, in the same task.

    Nulls, empty texts, repeated rows and empty tables as there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for batch in batches:
            counts, of_ids, of_text = [], [], []
            for one in small_batches(batch):
                for ids in own.encode_all(one.column(1).to_pylist()):
                    counts.append(len(ids))
                    of_ids.append(sha(ids.tobytes()))
                    of_text.append(sha(own.decode(ids).encode()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return whole(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def small_batches(batch: pa.RecordBatch, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of at most so many bytes of text, or of one row."""
    _, offsets = texts_as_bytes(batch.column(1))
    for first, last in slices(offsets, size):
        yield batch.slice(first, last - first)
