"""Byte-pair encoding by dynamic programming over prefixes, and its decoding.

In a byte-pair encoding every prefix of a word has exactly one encoding, so it has exactly one last token. For each
prefix the tokens that end there are read off an automaton of suffix matches (the reversed tokens as a trie); a token
is the last one if it and the last token of the prefix before it could stand side by side, which is decided from the
merge order alone. The stored last tokens are back-pointers: followed from the end of a word they give its ids. No
merge loop runs. Words of a batch go through the programme side by side as numpy arrays.

The vocabulary is a ``tokenizers`` JSON file with word ends; it is read on the driver (its size is fixed by the file)
and sent to the tasks. Texts stream through ``mapInArrow`` without a shuffle, at most about 1 MB of words at a time, so
neither a long text nor a long table needs memory in proportion. A task remembers encoded words up to a fixed number.

Defined results: a null or blank text has no ids and decodes to an empty text; equal rows give equal results; an empty
table gives an empty one; other columns are left out, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelframe.llm.common import U64, Lookup, ragged, slices

VOCABULARY = "word_bpe_49k.json"
_PIECE_BYTES = 1 << 20
_REMEMBERED = 600_000
_LANES_UP_TO = 48
_NEVER = 1 << 30


def vocabulary_path() -> str:
    """Where the public vocabulary file of this machine lies."""
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


class Vocabulary:
    """Tokens, merges and the automaton of suffix matches."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        ids, end = model["vocab"], model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}")
        self.strings = {i: s for s, i in (ids | self.special).items()}
        size = max(self.strings) + 1
        shown = byte_characters()
        self.inner = np.array([ids[c] for c in shown], np.int32)
        self.final = np.array([ids[c + end] for c in shown], np.int32)
        self.rank, self.left, self.right = np.full(size, -1), np.full(size, -1), np.full(size, -1)
        self.pairs: dict[tuple[int, int], int] = {}
        symbols = {int(i): (int(i),) for i in (*self.inner, *self.final)}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            x, y, t = ids[a], ids[b], ids[a + b]
            self.pairs[x, y] = rank
            if t not in symbols and x in symbols and y in symbols and self.side_by_side(x, y, rank):
                symbols[t] = symbols[x] + symbols[y]
                self.rank[t], self.left[t], self.right[t] = rank, x, y
        self.length = np.zeros(size, np.int32)
        steps, self.ends_in = {}, [-1]
        for t, word in symbols.items():
            self.length[t], state = len(word), 0
            for s in reversed(word):
                state_of = state * size + s
                if (state := steps.setdefault(state_of, len(self.ends_in))) == len(self.ends_in):
                    self.ends_in.append(-1)
            self.ends_in[state] = t
        self.size, self.ends_in = size, np.array(self.ends_in, np.int32)
        self.steps, self.states = Lookup(np.fromiter(steps, U64)), np.fromiter(steps.values(), np.int32)

    def side_by_side(self, x: int, y: int, before: int = _NEVER) -> bool:
        """Whether no merge of earlier rank than ``before`` joins ``x`` and ``y`` across their border.

        The merges that made the two are undone, latest first. At each step the pieces at the border existed at the
        same time until the merge just undone; a pair of an earlier rank would have been joined instead. Of equal
        ranks the left place comes first.
        """
        rank, limit = self.rank, before
        while True:
            if self.pairs.get((x, y), _NEVER) < limit:
                return False
            if rank[x] > rank[y]:
                limit, x = int(rank[x]), int(self.right[x])
            elif rank[y] < 0:
                return True
            else:
                limit, y = int(rank[y]) + 1, int(self.left[y])


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself if printable, else one from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Encoder:
    """Encodes words in batches and remembers them."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.pattern = regex.compile(f"{vocabulary.pattern}|\n")
        self.special = regex.compile("(" + "|".join(map(regex.escape, vocabulary.special)) + ")")
        self.marks = [s.encode() for s in vocabulary.special]
        self.shown = [vocabulary.strings.get(i, "").encode() for i in range(vocabulary.size)]
        self.tested_keys, self.tested = np.full(1 << 20, -1, np.int64), np.zeros(1 << 20, bool)
        self.forget()

    def forget(self) -> None:
        self.index: dict[bytes, int] = {}
        self.text: list[bytes] = []
        self.ids, self.start, self.count = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def __call__(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, bytes]]:
        """The ids and the decoded text of every text; both are parts of a whole that starts and ends at a blank."""
        split = [t.split() for t in texts]
        if len(self.index) > _REMEMBERED:
            self.forget()
        new = list({w for words in split for w in words} - self.index.keys())
        if new:
            self._learn(new)
        get, shown = self.index.__getitem__, self.text.__getitem__
        for words in split:
            at = np.fromiter(map(get, words), np.int64, len(words))
            yield self.ids[ragged(self.start[at], self.count[at])], b" ".join(filter(None, map(shown, at.tolist())))

    def _learn(self, words: list[bytes]) -> None:
        together, marked = b" ".join(words), []
        if any(m in together for m in self.marks):
            marked = [w for w in words if any(m in w for m in self.marks)]
        plain = [w for w in words if not any(m in w for m in self.marks)] if marked else words
        flat, counts = self._encode([w.decode("utf-8", "replace") for w in plain])
        if marked:
            parts = [p for w in marked for p in (*filter(None, self.special.split(w.decode())), "")]
            part_ids, part_counts = self._encode(["" if p in self.v.special else p for p in parts])
            ends, own, sizes, more = np.cumsum(part_counts), [], [], 0
            for p, stop, n in zip(parts, ends.tolist(), part_counts.tolist()):
                got = [self.v.special[p]] if p in self.v.special else part_ids[stop - n:stop].tolist()
                own += got
                more += len(got)
                if not p:
                    sizes.append(more)
                    more = 0
            flat = np.concatenate([flat, np.array(own, np.uint32)])
            counts = np.concatenate([counts, np.array(sizes, np.int64)])
        base = len(self.index)
        starts = np.cumsum(counts) - counts
        shown, tokens, at = self.shown, flat.tolist(), 0
        for n, w in zip(counts.tolist(), plain + marked):
            self.index[w] = base
            base += 1
            self.text.append(b" ".join([shown[t] for t in tokens[at:at + n]]))
            at += n
        self.start = np.concatenate([self.start, starts + len(self.ids)])
        self.count = np.concatenate([self.count, counts])
        self.ids = np.concatenate([self.ids, flat])

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words after another, and how many each has."""
        if not words:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        text = unicodedata.normalize("NFC", "\n".join(words)).replace("Σ", "σ").lower()
        pieces = self.pattern.findall(text)
        owner = np.cumsum(np.fromiter((p == "\n" for p in pieces), np.int64, len(pieces)))
        real = np.fromiter((p != "\n" for p in pieces), bool, len(pieces))
        coded = [p.encode() for p in pieces if p != "\n"]
        lengths = np.fromiter(map(len, coded), np.int64, len(coded))
        raw = np.frombuffer(b"".join(coded), np.uint8)
        symbols = self.v.inner[raw]
        last = np.cumsum(lengths) - 1
        symbols[last] = self.v.final[raw[last]]
        flags, tokens = self._programme(symbols, last - lengths + 1, lengths)
        per_piece = np.add.reduceat(flags, last - lengths + 1, dtype=np.int64) if len(coded) else np.zeros(0, np.int64)
        counts = np.bincount(owner[real], weights=per_piece, minlength=len(words)).astype(np.int64)
        return tokens[flags].astype(np.uint32), counts

    def _programme(self, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every symbol: whether an encoding's token ends there, and the last token of the prefix up to it."""
        v, last = self.v, np.full(len(symbols), -1, np.int64)
        flags = np.zeros(len(symbols), bool)
        order = np.argsort(-lengths, kind="stable")
        long = int(np.searchsorted(-lengths[order], -_LANES_UP_TO))
        for w in order[:long].tolist():
            self._one(symbols, last, int(starts[w]), int(lengths[w]))
        order = order[long:]
        start, length = starts[order], lengths[order]
        for i in range(int(length[0]) if len(length) else 0):
            lanes = int(np.searchsorted(-length, -i))
            at = start[:lanes] + i
            state, alive, found = np.zeros(lanes, np.int64), np.arange(lanes), []
            for depth in range(i + 1):
                step = v.steps(state[alive] * v.size + symbols[at[alive] - depth])
                alive = alive[step >= 0]
                if not len(alive):
                    break
                state[alive] = v.states[step[step >= 0]]
                token = v.ends_in[state[alive]]
                found.append((alive[token >= 0], token[token >= 0]))
            for lane, token in reversed(found):
                free = last[at[lane]] < 0
                lane, token = lane[free], token[free]
                before = at[lane] - v.length[token]
                whole = before < start[lane]
                fits = whole | self._fit(np.where(whole, 0, last[np.maximum(before, 0)]), token, ~whole)
                last[at[lane[fits]]] = token[fits]
        at, open_ = starts + lengths - 1, np.arange(len(starts))
        while len(open_):
            flags[at[open_]] = True
            at[open_] -= v.length[last[at[open_]]]
            open_ = open_[at[open_] >= starts[open_]]
        return flags, last

    def _fit(self, x: np.ndarray, y: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Whether the tokens can stand side by side; tests are remembered by a hash of the pair."""
        key = x * self.v.size + y
        slot = (key.astype(U64) * U64(0x9E3779B97F4A7C15) >> U64(44)).astype(np.int64)
        miss = wanted & (self.tested_keys[slot] != key)
        out = self.tested[slot] & wanted
        if miss.any():
            keys, inverse = np.unique(key[miss], return_inverse=True)
            tests = np.array([self.v.side_by_side(*divmod(k, self.v.size)) for k in keys.tolist()], bool)
            out[miss] = tests[inverse]
            slots = (keys.astype(U64) * U64(0x9E3779B97F4A7C15) >> U64(44)).astype(np.int64)
            self.tested_keys[slots] = keys
            self.tested[slots] = tests
            # of several pairs with one slot the arrays hold the last in both
        return out

    def _one(self, symbols: np.ndarray, last: np.ndarray, start: int, length: int) -> None:
        """The same for one long word, whose positions cannot be shared with others."""
        v, done = self.v, {}
        word = symbols[start:start + length].tolist()
        out: list[int] = []
        for i in range(length):
            state, choice = 0, -1
            for depth in range(i + 1):
                step = done.get((state, word[i - depth]))
                if step is None:
                    at = int(v.steps(np.array([state * v.size + word[i - depth]], U64))[0])
                    step = done[state, word[i - depth]] = int(v.states[at]) if at >= 0 else -1
                if step < 0:
                    break
                state, token = step, int(v.ends_in[step])
                if token >= 0 and (depth == i or v.side_by_side(out[i - depth - 1], token)):
                    choice = token
            out.append(choice)
        last[start:start + length] = out


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text cut at blanks into pieces of about a megabyte; a word is never cut."""
    blank, at = regex.compile(rb"[\x20\x09-\x0D]"), 0
    while at < len(text):
        cut = blank.search(text, min(len(text), at + _PIECE_BYTES))
        stop = cut.start() if cut else len(text)
        yield text[at:stop]
        at = stop


def _coded(vocabulary, with_ids: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(vocabulary.value)
        for batch in batches:
            for part in slices(batch, 1, _PIECE_BYTES):
                texts = [b"" if t is None else t for t in part.column(1).cast(pa.binary()).to_pylist()]
                rows = [[(i, d) for p in _pieces(t) for i, d in encode([p])] for t in texts] \
                    if len(texts) == 1 else [[r] for r in encode(texts)]
                ids = [np.concatenate([i for i, _ in r] or [np.zeros(0, np.uint32)]) for r in rows]
                plain = [b" ".join(d for _, d in r if d) for r in rows]
                columns = [part.column(0), pa.array([len(i) for i in ids], pa.int64()),
                           pa.array([hashlib.sha256(i.astype("<u4").tobytes()).hexdigest() for i in ids]),
                           pa.array([hashlib.sha256(d).hexdigest() for d in plain])]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    columns.append(pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)
    return run


def encode_decode(docs: DataFrame, path: str | None = None, with_ids: bool = False, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_tokens, ids_sha256, decoded_sha256`` and, if wanted, ``ids``.

    ``ids_sha256`` is over little-endian 32-bit ids, ``decoded_sha256`` over the decoded text.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary(path or vocabulary_path()))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" \
        + (", ids array<int>" if with_ids else "")
    return rows.mapInArrow(_coded(vocabulary, with_ids), schema)


def decode(ids: list[int], vocabulary: Vocabulary) -> str:
    """The text that ids stand for: the tokens as the vocabulary writes them, joined by blanks."""
    return " ".join(vocabulary.strings[i] for i in ids)
