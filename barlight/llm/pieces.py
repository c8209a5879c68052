"""SentencePiece encoding and decoding with numpy: equal-length words of a batch advance together.

A unigram model is segmented by Viterbi. A BPE model has merge ranks for scores, for which the best sum is not the model's
segmentation; its words take one best merge a step instead, in the same frame, and give the library's ids.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlight.llm.common import bounded_batches, texts

SPACE = "▁"
_UNIGRAM, _BPE = 1, 2
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_CACHED_WORDS = 100_000
_CELLS = 1 << 20  # cells of a step's matrix; more words of one length go in several parts
_LONG = 256  # characters from which a BPE word is merged by a queue of its own


@dataclass(frozen=True)
class Pieces:
    """A vocabulary as the encoder needs it; what it takes to run depends on the vocabulary file alone."""

    kind: int
    texts: tuple[str, ...]
    scores: np.ndarray
    types: np.ndarray
    dummy_prefix: bool


def load(path: str) -> Pieces:
    """Read a ``.model`` file. Models with a character map, user-defined pieces or other blank handling raise."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    with open(path, "rb") as f:
        return from_proto(proto.ModelProto.FromString(f.read()))


def from_proto(m) -> Pieces:
    n = m.normalizer_spec
    types = np.array([p.type for p in m.pieces])
    if m.trainer_spec.model_type not in (_UNIGRAM, _BPE) or n.precompiled_charsmap or n.remove_extra_whitespaces or not n.escape_whitespaces:
        raise ValueError("only unigram and BPE models that keep their text as it is")
    if not set(types) <= {_NORMAL, _UNKNOWN, _CONTROL, _BYTE} or any(SPACE in p.piece.lstrip(SPACE) or "\n" in p.piece for p in m.pieces if p.type == _NORMAL):
        raise ValueError("pieces must be plain, with blanks at their start only and without line ends")
    return Pieces(m.trainer_spec.model_type, tuple(p.piece for p in m.pieces), np.array([p.score for p in m.pieces], np.float32), types, n.add_dummy_prefix)


class Encoder:
    """Ids of texts and texts of ids. Distinct words are encoded once while they are cached."""

    def __init__(self, pieces: Pieces):
        self.p = pieces
        normal = np.flatnonzero(pieces.types == _NORMAL)
        self.normal = {pieces.texts[i]: int(i) for i in normal}
        self.unknown = int(np.flatnonzero(pieces.types == _UNKNOWN)[0])
        bytes_at = np.flatnonzero(pieces.types == _BYTE)
        self.byte_ids = {int(pieces.texts[i][3:5], 16): int(i) for i in bytes_at}
        self.raw = [bytes([int(t[3:5], 16)]) if k == _BYTE else b"" if k == _CONTROL else b" \xe2\x81\x87 " if k == _UNKNOWN else t.replace(SPACE, " ").encode() for t, k in zip(pieces.texts, pieces.types, strict=True)]
        self.forget()
        (self._prepare_viterbi if pieces.kind == _UNIGRAM else self._prepare_merges)()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        # ids of the words known, one after another, and where each word's begin
        self.flat, self.starts = np.empty(0, np.int64), np.zeros(1, np.int64)

    # words: no piece reaches over the start of a run of blanks or over a line end
    _words = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+").findall

    def encode(self, batch: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a batch in one array, and the number of ids of each text."""
        prefix = SPACE if self.p.dummy_prefix else ""
        words = [self._words(prefix + t.replace(" ", SPACE)) if t else [] for t in batch]
        if len(self.index) > _CACHED_WORDS:
            self.forget()
        new = list(set(chain.from_iterable(words)).difference(self.index))
        if new:
            parts = self._encode_words(new)
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))
            ends = self.starts[-1] + np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
            self.flat, self.starts = np.concatenate([self.flat, *parts]), np.concatenate([self.starts, ends])
        rows = np.fromiter(map(self.index.__getitem__, chain.from_iterable(words)), np.int64)
        begin = self.starts[rows]
        took = self.starts[rows + 1] - begin
        ends = np.cumsum(took)
        where = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - took), took)
        bounds = np.concatenate([[0], ends])
        docs = np.cumsum([0] + [len(doc) for doc in words])
        ids, sizes = self.flat[where], np.diff(bounds[docs])
        if not self.byte_ids:  # unknown characters in a row are one id
            text = np.repeat(np.arange(len(sizes)), sizes)
            again = np.zeros(len(ids), bool)
            again[1:] = (ids[1:] == self.unknown) & (ids[:-1] == self.unknown) & (text[1:] == text[:-1])
            ids, sizes = ids[~again], np.bincount(text[~again], minlength=len(sizes))
        return ids, sizes

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: byte pieces are joined to characters, blanks restored, the leading one taken off."""
        text = b"".join(map(self.raw.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.p.dummy_prefix and text[:1] == " " else text

    def _encode_words(self, words: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(words)
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by_length.setdefault(len(w), []).append(i)
        for length, members in by_length.items():
            if self.p.kind == _BPE and length > _LONG:
                for i in members:
                    out[i] = self._queue(words[i])
                continue
            step = max(1, _CELLS // length)
            for k in range(0, len(members), step):
                part = members[k : k + step]
                chars = np.frombuffer("".join(words[i] for i in part).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(part), length)
                for i, ids in zip(part, (self._viterbi if self.p.kind == _UNIGRAM else self._merge)(chars), strict=True):
                    out[i] = ids
        return out

    def _spell(self, char: int) -> list[int]:
        """Ids of a character without a piece: its bytes, or the unknown piece."""
        return [self.byte_ids[b] for b in chr(char).encode("utf-8", "surrogatepass")] if self.byte_ids else [self.unknown]

    # Unigram: Viterbi over sorted piece hashes.
    _BASE = np.uint64(0x9E3779B97F4A7C15)

    def _hashes(self, chars: np.ndarray, length: int) -> np.ndarray:
        """Hash of the substring of ``length`` that ends at every position, for all words; shape (words, L - length + 1)."""
        h = np.zeros((len(chars), chars.shape[1] - length + 1), np.uint64)
        for k in range(length):
            h = h * self._BASE + (chars[:, k : k + h.shape[1]].astype(np.uint64) + np.uint64(1))
        return h ^ (h >> np.uint64(29))

    def _prepare_viterbi(self) -> None:
        self.longest = max(map(len, self.normal))
        self.tables = {}
        by_length: dict[int, list[str]] = {}
        for t in self.normal:
            by_length.setdefault(len(t), []).append(t)
        for length, group in by_length.items():
            chars = np.frombuffer("".join(group).encode("utf-32-le"), np.uint32).reshape(len(group), length)
            keys = self._hashes(chars, length)[:, 0]
            order = np.argsort(keys)
            if len(np.unique(keys)) < len(keys):
                raise ValueError("two pieces share a hash")
            ids = np.array([self.normal[group[i]] for i in order])
            self.tables[length] = keys[order], ids, self.p.scores[ids]
        self.unknown_score = np.float32(self.p.scores[list(self.normal.values())].min() - np.float32(10))

    def _viterbi(self, chars: np.ndarray) -> list[np.ndarray]:
        n, length = chars.shape
        lengths = [k for k in sorted(self.tables, reverse=True) if k <= length]
        best = np.full((length + 1, n), -np.inf, np.float32)
        best[0] = 0
        took = np.zeros((length + 1, n), np.int32)
        which = np.full((length + 1, n), -1, np.int64)
        found = {}
        for k in lengths:
            keys, ids, scores = self.tables[k]
            h = self._hashes(chars, k)
            at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            hit = keys[at] == h
            found[k] = np.where(hit, scores[at], np.float32(-np.inf)), np.where(hit, ids[at], -1)
        for end in range(1, length + 1):
            usable = [k for k in lengths if k <= end]
            options = np.stack([best[end - k] + found[k][0][:, end - k] for k in usable] + [np.where(found[1][1][:, end - 1] < 0, best[end - 1] + self.unknown_score, -np.inf) if 1 in found else best[end - 1] + self.unknown_score])
            pick = options.argmax(0)  # the longest of equal ones
            best[end] = options[pick, np.arange(n)]
            sizes = np.array([*usable, 1])
            took[end] = sizes[pick]
            names = np.stack([found[k][1][:, end - k] for k in usable] + [np.full(n, -1)])
            which[end] = names[pick, np.arange(n)]
        out = []
        for r in range(n):
            ids, end = [], length
            while end:
                k = which[end, r]
                ids.extend([int(k)] if k >= 0 else reversed(self._spell(int(chars[r, end - 1]))))
                end -= took[end, r]
            out.append(np.array(ids[::-1], np.int64))
        return out

    # BPE: the best merge of each word, one a step, over sorted keys of symbol pairs.
    def _prepare_merges(self) -> None:
        self.symbols = dict(self.normal)
        for t in self.normal:
            for c in t:
                self.symbols.setdefault(c, len(self.p.texts) + len(self.symbols))
        self.span = max(self.symbols.values()) + 1
        merges = {}
        for t, i in self.normal.items():
            for k in range(1, len(t)):
                if (a := self.symbols.get(t[:k])) is not None and (b := self.symbols.get(t[k:])) is not None:
                    merges[a * self.span + b] = i
        self.pair_keys = np.array(sorted(merges), np.int64)
        self.pair_ids = np.array([merges[k] for k in self.pair_keys.tolist()], np.int64)
        self.pair_scores = self.p.scores[self.pair_ids]
        self.pairs = merges
        chars = sorted((ord(t), i) for t, i in self.symbols.items() if len(t) == 1)
        self.char_keys, self.char_ids = np.array([c for c, _ in chars], np.uint32), np.array([i for _, i in chars], np.int64)

    def _symbols_of(self, chars: np.ndarray) -> np.ndarray:
        """Symbol ids of characters; one that no piece has is minus itself and never merges."""
        at = np.minimum(np.searchsorted(self.char_keys, chars), len(self.char_keys) - 1)
        return np.where(self.char_keys[at] == chars, self.char_ids[at], -chars.astype(np.int64) - 1)

    def _probe(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = left * self.span + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        hit = (left >= 0) & (right >= 0) & (self.pair_keys[at] == keys)
        return np.where(hit, self.pair_scores[at], np.float32(-np.inf)), self.pair_ids[at]

    def _merge(self, chars: np.ndarray) -> list[np.ndarray]:
        """All words take their best merge at once; only the two pairs beside it are probed again."""
        state = self._symbols_of(chars)
        rows, out = np.arange(len(state)), [None] * len(state)
        scores, merged = self._probe(state[:, :-1], state[:, 1:])
        while len(rows):
            width = state.shape[1]
            if width > 1:
                pick = scores.argmax(1)  # the leftmost of equal ones
                live = scores[np.arange(len(rows)), pick] > -np.inf
            else:
                live = np.zeros(len(rows), bool)
            self._retire(rows[~live], state[~live], out)
            if width == 1:
                break
            rows, state, scores, merged, pick = rows[live], state[live], scores[live], merged[live], pick[live]
            here, at = np.arange(width - 1)[None, :], pick[:, None]
            state = np.where(here < at, state[:, :-1], np.where(here == at, merged, state[:, 1:]))
            before = here[:, :-1] < at
            scores, merged = np.where(before, scores[:, :-1], scores[:, 1:]), np.where(before, merged[:, :-1], merged[:, 1:])
            for shift in (-1, 0):
                k = np.flatnonzero((pick + shift >= 0) & (pick + shift < width - 2))
                j = pick[k] + shift
                scores[k, j], merged[k, j] = self._probe(state[k, j], state[k, j + 1])
        return out

    def _retire(self, rows: np.ndarray, states: np.ndarray, out: list) -> None:
        plain = ((states >= 0) & (states < len(self.p.texts))).all(1)
        for r, s, done in zip(rows.tolist(), states, plain.tolist(), strict=True):
            out[r] = s if done else self._ids(s)

    def _ids(self, symbols: np.ndarray) -> np.ndarray:
        """Piece ids of symbols, characters without a piece spelled out."""
        spelled = {i: t for t, i in self.symbols.items() if i >= len(self.p.texts)} if (symbols >= len(self.p.texts)).any() else {}
        out: list[int] = []
        for s in symbols.tolist():
            out.extend([s] if 0 <= s < len(self.p.texts) else self._spell(ord(spelled[s]) if s >= 0 else -s - 1))
        return np.array(out, np.int64)

    def _queue(self, word: str) -> np.ndarray:
        """One long word: a heap of merges over a linked list."""
        from heapq import heapify, heappop, heappush

        s = self._symbols_of(np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32)).tolist()
        after, before = [*range(1, len(s)), -1], [*range(-1, len(s) - 1)]
        score, pairs, span = self.p.scores, self.pairs, self.span

        def offer(i: int, j: int):
            m = pairs.get(s[i] * span + s[j]) if s[i] >= 0 and s[j] >= 0 else None
            return None if m is None else (-float(score[m]), i, s[i], s[j], m)

        heap = [o for i in range(len(s) - 1) if (o := offer(i, i + 1))]
        heapify(heap)
        while heap:
            _, i, left, right, m = heappop(heap)
            j = after[i]
            if s[i] != left or j < 0 or s[j] != right:
                continue
            s[i], s[j], after[i] = m, None, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (o := offer(a, b)):
                    heappush(heap, o)
        return self._ids(np.array([x for x in s if x is not None], np.int64))


def _encoded(pieces: Pieces, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        encoder = Encoder(pieces)
        for batch in batches:
            docs = [t or "" for t in batch.column("text").to_pylist()]
            flat, sizes = encoder.encode(docs)
            flat, ends = flat.astype("<i4"), np.cumsum(sizes)
            own = [flat[e - n : e] for e, n in zip(ends, sizes, strict=True)]
            back = [encoder.decode(ids) == t.replace(SPACE, " ") for ids, t in zip(own, docs, strict=True)]
            columns = [*batch.columns[:-1], pa.array(sizes, pa.int64()), pa.array([hashlib.sha256(ids.tobytes()).hexdigest() for ids in own]), pa.array(back)]
            names = [*batch.schema.names[:-1], "n_tokens", "ids_sha256", "round_trip"]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(flat, pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, round_trip, ids) of every row: the ids of its whole text, without begin or end pieces.

    ``ids_sha256`` is the hash of the ids as little-endian 32-bit integers; ``round_trip`` says that decoding them gives the
    text back (U+2581, the model's own sign for a blank, comes back as a blank). A null or empty text has no ids and comes
    back. Every text is encoded by itself: repeated rows stay, and nothing is shuffled.
    """
    bounded_batches(df.sparkSession)
    rows = texts(df, id_col, text_col).select("doc_id", "text")
    schema = "doc_id long, n_tokens long, ids_sha256 string, round_trip boolean" + ", ids array<int>" * with_ids
    return rows.mapInArrow(_encoded(load(path), with_ids), schema)
