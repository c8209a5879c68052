"""Benchmark passages in documents, re-parameterised ones too: typed templates, hashed windows, consistent slots."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlight.llm.common import Placed, bounded_batches, placed, stored, texts

# The author's choice: words that count as units of measure, and spelled-out numbers.
UNITS = (
    "%", "$", "€", "£", "cent", "cents", "cm", "day", "days", "degree", "degrees", "dollar", "dollars", "euro", "euros", "feet", "foot", "ft", "g", "gram",
    "grams", "h", "hour", "hours", "hr", "hrs", "inch", "inches", "kg", "kilogram", "kilograms", "kilometer", "kilometers", "kilometre", "kilometres", "km",
    "lb", "lbs", "liter", "liters", "litre", "litres", "m", "meter", "meters", "metre", "metres", "mg", "mile", "miles", "min", "minute", "minutes", "ml",
    "mm", "month", "months", "mph", "ounce", "ounces", "oz", "percent", "pound", "pounds", "s", "sec", "second", "seconds", "ton", "tons", "week", "weeks",
    "yard", "yards", "year", "years",
)
NUMBER_WORDS = (
    "zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve", "thirteen", "fourteen", "fifteen", "sixteen",
    "seventeen", "eighteen", "nineteen", "twenty", "thirty", "forty", "fifty", "sixty", "seventy", "eighty", "ninety", "hundred", "thousand", "million",
    "dozen", "half", "twice",
)
_CACHED_WORDS = 300_000
_WINDOW = "h long, size int, at int, slots array<string>"
_ITEM_WINDOW = f"{_WINDOW}, upto int, begin int, end int, head boolean, tail boolean"
_LITERAL, _NUMBER, _UNIT, _NAME = 0, 1, 2, 3


class _Codes(dict):
    """Number of a word, learned when it is first seen."""

    def __init__(self, learn) -> None:
        super().__init__()
        self.learn = learn

    def __missing__(self, word: bytes) -> int:
        k = self[word] = self.learn(word)
        return k


class Templates:
    """Template tokens of texts: words in lower case, with numbers, units and names as typed placeholders.

    A word loses the marks around it; one of marks alone is no token. A number is one of digits (with $ before or % after), or spelled out (parts joined
    by hyphens too). A name is a word with a capital first letter that is not all capitals. The first word of a sentence is
    taken for one as well, as nothing tells a name from another word there; its slot holds the word, so verbatim copies
    agree. A run of words of one type without a mark in between is one slot.
    """

    def __init__(self) -> None:
        import re

        import xxhash

        self.marks = bytes(b for b in range(128) if not chr(b).isalnum() and chr(b) not in "$%")
        self.number = re.compile(rb"\$?[0-9][0-9.,]*%?$").match
        self.digest = xxhash.xxh3_64_intdigest
        self.units = {u.encode() for u in UNITS}
        self.spelled = {w.encode() for w in NUMBER_WORDS}
        self.slot_hash = np.array([0, *(self.digest(b"slot%d" % kind, 1) for kind in (_NUMBER, _UNIT, _NAME)), 0], np.uint64)
        self.forget()

    def forget(self) -> None:
        self.index = _Codes(self._learn)
        self.core: list[bytes] = []
        # by word: hash of its token, hash of the word itself, type (-1: no token), marks before (1) and after (2)
        self.hash, self.exact = np.empty(_CACHED_WORDS * 2, np.uint64), np.empty(_CACHED_WORDS * 2, np.uint64)
        self.kind, self.edge = np.empty(_CACHED_WORDS * 2, np.int8), np.empty(_CACHED_WORDS * 2, np.uint8)
        self.new: tuple[list, list, list] = ([], [], [])  # (exact, kind, edge) of words not in the arrays yet

    def _learn(self, word: bytes) -> int:
        core = word.strip(self.marks)
        shown = core if core.isascii() else core.decode("utf-8", "replace")
        lower = shown.lower() if shown is core else shown.lower().encode()
        if not core:
            kind = -1
        elif (core[0] < 58 and self.number(core)) or lower in self.spelled or (b"-" in lower and self.spelled.issuperset(lower.split(b"-"))):
            kind = _NUMBER
        elif lower in self.units:
            kind = _UNIT
        else:
            kind = _NAME if shown[:1].isupper() and not (len(shown) > 1 and shown.isupper()) else _LITERAL
        exact, kinds, edges = self.new
        exact.append(self.digest(lower))
        kinds.append(kind)
        edges.append(0 if len(core) == len(word) else (word[:1] != core[:1]) + 2 * (word[-1:] != core[-1:]))
        self.core.append(lower)
        return len(self.core) - 1

    def _keep_new(self) -> None:
        """Words learned one by one go into the arrays together."""
        exact, kinds, edges = self.new
        begin, end = len(self.core) - len(exact), len(self.core)
        while end > len(self.hash):  # one text of very many words
            self.hash, self.exact, self.kind, self.edge = (np.concatenate([x, np.empty_like(x)]) for x in (self.hash, self.exact, self.kind, self.edge))
        self.exact[begin:end], self.kind[begin:end], self.edge[begin:end] = exact, kinds, edges
        kind = self.kind[begin:end]
        self.hash[begin:end] = np.where(kind == _LITERAL, self.exact[begin:end], self.slot_hash[kind])
        self.new = ([], [], [])

    def tokens(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hash, type, word) of every token, and the first token of every slot or literal; ``word`` indexes ``core``."""
        if len(self.core) > _CACHED_WORDS:
            self.forget()
        words = text.split()
        codes = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        if not len(codes):
            return np.empty(0, np.uint64), np.empty(0, np.int8), codes, codes
        if self.new[0]:
            self._keep_new()
        hashes, kind, edge = self.hash[codes], self.kind[codes], self.edge[codes]
        first = np.ones(len(codes), bool)
        first[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _LITERAL) | ((edge[:-1] & 2) | (edge[1:] & 1)).astype(bool)
        if kind.min() < 0:
            real = kind >= 0
            hashes, kind, codes, first = hashes[real], kind[real], codes[real], first[real]
        return hashes, kind, codes, np.flatnonzero(first)

    @staticmethod
    def windows(hashes: np.ndarray, size: int) -> np.ndarray:
        """Hash of every window of ``size`` tokens: windows of 1, 2, 4, ... tokens, each from two of the ones before, put together
        by the binary digits of ``size``."""
        n = len(hashes) - size + 1
        if n <= 0:
            return np.empty(0, np.uint64)
        out, begin, length = None, 0, 1
        while True:
            if size & length:
                part = hashes[begin : begin + n]
                out = part if out is None else Templates.joined(out, part)
                begin += length
            length *= 2
            if length > size:
                return Templates.joined(out, np.uint64(size))
            hashes = Templates.joined(hashes[: len(hashes) - length // 2], hashes[length // 2 :])

    @staticmethod
    def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = a * np.uint64(0x9E3779B97F4A7C15)
        out += b
        out ^= out >> np.uint64(31)
        return out

    def keyed(self, hashes: np.ndarray, kind: np.ndarray, word: np.ndarray, first: np.ndarray, size: int, literal: int) -> tuple[np.ndarray, np.ndarray]:
        """(at, hash) of windows of ``size`` slots and literals with at least ``literal`` literals, or of -``size`` tokens with fewer.

        The latter are hashed with the words in their slots, so they meet equal words only. ``at`` counts slots and literals in
        the former, tokens in the latter.
        """
        if size > 0 and len(first) < len(hashes):
            hashes, kind = hashes[first], kind[first]
        n = len(hashes) - abs(size) + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        literals = np.zeros(len(kind) + 1, np.int32)
        np.cumsum(kind == _LITERAL, out=literals[1:])
        held = literals[abs(size) :] - literals[:n]
        if size > 0:
            out = self.windows(hashes, size)
            at = np.flatnonzero(held >= min(literal, size))
            return at, out if len(at) == n else out[at]
        at = np.flatnonzero(held < min(literal, -size))
        out, exact = np.full(len(at), -size, np.uint64), self.exact[word]
        for k in range(-size):
            out = (out ^ exact[at + k]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(31)
        return at, out

    def slots(self, kind: np.ndarray, word: np.ndarray, edges: np.ndarray, at: int, size: int) -> list[str]:
        """Words of the slots of a window; ``edges`` are the first tokens of all, and the end."""
        if size < 0:
            return [self.core[word[i]].decode("utf-8", "replace") for i in range(at, at - size) if kind[i] != _LITERAL]
        spans = [(edges[j], edges[j + 1]) for j in range(at, at + size) if kind[edges[j]] != _LITERAL]
        return [b" ".join(self.core[w] for w in word[i:j]).decode("utf-8", "replace") for i, j in spans]


def _item_windows(window: int, literal: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates()
        for batch in batches:
            rows: list[tuple] = []
            for item, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                h, kind, word, first = templates.tokens(text)
                edges, slot = np.append(first, len(h)), np.searchsorted(first, np.arange(len(h)), "right") - 1
                for size in (min(window, len(first)), -min(window, len(h))) if len(h) else ():
                    at, x = templates.keyed(h, kind, word, first, size, literal)
                    for i, v in zip(at.tolist(), x.view(np.int64).tolist(), strict=True):
                        begin, end = (int(edges[i]), int(edges[i + size])) if size > 0 else (i, i - size)
                        head, tail = size > 0 and begin <= 1 and bool(kind[begin] != _LITERAL), size > 0 and end == len(h) and bool(kind[end - 1] != _LITERAL)
                        rows.append((item, len(h), v, size, int(slot[begin]), templates.slots(kind, word, edges, i, size), int(slot[end - 1]) + 1, begin, end, head, tail))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 11
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.string()), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_()]
            names = ["item_id", "item_tokens", "h", "size", "at", "slots", "upto", "begin", "end", "head", "tail"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

    return run


def _document_windows(sizes: list[int], wanted: dict[int, np.ndarray] | None, literal: int):
    """Windows of documents that are in ``wanted`` (sorted hashes by size), or all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates()
        mask = np.uint64((1 << 22) - 1)
        bits = {}
        for size, keys in (wanted or {}).items():
            bits[size] = np.zeros(1 << 22, bool)
            bits[size][(keys & mask).astype(np.int64)] = True
        for batch in batches:
            rows: list[tuple] = []
            for uid, doc, text in zip(batch.column("uid").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                h, kind, word, first = templates.tokens(text)
                edges = np.append(first, len(h))
                for size in sizes:
                    at, x = templates.keyed(h, kind, word, first, size, literal)
                    if wanted is not None:
                        may = np.flatnonzero(bits[size][(x & mask).astype(np.int64)])
                        keys = wanted[size]
                        may = may[keys[np.minimum(np.searchsorted(keys, x[may]), len(keys) - 1)] == x[may]]
                        at, x = at[may], x[may]
                    slot = at if size > 0 else np.searchsorted(first, at, "right") - 1
                    rows.extend((uid, doc, v, size, j, templates.slots(kind, word, edges, i, size)) for i, j, v in zip(at.tolist(), slot.tolist(), x.view(np.int64).tolist(), strict=True))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["uid", "doc_id", "h", "size", "at", "slots"])

    return run


def leaks(
    docs: DataFrame | Placed,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 8,
    literal: int = 4,
    least: float = 0.5,
    broadcast_windows: int = 1_000_000,
    drift: int = 8,
) -> DataFrame:
    """(uid, doc_id, item_id, covered, item_tokens, coverage, changed) of documents that hold at least ``least`` of an item.

    Both sides become template tokens; windows of ``window`` slots and literals (a whole item, if it has fewer) are joined by
    hash. One of tokens with fewer than ``literal`` literal ones says too little as a template, so its slots must hold equal
    words: such a part of an item is found as it stands, not re-parameterised. Its ``size`` is negative inside. Matched windows
    on one alignment of document and item must fill the item's slots by one rule: a value of the item always gets the
    same value in the document; what stands beside the item in the same run is cut off. A word more or less moves the
    alignment, so those that differ by up to ``drift`` slots and literals are joined, the longest first, as long as one rule
    holds. ``covered`` counts the item's tokens under such windows, in the best union; ``changed`` says that some slot holds
    another value, so the question is re-parameterised.

    The item side is broadcast while it holds at most ``broadcast_windows`` windows, which is counted first, and document
    windows are then filtered as they are made; beyond that all windows meet in a shuffled join. Null and empty texts and
    items match nothing; repeated documents are reported each, repeated items under each id.
    """
    docs = placed(docs)
    bounded_batches(docs.df.sparkSession)
    items = texts(benchmark, item_col, item_text_col)
    wanted = stored(items.mapInArrow(_item_windows(window, literal), f"item_id long, item_tokens int, {_ITEM_WINDOW}"))
    counts = {r["size"]: r["n"] for r in wanted.groupBy("size").agg(F.count("*").alias("n")).collect()}
    small = sum(counts.values()) <= broadcast_windows
    keys = None
    if small:
        keys = {size: [] for size in counts}
        for r in wanted.select("size", "h").distinct().collect():
            keys[r["size"]].append(r["h"])
        keys = {size: np.sort(np.array(v, np.int64).view(np.uint64)) for size, v in keys.items()}
    found = texts(docs, id_col, text_col).mapInArrow(_document_windows(sorted(counts), keys, literal), f"uid long, doc_id long, {_WINDOW}")
    side = wanted.select("item_id", "item_tokens", "h", "size", "upto", "begin", "end", "head", "tail", F.col("at").alias("item_at"), F.col("slots").alias("item_slots"))
    met = found.join(F.broadcast(side) if small else side, ["h", "size"])
    pairs = F.expr("""transform(arrays_zip(item_slots, slots), (p, i) -> named_struct('a', p.item_slots, 'b', CASE
        WHEN tail AND i = size(slots) - 1 AND startswith(p.slots, concat(p.item_slots, ' ')) THEN p.item_slots
        WHEN head AND i = 0 AND endswith(p.slots, concat(' ', p.item_slots)) THEN p.item_slots ELSE p.slots END))""")
    key = ["uid", "doc_id", "item_id", "item_tokens"]
    aligned = met.groupBy(*key, (F.col("at") - F.col("item_at")).alias("shift")).agg(
        F.collect_set(F.struct("begin", "end", F.col("item_at").alias("i"), F.col("upto").alias("j"), "at")).alias("spans"), F.array_distinct(F.flatten(F.collect_set(pairs))).alias("filled")
    )

    def under(spans: str, begin: str, end: str) -> str:
        step = "named_struct('n', x.n + greatest(p.end - greatest(x.end, p.begin), 0), 'end', greatest(x.end, p.end))"
        ordered = f"array_sort(transform({spans}, s -> named_struct('begin', {begin}, 'end', {end})))"
        return f"aggregate({ordered}, named_struct('n', 0, 'end', 0), (x, p) -> {step}, x -> x.n)"

    def covered(spans: str) -> str:
        # a passage of the document stands for one passage of the item only
        again = f"{under(spans, 's.i', 's.j')} - {under(spans, 's.at', 's.at + s.j - s.i')}"
        return f"{under(spans, 's.begin', 's.end')} - greatest({again}, 0)"

    def one_rule(filled: str) -> str:
        return f"size(array_distinct(transform({filled}, p -> p.a))) = size({filled})"

    # two rows of buckets, so that any two alignments within drift share one
    buckets = F.expr(f"array(2 * floor(shift / {2 * drift}), 2 * floor((shift + {drift}) / {2 * drift}) + 1)") if drift else F.array("shift")
    alone = aligned.filter(F.expr(one_rule("filled"))).withColumn("covered", F.expr(covered("spans")))
    near = alone.withColumn("bucket", F.explode(buckets)).groupBy(*key, "bucket").agg(F.sort_array(F.collect_list(F.struct("covered", "shift", "spans", "filled")), asc=False).alias("near"))
    both = "array_distinct(concat(x.filled, y.filled))"
    joined = f"""transform(near, a -> aggregate(near, named_struct('spans', a.spans, 'filled', a.filled), (x, y) -> CASE
        WHEN abs(y.shift - a.shift) <= {drift} AND {one_rule(both)} THEN named_struct('spans', array_union(x.spans, y.spans), 'filled', {both}) ELSE x END))"""
    single = "transform(near, a -> named_struct('spans', a.spans, 'filled', a.filled))"
    judged = f"transform(concat({single}, {joined}), x -> named_struct('covered', {covered('x.spans')}, 'same', not exists(x.filled, p -> p.a <> p.b)))"
    best = near.select(*key, F.array_max(F.expr(judged)).alias("x")).groupBy(*key).agg(F.max("x").alias("x"))
    out = best.select("uid", "doc_id", "item_id", F.col("x.covered").alias("covered"), "item_tokens", F.round(F.col("x.covered") / F.col("item_tokens"), 6).alias("coverage"), (~F.col("x.same")).alias("changed"))
    return out.filter(F.col("coverage") >= least)


def without_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns. Rows are told apart by file and row
    number; a frame that is not read from files is written once."""
    docs = placed(docs)
    hit = leaks(docs, benchmark, **options).select("uid").distinct()
    return docs.whole().join(hit, "uid", "left_anti").select("row.*")
