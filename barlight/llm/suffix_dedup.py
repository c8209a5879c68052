"""Repeated 50-byte strings across documents, by a distributed merge sort of front-coded suffix runs with loser trees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlight.llm.common import Placed, bounded_batches, cut, fingerprint, placed, stored, stretches, texts

LENGTH = 50  # bytes of a string that counts
GRAM = 24  # bytes of an anchor
SPAN = LENGTH - GRAM + 1  # grams in a string, of which the smallest hash is its anchor
BUCKET = 1 << 17  # anchors a bucket of the first exchange holds about
RUN = 1 << 17  # suffixes sorted in one run
HOT = 4096  # documents with one anchor from which its strings are dealt one by one
SEGMENT = 1 << 21  # bytes whose anchors are found at once
_ODD = np.uint64(0x9E3779B97F4A7C15)
_HOT_BIT = np.uint64(1 << 63)
_LAST = (1 << 63) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a * _ODD) ^ b
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def anchors(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, first, last, hash) of the anchors of the strings that begin at ``starts`` (ascending) in ``raw``.

    A string's anchor is its leftmost gram of smallest hash, so it follows from the string alone. ``first`` and ``last`` are
    the outermost of consecutive starts that have the anchor.
    """
    if not len(starts):
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    b = raw.astype(np.uint64) + np.uint64(1)
    h2 = _pair(b[:-1], b[1:])
    h4 = _pair(h2[:-2], h2[2:])
    h8 = _pair(h4[:-4], h4[4:])
    h16 = _pair(h8[:-8], h8[8:])
    h = _pair(h16[: len(h8) - 16], h8[16:])
    low = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    for step in (1, 2, 4, 8):
        low = np.minimum(low[:-step], low[step:])
    low = np.minimum(low[: len(low) - (SPAN - 16)], low[SPAN - 16 :])
    place = (low[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.concatenate([[True], (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)])
    at = np.flatnonzero(new)
    return place[at], starts[at], starts[np.append(at[1:], len(starts)) - 1], h[place[at]]


def _segments(raws: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, starts, row of each start, offset of a buffer place in its row's text) of a batch, some texts at a time.

    A text longer than a segment goes in pieces that overlap by one byte less than a string, so each string is in one piece.
    """
    parts: list[tuple[int, int, bytes]] = []
    held = 0
    for row, raw in enumerate(raws):
        for low in range(0, max(0, len(raw) - LENGTH + 1), SEGMENT):
            piece = raw[low : low + SEGMENT + LENGTH - 1]
            parts.append((row, low, piece))
            held += len(piece)
            if held >= SEGMENT:
                yield _joined(parts)
                parts, held = [], 0
    if parts:
        yield _joined(parts)


def _joined(parts: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    raw = np.frombuffer(b"".join(p for _, _, p in parts), np.uint8)
    sizes = np.array([len(p) for _, _, p in parts])
    begin = np.cumsum(sizes) - sizes
    valid = np.ones(len(raw), bool)
    for b, n in zip(begin.tolist(), sizes.tolist(), strict=True):
        valid[b + n - LENGTH + 1 : b + n] = False
    starts = np.flatnonzero(valid)
    which = np.repeat(np.arange(len(parts)), sizes - LENGTH + 1)
    rows = np.array([r for r, _, _ in parts])[which]
    shift = (np.array([low for _, low, _ in parts]) - begin)[which]
    return raw, starts, rows, shift


def _codes(h: np.ndarray, buckets: int) -> np.ndarray:
    """An anchor as bucket and 32 bits of hash: one code stands for two anchors seldom, which costs work and no result."""
    g = _mix(h)
    return (((g >> np.uint64(40)) % np.uint64(buckets)) << np.uint64(32)) | (g & np.uint64(0xFFFFFFFF))


def _raw(batch: pa.RecordBatch) -> list[bytes]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def _pack(values: np.ndarray) -> bytes:
    """Numbers for the exchange: byte planes, so that equal high bytes lie together, compressed."""
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes())


def _unpack(packed: bytes, kind: type) -> np.ndarray:
    import zstandard

    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _unpacked(table: pa.Table, column: str, kind: type) -> list[np.ndarray]:
    return [_unpack(x, kind) for x in table.column(column).to_pylist()]


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed for an exchange."""
    import zstandard

    packer = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        packed = pa.array([packer.compress(t) for t in _raw(batch)], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], packed], names=batch.schema.names)


def _plain(packed: list[bytes]) -> list[bytes]:
    import zstandard

    unpacker = zstandard.ZstdDecompressor()
    return [unpacker.decompress(t) for t in packed]


def _post(buckets: int):
    """mapInArrow function: anchors of many documents, packed by bucket as 32 hash bits (their steps) and a row number from ``base`` on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, held = None, 0
        codes: list[np.ndarray] = []
        rows: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            c, r = np.concatenate(codes), np.concatenate(rows).astype(np.uint16)
            order = np.argsort(c)
            c, r = c[order], r[order]
            same = np.concatenate([[False], (c[1:] == c[:-1]) & (r[1:] == r[:-1])])
            c, r = c[~same], r[~same]
            own, at, ends = stretches(c >> np.uint64(32))
            codes.clear(), rows.clear()
            steps = np.diff(c, prepend=c[:1])
            steps[at] = c[at]
            packed = [pa.array([_pack(x[i:j]) for i, j in zip(at, ends, strict=True)], pa.binary()) for x in (steps.astype(np.uint32), r)]
            return pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(np.full(len(own), base), pa.int64()), *packed], names=["bucket", "base", "c", "r"])

        for batch in batches:
            uid, raws, at = batch.column("uid").to_numpy(), _raw(batch), 0
            while at < len(uid):
                far = uid[at:] - (uid[at] if base is None else base)
                near = (far >= 0) & (far < 1 << 16)  # a new file starts elsewhere
                n = len(near) if near.all() else int(near.argmin())
                if base is not None and (held >= 1 << 21 or not n):
                    if codes:
                        yield flush()
                    base, held = None, 0
                    continue
                base = int(uid[at]) if base is None else base
                for raw, starts, row, _ in _segments(raws[at : at + n]):
                    place, first, _, h = anchors(raw, starts)
                    codes.append(_codes(h, buckets))
                    rows.append(far[row[np.searchsorted(starts, first)]])
                    held += len(place)
                at += n
        if codes:
            yield flush()

    return run


def _shared(table: pa.Table) -> pa.Table:
    """Of one bucket: the anchors that two rows or more have, packed by the rows' base."""
    bases = table.column("base").to_numpy()
    c = [np.cumsum(x, dtype=np.uint32) for x in _unpacked(table, "c", np.uint32)]
    base = np.repeat(bases, [len(x) for x in c])
    c, r = np.concatenate(c), np.concatenate(_unpacked(table, "r", np.uint16))
    order = np.argsort(c, kind="stable")
    c, r, base = c[order], r[order], base[order]
    at = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
    n = np.repeat(np.diff(np.append(at, len(c))), np.diff(np.append(at, len(c))))
    code = (np.uint64(table.column("bucket")[0].as_py()) << np.uint64(32)) | c.astype(np.uint64)
    code = np.where(n > HOT, code | _HOT_BIT, code)
    keep = n > 1
    code, r, base = code[keep], r[keep], base[keep]
    order = np.argsort(base, kind="stable")
    code, r, base = code[order], r[order], base[order]
    own, at, ends = stretches(base)
    packed = {n: pa.array([_pack(x[i:j]) for i, j in zip(at, ends, strict=True)], pa.binary()) for n, x in (("r", r), ("code", code))}
    return pa.table({"base": pa.array(own)} | packed)


def _by_row(table: pa.Table) -> pa.Table:
    """Of one base: the shared anchors of each row, sorted."""
    base = table.column("base")[0].as_py()
    r, code = np.concatenate(_unpacked(table, "r", np.uint16)), np.concatenate(_unpacked(table, "code", np.uint64))
    order = np.lexsort((code & ~_HOT_BIT, r))
    r, code = r[order], code[order]
    own, at, ends = stretches(r)
    return pa.table({"uid": pa.array(own.astype(np.int64) + base), "codes": cut(code, at, ends)})


_RUN_FIELDS = "bucket int, n int, lcp binary, size binary, tails binary, lsize binary, lefts binary, ord binary, uid binary, at binary"
_RUN_NAMES = [f.split()[0] for f in _RUN_FIELDS.split(", ")]


def _packed_spans(uid: np.ndarray, start: np.ndarray, size: np.ndarray, groups: int) -> list[tuple]:
    """Rows that carry spans on to the group of their documents; the first field of a run row is minus the group and one."""
    g = (_mix(uid.astype(np.uint64)) >> np.uint64(20)) % np.uint64(groups)
    order = np.argsort(g, kind="stable")
    uid, start, size, g = uid[order], start[order], size[order], g[order]
    own, at, ends = stretches(g)
    return [(int(k), *(_pack(x[i:j].astype(kind)) for x, kind in ((uid, np.int64), (start, np.int64), (size, np.uint8)))) for k, i, j in zip(own, at, ends, strict=True)]


def _runs(buckets: int, groups: int):
    """mapInArrow function: sorted, front-coded runs of the suffixes at shared anchors, one row a bucket and run.

    A suffix is the text from its anchor on, as far as a string with this anchor reaches; the text before the anchor travels
    along, as far back as such strings reach. Of equal suffixes with equal text before only those of the smallest document
    travel: the others are repeats already, and their spans go out as rows of their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        count = 0

        def flush() -> pa.RecordBatch:
            bucket, key, ord_, uid, at = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            order = np.argsort(ord_, kind="stable")
            whole = np.concatenate([bucket.astype(">u4").view(np.uint8).reshape(-1, 4), key], axis=1)
            flat = np.ascontiguousarray(whole).view(f"S{whole.shape[1]}").ravel()
            order = order[np.argsort(flat[order], kind="stable")]
            whole, ord_, uid, at, bucket = whole[order], ord_[order], uid[order], at[order], bucket[order]
            fresh = np.concatenate([[True], (whole[1:] != whole[:-1]).any(1)])
            lead = ord_[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
            again = ord_ > lead
            size, lsize = whole[:, 4 + LENGTH], whole[:, -1]
            rows: list[tuple] = []
            if again.any():  # every string of the anchor is covered
                spans = _packed_spans(uid[again], at[again] - lsize[again], lsize[again].astype(np.int64) + size[again], groups)
                rows += [(-1 - k, 0, None, s, None, None, None, None, u, a) for k, u, a, s in spans]
            keep = ~again
            whole, ord_, uid, at, bucket, size, lsize = whole[keep], ord_[keep], uid[keep], at[keep], bucket[keep], size[keep], lsize[keep]
            right, left = whole[:, 4 : 4 + LENGTH], whole[:, 5 + LENGTH : -1]
            differ = right[1:] != right[:-1]
            lcp = np.where(differ.any(1), differ.argmax(1), LENGTH)
            lcp = np.concatenate([[0], np.minimum(lcp, np.minimum(size[1:], size[:-1]))])
            own, first, stop = stretches(bucket)
            lcp[first] = 0
            place = np.arange(LENGTH)[None, :]
            in_tail = (place >= lcp[:, None]) & (place < size[:, None])
            tails, tail_ends = right[in_tail], np.concatenate([[0], np.cumsum(size - lcp)])
            in_left = np.arange(left.shape[1])[None, :] < lsize[:, None]
            lefts, left_ends = left[in_left], np.concatenate([[0], np.cumsum(lsize.astype(np.int64))])
            for k, i, j in zip(own.tolist(), first, stop, strict=True):
                own_tails, own_lefts = tails[tail_ends[i] : tail_ends[j]], lefts[left_ends[i] : left_ends[j]]
                rows.append((k, int(j - i), *map(_pack, (lcp[i:j].astype(np.uint8), size[i:j], own_tails, lsize[i:j], own_lefts, ord_[i:j], uid[i:j], at[i:j]))))
            types = [pa.int32(), pa.int32(), *[pa.binary()] * 8]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=_RUN_NAMES)

        for batch in batches:
            uids, ords = batch.column("uid").to_numpy(), batch.column("ord").to_numpy()
            wanted = [np.frombuffer(x, np.uint64) for x in batch.column("codes").to_pylist()]
            for raw, starts, row, shift in _segments(_plain(batch.column("text").to_pylist())):
                place, first, last, h = anchors(raw, starts)
                at = np.searchsorted(starts, first)
                row, shift, code = row[at], shift[at], _codes(h, buckets)
                hit, hot = np.zeros(len(code), bool), np.zeros(len(code), bool)
                for r in np.unique(row).tolist():
                    i, j = np.searchsorted(row, [r, r + 1])
                    known = wanted[r] & ~_HOT_BIT
                    k = np.minimum(np.searchsorted(known, code[i:j]), len(known) - 1)
                    hit[i:j] = known[k] == code[i:j]
                    hot[i:j] = (wanted[r][k] & _HOT_BIT) > 0
                padded = np.concatenate([raw, np.zeros(LENGTH, np.uint8)])
                usual = hit & ~hot
                made = [(place[usual], first[usual], last[usual], code[usual] >> np.uint64(32), row[usual], shift[usual])]
                if (hit & hot).any():  # strings one by one, each dealt by its own hash
                    some = np.flatnonzero(hit & hot)
                    n = last[some] - first[some] + 1
                    start = np.repeat(first[some] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                    grams = padded[start[:, None] + np.arange(LENGTH)].astype(np.uint64)
                    powers = np.cumprod(np.full(LENGTH, _ODD, np.uint64))
                    made.append((start, start, start, _mix((grams * powers).sum(1, dtype=np.uint64)) % np.uint64(buckets), np.repeat(row[some], n), np.repeat(shift[some], n)))
                for p, lo, hi, b, r, s in made:
                    if not len(p):
                        continue
                    size, lsize = hi + LENGTH - p, p - lo
                    right = padded[p[:, None] + np.arange(LENGTH)] * (np.arange(LENGTH)[None, :] < size[:, None])
                    back = np.arange(1, SPAN)
                    left = padded[np.maximum(p[:, None] - back, 0)] * (back[None, :] <= lsize[:, None])
                    key = np.concatenate([right, size[:, None], left, lsize[:, None]], axis=1).astype(np.uint8)
                    held.append((b.astype(np.uint32), key, ords[r], uids[r], p + s))
                    count += len(p)
                    if count >= RUN:
                        yield flush()
                        count = 0
        if held:
            yield flush()

    return run


def merge(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[tuple[int, int]], list[int]]:
    """Merge sorted runs (strings, common prefix with the one before): ((run, place) in order, common prefix with the one before).

    A loser tree: each inner node keeps the loser of its match and the prefix it shares with the last string put out. Of two
    strings the one that shares more with that string is the smaller, without a look at either; only on a tie are they
    compared, from that length on.
    """
    k = max(1, 1 << (len(runs) - 1).bit_length()) if runs else 0
    at, shared = [0] * k, [0] * k  # per run: next place, its prefix in common with the last string put out
    done = [i >= len(runs) or not runs[i][0] for i in range(k)]

    def beats(a: int, b: int) -> bool:
        """Whether run a's string comes first. The loser's prefix becomes the one it shares with the winner."""
        if done[a] or done[b]:
            return done[b]
        if shared[a] != shared[b]:
            return shared[a] > shared[b]
        h = shared[a]
        x, y = runs[a][0][at[a]][h:], runs[b][0][at[b]][h:]
        if x == y:
            both = len(x)
            first = a < b
        else:
            n = min(len(x), len(y))
            gap = int.from_bytes(x[:n]) ^ int.from_bytes(y[:n])
            both = n - (gap.bit_length() + 7) // 8
            first = x < y
        if first:
            shared[b] = h + both
        else:
            shared[a] = h + both
        return first

    tree = [0] * max(k, 1)
    level = list(range(k))
    base = k
    while base > 1:
        base //= 2
        nxt = []
        for i in range(base):
            a, b = level[2 * i], level[2 * i + 1]
            won = beats(a, b)
            tree[base + i] = b if won else a
            nxt.append(a if won else b)
        level = nxt
    order: list[tuple[int, int]] = []
    lcps: list[int] = []
    if not k:
        return order, lcps
    top = level[0]
    while not done[top]:
        place = at[top]
        order.append((top, place))
        lcps.append(shared[top])
        strings, own = runs[top]
        at[top] = place + 1
        if place + 1 < len(strings):
            shared[top] = own[place + 1]
        else:
            done[top] = True
        node = (top + k) >> 1
        while node:
            other = tree[node]
            if not beats(top, other):
                tree[node], top = top, other
            node >>= 1
    return order, lcps


def _repeats(groups: int):
    """applyInArrow function of one bucket: merge its runs, and find in the LCP intervals the strings of an earlier document."""

    def run(table: pa.Table) -> pa.Table:
        names = ["g", "uid", "start", "size"]
        if table.column("bucket")[0].as_py() < 0:  # spans that only pass
            rows = [(-1 - b, u, a, s) for b, u, a, s in zip(*(table.column(c).to_pylist() for c in ("bucket", "uid", "at", "size")), strict=True)]
        else:
            rows = _packed_spans(*_strings(table), groups)
        types = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        cols = zip(*rows, strict=True) if rows else [[]] * 4
        return pa.table([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

    return run


def _strings(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(uid, start, size) of spans covered by strings that an earlier document holds."""
    runs, offsets, total = [], [], 0
    cols = {c: [_unpack(x, np.uint8).tobytes() for x in table.column(c).to_pylist()] for c in ("lcp", "size", "tails", "lsize", "lefts")}
    cols |= {c: _unpacked(table, c, np.int64) for c in ("ord", "uid", "at")}
    for lcp, size, tails in zip(cols["lcp"], cols["size"], cols["tails"], strict=True):
        strings, before, i = [], b"", 0
        for h, n in zip(lcp, size, strict=True):
            before = before[:h] + tails[i : i + n - h]
            i += n - h
            strings.append(before)
        runs.append((strings, list(lcp)))
        offsets.append(total)
        total += len(strings)
    order, lcps = merge(runs)
    index = np.fromiter((offsets[r] + p for r, p in order), np.int64, total)
    join = lambda c, kind: np.concatenate([np.frombuffer(x, kind) for x in cols[c]])[index]
    size, lsize, ord_, uid, at = join("size", np.uint8).astype(np.int64), join("lsize", np.uint8).astype(np.int64), join("ord", np.int64), join("uid", np.int64), join("at", np.int64)
    raw_sizes = np.concatenate([np.frombuffer(x, np.uint8) for x in cols["lsize"]]).astype(np.int64)
    begin = (np.cumsum(raw_sizes) - raw_sizes)[index]
    lefts = np.concatenate([np.frombuffer(x, np.uint8) for x in cols["lefts"]] + [np.zeros(SPAN, np.uint8)])
    lcp = np.array(lcps, np.int64)
    before = np.zeros(total, np.uint64)  # hash of the text before the anchor, one byte longer each time
    covered: list[tuple[np.ndarray, np.ndarray]] = []
    for o in range(SPAN):
        if o:
            before = (before + lefts[np.minimum(begin + o - 1, len(lefts) - 1)].astype(np.uint64) + np.uint64(1)) * _ODD
            before ^= before >> np.uint64(29)
        has = np.flatnonzero((o >= LENGTH - size) & (o <= lsize))
        if not len(has):
            continue
        interval = np.cumsum(lcp < LENGTH - o)[has]
        rank = np.lexsort((ord_[has], before[has], interval))
        i, b, d = interval[rank], before[has][rank], ord_[has][rank]
        fresh = np.concatenate([[True], (i[1:] != i[:-1]) | (b[1:] != b[:-1])])
        least = d[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
        covered.append((has[rank[d > least]], np.full(int((d > least).sum()), o)))
    who, o = (np.concatenate(x) for x in zip(*covered, strict=True)) if covered else ((np.empty(0, np.int64),) * 2)
    if not len(who):
        return (np.empty(0, np.int64),) * 3
    rank = np.lexsort((-o, who))
    who, start = who[rank], (at[who] - o)[rank]
    new = np.concatenate([[True], (who[1:] != who[:-1]) | (start[1:] > start[:-1] + LENGTH)])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(who)) - 1
    return uid[who[first]], start[first], start[last] + LENGTH - start[first]


def _spans(table: pa.Table) -> pa.Table:
    """Of one group of documents: each one's maximal removed runs, as start and end pairs."""
    uid, start = (np.concatenate(_unpacked(table, c, np.int64)) for c in ("uid", "start"))
    end = start + np.concatenate(_unpacked(table, "size", np.uint8))
    order = np.lexsort((end, start, uid))
    uid, start, end = uid[order], start[order], end[order]
    rank = np.cumsum(np.concatenate([[0], uid[1:] != uid[:-1]]))
    stride = int(end.max()) + 2
    reach = np.maximum.accumulate(end + rank * stride)  # ends so far, of this document
    new = np.concatenate([[True], (start[1:] + rank[1:] * stride) > reach[:-1]])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(uid)) - 1
    pairs = np.stack([start[first], reach[last] - rank[last] * stride], axis=1)
    own, at, ends = stretches(uid[first])
    return pa.table({"uid": pa.array(own), "spans": cut(pairs, at, ends)})


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    for batch in batches:
        out = []
        for raw, spans in zip(_plain(batch.column("text").to_pylist()), batch.column("spans").to_pylist(), strict=True):
            pairs = np.frombuffer(spans or b"", np.int64).reshape(-1, 2)
            digest, done = hashlib.sha256(), 0
            for a, b in pairs.tolist():
                digest.update(raw[done:a])
                done = b
            digest.update(raw[done:])
            out.append((len(raw), int((pairs[:, 1] - pairs[:, 0]).sum()), len(pairs), digest.hexdigest()))
        n, gone, runs, sha = zip(*out, strict=True) if out else ((),) * 4
        names = ["uid", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        longs = [pa.array(x, pa.int64()) for x in (n, gone, runs)]
        yield pa.RecordBatch.from_arrays([batch.column("uid"), batch.column("doc_id"), *longs, pa.array(sha, pa.string())], names=names)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One span over the whole of each text."""
    for batch in batches:
        spans = [np.array([0, n], np.int64).tobytes() for n in batch.column("n").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("uid"), pa.array(spans, pa.binary())], names=["uid", "spans"])


def _copies(rows: DataFrame) -> DataFrame:
    """(uid, n) of rows whose whole text is in a row with a smaller doc_id, told by two 64-bit hashes.

    Firsts are counted before the shuffle and taken out by (text, doc_id), which few rows share, so a text that fills a third
    of the table gathers nowhere.
    """
    a, b = fingerprint(F.col("text"))
    marked = rows.select("uid", "ord", F.octet_length("text").cast("long").alias("n"), a.alias("a"), b.alias("b"))
    firsts = marked.groupBy("a", "b").agg(F.min("ord").alias("ord"))
    return stored(marked.join(firsts, ["a", "b", "ord"], "left_anti").select("uid", "n"))


def removed_spans(df: DataFrame | Placed, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(uid, spans): for rows with removed bytes the maximal removed runs, as little-endian 64-bit start and end pairs.

    A byte goes if a string of 50 bytes over it also starts in a row with a smaller doc_id. Strings lie within one text and
    are judged on the input. Rows of one doc_id do not remove from each other; a null doc_id counts as the largest.

    0. A text that a smaller doc_id holds too goes whole, and takes no part in what follows.
    1. Each string of 50 bytes has an anchor, its 24-byte gram of smallest hash; about one place in fourteen is one. Equal
       strings have equal anchors, so only anchors that two rows share matter: their hashes are exchanged in packed buckets
       and the shared ones return to their rows.
    2. The suffixes at shared anchors are sorted in runs, equal ones reduced to the smallest document, front-coded by the
       prefix in common with the suffix before, and exchanged by bucket.
    3. A loser tree merges a bucket's runs; it decides by known common prefixes and compares bytes only beyond them. In the
       merged order a string that starts o bytes before its anchor lies in one LCP interval of depth 50 - o; of the members
       whose o bytes before agree too, those of later documents are covered.
    4. The covered spans return to their documents and are united.

    Anchors with more than ``HOT`` rows are dealt string by string, each reduced in its run beforehand, so a passage in a
    third of all documents is spread like the rest. Buckets grow in number with the input, not in size.
    """
    df = placed(df)
    bounded_batches(df.df.sparkSession)
    rows = texts(df, id_col, text_col).select("uid", "doc_id", F.coalesce("doc_id", F.lit(_LAST)).alias("ord"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(32, -(-size // (13 * BUCKET)))
    posted = rows.select("uid", "text").mapInArrow(_post(buckets), "bucket int, base long, c binary, r binary")
    shared = posted.groupBy("bucket").applyInArrow(_shared, "base long, r binary, code binary")
    by_row = shared.groupBy("base").applyInArrow(_by_row, "uid long, codes binary")
    squeezed = rows.select("uid", "ord", "text").mapInArrow(_squeeze, "uid long, ord long, text binary")
    copies = _copies(rows)
    some = squeezed.join(by_row.join(copies, "uid", "left_anti"), "uid")
    runs = some.select("uid", "ord", "text", "codes").mapInArrow(_runs(buckets, buckets), _RUN_FIELDS)
    found = runs.groupBy("bucket").applyInArrow(_repeats(buckets), "g int, uid binary, start binary, size binary")
    whole = copies.filter(F.col("n") >= LENGTH).mapInArrow(_whole, "uid long, spans binary")
    return found.groupBy("g").applyInArrow(_spans, "uid long, spans binary").unionByName(whole)


def dedup_bytes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row, by ``removed_spans``. A null text counts as empty.

    Rows are told apart by file and row number; a frame that is not read from files is written once.
    """
    df = placed(df)
    spans = stored(removed_spans(df, id_col, text_col))
    squeezed = texts(df, id_col, text_col).mapInArrow(_squeeze, "uid long, doc_id long, text binary")
    rows = squeezed.join(spans, "uid", "left").select("uid", "doc_id", "text", "spans")
    return rows.mapInArrow(_keep, "uid long, doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string").drop("uid")
