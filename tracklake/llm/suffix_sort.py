"""Suffix order and common prefixes of a shard by induced sorting on disk-backed queues.

A shard is a list of byte strings, none empty. Its text, suffix types, queues and sorted buckets live in files
of a scratch folder of the task; memory holds pieces of bounded size, plus the ranks of the
left-most-S suffixes (about a third of the text's length).

Induction visits suffixes in sorted order; each hands its predecessor, as a tuple (position,
common prefix with the tuple before it), to the queue of the predecessor's first byte. Tuples
arrive in order, so a queue per byte is a priority queue by (byte, rank). The common prefix
of two tuples is one more than the least common prefix among the suffixes visited between
their sources, kept as a running minimum per byte.

The left-most-S suffixes are sorted first: one induction from text order sorts their substrings,
equal substrings share a name, and the string of names is sorted in turn by ranking
pairs of names twice as far apart in each recursion until all differ in what the limit covers.
"""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np

LIMIT = 100
#: Tuples handled at a time, and tuples that the queues keep in memory together.
PIECE = 1 << 18
HELD = 1 << 21


class Queues:
    """A first-in-first-out queue of (position, common prefix) per byte; the longest goes to disk when memory is full."""

    def __init__(self, folder: Path, held: int, place: type):
        self.folder, self.held, self.place, self.size = folder, held, place, 0
        self.parts: list[list] = [[] for _ in range(256)]
        self.sizes = np.zeros(256, np.int64)
        self.read = [0] * 256
        folder.mkdir()

    def push(self, byte: int, position: np.ndarray, prefix: np.ndarray) -> None:
        self.parts[byte].append((position, prefix))
        self.sizes[byte] += len(position)
        self.size += len(position)
        while self.size > self.held:
            self._spill(int(self.sizes.argmax()))

    def _spill(self, byte: int) -> None:
        for i, name in enumerate("pc"):
            with open(self.folder / f"{byte}{name}", "ab") as f:
                for part in self.parts[byte]:
                    part[i].tofile(f)
        self.size -= int(self.sizes[byte])
        self.parts[byte], self.sizes[byte] = [], 0

    def pop(self, byte: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All tuples of a byte, also those pushed meanwhile, in pieces."""
        while True:
            path = self.folder / f"{byte}p"
            width = np.dtype(self.place).itemsize
            done = path.stat().st_size // width if path.exists() else 0
            if self.read[byte] < done:
                at, n = self.read[byte], min(PIECE, done - self.read[byte])
                self.read[byte] += n
                yield np.fromfile(path, self.place, n, offset=width * at), np.fromfile(self.folder / f"{byte}c", np.uint8, n, offset=at)
            elif self.parts[byte]:
                parts, self.parts[byte] = self.parts[byte], []
                self.size -= int(self.sizes[byte])
                self.sizes[byte] = 0
                position, prefix = (np.concatenate(x) for x in zip(*parts, strict=True))
                for at in range(0, len(position), PIECE):
                    yield position[at : at + PIECE], prefix[at : at + PIECE]
            else:
                path.unlink(missing_ok=True)
                (self.folder / f"{byte}c").unlink(missing_ok=True)
                return


class Buckets:
    """The visited suffixes of one kind, by byte, in files."""

    def __init__(self, folder: Path, place: type):
        self.folder, self.place = folder, place
        folder.mkdir()

    def add(self, byte: int, position: np.ndarray, prefix: np.ndarray) -> None:
        for name, data in (("p", position), ("c", prefix)):
            with open(self.folder / f"{byte}{name}", "ab") as f:
                data.tofile(f)

    def pieces(self, byte: int, backwards: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pieces of a byte's suffixes, from the last one on if ``backwards`` (inside a piece too)."""
        path = self.folder / f"{byte}p"
        width = np.dtype(self.place).itemsize
        n = path.stat().st_size // width if path.exists() else 0
        starts = range(0, n, PIECE)
        for at in reversed(starts) if backwards else starts:
            k = min(PIECE, n - at)
            p, c = np.fromfile(path, self.place, k, offset=width * at), np.fromfile(self.folder / f"{byte}c", np.uint8, k, offset=at)
            yield (p[::-1], c[::-1]) if backwards else (p, c)


class Shard:
    def __init__(self, strings: Iterator[bytes], folder: str, held: int = HELD, limit: int = LIMIT):
        self.folder, self.held, self.limit = Path(folder), held, limit
        ends, at = [], 0
        with open(self.folder / "text", "wb") as f:
            for s in strings:
                f.write((np.frombuffer(s, np.uint8) + 1).tobytes() + b"\0")  # UTF-8 holds no byte 255
                at += len(s) + 1
                ends.append(at - 1)
            f.write(b"\0" * (limit + 16))
        self.n, self.ends = at, np.array(ends, np.int64)
        self.text = np.asarray(np.memmap(self.folder / "text", np.uint8, "r"))  # on disk still, without the overhead of a subclass
        self._words = np.lib.stride_tricks.sliding_window_view(self.text, 8)
        self.place = np.int32 if self.n < 1 << 31 else np.int64
        self.until = np.asarray(np.memmap(self.folder / "until", np.uint16, "w+", shape=(self.n,)))
        for i in range(0, len(self.ends), PIECE):
            ends = self.ends[i : i + PIECE]
            begin = self.ends[i - 1] + 1 if i else 0
            lengths = np.diff(np.append(begin - 1, ends))
            self.until[begin : ends[-1] + 1] = np.minimum(np.repeat(ends, lengths) - np.arange(begin, ends[-1] + 1), 65535)
        self._types()
        self._runs = 0

    def _types(self) -> None:
        """Type S (true) or L of every suffix: a byte decides by the next different one."""
        self.is_s = np.asarray(np.memmap(self.folder / "types", bool, "w+", shape=(self.n,)))
        later = True  # the last sentinel
        for stop in range(self.n, 0, -PIECE):
            start = max(0, stop - PIECE)
            step = np.diff(self.text[start : stop + 1].astype(np.int16))
            at = np.where(step != 0, np.arange(len(step)), len(step))
            at = np.minimum.accumulate(at[::-1])[::-1]
            kinds = np.append(step > 0, later)
            if stop == self.n:
                kinds[-2:] = True
                at[-1] = len(step)
            self.is_s[start:stop] = kinds[at]
            later = bool(self.is_s[start])

    def common(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | int) -> np.ndarray:
        """Common prefix of the suffixes at ``a`` and ``b``, at most ``limit`` and 65,535; sentinels all differ."""
        most = np.minimum(np.minimum(self.until[a], self.until[b]), limit).astype(np.int64)
        out, live, at = most.copy(), np.arange(len(a)), 0
        while len(live):
            differ = self._words[a[live] + at] != self._words[b[live] + at]
            some = differ.any(axis=1)
            out[live[some]] = np.minimum(most[live[some]], at + differ[some].argmax(axis=1))
            at += 8
            live = live[~some]
            live = live[most[live] > at]
        return out

    def _visit(self, position, prefix, running, queues: Queues, want_s: bool) -> None:
        """Hand the predecessors of type ``want_s`` to their queues."""
        before = position - self.place(1)
        ok = before >= 0
        ok[ok] = self.is_s[before[ok]] == want_s
        byte = np.where(ok, self.text[before], 0)  # a sentinel is never handed on
        at = np.flatnonzero(byte)
        if not len(at):
            np.minimum(running, prefix.min(), out=running)
            return
        order = at[np.argsort(byte[at], kind="stable")]
        heads = np.flatnonzero(np.diff(byte[order], prepend=0))
        untouched = np.ones(256, bool)
        for lo, hi in zip(heads, [*heads[1:], len(order)], strict=True):
            k, c = order[lo:hi], int(byte[order[lo]])
            least = np.minimum.reduceat(prefix[: k[-1] + 1], np.concatenate(([0], k[:-1] + 1)))
            first = running[c] < 0  # nothing was handed to this byte yet
            least = np.minimum(least.astype(np.int16) + 1, self.limit)
            least[0] = 0 if first else min(least[0], running[c] + 1)
            queues.push(c, before[k], least.astype(np.uint8))
            tail = prefix[k[-1] + 1 :]
            running[c] = tail.min() if len(tail) else 255
            untouched[c] = False
        np.minimum(running, np.where(untouched, prefix.min(), 255), out=running)

    def induce(self, lms: np.ndarray, prefix: np.ndarray) -> tuple[Buckets, Buckets]:
        """L suffixes in ascending and S suffixes in descending order, from the left-most-S suffixes in order."""
        self._runs += 1
        base = self.folder / f"run{self._runs}"
        base.mkdir()
        low, high = Buckets(base / "low", self.place), Buckets(base / "high", self.place)
        heads = np.searchsorted(self.text[lms], np.arange(257)) if len(lms) else np.zeros(257, np.int64)
        queues, running = Queues(base / "up", self.held, self.place), np.full(256, -1, np.int16)
        for c in range(256):
            last = None
            for p, x in queues.pop(c):
                low.add(c, p, x)
                self._visit(p, x, running, queues, False)
                last = p[-1]
            for at in range(heads[c], heads[c + 1], PIECE):
                p, x = lms[at : min(at + PIECE, heads[c + 1])], prefix[at : min(at + PIECE, heads[c + 1])].copy()
                if at == heads[c]:
                    x[0] = 0 if last is None or c == 0 else self.common(np.array([last]), p[:1], self.limit)[0]
                self._visit(p, x, running, queues, False)
        queues, running = Queues(base / "down", self.held, self.place), np.full(256, -1, np.int16)
        for c in range(255, 0, -1):
            last = None
            for p, x in queues.pop(c):
                high.add(c, p, x)
                self._visit(p, x, running, queues, True)
                last = p[-1]
            behind = None
            for p, x in low.pieces(c, backwards=True):
                # x holds the prefix with the smaller neighbour; going down it belongs to the next one
                first = behind if behind is not None else (0 if last is None else self.common(np.array([last]), p[:1], self.limit)[0])
                behind = x[-1]
                self._visit(p, np.concatenate((np.array([first], np.uint8), x[:-1])), running, queues, True)
        return low, high

    def _settle(self, rank: np.ndarray, at: np.ndarray, step: int) -> None:
        """Rank the tied names ``at``, in rank order, by what stands ``step`` names on, then twice as far.

        ``step`` names hold at least 2 ``step`` bytes; what ties beyond the limit stays in place.
        """
        if not len(at) or step > self.limit:
            return
        key = rank[at] * (len(rank) + 1) + rank[np.minimum(at + step, len(rank) - 1)]
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        old = rank[at]
        new_group, new_name = np.append(True, old[1:] != old[:-1]), np.append(True, key[1:] != key[:-1])
        here = np.arange(len(at))
        rank[at] += np.maximum.accumulate(np.where(new_name, here, 0)) - np.maximum.accumulate(np.where(new_group, here, 0))
        self._settle(rank, at[~new_name | ~np.append(new_name[1:], True)], 2 * step)

    def sorted_lms(self) -> tuple[np.ndarray, np.ndarray]:
        lms = (np.flatnonzero(self.is_s[1:] & ~self.is_s[:-1]) + 1).astype(self.place)
        if not len(lms):
            return lms, np.zeros(0, np.uint8)
        _, high = self.induce(lms[np.argsort(self.text[lms], kind="stable")], np.zeros(len(lms), np.uint8))
        found = [self.ends.astype(self.place)]
        for c in range(1, 256):
            for p, _ in high.pieces(c, backwards=True) if c else ():
                found.append(p[(p > 0) & ~self.is_s[p - 1]])
        shutil.rmtree(self.folder / "run1")
        # pieces of a byte come from its last on, each backwards: ascending over all
        order = np.concatenate(found)
        length = np.append(np.diff(lms), 1)
        place = np.searchsorted(lms, order)
        a, b = order[:-1], order[1:]
        same = (length[place[:-1]] == length[place[1:]]) & (self.text[a] > 0)
        at = np.flatnonzero(same)
        span = length[place[at]] + 1
        same[at] = self.common(a[at], b[at], span) == span
        rank = np.empty(len(lms), np.int64)
        head = np.append(True, ~same)
        rank[place] = np.maximum.accumulate(np.where(head, np.arange(len(lms)), 0))
        self._settle(rank, place[~head | ~np.append(head[1:], True)], 1)
        out = lms[np.argsort(rank, kind="stable")]
        prefix = np.zeros(len(out), np.uint8)
        if len(out) > 1:
            prefix[1:] = self.common(out[:-1], out[1:], self.limit)
        return out, prefix

    def suffixes(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(position, common prefix with the suffix before, at most ``limit``) of all suffixes in order, in pieces."""
        low, high = self.induce(*self.sorted_lms())
        for c in range(1, 256):
            last = None
            for p, x in low.pieces(c):
                yield p, x
                last = p[-1]
            behind = None
            for p, x in high.pieces(c, backwards=True):
                # x holds the prefix with the larger neighbour
                if behind is None:
                    first = 0 if last is None else self.common(np.array([last]), p[:1], self.limit)[0]
                else:
                    first = behind
                behind = x[-1]
                yield p, np.concatenate((np.array([first], np.uint8), x[:-1]))


def repeats(strings: Iterator[bytes], held: int = HELD, limit: int = LIMIT) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Groups of equal ``limit``-byte substrings: (string number, offset) of all members, a group's rows in a row, ids beside.

    Yields (rows, groups): rows is (k, 2), groups numbers the group of each row.
    """
    with tempfile.TemporaryDirectory(prefix="suffixes-") as folder:
        shard = Shard(strings, folder, held, limit)
        waiting, number = np.zeros(0, shard.place), 0
        for position, prefix in shard.suffixes():
            starts = np.flatnonzero(prefix < limit)
            if not len(starts):
                waiting = np.concatenate((waiting, position))
                continue
            # groups that end in this piece; the last one may go on
            group = np.concatenate((np.zeros(len(waiting), np.int64), np.cumsum(prefix < limit)))
            every = np.concatenate((waiting, position))
            done = group < group[-1]
            waiting = every[~done]
            yield from _members(shard, every[done], group[done] + number)
            number += int(group[-1])
        yield from _members(shard, waiting, np.full(len(waiting), number))


def _members(shard: Shard, position: np.ndarray, group: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    same = group[1:] == group[:-1]
    many = np.append(same, False) | np.append(False, same) if len(group) else np.zeros(0, bool)
    position, group = position[many], group[many]
    if len(position):
        string = np.searchsorted(shard.ends, position)
        begin = np.append(0, shard.ends[:-1] + 1)[string]
        yield np.stack((string, position - begin), axis=1), group
