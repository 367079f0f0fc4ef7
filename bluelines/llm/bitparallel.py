"""Edit distances of strings: the best place of a pattern, bit-parallel on Python integers (one machine-independent bit vector
per pattern), and the distance of two strings up to a limit, by diagonals, one pair or many at once."""

from __future__ import annotations

import numpy as np

CELLS = 1 << 16  # places on diagonals that are held at once


def positions(pattern: str) -> dict[str, int]:
    """For each character the bit mask of its places in ``pattern``."""
    out: dict[str, int] = {}
    for k, c in enumerate(pattern):
        out[c] = out.get(c, 0) | 1 << k
    return out


def best_occurrence(masks: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """(smallest edit distance of the pattern to any piece of ``text``, end of the first such piece)."""
    ones, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = ones, 0, m  # places where a column of the distance table rises or falls by one
    best, end = m, 0
    get = masks.get
    for k, c in enumerate(text, 1):
        equal = get(c, 0)
        across = (((equal & up) + up) ^ up) | equal
        right_up = down | (ones & ~(across | up))
        right_down = up & across
        if right_up & top:
            score += 1
        elif right_down & top:
            score -= 1
            if score < best:
                best, end = score, k
        right_up, right_down = right_up << 1 & ones, right_down << 1 & ones
        vertical = equal | down
        up = right_down | (ones & ~(vertical | right_up))
        down = right_up & vertical
    return best, end


def _common(a: str, b: str, i: int = 0, j: int = 0) -> int:
    """Length of the common prefix of ``a[i:]`` and ``b[j:]``, by slices that double and then halve."""
    begin, stop, size = i, min(len(a), len(b) - j + i), 16
    j -= i
    while i + size <= stop and a[i:i + size] == b[i + j:i + j + size]:
        i += size
        size *= 2
    while size > 1:
        size //= 2
        if i + size <= stop and a[i:i + size] == b[i + j:i + j + size]:
            i += size
    return i - begin


def banded_distance(a: str, b: str, limit: int) -> int:
    """Edit distance of two strings, ``limit + 1`` if it is larger. Only how far each diagonal gets with so many edits is kept
    (after Ukkonen and Landau, Vishkin): equal stretches are passed by comparing slices, so a pair takes about as many steps as
    the square of the limit, not its length times the band."""
    if len(a) < len(b):
        a, b = b, a
    goal = len(a) - len(b)  # the diagonal of the last characters
    if goal > limit:
        return limit + 1
    start = _common(a, b)  # common ends cost nothing
    a, b = a[start:], b[start:]
    end = _common(a[::-1], b[::-1])
    a, b = a[:len(a) - end], b[:len(b) - end]
    if not b:
        return min(len(a), limit + 1)
    n, m = len(a), len(b)
    reach = {}  # diagonal: the first characters of ``a`` that are matched on it with the edits so far
    for edits in range(limit + 1):
        left, now = limit - edits, {}
        for d in range(max(-edits, goal - left), min(edits, goal + left) + 1):
            i = 0 if not edits else max(reach.get(d, -2) + 1, reach.get(d - 1, -2) + 1, reach.get(d + 1, -2))
            i = min(i, n, m + d)
            if i < 0:
                continue
            if i < n and i - d < m and a[i] == b[i - d]:
                i += _common(a, b, i, i - d)
            if d == goal and i == n:
                return edits
            now[d] = i
        reach = now
    return limit + 1


class Texts:
    """Texts as one array, to decide for many pairs at once which are within a limit."""

    def __init__(self, texts: list[str]):
        self.size = np.array([len(t) for t in texts], np.int64)
        self.start = np.cumsum(self.size) - self.size
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        top = int(points.max(initial=0))
        kind = np.dtype("<u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4")
        self.wide, self.per = kind.itemsize, 8 // kind.itemsize  # bytes of a character, characters compared at once
        padded = np.zeros(len(points) + 8, kind)
        padded[:len(points)] = points
        self.words = np.ndarray(len(points) + 1, "<u8", padded, strides=(self.wide,))  # the next ``per`` characters of each place
        if len(points) < 1 << 22:
            self.words = np.ascontiguousarray(self.words)

    def _equal(self, differ: np.ndarray) -> np.ndarray:
        """How many characters are equal before the first difference of words."""
        low = np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)) // np.uint8(8 * self.wide)
        return low.astype(np.int64)

    def _common(self, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Lengths of the equal stretches from the places ``x`` and ``y`` on, at most ``most``."""
        differ = self.words[x] ^ self.words[y]
        out = np.minimum(self._equal(differ), most)
        todo, width, end = np.flatnonzero((differ == 0) & (out < most)), 4, len(self.words) - 1
        while len(todo):
            step, on = max(1, CELLS // width), []
            for k in (todo[a:a + step] for a in range(0, len(todo), step)):
                ahead = out[k, None] + np.arange(width) * self.per
                differ = self.words[np.minimum(x[k, None] + ahead, end)] ^ self.words[np.minimum(y[k, None] + ahead, end)]
                nth = (differ != 0).argmax(1)
                last = differ[np.arange(len(k)), nth]
                out[k] += np.where(last == 0, width * self.per, nth * self.per + self._equal(last))
                on.append(k[(last == 0) & (out[k] < most[k])])
            todo, width = np.concatenate(on), min(512, width * 4)
        return np.minimum(out, most)

    def within(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Whether the texts ``a`` and ``b`` are at most ``limit`` edits apart, as ``banded_distance`` <= ``limit``."""
        out = np.zeros(len(a), bool)
        order = np.argsort(limit, kind="stable")
        while len(order):
            n = max(1, CELLS // (2 * int(limit[order[0]]) + 3))
            n = min(n, max(1, int(np.searchsorted(limit[order[:n]], 2 * limit[order[0]], "right"))))
            pairs, order = order[:n], order[n:]
            out[pairs] = self._within(a[pairs], b[pairs], limit[pairs])
        return out

    def _within(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
        swap = self.size[a] < self.size[b]
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        out, most = np.zeros(len(a), bool), int(limit.max())
        pair = np.flatnonzero(self.size[a] - self.size[b] <= limit)
        a, b, limit = a[pair], b[pair], limit[pair]
        x, y, n, m = self.start[a], self.start[b], self.size[a], self.size[b]
        goal = n - m  # the diagonal of the last characters
        reach = np.full((len(pair), 2 * most + 3), -2, np.int64)  # by diagonal: the characters of ``a`` matched with the edits so far
        reach[:, most + 1] = self._common(x, y, m)
        done = (goal == 0) & (reach[:, most + 1] == n)
        for edits in range(1, most + 1):
            out[pair[done]] = True
            stays = ~done & (limit >= edits)
            if not stays.all():
                pair, x, y, n, m, goal, limit, reach = (c[stays] for c in (pair, x, y, n, m, goal, limit, reach))
            if not len(pair):
                return out
            low, high, d = most + 1 - edits, most + 2 + edits, np.arange(-edits, edits + 1)
            i = np.maximum(np.maximum(reach[:, low:high], reach[:, low - 1:high - 1]) + 1, reach[:, low + 1:high + 1])
            i = np.minimum(i, np.minimum(n[:, None], m[:, None] + d))
            p, c = np.nonzero((i >= 0) & (np.abs(d - goal[:, None]) <= (limit - edits)[:, None]))
            i, d = i[p, c], d[c]
            i += self._common(x[p] + i, y[p] + i - d, np.minimum(n[p] - i, m[p] - i + d))
            reach[:, low:high] = -2
            reach[p, low + c] = i
            done = np.zeros(len(pair), bool)
            done[p[(d == goal[p]) & (i == n[p])]] = True
        out[pair[done]] = True
        return out
