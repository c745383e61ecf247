"""Agreement of two texts: longest common subsequence in bit-parallel form, the best matching stretch by exact seeds, aligned segments by unique anchors."""

from __future__ import annotations

from bisect import bisect_left


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence; a's characters are the bits of one whole number, b's are its steps."""
    if len(a) > len(b):
        a, b = b, a
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    rest = full  # a zero bit for each column where the length grows
    for c in b:
        hit = rest & at.get(c, 0)
        rest = ((rest + hit) | (rest - hit)) & full
    return len(a) - rest.bit_count()


def likeness(a: str, b: str) -> float:
    """Twice the common subsequence over both lengths, 0 to 1; 1 for two empty texts."""
    return 2 * lcs_length(a, b) / (len(a) + len(b)) if a or b else 1.0


def stands_in(needle: str, hay: str, share: float = 0.95) -> bool:
    """Whether some stretch of the longer text, as long as the shorter one or cut off at an end, has a likeness of `share` with it.

    A stretch that is like enough differs by at most E = (1 - share) * 2 m edits (characters left out or put in), so of E + 1 blocks of the shorter text one stands
    in it unchanged, within E of its place; only stretches around such places are measured."""
    if not needle or not hay:
        return False
    if len(needle) > len(hay):
        needle, hay = hay, needle
    if needle in hay:
        return True
    m = len(needle)
    edits = int((1 - share) * 2 * m + 1e-9)
    if not edits:
        return False
    edges = [m * k // (edits + 1) for k in range(edits + 2)]
    starts: set[int] = set()
    for lo, hi in zip(edges, edges[1:]):
        block, p = needle[lo:hi], -1
        while block and (p := hay.find(block, p + 1)) >= 0:
            starts.update(range(max(p - lo - edits, 1 - m), min(p - lo + edits, len(hay) - 1) + 1))
    return any(likeness(needle, hay[max(0, s) : s + m]) >= share - 1e-9 for s in sorted(starts))


def anchors(a: str, b: str, q: int) -> list[tuple[int, int]]:
    """Places of runs of q characters that stand once in each text, as the longest chain that rises in both."""

    def once(s: str) -> dict[str, int]:
        seen: dict[str, int] = {}
        for i in range(len(s) - q + 1):
            g = s[i : i + q]
            seen[g] = -1 if g in seen else i
        return {g: i for g, i in seen.items() if i >= 0}

    theirs = once(b)
    pairs = sorted((i, theirs[g]) for g, i in once(a).items() if g in theirs)
    tails: list[int] = []  # the least last place of a chain of each length
    ends: list[int] = []
    before = [-1] * len(pairs)
    for k, (_, j) in enumerate(pairs):
        n = bisect_left(tails, j)
        before[k] = ends[n - 1] if n else -1
        tails[n : n + 1], ends[n : n + 1] = [j], [k]
    chain, k = [], ends[-1] if ends else -1
    while k >= 0:
        chain.append(pairs[k])
        k = before[k]
    return chain[::-1]


MARGIN, MOST_CELLS = 16, 1_000_000  # how far a banded alignment leaves the diagonal, and how large it may be


def banded(a: str, b: str) -> list[tuple[bool, str, str]]:
    """Stretches of an alignment with the fewest edits within a band around the diagonal; texts too large for it do not agree at all."""
    low, high = min(0, len(b) - len(a)) - MARGIN, max(0, len(b) - len(a)) + MARGIN
    width = high - low + 1
    if (len(a) + 1) * width > MOST_CELLS:
        return [(False, a, b)]
    far = len(a) + len(b) + 1
    cost = [j + low if 0 <= j + low <= len(b) else far for j in range(width)]  # row i: cell j stands for b's place i + low + j
    moves = [bytearray(b"i" * width)]
    for i, c in enumerate(a, 1):
        new, move = [far] * width, bytearray(width)
        for j in range(width):
            at = i + low + j
            if not 0 <= at <= len(b):
                continue
            best, way = far, 0
            if at:
                best, way = cost[j] + (c != b[at - 1]), 109 if c == b[at - 1] else 115  # match, substitute
            if j + 1 < width and cost[j + 1] + 1 < best:
                best, way = cost[j + 1] + 1, 100  # a's character left out
            if j and new[j - 1] + 1 < best:
                best, way = new[j - 1] + 1, 105  # b's put in
            new[j], move[j] = best, way
        cost = new
        moves.append(move)
    out: list[tuple[bool, str, str]] = []
    i, at = len(a), len(b)
    while i or at:
        way = moves[i][at - i - low] if i else 105
        x, y = ("" if way == 105 else a[i - 1]), ("" if way == 100 else b[at - 1])
        i, at = i - (way != 105), at - (way != 100)
        same = way == 109
        if out and out[-1][0] == same:
            out[-1] = (same, x + out[-1][1], y + out[-1][2])
        else:
            out.append((same, x, y))
    return out[::-1]


def segments(a: str, b: str, q: int = 6) -> list[tuple[bool, str, str]]:
    """The texts cut into stretches (agree, of a, of b) in order: between unique anchors of q characters, then of shorter ones inside what is left, then by a banded alignment."""
    if a == b:
        return [(True, a, b)] if a else []
    if not a or not b:
        return [(False, a, b)]
    if q < 2:
        return banded(a, b)
    out: list[tuple[bool, str, str]] = []

    def gap(x: str, y: str) -> None:
        """A stretch between anchors: its common edges agree, the inside is tried with shorter anchors."""
        head = 0
        while head < min(len(x), len(y)) and x[head] == y[head]:
            head += 1
        tail = 0
        while tail < min(len(x), len(y)) - head and x[-1 - tail] == y[-1 - tail]:
            tail += 1
        if head:
            out.append((True, x[:head], x[:head]))
        inner_x, inner_y = x[head : len(x) - tail], y[head : len(y) - tail]
        if inner_x or inner_y:
            out.extend(segments(inner_x, inner_y, q // 2))
        if tail:
            out.append((True, x[len(x) - tail :], x[len(x) - tail :]))

    i = j = 0
    for x, y in [*anchors(a, b, q), (len(a), len(b))]:
        if x < i or y < j:  # overlaps the anchor before: it must go on from there
            if x - i == y - j and x < len(a):
                out.append((True, a[i : x + q], a[i : x + q])) if x + q > i else None
                i, j = max(i, x + q), max(j, y + q)
            continue
        if x > i or y > j:
            gap(a[i:x], b[j:y])
        if x < len(a):
            out.append((True, a[x : x + q], a[x : x + q]))
        i, j = x + q, y + q
    merged: list[tuple[bool, str, str]] = []
    for same, x, y in out:
        if merged and merged[-1][0] == same:
            merged[-1] = (same, merged[-1][1] + x, merged[-1][2] + y)
        else:
            merged.append((same, x, y))
    return merged
