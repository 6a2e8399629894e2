"""The operators again, in plain Python over lists, to compare with."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LINE_END = re.compile(r"\n(?=[\x20\x09\x0B-\x0D]*[^\x20\x09-\x0D])")
SPACES = " \t\n\r\x0b\x0c"


def lower_ascii(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text: str | None, length: int = 2) -> set:
    words = WORD.findall(lower_ascii(text or ""))
    if len(words) < length:
        return {tuple(words)} if words else set()
    return set(zip(*[words[k:] for k in range(length)]))


def near_components(docs: list[tuple[int, str | None]], percent: int = 80, length: int = 2) -> dict[int, int]:
    sets = {d: shingles(t, length) for d, t in docs}
    holders = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for d, s in sets.items():
        for e, common in Counter(e for x in s for e in holders[x] if e < d).items():
            if 100 * common >= percent * (len(s) + len(sets[e]) - common):
                a, b = find(d), find(e)
                root[max(a, b)] = min(a, b)
    return {d: find(d) for d in sets}


def removed_lines(docs: list[tuple[int, str | None]], min_words: int) -> dict[int, set[int]]:
    """Runs of any number of lines that stand earlier, of enough words."""
    lines = {d: [x.strip(SPACES) for x in LINE_END.split(t or "")] for d, t in docs}
    removed = defaultdict(set)
    for length in range(1, max(map(len, lines.values()), default=0) + 1):
        seen, again = set(), False
        for d in sorted(lines):
            for i in range(len(lines[d]) - length + 1):
                run = tuple(lines[d][i : i + length])
                if not all(run):
                    continue
                if run in seen:
                    again = True
                    if sum(len(WORD.findall(x)) for x in run) >= min_words:
                        removed[d].update(range(i, i + length))
                seen.add(run)
        if not again:
            break
    return removed


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for k in range(len(words) - 2):
        if windows[tuple(words[k : k + 3])] > 1:
            covered |= {k, k + 1, k + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def tail_probability(n: int, k: int, risk: float) -> float:
    from math import comb

    return sum(comb(n, j) * risk**j * (1 - risk) ** (n - j) for j in range(k + 1))
