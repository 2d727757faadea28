"""Plain versions of the operators, row by row and pair by pair, for small tables."""

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text):
    words = WORD.findall(fold(text))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def components(texts):
    """Number of the group of each text: the first index reachable."""
    sets = [shingles(t) for t in texts]
    group = list(range(len(texts)))
    for _ in texts:
        before = list(group)
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 75 * len(a | b):
                    group[i] = group[j] = min(group[i], group[j])
        if before == group:
            return group
    return group


def recurring_removed(texts):
    """(n_words, n_removed, kept words) of each text."""
    lists = [WORD.findall(t or "") for t in texts]
    count = Counter(tuple(w[i : i + 35]) for w in lists for i in range(len(w) - 34))
    out = []
    for words in lists:
        gone = {k for i in range(len(words) - 34) if count[tuple(words[i : i + 35])] > 1 for k in range(i, i + 35)}
        out.append((len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)))
    return out


def benchmark_windows(items):
    found = {}
    for item, text in items:
        words = ALNUM.findall(fold(text))
        size = min(13, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            found.setdefault(tuple(words[i : i + size]), set()).add(item)
    return found


def hits(text, windows):
    """(n_words, n_hit, items)"""
    words, covered, items = ALNUM.findall(fold(text)), set(), set()
    for size in {len(w) for w in windows}:
        for i in range(len(words) - size + 1):
            found = windows.get(tuple(words[i : i + size]))
            if found is not None:
                covered.update(range(i, i + size))
                items |= found
    return len(words), len(covered), items


def counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words"""
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeated = {k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated)


def without_boilerplate(rows, ratio, least):
    """rows: (host, text); the texts without lines that too many of a host's texts have."""
    trim = lambda line: line.strip(" \t\n\r\x0b\x0c")
    pages = Counter(host for host, _ in rows)
    have = Counter((host, line) for host, text in rows for line in {trim(x) for x in (text or "").split("\n")} - {""})
    gone = {key for key, n in have.items() if n >= least and n > ratio * pages[key[0]]}
    return [None if text is None else "\n".join(x for x in text.split("\n") if (host, trim(x)) not in gone) for host, text in rows]
