"""Plain versions of what the operators compute, and the odd rows that every operator must take."""

from __future__ import annotations

import re
from collections import Counter

import xxhash

LONG = " ".join(f"w{i * 7919 % 5003}" for i in range(30_000))

#: doc_id, text, lang, source, n_chars, and a column that clashes with names the operators use inside.
ROWS = [
    (1, "The cat sat on the mat and looked at the dog. " * 3, "en", "a", 0, "x"),
    (2, "The cat sat on the mat and looked at the dog. " * 3, "en", "a", 0, "y"),
    (2, "The cat sat on the mat and looked at the dog. " * 3, "en", "a", 0, "y"),
    (3, None, "en", "b", 0, None),
    (4, "", None, None, 0, "x"),
    (5, " \t\n\x0b\x0c\r ", "en", None, 0, "x"),
    (6, "one", "fr", "b", 0, "x"),
    (7, "ONE two", "fr", "b", 0, "x"),
    (8, LONG, "en", "a", 0, "x"),
    (9, LONG + " tail", "en", "c", 0, "x"),
    (10, "é\u00a0ñ\u2003ü zwölf\u0301 \x1c \x85 <|endoftext|> don't. 好。 x́.", "de", "c", 0, "x"),
    (None, "a row without an id but with some words in it", "en", "c", 0, "x"),
    (11, "line one\nline one\n \nline one\nother # * $ % & | < > line", "en", "c", 0, "x"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string"


def odd_docs(spark, rows=None):
    return spark.createDataFrame(ROWS if rows is None else rows, SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


def simhash(text):
    w = words(lower(text))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, linked):
    """Smallest node reachable from each, over all pairs for which ``linked`` holds."""
    nodes = sorted(nodes)
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def base_statistics(text):
    w = words(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = Counter(windows)
    covered = {j for i, x in enumerate(windows) if often[x] > 1 for j in (i, i + 1, i + 2)}
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            repeated += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), repeated, len(covered), failed
