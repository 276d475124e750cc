"""Plain Python versions of what the operators return, and awkward documents to try them on."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").toPandas()
    return rows.sort_values("doc_id")


def awkward(spark):
    """Documents with nulls everywhere, empty and long texts, repeated rows, and clashing names."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    long = " ".join(rng.choice(words) for _ in range(30_000))
    passage = " ".join(f"p{i}" for i in range(40))
    texts = [
        None,
        "",
        " \n\t ",
        "one",
        "Ein Wort. zwei\x0bdrei\x0cvier\r\n fünf  sechs \x1f sieben acht ▁ <s> <|endoftext|> end",
        long,
        long + " tail",
        passage,
        f"before {passage}\nafter {passage}",
        "same line\nsame line\n\nsame line " * 30,
        "x" * 50_000,
        "\ufdd0 mark \ufdd0\n\n  two  spaces ",
        "a\x00b 😀 é é İ ſ ½ ²",
    ]
    rows = [(i, t, "en" if i % 2 else None, f"src{i % 3}" if i % 4 else None, len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], rows[7], rows[8], (None, "one", "en", None, 3), (None, None, None, None, None)]
    rows += [(20, f"{passage} more", "en", "src1", 10), (20, f"less {passage}", "en", "src1", 10)]
    frame = spark.createDataFrame(rows, SCHEMA)
    clashing = ["g", "bucket", "measures", "print", "Copy", "doc", "a.b", "of_lang", "mix_id", "size", "least", "root", "anchor", "home", "follows", "r"]
    for i, name in enumerate(clashing):
        frame = frame.selectExpr("*", f"{i} as `{name}`")
    return frame.selectExpr("*", "map('k', doc_id) as entries")


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def simhash(text: str | None) -> int:
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def groups(n: int, linked) -> list[int]:
    """The least place connected with each place, by trying all pairs."""
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def removals(rows: list[tuple]) -> list[tuple]:
    """(doc_id, n_words, n_removed, kept_sha256) of (doc_id, text)."""
    words = [WORD.findall(text or "") for _, text in rows]
    rank = [float("inf") if doc_id is None else doc_id for doc_id, _ in rows]
    first: dict[tuple, float] = {}
    for i, own in zip(rank, words, strict=True):
        for j in range(len(own) - 12):
            key = tuple(own[j : j + 13])
            first[key] = min(first.get(key, i), i)
    out = []
    for (doc_id, _), i, own in zip(rows, rank, words, strict=True):
        gone = [False] * len(own)
        for j in range(len(own) - 12):
            if first[tuple(own[j : j + 13])] < i:
                gone[j : j + 13] = [True] * 13
        kept = " ".join(w for w, g in zip(own, gone, strict=True) if not g)
        out.append((doc_id, len(own), sum(gone), sha(kept)))
    return out


def jaccard(a: list[str], b: list[str]) -> float:
    x, y = Counter(a), Counter(b)
    union = sum((x | y).values())
    return sum((x & y).values()) / union if union else 1.0


def multiset(rows) -> Counter:
    return Counter(tuple(repr(x) if isinstance(x, dict) else x for x in row) for row in rows)
