"""Merkle manifest against a plain recursion over lists."""

from __future__ import annotations

import hashlib
import zlib

import pytest

from tabula.llm.merkle import document_manifest

from .data import frame, none, texts


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text) -> str:
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def lower(text):
    return text if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def climb(hashes: list[str]):
    """The last node over ``hashes``, and for each of them its siblings (left, right) upwards."""
    paths = [[] for _ in hashes]
    at, level = list(range(len(hashes))), hashes
    while len(level) > 1:
        for i, a in enumerate(at):
            run = a // 16 * 16
            paths[i].append(("".join(level[run:a]), "".join(level[a + 1 : run + 16])))
        level = [h(*level[i : i + 16]) for i in range(0, len(level), 16)]
        at = [a // 16 for a in at]
    return level[0], paths


def plain(rows):
    by: dict = {}
    for r in rows:
        by.setdefault(r["source"], []).append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        key = lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(*r))
        mine = sorted(by[s], key=key)
        trees[s] = (mine, *climb([leaf(*r) for r in mine]))
    root, tops = climb([trees[s][1] for s in names]) if names else ("", [])
    out = []
    for s, top in zip(names, tops):
        mine, sub, paths = trees[s]
        for r, path in zip(mine, paths):
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
            node = leaf(*r[:4], lower(r["text"])) if hit else leaf(*r)
            for left, right in path + top:
                node = h(left, node, right)
            proof = h(*[a + b for a, b in path + top])
            out.append((r["doc_id"], leaf(*r), sub, root, proof, node, node == root))
    return out


def check(docs):
    rows = docs.select("doc_id", "source", "lang", "n_chars", "text").collect()
    got = [tuple(r) for r in document_manifest(docs).collect()]
    assert sorted(got, key=repr) == sorted(plain(rows), key=repr)
    return got


def test_hot_source_over_several_blocks(spark):
    rows = [f"Text Number {i}" for i in range(900)]
    got = check(frame(spark, rows, sources=["hot" if i % 9 else f"s{i % 40}" for i in range(900)]))
    hit = [g for g in got if zlib.crc32(str(g[0]).encode()) % 5 == 0]
    assert hit and not any(g[-1] for g in hit) and all(g[-1] for g in got if g not in hit)


def test_odd_rows(spark):
    rows = texts(n=10)
    ids = [None if i % 7 == 0 else i // 2 for i in range(len(rows))]
    check(frame(spark, rows, sources=[None, "", "ä", "a", "a"] * 20, ids=ids))


@pytest.mark.parametrize("n", [1, 2, 16, 17, 257])
def test_one_source_of_any_size(spark, n):
    check(frame(spark, ["x"] * n, sources=["one"] * n, ids=[None] * n))


def test_empty_table(spark):
    assert document_manifest(none(spark)).count() == 0
